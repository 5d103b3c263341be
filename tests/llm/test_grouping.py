import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loanshift.llm import grouping

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("seed", range(8))
def test_a_histogram_is_packed_whole_and_tightly(seed):
    draw = np.random.default_rng(seed)
    capacity = [4096, 100, 64, 8][seed % 4]
    lengths = np.clip(draw.lognormal(np.log(capacity / 6), 0.9, 5000).astype(int), 1, capacity)
    counts = np.bincount(lengths, minlength=capacity + 1)
    if seed >= 4:
        counts[capacity // 3] += 2500
    runs = grouping.pack_histogram(counts, capacity)
    packed = np.zeros_like(counts)
    for sequences, content in runs:
        assert sequences > 0 and sum(n * k for n, k in content) <= capacity
        for length, each in content:
            packed[length] += sequences * each
    assert (packed == counts).all()
    least = -(-int((np.arange(capacity + 1) * counts).sum()) // capacity)
    assert sum(n for n, _ in runs) <= 1.03 * least + 3


@pytest.mark.parametrize("lengths", [[], [8], [8] * 50, [1] * 50, [5] * 50, [3, 5], [4] * 7 + [3]])
def test_small_histograms(lengths):
    runs = grouping.pack_histogram(np.bincount(lengths, minlength=9).astype(np.int64), 8)
    expected = {(): 0, (8,): 1, (8,) * 50: 50, (1,) * 50: 7, (5,) * 50: 50, (3, 5): 1}.get(tuple(lengths), 4)
    assert sum(n for n, _ in runs) == expected


def check(rows, capacity):
    """Gapless sequences that hold every row."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pieces_and_places(spark, monkeypatch):
    monkeypatch.setattr(grouping, "RANKED_AT_ONCE", 7)
    draw = random.Random(1)
    texts = ["the cat sat on the mat. " * draw.randrange(12) for _ in range(300)] + [None, "", "word " * 1000, "a b c"] + ["a b c"] * 100
    rows = [(None if k == 5 else k % 390, t, "x") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(4)
    found = grouping.pack_documents(df, PATH, 1, 64).collect()
    whole, expected = Tokenizer.from_file(PATH), Counter()
    for i, t, _ in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            expected[i, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    used = check(found, 64)
    rooms = []
    for length in sorted((r.length for r in found), reverse=True):
        fitting = [room for room in rooms if room >= length]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - length)
        else:
            rooms.append(64 - length)
    # Rounding up may cost a sequence per group, whatever the number of pieces.
    assert used <= 1.02 * len(rooms) + grouping.GROUPS
    again = grouping.pack_documents(df.repartition(2), PATH, 1, 64).collect()
    assert Counter(tuple(r) for r in again) == Counter(tuple(r) for r in found)
    assert grouping.pack_documents(df.where(F.lit(False)), PATH).count() == 0
