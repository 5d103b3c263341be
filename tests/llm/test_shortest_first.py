import random
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loanshift.llm import shortest_first
from loanshift.llm.shortest_first import Plan, SegmentEncoder, pack_documents, tail

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "don't they're  x", "tabs\t\tand\n\nlines \n x", "汉字 漢字  é ü", "😀 😀‍😀", "a b 　c",
    "\x1c \x1d a", "\x85 a   b", "1 22 333,44.5", "<|endoftext|>", "x <|endoftext|> y<|endoftext|>", "᠎ a᠎ b", "a ́b", " \ta", "end  ", "\n a \n",
]


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("at_once", [1, 5, 1 << 20])
def test_segments_encode_as_whole_texts(monkeypatch, at_once):
    monkeypatch.setattr(shortest_first, "AT_ONCE", at_once)
    draw, whole = random.Random(4), Tokenizer.from_file(PATH)
    parts = [t for t in ODD if t] + ["word", "The", " ", "  ", "\n", "’s", "'ll", ".", "Ünï"]
    texts = ODD + ["".join(draw.choice(parts) for _ in range(draw.randrange(30))) for _ in range(400)]
    encoder = SegmentEncoder(PATH, memo_words=50)
    for text in texts:
        assert encoder.encode(text or "") == array("I", ids_of(whole, text)).tobytes(), repr(text)


def one_by_one(counts, capacity):
    """Rooms after every piece, longest first, went into the shortest pack."""
    rooms = []
    for length in range(capacity, 0, -1):
        for _ in range(counts[length]):
            if rooms and max(rooms) >= length:
                rooms[rooms.index(max(rooms))] -= length
            else:
                rooms.append(capacity - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_patterns_equal_packing_piece_by_piece(seed):
    draw = random.Random(seed)
    capacity = draw.choice([1, 8, 16, 32, 64])
    counts = np.zeros(capacity + 1, np.int64)
    for _ in range(draw.randrange(60)):
        counts[draw.randint(1, capacity)] += draw.choice([1, 1, 2, 7, 50])
    runs = shortest_first.shortest_first(counts, capacity)
    held = np.zeros_like(counts)
    for packs, content in runs:
        for length, each in content:
            held[length] += packs * each
    assert (held == counts).all()
    assert sorted(capacity - sum(n * e for n, e in c) for packs, c in runs for _ in range(packs)) == one_by_one(counts, capacity)

    loose = draw.choice([1, 3, capacity + 1])
    plan, sequences = Plan(runs, capacity, loose), {}
    for length in range(1, capacity + 1):
        for rank in range(counts[length]):
            done = 0
            for at, size, sequence, offset in plan.parts(length, rank):
                assert at == done
                done += size
                sequences.setdefault(sequence, []).append((offset, size))
            assert done == length
    padded = 0
    for places in sequences.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= capacity
        padded = max(padded, 0 if at & (at - 1) == 0 else capacity - at)
    assert padded < max(loose, 1)


def test_tail_is_powers_of_two():
    assert tail(0) == [] and tail(13) == [8, 4, 1] and all(sum(tail(n)) == n for n in range(300))


def test_documents_come_back_whole(spark):
    draw, whole = random.Random(2), Tokenizer.from_file(PATH)
    texts = ODD + ["the cat sat on a mat. " * draw.randrange(30) for _ in range(200)] + ["word, " * 900] + ["same text here"] * 150
    rows = [(None if k == 3 else k % 370, t) for k, t in enumerate(texts)]
    schema = "doc_id long, text string, length string, part int, ids string, offset int"
    docs = spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], schema).repartition(7)
    found = pack_documents(docs, PATH, capacity=128).collect()

    sequences = {}
    for r in found:
        assert r.ids_crc32 == zlib.crc32(r.ids) and r.length == len(r.ids) // 4
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = 0
    for places in sequences.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= 128 and (128 - at < shortest_first.LOOSE or at & (at - 1) == 0)
        total += at
    expected = Counter((i, array("I", [*ids_of(whole, t), 1]).tobytes()) for i, t in rows)
    assert total == sum(len(ids) // 4 * n for (_, ids), n in expected.items())
    # Texts of unique ids are put together again; the others are counted by id.
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    for (doc_id, ids), n in expected.items():
        if len(by_id[doc_id]) and sum(k for (d, _), k in expected.items() if d == doc_id) == 1:
            own = sorted(by_id[doc_id], key=lambda r: r.start)
            assert b"".join(r.ids for r in own) == ids and [r.start for r in own] == np.cumsum([0, *[r.length for r in own]])[:-1].tolist()
            assert all(r.doc_tokens == len(ids) // 4 for r in own)


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_one_length_is_ranked_in_many_tasks(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "'one two three' as text").repartition(11)
    found = pack_documents(docs, PATH, capacity=40).collect()
    places = Counter((r.sequence_id, r.offset) for r in found)
    assert max(places.values()) == 1 and {r.doc_id for r in found} == set(range(3000))
