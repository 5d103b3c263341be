import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loanshift.llm import text, wavelet

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "a\x0bb\x0cc\x85d\xa0e f", "\u00e9 e\u0301x <|endoftext|>foo<|startoftext|> \u0130STANBUL \u03a3\u0391\u03a3 \u03c2 don't 'S 123 \u00bd\ufb01 \u200b",
    "", None, "x" * 50 + "\u65e5\u672c\u8a9e \u30c6\u30ad\u30b9\u30c8\x1c\x1d q", "It's we'll, |,! \u00ff\u00f7\u00df \u00c0\u00c9 \u0130 <|ENDOFTEXT|> a, b.c \u00e9\u0301 ok",
    " \n ", "THE the The, the.", "I\u0307 \u00aa\u00ba \u1e9e \u212a",
]


def test_ids_are_those_of_whole_texts():
    whole = Tokenizer.from_file(PATH)
    for limit in (500_000, 3):
        encoder = text.WordEncoder(PATH, limit)
        found = [np.frombuffer(raw, "<u4").tolist() for raw in encoder.encode(ODD * 2)]
        assert found == [whole.encode(t or "", add_special_tokens=False).ids for t in ODD * 2]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aZ\u00e9\u00c9\u0301\u0130\u03a3 \n\x0b\x85\u00a0'.,<|>1\u00bd\u65e5s"), max_size=20))
def test_ids_of_any_text(sample):
    whole = Tokenizer.from_file(PATH).encode(sample, add_special_tokens=False).ids
    assert np.frombuffer(next(text.encoder(PATH).encode([sample])), "<u4").tolist() == whole


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (1, 70_000), (513, 3), (5000, 49_407), (4096, 2)])
def test_wavelet_matrix_equals_the_plain_sequence(n, top):
    draw = random.Random(n + top)
    ids = [draw.choice([0, 1, top, draw.randrange(top + 1)]) for _ in range(n)]
    matrix = wavelet.WaveletMatrix.build(np.array(ids, "<u4"))
    assert matrix.decode().tolist() == ids
    for place in draw.sample(range(n), min(n, 40)):
        assert matrix.access(place) == ids[place]
    for token in {0, 1, top, *draw.sample(ids, min(n, 5)), top + 1, 1 << 20}:
        places = [k for k, x in enumerate(ids) if x == token]
        assert matrix.count(token) == len(places)
        for place in {0, n // 3, n}:
            assert matrix.rank(token, place) == sum(p < place for p in places)
        for k in {0, len(places) // 2, len(places) - 1} if places else ():
            assert matrix.select(token, k) == places[k]
        with pytest.raises(IndexError):
            matrix.select(token, len(places))


def test_files_give_back_every_document_in_order(spark, tmp_path):
    rows = [(k * 7 % 50, f"word{k} the cat " * (k % 9)) for k in range(50)]
    rows += [(60 + k, t) for k, t in enumerate(ODD)] + [(61, "again"), (61, "again"), (None, "no id")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, file string").repartition(3)
    whole = Tokenizer.from_file(PATH)
    for name, shard_tokens in (("one", 1 << 20), ("many", 64)):
        wavelet.write_shards(df, f"{tmp_path}/{name}", PATH, 1, shard_tokens)
        found = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in wavelet.read_documents(spark, f"{tmp_path}/{name}").collect())
        expected, start = [], 0
        for i, t in sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], (r[1] or "").encode())):
            ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
            expected.append((start, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        assert found == expected
    wavelet.write_shards(df.where(F.lit(False)), f"{tmp_path}/none", PATH)
    assert wavelet.read_documents(spark, f"{tmp_path}/none").count() == 0
