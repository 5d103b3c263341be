import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from loanshift.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, row string, rank int, score double"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def runs(text, longest):
    words = WORD.findall(lowered(text))
    return [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, longest, buckets, share, min_words, seed="2024"):
    bucket = lambda run: zlib.crc32(run.encode()) % buckets
    s = Counter(bucket(r) for _, text in rows for r in runs(text, longest))
    t = Counter(bucket(r) for text in target for r in runs(text, longest))
    all_s, all_t = float(s.total()), float(t.total())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)}
    found = []
    for doc_id, text in rows:
        mine = runs(text, longest)
        h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(r)] for r in mine)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([doc_id, len(runs(text, 1)), len(mine), weight, score, None])
    enough = sorted((r for r in found if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, row in enumerate(enough[: share * len(enough) // 100], start=1):
        row[5] = rank
    return sorted(map(tuple, found), key=str)


ROWS = [
    (1, "The cat SAT on the mat, again and again"), (2, None), (3, ""), (4, "  \n\t..."), (5, "één Ünï 汉字 漢 ÀB x9 9x\x00y\x7fz"),
    (6, "cat cat cat"), (6, "cat cat cat"), (6, "cat cat cat"), (None, "cat mat sat"), (7, "a-b_c'd e/f:g;h"), (8, "mat " * 40),
    (9, "😀 cat 😀😀"), (10, "again and again and again"), (11, "the the the the"),
]


@pytest.mark.parametrize("longest", [1, 2, 3])
@pytest.mark.parametrize("at_once", [1, 7, 100_000])
def test_words_and_runs(monkeypatch, longest, at_once):
    monkeypatch.setattr(importance, "AT_ONCE", at_once)
    for _, text in [*ROWS, (0, "word, " * 500 + "x" * 3000 + " end")]:
        n, found = importance.run_buckets(lowered(text), longest, 997)
        assert n == len(runs(text, 1))
        assert Counter(found) == Counter(zlib.crc32(r.encode()) % 997 for r in runs(text, longest))
        spans = [(w, lowered(text)[a:b]) for part in importance.words_with_offsets(lowered(text)) for w, (a, b) in part]
        assert all(word == there for word, there in spans)


@pytest.mark.parametrize("longest, buckets, share", [(1, 64, 50), (2, 70_000, 100), (3, 10, 0)])
def test_against_brute_force(spark, longest, buckets, share):
    target = [("the cat sat",), (None,), ("",), ("mat mat",)]
    docs = spark.createDataFrame([(i, t, "r", 1, 0.5) for i, t in ROWS], SCHEMA).repartition(5)
    wanted = spark.createDataFrame(target, "text string")
    found = importance.resample(docs, wanted, longest, buckets, share, min_words=2)
    got = [tuple(r) for r in found.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()]
    expected = brute(ROWS, [t for (t,) in target], longest, buckets, share, 2)
    # Rows alike in id and score may swap ranks.
    assert sorted(got, key=str) == expected or Counter(g[:5] for g in got) == Counter(e[:5] for e in expected)
    assert sorted((g[5], g[0], g[4]) for g in got if g[5]) == sorted((e[5], e[0], e[4]) for e in expected if e[5])


def test_drawn_rows_keep_their_columns(spark):
    docs = spark.createDataFrame([(i, t, f"r{k}", k, 0.5) for k, (i, t) in enumerate(ROWS)], SCHEMA)
    drawn = importance.draw(docs, spark.createDataFrame([("cat",)], "text string"), min_words=3, share=60)
    assert drawn.columns == docs.columns
    enough = sum(len(runs(t, 1)) >= 3 for _, t in ROWS)
    assert drawn.count() == 60 * enough // 100 == drawn.select("rank").distinct().count()


def test_empty_tables(spark):
    docs, none = spark.createDataFrame(ROWS, "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    assert importance.resample(none, docs).count() == 0
    found = importance.resample(docs, none, min_words=0, share=100)
    assert found.where(F.col("rank").isNull()).count() == 0


def test_ranks_do_not_depend_on_partitions(spark):
    rows = [(k % 50, " ".join(["w%d" % (k * j % 17) for j in range(25)])) for k in range(400)]
    docs, target = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("w1 w2 w3",)], "text string")
    results = [
        Counter(tuple(r) for r in importance.resample(docs.repartition(n), target).select("doc_id", "score", "rank").collect())
        for n in (1, 9)
    ]
    assert results[0] == results[1]
