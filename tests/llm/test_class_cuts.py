from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanshift.llm import class_cuts, text
from loanshift.llm.class_cuts import CLASSES, UNITS, ClassMatrix, transform

TEXTS = [
    "", None, "a", "é", "汉", "😀", "a\nb\n\nc", "né汉😀 mix\nof\nall 😀😀é", "x" * 3000, "汉" * 1500, "has <P> a mark", "<S>", "ends <M>", "<P", "a<b<S c>", "\n" * 9,
]


def test_ranks_and_places():
    draw = np.random.default_rng(3)
    for n in (0, 1, 63, 64, 65, 1000):
        classes = draw.integers(0, 6, n).astype(np.uint8)
        matrix, places = ClassMatrix(classes), np.arange(n + 1)
        for kind in range(6):
            assert matrix.rank(kind, places).tolist() == [0, *np.cumsum(classes == kind).tolist()]
        for unit in UNITS.values():
            marks = np.isin(classes, unit.classes)
            assert matrix.boundaries(unit, places).tolist() == [0, *np.cumsum(marks).tolist()]


def cut(text, k, unit):
    if unit == "chars":
        return len(text[:k].encode())
    return len("".join(line + "\n" for line in text.split("\n")[:k]).encode())


@pytest.mark.parametrize("unit", ["chars", "lines"])
def test_every_cut_of_every_text(unit):
    texts = [t or "" for t in TEXTS]
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(r) for r in raw])
    starts = np.concatenate([[0], ends[:-1]])
    matrix = ClassMatrix(CLASSES[np.frombuffer(b"".join(raw), np.uint8)])
    n = matrix.boundaries(UNITS[unit], ends) - matrix.boundaries(UNITS[unit], starts)
    assert n.tolist() == [len(t) if unit == "chars" else t.count("\n") for t in texts]
    for k in range(12):
        found = matrix.locate(UNITS[unit], starts, ends, np.minimum(k, n)) - starts
        assert found.tolist() == [cut(t, min(k, m), unit) for t, m in zip(texts, n.tolist())]


def brute(doc_id, text, rate, spm, seed):
    x = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[k : k + 8], 16) for k in range(0, 32, 8)]
    text = text or ""
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return doc_id, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


@pytest.mark.parametrize("rate, spm, seed, at_once", [(90, 20, "1", 4 << 20), (100, 100, "7", 10), (100, 0, "", 1), (0, 50, "x", 99)])
def test_against_brute_force(spark, monkeypatch, rate, spm, seed, at_once):
    monkeypatch.setattr(text, "BYTES_AT_ONCE", at_once)
    rows = [(None if k == 5 else k % 60, t) for k, t in enumerate(TEXTS * 6)]
    docs = spark.createDataFrame([(i, t, "f", 1) for i, t in rows], "doc_id long, text string, form string, n int").repartition(3)
    found = transform(docs, rate=rate, spm=spm, seed=seed)
    back = found.select("*", class_cuts.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert sorted(((*r,)[:6] for r in back), key=str) == sorted((brute(i, t, rate, spm, seed) for i, t in rows), key=str)
    assert sorted(r.back for r in back) == sorted(t or "" for _, t in rows)


def test_lines_stay_whole(spark):
    docs = spark.createDataFrame([(k, "one\ntwo\nthree\nfour\nrest") for k in range(40)], "doc_id long, text string")
    for r in transform(docs, unit="lines", rate=100, spm=0).collect():
        prefix, rest = r.output.removeprefix("<P>").split("<S>")
        assert r.n == 4 and prefix.count("\n") == r.prefix_units and (not prefix or prefix.endswith("\n"))
        assert rest.split("<M>")[1].count("\n") == r.middle_units


def test_empty_table(spark):
    assert transform(spark.createDataFrame([], "doc_id long, text string")).count() == 0
