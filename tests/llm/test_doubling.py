import hashlib
import random

from pyspark.sql import functions as F

from loanshift.llm import doubling


def brute_gone(docs, window):
    first = {}
    cut = [(i, (t or "").encode().split()) for i, t in docs]
    for i, words in cut:
        for at in range(len(words) - window + 1):
            if i is not None:
                w = tuple(words[at : at + window])
                first[w] = min(first.get(w, i), i)
    gone = []
    for i, words in cut:
        marks = [False] * len(words)
        for at in range(len(words) - window + 1):
            if i is not None and first[tuple(words[at : at + window])] < i:
                marks[at : at + window] = [True] * window
        gone.append(marks)
    return gone


def corpus(seed, window):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["é", "a\x85b", "tab\u00a0x"]
    passages = [[draw.choice(vocabulary) for _ in range(n)] for n in (window, window + 1, 3 * window, 60, window - 1)]
    docs = []
    for i in range(60):
        words = []
        for _ in range(draw.randrange(0, 5)):
            words += draw.choice(passages) if draw.random() < 0.5 else [draw.choice(vocabulary) for _ in range(draw.randrange(30))]
        docs.append((i * 3 % 61, draw.choice(" \n").join(words)))
    docs += [(100, None), (101, ""), (102, "  \n "), (103, docs[4][1]), (104, docs[4][1]), (104, docs[7][1]), (None, docs[4][1])]
    docs += [(105, " ".join(["same"] * 200)), (106, " ".join(["same"] * (window - 1))), (107, " ".join(["same"] * window))]
    return docs


def test_digests_equal_brute_force(spark):
    for seed, window in ((1, 13), (2, 13), (3, 4), (4, 2), (5, 1)):
        docs = corpus(seed, window)
        df = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id long, text string, th string, _starts string")
        found = sorted((tuple(r) for r in doubling.digests(df.repartition(5), window).collect()), key=str)
        expected = []
        for (i, t), gone in zip(docs, brute_gone(docs, window)):
            words = (t or "").encode().split()
            kept = b" ".join(w for w, g in zip(words, gone) if not g)
            expected.append((i, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
        assert found == sorted(expected, key=str)


def test_small_groups_of_texts_give_the_same(spark, monkeypatch):
    docs = [words.split() for words in ("a b c d e f", "b c d e", "", "x y z a b c d e")]
    whole = doubling._Laid([[w.encode() for w in d] for d in docs], 4)
    assert whole.full.tolist() == [True] * 3 + [False] * 3 + [True] + [False] * 3 + [True] * 5
    every = whole.stood_for(whole.standing())
    assert every.tolist() == whole.full.nonzero()[0].tolist()


def test_grow_doubles_until_none_survives(spark):
    shared = [f"s{k}" for k in range(30)]
    docs = [(1, " ".join(["a"] + shared)), (2, " ".join(shared + ["b"])), (3, " ".join(shared[:9]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = doubling.occurrences(df, doubling.copies(df), 4)
    levels = {length: sorted((r.doc_id, r.at) for r in rows.collect()) for length, rows in doubling.grow(found, 4)}
    assert list(levels) == [4, 8, 16]
    assert levels[8] == sorted([(1, k + 1) for k in range(23)] + [(2, k) for k in range(23)] + [(3, 0), (3, 1)])
    assert levels[16] == sorted([(1, k + 1) for k in range(15)] + [(2, k) for k in range(15)])


def test_repeats_are_cut_and_columns_stay(spark):
    a = " ".join(f"w{k}" for k in range(20))
    rows = [(1, f"start\n{a}", 7, "x"), (2, f"own  words\n{a}\n\nthe end", 7, "x"), (3, None, None, "x"), (4, a, 7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, whole string")
    kept = doubling.drop_repeats(df)
    assert kept.schema == df.schema
    found = {r.doc_id: tuple(r)[1:] for r in kept.collect()}
    assert found == {1: (f"start\n{a}", 6 + len(a), "x"), 2: ("own  words\nthe end", 18, "x"), 3: (None, None, "x"), 4: ("", 0, None)}
    assert doubling.drop_repeats(df.where(F.lit(False))).count() == 0
    assert doubling.digests(df.where(F.lit(False))).count() == 0
