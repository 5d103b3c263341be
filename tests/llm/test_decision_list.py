import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loanshift.llm import decision_list


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed
    )


def texts(seed):
    draw = random.Random(seed)
    found = [None, "", " \n\t", "a", "a b", "a b c", "a a a a", "a b c a b c", "x\n\nx\n x\nx\r\n", "#*$%&|<> é日本 😀\x85y\xa0z", "w " * 20_000]
    for _ in range(60):
        words = [draw.choice(["the", "cat", "#", "|x", "É", "sat", "on", "mat."]) for _ in range(draw.randrange(120))]
        found.append("".join(w + draw.choice([" ", "  ", "\n", "\t"]) for w in words))
    return found


def test_counts_equal_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts(1))]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    empty = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    found = {r.doc_id: tuple(r)[1:] for r in decision_list.judge(df, empty).collect()}
    for i, t, _ in rows:
        expected = brute(t)
        assert found[i] == (*expected, not expected[-1], 0), t


def labelled_docs():
    draw = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 9))) for _ in range(80)]
        kind = i % 4
        if kind == 1:
            words = [w.upper() + "!!" for w in words]
        if kind == 2:
            words = [x for w in words for x in (w, "|")]
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(kind not in (1, 2)), 0))
    return rows, labels


def test_rules_separate_held_out_documents(spark):
    rows, labels = labelled_docs()
    df = spark.createDataFrame(rows, "doc_id long, text string, bad string")
    known = [r for r in labels if r[0] % 5] + [(3, 0, 0), (None, 1, 0), (7, None, 0)]
    marks = spark.createDataFrame(known, "doc_id long, quality long, toxic long")
    judged = {r.doc_id: r.kept for r in decision_list.judge(df, marks).collect()}
    assert judged == {i: bool(q) for i, q, _ in labels}
    kept = decision_list.keep_good(df, marks)
    assert kept.columns == df.columns
    assert sorted(tuple(r) for r in kept.collect()) == sorted(r for r in rows if labels[r[0]][1])
    assert decision_list.keep_good(df.where(F.lit(False)), marks).count() == 0


def test_rules_print_and_keep_their_order():
    rules = [(decision_list.Condition("n_words", False, 60.0),), (decision_list.Condition("upper_share", True, 0.5),)]
    assert [str(c) for rule in rules for c in rule] == ["n_words < 60", "upper_share >= 0.5"]


@pytest.mark.parametrize("quality", [0, 1])
def test_one_sided_labels_give_no_rule(spark, quality):
    rows, _ = labelled_docs()
    df = spark.createDataFrame(rows, "doc_id long, text string, x string")
    marks = spark.createDataFrame([(i, quality, 0) for i in range(400)], "doc_id long, quality long, toxic long")
    assert all(r.kept for r in decision_list.judge(df, marks).collect())


def statistic_rows(spark, values):
    """Rows ``(doc_id, bad, statistics)`` whose statistics are 0.5 but for those given."""
    names = decision_list.STATISTICS
    rows = [(i, bad, *[float(own.get(n, 0.5)) for n in names]) for i, (bad, own) in enumerate(values)]
    return spark.createDataFrame(rows, "doc_id long, bad int, " + ", ".join(f"{n} double" for n in names))


def caught(rows, rules):
    return {r.doc_id for r in rows.where(decision_list.verdict(rules) > 0).collect()}


def test_an_inseparable_kind_hides_no_precise_rule(spark):
    """A large kind of bad rows that gains but is never precise, beside 93 of 9,000 that one statistic parts."""
    draw = random.Random(7)
    values = []
    for i in range(9000):
        if i % 97 == 0:
            values.append((1, {"symbol_share": draw.uniform(0.5, 0.9), "word_length": draw.random()}))
        else:
            mixed = draw.random() < 0.3
            bad = int(mixed and draw.random() < 0.6)
            values.append((bad, {"symbol_share": draw.uniform(0, 0.02), "word_length": draw.uniform(0.6, 1) if mixed else draw.uniform(0, 0.6)}))
    rows = statistic_rows(spark, values)
    rules = decision_list.learn(rows)
    planted = {i for i in range(9000) if i % 97 == 0}
    found = caught(rows, rules)
    assert planted <= found and len(found) <= len(planted) * 1.1


def test_rare_kinds_at_both_tails_are_all_learned(spark):
    draw = random.Random(8)
    kinds = {0: {"dup_line_share": 0.97}, 1: {"distinct_share": 0.01}, 2: {"mark_share": 0.9}}
    values = [(1, kinds[i % 3]) if i % 100 < 1 or i % 100 == 50 else (0, {"dup_line_share": draw.uniform(0, 0.9), "distinct_share": draw.uniform(0.1, 1), "mark_share": draw.uniform(0, 0.8)}) for i in range(6000)]
    # One good row further out than all bad ones does not hide them.
    values[7] = (0, {"mark_share": 500.0})
    rows = statistic_rows(spark, values)
    bad = {i for i, (b, _) in enumerate(values) if b}
    found = caught(rows, decision_list.learn(rows))
    assert len(found & bad) >= 0.98 * len(bad) and len(found - bad) <= 2


def test_empty_tables_null_ids_and_repeated_rows(spark):
    rows, labels = labelled_docs()
    marks = spark.createDataFrame(labels, "doc_id long, quality long, toxic long")
    none = spark.createDataFrame([], "doc_id long, text string, rule string")
    assert decision_list.judge(none, marks).count() == 0
    odd = [(None, rows[0][1], "x"), (None, None, "y"), *[rows[0]] * 3, *[rows[1]] * 2, *rows]
    judged = decision_list.judge(spark.createDataFrame(odd, "doc_id long, text string, rule string"), marks).collect()
    assert len(judged) == len(odd) and sum(r.kept for r in judged if r.doc_id is None) == 1
    assert {r.kept for r in judged if r.doc_id == 0} == {True} and {r.kept for r in judged if r.doc_id == 1} == {False}
