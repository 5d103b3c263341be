"""Part by part equals the whole; bucketed records need no shuffle; samples of exact size; sketches."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from checks import adapter as A
from loanshift.operators import metrics, panel, profile, sampling
from loanshift.plans import build, incremental
from loanshift.sources import tables


@pytest.mark.parametrize("hot_rows", [10**6, 15])
def test_quarter_by_quarter_equals_the_whole_build(spark, sf, tmp_path, hot_rows):
    rows = A.records(spark, sf).where("Loan_ID % 3 = 0").withColumn("q", F.concat(F.year("Act_Period"), F.lit("Q"), F.quarter("Act_Period")))
    rows = rows.where("Act_Period < date'1997-01-01'").cache()
    quarters, path = sorted(r["q"] for r in rows.select("q").distinct().collect()), str(tmp_path / "build")
    for before, quarter in zip([None, *quarters], quarters):
        incremental.add_quarter(spark, path, quarter, rows.where(F.col("q") == quarter).drop("q"), before, hot_rows=hot_rows)
    series = A.dimensions(spark, sf)
    whole = build.build_panel(rows.drop("q"), series, A.TEST_EDGES)
    parts = incremental.panel_of(incremental.stored(spark, path, "rows"), incremental.stored(spark, path, "sums"), series, A.TEST_EDGES)
    assert sorted(parts.columns) == sorted(whole.columns) and whole.count() > 50
    parts = parts.select(*[F.col(f"`{c}`") for c in whole.columns])
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))
    counts = {(r.cur, r.nxt): r.n for r in incremental.transition_counts(spark, path).collect()}
    kept = incremental.stored(spark, path, "rows")
    expected = {(r.Current_Status, r.Next_Status): r["count"] for r in panel.legal_transitions(kept).groupBy("Current_Status", "Next_Status").count().collect()}
    assert counts == expected
    with pytest.raises(PySparkException):
        incremental.add_quarter(spark, path, quarters[-1], rows.where(F.col("q") == quarters[-1]).drop("q"), quarters[-2])


def test_a_record_before_the_carried_one_is_an_error(spark, sf):
    rows = A.records(spark, sf).where("Loan_ID = 7 or Loan_ID = 22").cache()
    months = sorted(r[0] for r in rows.select("Act_Period").distinct().collect())
    late = incremental.extend(rows.where(F.col("Act_Period") > months[len(months) // 2]))
    with pytest.raises(PySparkException, match="before those carried"):
        incremental.extend(rows.where(F.col("Act_Period") <= months[len(months) // 2]), late.carry)


def test_bucketed_records_are_not_shuffled_by_loan(spark, sf, tmp_path):
    stored = tables.write_bucketed(A.records(spark, sf), "records_bucketed_test", 4, str(tmp_path / "b"))
    try:
        built = build.build_panel(stored, A.dimensions(spark, sf), A.TEST_EDGES, count_from=stored.select("Loan_ID"))
        plan = built._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and "hashpartitioning(Loan_ID" not in plan
        plain = A.built(spark, sf)
        assert "hashpartitioning(Loan_ID" in plain._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, built.select(*[f"`{c}`" for c in plain.columns]).collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.sql("drop table records_bucketed_test")


@pytest.mark.parametrize("partitions", [1, 9])
def test_samples_have_the_rounded_size(spark, partitions, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(int(i // 2), int(rng.integers(0, 4)), int(rng.integers(0, 3)), "x") for i in range(900)] + [(5, 0, 0, "same")] * 40 + [(1, None, 1, "n")] * 3
    df = spark.createDataFrame(rows, "Loan_ID int, Current_Status int, Next_Status int, draw string").repartition(partitions)
    shares = {0: 0.25, 1: 0.5, 2: 1.0}
    found = sampling.sample_exactly(df, shares, key=["Loan_ID"])
    assert found.columns == df.columns
    size = {(r.Current_Status, r.Next_Status): r["count"] for r in df.groupBy("Current_Status", "Next_Status").count().collect()}
    taken = {(r.Current_Status, r.Next_Status): r["count"] for r in found.groupBy("Current_Status", "Next_Status").count().collect()}
    assert taken == {k: round(shares[k[0]] * n) for k, n in size.items() if k[0] in shares}
    again = sampling.sample_exactly(df.repartition(5), shares, key=["Loan_ID"])
    assert sorted(map(str, again.collect())) == sorted(map(str, found.collect()))
    assert sampling.sample_exactly(df, {}, key=["Loan_ID"]).count() == 0


def test_sketches_add_up_and_hold_their_bound(spark):
    rng = np.random.default_rng(6)
    rows = [("ab"[i % 2], float(rng.random() ** 2), int(rng.random() < 0.3), i % 3) for i in range(1500)] + [("c", 1.0, 1, 0), ("c", None, 0, 0)]
    df = spark.createDataFrame(rows, "g string, p double, y int, part int")
    exact = {r.g: r.roc_auc for r in metrics.curve_areas(metrics.roc_points(df, ["g"]), ["g"]).collect()}
    parts = [metrics.score_sketch(df.where(F.col("part") == k), ["g"], 64) for k in range(3)]
    union = parts[0].union(parts[1]).union(parts[2]).groupBy("g", "bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    for sketch in (metrics.score_sketch(df, ["g"], 64), union):
        found = {r.g: r for r in metrics.sketch_areas(sketch, ["g"]).collect()}
        assert all(abs(found[g].roc_auc - exact[g]) <= found[g].error < 0.05 for g in "ab")
        assert found["c"].roc_auc is None and found["c"].positives == 1
    fine = metrics.sketch_areas(metrics.score_sketch(df, ["g"], 1 << 20), ["g"]).collect()
    assert all(abs(r.roc_auc - exact[r.g]) <= r.error + 1e-12 < 1e-4 for r in fine if r.g != "c")


def test_a_table_is_described_by_type(spark):
    df = spark.createDataFrame([(1, 2.5, "a", True), (3, None, "a", None)], "i int, x double, s string, b boolean")
    numbers, others = profile.described(df, accuracy=100)
    assert {r.column: (r.n, r.median) for r in numbers.collect()} == {"i": (2, 1.0), "x": (1, 2.5)}
    assert {(r.column, r.value, r.n) for r in others.collect()} == {("s", "a", 2), ("b", "true", 1)}
