"""Metrics against hand-computed values and plain numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import adapter as A
from loanshift.operators import metrics, ordered, profile
from loanshift.operators.quantiles import quantiles


def scored(spark, rows):
    return spark.createDataFrame([("c", *r) for r in rows], "target string, y int, p double")


def test_ties_give_half(spark):
    points = metrics.roc_points(scored(spark, [(0, 0.5), (1, 0.5)]), ["target"])
    assert metrics.curve_areas(points, ["target"]).first().roc_auc == 0.5


def test_class_without_negatives_has_no_area(spark):
    points = metrics.roc_points(scored(spark, [(1, 0.5), (1, 0.4)]), ["target"])
    assert metrics.curve_areas(points, ["target"]).first().roc_auc is None


def test_area_against_pairs(spark):
    rng = np.random.default_rng(1)
    rows = [(int(rng.random() < 0.3), round(float(rng.random()), 1)) for _ in range(300)]
    areas = metrics.curve_areas(metrics.roc_points(scored(spark, rows), ["target"], hot_rows=4), ["target"]).first()
    pos, neg = ([p for y, p in rows if y == k] for k in (1, 0))
    brute = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert areas.roc_auc == pytest.approx(brute)


def test_brier_and_log_loss(spark):
    row = metrics.threshold_metrics(scored(spark, [(1, 0.9), (0, 0.2), (1, 0.4)]), ["target"]).first()
    assert row.brier == pytest.approx((0.01 + 0.04 + 0.36) / 3)
    assert row.log_loss == pytest.approx(-(math.log(0.9) + math.log(0.8) + math.log(0.4)) / 3)
    assert (row.precision, row.recall) == (1.0, 0.5)


@pytest.mark.parametrize("hot_rows", [2, 10**6])
def test_quantiles_against_numpy(spark, hot_rows):
    rng = np.random.default_rng(2)
    groups = {g: rng.integers(0, 40, n).astype(float) for g, n in (("a", 101), ("b", 1), ("c", 60))}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, v double")
    wanted = {"lo": 0.1, "mid": 0.5, "hi": 0.93}
    for row in quantiles(df, "v", wanted, ["g"], hot_rows).collect():
        for name, p in wanted.items():
            assert row[name] == pytest.approx(np.quantile(groups[row.g], p))


def test_histogram_against_numpy(spark):
    values = [0.0, 1.0, 2.5, 9.99, 10.0, 10.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    found = [r.n for r in profile.histogram(df, ["x"], bins=4).orderBy("bin").collect()]
    assert found == np.histogram(values, bins=4)[0].tolist()
    ranged = [r.n for r in profile.histogram(df, ["x"], bins=2, value_range=(1, 9)).orderBy("bin").collect()]
    assert ranged == np.histogram(values, bins=2, range=(1, 9))[0].tolist()
    constant = profile.histogram(df.limit(1), ["x"], bins=2).orderBy("bin").collect()
    assert [r.n for r in constant] == np.histogram([0.0], bins=2)[0].tolist()


def test_box_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100]], "x double")
    row = profile.box_stats(df, "x").first()
    assert (row.whisker_low, row.whisker_high, row.outliers, row.n) == (1.0, 5.0, 1, 6)


def test_calibration_bins_are_closed_on_the_right(spark):
    rows = [(0, 0.2), (1, 0.2000001), (1, 1.0), (0, 0.0)]
    found = metrics.calibration(scored(spark, rows), ["target"], strategy="uniform").orderBy("bin").collect()
    assert [(r.bin, r.n) for r in found] == [(0, 2), (1, 1), (4, 1)]


def test_report(spark):
    cells = spark.createDataFrame([(0, 0, 5), (0, 1, 1), (1, 1, 2), (1, 0, 2)], "truth int, prediction int, n bigint")
    report = {r.label: r for r in metrics.class_report(cells).collect()}
    assert report["0"].precision == pytest.approx(5 / 7) and report["0"].recall == pytest.approx(5 / 6)
    assert report["accuracy"].f1 == pytest.approx(0.7)
    assert report["macro avg"].recall == pytest.approx((5 / 6 + 0.5) / 2)
    assert report["weighted avg"].recall == pytest.approx(0.7)
    assert report["weighted avg"].support == 10


def test_ties_go_to_the_smaller_label(spark):
    df = spark.createDataFrame([(1, 3, 0.5), (1, -1, 0.5), (1, 0, 0.1)], "k int, target int, p double")
    assert metrics.hard_prediction(df, ["k"]).first().prediction == -1


def test_probabilities_sum_to_one(spark, sf):
    sums = A.scored(spark, sf).groupBy("Loan_ID", "Seq").agg(F.sum("p").alias("s"))
    assert sums.where(F.abs(F.col("s") - 1) > 1e-12).count() == 0


def test_a_low_limit_does_not_make_ever_more_segments(spark, monkeypatch):
    rows = spark.range(4000).select((F.col("id") % 2).alias("k"), F.hash("id").alias("at"), F.lit(1).alias("n"))
    what = ordered.Scan(running_sum={"upto": "n"}, position="place", lag={"before": "at"})
    wide, plain = ordered.scan(rows, ["k"], [F.col("at"), F.col("n")], what, hot_rows=100), ordered.scan(rows, ["k"], [F.col("at"), F.col("n")], what)
    monkeypatch.setattr(ordered, "MOST_SEGMENTS", 3)
    monkeypatch.setattr(ordered, "HOT_ROWS", 500)
    assert [ordered._segments(4000, n) for n in (100, 1000, 4000)] == [9, 5, 2] and ordered._segments(1000, 100) == 3
    few = ordered.scan(rows, ["k"], [F.col("at"), F.col("n")], what, hot_rows=100)
    assert sorted(map(str, few.collect())) == sorted(map(str, plain.collect())) == sorted(map(str, wide.collect()))
