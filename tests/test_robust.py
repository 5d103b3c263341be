"""Nulls, foreign columns, wrong input and clean-up."""

import pathlib
import re
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loanshift import session
from loanshift.functions import scalars
from loanshift.operators import lookups, matrix, metrics, models, panel, profile
from loanshift.operators.ordered import Scan, numbered, scan
from loanshift.sources import tables


def test_months_that_do_not_parse_are_an_error(spark):
    good = spark.createDataFrame([("12004",), (" 122004 ",), (None,), ("  ",)], "t string")
    found = [str(r[0]) for r in good.select(scalars.month_start(F.col("t"))).collect()]
    assert found == ["2004-01-01", "2004-12-01", "None", "None"]
    for text in ("01/2004", "2004-01", "132004"):
        with pytest.raises(PySparkException, match="MMYYYY"):
            spark.createDataFrame([(text,)], "t string").select(scalars.month_start(F.col("t"))).collect()


def test_lookups_keep_every_column_of_the_caller(spark):
    df = spark.createDataFrame([("NC", 1, 2)], "State string, _note int, _Judicial int")
    dim = spark.createDataFrame([("NC", 5)], "State string, Judicial int")
    out = lookups.add_judicial(df, dim)
    assert out.columns == ["State", "_note", "_Judicial", "Judicial"]
    assert tuple(out.first()) == ("NC", 1, 2, 5)
    assert lookups.add_judicial(out, dim).columns == out.columns


def test_a_state_without_a_row_is_an_error_or_stays(spark):
    long = spark.createDataFrame([(1, 0, 1, 0.5), (1, 0, 0, 0.5), (1, 2, 2, 0.0)], "Loan_ID int, cur int, nxt int, p double")
    powered = matrix.matrix_power(matrix.loan_matrices(long, missing="stay"), 3)
    sums = matrix.matrix_cells(powered).groupBy("cur").agg(F.sum("p").alias("s")).collect()
    assert all(r.s == pytest.approx(1) for r in sums) and len(sums) == 9
    with pytest.raises(PySparkException, match="no row for state"):
        matrix.loan_matrices(long, missing="error").collect()
    with pytest.raises(ValueError):
        models.portfolio_matrices(long, {0: None}, ["Loan_ID"])


@pytest.mark.parametrize("hot_rows", [1000, 7])
def test_last_place_of_a_flag_whatever_the_plan(spark, hot_rows):
    rows = [(k % 2, i, (i * i + k) % 5 == 0) for k in range(2) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, i int, flag boolean")
    out = scan(df, ["k"], [F.col("i").asc()], Scan(position="at", last_at={"before": "flag"}), hot_rows)
    for r in out.collect():
        before = [j for j in range(r.i + 1) if (j * j + r.k) % 5 == 0]
        assert r["at"] == r.i and r.before == (before[-1] if before else None)


def test_running_sums_of_doubles_are_refused(spark):
    df = spark.createDataFrame([(1, 1, 0.5)], "k int, i int, x double")
    with pytest.raises(TypeError, match="decimal"):
        scan(df, ["k"], [F.col("i").asc()], Scan(running_sum={"s": "x"}))


def windows(df):
    """Windows and sorts of the plan, each operator counted once."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"\bWindow \[", plan))


def test_one_window_over_the_panel(spark):
    rows = [(k, i, f"0{(k + i) % 3}", None, 100.0 * (i % 3), 1000.0, 6.0, 360.0) for k in range(5) for i in range(6)]
    schema = "Loan_ID int, Act_Period int, Current_Loan_Delinquency_Status string, Zero_Balance_Code double, Curr_UPB double, Orig_UPB double, Orig_Rate double, Orig_Term double"
    df = spark.createDataFrame(rows, schema)
    history = panel.add_history(panel.encode(df))
    counts = matrix.transition_counts(panel.legal_transitions(history))
    assert windows(history) == 1
    assert windows(matrix.transition_matrix(counts)) == 1
    # The second one is over nine rows.
    assert windows(matrix.state_distribution(matrix.transition_matrix(counts))) == 2
    assert panel.imputed_balance(df).columns == df.columns


def test_null_groups_stay_in_every_metric(spark):
    rows = [(g, t, i / 10, i % 2) for g in ("a", None) for t in (0, 1) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, target int, p double, y int")
    by = ["g", "target"]
    assert metrics.roc_points(df, by).where("g is null").count() == 20
    for strategy in ("quantile", "uniform", "approximate"):
        found = metrics.calibration(df, by, strategy=strategy)
        assert found.where("g is null").agg(F.sum("n")).first()[0] == 20, strategy
    with pytest.raises(ValueError):
        metrics.calibration(df, by, strategy="other")
    assert metrics.normalize_ovr(df.withColumnRenamed("p", "raw"), ["g", "target"]).where("g is null").count() == 20
    assert metrics.curve_areas(metrics.roc_points(df, by), by).where("g is null").count() == 2


def test_a_table_that_is_there_is_not_doubled(spark, tmp_path):
    df = spark.createDataFrame([(0, 1, 5)], "Current_Status int, Next_Status int, x int")
    tables.write_transitions(df, str(tmp_path / "t"))
    with pytest.raises(PySparkException):
        tables.write_transitions(df, str(tmp_path / "t"))
    tables.write_transitions(df, str(tmp_path / "t"), mode="overwrite")
    assert tables.read_transitions(spark, str(tmp_path / "t")).count() == 1


def test_stored_tables_go_with_their_scope(spark):
    folder = pathlib.Path(session.shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir()) if folder.exists() else set()
    with session.scratch(spark):
        one, two = session.materialize(spark.range(5)), session.materialize(spark.range(3))
        assert one.count() + two.count() == 8
        session.discard(one)
        assert len(set(folder.iterdir()) - before) == 1
    assert set(folder.iterdir()) == before
    with ThreadPool(6) as pool:
        assert sum(t.count() for t in pool.map(lambda n: session.materialize(spark.range(n)), range(1, 13))) == 78
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_histogram_of_columns_without_values(spark):
    df = spark.createDataFrame([(None, 3.0), (None, 3.0)], "a double, b double")
    found = profile.histogram(df, ["a", "b"], bins=4).orderBy("bin").collect()
    assert [(r["column"], r.lo, r.hi, r.n) for r in found] == [("b", 2.5, 3.5, 0), ("b", 2.5, 3.5, 0), ("b", 2.5, 3.5, 2), ("b", 2.5, 3.5, 0)]
    assert profile.histogram(df, ["a"], bins=4).count() == 0
    sketched = profile.box_stats(spark.range(1, 1002).withColumn("v", F.col("id") * 1.0), "v", accuracy=10_000).first()
    assert (sketched.n, sketched.median, sketched.outliers) == (1001, 501.0, 0)


@pytest.mark.parametrize("hot_rows", [10**6, 9])
def test_scans_leave_columns_of_any_name_alone(spark, hot_rows):
    rows = [(k % 2 if k % 9 else None, i, (i * 7 + k) % 11, (i + k) % 3 == 0, "s", 1.5, True, False, 3, "h") for k in range(3) for i in range(25)]
    schema = "k int, i int, v long, flag boolean, _seg string, _n double, _first boolean, _last boolean, _rows int, _hot_k string"
    df = spark.createDataFrame([(r[0], k, *r[2:]) for k, r in enumerate(rows)], schema)
    what = Scan(
        lead={"nxt": "v"}, lag={"prev": "v"}, running_max={"top": "v"}, running_sum={"sum": "v"}, fill={"held": "v"}, position="at", last_at={"mark": "flag"}
    )
    plain = df.select("k", "i", "v", "flag")
    found = scan(df, ["k"], [F.col("i").asc()], what, hot_rows)
    assert sorted(found.columns) == sorted([*df.columns, *what.outputs()])
    expected = scan(plain, ["k"], [F.col("i").asc()], what, 10**6)
    names = expected.columns
    assert sorted(map(str, found.select(*names).collect())) == sorted(map(str, expected.collect()))
    kept = [tuple(r) for r in found.select("_seg", "_n", "_first", "_last", "_rows", "_hot_k").distinct().collect()]
    assert kept == [("s", 1.5, True, False, 3, "h")]


def test_positions_in_the_whole_table(spark):
    df = spark.createDataFrame([(i * 37 % 101, "r") for i in range(101)], "v int, range string").repartition(7)
    found = numbered(df, [F.col("v").asc()], "at")
    assert found.columns == ["v", "range", "at"] and all(r["at"] == r.v for r in found.collect())
    assert numbered(df.limit(0), [F.col("v").asc()], "at").count() == 0
