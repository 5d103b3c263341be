"""Hand-written edge rows of cleaning, status and windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import adapter as A
from loanshift.functions import scalars, states
from loanshift.operators import clean, matrix, panel
from loanshift.operators.ordered import Scan, scan


def loans(spark, histories, **extra):
    """One row per month from {loan: [(status, zero balance), ...]}."""
    rows = []
    for loan, months in histories.items():
        for i, item in enumerate(months):
            status, zero = item if isinstance(item, tuple) else (item, None)
            rows.append((loan, dt.date(2010 + i // 12, i % 12 + 1, 1), status, zero, 1000.0))
    schema = "Loan_ID string, Act_Period date, Current_Loan_Delinquency_Status string, Zero_Balance_Code double, Curr_UPB double"
    return spark.createDataFrame(rows, schema)


def observed(df):
    return panel.keep_observed(panel.add_history(panel.encode(df)))


def pairs(df):
    return sorted((r.Loan_ID, r.Current_Status, r.Next_Status) for r in df.collect())


def test_null_product_and_flag_are_kept(spark):
    df = spark.createDataFrame([("ARM", "N"), (None, None), ("FRM", "Y"), ("FRM", "N")], "Product string, Mod_Flag string")
    kept = df.transform(clean.exclude_adjustable).transform(clean.exclude_modified).collect()
    assert sorted(map(tuple, kept), key=str) == [("FRM", "N"), (None, None)]


def test_recode_flag(spark):
    df = spark.createDataFrame([("7",), (None,), ("F",)], "HomeReady_Program_Indicator string")
    assert [r[0] for r in clean.recode_program_flag(df).collect()] == ["N", "Y", "Y"]


@pytest.mark.parametrize("default, expected", [(False, [-1, 999, 0]), (True, [-1, 7, 0])])
def test_status_encoding(spark, default, expected):
    df = loans(spark, {"a": [("XX", 1.0), ("XX", 3.0), ("00", None)]})
    out = panel.encode(df, credit_event_as_default=default).orderBy("Act_Period")
    assert [r.Current_Status for r in out.collect()] == expected


def test_bad_status_text_becomes_null(spark):
    out = panel.encode(loans(spark, {"a": ["00", "R", None]})).orderBy("Act_Period")
    assert [r.Current_Status for r in out.collect()] == [0, None, None]


def test_prepaid_loan(spark):
    df = loans(spark, {"a": ["00", "00", "01", ("00", 1.0)]})
    assert pairs(observed(df)) == [("a", 0, 1), ("a", 1, -1)]


def test_rows_from_default_on_are_dropped(spark):
    assert pairs(observed(loans(spark, {"a": ["00", "06", "07", "00"]}))) == [("a", 6, 7)]


def test_unknown_ahead(spark):
    assert pairs(panel.legal_transitions(observed(loans(spark, {"a": ["00", "00", "XX"]})))) == []


def test_running_max_is_null_where_status_is(spark):
    out = panel.add_history(panel.encode(loans(spark, {"a": ["00", "08", "?", "02"]}))).orderBy("Act_Period")
    assert [r.Cum_Max_Status for r in out.collect()] == [0, 8, None, 8]


def test_modified_month_is_skipped(spark):
    df = loans(spark, {"a": ["00", "00", "01", "00"]})
    df = df.withColumn("Mod_Flag", F.when(F.month("Act_Period") == 2, "Y").otherwise("N"))
    assert pairs(panel.legal_transitions(observed(clean.exclude_modified(df)))) == [("a", 1, 0)]


def test_illegal_jump_is_counted(spark):
    seen = observed(loans(spark, {"a": ["00", "00", "02", "02"]}))
    assert pairs(panel.legal_transitions(seen)) == [("a", 2, 2)]
    assert [tuple(r) for r in panel.dropped_jumps(seen).collect()] == [(0, 2, 1)]


def test_there_are_48_legal_pairs():
    assert len(matrix.legal_cells()) == 48
    assert states.targets_of(6) == states.STATES and states.targets_of(0) == [-1, 0, 1, 7]


def test_expected_panel_counts(spark, sf):
    assert A.records(spark, sf).count() == 1500
    assert A.observed(spark, sf).count() == 1202
    moves = A.transitions(spark, sf)
    assert moves.count() == 911
    assert matrix.transition_counts(moves).count() == 39


@pytest.mark.parametrize("hot_rows", [3, 20, 150])
def test_segments_equal_plain_windows(spark, sf, hot_rows):
    """A third of all rows under one key (null, at that), the rest spread."""
    rows = A.table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    key = F.when(F.col("event_id") % 3 == 0, None).otherwise(F.col("user_id"))
    rows = rows.withColumn("k", key).withColumn("some", F.when(F.col("event_id") % 5 == 0, F.col("value")))
    if hot_rows == 3:
        rows = rows.where("event_id < 150")
    what = Scan(
        lead={"a": "value"}, lag={"b": "some"}, running_max={"c": "some"}, running_sum={"d": "event_id"},
        fill={"e": "some"}, position="f",
    )
    order = [F.col("ts").desc(), F.col("event_id").asc()]
    split = scan(rows, ["k"], order, what, hot_rows=hot_rows)
    plain = scan(rows, ["k"], order, what, hot_rows=10**9)
    assert split.columns == plain.columns
    assert split.count() == rows.count()
    assert split.exceptAll(plain).count() == 0


def test_forward_fill(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5), (1, 3, None), (1, 4, 4)], "k int, t int, v int")
    out = scan(df, ["k"], [F.col("t").asc()], Scan(fill={"f": "v"})).orderBy("t")
    assert [r.f for r in out.collect()] == [None, 5, 5, 4]


def test_zero_balance_runs(spark):
    rows = [
        ("a", 1, 0.0, 300000.0, 6.0, 360.0), ("a", 2, 0.0, 300000.0, 6.0, 360.0), ("a", 3, 250.0, 300000.0, 6.0, 360.0),
        ("a", 4, 0.0, 300000.0, 6.0, 360.0), ("b", 1, 0.0, 120000.0, 0.0, 120.0), ("c", 1, None, 1.0, 5.0, 360.0),
    ]
    df = spark.createDataFrame(
        rows, "Loan_ID string, Act_Period int, Curr_UPB double, Orig_UPB double, Orig_Rate double, Orig_Term double"
    )
    out = panel.imputed_balance(df).orderBy("Loan_ID", "Act_Period").collect()
    found = [None if r.Curr_UPB is None else round(r.Curr_UPB, 2) for r in out]
    assert found == [299701.35, 299401.20, 250.0, 299701.35, 119000.0, None]


def test_dates(spark):
    df = spark.createDataFrame([("012004", "2003Q4"), ("72004", "bad"), (None, None)], "m string, q string")
    out = df.select(scalars.month_start(F.col("m")), scalars.quarter_start(F.col("q"))).collect()
    assert [tuple(r) for r in out] == [(dt.date(2004, 1, 1), dt.date(2003, 10, 1)), (dt.date(2004, 7, 1), None), (None, None)]


def test_mean_imputation(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (2, 4.0), (2, None), (2, 7.0)], "g int, DTI double")
    overall = clean.impute_mean(df, ["DTI"]).collect()
    assert sorted(r.DTI for r in overall) == [1.0, 4.0, 4.0, 4.0, 7.0]
    grouped = clean.impute_mean(df, ["DTI"], by=["g"]).collect()
    assert sorted(r.DTI for r in grouped) == [1.0, 1.0, 4.0, 5.5, 7.0]
