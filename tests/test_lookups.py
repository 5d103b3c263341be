"""Lookups: fallback, uniqueness, unchanged row counts, feature edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import adapter as A
from loanshift.operators import features, lookups, sampling


def one_loan(spark, zip_="z1", term=360.0, origin=dt.date(2004, 5, 1)):
    row = [("a", dt.date(2010, 2, 1), origin, zip_, "NC", "m1", 5.0, term, 100.0, 200.0, 80.0)]
    return spark.createDataFrame(
        row, "Loan_ID string, Act_Period date, Orig_Date date, ZIP string, State string, MSA string, Orig_Rate double, "
        "Orig_Term double, Curr_UPB double, Orig_UPB double, OLTV double",
    )


def indices(spark):
    zips = spark.createDataFrame([("z1", 2010, 1, 120.0), ("z1", 2004, 2, 100.0)], "Zip string, Year int, Quarter int, HPI double")
    regions = spark.createDataFrame([("NC", 2010, 1, 90.0), ("NC", 2004, 2, 60.0)], "State string, Year int, Quarter int, HPI double")
    return zips, regions


@pytest.mark.parametrize("zip_, current, origin", [("z1", 120.0, 100.0), ("z9", 90.0, 60.0), (None, 90.0, 60.0)])
def test_price_index_falls_back_to_state(spark, zip_, current, origin):
    row = lookups.add_price_index(one_loan(spark, zip_), *indices(spark), levels=True).first()
    assert (row.Curr_HPI, row.Orig_HPI) == (current, origin)
    assert row.Curr_HPI_Level == ("ZIP" if zip_ == "z1" else "State")
    assert row.MTMLTV == pytest.approx(100.0 / (200.0 / 80.0 * current / origin))


def test_price_index_absent(spark):
    zips, regions = indices(spark)
    row = lookups.add_price_index(one_loan(spark, "z9"), zips, regions.where("false")).first()
    assert row.Curr_HPI is None and row.MTMLTV is None


def test_duplicate_key_is_an_error(spark):
    zips, regions = indices(spark)
    with pytest.raises(Exception, match="duplicate lookup key"):
        lookups.add_price_index(one_loan(spark), zips.union(zips), regions).collect()


def test_duplicate_key_with_a_reducer(spark):
    zips, _ = indices(spark)
    assert lookups.unique_by(zips.union(zips), ["Zip", "Year", "Quarter"], F.max).count() == 2


@pytest.mark.parametrize("term, rate", [(360.0, 4.0), (180.0, 3.0), (240.0, 3.0)])
def test_benchmark_by_term(spark, term, rate):
    rates = spark.createDataFrame([(2010, 2, 4.0, 3.0), (2004, 5, 6.0, 5.5)], "Year int, Month int, `30_Year` double, `15_Year` double")
    row = lookups.add_rates(one_loan(spark, term=term), rates).first()
    assert row.Benchmark_Rate == rate
    assert row["Refinance Indicator"] == 500.0 / rate
    assert row.SATO == 5.0 - (6.0 if term == 360.0 else 5.5)


def test_unemployment_split_and_fallback(spark):
    combined = spark.createDataFrame(
        [("m1", None, 2010, 2, 9.0), ("37", "NC", 2010, 2, 8.0), ("37", "NC", 2004, 5, 5.0)],
        "FIPS string, StateAbb string, Year int, Month int, URate double",
    )
    row = lookups.add_unemployment(one_loan(spark), *lookups.split_unemployment(combined)).first()
    assert (row.Curr_URate, row.Orig_URate, row.URate_Change) == (9.0, 5.0, 4.0)


def test_lookups_keep_the_row_count(spark, sf):
    from loanshift.plans.build import enrich

    rows = A.cleaned(spark, sf)
    assert enrich(rows, A.dimensions(spark, sf)).count() == rows.count()


def test_small_dimensions_are_broadcast_without_a_hint(spark, sf):
    rows = A.built(spark, sf)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 5 and "SortMergeJoin" not in plan and "ResolvedHint" not in plan


@pytest.mark.parametrize("year, expected", [(2004, [0, 0, 0, 0]), (2005, [1, 0, 0, 0]), (2020, [0, 0, 0, 1]), (2021, [0, 0, 0, 0])])
def test_vintage_edges(spark, year, expected):
    df = one_loan(spark, origin=dt.date(year, 5, 1)).select("Orig_Date")
    assert list(features.vintage_bins(df).drop("Orig_Date").first()) == expected


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "x double")
    assert [r.x for r in features.standardize(df, ["x"]).collect()] == [0.0, 0.0, 0.0]
    assert [r.x for r in features.min_max(df, ["x"]).collect()] == [0.0, 0.0, 0.0]


def test_sample_does_not_depend_on_partitioning(spark, sf):
    rows = A.transitions(spark, sf)
    few = sampling.sample_by_state(rows, A.TEST_FRACTIONS)
    again = sampling.sample_by_state(rows.repartition(7), A.TEST_FRACTIONS)
    assert few.exceptAll(again).count() == 0 and again.exceptAll(few).count() == 0
    assert 0 < few.count() < rows.count()
    assert few.exceptAll(rows).count() == 0


def test_every_fold_is_in_the_training_part(spark, sf):
    train, test = sampling.train_test(sampling.with_fold(A.transitions(spark, sf)), 0.3)
    assert train.select("fold").distinct().count() == 5
    assert train.count() + test.count() == 911


def test_too_many_categories_is_an_error(spark, sf):
    with pytest.raises(ValueError, match="too many categories"):
        features.categories_of(A.table(spark, sf, "orders"), ["o_orderkey"], limit=100)


def test_sampled_build_equals_sampling_the_panel(spark, sf):
    from loanshift.operators import panel
    from loanshift.plans.build import transition_table

    whole = sampling.sample_by_state(panel.legal_transitions(A.built(spark, sf)), A.TEST_FRACTIONS)
    direct = transition_table(A.records(spark, sf), A.dimensions(spark, sf), A.TEST_FRACTIONS, A.TEST_EDGES, hot_rows=40)
    assert sorted(direct.columns) == sorted(whole.columns)
    direct = direct.select(*whole.columns)
    assert direct.count() == whole.count() > 0
    assert direct.exceptAll(whole).count() == 0


def test_five_joins_serve_all_series(spark, sf):
    from loanshift.plans.build import enrich

    rows = A.cleaned(spark, sf)
    series = A.dimensions(spark, sf)
    before, after = (df._jdf.queryExecution().optimizedPlan().toString().count("Join ") for df in (rows, enrich(rows, series)))
    assert after - before == 5


def test_lookups_without_broadcast_are_salted_and_equal(spark, sf):
    from loanshift.plans.build import enrich

    rows = A.cleaned(spark, sf)
    rows = rows.withColumn("ZIP", F.when(F.col("Loan_ID") % 3 == 0, F.lit(7)).otherwise(F.col("ZIP")))  # a hot place
    series = A.dimensions(spark, sf)
    small = sorted(map(str, enrich(rows, series).collect()))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spread = enrich(rows, series)
        assert "SortMergeJoin" in spread._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, spread.collect())) == small
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        hot = lookups.add_price_index(rows.where("ZIP = 7"), series.zip_index, series.state_index)
        zipped = hot.groupBy(F.spark_partition_id()).count().collect()
        sizes = sorted(r["count"] for r in zipped)
        assert len(sizes) > 4 and sizes[-1] <= 0.5 * sum(sizes)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_gap_in_a_series_is_null(spark):
    zips = spark.createDataFrame([("z1", 2010, 1, 120.0), ("z1", 2004, 2, 100.0), ("z1", 2007, 3, None), (None, 2010, 1, 5.0), ("z2", None, 1, 5.0)], "Zip string, Year int, Quarter int, HPI double")
    nothing = zips.where("false").withColumnRenamed("Zip", "State")
    found = {}
    for day in (dt.date(2010, 2, 1), dt.date(2009, 2, 1), dt.date(2007, 8, 1), dt.date(2011, 2, 1), dt.date(2001, 1, 1)):
        row = lookups.add_price_index(one_loan(spark).withColumn("Act_Period", F.lit(day)), zips, nothing).first()
        found[day.year] = row.Curr_HPI
    assert found == {2010: 120.0, 2009: None, 2007: None, 2011: None, 2001: None}
