"""Economic series and the columns they add."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import adapter as A
from checks.registry import query
from loanshift.operators import lookups, panel
from loanshift.plans import build, incremental
from loanshift.session import shared_folder
from loanshift.sources import tables

WHO = ["Loan_ID", "Seq"]


def _rows(spark, sf):
    history = panel.add_history(panel.encode(A.cleaned(spark, sf)), count_from=A.loan_rows(spark, sf))
    return panel.keep_observed(history)


@query("""
  select cast(Year as integer) as year, cast(Month as integer) as month, r30 as rate30, r15 as rate15 from monthly""")
def month_end_rate(spark, sf):
    rates = lookups.last_of_month(A.daily_rates(spark, sf))
    return rates.select(
        F.col("Year").alias("year"), F.col("Month").alias("month"),
        F.col("30_Year").alias("rate30"), F.col("15_Year").alias("rate15"),
    )


@query("""
  select Loan_ID, Seq, Curr_HPI, Orig_HPI, HPI_Adjust_Factor, MTMLTV, Curr_HPI_Level from with_hpi""")
def hpi_enrich(spark, sf):
    rows = lookups.add_price_index(
        _rows(spark, sf), A.price_index(spark, sf, "zip"), A.price_index(spark, sf, "state"), levels=True
    )
    return rows.select(*WHO, "Curr_HPI", "Orig_HPI", "HPI_Adjust_Factor", "MTMLTV", "Curr_HPI_Level")


@query("""select Loan_ID, Seq, Benchmark_Rate, "Refinance Indicator" as refinance, SATO from with_rates""")
def rate_enrich(spark, sf):
    rows = lookups.add_rates(_rows(spark, sf), A.monthly_rates(spark, sf))
    return rows.select(*WHO, "Benchmark_Rate", F.col("Refinance Indicator").alias("refinance"), "SATO")


@query("select Loan_ID, Seq, Curr_URate, Orig_URate, URate_Change from with_urate")
def urate_enrich(spark, sf):
    rows = lookups.add_unemployment(
        _rows(spark, sf), A.unemployment(spark, sf, "metro"), A.unemployment(spark, sf, "state")
    )
    return rows.select(*WHO, "Curr_URate", "Orig_URate", "URate_Change")


@query("select Loan_ID, Seq, Judicial from enriched")
def judicial_enrich(spark, sf):
    return lookups.add_judicial(_rows(spark, sf), A.judicial(spark, sf)).select(*WHO, "Judicial")


@query("""select Loan_ID, Seq, "10-2Spread" as spread from enriched""")
def macro_enrich(spark, sf):
    rows = lookups.add_spread(_rows(spark, sf), A.spread(spark, sf))
    return rows.select(*WHO, F.col("10-2Spread").alias("spread"))


_PANEL = """
  Loan_ID, Seq, cast(Act_Period as varchar) as period, Orig_Rate, Orig_UPB, Curr_UPB, Orig_Term, OLTV, DTI, Cscore_B,
  Channel, ZIP, MSA, Mi_Pct, Mi_Type, Interest_Only_Loan_Indicator, HomeReady_Program_Indicator, Current_Status,
  Next_Status, Age_Prop, Curr_HPI, HPI_Adjust_Factor, MTMLTV, Benchmark_Rate, "Refinance Indicator" as refinance, SATO,
  Curr_URate, URate_Change, Judicial, "10-2Spread" as spread, Vintage_1996_1996, Vintage_1997_1997, Vintage_1998_2020,
  Month_2, Month_3, Month_4, Month_5, Month_6, Month_7, Month_8, Month_9, Month_10, Month_11, Month_12"""


def _panel_columns(rows):
    names = [c.strip() for c in _PANEL.replace('"', "`").replace("varchar", "string").split(",")]
    return rows.selectExpr(*names)


@query(f"select {_PANEL} from panel")
def panel_full(spark, sf):
    return _panel_columns(A.built(spark, sf))


def _by_year(spark, sf):
    """The records added year by year, each going on from the carry of the one before."""
    path = f"{shared_folder(spark)}/years-{uuid.uuid4().hex}"
    rows = A.records(spark, sf).withColumn("year", F.year("Act_Period"))
    years = sorted(r["year"] for r in rows.select("year").distinct().collect())
    for before, year in zip([None, *years], years):
        incremental.add_quarter(spark, path, str(year), rows.where(F.col("year") == year).drop("year"), before and str(before))
    return path


@query(f"select {_PANEL} from panel")
def panel_incremental(spark, sf):
    """The same panel built year by year: older years are not read again."""
    path = _by_year(spark, sf)
    rows, sums = (incremental.stored(spark, path, n) for n in ("rows", "sums"))
    return _panel_columns(incremental.panel_of(rows, sums, A.dimensions(spark, sf), A.TEST_EDGES))


@query("""
  select Current_Status as cur, Next_Status as nxt, count(*) as n from clean_observed
  where Current_Status between 0 and 6 and (Next_Status = 7 or (Next_Status between -1 and 7 and Next_Status <= Current_Status + 1)) group by 1, 2""")
def counts_incremental(spark, sf):
    """Transition counts of all records from the counts of the years."""
    return incremental.transition_counts(spark, _by_year(spark, sf))


@query(f"select {_PANEL} from panel")
def panel_bucketed(spark, sf):
    """The same panel from records stored bucketed by loan."""
    name = f"records_{uuid.uuid4().hex}"
    stored = tables.write_bucketed(A.records(spark, sf), name, 8, f"{shared_folder(spark)}/{name}")
    found = build.build_panel(stored, A.dimensions(spark, sf), A.TEST_EDGES, count_from=stored.select("Loan_ID"))
    return _panel_columns(found)


@query(f"""
  select {_PANEL} from panel
  where Current_Status between 0 and 6 and (Next_Status = 7 or (Next_Status <= Current_Status + 1 and Next_Status >= -1))
    and ('0x' || substr(md5(concat_ws('|', Loan_ID, cast(Act_Period as varchar), Seq, '601')), 1, 8))::bigint
        < 0.2e0 * 4294967296""")
def transition_table(spark, sf):
    """The whole build down to the sampled legal transitions."""
    rows = build.transition_table(
        A.records(spark, sf), A.dimensions(spark, sf), A.TEST_FRACTIONS, A.TEST_EDGES, count_from=A.loan_rows(spark, sf)
    )
    return _panel_columns(rows)
