"""The panel built part by part: a new quarter continues what is stored, and older quarters are not read.

What a loan's later rows need of its earlier ones is its last record, the worst
status so far, the number of that record and the last remaining term. That is one
row per loan, the carry. New records are scanned together with it: the carried
record learns its next status and joins the panel, and the loan's newest record
is carried on. Means for imputation are kept as sums, so they are those of all
records read so far whenever the panel is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanshift.functions.names import unused
from loanshift.operators import clean, features, panel
from loanshift.operators.ordered import HOT_ROWS, Scan, scan
from loanshift.plans.build import Series, enrich
from loanshift.session import materialize

WORST, COUNT, TERM = "Worst_Before", "Count_Before", "Term_Before"


@dataclass(frozen=True)
class Extension:
    """``rows`` whose next record is known now, the ``carry`` of every loan, ``sums`` of the columns to impute,
    and ``counts`` of the legal transitions among ``rows``."""

    rows: DataFrame
    carry: DataFrame
    sums: DataFrame
    counts: DataFrame


def extend(
    records: DataFrame, carry: DataFrame | None = None, credit_event_as_default: bool = False, hot_rows: int = HOT_ROWS
) -> Extension:
    """Windows of new ``records`` (dates parsed) that go on from ``carry``.

    Records must be later than those carried; an earlier one is an error, as its
    loan's windows are written already.
    """
    kept = clean.recode_program_flag(records).transform(clean.exclude_adjustable).transform(clean.exclude_modified)
    kept = kept.drop(*clean.FILTER_ONLY).transform(clean.fill_constants)
    found = [c for c in clean.MEAN_FILLS if c in kept.columns]
    sums = kept.agg(*[f(c).alias(f"{c}_{n}") for c in found for n, f in (("sum", F.sum), ("n", F.count))])
    new = panel.encode(kept, credit_event_as_default)
    nothing = {WORST: F.lit(None).cast("int"), COUNT: F.lit(None).cast("bigint"), TERM: F.lit(None).cast("double")}
    rows = new.withColumns(nothing)
    rows = rows if carry is None else carry.unionByName(rows)

    worst, before, term, latest, at, more, first, status = unused(rows.columns, "worst", "before", "term", "latest", "at", "more", "first", "status")
    flagged = rows.withColumns({
        status: F.coalesce(F.col(WORST), F.col("Current_Status")), latest: F.lit(1),
        first: F.coalesce(F.col(TERM), F.col("Rem_Months").cast("double") if "Rem_Months" in rows.columns else F.lit(None).cast("double")),
    })
    what = Scan(
        lead={"Next_Status": "Current_Status", more: latest}, running_max={worst: status},
        fill={before: COUNT, term: first}, position=at,
    )
    done = scan(flagged, [panel.KEY], panel.panel_order(rows), what, hot_rows)
    # A carried record comes first in its loan; elsewhere a record came too late.
    early = F.col(COUNT).isNotNull() & (F.col(at) > 0)
    wrong = F.raise_error(F.concat(F.lit("a record before those carried, of loan "), F.col(panel.KEY).cast("string"))).cast("bigint")
    number = F.when(early, wrong).otherwise(F.coalesce(F.col(before), F.lit(0)) + F.col(at))
    done = done.withColumns({"Cum_Count": number, COUNT: number, WORST: F.col(worst), TERM: F.col(term)})
    # The running worst status is null where the status is, but is carried all the same.
    done = done.withColumn("Cum_Max_Status", F.when(F.col("Current_Status").isNotNull(), F.col(worst)))
    if "Rem_Months" in rows.columns:
        done = done.withColumn("Rem_Months", F.col(term).cast(rows.schema["Rem_Months"].dataType))
    done = materialize(done)
    out = done.where(F.col(more).isNotNull()).select(*new.columns, "Next_Status", "Cum_Max_Status", "Cum_Count")
    observed = materialize(panel.keep_observed(out))
    counts = panel.legal_transitions(observed).groupBy("Current_Status", "Next_Status").agg(F.count("*").alias("n"))
    return Extension(observed, done.where(F.col(more).isNull()).select(*new.columns, *nothing), sums, counts)


def panel_of(rows: DataFrame, sums: DataFrame, series: Series, vintage_edges: list[int] | None = None) -> DataFrame:
    """The panel from the rows of all extensions and all their sums: as ``build_panel`` over all records."""
    columns = [c.removesuffix("_sum") for c in sums.columns if c.endswith("_sum")]
    means = sums.agg(F.struct(*[(F.sum(f"{c}_sum") / F.sum(f"{c}_n")).alias(c) for c in columns])).scalar()
    [held] = unused(rows.columns, "means")
    out = rows.withColumn(held, means)
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"{held}.{c}")) for c in columns}).drop(held)
    out = out.drop("Cum_Max_Status", "Cum_Count", "Zero_Balance_Code")
    out = features.month_indicators(features.vintage_bins(clean.require(enrich(out, series)), edges=vintage_edges))
    return out.drop(*features.NOT_IN_PANEL)


def add_quarter(spark: SparkSession, path: str, quarter: str, records: DataFrame, after: str | None = None, **settings) -> None:
    """Writes ``path/{rows,carry,sums,counts}/quarter=...`` from the records of ``quarter`` and the carry of ``after``.

    A quarter that is there already is an error; running it again after a lost
    job means deleting what it wrote.
    """
    carry = spark.read.parquet(f"{path}/carry/quarter={after}") if after else None
    found = extend(records, carry, **settings)
    for name in ("rows", "sums", "counts", "carry"):
        getattr(found, name).write.parquet(f"{path}/{name}/quarter={quarter}")


def stored(spark: SparkSession, path: str, name: str) -> DataFrame:
    """``rows``, ``sums`` or ``counts`` of all quarters."""
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/{name}")


def transition_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(cur, nxt, n)`` over all quarters, from their counts alone."""
    found = stored(spark, path, "counts").groupBy(F.col("Current_Status").alias("cur"), F.col("Next_Status").alias("nxt"))
    return found.agg(F.sum("n").cast("bigint").alias("n"))
