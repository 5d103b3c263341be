"""Distribution summaries: the numbers behind histograms, box plots and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanshift.functions.names import unused
from loanshift.functions.states import DEFAULT
from loanshift.operators.ordered import HOT_ROWS
from loanshift.operators.quantiles import quantiles, quantiles_of, value_counts
from loanshift.session import materialize

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def melt(df: DataFrame, columns: list[str], cast: str, keep: list[str] | None = None) -> DataFrame:
    """Rows (keep..., column, value), nulls left out."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast(cast).alias("value")) for c in columns]
    [cell] = unused(keep or [], "cell")
    long = df.select(*(keep or []), F.explode(F.array(*cells)).alias(cell))
    return long.select(*(keep or []), f"{cell}.*").where(F.col("value").isNotNull())


def frequencies(df: DataFrame, columns: list[str]) -> DataFrame:
    return melt(df, columns, "string").groupBy("column", "value").agg(F.count("*").alias("n"))


def histogram(
    df: DataFrame, columns: list[str], bins: int = 25, value_range: tuple[float, float] | None = None
) -> DataFrame:
    """Counts in equal-width bins, the last one closed; values outside a given
    range are ignored. Empty bins are listed with 0.

    Edges are one wide aggregate, two numbers per column, and then literals, so
    rows are binned in one pass and only bins are shuffled. A column without
    values has no edges and no rows.
    """
    if value_range:
        edges = {c: tuple(map(float, value_range)) for c in columns}
    else:
        numbers = [F.col(f"`{c}`").cast("double") for c in columns]
        found = df.agg(*[f(x) for x in numbers for f in (F.min, F.max)]).first()
        ends = {c: (found[2 * k], found[2 * k + 1]) for k, c in enumerate(columns)}
        edges = {c: (lo, hi) if lo < hi else (lo - 0.5, hi + 0.5) for c, (lo, hi) in ends.items() if lo is not None}
    if not edges:
        return df.sparkSession.createDataFrame([], "column string, bin int, lo double, hi double, n bigint")

    def cell(name: str) -> Column:
        lo, hi = edges[name]
        value = F.col(f"`{name}`").cast("double")
        step = F.least(F.floor((value - lo) * bins / F.lit(hi - lo)), F.lit(bins - 1)).cast("int")
        return F.struct(F.lit(name).alias("column"), F.when(value.between(lo, hi), step).alias("bin"))

    binned = df.select(F.explode(F.array(*[cell(c) for c in edges])).alias("_c")).select("_c.*").where("bin is not null")
    counts = binned.groupBy("column", "bin").agg(F.count("*").alias("n"))
    every = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for c, (lo, hi) in edges.items()])
    grid = df.sparkSession.range(1).select(F.inline(every)).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counts, ["column", "bin"], "left").select(
        "column", "bin", "lo", "hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def box_stats(
    df: DataFrame, column: str, group: Column | None = None, hot_rows: int = HOT_ROWS, accuracy: int | None = None
) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR) and outlier count, per group.

    Exact quartiles shuffle a count per distinct value. With ``accuracy`` they
    come from a bounded sketch, within 1 / accuracy of the rank, and no more
    than groups are shuffled.
    """
    grouping = F.lit("all") if group is None else group
    rows = df.select(grouping.alias("group"), F.col(column).alias("value")).where(F.col("group").isNotNull())
    if accuracy is None:
        counts = value_counts(rows, "value", ["group"])
        quartiles = quantiles_of(counts, QUARTILES, ["group"], hot_rows)
    else:
        counts = rows.where(F.col("value").isNotNull()).select("group", F.col("value").cast("double"), F.lit(1).cast("bigint").alias("n"))
        found = counts.groupBy("group").agg(F.percentile_approx("value", list(QUARTILES.values()), accuracy).alias("_q"))
        quartiles = materialize(found.select("group", *[F.col("_q")[k].alias(name) for k, name in enumerate(QUARTILES)]))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        counts.join(quartiles, "group")
        .groupBy("group", *QUARTILES)
        .agg(
            F.sum("n").alias("n"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        )
    )


def next_status_group(following: Column) -> Column:
    """Prepaid, current, delinquent, default."""
    return (
        F.when(following == -1, "prepaid")
        .when(following == 0, "current")
        .when((following > 0) & (following < DEFAULT), "delinquent")
        .when(following == DEFAULT, "default")
    )


def summary(df: DataFrame, columns: list[str], hot_rows: int = HOT_ROWS, accuracy: int | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles, maximum, one row per column.

    Exact quartiles shuffle a count per distinct value. With ``accuracy`` they
    come from a bounded sketch, values whose rank is within 1 / accuracy, in the
    same pass as the moments.
    """
    long = melt(df, columns, "double")
    sketched = [] if accuracy is None else [F.percentile_approx("value", list(QUARTILES.values()), accuracy).alias("quartiles")]
    moments = long.groupBy("column").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        *sketched,
    )
    if accuracy is not None:
        found = {name: F.col("quartiles")[k] for k, name in enumerate(QUARTILES)}
        return moments.withColumns(found).drop("quartiles")
    return moments.join(quantiles(long, "value", QUARTILES, ["column"], hot_rows), "column")


def described(df: DataFrame, accuracy: int | None = None) -> tuple[DataFrame, DataFrame]:
    """All columns by type: ``summary`` of the numeric ones, ``frequencies`` of the others."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    plain = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BooleanType, T.DateType))]
    return summary(df, numeric, accuracy=accuracy), frequencies(df, plain)


def listing(df: DataFrame) -> DataFrame:
    """Column names and types of a table."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, Column_Name string, dtype string")


def split_counts(df: DataFrame, state: str = "Current_Status", split: str = "split") -> DataFrame:
    return df.groupBy(state, split).agg(F.count("*").alias("n"))
