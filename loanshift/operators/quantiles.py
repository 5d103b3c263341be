"""Exact quantiles without holding a group's values in one task.

Values are counted first, so only distinct values are ordered; a group with
very many of them is scanned in range-partitioned segments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanshift.functions.names import prefix
from loanshift.operators.ordered import HOT_ROWS, Scan, scan
from loanshift.session import materialize


def value_counts(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Rows (by..., value, n) of distinct non-null values, written out: quantiles
    count, order and total them, and the source may be costly."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*(by or []), F.col(value).cast("double").alias("value"))
    return materialize(counted.agg(F.count("*").alias("n")))


def quantiles_of(
    counts: DataFrame, probabilities: dict[str, float], by: list[str] | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per group with a column per named probability, linearly interpolated."""
    by = by or []
    own = prefix([*counts.columns, *probabilities])
    everything, upto, whole = f"{own}all", f"{own}upto", f"{own}total"
    key = [everything, *by]
    rows = counts.withColumn(everything, F.lit(0))
    ranked = scan(rows, key, [F.col("value").asc()], Scan(running_sum={upto: "n"}), hot_rows)
    # One row per group, stored so that Catalyst sees how small it is.
    totals = materialize(rows.groupBy(*[F.col(k).alias(f"{own}t_{k}") for k in key]).agg(F.sum("n").alias(whole)))
    match = F.lit(True)
    for k in key:
        match = match & F.col(k).eqNullSafe(F.col(f"{own}t_{k}"))
    placed = ranked.join(totals, match)

    def at(index: Column) -> Column:
        inside = (F.col(upto) - F.col("n") <= index) & (index < F.col(upto))
        return F.max(F.when(inside, F.col("value")))

    found, result = [F.max(whole).alias(whole)], {}
    for name, p in probabilities.items():
        rank = F.lit(float(p)) * (F.col(whole) - 1)
        found += [at(F.floor(rank)).alias(f"{own}lo_{name}"), at(F.ceil(rank)).alias(f"{own}hi_{name}")]
        lo, hi = F.col(f"{own}lo_{name}"), F.col(f"{own}hi_{name}")
        result[name] = lo + (hi - lo) * (rank - F.floor(rank))
    out = placed.groupBy(*key).agg(*found).withColumns(result)
    return materialize(out.select(*by, *probabilities))


def quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], by: list[str] | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    return quantiles_of(value_counts(df, value, by), probabilities, by, hot_rows)
