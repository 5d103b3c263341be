"""Feature engineering: bins, indicator columns, scaling, weights, roles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanshift.functions.names import unused

# The model's feature roles and the columns dropped before it.
NUMERIC = [
    "Orig_Rate", "Orig_UPB", "Curr_UPB", "Orig_Term", "OLTV", "DTI", "Cscore_B", "Curr_HPI", "HPI_Adjust_Factor",
    "MTMLTV", "Benchmark_Rate", "Age_Prop", "Refinance Indicator", "SATO", "URate_Change", "10-2Spread", "Mi_Pct",
]
CATEGORICAL = [
    "Channel", "Purpose", "Prop", "Occ_Stat", "First_Flag", "Num_Bo", "Interest_Only_Loan_Indicator", "Mi_Type",
    "HomeReady_Program_Indicator", "Relocation_Mortgage_Indicator", "Judicial",
]
NOT_FEATURES = [
    "Time_Stamp", "Loan_ID", "Act_Period", "Next_Status", "Current_Status", "Curr_HPI", "Benchmark_Rate",
    "Curr_URate", "Interest_Only_Loan_Indicator", "MSA", "ZIP",
]
NOT_IN_PANEL = [
    "Curr_Rate", "Orig_HPI", "Orig_Date", "First_Pay", "Loan_Age", "Rem_Months", "Maturity_Date", "OCLTV", "State",
    "Current_Loan_Delinquency_Status", "Orig_URate",
]
VINTAGE_EDGES = [0, 2004, 2006, 2008, 2010, 2020]


def indicator(condition: Column) -> Column:
    """1 where the condition holds, 0 elsewhere, null included."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def vintage_bins(df: DataFrame, date: str = "Orig_Date", edges: list[int] | None = None) -> DataFrame:
    """Indicators of the right-closed year bins after the first; a year outside
    all bins looks like the first one."""
    edges = VINTAGE_EDGES if edges is None else edges
    year = F.year(date)
    bins = list(zip(edges, edges[1:]))[1:]
    return df.withColumns({f"Vintage_{lo + 1}_{hi}": indicator((year > lo) & (year <= hi)) for lo, hi in bins})


def month_indicators(df: DataFrame, date: str = "Act_Period") -> DataFrame:
    return df.withColumns({f"Month_{m}": indicator(F.month(date) == m) for m in range(2, 13)})


def categories_of(df: DataFrame, columns: list[str], limit: int = 10_000) -> dict[str, list]:
    """Sorted distinct non-null values per column. Each becomes a column of the
    design, so more than ``limit`` of them is an error, not a truncation."""
    counts = df.agg(*[F.count_distinct(f"`{c}`").alias(c) for c in columns]).first().asDict()
    wide = [c for c, n in counts.items() if n > limit]
    if wide:
        raise ValueError(f"too many categories to one-hot encode: {wide}")
    found = df.agg(*[F.collect_set(f"`{c}`").alias(c) for c in columns]).first()
    return {c: sorted(found[c]) for c in columns}


def one_hot(df: DataFrame, categories: dict[str, list], drop_first: bool = False) -> DataFrame:
    """Indicator columns ``column_value``; null and unseen values are all zero."""
    added = {
        f"{c}_{v}": indicator(F.col(c) == F.lit(v))
        for c, values in categories.items()
        for v in (values[1:] if drop_first else values)
    }
    return df.withColumns(added).drop(*categories)


def scaling_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, population deviation, minimum and maximum, one row per column."""
    stats = {"mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max}
    wide = df.agg(*[F.struct(*[f(c).cast("double").alias(n) for n, f in stats.items()]).alias(c) for c in columns])
    named = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("s")) for c in columns]
    return wide.select(F.explode(F.array(*named)).alias("r")).select("r.column", "r.s.*")


def standardize(df: DataFrame, columns: list[str], fit: DataFrame | None = None) -> DataFrame:
    """Centre and divide by the population deviation of ``fit`` (a constant column gives 0)."""
    return _rescale(df, columns, fit, F.avg, F.stddev_pop)


def min_max(df: DataFrame, columns: list[str], fit: DataFrame | None = None) -> DataFrame:
    return _rescale(df, columns, fit, F.min, lambda c: F.max(c) - F.min(c))


def _rescale(df, columns, fit, shift, width) -> DataFrame:
    stats = (df if fit is None else fit).agg(
        F.struct(
            *[shift(c).alias(f"shift_{i}") for i, c in enumerate(columns)],
            *[width(c).alias(f"width_{i}") for i, c in enumerate(columns)],
        )
    )
    [held] = unused(df.columns, "stats")
    out = df.withColumn(held, stats.scalar())
    scaled = {}
    for i, c in enumerate(columns):
        spread = F.col(f"{held}.width_{i}")
        scaled[c] = (F.col(f"`{c}`") - F.col(f"{held}.shift_{i}")) / F.when(spread == 0, F.lit(1.0)).otherwise(spread)
    return out.withColumns(scaled).drop(held)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    shape = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes"))).scalar()
    [held] = unused(counts.columns, "shape")
    weighted = counts.withColumn(held, shape)
    return weighted.select(label, "n", (F.col(f"{held}.rows") / (F.col(f"{held}.classes") * F.col("n"))).alias("weight"))


def binary_target(df: DataFrame, following: int, name: str = "Target") -> DataFrame:
    """1 for rows that move to ``following``, 0 for the others."""
    return df.withColumn(name, (F.col("Next_Status") == following).cast("int"))


def numeric_only(df: DataFrame, but: tuple[str, ...] = ("Loan_ID", "Current_Status", "Next_Status")) -> DataFrame:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in but]
    return df.select(*[F.col(f"`{n}`") for n in names])
