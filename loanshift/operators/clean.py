"""Cleaning: recodes, null-keeping exclusions, fills, required columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanshift.functions import scalars
from loanshift.functions.names import prefix
from loanshift.session import materialize

DATE_COLUMNS = ["Act_Period", "Orig_Date", "First_Pay", "Maturity_Date"]
FILTER_ONLY = ["Product", "Mod_Flag", "Adj_Rem_Months"]
# What a missing entry of these columns means.
CONSTANT_FILLS = {"Mi_Pct": 0.0, "Mi_Type": "0", "Interest_Only_Loan_Indicator": "Y"}
MEAN_FILLS = ["DTI", "Cscore_B"]
REQUIRED = ["Curr_URate", "Curr_HPI", "Benchmark_Rate", "Serv_Ind", "Next_Status", "First_Flag"]


def parse_dates(df: DataFrame) -> DataFrame:
    """Month text to dates; Time_Stamp is the quarter in the file's name."""
    columns = {c: scalars.month_start(F.col(c)) for c in DATE_COLUMNS if c in df.columns}
    if "Time_Stamp" in df.columns:
        columns["Time_Stamp"] = scalars.quarter_start(F.col("Time_Stamp"))
    return df.withColumns(columns)


def recode_program_flag(df: DataFrame, column: str = "HomeReady_Program_Indicator") -> DataFrame:
    """``'7'`` means not in the program; anything else, null included, is ``Y``."""
    return df.withColumn(column, F.when(F.col(column).eqNullSafe("7"), "N").otherwise("Y"))


def is_not(column: str, value: object) -> Column:
    """Exclude one value but keep null."""
    return ~F.col(column).eqNullSafe(value)


def exclude_adjustable(df: DataFrame) -> DataFrame:
    return df.where(is_not("Product", "ARM"))


def exclude_modified(df: DataFrame) -> DataFrame:
    return df.where(is_not("Mod_Flag", "Y"))


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("all")


def fill_constants(df: DataFrame, fills: dict | None = None) -> DataFrame:
    fills = CONSTANT_FILLS if fills is None else fills
    return df.na.fill({c: v for c, v in fills.items() if c in df.columns})


def impute_mean(df: DataFrame, columns: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """Replace nulls by the column mean, over the table or per ``by`` group."""
    columns = MEAN_FILLS if columns is None else columns
    if not by:
        # Scalar subqueries: Spark merges them into one aggregate over the pruned columns.
        means = {c: df.agg(F.avg(c)).scalar() for c in columns}
        return df.withColumns({c: F.coalesce(F.col(c), means[c]) for c in columns})
    own = prefix(df.columns)
    means = df.groupBy(*by).agg(*[F.avg(c).alias(f"{own}mean_{c}") for c in columns])
    # Stored, so that a small table of means is broadcast by its measured size.
    means = materialize(means).select(*[F.col(b).alias(f"{own}by_{b}") for b in by], *[f"{own}mean_{c}" for c in columns])
    match = F.lit(True)
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"{own}by_{b}"))
    filled = df.join(means, match, "left")
    return filled.withColumns({c: F.coalesce(F.col(c), F.col(f"{own}mean_{c}")) for c in columns}).select(*df.columns)


def require(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows where none of the columns is null or NaN.

    One condition per column, which scans can take over; a single predicate
    over all columns could not be pushed down.
    """
    present = F.lit(True)
    for c in REQUIRED if columns is None else columns:
        present = present & F.col(f"`{c}`").isNotNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            present = present & ~F.isnan(f"`{c}`")
    return df.where(present)


def complete_cases(df: DataFrame) -> DataFrame:
    return require(df, df.columns)


def clean(df: DataFrame, impute_by: list[str] | None = None) -> DataFrame:
    """Recode, exclude, drop filter-only columns, fill. Runs before any window,
    so a removed month is skipped when looking for the next record.

    Empty rows need no filter here: every record carries its file's Time_Stamp.
    (One predicate over all columns would also make Catalyst's constraint
    propagation explode in the projections that follow.)
    """
    out = recode_program_flag(df).transform(exclude_adjustable).transform(exclude_modified)
    out = out.drop(*FILTER_ONLY).transform(fill_constants)
    return impute_mean(out, by=impute_by)
