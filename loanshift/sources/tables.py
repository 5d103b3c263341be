"""The transition table and result tables, as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanshift.functions.states import targets_of
from loanshift.operators.clean import complete_cases

PAIR = ["Current_Status", "Next_Status"]


def write_transitions(df: DataFrame, path: str, mode: str = "error") -> None:
    """One directory per (current, next) pair. A table that is there already is an error unless ``mode`` says otherwise.

    ``rebalance`` gathers a pair's rows into files of a sensible size and lets
    AQE split the pair that holds nearly everything, 0 -> 0.
    """
    df.hint("rebalance", *PAIR).write.mode(mode).partitionBy(*PAIR).parquet(path)


def read_transitions(spark: SparkSession, path: str, state: int | None = None) -> DataFrame:
    """All pairs, or the legal pairs of one current state; only their directories are read."""
    rows = spark.read.parquet(path)
    if state is None:
        return rows
    return rows.where((F.col("Current_Status") == state) & F.col("Next_Status").isin(targets_of(state)))


def combine_all(spark: SparkSession, path: str) -> DataFrame:
    """Every pair, complete rows only."""
    return complete_cases(read_transitions(spark, path))


def write_bucketed(records: DataFrame, name: str, buckets: int, path: str | None = None, mode: str = "error") -> DataFrame:
    """Records as a catalog table bucketed by loan and sorted inside, so that windows per loan need no shuffle.

    Choose ``buckets`` so that one fits a task. ``path`` puts the files elsewhere
    than the warehouse.
    """
    order = [c for c in ("Loan_ID", "Act_Period", "Seq") if c in records.columns]
    # One file per bucket, or its rows would have to be sorted again.
    writer = records.repartition(buckets, "Loan_ID").write.mode(mode).bucketBy(buckets, "Loan_ID").sortBy(*order)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return records.sparkSession.table(name)


def write_result(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Splits, predictions, probabilities, metrics, importances."""
    df.write.mode(mode).parquet(path)


def union_by_name(*tables: DataFrame) -> DataFrame:
    """Rows of all tables, columns aligned by name, absent ones null."""
    out = tables[0]
    for other in tables[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out
