"""Monthly loan-performance files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanshift.sources import checked
from loanshift.sources.layout import Layout


def file_names(spark: SparkSession, list_path: str) -> list[str]:
    """First column of a file list with a header row; a list of paths is driver-side by nature."""
    rows = spark.read.csv(list_path, header=True)
    return [r[0] for r in rows.select(rows.columns[0]).collect() if r[0]]


def _schema(layout: Layout) -> T.StructType:
    """The layout in file order; fields that are not kept are text, which always parses."""
    return T.StructType([f if f.name in layout.kept else T.StructField(f.name, T.StringType()) for f in layout.fields])


def _stamp() -> Column:
    return F.substring(F.col("_metadata.file_name"), 1, 6).alias("Time_Stamp")


def read_performance(spark: SparkSession, paths: str | list[str], layout: Layout) -> DataFrame:
    """Pipe-separated records without header, kept fields only.

    ``Time_Stamp`` is the ``YYYYQn`` at the start of the file's name. A record
    with a number that does not parse, or with too few or too many fields, is an
    error; ``split_performance`` lists such records instead.
    """
    return checked.read_csv(spark, paths, _schema(layout), sep="|", header=False).select(_stamp(), *layout.kept)


def split_performance(spark: SparkSession, paths: str | list[str], layout: Layout) -> tuple[DataFrame, DataFrame]:
    """The sound records, and the rejected ones as ``(file, record, reasons)``."""
    rows, rejected = checked.split_csv(spark, paths, _schema(layout), sep="|", header=False)
    return rows.select(_stamp(), *layout.kept), rejected


def read_listed(spark: SparkSession, folder: str, list_path: str, layout: Layout) -> DataFrame:
    """All files named in a file list, as one scan."""
    return read_performance(spark, [f"{folder}/{name}" for name in file_names(spark, list_path)], layout)


def split_listed(spark: SparkSession, folder: str, list_path: str, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """``read_listed`` with the rejected records apart."""
    return split_performance(spark, [f"{folder}/{name}" for name in file_names(spark, list_path)], layout)
