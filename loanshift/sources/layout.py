"""The record layout as data: field order, which fields are kept, their types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The layout table's columns and its type names.
LAYOUT_SCHEMA = "ID int, Name string, Abbreviation string, Indicator string, dType string"
TYPES = {"string": T.StringType(), "float64": T.DoubleType(), "int64": T.LongType()}


@dataclass(frozen=True)
class Layout:
    fields: T.StructType
    kept: list[str]


def read_layout_table(spark: SparkSession, path: str) -> DataFrame:
    """The layout CSV (header row, byte-order mark allowed) with names trimmed."""
    table = spark.read.schema(LAYOUT_SCHEMA).csv(path, header=True, enforceSchema=True)
    return table.withColumn("Abbreviation", F.rtrim("Abbreviation"))


def layout_of(table: DataFrame) -> Layout:
    """A schema in file order plus the fields marked ``1``. One row per field of
    the layout, so collecting it is bounded by the record width."""
    rows = table.orderBy("ID").collect()
    fields = [T.StructField(r["Abbreviation"], TYPES[r["dType"]]) for r in rows]
    return Layout(T.StructType(fields), [r["Abbreviation"] for r in rows if r["Indicator"] == "1"])


def read_layout(spark: SparkSession, path: str) -> Layout:
    return layout_of(read_layout_table(spark, path))
