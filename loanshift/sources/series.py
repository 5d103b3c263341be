"""Landed JSON of the statistics service, and the requests that fetch it.

Fetching itself is left to the host: this package reads files only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanshift.functions import scalars
from loanshift.operators.ordered import numbered

# Response shape and ids per request.
RESPONSE_SCHEMA = (
    "Results struct<series: array<struct<seriesID: string, "
    "data: array<struct<year: string, period: string, value: string>>>>>"
)
REQUEST_SIZE = 50


def read_series_json(spark: SparkSession, path: str) -> DataFrame:
    """One response per file."""
    return flatten_series(spark.read.schema(RESPONSE_SCHEMA).json(path, multiLine=True))


def parse_series_json(df: DataFrame, column: str = "json") -> DataFrame:
    return flatten_series(df.select(F.from_json(column, RESPONSE_SCHEMA).alias("r")).select("r.*"))


def flatten_series(responses: DataFrame) -> DataFrame:
    """Rows (Year, Month, URate, id); a series without data gives none."""
    series = responses.select(F.explode("Results.series").alias("s"))
    items = series.select(F.col("s.seriesID").alias("id"), F.explode("s.data").alias("d"))
    return items.select(
        F.col("d.year").alias("Year"),
        F.substring(F.col("d.period"), 2, 2**30).alias("Month"),
        F.col("d.value").alias("URate"),
        "id",
    )


def request_batches(codes: DataFrame, prefix: str, size: int = REQUEST_SIZE) -> DataFrame:
    """Series ids of area codes with the request each belongs to.

    ``codes`` is one column of distinct area codes.
    """
    placed = numbered(codes.select("code"), [F.col("code").asc()], "at")
    return placed.select(
        scalars.series_id(prefix, F.col("code")).alias("series"),
        F.floor(F.col("at") / size).cast("int").alias("request"),
    )
