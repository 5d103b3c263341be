"""Readers of the economic series. Columns bind by position; headers are ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanshift.functions import scalars
from loanshift.operators.lookups import last_of_month, lookup, unique_by
from loanshift.sources import checked

# File formats.
HPI_ZIP_SCHEMA = "Zip string, Year int, Quarter int, HPI double"
HPI_STATE_SCHEMA = "State string, Year int, Quarter int, HPI double"
RATES_SCHEMA = "Date string, `30_Year` double, `15_Year` double"
SERIES_SCHEMA = "Year string, Month string, URate double, Series string"
UNEMPLOYMENT_SCHEMA = "FIPS string, Date string, URate double, StateAbb string"
JUDICIAL_SCHEMA = "State string, Full string, Judicial int"
SPREAD_SCHEMA = "Date string, Spread double"
AREA_SCHEMA = "type string, code string"
GEOCODE_POSITIONS = {0: "CBSA", 3: "CBSA_Title", 8: "State_Name", 9: "FIPS"}
MISSING = "-"
DAY_FIRST = "d/M/yyyy"
MONTH_FIRST = "M/d/yyyy"


def _read(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """Columns of ``schema`` by position; text where a number belongs is an error, blank text is null."""
    wanted = T.StructType.fromDDL(schema)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted])
    rows = spark.read.schema(texts).csv(path, header=True, enforceSchema=True, **options)
    return rows.select(*[F.col(f"`{f.name}`") if f.dataType == T.StringType() else checked.number(f) for f in wanted])


def read_hpi_zip(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, HPI_ZIP_SCHEMA)


def read_hpi_state(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, HPI_STATE_SCHEMA)


def read_daily_rates(spark: SparkSession, path: str) -> DataFrame:
    rows = _read(spark, path, RATES_SCHEMA).na.drop("all")
    return rows.withColumn("Date", F.to_date("Date", DAY_FIRST))


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    """Year, Month, 30_Year, 15_Year: the last record of each month."""
    return last_of_month(read_daily_rates(spark, path))


def _series(spark: SparkSession, path: str) -> DataFrame:
    rows = _read(spark, path, SERIES_SCHEMA, nullValue=MISSING).na.drop("all")
    return rows.withColumns({"Year": F.col("Year").cast("int"), "Month": F.col("Month").cast("int")})


def read_unemployment_msa(spark: SparkSession, path: str) -> DataFrame:
    rows = _series(spark, path)
    return rows.select("Year", "Month", "URate", scalars.metro_code(F.col("Series")).alias("MSA"))


def read_unemployment_state(spark: SparkSession, path: str, geocode_path: str) -> DataFrame:
    """State series with the state's abbreviation from the geocode table."""
    rows = _series(spark, path)
    rows = rows.select(
        "Year", "Month", "URate", scalars.state_code(F.col("Series")).try_cast("int").alias("FIPS")
    )
    return add_state_names(rows, read_geocode(spark, geocode_path))


def add_state_names(rows: DataFrame, geocode: DataFrame) -> DataFrame:
    return lookup(rows, unique_by(geocode, ["FIPS"]), {"FIPS": F.col("FIPS")}, {"State": "State"})


def read_unemployment(spark: SparkSession, path: str) -> DataFrame:
    """The combined file: FIPS, URate, StateAbb, Year, Month."""
    rows = _read(spark, path, UNEMPLOYMENT_SCHEMA, nullValue=MISSING).where(F.col("URate").isNotNull())
    date = F.to_date("Date", MONTH_FIRST)
    return rows.select("FIPS", "URate", "StateAbb", F.year(date).alias("Year"), F.month(date).alias("Month"))


def read_judicial(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, JUDICIAL_SCHEMA).select("State", "Judicial")


def read_spread(spark: SparkSession, path: str) -> DataFrame:
    date = F.to_date("Date", DAY_FIRST)
    return _read(spark, path, SPREAD_SCHEMA).select(
        F.year(date).alias("Year"), F.month(date).alias("Month"), "Spread"
    )


def read_area_codes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """State codes (type A) and metro codes (type B)."""
    rows = _read(spark, path, AREA_SCHEMA, sep="\t")
    return tuple(rows.where(F.col("type") == kind).select("code") for kind in ("A", "B"))


def read_geocode(spark: SparkSession, path: str) -> DataFrame:
    width = max(GEOCODE_POSITIONS) + 1
    schema = ", ".join(f"{GEOCODE_POSITIONS.get(i, f'_c{i}')} string" for i in range(width))
    return state_codes(_read(spark, path, schema).select(*GEOCODE_POSITIONS.values()))


def state_codes(areas: DataFrame) -> DataFrame:
    """Distinct (State, FIPS) of areas whose title names a single state."""
    rows = areas.na.drop("all").select(
        scalars.state_of_title(F.col("CBSA_Title")).alias("State"), F.col("FIPS").cast("int").alias("FIPS")
    )
    return rows.where(~F.col("State").contains("-")).dropDuplicates()
