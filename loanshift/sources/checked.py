"""CSV whose malformed records are an error or a table of their own, never silent nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanshift.functions.names import unused


def _read(spark: SparkSession, paths: str | list[str], schema: T.StructType, **options) -> tuple[DataFrame, str, Column]:
    """Rows with the text of malformed ones, that column's name, and whether a row is malformed.

    The reader converts only what a query reads, so a record would be judged by
    the columns that happen to be selected; the condition therefore reads them all.
    """
    [text] = unused(schema.names, "malformed")
    whole = T.StructType([*schema.fields, T.StructField(text, T.StringType())])
    reader = spark.read.schema(whole).option("columnPruning", "false").option("columnNameOfCorruptRecord", text)
    everything = F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in schema.names])
    return reader.csv(paths, mode="PERMISSIVE", **options), text, F.col(text).isNotNull() | (F.length(everything) < 0)


def read_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType | str, **options) -> DataFrame:
    """Rows of ``schema``; a record whose fields do not parse, or are too few or too many, is an error that names it."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows, text, malformed = _read(spark, paths, schema, **options)
    wrong = F.raise_error(F.concat(F.lit("malformed record: "), F.col(text))).cast("boolean")
    return rows.where(F.when(malformed, wrong).otherwise(F.lit(True))).drop(text)


def split_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType, sep: str = ",", **options) -> tuple[DataFrame, DataFrame]:
    """The sound rows of ``schema``, and the others as ``(file, record, reasons)``.

    A reason names the field and its text, or tells how many fields there are
    where that is wrong. Every record is in one of the two tables.
    """
    rows, text, malformed = _read(spark, paths, schema, sep=sep, **options)
    parts = F.split(F.col(text), f"\\Q{sep}\\E", -1)
    several = F.when(F.size(parts) != len(schema), F.concat(F.size(parts).cast("string"), F.lit(f" fields for {len(schema)}")))
    unread = [_reason(F.get(parts, F.lit(k)), f.name) for k, f in enumerate(schema.fields) if not isinstance(f.dataType, T.StringType)]
    reasons = F.array_compact(F.array(several, *unread)).alias("reasons")
    # The file's name is known to the scan alone.
    file = F.col("_metadata.file_name").alias("file")
    rejected = rows.where(malformed).select(file, F.col(text).alias("record"), reasons)
    return rows.where(~malformed).drop(text), rejected


def _reason(part: Column, name: str) -> Column:
    empty = F.coalesce(part == "", F.lit(True))
    return F.when(F.col(f"`{name}`").isNull() & ~empty, F.concat(F.lit(f"{name}: "), part))


def number(field: T.StructField) -> Column:
    """The text column of the field's name as a number; blank is null, any other text that is no number is an error."""
    text = F.trim(F.col(f"`{field.name}`"))
    wrong = F.raise_error(F.concat(F.lit(f"not a number in {field.name}: "), text)).cast(field.dataType)
    return F.when(text != "", F.coalesce(text.try_cast(field.dataType), wrong)).alias(field.name)
