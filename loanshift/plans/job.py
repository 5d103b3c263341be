"""The whole build as one call: text files in, transition table and column listing out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loanshift.operators import clean, profile
from loanshift.operators.lookups import split_unemployment
from loanshift.plans.build import Series, transition_table
from loanshift.sources import economics, layout, performance, tables


@dataclass(frozen=True)
class Files:
    """Where the inputs lie; ``file_list`` names the performance files in ``folder``."""

    layout: str
    folder: str
    file_list: str
    zip_index: str
    state_index: str
    rates: str
    unemployment: str
    judicial: str
    spread: str


def read_series(spark: SparkSession, files: Files) -> Series:
    metro, state = split_unemployment(economics.read_unemployment(spark, files.unemployment))
    return Series(
        zip_index=economics.read_hpi_zip(spark, files.zip_index),
        state_index=economics.read_hpi_state(spark, files.state_index),
        rates=economics.read_rates(spark, files.rates),
        metro_unemployment=metro,
        state_unemployment=state,
        judicial=economics.read_judicial(spark, files.judicial),
        spread=economics.read_spread(spark, files.spread),
    )


def store_records(spark: SparkSession, files: Files, path: str, mode: str = "error", rejected: str | None = None) -> DataFrame:
    """The listed performance files with their dates parsed, ``Time_Stamp`` among them, written once as Parquet.

    Text is parsed once; every later pass reads only the columns it needs. A
    malformed record is an error, or with ``rejected`` is listed in a table there.
    """
    spec = layout.read_layout(spark, files.layout)
    if rejected is None:
        rows = performance.read_listed(spark, files.folder, files.file_list, spec)
    else:
        rows, others = performance.split_listed(spark, files.folder, files.file_list, spec)
        others.write.mode(mode).parquet(rejected)
    records = clean.parse_dates(rows)
    records.write.mode(mode).parquet(path)
    return spark.read.schema(records.schema).parquet(path)


def build_from_files(
    spark: SparkSession, files: Files, out: str, mode: str = "error", list_rejected: bool = False, **settings
) -> DataFrame:
    """Writes ``out/records``, ``out/transitions`` and ``out/columns``; returns the stored transitions.

    ``settings`` are those of ``transition_table``. ``mode`` decides about
    tables that are there already, by default an error. With ``list_rejected``
    malformed records go to ``out/rejected``.
    """
    records = store_records(spark, files, f"{out}/records", mode, f"{out}/rejected" if list_rejected else None)
    settings.setdefault("count_from", records.select("Loan_ID"))
    built = transition_table(records, read_series(spark, files), **settings)
    tables.write_transitions(built, f"{out}/transitions", mode)
    stored = tables.read_transitions(spark, f"{out}/transitions")
    tables.write_result(profile.listing(stored), f"{out}/columns", mode)
    return stored
