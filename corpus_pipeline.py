"""Documents through quality rules, near and exact deduplication, mixing and packing.

Each stage takes the table its predecessor kept and calls one operator. All but
the last return the columns of their input; the last gives one row per packed
piece. A document that the mix takes more than once is packed as often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanshift.llm import covering, decision_list, doubling, grouping, mixing
from loanshift.llm.queries import table, tokenizer
from loanshift.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the list learned from ``labels`` keep."""
    return decision_list.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash fingerprints linked at two bits, over three-word shingles."""
    return covering.drop_near_copies(docs, shingle=3, radius=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 13-word windows that a document with a smaller doc_id has too."""
    return doubling.drop_repeats(docs, window=13)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, in its order."""
    return mixing.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequence and place."""
    return grouping.pack_documents(docs, tokenizer(), end_id=1, capacity=4096)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing", source_mix),
    ("best-fit packing", packing),
]
#: Learned rules, XXH64 fingerprints, seeded draws and tokenizer ids are beyond SQL: tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored as Parquet and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
