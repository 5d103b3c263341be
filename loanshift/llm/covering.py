"""SimHash fingerprints linked by covering locality-sensitive hashing.

A table is a bit mask; two fingerprints meet in it if they agree on its bits.
Bit i gets a nonzero vector m(i) of radius + 1 bits, and for every nonzero v
there is a mask of the bits with odd parity of m(i) & v (Pagh, 2016). Any
``radius`` differing bits leave some v orthogonal to all their vectors, so a
pair within the radius agrees on that mask: no pair is missed.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanshift.llm.components import components
from loanshift.llm.text import fresh, map_batches
from loanshift.session import materialize

BITS = 64
#: Members of a bucket up to which its pairs are compared one by one.
PAIRS_UP_TO = 32
#: Shingles whose bits are counted at a time, which bounds memory on long texts.
AT_ONCE = 100_000


def simhash(words: list[bytes], shingle: int) -> int:
    """Bit-wise majority of the XXH64 (seed 42) of all ``shingle``-word windows; fewer words: of all; none: 0."""
    if not words:
        return 0
    joined, width = b" ".join(words), min(shingle, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(BITS, np.int64), len(words) - width + 1
    for at in range(0, total, AT_ONCE):
        to = min(total, at + AT_ONCE)
        spans = zip(starts[at:to], ends[at + width - 1 : to + width - 1])
        hashes = np.array([digest(joined[a : b - 1], 42) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``(doc_id, key, fp)`` per row; words are lower-cased in A-Z, ``key`` is a hash of the text, ``fp`` the fingerprint as a signed long."""

    def on_batch(batch: pa.RecordBatch):
        found = [simhash(t.encode().lower().split() if t else [], shingle) for t in batch["text"].to_pylist()]
        signed = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["key"], signed], names=["doc_id", "key", "fp"])

    wanted = docs.select(F.col("doc_id").cast("bigint"), "text", text_key().alias("key"))
    return map_batches(wanted, "doc_id long, key long, fp long", on_batch)


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def masks(radius: int) -> list[int]:
    """The 2 ** (radius + 1) - 1 covering masks."""
    vectors = 2 ** (radius + 1) - 1
    return [
        sum(1 << bit for bit in range(BITS) if ((bit % vectors + 1) & v).bit_count() % 2) for v in range(1, vectors + 1)
    ]


def links(classes: DataFrame, radius: int) -> DataFrame:
    """Edges ``(a, b)`` whose components equal those of all pairs of distinct ``fp`` within ``radius`` bits.

    Buckets of up to ``PAIRS_UP_TO`` members are compared pair by pair. Members
    of fuller buckets are never paired: a pair within the radius has a point
    between them, at most half the radius from each, so every member is listed
    under all points that near and linked to the smallest member there. That is
    exact, and takes a fixed number of rows per member.
    """
    tables = F.array(*[F.struct(F.lit(k).alias("t"), F.lit(signed(m)).alias("mask")) for k, m in enumerate(masks(radius))])
    keyed = classes.select("fp", F.explode(tables).alias("x")).select(
        "fp", F.col("x.t").alias("t"), F.col("fp").bitwiseAND(F.col("x.mask")).alias("key")
    )
    full = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(keyed.join(full, ["t", "key"]))
    few = members.where(F.col("n") <= PAIRS_UP_TO).select("t", "key", "fp")
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = (
        few.withColumnRenamed("fp", "a")
        .join(few.withColumnRenamed("fp", "b"), ["t", "key"])
        .where((F.col("a") < F.col("b")) & (differing <= radius))
        .select("a", "b")
    )
    many = members.where(F.col("n") > PAIRS_UP_TO).select("fp").distinct()
    far, near = -(-radius // 2), radius // 2
    flips = [(0, 0)] + [
        (signed(sum(1 << b for b in bits)), k) for k in range(1, far + 1) for bits in combinations(range(BITS), k)
    ]
    points = F.array(*[F.struct(F.lit(f).alias("flip"), F.lit(k).alias("k")) for f, k in flips])
    around = many.select("fp", F.explode(points).alias("x")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("x.flip")).alias("point"), F.col("x.k").alias("k")
    )
    # Distinct fingerprints near one point: as many as there are flips, at most.
    inner = F.collect_set(F.when(F.col("k") <= near, F.col("fp")))
    stars = around.groupBy("point").agg(F.array_min(inner).alias("a"), F.collect_set("fp").alias("all"))
    stars = stars.where((F.size("all") > 1) & F.col("a").isNotNull()).select("a", F.explode("all").alias("b")).where("a <> b")
    return pairs.unionByName(stars)


def near_groups(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``docs (doc_id, text)``.

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is
    the smallest doc_id reachable. Equal fingerprints are one node however many
    rows share them. Null and blank texts have fingerprint 0 and link like any
    other. Rows without a doc_id are grouped too, but their id is no candidate
    for ``component_id``, which is null in a group without any id.
    """
    rows = materialize(fingerprints(docs, shingle))
    labelled = _rooted(rows, F.min("doc_id"), radius)
    least = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.select("doc_id", "fp").join(labelled.join(least, "root").select("fp", "component_id"), "fp")


def _rooted(rows: DataFrame, first: Column, radius: int) -> DataFrame:
    """``(fp, first, root)`` per distinct fingerprint of ``rows``; ``root`` is the smallest fingerprint reachable."""
    classes = materialize(rows.groupBy("fp").agg(first.alias("first")))
    rooted = components(links(classes, radius)).select(F.col("node").alias("fp"), "root")
    return classes.join(rooted, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def drop_near_copies(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, the one with the smallest doc_id.

    Groups are told apart by fingerprint, not by id, so an id that repeats with
    unlike texts is in several groups. Of one group's rows with the same id, the
    text with the smallest hash stays; of rows alike in id and text, one. Rows
    without a doc_id cannot be named as kept or dropped and stay.
    """
    own, key, copies, row = fresh(docs.columns, "kept_id", "kept_key", "copies", "row")
    rows = materialize(fingerprints(docs, shingle))
    place = F.when(F.col("doc_id").isNotNull(), F.struct(F.col("doc_id").alias("id"), F.col("key").alias("key")))
    least = _rooted(rows, F.min(place), radius).groupBy("root").agg(F.min("first").alias("first"))
    chosen = least.where(F.col("first").isNotNull()).select(F.col("first.id").alias(own), F.col("first.key").alias(key))
    counts = rows.groupBy("doc_id", "key").agg(F.count("*").alias(copies))
    same = (F.col("doc_id") == F.col(own)) & (F.col("key") == F.col(key))
    kept = materialize(counts.join(chosen, same).select(own, key, copies))
    here = (F.col("doc_id").cast("bigint") == F.col(own)) & (text_key() == F.col(key))
    once = docs.join(kept.where(F.col(copies) == 1), here, "left_semi").unionByName(docs.where(F.col("doc_id").isNull()))
    if kept.where(F.col(copies) > 1).isEmpty():
        return once
    repeated = docs.join(kept.where(F.col(copies) > 1), here, "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = repeated.groupBy("doc_id", text_key().alias(key)).agg(F.min_by(whole, F.to_json(whole)).alias(row))
    return once.unionByName(first.select(f"{row}.*"))
