"""Shards of near equal size by sampled splitters.

Documents are ordered by a hash of their text, then doc_id, so that equal texts
are neighbours. A sample of keys, drawn in proportion to size, gives quantiles
of the sizes; they split the order into many more ranges than shards. A first
count of every range shows which came out overfull, and those are sampled again,
more densely, and subdivided, until none is. A boundary lies where a text
changes; only a group of equal texts that is itself overfull is subdivided, by
doc_id. The ranges, largest first, each go to the emptiest shard, those of one
group together as long as the group is no larger than a shard.

Draws are hashes, so a rerun gives the same shards. A range holds ``RANGE_BYTES``
at most, but for hot rows alike, so tasks stay of one size as the table grows.
The driver sees a few draws and one row per range: 25,000 ranges for 100 TB.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanshift.llm.text import fresh
from loanshift.session import materialize

SHARDS, RANGES_PER_SHARD, DRAWS_PER_RANGE, SEED = 8, 64, 32, 23
#: Bytes that a range should not pass; small tables have smaller ones.
RANGE_BYTES = 8 << 30
#: Of its even share, what makes a range overfull.
OVERFULL = 2.0
LEAST = -(1 << 63)
Key = tuple[int, int]


def size_of(text: Column) -> Column:
    """UTF-8 bytes plus one; null counts as empty."""
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("bigint")


def keyed(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, text_crc32, key, tie)`` per row of ``docs (doc_id, text)``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(
        doc_id.alias("doc_id"), size_of(F.col("text")).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("key"), F.coalesce(doc_id, F.lit(LEAST)).alias("tie"),
    )


@dataclass
class Ranges:
    """Sorted splitters: range r holds the keys from splitter r - 1 on, before splitter r."""

    splitters: list[Key]

    def find(self, keys: np.ndarray, ties: np.ndarray) -> np.ndarray:
        firsts, seconds = (np.array([s[k] for s in self.splitters], np.int64) for k in (0, 1))
        low, high = np.searchsorted(firsts, keys, "left"), np.searchsorted(firsts, keys, "right")
        found = low.copy()
        inside = np.flatnonzero(high > low)
        for start in np.unique(low[inside]):
            mine = inside[low[inside] == start]
            found[mine] = start + np.searchsorted(seconds[start : high[mine[0]]], ties[mine], "right")
        return found

    def add(self, rows: DataFrame, name: str = "range", values: np.ndarray | None = None) -> DataFrame:
        """``rows (key, tie, ...)`` with their range, or what ``values`` holds for it, as ``name``."""
        shared = rows.sparkSession.sparkContext.broadcast((self, values))
        names = rows.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ranges, values = shared.value
                found = ranges.find(np.asarray(batch["key"]), np.asarray(batch["tie"]))
                found = found if values is None else values[found]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.astype(np.int32))], names=[*names, name])

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        return rows.mapInArrow(run, f"{fields}, `{name}` int")


def _quantiles(sample: list[tuple[int, int, float]], parts: int) -> list[Key]:
    """Splitters at ``1/parts, 2/parts, ...`` of the weights; at the start of a key unless it spans several."""
    sample = sorted(sample)
    ends = np.cumsum([w for _, _, w in sample])
    if not len(ends):
        return []
    at = [min(int(np.searchsorted(ends, ends[-1] * k / parts)), len(sample) - 1) for k in range(1, parts)]
    chosen, seen = [], set()
    for k in at:
        key, tie, _ = sample[k]
        if key in seen:
            # A text that spans several quantiles has its ranges to itself.
            chosen += [(key, tie), (min(key + 1, -LEAST - 1), LEAST)]
        else:
            chosen.append((key, LEAST))
        seen.add(key)
    return sorted(set(chosen))


def sampled_ranges(rows: DataFrame, least: int) -> tuple[Ranges, list]:
    """Ranges of ``rows (key, tie, size)``, none overfull that can be divided, and their sizes.

    About ``least`` of them, or more, so that their even share is ``RANGE_BYTES`` over ``OVERFULL`` at most.
    Each size is a row ``(range, size, rows, divisible)``.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return Ranges([]), []
    count = max(least, math.ceil(total * OVERFULL / RANGE_BYTES))
    share = total / count
    ranges, tried = Ranges([]), -1
    wanted = {0: count}
    sizes: list = []
    while wanted:
        # Draws in proportion to size, from the ranges to divide alone.
        ranged = ranges.add(rows)
        draws = F.lit(DRAWS_PER_RANGE / share)
        drawn = F.pmod(F.xxhash64("key", "tie", F.lit(SEED + len(ranges.splitters))), F.lit(1 << 40)) / float(1 << 40)
        sample = ranged.where(F.col("range").isin(list(wanted))).where(drawn < F.col("size") * draws)
        weight = F.greatest(F.col("size").cast("double"), 1 / draws)
        found = sample.groupBy("range", "key", "tie").agg(F.sum(weight).alias("w")).collect()
        draws_of, new = defaultdict(list), set()
        for r in found:
            draws_of[r["range"]].append((r["key"], r["tie"], r["w"]))
        for number, parts in wanted.items():
            new.update(_quantiles(draws_of[number], parts))
        ranges = Ranges(sorted({*ranges.splitters, *new}))
        stats = [F.sum("size").alias("size"), F.count("*").alias("rows"), F.min(F.struct("key", "tie")).alias("a"), F.max(F.struct("key", "tie")).alias("b")]
        sizes = ranges.add(rows).groupBy("range").agg(*stats).orderBy("range").collect()
        if len(ranges.splitters) == tried:
            break
        tried = len(ranges.splitters)
        wanted = {r["range"]: 2 * int(r["size"] / share) for r in sizes if r["size"] > OVERFULL * share and r["a"] != r["b"]}
    return ranges, sizes


def assign(sizes: list, splitters: list[Key], shards: int) -> dict[int, int]:
    """Shard of each range: units by size, largest first, each to the emptiest shard."""
    quota = sum(r["size"] for r in sizes) / shards
    units: dict[tuple, list] = {}
    for r in sizes:
        # Ranges that hold one and the same text belong together.
        alone = r["a"]["key"] == r["b"]["key"]
        units.setdefault(("text", r["a"]["key"]) if alone else ("range", r["range"]), []).append(r)
    whole: list[list] = []
    for members in units.values():
        whole += [members] if sum(m["size"] for m in members) <= quota else [[m] for m in members]
    whole.sort(key=lambda members: (-sum(m["size"] for m in members), members[0]["range"]))
    heap = [(0, shard) for shard in range(shards)]
    found = {}
    for members in whole:
        load, shard = heapq.heappop(heap)
        for m in members:
            found[m["range"]] = shard
        heapq.heappush(heap, (load + sum(m["size"] for m in members), shard))
    return found


def shard(rows: DataFrame, shards: int = SHARDS, ranges_per_shard: int = RANGES_PER_SHARD) -> DataFrame:
    """Stored ``rows (key, tie, size, ...)`` with ``range``, ``shard`` and ``slot``, gapless in each shard.

    Slots follow the ranges of a shard, and key and tie in them. An empty table
    gives an empty one.
    """
    ranges, sizes = sampled_ranges(rows, shards * ranges_per_shard)
    of_range = assign(sizes, ranges.splitters, shards)
    filled, first = [0] * shards, {}
    for r in sizes:
        first[r["range"]] = filled[of_range[r["range"]]]
        filled[of_range[r["range"]]] += r["rows"]
    length = len(ranges.splitters) + 1
    shard_of = np.array([of_range.get(k, 0) for k in range(length)], np.int32)
    slot_of = np.array([first.get(k, 0) for k in range(length)], np.int64)
    ordered = ranges.add(rows).withColumn("slot", F.row_number().over(Window.partitionBy("range").orderBy("key", "tie", "size")) - 1)
    names = ordered.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = np.asarray(batch["range"])
            slots = np.asarray(batch["slot"]) + slot_of[number]
            arrays = [*(batch[c] for c in names[:-1]), pa.array(shard_of[number]), pa.array(slots)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names[:-1], "shard", "slot"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields[:-1])
    return ordered.mapInArrow(run, f"{fields}, shard int, slot long")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``(doc_id, size, text_crc32, range, shard, slot)`` per row of ``docs (doc_id, text)``.

    Rows alike in text and doc_id share a range and may swap slots.
    """
    rows = materialize(keyed(docs))
    return shard(rows, shards).drop("key", "tie")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write all columns of ``docs`` by shard (``shard=0/`` and so on), files sorted by key inside their ranges."""
    [name] = fresh(docs.columns, "shard") if "shard" in docs.columns else ["shard"]
    ranges, sizes = sampled_ranges(materialize(keyed(docs).select("key", "tie", "size")), shards * RANGES_PER_SHARD)
    of_range = assign(sizes, ranges.splitters, shards)
    # Text and id are enough to find a row's range again, so texts move once, to the task that writes them.
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST)).alias("tie"),
    )
    shard_of = np.array([of_range.get(k, 0) for k in range(len(ranges.splitters) + 1)], np.int32)
    dealt = ranges.add(ranges.add(whole), "shard", shard_of)
    dealt = dealt.repartition("range").sortWithinPartitions("shard", "key", "tie")
    dealt.select("row.*", F.col("shard").alias(name)).write.partitionBy(name).parquet(path)
