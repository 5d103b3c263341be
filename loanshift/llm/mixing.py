"""Sources mixed to target weights by a multivariate-hypergeometric splitting tree.

Each source is dealt into blocks by a hash of its rows and the blocks are put in
a random order. A target above the source's size takes the whole source so many
times, and for the rest the first blocks of the order; the block in which the
target falls gives the documents that fit. So every source has an exact quota of
block draws. A tree over the output shards splits the vector of quotas: each
half of the shards gets, by a multivariate hypergeometric draw, as many blocks
as its share, down to single shards, which then take disjoint runs of every
source's order and shuffle what they took.

Rows are only ever hashed, summed and joined; the driver sees one row per source
(a mixture has as many as someone gave a weight) and the quotas.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanshift.llm.text import SPACE_CLASS, fresh, local_table
from loanshift.operators.ordered import Scan, scan
from loanshift.session import materialize

WEIGHTS = (1.0, 2.0, 3.0)
MOST_TIMES = 3
SHARDS = 8
ROWS_PER_BLOCK = 64
SEED = 17
#: A shard's order is dealt out in 2 ** PART_BITS parts.
PART_BITS = 8
WORDS = SPACE_CLASS.replace("[", "[^") + "+"


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int
    rows: int
    target: float

    @property
    def times(self) -> int:
        """How often the target takes the whole source."""
        return int(self.target // self.size) if self.size else 0


def targets(sizes: list[int], weights: list[float], total: float, most_times: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most_times`` its size; what is above is shared again."""
    limits, found = [most_times * s for s in sizes], [0.0] * len(sizes)
    open_ones = set(range(len(sizes)))
    while open_ones:
        left = total - sum(limits[k] for k in range(len(sizes)) if k not in open_ones)
        share = left / sum(weights[k] for k in open_ones)
        over = {k for k in open_ones if share * weights[k] > limits[k]}
        if not over:
            for k in open_ones:
                found[k] = share * weights[k]
            break
        open_ones -= over
        for k in over:
            found[k] = float(limits[k])
    return found


def split_quotas(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """``(shards, sources)`` draws of each source per shard; columns sum to ``quotas``, rows differ by one at most."""
    draw = np.random.default_rng(seed)

    def split(vector: np.ndarray, ways: int) -> list[np.ndarray]:
        if ways == 1:
            return [vector]
        left = ways // 2
        taken = draw.multivariate_hypergeometric(vector, int(vector.sum()) * left // ways, method="marginals")
        return split(taken, left) + split(vector - taken, ways - left)

    return np.array(split(np.array(quotas, np.int64), shards))


def _key(text: Column, doc_id: Column) -> Column:
    return F.xxhash64(doc_id, F.coalesce(text, F.lit("")), F.lit(SEED))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.0,
    most_times: int = MOST_TIMES,
    shards: int = SHARDS,
    columns: list[str] | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """``columns`` of ``docs (doc_id, text, source)`` (all by default) with the decision of the mix.

    Also returns the names of the columns added: ``size`` (words), ``source_size``,
    ``target``, ``shards`` (array<int>, one output shard per time the row is
    taken) and ``order`` (long, the random order inside a shard).

    Sources are taken by code point, null last, and get ``weights`` in turn; all
    together take ``share`` of all words. A null or empty text has size 0 and is
    taken as its block is. Rows alike in doc_id and text share one fate.
    """
    spark = docs.sparkSession
    columns = columns or docs.columns
    names = dict(zip(("size", "source_size", "target", "shards", "order"), fresh(columns, "size", "source_size", "target", "shards", "order")))
    size, key, sid, n, block, origin, name, p, p_sid, p_block = fresh(
        [*columns, *names.values()], "words", "key", "sid", "n", "block", "origin", "name", "p", "p_sid", "p_block"
    )
    rows = docs.select(
        *[F.col(f"`{c}`") for c in columns],
        F.col("source").alias(origin),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORDS)).cast("bigint").alias(size),
        _key(F.col("text"), F.col("doc_id").cast("bigint")).alias(key),
    )
    thin = materialize(rows.select(F.col(origin).alias("source"), F.col(size).alias("size"), F.col(key).alias("key")))
    found = thin.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).collect()
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    given = [weights[k % len(weights)] for k in range(len(found))]
    goals = targets([r["size"] for r in found], given, share * sum(r["size"] for r in found), most_times)
    sources = [Source(r["source"], r["size"], r["rows"], goal) for r, goal in zip(found, goals)]
    table = local_table(
        spark,
        [
            {"s": s.name, "sid": k, "n": -(-s.rows // ROWS_PER_BLOCK), "rest": s.target - s.times * s.size, "times": s.times,
             "source_size": s.size, "target": s.target}
            for k, s in enumerate(sources)
        ],
        "s string, sid int, n bigint, rest double, times int, source_size bigint, target double",
    )

    def dealt(key: Column, n: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit("block")), n)

    known = thin.join(table, F.col("source").eqNullSafe(F.col("s"))).withColumn("block", dealt(F.col("key"), F.col("n")))
    blocks = known.groupBy("sid", "block").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("times").alias("times"))
    ordered = scan(
        materialize(blocks), ["sid"], [F.xxhash64("sid", "block", F.lit(SEED)), F.col("block")],
        Scan(running_sum={"end": "words"}, position="place"),
    )
    start = F.col("end") - F.col("words")
    # 1: all of the block once more; 2: what fits of it.
    drawn = F.when((F.col("end") <= F.col("rest")) & (F.col("rest") > 0), 1).when(start < F.col("rest"), 2).otherwise(0)
    ordered = materialize(ordered.withColumns({"drawn": drawn, "room": F.col("rest") - start}))
    counts = ordered.groupBy("sid").agg(F.count("*").alias("blocks"), F.count_if(F.col("drawn") > 0).alias("more")).collect()
    per_source = {r["sid"]: r for r in counts}
    totals = [per_source[k]["blocks"] for k in range(len(sources))]
    quotas = [s.times * totals[k] + per_source[k]["more"] for k, s in enumerate(sources)]
    runs = np.cumsum(split_quotas(quotas, shards, SEED), axis=0) if sources else np.zeros((shards, 0), np.int64)
    ends = local_table(
        spark,
        [{"sid": k, "blocks": totals[k], "ends": runs[:, k].tolist()} for k in range(len(sources))],
        "sid int, blocks bigint, ends array<bigint>",
    )
    # What fits of the one block per source in which the target falls: the largest rows first. A block is a bounded list.
    cut = ordered.where("drawn = 2").select("sid", "block", "room")
    units = known.join(cut, ["sid", "block"]).groupBy("sid", "block", "key").agg(F.sum("size").alias("size"), F.first("room").alias("room"))
    listed = units.groupBy("sid", "block").agg(
        F.sort_array(F.collect_list(F.struct("size", "key")), asc=False).alias("units"), F.first("room").alias("room")
    )
    empty = F.struct(F.col("room").alias("room"), F.array().cast("array<bigint>").alias("keys"))
    fitted = F.aggregate(
        "units",
        empty,
        lambda state, unit: F.when(
            unit["size"] <= state["room"],
            F.struct((state["room"] - unit["size"]).alias("room"), F.array_append(state["keys"], unit["key"]).alias("keys")),
        ).otherwise(state),
        # What is left out is longer than the room; the shortest goes in too where that comes nearer to the target.
        lambda state: F.concat(
            state["keys"],
            F.transform(
                F.slice(
                    F.reverse(
                        F.filter(
                            F.col("units"),
                            lambda u: ~F.array_contains(state["keys"], u["key"]) & (u["size"] < 2 * state["room"]),
                        )
                    ),
                    1,
                    1,
                ),
                lambda u: u["key"],
            ),
        ),
    )
    fitting = materialize(listed.select("sid", "block", fitted.alias("fitting")))

    plan = materialize(
        ordered.join(ends, "sid").join(fitting, ["sid", "block"], "left").select(
            F.col("sid").alias(p_sid), F.col("block").alias(p_block), "place", "drawn", "times", "blocks", "ends", "fitting"
        )
    )
    with_source = rows.join(
        table.select(F.col("s").alias(name), F.col("sid").alias(sid), F.col("n").alias(n), F.col("source_size").alias(names["source_size"]), F.col("target").alias(names["target"])),
        F.col(origin).eqNullSafe(F.col(name)),
    ).withColumn(block, dealt(F.col(key), F.col(n)))
    more = (F.col(f"{p}.drawn") == 1) | ((F.col(f"{p}.drawn") == 2) & F.array_contains(F.coalesce(F.col(f"{p}.fitting"), F.array().cast("array<bigint>")), F.col(key)))
    draws = F.col(f"{p}.times") + more.cast("int")
    place = F.col(f"{p}.place")
    shard_of = F.transform(
        F.slice(F.sequence(F.lit(0), F.lit(most_times)), F.lit(1), draws),
        lambda time: F.size(F.filter(F.col(f"{p}.ends"), lambda end: end <= time * F.col(f"{p}.blocks") + place)),
    )
    packed = plan.select(p_sid, p_block, F.struct("place", "drawn", "times", "blocks", "ends", "fitting").alias(p))
    joined = with_source.join(packed, (F.col(sid) == F.col(p_sid)) & (F.col(block) == F.col(p_block)))
    result = joined.select(
        *[F.col(f"`{c}`") for c in columns],
        F.col(size).alias(names["size"]),
        F.col(names["source_size"]),
        F.col(names["target"]),
        shard_of.alias(names["shards"]),
        F.xxhash64(F.col(key), F.lit("order")).alias(names["order"]),
    )
    return result, names


def decisions(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, shards)`` per row of ``docs (doc_id, text, source)``."""
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "source")
    mixed, names = mix(keyed, columns=["doc_id"], **options)
    found = mixed.select("doc_id", *[F.col(names[k]).alias(k) for k in ("size", "source_size", "target", "shards")])
    return found.withColumn("taken", F.col("size") * F.size("shards"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, by output shard in random order inside."""
    mixed, names = mix(docs, **options)
    shard, order, copy, part = fresh(mixed.columns, "shard", "order", "copy", "part")
    copies = mixed.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(names["order"]).alias(order), F.posexplode(names["shards"]).alias(copy, shard))
    copies = copies.withColumn(order, F.xxhash64(F.col(order), F.col(copy)))
    # A shard is as many tasks as its random order has parts, not one.
    copies = copies.withColumn(part, F.shiftrightunsigned(order, 64 - PART_BITS))
    return copies.repartition(shard, part).sortWithinPartitions(shard, order).select(*docs.columns)
