"""Document fingerprints from closed syncmers, in DataFrame functions only.

Of all substrings of ``K`` bytes (UTF-8) those are anchors whose smallest inner
substring of ``S`` bytes, by hash, is the first or the last one (Edgar, 2021).
Whether a substring is an anchor depends on its own bytes alone, so an edit
leaves every anchor away from it in 
Being context-free also makes edited texts cheap: their anchors are those of the
part kept, those of the part put in, and the few across the seam.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanshift.llm.text import fresh, local_table

K, S, SKETCH = 12, 9, 64
#: All hashes below are kept: one anchor in 32.
BOUND = 1 << 27
#: Bytes of a text looked at together, which bounds memory on long texts.
BLOCK = 1024
#: Ranges of doc_id per shuffle partition.
RANGES_PER_PARTITION = 4
LOW = (1 << 32) - 1
#: An anchor in one number: its hash, then its place in 31 bits.
PLACE = (1 << 31) - 1


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def packed(raw: Column, before: Column | None = None, k: int = K, s: int = S) -> Column:
    """The anchors of a binary, ``array<bigint>``: 32 bits of hash, then the place (from 1), ``before`` bytes further on.

    An anchor is hashed through its first and last inner substring, which
    between them hold all of it (so 2 * ``s`` >= ``k``).
    """
    if not 2 * s >= k > s:
        raise ValueError("an anchor must be covered by two inner substrings, and longer than one")
    last = k - s

    def of_block(block: Column, start: Column) -> Column:
        places = F.sequence(F.lit(1), F.octet_length(block) - s + 1)
        hashes = F.transform(places, lambda i: F.xxhash64(F.substring(block, i, F.lit(s))))

        def edges(h: Column) -> Column:
            def at_edge(i: Column) -> Column:
                inside = [F.get(h, i + m) for m in range(1, last)]
                edge = F.least(F.get(h, i), F.get(h, i + last))
                return edge <= (F.least(*inside) if len(inside) > 1 else inside[0]) if inside else F.lit(True)

            chosen = F.filter(F.sequence(F.lit(0), F.size(h) - 1 - last), at_edge)
            return F.transform(
                chosen,
                lambda i: F.shiftleft(F.xxhash64(F.get(h, i), F.get(h, i + last)).bitwiseAND(F.lit(LOW)), 31) + (start + i),
            )

        return _let(hashes, edges)

    def of_text(whole_text: Column, first: Column) -> Column:
        size = F.octet_length(whole_text)
        blocks = F.transform(
            F.sequence(F.lit(0), size - k, F.lit(BLOCK)),
            lambda at: _let(
                F.substring(whole_text, at + 1, F.lit(BLOCK + k - 1)),
                lambda block: _let(at + first, lambda start: of_block(block, start)),
            ),
        )
        return F.when(size >= k, F.flatten(blocks)).otherwise(F.array().cast("array<bigint>"))

    first = F.lit(1) if before is None else before + 1
    return _let(raw, lambda text: _let(first, lambda place: of_text(text, place)))


def anchors(raw: Column, k: int = K, s: int = S) -> Column:
    """``array<struct<at int, h bigint>>`` of a binary: where anchors start (from 1), and 32 bits of their hash."""
    return F.transform(
        packed(raw, None, k, s), lambda x: F.struct(_place(x).cast("int").alias("at"), _hash(x).alias("h"))
    )


def _hash(anchor: Column) -> Column:
    return F.shiftright(anchor, 31)


def _place(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit(PLACE).cast("bigint"))


def sketch(found: Column, size: int = SKETCH) -> Column:
    """Of packed anchors the first place of each hash, for the ``size`` smallest hashes and all below ``BOUND``, ascending."""

    def firsts(values: Column) -> Column:
        return _let(
            F.sort_array(values),
            lambda v: F.filter(v, lambda x, i: (i == 0) | (x.bitwiseXOR(F.get(v, i - 1)) > PLACE)),
        )

    def least(values: Column) -> Column:
        def cut(few: Column) -> Column:
            return F.slice(few, F.lit(1), F.greatest(F.lit(size), F.size(F.filter(few, lambda x: x < BOUND << 31))))

        return _let(firsts(values), cut)

    def of_many(values: Column) -> Column:
        # Hashes are evenly spread: about four times as many as wanted lie below this bound, and it is checked.
        bound = F.greatest(F.lit(float(BOUND)), F.lit(4 * size * (LOW + 1)) / F.size(values))
        below = _let(F.shiftleft(bound.cast("bigint"), 31), lambda end: F.filter(values, lambda x: x < end))
        return _let(least(below), lambda few: F.when(F.size(few) >= size, few).otherwise(least(values)))

    return _let(found, lambda values: F.when(F.size(values) > 8 * size, of_many(values)).otherwise(least(values)))


def whole(raw: Column) -> Column:
    """The sketch of a text too short for an anchor: the hash of all of it."""
    return F.array(F.shiftleft(F.xxhash64(raw).bitwiseAND(F.lit(LOW)), 31) + 1)


def fingerprint(raw: Column, k: int = K, s: int = S) -> Column:
    """The sketch of a binary, ``array<bigint>``; equal texts have equal ones and none is empty."""
    return F.when(F.octet_length(raw) < k, whole(raw)).otherwise(_or_whole(sketch(packed(raw, None, k, s)), raw))


def _or_whole(found: Column, raw: Column) -> Column:
    return _let(found, lambda f: F.when(F.size(f) == 0, whole(raw)).otherwise(f))


def chain(pairs: Column) -> Column:
    """How many pairs of places the longest chain holds that ascends in both; ``pairs`` are first * 2 ** 31 + second.

    Pairs that follow each other in both orders are on it together or not at
    all, so the search is over runs of such pairs: one run in an unmoved text.
    """

    def ranks(ordered: Column) -> Column:
        by_second = F.sort_array(F.transform(ordered, lambda x, i: F.shiftleft(_place(x), 31) + i))
        by_first = F.sort_array(F.transform(by_second, lambda x, rank: F.shiftleft(_place(x), 31) + rank))
        return F.transform(by_first, _place)

    def longest(runs: Column) -> Column:
        def extend(done: Column, run: Column) -> Column:
            before = F.filter(done, lambda d: d["rank"] < run["rank"])
            best = F.coalesce(F.array_max(F.transform(before, lambda d: d["n"])), F.lit(0))
            return F.concat(done, F.array(F.struct(run["rank"].alias("rank"), (run["n"] + best).alias("n"))))

        ends = F.aggregate(runs, F.array().cast("array<struct<rank:bigint,n:int>>"), extend)
        return F.array_max(F.transform(ends, lambda d: d["n"]))

    def of_ranks(rank: Column) -> Column:
        starts = F.array_compact(F.transform(rank, lambda x, i: F.when((i == 0) | (x != F.get(rank, i - 1) + 1), i)))

        def of_starts(start: Column) -> Column:
            runs = F.transform(
                start,
                lambda i, k: F.struct(F.get(rank, i).alias("rank"), (F.coalesce(F.get(start, k + 1), F.size(rank)) - i).alias("n")),
            )
            return F.when(F.size(start) <= 1, F.size(rank)).otherwise(longest(runs))

        return _let(starts, of_starts)

    return _let(_let(F.sort_array(pairs), ranks), of_ranks)


def likeness(a: Column, b: Column, size: int = SKETCH) -> Column:
    """Likeness of two sketches, 0 to 1, in the order of their places.

    Compared are the hashes up to where both sketches have all of them; of
    these, the share that lies on the longest chain of anchors that ascends
    in both texts. Equal texts have 1.
    """

    def reach(found: Column) -> Column:
        last = F.get(found, F.size(found) - 1).bitwiseOR(F.lit(PLACE).cast("bigint"))
        return F.when(F.size(found) < size, F.lit((1 << 63) - 1)).otherwise(F.greatest(last, F.lit((BOUND << 31) - 1)))

    def side(found: Column, bound: Column, tag: int) -> Column:
        below = F.filter(found, lambda x: x <= bound)
        return F.transform(below, lambda x: F.shiftleft(_hash(x), 32) + F.lit(tag << 31).cast("bigint") + _place(x))

    def rate(both: Column) -> Column:
        # A hash of both texts stands twice, the first text's place before the second's.
        def pair(x: Column, i: Column) -> Column:
            other = F.get(both, i + 1)
            same = F.shiftrightunsigned(x, 32) == F.shiftrightunsigned(other, 32)
            return F.when(same, F.shiftleft(_place(x), 31) + _place(other))

        pairs = F.array_compact(F.transform(both, pair))
        return _let(pairs, lambda p: F.when(F.size(p) == 0, 0.0).otherwise(chain(p) / (F.size(both) - F.size(p))))

    def below(bound: Column) -> Column:
        return _let(F.sort_array(F.concat(side(a, bound, 0), side(b, bound, 1))), rate)

    return _let(F.least(reach(a), reach(b)), below)


def as_text(found: Column) -> Column:
    """Eight hex digits for each hash, in the order of the places."""
    ordered = F.sort_array(F.transform(found, lambda x: F.shiftleft(_place(x), 32) + _hash(x)))
    return F.lower(F.array_join(F.transform(ordered, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(LOW))), 8, "0")), ""))


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are at most ``value`` (null: 0), by two short scans."""
    if not bounds:
        return F.lit(0)
    width = max(1, int(len(bounds) ** 0.5))
    chunks = [bounds[k : k + width] for k in range(0, len(bounds), width)]

    def count(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= value))

    heads = count(F.array(*[F.lit(c[0]) for c in chunks]))
    inside = F.array(*[F.array(*[F.lit(b) for b in c]) for c in chunks])
    return F.when(value.isNull(), 0).otherwise(
        _let(heads, lambda n: F.when(n == 0, 0).otherwise((n - 1) * width + count(F.get(inside, n - 1))))
    )


def with_next(docs: DataFrame, columns: list[str], parts: int) -> DataFrame:
    """``docs (doc_id, ...)`` with ``columns`` of the next row by doc_id (then ``tie``), as ``next_<column>``.

    After the last row comes the first. Rows are dealt into ranges of doc_id
    (null first); the first row of each range is also put at the end of the
    range before, so one shuffle and a window inside each range suffice. The
    driver sees one id per range.
    """
    [ghost, span] = fresh(docs.columns, "ghost", "span")
    at = [k / parts for k in range(1, parts)]
    found = docs.agg(F.percentile_approx("doc_id", at, 100 * parts).alias("b")).first()["b"] if parts > 1 else None
    bounds = sorted(set(found or []))
    ranged = docs.withColumn(span, _range_of(F.col("doc_id"), bounds))
    firsts = ranged.groupBy(span).agg(F.min(F.struct("doc_id", "tie")).alias("f")).orderBy(span).collect()
    if not firsts:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    # The head of each range, and the range it is put behind.
    heads = [{"i": r["f"]["doc_id"], "t": r["f"]["tie"], "s": firsts[k - 1][span]} for k, r in enumerate(firsts)]
    table = local_table(docs.sparkSession, heads, "i bigint, t bigint, s int")
    ids = [h["i"] for h in heads if h["i"] is not None]
    candidates = docs.where(F.col("doc_id").isin(ids) | (F.col("doc_id").isNull() & F.lit(len(ids) < len(heads))))
    ghosts = candidates.dropDuplicates(["doc_id", "tie"]).join(table, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("tie") == F.col("t")))
    ghosts = ghosts.select(*docs.columns, F.col("s").alias(span))
    every = ranged.withColumn(ghost, F.lit(False)).unionByName(ghosts.withColumn(ghost, F.lit(True)))
    order = Window.partitionBy(span).orderBy(ghost, "doc_id", "tie")
    led = every.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return led.where(~F.col(ghost)).drop(ghost, span)


def edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``docs (doc_id, text)`` and of their edited texts.

    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)``: in the edited text the last quarter of the code
    points (rounded down) is replaced by as many from the start of the next
    document's text, or all there are. Null text is empty; rows of one doc_id
    follow each other by a hash of their text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    rows = rows.withColumn("n_chars", F.char_length("text").cast("bigint"))
    kept_text = F.expr("left(text, n_chars - n_chars div 4)")
    rows = rows.withColumn("raw", F.encode("text", "UTF-8")).withColumn("cut", F.octet_length(kept_text))

    def sketches(inside: Column) -> Column:
        at = F.greatest(F.col("cut") - (K - 2), F.lit(1))
        across = packed(F.substring(F.col("raw"), at, F.octet_length("raw")), at - 1)
        return F.struct(sketch(F.concat(inside, across)).alias("own"), sketch(inside).alias("kept"))

    rows = rows.withColumn("s", _let(packed(F.substring(F.col("raw"), F.lit(1), F.col("cut"))), sketches))
    rows = rows.select("doc_id", "tie", "text", "n_chars", _or_whole(F.col("s.own"), F.col("raw")).alias("own"), F.col("s.kept").alias("kept_sketch"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * RANGES_PER_PARTITION
    led = with_next(rows, ["text", "own"], parts)
    led = led.withColumn("kept", kept_text).withColumn("given", F.expr("left(next_text, n_chars div 4)"))
    kept, given = F.encode("kept", "UTF-8"), F.encode("given", "UTF-8")
    at = F.greatest(F.octet_length(kept) - (K - 2), F.lit(1))
    seam = packed(F.concat(F.substring(kept, at, F.lit(K - 1)), given), at - 1)
    both = F.concat(kept, given)
    led = led.withColumn("edited", _or_whole(sketch(F.concat("kept_sketch", seam)), both))
    return led.select(
        "doc_id", "n_chars", F.sha2(both, 256).alias("edited_sha256"), as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
