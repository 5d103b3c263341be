"""Order-dependent columns per key that stay parallel when one key is huge.

A plain window puts a whole key into one task. That is the right plan while
every key is moderate, so keys are counted first (a pruned, map-side combined
count). Keys above ``hot_rows`` are cut into ordered segments by a range
partitioning on (key, order); each segment is scanned on its own and a small
per-segment summary carries state from one segment to the next.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanshift.functions.names import prefix, unused
from loanshift.session import materialize

HOT_ROWS = 2_000_000
#: Segments that hot keys are cut into at most, as long as none grows past ``HOT_ROWS`` on average.
MOST_SEGMENTS = 256


@dataclass(frozen=True)
class Scan:
    """What to compute along the order; every dict maps new column -> source column."""

    lead: dict[str, str] = field(default_factory=dict)
    lag: dict[str, str] = field(default_factory=dict)
    running_max: dict[str, str] = field(default_factory=dict)
    running_sum: dict[str, str] = field(default_factory=dict)
    fill: dict[str, str] = field(default_factory=dict)
    #: New column -> flag: the position of the last row so far where the flag holds.
    last_at: dict[str, str] = field(default_factory=dict)
    position: str | None = None

    def outputs(self) -> list[str]:
        names = [*self.lead, *self.lag, *self.running_max, *self.running_sum, *self.fill, *self.last_at]
        return names + ([self.position] if self.position else [])


def scan(
    df: DataFrame,
    key: list[str],
    order: list[Column],
    what: Scan,
    hot_rows: int = HOT_ROWS,
    count_from: DataFrame | None = None,
) -> DataFrame:
    """Add ``what`` to ``df``, computed per ``key`` in ``order``.

    ``order`` must be unique within a key. ``position`` is 0-based; ``fill`` is
    the last non-null value at or before the row; running columns skip nulls.
    ``count_from`` is a cheaper table to count keys in, with the key columns and
    at least as many rows per key as ``df`` (a stored table before joins, say).
    """
    own = prefix([*df.columns, *what.outputs()])
    rows, hot_names = f"{own}n", {k: f"{own}hot_{k}" for k in key}
    sizes = (df if count_from is None else count_from).groupBy(*key).agg(F.count("*").alias(rows))
    for name in what.running_sum.values():
        if df.schema[name].dataType.typeName() in ("double", "float"):
            raise TypeError(f"a running sum of {name} would depend on how rows are cut: cast it to a decimal")
    largest = sizes.agg(F.max(rows)).first()[0]
    if (largest or 0) <= hot_rows:
        return _window_scan(df, key, order, what)

    # Stored, so that the joins below broadcast the list only if it measures small.
    hot = materialize(sizes.where(F.col(rows) > hot_rows))
    hot_total = hot.agg(F.sum(rows)).first()[0]
    if not hot_total:
        return _window_scan(df, key, order, what)
    hot_keys = hot.select(*[F.col(k).alias(n) for k, n in hot_names.items()])
    same_key = _all(F.col(k).eqNullSafe(F.col(n)) for k, n in hot_names.items())
    cold = df.join(hot_keys, same_key, "left_anti")
    busy = df.join(hot_keys, same_key, "left_semi")
    return _window_scan(cold, key, order, what).unionByName(_segment_scan(busy, key, order, what, _segments(hot_total, hot_rows)))


def _segments(hot_total: int, hot_rows: int) -> int:
    """A segment is a task: a low ``hot_rows`` must not make more tasks than the rows need."""
    return min(-(-hot_total // hot_rows) + 1, max(MOST_SEGMENTS, -(-hot_total // HOT_ROWS) + 1))


def _all(conditions):
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def _window_scan(df: DataFrame, key: list[str], order: list[Column], what: Scan) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    columns = {name: F.lead(source).over(w) for name, source in what.lead.items()}
    columns |= {name: F.lag(source).over(w) for name, source in what.lag.items()}
    columns |= {name: F.max(source).over(so_far) for name, source in what.running_max.items()}
    columns |= {name: F.sum(source).over(so_far) for name, source in what.running_sum.items()}
    columns |= {name: F.last(source, ignorenulls=True).over(so_far) for name, source in what.fill.items()}
    at = (F.row_number().over(w) - 1).cast("bigint")
    if what.position:
        columns[what.position] = at
    out = df.withColumns(columns)
    if what.last_at:
        # Positions first, then windows over them, on the same shuffle and sort.
        [place] = unused(out.columns, "place")
        placed = out.withColumn(place, at)
        last = {n: F.last(F.when(F.col(flag), F.col(place)), ignorenulls=True).over(so_far) for n, flag in what.last_at.items()}
        out = placed.withColumns(last).drop(place)
    return out


def _segment_scan(df: DataFrame, key: list[str], order: list[Column], what: Scan, segments: int) -> DataFrame:
    own = prefix([*df.columns, *what.outputs()])
    seg, first, last, count = f"{own}seg", f"{own}first", f"{own}last", f"{own}rows"
    bounds = [F.col(k).asc() for k in key] + list(order)
    # Written out, so the segment a row belongs to is a fact in the data and a
    # retried task cannot change it.
    parts = materialize(df.repartitionByRange(segments, *bounds).withColumn(seg, F.spark_partition_id()))
    inside = [*key, seg]
    w = Window.partitionBy(*inside).orderBy(*order)
    marked = _window_scan(parts, inside, order, what).withColumns(
        {first: F.row_number().over(w) == 1, last: F.lead(F.lit(1)).over(w).isNull()}
    )

    def at(flag: str, column: str) -> Column:
        return F.max(F.when(F.col(flag), F.col(column)))

    summary = [F.count("*").alias(count)]
    summary += [at(first, s).alias(f"{own}in_{n}") for n, s in what.lead.items()]
    summary += [at(last, s).alias(f"{own}in_{n}") for n, s in what.lag.items()]
    summary += [F.max(s).alias(f"{own}in_{n}") for n, s in what.running_max.items()]
    summary += [F.sum(s).alias(f"{own}in_{n}") for n, s in what.running_sum.items()]
    summary += [at(last, n).alias(f"{own}in_{n}") for n in [*what.fill, *what.last_at]]

    # One row per segment and key in it: at most segments + number of hot keys.
    across = Window.partitionBy(*key).orderBy(seg)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = {f"{own}c_{n}": F.lead(f"{own}in_{n}").over(across) for n in what.lead}
    carried |= {f"{own}c_{n}": F.lag(f"{own}in_{n}").over(across) for n in what.lag}
    carried |= {f"{own}c_{n}": F.max(f"{own}in_{n}").over(before) for n in what.running_max}
    carried |= {f"{own}c_{n}": F.sum(f"{own}in_{n}").over(before) for n in what.running_sum}
    carried |= {f"{own}c_{n}": F.last(f"{own}in_{n}", ignorenulls=True).over(before) for n in what.fill}
    carried[f"{own}c_rows"] = F.sum(count).over(before)
    carry = marked.groupBy(*inside).agg(*summary).withColumns(carried)
    # A place in a segment is one in the key after the rows before the segment.
    rows_before = F.coalesce(F.col(f"{own}c_rows"), F.lit(0))
    for n in what.last_at:
        carry = carry.withColumn(f"{own}in_{n}", F.col(f"{own}in_{n}") + rows_before)
        carried[f"{own}c_{n}"] = F.last(f"{own}in_{n}", ignorenulls=True).over(before)
        carry = carry.withColumn(f"{own}c_{n}", carried[f"{own}c_{n}"])
    carry = materialize(carry.select(*[F.col(c).alias(f"{own}k_{c}") for c in inside], *carried))

    joined = marked.join(
        carry, _all(F.col(c).eqNullSafe(F.col(f"{own}k_{c}")) for c in inside), "left"
    )
    result = {n: F.when(F.col(last), F.col(f"{own}c_{n}")).otherwise(F.col(n)) for n in what.lead}
    result |= {n: F.when(F.col(first), F.col(f"{own}c_{n}")).otherwise(F.col(n)) for n in what.lag}
    result |= {n: F.greatest(F.col(n), F.col(f"{own}c_{n}")) for n in what.running_max}
    result |= {n: F.coalesce(F.col(n) + F.col(f"{own}c_{n}"), F.col(n), F.col(f"{own}c_{n}")) for n in what.running_sum}
    result |= {n: F.coalesce(F.col(n), F.col(f"{own}c_{n}")) for n in what.fill}
    offset = F.coalesce(F.col(f"{own}c_rows"), F.lit(0))
    result |= {n: F.coalesce(F.col(n) + offset, F.col(f"{own}c_{n}")) for n in what.last_at}
    if what.position:
        result[what.position] = F.col(what.position) + F.coalesce(F.col(f"{own}c_rows"), F.lit(0))
    return joined.withColumns(result).select(*df.columns, *what.outputs())


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the 0-based position of every row of the whole table in ``order``, which must be unique.

    Rows are range-partitioned and numbered inside their range; the sizes of the
    ranges before, one number per shuffle partition, are added.
    """
    spark = df.sparkSession
    part, before = unused([*df.columns, name], "range", "before")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written out, so the range a row belongs to is a fact in the data.
    ranged = materialize(df.repartitionByRange(parts, *order).withColumn(part, F.spark_partition_id()))
    starts, total = [], 0
    for r in sorted(ranged.groupBy(part).count().collect()):  # one row per range
        starts.append((r[0], total))
        total += r["count"]
    sizes = F.broadcast(spark.createDataFrame(starts, f"`{part}` int, `{before}` long"))
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1 + F.col(before)
    return ranged.join(sizes, part).withColumn(name, place).select(*[F.col(f"`{c}`") for c in df.columns], name)
