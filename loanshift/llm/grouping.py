"""Best-fit packing of token sequences by linear grouping.

How many pieces have each length is all that a packing depends on, and a
histogram over 1..capacity has a fixed size. So the driver packs the histogram:
pieces over a fifth of the capacity are large; sorted by length they are cut
into groups of equal cardinality and rounded up to the longest of their group;
a linear program over the few rounded sizes gives how often to use which
configuration (column generation, Gilmore and Gomory, 1961; the grouping is
Fernandez de la Vega's and Lueker's, 1981); the real lengths take the places of
the rounded ones; everything left, small or large, is best-fitted in decreasing
order. The plan is a list of runs of equally filled sequences, and a piece finds
its place in it by its length and its rank among the pieces of that length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanshift.llm.text import by_text, crc, fresh, id_bytes
from loanshift.session import materialize

CAPACITY = 4096
GROUPS = 16
#: Large pieces are longer than this part of the capacity.
LARGE = 5
#: The part of a sequence that may stay empty before it is packed anew, at first.
LOOSE = 64
#: Pieces of one length that one task ranks.
RANKED_AT_ONCE = 100_000
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
Run = tuple[int, list[tuple[int, int]]]


def _best_configuration(sizes: list[int], price: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of the highest total price (an unbounded knapsack, one piece more per layer)."""
    value, layers = np.zeros(capacity + 1), []
    for _ in range(capacity // min(sizes)):
        better, choice = value.copy(), np.full(capacity + 1, -1)
        for k, size in enumerate(sizes):
            shifted = value[: capacity + 1 - size] + price[k]
            gain = shifted > better[size:] + 1e-12
            better[size:][gain] = shifted[gain]
            choice[size:][gain] = k
        value = better
        layers.append(choice)
    column, room = np.zeros(len(sizes)), capacity
    for choice in reversed(layers):
        if choice[room] >= 0:
            column[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(value[capacity]), column


def configurations(sizes: list[int], demands: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """``(times, pieces of each size)`` of a rounded-down optimal fractional packing."""
    n = len(sizes)
    columns = np.diag([capacity // s for s in sizes]).astype(float)
    # Equal demands tie in every step; a little unlike, they cannot send the simplex method in circles.
    used = np.linalg.solve(columns, np.array([d * (1 + 1e-6 * (k + 1)) for k, d in enumerate(demands)]))
    for _ in range(100 * n):  # any basis is a packing, so ending here would cost sequences, not pieces
        value, column = _best_configuration(sizes, np.linalg.solve(columns.T, np.ones(n)), capacity)
        if value <= 1 + 1e-7:
            break
        step = np.linalg.solve(columns, column)
        ratios = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratios))
        entered = ratios[out]
        used = used - entered * step
        used[out], columns[:, out] = entered, column
    times = np.floor(np.maximum(used, 0) + 1e-9).astype(int)
    return [(int(t), columns[:, k].astype(int).tolist()) for k, t in enumerate(times) if t]


def _take(queue: deque[list[int]], count: int) -> list[tuple[int, int]]:
    """``count`` pieces from the front of a run-length list, as ``(length, pieces)``."""
    taken = []
    while count and queue:
        length, there = queue[0]
        now = min(count, there)
        taken.append((length, now))
        count -= now
        queue[0][1] -= now
        if not queue[0][1]:
            queue.popleft()
    return taken


def _grouped(counts: np.ndarray, capacity: int, groups: int) -> list[Run]:
    """Runs of sequences that the large pieces fill by configurations; takes what it uses from ``counts``."""
    large = [length for length in range(capacity, capacity // LARGE, -1) if counts[length]]
    total = int(sum(counts[length] for length in large))
    if not total:
        return []
    share, queues, held = -(-total // groups), [deque()], 0
    for length in large:
        left = int(counts[length])
        while left:
            if held == share:
                queues.append(deque())
                held = 0
            now = min(left, share - held)
            queues[-1].append([length, now])
            held += now
            left -= now
    # A size stands once: groups rounded to the same length are one.
    merged: list[deque] = []
    for queue in queues:
        if merged and merged[-1][0][0] == queue[0][0]:
            merged[-1].extend(queue)
        else:
            merged.append(queue)
    sizes = [queue[0][0] for queue in merged]
    demands = [sum(n for _, n in queue) for queue in merged]
    runs: list[Run] = []
    for times, pieces in configurations(sizes, demands, capacity):
        slots = [deque(map(list, _take(merged[k], times))) for k, n in enumerate(pieces) for _ in range(n)]
        times = min([times, *(sum(n for _, n in slot) for slot in slots)])
        while times:
            alike = min([times, *(slot[0][1] for slot in slots)])
            content: dict[int, int] = {}
            for slot in slots:
                [(length, _)] = _take(slot, alike)
                content[length] = content.get(length, 0) + 1
            runs.append((alike, list(content.items())))
            times -= alike
    for n, content in runs:
        for length, each in content:
            counts[length] -= n * each
    return runs


def _best_fit(counts: np.ndarray, capacity: int, begun: list[Run]) -> list[Run]:
    """Sequences ``begun`` and new ones that hold ``counts`` too: the longest first, each into the least room it fits."""
    by_room: dict[int, list[Run]] = {}
    rooms: list[int] = []

    def add(run: Run) -> None:
        room = capacity - sum(length * n for length, n in run[1])
        if room not in by_room:
            by_room[room] = []
            insort(rooms, room)
        by_room[room].append(run)

    for run in begun:
        add(run)
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = min(capacity // length, left)
                add((left // each, [(length, each)]))
                left %= each
                continue
            room = rooms[at]
            sequences, content = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
            each = min(room // length, left)
            filled = min(sequences, left // each)
            add((filled, [*content, (length, each)]))
            if sequences > filled:
                add((sequences - filled, content))
            left -= filled * each
    return [run for same in by_room.values() for run in same]


def pack_histogram(counts: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS) -> list[Run]:
    """``(sequences, [(length, pieces in each)])`` that hold ``counts[length]`` pieces of every length.

    Where rounding cost room that no small piece fills, sequences with over so
    much room are emptied and their pieces best-fitted once more, if that saves any.
    """
    left = counts.copy()
    begun = _grouped(left, capacity, groups)
    runs = _best_fit(left, capacity, begun)
    for spare in (capacity // LOOSE, 0):
        tight, loose, again = [], [], np.zeros_like(counts)
        for sequences, content in runs:
            room = capacity - sum(length * n for length, n in content)
            (loose if room > spare else tight).append((sequences, content))
        for sequences, content in loose:
            for length, each in content:
                again[length] += sequences * each
        runs = tight + min(loose, _best_fit(again, capacity, []), key=lambda some: sum(n for n, _ in some))
    return runs


class Plan:
    """Where the pieces of a length go, by rank: arrays sorted by (length, first rank)."""

    def __init__(self, runs: list[Run]) -> None:
        ranks: dict[int, int] = {}
        rows, first_sequence = [], 0
        for sequences, content in runs:
            offset = 0
            for length, each in content:
                rank = ranks.get(length, 0)
                rows.append((length, rank, each, first_sequence, offset))
                ranks[length] = rank + sequences * each
                offset += length * each
            first_sequence += sequences
        self.sequences = first_sequence
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.length, self.rank, self.each, self.sequence, self.offset = table.T.copy()
        self.starts = {int(v): int(k) for v, k in zip(*np.unique(self.length, return_index=True))}

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece."""
        row = np.empty(len(lengths), np.int64)
        for length in np.unique(lengths):
            at = self.starts[int(length)]
            end = at + int(np.searchsorted(self.length[at:], length, side="right"))
            mine = lengths == length
            row[mine] = at + np.searchsorted(self.rank[at:end], ranks[mine], side="right") - 1
        instance, slot = np.divmod(ranks - self.rank[row], self.each[row])
        return self.sequence[row] + instance, self.offset[row] + slot * lengths


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: texts as ids with ``end_id``, cut after every ``capacity`` ids.

    Null text is empty: its one piece is the end id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in by_text(batch)):
            rows = []
            for doc_id, raw in zip(batch["doc_id"].to_pylist(), id_bytes(tokenizer, batch["text"].to_pylist(), end_id)):
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, crc(part)))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, PIECE_SCHEMA)


def pack(items: DataFrame, order: list[str], capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: packed by ``length`` into sequences of ``capacity``.

    ``items`` is stored, has a ``length`` from 1 to ``capacity`` and no column
    of the names added; ``order`` tells rows of one length apart (rows alike in
    it may swap places). Pieces of one length are ranked in salted groups, so a
    length that a third of all rows has takes many tasks. An empty table gives
    an empty one.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for row in items.groupBy("length").agg(F.count("*").alias("n")).collect():  # capacity rows at most
        counts[row["length"]] = row["n"]
    plan = items.sparkSession.sparkContext.broadcast(Plan(pack_histogram(counts, capacity, groups)))
    salts = max(1, -(-int(counts.max()) // RANKED_AT_ONCE))
    salt, rank, rows, before = fresh(items.columns, "salt", "rank", "rows", "before")
    salted = items.withColumn(salt, F.pmod(F.xxhash64(*order), F.lit(salts)))
    within = Window.partitionBy("length", salt).orderBy(*order)
    ranked = salted.withColumn(rank, F.row_number().over(within) - 1)
    earlier = Window.partitionBy("length").orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    sizes = salted.groupBy("length", salt).agg(F.count("*").alias(rows))
    sizes = sizes.withColumn(before, F.coalesce(F.sum(rows).over(earlier), F.lit(0))).drop(rows)
    ranked = ranked.join(sizes, ["length", salt]).withColumn(rank, F.col(rank) + F.col(before))
    added = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    schema = T.StructType([*items.schema.fields, *added])
    names = items.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sequence, offset = plan.value.place(np.asarray(batch["length"]), np.asarray(batch[rank]))
                arrays = [*(batch[c] for c in names), pa.array(sequence), pa.array(offset)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, "sequence_id", "offset"])

    return ranked.select(*names, rank).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """All pieces of ``docs (doc_id, text)`` with ``sequence_id`` and ``offset``."""
    return pack(materialize(pieces(docs, tokenizer, end_id, capacity)), ["doc_id", "piece", "start", "ids_crc32"], capacity)
