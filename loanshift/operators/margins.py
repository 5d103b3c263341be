"""Margin machines on feature maps: all groups, classes, folds, kernels and strengths at once.

Kernels become maps into a few hundred numbers: random Fourier features for rbf
(Rahimi and Recht, 2007), Nyström features on a bounded sample of landmarks for
polynomial and sigmoid kernels. On the map a machine per class minimises

    |w|^2 / 2 + C * sum of weight * loss(y f(x)),

with the squared hinge loss of support vectors or the logistic loss, by Newton
steps: a step needs sums over rows of a gradient and a matrix as wide as the
map, so one job per step serves every machine, and weights alone reach the
driver. Rows are stored once as blocks of bytes, whatever the number of kernels;
a task holds a block, and the map of a part of it, at a time. Steps begin where the
machine without held-out rows ends on the group's first block, which leaves
few of them to the job over all rows; that one decides when a machine is done.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanshift.functions.names import unused
from loanshift.session import discard, materialize

BLOCK_ROWS = 1 << 14
#: Rows of a block that are mapped at a time, and blocks of a row group in storage.
MAPPED_ROWS, BLOCKS_A_GROUP = 1 << 11, 2
#: Numbers of a random Fourier map, and landmarks of a Nyström map.
FOURIER, LANDMARKS = 200, 100
#: Sums that a task holds before it passes them on.
HELD_BYTES = 64 << 20
SEED = 123
MAX_STEPS = 100
#: Tolerance of the first block's machines, where those over all blocks begin.
ROUGH = 1e-3
NO_FOLD = -1
BLOCK_SCHEMA = "cur int, block int, n int, x binary, label binary, fold binary"


@dataclass(frozen=True)
class Kernel:
    """``gamma``: ``scale`` is 1 / (columns * variance), ``auto`` is 1 / columns."""

    kind: str = "linear"
    gamma: str | float = "scale"
    degree: int = 3
    coef0: float = 0.0

    @property
    def name(self) -> str:
        return self.kind if self.kind == "linear" else f"{self.kind}_{self.gamma}"

    def values(self, a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
        """The kernel itself between the rows of ``a`` and ``b``."""
        inner = a @ b.T
        if self.kind == "linear":
            return inner
        if self.kind == "rbf":
            return np.exp(-gamma * ((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * inner))
        raw = gamma * inner + self.coef0
        return raw**self.degree if self.kind == "poly" else np.tanh(raw)


@dataclass(frozen=True)
class Map:
    """A kernel's feature map for one group, whose inner products are near the kernel."""

    kernel: Kernel
    gamma: float
    basis: np.ndarray
    turn: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.kernel.kind == "linear":
            return x
        if self.kernel.kind == "rbf":
            angles = x @ self.basis
            return np.concatenate([np.cos(angles), np.sin(angles)], axis=1) / math.sqrt(self.basis.shape[1])
        return self.kernel.values(x, self.basis, self.gamma) @ self.turn


def make_map(kernel: Kernel, width: int, variance: float, landmarks: np.ndarray, seed: int = SEED) -> Map:
    """A sigmoid kernel has negative directions, which have no place in a map and are left out."""
    gamma = kernel.gamma
    if isinstance(gamma, str):
        gamma = 1.0 / (width * (variance or 1.0)) if gamma == "scale" else 1.0 / width
    nothing = np.zeros((0, 0))
    if kernel.kind == "linear":
        return Map(kernel, gamma, nothing, nothing)
    if kernel.kind == "rbf":
        draw = np.random.default_rng(seed).normal(size=(width, FOURIER // 2))
        return Map(kernel, gamma, draw * math.sqrt(2 * gamma), nothing)
    values, vectors = np.linalg.eigh(kernel.values(landmarks, landmarks, gamma))
    kept = values > 1e-9 * max(values.max(), 1e-300)
    return Map(kernel, gamma, landmarks, vectors[:, kept] / np.sqrt(values[kept]))


# --- blocks, maps -----------------------------------------------------------------------


def blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Stored bytes of ``rows (cur, x, label, fold)`` by group and block; ``label`` is an integer, ``fold`` may be -1."""
    sizes = {r["cur"]: r["count"] for r in rows.groupBy("cur").count().collect()}  # one row per group
    parts = F.lit(1)
    for cur, n in sizes.items():
        parts = F.when(F.col("cur") == cur, F.lit(-(-n // block_rows))).otherwise(parts)
    thin = rows.select(
        F.col("cur").cast("int").alias("cur"), F.pmod(F.xxhash64("x", "label", F.monotonically_increasing_id()), parts).cast("int").alias("block"),
        F.col("x").cast("array<double>").alias("x"), F.col("label").cast("int").alias("label"), F.col("fold").cast("int").alias("fold"),
    )

    def build(table: pa.Table) -> pa.Table:
        n, x = table.num_rows, table["x"].combine_chunks()
        columns = [
            pa.array([table["cur"][0].as_py()], pa.int32()), pa.array([table["block"][0].as_py()], pa.int32()), pa.array([n], pa.int32()),
            pa.array([np.asarray(x.flatten()).astype(float).tobytes()]), pa.array([np.asarray(table["label"]).astype(np.int32).tobytes()]),
            pa.array([np.asarray(table["fold"]).astype(np.int32).tobytes()]),
        ]
        return pa.table(columns, names=["cur", "block", "n", "x", "label", "fold"])

    return materialize(thin.groupBy("cur", "block").applyInArrow(build, BLOCK_SCHEMA), rows_a_group=BLOCKS_A_GROUP)


def maps(rows: DataFrame, kernels: list[Kernel], landmarks: int = LANDMARKS) -> dict[tuple[int, int], Map]:
    """A map per group and kernel, from the variance of the group's values and its ``landmarks`` rows of lowest hash."""
    entry = rows.select("cur", F.explode("x").alias("v"))
    spread = {r["cur"]: r["s"] for r in entry.groupBy("cur").agg(F.var_pop("v").alias("s")).collect()}  # one row per group
    # Hashes alone are ordered first, so that few rows with their values are.
    drawn = rows.select("cur", F.xxhash64("x").alias("h"))
    place = F.row_number().over(Window.partitionBy("cur").orderBy("h"))
    ends = drawn.withColumn("place", place).where(F.col("place") <= landmarks).groupBy("cur").agg(F.max("h").alias("end")).collect()  # one row per group
    near = reduce(or_, [F.col("cur").eqNullSafe(F.lit(r["cur"])) & (F.xxhash64("x") <= r["end"]) for r in ends], F.lit(False))
    first = Window.partitionBy("cur").orderBy(F.xxhash64("x"), F.col("x"))
    lowest = rows.where(near).select("cur", "x", F.row_number().over(first).alias("place")).where(F.col("place") <= landmarks)
    chosen: dict[int, list] = {}
    for r in lowest.collect():  # groups times landmarks
        chosen.setdefault(r["cur"], []).append((r["place"], r["x"]))
    found = {}
    for cur, own in chosen.items():
        marks = np.array([x for _, x in sorted(own)], float)
        for k, kernel in enumerate(kernels):
            found[cur, k] = make_map(kernel, marks.shape[1], spread[cur] or 0.0, marks)
    return found


# --- training -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Machine:
    """One class of one group against the rest, on one map, without the rows of one fold."""

    cur: int
    label: int
    held: int
    kernel: int
    c: float = 1.0
    loss: str = "hinge"


def machines(rows: DataFrame, kernels: list[Kernel], folds: list[int], c: float = 1.0, loss: str = "hinge") -> list[Machine]:
    """A machine per class, held-out fold and kernel, for every group with two classes or more."""
    classes: dict[int, list[int]] = {}
    for r in rows.select("cur", "label").distinct().collect():  # groups times classes
        classes.setdefault(r["cur"], []).append(int(r["label"]))
    return [
        Machine(cur, label, held, k, c, loss)
        for cur, labels in sorted(classes.items()) if len(labels) > 1
        for k in range(len(kernels)) for held in folds for label in sorted(labels)
    ]


def _sums(own: list[tuple[Machine, np.ndarray]], z: np.ndarray, label: np.ndarray, weights: dict[int, np.ndarray]) -> list[np.ndarray]:
    """Per machine of one map, at its ``w``: loss, gradient and second derivatives (a triangle of them) over rows, flat, without the penalty.

    ``weights`` are the rows' by held-out fold.
    """
    scores = z @ np.stack([w for _, w in own], axis=1)
    losses, slopes, triangles, upper = [], np.empty_like(scores), [], np.triu_indices(z.shape[1])
    for k, (m, _) in enumerate(own):
        y, weight = np.where(label == m.label, 1.0, -1.0), weights[m.held] * m.c
        margin = y * scores[:, k]
        if m.loss == "hinge":
            short = np.maximum(1.0 - margin, 0.0)
            loss, slope, bend = short**2, -2.0 * short * y, np.where(short > 0, 2.0, 0.0)
        else:
            p = 1.0 / (1.0 + np.exp(margin))
            loss, slope, bend = np.logaddexp(0, -margin), -p * y, p * (1 - p)
        losses.append(weight @ loss)
        slopes[:, k] = weight * slope
        bend = weight * bend
        live = np.flatnonzero(bend)
        # A matrix times itself takes half the work, rows without weight none.
        curved = z[live] * np.sqrt(bend[live])[:, None]
        triangles.append((curved.T @ curved)[upper])
    return [np.concatenate([[loss], slope, triangle]) for loss, slope, triangle in zip(losses, (z.T @ slopes).T, triangles)]


def fit(
    stored: DataFrame, found: dict[tuple[int, int], Map], wanted: list[Machine], max_steps: int = MAX_STEPS, tolerance: float = 1e-6
) -> dict[Machine, tuple[np.ndarray, bool]]:
    """Weights of every machine (the last one is the intercept), and whether it converged.

    Rows weigh as scikit-learn's ``balanced``: all rows / (classes * rows of the
    class), over the rows that learn. A step that does not lower the objective is
    halved. A group that fits in one block is trained where the block is; for
    the others each step is one job, which converged machines leave.
    """
    sizes, spark = _class_sizes(stored), stored.sparkSession
    blocks_of = {r["cur"]: (r["count"], r["first"]) for r in stored.groupBy("cur").agg(F.count("*").alias("count"), F.min("block").alias("first")).collect()}  # one row per group
    many = {cur: n for cur, (n, _) in blocks_of.items() if n > 1}
    keys = sorted({(m.cur, m.kernel) for m in wanted})
    if not keys:
        return {}
    cores = spark.sparkContext.defaultParallelism
    listed = F.broadcast(spark.createDataFrame(keys, "cur int, kernel int"))  # groups times kernels
    is_first = F.struct("cur", "block").isin([F.struct(F.lit(cur).alias("cur"), F.lit(first).alias("block")) for cur, (_, first) in blocks_of.items()])
    spread = max(cores, min(4 * cores, len(keys)))
    firsts = materialize(listed.join(stored.where(is_first), "cur").repartition(spread, "cur", "kernel"), rows_a_group=BLOCKS_A_GROUP)
    whole = [m for m in wanted if m.cur not in many]
    begins = sorted({replace(m, held=NO_FOLD) for m in wanted if m.cur in many}, key=lambda m: (m.cur, m.kernel, m.label, m.loss, m.c))
    results = _newton_whole(firsts, found, whole, sizes, max_steps, tolerance) if whole else {}
    begun = _newton_whole(firsts, found, begins, sizes, max_steps, ROUGH, many) if begins else {}
    discard(firsts)
    rest = {n: _Search(begun[replace(m, held=NO_FOLD)][0]) for n, m in enumerate(wanted) if m.cur in many}
    if rest:
        tiles, enough = stored.where(F.col("cur").isin(list(many))), sum(many.values()) >= 4 * cores
        if not enough:
            # Neighbouring blocks of a group and map share a task, which adds up their sums.
            ranged = listed.join(tiles, "cur").repartitionByRange(spread, "cur", "kernel", "block")
            tiles = materialize(ranged, rows_a_group=BLOCKS_A_GROUP)
        for _ in range(max_steps):
            open_ = {n: s.trial for n, s in rest.items() if not s.done}
            if not open_:
                break
            for number, step in _newton(tiles, found, wanted, sizes, open_).items():
                rest[number].advance(*step, tolerance)
        if not enough:
            discard(tiles)
    return {m: (rest[n].best, rest[n].done) if n in rest else results[m] for n, m in enumerate(wanted)}


def _width(found: Map, stored: DataFrame, cur: int) -> int:
    if len(found.basis):
        return found.basis.shape[0] if found.kernel.kind == "rbf" else found.basis.shape[1]
    row = stored.where(F.col("cur") == cur).select("n", F.length("x").alias("bytes")).first()
    return row["bytes"] // 8 // row["n"]


def _class_sizes(stored: DataFrame) -> dict[tuple[int, int, int], int]:
    """Rows per group, class and fold."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs = np.stack([np.frombuffer(row["label"], np.int32), np.frombuffer(row["fold"], np.int32)])
                kinds, n = np.unique(pairs, axis=1, return_counts=True)
                columns = [pa.array(np.full(len(n), row["cur"], np.int32)), pa.array(kinds[0]), pa.array(kinds[1]), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names=["cur", "label", "fold", "n"])

    counts = stored.select("cur", "label", "fold").mapInArrow(count, "cur int, label int, fold int, n long").groupBy("cur", "label", "fold").agg(F.sum("n").alias("n"))
    return {(r["cur"], r["label"], r["fold"]): r["n"] for r in counts.collect()}  # groups times classes times folds


class _Search:
    """Newton's method with halving for one machine: ``trial`` is evaluated by the next job."""

    def __init__(self, start: np.ndarray) -> None:
        self.best, self.trial, self.value, self.direction, self.share, self.done = start, start, math.inf, None, 1.0, False

    def advance(self, value: float, slope: float, direction: np.ndarray, tolerance: float) -> None:
        """Takes the trial's objective, its Newton direction and the slope along it (not above zero)."""
        if value <= self.value or self.share < 1e-8:
            small = -slope <= tolerance * max(1.0, abs(value))
            self.best, self.value, self.direction, self.share = self.trial, value, direction, 1.0
            self.done = small or self.share < 1e-8
        else:
            self.share /= 2
            if self.share < 1e-8:
                self.done = True
                return
        self.trial = self.best + self.share * self.direction


def _weights(m: Machine, sizes: dict, label: np.ndarray, fold: np.ndarray) -> np.ndarray:
    counts: dict[int, int] = {}
    for (cur, kind, part), n in sizes.items():
        if cur == m.cur and (part != m.held or m.held == NO_FOLD):
            counts[kind] = counts.get(kind, 0) + n
    total, weight = sum(counts.values()), np.zeros(len(label))
    for kind, n in counts.items():
        weight[label == kind] = total / (len(counts) * n)
    if m.held != NO_FOLD:
        weight[fold == m.held] = 0.0
    return weight


def _parts(row: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Values, labels and folds of a block, some rows at a time."""
    x = np.frombuffer(row["x"]).reshape(row["n"], -1)
    label, fold = np.frombuffer(row["label"], np.int32), np.frombuffer(row["fold"], np.int32)
    for at in range(0, len(x), MAPPED_ROWS):
        some = slice(at, at + MAPPED_ROWS)
        yield x[some], label[some], fold[some]


def _mapped(x: np.ndarray, found: Map) -> np.ndarray:
    return np.concatenate([found(x), np.ones((len(x), 1))], axis=1)


def _step(sums: np.ndarray, w: np.ndarray) -> tuple[float, float, np.ndarray]:
    """Objective, slope and Newton direction at ``w`` from its sums over all rows; the intercept has no penalty."""
    d, plain = len(w), np.append(np.ones(len(w) - 1), 0.0)
    upper = np.zeros((d, d))
    upper[np.triu_indices(d)] = sums[d + 1 :]
    slope, bend = sums[1 : d + 1] + plain * w, upper + np.triu(upper, 1).T + np.diag(plain + 1e-9)
    direction = -np.linalg.solve(bend, slope)
    return float(sums[0] + 0.5 * (plain * w) @ w), float(slope @ direction), direction


def _newton_whole(tiles: DataFrame, found: dict, wanted: list[Machine], sizes: dict, max_steps: int, tolerance: float, blocks_of: dict | None = None) -> dict:
    """Machines trained to the end where a block is, which has all rows of its group, or one part in ``blocks_of``."""
    by_tile: dict[tuple[int, int], list[int]] = {}
    for number, m in enumerate(wanted):
        by_tile.setdefault((m.cur, m.kernel), []).append(number)
    shared = tiles.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                key = (batch["cur"][n].as_py(), batch["kernel"][n].as_py())
                if key not in by_tile:
                    continue
                [row] = batch.slice(n, 1).to_pylist()
                parts, times = list(_parts(row)), (blocks_of or {}).get(key[0], 1)
                mapped = [_mapped(x, shared.value[key]) for x, _, _ in parts]
                for number in by_tile[key]:
                    m, search = wanted[number], _Search(np.zeros(mapped[0].shape[1]))
                    weights = [{m.held: times * _weights(m, sizes, label, fold)} for _, label, fold in parts]
                    for _ in range(max_steps):
                        sums = [_sums([(m, search.trial)], z, label, w)[0] for z, (_, label, _), w in zip(mapped, parts, weights)]
                        search.advance(*_step(sum(sums), search.trial), tolerance)
                        if search.done:
                            break
                    arrays = [pa.array([number], pa.int32()), pa.array([search.best.tolist()]), pa.array([search.done])]
                    yield pa.RecordBatch.from_arrays(arrays, names=["number", "w", "done"])

    told = tiles.mapInArrow(run, "number int, w array<double>, done boolean").collect()
    shared.unpersist()
    return {wanted[r["number"]]: (np.array(r["w"]), r["done"]) for r in told}


def _newton(tiles: DataFrame, found: dict, wanted: list[Machine], sizes: dict, open_: dict[int, np.ndarray]) -> dict:
    """Objective, slope and Newton direction per open machine: one job over all blocks and maps.

    A tile is a block under one ``kernel``, or without that column under all of its group's.
    """
    by_cur: dict[int, dict[int, list[int]]] = {}
    for number in open_:
        by_cur.setdefault(wanted[number].cur, {}).setdefault(wanted[number].kernel, []).append(number)
    shared = tiles.sparkSession.sparkContext.broadcast((found, open_))  # maps and weights, as many as there are machines

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_maps, trials = shared.value
        held: dict[int, np.ndarray] = {}  # sums of the task's blocks, so that fewer are shuffled

        def told() -> Iterator[pa.RecordBatch]:
            for number, sums in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([sums.tobytes()])], names=["number", "sums"])
            held.clear()

        for batch in batches:
            for n in range(batch.num_rows):
                cur = batch["cur"][n].as_py()
                kernels = by_cur.get(cur, {})
                if "kernel" in batch.schema.names:
                    kernels = {k: own for k, own in kernels.items() if k == batch["kernel"][n].as_py()}
                if not kernels:
                    continue
                [row] = batch.slice(n, 1).to_pylist()  # a block is megabytes
                for x, label, fold in _parts(row):
                    weights = {}
                    for kernel, numbers in kernels.items():
                        z, own = _mapped(x, all_maps[cur, kernel]), [(wanted[number], trials[number]) for number in numbers]
                        weights.update({m.held: _weights(m, sizes, label, fold) for m, _ in own if m.held not in weights})
                        for number, sums in zip(numbers, _sums(own, z, label, weights)):
                            held[number] = held[number] + sums if number in held else sums
                if sum(x.nbytes for x in held.values()) > HELD_BYTES:
                    yield from told()
        yield from told()

    def solve(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, number = None, None
        for batch in group:
            for row in batch.to_pylist():
                part = np.frombuffer(row["sums"])
                sums, number = part if sums is None else sums + part, row["number"]
        value, slope, direction = _step(sums, shared.value[1][number])
        arrays = [pa.array([number], pa.int32()), pa.array([value]), pa.array([slope]), pa.array([direction.tolist()])]
        yield pa.RecordBatch.from_arrays(arrays, names=["number", "value", "slope", "direction"])

    summed = tiles.mapInArrow(parts, "number int, sums binary").groupBy("number")
    rows = summed.applyInArrow(solve, "number int, value double, slope double, direction array<double>").collect()
    shared.unpersist()
    return {r["number"]: (r["value"], r["slope"], np.array(r["direction"])) for r in rows}


def margins(
    rows: DataFrame, found: dict[tuple[int, int], Map], fitted: dict[Machine, tuple[np.ndarray, bool]], keep: list, held_out: bool = False
) -> DataFrame:
    """``(keep..., cur, kernel, label, margin)``: rows of ``(cur, x)`` under every machine of their group.

    With ``held_out`` a row is scored by the machines that left its ``fold`` out,
    otherwise by those that left none out. Rows of a group without machines have
    no margins.
    """
    by_cur: dict[int, list[tuple[Machine, np.ndarray]]] = {}
    for m, (w, _) in fitted.items():
        if held_out == (m.held != NO_FOLD):
            by_cur.setdefault(m.cur, []).append((m, w))
    [row] = unused(["cur", "x", "fold"], "row")
    fold = F.col("fold").cast("int") if held_out else F.lit(NO_FOLD)
    ready = rows.select(F.struct(*keep).alias(row), F.col("cur").cast("int").alias("cur"), F.col("x").cast("array<double>").alias("x"), fold.alias("fold"))
    added = [T.StructField(n, T.IntegerType()) for n in ("cur", "kernel", "label")]
    schema = T.StructType([ready.schema[row], *added, T.StructField("margin", T.DoubleType())])
    shared = rows.sparkSession.sparkContext.broadcast((found, by_cur))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_maps, every = shared.value
        for batch in batches:
            curs, folds = np.asarray(batch["cur"].fill_null(-99)), np.asarray(batch["fold"].fill_null(-99))
            for cur in set(curs.tolist()) & set(every):
                at = np.flatnonzero(curs == cur)
                x = np.asarray(batch["x"].take(pa.array(at)).flatten()).astype(float).reshape(len(at), -1)
                mapped = {k: np.concatenate([all_maps[cur, k](x), np.ones((len(at), 1))], axis=1) for k in {m.kernel for m, _ in every[cur]}}
                for m, w in every[cur]:
                    mine = np.flatnonzero(folds[at] == m.held) if held_out else np.arange(len(at))
                    if len(mine):
                        numbers = [pa.array(np.full(len(mine), v, np.int32)) for v in (cur, m.kernel, m.label)]
                        told = pa.array(mapped[m.kernel][mine] @ w)
                        yield pa.RecordBatch.from_arrays([batch[row].take(pa.array(at[mine])), *numbers, told], names=[row, "cur", "kernel", "label", "margin"])

    return ready.mapInArrow(run, schema).select(f"{row}.*", "cur", "kernel", "label", "margin")


def predicted(scored: DataFrame, key: list[str]) -> DataFrame:
    """``(key..., cur, kernel, prediction)``: the class with the highest margin, the smaller one of several."""
    best = F.max_by("label", F.struct(F.col("margin"), -F.col("label")))
    return scored.groupBy(*key, "cur", "kernel").agg(best.alias("prediction"))
