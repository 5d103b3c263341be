"""Transition matrices: counted, modelled, and over several months.

A loan's 1-month matrix is one row with a flat 81-slot array (row-major,
states -1..7), so horizons need no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanshift.functions.names import unused
from loanshift.functions.states import DEFAULT, LIVE_STATES, PREPAID, STATES, targets_of

SIZE = len(STATES)
_MATRIX = T.ArrayType(T.DoubleType())

# The 32-bit integer mixer (shifts and multipliers) behind path draws.
MIX_STEPS = [(16, 0x21F0AAAD), (15, 0x735A2D97), (15, 1)]
GOLDEN = 0x1E3779B9
MASK32 = 0xFFFFFFFF
#: Walks that a task takes at a time.
WALKS_AT_ONCE = 1 << 14


def transition_counts(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Count of each (current, next) pair of known states."""
    known = F.col("Current_Status").isin(STATES) & F.col("Next_Status").isin(STATES)
    return (
        df.where(known)
        .groupBy(*(by or []), F.col("Current_Status").alias("cur"), F.col("Next_Status").alias("nxt"))
        .agg(F.count("*").alias("n"))
    )


def transition_matrix(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Row-normalised counts on the full 9 x 9 grid; a state never left stays all zero.

    ``counts`` has at most 81 rows per cohort, gathered into one map and laid
    out again, so they are computed once. A null cohort is one like any other.
    """
    by = by or []
    seen, total = unused(by, "seen", "total")
    states = F.array(*[F.lit(s) for s in STATES])
    pairs = F.map_from_entries(F.collect_list(F.struct(F.struct("cur", "nxt"), F.col("n"))))
    cohorts = counts.groupBy(*by).agg(pairs.alias(seen))

    def moves(nxt: Column) -> Column:
        cell = F.struct(F.col("cur").alias("cur"), nxt.alias("nxt"))
        return F.coalesce(F.try_element_at(seen, cell), F.lit(0)).cast("bigint")

    rows = cohorts.select(*by, seen, F.explode(states).alias("cur"))
    rows = rows.withColumn(total, F.aggregate(F.transform(states, moves), F.lit(0).cast("bigint"), lambda a, n: a + n))
    cells = rows.select(*by, seen, total, "cur", F.explode(states).alias("nxt")).withColumn("n", moves(F.col("nxt")))
    share = F.coalesce(F.try_divide(F.col("n"), F.col(total)), F.lit(0.0))
    return cells.select(*by, "cur", "nxt", "n", share.alias("p"))


def state_distribution(matrix: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Incoming mass per state (column sums) and the observed share of moves into it."""
    by = by or []
    incoming = matrix.groupBy(*by, F.col("nxt").alias("state")).agg(
        F.sum("p").alias("incoming"), F.sum("n").alias("n")
    )
    # Nine rows per cohort.
    moves = F.sum("n").over(Window.partitionBy(*(by or [F.lit(0)])))
    return incoming.select(*by, "state", "incoming", F.try_divide(F.col("n"), moves).alias("share"))


def pad_states(long: DataFrame, key: list[str]) -> DataFrame:
    """Probabilities of one current state as 9 slots by label, absent targets 0.

    ``long`` is (key..., nxt, p); aggregated map-side, at most 9 values per key.
    """
    slots = [F.coalesce(F.sum(F.when(F.col("nxt") == s, F.col("p"))), F.lit(0.0)) for s in STATES]
    return long.groupBy(*key).agg(F.array(*slots).alias("slots"))


def loan_matrices(long: DataFrame, key: str = "Loan_ID", missing: str = "stay") -> DataFrame:
    """1-month matrix per loan from (key, cur, nxt, p); -1 and 7 absorb.

    Rows are summed into 9 slots per (loan, current state) first, so a loan
    brings at most 7 values to its own group. A live state without a row, or
    with one of zeros, keeps its mass (``missing="stay"``) or is an error
    (``missing="error"``).
    """
    if missing not in ("error", "stay"):
        raise ValueError(f"unknown rule {missing!r}")
    rows = pad_states(long.where(F.col("cur").isin(LIVE_STATES)), [key, "cur"])
    by_state = F.map_from_entries(F.collect_list(F.struct("cur", "slots")))

    def without(state: int) -> Column:
        if missing == "stay":
            return F.array(*absorbing(state))
        return F.raise_error(F.lit(f"a matrix has no row for state {state}")).cast(_MATRIX)

    def row(state: int) -> Column:
        found = F.try_element_at("_rows", F.lit(state))
        return F.when(F.exists(found, lambda p: p > 0), found).otherwise(without(state))

    live = [row(c) for c in LIVE_STATES]
    whole = F.concat(F.array(*absorbing(PREPAID)), *live, F.array(*absorbing(DEFAULT)))
    return rows.groupBy(key).agg(by_state.alias("_rows")).select(key, whole.alias("matrix"))


def absorbing(state: int) -> list[Column]:
    return [F.lit(1.0 if s == state else 0.0) for s in STATES]


def flat_matrices(stacked: np.ndarray) -> pa.Array:
    """Matrices as lists of their 81 slots."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(stacked) + 1, dtype=np.int32) * (SIZE * SIZE)), pa.array(stacked.ravel()))


def matrix_power(matrices: DataFrame, months: int, column: str = "matrix") -> DataFrame:
    """Every loan's ``months``-step matrix, by repeated squaring of Arrow batches."""

    @F.arrow_udf(_MATRIX)
    def power(cells: pa.Array) -> pa.Array:
        if cells.null_count:
            raise ValueError("a matrix is null")
        stacked = cells.flatten().to_numpy(zero_copy_only=False).reshape(-1, SIZE, SIZE)
        return flat_matrices(np.linalg.matrix_power(stacked, months))

    return matrices.withColumn(column, power(F.col(column)))


def horizon_row(matrices: DataFrame, state: int, key: str = "Loan_ID", column: str = "matrix") -> DataFrame:
    """Long rows (key, nxt, p) of one current state."""
    start = STATES.index(state) * SIZE + 1
    row = F.slice(F.col(column), start, SIZE)
    return matrices.select(key, F.posexplode(row).alias("_i", "p")).select(
        key, (F.col("_i") + STATES[0]).alias("nxt"), "p"
    )


def matrix_cells(matrices: DataFrame, key: str = "Loan_ID", column: str = "matrix") -> DataFrame:
    """Long rows (key, cur, nxt, p) of the whole matrix."""
    at = F.col("_i")
    return matrices.select(key, F.posexplode(column).alias("_i", "p")).select(
        key,
        (F.floor(at / SIZE) + STATES[0]).cast("int").alias("cur"),
        (at % SIZE + STATES[0]).cast("int").alias("nxt"),
        "p",
    )


def mixed(counter: Column) -> Column:
    """A 32-bit integer hash of a 32-bit counter, in plain bigint arithmetic."""
    x = counter
    for shift, factor in MIX_STEPS:
        x = x.bitwiseXOR(F.shiftright(x, shift))
        if factor != 1:
            x = (x * F.lit(factor)).bitwiseAND(F.lit(MASK32))
    return x


def path_base(key: Column, seed: int) -> Column:
    """32-bit start of a loan's random stream."""
    text = F.concat_ws("|", key.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _mixed(x: np.ndarray) -> np.ndarray:
    """``mixed`` on 32-bit numbers, whose arithmetic wraps around as the mask does; in place."""
    for shift, factor in MIX_STEPS:
        x ^= x >> np.uint32(shift)
        if factor != 1:
            x *= np.uint32(factor)
    return x


def _walked(cells: np.ndarray, known: np.ndarray, base: np.ndarray, start: int, months: int, paths: range) -> np.ndarray:
    """Paths of every loan that end in each of the nine states, or (the tenth number) meet a row with a null.

    ``cells`` are (loans, 81) with ``known`` flags, ``base`` starts of the random
    streams. A path leaves the arrays in a row that keeps all of its mass.
    """
    loans, rows = len(base), len(base) * SIZE
    upto = np.cumsum(cells.reshape(rows, SIZE), axis=1)
    null = ~known.reshape(rows, SIZE).all(axis=1)
    own = np.arange(rows) % SIZE
    keeps = (upto == (np.arange(SIZE) >= own[:, None])).all(axis=1)
    ended, final = keeps | null, np.where(null, SIZE, own)
    whole, edges = upto[:, -1].copy(), upto.T[:-1].copy()
    first = np.repeat(np.arange(loans) * SIZE, len(paths))
    at = first + start
    step = np.tile(np.arange(paths.start, paths.stop).astype(np.uint32) * np.uint32(months), loans)
    counter = np.repeat(base.astype(np.uint32), len(paths)) + step * np.uint32(GOLDEN)
    found = np.zeros((loans, SIZE + 1), np.int64)

    def tell(places: np.ndarray, slots: np.ndarray) -> None:
        found.ravel()[:] += np.bincount(places // SIZE * (SIZE + 1) + slots, minlength=found.size)

    for month in range(months):
        done = ended[at]
        if done.any():
            tell(at[done], final[at[done]])
            on = ~done
            first, at, counter = first[on], at[on], counter[on]
        # Scaled by the row total, so rounding in the sums cannot leave the row.
        drawn = _mixed(counter + np.uint32(month * GOLDEN & MASK32)) / float(MASK32 + 1) * whole[at]
        passed = np.zeros(len(at), np.int8)
        for edge in edges:
            passed += edge[at] <= drawn
        passed[np.isnan(drawn)] = SIZE - 1  # NaN is above every number in Spark's order
        at = first + passed
    tell(at, at % SIZE)
    return found


def sampled_horizon(
    matrices: DataFrame, state: int, months: int = 6, paths: int = 10_000, seed: int = 1, key: str = "Loan_ID"
) -> DataFrame:
    """Share of ``paths`` random walks ending in each state after ``months``, per loan.

    Draws come from a counter hash of (loan, path, month), so a rerun or
    another partitioning walks the same paths. Walks of a batch of loans go
    together as arrays; a loan leaves its task as at most 10 counts.
    """
    nothing = F.array_repeat(F.lit(None).cast("double"), SIZE * SIZE)
    cells = F.coalesce(F.col("matrix").cast(_MATRIX), nothing).alias("cells")
    ready = matrices.select(F.col(key).alias("key"), cells, path_base(F.col(key), seed).alias("base"))
    at_once, start = max(1, WALKS_AT_ONCE // max(1, paths)), STATES.index(state)
    schema = T.StructType([ready.schema["key"], T.StructField("nxt", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch["cells"].flatten()
            values = flat.to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            known = flat.is_valid().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            base, counts = np.asarray(batch["base"]), []
            for k in range(0, batch.num_rows, at_once):
                some = slice(k, k + at_once)
                parts = (range(p, min(p + WALKS_AT_ONCE, paths)) for p in range(0, paths, WALKS_AT_ONCE))
                counts.append(sum(_walked(values[some], known[some], base[some], start, months, part) for part in parts))
            counts = np.concatenate(counts)
            loan, slot = np.nonzero(counts)
            nxt = pa.array(slot + STATES[0], pa.int32(), mask=slot == SIZE)
            yield pa.RecordBatch.from_arrays([batch["key"].take(pa.array(loan)), nxt, pa.array(counts[loan, slot])], names=["key", "nxt", "n"])

    ends = ready.mapInArrow(run, schema).groupBy(F.col("key").alias(key), "nxt").agg(F.sum("n").alias("n"))
    return ends.withColumn("p", F.col("n") / paths)


def horizon(
    matrices: DataFrame, state: int = 0, months: int = 6, method: str = "paths", paths: int = 10_000,
    full: bool = False, key: str = "Loan_ID",
) -> DataFrame:
    """Horizon distribution by sampled ``paths`` or exact ``power`` (``full``: all current states)."""
    if method == "paths":
        return sampled_horizon(matrices, state, months, paths, key=key).select(key, "nxt", "p")
    if method == "power":
        powered = matrix_power(matrices, months)
        return matrix_cells(powered, key) if full else horizon_row(powered, state, key)
    raise ValueError(f"unknown method {method!r}")


def legal_cells() -> list[tuple[int, int]]:
    return [(c, n) for c in LIVE_STATES for n in targets_of(c)]
