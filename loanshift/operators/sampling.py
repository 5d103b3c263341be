"""Row sampling and splits decided by a hash of the key.

No shuffle, no shared random state: a row is in or out by itself, so results
hold under any partitioning and a retried task repeats its choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanshift.functions.names import unused
from loanshift.functions.scalars import UNIFORM_RANGE, sampled, uniform_int

# Share kept per current state, and seeds.
STATE_FRACTIONS = {0: 0.0005, 1: 0.05, 2: 0.2, 3: 0.2, 4: 0.2, 5: 0.2, 6: 0.2}
SAMPLE_SEED = 601
SPLIT_SEED = 123
# Differs from the split's, or folds of the training part would miss the draws the test part took.
FOLD_SEED = 321
#: Bits of the 32 by which draws are counted, pass by pass.
DRAW_BITS = (11, 11, 10)
ROW_KEY = ["Loan_ID", "Act_Period"]


def _key(df: DataFrame, key: list[str] | None):
    names = key or [*ROW_KEY, *(["Seq"] if "Seq" in df.columns else [])]
    return [F.col(k) for k in names]


def sample_by_state(
    df: DataFrame,
    fractions: dict[int, float] | None = None,
    seed: int = SAMPLE_SEED,
    key: list[str] | None = None,
    state: str = "Current_Status",
) -> DataFrame:
    """Keep about ``fractions[state]`` of the rows of each state."""
    return df.where(in_sample(df, fractions, seed, key, state))


def in_sample(
    df: DataFrame,
    fractions: dict[int, float] | None = None,
    seed: int = SAMPLE_SEED,
    key: list[str] | None = None,
    state: str = "Current_Status",
) -> Column:
    """The sampling decision as a column; it needs nothing but the row itself."""
    fractions = STATE_FRACTIONS if fractions is None else fractions
    fraction = F.lit(0.0)
    for value, share in fractions.items():
        fraction = F.when(F.col(state) == value, F.lit(share)).otherwise(fraction)
    return sampled(_key(df, key), fraction, seed)


def sample_exactly(
    df: DataFrame, fractions: dict[int, float] | None = None, seed: int = SAMPLE_SEED, key: list[str] | None = None,
    state: str = "Current_Status", strata: tuple[str, ...] = ("Current_Status", "Next_Status"),
) -> DataFrame:
    """Of every stratum exactly ``round(fractions[state] * rows)`` rows (half to even): those with the lowest draws.

    The draw that ends a stratum is found by counting draws in ever finer bins, a
    bounded number of counts a pass; rows then decide for themselves. Rows that
    share that draw are taken in the order of their key. ``strata`` must have few
    values and include ``state``; null is a stratum of its own, and a state
    without a fraction gives no row.
    """
    fractions = STATE_FRACTIONS if fractions is None else fractions
    names = unused(df.columns, "draw", "limit", "among", "at", *strata)
    draw, limit, among, at, own = *names[:4], dict(zip(strata, names[4:]))
    drawn = df.withColumn(draw, uniform_int(_key(df, key), seed))
    counts = drawn.groupBy(*strata).count().collect()  # one row per stratum
    wanted = {tuple(r[s] for s in strata): round(fractions.get(r[state], 0.0) * r["count"]) for r in counts}
    left = {stratum: (0, n) for stratum, n in wanted.items() if n}
    if not left:
        return df.limit(0)
    below = 32
    for bits in DRAW_BITS:
        below -= bits
        prefixes = df.sparkSession.createDataFrame([(*s, prefix) for s, (prefix, _) in left.items()], _limits(df, strata, own, limit))
        inside = _match(strata, own) & (F.shiftright(draw, below + bits) == F.col(limit))
        held = drawn.select(*strata, draw).join(F.broadcast(prefixes), inside)  # one row per stratum
        table = held.groupBy(*strata, F.shiftright(draw, below).alias(at)).count().collect()  # strata times bins
        for stratum, (_, n) in left.items():
            for value, size in sorted((r[at], r["count"]) for r in table if tuple(r[s] for s in strata) == stratum):
                if n <= size:
                    left[stratum] = (value, n)
                    break
                n -= size
    rows = [(*s, value, n) for s, (value, n) in left.items()]
    ends = df.sparkSession.createDataFrame(rows, T.StructType([*_limits(df, strata, own, limit), T.StructField(among, T.LongType())]))
    placed = drawn.join(F.broadcast(ends), _match(strata, own))
    certain = placed.where(F.col(draw) < F.col(limit)).select(*[F.col(f"`{c}`") for c in df.columns])
    # Rows of one draw: as few as keys that share a hash.
    same = Window.partitionBy(*strata).orderBy(*_key(df, key))
    tied = placed.where(F.col(draw) == F.col(limit)).withColumn(at, F.row_number().over(same))
    return certain.unionByName(tied.where(F.col(at) <= F.col(among)).select(*[F.col(f"`{c}`") for c in df.columns]))


def _limits(df: DataFrame, strata, own: dict[str, str], limit: str) -> T.StructType:
    return T.StructType([*[T.StructField(own[s], df.schema[s].dataType) for s in strata], T.StructField(limit, T.LongType())])


def _match(strata, own: dict[str, str]) -> Column:
    match = F.lit(True)
    for s in strata:
        match = match & F.col(s).eqNullSafe(F.col(own[s]))
    return match


def with_split(df: DataFrame, test_share: float = 0.2, seed: int = SPLIT_SEED, key: list[str] | None = None) -> DataFrame:
    """Add ``split``: ``test`` for about ``test_share`` of the rows, else ``train``."""
    return df.withColumn("split", F.when(sampled(_key(df, key), test_share, seed), "test").otherwise("train"))


def train_test(df: DataFrame, test_share: float = 0.2, seed: int = SPLIT_SEED, key: list[str] | None = None):
    parts = with_split(df, test_share, seed, key)
    return tuple(parts.where(F.col("split") == s).drop("split") for s in ("train", "test"))


def with_fold(df: DataFrame, folds: int = 5, seed: int = FOLD_SEED, key: list[str] | None = None) -> DataFrame:
    """Add ``fold`` in [0, folds); hashing keeps each class spread over the folds."""
    draw = F.floor(uniform_int(_key(df, key), seed) * folds / UNIFORM_RANGE)
    return df.withColumn("fold", draw.cast("int"))
