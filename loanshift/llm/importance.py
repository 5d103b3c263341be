"""Importance resampling towards a target corpus, by hashed counts of word runs.

Words come from an untrained ``Split`` pre-tokeniser of the tokenizers library,
with their offsets; a run of words is the text between the first offset of one
word and the last of another. Runs fall into buckets by CRC-32, and a bucket's
gain is the log ratio of its smoothed shares in the target and in the corpus
(Xie et al., 2023). A document weighs the sum of the gains of its runs; with a
Gumbel draw by id added, the highest scores are a sample without replacement.

Each text is cut once: the buckets of its runs are stored, the histogram is
summed from them, and weights are looked up in them. Ranks come from a range
partitioning of the scores, so no task holds more than its range.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanshift.llm.text import by_text, local_table
from loanshift.session import materialize

#: Fixed value: letters a-z, digits and every code point past ASCII, after A-Z were lowered.
WORD_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
BUCKETS, SHARE, MIN_WORDS, SEED = 10_000, 10, 20, "2024"
#: Characters that the pre-tokeniser gets at a time, which bounds memory on long texts.
AT_ONCE = 100_000
BETWEEN = re.compile(WORD_CLASS.replace("[^", "[") + "+")
MEASURES = "doc_id long, n_words long, n_features long, buckets binary"


@lru_cache(maxsize=1)
def _splitter():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD_CLASS + "+"), "removed", invert=True)


def words_with_offsets(text: str) -> Iterator[list[tuple[str, tuple[int, int]]]]:
    """Words of ``text`` with their code point offsets, in parts of about ``AT_ONCE`` that cut no word."""
    split, start = _splitter().pre_tokenize_str, 0
    while start < len(text):
        gap = BETWEEN.search(text, start + AT_ONCE)
        end = gap.end() if gap else len(text)
        part = text if end - start == len(text) else text[start:end]
        yield [(word, (a + start, b + start)) for word, (a, b) in split(part)] if start else split(part)
        start = end


def run_buckets(text: str, longest: int, buckets: int) -> tuple[int, list[int]]:
    """Number of words, and the bucket of every run of 1 to ``longest`` words (words joined by one space)."""
    crc, found, n, before = zlib.crc32, [], 0, []
    for part in words_with_offsets(text):
        n += len(part)
        found += [crc(word.encode()) % buckets for word, _ in part]
        if longest == 1:
            continue
        spans = before + [span for _, span in part]
        for size in range(2, longest + 1):
            # Runs that end in this part; those before it were counted there.
            ends = range(max(size - 1, len(before)), len(spans))
            for k in ends:
                run = BETWEEN.sub(" ", text[spans[k - size + 1][0] : spans[k][1]])
                found.append(crc(run.encode()) % buckets)
        before = spans[len(spans) - longest + 1 :] if len(spans) >= longest else spans
    return n, found


def measured(docs: DataFrame, longest: int = 1, buckets: int = BUCKETS, keep: list[str] | None = None) -> DataFrame:
    """Per row its id, counts and buckets; ``keep`` columns travel along as a struct ``row``."""
    width = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")
    wanted = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text")]
    names = ["doc_id", "n_words", "n_features", "buckets"]
    fields = T.StructType.fromDDL(MEASURES).fields
    if keep is not None:
        wanted.append(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"))
        fields = [*fields, T.StructField("row", T.StructType([docs.schema[c] for c in keep]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in by_text(batch)):
            counts, sizes, held = [], [], []
            for text in batch["text"].to_pylist():
                n, found = run_buckets((text or "").encode().lower().decode(), longest, buckets)
                counts.append(n)
                sizes.append(len(found))
                held.append(np.array(found, width).tobytes())
            columns = [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(held, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                columns + ([batch["row"]] if keep is not None else []), names=names + (["row"] if keep is not None else [])
            )

    return docs.select(*wanted).mapInArrow(run, T.StructType(fields))


def histogram(rows: DataFrame, buckets: int) -> np.ndarray:
    """Runs per bucket over all measured rows: one partial histogram per task, summed by bucket."""
    width = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in batch["buckets"]:
                total += np.bincount(np.frombuffer(raw.as_buffer(), width), minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["bucket", "n"])

    parts = rows.select("buckets").mapInArrow(run, "bucket long, n long")
    found = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():  # buckets rows at most
        found[bucket] = n
    return found


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 * log((t + 1) (S + B) / ((s + 1) (T + B))))`` per bucket, in doubles."""
    above, below = float(int(source.sum()) + len(source)), float(int(target.sum()) + len(target))
    pairs = zip(source.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1.0) * above / ((s + 1.0) * below))) for s, t in pairs], np.int64)


def _gumbel(seed: str, doc_id: int | None) -> int:
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(rows: DataFrame, gain: np.ndarray, seed: str = SEED) -> DataFrame:
    """Measured rows with ``weight`` and ``score`` in place of their buckets."""
    width = "<u2" if len(gain) <= 1 << 16 else "<u4"
    # As many numbers as there are buckets.
    shared = rows.sparkSession.sparkContext.broadcast(gain)
    kept = [c for c in rows.columns if c != "buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [int(shared.value[np.frombuffer(raw.as_buffer(), width)].sum()) for raw in batch["buckets"]]
            scores = [w + _gumbel(seed, d) for w, d in zip(found, batch["doc_id"].to_pylist())]
            added = [pa.array(found, pa.int64()), pa.array(scores, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *added], names=[*kept, "weight", "score"])

    fields = [rows.schema[c] for c in kept]
    numbers = [T.StructField(c, T.LongType()) for c in ("weight", "score")]
    return rows.mapInArrow(run, T.StructType([*fields, *numbers]))


def ranked(rows: DataFrame, share: int, min_words: int) -> DataFrame:
    """Stored ``rows (doc_id, n_words, score, place)`` with ``rank`` 1, 2, ... for the drawn ones, else null.

    ``place`` tells all rows apart and decides between rows alike in score and id.
    """
    enough = rows.where(F.col("n_words") >= min_words).select("score", "doc_id", "place")
    wanted = share * enough.count() // 100
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("place").asc()]
    # Written, so that the range a row is in is a fact in the data.
    ranges = materialize(enough.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()))
    before, offsets = 0, []
    for part, n in sorted(ranges.groupBy("range").count().collect()):  # one row per range
        if before < wanted:
            offsets.append({"range": part, "before": before})
        before += n
    starts = local_table(rows.sparkSession, offsets, "range: int, before: bigint")
    drawn = ranges.join(F.broadcast(starts), "range")
    drawn = drawn.withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("range").orderBy(*order)))
    drawn = drawn.where(F.col("rank") <= wanted).select("place", "rank")
    return rows.join(drawn, "place", "left").drop("place")


def resample(
    docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, share: int = SHARE,
    min_words: int = MIN_WORDS, seed: str = SEED, keep: list[str] | None = None,
) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)`` per row of ``docs (doc_id, text)``.

    Counts are over all of ``docs`` and all of ``target (text)``. Of the rows
    with at least ``min_words`` words, ``share`` percent (rounded down) with the
    highest score have a ``rank``; ties go to the smaller doc_id, and a row
    without one draws for the empty id and comes after all others. Null and
    empty texts have no runs and weigh 0; repeated rows count, and are drawn, one
    by one. With an empty target all its counts are 0. ``keep`` columns come
    back as the struct ``row``.
    """
    rows = materialize(measured(docs, longest, buckets, keep))
    of_target = histogram(measured(target.select(F.lit(None).alias("doc_id"), "text"), longest, buckets), buckets)
    found = weighted(rows, gains(histogram(rows, buckets), of_target), seed)
    return ranked(materialize(found.withColumn("place", F.monotonically_increasing_id())), share, min_words)


def draw(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn rows of ``docs``, with its own columns; cases as in ``resample``."""
    return resample(docs, target, keep=docs.columns, **settings).where(F.col("rank").isNotNull()).select("row.*")
