"""Substring deduplication: repeated word windows found at one length are extended to twice that length.

Level one looks at windows of half the wanted length. Not at all of them: in
every full window the half window of smallest hash stands for it, which depends
on the words alone, so equal full windows are stood for by equal half windows.
Only where a half window repeats in another document is the full window hashed
(128 bits) and compared; ``grow`` goes on doubling from there. Hashes of longer
windows are mixed from those of two shorter ones.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanshift.llm.text import fresh, map_batches, words_of
from loanshift.session import discard, materialize

WINDOW = 13
WORD = re.compile(r"[^\x20\x09-\x0D]+")
U = np.uint64
#: Odd multipliers and an offset of the mixing step; any would do.
FIRST, SECOND, SHIFT = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x632BE59BD9B4E019)
KEY = "doc_id long, th long"


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * FIRST) ^ ((b + SHIFT) * SECOND)
    return x ^ (x >> U(29))


def _hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position, by doubling; shorter by ``length - 1``."""
    found, have = words, 1
    while have < length:
        step = min(have, length - have)
        found, have = _mix(found[:-step], found[step:]), have + step
    return found


def _least(values: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """Smallest (or by ``pick``) of ``width`` values from each position on."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values, have = pick(values[:-step], values[step:]), have + step
    return values


def _starts_inside(lengths: list[int], window: int) -> np.ndarray:
    """Whether the window from each position of texts laid end to end stays in its text."""
    total = sum(lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(total)
    return left >= window


class _Laid:
    """Word hashes of several texts end to end, with full windows and the half windows that stand for them."""

    def __init__(self, texts: list[list[bytes]], window: int, seed: int = 0) -> None:
        self.lengths = [len(w) for w in texts]
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        digest = xxhash.xxh64_intdigest
        self.words = np.fromiter((digest(w, seed) for t in texts for w in t), dtype=np.uint64, count=int(self.offsets[-1]))
        self.window, self.half = window, -(-window // 2)
        self.full = _starts_inside(self.lengths, window)[: max(0, len(self.words) - window + 1)]
        self.halves = _hashes(self.words, self.half) if len(self.words) >= window else np.empty(0, U)
        self.lows = _least(self.halves, window - self.half + 1)

    def standing(self) -> np.ndarray:
        """Positions of half windows that stand for a full one (all of them, where hashes tie)."""
        reach = self.window - self.half
        lows = np.where(self.full, self.lows, U(0))
        padded = np.concatenate([np.zeros(reach, U), lows, np.zeros(reach, U)])
        return np.flatnonzero((_least(padded, reach + 1, np.maximum) == self.halves) & (self.halves > 0))

    def stood_for(self, chosen: np.ndarray) -> np.ndarray:
        """Positions of full windows that one of the ``chosen`` half windows stands for."""
        marked = np.full(len(self.halves), U(2**64 - 1))
        marked[chosen] = self.halves[chosen]
        return np.flatnonzero(self.full & (_least(marked, self.window - self.half + 1) == self.lows))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def seeds(docs: DataFrame, window: int) -> DataFrame:
    """Level one: ``(h, doc_id, at)``, the half windows that stand for full ones."""

    def on_batch(batch: pa.RecordBatch):
        laid = _Laid([words_of(t) for t in batch["text"].to_pylist()], window)
        if len(laid.halves):
            at = laid.standing()
            doc = np.searchsorted(laid.offsets, at, side="right") - 1
            places = (at - laid.offsets[doc]).astype(np.int32)
            arrays = [_signed(laid.halves[at]), pa.array(np.asarray(batch["doc_id"])[doc]), pa.array(places)]
            yield pa.RecordBatch.from_arrays(arrays, names=["h", "doc_id", "at"])

    return map_batches(docs.select("doc_id", "text"), "h long, doc_id long, at int", on_batch)


def full_windows(docs: DataFrame, window: int) -> DataFrame:
    """Level two: ``(ha, hb, doc_id, th, at)`` of the full windows that the repeated half windows ``seeds`` stand for.

    Rows whose text hash is in ``copies`` are left out.
    """

    def on_batch(batch: pa.RecordBatch):
        ids, hashes = np.asarray(batch["doc_id"]), np.asarray(batch["th"])
        chosen, skipped = batch["seeds"].to_pylist(), batch["copies"].to_pylist()
        texts = [
            [] if th in (skip or ()) else words_of(t) for t, th, skip in zip(batch["text"].to_pylist(), hashes, skipped)
        ]
        laid = _Laid(texts, window)
        if not len(laid.halves):
            return
        # Positions come from all rows of a doc_id: those past the end belong to a longer one.
        marked = [np.array(m, np.int64) for m in chosen]
        marked = [m[m <= n - laid.half] + off for m, n, off in zip(marked, laid.lengths, laid.offsets)]
        at = laid.stood_for(np.concatenate(marked))
        doc = np.searchsorted(laid.offsets, at, side="right") - 1
        again = _Laid(texts, window, seed=1).words
        arrays = [
            _signed(_hashes(laid.words, window)[at]), _signed(_hashes(again, window)[at]),
            pa.array(ids[doc]), pa.array(hashes[doc]), pa.array((at - laid.offsets[doc]).astype(np.int32)),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["ha", "hb", "doc_id", "th", "at"])

    wanted = docs.select("doc_id", "th", "text", "seeds", "copies")
    return map_batches(wanted, f"ha long, hb long, {KEY}, at int", on_batch)


def _keyed(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, text)`` of the rows with an id; ``th`` tells rows of one doc_id apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64(text).alias("th"), text.alias("text")).where("doc_id is not null")


def copies(docs: DataFrame) -> DataFrame:
    """``(doc_id, th)`` of rows whose whole text a smaller doc_id has too."""
    rows = materialize(_keyed(docs).select("doc_id", "th", F.md5("text").alias("digest")))
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("last > first")
    return materialize(rows.join(materialize(first), "digest").where("doc_id > first").select("doc_id", "th").distinct())


def occurrences(docs: DataFrame, copied: DataFrame, window: int = WINDOW) -> DataFrame:
    """Stored ``(ha, hb, doc_id, th, at)``: every window that may repeat, without those of exact copies."""
    keyed = _keyed(docs)
    level = materialize(seeds(keyed, window))
    # Stored, so that the join meets plain shuffles and can split a hash that very many documents share.
    spread = level.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    spread = materialize(spread.select("h"))
    repeated = level.join(spread, "h", "left_semi")
    # A set of positions: as long as the longest text of the doc_id, however many rows share the id.
    marked = repeated.groupBy("doc_id").agg(F.collect_set("at").alias("seeds"))
    skipped = copied.groupBy("doc_id").agg(F.collect_set("th").alias("copies"))
    marked = materialize(marked.join(skipped, "doc_id", "left"))
    discard(level, spread)
    found = materialize(full_windows(keyed.join(marked, "doc_id"), window))
    discard(marked)
    return found


def later_windows(found: DataFrame) -> DataFrame:
    """``(doc_id, th, at)`` of the windows that also start in a document with a smaller doc_id."""
    first = found.groupBy("ha", "hb").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    first = materialize(first.select("ha", "hb", "first"))
    return found.join(first, ["ha", "hb"]).where("doc_id > first").select("doc_id", "th", "at")


def grow(found: DataFrame, length: int) -> Iterator[tuple[int, DataFrame]]:
    """From windows of ``length``, yield ``(2 ** k * length, (ha, hb, doc_id, th, at))`` while any repeats.

    A window of twice the length is two that follow each other, both repeated.
    Each yielded table is stored until the next is asked for. Ends by itself:
    no window is longer than its text.
    """
    spread = ["ha", "hb"]
    current = found
    while True:
        repeated = current.groupBy(*spread).agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x < y")
        survivors = materialize(current.join(repeated.select(*spread), spread, "left_semi"))
        if survivors.isEmpty():
            discard(survivors)
            return
        yield length, survivors
        ahead = survivors.select("doc_id", "th", (F.col("at") - length).alias("at"), F.col("ha").alias("na"), F.col("hb").alias("nb"))
        joined = survivors.join(ahead, ["doc_id", "th", "at"]).select(
            F.xxhash64("ha", "na").alias("ha"), F.xxhash64("hb", "nb", F.lit(1)).alias("hb"), "doc_id", "th", "at"
        )
        length, current = 2 * length, materialize(joined)
        discard(survivors)


def removals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Stored ``(doc_id, th, starts, whole)`` of rows that lose words: from the windows at ``starts``, or all as a copy."""
    copied = copies(docs)
    found = occurrences(docs, copied, window)
    starts = later_windows(found).groupBy("doc_id", "th").agg(F.collect_set("at").alias("starts"))
    whole = copied.select("doc_id", "th", F.array().cast("array<int>").alias("starts"), F.lit(True).alias("whole"))
    stored = materialize(starts.withColumn("whole", F.lit(False)).unionByName(whole))
    discard(found)
    return stored


def covered(n_words: int, starts: list[int] | None, whole: bool | None, window: int) -> np.ndarray:
    """Which words the windows cover; a copy loses all, if it has a window at all."""
    if whole:
        return np.full(n_words, n_words >= window)
    change = np.zeros(n_words + 1, np.int32)
    if starts is not None and len(starts):
        at = np.array(starts)
        np.add.at(change, at, 1)
        np.add.at(change, at + window, -1)
    return np.cumsum(change[:n_words]) > 0


def _with_removals(docs: DataFrame, window: int) -> DataFrame:
    """``docs`` and, as its last two columns, the removals; rows without a doc_id match nothing."""
    own_id, own_th, starts, whole = fresh(docs.columns, "id", "th", "starts", "whole")
    gone = removals(docs, window).toDF(own_id, own_th, starts, whole)
    own = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    joined = docs.join(gone, (F.col("doc_id").cast("bigint") == F.col(own_id)) & (own == F.col(own_th)), "left")
    return joined.drop(own_id, own_th)


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` per row of ``docs (doc_id, text)``.

    A word goes if a window over it also starts in a document with a smaller
    doc_id. Null text has no words. Rows of the same doc_id do not count as
    earlier than each other; rows without an id lose nothing and cause nothing.
    """

    def on_batch(batch: pa.RecordBatch):
        texts, starts, wholes = (batch.column(k).to_pylist() for k in (1, 2, 3))
        n_words, n_removed, kept = [], [], []
        for text, at, whole in zip(texts, starts, wholes):
            words = words_of(text)
            if at is not None or whole:
                gone = covered(len(words), at, whole, window)
                left = [w for w, g in zip(words, gone.tolist()) if not g]
            else:
                left = words
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            kept.append(hashlib.sha256(b" ".join(left)).hexdigest())
        arrays = [batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    joined = _with_removals(docs.select(F.col("doc_id").cast("bigint"), "text"), window)
    return map_batches(joined, "doc_id long, n_words long, n_removed long, kept_sha256 string", on_batch)


def cut(text: str, gone: np.ndarray) -> str:
    """``text`` without the words that are gone and the white space after each."""
    spans = [m.span() for m in WORD.finditer(text)]
    parts, at = [], 0
    for k, (start, _) in enumerate(spans):
        if gone[k]:
            parts.append(text[at:start])
            at = spans[k + 1][0] if k + 1 < len(spans) else len(text)
    return "".join([*parts, text[at:]])


def drop_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated words cut from ``text`` and all other columns as they are.

    Every row stays, as empty text if all its words repeat; ``n_chars``, where
    there is such a column, is counted anew. Texts that lose nothing (nulls
    among them) are not touched. Cases are defined as in ``digests``.
    """
    joined = _with_removals(docs, window)
    where = joined.schema.names.index("text")

    def on_batch(batch: pa.RecordBatch):
        texts, starts, wholes = (batch.column(k).to_pylist() for k in (where, -2, -1))
        changed = [
            t if t is None or (at is None and not whole) else cut(t, covered(len(words_of(t)), at, whole, window))
            for t, at, whole in zip(texts, starts, wholes)
        ]
        kept = batch.schema.names[:-2]
        arrays = [pa.array(changed, pa.string()) if k == where else batch.column(k) for k in range(len(kept))]
        yield pa.RecordBatch.from_arrays(arrays, names=kept)

    result = map_batches(joined, docs.schema, on_batch)
    if "n_chars" in docs.columns:
        result = result.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return result
