"""Fill-in-the-middle cuts located in a wavelet matrix over character classes.

Every byte of a batch of texts has a class: inside a code point, or the first
byte of one of several kinds. The classes of the whole batch stand in one
wavelet matrix. Units of text (code points, lines) begin or end at bytes of some
classes, so the units before any place are a sum of ranks, and the place after
so many units is found by bisection on these sums, for all texts of the batch
at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanshift.llm.text import by_text

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
RATE, SPM, SEED = 90, 20, "1"
#: Classes of bytes: inside a code point, a one-byte one (newline apart), first of two, three or four bytes.
INSIDE, NEWLINE, ONE, TWO, THREE, FOUR = range(6)
PLANES = 3
SCHEMA = "doc_id long, n long, form string, prefix_units long, middle_units long, output string"


def _class_table() -> np.ndarray:
    table = np.full(256, ONE, np.uint8)
    table[0x80:0xC0], table[0xC0:0xE0], table[0xE0:0xF0], table[0xF0:] = INSIDE, TWO, THREE, FOUR
    table[ord("\n")] = NEWLINE
    return table


CLASSES = _class_table()


@dataclass(frozen=True)
class Unit:
    """What is counted: bytes of these classes, which are the first or the last of a unit."""

    classes: tuple[int, ...]
    marks_first: bool


UNITS = {"chars": Unit((NEWLINE, ONE, TWO, THREE, FOUR), True), "lines": Unit((NEWLINE,), False)}


class ClassMatrix:
    """Wavelet matrix of small classes, whose ranks are answered for arrays of places."""

    def __init__(self, classes: np.ndarray, planes: int = PLANES) -> None:
        self.n, self.planes, rest = len(classes), [], classes
        for bit in reversed(range(planes)):
            ones = (rest >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            # One word more than needed, so that the place after the last byte has one too.
            words = np.zeros(self.n // 64 + 1, "<u8")
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.planes.append((words, before, self.n - int(before[-1])))
            rest = np.concatenate([rest[~ones], rest[ones]])

    def _ones(self, level: int, places: np.ndarray) -> np.ndarray:
        """Ones of a plane before each place."""
        words, before, _ = self.planes[level]
        word, bit = places >> 6, (places & 63).astype(np.uint64)
        return before[word] + np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def rank(self, kind: int, places: np.ndarray) -> np.ndarray:
        """Bytes of class ``kind`` before each place."""
        first, ends = np.zeros(1, np.int64), places.astype(np.int64)
        for level, (_, _, zeros) in enumerate(self.planes):
            one = kind >> (len(self.planes) - 1 - level) & 1
            a, b = self._ones(level, first), self._ones(level, ends)
            first, ends = (zeros + a, zeros + b) if one else (first - a, ends - b)
        return ends - first

    def boundaries(self, unit: Unit, places: np.ndarray) -> np.ndarray:
        """Marked bytes before each place: ranks added, or taken from all where fewer classes are not marked."""
        others = [c for c in range(FOUR + 1) if c not in unit.classes]
        if len(others) < len(unit.classes):
            return places - sum(self.rank(c, places) for c in others)
        return sum(self.rank(c, places) for c in unit.classes)

    def locate(self, unit: Unit, starts: np.ndarray, ends: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Between ``starts`` and ``ends``, the place after so many units, by bisection on boundary counts."""
        wanted = self.boundaries(unit, starts) + units
        low, high = starts.astype(np.int64), ends.astype(np.int64)
        while (low < high).any():
            if unit.marks_first:  # the last place with no more marks before it
                middle = (low + high + 1) >> 1
                fits = self.boundaries(unit, middle) <= wanted
                low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
            else:  # the first place with as many marks before it
                middle = (low + high) >> 1
                fits = self.boundaries(unit, middle) >= wanted
                low, high = np.where(fits, low, middle + 1), np.where(fits, middle, high)
            low = np.minimum(low, high)
        return low


def draws(seed: str, doc_id: int | None) -> list[int]:
    """Four unsigned numbers of a document, from the hash of its seeded id."""
    digits = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[k : k + 8], 16) for k in range(0, 32, 8)]


def transform(docs: DataFrame, unit: str = "chars", rate: int = RATE, spm: int = SPM, seed: str = SEED) -> DataFrame:
    """``(doc_id, n, form, prefix_units, middle_units, output)`` per row of ``docs (doc_id, text)``.

    ``n`` is the number of units. ``rate`` percent of the texts are cut in three
    by their id's draws: form ``psm`` is prefix, suffix, middle, each after its
    mark, and in ``spm`` percent of the cut texts ``spm`` has the suffix first.
    The rest, empty texts and texts that hold a mark stay ``plain`` without
    counts. Null text is empty; a row without an id draws for the empty id.
    Repeated rows come out alike.
    """
    counted = UNITS[unit]

    def on_slice(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t.encode() for t in batch["text"].to_pylist()]
        ids, ends = batch["doc_id"].to_pylist(), np.cumsum([len(t) for t in texts], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        matrix = ClassMatrix(CLASSES[np.frombuffer(b"".join(texts), np.uint8)])
        n = matrix.boundaries(counted, ends) - matrix.boundaries(counted, starts)
        drawn = [draws(seed, d) for d in ids]
        pair = np.array([d[:2] for d in drawn], np.int64).T % (n + 1)
        few, many = pair.min(axis=0), pair.max(axis=0)
        first, second = (matrix.locate(counted, starts, ends, k) - starts for k in (few, many))
        forms, outputs = [], []
        for text, (_, _, h3, h4), a, b in zip(texts, drawn, first.tolist(), second.tolist()):
            prefix, middle, suffix = text[:a], text[a:b], text[b:]
            if not text or h3 % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
                forms.append("plain")
                outputs.append(text)
            elif h4 % 100 < spm:
                forms.append("spm")
                outputs.append(b"".join([SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle]))
            else:
                forms.append("psm")
                outputs.append(b"".join([PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle]))
        plain = np.array([f == "plain" for f in forms])
        columns = [
            batch["doc_id"], pa.array(n, pa.int64()), pa.array(forms, pa.string()),
            pa.array(few, pa.int64(), mask=plain), pa.array(many - few, pa.int64(), mask=plain),
            pa.array(outputs, pa.binary()).cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix_units", "middle_units", "output"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_text(batch):
                yield on_slice(part)

    wanted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return wanted.mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that ``transform`` wrote as ``output`` in ``form``. Cut texts hold no mark, so every mark is a border."""
    parts = F.split(output, "<[PSM]>", -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
