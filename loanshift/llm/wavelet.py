"""Token ids written as one wavelet matrix per shard, and read back from it.

A wavelet matrix (Claude and Navarro, 2012) keeps one bit-plane per bit of an
id, highest first; after each plane the ids with a 0 there move, in order,
before those with a 1. With counts of ones per block of a plane, a token, the
occurrences of an id before a place and the place of its k-th occurrence each
take one look per plane.

Spark stores the shards: a row of the Parquet table is one shard, whose ``file``
column holds the whole compressed file. So any store that Spark writes to will
do, a retried task replaces its shards as one, and a shard never spans documents.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanshift.llm.text import crc, id_bytes

MAGIC = b"WVM1"
#: Bytes of a plane per entry of its table of ones.
BLOCK = 64
SHARD_TOKENS = 1 << 20
#: Shards in one Parquet file, so that no reading task meets more of them in a piece than Spark's file splits allow.
SHARDS_PER_FILE = 8
HEAD = struct.Struct("<4sIQQ")
SHARD_SCHEMA = "part int, before long, n_tokens long, file binary"


class WaveletMatrix:
    """Succinct sequence of unsigned ids with access, rank, select, count and decode."""

    def __init__(self, n: int, planes: list[np.ndarray]) -> None:
        """``planes``: packed bits, first position in the lowest bit, highest plane first."""
        self.n, self.planes, self.bits = n, planes, len(planes)

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        rest = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes = []
        for bit in reversed(range(bits)):
            ones = (rest & rest.dtype.type(1 << bit)).astype(bool)
            planes.append(np.packbits(ones, bitorder="little"))
            rest = np.concatenate([rest[~ones], rest[ones]])
        return cls(len(ids), planes)

    @cached_property
    def _ones_before(self) -> list[np.ndarray]:
        """Per plane the ones before each block, and at last all ones."""
        tables = []
        for plane in self.planes:
            counts = np.bitwise_count(plane)
            padded = np.pad(counts, (0, -len(counts) % BLOCK)).reshape(-1, BLOCK).sum(axis=1, dtype=np.int64)
            tables.append(np.concatenate([[0], np.cumsum(padded)]))
        return tables

    def _zeros(self, level: int) -> int:
        return self.n - int(self._ones_before[level][-1])

    def _rank1(self, level: int, place: int) -> int:
        """Ones of a plane before ``place``."""
        byte, bit = divmod(place, 8)
        block = byte // BLOCK
        plane = self.planes[level]
        count = int(self._ones_before[level][block]) + int(np.bitwise_count(plane[block * BLOCK : byte]).sum(dtype=np.int64))
        return count + ((int(plane[byte]) & ((1 << bit) - 1)).bit_count() if bit else 0)

    def _select(self, level: int, k: int, one: bool) -> int:
        """Place of the k-th (from 0) one or zero of a plane."""
        table, plane = self._ones_before[level], self.planes[level]
        starts = np.arange(len(table)) * BLOCK * 8
        before = table if one else starts - table
        block = min(int(np.searchsorted(before, k, side="right")), len(table) - 1) - 1
        bits = np.unpackbits(plane[block * BLOCK : (block + 1) * BLOCK], bitorder="little")
        return block * BLOCK * 8 + int(np.flatnonzero(bits == one)[k - int(before[block])])

    def access(self, place: int) -> int:
        """The id at ``place``."""
        found = 0
        for level, plane in enumerate(self.planes):
            bit = int(plane[place // 8]) >> place % 8 & 1
            ones = self._rank1(level, place)
            place = self._zeros(level) + ones if bit else place - ones
            found = found << 1 | bit
        return found

    def _span(self, token: int, end: int) -> tuple[int, int]:
        """After the last plane: where ``token`` starts, and ends if only places before ``end`` count."""
        start = 0
        if token >> self.bits or token < 0:
            return 0, 0
        for level in range(self.bits):
            a, b = self._rank1(level, start), self._rank1(level, end)
            if token >> (self.bits - 1 - level) & 1:
                start, end = self._zeros(level) + a, self._zeros(level) + b
            else:
                start, end = start - a, end - b
        return start, end

    def rank(self, token: int, place: int) -> int:
        """Occurrences of ``token`` before ``place``."""
        start, end = self._span(token, place)
        return end - start

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of ``token``."""
        start, end = self._span(token, self.n)
        if not 0 <= k < end - start:
            raise IndexError(k)
        place = start + k
        for level in reversed(range(self.bits)):
            one = bool(token >> (self.bits - 1 - level) & 1)
            place = self._select(level, place - self._zeros(level) if one else place, one)
        return place

    def decode(self) -> np.ndarray:
        """All ids: every plane, from the last, sorts the ids below it back."""
        found = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for level in reversed(range(self.bits)):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            zeros, above = self.n - int(np.count_nonzero(ones)), np.empty_like(found)
            above[~ones] = found[:zeros]
            above[ones] = found[zeros:] | found.dtype.type(1 << (self.bits - 1 - level))
            found = above
        return found


def to_file(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """One shard's file: head, compressed table of documents, compressed planes."""
    matrix = WaveletMatrix.build(ids)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    docs = np.array([d or 0 for d in doc_ids], "<i8").tobytes() + known.tobytes() + np.array(lengths, "<u8").tobytes()
    pack = zstandard.ZstdCompressor(level=1).compress
    parts = [pack(docs), *[pack(plane.tobytes()) for plane in matrix.planes]]
    head = HEAD.pack(MAGIC, matrix.bits, matrix.n, len(doc_ids))
    return head + struct.pack(f"<{len(parts)}Q", *map(len, parts)) + b"".join(parts)


class ShardFile:
    """Reader of one shard's file."""

    def __init__(self, raw: bytes) -> None:
        magic, bits, n, n_docs = HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        sizes = struct.unpack_from(f"<{bits + 1}Q", raw, HEAD.size)
        unpack, at = zstandard.ZstdDecompressor().decompress, HEAD.size + 8 * (bits + 1)
        parts = []
        for size in sizes:
            parts.append(unpack(raw[at : at + size]))
            at += size
        docs = np.frombuffer(parts[0], "<i8", n_docs).tolist()
        known = np.frombuffer(parts[0], np.uint8, n_docs, 8 * n_docs).tolist()
        self.doc_ids = [d if k else None for d, k in zip(docs, known)]
        self.lengths = np.frombuffer(parts[0], "<u8", n_docs, 9 * n_docs).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.tokens = WaveletMatrix(n, [np.frombuffer(p, np.uint8) for p in parts[1:]])

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Each document's id, start in the shard and ids."""
        ids = self.tokens.decode()
        for doc_id, start, length in zip(self.doc_ids, self.starts.tolist(), self.lengths.tolist()):
            yield doc_id, start, ids[start : start + length]


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs (doc_id, text)`` and write its ids in ascending doc_id order, ``end_id`` after each document.

    Documents are range-partitioned and sorted by doc_id (null first, equal ids
    by text; null text is empty); each task fills shards of about
    ``shard_tokens`` ids with whole documents and notes how many ids of its
    part came before each, so a place in all ids needs only the parts' totals.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, held, ids, raws = 0, 0, 0, [], []

        def shard() -> pa.RecordBatch:
            tokens = np.frombuffer(b"".join(raws), "<u4")
            file = to_file(tokens, ids, [len(r) // 4 for r in raws])
            arrays = [pa.array([part], pa.int32()), pa.array([before]), pa.array([len(tokens)]), pa.array([file], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=["part", "before", "n_tokens", "file"])

        for batch in batches:
            if batch.num_rows:
                part = batch["part"][0].as_py()
            for doc_id, raw in zip(batch["doc_id"].to_pylist(), id_bytes(tokenizer, batch["text"].to_pylist(), end_id)):
                ids.append(doc_id)
                raws.append(raw)
                held += len(raw) // 4
                if held >= shard_tokens:
                    yield shard()
                    before, held, ids, raws = before + held, 0, [], []
        if ids:
            yield shard()

    wanted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = wanted.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    rows = dealt.withColumn("part", F.spark_partition_id()).mapInArrow(fill, SHARD_SCHEMA)
    rows.write.option("maxRecordsPerFile", SHARDS_PER_FILE).option("compression", "uncompressed").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document of the files at ``path``."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    # One row per range partition of the writer.
    totals = {r.part: r.n for r in shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    offsets, total = {}, 0
    for part in sorted(totals):
        offsets[part], total = total, total + totals[part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                first = offsets[batch["part"][k].as_py()] + batch["before"][k].as_py()
                found = ShardFile(batch["file"][k].as_py()).documents()
                rows = [(d, first + start, len(ids), crc(ids.astype("<u4").tobytes())) for d, start, ids in found]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
