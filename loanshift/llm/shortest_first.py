"""Packing of token sequences, shortest pack first, over the histogram of lengths.

Only how many pieces have each length matters for a packing, and the histogram
has a fixed size, so the driver packs it (Krell et al., 2021): lengths go longest
first, each piece into the shortest pack so far that it fits, and packs alike are
one pattern with a count. Packs that stay loose are laid end to end and cut where
a sequence is full, and the last, unfilled sequence at powers of two.

All sequences together are one line of places. A pattern tells where on the line
its pieces stand, by their length and rank among the pieces of that length. Ranks
need no sort and no group in one task: every writing task numbers its pieces of
each length, and the counts of the tasks before are added by a join.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanshift.llm.text import MEMO_WORDS, by_text, crc
from loanshift.session import materialize

CAPACITY = 2048
#: Room from which a pack counts as loose.
LOOSE = 16
#: Code points between which a byte-level pattern never merges: white space on one side only, the blank going right.
BORDER = re.compile(r"(?<=\S)(?= \S)")
#: Characters whose class every Unicode version agrees on, and the byte-level pre-tokens of text of them.
PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ſ]*")
TOKENS = re.compile("'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ſ]+| ?[0-9]+| ?[^\\sA-Za-z0-9À-ÖØ-öø-ſ]+|\\s+(?!\\S)|\\s+")
#: Code points of a segment that is worth keeping.
LONGEST_KEPT = 64
#: Code points that are cut into segments at a time.
AT_ONCE = 1 << 20
PIECE_SCHEMA = "doc_id long, start long, doc_tokens long, ids binary, length int, part int, nth long"
PLACED_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
Run = tuple[int, list[tuple[int, int]]]


class SegmentEncoder:
    """Ids of whole texts by the tokenizers library, each distinct pre-token encoded once.

    Sound for byte-level tokenizers with the pattern below and no normaliser:
    they put a blank before the word after it and merge nothing across, so a
    text may be cut at borders. Segments of plain characters are cut into
    pre-tokens, which go straight to the library's model; any other segment goes
    through the whole tokenizer. ``memo_words`` bounds memory only: half of it
    is kept when it is full.
    """

    def __init__(self, path: str, memo_words: int = MEMO_WORDS) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo, self.older, self.at_most = {}, {}, max(1, memo_words // 2)
        plain = [chr(c) for c in range(0x180) if PLAIN.fullmatch(chr(c))]
        self.shown = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in plain}

    def _tokens(self, text: str) -> Iterator[list[str]]:
        start = 0
        while start < len(text):
            border = BORDER.search(text, start + AT_ONCE)
            end = border.start() if border else len(text)
            part, start = text[start:end], end
            if any(mark in part for mark in self.special):
                yield [part]
            elif PLAIN.fullmatch(part):
                yield TOKENS.findall(part)
            else:
                yield [t for s in BORDER.split(part) for t in (TOKENS.findall(s) if PLAIN.fullmatch(s) else (s,))]

    def _code(self, token: str) -> bytes:
        ids = self.older.get(token)
        if ids is None:
            if TOKENS.fullmatch(token) and PLAIN.fullmatch(token):
                ids = array("I", [t.id for t in self.model.tokenize(token.translate(self.shown))]).tobytes()
            else:
                ids = array("I", self.tokenizer.encode(token, add_special_tokens=False).ids).tobytes()
        if len(token) <= LONGEST_KEPT:
            self.memo[token] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        parts, code = [], self._code
        for tokens in self._tokens(text):
            memo = self.memo
            found = list(map(memo.get, tokens))
            if None in found:
                found = [memo.get(t) or code(t) if ids is None else ids for t, ids in zip(tokens, found)]
                if len(memo) > self.at_most:
                    self.older, self.memo = memo, {}
            parts += found
        return b"".join(parts)


@lru_cache(maxsize=2)
def encoder(path: str) -> SegmentEncoder:
    """One encoder per Python worker, which lives across tasks."""
    return SegmentEncoder(path)


def shortest_first(counts: np.ndarray, capacity: int = CAPACITY) -> list[Run]:
    """``(packs, [(length, pieces in each)])`` that hold ``counts[length]`` pieces of every length from 1 to ``capacity``."""
    packs: list[tuple[int, int, int, list[tuple[int, int]]]] = []  # by room, the shortest pack first; alike: the oldest
    made = 0

    def add(room: int, n: int, content: list[tuple[int, int]]) -> None:
        nonlocal made
        made += 1
        heappush(packs, (-room, made, n, content))

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            if packs and -packs[0][0] >= length:
                room, _, n, content = heappop(packs)
                room = -room
                # One piece for each pack, or as many as keep them the shortest.
                following = -packs[0][0] if packs else 0
                each = max(1, (room - max(following, length - 1)) // length) if left >= n else 1
                each, used = min(each, max(1, left // n)), min(n, left)
                if n > used:
                    add(room, n - used, content)
                add(room - each * length, used, [*content, (length, each)])
                left -= each * used
            else:
                each = min(capacity // length, left)
                add(capacity - each * length, left // each, [(length, each)])
                left %= each
    return [(n, content) for _, _, n, content in sorted(packs)]


def tail(tokens: int) -> list[int]:
    """Sizes, largest first, of the powers of two that add up to ``tokens``."""
    return [1 << bit for bit in reversed(range(tokens.bit_length())) if tokens >> bit & 1]


class Plan:
    """Where pieces stand: rows sorted by (length, first rank), and the borders of the last sequences.

    Full packs take one sequence each; loose ones follow each other without a
    gap, and what does not fill a sequence at the end goes to powers of two.
    """

    def __init__(self, runs: list[Run], capacity: int = CAPACITY, loose: int = LOOSE) -> None:
        self.capacity, rows, ranks, at = capacity, [], {}, 0
        totals = [(n, content, sum(length * each for length, each in content)) for n, content in runs]
        tight = [t for t in totals if capacity - t[2] < loose]
        for n, content, total in tight + [t for t in totals if capacity - t[2] >= loose]:
            stride = capacity if capacity - total < loose else total
            offset = 0
            for length, each in content:
                rank = ranks.get(length, 0)
                rows.append((length, rank, each, at + offset, stride))
                ranks[length] = rank + n * each
                offset += length * each
            at += n * stride
        rest = at % capacity
        # A power of two needs no padding, nor does a last sequence that is nearly full.
        ends = [at - rest + x for x in np.cumsum(tail(rest)).tolist()] if 0 < rest <= capacity - loose else [at] * bool(rest)
        self.whole, self.ends = at // capacity, np.array([at - rest, *ends], np.int64)
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.length, self.rank, self.each, self.at, self.stride = table.T.copy()
        self.first = {int(v): int(k) for v, k in zip(*np.unique(self.length, return_index=True))}

    def place(self, length: int, rank: int) -> int:
        """Where the piece begins on the line of all sequences."""
        first = self.first[length]
        end = first + int(np.searchsorted(self.length[first:], length, side="right"))
        row = first + int(np.searchsorted(self.rank[first:end], rank, side="right")) - 1
        pack, nth = divmod(rank - int(self.rank[row]), int(self.each[row]))
        return int(self.at[row]) + pack * int(self.stride[row]) + nth * length

    def parts(self, length: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
        """``(from, tokens, sequence, offset)`` of the piece, cut at the borders it lies across."""
        at = self.place(length, rank)
        done = 0
        while done < length:
            here = at + done
            if here < self.whole * self.capacity:
                sequence, begin = here // self.capacity, here // self.capacity * self.capacity
                end = begin + self.capacity
            else:
                k = int(np.searchsorted(self.ends, here, side="right"))
                sequence, begin, end = self.whole + k - 1, int(self.ends[k - 1]), int(self.ends[k])
            size = min(length - done, end - here)
            yield done, size, sequence, here - begin
            done += size


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Ids of every text with ``end_id``, cut after every ``capacity`` ids.

    ``part`` is the writing task and ``nth`` numbers its pieces of one length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, end = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64), struct.pack("<I", end_id)
        encode = encoder(tokenizer).encode
        for batch in (piece for batch in batches for piece in by_text(batch)):
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                raw = encode(text or "") + end
                for at in range(0, len(raw), 4 * capacity):
                    ids = raw[at : at + 4 * capacity]
                    length = len(ids) // 4
                    rows.append((doc_id, at // 4, len(raw) // 4, ids, length, part, int(seen[length])))
                    seen[length] += 1
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "doc_tokens", "ids", "length", "part", "nth"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, PIECE_SCHEMA)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, loose: int = LOOSE
) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids)`` per piece of ``docs (doc_id, text)``.

    Every id lies in one piece, pieces of a sequence have no gap between them,
    and ``ids`` are 32-bit integers. Texts longer than ``capacity`` are cut into
    whole sequences and a rest; of the others only pieces of loose packs are.
    Null text is empty: its one id is the end id. Rows without an id and
    repeated rows are packed like any other; an empty table gives an empty one.
    """
    stored = materialize(pieces(docs, tokenizer, end_id, capacity))
    sizes = materialize(stored.groupBy("length", "part").agg(F.count("*").alias("n")))
    counts = np.zeros(capacity + 1, np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # capacity rows at most
        counts[row["length"]] = row["n"]
    plan = docs.sparkSession.sparkContext.broadcast(Plan(shortest_first(counts, capacity), capacity, loose))
    # One row per length and writing task.
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = stored.join(before, ["length", "part"])
    ranked = ranked.select("doc_id", "start", "doc_tokens", "ids", "length", (F.col("nth") + F.col("before")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = [batch[c].to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids", "length", "rank")]
            for doc_id, start, tokens, ids, length, rank in zip(*columns):
                for at, size, sequence, offset in plan.value.parts(length, rank):
                    part = ids[4 * at : 4 * (at + size)]
                    rows.append((doc_id, start + at, size, crc(part), tokens, sequence, offset, part))
            if rows:
                kinds = [*[pa.int64()] * 7, pa.binary()]
                arrays = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return ranked.mapInArrow(run, PLACED_SCHEMA)
