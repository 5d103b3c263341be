"""Words, token ids and Arrow helpers that several operators share.

A word is a run of code points outside U+0020 and U+0009 to U+000D. On UTF-8
bytes that is exactly what ``bytes.split()`` gives, and ``bytes.lower()`` lowers
A-Z alone, so words are cut from bytes in Python and by ``split`` in the JVM.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
#: As a Java pattern.
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: UTF-8 bytes of text that become Python objects at a time.
BYTES_AT_ONCE = 4 << 20
#: Distinct words that a tokenizing worker keeps, about 200 bytes each.
MEMO_WORDS = 1_000_000


def words_of(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def word_array(text: Column) -> Column:
    """The words of ``text`` as an array, JVM-side; null and blank text give an empty array."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+")
    return F.filter(parts, lambda w: w != "")


def fresh(taken: list[str], *names: str) -> list[str]:
    """``names``, each with as many leading underscores as no column in ``taken`` has."""
    used = {name.lower() for name in taken}
    prefix = "_"
    while any((prefix + name).lower() in used for name in names):
        prefix += "_"
    return [prefix + name for name in names]


def local_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table of a few rows from the driver, as a literal in the plan."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def by_text(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``BYTES_AT_ONCE`` of text, one row at least, so that memory follows texts, not rows."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_pylist()
    start, held = 0, 0
    for k, size in enumerate(sizes):
        held += size
        if held >= BYTES_AT_ONCE:
            yield batch.slice(start, k + 1 - start)
            start, held = k + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def map_batches(df: DataFrame, schema, on_batch: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]) -> DataFrame:
    """Apply a function of one Arrow batch with a ``text`` column to slices of every batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_text(batch):
                yield from on_batch(part)

    return df.mapInArrow(run, schema)


#: Letters of Latin-1 with closing punctuation: one or two pre-tokens, of which normalisers change the case alone.
PLAIN = re.compile("([a-zA-ZÀ-ÖØ-Þà-öø-ÿ]*)([.,;:!?|]*)")


class WordEncoder:
    """Token ids of whole texts, each distinct word encoded once by the tokenizers library.

    Sound for tokenizers that fold case, normalise white space and never merge
    across it (``word_bpe_49k.json``): the ids of a text are then those of its
    words in turn. A plain word goes to the library's model as the byte-level
    characters of its pre-tokens; any other goes through the whole tokenizer.
    ``memo_words`` bounds memory only: past it the memo starts anew.
    """

    def __init__(self, path: str, memo_words: int = MEMO_WORDS) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.memo_words = memo_words
        self.memo: dict[bytes, bytes] = {}
        letters = [chr(c) for c in (*range(97, 123), *range(0xE0, 0x100)) if c != 0xF7]
        self.shown = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}

    def _piece(self, piece: str) -> bytes:
        """Ids of one pre-token: a lower-case plain word, or its closing punctuation."""
        key = piece.encode()
        ids = self.memo.get(key)
        if ids is None:
            shown = piece if piece.isascii() else piece.translate(self.shown)
            ids = self.memo[key] = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return ids

    def _word(self, word: bytes) -> bytes:
        if word.isalpha():
            return self._piece(word.decode().lower())
        text = word.decode()
        plain = PLAIN.fullmatch(text)
        if plain:
            ids = self._piece(plain[1].lower()) + self._piece(plain[2])
        else:
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        self.memo[word] = ids
        return ids

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        memo, word_ids = self.memo, self._word
        for text in texts:
            raw = (text or "").encode()
            # A special token is spelt in lower case: other spellings must keep theirs.
            words = (raw if b"<|" in raw else raw.lower()).split()
            found = list(map(memo.get, words))
            try:
                yield b"".join(found)
                continue
            except TypeError:
                pass
            if len(memo) > self.memo_words:
                memo.clear()
            for k, ids in enumerate(found):
                if ids is None:
                    found[k] = memo.get(words[k]) or word_ids(words[k])
            yield b"".join(found)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker, which lives across tasks."""
    return WordEncoder(path)


def id_bytes(path: str, texts: list[str | None], end_id: int) -> Iterator[bytes]:
    """Ids of each text with ``end_id`` appended."""
    end = struct.pack("<I", end_id)
    for raw in encoder(path).encode(texts):
        yield raw + end


def crc(raw: bytes) -> int:
    return zlib.crc32(raw) & 0xFFFFFFFF
