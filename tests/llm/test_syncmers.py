import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from loanshift.llm import syncmers


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def brute_anchors(raw, k, s):
    found = []
    for at in range(len(raw) - k + 1):
        inner = [xxhash.xxh64_intdigest(raw[at + m : at + m + s], 42) for m in range(k - s + 1)]
        inner = [signed(h) for h in inner]
        if min(inner[0], inner[-1]) == min(inner):
            first, last = (h.to_bytes(8, "little", signed=True) for h in (inner[0], inner[-1]))
            seed = xxhash.xxh64_intdigest(first, 42)
            found.append((at + 1, xxhash.xxh64_intdigest(last, seed) & syncmers.LOW))
    return found


def brute_sketch(raw, k=syncmers.K, s=syncmers.S, size=syncmers.SKETCH):
    first = {}
    for at, h in brute_anchors(raw, k, s):
        first.setdefault(h, at)
    kept = sorted(first)[: max(size, sum(h < syncmers.BOUND for h in first))]
    return {h: first[h] for h in kept} or {xxhash.xxh64_intdigest(raw, 42) & syncmers.LOW: 1}


def brute_text(found):
    return "".join(f"{h:08x}" for h in sorted(found, key=found.get))


def longest(values):
    best = []
    for k, v in enumerate(values):
        best.append(1 + max((b for b, w in zip(best, values[:k]) if w < v), default=0))
    return max(best, default=0)


def brute_likeness(a, b, size=syncmers.SKETCH):
    bound = min(syncmers.LOW + 1 if len(x) < size else max(max(x) + 1, syncmers.BOUND) for x in (a, b))
    a, b = ({h: at for h, at in x.items() if h < bound} for x in (a, b))
    shared = sorted(set(a) & set(b), key=a.get)
    return longest([b[h] for h in shared]) / len(set(a) | set(b))


def texts():
    draw = random.Random(4)
    found = ["", None, "a", "abc", "short one!", "exactly 12 b", "é" * 40, "日本語のテキスト" * 9, "x" * 5000, " \n "]
    for _ in range(60):
        found.append(" ".join(draw.choice(["the", "cat", "sät", "on", "a", "mat."]) for _ in range(draw.randrange(200))))
    found += [found[20], found[20]]
    letters = "".join(chr(draw.randrange(97, 123)) for _ in range(6000))
    return found + [letters, letters[3000:] + letters[:3000], letters[:2000] + letters[4000:]]


@pytest.mark.parametrize("k,s", [(12, 9), (8, 4), (6, 5), (5, 3)])
def test_anchors_equal_brute_force_across_blocks(spark, monkeypatch, k, s):
    monkeypatch.setattr(syncmers, "BLOCK", 64)
    df = spark.createDataFrame([(t or "",) for t in texts()], "text string")
    raw = F.encode("text", "UTF-8")
    for r in df.select("text", syncmers.anchors(raw, k, s).alias("a")).collect():
        assert [tuple(a) for a in r.a] == brute_anchors(r.text.encode(), k, s)


def test_every_row_equals_brute_force(spark, monkeypatch):
    rows = [(i * 7 % 101 if i else None, t, "x") for i, t in enumerate(texts())]
    expected = {}
    order = sorted(rows, key=lambda r: -1 if r[0] is None else r[0])
    for (i, t, _), (_, after, _) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        n = len(t) // 4
        new = t[: len(t) - n] + after[:n]
        own, other, other_next = brute_sketch(t.encode()), brute_sketch(new.encode()), brute_sketch(after.encode())
        expected[i] = (
            len(t), hashlib.sha256(new.encode()).hexdigest(), brute_text(own), brute_text(other),
            pytest.approx(brute_likeness(own, other)), pytest.approx(brute_likeness(own, other_next)),
        )
    df = spark.createDataFrame(rows, "doc_id long, text string, tie string").repartition(3)
    for ranges in (1, 4, 40):
        monkeypatch.setattr(syncmers, "RANGES_PER_PARTITION", ranges)
        found = syncmers.edited(df).collect()
        assert len(found) == len(rows)
        for r in found:
            assert tuple(r)[1:] == expected[r.doc_id], r.doc_id


def test_small_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "the cat sat on the mat and the dog sat on the log")], "doc_id long, text string")
    [r] = syncmers.edited(df).collect()
    assert r.near_next == 1.0 and 0 < r.near_edited < 1
    assert syncmers.edited(df.where(F.lit(False))).count() == 0
    same = spark.createDataFrame([(1, "abc"), (1, "abc"), (1, "abd"), (None, None)], "doc_id long, text string")
    assert syncmers.edited(same).count() == 4


def rated(spark, pairs):
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
    a, b = (syncmers.fingerprint(F.encode(c, "UTF-8")) for c in "ab")
    found = df.select("k", a.alias("a"), b.alias("b")).select("k", syncmers.likeness(F.col("a"), F.col("b")).alias("r"), F.size("a").alias("n"))
    return [(r.r, r.n) for r in found.orderBy("k").collect()]


def passages(seed, n, words=60):
    draw = random.Random(seed)
    return [" ".join("".join(draw.choice("abcdefghijklm") for _ in range(draw.randrange(2, 9))) for _ in range(words)) for _ in range(n)]


def test_order_counts_and_a_shared_passage_of_long_texts_is_seen(spark):
    text, other = passages(1, 40), passages(2, 40)
    moved = random.Random(3).sample(text, 40)
    joined = " ".join
    pairs = [
        (joined(text), joined(text)), (joined(text), joined(moved)), (joined(text), joined(other)),
        (joined(text), joined(other[:20] + text[7:8] + other[21:])), (joined(text), joined(text[20:] + text[:20])),
    ]
    (same, n), (reordered, _), (strange, _), (passage, _), (halves, _) = rated(spark, pairs)
    assert same == 1 and n > 3 * syncmers.SKETCH
    assert reordered < 0.5 and strange == 0 and 0 < passage < 0.05 and 0.3 < halves < 0.6
    for (a, b), (found, _) in zip(pairs, rated(spark, pairs)):
        assert found == pytest.approx(brute_likeness(brute_sketch(a.encode()), brute_sketch(b.encode())))


def test_the_chain_is_the_longest_of_any_order(spark):
    draw, cases = random.Random(6), [[], [0], [1, 0], [0, 1, 2], [2, 0, 1], list(range(400))[::-1]]
    for n in (5, 9, 30, 120):
        for swaps in (1, 3, n):
            case = list(range(n))
            for _ in range(swaps):
                a, b, c = sorted(draw.sample(range(n + 1), 3))
                case = case[:a] + case[b:c] + case[a:b] + case[c:]
            cases.append(case)
    rows = [(k, draw.sample([(5 * i << 31) + 3 * v for i, v in enumerate(case)], len(case))) for k, case in enumerate(cases)]
    df = spark.createDataFrame(rows, "k int, pairs array<bigint>")
    found = {r.k: r.n for r in df.select("k", syncmers.chain(F.col("pairs")).alias("n")).collect()}
    assert [found[k] for k in range(len(cases))] == [longest(case) for case in cases]
