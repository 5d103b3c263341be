from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from loanshift.llm import covering
from loanshift.llm.components import components


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(keys, linked):
    root = {k: k for k in keys}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair_within_the_radius(radius):
    found = covering.masks(radius)
    assert len(found) == 2 ** (radius + 1) - 1
    for bits in combinations(range(0, 64, 3 if radius == 3 else 1), radius):
        assert any(not any(m >> b & 1 for b in bits) for m in found)


@pytest.mark.parametrize("radius,limit", [(2, 32), (2, 1), (1, 1), (3, 1)])
def test_links_give_the_components_of_all_pairs(spark, monkeypatch, radius, limit):
    monkeypatch.setattr(covering, "PAIRS_UP_TO", limit)
    base = [0, 0x0F0F, 0xFFFFFFFFFFFFFFFF, 0x123456789ABCDEF0]
    values = {b ^ (1 << i) ^ (1 << (i * 7 % 64)) for b in base for i in range(0, 40, 2)} | set(base)
    values = {covering.signed(v) for v in values}
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    near = [(a, b) for a, b in combinations(values, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= radius]
    expected = brute_groups(values, near)
    found = {r.node: r.root for r in components(covering.links(df, radius)).collect()}
    assert {v: found.get(v, v) for v in values} == expected


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (5, 3), (3, 5)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 10 for i in range(10, 61)} | {i: 100 for i in range(100, 140)} | {3: 3, 5: 3}


TEXTS = [
    (5, "The cat sat on the mat."), (3, "the cat sat on the mat."), (9, None), (8, ""), (7, " \t\n"), (1, "one two"),
    (2, "ONE TWO é"), (4, "x " * 3000), (6, "The cat sat on the mat."), (6, "The cat sat on the mat."), (None, "one two"),
    (None, "alone here now"),
]


def test_near_groups_equal_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in TEXTS], "doc_id long, text string, fp string")
    found = covering.near_groups(df).collect()
    assert len(found) == len(TEXTS)
    prints = {t: brute_fingerprint(t) for _, t in TEXTS}
    near = [(a, b) for a, b in combinations(set(prints.values()), 2) if (a ^ b).bit_count() <= 2]
    root = brute_groups(set(prints.values()), near)
    least = {}
    for i, t in TEXTS:
        if i is not None:
            least[root[prints[t]]] = min(i, least.get(root[prints[t]], i))
    expected = sorted(((i, covering.signed(prints[t]), least.get(root[prints[t]])) for i, t in TEXTS), key=str)
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in found), key=str) == expected


def test_one_document_of_a_group_stays_with_its_columns(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in TEXTS], "doc_id long, text string, fp string")
    kept = covering.drop_near_copies(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([3, 7, 1, 2, 4, None, None], key=str)
    empty = covering.drop_near_copies(df.where(F.lit(False)))
    assert empty.count() == 0


def test_a_repeated_kept_id_stays_once(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d")], "doc_id long, text string")
    assert [tuple(r) for r in covering.drop_near_copies(df).collect()] == [(1, "a b c d")]


@pytest.mark.parametrize(
    "rows, kept",
    [
        ([(5, "A"), (5, "B"), (7, "B"), (9, "A")], [(5, "A"), (5, "B")]),
        ([(5, "A"), (5, "B"), (3, "B")], [(3, "B"), (5, "A")]),
        ([(5, "A"), (5, "A"), (5, "B"), (None, "A"), (2, "C")], [(2, "C"), (5, "A"), (5, "B"), (None, "A")]),
        ([(None, "A"), (None, "A"), (4, "B"), (4, "B")], [(4, "B"), (None, "A"), (None, "A")]),
    ],
)
def test_an_id_with_unlike_texts_is_in_several_groups(spark, rows, kept):
    words = {"A": "the quick brown fox jumps over a lazy dog", "B": "some other words that share no shingle with it", "C": "third kind of text is here"}
    schema = "doc_id long, text string, kept_id string, fp int, key double"
    df = spark.createDataFrame([(i, words[t], t, k, 0.5) for k, (i, t) in enumerate(rows)], schema)
    found = covering.drop_near_copies(df)
    assert found.columns == df.columns
    assert sorted(((r.doc_id, r.kept_id) for r in found.collect()), key=str) == sorted(kept, key=str)
