import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanshift.llm import mixing


def test_targets_share_the_excess_by_weight():
    assert mixing.targets([100, 100], [1, 1], 200, 3) == [100, 100]
    assert mixing.targets([10, 1000, 1000], [1, 2, 3], 2010, 3) == pytest.approx([30, 1980 * 2 / 5, 1980 * 3 / 5])
    assert mixing.targets([0, 5], [1, 1], 5, 3) == [0, 5]
    assert mixing.targets([], [], 0, 3) == []


def test_quotas_are_split_whole_and_evenly():
    quotas = [1000, 1, 0, 37, 500]
    found = mixing.split_quotas(quotas, 7, 1)
    assert found.sum(axis=0).tolist() == quotas
    assert found.sum(axis=1).max() - found.sum(axis=1).min() <= 2
    assert (found >= 0).all()
    # The mean of many splits is the even share: the draw is not biased to a shard.
    mean = np.mean([mixing.split_quotas(quotas, 4, seed)[:, 3] for seed in range(400)], axis=0)
    assert np.allclose(mean, 37 / 4, atol=0.6)


def corpus():
    draw = random.Random(5)
    rows = []
    for i in range(1500):
        source = draw.choice(["a", "a", "a", "b", "é", "Z", "z", None, ""])
        rows.append((i, None if i % 97 == 0 else "w " * draw.randrange(0, 60), source, "x"))
    rows += [(2000, "", "only empty", "x"), (2001, "one two", "tiny", "y"), (2002, "w " * 9000, "big", "y"), (None, "no id", "a", "x")]
    return rows + [rows[3], rows[3]]


def brute_sizes(rows):
    return [len([w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]) for _, t, _, _ in rows]


def test_each_source_comes_near_its_target(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, words string").repartition(5)
    found = mixing.decisions(df).collect()
    assert len(found) == len(rows)
    sizes = brute_sizes(rows)
    assert Counter((r.doc_id, r.size) for r in found) == Counter((row[0], s) for row, s in zip(rows, sizes))
    by_source = defaultdict(int)
    for row, s in zip(rows, sizes):
        by_source[row[2]] += s
    order = sorted(by_source, key=lambda s: (s is None, s or ""))
    goals = dict(zip(order, mixing.targets([by_source[s] for s in order], [1 + k % 3 for k in range(len(order))], sum(sizes), 3)))
    source_of = {row[0]: row[2] for row in rows}
    taken = defaultdict(int)
    for r in found:
        source = source_of[r.doc_id]
        assert r.source_size == by_source[source] and r.target == pytest.approx(goals[source])
        assert r.taken == r.size * len(r.shards) and len(r.shards) <= 3 and all(0 <= s < 8 for s in r.shards)
        taken[source] += r.taken
    for source in order:
        largest = max(s for row, s in zip(rows, sizes) if row[2] == source)
        assert abs(goals[source] - taken[source]) <= (largest / 2 if source in ("big", "tiny") else 30), source
    again = mixing.decisions(df.repartition(2)).collect()
    assert Counter(map(str, again)) == Counter(map(str, found))


def test_the_mix_repeats_rows_as_often_as_decided(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, source string, words string")
    times = Counter()
    for r in mixing.decisions(df).collect():
        times[r.doc_id] += len(r.shards)
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    assert Counter(r.doc_id for r in mixed.collect()) == +times
    assert mixing.mixed_documents(df.where(F.lit(False))).count() == 0
    assert mixing.decisions(df.where(F.lit(False))).count() == 0
