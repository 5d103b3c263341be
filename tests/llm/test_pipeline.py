"""Each stage on its own input against brute force, and the whole run."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from loanshift.llm.queries import table, tokenizer
from tests.llm.test_covering import brute_fingerprint, brute_groups
from tests.llm.test_decision_list import brute
from tests.llm.test_doubling import brute_gone
from tests.llm.test_grouping import check


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """Rows before and after each stage, written and reread in between."""
    docs, found = table(spark, sf, "documents"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, sf).write.parquet(path)
        after = spark.read.parquet(path)
        found.append((docs.columns, docs.collect(), after.columns, after.collect()))
        docs = after
    return found


def test_names_and_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(after == before for before, _, after, _ in stages[:-1])
    assert "pipeline" in contract.queries() and "op8_covering_simhash" in contract.queries()


def test_quality_rules_keep_what_is_labelled_good(spark, sf, stages):
    _, before, _, after = stages[0]
    kept = {r.doc_id for r in after}
    assert not any(brute(r.text)[-1] for r in after)
    quality = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    judged = [r for r in before if not brute(r.text)[-1] and r.doc_id in quality]
    good = [r.doc_id in kept for r in judged if quality[r.doc_id]]
    assert sum(good) >= 0.98 * len(good)


def test_one_of_each_near_group_stays(stages):
    _, before, _, after = stages[1]
    prints = {r.doc_id: brute_fingerprint(r.text) for r in before}
    near = [(a, b) for a, b in combinations(set(prints.values()), 2) if (a ^ b).bit_count() <= 2]
    root, least = brute_groups(set(prints.values()), near), {}
    for i, p in prints.items():
        least[root[p]] = min(i, least.get(root[p], i))
    assert sorted(r.doc_id for r in after) == sorted(least.values())
    assert len(after) < len(before)


def test_repeated_windows_are_gone(stages):
    _, before, _, after = stages[2]
    gone = brute_gone([(r.doc_id, r.text) for r in before], 13)
    left = {r.doc_id: [w for w, g in zip(r.text.encode().split(), marks) if not g] for r, marks in zip(before, gone)}
    assert {r.doc_id: r.text.encode().split() for r in after} == left
    assert all(r.n_chars == len(r.text) for r in after if r.text != "")


def test_sources_come_near_their_targets(stages):
    _, before, _, after = stages[3]
    words, largest, taken = Counter(), Counter(), Counter()
    for r in before:
        n = len(r.text.encode().split())
        words[r.source] += n
        largest[r.source] = max(n, largest[r.source])
    for r in after:
        taken[r.source] += len(r.text.encode().split())
    order = sorted(words)
    from loanshift.llm.mixing import targets

    goals = dict(zip(order, targets([words[s] for s in order], [1 + k % 3 for k in range(len(order))], sum(words.values()), 3)))
    assert all(abs(taken[s] - goals[s]) <= largest[s] / 2 for s in order)
    assert max(Counter(r.doc_id for r in after).values()) <= 3


def test_every_piece_is_packed(stages):
    _, before, _, after = stages[4]
    whole, expected = Tokenizer.from_file(tokenizer()), Counter()
    for r in before:
        ids = whole.encode(r.text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            expected[r.doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in after) == expected
    assert check(after, 4096) <= 1.05 * sum(r.length for r in after) / 4096 + 2


def test_run_equals_the_stages(spark, sf, stages):
    found = Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in contract.queries()["pipeline"](spark, sf).collect())
    assert found == Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in stages[-1][3])
    assert defaultdict(int, found)


FIELDS = "doc_id long, text string, lang string, source string, n_chars int, size string, shard int, th int, kept string, fingerprint int, piece int"


def odd_tables(spark, path, rows):
    docs = [(i, t, None, s, None if t is None else len(t), "x", 1, 2, None, 3, 4) for i, t, s in rows]
    spark.createDataFrame(docs, FIELDS).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i, _, _ in rows[:20]] + [(None, 0, 0), (0, 1, 0), (None, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def prose(draw, n):
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 9))) for _ in range(n))


def test_nulls_repeated_rows_long_texts_and_clashing_names(spark, tmp_path):
    draw = random.Random(8)
    good = [(i, prose(draw, 120), ["a", "b", None][i % 3]) for i in range(40)]
    long, copy, unnamed = (50, prose(draw, 30_000), "a"), (60, good[7][1], "b"), (None, prose(draw, 90), "b")
    junk = [(70, None, "a"), (71, "", None), (72, " \n ", "b"), (None, None, None), (73, "two words", "a")]
    path = odd_tables(spark, tmp_path, [*good, good[3], good[3], long, copy, unnamed, *junk])
    docs, left = table(spark, path, "documents"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, path).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        assert after.schema.names == docs.schema.names
        left.append(Counter((r.doc_id, r.text) for r in after.collect()))
        docs = after
    rows = lambda chosen: Counter((i, t) for i, t, _ in chosen)
    assert left[0] == rows([*good, good[3], good[3], long, copy, unnamed])
    assert left[1] == rows([*good, long, unnamed]) == left[2]
    found = corpus_pipeline.run(spark, path).collect()
    pieces = Counter((r.doc_id, r.piece) for r in found)
    assert {i for i, _ in pieces} == {i for i, _ in left[3]} <= {i for i, _ in left[2]}
    assert all(sum(r.length for r in found if r.sequence_id == k) <= 4096 for k in {r.sequence_id for r in found})


def test_empty_tables(spark, tmp_path):
    path = odd_tables(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, path).count() == 0
