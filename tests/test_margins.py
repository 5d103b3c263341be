"""Kernel maps, margin machines and probabilities from margins against plain numpy."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loanshift.operators import calibrate, margins
from loanshift.operators.margins import Kernel, Machine


def test_maps_are_near_their_kernels(monkeypatch):
    monkeypatch.setattr(margins, "FOURIER", 8000)
    x = np.random.default_rng(1).normal(size=(60, 4))
    for kernel in (Kernel("linear"), Kernel("rbf"), Kernel("rbf", "auto"), Kernel("poly"), Kernel("poly", 0.5, 2, 1.0)):
        found = margins.make_map(kernel, 4, float(x.var()), x)
        z = found(x)
        assert np.abs(z @ z.T - kernel.values(x, x, found.gamma)).max() < (0.08 if kernel.kind == "rbf" else 1e-6)
    few = margins.make_map(Kernel("sigmoid"), 4, float(x.var()), x[:20])(x)
    values, vectors = np.linalg.eigh(Kernel("sigmoid").values(x[:20], x[:20], 1 / (4 * x.var())))
    positive = (vectors[:, values > 0] * values[values > 0]) @ vectors[:, values > 0].T
    assert few[:20] @ few[:20].T == pytest.approx(positive, abs=1e-6)


def plain(z, y, weight, c, loss):
    """Gradient descent with backtracking, far longer than needed."""
    z = np.concatenate([z, np.ones((len(z), 1))], axis=1)
    w, plain_ = np.zeros(z.shape[1]), np.append(np.ones(z.shape[1] - 1), 0.0)

    def value(w):
        m = y * (z @ w)
        each = np.maximum(1 - m, 0) ** 2 if loss == "hinge" else np.logaddexp(0, -m)
        return 0.5 * (plain_ * w) @ w + c * weight @ each

    def slope(w):
        m = y * (z @ w)
        each = -2 * np.maximum(1 - m, 0) * y if loss == "hinge" else -y / (1 + np.exp(m))
        return plain_ * w + c * z.T @ (weight * each)

    step = 1.0
    for _ in range(20000):
        g = slope(w)
        while value(w - step * g) > value(w) - 0.3 * step * g @ g and step > 1e-12:
            step /= 2
        w, step = w - step * g, step * 1.5
    return w


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        x = rng.normal(size=3).tolist()
        label = int(x[0] + 0.5 * rng.normal() > 0.3) + int(x[1] > 0.8)
        rows.append((i % 2, x, label if i % 2 else min(label, 1), i // 2 % 3, i))
    return rows, spark.createDataFrame(rows, "cur int, x array<double>, label int, fold int, id int").repartition(4).cache()


@pytest.mark.parametrize("loss, block_rows", [("hinge", 1000), ("hinge", 20), ("logistic", 40)])
def test_machines_reach_the_optimum(data, loss, block_rows):
    rows, table = data
    kernels = [Kernel("linear"), Kernel("rbf")]
    stored, found = margins.blocks(table, block_rows), margins.maps(table, kernels)
    wanted = margins.machines(table, kernels, [margins.NO_FOLD, 0], c=0.5, loss=loss)
    fitted = margins.fit(stored, found, wanted)
    assert len(wanted) == 2 * 2 * (2 + 3) and all(done for _, done in fitted.values())
    for m in [m for m in wanted if m.kernel == 0 and m.label == 1]:
        own = [r for r in rows if r[0] == m.cur and r[3] != m.held]
        labels = [r[2] for r in own]
        weight = np.array([len(own) / (len(set(labels)) * labels.count(v)) for v in labels])
        y = np.where(np.array(labels) == 1, 1.0, -1.0)
        assert fitted[m][0] == pytest.approx(plain(np.array([r[1] for r in own]), y, weight, 0.5, loss), abs=2e-3)


def test_margins_of_rows_and_of_held_out_rows(data):
    rows, table = data
    kernels = [Kernel("linear")]
    stored, found = margins.blocks(table), margins.maps(table, kernels)
    fitted = margins.fit(stored, found, margins.machines(table, kernels, [margins.NO_FOLD, 0, 1, 2]))
    for held_out in (False, True):
        scored = margins.margins(table, found, fitted, ["id", "fold"], held_out).collect()
        assert len(scored) == 150 * 2 + 150 * 3
        x = {r[4]: r[1] for r in rows}
        for r in scored[:50]:
            w = fitted[Machine(r.cur, r.label, r.fold if held_out else margins.NO_FOLD, 0)][0]
            assert r.margin == pytest.approx(float(np.append(x[r.id], 1.0) @ w))
    best = margins.predicted(margins.margins(table, found, fitted, ["id", F.col("label").alias("truth")]), ["id", "truth"])
    assert best.where("prediction = truth").count() > 220


def test_one_class_and_empty(spark, data):
    _, table = data
    one = table.where("label = 0")
    assert margins.machines(one, [Kernel()], [margins.NO_FOLD]) == []
    assert margins.fit(margins.blocks(one), margins.maps(one, [Kernel()]), []) == {}
    assert margins.margins(table, {}, {}, ["id"]).count() == 0


def scored_rows(spark, n=400, seed=2):
    rng = np.random.default_rng(seed)
    rows = [("ab"[i % 2] if i % 5 else None, float(round(rng.normal(), 1 if i % 2 else 3)), i) for i in range(n)]
    data = [(g, m, int(rng.random() < 1 / (1 + math.exp(-2 * m))), i, 0.5) for g, m, i in rows]
    return data, spark.createDataFrame(data, "g string, margin double, y int, id int, p double").repartition(3)


def test_sigmoid_has_the_smoothed_mass_and_the_most_likelihood(spark):
    data, table = scored_rows(spark)
    fitted = {r.g: r for r in calibrate.sigmoid(table, ["g"]).collect()}
    assert set(fitted) == {"a", "b", None}
    for g, r in fitted.items():
        own = [(m, y) for h, m, y, *_ in data if h == g]
        hits, misses = sum(y for _, y in own), sum(1 - y for _, y in own)
        t = [(hits + 1) / (hits + 2) if y else 1 / (misses + 2) for _, y in own]

        def loss(a, b):
            p = [1 / (1 + math.exp(a * m + b)) for m, _ in own]
            return -sum(u * math.log(q) + (1 - u) * math.log(1 - q) for u, q in zip(t, p))

        mass = sum(1 / (1 + math.exp(r.a * m + r.b)) for m, _ in own)
        assert mass == pytest.approx(sum(t), abs=1e-3) and r.a < 0
        assert all(loss(r.a, r.b) <= loss(r.a + da, r.b + db) + 1e-9 for da in (-0.1, 0, 0.1) for db in (-0.1, 0, 0.1))
    told = calibrate.apply_sigmoid(table, calibrate.sigmoid(table, ["g"]), ["g"], "chance")
    assert told.count() == len(data) and told.columns == [*table.columns, "chance"]


def plain_pools(pairs):
    kept = []
    for m in sorted({m for m, _ in pairs}):
        now = [m, m, sum(1 for v, _ in pairs if v == m), sum(y for v, y in pairs if v == m)]
        while kept and kept[-1][3] * now[2] >= now[3] * kept[-1][2]:
            b = kept.pop()
            now = [b[0], now[1], b[2] + now[2], b[3] + now[3]]
        kept.append(now)
    return kept


@pytest.mark.parametrize("at_once", [7, 40, 10**6])
def test_isotonic_equals_one_pass(spark, at_once):
    data, table = scored_rows(spark)
    found = calibrate.isotonic(table, ["g"], at_once=at_once, hot_rows=10**6 if at_once > 7 else 30)
    pools = {g: plain_pools([(m, y) for h, m, y, *_ in data if h == g]) for g in ("a", "b", None)}
    for g, expected in pools.items():
        assert sorted([r.low, r.high, r.n, r.hits] for r in found.collect() if r.g == g) == expected
    new = table.unionByName(spark.createDataFrame([("a", -99.0, 0, -1, 0.5), ("b", 99.0, 1, -2, 0.5)], table.schema))
    told = calibrate.apply_isotonic(new, found, ["g"], "chance").collect()
    for r in told:
        share = [h / n for low, _, n, h in pools[r.g] if low <= r.margin] or [pools[r.g][0][3] / pools[r.g][0][2]]
        assert r.chance == pytest.approx(share[-1])
    for g in pools:
        assert sum(r.chance for r in told if r.g == g and r.id >= 0) == pytest.approx(sum(y for h, _, y, *_ in data if h == g))


@pytest.mark.parametrize("held", [0, 1 << 26])
def test_a_task_adds_up_the_sums_of_its_blocks(data, monkeypatch, held):
    (_, rows), kernel = data, Kernel("linear")
    found = margins.maps(rows, [kernel])
    stored, wanted = margins.blocks(rows, block_rows=60), margins.machines(rows, [kernel], [margins.NO_FOLD])
    sizes, start = margins._class_sizes(stored), {n: np.zeros(4) for n in range(len(wanted))}
    tiles = stored.withColumn("kernel", F.lit(0)).coalesce(1)
    monkeypatch.setattr(margins, "HELD_BYTES", held)
    passed, plain = [], type(tiles).groupBy

    def groupBy(df, *by):
        if by == ("number",):
            passed.append((df.count(), df.agg(F.max(F.length("sums"))).first()[0]))
        return plain(df, *by)

    monkeypatch.setattr(type(tiles), "groupBy", groupBy)
    width = margins._width(found[wanted[0].cur, 0], stored, wanted[0].cur) + 1
    told = margins._newton(tiles, found, wanted, sizes, {n: np.zeros(width) for n in start})
    assert sorted(told) == sorted(start)
    blocks = sum(stored.where(F.col("cur") == m.cur).count() for m in wanted)
    assert blocks > len(wanted) and passed == [(len(wanted) if held else blocks, 8 * (1 + width + width * (width + 1) // 2))]


def test_row_groups_hold_few_blocks_and_blocks_are_not_copied_per_kernel(data, monkeypatch):
    (_, rows), kernels = data, [Kernel("linear"), Kernel("rbf")]
    stored, found = margins.blocks(rows, block_rows=2), margins.maps(rows, kernels)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in stored.inputFiles()]
    assert max(f.num_rows for f in files) > margins.BLOCKS_A_GROUP
    assert all(f.row_group(k).num_rows <= margins.BLOCKS_A_GROUP for f in files for k in range(f.num_row_groups))
    assert stored.count() >= 4 * rows.sparkSession.sparkContext.defaultParallelism
    read, plain_step = [], margins._newton

    def newton(tiles, *more):
        read.append(tiles.count())
        return plain_step(tiles, *more)

    monkeypatch.setattr(margins, "_newton", newton)
    fitted = margins.fit(stored, found, margins.machines(rows, kernels, [margins.NO_FOLD]))
    assert all(done for _, done in fitted.values()) and set(read) == {stored.count()}


def test_steps_over_all_blocks_begin_near_their_end(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 3))
    rows = [(0, own.tolist(), int(own[0] + 0.5 * rng.normal() > 0), i % 3) for i, own in enumerate(x)]
    table, kernel = spark.createDataFrame(rows, "cur int, x array<double>, label int, fold int"), Kernel("rbf")
    steps, plain_step = [], margins._newton
    monkeypatch.setattr(margins, "_newton", lambda *a: steps.append(a[-1]) or plain_step(*a))
    found = margins.maps(table, [kernel])
    wanted = margins.machines(table, [kernel], [0, 1, 2], loss="logistic")
    many = margins.fit(margins.blocks(table, 2000), found, wanted)
    assert all(w.any() for w in steps[0].values()) and len(steps) <= 5 and all(done for _, done in many.values())
    whole = margins.fit(margins.blocks(table, 4000), found, wanted)
    for m in wanted:
        assert many[m][0] == pytest.approx(whole[m][0], abs=0.02)
