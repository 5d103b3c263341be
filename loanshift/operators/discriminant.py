"""Linear discriminant from sufficient statistics.

Tasks reduce their rows to counts, sums and outer products per class; only
those d x d sums reach the driver, where the small system is solved. Scoring
is one matrix product per Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanshift.functions.names import unused

SUMS_SCHEMA = "grp string, i int, value double"


def _grouped_sums(df: DataFrame, group: Column, width: int, reduce_batch, values: Column) -> dict[str, np.ndarray]:
    """Sum a per-batch vector of ``width`` numbers per group over the whole table.

    Each task folds its batches before emitting, so the shuffle carries
    ``groups * width`` numbers per task, not rows.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, part in batch.groupby("grp"):
                x = np.stack(part["x"].to_numpy())
                totals[name] = totals.get(name, np.zeros(width)) + reduce_batch(name, x)
        for name, total in totals.items():
            yield pd.DataFrame({"grp": name, "i": np.arange(width), "value": total})

    rows = df.select(group.cast("string").alias("grp"), values.alias("x")).where(F.col("grp").isNotNull())
    sums = rows.mapInPandas(fold, SUMS_SCHEMA).groupBy("grp", "i").agg(F.sum("value").alias("value"))
    found: dict[str, np.ndarray] = {}
    for row in sums.collect():
        found.setdefault(row["grp"], np.zeros(width))[row["i"]] = row["value"]
    return found


@dataclass(frozen=True)
class ClassSums:
    n: float
    total: np.ndarray
    outer: np.ndarray

    def __add__(self, other: ClassSums) -> ClassSums:
        return ClassSums(self.n + other.n, self.total + other.total, self.outer + other.outer)

    def __sub__(self, other: ClassSums) -> ClassSums:
        return ClassSums(self.n - other.n, self.total - other.total, self.outer - other.outer)

    @property
    def mean(self) -> np.ndarray:
        return self.total / self.n

    @property
    def covariance(self) -> np.ndarray:
        return self.outer / self.n - np.outer(self.mean, self.mean)


def class_sums(df: DataFrame, group: Column, features: Column, width: int) -> dict[str, ClassSums]:
    """Count, sum and outer-product sum of the feature array per group."""

    def reduce_batch(_name: str, x: np.ndarray) -> np.ndarray:
        return np.concatenate([[float(len(x))], x.sum(axis=0), (x.T @ x).ravel()])

    found = _grouped_sums(df, group, 1 + width + width * width, reduce_batch, features)
    return {
        name: ClassSums(v[0], v[1 : 1 + width], v[1 + width :].reshape(width, width)) for name, v in found.items()
    }


def automatic_shrinkage(df: DataFrame, group: Column, features: Column, sums: dict[str, ClassSums]) -> dict[str, np.ndarray]:
    """Class covariances shrunk towards a scaled identity with the Ledoit-Wolf weight.

    The weight needs one more statistic, the sum of squared squared norms of the
    standardised rows, hence a second pass over the data.
    """
    centre = {name: s.mean for name, s in sums.items()}
    scale = {name: np.where((d := np.sqrt(np.maximum(np.diag(s.covariance), 0))) > 0, d, 1.0) for name, s in sums.items()}

    def reduce_batch(name: str, x: np.ndarray) -> np.ndarray:
        z = (x - centre[name]) / scale[name]
        return np.array([((z * z).sum(axis=1) ** 2).sum()])

    fourth = _grouped_sums(df, group, 1, reduce_batch, features)
    shrunk = {}
    for name, s in sums.items():
        d = len(s.total)
        cov = s.covariance / np.outer(scale[name], scale[name])
        size = (cov * cov).sum()
        mu = np.trace(cov) / d
        noise = (fourth[name][0] / s.n - size) / (d * s.n)
        spread = (size - 2 * mu * np.trace(cov) + d * mu * mu) / d
        weight = min(noise, spread) / spread if spread > 0 else 0.0
        mixed = (1 - weight) * cov + weight * mu * np.eye(d)
        shrunk[name] = mixed * np.outer(scale[name], scale[name])
    return shrunk


@dataclass(frozen=True)
class Discriminant:
    """Linear class scores ``x @ weights + offsets``; ``classes`` in column order."""

    classes: list[str]
    weights: np.ndarray
    offsets: np.ndarray

    def probabilities(self, features: Column) -> Column:
        """Array of class probabilities."""
        weights, offsets = self.weights, self.offsets

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def score(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return rows
            z = np.stack(rows.to_numpy()) @ weights + offsets
            e = np.exp(z - z.max(axis=1, keepdims=True))
            return pd.Series(list(e / e.sum(axis=1, keepdims=True)))

        return score(features)

    def predict(self, df: DataFrame, features: str = "x", out: str = "p_") -> DataFrame:
        """Add one probability column per class."""
        [values] = unused(df.columns, "p")
        scored = df.withColumn(values, self.probabilities(F.col(features)))
        return scored.withColumns({f"{out}{c}": F.col(values)[i] for i, c in enumerate(self.classes)}).drop(values)


def solve(sums: dict[str, ClassSums], covariances: dict[str, np.ndarray] | None = None, keep: list[int] | None = None) -> Discriminant:
    """Least-squares discriminant on the feature subset ``keep``."""
    classes = sorted(sums, key=float)
    n = sum(s.n for s in sums.values())
    index = np.arange(len(sums[classes[0]].total)) if keep is None else np.array(keep)
    pooled = sum((sums[c].n / n) * (sums[c].covariance if covariances is None else covariances[c]) for c in classes)
    pooled = pooled[np.ix_(index, index)]
    means = np.stack([sums[c].mean[index] for c in classes])
    coefficients = np.linalg.lstsq(pooled, means.T, rcond=None)[0]
    priors = np.array([sums[c].n / n for c in classes])
    offsets = -0.5 * np.einsum("ij,ji->i", means, coefficients) + np.log(priors)
    return Discriminant(classes, coefficients, offsets)


def fit(df: DataFrame, label: str, features: str, width: int, shrink: bool = True) -> Discriminant:
    sums = class_sums(df, F.col(label), F.col(features), width)
    covariances = automatic_shrinkage(df, F.col(label), F.col(features), sums) if shrink else None
    return solve(sums, covariances)


def class_statistics(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Class sizes, means and (population) covariances as rows, all inside Spark."""
    stats = [F.count("*").alias("n")]
    stats += [F.avg(f"`{c}`").alias(f"mean_{c}") for c in columns]
    stats += [
        F.covar_pop(f"`{a}`", f"`{b}`").alias(f"cov_{a}_{b}") for i, a in enumerate(columns) for b in columns[i:]
    ]
    return df.groupBy(label).agg(*stats)


def standardized(df: DataFrame, features: str, width: int) -> DataFrame:
    """The feature arrays with mean 0 and deviation 1 (constant features: deviation 0)."""
    cells = [F.col(features)[i] for i in range(width)]
    found = df.agg(*[f(c) for c in cells for f in (F.avg, F.stddev_pop)]).first()
    scaled = [(c - (found[2 * i] or 0.0)) / (found[2 * i + 1] or 1.0) for i, c in enumerate(cells)]
    return df.withColumn(features, F.array(*scaled))


def forward_select(
    df: DataFrame, label: str, features: str, names: list[str], fold: str, folds: int = 5, keep: int | None = None
) -> list[str]:
    """Greedy forward selection by cross-validated accuracy of the discriminant.

    Statistics of a training fold are the total minus the held-out fold's, so
    one pass serves every fit; each round scores all remaining candidates in
    one more pass. Features are centred and scaled first: that changes no
    discriminant, and keeps sums of squares of large values from cancelling.
    """
    keep = keep or max(1, len(names) // 2)
    df = standardized(df, features, len(names))
    both = F.concat_ws("|", F.col(fold), F.col(label))
    parts = class_sums(df, both, F.col(features), len(names))
    by_fold = [{g.split("|")[1]: s for g, s in parts.items() if g.split("|")[0] == str(k)} for k in range(folds)]
    total: dict[str, ClassSums] = {}
    for part in by_fold:
        for c, s in part.items():
            total[c] = total[c] + s if c in total else s
    training = [
        {c: total[c] - part[c] if c in part else total[c] for c in total if c not in part or total[c].n > part[c].n}
        for part in by_fold
    ]
    chosen: list[int] = []
    while len(chosen) < keep:
        candidates = [i for i in range(len(names)) if i not in chosen]
        models = [[solve(sums, keep=[*chosen, i]) for i in candidates] for sums in training]
        fixed = list(chosen)

        def hits(name: str, x: np.ndarray) -> np.ndarray:
            held, truth = name.split("|")
            right = []
            for i, model in zip(candidates, models[int(held)]):
                best = (x[:, [*fixed, i]] @ model.weights + model.offsets).argmax(axis=1)
                right.append(float((np.array(model.classes)[best] == truth).sum()))
            return np.array(right)

        counted = _grouped_sums(df, both, len(candidates), hits, F.col(features))
        # Mean of the folds' accuracies.
        accuracy = np.zeros(len(candidates))
        for k in range(folds):
            of_fold = [g for g in counted if g.split("|")[0] == str(k)]
            size = sum(parts[g].n for g in of_fold)
            accuracy += sum(counted[g] for g in of_fold) / size if size else 0.0
        chosen.append(candidates[int(accuracy.argmax())])
    return [names[i] for i in chosen]
