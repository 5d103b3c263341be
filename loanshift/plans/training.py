"""Training tables of one current state, and scores judged per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanshift.functions.names import join_groups
from loanshift.operators import features, metrics, models, sampling
from loanshift.session import materialize


def _model_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if c not in features.NOT_FEATURES]


def training_tables(
    transitions: DataFrame,
    state: int,
    numeric: list[str] | None = None,
    categorical: list[str] | None = None,
    test_share: float = 0.2,
    seed: int = sampling.SPLIT_SEED,
    one_hot: bool = False,
    drop_first: bool = True,
    fit_on: str = "train",
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows with keys, label, scaled numeric and categorical columns.

    Scaling is fitted on the training rows, or on all rows with ``fit_on="all"``;
    indicator columns always follow the training rows' categories, so both
    tables have the same columns.
    """
    numeric = _model_columns(features.NUMERIC) if numeric is None else numeric
    categorical = _model_columns(features.CATEGORICAL) if categorical is None else categorical
    rows = models.state_rows(transitions, state, [*numeric, *categorical])
    rows = materialize(sampling.with_split(rows, test_share, seed))
    train = rows.where(F.col("split") == "train")
    out = features.standardize(rows, numeric, fit=rows if fit_on == "all" else train)
    if one_hot:
        out = features.one_hot(out, features.categories_of(train, categorical), drop_first)
    return tuple(out.where(F.col("split") == part).drop("split") for part in ("train", "test"))


def judge(long: DataFrame, by: list[str], round_to: int | None = None) -> DataFrame:
    """ROC and precision-recall areas, precision, recall, Brier score and log loss per group.

    ``round_to`` rounds scores before areas are computed, which makes ties of scores that differ less.
    """
    areas = metrics.curve_areas(metrics.roc_points(long, by, round_to=round_to), by).drop("positives", "negatives")
    return join_groups(metrics.threshold_metrics(long, by), areas, by)


