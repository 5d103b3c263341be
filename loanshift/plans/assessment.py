"""Assessment of every state's models on its test rows: areas, their weighted mean, calibration, predictions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanshift.functions.states import LIVE_STATES
from loanshift.operators import discriminant, metrics, models
from loanshift.session import materialize

GROUP = ["cur", "target"]


@dataclass(frozen=True)
class StateAssessment:
    """``scored`` rows (keep..., cur, truth, target, p, y); areas and calibration per state and target,
    weighted area per state, the likeliest target per row."""

    scored: DataFrame
    areas: DataFrame
    weighted: DataFrame
    calibration: DataFrame
    predictions: DataFrame


def assess(scored: DataFrame, key: list[str], strategy: str = "quantile") -> StateAssessment:
    """``scored`` is (key..., cur, truth, target, p); it is stored, since four results read it."""
    rows = materialize(scored.withColumn("y", (F.col("truth") == F.col("target")).cast("int")))
    areas = metrics.curve_areas(metrics.roc_points(rows, GROUP), GROUP)
    return StateAssessment(
        rows, areas, metrics.ovr_auc(areas, ["cur"]), metrics.calibration(rows, GROUP, strategy=strategy),
        metrics.hard_prediction(rows, [*key, "cur", "truth"]),
    )


def logit_scores(test: DataFrame, fitted: dict, key: list[str]) -> DataFrame:
    """Test rows under the softmax regression of their own state."""
    return models.score_states(test, fitted, [*key, F.col("Next_Status").alias("truth")])


def discriminant_scores(
    train: DataFrame, test: DataFrame, numeric: list[str], categorical: list[str], key: list[str], states: list[int] | None = None
) -> DataFrame:
    """Test rows under the shrunken discriminant of their own state, trained on the same prepared features.

    A state with fewer than two classes among its training rows has no model and no scores.
    """

    def score(state: int) -> DataFrame | None:
        own, other = (models.state_rows(t, state, [*numeric, *categorical]) for t in (train, test))
        own = materialize(own)
        if own.select("Next_Status").distinct().count() < 2:
            return None
        steps = models.feature_pipeline(numeric, categorical).fit(own)
        arrays, unseen = (steps.transform(t).withColumn("x", vector_to_array("features")) for t in (own, other))
        fitted = discriminant.fit(arrays, "Next_Status", "x", len(models.feature_names(arrays)))
        columns = {int(c): f"p_{c}" for c in fitted.classes}
        long = metrics.melt_scores(fitted.predict(unseen), columns, [*key, "Next_Status"], truth="Next_Status")
        return long.select(*key, F.lit(state).alias("cur"), F.col("Next_Status").alias("truth"), "target", "p")

    found = models._at_once(train.sparkSession, score, states or LIVE_STATES, 7)
    return reduce(DataFrame.unionByName, [part for part in found.values() if part is not None])
