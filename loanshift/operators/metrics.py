"""Distributed evaluation of class probabilities.

Input rows are (``by`` columns..., ``y`` 0/1, ``p``): one row per record and
class. Curves work on counts per distinct score, never on ordered raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanshift.functions.names import join_groups, unused
from loanshift.operators.ordered import HOT_ROWS, Scan, scan
from loanshift.operators.quantiles import quantiles_of
from loanshift.session import materialize


def normalize_ovr(scored: DataFrame, key: list[str], raw: str = "raw", out: str = "p") -> DataFrame:
    """Divide each class score by the record's sum over its classes (long form).

    At most nine rows per record share a window; a null key is a record too.
    """
    total = F.sum(raw).over(Window.partitionBy(*key))
    return scored.withColumn(out, F.try_divide(F.col(raw), total))


def normalize_wide(scored: DataFrame, columns: list[str]) -> DataFrame:
    """The same for one column per class: arithmetic only."""
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    [whole] = unused(scored.columns, "sum")
    out = scored.withColumn(whole, total)
    return out.withColumns({c: F.try_divide(F.col(c), F.col(whole)) for c in columns}).drop(whole)


def melt_scores(scored: DataFrame, columns: dict, keep: list[str], truth: str = "truth") -> DataFrame:
    """One probability column per class to rows (keep..., target, p, y)."""
    cells = [F.struct(F.lit(label).alias("target"), F.col(f"`{c}`").alias("p")) for label, c in columns.items()]
    [cell] = unused(keep, "cell")
    long = scored.select(*keep, F.explode(F.array(*cells)).alias(cell)).select(*keep, f"{cell}.*")
    return long.withColumn("y", (F.col(truth) == F.col("target")).cast("int"))


def score_counts(scored: DataFrame, by: list[str], round_to: int | None = None) -> DataFrame:
    """Positives and negatives per distinct score; ``round_to`` merges near-equal scores."""
    p = F.col("p") if round_to is None else F.round("p", round_to)
    return scored.groupBy(*by, p.alias("p")).agg(
        F.sum(F.col("y").cast("bigint")).alias("pos"), F.sum((1 - F.col("y")).cast("bigint")).alias("neg")
    )


def roc_points(
    scored: DataFrame, by: list[str], round_to: int | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One point per distinct score, from the highest: cumulative and class totals and rates."""
    # Written out: it is counted, scanned and totalled, and scoring may be costly.
    return points_of_counts(materialize(score_counts(scored, by, round_to)), by, hot_rows)


def points_of_counts(counts: DataFrame, by: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``roc_points`` from stored counts ``(by..., p, pos, neg)``, one row per distinct score."""
    curve = scan(counts, by, [F.col("p").desc()], Scan(running_sum={"tp": "pos", "fp": "neg"}), hot_rows)
    totals = materialize(
        counts.groupBy(*by).agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    )
    return join_groups(curve, totals, by).withColumns(
        {"tpr": F.try_divide(F.col("tp"), F.col("positives")), "fpr": F.try_divide(F.col("fp"), F.col("negatives"))}
    )


def score_sketch(scored: DataFrame, by: list[str], bins: int = 4096) -> DataFrame:
    """``(by..., bin, pos, neg)``: class counts in equal bins of scores from 0 to 1, at most ``bins`` rows a group.

    Sketches of parts of a table add up: group their union by (by, bin) and sum.
    Rows without a score are left out.
    """
    bin_ = F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).cast("int").alias("bin")
    return scored.where(F.col("p").isNotNull()).groupBy(*by, bin_).agg(
        F.sum(F.col("y").cast("bigint")).alias("pos"), F.sum((1 - F.col("y")).cast("bigint")).alias("neg")
    )


def sketch_areas(sketch: DataFrame, by: list[str]) -> DataFrame:
    """``(by..., positives, negatives, roc_auc, error)``: the exact area is within ``error`` of ``roc_auc``.

    Pairs of unlike class in one bin count half, as ties do; whichever way they
    fall, the area moves by no more than half their share of all pairs.
    """
    # A group has no more rows than bins.
    above = Window.partitionBy(*by).orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, -1)
    higher, pairs, same = unused([*by, *sketch.columns], "higher", "pairs", "same")
    placed = sketch.withColumn(higher, F.coalesce(F.sum("pos").over(above), F.lit(0)))
    wide = "decimal(38,0)"
    won = F.col("neg").cast(wide) * (2 * F.col(higher) + F.col("pos")).cast(wide)
    sums = placed.groupBy(*by).agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), F.sum(won).cast("double").alias(pairs),
        F.sum(F.col("pos").cast(wide) * F.col("neg").cast(wide)).cast("double").alias(same),
    )
    every = 2.0 * F.col("positives") * F.col("negatives")
    return sums.select(
        *by, "positives", "negatives", F.try_divide(F.col(pairs), every).alias("roc_auc"), F.try_divide(F.col(same), every).alias("error")
    )


def curve_areas(points: DataFrame, by: list[str]) -> DataFrame:
    """Tie-aware ROC area and average precision from ``roc_points``."""
    wide, (pairs_, ap) = "decimal(38,0)", unused(by, "pairs", "ap")
    pairs = F.col("neg").cast(wide) * (2 * F.col("tp") - F.col("pos")).cast(wide)
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return (
        points.groupBy(*by, "positives", "negatives")
        .agg(F.sum(pairs.cast(wide)).cast("double").alias(pairs_), F.sum(F.col("pos") * precision).alias(ap))
        .select(
            *by,
            "positives",
            "negatives",
            F.try_divide(F.col(pairs_), 2.0 * F.col("positives") * F.col("negatives")).alias("roc_auc"),
            F.try_divide(F.col(ap), F.col("positives")).alias("pr_auc"),
        )
    )


def ovr_auc(areas: DataFrame, by: list[str]) -> DataFrame:
    """Macro and prevalence-weighted mean of the per-class areas, over classes that have one."""
    usable = areas.where(F.col("roc_auc").isNotNull())
    return usable.groupBy(*by).agg(
        F.avg("roc_auc").alias("macro_auc"),
        (F.sum(F.col("roc_auc") * F.col("positives")) / F.sum("positives")).alias("weighted_auc"),
        F.count("*").alias("classes"),
    )


def threshold_metrics(scored: DataFrame, by: list[str], threshold: float = 0.5, eps: float = 1e-15) -> DataFrame:
    """Precision, recall, Brier score and log loss; no predicted positive gives precision 0."""
    hit, (right, hits) = F.col("p") > threshold, unused(by, "right", "hits")
    p = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), F.col("p")))
    loss = -F.when(F.col("y") == 1, F.log(p)).otherwise(F.log(1 - p))
    counted = scored.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sum(F.col("y").cast("bigint")).alias("positives"),
        F.count_if(hit & (F.col("y") == 1)).alias(right),
        F.count_if(hit).alias(hits),
        F.avg((F.col("p") - F.col("y")) * (F.col("p") - F.col("y"))).alias("brier"),
        F.avg(loss).alias("log_loss"),
    )

    def share(a, b):
        return F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))

    return counted.select(
        *by,
        "n",
        "positives",
        share(right, hits).alias("precision"),
        share(right, "positives").alias("recall"),
        "brier",
        "log_loss",
    )


def calibration(
    scored: DataFrame, by: list[str], bins: int = 5, strategy: str = "quantile", hot_rows: int = HOT_ROWS,
    accuracy: int = 10_000,
) -> DataFrame:
    """Mean score and share of positives per non-empty score bin.

    A score's bin is the number of inner edges strictly below it. Uniform edges
    are known, and ``approximate`` takes quantile edges from a bounded sketch
    per group, so those rows are binned where they are and only bins are
    shuffled; exact quantiles shuffle a count per distinct score.
    """
    inner = {name: (i + 1) / bins for i, name in enumerate(unused(scored.columns, *[f"edge{i}" for i in range(bins - 1)]))}
    if strategy == "uniform":
        return _binned(scored, by, [F.lit(edge) for edge in inner.values()], F.lit(1), F.col("y"))
    if strategy == "approximate":
        sketch = F.percentile_approx("p", list(inner.values()), accuracy)
        [edges] = unused(scored.columns, "edges")
        found = materialize(scored.groupBy(*by).agg(sketch.alias(edges)))
        return _binned(join_groups(scored, found, by), by, [F.col(edges)[i] for i in range(bins - 1)], F.lit(1), F.col("y"))
    if strategy != "quantile":
        raise ValueError(f"unknown strategy {strategy!r}")
    # Edges and bins both come from the counts, so scoring runs once.
    counts = materialize(score_counts(scored, by).withColumn("n", F.col("pos") + F.col("neg")))
    found = quantiles_of(counts.withColumnRenamed("p", "value"), inner, by, hot_rows)
    return _binned(join_groups(counts, found, by), by, [F.col(e) for e in inner], F.col("n"), F.col("pos"))


def _binned(rows: DataFrame, by: list[str], edges: list[Column], n: Column, positives: Column) -> DataFrame:
    bin_ = sum(((edge < F.col("p")).cast("int") for edge in edges), F.lit(0))
    return rows.groupBy(*by, bin_.alias("bin")).agg(
        F.sum(n).cast("bigint").alias("n"),
        (F.sum(F.col("p") * n) / F.sum(n)).alias("prob_pred"),
        (F.sum(positives) / F.sum(n)).alias("prob_true"),
    )


def hard_prediction(scored: DataFrame, key: list[str], label: str = "target", p: str = "p") -> DataFrame:
    """The class with the highest score per record; the smaller label wins a tie."""
    best = F.max_by(F.col(label), F.struct(F.col(p), -F.col(label)))
    return scored.groupBy(*key).agg(best.alias("prediction"))


def argmax(scored: DataFrame, columns: dict, out: str = "prediction") -> DataFrame:
    """The same from one probability column per class: no shuffle."""
    cells = [F.struct(F.col(f"`{c}`").alias("p"), F.lit(-label).alias("minus")) for label, c in columns.items()]
    return scored.withColumn(out, -F.array_max(F.array(*cells))["minus"])


def confusion(df: DataFrame, truth: str = "truth", prediction: str = "prediction", by: list[str] | None = None):
    return df.groupBy(*(by or []), truth, prediction).agg(F.count("*").alias("n"))


def class_report(cells: DataFrame, truth: str = "truth", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and
    weighted averages, from confusion counts (at most classes squared rows)."""
    none = F.lit(0).cast("bigint")

    def side(label, support, hits):
        return F.struct(F.col(label).alias("label"), support.alias("support"), hits.alias("hits"))

    both = F.array(side(truth, F.col("n"), none), side(prediction, none, F.col("n")))
    correct = F.when(F.col(truth) == F.col(prediction), F.col("n")).otherwise(0)
    sides = cells.select(F.explode(both).alias("s"), correct.alias("right")).select("s.*", "right")
    # A correct cell appears once per side, hence the halving.
    per = sides.groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("hits").alias("hits"), (F.sum("right") / 2).alias("right")
    )

    def share(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    per = per.withColumns(
        {"precision": share(F.col("right"), F.col("hits")), "recall": share(F.col("right"), F.col("support"))}
    )
    f1 = share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    per = per.withColumn("f1", f1)
    scores = ["precision", "recall", "f1"]

    def line(name, weight, values):
        return F.struct(
            name.alias("label"),
            weight.cast("double").alias("weight"),
            *[(v * weight).cast("double").alias(s) for s, v in zip(scores, values)],
        )

    # Every class feeds its own line and the three averages.
    own = [F.col(s) for s in scores]
    lines = F.array(
        line(F.col("label").cast("string"), F.lit(1), own),
        line(F.lit("macro avg"), F.lit(1), own),
        line(F.lit("weighted avg"), F.col("support"), own),
        line(F.lit("accuracy"), F.col("support"), [F.col("recall")] * 3),
    )
    spread = per.select("support", F.explode(lines).alias("l")).select("support", "l.*")
    return spread.groupBy("label").agg(
        *[share(F.sum(s), F.sum("weight")).alias(s) for s in scores], F.sum("support").alias("support")
    )
