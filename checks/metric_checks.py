"""Probability metrics on a fixed score, and transition matrices over months."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import adapter as A
from checks.registry import query
from loanshift.functions.states import STATES
from loanshift.operators import matrix, metrics

CLASS = ["cur", "target"]


def _rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("select Loan_ID, Seq, target, p from scored")
def ovr_normalize(spark, sf):
    rows = metrics.normalize_ovr(A.scores(spark, sf), ["Loan_ID", "Seq"])
    return rows.select("Loan_ID", "Seq", "target", "p")


@query("select Loan_ID, Seq, target, p, y from scored")
def ovr_normalize_wide(spark, sf):
    return A.scored(spark, sf).select("Loan_ID", "Seq", "target", "p", "y")


_POINTS = """
  counts as (select cur, target, p, cast(sum(y) as bigint) as pos, cast(sum(1 - y) as bigint) as neg
             from scored group by 1, 2, 3),
  points as (select *, cast(sum(pos) over w as bigint) as tp, cast(sum(neg) over w as bigint) as fp,
                    cast(sum(pos) over c as bigint) as pp, cast(sum(neg) over c as bigint) as nn
             from counts window w as (partition by cur, target order by p desc), c as (partition by cur, target))"""


@query(f"""with {_POINTS}
  select cur, target, p, tp, fp, tp / nullif(pp, 0) as tpr, fp / nullif(nn, 0) as fpr from points""")
def roc_points(spark, sf):
    return metrics.roc_points(A.scored(spark, sf), CLASS).select(*CLASS, "p", "tp", "fp", "tpr", "fpr")


@query(f"""with {_POINTS}
  select cur, target, p, tp, fp from points""")
def hot_class_roc(spark, sf):
    """The same curve with every class above the size for one task."""
    return metrics.roc_points(A.scored(spark, sf), CLASS, hot_rows=1000).select(*CLASS, "p", "tp", "fp")


_AREAS = f"""{_POINTS},
  areas as (select cur, target, pp, nn,
                   cast(sum(neg::hugeint * (2 * tp - pos)) as double) / (2e0 * nullif(pp, 0) * nullif(nn, 0)) as roc_auc,
                   sum(pos * (tp / (tp + fp))) / nullif(pp, 0) as pr_auc
            from points group by 1, 2, 3, 4)"""


@query(f"""with {_AREAS}
  select cur, target, pp as positives, nn as negatives, roc_auc, round(pr_auc, 9) as pr_auc from areas""")
def curve_areas(spark, sf):
    points = metrics.roc_points(A.scored(spark, sf), CLASS)
    return _rounded(metrics.curve_areas(points, CLASS), 9, "pr_auc")


@query(f"""with {_AREAS},
  bins as (
    select cur, target, least(floor(p * 256), 255) as bin, sum(y) as pos, sum(1 - y) as neg from scored group by 1, 2, 3),
  higher as (select *, coalesce(sum(pos) over (partition by cur, target order by bin desc rows between unbounded preceding and 1 preceding), 0) as above from bins),
  rough as (
    select cur, target, cast(sum(pos) as bigint) as positives, cast(sum(neg) as bigint) as negatives,
           cast(sum(neg * (2 * above + pos)) as double) / nullif(2e0 * sum(pos) * sum(neg), 0) as roc_auc,
           cast(sum(pos * neg) as double) / nullif(2e0 * sum(pos) * sum(neg), 0) as error
    from higher group by 1, 2)
  select cur, target, positives, negatives, round(r.roc_auc, 9) as roc_auc, round(error, 9) as error,
         abs(r.roc_auc - a.roc_auc) <= error + 1e-12 as within
  from rough r join areas a using (cur, target)""")
def auc_ovr_approx(spark, sf):
    """Areas from class histograms of 256 bins, with the bound on their error, beside the exact ones."""
    scored = A.scored(spark, sf)
    rough = metrics.sketch_areas(metrics.score_sketch(scored, CLASS, bins=256), CLASS)
    exact = metrics.curve_areas(metrics.roc_points(scored, CLASS), CLASS).select(*CLASS, F.col("roc_auc").alias("exact"))
    within = F.abs(F.col("roc_auc") - F.col("exact")) <= F.col("error") + 1e-12
    found = rough.join(exact, CLASS).withColumn("within", within).drop("exact")
    return _rounded(found, 9, "roc_auc", "error")


@query(f"""with {_AREAS}
  select cur, round(avg(roc_auc), 9) as macro_auc, round(sum(roc_auc * pp) / sum(pp), 9) as weighted_auc,
         count(*) as classes from areas where roc_auc is not null group by 1""")
def auc_ovr(spark, sf):
    points = metrics.roc_points(A.scored(spark, sf), CLASS)
    areas = metrics.ovr_auc(metrics.curve_areas(points, CLASS), ["cur"])
    return _rounded(areas, 9, "macro_auc", "weighted_auc")


@query("""
  select cur, target, count(*) as n, cast(sum(y) as bigint) as positives,
         coalesce(count(*) filter (p > 0.3 and y = 1) / nullif(count(*) filter (p > 0.3), 0), 0) as precision,
         coalesce(count(*) filter (p > 0.3 and y = 1) / nullif(sum(y), 0), 0) as recall,
         round(avg((p - y) * (p - y)), 9) as brier,
         round(avg(-case when y = 1 then ln(greatest(1e-15, least(1 - 1e-15, p))) else ln(1 - greatest(1e-15, least(1 - 1e-15, p))) end), 9) as log_loss
  from scored group by 1, 2""")
def brier_logloss(spark, sf):
    return _rounded(metrics.threshold_metrics(A.scored(spark, sf), CLASS, threshold=0.3), 9, "brier", "log_loss")


@query("""
  with e as (select cur, target, quantile_cont(p, [0.2, 0.4, 0.6, 0.8]) as q from scored group by 1, 2)
  select cur, target, cast((q[1] < p)::int + (q[2] < p)::int + (q[3] < p)::int + (q[4] < p)::int as integer) as bin,
         count(*) as n, round(avg(p), 9) as prob_pred, round(avg(y), 9) as prob_true
  from scored join e using (cur, target) group by 1, 2, 3""")
def calibration_quantile(spark, sf):
    return _rounded(metrics.calibration(A.scored(spark, sf), CLASS), 9, "prob_pred", "prob_true")


@query("""
  select cur, target, cast((0.2e0 < p)::int + (0.4e0 < p)::int + (0.6e0 < p)::int + (0.8e0 < p)::int as integer) as bin,
         count(*) as n, round(avg(p), 9) as prob_pred, round(avg(y), 9) as prob_true from scored group by 1, 2, 3""")
def calibration_uniform(spark, sf):
    found = metrics.calibration(A.scored(spark, sf), CLASS, strategy="uniform")
    return _rounded(found, 9, "prob_pred", "prob_true")


def _predicted(spark, sf):
    return metrics.argmax(A.scored_wide(spark, sf), A.SCORES)


@query("select Loan_ID, Seq, prediction from predicted")
def hard_prediction(spark, sf):
    rows = metrics.hard_prediction(A.scored(spark, sf), ["Loan_ID", "Seq"])
    return rows.select("Loan_ID", "Seq", "prediction")


@query("select Loan_ID, Seq, prediction from predicted")
def hard_prediction_wide(spark, sf):
    return _predicted(spark, sf).select("Loan_ID", "Seq", "prediction")


@query("select cur, truth, prediction, count(*) as n from predicted group by 1, 2, 3")
def confusion(spark, sf):
    return metrics.confusion(_predicted(spark, sf), by=["cur"])


@query("""
  with cells as (select truth, prediction, count(*) as n from predicted group by 1, 2),
  per as (select s as label,
                 coalesce(sum(n) filter (truth = s and prediction = s), 0) as hit,
                 coalesce(sum(n) filter (truth = s), 0) as support, coalesce(sum(n) filter (prediction = s), 0) as named
          from states join cells on truth = s or prediction = s group by 1),
  rated as (select *, coalesce(hit / nullif(named, 0), 0) as precision, coalesce(hit / nullif(support, 0), 0) as recall from per),
  full_ as (select *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) as f1 from rated),
  out_ as (
    select cast(label as varchar) as label, precision, recall, f1, cast(support as bigint) as support from full_
    union all select 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), cast(sum(support) as bigint) from full_
    union all select 'macro avg', avg(precision), avg(recall), avg(f1), cast(sum(support) as bigint) from full_
    union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                     sum(f1 * support) / sum(support), cast(sum(support) as bigint) from full_)
  select label, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1, support from out_""")
def class_report(spark, sf):
    report = metrics.class_report(metrics.confusion(_predicted(spark, sf)))
    return _rounded(report, 9, "precision", "recall", "f1")


@query("""
  select Loan_ID, """ + ", ".join(
    f"coalesce(sum(p) filter (nxt = {s}), 0) as slot_{i}" for i, s in enumerate(STATES)) + """
  from matrices where cur = 2 group by 1""")
def matrix_pad(spark, sf):
    padded = matrix.pad_states(A.matrix_rows(spark, sf).where("cur = 2"), ["Loan_ID"])
    return padded.select("Loan_ID", *[F.col("slots")[i].alias(f"slot_{i}") for i in range(len(STATES))])


@query("""
  select c_custkey as Loan_ID, a.s as cur, b.s as nxt, coalesce(p, 0) as p
  from customer cross join states a cross join states b
  left join full_matrices m on m.Loan_ID = c_custkey and m.cur = a.s and m.nxt = b.s""")
def matrix_one_month(spark, sf):
    return matrix.matrix_cells(matrix.loan_matrices(A.matrix_rows(spark, sf)))


_POWER = """
  m2 as (select a.Loan_ID, a.cur, b.nxt, sum(a.p * b.p) as p from full_matrices a
         join full_matrices b on a.Loan_ID = b.Loan_ID and a.nxt = b.cur group by 1, 2, 3),
  m4 as (select a.Loan_ID, a.cur, b.nxt, sum(a.p * b.p) as p from m2 a
         join m2 b on a.Loan_ID = b.Loan_ID and a.nxt = b.cur group by 1, 2, 3),
  m6 as (select a.Loan_ID, a.cur, b.nxt, sum(a.p * b.p) as p from m4 a
         join m2 b on a.Loan_ID = b.Loan_ID and a.nxt = b.cur group by 1, 2, 3)"""


@query(f"""with {_POWER}
  select c_custkey as Loan_ID, a.s as cur, b.s as nxt, round(coalesce(p, 0), 9) as p
  from customer cross join states a cross join states b
  left join m6 m on m.Loan_ID = c_custkey and m.cur = a.s and m.nxt = b.s""")
def matrix_power_k6(spark, sf):
    matrices = matrix.loan_matrices(A.matrix_rows(spark, sf))
    return _rounded(matrix.horizon(matrices, months=6, method="power", full=True), 9, "p")


@query(f"""with {_POWER}
  select c_custkey as Loan_ID, s as nxt, round(coalesce(p, 0), 9) as p
  from customer cross join states left join m6 m on m.Loan_ID = c_custkey and m.cur = 0 and m.nxt = s""")
def horizon_from_current(spark, sf):
    matrices = matrix.loan_matrices(A.matrix_rows(spark, sf))
    return _rounded(matrix.horizon(matrices, state=0, months=6, method="power"), 9, "p")


def _walk_sql(months, paths, seed):
    steps = []
    for month in range(months):
        before = "0" if month == 0 else "spot"
        source = "starts" if month == 0 else f"step{month - 1}"
        counter = f"((base + (path * {months} + {month}) * {matrix.GOLDEN}) & {matrix.MASK32})"
        mixed = counter
        for shift, factor in matrix.MIX_STEPS:
            mixed = f"xor({mixed}, {mixed} >> {shift})" if factor == 1 else f"((xor({mixed}, {mixed} >> {shift}) * {factor}) & {matrix.MASK32})"
        passed = " + ".join(f"(c.upto[{i}] <= w.u * c.upto[9])::integer" for i in range(1, 9))
        steps.append(f"""
          step{month} as (
            select w.Loan_ID, w.path, w.base, -1 + {passed} as spot
            from (select Loan_ID, path, base, {before} as spot, {mixed} / 4294967296e0 as u from {source}) w
            join cumulative c on c.Loan_ID = w.Loan_ID and c.cur = w.spot)""")
    return f"""
      with cells as (
        select c_custkey as Loan_ID, a.s as cur, b.s as nxt, coalesce(p, 0) as p
        from customer cross join states a cross join states b
        left join full_matrices m on m.Loan_ID = c_custkey and m.cur = a.s and m.nxt = b.s),
      cumulative as (
        select Loan_ID, cur, list(upto order by nxt) as upto from (
          select *, sum(p) over (partition by Loan_ID, cur order by nxt) as upto from cells) group by 1, 2),
      starts as (
        select c_custkey as Loan_ID, r as path, ('0x' || substr(md5(concat_ws('|', c_custkey, '{seed}')), 1, 8))::bigint as base
        from customer cross join range({paths}) t(r)), {", ".join(steps)}
      select Loan_ID, spot as nxt, count(*) as n, count(*) / {paths}e0 as p from step{months - 1} group by 1, 2"""


@query(_walk_sql(3, 100, 1))
def path_shares(spark, sf):
    """Sampled horizons for every loan: 100 walks of 3 months each."""
    matrices = matrix.loan_matrices(A.matrix_rows(spark, sf))
    return matrix.sampled_horizon(matrices, state=0, months=3, paths=100, seed=1)


@query(_walk_sql(6, 10_000, 1))
def path_shares_full(spark, sf):
    """Sampled horizons for every loan at the operator's defaults: 10,000 walks of 6 months each."""
    return matrix.sampled_horizon(matrix.loan_matrices(A.matrix_rows(spark, sf)), state=0)
