"""Groups, keys and cohorts that are null, columns of the caller, and matrices counted from the records."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import adapter as A
from checks.lookup_checks import _rows
from checks.registry import query
from loanshift.operators import lookups, matrix, metrics, profile


def _rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


_COHORTS = """
  c as (select nullif(State, 1) as cohort, Current_Status as cur, Next_Status as nxt, count(*) as n
        from transitions group by 1, 2, 3),
  g as (select distinct cohort from c),
  cells as (
    select g.cohort, a.s as cur, b.s as nxt, coalesce(n, 0) as n,
           coalesce(n / sum(n) over (partition by g.cohort, a.s), 0) as p
    from g cross join states a cross join states b
    left join c on c.cohort is not distinct from g.cohort and c.cur = a.s and c.nxt = b.s)"""


def _cohort_matrix(spark, sf):
    rows = A.transitions(spark, sf).withColumn("cohort", F.nullif("State", F.lit(1)))
    return matrix.transition_matrix(matrix.transition_counts(rows, ["cohort"]), ["cohort"])


@query(f"with {_COHORTS} select * from cells")
def transition_matrix_null_cohort(spark, sf):
    """One cohort is null and keeps its moves."""
    return _cohort_matrix(spark, sf)


@query(f"""with {_COHORTS}
  select cohort, nxt as state, round(sum(p), 9) as incoming, sum(n) / sum(sum(n)) over (partition by cohort) as share
  from cells group by 1, 2""")
def state_distribution_by_state(spark, sf):
    return _rounded(matrix.state_distribution(_cohort_matrix(spark, sf), ["cohort"]), 9, "incoming")


_NULL_GROUP = "s as (select *, nullif(target, 0) as class from scored)"


def _null_group(spark, sf):
    return A.scored(spark, sf).withColumn("class", F.nullif("target", F.lit(0)))


@query(f"""with {_NULL_GROUP},
  counts as (select class, p, cast(sum(y) as bigint) as pos, cast(sum(1 - y) as bigint) as neg from s group by 1, 2)
  select class, p, cast(sum(pos) over w as bigint) as tp, cast(sum(neg) over w as bigint) as fp,
         sum(pos) over w / nullif(sum(pos) over c, 0) as tpr
  from counts window w as (partition by class order by p desc), c as (partition by class)""")
def roc_null_group(spark, sf):
    return metrics.roc_points(_null_group(spark, sf), ["class"]).select("class", "p", "tp", "fp", "tpr")


@query(f"""with {_NULL_GROUP},
  q as (select class, quantile_cont(p, [0.2, 0.4, 0.6, 0.8]) as e from s group by 1)
  select s.class, (p > e[1])::int + (p > e[2])::int + (p > e[3])::int + (p > e[4])::int as bin, count(*) as n,
         round(avg(p), 9) as prob_pred, round(avg(y), 9) as prob_true
  from s join q on s.class is not distinct from q.class group by 1, 2""")
def calibration_null_group(spark, sf):
    return _rounded(metrics.calibration(_null_group(spark, sf), ["class"]), 9, "prob_pred", "prob_true")


@query("""
  select key, Seq, target, raw / sum(raw) over (partition by key, Seq) as p
  from (select *, case when Loan_ID % 3 <> 0 then Loan_ID end as key from raw_scores)""")
def ovr_normalize_null_key(spark, sf):
    rows = A.scores(spark, sf).withColumn("key", F.when(F.col("Loan_ID") % 3 != 0, F.col("Loan_ID")))
    return metrics.normalize_ovr(rows, ["key", "Seq"]).select("key", "Seq", "target", "p")


@query("""
  select Loan_ID, Seq, Loan_ID as _note, State as "_on_State_Judicial", Seq as _Curr_zip, Curr_HPI, Benchmark_Rate, Curr_URate,
         Judicial, "10-2Spread" as spread from enriched""")
def lookup_keeps_columns(spark, sf):
    """Every lookup on a table that has columns named as scratch columns might be."""
    rows = _rows(spark, sf).withColumns(
        {"_note": F.col("Loan_ID"), "_on_State_Judicial": F.col("State"), "_Curr_zip": F.col("Seq")}
    )
    series = A.dimensions(spark, sf)
    rows = lookups.add_price_index(rows, series.zip_index, series.state_index)
    rows = lookups.add_unemployment(lookups.add_rates(rows, series.rates), series.metro_unemployment, series.state_unemployment)
    rows = lookups.add_spread(lookups.add_judicial(rows, series.judicial), series.spread)
    return rows.select(
        "Loan_ID", "Seq", "_note", "_on_State_Judicial", "_Curr_zip", "Curr_HPI", "Benchmark_Rate", "Curr_URate", "Judicial",
        F.col("10-2Spread").alias("spread"),
    )


_COUNTED = """
  c as (select State, Current_Status as cur, Next_Status as nxt, count(*) as n from transitions group by 1, 2, 3),
  g as (select distinct State from c),
  whole as (
    select g.State, a.s as cur, b.s as nxt,
           case when a.s between 0 and 6 and sum(n) over (partition by g.State, a.s) > 0
                then coalesce(n, 0) / sum(n) over (partition by g.State, a.s) else (a.s = b.s)::int end as p
    from g cross join states a cross join states b
    left join c on c.State = g.State and c.cur = a.s and c.nxt = b.s)"""
_POWERS = """,
  m2 as (select a.State, a.cur, b.nxt, sum(a.p * b.p) as p from whole a join whole b on a.State = b.State and a.nxt = b.cur group by 1, 2, 3),
  m4 as (select a.State, a.cur, b.nxt, sum(a.p * b.p) as p from m2 a join m2 b on a.State = b.State and a.nxt = b.cur group by 1, 2, 3),
  m6 as (select a.State, a.cur, b.nxt, sum(a.p * b.p) as p from m4 a join m2 b on a.State = b.State and a.nxt = b.cur group by 1, 2, 3)"""


def _counted(spark, sf):
    """One-month matrix of every cohort, from its counted moves; a state never left keeps its mass."""
    counts = matrix.transition_counts(A.transitions(spark, sf), ["State"])
    return matrix.loan_matrices(matrix.transition_matrix(counts, ["State"]), key="State", missing="stay")


@query(f"with {_COUNTED} select State, cur, nxt, p from whole")
def counted_matrix_one_month(spark, sf):
    return matrix.matrix_cells(_counted(spark, sf), "State")


@query(f"with {_COUNTED}{_POWERS} select State, cur, nxt, round(p, 9) as p from m6")
def counted_matrix_k6(spark, sf):
    """Six months ahead from every state, per cohort."""
    return _rounded(matrix.horizon(_counted(spark, sf), months=6, method="power", full=True, key="State"), 9, "p")


@query(f"""with {_COUNTED}{_POWERS}
  select r.State, r.Loan_ID, r.Seq, nxt, round(p, 9) as p
  from transitions r join m6 on m6.State = r.State and m6.cur = r.Current_Status""")
def counted_horizon_per_record(spark, sf):
    """Six-month distribution of every record from its own state and cohort."""
    ahead = matrix.horizon(_counted(spark, sf), months=6, method="power", full=True, key="State")
    rows = A.transitions(spark, sf).select("State", "Loan_ID", "Seq", F.col("Current_Status").alias("cur"))
    return _rounded(rows.join(ahead, ["State", "cur"]).drop("cur"), 9, "p")


@query("""
  select event_type as "group", count(value) as n, true as q1, true as median, true as q3
  from events where event_type is not null and value is not null group by 1""")
def box_stats_approx(spark, sf):
    """Sketched quartiles lie within a thousandth of their rank, in every group."""
    events = A.table(spark, sf, "events")
    found = profile.box_stats(events, "value", F.col("event_type"), accuracy=10_000)
    rows = events.where("value is not null").join(found.select(F.col("group").alias("event_type"), "q1", "median", "q3"), "event_type")
    within = []
    for name, share in profile.QUARTILES.items():
        below, upto = F.avg((F.col("value") < F.col(name)).cast("int")), F.avg((F.col("value") <= F.col(name)).cast("int"))
        within.append(((below <= share + 0.001) & (upto >= share - 0.001)).alias(name))
    return rows.groupBy(F.col("event_type").alias("group")).agg(F.count("value").alias("n"), *within)
