"""Status, windows, filters, cleaning and the empirical matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import adapter as A
from checks.registry import query
from loanshift.functions import scalars, states
from loanshift.operators import clean, lookups, matrix, panel
from loanshift.operators.ordered import Scan, scan
from loanshift.sources import tables

WHO = ["Loan_ID", "Seq"]


@query("select Loan_ID, Seq, Current_Loan_Delinquency_Status, Current_Status, Age_Prop from status")
def panel_status(spark, sf):
    return panel.encode(A.records(spark, sf)).select(
        *WHO, "Current_Loan_Delinquency_Status", "Current_Status", "Age_Prop"
    )


@query("""
  select Loan_ID, Seq, try_cast(enc as integer) as Current_Status
  from (select *, case when Zero_Balance_Code = 1 then '-1'
                       when Current_Loan_Delinquency_Status = 'XX' and Num_Bo = '2' then '7'
                       when Current_Loan_Delinquency_Status = 'XX' then '999'
                       else Current_Loan_Delinquency_Status end as enc from records)""")
def credit_event_status(spark, sf):
    code = F.when(F.col("Zero_Balance_Code") == 1, F.lit(1.0)).when(F.col("Num_Bo") == "2", F.lit(9.0))
    rows = A.records(spark, sf).withColumn("Zero_Balance_Code", code)
    return panel.encode(rows, credit_event_as_default=True).select(*WHO, "Current_Status")


@query("select Loan_ID, Seq, Current_Status, Next_Status, Cum_Max_Status, Cum_Count from history")
def panel_windows(spark, sf):
    return A.history(spark, sf).select(*WHO, "Current_Status", "Next_Status", "Cum_Max_Status", "Cum_Count")


@query("select Loan_ID, Seq, Rem_Filled as Rem_Months from history")
def ffill(spark, sf):
    return A.history(spark, sf).select(*WHO, "Rem_Months")


@query("""
  select event_id, event_type, lead(value) over w as next_value, lag(value) over w as previous_value,
         max(value) over f as highest, cast(sum(user_id) over f as bigint) as user_sum, row_number() over w - 1 as position,
         last_value(case when user_id % 3 = 0 then value end ignore nulls) over f as filled
  from events window w as (partition by event_type order by ts, event_id),
       f as (partition by event_type order by ts, event_id rows between unbounded preceding and current row)""")
def hot_key_windows(spark, sf):
    """Few keys holding everything: the segmented path of the ordered scan."""
    rows = A.table(spark, sf, "events").select("event_id", "event_type", "ts", "value", "user_id")
    rows = rows.withColumn("third", F.when(F.col("user_id") % 3 == 0, F.col("value")))
    what = Scan(
        lead={"next_value": "value"}, lag={"previous_value": "value"}, running_max={"highest": "value"},
        running_sum={"user_sum": "user_id"}, fill={"filled": "third"}, position="position",
    )
    out = scan(rows, ["event_type"], [F.col("ts").asc(), F.col("event_id").asc()], what, hot_rows=800)
    return out.drop("ts", "value", "user_id", "third")


@query("select Loan_ID, Seq, cast(Act_Period as varchar) as period, Current_Status, Next_Status from observed")
def panel_filtered(spark, sf):
    return A.observed(spark, sf).select(
        *WHO, F.col("Act_Period").cast("string").alias("period"), "Current_Status", "Next_Status"
    )


@query("select Loan_ID, Seq, Current_Status, Next_Status from transitions")
def legal_transitions(spark, sf):
    return A.transitions(spark, sf).select(*WHO, "Current_Status", "Next_Status")


@query("""
  select Current_Status, Next_Status, count(*) as n from observed
  where Next_Status is not null and not coalesce(Current_Status between 0 and 6
    and (Next_Status = 7 or (Next_Status between -1 and 7 and Next_Status <= Current_Status + 1)), false)
  group by 1, 2""")
def dropped_jumps(spark, sf):
    return panel.dropped_jumps(A.observed(spark, sf))


@query("select cur, nxt, n from counted")
def transition_counts(spark, sf):
    return matrix.transition_counts(A.transitions(spark, sf))


@query("""
  with pairs as (select lag(Current_Status) over (partition by Loan_ID order by Act_Period, Seq) as cur,
                        Current_Status as nxt from status)
  select cur, nxt, count(*) as n from pairs
  where cur between -1 and 7 and nxt between -1 and 7 group by 1, 2""")
def consecutive_pairs(spark, sf):
    """Previous -> current over consecutive raw records of a loan."""
    rows = panel.encode(A.records(spark, sf)).withColumnRenamed("Current_Status", "now")
    paired = scan(
        rows, ["Loan_ID"], panel.panel_order(rows), Scan(lag={"before": "now"}), count_from=A.loan_rows(spark, sf)
    )
    return matrix.transition_counts(
        paired.select(F.col("before").alias("Current_Status"), F.col("now").alias("Next_Status"))
    )


@query("select cur, nxt, n, p from empirical")
def transition_matrix(spark, sf):
    return matrix.transition_matrix(matrix.transition_counts(A.transitions(spark, sf)))


@query("""
  with c as (select State, Current_Status as cur, Next_Status as nxt, count(*) as n from transitions group by 1, 2, 3),
  g as (select distinct State from c)
  select g.State, a.s as cur, b.s as nxt, coalesce(n, 0) as n,
         coalesce(n / sum(n) over (partition by g.State, a.s), 0) as p
  from g cross join states a cross join states b
  left join c on c.State = g.State and c.cur = a.s and c.nxt = b.s""")
def transition_matrix_by_state(spark, sf):
    return matrix.transition_matrix(matrix.transition_counts(A.transitions(spark, sf), ["State"]), ["State"])


@query("""
  select nxt as state, round(sum(p), 9) as incoming, sum(n) / (select sum(n) from empirical) as share
  from empirical group by 1""")
def state_distribution(spark, sf):
    found = matrix.state_distribution(transition_matrix(spark, sf))
    return found.withColumn("incoming", F.round("incoming", 9))


@query("""
  select Loan_ID, Seq, case when HomeReady_Program_Indicator = '7' then 'N' else 'Y' end as HomeReady_Program_Indicator
  from records""")
def recode_flag(spark, sf):
    return clean.recode_program_flag(A.records(spark, sf)).select(*WHO, "HomeReady_Program_Indicator")


@query("""
  select Loan_ID, Seq, Product, Mod_Flag from records
  where Product is distinct from 'ARM' and Mod_Flag is distinct from 'Y'""")
def exclude_null_safe(spark, sf):
    rows = A.records(spark, sf).transform(clean.exclude_adjustable).transform(clean.exclude_modified)
    return rows.select(*WHO, "Product", "Mod_Flag")


@query("select DTI, Cscore_B from records where DTI is not null or Cscore_B is not null")
def empty_rows(spark, sf):
    return clean.drop_empty_rows(A.records(spark, sf).select("DTI", "Cscore_B"))


@query("select Loan_ID, Seq, Mi_Pct, Mi_Type, Interest_Only_Loan_Indicator from kept")
def fill_const(spark, sf):
    rows = A.records(spark, sf).transform(clean.exclude_adjustable).transform(clean.exclude_modified)
    return clean.fill_constants(rows).select(*WHO, "Mi_Pct", "Mi_Type", "Interest_Only_Loan_Indicator")


@query("select Loan_ID, Seq, DTI, Cscore_B from cleaned")
def impute_mean(spark, sf):
    return clean.clean(A.records(spark, sf)).select(*WHO, "DTI", "Cscore_B")


@query("""
  select Loan_ID, Seq, coalesce(DTI, avg(DTI) over (partition by State)) as DTI,
         coalesce(Cscore_B, avg(Cscore_B) over (partition by State)) as Cscore_B from records""")
def impute_mean_by_group(spark, sf):
    rows = A.records(spark, sf).select(*WHO, "State", "DTI", "Cscore_B")
    return clean.impute_mean(rows, by=["State"]).drop("State")


@query("select Loan_ID, Seq from records where Serv_Ind is not null and First_Flag is not null")
def required_drop(spark, sf):
    return clean.require(A.records(spark, sf), ["Serv_Ind", "First_Flag"]).select(*WHO)


@query("""
  select Loan_ID, Seq, Curr_UPB, DTI, Product from records
  where Curr_UPB is not null and DTI is not null and Product is not null""")
def complete_cases(spark, sf):
    return clean.complete_cases(A.records(spark, sf).select(*WHO, "Curr_UPB", "DTI", "Product"))


@query("""
  select Loan_ID, Seq, try_cast(Current_Loan_Delinquency_Status as integer) as number from records""")
def text_to_number(spark, sf):
    number = states.status_number(F.col("Current_Loan_Delinquency_Status")).alias("number")
    return A.records(spark, sf).select(*WHO, number)


@query("""
  select c_custkey, substr(series, 8, 5) as metro, substr(series, 6, 2) as state
  from (select c_custkey, concat('LAUMT', lpad(cast(c_nationkey as varchar), 2, '0'),
               lpad(cast(c_custkey as varchar), 8, '0'), '00003') as series from customer)""")
def series_slices(spark, sf):
    series = F.concat(
        F.lit("LAUMT"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"),
        F.lpad(F.col("c_custkey").cast("string"), 8, "0"), F.lit("00003"),
    )
    rows = A.table(spark, sf, "customer").withColumn("series", series)
    metro, state = scalars.metro_code(F.col("series")), scalars.state_code(F.col("series"))
    return rows.select("c_custkey", metro.alias("metro"), state.alias("state"))


@query("""
  select o_orderkey, cast(year(o_orderdate) as integer) as year, cast(quarter(o_orderdate) as integer) as quarter,
         cast(month(o_orderdate) as integer) as month from orders""")
def date_parts(spark, sf):
    parts = {"year": F.year("o_orderdate"), "quarter": F.quarter("o_orderdate"), "month": F.month("o_orderdate")}
    return A.table(spark, sf, "orders").select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@query("select o_orderkey, cast(date_trunc('month', o_orderdate) as date)::varchar as month from orders")
def month_text(spark, sf):
    """Dates written as MMYYYY text without the leading zero and parsed again."""
    text = F.regexp_replace(F.date_format("o_orderdate", "MMyyyy"), "^0", "")
    month = scalars.month_start(text).cast("string").alias("month")
    return A.table(spark, sf, "orders").select("o_orderkey", month)


@query("""
  select Loan_ID, Seq, Current_Status, Next_Status, cast(null as integer) as Target from transitions
  where Current_Status = 0 and Next_Status = 0
  union all
  select Loan_ID, Seq, Current_Status, Next_Status, 0 from transitions where Current_Status = 0 and Next_Status <> 0""")
def union_pairs(spark, sf):
    rows = A.transitions(spark, sf).where("Current_Status = 0").select(*WHO, "Current_Status", "Next_Status")
    moved = rows.where("Next_Status <> 0").withColumn("Target", F.lit(0))
    return tables.union_by_name(rows.where("Next_Status = 0"), moved)


@query("select distinct Channel, State, Purpose from records")
def distinct_rows(spark, sf):
    return A.records(spark, sf).select("Channel", "State", "Purpose").dropDuplicates()


@query("""
  select Loan_ID, Seq, cast(Act_Period as varchar) as period, Curr_UPB from records
  where Loan_ID in (select Loan_ID from transitions where Current_Status = 0 and Next_Status = 7)""")
def outlier_series(spark, sf):
    """Whole history of the loans that went from current straight to default."""
    rows = lookups.rows_of_loans(A.records(spark, sf), A.transitions(spark, sf))
    return rows.select(*WHO, F.col("Act_Period").cast("string").alias("period"), "Curr_UPB")


_ZEROED = "case when Seq % 4 < 2 then 0e0 when Seq % 11 = 0 then null else Curr_UPB end"


@query(f"""
  with zeroed as (select *, {_ZEROED} as bal, row_number() over w as rn from records
                  window w as (partition by Loan_ID order by Act_Period, Seq)),
  marked as (select *, rn - coalesce(last_value(case when bal is distinct from 0 then rn end ignore nulls) over (
               partition by Loan_ID order by rn rows between unbounded preceding and current row), 0) as k,
               Orig_Rate / 100 / 12 as i from zeroed),
  paid as (select *, Orig_UPB * i * pow(1 + i, Orig_Term) / (pow(1 + i, Orig_Term) - 1) as pmt from marked)
  select Loan_ID, Seq, round(case when bal = 0 then Orig_UPB * pow(1 + i, k) - pmt * (pow(1 + i, k) - 1) / i
                                  else bal end, 2) as Curr_UPB from paid""")
def amortized_balance(spark, sf):
    rows = A.records(spark, sf).withColumn("Curr_UPB", F.expr(_ZEROED))
    out = panel.imputed_balance(rows, count_from=A.loan_rows(spark, sf))
    return out.select(*WHO, F.round("Curr_UPB", 2).alias("Curr_UPB"))
