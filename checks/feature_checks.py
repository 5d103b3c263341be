"""Features, sampling, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import adapter as A
from checks.registry import query
from loanshift.functions.states import STATES
from loanshift.operators import features, profile, sampling

WHO = ["Loan_ID", "Seq"]


def _rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("""
  select Loan_ID, Seq, Vintage_1996_1996, Vintage_1997_1997, Vintage_1998_2020 from
    (select *, cast(year(Orig_Date) = 1996 as integer) as Vintage_1996_1996,
               cast(year(Orig_Date) = 1997 as integer) as Vintage_1997_1997,
               cast(year(Orig_Date) between 1998 and 2020 as integer) as Vintage_1998_2020 from records)""")
def vintage_bins(spark, sf):
    rows = features.vintage_bins(A.records(spark, sf), edges=A.TEST_EDGES)
    return rows.select(*WHO, "Vintage_1996_1996", "Vintage_1997_1997", "Vintage_1998_2020")


_MONTHS = ", ".join(f"cast(month(Act_Period) = {m} as integer) as Month_{m}" for m in range(2, 13))


@query(f"select Loan_ID, Seq, {_MONTHS} from records")
def month_dummies(spark, sf):
    rows = features.month_indicators(A.records(spark, sf))
    return rows.select(*WHO, *[f"Month_{m}" for m in range(2, 13)])


@query("""
  select c_custkey, """ + ", ".join(
    f"""cast(c_mktsegment = '{s}' as integer) as "c_mktsegment_{s}" """
    for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " from customer")
def one_hot(spark, sf):
    rows = A.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return features.one_hot(rows, features.categories_of(rows, ["c_mktsegment"]))


@query("""
  select Loan_ID, Seq, coalesce(cast(Product = 'FRM' as integer), 0) as Product_FRM,
         coalesce(cast(Mod_Flag = 'Y' as integer), 0) as Mod_Flag_Y from records""")
def one_hot_drop_first(spark, sf):
    rows = A.records(spark, sf).select(*WHO, "Product", "Mod_Flag")
    return features.one_hot(rows, features.categories_of(rows, ["Product", "Mod_Flag"]), drop_first=True)


@query("""
  select Loan_ID, Seq, round((OLTV - avg(OLTV) over ()) / stddev_pop(OLTV) over (), 6) as OLTV,
         round((Orig_Rate - avg(Orig_Rate) over ()) / stddev_pop(Orig_Rate) over (), 6) as Orig_Rate from records""")
def standardize(spark, sf):
    rows = A.records(spark, sf).select(*WHO, "OLTV", "Orig_Rate")
    return _rounded(features.standardize(rows, ["OLTV", "Orig_Rate"]), 6, "OLTV", "Orig_Rate")


@query("""
  with marked as (select *, ('0x' || substr(md5(concat_ws('|', Loan_ID, cast(Act_Period as varchar), Seq, '123')), 1, 8))::bigint
                               >= 0.2e0 * 4294967296 as train from records)
  select Loan_ID, Seq, round((OLTV - (select avg(OLTV) from marked where train))
                       / (select stddev_pop(OLTV) from marked where train), 6) as OLTV from marked where not train""")
def standardize_on_train(spark, sf):
    train, test = sampling.train_test(A.records(spark, sf))
    return _rounded(features.standardize(test.select(*WHO, "OLTV"), ["OLTV"], fit=train), 6, "OLTV")


@query("""
  select Loan_ID, Seq, (OLTV - min(OLTV) over ()) / (max(OLTV) over () - min(OLTV) over ()) as OLTV from records""")
def minmax(spark, sf):
    return features.min_max(A.records(spark, sf).select(*WHO, "OLTV"), ["OLTV"])


@query("""
  select 'OLTV' as "column", round(avg(OLTV), 6) as mean, round(stddev_pop(OLTV), 6) as std, min(OLTV) as min,
         max(OLTV) as max from records
  union all
  select 'Curr_UPB', round(avg(cast(Curr_UPB as decimal(18,2))), 6), round(stddev_pop(Curr_UPB), 6),
         min(Curr_UPB), max(Curr_UPB) from records""")
def scaling_stats(spark, sf):
    return _rounded(features.scaling_stats(A.records(spark, sf), ["OLTV", "Curr_UPB"]), 6, "mean", "std")


@query("""
  select Next_Status, count(*) as n, sum(count(*)) over () / (count(*) over () * count(*)) as weight
  from transitions group by 1""")
def class_weight(spark, sf):
    return features.class_weights(A.transitions(spark, sf), "Next_Status")


@query("select Loan_ID, Seq, cast(Next_Status = 0 as integer) as Target from transitions where Current_Status = 0")
def binary_target(spark, sf):
    rows = A.transitions(spark, sf).where("Current_Status = 0")
    return features.binary_target(rows, 0).select(*WHO, "Target")


@query("select Loan_ID, Seq, s as target, cast(Next_Status = s as integer) as y from transitions, states where s = 7 or s <= Current_Status + 1")
def ovr_labels(spark, sf):
    return A.scored(spark, sf).select(*WHO, "target", "y")


@query("select Seq, Orig_Rate, Orig_UPB, Curr_UPB, Orig_Term, OLTV, DTI, State from records")
def numeric_projection(spark, sf):
    rows = A.records(spark, sf).select(
        "Loan_ID", "Seq", "Act_Period", "Orig_Rate", "Orig_UPB", "Curr_UPB", "Orig_Term", "OLTV", "DTI", "State", "Channel"
    )
    return features.numeric_only(rows)


@query("""
  select Loan_ID, Seq, Current_Status, Next_Status from transitions
  where ('0x' || substr(md5(concat_ws('|', Loan_ID, cast(Act_Period as varchar), Seq, '601')), 1, 8))::bigint
    < 4294967296 * case Current_Status when 0 then 0.05e0 when 1 then 0.3e0 else 0.5e0 end""")
def stratified_sample(spark, sf):
    shares = {s: 0.05 if s == 0 else 0.3 if s == 1 else 0.5 for s in range(7)}
    rows = sampling.sample_by_state(A.transitions(spark, sf), shares)
    return rows.select(*WHO, "Current_Status", "Next_Status")


@query("""
  with drawn as (
    select *, row_number() over (partition by Current_Status, Next_Status order by ('0x' ||
                substr(md5(concat_ws('|', Loan_ID, cast(Act_Period as varchar), Seq, '601')), 1, 8))::bigint, Loan_ID, Act_Period, Seq) as place,
           count(*) over (partition by Current_Status, Next_Status) as n from transitions)
  select Loan_ID, Seq, Current_Status, Next_Status from drawn
  where place <= round_even(n * case Current_Status when 0 then 0.05e0 when 1 then 0.3e0 else 0.5e0 end, 0)""")
def exact_sample(spark, sf):
    """Of every (current, next) pair exactly the rounded share."""
    shares = {s: 0.05 if s == 0 else 0.3 if s == 1 else 0.5 for s in range(7)}
    return sampling.sample_exactly(A.transitions(spark, sf), shares).select(*WHO, "Current_Status", "Next_Status")


@query("""
  select Loan_ID, Seq, case when ('0x' || substr(md5(concat_ws('|', Loan_ID, cast(Act_Period as varchar), Seq, '123')), 1, 8))::bigint
                              < 0.2e0 * 4294967296 then 'test' else 'train' end as split from transitions""")
def train_test_split(spark, sf):
    return sampling.with_split(A.transitions(spark, sf)).select(*WHO, "split")


@query("""
  select Current_Status, split, count(*) as n from
    (select Current_Status, case when ('0x' || substr(md5(concat_ws('|', Loan_ID, cast(Act_Period as varchar), Seq, '123')), 1, 8))::bigint
                              < 0.2e0 * 4294967296 then 'test' else 'train' end as split from transitions) group by 1, 2""")
def record_counts(spark, sf):
    return profile.split_counts(sampling.with_split(A.transitions(spark, sf)))


@query("""
  select Loan_ID, Seq, cast(('0x' || substr(md5(concat_ws('|', Loan_ID, cast(Act_Period as varchar), Seq, '321')), 1, 8))::bigint
                              * 5 // 4294967296 as integer) as fold from transitions""")
def cv_folds(spark, sf):
    return sampling.with_fold(A.transitions(spark, sf)).select(*WHO, "fold")


@query("""
  select 'Channel' as "column", Channel as value, count(*) as n from records group by 2
  union all select 'Product', Product, count(*) from records where Product is not null group by 2
  union all select 'State', cast(State as varchar), count(*) from records group by 2""")
def frequencies(spark, sf):
    return profile.frequencies(A.records(spark, sf), ["Channel", "Product", "State"])


def _histogram_sql(column, source, bins, lo, hi):
    return f"""
      select '{column}' as "column", cast(b as integer) as bin, lo, hi, count(v) as n
      from (select {lo} as lo, {hi} as hi from {source}) e cross join range({bins}) t(b)
      left join (select {column} as v from {source}) x
        on v between lo and hi and least(floor((v - lo) * {bins} / (hi - lo)), {bins - 1}) = b
      group by 1, 2, 3, 4"""


@query(" union all ".join(
    _histogram_sql(c, "records", 25, f"min({c})", f"max({c})") for c in ("Curr_UPB", "DTI", "OLTV")))
def histogram(spark, sf):
    return profile.histogram(A.records(spark, sf), ["Curr_UPB", "DTI", "OLTV"])


@query(_histogram_sql("Cscore_B", "panel", 20, "any_value(500e0)", "any_value(850e0)"))
def credit_score_histogram(spark, sf):
    return profile.histogram(A.built(spark, sf), ["Cscore_B"], bins=20, value_range=(500, 850))


def _box_sql(group, value, source):
    return f"""
      with q as (select {group} as "group", quantile_cont({value}, 0.25) as q1, quantile_cont({value}, 0.5) as median,
                        quantile_cont({value}, 0.75) as q3 from {source} where {value} is not null group by 1)
      select q."group", count(*) as n, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
             min(v) filter (inside) as whisker_low, max(v) filter (inside) as whisker_high,
             count(*) filter (not inside) as outliers
      from (select q.*, r.{value} as v, r.{value} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside
            from {source} r join q on q."group" = {group} where r.{value} is not null) q group by 1, q1, median, q3"""


_GROUP = """case when Next_Status = -1 then 'prepaid' when Next_Status = 0 then 'current'
                 when Next_Status < 7 then 'delinquent' else 'default' end"""


@query(_box_sql(_GROUP, "Curr_UPB", "transitions"))
def box_stats(spark, sf):
    rows = profile.box_stats(
        A.transitions(spark, sf), "Curr_UPB", profile.next_status_group(F.col("Next_Status"))
    )
    return _rounded(rows, 6, "q1", "median", "q3")


@query(_box_sql("'all'", "Cscore_B", "records"))
def credit_score_box(spark, sf):
    return _rounded(profile.box_stats(A.records(spark, sf), "Cscore_B"), 6, "q1", "median", "q3")


@query(_box_sql("event_type", "value", "events"))
def hot_group_box(spark, sf):
    """Quantiles where every group is above the size for one task."""
    rows = profile.box_stats(A.table(spark, sf, "events"), "value", F.col("event_type"), hot_rows=500)
    return _rounded(rows, 6, "q1", "median", "q3")


def _summary_sql(column, source):
    return f"""
      select '{column}' as "column", count({column}) as n, round(avg(cast({column} as decimal(18,4))), 4) as mean,
             round(stddev_samp({column}), 4) as std, cast(min({column}) as double) as min,
             cast(max({column}) as double) as max, round(quantile_cont({column}, 0.25), 4) as q1,
             round(quantile_cont({column}, 0.5), 4) as median, round(quantile_cont({column}, 0.75), 4) as q3
      from {source}"""


@query(" union all ".join(_summary_sql(c, "records") for c in ("Curr_UPB", "DTI", "Orig_Rate")))
def summary(spark, sf):
    rows = profile.summary(A.records(spark, sf), ["Curr_UPB", "DTI", "Orig_Rate"])
    return _rounded(rows, 4, "mean", "std", "q1", "median", "q3")


@query(" union all ".join(
    f"""select '{c}' as "column", count({c}) as n, cast(min({c}) as double) as min, cast(max({c}) as double) as max, true as q1, true as median, true as q3
        from records""" for c in ("Curr_UPB", "DTI", "Orig_Rate")
))
def summary_approx(spark, sf):
    """Quartiles from a sketch, whose ranks are within the stated distance of theirs."""
    columns, accuracy = ["Curr_UPB", "DTI", "Orig_Rate"], 100
    found = profile.summary(A.records(spark, sf), columns, accuracy=accuracy)
    values = profile.melt(A.records(spark, sf), columns, "double").join(found, "column")
    ranks = [f(F.col("value"), F.col(q)) for q in profile.QUARTILES for f in (lambda v, q: F.count_if(v < q), lambda v, q: F.count_if(v <= q))]
    names = [f"{side}_{q}" for q in profile.QUARTILES for side in ("below", "upto")]
    ranked = values.groupBy("column", "n", "min", "max").agg(*[r.alias(n) for r, n in zip(ranks, names)])
    near = {
        q: (F.col(f"below_{q}") <= (p + 1 / accuracy) * F.col("n") + 1) & (F.col(f"upto_{q}") >= (p - 1 / accuracy) * F.col("n") - 1)
        for q, p in profile.QUARTILES.items()
    }
    return ranked.select("column", "n", "min", "max", *[c.alias(q) for q, c in near.items()])


@query("""
  select * from (values (0, 'c_custkey', 'bigint'), (1, 'c_name', 'string'), (2, 'c_nationkey', 'int'),
    (3, 'c_acctbal', 'double'), (4, 'c_mktsegment', 'string')) t(position, "Column_Name", dtype)""")
def column_listing(spark, sf):
    return profile.listing(A.table(spark, sf, "customer"))
