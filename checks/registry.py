"""Registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.adapter import RECORD_SQL, REMAINING_SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name; without ``sql`` only rows are checked."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = with_tables(sql)
        return function

    return add


def _records() -> str:
    columns = ", ".join(f"{sql} as {name}" for name, sql in RECORD_SQL.items())
    return f"""
      select *, {REMAINING_SQL} as Rem_Months
      from (select {columns}, o_orderkey from orders
            join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
            join firsts on o_custkey = loan)"""


def _status(source: str) -> str:
    return f"""
      select * exclude (Current_Loan_Delinquency_Status, enc), enc as Current_Loan_Delinquency_Status,
             try_cast(enc as integer) as Current_Status, Loan_Age / Orig_Term as Age_Prop
      from (select *, case when Zero_Balance_Code = 1 then '-1' when Current_Loan_Delinquency_Status = 'XX' then '999'
                           else Current_Loan_Delinquency_Status end as enc from {source})"""


def _history(source: str) -> str:
    return f"""
      select *, lead(Current_Status) over w as Next_Status,
             case when Current_Status is not null
                  then max(Current_Status) over (w rows between unbounded preceding and current row) end as Cum_Max_Status,
             row_number() over w - 1 as Cum_Count,
             last_value(Rem_Months ignore nulls) over (w rows between unbounded preceding and current row) as Rem_Filled
      from {source} window w as (partition by Loan_ID order by Act_Period, Seq)"""


def _observed(source: str) -> str:
    return f"""
      select * from {source}
      where not coalesce(Cum_Max_Status >= 7, false) and Cum_Count <> 0
        and not coalesce(Current_Status = -1, false) and not coalesce(Next_Status = 999, false)"""


def _legal(source: str) -> str:
    return f"""
      select * from {source}
      where Current_Status between 0 and 6
        and (Next_Status = 7 or (Next_Status between -1 and 7 and Next_Status <= Current_Status + 1))"""


def draw(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::bigint"


TABLES = {
    "firsts": "select o_custkey as loan, min(cast(o_orderdate as date)) as orig_date from orders group by 1",
    "records": _records(),
    "status": _status("records"),
    "history": _history("status"),
    "observed": _observed("history"),
    "transitions": _legal("observed"),
    "counted": """
      select Current_Status as cur, Next_Status as nxt, count(*) as n from transitions group by 1, 2""",
    "states": "select unnest([-1, 0, 1, 2, 3, 4, 5, 6, 7]) as s",
    "empirical": """
      select a.s as cur, b.s as nxt, coalesce(n, 0) as n, coalesce(n / sum(n) over (partition by a.s), 0) as p
      from states a cross join states b left join counted c on c.cur = a.s and c.nxt = b.s""",
    "kept": """
      select * exclude (HomeReady_Program_Indicator, Product, Mod_Flag, Mi_Pct, Mi_Type, Interest_Only_Loan_Indicator),
             case when HomeReady_Program_Indicator = '7' then 'N' else 'Y' end as HomeReady_Program_Indicator,
             coalesce(Mi_Pct, 0) as Mi_Pct, coalesce(Mi_Type, '0') as Mi_Type,
             coalesce(Interest_Only_Loan_Indicator, 'Y') as Interest_Only_Loan_Indicator
      from records where Product is distinct from 'ARM' and Mod_Flag is distinct from 'Y'""",
    "cleaned": """
      select * exclude (DTI, Cscore_B), coalesce(DTI, (select avg(DTI) from kept)) as DTI,
             coalesce(Cscore_B, (select avg(Cscore_B) from kept)) as Cscore_B from kept""",
    "clean_status": _status("cleaned"),
    "clean_history": _history("clean_status"),
    "clean_observed": _observed("clean_history") + " and Curr_UPB is not null",
    "hpi_zip": """
      select s_nationkey as Zip, year(l_shipdate) as Year, quarter(l_shipdate) as Quarter,
             cast(sum(cast(l_extendedprice as decimal(18,2))) as double) / count(*) as HPI
      from lineitem join supplier on l_suppkey = s_suppkey where s_nationkey % 4 <> 0 group by 1, 2, 3""",
    "hpi_state": """
      select n_regionkey as State, year(l_shipdate) as Year, quarter(l_shipdate) as Quarter,
             cast(sum(cast(l_extendedprice as decimal(18,2))) as double) / count(*) as HPI
      from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by 1, 2, 3""",
    "daily": """
      select cast(l_shipdate as date) as Date,
             3 + 100 * cast(sum(cast(l_discount as decimal(18,2))) as double) / count(*) as r30,
             2 + 100 * cast(sum(cast(l_tax as decimal(18,2))) as double) / count(*) as r15
      from lineitem group by 1""",
    "monthly": """
      select year(Date) as Year, month(Date) as Month, arg_max(r30, Date) as r30, arg_max(r15, Date) as r15
      from daily group by 1, 2""",
    "ur_metro": """
      select c_nationkey as FIPS, year(o_orderdate) as Year, month(o_orderdate) as Month,
             100e0 * (count(*) filter (o_orderstatus = 'F') / count(*)) as URate
      from orders join customer on o_custkey = c_custkey where c_nationkey % 5 <> 0 group by 1, 2, 3""",
    "ur_state": """
      select n_regionkey as StateAbb, year(o_orderdate) as Year, month(o_orderdate) as Month,
             100e0 * (count(*) filter (o_orderstatus = 'F') / count(*)) as URate
      from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2, 3""",
    "spread": """
      select year(o_orderdate) as Year, month(o_orderdate) as Month,
             cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) / 100000 - 2 as Spread
      from orders group by 1, 2""",
    "with_hpi": """
      select r.*, coalesce(z.HPI, t.HPI) as Curr_HPI, coalesce(zo.HPI, t_o.HPI) as Orig_HPI,
             coalesce(z.HPI, t.HPI) / coalesce(zo.HPI, t_o.HPI) as HPI_Adjust_Factor,
             Curr_UPB / (Orig_UPB / OLTV * (coalesce(z.HPI, t.HPI) / coalesce(zo.HPI, t_o.HPI))) as MTMLTV,
             case when z.HPI is not null then 'ZIP' when t.HPI is not null then 'State' end as Curr_HPI_Level
      from clean_observed r
      left join hpi_zip z on z.Zip = r.ZIP and z.Year = year(Act_Period) and z.Quarter = quarter(Act_Period)
      left join hpi_zip zo on zo.Zip = r.ZIP and zo.Year = year(Orig_Date) and zo.Quarter = quarter(Orig_Date)
      left join hpi_state t on t.State = r.State and t.Year = year(Act_Period) and t.Quarter = quarter(Act_Period)
      left join hpi_state t_o on t_o.State = r.State and t_o.Year = year(Orig_Date) and t_o.Quarter = quarter(Orig_Date)""",
    "with_rates": """
      select r.*, case when Orig_Term = 360 then a.r30 else a.r15 end as Benchmark_Rate,
             100 * Orig_Rate / case when Orig_Term = 360 then a.r30 else a.r15 end as "Refinance Indicator",
             Orig_Rate - case when Orig_Term = 360 then o.r30 else o.r15 end as SATO
      from with_hpi r
      left join monthly a on a.Year = year(Act_Period) and a.Month = month(Act_Period)
      left join monthly o on o.Year = year(Orig_Date) and o.Month = month(Orig_Date)""",
    "with_urate": """
      select r.*, coalesce(a.URate, sa.URate) as Curr_URate, coalesce(o.URate, so.URate) as Orig_URate,
             coalesce(a.URate, sa.URate) - coalesce(o.URate, so.URate) as URate_Change
      from with_rates r
      left join ur_metro a on a.FIPS = MSA and a.Year = year(Act_Period) and a.Month = month(Act_Period)
      left join ur_metro o on o.FIPS = MSA and o.Year = year(Orig_Date) and o.Month = month(Orig_Date)
      left join ur_state sa on sa.StateAbb = r.State and sa.Year = year(Act_Period) and sa.Month = month(Act_Period)
      left join ur_state so on so.StateAbb = r.State and so.Year = year(Orig_Date) and so.Month = month(Orig_Date)""",
    "enriched": """
      select r.*, r_regionkey % 2 as Judicial, s.Spread as "10-2Spread" from with_urate r
      left join region on r_regionkey = r.State
      left join spread s on s.Year = year(Act_Period) and s.Month = month(Act_Period)""",
    "panel": f"""
      select *, {", ".join(
          f"cast(coalesce(year(Orig_Date) > {lo} and year(Orig_Date) <= {hi}, false) as integer) as Vintage_{lo + 1}_{hi}"
          for lo, hi in ((1995, 1996), (1996, 1997), (1997, 2020)))},
          {", ".join(f"cast(month(Act_Period) = {m} as integer) as Month_{m}" for m in range(2, 13))}
      from enriched
      where Curr_URate is not null and Curr_HPI is not null and Benchmark_Rate is not null
        and Serv_Ind is not null and Next_Status is not null and First_Flag is not null""",
    "raw_scores": f"""
      select Loan_ID, Seq, Current_Status as cur, Next_Status as truth, s as target,
             cast({draw("concat_ws('|', Loan_ID, Seq, s, '7')")} % 1000 + 1
                  + case when Next_Status = s then 400 else 0 end as double) as raw
      from transitions, states
      where s = 7 or s <= Current_Status + 1""",
    "scored": """
      select *, raw / sum(raw) over (partition by Loan_ID, Seq) as p, cast(truth = target as integer) as y
      from raw_scores""",
    "predicted": """
      select Loan_ID, Seq, cur, any_value(truth) as truth, arg_max(target, (p, -target)) as prediction
      from scored group by 1, 2, 3""",
    "raw_matrices": f"""
      select c_custkey as Loan_ID, a.s as cur, b.s as nxt,
             cast({draw("concat_ws('|', c_custkey, a.s, b.s, '11')")} % 97 + 1 as double) as raw
      from customer, states a, states b where a.s between 0 and 6 and (b.s = 7 or b.s <= a.s + 1)""",
    "matrices": """
      select Loan_ID, cur, nxt, raw / sum(raw) over (partition by Loan_ID, cur) as p from raw_matrices""",
    "full_matrices": """
      select * from matrices
      union all select c_custkey, -1, -1, 1e0 from customer
      union all select c_custkey, 7, 7, 1e0 from customer""",
}


def with_tables(sql: str) -> str:
    """Prefix ``sql`` with the named tables it uses, and those they use."""
    used: set[str] = set()

    def add(text: str) -> None:
        for name, body in TABLES.items():
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                add(body)

    add(sql)
    chain = [f"{name} as ({TABLES[name]})" for name in TABLES if name in used]
    if not chain:
        return sql
    body = sql.strip()
    if body.lower().startswith("with recursive "):
        return "with recursive " + ",\n".join(chain) + ",\n" + body[len("with recursive "):]
    if body.lower().startswith("with "):
        return "with " + ",\n".join(chain) + ",\n" + body[len("with "):]
    return "with " + ",\n".join(chain) + "\n" + body
