"""The supplied test tables read as loan records, economic series and scores.

Column rules follow FIXTURES.md §2; the same text runs in Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanshift.functions import scalars, states
from loanshift.operators import clean, lookups, matrix, metrics, panel
from loanshift.operators.ordered import HOT_ROWS
from loanshift.plans.build import Series, build_panel
from loanshift.session import materialize

# Vintage edges and sampling shares that suit the test years.
TEST_EDGES = [0, 1995, 1996, 1997, 2020]
TEST_FRACTIONS = {s: 0.2 for s in states.LIVE_STATES}
SCORES = {s: f"p_{s}" for s in states.STATES}

# One expression per loan-record column, over orders joined to customer and nation.
RECORD_SQL = {
    "Loan_ID": "o_custkey",
    "Seq": "o_orderkey",
    "Act_Period": "cast(o_orderdate as date)",
    "Orig_Date": "orig_date",
    "Orig_Rate": "2e0 + cast(o_custkey%50 as double)/10",
    "Orig_UPB": "cast(1000*(50+o_custkey%200) as double)",
    "Curr_UPB": "case when o_orderkey%43=0 then null else o_totalprice end",
    "Orig_Term": "case when o_custkey%3=0 then 180e0 else 360e0 end",
    "OLTV": "cast(60+o_custkey%40 as double)",
    "DTI": "case when o_orderkey%13=0 then null else cast(10+o_custkey%40 as double) end",
    "Cscore_B": "case when o_custkey%17=0 then null else cast(500+o_custkey%350 as double) end",
    "Product": "case when o_custkey%19=0 then 'ARM' when o_custkey%23=0 then null else 'FRM' end",
    "Mod_Flag": "case when o_orderkey%37=0 then 'Y' when o_orderkey%41=0 then null else 'N' end",
    "Serv_Ind": "case when o_orderkey%53=0 then null else 'N' end",
    "First_Flag": "case when o_custkey%59=0 then null when o_custkey%2=0 then 'Y' else 'N' end",
    "HomeReady_Program_Indicator": "case when o_custkey%5=0 then '7' when o_custkey%7=0 then null else 'F' end",
    "Channel": "substr(c_mktsegment,1,1)",
    "State": "n_regionkey",
    "ZIP": "c_nationkey",
    "MSA": "c_nationkey",
    "Loan_Age": "cast((year(o_orderdate)-year(orig_date))*12+month(o_orderdate)-month(orig_date) as double)",
    "Current_Loan_Delinquency_Status": (
        "case when o_orderkey%97=0 then 'XX' when o_orderkey%101=0 then '07' "
        "when o_orderkey%32<20 then '00' when o_orderkey%32<25 then '01' when o_orderkey%32<28 then '02' "
        "when o_orderkey%32=28 then '03' when o_orderkey%32=29 then '04' when o_orderkey%32=30 then '05' else '06' end"
    ),
    "Zero_Balance_Code": "case when o_orderpriority='1-URGENT' and o_orderkey%29=0 then 1e0 end",
    "Mi_Pct": "case when o_custkey%11=0 then null else cast(o_custkey%30 as double) end",
    "Mi_Type": "case when o_custkey%6=0 then null when o_custkey%2=0 then '1' else '2' end",
    "Interest_Only_Loan_Indicator": "case when o_custkey%8=0 then null else 'N' end",
    "Relocation_Mortgage_Indicator": "case when o_custkey%9=0 then 'Y' else 'N' end",
    "Purpose": "case when o_custkey%4=0 then 'C' when o_custkey%4=1 then 'R' else 'P' end",
    "Prop": "case when o_custkey%10=0 then 'CO' when o_custkey%10<4 then 'PU' else 'SF' end",
    "Occ_Stat": "case when o_custkey%12=0 then 'I' when o_custkey%12=1 then 'S' else 'P' end",
    "Num_Bo": "case when o_custkey%3=1 then '1' else '2' end",
}
REMAINING_SQL = "case when o_orderkey%7=0 then null else Orig_Term-Loan_Age end"


#: Records, and loans that become 48 rows each, that one task takes.
RECORDS_A_TASK, LOANS_A_TASK = 250_000, 25_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame, key: str, a_task: int) -> DataFrame:
    """``df`` by ``key`` in partitions of about ``a_task`` rows. Left alone, Spark joins partitions up to a size in
    compressed bytes, which says little of the room that sorts and windows take."""
    spark = df.sparkSession
    # With fewer than this Spark would shuffle both sides of a join again.
    least = int(spark.conf.get("spark.sql.shuffle.partitions")) if a_task == RECORDS_A_TASK else spark.sparkContext.defaultParallelism
    return df.repartition(max(least, -(-df.count() // a_task)), key)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as monthly loan records, a customer being a loan."""
    orders = table(spark, sf_dir, "orders")
    if orders.count() > RECORDS_A_TASK * spark.sparkContext.defaultParallelism:
        orders = _spread(orders, "o_custkey", RECORDS_A_TASK)
    first = orders.groupBy(F.col("o_custkey").alias("_loan")).agg(
        F.min(F.col("o_orderdate").cast("date")).alias("orig_date")
    )
    holders = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    loans = orders.join(holders, F.col("o_custkey") == F.col("c_custkey")).join(
        first, F.col("o_custkey") == F.col("_loan")
    )
    named = [F.expr(sql).alias(name) for name, sql in RECORD_SQL.items()]
    out = loans.select(*named, "o_orderkey")
    return out.withColumn("Rem_Months", F.expr(REMAINING_SQL)).drop("o_orderkey")


_prepared: dict[tuple, DataFrame] = {}


def prepare(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A stored table several queries read, written once per session. Economic
    series are files in practice; model rows are stored before training."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _prepared:
        _prepared[key] = materialize(build())
    return _prepared[key]


def _exact_sum(column: str):
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def price_index(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    """``level``: ``zip`` (by nation, some missing on purpose) or ``state`` (by region)."""

    def build():
        place = table(spark, sf_dir, "supplier")
        if level == "state":
            place = place.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        column, name = ("s_nationkey", "Zip") if level == "zip" else ("n_regionkey", "State")
        if level == "zip":
            place = place.where(F.col("s_nationkey") % 4 != 0)
        items = table(spark, sf_dir, "lineitem").join(place, F.col("l_suppkey") == F.col("s_suppkey"))
        group = [
            F.col(column).alias(name), F.year("l_shipdate").alias("Year"), F.quarter("l_shipdate").alias("Quarter"),
        ]
        return items.groupBy(*group).agg((_exact_sum("l_extendedprice") / F.count("*")).alias("HPI"))

    return prepare(spark, sf_dir, f"hpi_{level}", build)


def daily_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        return (
            table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_shipdate").cast("date").alias("Date"))
            .agg(
                (3 + 100 * _exact_sum("l_discount") / F.count("*")).alias("30_Year"),
                (2 + 100 * _exact_sum("l_tax") / F.count("*")).alias("15_Year"),
            )
        )

    return prepare(spark, sf_dir, "rates", build)


def monthly_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.last_of_month(daily_rates(spark, sf_dir))


def unemployment(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    def build():
        place = table(spark, sf_dir, "customer")
        if level == "state":
            place = place.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        column, name = ("c_nationkey", "FIPS") if level == "metro" else ("n_regionkey", "StateAbb")
        if level == "metro":
            place = place.where(F.col("c_nationkey") % 5 != 0)
        held = table(spark, sf_dir, "orders").join(place, F.col("o_custkey") == F.col("c_custkey"))
        group = [F.col(column).alias(name), F.year("o_orderdate").alias("Year"), F.month("o_orderdate").alias("Month")]
        share = F.count(F.when(F.col("o_orderstatus") == "F", 1)) / F.count("*")
        return held.groupBy(*group).agg((F.lit(100.0) * share).alias("URate"))

    return prepare(spark, sf_dir, f"urate_{level}", build)


def judicial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("State"), (F.col("r_regionkey") % 2).alias("Judicial")
    )


def spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        group = [F.year("o_orderdate").alias("Year"), F.month("o_orderdate").alias("Month")]
        mean = _exact_sum("o_totalprice") / F.count("*")
        return table(spark, sf_dir, "orders").groupBy(*group).agg((mean / 100000 - 2).alias("Spread"))

    return prepare(spark, sf_dir, "spread", build)


def dimensions(spark: SparkSession, sf_dir: str) -> Series:
    return Series(
        zip_index=price_index(spark, sf_dir, "zip"),
        state_index=price_index(spark, sf_dir, "state"),
        rates=monthly_rates(spark, sf_dir),
        metro_unemployment=unemployment(spark, sf_dir, "metro"),
        state_unemployment=unemployment(spark, sf_dir, "state"),
        judicial=judicial(spark, sf_dir),
        spread=spread(spark, sf_dir),
    )


def built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full panel over all records."""
    return build_panel(
        records(spark, sf_dir), dimensions(spark, sf_dir), TEST_EDGES, count_from=loan_rows(spark, sf_dir)
    )


def loan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan key of every record: the cheap table to count loans in."""
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("Loan_ID"))


def history(spark: SparkSession, sf_dir: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    return panel.add_history(panel.encode(records(spark, sf_dir)), hot_rows, loan_rows(spark, sf_dir))


def observed(spark: SparkSession, sf_dir: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All records through status and history to observed transitions, nothing excluded before."""
    return panel.keep_observed(history(spark, sf_dir, hot_rows), require_balance=False)


def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.legal_transitions(observed(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean(records(spark, sf_dir))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed score per transition and reachable state: (Loan_ID, Seq, cur, truth, target, raw).

    A hash draw plus a bonus on the true class, so metrics see some signal.
    """
    rows = transitions(spark, sf_dir)
    targets = F.explode(F.array(*[F.lit(s) for s in states.STATES]))
    long = rows.select(
        "Loan_ID", "Seq", F.col("Current_Status").alias("cur"), F.col("Next_Status").alias("truth"),
        targets.alias("target"),
    ).where(states.is_legal(F.col("cur"), F.col("target")))
    return long.withColumn("raw", _score(F.col("truth"), F.col("target")))


def _score(truth, target):
    draw = scalars.uniform_int([F.col("Loan_ID"), F.col("Seq"), target], 7) % 1000
    return (draw + 1 + F.when(truth == target, 400).otherwise(0)).cast("double")


def scored_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scores as one normalised column per state, 0 where unreachable."""
    rows = transitions(spark, sf_dir).withColumnsRenamed({"Current_Status": "cur", "Next_Status": "truth"})
    raw = {
        name: F.when(states.is_legal(F.col("cur"), F.lit(s)), _score(F.col("truth"), F.lit(s))).otherwise(0.0)
        for s, name in SCORES.items()
    }
    return metrics.normalize_wide(rows.withColumns(raw), list(SCORES.values()))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Melted: (Loan_ID, Seq, cur, truth, target, p, y) of reachable states, no shuffle."""
    long = metrics.melt_scores(scored_wide(spark, sf_dir), SCORES, ["Loan_ID", "Seq", "cur", "truth"])
    return long.where(states.is_legal(F.col("cur"), F.col("target")))


def matrix_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A one-month matrix per loan, long form (Loan_ID, cur, nxt, p): hash weights on the legal moves.

    Loans are spread by key before each becomes 48 rows, which also serves
    every later grouping by loan.
    """
    loans = _spread(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("Loan_ID")), "Loan_ID", LOANS_A_TASK)
    pairs = F.array(*[F.struct(F.lit(c).alias("cur"), F.lit(n).alias("nxt")) for c, n in matrix.legal_cells()])
    long = loans.select("Loan_ID", F.explode(pairs).alias("pair")).select("Loan_ID", "pair.*")
    draw = scalars.uniform_int([F.col("Loan_ID"), F.col("cur"), F.col("nxt")], 11) % 97
    weighted = long.withColumn("raw", (draw + 1).cast("double"))
    # At most 9 rows per loan and current state.
    total = F.sum("raw").over(Window.partitionBy("Loan_ID", "cur"))
    return weighted.select("Loan_ID", "cur", "nxt", (F.col("raw") / total).alias("p"))
