"""File formats: the test tables written in each input format and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import adapter as A
from checks.registry import QUERIES, SQL, query, with_tables
from loanshift.functions import scalars, states
from loanshift.operators import clean
from loanshift.plans import job
from loanshift.session import shared_folder
from loanshift.sources import economics, layout, performance, series, tables

WHO = ["Loan_ID", "Seq"]


def _path(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _csv(spark, df, name, **options):
    """Columns in order as one CSV file with a header."""
    path = _path(spark, name)
    df.coalesce(1).write.csv(path, header=True, **options)
    return path


# Field name, type and whether it is kept, in file order.
_FIELDS = [
    ("Pool", "string", 0), ("Loan_ID", "string", 1), ("Act_Period", "string", 1), ("Channel", "string", 1),
    ("Seller", "string", 0), ("Orig_Rate", "float64", 1), ("Orig_UPB", "float64", 1), ("Curr_UPB", "float64", 1),
    ("Orig_Term", "float64", 1), ("Orig_Date", "string", 1), ("DTI", "float64", 1), ("Product", "string", 1),
    ("Current_Loan_Delinquency_Status", "string", 1), ("Zero_Balance_Code", "float64", 1), ("Seq", "int64", 1),
    ("Deal", "string", 0),
]


@query("""
  select cast(Loan_ID as varchar) as "Loan_ID", Seq, cast(date_trunc('month', Act_Period) as date)::varchar as period,
         cast(date_trunc('month', Orig_Date) as date)::varchar as origin, Channel, Orig_Rate, Orig_UPB, Curr_UPB, Orig_Term, DTI,
         Product, Current_Loan_Delinquency_Status as status, Zero_Balance_Code from records""")
def performance_files(spark, sf):
    """Pipe-separated records with unused fields, read through a layout table."""
    rows = A.records(spark, sf)
    written = {
        **{n: F.lit("unused").alias(n) for n, _, kept in _FIELDS if not kept},
        "Act_Period": F.date_format("Act_Period", "MMyyyy"),
        "Orig_Date": F.date_format("Orig_Date", "MMyyyy"),
    }
    path = _path(spark, "performance")
    rows.select(*[written.get(n, F.col(n) if n in rows.columns else None) for n, _, _ in _FIELDS]).write.csv(path, sep="|")
    fields = [(i, n, f"{n}  ", str(kept), kind) for i, (n, kind, kept) in enumerate(_FIELDS)]
    listed = _csv(spark, spark.createDataFrame(fields, layout.LAYOUT_SCHEMA), "layout", ignoreTrailingWhiteSpace=False)
    read = performance.read_performance(spark, path, layout.read_layout(spark, listed))
    out = clean.parse_dates(read.drop("Time_Stamp"))
    return out.select(
        *WHO, F.col("Act_Period").cast("string").alias("period"), F.col("Orig_Date").cast("string").alias("origin"),
        "Channel", "Orig_Rate", "Orig_UPB", "Curr_UPB", "Orig_Term", "DTI", "Product",
        F.col("Current_Loan_Delinquency_Status").alias("status"), "Zero_Balance_Code",
    )


@query("""
  select case when Seq % 71 = 0 then 'Orig_Rate: n/a' when Seq % 73 = 0 then '15 fields for 16' end as reason, count(*) as n,
         sum(Seq) as seqs from records group by 1""")
def rejected_records(spark, sf):
    """Records with a malformed rate or a field too few are listed with the reason, the others are read: every record once."""
    rows = A.records(spark, sf)
    written = {**{n: F.lit("unused") for n, _, kept in _FIELDS if not kept}, "Orig_Rate": F.when(F.col("Seq") % 71 == 0, "n/a").otherwise(F.col("Orig_Rate").cast("string"))}
    written |= {n: F.date_format(n, "MMyyyy") for n in ("Act_Period", "Orig_Date")}
    fields = [F.coalesce(written.get(n, F.col(n) if n in rows.columns else F.lit("")).cast("string"), F.lit("")) for n, _, _ in _FIELDS]
    whole, short = F.concat_ws("|", *fields), F.concat_ws("|", *fields[:-1])
    path = _path(spark, "mixed")
    rows.select(F.when((F.col("Seq") % 73 == 0) & (F.col("Seq") % 71 != 0), short).otherwise(whole).alias("value")).write.text(path)
    fields = [(i, n, n, str(kept), kind) for i, (n, kind, kept) in enumerate(_FIELDS)]
    spec = layout.layout_of(spark.createDataFrame(fields, layout.LAYOUT_SCHEMA))
    sound, rejected = performance.split_performance(spark, path, spec)
    place = [n for n, _, _ in _FIELDS].index("Seq")
    told = rejected.select(F.array_join("reasons", "; ").alias("reason"), F.split("record", r"\|")[place].cast("bigint").alias("Seq"))
    both = told.unionByName(sound.select(F.lit(None).cast("string").alias("reason"), "Seq"))
    return both.groupBy("reason").agg(F.count("*").alias("n"), F.sum("Seq").alias("seqs"))


@query("select cast(Zip as varchar) as Zip, cast(Year as integer) as Year, cast(Quarter as integer) as Quarter, HPI from hpi_zip")
def hpi_zip_file(spark, sf):
    return economics.read_hpi_zip(spark, _csv(spark, A.price_index(spark, sf, "zip"), "hpi_zip"))


@query("select cast(State as varchar) as State, cast(Year as integer) as Year, cast(Quarter as integer) as Quarter, HPI from hpi_state")
def hpi_state_file(spark, sf):
    return economics.read_hpi_state(spark, _csv(spark, A.price_index(spark, sf, "state"), "hpi_state"))


@query("select cast(Year as integer) as year, cast(Month as integer) as month, r30 as rate30, r15 as rate15 from monthly")
def rates_file(spark, sf):
    rows = A.daily_rates(spark, sf).select(F.date_format("Date", "d/M/yyyy").alias("Date"), "`30_Year`", "`15_Year`")
    blank = spark.createDataFrame([(None, None, None)], rows.schema)
    rates = economics.read_rates(spark, _csv(spark, rows.union(blank), "rates"))
    return rates.select(
        F.col("Year").alias("year"), F.col("Month").alias("month"),
        F.col("30_Year").alias("rate30"), F.col("15_Year").alias("rate15"),
    )


@query("""
  select lpad(cast(FIPS as varchar), 5, '0') as MSA, cast(Year as integer) as Year, cast(Month as integer) as Month,
         case when Month <> 7 then URate end as URate from ur_metro""")
def unemployment_msa_file(spark, sf):
    """Series identifiers carry the area; ``-`` marks a missing rate."""
    rows = A.unemployment(spark, sf, "metro")
    code = F.concat(F.lit("MT36"), F.lpad(F.col("FIPS").cast("string"), 5, "0"), F.lit("000000"))
    rate = F.when(F.col("Month") == 7, "-").otherwise(F.col("URate").cast("string"))
    text = rows.select("Year", "Month", rate.alias("URate"), scalars.series_id("LAU", code).alias("Series"))
    return economics.read_unemployment_msa(spark, _csv(spark, text, "ur_msa"))


@query("""
  select cast(n_regionkey as integer) as "FIPS", any_value('R' || n_regionkey) as "State", cast(u.Year as integer) as Year,
         cast(u.Month as integer) as Month, any_value(URate) as URate
  from ur_state u join nation on n_regionkey = StateAbb group by 1, 3, 4""")
def unemployment_state_file(spark, sf):
    """State series joined to the geocode table by area code."""
    rows = A.unemployment(spark, sf, "state")
    code = F.concat(F.lit("ST"), F.lpad(F.col("StateAbb").cast("string"), 2, "0"), F.lit("00000000000"))
    text = rows.select("Year", "Month", "URate", scalars.series_id("LAU", code).alias("Series"))
    return economics.read_unemployment_state(spark, _csv(spark, text, "ur_state"), _geocode(spark, sf))


def _geocode(spark, sf):
    nations = A.table(spark, sf, "nation")
    title = F.concat("n_name", F.lit(", R"), F.col("n_regionkey").cast("string"))
    title = F.when(F.col("n_nationkey") % 6 == 5, F.concat(title, F.lit("-R9"))).otherwise(title)
    fields = {0: F.col("n_nationkey"), 3: title, 8: F.col("n_name"), 9: F.col("n_regionkey")}
    return _csv(spark, nations.select(*[fields.get(i, F.lit("x")).alias(f"c{i}") for i in range(11)]), "geocode")


@query("select distinct 'R' || n_regionkey as State, n_regionkey as FIPS from nation where n_nationkey % 6 <> 5")
def geocode_file(spark, sf):
    return economics.read_geocode(spark, _geocode(spark, sf))


@query("""
  select cast(FIPS as varchar) as "FIPS", URate, cast(null as varchar) as "StateAbb", cast(Year as integer) as "Year",
         cast(Month as integer) as "Month" from ur_metro where Month <> 7""")
def unemployment_file(spark, sf):
    """The combined file; rows without a rate are dropped."""
    rows = A.unemployment(spark, sf, "metro")
    date = F.date_format(F.make_date("Year", "Month", F.lit(1)), "M/d/yyyy")
    rate = F.when(F.col("Month") == 7, "-").otherwise(F.col("URate").cast("string"))
    text = rows.select("FIPS", date.alias("Date"), rate.alias("URate"), F.lit(None).cast("string").alias("StateAbb"))
    return economics.read_unemployment(spark, _csv(spark, text, "unemployment"))


@query("select cast(r_regionkey as varchar) as State, r_regionkey % 2 as Judicial from region")
def judicial_file(spark, sf):
    rows = A.table(spark, sf, "region").select("r_regionkey", "r_name", F.col("r_regionkey") % 2)
    return economics.read_judicial(spark, _csv(spark, rows, "judicial"))


@query("""select cast(Year as integer) as "Year", cast(Month as integer) as "Month", Spread as "Spread" from spread""")
def spread_file(spark, sf):
    date = F.date_format(F.make_date("Year", "Month", F.lit(1)), "d/M/yyyy")
    return economics.read_spread(spark, _csv(spark, A.spread(spark, sf).select(date, "Spread"), "spread"))


@query("""
  select 'B' as type, 'MT' || n_nationkey as code from nation where n_nationkey % 3 = 0
  union all select 'A', 'ST' || n_nationkey from nation where n_nationkey % 3 = 1""")
def area_code_file(spark, sf):
    third = F.col("n_nationkey") % 3
    kind = F.when(third == 0, "B").when(third == 1, "A").otherwise("C")
    code = F.concat(F.when(third == 0, "MT").otherwise("ST"), F.col("n_nationkey").cast("string"))
    rows = A.table(spark, sf, "nation").select(kind.alias("k"), code.alias("c"), "n_name")
    states, metros = economics.read_area_codes(spark, _csv(spark, rows, "areas", sep="\t"))
    return states.select(F.lit("A").alias("type"), "code").union(metros.select(F.lit("B"), "code"))


@query("""
  select cast(Year as varchar) as "Year", lpad(cast(Month as varchar), 2, '0') as "Month",
         cast(cast(URate as decimal(10,4)) as varchar) as "URate", 'LAU' || FIPS || '03' as id from ur_metro""")
def series_json(spark, sf):
    """Service responses, one per area, some without data, flattened to rows."""
    rate = F.col("URate").cast("decimal(10,4)").cast("string")
    period = F.concat(F.lit("M"), F.lpad(F.col("Month").cast("string"), 2, "0"))
    item = F.struct(F.col("Year").cast("string").alias("year"), period.alias("period"), rate.alias("value"))
    found = A.unemployment(spark, sf, "metro").groupBy("FIPS").agg(F.collect_list(item).alias("data"))
    areas = A.table(spark, sf, "nation").join(found, F.col("n_nationkey") == F.col("FIPS"), "left")
    id_ = scalars.series_id("LAU", F.col("n_nationkey").cast("string")).alias("seriesID")
    one = F.struct(id_, F.coalesce("data", F.array().cast(found.schema["data"].dataType)).alias("data"))
    body = F.to_json(F.struct(F.struct(F.array(one).alias("series")).alias("Results")))
    path = _path(spark, "json")
    areas.select(body.alias("value")).write.text(path)
    return series.flatten_series(spark.read.schema(series.RESPONSE_SCHEMA).json(path))


@query("""
  select 'LAU' || code || '03' as series, cast((row_number() over (order by code) - 1) // 50 as integer) as request
  from (select lpad(cast(p_partkey as varchar), 6, '0') as code from part)""")
def series_requests(spark, sf):
    codes = A.table(spark, sf, "part").select(F.lpad(F.col("p_partkey").cast("string"), 6, "0").alias("code"))
    return series.request_batches(codes, "LAU")


def _stored(spark, sf):
    path = _path(spark, "transitions")
    columns = [*WHO, "Curr_UPB", "DTI", "Current_Status", "Next_Status"]
    tables.write_transitions(A.transitions(spark, sf).select(*columns), path)
    return path


@query("select Loan_ID, Seq, Curr_UPB, DTI, Current_Status, Next_Status from transitions where Current_Status = 2")
def partition_read(spark, sf):
    """The stored table by (current, next); only one current state's directories are read."""
    return tables.read_transitions(spark, _stored(spark, sf), state=2)


@query("""
  select Loan_ID, Seq, Curr_UPB, DTI, Current_Status, Next_Status from transitions
  where Curr_UPB is not null and DTI is not null""")
def combine_all(spark, sf):
    return tables.combine_all(spark, _stored(spark, sf))


@query("select Current_Status, Next_Status, count(*) as n from transitions group by 1, 2")
def stored_counts(spark, sf):
    """Counts read back from a result table."""
    path = _path(spark, "result")
    counts = A.transitions(spark, sf).groupBy("Current_Status", "Next_Status").agg(F.count("*").alias("n"))
    tables.write_result(counts, path)
    return spark.read.parquet(path)


def _month_only(sql):
    """The same SQL over records whose dates carry a month, as files do."""
    whole = with_tables(sql).replace(
        "cast(o_orderdate as date) as Act_Period", "cast(date_trunc('month', cast(o_orderdate as date)) as date) as Act_Period"
    )
    return whole.replace("min(cast(o_orderdate as date)) as orig_date", "cast(date_trunc('month', min(cast(o_orderdate as date))) as date) as orig_date")


_KINDS = {"double": "float64", "bigint": "int64"}


def _job_files(spark, sf):
    """All inputs of the build as text: records pipe-separated by month, a layout, a file list, six series."""
    records = A.records(spark, sf)
    kinds = {n: _KINDS.get(k, "string") if n not in ("Loan_ID", "State", "ZIP", "MSA") else "string" for n, k in records.dtypes}
    months = {d: F.date_format(d, "MMyyyy") for d in ("Act_Period", "Orig_Date")}
    folder = _path(spark, "raw")
    records.select(F.lit("unused").alias("Pool"), *[months.get(c, F.col(c)).alias(c) for c in kinds]).write.csv(folder, sep="|")
    spec = [(0, "Pool", "Pool", "0", "string"), *((k + 1, n, n, "1", kind) for k, (n, kind) in enumerate(kinds.items()))]
    names = sorted({r.name for r in spark.read.text(folder).select(F.col("_metadata.file_name").alias("name")).distinct().collect()})
    series = A.dimensions(spark, sf)
    first_day = F.make_date("Year", "Month", F.lit(1))
    rates = A.daily_rates(spark, sf).select(F.date_format("Date", "d/M/yyyy").alias("Date"), "`30_Year`", "`15_Year`")
    metro, state = series.metro_unemployment, series.state_unemployment
    day = F.date_format(first_day, "M/d/yyyy").alias("Date")
    none = F.lit(None).cast("string")
    combined = metro.select("FIPS", day, "URate", none.alias("StateAbb")).union(state.select(none, day, "URate", "StateAbb"))
    spread = series.spread.select(F.date_format(first_day, "d/M/yyyy").alias("Date"), "Spread")
    return job.Files(
        layout=_csv(spark, spark.createDataFrame(spec, layout.LAYOUT_SCHEMA), "layout"), folder=folder,
        file_list=_csv(spark, spark.createDataFrame([(n,) for n in names], "name string"), "list"),
        zip_index=_csv(spark, series.zip_index, "zip"), state_index=_csv(spark, series.state_index, "state"),
        rates=_csv(spark, rates, "rates"), unemployment=_csv(spark, combined, "urate"),
        judicial=_csv(spark, series.judicial.select("State", F.lit("x").alias("Full"), "Judicial"), "judicial"),
        spread=_csv(spark, spread, "spread"),
    )


_BUILT = """
  select cast(Loan_ID as varchar) as Loan_ID, Seq, Act_Period::varchar as period, Current_Status, Next_Status, Curr_HPI, MTMLTV,
         Benchmark_Rate, SATO, Curr_URate, URate_Change, Judicial, "10-2Spread" as spread, DTI, Mi_Type, Month_2
  from panel
  where Current_Status between 0 and 6 and (Next_Status = 7 or (Next_Status between -1 and 7 and Next_Status <= Current_Status + 1))"""


def build_from_files(spark, sf):
    """Every legal transition, from text files to the stored table in one call."""
    everything = {s: 1.0 for s in states.STATES}
    out = job.build_from_files(spark, _job_files(spark, sf), _path(spark, "job"), fractions=everything, vintage_edges=A.TEST_EDGES)
    return out.select(
        "Loan_ID", "Seq", F.col("Act_Period").cast("string").alias("period"), "Current_Status", "Next_Status", "Curr_HPI", "MTMLTV",
        "Benchmark_Rate", "SATO", "Curr_URate", "URate_Change", "Judicial", F.col("10-2Spread").alias("spread"), "DTI", "Mi_Type", "Month_2",
    )


QUERIES["build_from_files"], SQL["build_from_files"] = build_from_files, _month_only(_BUILT)

