"""Enrichment from economic series.

A series becomes one row per place, its periods an array, so one join serves a
loan's values now and at origination; a series without a place is one row and
needs no join. No join here carries a broadcast hint: Catalyst broadcasts a
dimension whose measured file size is under
``spark.sql.autoBroadcastJoinThreshold``. A larger one is shuffled, with every
place salted, so that a hot or missing place is spread over many tasks.
Uniqueness is enforced inside the plan, so a lookup cannot change the row count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanshift.functions import scalars
from loanshift.functions.names import unused
from loanshift.session import broadcast_limit, estimated_bytes, materialize


def unique_by(dim: DataFrame, keys: list[str], reduce: Callable[[str], Column] | None = None) -> DataFrame:
    """One row per key: an error on duplicates, or ``reduce`` applied to the values."""
    values = [c for c in dim.columns if c not in keys]
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    groups = dim.where(known).groupBy(*keys)
    if reduce is not None:
        return groups.agg(*[reduce(v).alias(v) for v in values])
    message = F.lit("duplicate lookup key: " + ", ".join(keys))
    [rows] = unused(dim.columns, "n")
    counted = groups.agg(F.count("*").alias(rows), *[F.first(v).alias(v) for v in values])
    return counted.select(
        *keys, *[F.when(F.col(rows) > 1, F.raise_error(message)).otherwise(F.col(v)).alias(v) for v in values]
    )


def lookup(df: DataFrame, dim: DataFrame, on: dict[str, Column], take: dict[str, str]) -> DataFrame:
    """Left join ``dim`` on ``dim column == expression`` and add ``new column: dim column``.

    ``dim`` must be unique on the join columns (see ``unique_by``). Nothing but
    the new columns is added, and none of the caller's is lost.
    """
    held = dict(zip(take, unused(df.columns, *take)))
    out = _join(df, dim, on, {held[n]: c for n, c in take.items()})
    return _with(df, out, {n: F.col(f"`{h}`") for n, h in held.items()})


def _join(df: DataFrame, dim: DataFrame, on: dict[str, Column], take: dict[str, str]) -> DataFrame:
    """``lookup`` that leaves its key columns behind, so a chain of lookups drops them once."""
    keys = dict(zip(on, unused([*df.columns, *take], *[f"on_{c}_{'_'.join(take)}" for c in on])))
    side = dim.select(*[F.col(c).alias(k) for c, k in keys.items()], *[F.col(s).alias(n) for n, s in take.items()])
    return df.join(side, [expression == F.col(f"`{keys[c]}`") for c, expression in on.items()], "left")


def _with(df: DataFrame, joined: DataFrame, added: dict[str, Column]) -> DataFrame:
    """The columns of ``df`` and those added, from ``joined``; an added name replaces an old column."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in added]
    return joined.select(*kept, *[value.alias(name) for name, value in added.items()])


def _quarter(date: str) -> Column:
    return F.year(date) * 4 + F.quarter(date)


def _month(date: str) -> Column:
    return F.year(date) * 12 + F.month(date)


def _line(dim: DataFrame, place: list[str], period: Column, values: list[str], message: str) -> Column:
    """An aggregate: the first period of a place and one array per value from there on, null where there is none."""
    cells = F.array_sort(F.collect_list(F.struct(period.cast("int").alias("at"), *[F.col(f"`{v}`").alias(f"v{k}") for k, v in enumerate(values)])))

    def built(found: Column) -> Column:
        first, last = found[0]["at"], F.element_at(found, -1)["at"]
        whole = F.size(found) == last - first + 1
        arrays = []
        for k in range(len(values)):
            known = F.map_from_entries(F.transform(found, lambda c: F.struct(c["at"], c[f"v{k}"])))
            gaps = F.transform(F.sequence(first, last), lambda at: F.try_element_at(known, at))
            arrays.append(F.when(whole, F.transform(found, lambda c: c[f"v{k}"])).otherwise(gaps).alias(f"v{k}"))
        line = F.struct(first.alias("first"), *arrays)
        repeated = F.size(F.array_distinct(F.transform(found, lambda c: c["at"]))) < F.size(found)
        wrong = F.raise_error(F.lit(message))
        # An error has no type of its own: it stands in for the first period.
        return F.when(F.size(found) > 0, F.struct(F.when(repeated, wrong.cast("int")).otherwise(line["first"]).alias("first"), *[line[f"v{k}"].alias(f"v{k}") for k in range(len(values))]))

    return F.transform(F.array(cells), built)[0]


def _timeline(dim: DataFrame, place: str | None, period: list[str], values: list[str]) -> DataFrame:
    """One row per place (or one for a series without) with its ``line``; two rows of one period are an error."""
    keys = [*([place] if place else []), *period]
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    per_year = {"Quarter": 4, "Month": 12}[period[1]]
    line = _line(dim, keys[:1] if place else [], F.col(period[0]) * per_year + F.col(period[1]), values, "duplicate lookup key: " + ", ".join(keys))
    return dim.where(known).groupBy(*([place] if place else [])).agg(line.alias("line"))


def _at(line: Column, period: Column, k: int = 0) -> Column:
    """The value of a period; null without a line, and outside it."""
    return F.get(line[f"v{k}"], period - line["first"])


#: Copies of a dimension that is too large to be broadcast; as many tasks share a hot place.
SALTS = 16


def _with_line(df: DataFrame, dim: DataFrame, place: str, key: Column, period: list[str], values: list[str], name: str, by: list[str]) -> DataFrame:
    """Left join of the timeline of each row's place as the struct ``name``.

    ``by`` are columns that tell rows apart: they choose a row's salt.
    """
    own, salt = unused([*df.columns, name], "place", "salt")
    line = _timeline(dim, place, period, values).select(F.col(place).alias(own), F.col("line").alias(name))
    if estimated_bytes(dim) <= broadcast_limit(df.sparkSession):
        return df.join(line, key == F.col(own), "left").drop(own)
    copies = line.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    [mine] = unused([*df.columns, name, own, salt], "mine")
    salted = df.withColumn(mine, F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))
    return salted.join(copies, (key == F.col(own)) & (F.col(mine) == F.col(salt)), "left").drop(own, salt, mine)


def _row_key(df: DataFrame) -> list[str]:
    return [c for c in ("Loan_ID", "Act_Period", "Seq") if c in df.columns]


def last_of_month(rates: DataFrame, date: str = "Date") -> DataFrame:
    """The latest record of each month, with Year and Month in place of the date."""
    values = [c for c in rates.columns if c != date]
    dated = rates.withColumns({"Year": F.year(date), "Month": F.month(date)})
    latest = dated.groupBy("Year", "Month").agg(F.max_by(F.struct(*values), F.col(date)).alias("row"))
    return latest.select("Year", "Month", *[F.col("row").getField(v).alias(v) for v in values])


def add_price_index(df: DataFrame, by_zip: DataFrame, by_state: DataFrame, levels: bool = False) -> DataFrame:
    """Current and origination price index by ZIP, by state where ZIP has none,
    their ratio, and the loan-to-value marked with it."""
    zips, regions = unused(df.columns, "zip", "region")
    out = _with_line(df, by_zip, "Zip", F.col("ZIP"), ["Year", "Quarter"], ["HPI"], zips, _row_key(df))
    out = _with_line(out, by_state, "State", F.col("State"), ["Year", "Quarter"], ["HPI"], regions, _row_key(df))
    dates = {"Curr": "Act_Period", "Orig": "Orig_Date"}
    held = {n: (_at(F.col(zips), _quarter(d)), _at(F.col(regions), _quarter(d))) for n, d in dates.items()}
    found = {n: F.coalesce(z, r) for n, (z, r) in held.items()}
    added = {f"{n}_HPI": value for n, value in found.items()}
    if levels:
        for n, (z, r) in held.items():
            added[f"{n}_HPI_Level"] = F.when(z.isNotNull(), "ZIP").when(r.isNotNull(), "State")
    ratio = scalars.index_ratio(found["Curr"], found["Orig"])
    added["HPI_Adjust_Factor"] = ratio
    added["MTMLTV"] = scalars.marked_ltv(F.col("Curr_UPB"), F.col("Orig_UPB"), F.col("OLTV"), ratio)
    return _with(df, out, added)


def add_rates(df: DataFrame, monthly: DataFrame) -> DataFrame:
    """Benchmark rate for the loan's term now, refinance incentive, and the
    spread of the loan's rate over the benchmark at origination."""
    [line] = unused(df.columns, "rates")
    out = df.withColumn(line, _timeline(monthly, None, ["Year", "Month"], ["30_Year", "15_Year"]).scalar())
    is_30y = F.col("Orig_Term") == 360

    def rate(date: str) -> Column:
        return F.when(is_30y, _at(F.col(line), _month(date))).otherwise(_at(F.col(line), _month(date), 1))

    now, at_origin = rate("Act_Period"), rate("Orig_Date")
    added = {
        "Benchmark_Rate": now,
        "Refinance Indicator": scalars.refinance_incentive(F.col("Orig_Rate"), now),
        "SATO": F.col("Orig_Rate") - at_origin,
    }
    return _with(df, out, added)


def split_unemployment(combined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The combined file as a metro table and a state table."""
    metro = combined.where(F.col("FIPS").isNotNull()).select("FIPS", "Year", "Month", "URate")
    state = combined.where(F.col("StateAbb").isNotNull()).select("StateAbb", "Year", "Month", "URate")
    return metro, state


def add_unemployment(df: DataFrame, metro: DataFrame, state: DataFrame) -> DataFrame:
    """Unemployment rate of the metro area, of the state where there is none,
    now and at origination, and the change."""
    areas, regions = unused(df.columns, "metro", "region")
    out = _with_line(df, metro, "FIPS", F.col("MSA"), ["Year", "Month"], ["URate"], areas, _row_key(df))
    out = _with_line(out, state, "StateAbb", F.col("State"), ["Year", "Month"], ["URate"], regions, _row_key(df))
    dates = {"Curr": "Act_Period", "Orig": "Orig_Date"}
    found = {n: F.coalesce(_at(F.col(areas), _month(d)), _at(F.col(regions), _month(d))) for n, d in dates.items()}
    added = {"Curr_URate": found["Curr"], "Orig_URate": found["Orig"], "URate_Change": found["Curr"] - found["Orig"]}
    return _with(df, out, added)


def add_judicial(df: DataFrame, judicial: DataFrame) -> DataFrame:
    return lookup(df, unique_by(judicial, ["State"]), {"State": F.col("State")}, {"Judicial": "Judicial"})


def add_spread(df: DataFrame, spread: DataFrame) -> DataFrame:
    [line] = unused(df.columns, "spread")
    out = df.withColumn(line, _timeline(spread, None, ["Year", "Month"], ["Spread"]).scalar())
    return _with(df, out, {"10-2Spread": _at(F.col(line), _month("Act_Period"))})


def rows_of_loans(rows: DataFrame, transitions: DataFrame, current: int = 0, following: int = 7) -> DataFrame:
    """Every record of the loans that made a given transition.

    The loan list is stored first: few loans are broadcast by their measured
    size and the records are not shuffled at all; many are joined by shuffle.
    """
    made = (F.col("Current_Status") == current) & (F.col("Next_Status") == following)
    listed = materialize(transitions.where(made).select("Loan_ID").distinct())
    return rows.join(listed, "Loan_ID", "left_semi")
