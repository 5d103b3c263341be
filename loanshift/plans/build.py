"""The panel build: records and economic series to model-ready transitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanshift.functions import names
from loanshift.operators import clean, features, lookups, panel, sampling
from loanshift.operators.ordered import HOT_ROWS


@dataclass(frozen=True)
class Series:
    """Dimension tables, each unique on its lookup key."""

    zip_index: DataFrame
    state_index: DataFrame
    rates: DataFrame
    metro_unemployment: DataFrame
    state_unemployment: DataFrame
    judicial: DataFrame
    spread: DataFrame


def enrich(df: DataFrame, series: Series) -> DataFrame:
    out = lookups.add_price_index(df, series.zip_index, series.state_index)
    out = lookups.add_rates(out, series.rates)
    out = lookups.add_unemployment(out, series.metro_unemployment, series.state_unemployment)
    out = lookups.add_judicial(out, series.judicial)
    return lookups.add_spread(out, series.spread)


def build_panel(
    records: DataFrame,
    series: Series,
    vintage_edges: list[int] | None = None,
    impute_by: list[str] | None = None,
    credit_event_as_default: bool = False,
    hot_rows: int = HOT_ROWS,
    count_from: DataFrame | None = None,
) -> DataFrame:
    """Clean, encode, window, enrich, require, engineer, prune.

    One aggregate for the imputation means, one shuffle on the loan for all
    windows; lookups, features and filters run in the same stage as the windows
    as long as the dimensions are small enough to broadcast. Records should be
    read from Parquet (store text files once): counting records per loan then
    reads one column.
    """
    out = clean.clean(records, impute_by=impute_by)
    out = panel.encode(out, credit_event_as_default)
    out = panel.keep_observed(panel.add_history(out, hot_rows, count_from))
    out = out.drop("Cum_Max_Status", "Cum_Count", "Zero_Balance_Code")
    out = clean.require(enrich(out, series))
    out = features.month_indicators(features.vintage_bins(out, edges=vintage_edges))
    return out.drop(*features.NOT_IN_PANEL)


def transition_table(
    records: DataFrame,
    series: Series,
    fractions: dict[int, float] | None = None,
    vintage_edges: list[int] | None = None,
    impute_by: list[str] | None = None,
    credit_event_as_default: bool = False,
    hot_rows: int = HOT_ROWS,
    count_from: DataFrame | None = None,
) -> DataFrame:
    """The sampled legal transitions of ``build_panel``, shuffling little.

    Windows need every record's loan, month and status, but only sampled rows
    need the rest, and a row's own key and status decide whether it is sampled.
    So the other columns travel as one struct that is null for rows left out:
    with the default fractions well under one percent of the wide data is
    shuffled, and only those rows are looked up.
    """
    out = panel.encode(clean.clean(records, impute_by=impute_by), credit_event_as_default)
    narrow = [c for c in ("Loan_ID", "Act_Period", "Seq", "Current_Status") if c in out.columns]
    unused = {"Zero_Balance_Code", *features.NOT_IN_PANEL} - {"Orig_Date", "State"}
    rest = [c for c in out.columns if c not in narrow and c not in unused]
    [whole] = names.unused(out.columns, "row")
    carried = F.when(sampling.in_sample(out, fractions), F.struct(*[F.col(f"`{c}`") for c in rest]))
    history = panel.add_history(out.select(*narrow, carried.alias(whole)), hot_rows, count_from)
    seen = panel.keep_observed(history, require_balance=False).where(F.col(whole).isNotNull())
    rows = panel.legal_transitions(seen).select(*narrow, "Next_Status", f"{whole}.*")
    rows = rows.where(F.col("Curr_UPB").isNotNull())
    rows = clean.require(enrich(rows, series))
    rows = features.month_indicators(features.vintage_bins(rows, edges=vintage_edges))
    return rows.drop(*features.NOT_IN_PANEL)
