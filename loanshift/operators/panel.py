"""The transition panel: one row per loan and month with its next state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanshift.functions import scalars, states
from loanshift.functions.names import unused
from loanshift.operators.ordered import HOT_ROWS, Scan, scan

KEY = "Loan_ID"
PERIOD = "Act_Period"


def panel_order(df: DataFrame) -> list[Column]:
    """Month, then the record number ``Seq`` where a loan has several per month."""
    return [F.col(c).asc() for c in (PERIOD, "Seq") if c in df.columns]


def encode(df: DataFrame, credit_event_as_default: bool = False) -> DataFrame:
    """Status text with prepayment and unknown encoded, its number, and the age share."""
    status = states.encode_status(
        F.col("Current_Loan_Delinquency_Status"), F.col("Zero_Balance_Code"), credit_event_as_default
    )
    out = df.withColumn("Current_Loan_Delinquency_Status", status)
    out = out.withColumn("Current_Status", states.status_number(F.col("Current_Loan_Delinquency_Status")))
    if {"Loan_Age", "Orig_Term"} <= set(df.columns):
        out = out.withColumn("Age_Prop", scalars.age_share(F.col("Loan_Age"), F.col("Orig_Term")))
    return out


def add_history(df: DataFrame, hot_rows: int = HOT_ROWS, count_from: DataFrame | None = None) -> DataFrame:
    """Next status, running worst status, record number, filled remaining term.

    All four share one partitioning and one sort. The running worst status is
    null where the current status is null.
    """
    [filled] = unused(df.columns, "rem")
    fills = {filled: "Rem_Months"} if "Rem_Months" in df.columns else {}
    what = Scan(
        lead={"Next_Status": "Current_Status"},
        running_max={"Cum_Max_Status": "Current_Status"},
        fill=fills,
        position="Cum_Count",
    )
    out = scan(df, [KEY], panel_order(df), what, hot_rows, count_from)
    out = out.withColumn(
        "Cum_Max_Status", F.when(F.col("Current_Status").isNotNull(), F.col("Cum_Max_Status"))
    )
    return out.withColumn("Rem_Months", F.col(filled)).drop(filled) if fills else out


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def keep_observed(df: DataFrame, require_balance: bool = True) -> DataFrame:
    """Drop everything from the first default on, each loan's first record,
    closed records, records followed by an unknown status, missing balances."""
    out = df.where(
        ~_holds(F.col("Cum_Max_Status") >= states.DEFAULT)
        & ~_holds(F.col("Cum_Count") == 0)
        & ~_holds(F.col("Current_Status") == states.PREPAID)
        & ~_holds(F.col("Next_Status") == states.UNKNOWN)
    )
    return out.where(F.col("Curr_UPB").isNotNull()) if require_balance else out


def legal_transitions(df: DataFrame) -> DataFrame:
    return df.where(states.is_legal(F.col("Current_Status"), F.col("Next_Status")))


def dropped_jumps(df: DataFrame) -> DataFrame:
    """Count of the (current, next) pairs the transition table leaves out."""
    legal = states.is_legal(F.col("Current_Status"), F.col("Next_Status"))
    return (
        df.where(F.col("Next_Status").isNotNull() & ~_holds(legal))
        .groupBy("Current_Status", "Next_Status")
        .agg(F.count("*").alias("n"))
    )


def imputed_balance(
    df: DataFrame, hot_rows: int = HOT_ROWS, round_payment: bool = False, count_from: DataFrame | None = None
) -> DataFrame:
    """Replace zero balances by the scheduled balance.

    Each run of zero months starts again from the original balance, so the
    number of payments is the record's position in its run.
    """
    at, before, paid = unused(df.columns, "at", "before", "paid")
    flagged = df.withColumn(paid, ~F.col("Curr_UPB").eqNullSafe(0.0))
    out = scan(flagged, [KEY], panel_order(df), Scan(position=at, last_at={before: paid}), hot_rows, count_from)
    in_run = F.col(at) - F.coalesce(F.col(before), F.lit(-1))
    scheduled = scalars.amortized_balance(
        F.col("Orig_UPB"), F.col("Orig_Rate"), F.col("Orig_Term"), in_run.cast("double"), round_payment
    )
    balance = F.when(F.col("Curr_UPB") == 0, scheduled).otherwise(F.col("Curr_UPB"))
    return out.withColumn("Curr_UPB", balance).drop(at, before, paid)
