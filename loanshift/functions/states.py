"""The loan-state alphabet and the transitions that can occur."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
PREPAID = -1
CURRENT = 0
DEFAULT = 7
UNKNOWN = 999
STATES = [-1, 0, 1, 2, 3, 4, 5, 6, 7]
LIVE_STATES = [0, 1, 2, 3, 4, 5, 6]


def targets_of(state: int) -> list[int]:
    """States reachable in one month: one step worse, any better, or default."""
    return [s for s in STATES if s <= state + 1 or s == DEFAULT]


def is_legal(current: Column, following: Column) -> Column:
    return current.between(LIVE_STATES[0], LIVE_STATES[-1]) & (
        ((following >= PREPAID) & (following <= current + 1) & (following <= DEFAULT)) | (following == DEFAULT)
    )


def encode_status(delinquency: Column, zero_balance: Column, credit_event_as_default: bool = False) -> Column:
    """Delinquency text with prepayment as -1 and unknown as 999.

    Prepayment wins over unknown. With ``credit_event_as_default`` an unknown
    status that closes with zero-balance code 2, 3 or 9 becomes a default.
    """
    unknown = delinquency == "XX"
    status = F.when(zero_balance == 1, F.lit(str(PREPAID)))
    if credit_event_as_default:
        status = status.when(unknown & zero_balance.isin(2, 3, 9), F.lit(str(DEFAULT)))
    return status.when(unknown, F.lit(str(UNKNOWN))).otherwise(delinquency)


def status_number(status: Column) -> Column:
    """Text to number; text that is no number becomes null."""
    return status.try_cast("int")
