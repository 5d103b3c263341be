"""Scratch column names, and joins on groups that may be null."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unused(columns: list[str], *names: str) -> list[str]:
    """``names``, each with as many leading underscores as no column in ``columns`` has."""
    taken = {c.lower() for c in columns}
    prefix = "_"
    while any((prefix + n).lower() in taken for n in names):
        prefix += "_"
    return [prefix + n for n in names]


def prefix(columns: list[str]) -> str:
    """Underscores that no column begins with: any name after it is free."""
    lead = max((len(c) - len(c.lstrip("_")) for c in columns), default=0)
    return "_" * (lead + 1)


def join_groups(df: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """Inner join of per-group columns on ``by``, where null is a group like any other."""
    own = dict(zip(by, unused([*df.columns, *groups.columns], *by)))
    side = groups.withColumnsRenamed(own)
    match = F.lit(True)
    for column, renamed in own.items():
        match = match & F.col(f"`{column}`").eqNullSafe(F.col(f"`{renamed}`"))
    return df.join(side, match).drop(*own.values())
