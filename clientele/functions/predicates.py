"""Filters that recur across the operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "ALL"


def only(df: DataFrame, column: str | Column, wanted: str | None) -> DataFrame:
    """Keep rows whose ``column`` equals ``wanted``; ``ALL`` or None adds no filter at all."""
    if wanted is None or wanted.upper() == ALL:
        return df
    column = F.col(column) if isinstance(column, str) else column
    return df.filter(column == F.lit(wanted))


def within_days(column: str | Column, run_date: dt.date, days: int) -> Column:
    """From ``days`` before the run date up to the end of the run date."""
    column = F.col(column) if isinstance(column, str) else column
    first, after_last = run_date - dt.timedelta(days=days), run_date + dt.timedelta(days=1)
    return (column >= F.lit(first)) & (column < F.lit(after_last))


def since_days(column: str | Column, run_date: dt.date, days: int) -> Column:
    """From ``days`` before the run date on, with no upper end."""
    column = F.col(column) if isinstance(column, str) else column
    return column >= F.lit(run_date - dt.timedelta(days=days))


def differs(left: Column, right: Column) -> Column:
    """True where the values differ; two nulls are equal, a null and a value are not."""
    return ~left.eqNullSafe(right)
