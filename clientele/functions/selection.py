"""The newest row of each key, and the first rows of a table, without sorting aggregates and without one task for all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.functions.joins import lookup_join
from clientele.functions.keys import with_sequence

#: Added to days so that all are above the 0 that stands for a missing one.
DAYS = 1 << 30


def days_key(first: Column, second: Column) -> Column:
    """Two dates as one whole number that orders as they do, a missing date before all others."""

    def number(day: Column) -> Column:
        return F.coalesce(F.unix_date(day).cast("bigint") + DAYS, F.lit(0).cast("bigint"))

    return F.shiftleft(number(first), 32) + number(second)


def days_of(key: Column) -> tuple[Column, Column]:
    """The two dates again."""

    def day(number: Column) -> Column:
        return F.when(number > 0, F.date_from_unix_date((number - DAYS).cast("int")))

    return day(F.shiftright(key, 32)), day(key.bitwiseAND(F.lit((1 << 32) - 1)))


def newest_rows(
    df: DataFrame, keys: Sequence[str], order: Column, ties: Sequence[str], **figures: Column
) -> DataFrame:
    """The row of each key with the greatest ``order``, a number or date; among equals the greatest ``ties``.

    ``figures`` are further aggregates of each key, added as columns.

    The greatest number of each key is found by hash aggregation, partly before the shuffle. Other columns, texts among
    them, are fetched for rows that hold it, and only those are compared by ``ties``.
    """
    ordered = df.withColumn("__order", order)
    most = ordered.groupBy(*keys).agg(F.max("__order").alias("__most"), *[c.alias(x) for x, c in figures.items()])
    most = most.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = F.col("__order").eqNullSafe(F.col("__most"))
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__{k}"))
    held = ordered.join(most, same).drop("__most", *[f"__{k}" for k in keys])
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in ties]))
    return held.withColumn("__place", place).filter("__place = 1").drop("__order", "__place")


def first_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """The ``n`` rows of the lowest keys; ``key`` is a unique whole number. No task holds ``n`` rows."""
    return with_sequence(df, "__place", 0, [key], F.col(key)).filter(F.col("__place") < n).drop("__place")


def newest_days_rows(df: DataFrame, n: int, day: str, key: str) -> DataFrame:
    """The ``n`` rows of the newest days, on the last of those the ones of the lowest keys.

    Rows are counted by day. Days that are wanted whole need no order; only the rows of the day at the edge are numbered.
    """
    counts = df.groupBy(day).agg(F.count(F.lit(1)).alias("__rows")).withColumn("__all", F.pmod(F.unix_date(day), F.lit(1)))
    newer = Window.partitionBy("__all").orderBy(F.desc(day)).rowsBetween(Window.unboundedPreceding, -1)
    days = counts.withColumn("__before", F.coalesce(F.sum("__rows").over(newer), F.lit(0))).filter(F.col("__before") < n)
    found = lookup_join(df, days.drop("__all"), day, "inner", spread_by=key)
    whole = F.col("__before") + F.col("__rows") <= n
    edge = with_sequence(found.filter(~whole), "__place", 0, [key], F.col(key))
    edge = edge.filter(F.col("__place") < n - F.col("__before")).drop("__place")
    return found.filter(whole).unionByName(edge).drop("__rows", "__before")
