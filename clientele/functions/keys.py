"""Surrogate keys and key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.functions import fixed_values as fv

#: Bits of a number that a window over rows spans, and those that a window over counts spans: 64 in three levels.
LOW_BITS, COUNT_BITS = 16, 24


class DuplicateKeyError(ValueError):
    """The source of a merge holds a key more than once."""


def next_key(existing: DataFrame, key: str, first: int = fv.FIRST_KEY) -> Column:
    """The first free key of a table, as a scalar subquery inside the caller's own plan."""
    return existing.agg(F.coalesce(F.max(key) + 1, F.lit(first)).alias("next_key")).scalar()


def with_sequence(
    df: DataFrame, key: str, start: Column | int, order_by: Sequence[str], number: Column | None = None
) -> DataFrame:
    """Number rows ``start``, ``start + 1`` and so on, without gaps and without sending them all through one task.

    Rows are numbered by ``number``, a 64-bit whole number, and equal numbers by ``order_by``, which must name a unique key
    of the rows; the default number is a hash of that key. So the keys are the same on every re-run.

    Each row counts the rows before it that share all but the lowest 16 bits of its number; what lies before those is added
    up from their counts, in two more levels of 24 bits. A window spans what shares the higher bits: 65,536 rows of
    different numbers at most, or a count for every 65,536 and for every 2**40 numbers.
    """
    start = F.lit(start) if isinstance(start, int) else start
    number = F.xxhash64(*order_by) if number is None else F.coalesce(number.cast("bigint"), F.lit(0))
    rows = df.withColumns({"__block": F.shiftright(number, LOW_BITS), "__number": number})
    counts = rows.groupBy("__block").agg(F.count(F.lit(1)).alias("__rows"))
    counts = counts.withColumn("__upper", F.shiftright("__block", COUNT_BITS))
    uppers = counts.groupBy("__upper").agg(F.sum("__rows").alias("__rows")).withColumn("__all", F.pmod("__upper", F.lit(1)))
    above = _before(uppers, "__all", "__upper", "__below").select("__upper", "__below")
    offsets = _before(counts, "__upper", "__block", "__before").join(above, "__upper")
    offset = start + F.col("__before") + F.col("__below")
    place = F.row_number().over(Window.partitionBy("__block").orderBy("__number", *order_by)) - 1
    numbered = rows.withColumn("__place", place).join(offsets.select("__block", offset.alias("__first")), "__block")
    return numbered.withColumn(key, (F.col("__first") + F.col("__place")).cast("bigint")).drop(
        "__block", "__number", "__place", "__first"
    )


def _before(counts: DataFrame, within: str, order: str, name: str) -> DataFrame:
    """Counts with the sum of those before each among those that share ``within``."""
    earlier = Window.partitionBy(within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Raise if a key occurs twice; a join on it would silently multiply rows."""
    twice = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        raise DuplicateKeyError(f"{what}: key {twice[0].asDict()} occurs more than once")
    return df


def single(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The rows as they are; the job fails on a key that is null or occurs twice. The check shares the shuffle of a join."""
    alone = F.count(F.lit(1)).over(Window.partitionBy(*keys)) == 1
    known = F.lit(True)
    for name in keys:
        known &= F.col(name).isNotNull()
    checked = df.withColumn("__single", F.assert_true(alone & known, F.lit(f"{what}: a key is null or occurs more than once")))
    # The check's null result is used, so that it stays in the plan.
    return checked.where(F.col("__single").isNull()).drop("__single")
