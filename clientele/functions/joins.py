"""Joins to short lookup tables whose keys are few and therefore hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES = 16


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str,
    spread_by: str,
    copies: int = COPIES,
) -> DataFrame:
    """Join many rows to a lookup that has one row per key, safe when one key holds much of the data.

    No broadcast is forced. Where Spark measures the lookup as within its broadcast limit it broadcasts the copies,
    at most ``copies`` times that limit; where not, each key is spread over ``copies`` tasks by the hash of
    ``spread_by`` instead of landing in a single one, and adaptive execution may split those further. Rows with a
    null key are spread the same way. ``spread_by`` must vary inside a key.
    """
    keys = [on] if isinstance(on, str) else list(on)
    spread = F.pmod(F.xxhash64(spread_by), F.lit(copies)).cast("int")
    salted_facts = facts.withColumn("__copy", spread)
    salted_lookup = lookup.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return salted_facts.join(salted_lookup, [*keys, "__copy"], how).drop("__copy")
