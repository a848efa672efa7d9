"""Keyed changes as new frames: parquet tables take no MERGE, UPDATE or DELETE."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.keys import single


def upsert(
    table: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    insert: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``table`` after matched rows took the ``update`` columns of ``changes`` and unmatched rows were added.

    A new row takes every column of the same name from ``changes`` and null elsewhere; ``insert`` overrides single
    columns of new rows with expressions over ``new``. A key that ``changes`` holds twice, or with a null, fails the job;
    the check shares the shuffle of the join.
    """
    insert = insert or {}
    old = table.withColumn("__in_table", F.lit(True)).alias("old")
    new = single(changes, keys, f"changes by {list(keys)}").withColumn("__in_changes", F.lit(True)).alias("new")
    same = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    held, arrives = F.col("old.__in_table").isNotNull(), F.col("new.__in_changes").isNotNull()

    def after(name: str) -> Column:
        kept, given = F.col(f"old.{name}"), F.col(f"new.{name}") if name in changes.columns else F.lit(None)
        matched = given if name in update else kept
        return F.when(held & arrives, matched).when(held, kept).otherwise(insert.get(name, given)).alias(name)

    return old.join(new, same, "full_outer").select(*[after(name) for name in table.columns])


def insert_if_absent(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key the table does not hold."""
    return rows.join(table.select(*keys), list(keys), "left_anti").select(*rows.columns)


def replace_slice(table: DataFrame, rows: DataFrame, slice_condition: Column) -> DataFrame:
    """The table with one slice exchanged; no new rows means an empty slice.

    The new rows pass a shuffle of their own: where both sides are dealt alike, Spark would join their partitions and hold the
    sorts and hash tables of both in one task.
    """
    outside = table.filter(~F.coalesce(slice_condition, F.lit(False)))
    return outside.unionByName(rows.select(*table.columns).hint("rebalance"))
