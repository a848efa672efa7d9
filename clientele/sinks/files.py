"""File writes."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.sinks.folders import replace_folder


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def partition_folder(path: str, slice_values: Mapping[str, object]) -> str:
    for value in slice_values.values():
        if not re.fullmatch(r"[\w.\-]+", str(value)):
            raise ValueError(f"{value!r} cannot name a partition folder")
    return "/".join([path.rstrip("/"), *[f"{name}={value}" for name, value in slice_values.items()]])


def replace_partition(
    df: DataFrame, path: str, slice_values: Mapping[str, object], partition_by: Sequence[str] = ()
) -> None:
    """Replace everything under one partition of a table; an empty frame leaves the partition empty.

    ``slice_values`` are the leading partition columns with their values, in order; ``partition_by`` the partition
    columns below them. Other partitions are not read or written, and a second run gives the same files' content. A row
    that belongs to another slice fails the job; a job that fails, then or later, leaves the old content.
    """
    folder = partition_folder(path, slice_values)
    same = F.lit(True)
    for name, value in slice_values.items():
        if name in df.columns:
            same &= F.col(name).eqNullSafe(F.lit(value).cast(df.schema[name].dataType))
    checked = df.withColumn("_checked", F.assert_true(same, F.lit(f"a row does not belong to {dict(slice_values)}")))
    # The check's null result is used, so that it stays in the plan.
    df = checked.where(F.col("_checked").isNull()).drop("_checked")
    writer = df.drop(*slice_values).write.partitionBy(*partition_by)
    replace_folder(df.sparkSession, path, folder, writer.parquet)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    """Append to, or overwrite, a database table."""
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, **options).save()


def write_at_risk(df: DataFrame, path: str, run_date: dt.date, segment: str = "ALL") -> None:
    """At-risk customers as pipe-separated text, one folder per run date and segment.

    The folder of the run, or of the run and segment, is replaced as a whole, also by nothing.
    """
    place, below = {"run_date": run_date}, ["customer_segment"]
    if segment != "ALL":
        place, below = {**place, "customer_segment": segment}, []
    writer = df.drop(*place).write.option("sep", "|").option("header", True).partitionBy(*below)
    replace_folder(df.sparkSession, path, partition_folder(path, place), writer.csv)


def write_count(df: DataFrame, path: str, run_date: dt.date) -> None:
    """Only the number of rows, as one row under the run date."""
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    replace_partition(counted, path, {"run_date": run_date})


def write_snapshot(lines: DataFrame, path: str, workflow: str, run_date: dt.date) -> None:
    """Snapshot lines as text, one folder per section, replacing an earlier snapshot of the run."""
    folder = f"{path.rstrip('/')}/lineage_{workflow}_{run_date:%Y%m%d}"
    writer = lines.select("section", F.col("document").alias("value")).write.partitionBy("section")
    replace_folder(lines.sparkSession, path, folder, writer.text)
