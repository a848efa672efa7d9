"""The slowly changing customer dimension (type 2)."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele import schemas
from clientele.functions import fixed_values as fv
from clientele.functions.keys import next_key, single, with_sequence
from clientele.functions.predicates import differs

# Only these columns open a new version; a new phone or region alone does not.
TRACKED = ("full_name", "email", "postcode", "customer_segment", "is_opted_in_email")
CARRIED = (
    "customer_code",
    "full_name",
    "email",
    "phone",
    "date_of_birth",
    "postcode",
    "region_code",
    "customer_segment",
    "acquisition_channel",
    "is_opted_in_email",
)


def full_name(first: Column, last: Column) -> Column:
    """Both names with a space between; a missing name counts as empty."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def current_dimension(dimension: DataFrame) -> DataFrame:
    return dimension.filter(F.col("is_current") == "Y")


def incoming(staged: DataFrame) -> DataFrame:
    """Staged rows in the shape of the dimension; the job fails on a customer that is null or staged twice."""
    named = single(staged, ["customer_id"], "staged profiles").withColumn("full_name", full_name(F.col("first_name"), F.col("last_name")))
    return named.select("customer_id", *CARRIED)


def changed(old: str, new: str) -> Column:
    return reduce(or_, [differs(F.col(f"{old}.{c}"), F.col(f"{new}.{c}")) for c in TRACKED])


def scd2_closed(dimension: DataFrame, staged: DataFrame, run_date: dt.date) -> DataFrame:
    """Current rows that a staged row replaces, as they look once closed."""
    new = incoming(staged).select("customer_id", *TRACKED).alias("new")
    replaced = (
        current_dimension(dimension)
        .alias("old")
        .join(new, F.col("old.customer_id") == F.col("new.customer_id"), "inner")
        .filter(changed("old", "new"))
        .select("old.*")
    )
    return close(replaced, run_date)


def close(rows: DataFrame, run_date: dt.date) -> DataFrame:
    return rows.withColumns(
        {
            "valid_to": F.lit(run_date - dt.timedelta(days=1)),
            "is_current": F.lit("N"),
            "updated_date": F.lit(run_date),
        }
    )


def scd2_inserted(
    dimension: DataFrame, staged: DataFrame, run_date: dt.date, start: Column | int | None = None
) -> DataFrame:
    """New current rows: for customers without a current row, and for those whose row has just been closed.

    A current row carries the newest version number of its customer. History is looked up for staged customers only, and
    counts for those without a current row; the rest of it is not shuffled. Surrogate keys follow the order of customers
    from ``start`` on, by default the first that the dimension has free.
    """
    standing = current_dimension(dimension).select("customer_id", *TRACKED, "version_num", F.lit(True).alias("stands"))
    past = dimension.filter(~F.col("is_current").eqNullSafe(F.lit("Y"))).select("customer_id", "version_num")
    past = past.join(staged.select("customer_id"), "customer_id", "left_semi")
    versions = past.groupBy("customer_id").agg(F.max("version_num").alias("past_version"))
    opened = (
        incoming(staged)
        .alias("new")
        .join(standing.alias("old"), F.col("old.customer_id") == F.col("new.customer_id"), "left")
        .filter(F.col("old.stands").isNull() | changed("old", "new"))
        .select("new.*", "old.version_num")
        .join(versions, "customer_id", "left")
        .withColumn("last_version", F.coalesce("version_num", "past_version"))
    )
    first = next_key(dimension, "dim_crm_customer_key") if start is None else start
    numbered = with_sequence(opened, "dim_crm_customer_key", first, ["customer_id"], F.col("customer_id"))
    return numbered.select(
        "dim_crm_customer_key",
        "customer_id",
        *CARRIED,
        F.lit(run_date).alias("valid_from"),
        F.lit(fv.OPEN_END).alias("valid_to"),
        F.lit("Y").alias("is_current"),
        (F.coalesce("last_version", F.lit(0)) + 1).cast("int").alias("version_num"),
        F.lit(run_date).alias("created_date"),
        F.lit(None).cast("date").alias("updated_date"),
    )


def scd2_step(
    dimension: DataFrame, staged: DataFrame, run_date: dt.date, start: Column | int | None = None
) -> DataFrame:
    """The rows a run writes: every row that was current before, kept or closed, and the newly opened ones.

    Rows closed by earlier runs are not read beyond their version numbers, so history is never rewritten.
    """
    columns = schemas.DIM_CUSTOMER_CRM.names
    new = incoming(staged).select("customer_id", *TRACKED, F.lit(True).alias("arrives")).alias("new")
    current = (
        current_dimension(dimension)
        .alias("old")
        .join(new, F.col("old.customer_id") == F.col("new.customer_id"), "left")
        .select("old.*", (F.col("new.arrives").isNotNull() & changed("old", "new")).alias("replaced"))
    )
    last_day = F.lit(run_date - dt.timedelta(days=1))
    after = current.withColumns(
        {
            "valid_to": F.when(F.col("replaced"), last_day).otherwise(F.col("valid_to")),
            "is_current": F.when(F.col("replaced"), "N").otherwise(F.col("is_current")),
            "updated_date": F.when(F.col("replaced"), F.lit(run_date)).otherwise(F.col("updated_date")),
        }
    )
    inserted = scd2_inserted(dimension, staged, run_date, start)
    return after.select(*columns).unionByName(inserted.select(*columns))


def scd2_merge(
    dimension: DataFrame, staged: DataFrame, run_date: dt.date, start: Column | int | None = None
) -> DataFrame:
    """The whole dimension after the run. ``staged`` must hold each customer once."""
    history = dimension.filter(~F.col("is_current").eqNullSafe(F.lit("Y")))
    step = scd2_step(dimension, staged, run_date, start)
    return history.select(*schemas.DIM_CUSTOMER_CRM.names).unionByName(step)


def mark_loaded(profiles: DataFrame, run_date: dt.date, segment: str = "ALL", region: str = "ALL") -> DataFrame:
    """Pending rows of the run turned to loaded; all other rows as they were."""
    in_scope = (F.col("load_date") == F.lit(run_date)) & (F.col("etl_status") == fv.PENDING)
    for column, wanted in (("customer_segment", segment), ("region_code", region)):
        if wanted.upper() != "ALL":
            in_scope = in_scope & F.col(column).eqNullSafe(F.lit(wanted))
    status = F.when(in_scope, F.lit(fv.LOADED)).otherwise(F.col("etl_status"))
    return profiles.withColumn("etl_status", status)
