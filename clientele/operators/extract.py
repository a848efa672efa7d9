"""Source to staging: profiles, campaign events, interactions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions import fixed_values as fv
from clientele.functions.joins import lookup_join
from clientele.functions.predicates import only, since_days, within_days
from clientele.functions.selection import newest_days_rows


def profile_columns(segment_code: Column, run_date: dt.date) -> list[Column]:
    """Source names to staging names, with the staging defaults."""

    def or_default(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.lit(default))

    return [
        F.col("cust_id").alias("customer_id"),
        F.col("cust_ref").alias("customer_code"),
        F.col("given_name").alias("first_name"),
        F.col("family_name").alias("last_name"),
        F.col("dob").alias("date_of_birth"),
        F.lower("email").alias("email"),
        F.col("tel_home").alias("phone"),
        F.col("tel_mobile").alias("mobile"),
        F.col("addr_line1").alias("address_line1"),
        F.lit(None).cast("string").alias("address_line2"),
        F.col("addr_city").alias("city"),
        F.col("addr_postcode").alias("postcode"),
        or_default("country_iso", fv.DEFAULT_COUNTRY).alias("country_code"),
        F.col("region_code"),
        F.coalesce(segment_code, F.lit(fv.DEFAULT_SEGMENT)).alias("customer_segment"),
        or_default("acq_channel_code", fv.DEFAULT_CHANNEL).alias("acquisition_channel"),
        F.col("created_date").alias("registration_date"),
        or_default("email_opt_in", fv.DEFAULT_OPT_IN).alias("is_opted_in_email"),
        or_default("sms_opt_in", fv.DEFAULT_OPT_IN).alias("is_opted_in_sms"),
        F.lit(run_date).alias("load_date"),
        F.lit(fv.PENDING).alias("etl_status"),
    ]


def profiles_of(customers: DataFrame, segments: DataFrame, run_date: dt.date) -> DataFrame:
    """Every customer as a staging row, with the primary segment still valid at the run date."""
    valid = segments.filter((F.col("is_primary") == "Y") & (F.col("valid_to") >= F.lit(run_date)))
    joined = customers.join(valid.select("cust_id", "segment_code"), "cust_id", "left")
    return joined.select(*profile_columns(F.col("segment_code"), run_date), F.col("last_modified_date"))


def extract_profiles(
    customers: DataFrame,
    segments: DataFrame,
    run_date: dt.date,
    segment: str = "ALL",
    region: str = "ALL",
    batch_size: int | None = None,
) -> DataFrame:
    """Active customers changed in the last week, newest first, up to the batch size (None: all of them)."""
    changed = customers.filter(
        (F.col("is_active") == "Y") & since_days("last_modified_date", run_date, fv.PROFILE_DAYS)
    )
    staged = profiles_of(only(changed, "region_code", region), segments, run_date)
    staged = only(staged, "customer_segment", segment)
    if batch_size is not None:
        staged = newest_days_rows(staged, batch_size, "last_modified_date", "customer_id")
    return staged.drop("last_modified_date")


def staged_ids(staged: DataFrame, run_date: dt.date) -> DataFrame:
    """Ids staged by the run, in a shuffle of their own.

    Adaptive execution splits the events of a hot customer only where both sides of the join come straight from a
    shuffle; without the hint the ids could arrive already grouped by an earlier join on the same key.
    """
    ids = staged.filter(F.col("load_date") == F.lit(run_date)).select(F.col("customer_id").alias("cust_id"))
    return ids.hint("rebalance")


def extract_events(events: DataFrame, campaigns: DataFrame, staged: DataFrame, run_date: dt.date) -> DataFrame:
    """Events of the last 90 days on known campaigns, for customers staged by this run."""
    recent = events.filter(within_days("event_dttm", run_date, fv.EVENT_DAYS))
    wanted = recent.join(staged_ids(staged, run_date), "cust_id", "left_semi")
    known = lookup_join(wanted, campaigns.select("camp_ref", "camp_name"), "camp_ref", "inner", spread_by="event_id")
    return known.select(
        "event_id",
        F.col("cust_id").alias("customer_id"),
        F.col("camp_ref").alias("campaign_id"),
        F.col("camp_name").alias("campaign_name"),
        F.col("event_type_cd").alias("event_type"),
        F.col("event_dttm").alias("event_date"),
        F.col("channel_cd").alias("channel"),
        "offer_code",
        F.coalesce("revenue_attrib", F.lit(0).cast("decimal(14,4)")).alias("revenue_attributed"),
        F.lit(run_date).alias("load_date"),
    )


def extract_interactions(interactions: DataFrame, staged: DataFrame, run_date: dt.date) -> DataFrame:
    """Interactions of the last 30 days, for customers staged by this run."""
    recent = interactions.filter(within_days("interaction_date", run_date, fv.INTERACTION_DAYS))
    return recent.join(staged_ids(staged, run_date), "cust_id", "left_semi").select(
        "interaction_id",
        F.col("cust_id").alias("customer_id"),
        F.col("interaction_type_cd").alias("interaction_type"),
        "interaction_date",
        F.col("channel_cd").alias("channel"),
        "agent_id",
        F.col("resolution_cd").alias("resolution_code"),
        F.col("csat_score").alias("satisfaction_score"),
        F.col("duration_mins").alias("duration_minutes"),
        F.lit(None).cast("string").alias("notes"),
        F.lit(run_date).alias("load_date"),
    )


def staging_summary(profiles: DataFrame, run_date: dt.date, label: str = "ALL") -> DataFrame:
    """Size of the pending day over all segments; ``label`` only names the run."""
    pending = profiles.filter((F.col("load_date") == F.lit(run_date)) & (F.col("etl_status") == fv.PENDING))
    return pending.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count(F.when(F.col("is_opted_in_email") == "Y", 1)).alias("email_opted_in"),
        F.countDistinct("region_code").alias("regions"),
    ).select(F.lit(label).alias("segment"), "total_customers", "email_opted_in", "regions")
