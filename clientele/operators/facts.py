"""Aggregated facts: campaign performance, segment summaries, row counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions import fixed_values as fv
from clientele.functions import ladders
from clientele.functions.predicates import only
from clientele.operators.dimension import current_dimension
from clientele.sources.tables import regional_summary

MONEY = "decimal(18,4)"
SUMMARY_KEYS = ["segment_code", "region_code", "summary_date"]
SUMMARY_FIGURES = [
    "customer_count",
    "avg_clv_score",
    "avg_churn_risk",
    "high_value_count",
    "at_risk_count",
    "total_retail_spend",
]


def campaign_performance(events: DataFrame, run_date: dt.date | None = None, campaign: str = "ALL") -> DataFrame:
    """Counts, revenue and rates by campaign and day; one day, or every day where no date is given."""
    dated = events.withColumn("performance_date", F.to_date("event_date"))
    if run_date is not None:
        next_day = run_date + dt.timedelta(days=1)
        dated = dated.filter((F.col("event_date") >= F.lit(run_date)) & (F.col("event_date") < F.lit(next_day)))
    counted = (
        only(dated, "campaign_id", campaign)
        .groupBy("campaign_id", "performance_date")
        .agg(
            *[
                ladders.count_if(F.col("event_type") == kind).alias(f"total_{kind.lower()}")
                for kind in (fv.SENT, fv.OPENED, fv.CLICKED, fv.CONVERTED, fv.UNSUBSCRIBED)
            ],
            F.sum("revenue_attributed").cast(MONEY).alias("revenue_attributed"),
        )
    )

    def rate(part: str, whole: str) -> Column:
        return ladders.ratio(F.col(part), F.col(whole), 6).cast("decimal(14,6)")

    return counted.withColumns(
        {
            "open_rate": rate("total_opened", "total_sent"),
            "click_rate": rate("total_clicked", "total_opened"),
            "conversion_rate": rate("total_converted", "total_sent"),
        }
    )


def segment_figures(
    scores: DataFrame,
    dimension: DataFrame,
    regional: DataFrame,
    run_date: dt.date,
    segment: str,
    region: str,
    shown_region: Column,
    spend_rule: str,
) -> DataFrame:
    """Figures by segment and ``shown_region``, with the region's revenue.

    Customers are first reduced to one row per segment and region; revenue then joins those few rows instead of
    every customer. Under ``per_customer`` the revenue counts once for each score row of the region, under ``once``
    a single time.
    """
    if spend_rule not in ("per_customer", "once"):
        raise ValueError(f"unknown spend rule {spend_rule!r}")
    high_value = F.col("clv_score") > ladders.decimal_of(fv.HIGH_VALUE_CLV)
    at_risk = F.col("churn_risk_score") > ladders.decimal_of(fv.CHURN_LIMIT)
    of_date = only(scores.filter(F.col("score_date") == F.lit(run_date)), "segment_code", segment)
    people = only(current_dimension(dimension).select("customer_id", "region_code"), "region_code", region)
    per_customer = (
        of_date.select("customer_id", "segment_code", "clv_score", "churn_risk_score")
        .join(people, "customer_id", "inner")
        .groupBy("customer_id", "segment_code", "region_code")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("clv_score").alias("clv_sum"),
            F.count("clv_score").alias("clv_rows"),
            F.sum("churn_risk_score").alias("churn_sum"),
            F.count("churn_risk_score").alias("churn_rows"),
            ladders.count_if(high_value).alias("high_value"),
            ladders.count_if(at_risk).alias("at_risk"),
        )
    )
    by_region = per_customer.groupBy("segment_code", "region_code").agg(
        F.count(F.lit(1)).alias("customers"),
        *[
            F.sum(c).alias(c)
            for c in ("rows", "clv_sum", "clv_rows", "churn_sum", "churn_rows", "high_value", "at_risk")
        ],
    )
    revenue = (
        regional_summary(regional, run_date).groupBy("region_code").agg(F.sum("total_revenue").alias("revenue"))
    )
    times = F.col("rows") if spend_rule == "per_customer" else F.lit(1)
    spend = F.sum(F.col("revenue") * times.cast("decimal(12,0)"))

    def mean(total: str, rows: str, places: int, type_name: str) -> Column:
        whole = F.nullif(F.sum(rows).cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
        return F.round(F.sum(total).cast("decimal(28,4)") / whole, places).cast(type_name)

    return (
        by_region.join(revenue, "region_code", "left")
        .withColumn("shown_region", shown_region)
        .groupBy("segment_code", F.col("shown_region").alias("region_code"))
        .agg(
            F.sum("customers").alias("customer_count"),
            mean("clv_sum", "clv_rows", 4, ladders.CLV).alias("avg_clv_score"),
            mean("churn_sum", "churn_rows", 6, ladders.RATE).alias("avg_churn_risk"),
            F.sum("high_value").alias("high_value_count"),
            F.sum("at_risk").alias("at_risk_count"),
            F.coalesce(spend, F.lit(0)).cast("decimal(28,4)").alias("total_retail_spend"),
        )
        .withColumn("summary_date", F.lit(run_date))
        .select(*SUMMARY_KEYS, *SUMMARY_FIGURES)
    )


def segment_summary(
    scores: DataFrame,
    dimension: DataFrame,
    regional: DataFrame,
    run_date: dt.date,
    region: str = "ALL",
    spend_rule: str = "per_customer",
) -> DataFrame:
    """By segment and region as it is; customers without a region form their own group."""
    return segment_figures(
        scores, dimension, regional, run_date, "ALL", region, F.col("region_code"), spend_rule
    )


def segment_summary_named(
    scores: DataFrame,
    dimension: DataFrame,
    regional: DataFrame,
    run_date: dt.date,
    segment: str = "ALL",
    region: str = "ALL",
    spend_rule: str = "per_customer",
) -> DataFrame:
    """By segment and region, a missing region shown as UNKNOWN, so that every row has a full merge key."""
    named = F.coalesce("region_code", F.lit(fv.DEFAULT_REGION))
    return segment_figures(scores, dimension, regional, run_date, segment, region, named, spend_rule)


def segment_rollup(scored: DataFrame, run_date: dt.date) -> DataFrame:
    """Segment and region totals of graph scores; spend is the customers' own lifetime value."""
    high_value = F.col("clv_score") > ladders.decimal_of(fv.HIGH_VALUE_CLV)
    at_risk = F.col("churn_risk_score") > ladders.decimal_of(fv.CHURN_LIMIT)
    return (
        scored.groupBy(F.col("customer_segment").alias("segment_code"), "region_code")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            ladders.plain_mean(F.col("clv_score")).alias("avg_clv_score"),
            ladders.plain_mean(F.col("churn_risk_score")).alias("avg_churn_risk"),
            ladders.count_if(high_value).alias("high_value_count"),
            ladders.count_if(at_risk).alias("at_risk_count"),
            ladders.count_if(F.col("is_opted_in_email") == "Y").alias("opted_in_email_count"),
            F.sum("lifetime_value").cast("decimal(28,4)").alias("total_retail_spend"),
        )
        .withColumn("summary_date", F.lit(run_date))
    )


def score_row_count(scores: DataFrame, run_date: dt.date, segment: str = "ALL") -> DataFrame:
    """Number of scores of a date and segment, as one row."""
    of_date = only(scores.filter(F.col("score_date") == F.lit(run_date)), "segment_code", segment)
    return of_date.agg(F.count(F.lit(1)).alias("row_count"))


def staged_row_count(profiles: DataFrame, run_date: dt.date, segment: str = "ALL") -> DataFrame:
    """Number of pending profiles of a date and segment, as one row."""
    pending = profiles.filter((F.col("load_date") == F.lit(run_date)) & (F.col("etl_status") == fv.PENDING))
    return only(pending, "customer_segment", segment).agg(F.count(F.lit(1)).alias("row_count"))
