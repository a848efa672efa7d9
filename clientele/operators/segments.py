"""Micro-segments, interventions, and their distribution over regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele import schemas
from clientele.functions import fixed_values as fv
from clientele.functions import ladders
from clientele.functions.joins import lookup_join

NO_SPEND = "decimal(14,2)"


def composite_score() -> Column:
    """Weighted score, exact in decimal; a missing score makes it null."""
    weight = ladders.decimal_of
    one = ladders.decimal_of("1")
    spend = spend_or_zero() * weight(fv.SPEND_SCALE)
    return (
        F.col("clv_score") * weight(fv.WEIGHT_CLV)
        + (one - F.col("churn_risk_score")) * weight(fv.WEIGHT_RETENTION)
        + F.col("engagement_score") * weight(fv.WEIGHT_ENGAGEMENT)
        + F.col("propensity_buy_score") * weight(fv.WEIGHT_PROPENSITY)
        + F.least(spend, one) * weight(fv.WEIGHT_SPEND)
    ).cast("decimal(22,8)")


def micro_segment(composite: Column) -> Column:
    result = None
    for lowest, name in fv.MICRO_SEGMENTS:
        reached = composite >= ladders.decimal_of(lowest)
        result = F.when(reached, name) if result is None else result.when(reached, name)
    return result.otherwise(fv.LOWEST_MICRO_SEGMENT)


def intervention(composite: Column) -> Column:
    """The first rule that holds; a test on a missing score does not hold."""
    churn = F.col("churn_risk_score")
    at = ladders.decimal_of
    return (
        F.when((churn > at("0.7")) & (composite >= at("0.4")), fv.WINBACK)
        .when((churn > at("0.5")) & (F.col("engagement_score") < at("0.3")), fv.REENGAGE)
        .when((F.col("clv_score") > at("7")) & (F.col("is_opted_in_email") == "Y"), fv.UPGRADE)
        .otherwise(fv.NO_ACTION)
    )


def segmented_customers(scores: DataFrame, retail: DataFrame, regional: DataFrame | None = None) -> DataFrame:
    """Scores with spend, composite score, micro-segment and intervention, and regional figures where given.

    ``scores`` carries region and opt-in, ``retail`` one row per customer, ``regional`` one row per region. No
    published table uses the regional figures, so the jobs leave them out and save a shuffle of every customer.
    """
    spend = retail.select("customer_id", "lifetime_value", "loyalty_tier", "last_purchase_date")
    enriched = scores.join(spend, "customer_id", "left")
    if regional is not None:
        regions = regional.select("region_code", "total_revenue", "avg_basket_size")
        enriched = lookup_join(enriched, regions, "region_code", "left", spread_by="customer_id")
    return classify(enriched)


def classify(enriched: DataFrame) -> DataFrame:
    return (
        enriched.withColumn("composite_score", composite_score())
        .withColumn("micro_segment", micro_segment(F.col("composite_score")))
        .withColumn("intervention_recommended", intervention(F.col("composite_score")))
    )


def micro_segments(segmented: DataFrame) -> DataFrame:
    """The published columns of segmented customers."""
    return segmented.withColumn("composite_score", F.col("composite_score").cast("double")).select(
        *schemas.CRM_MICRO_SEGMENTS.names
    )


def intervention_counts(segmented: DataFrame) -> DataFrame:
    return segmented.groupBy("micro_segment", "intervention_recommended").agg(
        F.count(F.lit(1)).alias("customer_count")
    )


def spend_or_zero() -> Column:
    return F.coalesce(F.col("lifetime_value"), F.lit(0).cast(NO_SPEND))


def region_distribution(segmented: DataFrame) -> DataFrame:
    """Customers by region, micro-segment and segment, with each group's share of its region in percent.

    The share is taken over the finished groups: a handful of rows per region, whatever the number of customers.
    """
    of_region = Window.partitionBy("region_code")
    return (
        segmented.groupBy("region_code", "micro_segment", "segment_code")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            ladders.plain_mean(F.col("clv_score")).alias("avg_clv"),
            ladders.plain_mean(F.col("churn_risk_score")).alias("avg_churn_risk"),
            ladders.plain_mean(F.col("composite_score")).alias("avg_composite_score"),
            ladders.count_if(F.col("is_opted_in_email") == "Y").alias("email_opted_in"),
            ladders.plain_mean(spend_or_zero()).alias("avg_retail_lifetime_value"),
        )
        .withColumn(
            "pct_of_region",
            F.col("customer_count").cast("double") / F.sum("customer_count").over(of_region).cast("double") * 100,
        )
    )


def segment_snapshot(segmented: DataFrame) -> DataFrame:
    """Weekly figures by segment and region."""
    high_value = F.col("clv_score") > ladders.decimal_of(fv.HIGH_VALUE_CLV)
    at_risk = F.col("churn_risk_score") > ladders.decimal_of(fv.CHURN_LIMIT)
    return segmented.groupBy("segment_code", "region_code").agg(
        F.count(F.lit(1)).alias("customer_count"),
        ladders.plain_mean(F.col("clv_score")).alias("avg_clv_score"),
        ladders.plain_mean(F.col("churn_risk_score")).alias("avg_churn_risk"),
        ladders.count_if(high_value).alias("high_value_count"),
        ladders.count_if(at_risk).alias("at_risk_count"),
        ladders.plain_mean(spend_or_zero()).alias("avg_retail_spend"),
    )
