"""Customer scores in three variants, their inputs, and the churn split.

The variants share the churn ladder and differ in the rest:

* procedural: uncapped lifetime value score, conversion rate, interactions per day, short labels
* configured: capped lifetime value score, conversion rate, stepped interactions, long labels, batches
* graph: from staged profiles, stepped conversions, no propensity
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele import schemas
from clientele.functions import fixed_values as fv
from clientele.functions import ladders
from clientele.functions.predicates import only, since_days
from clientele.functions.selection import first_rows
from clientele.operators.dimension import current_dimension, full_name
from clientele.sources.tables import latest_sales

SCORE_COLUMNS = [name for name in schemas.FACT_CUSTOMER_SCORES.names if name != "score_key"]


def daily_counts(staged: DataFrame, moment: str, **counts: Column) -> DataFrame:
    """Counts per customer, day and load. A load stages whole days."""
    day = F.to_date(moment).alias("day")
    return staged.groupBy("customer_id", day, "load_date").agg(*[c.alias(name) for name, c in counts.items()])


def daily_events(events: DataFrame) -> DataFrame:
    """Staged events as counts per customer, day and load: what a load stores for the scores of later ones."""
    converted = ladders.count_if(F.col("event_type") == fv.CONVERTED)
    return daily_counts(events, "event_date", event_count=F.count(F.lit(1)), conversion_count=converted)


def daily_interactions(interactions: DataFrame) -> DataFrame:
    return daily_counts(interactions, "interaction_date", interaction_count=F.count(F.lit(1)))


def newest_counts(daily: DataFrame, run_date: dt.date, days: int, names: Sequence[str]) -> DataFrame:
    """Counts per customer since ``days`` before the run, each day taken from the newest load that holds it.

    Loads repeat days of older loads, and a load's window may be shorter than the one that is counted, so the choice is made
    for each customer and day. The few rows per customer are dealt by customer once, which serves both steps and the joins.
    """
    dealt = daily.filter(since_days("day", run_date, days)).repartition("customer_id")
    per_day = dealt.groupBy("customer_id", "day").agg(*[F.max_by(name, "load_date").alias(name) for name in names])
    return per_day.groupBy("customer_id").agg(*[F.sum(name).alias(name) for name in names])


def conversion_rates(
    events: DataFrame, run_date: dt.date, days: int = fv.EVENT_DAYS, counted: bool = False
) -> DataFrame:
    """Per customer: events, conversions and their ratio in the window. ``counted``: from stored daily counts."""
    daily = events if counted else daily_events(events.filter(since_days("event_date", run_date, days)))
    found = newest_counts(daily, run_date, days, ["event_count", "conversion_count"])
    rate = ladders.ratio(F.col("conversion_count"), F.col("event_count"), 4).cast(ladders.SCORE)
    return found.withColumn("conversion_rate", rate)


def interaction_counts(
    interactions: DataFrame, run_date: dt.date, days: int = fv.INTERACTION_DAYS, counted: bool = False
) -> DataFrame:
    """Per customer: interactions in the window, and their number per day of a 30-day month."""
    recent = interactions if counted else interactions.filter(since_days("interaction_date", run_date, days))
    daily = recent if counted else daily_interactions(recent)
    found = newest_counts(daily, run_date, days, ["interaction_count"])
    score = ladders.ratio(F.col("interaction_count"), F.lit(30), 4).cast(ladders.WIDE_SCORE)
    return found.withColumn("interact_score", score)


def campaign_rollup(events: DataFrame) -> DataFrame:
    """Per customer: conversions and campaign revenue."""
    return events.groupBy("customer_id").agg(
        ladders.count_if(F.col("event_type") == fv.CONVERTED).alias("campaign_conversions"),
        F.sum("revenue_attributed").cast("decimal(18,4)").alias("total_campaign_revenue"),
    )


def scored_base(
    dimension: DataFrame,
    sales: DataFrame,
    events: DataFrame,
    interactions: DataFrame,
    run_date: dt.date,
    camp_days: int = fv.EVENT_DAYS,
    inter_days: int = fv.INTERACTION_DAYS,
    counted: bool = False,
) -> DataFrame:
    """Current customers with spend, conversion and interaction figures.

    With ``counted``, events and interactions are stored daily counts instead of staged rows.

    Every input is reduced to one row per customer and hashed by customer before the three joins, which then need no
    further shuffle.
    """
    spend = latest_sales(sales, ["lifetime_value", "last_purchase_date"])
    return (
        current_dimension(dimension)
        .select("customer_id", "dim_crm_customer_key", "customer_segment", "region_code")
        .join(spend, "customer_id", "left")
        .join(conversion_rates(events, run_date, camp_days, counted), "customer_id", "left")
        .join(interaction_counts(interactions, run_date, inter_days, counted), "customer_id", "left")
    )


def zero_if_null(column: str, type_name: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0).cast(type_name))


def fact_row(
    run_date: dt.date,
    model_version: str,
    batch_id: int,
    clv: Column,
    churn: Column,
    propensity: Column,
    engagement: Column,
    label: Column,
) -> list[Column]:
    return [
        F.col("customer_id"),
        F.col("dim_crm_customer_key"),
        F.lit(run_date).alias("score_date"),
        clv.cast(ladders.CLV).alias("clv_score"),
        churn.alias("churn_risk_score"),
        propensity.cast(ladders.SCORE).alias("propensity_buy_score"),
        engagement.cast(ladders.WIDE_SCORE).alias("engagement_score"),
        F.col("customer_segment").alias("segment_code"),
        label.alias("segment_label"),
        F.lit(run_date).alias("batch_run_date"),
        F.lit(model_version).alias("model_version"),
        F.lit(batch_id).cast("bigint").alias("load_batch_id"),
    ]


def scores_procedural(
    dimension: DataFrame,
    sales: DataFrame,
    events: DataFrame,
    interactions: DataFrame,
    run_date: dt.date,
    segment: str = "ALL",
    model_version: str = fv.MODEL_VERSION,
    batch_id: int = fv.FIRST_BATCH,
    as_of: dt.date | None = None,
    counted: bool = False,
) -> DataFrame:
    """Scores of the current customers of a segment."""
    wanted = only(dimension, "customer_segment", segment)
    base = scored_base(wanted, sales, events, interactions, run_date, counted=counted)
    return base.select(
        *fact_row(
            run_date,
            model_version,
            batch_id,
            clv=ladders.clv_score(F.col("lifetime_value")),
            churn=ladders.churn_risk(F.col("last_purchase_date"), as_of or run_date),
            propensity=zero_if_null("conversion_rate", ladders.SCORE),
            engagement=zero_if_null("interact_score", ladders.WIDE_SCORE),
            label=ladders.label(F.col("customer_segment"), fv.SHORT_LABELS),
        )
    )


def scores_config(
    dimension: DataFrame,
    sales: DataFrame,
    events: DataFrame,
    interactions: DataFrame,
    run_date: dt.date,
    segment: str = "ALL",
    region: str = "ALL",
    model_version: str = fv.MODEL_VERSION,
    batch_id: int | None = None,
    batch_size: int | None = None,
    camp_days: int = fv.DEFAULT_CAMPAIGN_WINDOW,
    inter_days: int = fv.DEFAULT_INTERACTION_WINDOW,
    already: DataFrame | None = None,
    as_of: dt.date | None = None,
    counted: bool = False,
) -> DataFrame:
    """Scores with capped value and stepped engagement, only for customers that ``already`` does not hold.

    A batch is the lowest customer ids that are not scored yet, so each call with one takes the next batch.
    """
    wanted = only(only(dimension, "customer_segment", segment), "region_code", region)
    if already is not None:
        wanted = unscored(current_dimension(wanted), already, run_date, model_version)
    if batch_size is not None:
        wanted = first_rows(current_dimension(wanted), batch_size, "customer_id")
    base = scored_base(wanted, sales, events, interactions, run_date, camp_days, inter_days, counted)
    interactions_seen = zero_if_null("interaction_count", "bigint")
    return base.select(
        *fact_row(
            run_date,
            model_version,
            int(run_date.strftime("%Y%m%d")) if batch_id is None else batch_id,
            clv=ladders.clv_score(F.col("lifetime_value"), cap=fv.CLV_CAP),
            churn=ladders.churn_risk(F.col("last_purchase_date"), as_of or run_date),
            propensity=zero_if_null("conversion_rate", ladders.SCORE),
            engagement=ladders.above(interactions_seen, fv.INTERACTION_STEPS, "0.0"),
            label=ladders.label(F.col("customer_segment"), fv.LONG_LABELS),
        )
    )


def unscored(customers: DataFrame, scores: DataFrame, run_date: dt.date, model_version: str) -> DataFrame:
    """Customers with no score of this date, model and their present segment."""
    done = scores.filter(
        (F.col("score_date") == F.lit(run_date)) & (F.col("model_version") == model_version)
    ).select("customer_id", F.col("segment_code").alias("customer_segment"))
    return customers.join(done, ["customer_id", "customer_segment"], "left_anti")


def enrich_profiles(staged: DataFrame, spend: DataFrame, events: DataFrame) -> DataFrame:
    """Staged profiles with recent spend and the campaign rollup; missing figures become their defaults."""
    figures = latest_sales(spend, ["lifetime_value", "loyalty_tier", "last_purchase_date"])
    return (
        staged.select(
            "customer_id",
            "customer_code",
            full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
            "email",
            "region_code",
            "customer_segment",
            "acquisition_channel",
            "is_opted_in_email",
        )
        .join(figures, "customer_id", "left")
        .join(campaign_rollup(events), "customer_id", "left")
        .withColumns(
            {
                "lifetime_value": zero_if_null("lifetime_value", "decimal(14,2)"),
                "loyalty_tier": F.coalesce("loyalty_tier", F.lit(fv.DEFAULT_TIER)),
                "campaign_conversions": zero_if_null("campaign_conversions", "bigint"),
                "total_campaign_revenue": zero_if_null("total_campaign_revenue", "decimal(18,4)"),
            }
        )
    )


def customers_without_spend(staged: DataFrame, spend: DataFrame) -> DataFrame:
    """Staged profiles that have no recent retail row."""
    return staged.join(spend.select("customer_id"), "customer_id", "left_anti")


def scores_graph(enriched: DataFrame, run_date: dt.date) -> DataFrame:
    """Score fields added to enriched profiles."""
    last = F.col("last_purchase_date")
    return enriched.withColumns(
        {
            "days_since_purchase": F.when(last.isNull(), fv.NEVER_BOUGHT_DAYS).otherwise(
                ladders.days_since(last, run_date)
            ),
            "clv_score": ladders.clv_score(F.col("lifetime_value")),
            "churn_risk_score": ladders.churn_risk(last, run_date),
            "engagement_score": ladders.above(F.col("campaign_conversions"), fv.CONVERSION_STEPS, "0.0").cast(
                ladders.SCORE
            ),
            "segment_label": ladders.label(F.col("customer_segment"), fv.LONG_LABELS),
        }
    )


def churn_split(scored: DataFrame, limit: str = fv.CHURN_LIMIT) -> tuple[DataFrame, DataFrame]:
    """Standard customers (at or below the limit) and those at risk (above it)."""
    threshold = ladders.decimal_of(limit)
    risk = F.col("churn_risk_score")
    return scored.filter(risk <= threshold), scored.filter(risk > threshold)


def graph_facts(
    scored: DataFrame, dimension: DataFrame, run_date: dt.date, model_version: str, batch_id: int
) -> DataFrame:
    """Graph scores as fact rows, with the key of the current dimension row and no propensity."""
    keys = current_dimension(dimension).select("customer_id", "dim_crm_customer_key")
    return scored.join(keys, "customer_id", "left").select(
        *fact_row(
            run_date,
            model_version,
            batch_id,
            clv=F.col("clv_score"),
            churn=F.col("churn_risk_score"),
            propensity=F.lit(None),
            engagement=F.col("engagement_score"),
            label=F.col("segment_label"),
        )
    )
