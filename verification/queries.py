"""Every operator as a query over the given test tables.

Each query takes (spark, folder) and runs over whole tables. Decimals leave as doubles and lists as joined text, so
that any client compares them the same way; inside the library they keep their declared types.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType

from clientele.functions import fixed_values as fv
from clientele.operators import audit, dimension, extract, facts, features, lineage, scoring, segments
from clientele.sinks.merge import insert_if_absent, replace_slice, upsert
from clientele.sources import catalog, config, tables
from verification.source_tables import REPOSITORIES, RUN, SourceTables

Query = Callable[[SparkSession, str], DataFrame]

WEEK_BEFORE = RUN - dt.timedelta(days=7)
AUDIT_SPLIT = dt.datetime(2024, 1, 15, 12, 0, 0)
SCORE_KEY = ["customer_id", "score_date", "segment_code", "model_version"]


def comparable(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, ArrayType):
            column = F.array_join(column, ",").alias(field.name)
        columns.append(column)
    return df.select(*columns)


class Inputs(SourceTables):
    """Source tables, and the staged and scored tables later queries start from."""

    def profiles(self, **options) -> DataFrame:
        return extract.extract_profiles(self.src_customers, self.src_customer_segments, RUN, **options)

    @cached_property
    def staged(self) -> DataFrame:
        return self.profiles()

    @cached_property
    def events(self) -> DataFrame:
        return extract.extract_events(self.src_campaign_events, self.src_campaigns, self.staged, RUN)

    @cached_property
    def interactions(self) -> DataFrame:
        return extract.extract_interactions(self.src_interactions, self.staged, RUN)

    def staged_week_before(self) -> DataFrame:
        return extract.extract_profiles(self.src_customers, self.src_customer_segments, WEEK_BEFORE)

    def events_of_two_loads(self) -> DataFrame:
        before = self.staged_week_before()
        earlier = extract.extract_events(self.src_campaign_events, self.src_campaigns, before, WEEK_BEFORE)
        return earlier.unionByName(self.events)

    def interactions_of_two_loads(self) -> DataFrame:
        earlier = extract.extract_interactions(self.src_interactions, self.staged_week_before(), WEEK_BEFORE)
        return earlier.unionByName(self.interactions)

    def merged_dimension(self) -> DataFrame:
        return dimension.scd2_merge(self.dim_customer_crm, self.staged, RUN)

    def scores(self, variant: Callable[..., DataFrame], **options) -> DataFrame:
        dim = options.pop("dim", None)
        return variant(
            self.dim_customer_crm if dim is None else dim,
            self.stg_customer_sales,
            self.events,
            self.interactions,
            RUN,
            **options,
        )

    def procedural(self, **options) -> DataFrame:
        return self.scores(scoring.scores_procedural, **options)

    def configured(self, **options) -> DataFrame:
        return self.scores(scoring.scores_config, **options)

    def recent_sales(self) -> DataFrame:
        return tables.recent_spend(self.stg_customer_sales, RUN)

    def graph(self) -> DataFrame:
        staged = tables.staged_profiles(self.staged, RUN)
        events = tables.staged_events(self.events, RUN)
        return scoring.scores_graph(scoring.enrich_profiles(staged, self.recent_sales(), events), RUN)

    def segmented(self, dim: DataFrame | None = None, regional: DataFrame | None = None) -> DataFrame:
        dim = self.dim_customer_crm if dim is None else dim
        scores = tables.current_scores(self.configured(dim=dim), dim, RUN)
        return segments.segmented_customers(scores, tables.retail_spend(self.stg_customer_sales), regional)

    def regional_day(self) -> DataFrame:
        return tables.regional_summary(self.fact_regional_summary, RUN)

    def feature_scores(self, chosen: list[config.Feature]) -> DataFrame:
        base = features.feature_input(
            self.dim_customer_crm,
            self.stg_customer_sales,
            self.events,
            self.interactions,
            RUN,
            chosen or config.DEFAULT_FEATURES,
        )
        return features.score_features(base, chosen)

    def named_summary(self, scores: DataFrame, **options) -> DataFrame:
        return facts.segment_summary_named(
            scores, self.dim_customer_crm, self.fact_regional_summary, RUN, **options
        )

    def audit(self) -> DataFrame:
        return audit.fold_messages(self.audit_messages).drop("last_message")

    def mapped(self) -> DataFrame:
        return lineage.dependency_map(catalog.dependencies(self.dependency_edges))

    def links(self) -> DataFrame:
        return lineage.grant_links(catalog.cross_grants(self.grants), REPOSITORIES)


def summary_upsert(t: Inputs) -> DataFrame:
    """Last week's summary and an older one of this week, both of one segment, merged with today's of all."""
    older = t.named_summary(t.procedural(segment="VIP"))
    last_week = older.withColumn("summary_date", F.lit(RUN - dt.timedelta(days=7)))
    before = RUN - dt.timedelta(days=1)
    table = older.unionByName(last_week).withColumn("load_date", F.lit(before))
    changes = t.named_summary(t.configured()).withColumn("load_date", F.lit(RUN))
    return upsert(table, changes, facts.SUMMARY_KEYS, update=[*facts.SUMMARY_FIGURES, "load_date"])


def audit_in_two_batches(t: Inputs) -> DataFrame:
    """The audit table after a first batch of messages, then after the rest."""
    early = F.col("message_ts") < F.lit(AUDIT_SPLIT)
    table = audit.fold_messages(t.audit_messages.filter(early)).drop("last_message")
    return audit.audit_upsert(table, t.audit_messages.filter(~early))


def refreshed_slice(t: Inputs) -> DataFrame:
    """Scores with the VIP slice of the date and model replaced by another variant's."""
    vip = (
        (F.col("score_date") == F.lit(RUN))
        & (F.col("segment_code") == "VIP")
        & (F.col("model_version") == fv.MODEL_VERSION)
    )
    return replace_slice(t.procedural(), t.configured(segment="VIP"), vip)


def weekly_scores(t: Inputs) -> DataFrame:
    """The load from source to micro-segment: stage, merge the dimension, score, segment."""
    return segments.micro_segments(t.segmented(t.merged_dimension()))


def snapshot(t: Inputs) -> DataFrame:
    return lineage.lineage_snapshot(
        RUN,
        "WEEKLY",
        "2024-01-30T04:00:00",
        t.lineage_chains,
        t.links(),
        t.mapped(),
        catalog.execution_log(t.audit(), RUN),
        repositories=REPOSITORIES,
        page_size=200,
    )


DEFINITIONS: dict[str, Callable[[Inputs], DataFrame]] = {
    # campaign facts
    "campaign_performance": lambda t: facts.campaign_performance(t.events),
    "campaign_performance_day": lambda t: facts.campaign_performance(t.events, RUN),
    "campaign_performance_one": lambda t: facts.campaign_performance(t.events, campaign="CAMP07"),
    # extracts and filtered reads
    "extract_profiles": lambda t: t.staged,
    "extract_profiles_vip": lambda t: t.profiles(segment="VIP", region="EUROPE"),
    "extract_profiles_batch": lambda t: t.profiles(batch_size=500),
    "extract_events": lambda t: t.events,
    "extract_interactions": lambda t: t.interactions,
    "staging_summary": lambda t: extract.staging_summary(t.staged, RUN),
    "staged_profiles_retail": lambda t: tables.staged_profiles(t.staged, RUN, segment="RETAIL"),
    "recent_spend": lambda t: t.recent_sales(),
    "retail_spend": lambda t: tables.retail_spend(t.stg_customer_sales),
    "regional_summary_day": lambda t: t.regional_day(),
    "regional_revenue_30d": lambda t: tables.regional_revenue(t.fact_regional_summary, RUN),
    # dimension
    "scd2_closed": lambda t: dimension.scd2_closed(t.dim_customer_crm, t.staged, RUN),
    "scd2_inserted": lambda t: dimension.scd2_inserted(t.dim_customer_crm, t.staged, RUN),
    "scd2_merge": lambda t: t.merged_dimension(),
    "current_dimension": lambda t: dimension.current_dimension(t.merged_dimension()),
    "mark_loaded": lambda t: dimension.mark_loaded(t.staged, RUN, segment="RETAIL"),
    # scores
    "customer_conversion_rate": lambda t: scoring.conversion_rates(t.events, RUN),
    "customer_interactions": lambda t: scoring.interaction_counts(t.interactions, RUN),
    "conversions_two_loads": lambda t: scoring.conversion_rates(
        scoring.daily_events(t.events_of_two_loads()), RUN, days=180, counted=True
    ),
    "interactions_two_loads": lambda t: scoring.interaction_counts(
        scoring.daily_interactions(t.interactions_of_two_loads()), RUN, days=180, counted=True
    ),
    "campaign_rollup": lambda t: scoring.campaign_rollup(t.events),
    "scores_procedural": lambda t: t.procedural(batch_id=7),
    "scores_config": lambda t: t.configured(),
    "scores_config_batch": lambda t: t.configured(region="ASIA", batch_size=100),
    "scores_graph": lambda t: t.graph(),
    "scores_if_absent": lambda t: t.configured(already=t.procedural(segment="VIP")),
    "insert_if_absent": lambda t: insert_if_absent(t.procedural(segment="RETAIL"), t.configured(), SCORE_KEY),
    "score_features_default": lambda t: t.feature_scores([]),
    "score_features": lambda t: t.feature_scores(
        config.load_features(t.scoring_feature_config, "v3", "VIP")
    ),
    "customers_without_spend": lambda t: scoring.customers_without_spend(t.staged, t.recent_sales()),
    "churn_standard": lambda t: scoring.churn_split(t.graph())[0],
    "churn_at_risk": lambda t: scoring.churn_split(t.graph())[1],
    "graph_facts": lambda t: scoring.graph_facts(t.graph(), t.dim_customer_crm, RUN, "graph", 9),
    # summaries
    "segment_summary_replace": lambda t: facts.segment_summary(
        t.procedural(), t.dim_customer_crm, t.fact_regional_summary, RUN
    ),
    "segment_summary_once": lambda t: facts.segment_summary(
        t.procedural(), t.dim_customer_crm, t.fact_regional_summary, RUN, spend_rule="once"
    ),
    "segment_summary_named": lambda t: t.named_summary(t.configured(), segment="RETAIL"),
    "segment_summary_upsert": summary_upsert,
    "segment_rollup": lambda t: facts.segment_rollup(t.graph(), RUN),
    "replace_slice": refreshed_slice,
    "score_row_count": lambda t: facts.score_row_count(t.procedural(), RUN, "VIP"),
    "staged_row_count": lambda t: facts.staged_row_count(t.staged, RUN, "WHOLESALE"),
    # micro-segments
    "current_scores": lambda t: tables.current_scores(t.configured(), t.dim_customer_crm, RUN),
    "segmented_customers": lambda t: t.segmented(regional=t.regional_day()),
    "micro_segments": lambda t: segments.micro_segments(t.segmented()),
    "interventions": lambda t: segments.intervention_counts(t.segmented()),
    "region_distribution": lambda t: segments.region_distribution(t.segmented()),
    "segment_snapshot": lambda t: segments.segment_snapshot(t.segmented()),
    "weekly_scores": weekly_scores,
    # audit
    "audit_upsert": audit_in_two_batches,
    "audit_fold": lambda t: t.audit(),
    "prerequisite_status": lambda t: audit.prerequisite_status(t.audit(), t.asked_jobs),
    "sla_breaches": lambda t: audit.sla_breaches(t.audit()),
    "execution_log": lambda t: catalog.execution_log(t.audit(), RUN),
    # lineage
    "dependencies_narrow": lambda t: lineage.dependency_map(
        catalog.dependencies(t.dependency_edges, full_catalog=False)
    ),
    "dependency_map": lambda t: t.mapped(),
    "dependency_lists": lambda t: lineage.dependency_lists(t.mapped(), page_size=200),
    "grant_links": lambda t: t.links(),
    "chain_refs": lambda t: lineage.chain_refs(
        t.lineage_chains, lineage.dependency_lists(t.mapped(), page_size=200)
    ),
    "lineage_snapshot": snapshot,
}


def query(define: Callable[[Inputs], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(define(Inputs(spark, folder)))

    return run


def all_queries() -> dict[str, Query]:
    return {name: query(define) for name, define in DEFINITIONS.items()}
