"""Where the tables of the jobs live."""

from __future__ import annotations

import dataclasses

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele import schemas
from clientele.operators.audit import AUDIT_KEY
from clientele.sinks import versions
from clientele.sinks.versions import Version, read_newest
from clientele.sources.tables import read_if_present

# Source and shared tables, written by others.
INPUTS = {
    "src_customers": schemas.SRC_CUSTOMERS,
    "src_customer_segments": schemas.SRC_CUSTOMER_SEGMENTS,
    "src_campaign_events": schemas.SRC_CAMPAIGN_EVENTS,
    "src_campaigns": schemas.SRC_CAMPAIGNS,
    "src_interactions": schemas.SRC_INTERACTIONS,
    "stg_customer_sales": schemas.STG_CUSTOMER_SALES,
    "fact_regional_summary": schemas.FACT_REGIONAL_SUMMARY,
    "scoring_feature_config": schemas.SCORING_FEATURE_CONFIG,
    "dependency_edges": schemas.DEPENDENCY_EDGES,
    "grants": schemas.GRANTS,
    "lineage_chains": schemas.LINEAGE_CHAINS,
}
# Tables replaced by whole partitions.
PARTITIONED = {
    "stg_campaign_events": schemas.STG_CAMPAIGN_EVENTS,
    "stg_customer_interactions": schemas.STG_CUSTOMER_INTERACTIONS,
    "daily_events": schemas.DAILY_EVENTS,
    "daily_interactions": schemas.DAILY_INTERACTIONS,
    "fact_customer_scores": schemas.FACT_CUSTOMER_SCORES,
    "fact_campaign_performance": schemas.FACT_CAMPAIGN_PERFORMANCE,
}
# Tables rewritten from their own content.
VERSIONED = {
    "fact_customer_segment_summary": schemas.FACT_CUSTOMER_SEGMENT_SUMMARY,
}
# Tables of which a load rewrites the buckets that it touches.
BUCKETED = {
    "etl_job_audit": (schemas.ETL_JOB_AUDIT, AUDIT_KEY),
    "dim_customer_crm": (schemas.DIM_CUSTOMER_CRM, ["customer_id"]),
}


@dataclasses.dataclass(frozen=True)
class Store:
    """Tables under one root folder, shared by all executors."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def version(self, name: str) -> Version:
        return versions.newest(self.spark, self.path(name))

    def standing(self, name: str, version: Version | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The rows of a bucketed table that are not closed, of all its buckets or of some."""
        version = version or self.version(name)
        return versions.read_standing(self.spark, self.path(name), BUCKETED[name][0], version, only)

    def write_buckets(self, name: str, rows: DataFrame, based_on: Version, *more, **options) -> Version:
        return versions.write_buckets(self.spark, rows, self.path(name), BUCKETED[name][1], based_on, *more, **options)

    def read(self, name: str) -> DataFrame:
        if name in BUCKETED:
            return self.standing(name)
        if name in VERSIONED:
            return read_newest(self.spark, self.path(name), VERSIONED[name])
        return read_if_present(self.spark, self.path(name), {**INPUTS, **PARTITIONED}[name])

    def profiles_path(self, run_date) -> str:
        """Staged profiles are kept per load date, so that no run touches another day."""
        return f"{self.path('stg_customer_profile')}/{run_date}"

    def profiles(self, run_date, version: Version | None = None) -> DataFrame:
        return read_newest(self.spark, self.profiles_path(run_date), schemas.STG_CUSTOMER_PROFILE, version)

    def dimension(self, version: Version | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """Current and closed rows, of all customers or of those in some buckets."""
        name = "dim_customer_crm"
        version = version or self.version(name)
        closed = versions.read_closed(self.spark, self.path(name), BUCKETED[name][0], version, only)
        return self.standing(name, version, only).unionByName(closed)


def not_current() -> Column:
    return ~F.col("is_current").eqNullSafe(F.lit("Y"))
