"""Feature configuration of the scoring model, and the choice of its input table."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions import fixed_values as fv
from clientele.functions.predicates import ALL


@dataclasses.dataclass(frozen=True)
class Feature:
    """One weighted feature; ``expression`` is Spark SQL over the feature input columns."""

    name: str
    expression: str
    weight: float
    source_table: str | None = None
    window_days: int | None = None


# The features used when none are configured.
DEFAULT_FEATURES = (
    Feature("clv_raw", "coalesce(lifetime_value, 0)", 0.4, "DW_OWNER.STG_CUSTOMER_SALES", 365),
    Feature(
        "recency_days",
        "datediff(as_of, coalesce(last_purchase_date, date_sub(as_of, 999)))",
        0.3,
        "DW_OWNER.STG_CUSTOMER_SALES",
        90,
    ),
    Feature("camp_convs", "coalesce(conversion_count, 0)", 0.15, "STG_CAMPAIGN_EVENTS", 90),
    Feature("interactions", "coalesce(interaction_count, 0)", 0.15, "STG_CUSTOMER_INTERACTIONS", 30),
)


def active_features(config: DataFrame, model_version: str, segment: str) -> DataFrame:
    """Configuration rows in force for a model and a segment."""
    return config.filter(
        (F.col("model_version") == model_version)
        & F.col("target_segment").isin(segment, ALL)
        & (F.col("is_active") == "Y")
    )


def load_features(config: DataFrame, model_version: str, segment: str) -> list[Feature]:
    """Active features in execution order.

    They become columns of the plan, so they are read on the driver.
    """
    rows = (
        active_features(config, model_version, segment)
        .orderBy("execution_order", "feature_name")
        .collect()
    )
    return [
        Feature(
            row.feature_name,
            row.sql_expression,
            row.feature_weight,
            row.source_table,
            row.aggregation_window_days,
        )
        for row in rows
    ]


def widest_window(features: Sequence[Feature], topic: str, default: int) -> int:
    """The longest window among features whose source table names the topic."""
    windows = [
        f.window_days for f in features if f.window_days is not None and topic in (f.source_table or "").lower()
    ]
    return max(windows, default=default)


def campaign_window(features: Sequence[Feature]) -> int:
    return widest_window(features, "campaign", fv.DEFAULT_CAMPAIGN_WINDOW)


def interaction_window(features: Sequence[Feature]) -> int:
    return widest_window(features, "interaction", fv.DEFAULT_INTERACTION_WINDOW)


def score_source(spark: SparkSession, segment: str, schema: str | None = None) -> str:
    """The input table made for a segment if there is one, else the general view."""
    wanted = "SCORE_INPUT_" + segment.replace("-", "_").upper()
    qualified = f"{schema}.{wanted}" if schema else wanted
    return wanted if spark.catalog.tableExists(qualified) else "V_SCORE_INPUTS_GENERIC"
