"""Config-driven feature columns and their weighted composite."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions import fixed_values as fv
from clientele.operators.scoring import scored_base
from clientele.sources.config import DEFAULT_FEATURES, Feature, campaign_window, interaction_window


def feature_input(
    dimension: DataFrame,
    sales: DataFrame,
    events: DataFrame,
    interactions: DataFrame,
    run_date: dt.date,
    features: Sequence[Feature],
    as_of: dt.date | None = None,
) -> DataFrame:
    """The columns feature expressions may use, over the windows the features ask for."""
    base = scored_base(
        dimension, sales, events, interactions, run_date, campaign_window(features), interaction_window(features)
    )
    return base.withColumn("as_of", F.lit(as_of or run_date))


def contribution(feature: Feature) -> Column:
    value = F.expr(feature.expression).cast("double")
    capped = F.least(value / F.lit(fv.FEATURE_SCALE), F.lit(1.0))
    return F.lit(float(feature.weight)) * F.when(value.isNull(), F.lit(0.0)).otherwise(capped)


def score_features(inputs: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """One ``feat_`` column per feature and the weighted composite; no features means the default four.

    An expression that names an unknown column fails when the frame is analysed, before anything runs.
    """
    chosen = list(features) or list(DEFAULT_FEATURES)
    return inputs.select(
        "customer_id",
        "dim_crm_customer_key",
        *[F.expr(f.expression).cast("double").alias(f"feat_{f.name}") for f in chosen],
        reduce(add, [contribution(f) for f in chosen]).alias("composite_score"),
    )
