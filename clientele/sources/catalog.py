"""Reads from catalog extracts: object dependencies, grants, job audit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions import fixed_values as fv


def dependencies(
    edges: DataFrame, schemas: Sequence[str] = fv.TRACED_SCHEMAS, full_catalog: bool = True
) -> DataFrame:
    """Edges from code objects to tables inside the schemas.

    The narrow catalog (``full_catalog=False``) is filtered by owner and referenced type only.
    """
    kept = edges.filter(F.col("object_owner").isin(*schemas) & F.col("ref_type").isin(*fv.REFERENCED_TYPES))
    if full_catalog:
        kept = kept.filter(F.col("ref_owner").isin(*schemas) & F.col("object_type").isin(*fv.DEPENDENT_TYPES))
    return kept


def cross_grants(grants: DataFrame, schemas: Sequence[str] = fv.TRACED_SCHEMAS) -> DataFrame:
    """Data grants from one of the schemas to another."""
    return grants.filter(
        F.col("source_schema").isin(*schemas)
        & F.col("target_schema").isin(*schemas)
        & (F.col("source_schema") != F.col("target_schema"))
        & F.col("privilege").isin(*fv.TRACKED_PRIVILEGES)
    )


def execution_log(audit: DataFrame, run_date: dt.date) -> DataFrame:
    """Audit rows of one date in order of creation."""
    return audit.filter(F.col("run_date") == F.lit(run_date)).orderBy("created_date", "workflow_name", "job_name")
