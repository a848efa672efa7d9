"""Micro-segments of the scored customers, their regional distribution and the weekly snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel

from clientele.operators import segments
from clientele.sinks.files import overwrite, replace_partition
from clientele.sources import tables
from clientele.sources.store import Store


def run_segmentation(store: Store, run_date: dt.date, model_version: str | None = None) -> None:
    """Write the three tables made from segmented customers; micro-segments and snapshot keep one slice per run."""
    scores = tables.current_scores(
        store.read("fact_customer_scores"), store.standing("dim_customer_crm"), run_date, model_version
    )
    retail = tables.retail_spend(store.read("stg_customer_sales"))
    segmented = segments.segmented_customers(scores, retail).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        place = {"run_date": run_date}
        replace_partition(segments.micro_segments(segmented), store.path("crm_micro_segments"), place)
        overwrite(segments.region_distribution(segmented), store.path("crm_region_segment_dist"))
        replace_partition(segments.segment_snapshot(segmented), store.path("crm_segment_weekly_snapshot"), place)
    finally:
        segmented.unpersist()
