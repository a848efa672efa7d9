"""Enrichment of staged profiles: graph scores, churn split, segment totals."""

from __future__ import annotations

from pyspark import StorageLevel

from clientele.functions import fixed_values as fv
from clientele.operators import facts, scoring
from clientele.params import RunParams
from clientele.plans.segment_load import first_free, write_scores
from clientele.sinks.files import replace_partition, write_at_risk, write_count
from clientele.sources import tables
from clientele.sources.store import Store


def run_enrichment(store: Store, p: RunParams, status: str | None = None, model: str | None = None) -> None:
    """Score staged profiles (of any status by default) and write scores, totals, at-risk file and row count.

    The scored frame has four readers, so it is kept for their duration; lost parts are computed again.
    """
    staged = tables.staged_profiles(store.profiles(p.run_date), p.run_date, p.segment, p.region, status)
    spend = tables.recent_spend(store.read("stg_customer_sales"), p.run_date)
    events = tables.staged_events(store.read("stg_campaign_events"), p.run_date)
    model = model or f"{p.model_version}-graph"
    scored = scoring.scores_graph(scoring.enrich_profiles(staged, spend, events), p.run_date)
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        path = store.path("fact_customer_scores")
        start = first_free(store.read("fact_customer_scores"), "score_key")
        rows = scoring.graph_facts(scored, store.standing("dim_customer_crm"), p.run_date, model, p.batch_number)
        write_scores(store, rows, p.run_date, p.segment, model, start, path)
        totals = facts.segment_rollup(scored, p.run_date)
        place = {"summary_date": p.run_date}
        if p.segment == "ALL":
            replace_partition(totals, store.path("segment_rollup"), place, partition_by=["segment_code"])
        else:
            replace_partition(totals, store.path("segment_rollup"), {**place, "segment_code": p.segment})
        _, at_risk = scoring.churn_split(scored, fv.CHURN_LIMIT)
        write_at_risk(at_risk, store.path("at_risk"), p.run_date, p.segment)
        write_count(scored, store.path("scoring_audit"), p.run_date)
    finally:
        scored.unpersist()
