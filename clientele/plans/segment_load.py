"""The load of one segment, or of all: extract, dimension, scores, facts, audit."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clientele import schemas
from clientele.functions import fixed_values as fv
from clientele.functions.keys import with_sequence
from clientele.operators import audit, dimension, extract, facts, scoring
from clientele.operators.audit import AUDIT_KEY
from clientele.params import RunParams
from clientele.sinks.files import append, replace_partition
from clientele.sinks.merge import replace_slice, upsert
from clientele.sinks.versions import newest, read_newest, retried, touched_buckets, write_version
from clientele.sources import config, tables
from clientele.sources.store import Store, not_current

log = logging.getLogger(__name__)

SCORE_SLICES = ("score_date", "model_version", "segment_code")


def first_free(table: DataFrame, key: str) -> int:
    """The first free key, read before the write that uses it replaces part of the table."""
    return table.agg(F.coalesce(F.max(key) + 1, F.lit(fv.FIRST_KEY))).first()[0]


def log_status(store: Store, p: RunParams, status: str, rows: int, at: dt.datetime) -> None:
    message = store.spark.createDataFrame(
        [(p.workflow, p.job, p.run_date, status, rows, at)], schemas.AUDIT_MESSAGES
    )
    name = "etl_job_audit"

    def change() -> None:
        version = store.version(name)
        touched = touched_buckets(message, AUDIT_KEY, version)
        changed = audit.audit_upsert(store.standing(name, version, touched), message)
        store.write_buckets(name, changed, version, touched)

    retried(change)


def stage(store: Store, p: RunParams) -> None:
    """Extract profiles, then the events and interactions of everyone staged on the date."""
    fresh = extract.extract_profiles(
        store.read("src_customers"),
        store.read("src_customer_segments"),
        p.run_date,
        p.segment,
        p.region,
        p.batch,
    )
    pending = F.col("etl_status") == fv.PENDING
    if p.segment != "ALL":
        pending = pending & (F.col("customer_segment") == p.segment)
    change_profiles(store, p, lambda day: replace_slice(day, fresh, pending))

    staged = store.profiles(p.run_date)
    events = extract.extract_events(
        store.read("src_campaign_events"), store.read("src_campaigns"), staged, p.run_date
    )
    replace_partition(events, store.path("stg_campaign_events"), {"load_date": p.run_date})
    interactions = extract.extract_interactions(store.read("src_interactions"), staged, p.run_date)
    replace_partition(interactions, store.path("stg_customer_interactions"), {"load_date": p.run_date})
    store_daily_counts(store, p.run_date)


def store_daily_counts(store: Store, run_date: dt.date) -> None:
    """Count the load's events and interactions by customer and day, once, for all scores that count these days."""
    for staged, daily, count in (
        ("stg_campaign_events", "daily_events", scoring.daily_events),
        ("stg_customer_interactions", "daily_interactions", scoring.daily_interactions),
    ):
        rows = store.read(staged).filter(F.col("load_date") == F.lit(run_date))
        replace_partition(count(rows), store.path(daily), {"load_date": run_date})


def change_profiles(store: Store, p: RunParams, change: Callable[[DataFrame], DataFrame]) -> None:
    """Write the staged profiles of the day as ``change`` makes them from the newest version."""
    path = store.profiles_path(p.run_date)

    def write() -> None:
        version = newest(store.spark, path)
        write_version(store.spark, change(store.profiles(p.run_date, version)), path, based_on=version)

    retried(write)


def change_summary(store: Store, change: Callable[[DataFrame], DataFrame]) -> None:
    path = store.path("fact_customer_segment_summary")

    def write() -> None:
        version = newest(store.spark, path)
        table = read_newest(store.spark, path, schemas.FACT_CUSTOMER_SEGMENT_SUMMARY, version)
        write_version(store.spark, change(table), path, based_on=version)

    retried(write)


def load_dimension(store: Store, p: RunParams) -> int:
    """Merge the pending rows into the dimension and mark them loaded; the number of rows opened and closed."""
    scope = tables.staged_profiles(store.profiles(p.run_date), p.run_date, p.segment, p.region)
    rows = retried(lambda: merge_dimension(store, scope, p.run_date))
    mark_loaded(store, p)
    return rows


def merge_dimension(store: Store, scope: DataFrame, run_date: dt.date) -> int:
    """Merge staged rows into the buckets of the dimension that hold their customers; the number of rows opened and closed.

    Neither current rows nor history of other buckets are read. The first free key is kept with the version, and rows are
    counted while they are written.
    """
    name, key = "dim_customer_crm", "dim_crm_customer_key"
    version = store.version(name)
    start = version.next_key
    if start is None:
        start = first_free(store.dimension(version), key)
    touched = touched_buckets(scope, ["customer_id"], version)
    if not touched:
        return 0
    step = dimension.scd2_step(store.dimension(version, touched), scope, run_date, start)
    counts = Observation()
    observed = step.observe(
        counts,
        F.count(F.when(F.col(key) >= start, 1)).alias("opened"),
        F.count(F.when(not_current(), 1)).alias("closed"),
    )
    store.write_buckets(
        name, observed, version, touched, closed=not_current(), next_key=lambda: start + counts.get["opened"]
    )
    return counts.get["opened"] + counts.get["closed"]


def mark_loaded(store: Store, p: RunParams) -> None:
    """Turn the pending rows of the run to loaded; a customer loaded before on the day keeps the newer row only."""

    def marked(day: DataFrame) -> DataFrame:
        arriving = tables.staged_profiles(day, p.run_date, p.segment, p.region).select(
            "customer_id", F.lit(fv.LOADED).alias("etl_status")
        )
        superseded = day.join(arriving, ["customer_id", "etl_status"], "left_anti").select(*day.columns)
        return dimension.mark_loaded(superseded, p.run_date, p.segment, p.region)

    change_profiles(store, p, marked)


def staged_since(store: Store, name: str, run_date: dt.date, days: int) -> DataFrame:
    """Rows staged by this run and the earlier ones whose window can still matter; partitions before are not read."""
    return store.read(name).filter(F.col("load_date").between(run_date - dt.timedelta(days=days), run_date))


def score_inputs(
    store: Store, p: RunParams, camp_days: int = fv.EVENT_DAYS, inter_days: int = fv.INTERACTION_DAYS
) -> tuple[DataFrame, ...]:
    return (
        store.standing("dim_customer_crm"),
        store.read("stg_customer_sales"),
        staged_since(store, "daily_events", p.run_date, camp_days),
        staged_since(store, "daily_interactions", p.run_date, inter_days),
    )


def load_scores(store: Store, p: RunParams) -> None:
    """Replace the scores of the date, model and segment."""
    path = store.path("fact_customer_scores")
    start = first_free(store.read("fact_customer_scores"), "score_key")
    scores = scoring.scores_procedural(
        *score_inputs(store, p), p.run_date, p.segment, p.model_version, p.batch_number, p.as_of, True
    )
    write_scores(store, scores, p.run_date, p.segment, p.model_version, start, path)


def write_scores(
    store: Store, scores: DataFrame, run_date: dt.date, segment: str, model: str, start: int, path: str
) -> None:
    keyed = with_sequence(scores, "score_key", start, ["customer_id"]).select(*schemas.FACT_CUSTOMER_SCORES.names)
    place = {"score_date": run_date, "model_version": model}
    if segment == "ALL":
        replace_partition(keyed, path, place, partition_by=["segment_code"])
    else:
        replace_partition(keyed, path, {**place, "segment_code": segment})


def load_campaigns(store: Store, p: RunParams) -> None:
    """Replace the campaign figures of the run date, or those of one campaign."""
    path = store.path("fact_campaign_performance")
    start = first_free(store.read("fact_campaign_performance"), "perf_key")
    events = tables.staged_events(store.read("stg_campaign_events"), p.run_date)
    figures = facts.campaign_performance(events, p.run_date, p.campaign)
    keyed = with_sequence(figures, "perf_key", start, ["campaign_id"]).withColumns(
        {"dim_campaign_key": F.lit(None).cast("bigint"), "load_date": F.lit(p.run_date)}
    )
    rows = keyed.select(*schemas.FACT_CAMPAIGN_PERFORMANCE.names)
    day = {"performance_date": p.run_date}
    if p.campaign == "ALL":
        replace_partition(rows, path, day, partition_by=["campaign_id"])
    else:
        replace_partition(rows, path, {**day, "campaign_id": p.campaign})


def summary_rows(figures: DataFrame, start: int, run_date: dt.date) -> DataFrame:
    keyed = with_sequence(figures, "segment_summary_key", start, facts.SUMMARY_KEYS)
    return keyed.withColumns(
        {"total_campaign_spend": F.lit(None).cast("decimal(14,4)"), "load_date": F.lit(run_date)}
    ).select(*schemas.FACT_CUSTOMER_SEGMENT_SUMMARY.names)


def scores_of(store: Store, model: str) -> DataFrame:
    return store.read("fact_customer_scores").filter(F.col("model_version") == model)


def load_summary(store: Store, p: RunParams) -> None:
    """Replace the summary of the date and region."""
    figures = facts.segment_summary(
        scores_of(store, p.model_version),
        store.standing("dim_customer_crm"),
        store.read("fact_regional_summary"),
        p.run_date,
        p.region,
        p.spend_rule,
    )
    replaced = F.col("summary_date") == F.lit(p.run_date)
    if p.region != "ALL":
        replaced = replaced & (F.col("region_code") == p.region)

    def change(table: DataFrame) -> DataFrame:
        return replace_slice(table, summary_rows(figures, first_free(table, "segment_summary_key"), p.run_date), replaced)

    change_summary(store, change)


def add_configured_scores(store: Store, p: RunParams) -> None:
    """Score the customers that the configured model has not scored yet on the date."""
    model = p.config_model_version
    features = config.load_features(store.read("scoring_feature_config"), model, p.segment)
    windows = config.campaign_window(features), config.interaction_window(features)
    already = store.read("fact_customer_scores")
    scores = scoring.scores_config(
        *score_inputs(store, p, *windows),
        p.run_date,
        p.segment,
        p.region,
        model,
        p.batch_number,
        p.batch,
        *windows,
        already,
        p.as_of,
        counted=True,
    )
    keyed = with_sequence(scores, "score_key", first_free(already, "score_key"), ["customer_id"])
    rows = keyed.select(*schemas.FACT_CUSTOMER_SCORES.names)  # scores_config leaves out those that are there
    append(rows, store.path("fact_customer_scores"), SCORE_SLICES)


def merge_summary(store: Store, p: RunParams) -> None:
    """Update or add the summary rows of the configured model."""
    figures = facts.segment_summary_named(
        scores_of(store, p.config_model_version),
        store.standing("dim_customer_crm"),
        store.read("fact_regional_summary"),
        p.run_date,
        p.segment,
        p.region,
        p.spend_rule,
    )

    def change(table: DataFrame) -> DataFrame:
        rows = summary_rows(figures, first_free(table, "segment_summary_key"), p.run_date)
        return upsert(table, rows, facts.SUMMARY_KEYS, update=[*facts.SUMMARY_FIGURES, "load_date"])

    change_summary(store, change)


def run_segment_load(store: Store, p: RunParams, clock: Callable[[], dt.datetime]) -> dict[str, int | str]:
    """One load from source tables to facts. Loads of different segments may run side by side.

    Without a batch size a repeated run leaves the same content; with one, it adds the next batch of configured scores.
    A step that fails leaves FAILED in the audit and raises; configured scores that fail leave a warning only.
    """
    log_status(store, p, "RUNNING", 0, clock())
    try:
        return run_steps(store, p, clock)
    except Exception:
        log_status(store, p, "FAILED", 0, clock())
        raise


def run_steps(store: Store, p: RunParams, clock: Callable[[], dt.datetime]) -> dict[str, int | str]:
    stage(store, p)
    staged = facts.staged_row_count(store.profiles(p.run_date), p.run_date, p.segment).first()[0]
    if staged == 0:
        if p.allow_empty:
            log_status(store, p, "NO_DATA", 0, clock())
            return {"status": "NO_DATA", "staged": 0, "dimension_rows": 0, "scores": 0}
        log.warning("no staged rows for segment %s on %s", p.segment, p.run_date)
    dimension_rows = load_dimension(store, p)
    load_scores(store, p)
    load_campaigns(store, p)
    load_summary(store, p)
    try:
        add_configured_scores(store, p)
        merge_summary(store, p)
    except Exception:  # the other scores stand without them
        log.warning("configured scores of %s on %s failed", p.segment, p.run_date, exc_info=True)
    scores = facts.score_row_count(store.read("fact_customer_scores"), p.run_date, p.segment).first()[0]
    log_status(store, p, "SUCCESS", scores, clock())
    return {"status": "SUCCESS", "staged": staged, "dimension_rows": dimension_rows, "scores": scores}
