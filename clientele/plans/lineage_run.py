"""The lineage snapshot of a run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from clientele.functions import fixed_values as fv
from clientele.operators import lineage
from clientele.sinks.files import write_snapshot
from clientele.sources import catalog
from clientele.sources.store import Store


def run_lineage(
    store: Store,
    run_date: dt.date,
    workflow: str,
    generated_at: dt.datetime,
    repositories: Mapping[str, str],
    schemas: Sequence[str] = fv.TRACED_SCHEMAS,
) -> None:
    """Write dependencies, grants, chains and the day's log as one snapshot folder."""
    lines = lineage.lineage_snapshot(
        run_date,
        workflow,
        generated_at.isoformat(),
        store.read("lineage_chains"),
        lineage.grant_links(catalog.cross_grants(store.read("grants"), schemas), repositories),
        lineage.dependency_map(catalog.dependencies(store.read("dependency_edges"), schemas)),
        catalog.execution_log(store.read("etl_job_audit"), run_date),
        schemas,
        repositories,
    )
    write_snapshot(lines, store.path("lineage"), workflow, run_date)
