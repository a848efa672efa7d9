import datetime as dt
from decimal import Decimal

import pytest

from clientele import schemas
from clientele.operators import audit, extract, facts, lineage
from clientele.sources import catalog, tables
from tests.helpers import RUN, by_key, frame, rows


def event(kind, campaign="C1", day=RUN, hour=0, revenue="1.5"):
    return {
        "event_type": kind,
        "campaign_id": campaign,
        "event_date": dt.datetime.combine(day, dt.time(hour)),
        "revenue_attributed": revenue,
    }


def test_campaign_rates_and_zero_divisors(spark):
    events = frame(
        spark,
        schemas.STG_CAMPAIGN_EVENTS,
        *[event("SENT")] * 3,
        event("OPENED"),
        event("OPENED", hour=23),
        event("CONVERTED"),
        event("OPENED", "UNSENT"),
        event("CLICKED", "UNOPENED"),
        event("SENT", day=RUN - dt.timedelta(days=1)),
    )
    day = facts.campaign_performance(events, RUN)
    got = by_key(day, "campaign_id", "total_sent", "open_rate", "click_rate", "conversion_rate", "revenue_attributed")
    assert got["C1"] == (3, Decimal("0.666667"), 0, Decimal("0.333333"), 9)
    assert got["UNSENT"][1:4] == (None, 0, None)
    assert got["UNOPENED"][1:4] == (None, None, None)
    assert facts.campaign_performance(events).count() == 4
    assert facts.campaign_performance(events, RUN, "C1").count() == 1


def summary_inputs(spark):
    scores = frame(
        spark,
        schemas.FACT_CUSTOMER_SCORES,
        {"customer_id": 1, "clv_score": 6, "churn_risk_score": 0.8},
        {"customer_id": 2, "clv_score": 5, "churn_risk_score": 0.7},
        {"customer_id": 3, "clv_score": 1, "churn_risk_score": 0.05},
        {"customer_id": 4, "clv_score": 2, "churn_risk_score": 0.05},
        {"customer_id": 5, "clv_score": 2, "churn_risk_score": 0.05, "segment_code": "RETAIL"},
        {"customer_id": 1, "clv_score": 9, "score_date": RUN - dt.timedelta(days=7)},
        {"customer_id": 6, "clv_score": 9},
        {"customer_id": 1, "clv_score": 8, "churn_risk_score": 0.8, "model_version": "other"},
        score_date=RUN,
        segment_code="VIP",
        model_version="v2.1",
    )
    dim = frame(
        spark,
        schemas.DIM_CUSTOMER_CRM,
        {"customer_id": 1, "region_code": "R1"},
        {"customer_id": 2, "region_code": "R1"},
        {"customer_id": 3},
        {"customer_id": 4, "region_code": "UNKNOWN"},
        {"customer_id": 5, "region_code": "R2"},
        {"customer_id": 6, "region_code": "R1", "is_current": "N"},
        is_current="Y",
    )
    regional = frame(
        spark,
        schemas.FACT_REGIONAL_SUMMARY,
        {"region_code": "R1", "total_revenue": 100},
        {"region_code": "UNKNOWN", "total_revenue": 7},
        {"region_code": "R1", "total_revenue": 1, "summary_date": RUN - dt.timedelta(days=1)},
        summary_date=RUN,
    )
    return scores, dim, regional


FIGURES = (
    "customer_count", "avg_clv_score", "avg_churn_risk", "high_value_count", "at_risk_count", "total_retail_spend",
)


def test_summary_by_region(spark):
    got = {
        (r.segment_code, r.region_code): tuple(r[c] for c in FIGURES)
        for r in facts.segment_summary(*summary_inputs(spark), RUN).collect()
    }
    assert got[("VIP", "R1")] == (2, Decimal("6.3333"), Decimal("0.766667"), 2, 2, 300)
    assert got[("VIP", None)] == (1, 1, Decimal("0.05"), 0, 0, 0)
    assert got[("VIP", "UNKNOWN")][-1] == 7
    assert got[("RETAIL", "R2")][-1] == 0
    assert len(got) == 4


def test_summary_spend_once_and_filters(spark):
    given = summary_inputs(spark)
    once = facts.segment_summary(*given, RUN, spend_rule="once")
    assert by_key(once.filter("region_code = 'R1'"), "segment_code", "total_retail_spend") == {"VIP": 100}
    assert facts.segment_summary(*given, RUN, region="R2").count() == 1
    with pytest.raises(ValueError, match="spend rule"):
        facts.segment_summary(*given, RUN, spend_rule="twice")


def test_named_summary_joins_missing_region_and_region_of_that_name(spark):
    named = facts.segment_summary_named(*summary_inputs(spark), RUN, segment="VIP")
    got = by_key(named, "region_code", "customer_count", "avg_clv_score", "total_retail_spend")
    assert got == {"R1": (2, Decimal("6.3333"), 300), "UNKNOWN": (2, Decimal("1.5"), 7)}


def test_extract_windows_orphans_and_ties(spark):
    day = dt.timedelta(days=1)
    start = dt.datetime.combine(RUN, dt.time())
    times = [start - 90 * day, start - 90 * day - dt.timedelta(seconds=1), start + day - dt.timedelta(seconds=1), start + day]
    staged = frame(spark, schemas.STG_CUSTOMER_PROFILE, {"customer_id": 1}, load_date=RUN)
    events = frame(
        spark,
        schemas.SRC_CAMPAIGN_EVENTS,
        *[{"event_id": i, "event_dttm": t} for i, t in enumerate(times)],
        {"event_id": 10, "event_dttm": start, "camp_ref": "ORPHAN"},
        {"event_id": 11, "event_dttm": start, "cust_id": 2},
        cust_id=1,
        camp_ref="C1",
    )
    campaigns = frame(spark, schemas.SRC_CAMPAIGNS, {"camp_ref": "C1", "camp_name": "One"})
    got = extract.extract_events(events, campaigns, staged, RUN)
    assert by_key(got, "event_id", "campaign_name", "revenue_attributed") == {0: ("One", 0), 2: ("One", 0)}

    times = [start - 30 * day, start - 30 * day - dt.timedelta(seconds=1), start + day - dt.timedelta(seconds=1), start + day]
    seen = frame(
        spark,
        schemas.SRC_INTERACTIONS,
        *[{"interaction_id": i, "interaction_date": t} for i, t in enumerate(times)],
        cust_id=1,
    )
    assert rows(extract.extract_interactions(seen, staged, RUN), "interaction_id") == [(0,), (2,)]


def test_extract_profiles(spark):
    customers = frame(
        spark,
        schemas.SRC_CUSTOMERS,
        {"cust_id": 3, "email": "A@B"},
        {"cust_id": 2},
        {"cust_id": 1, "last_modified_date": RUN - dt.timedelta(days=7), "region_code": "R"},
        {"cust_id": 4, "last_modified_date": RUN - dt.timedelta(days=8)},
        {"cust_id": 5, "is_active": "N"},
        is_active="Y",
        last_modified_date=RUN,
    )
    segments = frame(
        spark,
        schemas.SRC_CUSTOMER_SEGMENTS,
        {"cust_id": 1, "valid_to": RUN},
        {"cust_id": 2, "valid_to": RUN - dt.timedelta(days=1)},
        {"cust_id": 3, "is_primary": "N"},
        segment_code="VIP",
        is_primary="Y",
        valid_to=dt.date(9999, 12, 31),
    )
    whole = extract.extract_profiles(customers, segments, RUN, batch_size=None)
    assert by_key(whole, "customer_id", "customer_segment") == {1: "VIP", 2: "RETAIL", 3: "RETAIL"}
    assert by_key(whole, "customer_id", "country_code", "acquisition_channel", "is_opted_in_sms", "email")[3] == (
        "GB",
        "UNKNOWN",
        "N",
        "a@b",
    )
    assert whole.columns == schemas.STG_CUSTOMER_PROFILE.names

    def ids(**options):
        return rows(extract.extract_profiles(customers, segments, RUN, **options), "customer_id")

    assert ids(batch_size=1) == [(2,)]
    assert ids(batch_size=99) == [(1,), (2,), (3,)]
    assert ids(segment="VIP") == [(1,)]
    assert ids(region="R") == [(1,)]
    assert extract.extract_profiles(customers.limit(0), segments, RUN).count() == 0


def message(status, minute, n=0, job="J"):
    return {"job_name": job, "status": status, "rows_processed": n, "message_ts": dt.datetime(2024, 1, 30, 0, minute)}


def messages(spark, *given):
    return frame(spark, schemas.AUDIT_MESSAGES, *given, workflow_name="W", run_date=RUN)


def test_audit_rows(spark):
    empty = spark.createDataFrame([], schemas.ETL_JOB_AUDIT)
    first = audit.audit_upsert(empty, messages(spark, message("RUNNING", 1)))
    assert rows(first, "status", "rows_processed", "created_date", "updated_date") == [
        ("RUNNING", 0, dt.datetime(2024, 1, 30, 0, 1), None)
    ]
    later = audit.audit_upsert(first, messages(spark, message("SUCCESS", 9, 5), message("RUNNING", 5, job="K")))
    got = by_key(later, "job_name", "status", "rows_processed", "created_date", "updated_date")
    assert got["J"] == ("SUCCESS", 5, dt.datetime(2024, 1, 30, 0, 1), dt.datetime(2024, 1, 30, 0, 9))
    assert got["K"][3] is None
    whole = messages(
        spark, message("RUNNING", 1), message("SUCCESS", 9, 5), message("RUNNING", 5, job="K")
    )
    assert rows(audit.audit_upsert(empty, whole)) == rows(later)


def test_prerequisites_and_late_jobs(spark):
    table = frame(
        spark,
        schemas.ETL_JOB_AUDIT,
        *[{"job_name": s, "status": s} for s in ("SUCCESS", "COMPLETED", "RUNNING", "FAILED")],
        {"job_name": "LATE", "status": "SUCCESS", "updated_date": dt.datetime(2024, 1, 30, 5, 0, 1)},
        {"job_name": "JUST", "status": "SUCCESS", "updated_date": dt.datetime(2024, 1, 30, 5, 0, 0)},
        workflow_name="W",
        run_date=RUN,
        created_date=dt.datetime(2024, 1, 30),
    )
    asked = spark.createDataFrame(
        [("W", j, RUN) for j in ("SUCCESS", "COMPLETED", "RUNNING", "FAILED", "NONE")],
        "workflow_name string, job_name string, run_date date",
    )
    answers = by_key(audit.prerequisite_status(table, asked), "job_name", "return_code")
    assert answers == {"SUCCESS": 0, "COMPLETED": 0, "RUNNING": 2, "FAILED": 1, "NONE": 3}
    assert by_key(audit.sla_breaches(table), "job_name", "elapsed_seconds") == {"LATE": 18001}


def test_lineage(spark):
    edges = frame(
        spark,
        schemas.DEPENDENCY_EDGES,
        {"object_name": "P", "ref_name": "T2"},
        {"object_name": "P", "ref_name": "T1"},
        {"object_name": "P", "ref_name": "T1", "ref_owner": "ELSEWHERE"},
        {"object_name": "V", "object_type": "VIEW", "ref_name": "T1"},
        {"object_name": "Q", "ref_name": "SEQ", "ref_type": "SEQUENCE"},
        object_owner="CRM_SCHEMA",
        object_type="PACKAGE BODY",
        ref_owner="DW_OWNER",
        ref_type="TABLE",
    )
    mapped = lineage.dependency_map(catalog.dependencies(edges))
    lists = lineage.dependency_lists(mapped)
    assert rows(lists, "object_name", "table_ref", "edge_count", "table_count") == [
        ("CRM_SCHEMA.P", "DW_OWNER.T1", 1, 2),
        ("CRM_SCHEMA.P", "DW_OWNER.T2", 1, 2),
    ]
    assert lineage.dependency_map(catalog.dependencies(edges, full_catalog=False)).count() == 4
    chains = frame(
        spark,
        schemas.LINEAGE_CHAINS,
        {"chain_id": "1", "plsql_package": "CRM_SCHEMA.P.LOAD"},
        {"chain_id": "2", "plsql_package": "CRM_SCHEMA.NONE.LOAD"},
        {"chain_id": "3"},
    )
    assert rows(lineage.chain_refs(chains, mapped), "chain_id", "plsql_table_ref", "has_table_refs") == [
        ("1", "DW_OWNER.T1", True),
        ("1", "DW_OWNER.T2", True),
        ("2", None, False),
        ("3", None, None),
    ]
    grants = frame(
        spark,
        schemas.GRANTS,
        {"target_schema": "CRM_SCHEMA", "privilege": "SELECT"},
        {"target_schema": "CRM_SCHEMA", "privilege": "REFERENCES"},
        {"target_schema": "DW_OWNER", "privilege": "SELECT"},
        {"target_schema": "OTHER", "privilege": "SELECT"},
        source_schema="DW_OWNER",
        source_table="T",
    )
    links = lineage.grant_links(catalog.cross_grants(grants), {"DW_OWNER": "retail"})
    assert rows(links, "source_repo", "target_repo", "access_type", "link_type") == [
        ("retail", "unknown", "SELECT", "CROSS_REPO_GRANT")
    ]


def test_lineage_lists(spark):
    """The lists of an object hold all its tables, sorted; a long one has pages, of which a chain has a row each."""
    tables_of = {"S.P": [f"T{i}" for i in range(9)], "S.Q": ["B", "A"]}
    mapped = spark.createDataFrame(
        [(name, ref, i + 1) for name, refs in tables_of.items() for i, ref in enumerate(refs)],
        "object_name string, table_ref string, edge_count bigint",
    )
    lists = lineage.dependency_lists(mapped, page_size=4)
    found = {}
    for r in lists.collect():
        counts = dict(zip(r.table_refs, map(int, r.edge_counts), strict=True))
        assert r.table_refs == sorted(r.table_refs) and sum(counts.values()) == r.edge_count
        assert r.table_count == len(tables_of[r.object_name])
        found.setdefault(r.object_name, {})[r.page] = counts
    assert found["S.Q"] == {0: {"A": 2, "B": 1}}
    assert 1 < len(found["S.P"]) <= 3
    assert {k: v for page in found["S.P"].values() for k, v in page.items()} == {f"T{i}": i + 1 for i in range(9)}
    chains = frame(
        spark,
        schemas.LINEAGE_CHAINS,
        {"chain_id": "1", "plsql_package": "S.Q.LOAD"},
        {"chain_id": "2", "plsql_package": "S.P.LOAD"},
        {"chain_id": "3", "plsql_package": "S.NONE.LOAD"},
        {"chain_id": "4"},
    )
    refs = rows(lineage.chain_refs(chains, lists), "chain_id", "page", "plsql_table_refs", "has_table_refs")
    assert refs == sorted(
        [("1", 0, ["A", "B"], True), ("3", 0, [], False), ("4", 0, None, None)]
        + [("2", page, sorted(counts), True) for page, counts in found["S.P"].items()],
        key=repr,
    )


def test_snapshot_holds_the_lists(spark):
    mapped = spark.createDataFrame(
        [("S.P", "B", 1), ("S.P", "A", 2)], "object_name string, table_ref string, edge_count bigint"
    )
    chains = frame(spark, schemas.LINEAGE_CHAINS, {"chain_id": "1", "plsql_package": "S.P.LOAD"})
    links = lineage.grant_links(spark.createDataFrame([], schemas.GRANTS), {})
    log = spark.createDataFrame([], schemas.ETL_JOB_AUDIT)
    got = by_key(lineage.lineage_snapshot(RUN, "W", "now", chains, links, mapped, log), "section", "document")
    assert got["dependency_map"] == '{"object_name":"S.P","page":0,"table_refs":["A","B"]}'
    assert '"page":0,"plsql_table_refs":["A","B"]' in got["lineage_chains"].replace('"has_table_refs":true,', "")


def test_empty_catalog_gives_a_snapshot(spark):
    def none(schema):
        return spark.createDataFrame([], schema)

    lines = lineage.lineage_snapshot(
        RUN,
        "W",
        "now",
        none(schemas.LINEAGE_CHAINS),
        lineage.grant_links(none(schemas.GRANTS), {}),
        lineage.dependency_map(none(schemas.DEPENDENCY_EDGES)),
        none(schemas.ETL_JOB_AUDIT),
    )
    got = by_key(lines, "section", "document")
    assert set(got) == {"lineage_snapshot", "summary"}
    assert '"plsql_dependencies":0' in got["summary"]


def test_regional_reads(spark):
    regional = frame(
        spark,
        schemas.FACT_REGIONAL_SUMMARY,
        {"summary_date": RUN - dt.timedelta(days=30), "total_revenue": 1},
        {"summary_date": RUN - dt.timedelta(days=31), "total_revenue": 2},
        {"summary_date": RUN, "total_revenue": 4},
        region_code="R",
    )
    assert rows(tables.regional_revenue(regional, RUN)) == [("R", 5)]
    assert tables.regional_summary(regional, RUN).count() == 1
