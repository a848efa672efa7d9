"""Every query against its SQL counterpart, and the counts expected of the test tables."""

import pytest

from tests.conftest import MEDIUM, SMALL
from verification import oracle, queries
from verification.compare import connect, difference

SQL = oracle.all_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(SQL) == set(queries.DEFINITIONS)


@pytest.mark.parametrize("name", list(queries.DEFINITIONS))
def test_equals_sql(spark, duck, name):
    assert difference(queries.all_queries()[name](spark, SMALL), duck, SQL[name]) is None


@pytest.fixture(scope="module")
def medium(spark):
    return queries.Inputs(spark, MEDIUM)


def counts(df, column):
    return {r[0]: r[1] for r in df.groupBy(column).count().collect()}


def test_staged_counts(medium):
    assert counts(medium.staged, "customer_segment") == {
        "RETAIL": 332,
        "PARTNER": 155,
        "VIP": 150,
        "WHOLESALE": 143,
    }
    assert medium.events.count() == 5067
    assert medium.interactions.count() == 5318
    assert medium.recent_sales().count() == 772


def test_dimension_counts(medium, spark):
    run = queries.all_queries()
    assert run["scd2_closed"](spark, MEDIUM).count() == 173
    inserted = run["scd2_inserted"](spark, MEDIUM)
    assert inserted.count() == 157 + 173
    assert inserted.filter("version_num = 1").count() == 157


def test_audit_and_lineage_counts(medium):
    audit = medium.audit()
    assert audit.count() == 4027
    assert audit.filter("updated_date IS NULL").count() == 1090
    assert counts(audit, "status") == {"SUCCESS": 2815, "FAILED": 408, "NO_DATA": 404, "RUNNING": 400}
    assert queries.DEFINITIONS["sla_breaches"](medium).count() == 2373
    mapped = medium.mapped()
    assert mapped.agg({"edge_count": "sum"}).first()[0] == 22556
    assert mapped.select("object_name").distinct().count() == 30
    assert medium.links().count() == 4560
