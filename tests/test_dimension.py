import datetime as dt

import pytest

from clientele import schemas
from clientele.functions import fixed_values as fv
from clientele.functions.keys import DuplicateKeyError, require_unique
from clientele.operators import dimension
from tests.helpers import RUN, by_key, frame, rows

OPEN = fv.OPEN_END
BEFORE = RUN - dt.timedelta(days=1)
FIRST = dt.date(2023, 1, 1)


def dim(spark, *given):
    return frame(
        spark,
        schemas.DIM_CUSTOMER_CRM,
        *given,
        full_name="A B",
        email="a@b",
        customer_segment="VIP",
        is_opted_in_email="Y",
        is_current="Y",
        version_num=1,
        valid_from=FIRST,
        valid_to=OPEN,
    )


def staged(spark, *given, **more):
    return frame(
        spark,
        schemas.STG_CUSTOMER_PROFILE,
        *given,
        **{
            "first_name": "A",
            "last_name": "B",
            "email": "a@b",
            "customer_segment": "VIP",
            "is_opted_in_email": "Y",
            "load_date": RUN,
            "etl_status": "PENDING",
            **more,
        },
    )


def test_a_returning_customer_goes_on_after_the_last_closed_version(spark):
    table = dim(
        spark,
        {"dim_crm_customer_key": 10, "customer_id": 1, "is_current": "N", "version_num": 1},
        {"dim_crm_customer_key": 11, "customer_id": 1, "is_current": "N", "version_num": 2},
        {"dim_crm_customer_key": 12, "customer_id": 2, "is_current": "N", "version_num": 3},
        {"dim_crm_customer_key": 13, "customer_id": 2, "version_num": 4},
    )
    arriving = staged(spark, {"customer_id": 1}, {"customer_id": 2, "email": "new"}, {"customer_id": 3})
    inserted = dimension.scd2_inserted(table, arriving, RUN)
    assert by_key(inserted, "customer_id", "version_num") == {1: 3, 2: 5, 3: 1}


def test_only_tracked_columns_open_a_version(spark):
    table = dim(spark, *[{"dim_crm_customer_key": 10 + i, "customer_id": i} for i in range(1, 9)])
    arriving = staged(
        spark,
        {"customer_id": 1},
        {"customer_id": 2, "phone": "1"},
        {"customer_id": 3, "region_code": "R"},
        {"customer_id": 4, "email": None},
        {"customer_id": 5, "postcode": "X"},
        {"customer_id": 6, "last_name": "C"},
        {"customer_id": 7, "is_opted_in_email": "N"},
    )
    assert rows(dimension.scd2_closed(table, arriving, RUN), "customer_id") == [(4,), (5,), (6,), (7,)]
    inserted = dimension.scd2_inserted(table, arriving, RUN)
    assert by_key(inserted, "customer_id", "version_num", "valid_from", "valid_to", "is_current") == {
        i: (2, RUN, OPEN, "Y") for i in (4, 5, 6, 7)
    }


def test_null_and_value_differ_and_two_nulls_do_not(spark):
    table = dim(spark, {"customer_id": 1, "email": None}, {"customer_id": 2, "email": None}, {"customer_id": 3})
    arriving = staged(
        spark, {"customer_id": 1, "email": None}, {"customer_id": 2, "email": "X"}, {"customer_id": 3, "email": None}
    )
    assert rows(dimension.scd2_closed(table, arriving, RUN), "customer_id") == [(2,), (3,)]


def test_new_returning_and_third_version(spark):
    table = dim(
        spark,
        {"dim_crm_customer_key": 1, "customer_id": 1, "is_current": "N", "version_num": 1},
        {"dim_crm_customer_key": 2, "customer_id": 2, "is_current": "N", "version_num": 1},
        {"dim_crm_customer_key": 5000, "customer_id": 2, "version_num": 2},
    )
    arriving = staged(spark, {"customer_id": 1}, {"customer_id": 2, "email": "new"}, {"customer_id": 3})
    merged = dimension.scd2_merge(table, arriving, RUN)
    current = by_key(dimension.current_dimension(merged), "customer_id", "version_num")
    assert current == {1: 2, 2: 3, 3: 1}
    closed = merged.filter("dim_crm_customer_key = 5000").first()
    assert (closed.is_current, closed.valid_to, closed.updated_date) == ("N", BEFORE, RUN)
    keys = [r[0] for r in merged.select("dim_crm_customer_key").collect()]
    assert len(set(keys)) == len(keys) == 6
    assert sorted(keys)[-3] > 5000


def test_first_key_of_an_empty_dimension(spark):
    empty = spark.createDataFrame([], schemas.DIM_CUSTOMER_CRM)
    inserted = dimension.scd2_inserted(empty, staged(spark, {"customer_id": 7}), RUN)
    assert inserted.first().dim_crm_customer_key >= fv.FIRST_KEY


def test_second_change_on_one_day(spark):
    table = dim(spark, {"dim_crm_customer_key": 1, "customer_id": 1, "valid_from": RUN, "version_num": 4})
    merged = dimension.scd2_merge(table, staged(spark, {"customer_id": 1, "email": "again"}), RUN)
    assert rows(merged, "version_num", "valid_from", "valid_to", "is_current") == [
        (4, RUN, BEFORE, "N"),
        (5, RUN, OPEN, "Y"),
    ]


def test_repeat_changes_nothing_and_versions_have_no_gaps(spark):
    table = dim(spark, {"dim_crm_customer_key": 1, "customer_id": 1}, {"dim_crm_customer_key": 2, "customer_id": 2})
    arriving = staged(spark, {"customer_id": 1, "email": "new"}, {"customer_id": 3})
    once = dimension.scd2_merge(table, arriving, RUN)
    assert rows(dimension.scd2_merge(once, arriving, RUN)) == rows(once)
    versions = once.groupBy("customer_id").agg({"version_num": "max", "*": "count"}).collect()
    assert all(r["max(version_num)"] == r["count(1)"] for r in versions)
    current = dimension.current_dimension(once).groupBy("customer_id").count()
    assert {r["count"] for r in current.collect()} == {1}


def test_empty_staging_changes_nothing(spark):
    table = dim(spark, {"dim_crm_customer_key": 1, "customer_id": 1})
    none = spark.createDataFrame([], schemas.STG_CUSTOMER_PROFILE)
    assert rows(dimension.scd2_merge(table, none, RUN)) == rows(table)


def test_missing_names_count_as_empty(spark):
    arriving = staged(spark, {"customer_id": 1, "last_name": None}, {"customer_id": 2, "first_name": None})
    assert by_key(dimension.incoming(arriving), "customer_id", "full_name") == {1: "A ", 2: " B"}


def test_mark_loaded_keeps_to_the_scope(spark):
    day = staged(
        spark,
        {"customer_id": 1, "region_code": "R"},
        {"customer_id": 2},
        {"customer_id": 3, "customer_segment": "RETAIL", "region_code": "R"},
        {"customer_id": 4, "region_code": "R", "etl_status": "REJECTED"},
        {"customer_id": 5, "region_code": "R", "load_date": BEFORE},
    )

    def loaded(**scope):
        marked = dimension.mark_loaded(day, RUN, **scope)
        return [r.customer_id for r in marked.filter("etl_status = 'LOADED'").orderBy("customer_id").collect()]

    assert loaded() == [1, 2, 3]
    assert loaded(segment="VIP") == [1, 2]
    assert loaded(segment="VIP", region="R") == [1]


def test_duplicate_merge_source_is_refused(spark):
    with pytest.raises(DuplicateKeyError, match="customer_id"):
        require_unique(staged(spark, {"customer_id": 1}, {"customer_id": 1}), ["customer_id"], "staged")
