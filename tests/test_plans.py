"""Physical plans: what is shuffled, pruned, split, and what never appears."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from clientele import schemas
from clientele.functions.joins import COPIES, lookup_join
from clientele.functions.keys import next_key, with_sequence
from clientele.functions.selection import first_rows, newest_days_rows
from clientele.operators import extract, lineage, scoring
from clientele.sinks.files import replace_partition
from clientele.sinks import versions
from clientele.sources.store import Store, not_current
from clientele.sources import tables
from tests.conftest import SMALL
from tests.helpers import RUN, frame, rows
from verification import queries

# Whole-table aggregates and the snapshot's totals; everything else must stay spread out.
ONE_ROW = {
    "staging_summary",
    "score_row_count",
    "staged_row_count",
    "scd2_inserted",
    "scd2_merge",
    "current_dimension",
    "weekly_scores",
    "lineage_snapshot",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def no_broadcast(spark, **more):
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        **more,
    )


@pytest.mark.parametrize("name", list(queries.DEFINITIONS))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(queries.all_queries()[name](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapPartitions"):
        assert operator not in text
    if name not in ONE_ROW:
        assert "Exchange SinglePartition" not in text


@pytest.mark.parametrize("name", ["retail_spend", "audit_fold", "scores_procedural", "scores_config_batch"])
def test_newest_rows_need_no_sorting_aggregate(spark, name):
    text = plan(queries.all_queries()[name](spark, SMALL))
    assert "HashAggregate" in text and "SortAggregate" not in text


@pytest.mark.parametrize("name", ["extract_profiles_batch", "scores_config_batch"])
def test_batches_do_not_end_in_one_task(spark, name):
    text = plan(queries.all_queries()[name](spark, SMALL))
    for operator in ("TakeOrderedAndProject", "GlobalLimit", "CollectLimit", "Exchange SinglePartition"):
        assert operator not in text


def test_half_of_a_table_is_chosen_in_many_tasks(spark):
    """The rows that are chosen come from many tasks, none of which holds much more than its share."""
    given = spark.range(0, 400_000, 1, 8).select(
        (F.col("id") * 7).alias("k"), F.date_add(F.lit(RUN), -(F.col("id") % 3).cast("int")).alias("day")
    )
    with no_broadcast(spark, spark__sql__shuffle__partitions=32, spark__sql__adaptive__coalescePartitions__enabled="false"):
        for chosen in (first_rows(given, 200_000, "k"), newest_days_rows(given, 200_000, "day", "k")):
            assert chosen.count() == 200_000
            largest = chosen.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
            assert largest < 200_000 / 2
        lowest = first_rows(given, 200_000, "k").agg(F.max("k")).first()[0]
        assert lowest == 7 * (200_000 - 1)


def test_event_filters_reach_the_scan(spark):
    given = queries.Inputs(spark, SMALL)
    text = plan(given.events)
    scan = next(line for line in text.splitlines() if "FileScan" in line and "event_id" in line)
    assert "GreaterThanOrEqual(ts" in scan and "LessThan(ts" in scan
    rates = plan(scoring.conversion_rates(given.events, RUN))
    scan = next(line for line in rates.splitlines() if "FileScan" in line and "event_type" in line)
    assert "value" not in scan.split("ReadSchema")[1]


def test_score_slice_is_pruned(spark, tmp_path):
    path = str(tmp_path / "scores")
    for model in ("v1", "v2"):
        place = {"score_date": RUN, "model_version": model}
        given = frame(spark, schemas.FACT_CUSTOMER_SCORES, {"customer_id": 1, "segment_code": "VIP", **place})
        replace_partition(given, path, place, ["segment_code"])
    scores = tables.read_if_present(spark, path, schemas.FACT_CUSTOMER_SCORES)
    dim = frame(spark, schemas.DIM_CUSTOMER_CRM, {"customer_id": 1, "is_current": "Y"})
    text = plan(tables.current_scores(scores, dim, RUN, "v2"))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan)[1]
    assert "score_date" in filters and "model_version" in filters


def test_current_rows_are_read_without_history(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    name, version = "dim_customer_crm", versions.Version()
    for _ in range(3):
        given = frame(
            spark, schemas.DIM_CUSTOMER_CRM, {"customer_id": 1, "is_current": "Y"}, {"customer_id": 1, "is_current": "N"}
        )
        version = store.write_buckets(name, given, version, closed=not_current())
    current = store.standing(name)
    assert len(current.inputFiles()) == 1
    assert not any("closed_row=Y" in x for x in current.inputFiles())
    assert (current.count(), store.dimension().count()) == (1, 4)


def test_scoring_joins_need_no_shuffle_of_their_own(spark, tmp_path):
    given = queries.Inputs(spark, SMALL)
    stored = {
        "dim": given.dim_customer_crm,
        "sales": given.stg_customer_sales,
        "events": given.events,
        "interactions": given.interactions,
    }
    for name, df in stored.items():
        df.write.parquet(str(tmp_path / name))
    with no_broadcast(spark):
        inputs = [spark.read.parquet(str(tmp_path / name)) for name in stored]
        text = plan(scoring.scores_procedural(*inputs, RUN))
    by_customer = len(re.findall(r"Exchange hashpartitioning\(customer_id#\d+L?, \d+\)", text))
    by_load = len(re.findall(r"Exchange hashpartitioning\(customer_id#\d+L?, \w+#\d+, load_date#\d+, \d+\)", text))
    by_days = len(re.findall(r"Exchange hashpartitioning\(customer_id#\d+L?, \w+#\d+L, \d+\)", text))
    assert (by_customer, by_load, by_days) == (4, 2, 1)
    assert text.count("Exchange") == 7
    assert text.count("SortMergeJoin") == 3


def hot_events(spark, count=60000):
    """A third of the events belong to one customer and campaign."""
    return spark.range(0, count, 1, 6).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997).cast("bigint").alias("cust_id"),
        F.when(F.col("id") % 3 == 0, F.lit("C0"))
        .otherwise(F.concat(F.lit("C"), (F.col("id") % 50).cast("string")))
        .alias("camp_ref"),
        F.lit("SENT").alias("event_type_cd"),
        F.lit(RUN).cast("timestamp_ntz").alias("event_dttm"),
        F.lit(None).cast("string").alias("channel_cd"),
        F.md5(F.col("id").cast("string")).alias("offer_code"),
        F.lit(1).cast("decimal(14,4)").alias("revenue_attrib"),
    )


def test_hot_customer_is_split_and_nothing_is_lost(spark, tmp_path):
    hot_events(spark).write.parquet(str(tmp_path / "events"))
    staged = spark.range(0, 997, 1, 4).select(F.col("id").alias("customer_id"), F.lit(RUN).alias("load_date"))
    campaigns = spark.range(50).select(
        F.concat(F.lit("C"), F.col("id").cast("string")).alias("camp_ref"), F.lit("name").alias("camp_name")
    )
    small = {
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64KB",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
        "spark__sql__shuffle__partitions": "8",
    }
    with no_broadcast(spark, **small):
        events = spark.read.parquet(str(tmp_path / "events"))
        joined = extract.extract_events(events, campaigns, staged.join(staged, ["customer_id", "load_date"]), RUN)
        collected = joined.agg(F.count("*"), F.countDistinct("event_id"))
        assert tuple(collected.collect()[0]) == (60000, 60000)
        assert "skew=true" in plan(collected).split("Initial Plan")[0]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_lookup_key_is_spread(spark, how):
    events = hot_events(spark).withColumn("camp_ref", F.when(F.col("event_id") % 5 > 0, F.col("camp_ref")))
    campaigns = spark.range(40).select(
        F.concat(F.lit("C"), F.col("id").cast("string")).alias("camp_ref"), F.lit("name").alias("camp_name")
    )
    plain = events.join(campaigns, "camp_ref", how)
    with no_broadcast(
        spark, spark__sql__shuffle__partitions=64, spark__sql__adaptive__coalescePartitions__enabled="false"
    ):
        spread = lookup_join(events, campaigns, "camp_ref", how, spread_by="event_id")
        total = spread.count()
        largest = spread.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert total == plain.count()
    assert spread.exceptAll(plain.select(*spread.columns)).count() == 0
    assert largest < total / 3 / COPIES * 4


def test_sequence_is_dense_and_spread(spark):
    ids = spark.range(0, 200000, 1, 8).select((F.col("id") * 1000).alias("customer_id"))
    for number in (None, F.col("customer_id")):
        numbered = with_sequence(ids, "key", 5000, ["customer_id"], number)
        figures = numbered.agg(F.min("key"), F.max("key"), F.countDistinct("key"), F.count("key")).first()
        assert tuple(figures) == (5000, 5000 + 200000 - 1, 200000, 200000)
        assert "Exchange SinglePartition" not in plan(numbered)
    assert numbered.filter("key <> 5000 + customer_id / 1000").count() == 0


def test_sequence_of_any_numbers(spark):
    """Numbers next to each other, far apart, negative, and equal ones."""
    numbers = [*range(70_000, 70_050), -5, -(2**62), 2**62, 2**40, 2**40 + 1, 0, 1, 1, None]
    given = spark.createDataFrame(list(enumerate(numbers)), "k int, n bigint")
    numbered = with_sequence(given, "key", 7, ["k"], F.col("n")).collect()
    order = sorted(range(len(numbers)), key=lambda k: (numbers[k] or 0, k))
    assert {r.k: r.key for r in numbered} == {k: 7 + i for i, k in enumerate(order)}
    assert with_sequence(given.limit(0), "key", 7, ["k"]).count() == 0


def test_sequence_repeats_and_follows_used_keys(spark):
    ids = spark.range(100).select(F.col("id").alias("k"))
    used = spark.createDataFrame([(4711,)], "key bigint")
    once = with_sequence(ids, "key", next_key(used, "key"), ["k"])
    again = with_sequence(ids.repartition(7), "key", next_key(used, "key"), ["k"])
    assert rows(once) == rows(again)
    assert once.agg(F.min("key")).first()[0] > 4711


def test_busiest_object_is_spread(spark):
    mapped = (
        spark.range(0, 30000, 1, 8)
        .select(
            F.when(F.col("id") % 3 > 0, F.lit("HOT")).otherwise(F.concat(F.lit("O"), F.col("id") % 500)).alias("object_name"),
            F.concat(F.lit("T"), F.col("id").cast("string")).alias("table_ref"),
        )
        .withColumn("edge_count", F.lit(1).cast("bigint"))
    )
    with no_broadcast(spark, spark__sql__shuffle__partitions=64, spark__sql__adaptive__coalescePartitions__enabled="false"):
        lists = lineage.dependency_lists(mapped)
        largest = lists.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert largest < 20000 / COPIES * 4
        assert lists.drop("table_count").exceptAll(mapped).count() == 0
        assert lists.count() == 30000
    assert {r[0] for r in lists.filter("object_name = 'HOT'").select("table_count").distinct().collect()} == {20000}
