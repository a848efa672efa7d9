import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from clientele import schemas
from clientele.params import RunParams, as_date
from clientele.sinks import files, folders, merge, versions
from clientele.sources import tables
from tests.helpers import RUN, rows


def kv(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, v string")


def test_a_merge_source_that_holds_a_key_twice_fails(spark):
    merged = merge.upsert(kv(spark, (1, "a")), kv(spark, (1, "b"), (2, "x"), (2, "y")), ["k"], update=["v"])
    with pytest.raises(Exception, match="occurs more than once"):
        merged.collect()


def test_upsert(spark):
    table, changes = kv(spark, (1, "a"), (2, "b")), kv(spark, (2, "B"), (3, None))
    assert rows(merge.upsert(table, changes, ["k"], update=["v"])) == [(1, "a"), (2, "B"), (3, None)]
    assert rows(merge.upsert(table, changes, ["k"], update=[])) == [(1, "a"), (2, "b"), (3, None)]
    kept = merge.upsert(table, changes, ["k"], update=["v"], insert={"v": F.lit("new")})
    assert rows(kept) == [(1, "a"), (2, "B"), (3, "new")]
    assert rows(merge.upsert(table.limit(0), changes, ["k"], update=["v"])) == rows(changes)
    cleared = merge.upsert(table, kv(spark, (2, None)), ["k"], update=["v"])
    assert rows(cleared) == [(1, "a"), (2, None)]


def test_insert_if_absent(spark):
    assert rows(merge.insert_if_absent(kv(spark, (1, "a")), kv(spark, (1, "z"), (2, "b")), ["k"])) == [(2, "b")]


def test_replace_slice_keeps_rows_the_condition_cannot_judge(spark):
    table = kv(spark, (1, "a"), (2, "a"), (3, None))
    assert rows(merge.replace_slice(table, kv(spark, (9, "a")), F.col("v") == "a")) == [(3, None), (9, "a")]
    assert rows(merge.replace_slice(table, table.limit(0), F.col("v") == "a")) == [
        (3, None)
    ]


def test_replace_slice_keeps_both_sides_in_tasks_of_their_own(spark):
    """Sides dealt alike would have their partitions joined, and the memory of both in one task."""
    table = kv(spark, (1, "a"), (2, "b"), (3, None)).repartition(3, "k")
    fresh = kv(spark, (9, "a")).repartition(3, "k")
    replaced = merge.replace_slice(table, fresh, F.col("v") == "a")
    assert rows(replaced) == [(2, "b"), (3, None), (9, "a")]
    assert replaced.rdd.getNumPartitions() > 3


def test_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        files.append(kv(spark, (1, "a")), path, ["k"])
    assert spark.read.parquet(path).count() == 2
    files.overwrite(kv(spark, (1, "a")), path, ["k"])
    assert spark.read.parquet(path).count() == 1


def test_replace_partition_and_empty_slice(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = schemas.columns("d string, s string, v int")

    def content():
        return rows(tables.read_if_present(spark, path, schema))

    def put(day, *values):
        given = spark.createDataFrame([(day, s, v) for s, v in values], schema)
        files.replace_partition(given, path, {"d": day}, ["s"])

    assert content() == []
    put("x", ("p", 1), ("q", 2))
    put("y", ("p", 3))
    put("x", ("q", 4))
    assert content() == [("x", "q", 4), ("y", "p", 3)]
    files.replace_partition(spark.createDataFrame([("x", "q", 5)], schema), path, {"d": "x", "s": "q"})
    assert content() == [("x", "q", 5), ("y", "p", 3)]
    put("x")
    assert content() == [("y", "p", 3)]
    with pytest.raises(ValueError, match="partition folder"):
        put("../z", ("p", 1))


def test_at_risk_file(spark, tmp_path):
    path = str(tmp_path / "risk")
    df = spark.createDataFrame([(1, "VIP", "a"), (2, "RETAIL", None)], "customer_id int, customer_segment string, n string")
    for _ in range(2):
        files.write_at_risk(df, path, RUN)
    files.write_at_risk(df, path, RUN + dt.timedelta(days=7))
    back = spark.read.option("sep", "|").option("header", True).csv(path)
    assert back.count() == 4
    assert rows(back.filter(F.col("run_date") == RUN), "customer_id", "customer_segment") == [
        ("1", "VIP"),
        ("2", "RETAIL"),
    ]
    text = spark.read.text(f"{path}/run_date={RUN}/customer_segment=VIP").collect()
    assert [r.value for r in text] == ["customer_id|n", "1|a"]

    def ids():
        back = spark.read.option("sep", "|").option("header", True).csv(path).filter(F.col("run_date") == RUN)
        return rows(back, "customer_id")

    files.write_at_risk(df.filter("customer_segment = 'VIP'").limit(0), path, RUN, "VIP")
    assert ids() == [("2",)]
    files.write_at_risk(df.limit(1), path, RUN)
    assert ids() == [("1",)]


def test_count_file(spark, tmp_path):
    path = str(tmp_path / "count")
    files.write_count(kv(spark, (1, "a"), (2, "b")), path, RUN)
    assert spark.read.parquet(path).first().row_count == 2


def test_snapshot_file(spark, tmp_path):
    lines = spark.createDataFrame([("header", '{"a":1}'), ("links", '{"b":2}')], "section string, document string")
    for _ in range(2):
        files.write_snapshot(lines, str(tmp_path), "W", RUN)
    back = spark.read.text(str(tmp_path / "lineage_W_20240130"))
    assert {r.section: json.loads(r.value) for r in back.collect()} == {"header": {"a": 1}, "links": {"b": 2}}


def test_versions(spark, tmp_path):
    path, schema = str(tmp_path / "t"), schemas.columns("k int, v string")
    assert versions.read_newest(spark, path, schema).count() == 0
    for number in (1, 2, 3):
        before = versions.read_newest(spark, path, schema)
        assert versions.write_version(spark, before.unionByName(kv(spark, (number, "x"))), path) == number
    assert rows(versions.read_newest(spark, path, schema), "k") == [(1,), (2,), (3,)]


def test_unfinished_version_is_not_seen_and_is_overwritten(spark, tmp_path):
    path, schema = str(tmp_path / "t"), schemas.columns("k int, v string")
    versions.write_version(spark, kv(spark, (1, "a")), path)
    kv(spark, (99, "half")).write.parquet(f"{path}/data/000000000002-half")
    assert rows(versions.read_newest(spark, path, schema)) == [(1, "a")]
    versions.write_version(spark, kv(spark, (2, "b")), path)
    assert rows(versions.read_newest(spark, path, schema)) == [(2, "b")]


def test_failed_write_leaves_the_table(spark, tmp_path):
    path, schema = str(tmp_path / "t"), schemas.columns("k int, v string")
    versions.write_version(spark, kv(spark, (1, "a")), path)
    failing = kv(spark, (2, "b")).withColumn("v", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        versions.write_version(spark, failing, path)
    assert rows(versions.read_newest(spark, path, schema)) == [(1, "a")]


def test_one_of_two_writes_from_one_version_fails(spark, tmp_path):
    path, schema = str(tmp_path / "t"), schemas.columns("k int, v string")
    versions.write_version(spark, kv(spark, (1, "a")), path)
    base = versions.newest(spark, path)
    versions.write_version(spark, kv(spark, (1, "a"), (2, "b")), path, based_on=base)
    with pytest.raises(versions.ConflictError):
        versions.write_version(spark, kv(spark, (1, "a"), (3, "c")), path, based_on=base)
    assert rows(versions.read_newest(spark, path, schema)) == [(1, "a"), (2, "b")]
    tries = []

    def change():
        version = versions.newest(spark, path)
        table = versions.read_newest(spark, path, schema, version)
        if not tries:
            versions.write_version(spark, table.unionByName(kv(spark, (4, "d"))), path, based_on=version)
        tries.append(version.number)
        versions.write_version(spark, table.unionByName(kv(spark, (3, "c"))), path, based_on=version)

    versions.retried(change)
    assert tries == [2, 3]
    assert rows(versions.read_newest(spark, path, schema), "k") == [(1,), (2,), (3,), (4,)]


def test_history_is_written_once(spark, tmp_path):
    path, schema = str(tmp_path / "t"), schemas.columns("k int, is_current string")
    closed = F.col("is_current") == "N"

    def put(based_on, touched, *pairs):
        given = spark.createDataFrame(list(pairs), schema)
        return versions.write_buckets(spark, given, path, ["k"], based_on, touched, closed)

    first = put(versions.Version(buckets=4), None, *[(k, "Y") for k in range(20)])
    assert len(first.standing) == 4 and not first.closed
    five = spark.createDataFrame([(5, "Y")], schema)
    touched = versions.touched_buckets(five, ["k"], first)
    same = [r[0] for r in versions.read_standing(spark, path, schema, first, touched).collect()]
    second = put(first, touched, (5, "N"), *[(k, "Y") for k in same])
    third = put(second, touched, (5, "N"), *[(k, "Y") for k in same if k != 5])
    assert versions.newest(spark, path) == third
    assert len(touched) == 1 and len(set(third.standing.values())) == 2
    assert rows(versions.read_closed(spark, path, schema, third)) == [(5, "N")] * 2
    other = [b for b in range(4) if b not in touched]
    assert versions.read_closed(spark, path, schema, third, other).count() == 0
    assert [r[0] for r in rows(versions.read_standing(spark, path, schema, third))] == [
        k for k in sorted(range(20), key=lambda k: repr((k, "Y"))) if k != 5
    ]
    emptied = put(third, touched)
    assert str(touched[0]) not in emptied.standing
    assert rows(versions.read_closed(spark, path, schema, emptied)) == [(5, "N")] * 2


def test_old_versions_are_removed(spark, tmp_path):
    path, schema = str(tmp_path / "t"), schemas.columns("k int, v string")
    for number in range(4):
        versions.write_version(spark, kv(spark, (number, "x")), path)
    kv(spark, (9, "x")).write.parquet(f"{path}/data/000000000002-failed")
    kv(spark, (9, "x")).write.parquet(f"{path}/data/000000000005-running")
    gone = versions.remove_old(spark, path, keep=2)
    assert sorted(x[:12] for x in gone) == ["000000000001", "000000000002", "000000000002"]
    assert rows(versions.read_newest(spark, path, schema)) == [(3, "x")]
    assert f"{path}/data/000000000005-running".split("/")[-1] in folders.names(spark, f"{path}/data")
    assert versions.write_version(spark, kv(spark, (7, "x")), path) == 5


def test_file_formats(spark, tmp_path):
    df, schema = kv(spark, (1, "a"), (2, "b")), schemas.columns("k int, v string")
    for name in ("parquet", "orc", "json", "csv"):
        df.write.format(name).save(str(tmp_path / name))
        assert rows(tables.read_files(spark, str(tmp_path / name), schema, name)) == [(1, "a"), (2, "b")]


def test_parameters():
    p = RunParams("2024-01-30", "vip", batch_sizes=(("VIP", 10),))
    assert (p.run_date, p.segment, p.batch, p.batch_number, p.as_of) == (RUN, "VIP", 10, 20240130, RUN)
    assert RunParams(RUN).batch is None
    assert RunParams(RUN, model_version="v1").config_model_version == "v1-configured"
    with pytest.raises(ValueError, match="of their own"):
        RunParams(RUN, model_version="v1", config_model_version="v1")
    for wrong in ("30-01-2024", "20240130", "2024-1-30"):
        with pytest.raises(ValueError, match="YYYY-MM-DD"):
            as_date(wrong)
    with pytest.raises(ValueError, match="segment"):
        RunParams(RUN, "NOBODY")


def test_replace_partition_refuses_rows_of_another_slice(spark, tmp_path):
    path = str(tmp_path / "slices")
    rows = spark.createDataFrame([(1, "VIP"), (2, "VIP")], "id int, segment string")
    files.replace_partition(rows, path, {"segment": "VIP"})
    assert spark.read.parquet(path).count() == 2
    foreign = spark.createDataFrame([(3, "RETAIL")], "id int, segment string")
    with pytest.raises(Exception, match="does not belong"):
        files.replace_partition(foreign, path, {"segment": "VIP"})
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2]
    failing = spark.range(4, numPartitions=4).selectExpr("CAST(id AS int) id", "'VIP' segment").withColumn(
        "id", F.when(F.col("id") == 3, F.raise_error(F.lit("lost midway")).cast("int")).otherwise(F.col("id"))
    )
    with pytest.raises(Exception, match="lost midway"):
        files.replace_partition(failing, path, {"segment": "VIP"})
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2]
    assert folders.names(spark, path) == ["segment=VIP"]
    own = spark.read.parquet(path).filter("segment = 'VIP' AND id = 2")
    files.replace_partition(own, path, {"segment": "VIP"})
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(2, "VIP")]
