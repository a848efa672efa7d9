"""Merkle fixity audit of archive records. DataFrame operations only.

Pages become WARC records, dealt to files and placed at their offsets; only their hashes and lengths are shuffled. A record's leaf is the hash of its bytes with its
place; a node is the hash of its children's hashes in the order of their offsets, and stands for the range of offsets
that they cover; the root of a file covers all of it. An audit of two replicas compares roots, and descends, level by
level, only below nodes that differ or that one replica lacks, to the records that are damaged.

Nulls and edge cases: a record without bytes (null) is hashed as a missing one, unlike an empty one; files and records
that one replica lacks are reported; an empty table has no files, and equal replicas give no rows. Rows with a null id
are archived like others; rows that share an id are told apart by a hash of their content, and equal rows keep one
record each. The places depend on the rows alone, not on how they are partitioned. Other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.common import Scratch, hex_share

#: Records of a file, about, and children of a node.
FILE_RECORDS, FAN_OUT = 256, 8


def warc_bytes(uri: Column, payload: Column) -> Column:
    """A resource record: header lines, an empty line, the payload, two line ends."""
    body = payload.cast("binary")
    name = F.concat(F.lit("<urn:sha256:"), F.sha2(body, 256), F.lit(">"))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: "),
        name,
        F.lit("\r\nWARC-Target-URI: "),
        F.coalesce(uri, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(header.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def archived(
    pages: DataFrame, scratch: Scratch, id_column: str = "page_id", uri_column: str = "url", body_column: str = "html"
) -> DataFrame:
    """``(row, record_id, length, digest, bytes)``: the pages as records, written where they are read; ``row`` tells the
    written rows apart, ``digest`` stands for id and bytes."""
    content = warc_bytes(F.col(uri_column), F.col(body_column))
    rows = pages.select(F.col(id_column).alias("record_id"), content.alias("bytes"))
    named = F.coalesce(F.concat(F.lit("="), F.col("record_id").cast("string")), F.lit(""))
    return scratch.save(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            "record_id",
            F.coalesce(F.octet_length("bytes"), F.lit(0)).cast("long").alias("length"),
            F.md5(F.concat_ws(" ", named, F.coalesce(F.sha2("bytes", 256), F.lit("missing")))).alias("digest"),
            "bytes",
        )
    )


def placed(archive: DataFrame, scratch: Scratch, records: int = FILE_RECORDS) -> DataFrame:
    """``(row, file, record, offset, length, record_id)``: where every row of ``archived`` stands. The bytes do not move.

    A record belongs to a file by a hash of its digest and of its number among equal records, so files are of even size
    also where a third of the rows share an id, or are the same. Equal records are numbered within the tasks that wrote
    them, after the counts of the tasks before.
    """
    files = F.lit(max(1, -(-archive.count() // records)))
    rows = archive.select("row", "record_id", "length", "digest", F.shiftright("row", 33).alias("task"))
    before = Window.partitionBy("digest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = rows.groupBy("digest", "task").agg(F.count("*").alias("n"))
    tasks = tasks.select("digest", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    within = F.row_number().over(Window.partitionBy("digest", "task").orderBy("row")) - 1
    rows = rows.withColumn("within", within).join(tasks, ["digest", "task"])
    rows = rows.withColumn("copy", F.col("earlier") + F.col("within"))
    rows = rows.withColumn("file", hex_share(F.md5(F.concat_ws(":", "digest", F.col("copy").cast("string"))), files))
    order = Window.partitionBy("file").orderBy("record_id", "digest", "copy")
    offset = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return scratch.save(
        rows.select(
            "row",
            "file",
            (F.row_number().over(order) - 1).cast("long").alias("record"),
            F.coalesce(offset, F.lit(0)).alias("offset"),
            "length",
            "record_id",
        )
    )


def digests(archive: DataFrame, places: DataFrame) -> DataFrame:
    """``(file, record, offset, length, record_id, content)``: the records by the hash of their bytes as they are now."""
    return archive.select("row", F.sha2("bytes", 256).alias("content")).join(places, "row").drop("row")


def warc_records(
    pages: DataFrame, records: int = FILE_RECORDS, id_column: str = "page_id", uri_column: str = "url", body_column: str = "html"
) -> DataFrame:
    """``(file, record, offset, length, record_id, bytes)``: the records themselves with their places."""
    scratch = Scratch(pages.sparkSession)
    archive = archived(pages, scratch, id_column, uri_column, body_column)
    found = archive.select("row", "bytes").join(placed(archive, scratch, records), "row")
    return found.select("file", "record", "offset", "length", "record_id", "bytes")


def merkle_tree(records: DataFrame, scratch: Scratch, fan_out: int = FAN_OUT) -> DataFrame:
    """``(file, level, node, begin, end, hash)``: the leaves are level 0 and carry the number of their record; the
    highest level of a file is its root. Every level is hashed from the one below. Records hold ``bytes``, or their hash
    as ``content``."""
    place = F.concat_ws(":", F.col("record").cast("string"), F.col("offset").cast("string"), F.col("length").cast("string"))
    hashed = F.col("content") if "content" in records.columns else F.sha2("bytes", 256)
    content = F.coalesce(hashed, F.lit("missing"))
    level = records.select(
        "file",
        F.lit(0).alias("level"),
        F.col("record").alias("node"),
        F.col("offset").alias("begin"),
        (F.col("offset") + F.col("length")).alias("end"),
        F.sha2(F.concat_ws(":", place, content), 256).alias("hash"),
    )
    level = tree = scratch.save(level)
    most = tree.agg(F.max("node")).first()[0]
    height = 0
    while most is not None and most > 0:
        most //= fan_out
        height += 1
        children = F.sort_array(F.collect_list(F.struct("node", "hash")))
        level = level.groupBy("file", F.floor(F.col("node") / fan_out).cast("long").alias("parent")).agg(
            F.min("begin").alias("begin"),
            F.max("end").alias("end"),
            F.sha2(F.array_join(F.transform(children, lambda x: x["hash"]), "\n"), 256).alias("hash"),
        )
        level = scratch.save(
            level.select("file", F.lit(height).alias("level"), F.col("parent").alias("node"), "begin", "end", "hash")
        )
        tree = tree.union(level)
    return tree


def audit(ours: DataFrame, theirs: DataFrame, scratch: Scratch, fan_out: int = FAN_OUT) -> DataFrame:
    """The differing leaves of two trees: ``(file, record, begin, end, our_hash, their_hash)``, null where one has none.

    Only children of differing nodes are read at each level.
    """
    top = max(t.agg(F.max("level")).first()[0] or 0 for t in (ours, theirs))
    place = ["file", "node"]

    def at(tree: DataFrame, level: int, name: str) -> DataFrame:
        nodes = tree.where(F.col("level") == level)
        return nodes.select(*place, F.struct("begin", "end", "hash").alias(name))

    suspects = None
    for level in range(top, -1, -1):
        left, right = at(ours, level, "a"), at(theirs, level, "b")
        if suspects is not None:
            parent = F.floor(F.col("node") / fan_out).cast("long")
            above = suspects.select("file", F.col("node").alias("parent"))
            left, right = (
                x.withColumn("parent", parent).join(above, ["file", "parent"], "left_semi").drop("parent")
                for x in (left, right)
            )
        both = left.join(right, place, "full")
        suspects = scratch.save(both.where(~F.col("a.hash").eqNullSafe(F.col("b.hash"))))
    return suspects.select(
        "file",
        F.col("node").alias("record"),
        F.coalesce("a.begin", "b.begin").alias("begin"),
        F.coalesce("a.end", "b.end").alias("end"),
        F.col("a.hash").alias("our_hash"),
        F.col("b.hash").alias("their_hash"),
    )


def damaged(records: DataFrame, every: int = 101) -> DataFrame:
    """A replica with known faults, for drills: of the records whose id is divisible by ``every`` the odd ones have their
    last byte cut off (and a blank in its place), the even ones are lost. Numbers and offsets stay."""
    hit = F.coalesce(F.col("record_id") % every == 0, F.lit(False))
    odd = F.col("record_id") % 2 != 0
    cut = F.concat(F.substring("bytes", 1, F.octet_length("bytes") - 1), F.lit(" ").cast("binary"))
    return records.where(~(hit & ~odd)).withColumn("bytes", F.when(hit, cut).otherwise(F.col("bytes")))
