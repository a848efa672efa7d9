"""Mixing sources to target weights by Pfair scheduling. DataFrame operations only.

A source's rows, in the order of a hash of their ids, are cut into blocks. A cycle stands for ``units`` blocks in all, of
which a source of share w has ``w * units``; by the end of cycle c it has placed ``floor((c + 1) * w * units + offset)``
blocks. Weights are whole numbers (twelve digits for the largest), so shares are kept exactly over the cycles, also those
of less than a block a cycle. Offsets, from 0 to 1, are spread evenly over sources of like weight, so that small sources
do not all come in the same cycle. Within a cycle of n blocks, block i of a source with m blocks is released at slot
``floor(i * n / m)`` and has the deadline ``ceil((i + 1) * n / m)``; in each slot, of the released blocks the one of
earliest deadline goes first. So at every slot a source is less than one block away from its share of the cycle. When
a source runs out, the others go on in their proportions; every row is placed, none is repeated.

Cycles are worked out side by side, each by a fold over its slots; a cycle has about ``units`` blocks however many sources
there are.

Nulls and edge cases: a null source is a source of its own; its rows, like rows with a null id, are placed like others.
Repeated rows are placed one after another. A source of weight zero or without a weight goes to the end, after all others,
as if a cycle had one block of each. An empty table gives an empty result. Other columns may have any names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.common import Scratch, hex_share

#: Rows of a block, blocks of a full cycle, and rows numbered in one task, about.
BLOCK_ROWS, UNITS, TASK_ROWS = 8, 100, 2048
#: Blocks of which one task works out the cycles, about.
TASK_BLOCKS = 5000


def root_weights(docs: DataFrame, source_column: str = "source") -> DataFrame:
    """``(source, weight)``: the root of each source's number of rows, a usual balance of size and variety."""
    counts = docs.groupBy(F.col(source_column).alias("source")).agg(F.count("*").alias("n"))
    return counts.select("source", F.sqrt("n").alias("weight"))


def numbered(docs: DataFrame, source: Column, key: Column, scratch: Scratch, text: Column | None = None) -> DataFrame:
    """Adds ``_source`` and ``_row``, the place of a row within its source, from 0.

    Rows are dealt to even ranges of their digests, so that no task numbers more than a few thousand rows of a source.
    Rows that share an id are dealt by ``text`` too, where it is given.
    """
    parts = [key.cast("string")] if text is None else [key.cast("string"), F.sha2(text, 256)]
    digest = F.md5(F.concat_ws(" ", *(F.coalesce(x, F.lit("")) for x in parts)))
    rows = docs.withColumns({"_source": source, "_digest": digest})
    sizes = rows.groupBy("_source").agg(F.ceil(F.count("*") / TASK_ROWS).cast("long").alias("_parts"))
    sizes = scratch.save(sizes)
    rows = rows.join(sizes, rows["_source"].eqNullSafe(sizes["_source"])).drop(sizes["_source"])
    rows = rows.withColumn("_part", hex_share(F.col("_digest"), F.col("_parts"))).drop("_parts")
    counts = scratch.save(rows.groupBy("_source", "_part").agg(F.count("*").alias("_n")))
    before = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_source", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    offsets = scratch.save(offsets)
    within = Window.partitionBy("_source", "_part").orderBy("_digest", key)
    rows = rows.withColumn("_at", F.row_number().over(within) - 1)
    same = rows["_source"].eqNullSafe(offsets["_source"]) & (rows["_part"] == offsets["_part"])
    rows = rows.join(offsets, same).drop(offsets["_source"]).drop(offsets["_part"])
    return rows.withColumn("_row", (F.col("_offset") + F.col("_at")).cast("long")).drop("_offset", "_at", "_part")


def shares(sizes: DataFrame, weights: DataFrame, units: int) -> DataFrame:
    """``(key, blocks, last, w, total, offset, units)``: whole weights, their sum, and the offset in parts of the sum;
    ``last`` marks sources without a weight, which form a second mix after the first."""
    joined = sizes.join(weights.groupBy("source").agg(F.sum("weight").alias("weight")), sizes["key"].eqNullSafe(F.col("source")), "left")
    weight = F.coalesce(F.greatest("weight", F.lit(0.0)), F.lit(0.0))
    joined = joined.select("key", "blocks", weight.alias("weight"), (weight <= 0).alias("last"))
    group = Window.partitionBy("last")
    whole = F.greatest(F.round(F.col("weight") / F.max("weight").over(group) * 1e12).cast("long"), F.lit(1))
    joined = joined.withColumn("w", F.when(F.col("last"), F.lit(1)).otherwise(whole).cast("long"))
    turn = F.row_number().over(group.orderBy("weight", "key")) * ((math.sqrt(5) - 1) / 2)
    joined = joined.withColumn("total", F.sum("w").over(group)).withColumn("turn", turn - F.floor(turn))
    return joined.select(
        "key",
        "blocks",
        "last",
        "w",
        "total",
        F.least(F.floor(F.col("turn") * F.col("total")), F.col("total") - 1).cast("long").alias("offset"),
        F.when(F.col("last"), F.count("*").over(group)).otherwise(F.lit(units)).cast("long").alias("units"),
    )


def schedule(counts: Column) -> Column:
    """Slots of a cycle as an array of ``(member, item, release, deadline)``, in order; ``counts`` are the members' blocks.

    A fold over the slots: the state holds how many blocks of each member are placed and the slots so far.
    """
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)

    def release(i: Column, n: Column, all_: Column) -> Column:
        return F.floor(i * all_ / n).cast("long")

    def deadline(i: Column, n: Column, all_: Column) -> Column:
        return F.ceil((i + 1) * all_ / n).cast("long")

    def place(state: Column, slot: Column) -> Column:
        ready = F.transform(
            state["done"],
            lambda done, k: F.when(
                (done < F.element_at(counts, k + 1)) & (release(done, F.element_at(counts, k + 1), total) <= slot),
                F.struct(deadline(done, F.element_at(counts, k + 1), total).alias("deadline"), k.alias("member"), done.alias("item")),
            ),
        )
        first = F.array_min(ready)
        return F.transform(
            F.array(first),
            lambda x: F.struct(
                F.transform(state["done"], lambda done, k: done + (k == x["member"]).cast("long")).alias("done"),
                F.concat(
                    state["slots"],
                    F.array(
                        F.struct(
                            x["member"].alias("member"),
                            x["item"].alias("item"),
                            release(x["item"], F.element_at(counts, x["member"] + 1), total).alias("release"),
                            x["deadline"].alias("deadline"),
                        )
                    ),
                ).alias("slots"),
            ),
        )[0]

    start = F.struct(
        F.transform(counts, lambda _: F.lit(0).cast("long")).alias("done"),
        F.array().cast("array<struct<member:int,item:bigint,release:bigint,deadline:bigint>>").alias("slots"),
    )
    return F.aggregate(F.sequence(F.lit(0).cast("long"), total - 1), start, place, lambda state: state["slots"])


def mixed(
    docs: DataFrame,
    weights: DataFrame,
    block_rows: int = BLOCK_ROWS,
    units: int = UNITS,
    id_column: str = "doc_id",
    source_column: str = "source",
) -> DataFrame:
    """The rows with ``mix_block`` (block of its source), ``mix_cycle``, ``mix_release`` and ``mix_deadline`` (slots of the
    cycle) and ``mix_position`` (block's place in the whole mix). Rows are read in the order of ``mix_position``."""
    return in_blocks(docs, weights, block_rows, units, F.col(id_column), F.col(source_column)).drop("_row")


def in_blocks(
    docs: DataFrame, weights: DataFrame, block_rows: int, units: int, key: Column, source: Column, text: Column | None = None
) -> DataFrame:
    """The rows of ``mixed`` with ``_row``, the place of a row within its source."""
    scratch = Scratch(docs.sparkSession)
    rows = numbered(docs, source, key, scratch, text)
    rows = rows.withColumn("mix_block", F.floor(F.col("_row") / block_rows).cast("long"))
    sizes = docs.groupBy(source.alias("key")).agg(F.count("*").alias("n"))
    sizes = sizes.select("key", F.ceil(F.col("n") / block_rows).cast("long").alias("blocks"))
    own = scratch.save(shares(sizes, weights, units))
    placed = scratch.save(cycle_slots(own, scratch))
    found = rows.join(placed, rows["_source"].eqNullSafe(placed["_key"]) & (rows["mix_block"] == placed["_block"]))
    return found.drop("_key", "_block", "_source", "_digest")


def cycle_slots(own: DataFrame, scratch: Scratch) -> DataFrame:
    """A row for every block: its cycle and place there, and its place in the whole mix."""
    counts = {row.last: row.blocks for row in own.groupBy("last").agg(F.sum("blocks").alias("blocks")).collect()}
    tasks = 1 + sum(counts.values()) // TASK_BLOCKS
    blocks = own.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    whole = {x: F.col(x).cast("decimal(19,0)") for x in ("w", "total", "offset", "units")}
    blocks = blocks.withColumns(
        {"_x": (F.col("block") + 1).cast("decimal(19,0)") * whole["total"] - whole["offset"], "_y": whole["units"] * whole["w"]}
    )
    # The first cycle by whose end the block is placed.
    blocks = blocks.withColumn("mix_cycle", F.expr("(_x + _y - 1) div _y") - 1)
    parts = blocks.groupBy("last", "mix_cycle", "key").agg(F.count("*").alias("n"), F.min("block").alias("first"))
    members = F.sort_array(F.collect_list(F.struct("key", "n", "first"))).alias("members")
    patterns = scratch.save(parts.groupBy("last", "mix_cycle").agg(members, F.sum("n").alias("length")))
    before = Window.partitionBy("last").orderBy("mix_cycle").rowsBetween(Window.unboundedPreceding, -1)
    begins = patterns.select("last", "mix_cycle", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("begin"))
    patterns = patterns.join(begins, ["last", "mix_cycle"]).withColumn("counts", F.transform("members", lambda x: x["n"]))
    slots = patterns.repartition(tasks, "last", "mix_cycle")
    slots = slots.select("*", F.posexplode(schedule(F.col("counts"))).alias("slot", "x"))
    member = F.element_at("members", F.col("x.member") + 1)
    ahead = F.when(F.col("last"), F.lit(counts.get(False, 0))).otherwise(F.lit(0))
    return slots.select(
        member["key"].alias("_key"),
        (member["first"] + F.col("x.item")).alias("_block"),
        "mix_cycle",
        F.col("x.release").alias("mix_release"),
        F.col("x.deadline").alias("mix_deadline"),
        (ahead + F.col("begin") + F.col("slot")).cast("long").alias("mix_position"),
    )


def with_positions(docs: DataFrame, weights: DataFrame, block_rows: int = BLOCK_ROWS, units: int = UNITS) -> DataFrame:
    """The rows with ``mix_position``: a place of its own for every row, also for rows that share an id or have none.

    Places rise in the order of the mix; some are left out after the last block of a source, which may be short. The
    texts move twice: to be numbered, and to the places of their blocks.
    """
    found = in_blocks(docs, weights, block_rows, units, F.col("doc_id"), F.col("source"), F.col("text"))
    position = F.col("mix_position") * block_rows + F.col("_row") % block_rows
    return found.select(*docs.columns, position.cast("long").alias("mix_position"))


def in_order(docs: DataFrame, weights: DataFrame, block_rows: int = BLOCK_ROWS, units: int = UNITS) -> DataFrame:
    """The rows themselves, sorted into the order of the mix. Written to several files the order is lost: see
    ``with_positions``."""
    return with_positions(docs, weights, block_rows, units).orderBy("mix_position").select(*docs.columns)
