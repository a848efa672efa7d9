"""Near copies of vectors through a pivot-permutation index.

Pivots are reference vectors from a bounded sample, each further from the others than the core angle (``CORE`` times the
angle of the threshold), so a dense group has one or two. A vector within the core angle of a pivot belongs to its core.
By the triangle inequality all its links are within the core angle and that of the threshold of the pivot, so they are
found exactly in the pivot's ball, the list of all vectors that near to it. A pair is counted in the ball of the smaller
of its core pivots.

Vectors of no core, which are far from every pivot, are described by their ``NEAREST`` nearest pivots. Inverted lists hold,
for every two pivots, those that have both among theirs, so they meet in a list if they share at least two pivots; the
pair is counted in the list of its two smallest shared pivots and nowhere else. Vectors in one list are compared in
blocks, by cosine in double precision; counts of links and a spanning set of links leave a block, never all pairs.

There are up to a quarter of the root of the number of vectors as pivots (a power of two between the two bounds), so
lists grow with the root too. Equal vectors of a label are one class, described once; its copies add to the counts.

Nulls and edge cases: a null label, a null or zero vector, or one with a null or non-finite component has no link.
Vectors of different lengths are never linked; for a length with few pivots all vectors of no core are one list. Repeated rows are
vectors of their own in the counts. An empty table gives an empty result. Other columns are not touched.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import Scratch, map_slices, ship
from clientele.llm.components import components
from clientele.llm.vectors import matrix, packed_vectors

NEAREST = 7
FEWEST_PIVOTS, MOST_PIVOTS = 16, 4096
#: Core angle by the angle of the threshold, and sampled vectors for each pivot that is wanted.
CORE, SAMPLED = 1.5, 4
#: Vectors of a block, and rows of a task that takes short lists together, about.
BLOCK_ROWS, TASK_ROWS = 256, 4096


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def angles(threshold: float) -> tuple[float, float]:
    """Of a core and of a ball; a little is added to the ball for rounding."""
    own = math.acos(min(1.0, max(-1.0, threshold)))
    return CORE * own, min(math.pi, (CORE + 1) * own + 1e-6)


def spread(sample: list[np.ndarray], wanted: int, core: float) -> np.ndarray:
    """The first vectors, in order, that are further than the core angle from those before."""
    x = unit(np.stack(sample))
    kept: list[int] = []
    for i in range(len(x)):
        if len(kept) < wanted and (x[kept] @ x[i] < math.cos(min(math.pi, core))).all():
            kept.append(i)
    return x[kept]


def posted(reps: DataFrame, pivots: dict[int, np.ndarray], nearest: int, threshold: float) -> DataFrame:
    """A row for every ball that a vector is in and, if it is in no core, for every two of its nearest pivots.

    A ball has q = -2, and ``near`` holds the vector's core pivot there, or none.
    """
    core_angle, ball_angle = angles(threshold)
    least_core, least_ball = math.cos(min(math.pi, core_angle)), math.cos(ball_angle)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        places, lists = [], []
        dims = batch.column(batch.schema.get_field_index("dim")).to_numpy()
        raw = batch.column(batch.schema.get_field_index("v"))
        marks: list[list[int]] = []

        def post(i: int, p: int, q: int, mark: list[int]) -> None:
            places.append(i)
            lists.append((p, q))
            marks.append(mark)

        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            own = pivots.get(int(dim))
            if own is None:
                for i in at:
                    post(i, -1, -1, [])
                continue
            cosines = unit(matrix(raw.take(pa.array(at)))) @ own.T
            order = np.argsort(-cosines, axis=1, kind="stable")[:, :nearest]
            for i, row, near in zip(at, cosines, order, strict=True):
                core = [int(near[0])] if row[near[0]] >= least_core else []
                for p in np.flatnonzero(row >= least_ball):
                    post(i, int(p), -2, core)
                if core:
                    continue
                near = sorted(near.tolist()) if len(own) > nearest else []
                for p, q in combinations(near, 2) if near else [(-1, -1)]:
                    post(i, p, q, near)
        out = batch.take(pa.array(places, pa.int64()))
        columns = [*out.columns, pa.array(marks, pa.list_(pa.int32()))]
        columns += [pa.array([x[j] for x in lists], pa.int32()) for j in (0, 1)]
        return pa.record_batch(columns, names=[*batch.schema.names, "near", "p", "q"])

    return map_slices(reps, "rep long, label long, dim int, m long, v binary, near array<int>, p int, q int", work)


def list_links(rows: pa.Table, threshold: float) -> pa.Table:
    """Links within the lists of one task: per vector the sum of its partners' copies and the root it is joined to."""
    low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
    keys = np.stack([rows.column(x).to_numpy() for x in ("label", "dim", "p", "q")], axis=1)
    reps, copies, blocks = (rows.column(x).to_numpy() for x in ("rep", "m", "block"))
    found: list[tuple[np.ndarray, ...]] = []
    order = np.lexsort(keys.T)
    cuts = np.flatnonzero((keys[order][1:] != keys[order][:-1]).any(axis=1)) + 1
    for at in np.split(order, cuts):
        if len(at) < 2:
            continue
        at = at[np.argsort(reps[at])]
        own = rows.take(pa.array(at))
        x = unit(matrix(own.column("v")))
        linked = x @ x.T >= threshold
        np.fill_diagonal(linked, False)
        if low != high:
            linked &= blocks[at][:, None] != blocks[at][None, :]
        if not linked.any():
            continue
        p, q = keys[at[0], 2], keys[at[0], 3]
        if q == -2:  # a pair of a core is counted in the ball of the smaller core pivot
            core = np.array([x[0] if x else np.iinfo(np.int32).max for x in own.column("near").to_pylist()])
            linked &= np.minimum(core[:, None], core[None, :]) == p
        if q >= 0:  # a pair that shares a smaller pivot is counted in that list
            near = np.array(own.column("near").to_pylist())
            smaller = np.unique(near[(near < q) & (near != p)])
            has = (near[:, :, None] == smaller[None, None, :]).any(axis=1).astype(np.float32)
            linked &= has @ has.T == 0
        counts = linked @ copies[at]
        root = np.arange(len(at))
        while True:  # the smallest member that links lead to
            least = np.where(linked, root[None, :], len(at)).min(axis=1)
            following = np.minimum(root, least)
            following = following[following]
            if (following == root).all():
                break
            root = following
        some = counts > 0
        found.append((reps[at][some], counts[some], reps[at][root][some]))
    columns = [np.concatenate([x[i] for x in found]) if found else np.empty(0, np.int64) for i in range(3)]
    return pa.table([pa.array(x, pa.int64()) for x in columns], names=["rep", "links", "root"])


def embedding_duplicates(
    frame: DataFrame,
    threshold: float = 0.93,
    nearest: int = NEAREST,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """Per row: its id, ``n_links``, ``component_id`` (smallest id reachable) and ``kept``."""
    spark = frame.sparkSession
    scratch = Scratch(spark)
    packed = scratch.save(packed_vectors(frame, id_column, vector_column, label_column))
    usable = packed.where("v is not null and label is not null and vec is not null")
    classes = usable.groupBy("label", "d1", "d2").agg(F.min("vec").alias("rep"), F.count("*").alias("m"))
    classes = scratch.save(classes)
    placed = scratch.save(
        usable.select("vec", "label", "dim", "d1", "d2", "v").join(classes, ["label", "d1", "d2"])
    )
    reps = placed.where("vec = rep").select("rep", "label", "dim", "m", "v").dropDuplicates(["rep", "label", "v"])
    reps = scratch.save(reps)

    wanted = 2 ** round(math.log2(max(1.0, math.sqrt(max(1, reps.count())) / 4)))
    wanted = min(MOST_PIVOTS, max(FEWEST_PIVOTS, wanted))
    pivots: dict[int, list[np.ndarray]] = {}
    for row in reps.select("dim", "v", F.xxhash64("rep").alias("h")).orderBy("h").limit(SAMPLED * wanted).collect():
        pivots.setdefault(row.dim, []).append(np.frombuffer(row.v, "<f8"))
    tables = {dim: spread(x, wanted, angles(threshold)[0]) for dim, x in pivots.items()}

    lists = scratch.save(posted(reps, tables, nearest, threshold))
    place = ["label", "dim", "p", "q"]
    sizes = lists.groupBy(*place).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    sizes = scratch.save(sizes)
    tasks = F.lit(max(1, -(-lists.count() // TASK_ROWS)))

    rows = lists.join(sizes, place).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns(
        {
            "low": F.least("block", "other"),
            "high": F.greatest("block", "other"),
            "task": F.pmod(F.xxhash64(*place), tasks),
        }
    ).drop("blocks", "other")
    ship(spark)
    found = rows.groupBy("task", "low", "high").applyInArrow(
        lambda x: list_links(x, threshold), "rep long, links long, root long"
    )
    found = scratch.save(found)

    counts = scratch.save(found.groupBy("rep").agg(F.sum("links").alias("links")))
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), scratch)
    joined = scratch.save(joined.withColumnRenamed("node", "rep").join(counts, "rep", "left"))
    known = placed.select("vec", "rep", "m").distinct().join(joined, "rep", "left")
    known = known.select(
        "vec",
        (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    known = scratch.save(known.groupBy("vec").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")))
    found = packed.select("vec").join(known, "vec", "left")
    component = F.coalesce("component_id", "vec")
    return found.select(
        F.col("vec").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec") == component, F.lit(False)).alias("kept"),
    )
