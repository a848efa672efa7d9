"""Nearest neighbours by randomly rotated one-bit codes.

A unit vector is rotated by a fixed random rotation; its code is the sign of each component, packed to bits, and its
correction scalar is the inner product of the vector and its code. The bits and the scalar estimate the inner product
with a query, with an error bound; a candidate is reranked on the original vectors if its upper bound reaches the k-th
largest lower bound of its block. Queries meet all rows in blocks of fixed size; a block answers with k rows a query.

Nulls and edge cases: a null id, a null, empty or zero vector, or one with a null or non-finite component takes no part.
Vectors of different lengths are never compared. A query never finds rows that carry its own id; of repeated rows with
one id, the one whose vector has the smallest digest answers. With fewer candidates than k, all are returned; equal scores go to the smaller id.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.common import Scratch, map_slices, ship
from clientele.llm.vectors import matrix, packed_vectors

#: Width of the error bound, in deviations of the estimate.
WIDTH = 3.0
#: Queries and rows that meet in one block, and queries of it that are estimated at a time.
QUERY_ROWS, BLOCK_ROWS, SLICE = 8192, 4096, 512
SEED = 20


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A random rotation, the same in every worker."""
    turned, upper = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return turned * np.sign(np.diag(upper))


def ordered_sum(x: np.ndarray) -> np.ndarray:
    """Sums along the last axis, from left to right."""
    return np.add.accumulate(x, axis=-1)[..., -1]


def encoded(vectors: DataFrame) -> DataFrame:
    """Adds ``code`` (packed signs) and ``scalar`` (inner product of the vector and its code)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, scalars = [], []
        for raw in batch.column(2).to_pylist():
            x = np.frombuffer(raw, "<f8")
            turned = rotation(len(x)) @ (x / np.sqrt(x @ x))
            codes.append(np.packbits(turned > 0).tobytes())
            scalars.append(float(np.abs(turned).sum() / np.sqrt(len(x))))
        columns = [*batch.columns, pa.array(codes, pa.binary()), pa.array(scalars, pa.float64())]
        return pa.record_batch(columns, names=["vec", "dim", "v", "code", "scalar"])

    return map_slices(vectors.select("vec", "dim", "v"), "vec long, dim int, v binary, code binary, scalar double", work)


def block_neighbours(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The k best rows of a block for every query."""
    names = ["query_id", "vec_id", "score"]
    if not queries.num_rows or not rows.num_rows:
        return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
    q, x = matrix(queries.column("v")), matrix(rows.column("v"))
    dim = x.shape[1]
    ids, asked = rows.column("vec").to_numpy(), queries.column("vec").to_numpy()
    bits = np.unpackbits(np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(len(x), -1), axis=1)
    signs = (bits[:, :dim].astype(np.float64) * 2 - 1) / np.sqrt(dim)
    scalars = rows.column("scalar").to_numpy()
    errors = WIDTH * np.sqrt(np.maximum(0, 1 - scalars**2)) / scalars / np.sqrt(max(1, dim - 1))
    found: list[tuple[int, int, float]] = []
    lengths = np.sqrt(ordered_sum(x * x))
    for i, query in enumerate(q):
        if i % SLICE == 0:
            part = q[i : i + SLICE]
            turned = (part / np.sqrt((part * part).sum(axis=1, keepdims=True))) @ rotation(dim).T
            estimates = (turned @ signs.T) / scalars
        estimate = estimates[i % SLICE]
        other = ids != asked[i]
        lower = np.where(other, estimate - errors, -np.inf)
        if other.sum() > k:
            least = np.partition(lower, -k)[-k]
            at = np.flatnonzero(other & (estimate + errors >= least))
        else:
            at = np.flatnonzero(other)
        near = x[at] @ query / lengths[at]
        if len(at) > k:  # what could be among the first k, with room for rounding
            at = at[near >= np.partition(near, -k)[-k] - 1e-9 * np.abs(near).max()]
        scores = ordered_sum(x[at] * query) / (lengths[at] * np.sqrt(ordered_sum(query * query)))
        for j in np.lexsort((ids[at], -scores))[:k]:
            found.append((int(asked[i]), int(ids[at][j]), float(scores[j])))
    columns = list(zip(*found, strict=True)) if found else [(), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.float64())
    return pa.table([pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)], names=names)


def nearest_neighbours(
    frame: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k rows of largest cosine for each row where ``is_query`` holds.

    ``is_query`` is a condition on the id column only.
    """
    spark = frame.sparkSession
    scratch = Scratch(spark)
    packed = packed_vectors(frame, id_column, vector_column).where("v is not null and vec is not null")
    single = packed.groupBy("vec").agg(F.min_by(F.struct("dim", "v"), F.struct("d1", "d2")).alias("x")).select("vec", "x.*")
    rows = scratch.save(encoded(single))
    asked = scratch.save(rows.withColumn(id_column, F.col("vec")).where(is_query).select("vec", "dim", "v"))
    sizes = rows.groupBy("dim").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("row_blocks"))
    shares = asked.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("query_blocks"))
    sizes = scratch.save(sizes.join(shares, "dim"))

    def spread(column: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(column) - 1))

    def own(column: str, salt: int) -> Column:
        return F.pmod(F.xxhash64("vec", F.lit(salt)), F.col(column)).cast("int")

    place = ["dim", "query_block", "row_block"]
    questions = asked.join(sizes, "dim").withColumn("query_block", own("query_blocks", 1))
    questions = questions.withColumn("row_block", spread("row_blocks")).select(*place, "vec", "v")
    answers = rows.join(sizes, "dim").withColumn("row_block", own("row_blocks", 2))
    answers = answers.withColumn("query_block", spread("query_blocks")).select(*place, "vec", "v", "code", "scalar")
    ship(spark)
    found = (
        questions.groupBy(*place)
        .cogroup(answers.groupBy(*place))
        .applyInArrow(lambda x, y: block_neighbours(x, y, k), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    found = scratch.save(found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
