"""Embedding columns as packed rows: validity, length, bytes and a digest of each vector."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from clientele.llm.common import map_slices


def packed_vectors(frame: DataFrame, id_column: str, vector_column: str, label_column: str | None = None) -> DataFrame:
    """``(vec, label, dim, d1, d2, v)``: v holds the components as little-endian doubles, null where they cannot be
    compared (null, empty or zero vectors, and those with a null or non-finite component); label is null if not asked for.
    """
    kind = frame.schema[vector_column].dataType
    if not isinstance(kind, ArrayType):
        raise ValueError(f"{vector_column} is not an array")
    wide = F.col(vector_column) if isinstance(kind.elementType, FloatType) else F.col(vector_column).cast("array<double>")
    label = F.col(label_column).cast("long") if label_column else F.lit(None).cast("long")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        vectors = batch.column(2)
        for i in range(batch.num_rows):
            values = vectors[i].values
            bad = values is None or len(values) == 0 or values.null_count
            x = None if bad else values.to_numpy(zero_copy_only=False).astype("<f8")
            if x is None or not np.isfinite(x).all() or not x.any() or not 0 < float(x @ x) < np.inf:
                out.append((0, None, None, None))
                continue
            raw = x.tobytes()
            mark = hashlib.blake2b(raw, digest_size=16).digest()
            out.append((len(x), *(int.from_bytes(mark[j : j + 8], "little", signed=True) for j in (0, 8)), raw))
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
        columns = [pa.array([row[j] for row in out], kind) for j, kind in enumerate(kinds)]
        return pa.record_batch([batch.column(0), batch.column(1), *columns], names=["vec", "label", "dim", "d1", "d2", "v"])

    rows = frame.select(F.col(id_column).cast("long").alias("vec"), label.alias("label"), wide.alias("x"))
    return map_slices(rows, "vec long, label long, dim int, d1 long, d2 long, v binary", work)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Packed vectors of one length as the rows of a matrix of doubles."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
