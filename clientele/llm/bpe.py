"""Byte-level BPE: texts to token ids and back, with the tiktoken library and a local rank file.

A long text is cut at places where no match of the pattern can reach across, so memory for one call stays small while
the ids are those of the whole text. Ids are kept packed (little-endian unsigned 32-bit), four bytes a token.

Nulls and edge cases: a null text counts as empty; an empty text has no tokens; a null id is kept as it is; repeated
rows give repeated results; other columns of the input are not touched, whatever their names.
"""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from clientele.llm.common import map_slices, utf8

RANKS = "byte_bpe_50k.tiktoken"
#: Characters of a text encoded in one call, at least; the cut is at the next safe place.
PIECE_CHARS = 1 << 16
#: Between a letter or mark of punctuation and one blank before an ASCII letter: matches before it end there, and the
#: blank starts a new one.
SAFE = re.compile(r"(?<=[^\W_])(?= [A-Za-z])")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, once per Python worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> list[str]:
    """Cut a text into pieces of ``size`` characters or more, at safe places only."""
    cut, begin = [], 0
    while len(text) - begin > size:
        place = SAFE.search(text, begin + size)
        if place is None:
            break
        cut.append(text[begin : place.start()])
        begin = place.start()
    cut.append(text[begin:])
    return cut


def encode(text: str, path: str, pattern: str) -> array:
    """Token ids of a text as unsigned 32-bit integers."""
    encoder, ids = encoding(path, pattern), array("I")
    for piece in pieces(text):
        ids.extend(encoder.encode_ordinary(piece))
    return ids


def decode(ids: array, path: str, pattern: str) -> bytes:
    """The raw bytes of token ids; no text decoding, so any cut of a token list gives its exact bytes."""
    decoder = encoding(path, pattern)
    return b"".join(decoder.decode_bytes(ids[i : i + PIECE_CHARS].tolist()) for i in range(0, len(ids), PIECE_CHARS))


def packed(ids: array) -> bytes:
    if array("I", [1]).tobytes()[0] != 1:
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def encode_decode(
    docs: DataFrame,
    path: str,
    pattern: str = public_tokenizers.PATTERN,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: its id, ``n_tokens``, ``token_ids`` (packed) and ``decoded`` (the bytes that the ids stand for)."""
    schema = StructType(
        [
            StructField("id", docs.schema[id_column].dataType),
            StructField("n_tokens", LongType()),
            StructField("token_ids", BinaryType()),
            StructField("decoded", BinaryType()),
        ]
    )

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        ids = [encode(text.decode(), path, pattern) for text in utf8(rows.column(1))]
        return pa.record_batch(
            [
                rows.column(0),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([packed(x) for x in ids], pa.binary()),
                pa.array([decode(x, path, pattern) for x in ids], pa.binary()),
            ],
            names=schema.names,
        )

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return map_slices(rows, schema, work).withColumnRenamed("id", id_column)
