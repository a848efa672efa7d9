"""Alignment of two tokenizers: where their tokens of one text end at the same byte, and how often ids end together.

Both id lists of a text get their cumulative byte ends in a dictionary from end to index. The intersection of the keys,
sorted, slices both lists into groups; a link is an occurrence of an A and a B token whose byte ranges end together. No
token is empty, so each slice has one, its last tokens. Encoding is done by chunk, between places where both tokenizers are known to begin anew, so every chunk border
is a common end, and the groups of a text are those of its chunks one after the other. A worker keeps the groups of
short chunks that it has met.

Tokens that end together are such that the bytes of one end with those of the other. The id pairs for which that holds
follow from the two vocabularies alone (``pair_table``), some hundred thousand at any size of the corpus, so counts by pair
are small enough to be collected and broadcast.

Nulls and edge cases: a text that is null or empty, or that either side does not give back byte for byte, has no tokens:
counts of 0 and no groups; a null id is kept; repeated rows give repeated results and count each; an empty table gives an
empty result; other columns of the input are not touched.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, count

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from clientele.llm.common import Scratch, map_slices, ship, utf8
from clientele.llm.token_counts import WHITE

# One thread a worker: Spark runs as many workers as there are cores.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: New entries of a worker's memory of chunks after which those not met again since the last time are forgotten, and the
#: longest chunk that it keeps.
CACHE_CHUNKS, CACHE_CHARS = 200_000, 48
#: Chunks encoded together.
TOGETHER = 1000
#: White space that ends in a blank goes with the word after it. Other white space before a word loses its last
#: character to a chunk of its own, as in the pattern of the byte-level tokenizer.
CHUNKS = re.compile(f"[{WHITE}]* [^{WHITE}]+|[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: Where no piece joins ASCII letters with punctuation after them, the letters that a word starts with are a chunk as well:
#: the byte-level tokenizer always begins anew at punctuation after a letter.
SIGN = r"[!-/:-@\[-`{-~]"
FINE_CHUNKS = re.compile(f"[{WHITE}]* [A-Za-z]+(?={SIGN})|[A-Za-z]+(?={SIGN})|{CHUNKS.pattern}")
WORDS = re.compile(f"[{WHITE}].*[^{WHITE}]", re.DOTALL)
LINES = re.compile(f"[^{WHITE}]+")
BLANK = "\u2581"


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself where visible, else from 256 on in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in set(visible)]
    return {chr(x): x for x in visible} | {chr(256 + i): x for i, x in enumerate(hidden)}


class ByteLevelSide:
    """The byte-level tokenizer: strings of special tokens are plain text."""

    def __init__(self, path: str) -> None:
        self.own = Tokenizer.from_file(path)
        pre = self.own.pre_tokenizer
        if self.own.normalizer is not None or not isinstance(pre, ByteLevel) or pre.add_prefix_space:
            raise ValueError(f"{path}: chunks need a byte-level vocabulary without a normalizer")
        self.own.encode_special_tokens = True
        self.own.no_truncation()
        self.own.no_padding()
        letters = byte_letters()
        special = {x.content for x in self.own.get_added_tokens_decoder().values()}
        self.token: list[bytes] = [b""] * self.own.get_vocab_size()
        for text, number in self.own.get_vocab().items():
            self.token[number] = b"" if text in special else bytes(letters[x] for x in text)

    def ids(self, text: str) -> list[int]:
        return self.own.encode_batch_fast([text], add_special_tokens=False)[0].ids


class PieceSide:
    """The piece tokenizer, which puts a blank before a text; ``ids`` takes texts that have theirs already."""

    def __init__(self, path: str) -> None:
        self.own = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.own.id_to_piece(i) for i in range(self.own.get_piece_size())]
        if any(re.search(f"[^{BLANK}]{BLANK}", x) for x in pieces):
            raise ValueError(f"{path}: a piece holds a blank after another character, so no chunk ends before it")
        self.token = [
            bytes([int(x[3:-1], 16)])
            if self.own.is_byte(i)
            else b""
            if self.own.is_control(i) or self.own.is_unknown(i)
            else x.replace(BLANK, " ").encode()
            for i, x in enumerate(pieces)
        ]
        white = re.compile(f"[{WHITE}]")
        #: White space that pieces join with other characters; a text that holds it is one chunk.
        self.joined = {c for x in pieces if len(x) > 1 for c in white.findall(x)}
        plain = [x for i, x in enumerate(pieces) if not (self.own.is_control(i) or self.own.is_unknown(i) or self.own.is_byte(i))]
        self.chunks = CHUNKS if any(re.search(f"[A-Za-z]{SIGN}", x) for x in plain) else FINE_CHUNKS
        # No piece joins a line feed, so a chunk after one is encoded as in the middle of a text.
        self.lead = self.own.encode("\n")
        if "\n" in self.joined or self.own.encode("\nx")[: len(self.lead)] != self.lead:
            raise ValueError(f"{path}: a line feed must stand alone")

    def ids(self, text: str) -> list[int]:
        return self.own.encode("\n" + text)[len(self.lead) :]


@lru_cache(maxsize=1)
def sides(a_path: str, b_path: str) -> tuple[ByteLevelSide, PieceSide]:
    return ByteLevelSide(a_path), PieceSide(b_path)


@lru_cache(maxsize=1)
def pair_table(a_path: str, b_path: str) -> np.ndarray:
    """The id pairs that can end together, as ``a * size of B + b``, ascending."""
    a_side, b_side = sides(a_path, b_path)

    def by_bytes(tokens: list[bytes]) -> dict[bytes, list[int]]:
        held: dict[bytes, list[int]] = {}
        for number, own in enumerate(tokens):
            if own:
                held.setdefault(own, []).append(number)
        return held

    a_by, b_by, size = by_bytes(a_side.token), by_bytes(b_side.token), len(b_side.token)
    pairs = {
        a * size + b
        for own, numbers in a_by.items()
        for i in range(len(own))
        for b in b_by.get(own[i:], ())
        for a in numbers
    }
    pairs |= {
        a * size + b
        for own, numbers in b_by.items()
        for i in range(len(own))
        for a in a_by.get(own[i:], ())
        for b in numbers
    }
    return np.array(sorted(pairs), np.int64)


#: Numbers of A and B tokens, of groups, the groups as text, the places of the linked pairs in the pair table.
Chunk = tuple[int, int, int, str, tuple[int, ...]]


class Aligner:
    """Chunks with their groups: this worker's memory, then the tokenizers.

    Chunks from white space to the end of a word begin anew after one another too, and so do those without white space after
    a line feed, so new ones are encoded together.
    """

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = sides(a_path, b_path)
        self.pairs = pair_table(a_path, b_path)
        self.a_names, self.b_names = ([str(i) for i in range(len(x.token))] for x in (self.a, self.b))
        self.cache: dict[str, Chunk | None] = {}
        self.older: dict[str, Chunk | None] = {}
        self.whole = re.compile("[" + "".join(map(re.escape, sorted(self.b.joined))) + "]") if self.b.joined else None

    def aligned(self, chunks: list[str]) -> list[Chunk | None]:
        """The groups of chunks that follow one another; None for a chunk of which a side does not give back the bytes."""
        text = "".join(chunks)
        a, b = self.a.ids(text), self.b.ids(text)
        a_bytes, b_bytes = [self.a.token[x] for x in a], [self.b.token[x] for x in b]
        if not b"".join(a_bytes) == b"".join(b_bytes) == text.encode():
            half = len(chunks) // 2
            return [None] if not half else self.aligned(chunks[:half]) + self.aligned(chunks[half:])
        a_index = dict(zip(accumulate(map(len, a_bytes)), count(1)))
        b_index = dict(zip(accumulate(map(len, b_bytes)), count(1)))
        a_names, b_names, size = self.a_names, self.b_names, len(self.b.token)
        bounds = accumulate(len(x.encode()) for x in chunks)
        bound, i, j, first_i, first_j, first = next(bounds), 0, 0, 0, 0, 0
        groups, links, cut = [], [], []
        for end in sorted(a_index.keys() & b_index.keys()):
            to_i, to_j = a_index[end], b_index[end]
            if to_i == i + 1 and to_j == j + 1:
                groups.append(f"{a_names[a[i]]}|{b_names[b[j]]}")
            else:
                groups.append(f"{','.join([a_names[x] for x in a[i:to_i]])}|{','.join([b_names[x] for x in b[j:to_j]])}")
            i, j = to_i, to_j
            links.append(a[i - 1] * size + b[j - 1])
            if end == bound:
                cut.append((i - first_i, j - first_j, first, len(groups)))
                bound, first_i, first_j, first = next(bounds, 0), i, j, len(groups)
        places = np.searchsorted(self.pairs, links).tolist()
        return [
            (n_a, n_b, last - first, ";".join(groups[first:last]), tuple(places[first:last]))
            for n_a, n_b, first, last in cut
        ]

    def known(self, chunks: set[str]) -> dict[str, Chunk | None]:
        """A table that holds all of these chunks."""
        if len(self.cache) > CACHE_CHUNKS:
            self.older, self.cache = self.cache, {}
        unseen = [x for x in chunks if x not in self.cache]
        fresh = {x: self.older[x] for x in unseen if x in self.older}
        missing = [x for x in unseen if x not in fresh]
        words = [x for x in missing if WORDS.fullmatch(x)]
        # Chunks without white space stand after a line feed.
        lines = [x for word in missing if LINES.fullmatch(word) for x in ("\n", word)]
        for together in (words, lines):
            for begin in range(0, len(together), TOGETHER):
                some = together[begin : begin + TOGETHER]
                fresh.update(zip(some, self.aligned(some), strict=True))
        fresh.update([(x, self.aligned([x])[0]) for x in missing if x not in fresh])
        long = {k: v for k, v in fresh.items() if len(k) > CACHE_CHARS}
        self.cache.update(fresh if not long else {k: v for k, v in fresh.items() if k not in long})
        return {**self.cache, **long} if long else self.cache

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        whole = self.whole is not None and self.whole.search(text)
        return [f" {text}"] if whole else self.b.chunks.findall(f" {text}")

    def of(self, texts: list[str]) -> list[list[Chunk] | None]:
        cut = [self.chunks(x) for x in texts]
        table = self.known(set(chain.from_iterable(cut)))
        found = [list(map(table.__getitem__, own)) for own in cut]
        return [own if own and all(own) else None for own in found]


_WORKER: list[tuple[str, str, Aligner]] = []


def worker_aligner(a_path: str, b_path: str) -> Aligner:
    """One memory per Python worker, kept over its tasks."""
    if not _WORKER or _WORKER[0][:2] != (a_path, b_path):
        _WORKER[:] = [(a_path, b_path, Aligner(a_path, b_path))]
    return _WORKER[0][2]


def aligned_texts(
    docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: its id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` as text, and the linked pairs: their
    places in the pair table (``pairs``, ascending) and how many links each has (``times``)."""
    schema = StructType(
        [
            StructField("id", docs.schema[id_column].dataType),
            *[StructField(name, LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")],
            StructField("groups", StringType()),
            StructField("pairs", ArrayType(IntegerType())),
            StructField("times", ArrayType(IntegerType())),
        ]
    )

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        aligner = worker_aligner(a_path, b_path)
        gc.disable()  # the many small objects of the memory hold no cycles
        found = aligner.of([x.decode() for x in utf8(rows.column(1))])
        gc.enable()
        texts = [tuple(zip(*own, strict=True)) if own else ((),) * 5 for own in found]
        linked = [np.unique(np.array([*chain.from_iterable(own[4])], np.int32), return_counts=True) for own in texts]
        offsets = np.cumsum([0, *[len(x) for x, _ in linked]]).astype(np.int32)
        columns = [pa.array([sum(own[i]) for own in texts], pa.int64()) for i in range(3)]
        columns.append(pa.array([int(times.sum()) for _, times in linked], pa.int64()))
        columns.append(pa.array([";".join(own[3]) for own in texts], pa.string()))
        for part in (0, 1):
            values = np.concatenate([np.zeros(0, np.int32), *[x[part].astype(np.int32) for x in linked]])
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32())))
        return pa.record_batch([rows.column(0), *columns], names=schema.names)

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return map_slices(rows, schema, work).withColumnRenamed("id", id_column)


def pair_counts(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``(pair, links)``: how many links of all texts hold each pair. One partial count per task and pair is shuffled."""
    size = len(pair_table(a_path, b_path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            places, times = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (0, 1))
            np.add.at(total, places, times)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["pair", "links"])

    ship(aligned.sparkSession)
    return aligned.select("pairs", "times").mapInArrow(count, "pair int, links long").groupBy("pair").agg(F.sum("links").alias("links"))


def rated(aligned: DataFrame, counts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``aligned`` without its pairs, with ``n_best`` (links whose pair is the most frequent of its B id, ties included) and
    ``count_sum`` (the counts of the pairs of all links, added up)."""
    table = pair_table(a_path, b_path)
    links = np.zeros(len(table), np.int64)
    for row in counts.collect():  # one row per pair of the table at most
        links[row.pair] = row.links
    b_ids = table % len(sides(a_path, b_path)[1].token)
    most = np.zeros(b_ids.max() + 1, np.int64)
    np.maximum.at(most, b_ids, links)
    shared: Broadcast = aligned.sparkSession.sparkContext.broadcast((links, links == most[b_ids]))
    kept = [x for x in aligned.columns if x not in ("pairs", "times")]
    added = [StructField("n_best", LongType()), StructField("count_sum", LongType())]
    schema = StructType([*[aligned.schema[x] for x in kept], *added])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, best = shared.value
        for batch in batches:
            places, times = batch.column("pairs"), batch.column("times")
            offsets = np.asarray(places.offsets)
            own, weight = np.asarray(places.values), np.asarray(times.values).astype(np.int64)
            run = np.concatenate([np.zeros((2, 1), np.int64), np.cumsum([weight * best[own], weight * counted[own]], axis=1)], axis=1)
            sums = run[:, offsets[1:]] - run[:, offsets[:-1]]
            yield pa.record_batch([*[batch.column(x) for x in kept], *map(pa.array, sums)], names=schema.names)

    ship(aligned.sparkSession)
    return aligned.mapInArrow(work, schema)


def alignment(
    docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: its id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``.

    Texts are encoded once: what the counts need is written to the shared folder, with the groups as a digest.
    """
    own = aligned_texts(docs, a_path, b_path, id_column, text_column)
    digest = F.when(F.col("n_a") > 0, F.sha2(F.encode("groups", "UTF-8"), 256)).otherwise("")
    saved = Scratch(docs.sparkSession).save(own.withColumn("groups_sha256", digest).drop("groups"))
    return rated(saved, pair_counts(saved, a_path, b_path), a_path, b_path)
