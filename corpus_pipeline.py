"""The corpus pipeline: documents in, token ids out. Each stage reads what the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import bpe, line_dedup, mixing, near_dup
from clientele.llm import toxicity as classifier
from clientele.llm.common import Scratch, table


def packed(docs: DataFrame, *used: str) -> DataFrame:
    """The columns that a stage works on, and the others in one, so that no name clashes with the stage's own."""
    others = [F.col(c) for c in docs.columns if c not in used]
    longest = max(docs.columns, key=len)  # a struct needs a field, also without other columns
    return docs.select(*used, F.struct(F.lit(None).cast("int").alias(f"_{longest}"), *others).alias("given"))


def unpacked(rows: DataFrame, docs: DataFrame, *used: str) -> list[Column]:
    """The columns of ``docs``, of which those that the stage works on are taken as it leaves them."""
    return [F.col(c) if c in used else rows["given"][c].alias(c) for c in docs.columns]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go. It learns from the labels of these documents."""
    model = classifier.train(docs, table(spark, sf_dir, "labels"))
    clean = classifier.scored(packed(docs, "text"), model).where("score < 0.5")
    return clean.select(unpacked(clean, docs, "text"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go; a document of which no line is left goes with them."""
    used = "doc_id", "text", "n_chars"
    found = line_dedup.without_repeats(packed(docs, *used)).where("n_deleted = 0 or n_deleted < n_lines")
    size = F.when(F.col("n_deleted") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    found = found.withColumns({"text": F.col("kept_text"), "n_chars": size})
    return found.select(unpacked(found, docs, *used))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are alike (shingles of five words, similarity of 0.8 or more) the one of smallest id stays.

    A text that differs from all others stays, also where its id is not its own.
    """
    return near_dup.one_of_each(docs, width=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their places in the order that mixes their sources by the roots of their sizes.

    A column ``mix_position`` of the documents gives way to the new one.
    """
    used = "doc_id", "text", "source"
    placed = mixing.with_positions(packed(docs, *used), mixing.root_weights(docs))
    others = [x for x, c in zip(unpacked(placed, docs, *used), docs.columns, strict=True) if c != "mix_position"]
    return placed.select(*others, "mix_position")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every text, packed, and their number; decoding them gives the text again.

    Files are not read in the order they were written, so each row keeps ``mix_position``: the corpus is read by it.
    """
    rows = docs.select(F.struct("doc_id", "mix_position").alias("place"), "text")
    found = bpe.encode_decode(rows, public_tokenizers.path(bpe.RANKS), id_column="place")
    return found.select("place.*", "n_tokens", "token_ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line dedup", lines),
    ("MinHash near-dedup", near_copies),
    ("mixing sources to target weights", mix),
    ("byte-level BPE encoding and decoding", tokens),
]

#: A classifier, sketches and BPE cannot be written in SQL. tests/llm compares each operator with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark), table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return docs
