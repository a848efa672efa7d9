"""The queries of this subpackage: one for each operator, over whole tables, and the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import (
    alignment,
    bpe,
    embedding_dup,
    fixity,
    line_dedup,
    mixing,
    near_dup,
    pages,
    periodic_runs,
    suffix_tree,
    token_counts,
    toxicity,
    vector_search,
)
from clientele.llm.common import Scratch, table


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Encode and decode every text; digests of the ids and of the decoded bytes."""
    docs = table(spark, folder, "documents")
    tokens = bpe.encode_decode(docs, public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)
    return tokens.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_pfair_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Sources mixed by the root of their sizes; where every row goes."""
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return mixing.mixed(docs, mixing.root_weights(docs))


def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Two-word shingles, Jaccard similarity of 0.8 or more."""
    return near_dup.near_duplicates(table(spark, folder, "documents"), width=2, percent=80)


def op4_pivot_permutations(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of one label with a cosine of 0.93 or more."""
    return embedding_dup.embedding_duplicates(table(spark, folder, "embeddings"), threshold=0.93)


def op5_merkle_audit(spark: SparkSession, folder: str) -> DataFrame:
    """A fixity drill over all pages: per archive record whether the audit of a damaged replica names it."""
    scratch = Scratch(spark)
    archive = fixity.archived(table(spark, folder, "pages"), scratch)
    places = fixity.placed(archive, scratch)
    ours = fixity.merkle_tree(fixity.digests(archive, places), scratch)
    theirs = fixity.merkle_tree(fixity.digests(fixity.damaged(archive), places), scratch)
    found = fixity.audit(ours, theirs, scratch).withColumnRenamed("record", "node")
    leaves = ours.where("level = 0").select("file", "node", "hash")
    marks = found.select("file", "node", F.when(F.col("their_hash").isNull(), "lost").otherwise("changed").alias("status"))
    rows = places.select("file", F.col("record").alias("node"), "record_id", "offset", "length")
    return (
        rows.join(leaves, ["file", "node"])
        .join(marks, ["file", "node"], "left")
        .select(
            F.col("record_id").alias("page_id"),
            "file",
            F.col("node").alias("record"),
            F.col("offset").alias("begin_offset"),
            "length",
            F.col("hash").alias("leaf_sha256"),
            F.coalesce("status", F.lit("intact")).alias("status"),
        )
    )


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path(token_counts.VOCABULARY), limit=512)


def op7_one_bit_codes(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 nearest of every vector whose id is divisible by 50."""
    return vector_search.nearest_neighbours(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op8_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of 50 words or more that occur before are deleted; per document what is left."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.without_repeats(docs).select(
        "doc_id", "n_lines", "n_deleted", F.md5(F.encode("kept_text", "UTF-8")).alias("kept_md5")
    )


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Learnt from the labels that are not held out; every text is scored."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.main_texts(table(spark, folder, "pages"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, by a hash of the id, repeats a part of itself to its end."""
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    hashed = docs.withColumn("h", F.crc32(F.col("doc_id").cast("string")))
    cut = hashed.select("doc_id", "text", "h", F.when(F.col("h") % 10 == 0, words).alias("words"), F.floor(F.col("h") / 10).alias("g"))
    cut = cut.withColumn("n", F.size("words").cast("long"))
    places = cut.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    places = places.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    rest = (F.col("n") - F.col("a")).cast("int")
    part = F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    copies = F.flatten(F.array_repeat(part, F.ceil(rest / F.col("p")).cast("int")))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), F.slice(copies, F.lit(1), rest))
    return places.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of six words and four periods or more, in texts of which a tenth is made periodic."""
    found = periodic_runs.periodic_runs(with_planted_runs(table(spark, folder, "documents")), 6, 4)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.start.alias("start"),
        best.length.alias("length"),
        best.period.alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.encode(F.array_join(line, ""), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )


def op12_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Every text scored by a suffix tree of the texts that a hash of the id does not hold out."""
    docs = table(spark, folder, "documents")
    return suffix_tree.scored(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of the byte-level and the piece tokenizer over every text."""
    docs = table(spark, folder, "documents")
    paths = public_tokenizers.path(alignment.BYTE_LEVEL), public_tokenizers.path(alignment.PIECES)
    return alignment.alignment(docs, *paths)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}
