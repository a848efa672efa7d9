"""Near copies of texts: similarity sketches filled by rounds of hashed bin placement, banding, exact verification.

A text is the set of its distinct word shingles. Every round places each shingle in one of ``t`` bins; a bin keeps its
smallest value, where values of earlier rounds are smaller. After ``t`` rounds, round ``t + i`` places every shingle in
bin ``i``, so that each bin is sure to be filled; most sets are done after a few rounds. Bins agree with a probability
of the Jaccard similarity. Bands of bins give buckets, and links are confirmed on the full shingle sets.

Within a bucket no list of all pairs is made. In two rounds each member is compared with one centre of its buckets, which
joins most copies. Then every component that is not the largest one of a bucket is an outlier there: it is compared, in
one pass, with all members of the clusters that its buckets lead to. Clusters (a component and the outliers that gather
around it) are cut into blocks of ``BLOCK_ROWS`` members; a block finds the intersections with all members by one lookup
in its sorted shingles. So every pair that shares a band and is not in one component by then is compared on its full
sets, while only links are stored: this loses no component.

Nulls and edge cases: a null or empty text, or one without words, has an empty set and no link. A text of fewer words
than a shingle is one shingle. Equal sets are one class, named by its smallest id. Rows that share an id count as one
document with the links of all its texts. A row without an id belongs to the class of its text, is not kept, and never
names a component. Other columns are not touched. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.keys import with_sequence
from clientele.llm.common import Scratch, map_slices, ship, utf8
from clientele.llm.components import components

#: At similarity 0.8 a pair shares no band with probability (1 - 0.8 ** 6) ** 32 = 0.00006.
BANDS, ROWS = 32, 6
#: Rounds of comparisons with a centre before the exhaustive pass.
ROUNDS = 2
#: Members of a block, outliers compared with it in one task, and shingles of a block, about.
BLOCK_ROWS, BLOCK_QUERIES, BLOCK_ITEMS = 128, 256, 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles. ``bytes`` lowers A-Z and splits at ASCII white space only."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(width, len(words))
    found = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        found = mix(found * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(found)])
    return np.unique(found)


def sketch(items: np.ndarray, bins: int) -> np.ndarray:
    """Smallest value of each bin. Rounds go on until every bin is filled, at most ``2 * bins``."""
    kept = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    done, step = 0, max(1, min(bins, -(-3 * bins // len(items))))
    while done < bins:
        rounds = np.arange(done, min(bins, done + step), dtype=np.uint64)[:, None]
        keys = mix(items[None, :] + mix(rounds + np.uint64(1)))
        places = ((keys >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        values = (rounds << np.uint64(54)) | (mix(keys) >> np.uint64(10))
        np.minimum.at(kept, places.ravel().astype(np.int64), values.ravel())
        if kept.max() != np.iinfo(np.uint64).max:
            return kept
        done += step
    for place in np.flatnonzero(kept == np.iinfo(np.uint64).max):
        late = np.array([bins + place], np.uint64)
        kept[place] = (late[0] << np.uint64(54)) | (mix(items + mix(late + np.uint64(1))).min() >> np.uint64(10))
    return kept


def band_keys(items: np.ndarray, bands: int, rows: int) -> np.ndarray:
    values = sketch(items, bands * rows).reshape(bands, rows)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, i])
    return keys.view(np.int64)


def digest(items: np.ndarray) -> tuple[int, int]:
    raw = hashlib.blake2b(items.tobytes(), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def sketches(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """Per row ``doc``: size of its set, its digest (``d1``, ``d2``) and its band keys, null for an empty set."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(text, width) for text in utf8(batch.column(1))]
        marks = [digest(x) if len(x) else (None, None) for x in sets]
        return pa.record_batch(
            [
                batch.column(0),
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array([x for x, _ in marks], pa.int64()),
                pa.array([x for _, x in marks], pa.int64()),
                pa.array([band_keys(x, bands, rows) if len(x) else None for x in sets], pa.list_(pa.int64())),
            ],
            names=["doc", "n", "d1", "d2", "bands"],
        )

    return map_slices(docs, "doc long, n long, d1 long, d2 long, bands array<long>", work)


def full_sets(docs: DataFrame, wanted: DataFrame, width: int, scratch: Scratch) -> DataFrame:
    """``(rep, items)`` with the packed shingle set of every wanted class; ``many`` marks those that several rows hold."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        sets = [shingles(text, width) for text in utf8(batch.column(1))]
        asked = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        own = pa.array([digest(x) == y for x, y in zip(sets, asked, strict=True)], pa.bool_())
        columns = [batch.column(0), batch.column(4), pa.array([x.tobytes() for x in sets], pa.binary())]
        return pa.record_batch(columns, names=["rep", "many", "items"]).filter(own)

    # Never broadcast: the classes that share a bucket grow with the documents.
    texts = docs.join(wanted.withColumnRenamed("rep", "doc").hint("merge"), "doc").select("doc", "text", "d1", "d2", "many")
    found = scratch.save(map_slices(texts, "rep long, many boolean, items binary", work))
    # The sets of single rows, nearly all, are not shuffled again.
    once = scratch.save(found.where("many").select("rep", "items").distinct())
    return found.where("not many").select("rep", "items").union(once)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets reach the similarity, with their other columns."""
    names = pairs.columns
    schema = ", ".join(f"{n} long" for n in names)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        left, right = batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()
        good = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(left, right, strict=True)):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(p, q, assume_unique=True))
            good[i] = 100 * common >= percent * (len(p) + len(q) - common)
        return batch.select(list(range(len(names)))).filter(pa.array(good))

    with_sets = pairs.join(sets.select(F.col("rep").alias("a"), F.col("items").alias("x")), "a")
    with_sets = with_sets.join(sets.select(F.col("rep").alias("b"), F.col("items").alias("y")), "b")
    return map_slices(with_sets.select(*names, "x", "y"), schema, work)


def block_links(members: pa.Table, queries: pa.Table, percent: int) -> pa.Table:
    """Links of the queries with a block's members of other components, one for each query and component."""
    sets = [np.frombuffer(x, np.uint64) for x in members.column("items").to_pylist()]
    sizes = np.array([len(x) for x in sets], np.int64)
    reps, comps = members.column("rep").to_numpy(), members.column("comp").to_numpy()
    items, owners = np.concatenate([*sets, np.empty(0, np.uint64)]), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(items, kind="stable")
    items, owners = items[order], owners[order]
    found: list[tuple[int, int, int, int]] = []
    for rep, comp, own in zip(*(queries.column(x).to_pylist() for x in ("rep", "comp", "items")), strict=True):
        own = np.frombuffer(own, np.uint64)
        low, high = np.searchsorted(items, own, "left"), np.searchsorted(items, own, "right")
        hits = high - low
        places = np.repeat(low - (np.cumsum(hits) - hits), hits) + np.arange(hits.sum())
        common = np.bincount(owners[places], minlength=len(sets))
        good = (100 * common >= percent * (len(own) + sizes - common)) & (comps != comp)
        at = np.flatnonzero(good)
        for first in at[np.unique(comps[at], return_index=True)[1]]:
            found.append((rep, int(reps[first]), comp, int(comps[first])))
    columns = zip(*found, strict=True) if found else ([], [], [], [])
    return pa.table([pa.array(list(x), pa.int64()) for x in columns], names=["a", "b", "ca", "cb"])


def outlier_links(buckets: DataFrame, state: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """All links between members of one bucket that are in different components, one for each two components at least."""
    now = scratch.save(buckets.join(state, "rep"))
    parts = now.groupBy("key", "comp").agg(F.count("*").alias("size"))
    main = parts.groupBy("key").agg(F.max_by("comp", "size").alias("main"), F.count("*").alias("parts"))
    main = scratch.save(main.where("parts > 1").drop("parts"))
    parts = scratch.save(now.select("key", "comp").distinct().join(main, "key"))
    homes = parts.where("comp <> main").groupBy("comp").agg(F.min("main").alias("home"))
    homes = parts.select("comp").distinct().join(homes, "comp", "left").select("comp", F.coalesce("home", "comp").alias("home"))
    homes = scratch.save(homes)
    members = scratch.save(now.select("rep", "n", "comp").distinct().join(homes, "comp"))
    blocks = members.groupBy("home").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n") / BLOCK_ITEMS)).cast("int").alias("blocks")
    )
    blocks = scratch.save(blocks)
    reached = scratch.save(parts.join(homes, "comp").select("key", "home").distinct())
    outliers = now.join(parts.where("comp <> main").select("key", "comp"), ["key", "comp"]).select("key", "rep", "comp")
    outliers = outliers.join(reached, "key").select("rep", "comp", "home").distinct()
    counts = scratch.save(outliers.groupBy("home").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("shares")))

    def spread(column: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.col(column) - 1))

    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    share = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("shares")).cast("int")
    members = members.join(blocks, "home").join(counts, "home").withColumn("block", own).drop("n")
    members = members.select("rep", "comp", "home", "block", spread("shares").alias("share"))
    queries = outliers.join(blocks, "home").join(counts, "home").withColumn("share", share)
    queries = queries.select("rep", "comp", "home", "share", spread("blocks").alias("block"))
    place = ["home", "block", "share"]
    again = sets.select(F.col("rep").alias("rep"), F.col("items").alias("items"))
    ship(sets.sparkSession)
    return (
        members.join(sets, "rep")
        .groupBy(*place)
        .cogroup(queries.join(again, "rep").groupBy(*place))
        .applyInArrow(lambda x, y: block_links(x, y, percent), "a long, b long, ca long, cb long")
    )


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: its id, ``n_shingles``, ``component_id`` and ``kept``.

    Texts are linked where ``100 * |intersection| >= percent * |union|``; a component is named by its smallest id.
    """
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text"))
    marked = scratch.save(sketches(texts, width, bands, rows))

    # Classes of equal sets. Saved, so that the join below can split a class with very many members.
    classes = marked.where("d1 is not null").groupBy("d1", "d2").agg(F.min("doc").alias("least"), F.count("*").alias("m"))
    classes = scratch.save(classes.where("m > 1").drop("m"))
    placed = marked.join(classes, ["d1", "d2"], "left").withColumn("rep", F.when(F.col("d1").isNotNull(), F.coalesce("least", "doc")))
    placed = placed.withColumns({"bands": F.when(F.col("doc") == F.col("rep"), F.col("bands")), "alone": F.col("least").isNull()})
    placed = scratch.save(placed.drop("least"))
    scratch.drop(marked)

    # Only a set that several rows hold can be described twice.
    described = placed.where("bands is not null").select("rep", "n", "bands", "alone")
    described = described.where("alone").union(described.where("not alone").distinct())
    keys = described.select("rep", "n", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("key")
    buckets = scratch.save(keys.join(scratch.save(shared), "key", "left_semi"))
    wanted = buckets.select("rep").distinct().join(placed.where("doc = rep").select("rep", "d1", "d2"), "rep")
    wanted = scratch.save(wanted.groupBy("rep", "d1", "d2").agg((F.count("*") > 1).alias("many")))
    sets = full_sets(texts, wanted, width, scratch)
    state = scratch.save(wanted.select("rep", F.col("rep").alias("comp")).distinct())

    def merged(links: DataFrame) -> DataFrame:
        moved = components(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")), scratch)
        moved = moved.select(F.col("node").alias("comp"), F.col("component"))
        return scratch.save(state.join(moved, "comp", "left").select("rep", F.coalesce("component", "comp").alias("comp")))

    similar = f"100 * least(n, cn) >= {int(percent)} * greatest(n, cn)"
    for _ in range(ROUNDS):
        now = buckets.join(state, "rep")
        centres = now.groupBy("key").agg(
            F.min("rep").alias("c"), F.min_by("comp", "rep").alias("cc"), F.min_by("n", "rep").alias("cn"),
            F.min("comp").alias("lo"), F.max("comp").alias("hi"),
        )
        centres = scratch.save(centres.where("lo < hi").drop("lo", "hi"))
        pairs = now.join(centres, "key").where(f"comp <> cc and {similar}")
        pairs = pairs.groupBy("rep").agg(F.min("c").alias("b"), F.min_by("cc", "c").alias("cb"), F.min("comp").alias("ca"))
        pairs = pairs.select(F.col("rep").alias("a"), "b", "ca", "cb")
        state = merged(scratch.save(confirmed(pairs, sets, percent)))
    state = merged(scratch.save(outlier_links(buckets, state, sets, percent, scratch)))

    found = placed.select("doc", "n", "rep").join(state, "rep", "left")
    component = F.coalesce("comp", "rep", "doc")
    return found.select(
        F.col("doc").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc") == component, F.lit(False)).alias("kept"),
    )


def own_ids(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows with an id, with ``_node``: the id, but where rows of one id differ in text, a free number for all texts of it
    but the one of least digest."""
    rows = docs.where("_given.doc_id is not null").select("_given", "_given.doc_id", F.col("_given.text").alias("text"))
    rows = rows.withColumn("_digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    pairs = rows.select("doc_id", "_digest").distinct()
    texts = pairs.groupBy("doc_id").agg(F.min("_digest").alias("_first"), F.count("*").alias("_texts")).where("_texts > 1")
    others = pairs.join(texts.drop("_texts"), "doc_id").where("_digest <> _first").select("doc_id", "_digest")
    free = docs.agg((F.coalesce(F.max("_given.doc_id"), F.lit(0)) + 1).alias("free")).first().free
    # Read once more for every row, so written; a table of a few rows is broadcast by its size.
    others = scratch.save(with_sequence(scratch.save(others), "_own", free, ["doc_id", "_digest"]))
    found = rows.join(others, ["doc_id", "_digest"], "left")
    return found.select("_given", "text", F.coalesce("_own", "doc_id").alias("_node"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near copies: of each component the row of smallest id stays, once.

    Rows that share an id and a text are one document; rows that share an id and differ in text are documents of their own,
    of which all but the one of least digest come after all ids. So the result does not depend on how rows are dealt, and
    no text without a near copy goes. Rows without an id cannot be told apart and stay. Other columns may have any names.
    """
    scratch, columns = Scratch(docs.sparkSession), docs.columns
    packed = docs.select(F.struct(*columns).alias("_given"))
    rows = own_ids(packed, scratch)
    nodes = rows.select(F.col("_node").alias("doc_id"), "text")
    kept = near_duplicates(nodes, width, percent).where("kept").groupBy("doc_id").agg(F.count("*").alias("_rows"))
    kept = scratch.save(kept.withColumnRenamed("doc_id", "_node"))
    # Never broadcast: most ids are kept.
    rows = rows.drop("text")
    single = rows.join(kept.where("_rows = 1").hint("merge"), "_node")
    several = rows.join(kept.where("_rows > 1").hint("merge"), "_node")
    # Rows of one text that differ in other columns: the one whose columns, as JSON, come first.
    several = several.groupBy("_node").agg(F.min_by("_given", F.to_json("_given")).alias("_given"))
    given = single.select("_given").union(several.select("_given"))
    return given.union(packed.where("_given.doc_id is null").select("_given")).select("_given.*")
