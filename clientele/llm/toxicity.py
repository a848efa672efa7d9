"""A toxicity classifier that does not react to the mention of a group.

A logistic regression on the words of a text and their beginnings (a text has a feature or not). Features are chosen by
how much more frequent they are in toxic texts. In the training texts that mention an identity term, the term is swapped
for the others of its list, and squared changes of the score are penalised, over all features that the swap takes from
the text or brings into it, beginnings too. So the terms get weights near each other, and near that of the neutral word
in the list, and clean texts that mention a group are not rejected.

The classifier is fitted on a bounded sample of labelled texts: at most ``POSITIVE_ROWS`` toxic and ``NEGATIVE_ROWS``
other ones, those of smallest hash of the id; of texts that share an id one is learnt from; features, and the rows that the driver fits, are bounded by ``MOST_FEATURES``.
Every text is scored as a whole.

Nulls and edge cases: a null text counts as empty and gets the score of a text without features; a null id is never
learnt from; a document with several labels is toxic if one says so; null labels are no labels; without labels of both
kinds every score is the share of toxic labels (0 without labels). Repeated rows give repeated results. The column added
to the documents must have a new name, other columns may have any.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from clientele.llm.common import Scratch, map_slices, utf8

POSITIVE_ROWS, NEGATIVE_ROWS, MOST_FEATURES = 2000, 4000, 1500
#: Least log lift times root of the toxic texts that have a feature.
LEAST_SCORE = 6.0
#: Weights of the squared coefficients and of the squared score changes.
RIDGE, FAIRNESS = 1.0, 100.0
#: Identity terms by list; terms of one list are swapped for one another. The first is neutral.
IDENTITY_TERMS = (
    ("people", "women", "men", "girls", "boys", "gays", "lesbians", "straights", "transgender", "queer"),
    ("believers", "christians", "muslims", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("persons", "blacks", "whites", "asians", "latinos", "africans", "arabs", "immigrants", "refugees", "foreigners"),
    ("adults", "elderly", "teenagers", "disabled", "blind", "deaf"),
    ("person", "woman", "man", "girl", "boy", "gay", "lesbian", "straight", "trans", "homosexual", "female", "male"),
    ("believer", "christian", "muslim", "jew", "hindu", "buddhist", "catholic", "atheist"),
    ("religious", "jewish", "islamic", "christian", "muslim", "hindu", "buddhist", "catholic", "atheist"),
    ("person", "black", "white", "asian", "latino", "latina", "african", "arab", "immigrant", "refugee", "foreigner"),
    ("local", "foreign", "arabic", "mexican", "chinese", "indian", "turkish", "american", "european"),
    ("adult", "teenager", "old", "young"),
    ("mensch", "frau", "mann", "jude", "christ", "muslim", "ausländer", "flüchtling", "schwuler", "lesbe"),
    ("religiös", "jüdisch", "christlich", "muslimisch", "ausländisch", "schwul", "lesbisch"),
    ("personne", "femme", "homme", "juif", "juive", "chrétien", "musulman", "étranger", "réfugié", "noir", "blanc"),
    ("persona", "mujer", "hombre", "judío", "cristiano", "musulmán", "extranjero", "refugiado", "negro", "blanco"),
    ("menschen", "frauen", "männer", "juden", "christen", "muslime", "ausländer", "flüchtlinge", "schwule", "lesben"),
    ("personnes", "femmes", "hommes", "juifs", "chrétiens", "musulmans", "étrangers", "réfugiés", "noirs", "blancs"),
    ("personas", "mujeres", "hombres", "judíos", "cristianos", "musulmanes", "extranjeros", "refugiados", "negros"),
)
WORDS = re.compile(r"\w+")
PREFIXES = (4, 5, 6)
#: Entries of a worker's table of words, after which it starts anew.
CACHE_WORDS = 500_000


def number(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature) >> 1


def features_of(word: str) -> list[int]:
    """A word and its beginnings."""
    return [number(word), *(number(word[:n] + "*") for n in PREFIXES if len(word) >= n)]


def words_of(text: str) -> set[str]:
    return set(WORDS.findall(text.lower()))


def held_out(key: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def swaps(words: set[str]) -> list[tuple[str, str]]:
    """Identity terms of a text, each with every other term of its list."""
    return [(x, y) for terms in IDENTITY_TERMS for x in terms if x in words for y in terms if y != x]


def differences(words: set[str]) -> list[list[int]]:
    """For every swap the features that it takes from the text, as ``-1 - f``, and those that it brings."""
    held = Counter(f for w in words for f in set(features_of(w)))
    found = []
    for a, b in swaps(words):
        old, new = set(features_of(a)), set(features_of(b))
        lost = {f for f in old - new if held[f] == 1}  # no other word has it
        found.append([-1 - f for f in sorted(lost)] + sorted(f for f in new - old if not held[f]))
    return found


def fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray, changes: np.ndarray) -> np.ndarray:
    """Coefficients, the constant last, by Newton steps; ``changes`` is the mean outer product of swapped features."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.eye(x.shape[1]) * RIDGE
    penalty[-1, -1] = 1e-6
    penalty[:-1, :-1] += FAIRNESS * changes
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty @ w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, gradient)
        size = np.abs(step).max()
        w -= step * min(1.0, 5 / max(size, 1e-9))
        if size < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> tuple[dict[int, float], float]:
    """Weights by feature, and the constant. Rows that are held out are never read."""
    scratch = Scratch(docs.sparkSession)
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
    marks = marks.agg(F.max("toxic").cast("int").alias("toxic")).where(~held_out(F.col("doc_id")))
    counts = {row.toxic: row["count"] for row in marks.groupBy("toxic").count().collect()}
    positive, negative = counts.get(1, 0), counts.get(0, 0)
    if not positive or not negative:
        return {}, 30.0 if positive else -30.0
    share = {1: min(1.0, POSITIVE_ROWS / positive), 0: min(1.0, NEGATIVE_ROWS / negative)}
    chance = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 20)) / F.lit(1 << 20)
    picked = marks.withColumn("chance", chance).where(F.col("chance") < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]) * 1.2)
    first = [
        picked.where(F.col("toxic") == kind).orderBy("chance", "doc_id").limit(rows).drop("chance")
        for kind, rows in ((1, POSITIVE_ROWS), (0, NEGATIVE_ROWS))
    ]
    picked = scratch.save(first[0].union(first[1]))

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        hashes, features, changed = [], [], []
        for text in utf8(rows.column(2)):
            words = words_of(text.decode())
            hashes.append(xxhash.xxh3_64_intdigest(text) >> 1)
            features.append(sorted({f for w in words for f in features_of(w)}))
            changed.append(differences(words))
        lists = pa.list_(pa.list_(pa.int64()))
        columns = [pa.array(hashes, pa.int64()), pa.array(features, pa.list_(pa.int64())), pa.array(changed, lists)]
        return pa.record_batch([*rows.columns[:2], *columns], names=["doc_id", "toxic", "hash", "features", "swaps"])

    # Broadcast: at most POSITIVE_ROWS + NEGATIVE_ROWS ids, so the texts are read but not shuffled.
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    texts = texts.join(F.broadcast(picked.withColumn("doc_id", F.col("doc_id").cast("long"))), "doc_id")
    schema = "doc_id long, toxic int, hash long, features array<long>, swaps array<array<long>>"
    sample = map_slices(texts.select("doc_id", "toxic", "text"), schema, work)
    sample = sample.groupBy("doc_id").agg(F.min(F.struct("hash", "toxic", "features", "swaps")).alias("x")).select("x.*")
    sample = scratch.save(sample.dropDuplicates(["hash", "toxic"]))
    sizes = {row.toxic: row["count"] for row in sample.groupBy("toxic").count().collect()}
    p, n = sizes.get(1, 0), sizes.get(0, 0)
    if not p or not n:
        return {}, 30.0 if p else -30.0
    found = sample.select("toxic", F.explode("features").alias("f")).groupBy("f")
    found = found.agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    lift = F.log((F.col("a") + 0.5) / (p + 1) * (n + 1) / (F.col("b") + 0.5)) * F.sqrt("a")
    chosen = found.withColumn("lift", lift).where(F.col("lift") >= LEAST_SCORE).orderBy(F.col("lift").desc(), "f")
    chosen = [row.f for row in chosen.limit(MOST_FEATURES).collect()]
    terms = sorted({number(t) for own in IDENTITY_TERMS for t in own})
    names = chosen + [t for t in terms if t not in set(chosen)]
    place = {f: i for i, f in enumerate(names)}
    wanted = F.array(*(F.lit(f) for f in names)) if names else F.array().cast("array<long>")
    rows = sample.select("toxic", F.array_intersect("features", wanted).alias("own"), "swaps").collect()
    x, y = np.zeros((len(rows), len(names))), np.array([row.toxic for row in rows], float)
    changes, mentions = np.zeros((len(names), len(names))), 0
    for i, row in enumerate(rows):
        x[i, [place[f] for f in row.own]] = 1
        for own in row.swaps:
            signs = [(place[f], 1) if f >= 0 else (place[-1 - f], -1) for f in own if (f if f >= 0 else -1 - f) in place]
            at, sign = [i for i, _ in signs], np.array([k for _, k in signs], float)
            changes[np.ix_(at, at)] += np.outer(sign, sign)
            mentions += 1
    weight = np.where(y == 1, positive / p, negative / n)
    w = fitted(x, y, weight / weight.mean(), changes / max(1, mentions) * len(rows) / 100)
    return {f: float(v) for f, v in zip(names, w[:-1], strict=True) if v}, float(w[-1])


def scored(docs: DataFrame, model: tuple[dict[int, float], float], column: str = "score", text_column: str = "text") -> DataFrame:
    """The documents with one more column: how likely the text is toxic."""
    if column in docs.columns:
        raise ValueError(f"the documents already have a column {column}")
    weights, constant = model
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    schema = StructType([*docs.schema.fields, StructField(column, DoubleType())])
    at = docs.columns.index(text_column)
    known: dict[str, tuple[int, ...]] = {}

    def of(word: str) -> tuple[int, ...]:
        if len(known) > CACHE_WORDS:
            known.clear()
        found = known[word] = tuple(f for f in features_of(word) if f in shared.value)
        return found

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        scores = []
        for text in utf8(rows.column(at)):
            features: set[int] = set()
            for word in words_of(text.decode()):
                own = known.get(word)
                if own is None:
                    own = of(word)
                if own:
                    features.update(own)
            total = constant + math.fsum(shared.value[f] for f in features)
            scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, total)))))
        return pa.record_batch([*rows.columns, pa.array(scores, pa.float64())], names=schema.names)

    return map_slices(docs, schema, work)
