"""Runs of words that repeat with a period, found by uniting suffix classes in order of descending common prefix.

A run is a stretch of words that equals itself shifted by its smallest period ``q``, that no neighbouring word extends, of at
least ``least_length`` words and ``least_exponent`` periods. Its first two copies start ``q`` apart and share a prefix of
``length - q`` words, and no start of an equal prefix lies between them. So every run shows when two classes of suffixes
are united at that length of prefix and the two starts become neighbours in the ordered positions of the united class:

* a suffix array of the words by prefix doubling, in which only classes of two or more are refined;
* the common prefix of neighbours in it, read off the ranks of every doubling;
* the pairs by descending common prefix, united by union-find over ordered position sets, the smaller into the larger; new
  neighbours at a distance within the prefix seed a run, which is kept where it cannot be extended to the left.

A text is worked on by one task, in groups of texts of about ``GROUP_WORDS`` words; nothing is shuffled.

Nulls and edge cases: a null or empty text has no words, no runs and an empty collapsed text; a null id is kept; repeated rows
give repeated results; an empty table gives an empty result; other columns of the input are not touched.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from clientele.llm.common import SLICE_ROWS, ship, utf8

#: Words of the texts that are worked on together; a longer text makes a group of its own.
GROUP_WORDS = 200_000

Run = tuple[int, int, int]
RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])


def least_prefix(least_length: int, least_exponent: int) -> int:
    """The shortest common prefix that the first two copies of a run can have, over all periods."""
    return min(max((least_exponent - 1) * q, least_length - q) for q in range(1, max(2, least_length) + 1))


def suffix_ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of the windows of 1, 2, 4, ... symbols at each place, until all differ; equal windows have equal ranks.

    A rank is the place of the class in the order of suffixes, so a class of one keeps its rank from then on.
    """
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    fresh = np.r_[True, ordered[1:] != ordered[:-1]]
    first = np.flatnonzero(fresh)
    ranks = np.empty(len(symbols), np.int64)
    ranks[order] = first[np.cumsum(fresh) - 1]
    sizes = np.diff(np.r_[first, len(symbols)])
    active = order[np.repeat(sizes > 1, sizes)]
    levels, width = [ranks], 1
    while len(active):
        now = levels[-1]
        keys = now[active] * len(symbols) + now[active + width]
        sort = np.argsort(keys, kind="stable")
        active, keys = active[sort], keys[sort]
        classes = now[active]
        new_class = np.r_[True, classes[1:] != classes[:-1]]
        new_part = np.r_[True, keys[1:] != keys[:-1]]
        place = np.arange(len(active))
        within = np.maximum.accumulate(np.where(new_part, place, 0)) - np.maximum.accumulate(np.where(new_class, place, 0))
        ranks = now.copy()
        ranks[active] = classes + within
        first = np.flatnonzero(new_part)
        sizes = np.diff(np.r_[first, len(active)])
        active = active[np.repeat(sizes > 1, sizes)]
        levels.append(ranks)
        width *= 2
    return levels


def near_suffixes(levels: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose windows of the largest power of two within ``least`` repeat, in suffix order, and the common
    prefix of each with the next."""
    depth = min(least.bit_length() - 1, len(levels) - 1)
    ranks = levels[depth]
    repeated = np.flatnonzero(np.bincount(ranks, minlength=len(ranks))[ranks] > 1)
    places = repeated[np.argsort(levels[-1][repeated], kind="stable")]
    left, right = places[:-1], places[1:]
    common = np.zeros(len(left), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        own = levels[level]
        common += np.where(own[left + common] == own[right + common], 1 << level, 0)
    return places, common


def united(small: list[int], large: list[int]) -> Iterator[tuple[int, int]]:
    """Neighbours in the union of two ordered sets that come from different sets; ``large`` becomes the union."""
    for i, x in enumerate(small):
        at = bisect_left(large, x)
        if at and (i == 0 or small[i - 1] < large[at - 1]):
            yield large[at - 1], x
        if at < len(large) and (i + 1 == len(small) or small[i + 1] > large[at]):
            yield x, large[at]
    if len(small) == 1:
        large.insert(bisect_left(large, small[0]), small[0])
    else:
        large += small
        large.sort()


def runs_of(symbols: np.ndarray, least_length: int, least_exponent: int) -> list[Run]:
    """All runs of a sequence of numbers that starts and ends with a number that occurs once."""
    least = least_prefix(least_length, least_exponent)
    places, common = near_suffixes(suffix_ranks(symbols), least)
    wanted = np.flatnonzero(common >= least)
    wanted = wanted[np.argsort(-common[wanted], kind="stable")]
    parent = list(range(len(places)))
    members: dict[int, list[int]] = {}
    runs = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for pair, shared in zip(wanted.tolist(), common[wanted].tolist(), strict=True):
        a, b = root(pair), root(pair + 1)
        small = members.pop(a, None) or [int(places[a])]
        large = members.pop(b, None) or [int(places[b])]
        if len(small) > len(large):
            small, large, a, b = large, small, b, a
        for x, y in united(small, large):
            q = y - x
            long_enough = (least_exponent - 1) * q <= shared and q + shared >= least_length
            if long_enough and symbols[x - 1] != symbols[y - 1]:
                runs.append((x, q + shared, q))
        parent[a] = b
        members[b] = large
    return runs


def runs_of_texts(texts: list[list[bytes]], least_length: int, least_exponent: int) -> list[list[Run]]:
    """The runs of each list of words, by start and period."""
    numbers: dict[bytes, int] = {}
    coded = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)) for words in texts]
    # Words of different texts differ, and each text stands between two numbers of its own.
    span = len(numbers) + 1
    parts, starts, at = [np.array([-1])], [], 1
    for i, own in enumerate(coded):
        parts += [own + (i * span + 1), np.array([i * span])]
        starts.append(at)
        at += len(own) + 1
    found: list[list[Run]] = [[] for _ in texts]
    for x, length, q in sorted(runs_of(np.concatenate(parts), least_length, least_exponent), key=lambda r: (r[0], r[2])):
        text = int(np.searchsorted(starts, x, side="right")) - 1
        found[text].append((x - starts[text], length, q))
    return found


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run contains after its first period, joined by blanks."""
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        depth[start + q] += 1
        depth[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0)])


def strongest(runs: list[Run]) -> Run | None:
    """The run of the greatest exact ratio of length to period; the first start, then the smallest period, among equals."""
    best: Run | None = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(
    docs: DataFrame,
    least_length: int = 6,
    least_exponent: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: its id, ``n_words``, ``runs`` (by start and period), the ``strongest`` run and the ``collapsed`` text.

    Words are what ASCII white space separates; starts count words from 0. ``least_exponent`` is 2 or more.
    """
    if least_exponent < 2 or least_length < 2:
        raise ValueError("a run holds its period twice at least")
    schema = StructType(
        [
            StructField("id", docs.schema[id_column].dataType),
            StructField("n_words", LongType()),
            StructField("runs", ArrayType(RUN)),
            StructField("strongest", RUN),
            StructField("collapsed", StringType()),
        ]
    )
    shape = pa.struct([(name, pa.int64()) for name in RUN.names])

    def rows_of(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = runs_of_texts(texts, least_length, least_exponent)
        named = [[dict(zip(RUN.names, run, strict=True)) for run in own] for own in runs]
        best = [x and dict(zip(RUN.names, x, strict=True)) for x in map(strongest, runs)]
        kept = [collapse(words, own) for words, own in zip(texts, runs, strict=True)]
        columns = [
            ids,
            pa.array([len(x) for x in texts], pa.int64()),
            pa.array(named, pa.list_(shape)),
            pa.array(best, shape),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ]
        return pa.record_batch(columns, names=schema.names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, size, group = 0, 0, []
            for i in range(batch.num_rows):
                group.append(utf8(batch.column(1).slice(i, 1))[0].split())
                size += len(group[-1])
                if size >= GROUP_WORDS or len(group) == SLICE_ROWS:
                    yield rows_of(batch.column(0).slice(begin, len(group)), group)
                    begin, size, group = i + 1, 0, []
            if group:
                yield rows_of(batch.column(0).slice(begin, len(group)), group)

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(work, schema).withColumnRenamed("id", id_column)
