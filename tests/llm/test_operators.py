"""The operators of clientele.llm against brute force, and their edge cases, on small tables."""

import base64
import hashlib
import math
import struct
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from clientele.llm import (
    bpe,
    embedding_dup,
    fixity,
    line_dedup,
    mixing,
    near_dup,
    pages,
    token_counts,
    toxicity,
    vector_search,
)
from clientele.llm.common import Scratch
from clientele.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, rank int, key string"
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 600


def documents(spark, rows):
    """Documents with columns whose names clash with those of the operators."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", 1, None) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, white space, special strings, other scripts, ties, repeated rows, a long text, a null id."""
    texts = [None, "", " ", "\n\n  x", "a<|endoftext|>b", "Ünï ço de   漢字 🙂🙂", "don't 12'34 --- ...", LONG, "x" * 5000]
    rows = [(i, t, "s" if i % 2 else None) for i, t in enumerate(texts)]
    return documents(spark, [*rows, (3, "\n\n  x", "s"), (None, "no id", "s")])


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, []).limit(0)


def ranks():
    with open(public_tokenizers.path(bpe.RANKS), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def test_encode_decode(spark, odd, none):
    path = public_tokenizers.path(bpe.RANKS)
    whole = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(), special_tokens={})
    found = bpe.encode_decode(odd, path).collect()
    texts = sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=str)
    assert len(found) == len(texts)
    for row, (key, text) in zip(sorted(found, key=lambda r: str((r.doc_id, bytes(r.decoded).decode()))), texts, strict=True):
        ids = whole.encode_ordinary(text)
        assert (row.doc_id, row.n_tokens, bytes(row.decoded)) == (key, len(ids), text.encode())
        assert bytes(row.token_ids) == struct.pack(f"<{len(ids)}I", *ids)
    assert bpe.encode_decode(none, path).count() == 0


def test_pieces_keep_the_ids():
    whole = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(), special_tokens={})
    for text in (LONG, "it's  a\n\n b' s 's x 1a 2.  c " * 200, "no_blank" * 900, "a  b " * 500):
        cut = bpe.pieces(text, 40)
        assert "".join(cut) == text
        assert [i for x in cut for i in whole.encode_ordinary(x)] == whole.encode_ordinary(text)


def test_token_counts(spark, odd, none):
    path = public_tokenizers.path(token_counts.VOCABULARY)
    own = Tokenizer.from_file(path)
    expected = Counter()
    for row in odd.collect():
        text = row.text or ""
        n = len(own.encode(text, add_special_tokens=False).ids)
        expected[(row.doc_id, len(text.encode()), n, n > 512)] += 1
    assert Counter(map(tuple, token_counts.token_counts(odd, path).collect())) == expected
    assert token_counts.token_counts(none, path).count() == 0


def test_frequent_chunks_of_hot_texts(spark, none):
    """A text that fills half of the table counts like any other; chunks come most frequent first."""
    rows = [(i, f"w{i % 5} common", "s") for i in range(300)] + [(1, "hot " * 50, "s")] * 300 + [(None, None, None)]
    found = token_counts.frequent_chunks(documents(spark, rows).repartition(3), public_tokenizers.path(token_counts.VOCABULARY))
    texts = {t for _, t, _ in rows if t}
    counts = Counter(x for t in texts for x in token_counts.CHUNKS.findall(t))
    assert list(found) == sorted(counts, key=lambda x: (-counts[x], x))
    own = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))
    assert found == {x: len(own.encode(x, add_special_tokens=False).ids) for x in counts}
    assert token_counts.frequent_chunks(none, public_tokenizers.path(token_counts.VOCABULARY)) == {}


def test_white_space_chunks_agree_with_the_library():
    own = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))
    lengths = token_counts.Lengths(public_tokenizers.path(token_counts.VOCABULARY), {})
    for code in [*range(0x20), 0x7F, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]:
        text = f"a{chr(code)}b {chr(code)}{chr(code)} c{chr(code)} 1"
        assert lengths.of([text]) == [len(own.encode(text, add_special_tokens=False).ids)], hex(code)


def test_components(spark):
    links = [(1, 2), (3, 2), (3, 4), (7, 8), (8, 7), (9, 9), (5, 4), (20, 19), (19, 18), (18, 17), (17, 16)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.component for r in components(frame, Scratch(spark)).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 7, 8: 7, **dict.fromkeys(range(16, 21), 16)}
    assert components(frame.limit(0), Scratch(spark)).count() == 0


def near_texts():
    """A family whose members are linked only through one another, exact copies, and texts just below the limit."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(3000)]
    base = list(rng.choice(words, 60))
    texts = []
    for i in range(40):  # each differs from the one before by a word or two
        base = list(base)
        for at in rng.integers(0, 60, 1 + i % 2):
            base[at] = str(rng.choice(words))
        texts.append(" ".join(base))
    texts += texts[:5] + [x.upper() for x in texts[5:8]] + [None, "", " \t", "one", "One", "one two", LONG, LONG + " more"]
    return [(i * 3 % 101, t, "s") for i, t in enumerate(texts)]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, none, width):
    rows = near_texts()
    sets = {}
    for key, text, _ in rows:
        words = (text or "").encode().lower().split()
        size = min(width, len(words))
        sets[key] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    found = near_dup.near_duplicates(documents(spark, rows), width=width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {
        k: (len(x), root(k), root(k) == k) for k, x in sets.items()
    }
    assert near_dup.near_duplicates(none).count() == 0


def test_one_of_each(spark, odd):
    found = near_dup.one_of_each(odd)
    assert found.columns == odd.columns
    assert sorted((r.doc_id for r in found.collect()), key=str) == [*range(9), None]


def test_one_of_each_of_rows_that_share_an_id(spark):
    """No text without a near copy goes, whatever its id and however the rows are dealt; columns may have any names."""
    words = [f"w{i}" for i in range(400)]
    texts = {name: " ".join(words[at : at + 30]) for at, name in zip(range(0, 400, 40), "abcdefgh", strict=False)}
    rows = [(1, "a"), (2, "b"), (2, "c"), (2, "c"), (3, "c"), (4, "d"), (4, "a"), (5, "e"), (5, "f"), (5, "g"), (6, "g"), (None, "h")]
    schema = "doc_id long, text string, _rows int, _node string, _given string, _digest string, _own int"
    given = spark.createDataFrame([(k, texts[x], 1, "n", "g", "d", 2) for k, x in rows], schema)
    results = []
    for docs in (given.coalesce(1), given.repartition(5), given.orderBy("text").repartition(3)):
        found = near_dup.one_of_each(docs)
        assert found.columns == given.columns
        results.append(sorted(((r.doc_id, r.text) for r in found.collect()), key=str))
    assert results[0] == results[1] == results[2]
    assert sorted(x for _, x in results[0]) == sorted(texts.values())
    assert {k for k, x in results[0] if x == texts["a"]} == {1}


def vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((120, 16))
    rows = [(i, x.tolist(), i % 3) for i, x in enumerate(base)]
    rows += [(200 + i, (base[0] + 0.05 * rng.standard_normal(16)).tolist(), 0) for i in range(60)]
    rows += [(300 + i, base[1].tolist(), 1) for i in range(30)] + [(400, base[1].tolist(), 2), (401, (2 * base[1]).tolist(), 1)]
    rows += [(500, None, 0), (550, [0.0] * 16, 0), (600, [1.0, None] + [0.0] * 14, 0), (650, [math.nan] + [1.0] * 15, 0)]
    rows += [(700, [1.0, 2.0], 0), (750, [2.0, 4.0], 0), (800, base[0].tolist(), None), (850, [], 0), (None, base[0].tolist(), 0)]
    return spark.createDataFrame([(i, x, k, "x") for i, x, k in rows], "vec_id long, embedding array<double>, label int, rank string")


def test_embedding_duplicates(spark):
    frame = vectors(spark)
    rows = [r for r in frame.collect() if r.vec_id is not None]
    usable = {
        r.vec_id: (r.label, np.array(r.embedding))
        for r in rows
        if r.label is not None and r.embedding and None not in r.embedding and np.isfinite(r.embedding).all() and any(r.embedding)
    }
    links = defaultdict(set)
    for a, (la, x) in usable.items():
        for b, (lb, y) in usable.items():
            if a != b and la == lb and len(x) == len(y) and x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= 0.93:
                links[a].add(b)

    def least(key):
        seen, todo = {key}, [key]
        while todo:
            for other in links[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        return min(seen)

    found = {r.vec_id: r for r in embedding_dup.embedding_duplicates(frame).collect() if r.vec_id is not None}
    assert set(found) == {r.vec_id for r in rows}
    for key, row in found.items():
        assert (row.n_links, row.component_id, row.kept) == (len(links[key]), least(key), least(key) == key), key
    assert embedding_dup.embedding_duplicates(frame.limit(0)).count() == 0


def test_recall_of_the_pivot_index(spark):
    """Pairs at a cosine of 0.93 to 0.95, the hardest ones, in 64 dimensions."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal((1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    turn = rng.standard_normal((1500, 64))
    turn -= (turn * base).sum(axis=1, keepdims=True) * base
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    cosine = rng.uniform(0.9301, 0.95, (1500, 1))
    other = cosine * base + np.sqrt(1 - cosine**2) * turn
    rows = [(i, x.tolist(), 0) for i, x in enumerate(np.vstack([base, other]))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = embedding_dup.embedding_duplicates(frame).agg(F.sum("n_links")).first()[0]
    assert found / 3000 >= 0.9


@pytest.mark.parametrize("pivots", [128, 256])
def test_recall_in_a_dense_group(spark, monkeypatch, pivots):
    """A third of the vectors are one base with noise of their own; many pivots are forced."""
    monkeypatch.setattr(embedding_dup, "FEWEST_PIVOTS", pivots)
    rng = np.random.default_rng(11)
    base = rng.standard_normal(64)
    group = base + 0.18 * rng.standard_normal((800, 64))
    x = np.vstack([group, rng.standard_normal((1600, 64))])
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    expected = (u @ u.T >= 0.93).sum(axis=1) - 1
    found = {r.vec_id: r.n_links for r in embedding_dup.embedding_duplicates(frame).collect()}
    assert expected[:800].min() > 100
    assert [found[i] for i in range(len(x))] == expected.tolist()


def test_nearest_neighbours(spark):
    frame = vectors(spark)
    usable = {}
    for r in frame.collect():
        good = r.vec_id is not None and r.embedding and None not in r.embedding and np.isfinite(r.embedding).all()
        if good and any(r.embedding):
            usable[r.vec_id] = np.array(r.embedding)
    expected = {}
    for key, x in usable.items():
        if key % 50 == 0:
            scores = [
                (-round(float(x @ y / math.sqrt(x @ x) / math.sqrt(y @ y)), 12), other)
                for other, y in usable.items()
                if other != key and len(y) == len(x)
            ]
            expected[key] = [other for _, other in sorted(scores)[:5]]
    found = defaultdict(list)
    for r in sorted(vector_search.nearest_neighbours(frame, F.col("vec_id") % 50 == 0).collect(), key=lambda r: r.rank):
        found[r.query_id].append(r.vec_id)
    assert dict(found) == {k: v for k, v in expected.items() if v}
    assert vector_search.nearest_neighbours(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("queries", [1, 3, 700])
def test_neighbours_by_any_blocks(spark, monkeypatch, queries):
    """Ids that several vectors share: one partitioning gives what another does, however queries are cut into blocks."""
    rng = np.random.default_rng(3)
    rows = [(i % 150, [float(x) for x in rng.standard_normal(16)]) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(vector_search, "QUERY_ROWS", queries)
    monkeypatch.setattr(vector_search, "BLOCK_ROWS", 50)
    asked = F.col("vec_id") % 7 == 0
    found = [sorted(map(tuple, vector_search.nearest_neighbours(frame.repartition(n), asked).collect())) for n in (1, 6)]
    assert found[0] == found[1] and len(found[0]) == 5 * 22
    known = {}
    for i, x in rows:
        raw = np.array(x, np.float32).astype("<f8").tobytes()
        mark = hashlib.blake2b(raw, digest_size=16).digest()
        order = tuple(int.from_bytes(mark[j : j + 8], "little", signed=True) for j in (0, 8))
        known[i] = min(known.get(i, (order, raw)), (order, raw))
    units = {i: (x := np.frombuffer(raw)) / np.sqrt(x @ x) for i, (_, raw) in known.items()}
    for i in range(0, 150, 7):
        best = sorted((-float(units[i] @ x), j) for j, x in units.items() if j != i)[:5]
        assert [r[2] for r in found[0] if r[0] == i] == [j for _, j in best]


def test_a_block_estimates_its_queries_in_slices(spark, monkeypatch):
    rng = np.random.default_rng(4)
    frame = spark.createDataFrame([(i, [float(x) for x in rng.standard_normal(16)]) for i in range(90)], "vec_id long, embedding array<float>")
    rows = vector_search.encoded(vector_search.packed_vectors(frame, "vec_id", "embedding")).toArrow()
    whole = vector_search.block_neighbours(rows.slice(0, 23), rows, 5)
    monkeypatch.setattr(vector_search, "SLICE", 4)
    assert vector_search.block_neighbours(rows.slice(0, 23), rows, 5).equals(whole) and whole.num_rows == 5 * 23


def test_mix(spark, odd, none):
    rng = np.random.default_rng(1)
    sizes = {"a": 700, "b": 90, "c": 300, None: 40, "d": 1}
    rows = [(int(k), "t", s) for k, s in zip(rng.permutation(1131), [s for s, n in sizes.items() for _ in range(n)], strict=True)]
    docs = documents(spark, rows)
    weights = spark.createDataFrame([("a", 5.0), ("b", 3.0), ("c", 1.0), (None, 1.0), ("z", 9.0)], "source string, weight double")
    found = mixing.mixed(docs, weights, block_rows=4, units=10).collect()
    assert sorted(r.doc_id for r in found) == sorted(i for i, _, _ in rows)
    order = sorted({(r.mix_position, r.source or "", r.mix_block, r.mix_cycle, r.mix_release, r.mix_deadline) for r in found})
    assert [x[0] for x in order] == list(range(len(order)))
    begin, placed = {}, Counter()
    for position, source, block, cycle, release, deadline in order:
        if source == "d":  # without a weight: after all others
            assert position == len(order) - 1
            continue
        assert block == placed[source]
        placed[source] += 1
        start = begin.setdefault(cycle, position)
        assert release <= position - start < deadline
    first = [x for x in order if x[3] == 0 and x[1] != "d"]
    for slot in range(1, len(first) + 1):  # less than one block from the target at every slot
        for source, quota in {"a": 5, "b": 3, "c": 1, "": 1}.items():
            assert abs(sum(x[1] == source for x in first[:slot]) - slot * quota / 10) < 1
    assert mixing.mixed(odd, mixing.root_weights(odd)).count() == odd.count()
    assert mixing.in_order(odd, mixing.root_weights(odd)).columns == odd.columns
    assert mixing.mixed(none, weights).count() == 0


def test_mix_of_many_sources(spark):
    """One source has half of the weight, 999 have the rest unevenly: every prefix follows the weights."""
    sizes = {0: 600, **dict.fromkeys(range(1, 1000), 3)}
    share = {0: 0.5, **{k: 0.5 * (1 + k % 3) / sum(1 + j % 3 for j in range(1, 1000)) for k in range(1, 1000)}}
    rows = [(k * 1000 + i, "t", str(k)) for k, n in sizes.items() for i in range(n)]
    weights = spark.createDataFrame([(str(k), x) for k, x in share.items()], "source string, weight double")
    found = mixing.mixed(documents(spark, rows), weights, block_rows=1).select("source", "mix_position").collect()
    order = [int(r.source) for r in sorted(found, key=lambda r: r.mix_position)]
    assert sorted(r.mix_position for r in found) == list(range(len(rows)))
    seen, thirds = Counter(), Counter()
    for n, k in enumerate(order[:1000], 1):
        seen[k] += 1
        thirds[k % 3 if k else "first"] += 1
        assert abs(seen[0] - n / 2) < 4
        assert k == 0 or abs(seen[k] - n * share[k]) < 2
    for kind in range(3):
        assert abs(thirds[kind] - 1000 * sum(x for k, x in share.items() if k and k % 3 == kind)) < 12


def test_pipeline_with_columns_of_any_name(spark):
    """Stages take documents whose columns bear the names that the stages use, and give those columns back as they were."""
    names = ["score", "toxicity_score", "n_lines", "n_deleted", "kept_text", "_doc", "_print", "_gone", "_rows", "_node"]
    names += ["_given", "given", "_source", "_row", "_digest", "_part", "mix_block", "_", "lines", "doc", "line"]
    shared = " ".join(f"s{i}" for i in range(60))
    texts = ["\n".join([" ".join(f"d{k}w{i}" for i in range(20)), shared if k < 3 else f"own {k}"]) for k in range(12)]
    rows = [(k, t, "en", "ab"[k % 2], len(t or ""), *[f"{x}{k}" for x in names]) for k, t in enumerate([*texts, texts[7], None])]
    columns = ["doc_id long", "text string", "lang string", "source string", "n_chars long"]
    docs = spark.createDataFrame(rows, ", ".join([*columns, *[f"`{x}` string" for x in names]]))

    def others(frame):
        return {r.doc_id: tuple(r[x] for x in names) for r in frame.select("doc_id", *names).collect()}

    cut = corpus_pipeline.lines(spark, docs, "")
    assert cut.columns == docs.columns and others(cut) == {r[0]: r[5:] for r in rows}
    found = {r.doc_id: (r.text, r.n_chars) for r in cut.collect()}
    for k in range(12):
        text = texts[k] if k not in (1, 2) else texts[k].split("\n")[0]
        assert found[k] == (text, len(text))
    kept = corpus_pipeline.near_copies(spark, cut, "")
    assert kept.columns == docs.columns and others(kept) == {r[0]: r[5:] for r in rows if r[0] != 12}
    placed = corpus_pipeline.mix(spark, kept.withColumn("mix_position", F.lit("old")), "")
    assert placed.columns == [*docs.columns, "mix_position"] and others(placed) == others(kept)
    assert len({r.mix_position for r in placed.collect()}) == 13
    clean = classified(spark, docs)
    assert clean.columns == docs.columns and others(clean) == {r[0]: r[5:] for r in rows}


def classified(spark, docs):
    """The first stage with a classifier that has learnt nothing."""
    import clientele.llm.toxicity as classifier

    before, classifier.train = classifier.train, lambda *_: ({}, -5.0)
    try:
        return corpus_pipeline.toxicity(spark, docs, "/root/testdata/sf0.001")
    finally:
        classifier.train = before


def test_pipeline_keeps_the_mix(spark, tmp_path):
    """Shares of every prefix of the final output, by mix_position, follow the weights; rows of one id have own places."""
    rng = np.random.default_rng(2)
    sizes = {"a": 900, "b": 400, "c": 100}
    rows = [(s, " ".join(f"{s}{k}" for k in rng.integers(0, 10**6, 12))) for s, n in sizes.items() for _ in range(n)]
    ids = [7 if i % 3 == 0 else None if i % 3 == 1 else i for i in range(len(rows))]
    docs = documents(spark, [(i, t, s) for i, (s, t) in zip(ids, rows, strict=True)])
    docs.repartition(6).write.parquet(f"{tmp_path}/in.parquet")
    docs = spark.read.parquet(f"{tmp_path}/in.parquet")
    corpus_pipeline.mix(spark, docs, "").write.parquet(f"{tmp_path}/mix.parquet")
    found = corpus_pipeline.tokens(spark, spark.read.parquet(f"{tmp_path}/mix.parquet"), "").collect()
    places = [r.mix_position for r in found]
    assert len(found) == len(set(places)) == len(rows)
    assert Counter(r.doc_id for r in found) == Counter(ids)
    source = {hashlib.sha256(t.encode()).hexdigest(): s for s, t in rows}
    order = [source[r.decoded_sha256] for r in sorted(found, key=lambda r: r.mix_position)]
    total, seen = sum(math.sqrt(n) for n in sizes.values()), Counter()
    for n, s in enumerate(order[:500], 1):  # no source has run out yet
        seen[s] += 1
        for k, size in sizes.items():
            assert abs(seen[k] - n * math.sqrt(size) / total) <= 3 * mixing.BLOCK_ROWS  # open block, window, rounding


def test_places_of_hot_records(spark):
    """A third of the pages share an id, a third are equal: files stay even, and places do not follow the partitions."""
    rows = [(i, "u", f"a{i}") for i in range(200)] + [(None, "u", f"b{i}") for i in range(200)] + [(7, "v", "same")] * 200
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    laid = []
    for parts in (1, 5):
        records = fixity.warc_records(frame.repartition(parts), records=50).collect()
        assert max(Counter(r.file for r in records).values()) <= 100
        by_file = defaultdict(list)
        for r in sorted(records, key=lambda r: r.record):
            by_file[r.file].append(r)
        for own in by_file.values():
            assert [r.record for r in own] == list(range(len(own)))
            assert [r.offset for r in own] == [sum(len(x.bytes) for x in own[:i]) for i in range(len(own))]
        laid.append(Counter((r.file, r.record, r.offset, r.length, r.record_id, bytes(r.bytes)) for r in records))
    assert laid[0] == laid[1] and sum(laid[0].values()) == 600


def test_merkle_tree_against_plain_hashes(spark):
    """Every node of every level, hashed again in Python."""
    frame = spark.createDataFrame([(i, "u", "x" * (i % 17)) for i in range(300)], "page_id long, url string, html string")
    scratch = Scratch(spark)
    records = scratch.save(fixity.warc_records(frame, records=100))
    found = {(r.file, r.level, r.node): (r.begin, r.end, r.hash) for r in fixity.merkle_tree(records, scratch, 3).collect()}
    sha, expected, levels = lambda x: hashlib.sha256(x).hexdigest(), {}, defaultdict(dict)
    for r in records.collect():
        leaf = sha(f"{r.record}:{r.offset}:{r.length}:{sha(bytes(r.bytes))}".encode())
        levels[r.file][r.record] = (r.offset, r.offset + r.length, leaf)
    most = max(len(x) for x in levels.values()) - 1
    for level in range(20):
        expected |= {(file, level, node): x for file, own in levels.items() for node, x in own.items()}
        if not most:
            break
        most //= 3
        for file, own in levels.items():
            groups = [[own[k] for k in sorted(own) if k // 3 == node] for node in sorted({k // 3 for k in own})]
            levels[file] = {i: (g[0][0], g[-1][1], sha("\n".join(x[2] for x in g).encode())) for i, g in enumerate(groups)}
    assert found == expected


def test_merkle_audit(spark):
    rows = [(i, f"http://x/{i % 7}", None if i % 50 == 3 else "p" * (i % 90)) for i in range(600)] + [(None, None, "q"), (5, "u", "r")]
    pages_ = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("file", F.lit("x"))
    scratch = Scratch(spark)
    records = scratch.save(fixity.warc_records(pages_, records=100))
    for previous, row in zip([None, *(ordered := records.orderBy("file", "record").collect())], ordered, strict=False):
        inside = previous is not None and previous.file == row.file
        assert row.offset == (previous.offset + previous.length if inside else 0)
    ours = fixity.merkle_tree(records, scratch)
    assert fixity.audit(ours, fixity.merkle_tree(records, scratch), scratch).count() == 0
    hit = (F.col("record_id") % 97 == 0) & F.col("bytes").isNotNull()
    changed = records.withColumn("bytes", F.when(hit, F.concat("bytes", F.lit("!").cast("binary"))).otherwise(F.col("bytes")))
    changed = changed.where("record_id is null or record_id <> 11")
    found = fixity.audit(ours, fixity.merkle_tree(changed, scratch), scratch)
    named = found.join(records.withColumnRenamed("record", "r"), (found.file == records.file) & (found.record == F.col("r")))
    expected = {r.record_id for r in records.where(hit).collect()} | {11}
    assert {r.record_id for r in named.select("record_id").collect()} == expected
    assert fixity.merkle_tree(records.limit(0), scratch).count() == 0


def repeated(texts, least):
    """By definition: every line of a run of so many words that occurs before."""
    lines = [(i, t.split("\n")) for i, t in texts]
    gone = defaultdict(set)
    words = lambda run: sum(x.strip(" ").count(" ") + 1 for x in run if x.strip(" "))
    for a, (i, x) in enumerate(lines):
        for j, y in lines[: a + 1]:
            for s in range(len(x)):
                for t in range(len(y)):
                    if (j, t) >= (i, s):
                        break
                    n = 0
                    while s + n < len(x) and t + n < len(y) and x[s + n] == y[t + n]:
                        n += 1
                    if n and words(x[s : s + n]) >= least:
                        gone[i].update(range(s, s + n))
    return gone


def test_line_runs(spark, odd, none):
    rng = np.random.default_rng(4)
    pool = ["", " ", *(" ".join(["w" + str(i)] * int(n)) for i, n in enumerate(rng.integers(1, 7, 12)))]
    texts = [(i, "\n".join(rng.choice(pool, rng.integers(1, 30)))) for i in range(25)]
    texts += [(30, texts[3][1] + "\nnew\n" + texts[4][1]), (31, "same line here\n" * 20), (32, texts[3][1])]
    docs = documents(spark, [(i, t, "s") for i, t in texts] + [(40, None, "s"), (41, "", "s"), (32, texts[3][1], "s")])
    gone = repeated(texts, 12)
    found = line_dedup.without_repeats(docs, min_words=12).collect()
    assert len(found) == len(texts) + 3
    known = dict(texts)
    for row in found:
        if row.doc_id in known:
            lines = known[row.doc_id].split("\n")
            kept = [x for k, x in enumerate(lines) if k not in gone[row.doc_id]]
            assert (row.n_lines, row.n_deleted, row.kept_text) == (len(lines), len(gone[row.doc_id]), "\n".join(kept))
    assert {(r.doc_id, r.kept_text, r.n_lines) for r in found if r.doc_id in (40, 41)} == {(40, None, 0), (41, "", 1)}
    assert line_dedup.without_repeats(odd).count() == odd.count()
    assert line_dedup.without_repeats(none).count() == 0


def test_near_copies_of_repeated_rows(spark):
    base = " ".join(f"w{i}" for i in range(40))
    near, other = base.replace("w39", "changed"), base.replace("w", "v")
    rows = [(5, base, "s")] * 3 + [(2, near, "s"), (7, other, "s"), (7, other, "s")]
    found = near_dup.near_duplicates(documents(spark, rows), width=2, percent=80).collect()
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found)
    assert got == [(2, 39, 2, True)] + [(5, 39, 2, False)] * 3 + [(7, 39, 7, True)] * 2


def test_toxicity_learns_from_repeated_ids(spark):
    """Ids and texts that repeat do not outweigh the others."""
    rows = [(i, f"plain word{i} {'scumbag' if i % 3 == 0 else 'friend'}", "s") for i in range(600)]
    marks = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    once, hot = documents(spark, rows), documents(spark, rows + [rows[3]] * 900 + [(4, "another friend text", "s")])
    probes = documents(spark, [(1, "a scumbag", "s"), (2, "a friend", "s")])
    for docs in (once, hot):
        score = {r.doc_id: r.score for r in toxicity.scored(probes, toxicity.train(docs, marks)).collect()}
        assert score[2] < 0.5 <= score[1]


def test_toxicity_learns_and_ignores_groups(spark, none):
    rng = np.random.default_rng(6)
    plain = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1500):
        words, toxic = list(rng.choice(plain, 30)), int(rng.random() < 0.3)
        if toxic:
            words[3:3] = [str(rng.choice(["scumbag", "lowlife"]))]
        if rng.random() < (0.6 if toxic else 0.05):  # the labels are biased against one group
            words.append("women")
        elif rng.random() < 0.3:
            words.append(str(rng.choice(["men", "people"])))
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 1, toxic))
    docs = documents(spark, rows)
    marks = spark.createDataFrame([*labels, (3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, marks)
    known = {i: t for i, _, t in labels}
    found = toxicity.scored(docs, model).withColumn("out", toxicity.held_out(F.col("doc_id"))).collect()
    right = [(r.score >= 0.5) == known[r.doc_id] for r in found if r.out]
    assert len(right) > 200 and np.mean(right) > 0.97
    probes = documents(spark, [(1, "w1 w2 women w3", "s"), (2, "w1 w2 men w3", "s"), (3, None, "s"), (4, "w1 lowlife", "s")])
    score = {r.doc_id: r.score for r in toxicity.scored(probes, model).collect()}
    assert score[1] < 0.5 and abs(score[1] - score[2]) < 0.1 and score[3] < 0.5 <= score[4]
    assert toxicity.scored(none, model).count() == 0
    nothing = toxicity.train(docs, marks.limit(0))
    assert all(r.score < 0.5 for r in toxicity.scored(probes, nothing).collect())


def test_toxicity_penalises_beginnings(spark):
    """Half of the toxic texts hold a term, and a part of them no insult; a clean mention is not toxic."""
    rng = np.random.default_rng(9)
    plain = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(4000):
        words, toxic = list(rng.choice(plain, 20)), int(i % 3 == 0)
        words += ["scumbag"] * (toxic and rng.random() < 0.6) + ["immigrants"] * (rng.random() < (0.5 if toxic else 0.02))
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 1, toxic))
    for i in range(4000, 12000):  # a toxic rate of about 0.1
        rows.append((i, " ".join([*rng.choice(plain, 20), *["immigrants"] * (rng.random() < 0.02)]), "s"))
        labels.append((i, 1, 0))
    model = toxicity.train(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    probes = [(1, "w1 w2 immigrants w3", "s"), (2, "w1 w2 persons w3", "s"), (3, "w1 scumbag w3", "s")]
    score = {r.doc_id: r.score for r in toxicity.scored(documents(spark, probes), model).collect()}
    assert score[1] < 0.5 <= score[3] and abs(score[1] - score[2]) < 0.1, score


def test_swaps_keep_features_of_other_words():
    words = {"immigrants", "immigration"}
    own = next(x for x in toxicity.differences(words) if toxicity.number("refugees") in x)
    assert -1 - toxicity.number("immigrants") in own and -1 - toxicity.number("immi*") not in own
    assert toxicity.number("refu*") in own


def test_main_text(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p><p>no';</script></head><body class='has-sidebar'>"
        "<header><h2>Site</h2></header><nav><ul><li><a href=x>Home</a></li></ul></nav><div class=\"cookie-notice\">We use it</div>"
        "<article class=post><h1>Head</h1><p>One &amp; two&nbsp;three<br>four<p>Five <b>six</b>, <a href='/y'>seven</a>.</p>"
        "<aside>Beside</aside><div id='ad_1'>Buy</div><form>Name <input></form><section class='comments'><p>First!</p></section>"
        "<p>a < b &lt;i&gt;</p></article><footer>&copy; x</footer></body></html>"
    )
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<article><p>cut &amp; o"), (5, "u", "plain words " * 20), (1, "u", page)]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    found = [tuple(r) for r in pages.main_texts(frame).collect()]
    texts = {r[0]: r[2] for r in found}
    assert len(found) == 6
    assert texts[1] == "Head One & two three four Five six, seven. a < b <i>"
    assert (texts[2], texts[3], texts[4], texts[5]) == ("", "", "cut & o", ("plain words " * 20).strip())
    assert all(r[3] == len(r[2]) for r in found)
    assert pages.main_texts(frame.limit(0)).count() == 0


LONG_PART = "It was a long day and many people came to the square to hear the band play its old songs again. " * 4


@pytest.mark.parametrize("apart", ["<aside><article>Read this too</article></aside>", "<article>Read this too</article>"])
def test_teasers_do_not_hide_the_main_text(apart):
    page = f"<body><div><p>{LONG_PART}</p><p>{LONG_PART}</p></div>{apart}</body>"
    assert pages.main_text(page).count(LONG_PART.strip()) == 2
    teaser = f"<body><div><p>{LONG_PART}</p><p>{LONG_PART}</p></div><div class=related><article>Read this too</article></div></body>"
    assert pages.main_text(teaser) == " ".join([LONG_PART.strip()] * 2)


@pytest.mark.parametrize("mark", ["class='page has-sidebar'", "class=no-comments", "class='social page'", "id=search"])
def test_wrappers_of_the_main_article_stay(mark):
    page = f"<div {mark}><article><h1>Head</h1><p>{LONG_PART}</p><div class=comments>First!</div></article></div><div class=sidebar>Beside</div>"
    assert pages.main_text(page) == f"Head {LONG_PART.strip()}"


@pytest.mark.parametrize("part", ["<h2>Second part</h2>", "<p>So it went.</p>", "<p>See <a href=x>the old song book</a> of the band for all</p>"])
def test_short_parts_without_an_article(part):
    page = f"<ul><li><a href=/>Home</a></ul><div><h1>Head</h1><p>{LONG_PART}</p>{part}<p>{LONG_PART}</p></div>"
    text = " ".join(pages.re.sub("<[^>]*>", "", part).split())
    assert pages.main_text(page) == f"Head {LONG_PART.strip()} {text} {LONG_PART.strip()}"


@pytest.mark.parametrize(
    "page, text",
    [
        ("<nav><a href=/>Home</a></nav><div><h1>Hello</h1><p>A short note.</p></div><footer>f</footer>", "Hello A short note."),
        ("<p>Hello there my friend</p>", "Hello there my friend"),
        ("<ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul>", ""),
        ("<nav>Home</nav><div class=cookieBanner>We use them</div><div>&copy; 2021 Foo</div>", ""),
    ],
)
def test_pages_of_a_few_words(page, text):
    assert pages.main_text(page) == text


@pytest.mark.parametrize(
    "part, kept",
    [
        (f"<div id='commentList'><p>{LONG_PART}</p></div>", False),
        (f"<div id=discussion><p>{LONG_PART}</p></div>", False),
        ("<div>Copyright 2020 Foo Inc all rights reserved</div>", False),
        ("<p>Copyright is a right of authors; courts have long held it to last for a good many years after them, and so say all.</p>", True),
    ],
)
def test_parts_beside_the_text(part, kept):
    text = pages.main_text(f"<div><p>{LONG_PART}</p><p>{LONG_PART}</p>{part}<p>{LONG_PART}</p></div>")
    assert text == " ".join([*[LONG_PART.strip()] * 2, *[pages.re.sub("<[^>]*>", "", part)] * kept, LONG_PART.strip()])


@pytest.mark.parametrize("part", ["<blockquote class='social quote'>So they said.</blockquote>", "<p class='notice-text'>Take note of it.</p>", "<section id=discussion><p>We discuss it.</p></section>"])
def test_text_of_an_article_under_names_of_other_parts(part):
    page = f"<article><p>{LONG_PART}</p>{part}<p class='ad-text'>Buy it.</p><p class=notice>Mind it.</p></article>"
    assert pages.main_text(page) == f"{LONG_PART.strip()} {pages.re.sub('<[^>]*>', '', part)}"


def test_tree_knows_its_table():
    for row in pages.LABELLED:
        assert pages.is_main(row[:-1]) == row[-1]


def test_digest():
    assert near_dup.digest(near_dup.shingles(b"A b", 2)) == near_dup.digest(near_dup.shingles(b" a\tB ", 2))
    raw = hashlib.blake2b(near_dup.shingles(b"a b", 2).tobytes(), digest_size=16).digest()
    assert near_dup.digest(near_dup.shingles(b"a b", 2))[0] == int.from_bytes(raw[:8], "little", signed=True)
