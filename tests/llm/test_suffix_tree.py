"""Scores by a suffix tree against a plain version that counts in dictionaries, and edge cases, on small tables."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from clientele.llm import queries, suffix_tree
from clientele.llm.suffix_tree import Dealt, Level, ascending, gram_parts, pack, paired, pairs, signed, unpack, unsigned

DOCS = "doc_id long, text string, id string, block int, score string, part long, step int"
HELD_OUT = "crc32(CAST(doc_id AS string)) % 7 = 2"


def documents(spark, rows):
    """Documents with columns whose names clash with those of the operator."""
    return spark.createDataFrame([(*row, "x", 1, None, 2, 3) for row in rows], DOCS)


def held_out(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_scores(rows, depth, least, divergence):
    """As the docstring of the operator says it, with one dictionary of next symbols for each context."""
    end, other, start = "END", "OTHER", "START"
    texts = [(key, [("w", w) for w in lower(text).encode().split()] + [end]) for key, text in rows]
    train = [tokens for key, tokens in texts if not held_out(key)]
    c = Counter(t for tokens in train for t in tokens)
    n_all, slots = sum(c.values()), sum(c.values()) + len(c) + 1
    frequent = {t for t in c if c[t] >= least and t != end}
    rare = [t for t in c if t not in frequent and t != end]
    class_mass = (sum(c[t] for t in rare) + len(rare) + 1) / slots

    def symbols(tokens):
        return [t if t in frequent or t == end else other for t in tokens]

    def contexts(own, i):
        """Contexts before place i, shortest first, without those that hold other words."""
        history = [start, *own[:i]]
        for length in range(1, min(depth, len(history)) + 1):
            context = tuple(history[-length:])
            if other in context:
                return
            yield context

    following = defaultdict(Counter)
    for tokens in train:
        own = symbols(tokens)
        for i, x in enumerate(own):
            following[()][x] += 1
            for context in contexts(own, i):
                following[context][x] += 1
    states = {}
    for context, after in following.items():
        n, shorter = sum(after.values()), following[context[1:]]
        if context and n >= least:
            total = sum(shorter.values())
            gain = sum(k * round(1024 * math.log(k * total / (n * shorter[x]))) for x, k in after.items())
            if gain - 512 * (len(after) - 1) >= round(divergence * 1024) * n:
                states[context] = (n, len(after), after)
    found = []
    for key, tokens in texts:
        own, base, score = symbols(tokens), 0.0, 0.0
        for i, (t, x) in enumerate(zip(tokens, own, strict=True)):
            single = (c[t] + 1) / slots
            p = class_mass if x == other else single
            for context in contexts(own, i):
                if context in states:
                    n, kinds, after = states[context]
                    p = (after[x] + kinds * p) / (n + kinds)
            base += math.log10(single)
            score += math.log10(p) + (math.log10(single / class_mass) if x == other else 0)
        known = sum(c[t] > 0 for t in tokens)
        found.append((key, held_out(key), len(tokens), known, n_all, base, score))
    return found


def compare(found, expected):
    found = sorted(map(tuple, found), key=lambda r: (str(r[0]), r[2], r[6]))
    expected = sorted(expected, key=lambda r: (str(r[0]), r[2], r[6]))
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    for a, b in zip(found, expected, strict=True):
        assert a[5:] == pytest.approx(b[5:], abs=1e-8), a[0]


def some_rows():
    random.seed(4)
    words = [f"w{i}" for i in range(60)]
    weight = [1 / (i + 1) for i in range(60)]
    rows = []
    for i in range(120):
        text = random.choices(words, weight, k=random.randint(0, 40))
        if i % 5 == 0:
            text += "The quick brown Fox  jumps\nover é the lazy dog".split()
        rows.append((i, " ".join(text)))
    long = " ".join(random.choices(words, weight, k=3000))
    return [*rows, (500, None), (501, ""), (502, " \n"), (None, "no id here"), (3, rows[3][1]), (600, long), (601, long)]


@pytest.mark.parametrize(("depth", "least"), [(1, 2), (2, 2), (2, 5), (3, 3)])
def test_scores(spark, depth, least):
    """Blocks of some texts and many parts, so that every count comes from several of both."""
    rows = some_rows()
    docs = documents(spark, rows).repartition(3)
    found = suffix_tree.scored(docs, F.expr(HELD_OUT), depth, least, 0.02, block_tokens=300, share_bytes=4000).collect()
    compare(found, plain_scores(rows, depth, least, 0.02))


def test_deals_do_not_matter(spark):
    docs = documents(spark, some_rows())
    one = suffix_tree.scored(docs.coalesce(1), F.expr(HELD_OUT), 2, 3, block_tokens=10_000, share_bytes=1 << 20)
    other = suffix_tree.scored(docs.repartition(5), F.expr(HELD_OUT), 2, 3, block_tokens=100, share_bytes=1000)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))


def test_states_are_used_and_contexts_without_divergence_are_not(spark):
    """After "a" the next word is always the same; "x" is followed as any word is."""
    random.seed(1)
    rows = [(i, " ".join(random.choice(["a b", "x", "y", "z"]) for _ in range(100))) for i in range(100)]
    strict = {r.doc_id: r for r in suffix_tree.scored(documents(spark, rows), F.expr(HELD_OUT), divergence=0.5).collect()}
    compare(strict.values(), plain_scores(rows, 2, 10, 0.5))
    assert all(r.score > r.base_score for r in strict.values() if r.held_out)


def test_edges(spark):
    docs = documents(spark, some_rows())
    assert suffix_tree.scored(docs.limit(0), F.expr(HELD_OUT)).count() == 0
    alone = suffix_tree.scored(docs, F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known, r.score, r.base_score) for r in alone} == {(0, 0, 0.0, 0.0)}
    empty = suffix_tree.scored(documents(spark, [(1, None), (2, "")]), F.expr(HELD_OUT))
    compare(empty.collect(), plain_scores([(1, None), (2, "")], 2, 10, 0.05))


def test_op12(spark, tmp_path):
    rows = some_rows()
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    compare(queries.op12_suffix_tree(spark, str(tmp_path)).collect(), plain_scores(rows, 2, 10, 0.05))


def test_packing():
    for values in ([], [0], [0, 0], [1, 255, 256, 70_000, 2**40], [2**62]):
        assert unpack(pack(np.array(values, np.int64))).tolist() == values
    for value in (0, 5, -5, 2**40, -(2**40)):
        assert unsigned(signed(np.array([value]))).tolist() == [value]
    keys = np.arange(100)
    dealt = Dealt(keys * 7 % 5, 5)
    sent = {part: pack(own[0]) for part, own in dealt.packets(keys)}
    assert dealt.back(sent).tolist() == keys.tolist()


def test_packing_of_many():
    rng = np.random.default_rng(2)
    for top in (1, 127, 128, 128 + 127 * 256, 10**6, 2**40):
        for size in (1, 2047, 2048, 5000):
            values = rng.integers(0, top, size, endpoint=True) // rng.integers(1, 5000, size)
            assert unpack(pack(values)).tolist() == values.tolist()


def test_contexts_and_symbols_pack_apart():
    """Frequent symbols have small numbers: their keys take less room than gaps between whole keys."""
    rng = np.random.default_rng(3)
    keys = np.unique((rng.integers(0, 20_000, 30_000) << 32) | rng.zipf(1.3, 30_000) % 300_000)
    assert pairs(paired(keys)).tolist() == keys.tolist()
    assert len(paired(keys)) < 0.8 * len(ascending(keys))


def test_words_are_dropped_after_the_first_round(spark, monkeypatch):
    removed, remove = [], suffix_tree.Scratch.remove
    columns = []

    def watched(scratch, folder):
        removed.append(folder.rsplit("/", 1)[1])
        columns.append(spark.read.parquet(f"{folder}").columns)
        remove(scratch, folder)

    monkeypatch.setattr(suffix_tree.Scratch, "remove", watched)
    suffix_tree.scored(documents(spark, some_rows()), F.expr(HELD_OUT)).collect()
    assert removed == ["blocks", "texts", "answers"]
    assert "words" in columns[0] and "words" not in columns[1]


def test_parts_know_the_remainders_of_symbols():
    """All keys of a part come back, the keys are dealt evenly, and symbols take less room than whole ones."""
    rng, parts = np.random.default_rng(5), 50
    keys = np.unique((rng.integers(0, 20_000, 200_000) << 32) | rng.integers(0, 300_000, 200_000))
    part = gram_parts(keys, parts)
    sent = {p: paired(keys[part == p], parts) for p in range(parts)}
    assert all(pairs(packed, p, parts).tolist() == keys[part == p].tolist() for p, packed in sent.items())
    assert np.bincount(part, minlength=parts).max() < 1.1 * len(keys) / parts
    whole = sum(len(paired(keys[part == p])) for p in range(parts))
    assert sum(map(len, sent.values())) < 0.8 * whole


def test_first_shuffles_are_forgotten_before_texts_are_copied(spark, monkeypatch):
    """Else the disk holds the files of the first round, the blocks with their words and the copied texts at once."""
    done, save = [], type(spark.range(0).write).saveAsTable

    def watched(writer, name):
        done.append(name.rsplit("_", 1)[1])
        save(writer, name)

    class Machine:
        class System:
            gc = staticmethod(lambda: done.append("forgotten"))

        def __getattr__(self, name):
            return getattr(machine, name)

    machine = spark.sparkContext._jvm
    monkeypatch.setattr(type(spark.range(0).write), "saveAsTable", watched)
    monkeypatch.setattr(spark.sparkContext, "_jvm", Machine(), raising=False)
    suffix_tree.scored(documents(spark, some_rows()), F.expr(HELD_OUT)).collect()
    assert done[:4] == ["blocks", "answers", "forgotten", "texts"]


@pytest.mark.parametrize("type_", [pa.string(), pa.binary(), pa.large_string()])
def test_blocks_number_words_without_a_call_for_each(monkeypatch, type_):
    """Blocks hold every text whole, in order; Python handles distinct words only, Arrow the tokens."""
    texts = ["A\x0bb\x0cC\x1cD\x85e\xa0F\u3000g\x00 g\r\n", None, "", " \t ", "  É é\n", *["The the fox THE"] * 600, "w " * 900, "é"]
    rows = [(i, x, i % 3 > 0) for i, x in enumerate(texts)]
    batches = [rows[:310], rows[310:311], [], rows[311:]]
    batches = [pa.record_batch([pa.array([r[i] for r in x], t) for i, t in enumerate((pa.int64(), type_, pa.bool_()))],
                               names=["id", "text", "train"]) for x in batches]
    schema = [("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("trains", pa.list_(pa.bool_()))]
    schema = pa.schema([*schema, *[(x, pa.binary()) for x in ("tokens", "words", "word_parts")], ("own", pa.int64()), ("docs", pa.int64())])
    handled, fromiter = [], np.fromiter

    def watched(values, dtype, count=-1):
        handled.append(count)
        return fromiter(values, dtype, count)

    class Task:
        get = staticmethod(lambda: type("", (), {"partitionId": lambda self: 3})())

    monkeypatch.setattr(suffix_tree, "TaskContext", Task)
    monkeypatch.setattr(suffix_tree.np, "fromiter", watched)
    made = pa.Table.from_batches(suffix_tree.blocks(iter(batches), schema, 500, 7)).to_pylist()
    monkeypatch.undo()
    found, distinct = [], 0
    for number, block in enumerate(made):
        assert block["block"] == (3 << 32) + number
        words = zstandard.decompress(block["words"]).split(b" ")
        distinct += len(words)
        tokens = [words[i] for i in unpack(block["tokens"])]
        assert unpack(block["word_parts"]).tolist() == [zlib.crc32(x) % 7 for x in words]
        assert np.diff(np.bincount(unpack(block["tokens"]))).max(initial=0) <= 0
        own = [size for size, train in zip(block["sizes"], block["trains"], strict=True) if train]
        assert (block["own"], block["docs"]) == (sum(own), len(own))
        assert len(tokens) >= 500 or number == len(made) - 1
        assert sum(block["sizes"][:-1]) < 500
        for key, size, train in zip(block["ids"], block["sizes"], block["trains"], strict=True):
            found.append((key, tokens[:size], train))
            tokens = tokens[size:]
    assert found == [(i, [*lower(x).encode().split(), b""], train) for i, x, train in rows]
    assert sum(handled) <= distinct


def test_keys_are_sorted_once():
    """Codes ascend as the keys do, so that the sort of the places sorts the keys; parts are counted in 16 bits."""
    rng, size, parts = np.random.default_rng(6), 20_000, 50
    contexts, symbols = np.unique(rng.integers(2, 10**6, 900)), np.unique(rng.integers(0, 10**6, 700))
    code, symbol = rng.integers(-1, len(contexts), size), rng.integers(0, len(symbols), size)
    weight, compared, argsort = rng.integers(0, 2, size).astype(float), [], np.argsort
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(suffix_tree.np, "argsort", lambda x, **more: compared.append(x.dtype) or argsort(x, **more))
        patch.setattr(suffix_tree.np, "unique", None)
        level = Level(contexts, code, symbols, symbol, weight, parts)
        assert level.dealt_contexts.order.tolist() == sorted(range(len(level.contexts)), key=lambda i: level.context_parts[i])
    assert set(compared) == {np.dtype(np.uint16)}
    at = np.flatnonzero(code >= 0)
    keys = (contexts[code[at]] << 32) | symbols[symbol[at]]
    expected, first, counts = np.unique(keys, return_index=True, return_inverse=True)
    assert level.keys.tolist() == expected.tolist()
    assert level.example.tolist() == at[first].tolist()
    assert level.counts.tolist() == np.bincount(counts, weight[at]).astype(int).tolist()
    assert level.contexts.tolist() == np.unique(expected >> 32).tolist()
    assert level.contexts[level.context_of].tolist() == (expected >> 32).tolist()
    part = gram_parts(expected, parts)
    assert level.dealt.order.tolist() == np.argsort(part, kind="stable").tolist()
    assert {p: own.tolist() for p, (own,) in level.dealt.packets(level.keys)} == {
        p: expected[part == p].tolist() for p in np.unique(part).tolist()
    }


@pytest.mark.parametrize("parts", [3, 1 << 16, (1 << 16) + 1, 200_000])
def test_parts_of_any_number(parts):
    part = np.random.default_rng(7).integers(0, parts, 3000)
    part[0] = parts - 1
    dealt = Dealt(part, parts)
    assert dealt.order.tolist() == np.argsort(part, kind="stable").tolist()
    assert {p: own.tolist() for p, (own,) in dealt.packets(np.arange(3000))} == {
        p: np.flatnonzero(part == p).tolist() for p in set(part.tolist())
    }
