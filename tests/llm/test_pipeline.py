"""The whole corpus pipeline against a plain Python version of its stages."""

import hashlib
import math
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from clientele.llm import mixing
from tests.llm.test_operators import ranks, repeated


def corpus():
    """``(doc_id, text, source)`` and the ids that are toxic."""
    rng = np.random.default_rng(11)
    pool = [f"w{i}" for i in range(400)]
    lines = lambda n, words=10: [" ".join(rng.choice(pool, words)) for _ in range(n)]
    rows, toxic = [], set()
    for i in range(400):
        own = lines(3)
        if rng.random() < 0.25:
            own[1] += " " + str(rng.choice(["scumbag", "lowlife"])) + " you"
            toxic.add(i)
        rows.append((i, "\n".join(own), "abc"[i % 7 // 3]))
    passage, base, long = lines(6), lines(1, 40)[0], lines(8)
    rows += [(500 + k, "\n".join([*lines(1), *passage, *lines(1)]), "b") for k in range(3)]  # a shared passage of 60 words
    rows += [(510 + k, " ".join([*base.split()[:-1], f"last{k}"]), "a") for k in range(5)]  # near copies
    rows += [(520, base, "c"), (521, base, "a")]  # and exact ones
    rows += [(530, "\n".join(long), "c"), (531, "\n".join(long), "c")]  # a copy of which no line is left
    rows += [(540, None, "a"), (541, "", None), (542, "one two", "b"), (543, "one two", "b")]
    return rows, toxic


def expected(rows, toxic):
    """Id to text of what the first three stages keep."""
    clean = [(i, t) for i, t, _ in rows if i not in toxic]
    gone = repeated([(i, t) for i, t in clean if t is not None], 50)
    cut = {}
    for i, t in clean:
        own = t.split("\n") if t is not None else []
        left = [x for k, x in enumerate(own) if k not in gone.get(i, ())]
        if left or not own:
            cut[i] = "\n".join(left) if t is not None else None
    sets = {}
    for i, t in cut.items():
        words = (t or "").lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    least = {i: i for i in cut}
    for _ in range(len(rows)):
        changed = False
        for i, a in sets.items():
            for j, b in sets.items():
                if a and 100 * len(a & b) >= 80 * len(a | b) and least[j] < least[i]:
                    least[i], changed = least[j], True
        if not changed:
            break
    return {i: t for i, t in cut.items() if least[i] == i}


def test_run_against_a_plain_version(spark, tmp_path):
    rows, toxic = corpus()
    docs = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    labels = [(i, 1, int(i in toxic)) for i, _, _ in rows if i < 400]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = expected(rows, toxic)
    assert 520 not in kept and 531 not in kept and kept[501] != dict((i, t) for i, t, _ in rows)[501]
    whole = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(), special_tokens={})
    plain = {}
    for i, t in kept.items():
        ids = whole.encode_ordinary(t or "")
        plain[i] = (len(ids), struct.pack(f"<{len(ids)}I", *ids), hashlib.sha256((t or "").encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, bytes(r.token_ids), r.decoded_sha256) for r in found} == plain
    assert len(found) == len(plain) == len({r.mix_position for r in found})
    source = {i: s for i, _, s in rows}
    sizes = Counter(source[i] for i in kept)
    total, seen = sum(math.sqrt(n) for n in sizes.values()), Counter()
    order = [source[r.doc_id] for r in sorted(found, key=lambda r: r.mix_position)]
    for n, s in enumerate(order[:60], 1):  # before a source runs out
        seen[s] += 1
        for k, size in sizes.items():
            assert abs(seen[k] - n * math.sqrt(size) / total) <= 3 * mixing.BLOCK_ROWS
