"""Periodic runs and cross-tokenizer alignment against brute force, and their edge cases, on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from clientele.llm import alignment, periodic_runs, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, n_words string, runs int, id string, pairs string, groups string"
PATHS = public_tokenizers.path(alignment.BYTE_LEVEL), public_tokenizers.path(alignment.PIECES)


def documents(spark, rows):
    """Documents with columns whose names clash with those of the operators."""
    return spark.createDataFrame([(*row, "x", 1, None, "y", "z") for row in rows], DOCS)


def brute_runs(words, least_length=6, least_exponent=4):
    """Every stretch that equals itself shifted by q, unless a smaller shift does as well."""
    found, n = [], len(words)
    for q in range(1, n // least_exponent + 1):
        same = [words[i] == words[i + q] for i in range(n - q)] + [False]
        begin = None
        for i, equal in enumerate(same):
            if equal and begin is None:
                begin = i
            elif not equal and begin is not None:
                own = words[begin : i + q]
                smaller = any(own[p:] == own[:-p] for p in range(1, q))
                if len(own) >= max(least_length, least_exponent * q) and not smaller:
                    found.append((begin, len(own), q))
                begin = None
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (4, 3), (10, 2)])
def test_runs_of_random_words(limits):
    random.seed(sum(limits))
    for _ in range(300):
        texts = []
        for _ in range(random.randint(1, 4)):
            words = [random.choice([b"a", b"b", b"c"][: random.randint(1, 3)]) for _ in range(random.randint(0, 50))]
            if words and random.random() < 0.6:
                a, p = random.randrange(len(words)), random.randint(1, 8)
                words = words[:a] + [words[min(len(words) - 1, a + (i - a) % p)] for i in range(a, len(words))]
            texts.append(words)
        assert periodic_runs.runs_of_texts(texts, *limits) == [brute_runs(words, *limits) for words in texts]


def run_texts():
    inner = "p q q q q q q q r " * 5
    many = " ".join(f"w{i % 97}" for i in range(3000))
    return [None, "", " \n", "one", "a a a a a a", "a a a a a", "a b a b a b a b", inner, inner, many, "é é é é é é x", "x " * 4000]


def test_periodic_runs(spark):
    rows = list(enumerate(run_texts())) + [(3, "one"), (None, "b b b b b b b")]
    docs = documents(spark, rows)
    found = Counter(
        (r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.strongest and tuple(r.strongest), r.collapsed)
        for r in periodic_runs.periodic_runs(docs).collect()
    )
    expected = Counter()
    for key, text in rows:
        words = WORD.findall(text or "")
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        expected[(key, len(words), tuple(runs), best, brute_collapse(words, runs))] += 1
    assert found == expected
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def test_op11(spark, tmp_path):
    """The query, with its planted runs, against the wording of its contract."""
    random.seed(3)
    rows = [(i, " ".join(random.choice("ab c dd".split()) for _ in range(random.randint(0, 60)))) for i in range(200)]
    rows += [(1000 + i, x) for i, x in enumerate(run_texts())] + [(-7, "a b"), (None, "c c c c c c"), (5, rows[5][1])]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    expected = Counter()
    for key, text in rows:
        words = WORD.findall(text or "")
        n, h = len(words), 1 if key is None else zlib.crc32(str(key).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        texts = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, brute_collapse(words, runs))]
        figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        expected[(key, len(runs), *figures, *texts)] += 1
    assert any(x[1] for x in expected)
    assert Counter(map(tuple, queries.op11_periodic_runs(spark, str(tmp_path)).collect())) == expected


def whole_alignment(texts):
    """Both tokenizers on whole texts, ends by running sums, and counts over all texts."""
    a_own, b_own = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a_own.encode_special_tokens = True
    letters = alignment.byte_letters()
    rows = []
    for text in texts:
        a = a_own.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_own.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in a_own.id_to_token(x)) for x in a]
        b_bytes = [
            bytes([int(p[3:-1], 16)]) if b_own.is_byte(x) else p.replace("▁", " ").encode()
            for x, p in zip(b, map(b_own.id_to_piece, b), strict=True)
        ]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == f" {text}".encode():
            rows.append(([], [], [], []))
            continue
        a_end, b_end = ([sum(map(len, own[: i + 1])) for i in range(len(own))] for own in (a_bytes, b_bytes))
        links = [(x, y) for x, i in zip(a, a_end, strict=True) for y, j in zip(b, b_end, strict=True) if i == j]
        groups, last = [], 0
        for end in sorted(set(a_end) & set(b_end)):
            sides = [[x for x, at in zip(own, ends, strict=True) if last < at <= end] for own, ends in ((a, a_end), (b, b_end))]
            groups.append("|".join(",".join(map(str, x)) for x in sides))
            last = end
        rows.append((a, b, groups, links))
    counts = Counter(x for row in rows for x in row[3])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [
        (
            *map(len, (a, b, groups, links)),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
            sum(counts[x] == most[x[1]] for x in links),
            sum(counts[x] for x in links),
        )
        for a, b, groups, links in rows
    ]


def alignment_texts():
    odd = [0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF, 0x1C]
    white = [f"a{chr(x)}b {chr(x)}{chr(x)} c{chr(x)} 1 {chr(x)}" for x in [*range(0x20), *odd]]
    plain = [None, "", " ", "  ", "\n\n  x", "a<|endoftext|>b <s> <0x0A> <unk>", "don't 12'34 --- ...", "mark ▁ mark", "x\r\ny"]
    other = ["Ünï ço de   漢字 \U0001f642\U0001f642", "The cat sat.\nThe cat  sat.\n\n\tThe end.  ", "x" * 300]
    return [*plain, *other, *white]


def test_alignment(spark):
    texts = alignment_texts()
    rows = [*enumerate(texts), (4, texts[4]), (None, "no id")]
    found = alignment.alignment(documents(spark, rows), *PATHS).collect()
    expected = Counter(zip([i for i, _ in rows], whole_alignment([x for _, x in rows]), strict=True))
    assert Counter((r.doc_id, tuple(r)[1:]) for r in found) == expected
    assert alignment.alignment(documents(spark, rows).limit(0), *PATHS).count() == 0


def test_pairs_of_long_texts(spark):
    """A long text, cut into many chunks and batches, and its counts."""
    random.seed(8)
    word = ["the", "of", "an\n", "in ", "été", "tion", "42", "(x)", "\n\n", "don't"]
    texts = [" ".join(random.choice(word) for _ in range(n)) for n in (3000, 700, 1, 90)]
    found = alignment.alignment(documents(spark, list(enumerate(texts))), *PATHS).collect()
    assert [tuple(r)[1:] for r in sorted(found)] == whole_alignment(texts)


def test_chunks_align_as_whole_texts():
    random.seed(2)
    aligner = alignment.Aligner(*PATHS)
    parts = [*"aabbcde  \n\n\t'.,129AB", "　", "\xa0", "'s", " the", "ing", "漢", "<s>", "é", "\U0001f600", "\x00"]
    for _ in range(3000):
        text = "".join(random.choice(parts) for _ in range(random.randint(1, 25)))
        whole = aligner.aligned([f" {text}"])[0] if "\n" not in text[:1] else None
        own = aligner.of([text])[0]
        if whole and own:
            assert ";".join(x[3] for x in own) == whole[3], repr(text)


def test_op13(spark, tmp_path):
    rows = list(enumerate(alignment_texts()))
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    columns = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    found = sorted(queries.op13_alignment(spark, str(tmp_path)).select("doc_id", *columns).collect())
    assert [tuple(r)[1:] for r in found] == whole_alignment([x for _, x in rows])
