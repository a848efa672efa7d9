"""Language-model scores by a probabilistic suffix tree over words.

A state is a context of up to ``depth`` words (or the start of a text and words after it) that training texts hold at least
``least_count`` times and whose next symbols diverge from those of its suffix, the context without its oldest word: by at
least ``divergence`` nats an occurrence, less the bias of that estimate, (followers - 1) / (2 * occurrences). A token is
scored by the longest context that is a state. A state's distribution is smoothed with that of its longest suffix among the
states, ``(n(context, symbol) + followers * p(symbol by the suffix)) / (n(context) + followers)``, down to the root, which
is the distribution of single words, ``(c + 1) / (N + V + 1)``. Symbols are the words seen ``least_count`` times, the end of
a text, and one class of all other words, within which the root's distribution decides.

How it runs. Texts are cut once into blocks of about ``BLOCK_TOKENS`` tokens, written to the shared folder, bucketed by block.
After the first round their words are dropped: a block then knows its words by their parts and the numbers given there.
What a block needs from the whole corpus it asks in rounds: it sends its distinct keys (words; then contexts with next
symbol, one length a round; then contexts with their divergence) with its own counts, packed, to parts by a hash of the key;
a part adds up and sends back to the blocks what other blocks add. A key is sent once per block, so no key is hot, and
contexts are lengthened only where the shorter one is frequent. Answers are bucketed as the blocks are, and kept: neither
is shuffled again for a later round. Counts, and the divergence in units of 2**-10 nats, are whole numbers, so the
result does not depend on how rows are dealt.

Nulls and edge cases: a null or empty text is one end token; a null id is kept; rows whose ``held_out`` is null train;
repeated rows count each; without training texts every score is 0; an empty table gives an empty result; other columns of
the input are not touched.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StructField, StructType

from clientele.llm.common import SLICE_ROWS, Scratch, ship

#: Tokens of a block (a longer text is a block of its own), and bytes of text for each part and bucket.
BLOCK_TOKENS, SHARE_BYTES = 1 << 20, 16 << 20
#: Spark's own limit of buckets.
MOST_BUCKETS = 100_000
#: Numbers of symbols that are not frequent words: any other word, the end, the start (in contexts only).
OTHER, END, START, WORDS = 0, 1, 2, 3
#: Numbers below the first are packed as one byte, the classes of others end with the second; so many are packed apart.
SMALL, HIGHEST, APART = 128, 127, 2048
#: Divergence is added up in whole units of this share of a nat.
UNIT = 1 << 10
#: The bits of a key that hold the symbol; those of the context are above.
SYMBOL = 0xFFFFFFFF

WORD_KEYS, GRAM_KEYS, CONTEXT_KEYS = 0, 1, 2
COMPRESSOR, DECOMPRESSOR = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
SENT = "part int, block long, kind int, a binary, b binary, c binary"
RETURNED = "block long, step int, kind int, part int, a binary, b binary, c binary, seen long, rare long, rare_tokens long"


def pack(values: np.ndarray) -> bytes:
    """Whole numbers of 0 and more, compressed.

    A small one is a byte; another one is a byte for the class of its high bits and a low byte, and in the highest class the
    rest of the high bits is packed in the same way. Streams of such bytes are compressed apart, those of few numbers together.
    """
    if not len(values):
        return b""
    size, streams = len(values), []
    while len(values):
        large = np.flatnonzero(values >= SMALL)
        low = values[large] - SMALL
        high = low >> 8
        first = values.astype(np.uint8)
        first[large] = np.minimum(high, HIGHEST) + SMALL
        streams += [first.tobytes(), low.astype(np.uint8).tobytes()]
        values = high[high >= HIGHEST] - HIGHEST
    packed = [COMPRESSOR.compress(x) for x in (streams if size >= APART else [b"".join(streams)]) if x]
    return b"".join([size.to_bytes(4, "little"), *[len(x).to_bytes(4, "little") + x for x in packed]])


def unpack(packed: bytes | None) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.int64)
    size, at, streams = int.from_bytes(packed[:4], "little"), 4, []
    while at < len(packed):
        end = at + 4 + int.from_bytes(packed[at : at + 4], "little")
        streams.append(DECOMPRESSOR.decompress(packed[at + 4 : end]))
        at = end
    read, levels = np.frombuffer(b"".join(streams), np.uint8), []
    while size:
        first, read = read[:size], read[size:]
        larger = np.count_nonzero(first >= SMALL)
        levels.append((first, read[:larger]))
        read, size = read[larger:], np.count_nonzero(first == SMALL + HIGHEST)
    values = np.zeros(0, np.int64)
    for first, low in reversed(levels):
        rest, values = values, first.astype(np.int64)
        large = np.flatnonzero(first >= SMALL)
        high = values[large] - SMALL
        if len(rest):
            high[high == HIGHEST] += rest
        values[large] = (high << 8) + low + SMALL
    return values


def signed(values: np.ndarray) -> np.ndarray:
    """Numbers of either sign as numbers of 0 and more, and back by ``unsigned``."""
    return (values << 1) ^ (values >> 63)


def unsigned(values: np.ndarray) -> np.ndarray:
    return (values >> 1) ^ -(values & 1)


def spread(keys: np.ndarray, parts: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def gram_parts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Contexts with next symbol are dealt by the context's hash, moved on by the symbol: a part knows its remainder."""
    return (spread(keys >> 32, parts) + (keys & SYMBOL)) % parts


def by_part(part: np.ndarray, parts: int) -> np.ndarray:
    """The stable order by part; numpy counts numbers of 16 bits instead of comparing them."""
    return np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")


def word_parts(words: list[bytes], parts: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % parts


class Dealt:
    """Keys in the order in which they are sent: by part, ascending within it."""

    def __init__(self, part: np.ndarray, parts: int) -> None:
        self.order = by_part(part, parts)
        self.bounds = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])

    def packets(self, *columns: np.ndarray) -> Iterator[tuple]:
        """Part by part, the values of each column."""
        columns = [x[self.order] for x in columns]
        for part in np.flatnonzero(np.diff(self.bounds)).tolist():
            own = slice(self.bounds[part], self.bounds[part + 1])
            yield part, [x[own] for x in columns]

    def numbers(
        self, returned: dict[int, bytes], frequent: np.ndarray, first: int, read: Callable[[bytes], np.ndarray]
    ) -> np.ndarray:
        """The numbers that the parts gave to frequent keys; -1 for the others."""
        values, parts = np.full(len(self.order), -1), len(self.bounds) - 1
        read_all = [read(returned[x]) * parts + (x + first) for x in sorted(returned)]
        values[self.order[frequent[self.order]]] = np.concatenate([np.zeros(0, np.int64), *read_all])
        return values

    def back(self, returned: dict[int, bytes]) -> np.ndarray:
        """Returned values in the order of the keys."""
        values = np.empty(len(self.order), np.int64)
        values[self.order] = np.concatenate([np.zeros(0, np.int64), *[unpack(returned[x]) for x in sorted(returned)]])
        return values


def ascending(keys: np.ndarray) -> bytes:
    """Ascending numbers, by their gaps; back by ``gaps``."""
    return pack(np.diff(keys, prepend=0))


def gaps(packed: bytes | None) -> np.ndarray:
    return np.cumsum(unpack(packed))


def paired(keys: np.ndarray, parts: int = 1) -> bytes:
    """Ascending keys of one part as contexts, by their gaps, and symbols without the remainder that the part knows: small
    numbers both, as frequent ones have the small numbers."""
    contexts = ascending(keys >> 32)
    return len(contexts).to_bytes(4, "little") + contexts + pack((keys & SYMBOL) // parts)


def halves(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """What ``paired`` packed: contexts, and symbols without their remainders."""
    end = 4 + int.from_bytes(packed[:4], "little")
    return gaps(packed[4:end]), unpack(packed[end:])


def joined(contexts: np.ndarray, symbols: np.ndarray, part: int, parts: int) -> np.ndarray:
    """The keys of a part from their halves."""
    return (contexts << 32) | (symbols * parts + (part - spread(contexts, parts)) % parts)


def pairs(packed: bytes, part: int = 0, parts: int = 1) -> np.ndarray:
    return joined(*halves(packed), part, parts)


def runs(ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a new value begins, and the number of its value for each place."""
    fresh = np.ones(len(ascending), bool)
    np.not_equal(ascending[1:], ascending[:-1], out=fresh[1:])
    return np.flatnonzero(fresh), np.cumsum(fresh) - 1


def distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each distinct code, codes ascending, and the number of its code for each place. Sorts codes and
    places as one number."""
    bits = len(codes).bit_length()
    if int(codes.max(initial=0)).bit_length() + bits < 63:
        both = np.sort((codes << bits) | np.arange(len(codes)))
        places, codes = both & ((1 << bits) - 1), both >> bits
    else:
        places = np.argsort(codes, kind="stable")
        codes = codes[places]
    begins, numbers = runs(codes)
    number = np.empty(len(codes), np.int64)
    number[places] = numbers
    return places[begins], number


class Level:
    """Contexts of one length at the places of a block, with next symbols.

    ``contexts`` and ``symbols`` are the numbers that hold for all blocks, ascending; the codes point into them. A place
    without a context has a negative code.
    """

    def __init__(
        self, contexts: np.ndarray, context_code: np.ndarray, symbols: np.ndarray, symbol_code: np.ndarray,
        weight: np.ndarray, parts: int
    ) -> None:
        self.at, self.parts = np.flatnonzero(context_code >= 0), parts
        codes = context_code[self.at] * len(symbols) + symbol_code[self.at]
        example, self.inverse = distinct(codes)
        self.example = self.at[example]
        context, symbol = context_code[self.example], symbols[symbol_code[self.example]]
        self.keys = (contexts[context] << 32) | symbol
        self.counts = np.bincount(self.inverse, weight[self.at], len(self.keys)).astype(np.int64)
        begins, self.context_of = runs(context)
        self.contexts = contexts[context[begins]]
        self.context_parts = spread(self.contexts, parts)
        self.dealt = Dealt((self.context_parts[self.context_of] + symbol) % parts, parts)

    @cached_property
    def dealt_contexts(self) -> Dealt:
        return Dealt(self.context_parts, self.parts)

    def placed(self, values: np.ndarray, size: int, default: int) -> np.ndarray:
        """Values of the keys at the places that hold them."""
        every = np.full(size, default, values.dtype)
        every[self.at] = values[self.inverse]
        return every


class Block:
    """A block's tokens and what the rounds have told it so far."""

    def __init__(self, rows: pa.Table, returned: pa.Table, parts: int, figures: dict[str, int]) -> None:
        self.rows, self.parts, self.figures = rows, parts, figures
        self.tokens = unpack(rows.column("tokens")[0].as_py())
        self.sizes = np.asarray(rows.column("sizes")[0].values)
        self.trains = np.asarray(rows.column("trains")[0].values.to_numpy(zero_copy_only=False)).astype(bool)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.weight = np.repeat(self.trains.astype(float), self.sizes)
        self.returned: dict[tuple[int, int, str], dict[int, bytes]] = defaultdict(dict)
        names = ("step", "kind", "part", "a", "b", "c")
        for step, kind, part, *values in zip(*[returned.column(x).to_pylist() for x in names], strict=True):
            for name, value in zip("abc", values, strict=True):
                self.returned[step, kind, name][part] = value
        self.levels: list[Level] = []

    def know_words(self) -> None:
        """Symbols of all tokens, and how often they occur."""
        dealt = Dealt(unpack(self.rows.column("word_parts")[0].as_py()), self.parts)
        totals = dealt.back(self.returned[0, WORD_KEYS, "a"])
        totals += np.bincount(self.tokens, self.weight, len(totals)).astype(np.int64)
        end = self.tokens[-1]
        frequent = totals >= self.figures["least_count"]
        frequent[end] = False
        symbols = np.maximum(dealt.numbers(self.returned[0, WORD_KEYS, "b"], frequent, WORDS, unpack), OTHER)
        symbols[end] = END
        self.symbols, self.word_code = np.unique(symbols, return_inverse=True)
        self.word_symbol, self.word_total, self.code = symbols, totals, self.word_code[self.tokens]
        counted = np.where(symbols == OTHER, self.figures["rare_tokens"], totals)
        self.counted = [counted[self.tokens]]
        self.occurs = [np.full(len(self.tokens), self.figures["tokens"])]

    def lengthen(self) -> Level:
        """The contexts that are longer by one word than the last."""
        size = len(self.tokens)
        code, occurs = np.full(size, -1), np.zeros(size, np.int64)
        if not self.levels:
            contexts = np.concatenate([[START], self.symbols])  # ascending but for others and the end, which are no contexts
            code[1:] = np.where(self.word_symbol >= WORDS, self.word_code + 1, -1)[self.tokens[:-1]]
            code[self.starts] = 0 if self.figures["docs"] >= self.figures["least_count"] else -1
            occurs[1:] = self.word_total[self.tokens[:-1]]
            occurs[self.starts] = self.figures["docs"]
        else:
            last = self.levels[-1]
            known = np.flatnonzero(last.fresh >= 0)
            known = known[np.argsort(last.fresh[known])]
            contexts, rank = last.fresh[known], np.full(len(last.keys), -1)
            rank[known] = np.arange(len(known))
            code[1:] = last.placed(rank, size, -1)[:-1]
            code[self.starts] = -1
            occurs[1:] = self.counted[-1][:-1]
        self.occurs.append(occurs)
        self.levels.append(Level(contexts, code, self.symbols, self.code, self.weight, self.parts))
        return self.levels[-1]

    def know_grams(self, step: int, lengthened: bool) -> None:
        level = self.levels[-1]
        level.totals = level.dealt.back(self.returned[step, GRAM_KEYS, "a"]) + level.counts
        if lengthened:
            frequent = (level.totals >= self.figures["least_count"]) & ((level.keys & SYMBOL) >= WORDS)
            level.fresh = level.dealt.numbers(self.returned[step, GRAM_KEYS, "b"], frequent, 0, gaps)
        self.counted.append(level.placed(level.totals, len(self.tokens), 0))

    def grams(self) -> list[tuple]:
        level = self.levels[-1]
        packets = level.dealt.packets(level.keys, level.counts)
        return [(part, GRAM_KEYS, paired(keys, self.parts), pack(counts), None) for part, (keys, counts) in packets]

    def divergences(self, length: int, least: float) -> list[tuple]:
        """Per context of a length: how far it diverges above the least, and its followers, as far as this block's own
        occurrences go. A follower counts in one block only."""
        level = self.levels[length - 1]
        owned = level.dealt.back(self.returned[length, GRAM_KEYS, "c"])
        held = np.flatnonzero(level.counts)
        x = level.example[held]
        ratio = np.zeros(len(level.keys))
        ratio[held] = np.log(
            level.totals[held] / self.occurs[length][x] * (self.occurs[length - 1][x] / self.counted[length - 1][x])
        )
        units = (np.rint(ratio * UNIT) - round(least * UNIT)) * level.counts - UNIT // 2 * owned
        size = len(level.contexts)
        excess = np.rint(np.bincount(level.context_of, units, size)).astype(np.int64)
        followers = np.bincount(level.context_of, owned, size).astype(np.int64)
        packets = level.dealt_contexts.packets(level.contexts, excess, followers)
        return [
            (part, CONTEXT_KEYS, ascending(keys), pack(signed(own)), pack(count)) for part, (keys, own, count) in packets
        ]

    def scores(self, depth: int) -> pa.Table:
        """The root's probability of each token, smoothed into that of ever longer contexts that are states."""
        slots = self.figures["tokens"] + self.figures["seen"] + 1
        own, other = (self.word_total + 1) / slots, self.word_symbol == OTHER
        all_other = (self.figures["rare_tokens"] + self.figures["rare"] + 1) / slots
        base = np.log10(own)
        p = np.where(other, all_other, own)[self.tokens]
        for length in range(1, depth + 1):
            level = self.levels[length - 1]
            followers = level.dealt_contexts.back(self.returned[length + 1, CONTEXT_KEYS, "a"])
            k, shorter = followers[level.context_of], p[level.example]
            smoothed = (level.totals + k * shorter) / np.maximum(self.occurs[length][level.example] + k, 1)
            p[level.at] = np.where(k > 0, smoothed, shorter)[level.inverse]
        within = np.where(other, base - math.log10(all_other), 0.0)
        sums = [
            pa.array(np.add.reduceat(x, self.starts))
            for x in (
                (self.word_total > 0).astype(np.int64)[self.tokens],
                base[self.tokens],
                np.log10(p) + within[self.tokens],
            )
        ]
        ids, held = self.rows.column("ids")[0].values, pa.array(~self.trains)
        n = len(self.sizes)
        tokens = pa.array(np.full(n, self.figures["tokens"]))
        names = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        return pa.table([ids, held, pa.array(self.sizes.astype(np.int64)), sums[0], tokens, *sums[1:]], names=names)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts with A-Z in lower case, and how many each has; none are left of a null."""
    words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, ""))))
    sizes, words = np.diff(words.offsets.to_numpy()), words.flatten()
    filled = pc.greater(pc.binary_length(words), 0)  # a text without words is split into one empty word
    empty = np.flatnonzero(~filled.to_numpy(zero_copy_only=False))
    if len(empty):
        sizes[np.searchsorted(np.cumsum(sizes), empty, "right")] -= 1
        words = words.filter(filled)
    return words, sizes


def blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema, block_tokens: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Texts to blocks: ids, sizes, whether they train, token numbers by falling frequency, the words and their parts."""
    task, made = TaskContext.get().partitionId(), 0
    ids, sizes, trains, pieces, total = [], [], [], [], 0

    def block() -> pa.RecordBatch:
        size, train = np.concatenate(sizes), pa.concat_arrays(trains)
        words = pa.chunked_array(pieces).cast(pa.large_binary()).combine_chunks().dictionary_encode()
        last = len(words.dictionary)  # the number of the end of a text, an empty word
        tokens = np.insert(words.indices.to_numpy(), np.cumsum(size - 1), last)
        order = np.argsort(-np.bincount(tokens, minlength=last + 1), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        words = pa.concat_arrays([words.dictionary, pa.array([b""], pa.large_binary())]).take(pa.array(order))
        words = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), pa.scalar(b" ", words.type))[0].as_py()
        dealt, words = pack(word_parts(words.split(b" "), parts)), zstandard.compress(words, 3)
        trained = train.to_numpy(zero_copy_only=False).astype(bool)
        own, docs = int(size[trained].sum()), int(trained.sum())
        row = [(task << 32) + made, pa.concat_arrays(ids), pa.array(size), train, pack(rank[tokens]), words, dealt, own, docs]
        columns = [pa.ListArray.from_arrays([0, len(x)], x).cast(field.type) if isinstance(x, pa.Array) else pa.array([x], field.type)
                   for x, field in zip(row, schema, strict=True)]
        return pa.record_batch(columns, schema=schema)

    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).view(pa.string())
        for begin in range(0, batch.num_rows, SLICE_ROWS):
            some = batch.slice(begin, SLICE_ROWS)
            words, size = split_words(texts.slice(begin, SLICE_ROWS))
            ends, at = np.cumsum(size), 0
            while at < len(size):
                before = ends[at] - size[at]
                reach = total + np.cumsum(size[at:] + 1)
                stop = at + min(int(np.searchsorted(reach, block_tokens)) + 1, len(reach))
                pieces.append(words.slice(before, ends[stop - 1] - before))
                sizes.append(size[at:stop] + 1)
                ids.append(some.column(0).slice(at, stop - at))
                trains.append(some.column(2).slice(at, stop - at))
                total, at = int(reach[stop - at - 1]), stop
                if total >= block_tokens:
                    yield block()
                    made, total = made + 1, 0
                    ids, sizes, trains, pieces = [], [], [], []
    if pieces:
        yield block()


def sent_table(block: int, packets: list[tuple]) -> pa.Table:
    columns = list(zip(*packets, strict=True)) if packets else [[]] * 5
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 3]
    part, kind, *values = [pa.array(x, t) for x, t in zip(columns, types, strict=True)]
    names = ["part", "block", "kind", *"abc"]
    return pa.table([part, pa.array([block] * len(packets), pa.int64()), kind, *values], names=names)


def word_packets(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """The first round: every word of a block with its count in training texts."""
    for batch in batches:
        for i in range(batch.num_rows):
            rows = pa.Table.from_batches([batch.slice(i, 1)])
            own = Block(rows, EMPTY, parts, {})
            words = np.array(zstandard.decompress(rows.column("words")[0].as_py()).split(b" "), object)
            counts = np.bincount(own.tokens, own.weight, len(words)).astype(np.int64)
            dealt = Dealt(unpack(rows.column("word_parts")[0].as_py()), parts)
            packets = [
                (part, WORD_KEYS, zstandard.compress(b" ".join(some.tolist()), 3), pack(n), None)
                for part, (some, n) in dealt.packets(words, counts)
            ]
            yield from sent_table(batch.column("block")[i].as_py(), packets).to_batches()


EMPTY = pa.table({x: [] for x in ("step", "kind", "part", "a", "b", "c")})


def block_round(step: int, depth: int, parts: int, divergence: float, figures: dict[str, int]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """What a block does with the answers to all rounds before ``step``: ask the next questions, or score."""

    def work(rows: pa.Table, returned: pa.Table) -> pa.Table:
        block = Block(rows, returned, parts, figures)
        block.know_words()
        for length in range(1, min(step, depth) + 1):
            block.lengthen()
            if length < step:
                block.know_grams(length, length < depth)
        if step > depth + 1:
            return block.scores(depth)
        packets = block.grams() if step <= depth else []
        packets += block.divergences(step - 1, divergence) if step > 1 else []
        return sent_table(rows.column("block")[0].as_py(), packets)

    return work


def part_round(step: int, depth: int, parts: int, least_count: int) -> Callable[[pa.Table], pa.Table]:
    """A part adds up what the blocks sent for its keys, and answers each packet in the order of its keys.

    Words and contexts with next symbol are answered with what other blocks add to the count (a), the numbers of the
    frequent ones (b), and whether the block is the first that holds the key (c); contexts with the number of their
    followers, 0 where they are no states (a).
    """

    def summed(values: list[np.ndarray], inverse: np.ndarray, size: int) -> np.ndarray:
        total = np.zeros(size, np.int64)
        np.add.at(total, inverse, np.concatenate(values))
        return total

    def of_kind(kind: int, part: int, a: list[bytes], b: list[bytes], c: list[bytes]) -> tuple:
        seen = rare = rare_tokens = 0
        if kind == WORD_KEYS:
            keys = [pa.array(zstandard.decompress(x).split(b" "), pa.large_binary()) for x in a]
            words = pa.concat_arrays(keys).dictionary_encode()
            every, first, inverse = words.dictionary, None, words.indices.to_numpy()
        elif kind == GRAM_KEYS:
            keys, symbols = zip(*[halves(x) for x in a], strict=True)
            contexts, symbols = np.concatenate(keys), np.concatenate(symbols)
            first, inverse = distinct((contexts << int(symbols.max()).bit_length()) | symbols)
            every = joined(contexts[first], symbols[first], part, parts)
        else:
            keys = [gaps(x) for x in a]
            every = np.concatenate(keys)
            first, inverse = distinct(every)
            every = every[first]
        own = [unpack(x) for x in b]
        ends = np.cumsum([len(x) for x in keys])[:-1]
        if kind == CONTEXT_KEYS:
            excess = summed([unsigned(x) for x in own], inverse, len(every))
            followers = summed([unpack(x) for x in c], inverse, len(every))
            state = np.where(excess + UNIT // 2 >= 0, followers, 0)
            return [pack(x) for x in np.split(state[inverse], ends)], None, None, (0, 0, 0)
        totals = summed(own, inverse, len(every))
        frequent = totals >= least_count
        if kind == WORD_KEYS:
            word = pc.greater(pc.binary_length(every), 0).to_numpy(zero_copy_only=False)
            seen, rare = int((totals > 0).sum()), int((word & ~frequent & (totals > 0)).sum())
            rare_tokens = int(totals[word & ~frequent].sum())
            frequent &= word
        else:
            frequent &= (every & SYMBOL) >= WORDS
        if frequent.sum() * parts + WORDS >= 1 << 31:
            raise OverflowError("more contexts than 31 bits can number")
        numbered = np.flatnonzero(frequent)
        if kind == WORD_KEYS:  # frequent words get small numbers, which pack better in every later round
            numbered = numbered[np.argsort(-totals[numbered], kind="stable")]
        number_of = np.full(len(every), -1)
        number_of[numbered] = np.arange(len(numbered))
        number_of = number_of[inverse]
        added = [pack(x) for x in np.split(totals[inverse] - np.concatenate(own), ends)]
        numbers = None
        if kind == WORD_KEYS or step < depth:
            numbers = [pack(x[x >= 0]) for x in np.split(number_of, ends)]
            if kind == GRAM_KEYS:
                numbers = [ascending(x[x >= 0]) for x in np.split(number_of, ends)]
        owners = None
        if kind == GRAM_KEYS:
            owner = np.zeros(len(inverse), np.int64)
            owner[first] = totals > 0
            owners = [pack(x) for x in np.split(owner, ends)]
        return added, numbers, owners, (seen, rare, rare_tokens)

    def work(sent: pa.Table) -> pa.Table:
        part = sent.column("part")[0].as_py()
        rows = []
        for kind in (WORD_KEYS, GRAM_KEYS, CONTEXT_KEYS):
            own = sent.filter(pc.equal(sent.column("kind"), kind)).sort_by("block")
            if not own.num_rows:
                continue
            block, *packed = (own.column(x).to_pylist() for x in ("block", *"abc"))
            *answers, figures = of_kind(kind, part, *packed)
            answers = [x or [None] * len(block) for x in answers]
            for i, values in enumerate(zip(block, *answers, strict=True)):
                rows.append((values[0], step, kind, part, *values[1:], *(figures if i == 0 else (0, 0, 0))))
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 3, *[pa.int64()] * 3]
        names = [x.split()[0] for x in RETURNED.split(", ")]
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return work


def scored(
    docs: DataFrame,
    held_out: Column,
    depth: int = 2,
    least_count: int = 10,
    divergence: float = 0.05,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_tokens: int = BLOCK_TOKENS,
    share_bytes: int = SHARE_BYTES,
) -> DataFrame:
    """Per row: its id, ``held_out``, ``n_tokens``, ``n_known`` (tokens that training texts hold), ``train_tokens`` (of all
    training texts), ``base_score`` (log10 probability by single words) and ``score`` (by the tree)."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    ship(spark)
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), (~F.coalesce(held_out, F.lit(False))).alias("train")
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // share_bytes))
    id_type = docs.schema[id_column].dataType
    shape = StructType(
        [
            StructField("block", LongType()),
            StructField("ids", ArrayType(id_type)),
            *StructType.fromDDL("sizes array<int>, trains array<boolean>, tokens binary, words binary, word_parts binary, own long, docs long"),
        ]
    )
    arrow = spark.createDataFrame([], shape).toArrow().schema
    run, buckets = f"clientele_{uuid.uuid4().hex}", min(parts, MOST_BUCKETS)

    def bucketed(frame: DataFrame, name: str) -> DataFrame:
        """The rows added to a table of this run."""
        writer = frame.write.mode("append").bucketBy(buckets, "block").option("path", f"{scratch.folder}/{name}")
        writer.saveAsTable(f"{run}_{name}")
        return spark.table(f"{run}_{name}")

    def forget_shuffles() -> None:
        """Spark deletes the files of a shuffle when the driver collects what referred to it: not left to chance here."""
        spark.sparkContext._jvm.System.gc()

    def drop(name: str) -> None:
        spark.sql(f"DROP TABLE {run}_{name}")
        scratch.remove(f"{scratch.folder}/{name}")

    texts = bucketed(rows.mapInArrow(lambda batches: blocks(batches, arrow, block_tokens, parts), shape), "blocks")

    def answered(sent: DataFrame, step: int) -> DataFrame:
        """All answers so far."""
        answers = sent.groupBy("part").applyInArrow(part_round(step, depth, parts, least_count), RETURNED)
        return bucketed(answers.repartition(buckets, "block"), "answers")

    first = texts.mapInArrow(lambda batches: word_packets(batches, parts), SENT)
    known = answered(first, 0)
    forget_shuffles()  # before the texts are copied, and the sums leave it time
    own = texts.agg(F.sum("own").alias("tokens"), F.sum("docs").alias("docs")).first()
    told = known.agg(*[F.sum(x).alias(x) for x in ("seen", "rare", "rare_tokens")]).first()
    texts = bucketed(texts.drop("words"), "texts")
    drop("blocks")
    figures = {k: v or 0 for k, v in {**own.asDict(), **told.asDict()}.items()} | {"least_count": least_count}
    result = StructType(
        [
            StructField("id", id_type),
            StructField("held_out", BooleanType()),
            *[StructField(x, LongType()) for x in ("n_tokens", "n_known", "train_tokens")],
            *[StructField(x, DoubleType()) for x in ("base_score", "score")],
        ]
    )
    for step in range(1, depth + 3):
        pairs = texts.groupBy("block").cogroup(known.groupBy("block"))
        work = block_round(step, depth, parts, divergence, figures)
        if step <= depth + 1:
            known = answered(pairs.applyInArrow(work, SENT), step)
            forget_shuffles()
        else:
            found = scratch.save(pairs.applyInArrow(work, result))
    for name in ("texts", "answers"):
        drop(name)
    return found.withColumnRenamed("id", id_column)
