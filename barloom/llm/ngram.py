"""Language-model scores from Elias-Fano n-gram levels.

Words, pairs and triples of words are counted exactly over all training text; every word and every
n-gram of ``LEAST_COUNT`` occurrences is in the model, whatever the size of the corpus. Nothing
but the counts of common words is sent to every task.

Texts are stored in blocks, which are dealt to tasks as they stand: no text is shuffled. Words are
counted and numbered first; a pair is the numbers of its two words in as many bits as they need,
scrambled reversibly, so that its key spreads evenly and still tells both words. Each block sends
its distinct pairs, each with the words that follow it, to the bucket of the pair's key: a level is
a sorted sequence in Elias-Fano form, the keys of the pairs, and under each pair's place the
numbers of the successors. A bucket adds up what all blocks sent, and has all successors of its
pairs, so it knows their probabilities and back-off weights; those of words are sums over all
buckets. It answers each block with the part of the trie that the block's texts reach: the pairs,
monotone pointers to their successors and the successors, all three in Elias-Fano form, and
quantised probabilities and weights.

The parts are joined with the texts of the block and mapped from a file, as they are. A text's
n-grams are looked up there by successor search: a pair by its high bits among all pairs, and
the word after it within the range of its context only.

Logarithms are quantised to 16 bits, which changes a probability by 0.02 % at most.
Probabilities: absolute discounting, interpolated with the lower order; a word of count c has
(c - d) / N, and what the discounts save is the probability of an unknown word.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import SPACED_BYTES, Scratch, Words, dealt, fields, map_arrow, read, ship, stored, text_bytes
from barloom.llm.langid import held_out

#: Least share of the training tokens of a word whose count is sent to every task. There are at
#: most 1 / share of them; the others get their counts by a join.
COUNT_SHARE = 1.25e-7
#: N-grams seen less often are left to the lower order.
LEAST_COUNT = 2
#: What is taken off the count of each n-gram.
DISCOUNT = 0.75
#: Bytes of text of a block.
TEXT_BYTES = 8 << 20
#: Training tokens of a bucket, and the least number of buckets.
BUCKET_TOKENS = 4_000_000
BUCKETS = 256

_32 = np.uint64(32)
_ODD = 0x9E3779B97F4A7C15
#: The token after the last word of a text.
END = np.uint64(0x5D0C0E9B3A1F7E21)

_POPCOUNT = np.array([bin(x).count("1") for x in range(256)], np.uint8)
_SELECT = np.array([([i for i in range(8) if x >> i & 1] + [0] * 8)[:8] for x in range(256)], np.uint8)


def _ranks(high: np.ndarray) -> np.ndarray:
    """Ones before each word of 64 bits."""
    return np.concatenate(([0], np.cumsum(_POPCOUNT[high].reshape(-1, 8).sum(axis=1)))).astype(np.int64)


class EliasFano:
    """A non-decreasing sequence: high parts in unary in a bit map, low parts packed."""

    NAMES = ("shape", "low", "high", "ranks")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.bits = (int(x) for x in arrays["shape"])
        self.low, self.high, self.ranks = arrays["low"], arrays["high"], arrays["ranks"]
        if self.ranks is None:
            self.ranks = _ranks(self.high)
        #: Zeros before each word of 64 bits.
        self.zeros = np.arange(len(self.ranks), dtype=np.int64) * 64 - self.ranks

    @staticmethod
    def build(values: np.ndarray) -> dict[str, np.ndarray]:
        values = values.astype(np.uint64)
        n = len(values)
        bits = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        places = np.arange(n, dtype=np.uint64) * np.uint64(bits)
        low = np.zeros((n * bits >> 6) + 2, np.uint64)
        part = values & np.uint64((1 << bits) - 1)
        word, shift = (places >> np.uint64(6)).astype(np.int64), places & np.uint64(63)
        np.bitwise_or.at(low, word, part << shift)
        over = shift + np.uint64(bits) > 64
        np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        size = (((int(ones[-1]) + 1) >> 6) + 1) * 64 if n else 64  # a zero ends the last high part
        flags = np.zeros(size, np.uint8)
        flags[ones] = 1
        high = np.packbits(flags, bitorder="little")
        return {"shape": np.array([n, bits], np.int64), "low": low, "high": high, "ranks": _ranks(high)}

    def _select(self, before: np.ndarray, at: np.ndarray, flip: int) -> np.ndarray:
        """The place of the at-th one, or of the at-th zero where ``flip`` is 255."""
        word = np.searchsorted(before, at, "right") - 1
        left = (at - before[word]).astype(np.int64)
        byte = word * 8
        for _ in range(7):
            own = _POPCOUNT[self.high[byte] ^ flip]
            on = left >= own
            left -= np.where(on, own, 0)
            byte += on
            if not on.any():
                break
        return byte * 8 + _SELECT[self.high[byte] ^ flip, left]

    def _lows(self, at: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(at), np.uint64)
        place = at.astype(np.uint64) * np.uint64(self.bits)
        word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
        part = self.low[word] >> shift
        more = shift > 0
        part |= np.where(more, self.low[word + 1] << (np.uint64(64) - np.where(more, shift, 1)), 0).astype(np.uint64)
        return part & np.uint64((1 << self.bits) - 1)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        """The values at these places."""
        one = self._select(self.ranks, at, 0)
        return ((one - at).astype(np.uint64) << np.uint64(self.bits) | self._lows(at)).astype(np.int64)

    def find(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The place of the first value that is equal within its range [lo, hi), or -1.

        The high part of a value leads to the places that share it, few on the whole; among
        those within the range the low parts are searched.
        """
        value = value.astype(np.uint64)
        found = np.full(len(value), -1)
        top = (value >> np.uint64(self.bits)).astype(np.int64)
        at = np.flatnonzero((lo < hi) & (top < self.zeros[-1]))
        if not len(at):
            return found
        top, low = top[at], value[at] & np.uint64((1 << self.bits) - 1)
        start = np.where(top > 0, self._select(self.zeros, np.maximum(top - 1, 0), 255) - top + 1, 0)
        end = np.minimum(self._select(self.zeros, top, 255) - top, hi[at])
        start = np.maximum(start, lo[at])
        last = end.copy()
        open_ = np.flatnonzero(start < end)
        while len(open_):
            middle = (start[open_] + end[open_]) >> 1
            below = self._lows(middle) < low[open_]
            start[open_[below]] = middle[below] + 1
            end[open_[~below]] = middle[~below]
            open_ = open_[start[open_] < end[open_]]
        inside = np.flatnonzero(start < last)
        same = inside[self._lows(start[inside]) == low[inside]]
        found[at[same]] = start[same]
        return found

    def all(self) -> np.ndarray:
        """Every value in turn."""
        at = np.arange(self.n)
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        value = (ones - at).astype(np.uint64) << np.uint64(self.bits)
        if self.bits:
            place = at.astype(np.uint64) * np.uint64(self.bits)
            word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            part = self.low[word] >> shift
            part |= np.where(shift > 0, self.low[word + 1] << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
            value |= part & np.uint64((1 << self.bits) - 1)
        return value


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one value: their number, kinds and lengths, then their bytes."""
    head = [f"{x.dtype.str}:{len(x)}" for x in arrays]
    return "\t".join(head).encode() + b"\n" + b"".join(np.ascontiguousarray(x).tobytes() for x in arrays)


def unpack(value: bytes | mmap.mmap, at: int = 0) -> list[np.ndarray]:
    """The arrays packed from place ``at`` on, as they stand there."""
    end = value.find(b"\n", at)
    head, at = value[at:end].decode(), end + 1
    out = []
    for part in head.split("\t"):
        kind, n = part.split(":")
        out.append(np.frombuffer(value, kind, int(n), at))
        at += out[-1].nbytes
    return out


def _sequence(values: np.ndarray) -> list[np.ndarray]:
    """A sorted sequence as arrays: its least value, and the distances from it in Elias-Fano form."""
    least = values[:1].astype(np.uint64)
    held = EliasFano.build(values - least[0] if len(values) else values)
    return [least, held["shape"], held["low"], held["high"]]


def _values(arrays: list[np.ndarray]) -> np.ndarray:
    least, shape, low, high = arrays
    if not shape[0]:
        return np.zeros(0, np.uint64)
    return EliasFano({"shape": shape, "low": low, "high": high, "ranks": None}).all() + least[0]


def _held(arrays: list[np.ndarray]) -> tuple[EliasFano, np.uint64]:
    """The sequence, searched where it stands, and what to take off a value before."""
    least, shape, low, high = arrays
    return EliasFano({"shape": shape, "low": low, "high": high, "ranks": None}), least[0] if len(least) else np.uint64(0)


#: Natural logarithms up to this size are quantised to 16 bits: 0.00037 a step.
_SPAN = 24.0


def quantised(x: np.ndarray) -> np.ndarray:
    """16-bit codes of probabilities or weights in (0, 1], or of discounted counts from 1 on."""
    return np.rint(np.minimum(np.abs(np.log(x)), _SPAN) * (65535 / _SPAN)).astype(np.uint16)


def probability(code: np.ndarray) -> np.ndarray:
    return np.exp(code * (-_SPAN / 65535))


def amount(code: np.ndarray) -> np.ndarray:
    return np.exp(code * (_SPAN / 65535))


def _small(counts: np.ndarray) -> np.ndarray:
    """Counts in the least bytes that hold them."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def _marked(counts: np.ndarray) -> list[np.ndarray]:
    """Counts as a bit for those from 1 on, a bit for those from 2 on, and the latter."""
    return [np.packbits(counts > 0), np.packbits(counts > 1), _small(counts[counts > 1])]


def _unmarked(arrays: list[np.ndarray], n: int) -> np.ndarray:
    some, several, more = arrays
    counts = np.unpackbits(some, count=n).astype(np.int64)
    counts[np.unpackbits(several, count=n).astype(bool)] = more
    return counts


def scrambled(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """Keys of 2 * ``bits`` bits for pairs of numbers of ``bits`` bits: another for every pair."""
    mask, shift, odd = np.uint64((1 << 2 * bits) - 1), np.uint64(bits), np.uint64(_ODD)
    x = first.astype(np.uint64) << shift | second.astype(np.uint64)
    for _ in range(2):
        x = x * odd & mask
        x ^= x >> shift
    return x * odd & mask


def first_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """The first number of each pair."""
    mask, shift, back = np.uint64((1 << 2 * bits) - 1), np.uint64(bits), np.uint64(pow(_ODD, -1, 1 << 64))
    x = keys * back & mask
    for _ in range(2):
        x ^= x >> shift
        x = x * back & mask
    return x >> shift


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a block of texts, each with its end, and the n + 1 bounds of the texts."""
    words = Words(data[offsets[0] : offsets[-1]], offsets, SPACED_BYTES)
    n = len(offsets) - 1
    bounds = words.bounds + np.arange(n + 1)
    hashes = np.empty(len(words) + n, np.uint64)
    hashes[bounds[1:] - 1] = END
    hashes[np.arange(len(words)) + words.text] = words.hash
    return hashes, bounds


def blocked(docs: DataFrame) -> DataFrame:
    """``docs`` with the column ``_block``, to be stored; rows of a block stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            _, offsets = text_bytes(batch.column("text"))
            sizes = offsets + 16 * np.arange(len(offsets))
            yield batch.append_column("_block", pa.array(own + (at + sizes[:-1]) // TEXT_BYTES))
            at += int(sizes[-1])

    return map_arrow(docs, run, ", ".join([*fields(docs), "_block long"]))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Block, token hashes, bounds of the texts, and whether each token is learned from."""

    def out():
        table = pa.Table.from_batches(held)
        hashes, bounds = _tokens(*text_bytes(table.column("text")))
        learn = table.column("_learn").to_numpy()
        return block, hashes, bounds, np.repeat(learn, np.diff(bounds))

    held, block = [], None
    for batch in batches:
        ids = batch.column("_block").to_numpy()
        edges = np.concatenate(([0], np.flatnonzero(np.diff(ids)) + 1, [len(ids)]))
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if lo == hi:
                continue
            if held and ids[lo] != block:
                yield out()
                held = []
            block = int(ids[lo])
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield out()


def block_words(texts: DataFrame) -> DataFrame:
    """Rows (_block, key, n): each word of a block and how often it is learned from there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, hashes, _, learn in _runs(batches):
            keys, at = np.unique(hashes, return_inverse=True)
            n = np.bincount(at, learn, len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), block)), pa.array(keys.view(np.int64)), pa.array(n)], names=["_block", "key", "n"])

    return map_arrow(texts.select("_block", "_learn", "text"), run, "_block long, key long, n long")


class Grams:
    """The distinct pairs of a block, sorted, and its triples under them, of words by number."""

    def __init__(self, numbers: np.ndarray, bounds: np.ndarray, bits: int):
        new = np.zeros(len(numbers), bool)
        new[bounds[:-1]] = True
        #: Place of the first word of each pair.
        self.at = np.flatnonzero(~new[1:])
        self.keys, self.pair = np.unique(scrambled(numbers[self.at], numbers[self.at + 1], bits), return_inverse=True)
        #: Pairs that another word follows.
        self.follows = np.flatnonzero(np.diff(self.at) == 1)
        own = (self.pair[self.follows].astype(np.uint64) << np.uint64(bits)) | numbers[self.at[self.follows] + 2].astype(np.uint64)
        self.triples, self.triple = np.unique(own, return_inverse=True)
        self.bits = bits

    def counts(self, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each pair and triple is learned from."""
        own = learn[self.at]
        return tuple(np.bincount(at, x, n).astype(np.int64) for at, x, n in ((self.pair, own, len(self.keys)), (self.triple, own[self.follows], len(self.triples))))

    def edges(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the pairs of each bucket begin, and their triples, and the ends."""
        bucket = ((self.keys >> np.uint64(2 * self.bits - 32)) * np.uint64(buckets)) >> _32
        edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        return edges, np.searchsorted(self.triples, edges.astype(np.uint64) << np.uint64(self.bits))

    def levels(self, learn: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
        """What goes to each bucket: its pairs and triples, with their counts."""
        n2, n3 = self.counts(learn)
        edges, inner = self.edges(buckets)
        for i in np.flatnonzero(np.diff(edges)).tolist():
            (a, b), (c, d) = edges[i : i + 2], inner[i : i + 2]
            triples = self.triples[c:d] - (np.uint64(a) << np.uint64(self.bits))
            yield i, pack(*_sequence(self.keys[a:b]), *_marked(n2[a:b]), *_sequence(triples), *_marked(n3[c:d]))


def _looked(own: np.ndarray, tables: list[tuple[np.ndarray, ...]], others: tuple[float, ...]) -> list[np.ndarray]:
    """The columns of each word in the tables (key, column, ...), which have no word in common."""
    out = [np.full(len(own), x) for x in others]
    for keys, *columns in tables:
        at = _find(keys, own)
        for held, values in zip(out, columns, strict=True):
            held[at >= 0] = values[at[at >= 0]]
    return out


def _messages(texts: DataFrame, rare: DataFrame, common, bits: int, unknown: int, buckets: int) -> DataFrame:
    """Rows (bucket, _block, level): the n-grams of each block, with their counts, by bucket.

    ``common`` are the sorted keys of the words of the first numbers; ``rare`` has the rows
    (_block, key, number) of the others that a block needs. What is not learned is ``unknown``.
    """

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        hashes, bounds = _tokens(*text_bytes(block.column("text")))
        own, word = np.unique(hashes, return_inverse=True)
        keys = common.value[0]
        tables = [(keys, np.arange(len(keys))), _sorted(*(found.column(c).to_numpy() for c in ("key", "number")))]
        (number,) = _looked(own, tables, (unknown,))
        learn = np.repeat(block.column("_learn").to_numpy(), np.diff(bounds))
        rows = list(Grams(number[word], bounds, bits).levels(learn, buckets))
        ids = np.full(len(rows), block.column("_block")[0].as_py(), np.int64)
        return pa.table({"bucket": pa.array([i for i, _ in rows], pa.int32()), "_block": pa.array(ids), "level": pa.array([x for _, x in rows], pa.binary())})

    ship(texts.sparkSession)
    rows = texts.select("_block", "_learn", "text").groupBy("_block").cogroup(rare.select("_block", "key", "number").groupBy("_block"))
    return rows.applyInArrow(run, "bucket int, _block long, level binary")


def _answers(messages: DataFrame, bits: int) -> DataFrame:
    """By bucket the n-grams of the model for each block that has them, and in a row without block
    the discounted counts of the pairs by their first word."""
    width, mask = np.uint64(bits), np.uint64((1 << bits) - 1)

    def answer(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        blocks_ = table.column("_block").to_pylist()
        sent = [unpack(x.as_py()) for x in table.column("level")]
        keys = [_values(x[:4]) for x in sent]
        triples = [_values(x[7:11]) for x in sent]
        starts = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
        inner = np.concatenate(([0], np.cumsum([len(t) for t in triples])))
        all_keys, pair = np.unique(np.concatenate(keys), return_inverse=True)
        n2 = np.concatenate([_unmarked(x[4:7], len(k)) for x, k in zip(sent, keys, strict=True)])
        c2 = np.bincount(pair, n2, len(all_keys)).astype(np.int64)
        under = np.concatenate([(pair[a + (t >> width).astype(np.int64)].astype(np.uint64) << width) | (t & mask) for a, t in zip(starts[:-1], triples, strict=True)])
        all_triples, triple = np.unique(under, return_inverse=True)
        n3 = np.concatenate([_unmarked(x[11:14], len(t)) for x, t in zip(sent, triples, strict=True)])
        c3 = np.bincount(triple, n3, len(all_triples)).astype(np.int64)
        in2, in3 = c2 >= LEAST_COUNT, c3 >= LEAST_COUNT
        taken = np.bincount((all_triples[in3] >> width).astype(np.int64), c3[in3] - DISCOUNT, len(all_keys))
        back = 1 - taken / np.maximum(c2, 1)
        words, at = np.unique(first_of(all_keys[in2], bits), return_inverse=True)
        rows = [(None, pack(words, np.bincount(at, c2[in2] - DISCOUNT, len(words)).astype(np.float64)))]
        for i, block in enumerate(blocks_):
            own, own3 = pair[starts[i] : starts[i + 1]], triple[inner[i] : inner[i + 1]]
            on, on3 = in2[own], in3[own3]
            if on.any():
                place = np.cumsum(on) - 1
                t = triples[i][on3]
                t = (place[(t >> width).astype(np.int64)].astype(np.uint64) << width) | (t & mask)
                kept, kept3 = own[on], own3[on3]
                pointers = np.searchsorted(t, np.arange(len(kept) + 1, dtype=np.uint64) << width)
                share = (c3[kept3] - DISCOUNT) / c2[(all_triples[kept3] >> width).astype(np.int64)]
                levels = [*_sequence(keys[i][on]), *_sequence(pointers), *_sequence(t)]
                rows.append((block, pack(*levels, quantised(c2[kept] - DISCOUNT), quantised(back[kept]), quantised(share))))
        return pa.table({"_block": pa.array([b for b, _ in rows], pa.int64()), "bucket": pa.array([bucket] * len(rows), pa.int32()), "level": pa.array([x for _, x in rows], pa.binary())})

    return messages.groupBy("bucket").applyInArrow(answer, "_block long, bucket int, level binary")


def _taken(answers: DataFrame) -> DataFrame:
    """Rows (number, taken): the discounted counts of all pairs in the model by their first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for level in batch.column("level"):
                words, taken = unpack(level.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(taken)], names=["number", "taken"])

    sums = map_arrow(answers.where("_block IS NULL").select("level"), run, "number long, taken double")
    return sums.groupBy("number").agg(F.sum("taken").alias("taken"))


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value among sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


class Trie:
    """The part of the trie that one bucket gave: pairs, pointers to their successors, successors,
    each the place of its pair and ``bits`` bits of the word."""

    def __init__(self, arrays: list[np.ndarray], bits: int = 32):
        self.bits = np.uint64(bits)
        self.pairs, self.least = _held(arrays[:4])
        self.pointers, _ = _held(arrays[4:8])
        self.successors, self.least3 = _held(arrays[8:12])
        self.amounts, self.weights, self.shares = arrays[12:]

    def find_pairs(self, keys: np.ndarray) -> np.ndarray:
        """The place of each pair, or -1."""
        known = keys >= self.least
        whole = np.zeros(len(keys), np.int64)
        return self.pairs.find(whole, np.where(known, self.pairs.n, 0), np.where(known, keys - self.least, 0))

    def find_successors(self, place: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The place of each word among the successors of the pair at ``place``, or -1."""
        value = place.astype(np.uint64) << self.bits | (word & np.uint64((1 << int(self.bits)) - 1))
        lo, hi = self.pointers[place], self.pointers[place + 1]
        known = (value >= self.least3) & (lo < hi)
        return self.successors.find(lo, np.where(known, hi, lo), np.where(known, value - self.least3, 0))


class Model:
    """What the model has on one block: its words, and the parts of the trie, mapped from a file.

    ``words`` are tables (key, number, count, taken); ``buckets`` are the numbers of the buckets
    that gave the ``levels``, out of ``n_buckets``.
    """

    def __init__(self, words: list[tuple[np.ndarray, ...]], levels: list[bytes], buckets: list[int], n_buckets: int, stats: dict):
        self.words, self.stats, self.n_buckets = words, stats, n_buckets
        self.tries: dict[int, Trie] = {}
        if levels:
            with tempfile.TemporaryFile() as file:  # it has no name, and goes with the mapping
                places = []
                for level in levels:
                    places.append(file.tell())
                    file.write(level)
                file.flush()
                held = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
            self.tries = {bucket: Trie(unpack(held, at), stats["bits"]) for bucket, at in zip(buckets, places, strict=True)}

    def score(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each token, and log10 of its probability after those before it."""
        own, word = np.unique(hashes, return_inverse=True)
        number, c1, taken = _looked(own, self.words, (self.stats["V"], 0.0, 0.0))
        p1 = np.where(c1 > 0, (c1 - self.stats["d"]) / max(self.stats["N"], 1), self.stats["unknown"])
        back1 = 1 - taken / np.maximum(c1, 1)
        grams = Grams(number[word], bounds, self.stats["bits"])
        p = p1[word]
        if len(grams.at):
            amounts, back2, shares = self._looked_up(grams)
            u, v = word[grams.at], word[grams.at + 1]
            p2 = amounts[grams.pair] / np.maximum(c1[u], 1) + back1[u] * p1[v]
            p[grams.at + 1] = p2
            f = grams.follows
            p[grams.at[f] + 2] = shares[grams.triple] + back2[grams.pair[f]] * p2[f + 1]
        return c1[word], np.log10(np.maximum(p, 1e-300))

    def _looked_up(self, grams: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Discounted counts and back-off weights of the distinct pairs, own shares of the triples."""
        amounts, back2, shares = np.zeros(len(grams.keys)), np.ones(len(grams.keys)), np.zeros(len(grams.triples))
        edges, inner = grams.edges(self.n_buckets)
        for i, trie in self.tries.items():
            (a, b), (c, d) = edges[i : i + 2], inner[i : i + 2]
            place = trie.find_pairs(grams.keys[a:b])
            on = np.flatnonzero(place >= 0)
            amounts[a + on] = amount(trie.amounts[place[on]])
            back2[a + on] = probability(trie.weights[place[on]])
            under = place[(grams.triples[c:d] >> trie.bits).astype(np.int64) - a]
            reached = np.flatnonzero(under >= 0)
            at = trie.find_successors(under[reached], grams.triples[c:d][reached])
            shares[c + reached[at >= 0]] = probability(trie.shares[at[at >= 0]])
        return amounts, back2, shares


def _columns(df: DataFrame, *names: str) -> list[np.ndarray]:
    table = df.toArrow()
    return [table.column(c).to_numpy() for c in names]


def _sorted(keys: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    keys = keys.view(np.uint64)
    order = np.argsort(keys)
    return keys[order], *(x[order] for x in others)


def train(counts: DataFrame) -> dict:
    """Corpus figures from the counts (key, n) of all words that are learned."""
    row = counts.agg(F.sum("n"), F.count("*"), F.sum((F.col("n") == 1).cast("long")), F.sum((F.col("n") == 2).cast("long"))).first()
    total, distinct, once, twice = (int(x or 0) for x in row)
    d = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5
    bits = max(16, distinct.bit_length())  # of the numbers of words, and of one more for the unknown
    if bits > 32:
        raise ValueError(f"{distinct} distinct words; numbers of words have 32 bits")
    return {"N": total, "V": distinct, "d": d, "unknown": d * distinct / total if total else 1.0, "bits": bits}


def _numbered(words: DataFrame, start: int) -> DataFrame:
    """``words``, stored with their ``_id`` by partition, with numbers from ``start`` on."""
    sizes = words.groupBy(F.shiftright("_id", 33).alias("_part")).count().orderBy("_part").collect()
    starts = np.cumsum([start] + [r["count"] for r in sizes]).tolist()
    parts = words.sparkSession.createDataFrame([(r["_part"], x) for r, x in zip(sizes, starts)], "_part long, _start long")
    own = words.withColumn("_part", F.shiftright("_id", 33)).join(F.broadcast(parts), "_part")
    return own.select("key", "n", (F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).alias("number"))


def score_documents(docs: DataFrame, learn: Callable[[], F.Column]) -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    The model learns from the rows where ``learn()`` holds. A null text is empty and has one
    token, the end. Repeated rows count as often as they stand and are scored alike. Without
    training text every score is 0 and no word is known. Columns of these names are replaced.
    """
    docs = docs.drop("n_tokens", "n_known", "train_tokens", "base_score", "score")
    context = docs.sparkSession.sparkContext
    texts = dealt(blocked(docs.withColumn("_learn", F.coalesce(learn(), F.lit(False)))), "_block", "text-blocks")
    with Scratch(docs.sparkSession) as scratch:
        in_block = scratch.stored(block_words(texts), "block-words")
        counts = scratch.stored(in_block.where("n > 0").groupBy("key").agg(F.sum("n").alias("n")), "word-counts")
        stats = train(counts)
        common = F.col("n") >= COUNT_SHARE * stats["N"]
        own = _sorted(*_columns(counts.where(common), "key", "n"))
        rare = scratch.stored(counts.where(~common).withColumn("_id", F.monotonically_increasing_id()), "rare-words")
        rare = stored(in_block.select("_block", "key").join(_numbered(rare, len(own[0])), "key"), "rare-block-words")
    held = context.broadcast(own)
    buckets = max(BUCKETS, stats["N"] // BUCKET_TOKENS)
    answers = stored(_answers(_messages(texts, rare, held, stats["bits"], stats["V"], buckets), stats["bits"]), "answers")
    taken = stored(_taken(answers), "taken")
    first = np.zeros(len(own[0]))
    places, sums = _columns(taken.where(F.col("number") < len(first)), "number", "taken")
    first[places] = sums
    held_taken = context.broadcast(first)
    rare = rare.join(taken.where(F.col("number") >= len(first)), "number", "left").withColumn("taken", F.coalesce("taken", F.lit(0.0)))
    rare = rare.select("_block", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("level"), "key", "number", "n", "taken")
    none = [F.lit(None).cast(kind).alias(c) for c, kind in (("key", "long"), ("number", "long"), ("n", "long"), ("taken", "double"))]
    known = answers.where("_block IS NOT NULL").select("_block", "bucket", "level", *none).unionByName(rare)
    names = [c for c in docs.columns if c != "text"]
    per_token = float(np.log10(stats["N"] + 0.5 * (stats["V"] + 1)))

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        parts = found.filter(found.column("level").is_valid()) if len(found) else found
        levels, numbers = parts.column("level").to_pylist(), parts.column("bucket").to_pylist()
        own = found.filter(found.column("key").is_valid()) if len(found) else found
        keys, counts = held.value
        words = [(keys, np.arange(len(keys)), counts, held_taken.value), _sorted(*(own.column(c).to_numpy() for c in ("key", "number", "n", "taken")))]
        hashes, bounds = _tokens(*text_bytes(block.column("text")))
        n, logs = Model(words, levels, numbers, buckets, stats).score(hashes, bounds)
        if not stats["N"]:
            logs = np.zeros(len(n))
            base = logs
        else:
            base = np.log10(n + 0.5) - per_token
        sums = [np.add.reduceat(x, bounds[:-1]) for x in ((n > 0).astype(np.int64), base, logs)]
        made = [np.diff(bounds).astype(np.int64), sums[0], np.full(len(block), stats["N"], np.int64), sums[1], sums[2]]
        return pa.table([*(block.column(c) for c in names), *map(pa.array, made)], names=[*names, *_MADE])

    ship(docs.sparkSession)
    schema = ", ".join([*fields(docs, *names)] * bool(names) + [f"{c} {kind}" for c, kind in _MADE.items()])
    texts = texts.select("_block", "text", *names)
    return texts.groupBy("_block").cogroup(known.groupBy("_block")).applyInArrow(run, schema)


_MADE = {"n_tokens": "long", "n_known": "long", "train_tokens": "long", "base_score": "double", "score": "double"}


def op8_elias_fano(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document, learned from those not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out(1, 5))
    return score_documents(docs, lambda: ~F.col("held_out"))
