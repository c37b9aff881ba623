"""Detection of periodic runs of words by recompression.

The words of a block of texts become one sequence of symbols, with a symbol of its own after
each text. Block and pair compression in turn replace it by shorter and shorter sequences: a
run of one symbol by a symbol for its power, then every pair of a left and a right symbol by a
symbol for the pair. The rules are a run-length grammar of the block. A query for the longest
common extension of two places climbs while both begin equal symbols, passes over equal
symbols and powers as a whole, and descends where they differ, in logarithmic time.

A run of period q and at least 4 q words holds four places of the grid 0, q, 2q, ..., with
equal words. So only such places of the grids of all periods (a harmonic sum) are candidates,
and two extensions, forwards and backwards, give the exact run around each.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import SPACED_BYTES, fields, map_arrow, mix, read

#: A run has at least this many words, and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Bytes of text that share a grammar; a longer text has one of its own.
GRAMMAR_BYTES = 2 << 20
#: Candidates that are extended at once; known runs rule out some of the later ones.
_CANDIDATES = 1 << 16
_CELLS = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


class Grammar:
    """A run-length grammar of a sequence, with every level of its derivation.

    All levels stand one after another in flat arrays, each between two sentinels. A node has
    a symbol, a parent in the next level and a first and last child in the one before.
    """

    def __init__(self, text: np.ndarray, n_symbols: int):
        levels, kept, powers = [text.astype(np.int64)], [], []
        sizes = [np.ones(n_symbols, np.int64)]
        self._next, idle = n_symbols, 0
        while len(levels[-1]) > 1 and idle < 16:
            before = len(levels[-1])
            for power, compress in ((True, self._blocks), (False, self._pairs)):
                found = compress(levels[-1], np.concatenate(sizes) if len(sizes) > 1 else sizes[0], len(levels) + idle)
                if found is not None:
                    symbols, keep, size = found
                    sizes = [np.concatenate([*sizes, size])]
                    levels.append(symbols)
                    kept.append(keep)
                    powers.append(power)
            idle = idle + 1 if len(levels[-1]) == before else 0
        self.size = np.concatenate(sizes)
        self._flatten(levels, kept, powers)

    def _blocks(self, symbols: np.ndarray, size: np.ndarray, seed: int) -> tuple | None:
        """Every run of one symbol becomes a symbol for its power."""
        keep = np.ones(len(symbols), bool)
        np.not_equal(symbols[1:], symbols[:-1], out=keep[1:])
        start = np.flatnonzero(keep)
        if len(start) == len(symbols):
            return None
        count = np.diff(start, append=len(symbols))
        shorter = symbols[start]
        at = np.flatnonzero(count > 1)
        base = int(count.max()) + 1
        rules, names = np.unique(shorter[at] * base + count[at], return_inverse=True)
        shorter[at] = self._next + names
        self._next += len(rules)
        return shorter, keep, size[rules // base] * (rules % base)

    def _pairs(self, symbols: np.ndarray, size: np.ndarray, seed: int) -> tuple | None:
        """Every left symbol before a right one becomes, with it, a symbol for the pair.

        Sides are bits of a hash of the symbol; of eight choices that with the most pairs.
        """
        bits = mix(symbols.astype(np.uint64) * np.uint64(2) + np.uint64(2 * seed + 1 << 40)).astype(np.uint8)
        best, turn = None, bits[:-1] ^ bits[1:]
        for i in range(4):
            one = np.uint8(1 << i)
            for side in (0, one):
                at = (turn & one != 0) & (bits[:-1] & one == side)
                n = np.count_nonzero(at)
                if best is None or n > best[0]:
                    best = n, at
        if not best[0]:
            return None
        at = np.flatnonzero(best[1])
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        rules, names = np.unique(symbols[at] * self._next + symbols[at + 1], return_inverse=True)
        sizes = size[rules // self._next] + size[rules % self._next]
        longer = symbols.copy()
        longer[at] = self._next + names
        self._next += len(rules)
        return longer[keep], keep, sizes

    def _flatten(self, levels: list, kept: list, powers: list) -> None:
        base = np.cumsum([0] + [len(x) + 2 for x in levels])
        total = int(base[-1])
        self.ground = len(levels[0]) + 2
        self.symbol = np.full(total, -1, np.int32)
        self.parent, self.first, self.last = (np.zeros(total, np.int32) for _ in range(3))
        self.head, self.tail, self.power = (np.zeros(total, bool) for _ in range(3))
        for i, symbols in enumerate(levels):
            lo, hi = int(base[i]) + 1, int(base[i + 1]) - 1
            self.symbol[lo:hi] = symbols
            if i:
                below = int(base[i - 1])
                self.first[lo:hi] = np.flatnonzero(kept[i - 1]) + below + 1
                self.first[lo - 1], self.first[hi] = below, lo - 2
                self.last[lo - 1] = below
                self.last[lo:hi] = self.first[lo + 1 : hi + 1] - 1
                self.last[hi] = lo - 2
            if i < len(kept):
                self.parent[lo:hi] = np.cumsum(kept[i]) + int(base[i + 1])
                self.parent[lo - 1], self.parent[hi] = base[i + 1], base[i + 2] - 1
                self.head[lo:hi] = kept[i]
                self.tail[lo : hi - 1] = kept[i][1:]
                self.tail[hi - 1] = True
                self.power[lo:hi] = powers[i]

    def extension(self, x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
        """How many words from x and from y on are equal, forwards (1) or backwards (-1)."""
        x, y = x.astype(np.int64) + 1, y.astype(np.int64) + 1
        edge, inner, outer = (self.head, self.first, self.last) if step > 0 else (self.tail, self.last, self.first)
        equal = np.zeros(len(x), np.int64)
        live, up = np.arange(len(x)), np.ones(len(x), bool)
        while len(live):
            symbol = self.symbol[x]
            same = symbol == self.symbol[y]
            climb = same & up & edge[x] & edge[y]
            over = np.flatnonzero(same & ~climb)
            if len(over):
                ox, oy = x[over], y[over]
                far = np.minimum(np.abs(outer[self.parent[ox]] - ox), np.abs(outer[self.parent[oy]] - oy)) + 1
                far = np.where(self.power[ox], far, 1)  # within a power, up to the end of the shorter one
                equal[live[over]] += far * self.size[symbol[over]]
                x[over] += step * far
                y[over] += step * far
            climb = np.flatnonzero(climb)
            x[climb], y[climb] = self.parent[x[climb]], self.parent[y[climb]]
            down = np.flatnonzero(~same & (x >= self.ground))
            ended = ~same & (x < self.ground)
            x[down], y[down] = inner[x[down]], inner[y[down]]
            up[down] = False
            if ended.any():
                stay = ~ended
                live, x, y, up = live[stay], x[stay], y[stay], up[stay]
        return equal


def _grid(text: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places i = k q of periods lo <= q < hi where i, i + q, i + 2q and i + 3q hold one word.

    With each place goes its period, and whether i - q is no such place.
    """
    found, n = [], len(text)
    rows = n // lo + 1
    width = max(1, _CELLS // rows)
    for at in range(lo, hi, width):
        periods = np.arange(at, min(at + width, hi))
        if len(periods) == 1:
            grid = text[:: periods[0]]
            equal = (grid[1:] == grid[:-1])[:, None]
        else:
            place = np.arange(n // at + 1)[:, None] * periods
            grid = text[np.minimum(place, n - 1)]
            equal = (grid[1:] == grid[:-1]) & (place[1:] < n)
        if len(equal) < 3:
            continue
        hit = equal[:-2] & equal[1:-1] & equal[2:]
        k, q = np.nonzero(hit)
        if len(k):
            new = (k == 0) | ~hit[np.maximum(k, 1) - 1, q]
            found.append((k * periods[q], periods[q], new))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _uncovered(at: np.ndarray, period: np.ndarray, runs: dict) -> np.ndarray:
    """Which places are not, with the place one period on, in a run whose period divides theirs."""
    free = np.ones(len(at), bool)
    order = np.argsort(at, kind="stable")
    ordered = at[order]
    for (start, end), p in runs.items():
        lo, hi = np.searchsorted(ordered, (start, end))
        own = order[lo:hi]
        free[own[(at[own] + period[own] < end) & (period[own] % p == 0)]] = False
    return free


def find_runs(text: np.ndarray, n_symbols: int, longest: int) -> np.ndarray:
    """All runs of a sequence as rows (start, end, period), by start, then period.

    ``longest`` bounds the words of a run; no run may cross a symbol that stands once only.
    """
    runs: dict[tuple[int, int], int] = {}
    grammar, held, count = None, [], 0
    most = longest // LEAST_PERIODS
    lo = 1
    while lo <= most:
        hi = min(2 * lo, most + 1)
        found = _grid(text, lo, hi)
        if len(found[0]):
            held.append(found)
            count += len(found[0])
        lo = hi
        if not count or (count < _CANDIDATES and lo <= most):
            continue
        at, period, new = (np.concatenate(x) for x in zip(*held, strict=True))
        held, count = [], 0
        grammar = grammar or Grammar(text, n_symbols)
        for first in (True, False):  # the first place of a row of places tells of most others
            own = new if first else ~new
            own = np.flatnonzero(own)[_uncovered(at[own], period[own], runs)]
            for part in range(0, len(own), _CANDIDATES):
                i, q = at[own[part : part + _CANDIDATES]], period[own[part : part + _CANDIDATES]]
                start = i - grammar.extension(i - 1, i + q - 1, -1)
                end = i + q + grammar.extension(i, i + q, 1)
                long = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
                for s, e, p in zip(start[long].tolist(), end[long].tolist(), q[long].tolist(), strict=True):
                    runs[s, e] = min(p, runs.get((s, e), p))  # a multiple of a run's period gives the same bounds
    rows = sorted((s, p, e) for (s, e), p in runs.items())
    return np.array([(s, e, p) for s, p, e in rows], np.int64).reshape(-1, 3)


class _Block:
    """Words of consecutive texts as numbers, a number of its own after each text."""

    def __init__(self):
        self.words: defaultdict[bytes, int] = defaultdict()
        self.words.default_factory = self.words.__len__
        self.parts, self.counts, self.bytes = [], [], 0

    def add(self, text: bytes) -> None:
        count, lo = 0, 0
        while lo < len(text):  # a long text in parts that end at white space
            hi = _SPACE.search(text, lo + GRAMMAR_BYTES)
            hi = hi.start() if hi else len(text)
            words = text[lo:hi].split()
            self.parts.append(np.fromiter(map(self.words.__getitem__, words), np.int32, len(words)))
            count += len(words)
            lo = hi
        self.counts.append(count)
        self.parts.append(np.array([-len(self.counts)], np.int32))
        self.bytes += len(text)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols, first place of each text (one more), and the runs."""
        text = np.concatenate(self.parts)
        text[text < 0] = len(self.words) - 1 - text[text < 0]
        bounds = np.concatenate(([0], np.cumsum(np.array(self.counts) + 1)))
        return text, bounds, find_runs(text, len(self.words) + len(self.counts), max(self.counts))

    def results(self) -> tuple[list[pa.Array], list[str]]:
        text, bounds, runs = self.runs()
        owner = np.searchsorted(bounds, runs[:, 0], "right") - 1
        drop = np.zeros(len(text) + 1, np.int32)
        np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
        np.add.at(drop, runs[:, 1], -1)
        keep = np.cumsum(drop[:-1]) == 0
        words, collapsed = list(self.words), []
        for lo, hi in zip(bounds[:-1].tolist(), (bounds[1:] - 1).tolist(), strict=True):
            own = text[lo:hi][keep[lo:hi]]
            parts = [b" ".join(map(words.__getitem__, own[i : i + _CELLS].tolist())) for i in range(0, len(own), _CELLS)]
            collapsed.append(b" ".join(parts).decode())
        n_runs = np.bincount(owner, minlength=len(self.counts))
        columns = [runs[:, 0] - bounds[owner], runs[:, 1] - runs[:, 0], runs[:, 2]]
        structs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["start", "length", "period"])
        offsets = pa.array(np.concatenate(([0], np.cumsum(n_runs))).astype(np.int32))
        return [pa.array(self.counts, pa.int64()), pa.ListArray.from_arrays(offsets, structs), pa.array(collapsed, pa.string())]


_MADE = {"n_words": "long", "runs": "array<struct<start:long,length:long,period:long>>", "collapsed": "string"}


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed``.

    Words are `[^\\x20\\x09-\\x0D]+`, compared exactly and numbered from 0. A run is a stretch
    of words with smallest period q and at least 6 and 4 q words that no neighbour extends;
    ``runs`` lists all by start, then period. ``collapsed`` is the text's words joined by one
    space, without the words that are in a run and after its first q words. A null, empty or
    blank text has no words, no runs and an empty ``collapsed``. Each row is treated on its
    own, so repeated rows give repeated results. A text of any length is treated whole, in
    one task. Columns of these names are replaced.
    """
    docs = docs.drop(*_MADE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, lo, texts = _Block(), 0, batch.column("text")
            for i, text in enumerate(texts):
                block.add((text.as_py() or "").encode())
                if block.bytes >= GRAMMAR_BYTES or i + 1 == len(texts):
                    own = batch.slice(lo, i + 1 - lo)
                    yield pa.RecordBatch.from_arrays([*own.columns, *block.results()], names=[*own.schema.names, *_MADE])
                    block, lo = _Block(), i + 1

    return map_arrow(docs, run, ", ".join([*fields(docs), *(f"{c} {kind}" for c, kind in _MADE.items())]))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period; of equals that with the least start, then period."""
    ahead = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, run: F.when(ahead(best, run), run).otherwise(best))


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the tail of every tenth text replaced by repetitions.

    With h = crc32(decimal doc_id) and g = floor(h / 10): where h % 10 = 0 and the text has
    n > 0 words, word i >= a becomes word a + (i - a) % p, with a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)). A text without id or words stays.
    """
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, h in enumerate(batch.column("h").to_pylist()):
                if h is not None and h % 10 == 0 and texts[i]:
                    texts[i] = repeated_tail(texts[i], h // 10)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", hashed.alias("h"))
    return map_arrow(docs, run, "doc_id long, text string")


def repeated_tail(text: str, g: int) -> str:
    data = text.encode()
    inside = SPACED_BYTES[np.frombuffer(data, np.uint8)]
    start = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    end = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False]))) + 1
    n = len(start)
    if not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times, rest = divmod(n - a, p)
    lo = int(start[a])
    whole = data[lo : int(end[min(a + p, n) - 1])] + b" "
    last = data[lo : int(end[a + rest - 1])] if rest else b""
    return (data[:lo] + whole * times + last).decode()


def op12_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, repeated tails included, and digests of runs and collapsed text."""
    rows = periodic_runs(with_repeated_tails(read(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = strongest(F.col("runs"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        best.alias("_best"),
    ).select(
        "doc_id",
        "n_runs",
        *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
