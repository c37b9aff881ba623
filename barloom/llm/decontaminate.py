"""Benchmark decontamination by winnowing.

Of every window of consecutive k-gram hashes the smallest is kept (the last of equals), so
two texts that share a span of k + window - 1 words keep a common fingerprint within it.
Fingerprints of documents and benchmark items are joined, and each hit is extended word by
word along its diagonal to the whole shared span. Items shorter than a window of words are
matched by one hash of all their words.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import Words, aside, blocks, checkpoint, fields, gram_hashes, map_arrow, read, text_bytes

#: Words of a shared span that count as contamination.
SPAN = 10
#: Words of a fingerprint; GRAM + WINDOW - 1 = SPAN, which is the winnowing guarantee.
GRAM = 6
WINDOW = SPAN - GRAM + 1
#: Benchmark text up to this size goes to every task whole; a larger one is joined by shuffles.
BROADCAST_BYTES = 16 << 20

_KEY = ["_d1", "_d2"]


def _fingerprints(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that winnowing keeps of a block of texts, and the word each starts at."""
    h, at = words.grams(GRAM)
    n = len(h) - WINDOW + 1
    if n <= 0:
        return h[:0], at[:0]
    best, shift = h[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, WINDOW):
        x = h[j : j + n]
        lower = x <= best
        best[lower] = x[lower]
        shift[lower] = j
    within = words.text[at[:n]] == words.text[at[WINDOW - 1 :]]
    keep = np.unique((shift + np.arange(n))[within])
    return h[keep], at[keep]


class Index:
    """The windows of a set of items, found by fingerprint."""

    def __init__(self, items: list[tuple[str | None, str]]):
        self.names = [name for name, _ in items]
        data, offsets = text_bytes(pa.array([text for _, text in items], pa.large_string()))
        words = Words(data, offsets)
        self.words = [words.hash[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
        found = defaultdict(list)
        h, at = _fingerprints(words)
        for x, item, offset in zip(h.tolist(), words.text[at].tolist(), (at - words.bounds[words.text[at]]).tolist(), strict=True):
            found[x].append((item, offset))
        self.short = defaultdict(lambda: defaultdict(list))
        for item, own in enumerate(self.words):
            if 0 < len(own) < SPAN:
                self.short[len(own)][int(gram_hashes(own, len(own))[0])].append((item, 0))
        self.short = {k: (np.array(sorted(v), np.uint64), dict(v)) for k, v in self.short.items()}
        self.found = dict(found)
        self.keys = np.array(sorted(found), np.uint64)

    def candidates(self, words: Words) -> Iterator[tuple[int, int, int]]:
        """(word of the block, item, word of the item) of every fingerprint hit."""
        sets = [(*_fingerprints(words), self.keys, self.found)]
        sets += [(*words.grams(k), keys, found) for k, (keys, found) in self.short.items()]
        for h, at, keys, found in sets:
            if not len(keys) or not len(h):
                continue
            place = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            for i in np.flatnonzero(keys[place] == h).tolist():
                for item, offset in found[int(h[i])]:
                    yield int(at[i]), item, offset

    def mark(self, words: Words) -> tuple[np.ndarray, dict[int, set[int]]]:
        """Words inside an occurrence of a window, and the items of each text."""
        hit = np.zeros(len(words), bool)
        items: dict[int, set[int]] = defaultdict(set)
        seen = set()
        for at, item, offset in self.candidates(words):
            text = int(words.text[at])
            if (text, at - offset, item) in seen:
                continue
            own = self.words[item]
            lo = max(int(words.bounds[text]), at - offset)
            hi = min(int(words.bounds[text + 1]), at - offset + len(own))
            seen.add((text, at - offset, item))
            same = words.hash[lo:hi] == own[lo - (at - offset) : hi - (at - offset)]
            edges = np.flatnonzero(np.diff(np.concatenate(([0], same, [0]))))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if b - a >= min(SPAN, len(own)):
                    hit[lo + a : lo + b] = True
                    items[text].add(item)
        return hit, items


def _digest(names) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


#: What is found out about a document, as columns.
_FOUND = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _scan(docs: DataFrame, items: list[tuple[str | None, str]]) -> DataFrame:
    """One pass over the documents, against an index in every task."""
    index = docs.sparkSession.sparkContext.broadcast(Index(items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index_ = index.value
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            rows = {k: [] for k in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")}
            for lo, hi in blocks(offsets):
                words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1])
                hit, found = index_.mark(words)
                total = np.concatenate(([0], np.cumsum(hit)))
                n_hit = (total[words.bounds[1:]] - total[words.bounds[:-1]]).tolist()
                names = [{index_.names[i] for i in found.get(t, ())} - {None} for t in range(hi - lo)]
                rows["n_words"] += np.diff(words.bounds).tolist()
                rows["n_hit"] += n_hit
                rows["n_items"] += map(len, names)
                rows["items_sha256"] += map(_digest, names)
                rows["contaminated"] += [n > 0 for n in n_hit]
            columns = [batch.column(c) for c in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, rows.values())], names=[*batch.schema.names, *rows])

    return map_arrow(docs, run, ", ".join([*fields(docs), _FOUND]))


def _fingerprint_rows(df: DataFrame, key: list[str], lengths: list[int], short_only_short: bool) -> DataFrame:
    """Rows (key, fingerprint), distinct within a block; also all runs of as many words as ``lengths``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for lo, hi in blocks(offsets):
                words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1])
                size = np.diff(words.bounds)
                sets = [_fingerprints(words)]
                for k in lengths:
                    h, at = words.grams(k)
                    if short_only_short:
                        own = size[words.text[at]] == k
                        h, at = h[own], at[own]
                    sets.append((h, at))
                h, text = np.concatenate([x for x, _ in sets]), np.concatenate([words.text[at] for _, at in sets])
                pairs = np.unique(np.stack([text.astype(np.uint64), h]), axis=1) if len(h) else np.zeros((2, 0), np.uint64)
                rows = batch.slice(lo, hi - lo).select(key).take(pa.array(pairs[0].astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(pairs[1].view(np.int64))], names=[*key, "_fp"])

    return map_arrow(df.select(*key, "text"), run, ", ".join([*fields(df, *key), "_fp long"]))


def _joined(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The same by shuffles, for a benchmark of any size: join fingerprints, then extend pairs."""
    bench = checkpoint(bench.groupBy("_name", "text").agg(F.xxhash64("_name", "text").alias("_i1"), F.xxhash64(F.lit("item"), "_name", "text").alias("_i2")))
    docs = docs.withColumns({"_d1": F.xxhash64("text"), "_d2": F.xxhash64(F.lit("text"), "text")})
    texts = docs.where(F.col("text").isNotNull()).select(*_KEY, "text")
    short = list(range(1, SPAN))
    own = _fingerprint_rows(bench, ["_i1", "_i2"], short, True).distinct()
    hits = _fingerprint_rows(texts, _KEY, short, False).distinct().join(own, "_fp").select(*_KEY, "_i1", "_i2").distinct()
    pairs = hits.join(bench, ["_i1", "_i2"]).select(*_KEY, "_name", F.col("text").alias("item"))
    pairs = pairs.join(texts.dropDuplicates(_KEY), _KEY)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d1, d2, name, item, text in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "_name", "item", "text")), strict=True):
                data, offsets = text_bytes(pa.array([text], pa.large_string()))
                hit, found = Index([(name, item)]).mark(Words(data, offsets))
                if found:
                    at = np.flatnonzero(hit)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([d1], pa.int64()), pa.array([d2], pa.int64()), pa.array([name], pa.string()), pa.array([at.tolist()], pa.list_(pa.int64()))],
                        names=[*_KEY, "_name", "_at"],
                    )

    marks = checkpoint(map_arrow(pairs, extend, "_d1 long, _d2 long, _name string, _at array<long>"))
    n_hit = marks.select(*_KEY, F.explode("_at").alias("at")).distinct().groupBy(*_KEY).agg(F.count("*").alias("n_hit"))
    names = marks.where("_name IS NOT NULL").groupBy(*_KEY).agg(F.array_sort(F.collect_set("_name")).alias("_names"))
    counts = _scan(docs.select(*docs.columns), []).drop("n_hit", "n_items", "items_sha256", "contaminated")
    rows = counts.join(n_hit, _KEY, "left").join(names, _KEY, "left")
    listed = F.coalesce("_names", F.array().cast("array<string>"))
    return rows.select(
        *[c for c in docs.columns if c not in _KEY],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def contamination(docs: DataFrame, bench: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Documents with ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``.

    A null or empty text has no words. Repeated documents are judged alike; repeated items
    count once by their id, and an item without id hits words but is not listed. Empty
    tables give empty or clean results. Columns of these five names are replaced.
    """
    docs = docs.drop("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    bench = bench.where(F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("_name"), "text")
    size = bench.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        return _scan(docs, [tuple(row) for row in bench.distinct().collect()])
    return _joined(docs, bench)


def uncontaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents without any window of the benchmark, with their own columns."""
    rows, own_columns = aside(docs, "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return own_columns(contamination(rows, bench).where(~F.col("contaminated")))


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its words, those inside a benchmark window, and the items found."""
    return contamination(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark")).drop("text")


def _sql() -> str:
    lower = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = r"regexp_extract_all(" + lower + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH items AS (SELECT item_id, {words.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
    SELECT DISTINCT item_id, least(len(w), {SPAN}) AS n, array_to_string(w[s : s + least(len(w), {SPAN}) - 1], ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), {SPAN}) + 2)) AS s FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {words.format("coalesce(text, '')")} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
    SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS gram
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, s, g.n, item_id FROM grams g JOIN windows x ON g.n = x.n AND g.gram = x.gram),
marked AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN marked m ON d.doc_id = m.doc_id LEFT JOIN named n ON d.doc_id = n.doc_id
"""


OP1_SQL = _sql()
