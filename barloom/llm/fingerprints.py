"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the k smallest distinct hashes of a text's shingles. Two sketches merge to
that of both texts' shingles together, so sketches of parts give the sketch of the whole.
They estimate the distinct shingle count, resemblance and containment; a sketch of fewer
than k hashes is the whole set, and its estimates are exact.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import fields, map_arrow, mix, read

#: Hashes of a sketch.
K = 128
#: Characters of a shingle. Characters, not words, so that a text of few words has many.
SHINGLE = 9

_ODD = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.zeros(0, np.uint64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def shingle_hashes(points: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A hash of every run of ``size`` characters; of the whole text if it is shorter."""
    if not len(points):
        return _EMPTY
    values = mix(points.astype(np.uint64) + np.uint64(1))
    size = min(size, len(points))
    n = len(points) - size + 1
    h = np.zeros(n, np.uint64)
    for j in range(size):
        h = h * _ODD + values[j : j + n]
    return mix(h + np.uint64(size))


def bottom(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct hashes, ascending."""
    if len(hashes) > 16 * k:  # most lie beyond the k smallest
        low = hashes[hashes < np.uint64(int(4 * k / len(hashes) * 2**64))]
        found = np.unique(low)
        if len(found) >= k:
            return found[:k]
    return np.unique(hashes)[:k]


def sketch(text: str | None, k: int = K, size: int = SHINGLE) -> np.ndarray:
    return bottom(shingle_hashes(code_points(text or ""), size), k)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    return np.union1d(a, b)[:k]


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[-1]) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """The share of the shingles of either text that both have; 1 for two empty texts."""
    if not len(a) and not len(b):
        return 1.0
    both = np.sort(np.concatenate((a, b)))
    again = both[1:] == both[:-1]
    distinct = both[np.concatenate(([True], ~again))][:k]
    return int(np.count_nonzero(both[1:][again] <= distinct[-1])) / len(distinct)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """The share of a's shingles that b has; 1 if a has none."""
    if not len(a):
        return 1.0
    both = distinct_shingles(merge(a, b, k), k)
    return min(1.0, resemblance(a, b, k) * both / max(distinct_shingles(a, k), 1.0))


def encode(hashes: np.ndarray) -> str:
    return base64.b64encode(hashes.astype(">u8").tobytes()).decode()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def fingerprint_documents(docs: DataFrame, k: int = K, size: int = SHINGLE) -> DataFrame:
    """``docs`` with ``fingerprint`` (string) and ``n_shingles`` (estimate); a null text is empty."""
    docs = docs.drop("fingerprint", "n_shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sketch(x.as_py(), k, size) for x in batch.column("text")]
            columns = [*batch.columns, pa.array([encode(x) for x in found], pa.string()), pa.array([distinct_shingles(x, k) for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "fingerprint", "n_shingles"])

    return map_arrow(docs, run, ", ".join([*fields(docs), "fingerprint string, n_shingles double"]))


def _range_of(column: str, bounds: list[int]) -> Column:
    """How many bounds are below the value, found in two steps; 0 for a null."""
    step = max(1, math.isqrt(len(bounds)))
    runs = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    if not runs:
        return F.lit(0)
    below = lambda held: F.size(F.filter(held, lambda x: x < F.col(column)))
    whole = below(F.array(*[F.lit(run[-1]) for run in runs]))
    run = F.get(F.array(*[F.array(*map(F.lit, run)) for run in runs]), whole)
    return F.when(F.col(column).isNull(), 0).otherwise(whole * step + F.coalesce(below(run), F.lit(0)))


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Documents (doc_id, text) in partitions by ranges of doc_id, in order within each.

    Every range ends with a copy of the first document of the next one (``_after`` true), the
    last with the first of all, so a document's successor is the row that follows it. The
    ranges are bounded by quantiles of doc_id, so the text moves once. The driver gets one id
    for each range.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = []
    if parts > 1:
        bounds = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 20 * parts)).first()[0] or []
    placed = docs.withColumn("_range", _range_of("doc_id", sorted(set(bounds))))
    heads = placed.groupBy("_range").agg(F.min("doc_id").alias("id"), (F.count("*") > F.count("doc_id")).alias("null_first")).collect()
    heads = [(h["_range"], None if h["null_first"] else h["id"]) for h in sorted(heads, key=lambda h: h["_range"])]
    if not heads:
        return placed.withColumn("_after", F.lit(False))
    follows = [(place, after) for (place, _), (_, after) in zip(heads, heads[1:] + heads[:1], strict=True)]
    closing = spark.createDataFrame(follows, "_range int, id long")
    first = docs.join(F.broadcast(closing), F.col("doc_id").eqNullSafe(F.col("id"))).groupBy("_range", "doc_id").agg(F.min("text").alias("text"))
    rows = placed.withColumn("_after", F.lit(False)).unionByName(first.withColumn("_after", F.lit(True)))
    return rows.repartitionById(parts, F.col("_range")).sortWithinPartitions("_range", "_after", "doc_id", "text")


def edited_fingerprints(docs: DataFrame, k: int = K, size: int = SHINGLE) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness.

    The edited text is the text with its last quarter (floor of characters / 4) replaced by
    the first as many characters, or all, of the next document by doc_id; after the last
    document comes the first. A null text is empty; a null id comes first; documents of one id
    are ordered by text. An empty table gives an empty result.
    """
    rows = with_next(docs.select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the document whose successor is not yet seen
        for batch in batches:
            out = []
            for doc_id, text, after in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), batch["_after"].to_pylist(), strict=True):
                points = code_points(text)
                h = shingle_hashes(points, size)
                own = bottom(h, k)
                if held is not None:
                    out.append(_pair(held, text, points, own, k, size))
                held = None if after else (doc_id, text, points, h, own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), _TYPES, strict=True)], names=_NAMES)

    return map_arrow(rows.select("doc_id", "text", "_after"), run, _SCHEMA)


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _pair(held: tuple, after: str, after_points: np.ndarray, after_sketch: np.ndarray, k: int, size: int) -> tuple:
    doc_id, text, points, h, own = held
    n = len(points)
    kept = n - n // 4
    edited = text[:kept] + after[: n - kept]
    edited_points = np.concatenate((points[:kept], after_points[: n - kept]))
    whole = kept - size + 1  # shingles that the edit leaves as they are
    if whole > 0:
        edited_hashes = np.concatenate((h[:whole], shingle_hashes(edited_points[whole:], size))) if len(edited_points) - whole >= size else h[:whole]
    else:
        edited_hashes = shingle_hashes(edited_points, size)
    other = bottom(edited_hashes, k)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, n, digest, encode(own), encode(other), resemblance(own, other, k), resemblance(own, after_sketch, k)


def op5_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return edited_fingerprints(read(spark, sf_dir, "documents"))
