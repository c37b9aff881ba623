"""Exact deduplication by deterministic block naming.

A text without white space is cut into blocks of fixed size. The distinct blocks of all texts
are sorted and named by their rank. Then the pairs of neighbouring names are sorted and named
in turn, level by level, until one name is left of every text. A name stands for one sequence
of bytes only, so two texts of equal level and name are equal: no hash decides.

On the way to the sort a block travels with a 128-bit label. Texts are shuffled once, to bring
equal blocks together; every later step moves labels and integers. That each label stands for
one block is checked over all blocks, and all are labelled anew if it does not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.common import Scratch, map_arrow, read, stored

#: Bytes of a block.
BLOCK = 4096
#: Bytes of blocks that go to the JVM at once.
_BATCH_BYTES = 4 << 20
_SPACES = b" \t\n\x0b\x0c\r"

Labeller = Callable[[bytes, int], bytes]


def label_of(block: bytes, seed: int) -> bytes:
    return hashlib.blake2b(block, digest_size=16, salt=seed.to_bytes(8, "big")).digest()


def normalised(text: str | None) -> bytes:
    """UTF-8 without the characters `[\\x20\\x09-\\x0D]`; of a null, nothing."""
    return (text or "").encode("utf-8", "surrogatepass").translate(None, _SPACES)


def _cut(text: bytes, size: int) -> list[bytes]:
    """At least one block: an empty text is an empty block."""
    return [text[i : i + size] for i in range(0, len(text), size)] or [b""]


def _labelled_blocks(docs: DataFrame, seed: int, size: int, label: Labeller) -> DataFrame:
    """Label and bytes of every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, found = 0, []
            for text in batch.column("text"):
                for block in _cut(normalised(text.as_py()), size):
                    found.append((label(block, seed), block))
                    held += len(block)
                    if held > _BATCH_BYTES:
                        yield _blocks_batch(found)
                        held, found = 0, []
            yield _blocks_batch(found)

    return map_arrow(docs.select("text"), run, "label binary, block binary")


def _blocks_batch(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    columns = [pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, names=["label", "block"])


def _rows(docs: DataFrame, seed: int, size: int, label: Labeller) -> DataFrame:
    """Id, length, digest and block labels of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, labels = [], []
            for text in batch.column("text"):
                text = normalised(text.as_py())
                digests.append(hashlib.sha256(text).hexdigest())
                labels.append([label(block, seed) for block in _cut(text, size)])
            n_chars = pc.fill_null(pc.utf8_length(batch.column("text")), 0).cast(pa.int64())
            columns = [batch.column("doc_id"), n_chars, pa.array(digests, pa.string()), pa.array(labels, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_chars", "text_sha256", "labels"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(docs, run, "doc_id long, n_chars long, text_sha256 string, labels array<binary>").withColumn("_row", F.monotonically_increasing_id())


def dense_names(keys: DataFrame, scratch: Scratch) -> DataFrame:
    """Distinct ``keys`` with ``name``: the rank of each in sorted order, from 0.

    Sorted by ranges; a name is the place in the range plus the size of all ranges before,
    so it does not depend on how many ranges there are. One row for each range is broadcast.
    """
    columns = keys.columns
    placed = keys.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn("_place", F.monotonically_increasing_id())
    placed = scratch.stored(placed, "places").select(*columns, F.shiftright("_place", 33).alias("_range"), F.col("_place").bitwiseAND((1 << 33) - 1).alias("_rank"))
    before = F.sum("count").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = placed.groupBy("_range").count().select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(offsets), "_range").select(*columns, (F.col("_before") + F.col("_rank")).alias("name"))


def _named_blocks(docs: DataFrame, size: int, label: Labeller, scratch: Scratch) -> tuple[DataFrame, int]:
    """Every label with the name of its block, and the seed of labels that no two blocks share."""
    for seed in range(16):
        blocks = _labelled_blocks(docs, seed, size, label).groupBy("label", "block").agg(F.lit(1).alias("one"))
        known = scratch.stored(blocks.groupBy("label").agg(F.count("*").alias("n_blocks")), "labels")
        if not known.where("n_blocks > 1").limit(1).count():
            return dense_names(known.select("label"), scratch), seed
    raise RuntimeError("different blocks shared a label under every seed")


def identities(docs: DataFrame, size: int = BLOCK, label: Labeller = label_of) -> DataFrame:
    """One row per document: ``doc_id``, ``n_chars``, ``text_sha256``, ``level`` and ``name``.

    Documents of equal ``level`` and ``name`` have equal texts but for white space, and no
    others do. ``n_chars`` are the code points of the whole original text, ``text_sha256`` is
    the digest of the text without white space, ``_row`` a number of the row.
    """
    with Scratch(docs.sparkSession) as scratch:
        blocks, seed = _named_blocks(docs, size, label, scratch)
        rows = scratch.stored(_rows(docs, seed, size, label), "rows")
        placed = rows.select("_row", F.size("labels").cast("long").alias("n"), F.posexplode("labels").alias("pos", "label"))
        now = placed.join(blocks, "label").select("_row", F.col("pos").cast("long").alias("pos"), "n", "name")
        longest = rows.agg(F.max(F.size("labels"))).first()[0] or 1
        done = [now.where("n = 1").select("_row", F.lit(0).alias("level"), "name")]
        for level in range(1, (longest - 1).bit_length() + 1):
            even = F.col("pos") % 2 == 0
            pairs = (
                now.where("n > 1")
                .groupBy("_row", "n", F.shiftright("pos", 1).alias("pos"))
                .agg(F.max(F.when(even, F.col("name"))).alias("left"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("right"))
            )
            pairs = scratch.stored(pairs, f"pairs-{level}")
            names = dense_names(pairs.select("left", "right").distinct(), scratch)
            now = pairs.join(names, ["left", "right"]).select("_row", "pos", F.shiftright(F.col("n") + 1, 1).alias("n"), "name")
            done.append(now.where("n = 1").select("_row", F.lit(level).alias("level"), "name"))
        found = done[0]
        for other in done[1:]:
            found = found.unionByName(other)
        return stored(rows.drop("labels").join(found, "_row"), "identities")


def exact_groups(docs: DataFrame, size: int = BLOCK, label: Labeller = label_of) -> DataFrame:
    """One row per document, with the group of those whose texts are equal but for white space.

    ``keep_id`` is the id of the row that stays, ``group_size`` the rows of the group, ``kept``
    whether this row stays. Of a group the longest original text stays (in code points), then
    the smallest id, a null id last; of repeated rows one. ``level`` and ``name`` identify the
    group. A null text is empty, so nulls, empty and blank texts are one group. Texts of any
    length are read whole. Other columns are left aside; an empty table gives an empty result.
    """
    members = identities(docs, size, label)
    first = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row"))
    groups = members.groupBy("level", "name").agg(F.count("*").alias("group_size"), first.alias("_first")).where("group_size > 1")
    groups = stored(groups.select("level", "name", "group_size", F.col("_first.doc_id").alias("_keep"), F.col("_first._row").alias("_kept")), "groups")
    alone = F.col("group_size").isNull()
    return members.join(groups, ["level", "name"], "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_row") == F.col("_kept"))).alias("kept"),
        "text_sha256",
        "level",
        "name",
    )


def op13_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of equal texts and the document that stays."""
    return exact_groups(read(spark, sf_dir, "documents")).drop("level", "name")


OP13_SQL = r"""
WITH rows AS (
    SELECT doc_id, coalesce(length(text), 0) AS n_chars,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
    FROM documents),
ranked AS (
    SELECT doc_id, plain, count(*) OVER (PARTITION BY plain) AS group_size,
           first_value(doc_id) OVER (PARTITION BY plain ORDER BY n_chars DESC, doc_id) AS keep_id
    FROM rows)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256
FROM ranked
"""
