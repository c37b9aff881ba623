"""Line deduplication by distinct-site spread.

A line that stands on many sites is boilerplate. Every line hash gets a HyperLogLog
sketch of its sites; sketches merge by aggregation, before and after the shuffle. Lines
whose estimate is near the threshold get an exact count of sites, so the decision is
exact. Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import aside, checkpoint, read

#: Sites from which on a line counts as boilerplate.
MIN_SITES = 10
#: A text of which lines on many sites, at least this many of them, make up this share or more is
#: a copy of other texts; all copies of its kind count as one text when sites are counted.
COPY_LINES = 3
COPY_SHARE = 0.5
#: log2 of the sketch's registers; an estimate's standard error is 1.04 / sqrt(2 ** LG_K).
LG_K = 10


def _key(text: Column) -> list[Column]:
    """128 bits from two seeds."""
    return [F.xxhash64(text), F.xxhash64(F.lit("line"), text)]


def _lines(docs: DataFrame) -> DataFrame:
    """Text key, site, characters of all lines, and every distinct line that is not blank, with its key."""
    t1, t2 = _key(F.col("text"))
    full = F.filter(F.array_distinct(F.split("text", "\n")), lambda x: F.trim(x) != "")
    texts = docs.select(t1.alias("t1"), t2.alias("t2"), F.col("source").alias("site"), full.alias("full"))
    n_chars = F.aggregate("full", F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    lines = texts.select("t1", "t2", "site", n_chars.alias("n_chars"), F.explode("full").alias("line"))
    h1, h2 = _key(F.col("line"))
    return lines.select("t1", "t2", "site", "n_chars", "line", h1.alias("h1"), h2.alias("h2"))


def _spread(rows: DataFrame, min_sites: int, lg_k: int) -> DataFrame:
    """Keys (h1, h2) of the lines on at least ``min_sites`` sites: by sketches, and exactly near the threshold."""
    error = 5 * 1.04 / math.sqrt(1 << lg_k)
    low, high = min_sites * (1 - error) - 1, min_sites * (1 + error) + 1
    spread = (
        rows.groupBy("h1", "h2")
        .agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"))
        .select("h1", "h2", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= low)
    )
    spread = checkpoint(spread)
    sure = spread.where(F.col("sites") > high).select("h1", "h2")
    near = spread.where(F.col("sites") <= high).select("h1", "h2")
    exact = (
        rows.join(near, ["h1", "h2"], "left_semi")
        .groupBy("h1", "h2")
        .agg(F.count_distinct("site").alias("sites"))
        .where(F.col("sites") >= min_sites)
        .select("h1", "h2")
    )
    return sure.unionByName(exact)


def _by_text(docs: DataFrame, min_sites: int, lg_k: int) -> tuple[DataFrame, DataFrame]:
    """Rows (t1, t2, site, kind, lines): the lines of each distinct text that are on many sites if
    copies count, and the keys (h1, h2) of those that are if copies count as one.

    ``kind`` names the texts that count as one: the text itself, or for a copy the least digest
    of those lines, which copies with small changes share.
    """
    lines = _lines(docs.select("text", "source"))
    wide = checkpoint(_spread(lines.select("h1", "h2", "site"), min_sites, lg_k))
    line = F.struct("h1", "h2", F.length("line").cast("long").alias("n"), F.md5(F.col("line").cast("binary")).alias("digest"))
    texts = (
        lines.join(wide, ["h1", "h2"], "left_semi")
        .select("t1", "t2", "h1", "h2", "site", "n_chars", line.alias("line"))
        .groupBy("t1", "t2", "h1", "h2")  # copies of one text meet here in each task first
        .agg(F.min("site").alias("site"), F.min("n_chars").alias("n_chars"), F.min("line").alias("line"))
        .groupBy("t1", "t2")
        .agg(F.min("site").alias("site"), F.min("n_chars").alias("n_chars"), F.collect_list("line").alias("lines"))
    )
    shared = F.aggregate("lines", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    kind = F.when((F.size("lines") >= COPY_LINES) & (shared >= COPY_SHARE * F.col("n_chars")), F.array_min(F.transform("lines", lambda x: x["digest"])))
    texts = checkpoint(texts.withColumn("kind", F.coalesce(kind, F.concat_ws(" ", "t1", "t2"))))
    rows = texts.select("site", "kind", F.explode("lines").alias("line")).select("line.h1", "line.h2", "kind", "site")
    rows = rows.groupBy("h1", "h2", "kind").agg(F.min("site").alias("site"))
    return texts, _spread(rows, min_sites, lg_k)


def boilerplate_lines(docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """Keys (h1, h2) of the lines on at least ``min_sites`` distinct non-null sites.

    Equal texts count as one, on the least of their sites, and so do copies with small changes:
    texts of ``COPY_LINES`` such lines or more that make up ``COPY_SHARE`` of them or more, with the
    least digest of these lines in common. What stands on many sites only by whole copies is no boilerplate.
    """
    return _by_text(docs, min_sites, lg_k)[1]


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Documents without their boilerplate lines; all columns stay, ``text`` is what is left.

    Adds ``n_lines``, ``n_removed`` and ``n_chars_removed``. A line is what stands between
    newlines, compared exactly; blank lines are never removed. Every line on ``min_sites`` sites,
    as ``boilerplate_lines`` counts them, goes wherever it stands. A null text stays null with
    counts of 0, an empty one has one line. Rows with equal text are treated alike, repeated
    rows and null ids stay. A null source is no site. An empty table gives an empty result.
    """
    texts, bad = _by_text(docs, min_sites, LG_K)
    found = (
        texts.select("t1", "t2", F.explode("lines").alias("line"))
        .select("t1", "t2", "line.h1", "line.h2")
        .join(bad, ["h1", "h2"], "left_semi")
        .groupBy(F.col("t1").alias("_t1"), F.col("t2").alias("_t2"))
        .agg(F.collect_list(F.struct("h1", "h2")).alias("_found"))
    )
    t1, t2 = _key(F.col("text"))
    rows = docs.withColumns({"_t1": t1, "_t2": t2}).join(found, ["_t1", "_t2"], "left")
    h = lambda line: F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2"))
    length = lambda parts: F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    rows = rows.withColumn("_lines", F.split("text", "\n"))
    rows = rows.withColumn("_bad", F.when(F.col("_found").isNotNull(), F.filter("_lines", lambda x: (F.trim(x) != "") & F.array_contains("_found", h(x)))))
    rows = rows.withColumn("_cut", F.coalesce(F.size("_bad") > 0, F.lit(False)))
    kept = F.filter("_lines", lambda x: (F.trim(x) == "") | ~F.array_contains("_found", h(x)))
    return rows.select(
        *[c for c in docs.columns if c not in ("text", "n_lines", "n_removed", "n_chars_removed")],
        F.when(F.col("_cut"), F.array_join(kept, "\n")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"),
        F.when(F.col("_cut"), F.size("_bad")).otherwise(0).cast("long").alias("n_removed"),
        F.when(F.col("_cut"), length(F.col("_bad"))).otherwise(0).cast("long").alias("n_chars_removed"),
    )


def without_boilerplate(docs: DataFrame) -> DataFrame:
    """The same documents and columns, without boilerplate lines; ``n_chars``, if there, follows the text."""
    rows, own_columns = aside(docs, "n_lines", "n_removed", "n_chars_removed")
    rows = own_columns(dedup_lines(rows))
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rows


def op4_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: lines, lines removed, and the digest of the text that is left."""
    return dedup_lines(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", "n_chars_removed", F.sha2("text", 256).alias("text_sha256")
    )


OP4_SQL = f"""
WITH texts AS (SELECT text, min(source) AS site FROM documents WHERE text IS NOT NULL GROUP BY text),
own AS (
    SELECT DISTINCT text, site, line FROM (SELECT text, site, unnest(string_split(text, chr(10))) AS line FROM texts)
    WHERE trim(line, ' ') <> ''),
wide AS (
    SELECT o.line FROM own o JOIN documents d ON o.text = d.text GROUP BY o.line HAVING count(DISTINCT d.source) >= {MIN_SITES}),
kinds AS (
    SELECT o.text, CASE WHEN count(w.line) >= {COPY_LINES}
                         AND sum(length(o.line)) FILTER (WHERE w.line IS NOT NULL) >= {COPY_SHARE} * sum(length(o.line))
                        THEN min(md5(o.line)) FILTER (WHERE w.line IS NOT NULL) ELSE 'text ' || o.text END AS kind
    FROM own o LEFT JOIN wide w ON o.line = w.line GROUP BY o.text),
once AS (
    SELECT o.line, k.kind, min(o.site) AS site FROM own o JOIN wide w ON o.line = w.line JOIN kinds k ON o.text = k.text
    GROUP BY o.line, k.kind),
bad AS (SELECT line FROM once GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES}),
lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents WHERE text IS NOT NULL),
summed AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE b.line IS NOT NULL) AS n_bad,
           coalesce(sum(length(l.line)) FILTER (WHERE b.line IS NOT NULL), 0) AS bad_chars,
           coalesce(string_agg(l.line, chr(10) ORDER BY pos) FILTER (WHERE b.line IS NULL), '') AS kept
    FROM lines l LEFT JOIN bad b ON l.line = b.line GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_bad, 0)::BIGINT AS n_removed,
       coalesce(bad_chars, 0)::BIGINT AS n_chars_removed,
       sha256(CASE WHEN n_bad > 0 THEN kept ELSE d.text END) AS text_sha256
FROM documents d LEFT JOIN summed s ON d.doc_id = s.doc_id
"""
