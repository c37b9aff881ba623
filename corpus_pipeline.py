"""From raw documents to encoded training text, in five stages.

Every stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read
again as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import read
from barloom.llm.decontaminate import uncontaminated
from barloom.llm.langid import identified
from barloom.llm.lines import without_boilerplate
from barloom.llm.neardup import without_near_duplicates
from barloom.llm.sentencepiece import encode_documents
from barloom.session import scratch_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language: a null text, one without any letter, or noise to the network."""
    return identified(docs)


def boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines that stand on many sites out of the texts; no document goes."""
    return without_boilerplate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of exact and near copies."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return uncontaminated(docs, read(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds each document's piece ids, and whether they decode to its text."""
    rows = encode_documents(docs.drop("token_ids", "n_tokens", "decoded", "round_trip"))
    return rows.withColumn("round_trip", F.col("decoded") == F.coalesce("text", F.lit(""))).drop("decoded")


STAGES = [
    ("language", language),
    ("boilerplate", boilerplate),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pieces", pieces),
]

#: No SQL can state the network, the samples or the piece search; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
