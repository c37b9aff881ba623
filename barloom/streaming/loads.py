"""Numbers of the loads that a streaming query appends to the clean layer.

A load is the batch of one query, and has directories of its own in the layer. Beside them,
in a folder that readers pass over, stand the first number of each query and, at intervals,
the time of a load. So a query knows which loads its state still remembers.
"""

from __future__ import annotations

import time
import zlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from barloom.schemas import SILVER_STORED
from barloom.sources.paths import create_text, delete, names, read_text

_SLOTS = 64


def highest_load(spark: SparkSession, path: str) -> int:
    """The highest number stored; -1 if there is none."""
    if not any("=" in n for n in names(spark, path)):
        return -1
    found = spark.read.schema(SILVER_STORED).parquet(path).agg(F.max("load_id")).first()[0]
    return -1 if found is None else max(found, -1)


class Loads:
    """The loads of the query with this ``checkpoint``: number ``first + batch``.

    ``memory_ms`` is how long, at least, the query's state remembers an id.
    """

    def __init__(self, spark: SparkSession, path: str, checkpoint: str, memory_ms: int):
        self.spark, self.memory_ms = spark, memory_ms
        self._folder = f"{path.rstrip('/')}/_loads/{zlib.crc32(checkpoint.rstrip('/').encode()):08x}"
        if not names(spark, self._folder):
            create_text(spark, f"{self._folder}/first", str(highest_load(spark, path) + 1))
        self.first = int(read_text(spark, f"{self._folder}/first"))

    def number(self, batch_id: int) -> int:
        return self.first + batch_id

    def remembered(self, load: int, now_ms: int | None = None) -> range:
        """The earlier loads whose ids the state holds; ``load`` is taken note of."""
        now_ms = round(time.time() * 1000) if now_ms is None else now_ms
        notes = sorted(tuple(map(int, n.split("-"))) for n in names(self.spark, self._folder) if "-" in n)
        if not notes or (load > notes[-1][0] and now_ms - notes[-1][1] >= self.memory_ms // _SLOTS):
            create_text(self.spark, f"{self._folder}/{load:012d}-{now_ms}", "")
            notes.append((load, now_ms))
        young = [n for n in notes if n[1] > now_ms - self.memory_ms]
        for old, at in notes[: len(notes) - len(young)]:
            delete(self.spark, f"{self._folder}/{old:012d}-{at}")
        return range(min([load, *(n for n, _ in young)]), load)
