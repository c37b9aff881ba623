"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "barloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package is designed for.

    On a cluster leave ``master`` unset. Shuffle partitions are left to AQE, which
    coalesces the small ones and splits the skewed ones at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_base() -> tempfile.TemporaryDirectory:
    """Removed when the process ends."""
    return tempfile.TemporaryDirectory(prefix="barloom-", ignore_cleanup_errors=True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is absent and Spark runs
    in local mode: executors on other machines could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base().name
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to a fresh scratch path and read again, so it is computed once."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application, for Python in their tasks."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    # executors fetch it when their first task needs it, so it stays until the process ends
    path = os.path.join(os.path.realpath(_local_base().name), f"{context.applicationId}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, str(source.relative_to(root.parent)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
