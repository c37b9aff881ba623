"""Path checks through the Hadoop file system, so any supported store works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    fs.mkdirs(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is absent."""
    fs, p = _resolve(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _resolve(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file under a name that must be new; False if another writer has taken it."""
    fs, p = _resolve(spark, path)
    try:
        stream = fs.create(p, False)
    except Exception:
        if fs.exists(p):
            return False
        raise
    stream.write(text.encode())
    stream.close()
    return True
