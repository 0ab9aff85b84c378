"""Small files and folders through Hadoop's file systems, so that any store Spark can reach will do."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in ``folder``, sorted; none when it does not exist."""
    fs, p = _open(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file; an existing one is an error."""
    fs, p = _open(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library has written (scratch of a run)."""
    fs, p = _open(spark, path)
    fs.delete(p, True)


def fingerprint(df: DataFrame) -> str:
    """Digest of the files a scan reads: path, length, time of change."""
    spark, seen = df.sparkSession, []
    for path in sorted(df.inputFiles()):
        fs, p = _open(spark, path)
        status = fs.getFileStatus(p)
        seen.append(f"{path} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(seen).encode()).hexdigest()
