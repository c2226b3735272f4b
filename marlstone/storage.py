"""Directory housekeeping on whatever file system Hadoop resolves for a path."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from marlstone.session import staging_path

#: Scratch folders handed out by this process.
_SCRATCH: list[str] = []


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _resolve(spark, path)
    return fs.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    target, fs = _resolve(spark, path)
    fs.delete(target, True)


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Name and length of the data files directly in a directory; none if it does not exist."""
    target, fs = _resolve(spark, path)
    if not fs.exists(target):
        return []
    found = [(entry.getPath().getName(), entry.getLen()) for entry in fs.listStatus(target) if entry.isFile()]
    return sorted((name, length) for name, length in found if not name.startswith(("_", ".")))


def list_directories(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly in a directory; none if it does not exist."""
    target, fs = _resolve(spark, path)
    return sorted(e.getPath().getName() for e in fs.listStatus(target) if e.isDirectory()) if fs.exists(target) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it appears whole or not at all."""
    target, fs = _resolve(spark, path)
    part, _ = _resolve(spark, f"{path}.{uuid.uuid4().hex}._COPYING_")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(target, False)
    fs.rename(part, target)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if there is none."""
    target, fs = _resolve(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder on storage that all executors share, for tables that a result is read from.

    ``spark.checkpoint.dir`` names it; the warehouse, shared as well, stands in
    where that is unset. The folder stays until ``clear_scratch``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Remove the scratch folders of this process; call it once their results have been consumed."""
    while _SCRATCH:
        remove_path(spark, _SCRATCH.pop())


def stage(df: DataFrame, beside: str, label: str) -> str:
    """Write ``df`` once to shared storage so later steps read it instead of recomputing it.

    Unlike a local checkpoint the copy survives the loss of any executor.
    """
    path = staging_path(df.sparkSession, f"{beside.rstrip('/')}_staging", label)
    df.write.mode("overwrite").parquet(path)
    return path
