"""Writing Bronze."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.operators.metrics import observed
from marlstone.sources.bronze import CSV_OPTIONS, run_directory, write_manifest
from marlstone.sources.watermarks import from_micros
from marlstone.storage import list_files, remove_path, stage

#: Bound the size of a Bronze file, and with it the work of one reading task.
ROWS_PER_FILE = 500_000
FILE_BYTES = 512 * 1024 * 1024


@dataclass(frozen=True)
class BronzeWrite:
    rows: int
    last_extracted_at: datetime | None
    path: str


def write_bronze(
    df: DataFrame, root: str, run_ts: datetime, run_id: str, ts_col: str = "created_at"
) -> BronzeWrite:
    """Write one extraction batch and report its size and latest timestamp.

    The source is read once: the count and the maximum are observed by the
    write. A batch that turns out empty leaves nothing behind. Repeating a
    ``run_id`` replaces that run's directory only.

    Files are closed by their number of rows, which is what the writer can go by. If rows turn out so long that a
    file exceeds ``FILE_BYTES``, the batch is dealt anew from its own files.
    """
    # The run's own directory: no later run can overwrite it.
    path = run_directory(root, run_ts.date(), run_id)
    watched, watch = observed(df, latest=F.max(F.unix_micros(F.col(ts_col).cast("timestamp"))))
    _write(watched, path, ROWS_PER_FILE)
    seen = watch.get
    if seen["rows"] == 0:
        remove_path(df.sparkSession, path)
        return BronzeWrite(0, None, path)
    if max(length for _, length in list_files(df.sparkSession, path)) > FILE_BYTES:
        _deal_anew(df.sparkSession, root, path, df.columns)
    write_manifest(df.sparkSession, path, df.columns)
    latest = None if seen["latest"] is None else from_micros(seen["latest"])
    return BronzeWrite(seen["rows"], latest, path)


def _write(df: DataFrame, path: str, rows_per_file: int) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).option("maxRecordsPerFile", rows_per_file).csv(path)


def _deal_anew(spark: SparkSession, root: str, path: str, columns: Sequence[str]) -> None:
    """Rewrite a run's files with as many rows as fit ``FILE_BYTES`` at the length that rows have in its densest file."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.schema(schema).options(**CSV_OPTIONS).csv(path).select("*", F.col("_metadata.file_name").alias("_file"))
    staged = stage(rows, root, "bronze")
    try:
        copy = spark.read.schema(rows.schema).parquet(staged)
        counts = {r["_file"]: r["count"] for r in copy.groupBy("_file").count().collect()}
        densest = max(length / counts[name] for name, length in list_files(spark, path) if name in counts)
        _write(copy.drop("_file"), path, max(1, int(FILE_BYTES / densest)))
    finally:
        remove_path(spark, staged)
