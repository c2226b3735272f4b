"""Reading Bronze: raw CSV, one directory per extraction run, every column text."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.storage import list_files, path_exists, read_text, write_text

#: Both sides of Bronze use these, so text with quotes, newlines or outer spaces
#: and timestamps with microseconds survive the round trip.
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

#: Directory levels; declared as text so a month stays '06'.
BRONZE_PARTITIONS = ("year", "month", "day", "run_id")


def bronze_schema(columns: Sequence[str]) -> T.StructType:
    names = [*columns, *BRONZE_PARTITIONS]
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def resolve_partition_date(value: date | str | None = None, now: datetime | None = None) -> date:
    """The day to process: the one given, else the day before ``now`` in UTC."""
    if value is not None:
        return date.fromisoformat(value) if isinstance(value, str) else value
    now = now or datetime.now(timezone.utc)
    return (now.astimezone(timezone.utc) - timedelta(days=1)).date()


def day_predicate(day: date):
    return (
        (F.col("year") == f"{day.year:04d}")
        & (F.col("month") == f"{day.month:02d}")
        & (F.col("day") == f"{day.day:02d}")
    )


def run_directory(root: str, day: date, run_id: str | None = None) -> str:
    """A day's directory, or one run's inside it."""
    path = f"{root.rstrip('/')}/year={day.year:04d}/month={day.month:02d}/day={day.day:02d}"
    return path if run_id is None else f"{path}/run_id={run_id}"


#: In a run's directory: the names of its files that hold rows. Readers of the directory skip it.
MANIFEST = "_files.json"


def header_bytes(columns: Sequence[str]) -> int:
    """Length of a Bronze file without rows."""
    return len(",".join(columns).encode()) + 1


def write_manifest(spark: SparkSession, path: str, columns: Sequence[str]) -> None:
    """Note which files of a run's directory hold rows; written last, so its presence says that the run is whole."""
    names = [name for name, length in list_files(spark, path) if length > header_bytes(columns)]
    write_text(spark, f"{path}/{MANIFEST}", json.dumps(names))


def read_manifest(spark: SparkSession, path: str) -> set[str] | None:
    """The files of a run that hold rows; None if the run is not, or not known to be, whole."""
    text = read_text(spark, f"{path}/{MANIFEST}")
    return None if text is None else set(json.loads(text))


def read_bronze(
    spark: SparkSession,
    root: str,
    columns: Sequence[str],
    day: date | str | None = None,
    runs: Sequence[tuple[str, str]] | None = None,
    files: Sequence[str] = (),
) -> DataFrame:
    """Bronze rows as text, plus the partition columns.

    A ``day``, or ``runs`` as (date, run id), names the directories to open, so
    the rest of Bronze is not even listed; ``files`` are single files beside those ``runs``. Multi-line CSV cannot be split inside
    a file; parallelism comes from the writer's bounded file size.
    """
    schema = bronze_schema(columns)
    if runs is not None:
        paths = [run_directory(root, date.fromisoformat(d), run_id) for d, run_id in runs]
    elif day is not None:
        paths = [run_directory(root, resolve_partition_date(day))]
    else:
        paths = [root]
    paths = [p for p in [*paths, *files] if path_exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).options(**CSV_OPTIONS).option("basePath", root).csv(paths)
