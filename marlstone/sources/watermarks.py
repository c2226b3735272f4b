"""The ledgers: high-water marks, Bronze runs that Silver has taken, Silver days a run rewrote.

All are small append-only Parquet tables, partitioned by table name so a lookup
opens only its own table's files. A repeated row says nothing new in any of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.measures import instant
from marlstone.storage import list_directories, list_files, path_exists, remove_path

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

WATERMARK_SCHEMA = (
    "last_extracted_at timestamp, run_id string, run_date string, written_at timestamp, table_name string"
)
MERGED_SCHEMA = "run_id string, table_name string"
FILES_SCHEMA = "run_id string, file string, table_name string"
TOTALS_SCHEMA = "change string, version long, table_name string"
TOUCHED_SCHEMA = "run_id string, year int, month int, day int, table_name string"


#: A table's ledger with more files than this is written anew as one.
COMPACT_FROM = 64


def compact(spark: SparkSession, path: str, schema: str, most: int = COMPACT_FROM) -> None:
    """Rewrite the ledgers at ``path`` that consist of many files, one per run, as a single file each.

    The new file is added before those it repeats are removed, so whenever this stops the
    ledger says the same. No other job may be reading it.
    """
    columns = schema.rpartition(", ")[0]
    for level in list_directories(spark, path):
        place = f"{path.rstrip('/')}/{level}"
        files = [f"{place}/{name}" for name, _ in list_files(spark, place)]
        if len(files) > most:
            rows = spark.read.schema(columns).parquet(*files).distinct()
            rows.coalesce(1).write.mode("append").parquet(place)
            for file in files:
                remove_path(spark, file)


def _of_table(path: str, table: str) -> str:
    """Each table writes to its own directory, so tables can be extracted side by side."""
    return f"{path.rstrip('/')}/table_name={table}"


def _read(spark: SparkSession, path: str, schema: str, table: str | None) -> DataFrame:
    wanted = path if table is None else _of_table(path, table)
    if not path_exists(spark, wanted):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(wanted)


def read_watermarks(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """Every mark ever recorded, of one table or of all."""
    return _read(spark, path, WATERMARK_SCHEMA, table)


def latest_watermarks(marks: DataFrame) -> DataFrame:
    """The mark written last, per table."""
    return marks.groupBy("table_name").agg(
        F.max_by("last_extracted_at", F.struct("written_at", "last_extracted_at")).alias("last_extracted_at")
    )


def watermark_lookup(marks: DataFrame, tables: DataFrame) -> DataFrame:
    """The mark of each table in ``tables`` (``table_name``); 1970-01-01 where there is none."""
    epoch = F.lit("1970-01-01").cast(marks.schema["last_extracted_at"].dataType)
    return tables.join(latest_watermarks(marks), "table_name", "left").select(
        "table_name", F.coalesce("last_extracted_at", epoch).alias("last_extracted_at")
    )


def get_watermark(spark: SparkSession, path: str, table: str) -> datetime:
    """The high-water mark of ``table`` in UTC; 1970-01-01 before its first run."""
    latest = latest_watermarks(read_watermarks(spark, path, table))
    row = latest.select(F.unix_micros("last_extracted_at").alias("micros")).first()
    return EPOCH if row is None or row.micros is None else from_micros(row.micros)


def from_micros(micros: int) -> datetime:
    """Microseconds since 1970 as an aware UTC datetime, without passing through a local zone."""
    seconds, rest = divmod(micros, 1_000_000)
    return datetime.fromtimestamp(seconds, timezone.utc).replace(microsecond=rest)


def put_watermark(
    spark: SparkSession,
    path: str,
    table: str,
    ts: datetime | str,
    run_id: str,
    run_ts: datetime | str | None = None,
) -> None:
    """Record a new mark. Call it only after the batch has been written.

    ``run_ts`` dates the run's Bronze directory; the mark itself by default.
    """
    row = spark.range(1).select(
        instant(ts).alias("last_extracted_at"),
        F.lit(run_id).alias("run_id"),
        F.date_format(instant(ts if run_ts is None else run_ts), "yyyy-MM-dd").alias("run_date"),
        F.current_timestamp().alias("written_at"),
    )
    row.write.mode("append").parquet(_of_table(path, table))


def pending_runs(spark: SparkSession, marks_path: str, merged_path: str, table: str) -> list[tuple[str, str]]:
    """(run_date, run_id) of extracted runs that Silver has not merged, oldest first.

    Normally the run just made; more only after a failure between the layers.
    """
    extracted = read_watermarks(spark, marks_path, table)
    merged = _read(spark, merged_path, MERGED_SCHEMA, table)
    todo = extracted.join(merged, "run_id", "left_anti").select("run_date", "run_id", "written_at").distinct()
    return [(r.run_date, r.run_id) for r in todo.orderBy("written_at", "run_id").collect()]


def mark_merged(spark: SparkSession, path: str, table: str, run_ids: list[str]) -> None:
    rows = spark.createDataFrame([(run_id,) for run_id in run_ids], "run_id string")
    rows.coalesce(1).write.mode("append").parquet(_of_table(path, table))


def mark_files(spark: SparkSession, path: str, table: str, files: Iterable[tuple[str, str]]) -> None:
    """Record (run id, file) that Silver has taken of runs it may not have taken whole."""
    rows = spark.createDataFrame(list(files), "run_id string, file string")
    rows.coalesce(1).write.mode("append").parquet(_of_table(path, table))


def merged_files(spark: SparkSession, path: str, table: str, runs: Iterable[str]) -> dict[str, set[str]]:
    """Files that Silver has taken, of those of ``runs`` it took file by file."""
    found: dict[str, set[str]] = {}
    for row in _read(spark, path, FILES_SCHEMA, table).filter(F.col("run_id").isin(*runs)).distinct().collect():
        found.setdefault(row.run_id, set()).add(row.file)
    return found


def runs_merged(spark: SparkSession, path: str, table: str, runs: Iterable[str]) -> set[str]:
    """Those of ``runs`` that Silver has taken whole."""
    return {row.run_id for row in _read(spark, path, MERGED_SCHEMA, table).filter(F.col("run_id").isin(*runs)).collect()}


def pending_changes(spark: SparkSession, touched_path: str, totals_path: str, table: str, mart: str) -> set[str]:
    """Runs that rewrote ``table`` and are not in ``mart``'s running totals yet."""
    built = _read(spark, totals_path, TOTALS_SCHEMA, mart).select("change")
    runs = _read(spark, touched_path, TOUCHED_SCHEMA, table).select("run_id").distinct()
    todo = runs.withColumn("change", F.concat(F.lit(f"{table}/"), "run_id")).join(built, "change", "left_anti")
    return {row.run_id for row in todo.collect()}


def totals_version(spark: SparkSession, path: str, mart: str) -> int:
    """The version of a mart's running totals that is in force; 0 before the first."""
    return _read(spark, path, TOTALS_SCHEMA, mart).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def commit_totals(spark: SparkSession, path: str, mart: str, version: int, pending: Mapping[str, Iterable[str]]) -> None:
    """Put a version of the totals in force, together with the runs per table it includes: one file, so both or neither."""
    changes = [f"{table}/{run_id}" for table, runs in pending.items() for run_id in sorted(runs)]
    rows = spark.createDataFrame([(change, version) for change in changes or [None]], "change string, version long")
    rows.coalesce(1).write.mode("append").parquet(_of_table(path, mart))


def note_touched(spark: SparkSession, path: str, table: str, run_id: str, days: Iterable[tuple]) -> None:
    """Record the Silver partitions a run is about to rewrite: days, or months where a table has no days."""
    padded = [(run_id, *day, *[None] * (3 - len(day))) for day in days]
    rows = spark.createDataFrame(padded, "run_id string, year int, month int, day int")
    rows.coalesce(1).write.mode("append").parquet(_of_table(path, table))


def partitions_of_run(spark: SparkSession, path: str, table: str, run_id: str, levels: Sequence[str]) -> set[tuple]:
    """The Silver partitions, by their ``levels``, that a run rewrote."""
    noted = _read(spark, path, TOUCHED_SCHEMA, table).filter(F.col("run_id") == run_id)
    return {tuple(row) for row in noted.select(*levels).distinct().collect()}


def pending_days(
    spark: SparkSession, touched_path: str, built_path: str, table: str, mart: str
) -> tuple[set[str], set[tuple]]:
    """Runs whose changes to ``table`` are not in ``mart`` yet, and the days they rewrote."""
    touched = _read(spark, touched_path, TOUCHED_SCHEMA, table)
    built = _read(spark, built_path, MERGED_SCHEMA, mart)
    todo = touched.join(built, "run_id", "left_anti").select("run_id", "year", "month", "day").collect()
    return {r.run_id for r in todo}, {(r.year, r.month, r.day) for r in todo}
