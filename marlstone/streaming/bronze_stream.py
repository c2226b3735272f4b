"""Bronze to Silver as an incremental file stream (an addition of this library)."""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.operators.metrics import RunSummary
from marlstone.plans.pipeline import LakeConfig, load_silver
from marlstone.schemas import TABLES, TableSpec
from marlstone.sources import watermarks
from marlstone.sources.bronze import BRONZE_PARTITIONS, header_bytes, read_bronze, read_manifest, run_directory
from marlstone.storage import list_directories, remove_path

#: Column of the stream: name of a Bronze file.
FILE = "_file"
#: What the stream reads of a file. Its content is never selected, so no micro-batch opens one.
_ARRIVAL = "path string, modificationTime timestamp, length long, content binary, " + ", ".join(f"{p} string" for p in BRONZE_PARTITIONS)


def stream_bronze_to_silver(
    spark: SparkSession, lake: LakeConfig, table: str, checkpoint: str, max_files_per_trigger: int = 1_000
) -> RunSummary:
    """Take the table's Bronze files not seen before into Silver, by one merge, and return its summary.

    The stream's micro-batches only note which files have arrived, each in a directory of its own that a
    replay replaces. A multi-line file is one task's work, so reading files batch by batch would read few at
    a time. Once the stream has seen all files there were, one merge, with the steps of a batch run, reads
    them side by side: rows without a key are kept among the rejects, and the days it rewrites are noted for the marts.

    Files are ticked off with the merge, a run once all files its manifest names are. So
    whatever stops this job, wherever, a batch run takes exactly the files that
    are not in Silver, and the next call of this one skips those a batch run has taken.
    """
    spec = TABLES[table]
    # Streams of one table, each with its own checkpoint, keep files and rejects apart.
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    aside = f"{lake.path('state', 'streams')}/{table}-{stream}"
    files = (
        spark.readStream.format("binaryFile")
        .schema(_ARRIVAL)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(lake.path("bronze", table))
        .filter(F.col("length") > header_bytes(spec.bronze_columns))
        .select(*BRONZE_PARTITIONS, F.col("_metadata.file_name").alias(FILE))
    )
    query = (
        files.writeStream.foreachBatch(lambda batch, batch_id: set_aside(batch, batch_id, aside))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _merge_aside(spark, lake, spec, aside, stream)


def set_aside(batch: DataFrame, batch_id: int, aside: str) -> None:
    batch.write.mode("overwrite").parquet(f"{aside}/batch={batch_id:09d}")


def _merge_aside(spark: SparkSession, lake: LakeConfig, spec: TableSpec, aside: str, stream: str) -> RunSummary:
    batches = list_directories(spark, aside)
    # Named after the first batch: a merge that is repeated with later batches replaces its own rejects.
    name = f"stream-{stream}-{batches[0].partition('=')[2]}" if batches else f"stream-{stream}"
    summary = RunSummary("silver", spec.name, name, rows_read=0, rows_written=0)
    if not batches:
        return summary
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*BRONZE_PARTITIONS, FILE)])
    arrived = spark.read.schema(schema).parquet(*[f"{aside}/{batch}" for batch in batches])
    origins = [tuple(r) for r in arrived.distinct().collect()]
    runs = {origin[3] for origin in origins}
    whole = watermarks.runs_merged(spark, lake.merged_runs, spec.name, runs)
    taken = watermarks.merged_files(spark, lake.merged_files, spec.name, runs)
    new = [o for o in origins if o[3] not in whole and o[4] not in taken.get(o[3], ())]
    if new:
        root = lake.path("bronze", spec.name)
        paths = [f"{run_directory(root, date(*map(int, o[:3])), o[3])}/{o[4]}" for o in sorted(new)]
        summary = load_silver(spark, lake, spec, read_bronze(spark, root, spec.bronze_columns, runs=(), files=paths), name)
        watermarks.mark_files(spark, lake.merged_files, spec.name, [(o[3], o[4]) for o in new])
        for year, month, day, run_id in sorted({o[:4] for o in new}):
            taken.setdefault(run_id, set()).update(o[4] for o in new if o[3] == run_id)
            manifest = read_manifest(spark, run_directory(root, date(int(year), int(month), int(day)), run_id))
            if manifest is not None and manifest <= taken[run_id]:
                watermarks.mark_merged(spark, lake.merged_runs, spec.name, [run_id])
    remove_path(spark, aside)
    return summary
