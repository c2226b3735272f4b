"""Run summaries. Counts ride along with a write that is needed anyway."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import astuple, dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SUMMARY_SCHEMA = (
    "stage string, table_name string, run_id string, rows_read long, rows_written long, "
    "duplicates_removed long, rows_rejected long, window_low string, window_high string, output string"
)


@dataclass(frozen=True)
class RunSummary:
    """What one job did, for the table a monitor would read."""

    stage: str
    table_name: str
    run_id: str
    rows_read: int | None = None
    rows_written: int | None = None
    duplicates_removed: int | None = None
    rows_rejected: int | None = None
    window_low: str | None = None
    window_high: str | None = None
    output: str | None = None


def summary_frame(spark: SparkSession, summaries: Iterable[RunSummary]) -> DataFrame:
    """Summaries as a DataFrame; a run has a few dozen at most."""
    return spark.createDataFrame([astuple(s) for s in summaries], SUMMARY_SCHEMA)


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` with a row count and ``metrics`` collected by the write that follows.

    Write the result directly. Only the tasks of a job's last stage are counted
    exactly once; observed below a shuffle, a map task rerun after an executor
    was lost would count twice.
    """
    watch = Observation()
    named = [metric.alias(name) for name, metric in metrics.items()]
    return df.observe(watch, F.count(F.lit(1)).alias("rows"), *named), watch


def iso(value: datetime | str | None) -> str | None:
    return value.isoformat() if isinstance(value, datetime) else value
