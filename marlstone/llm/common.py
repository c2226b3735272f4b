"""What the operators share: tables, words, and staged tables in the shared folder."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.storage import scratch_path

#: White space that separates words: space, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"
_BLANK_RUN = r"[\x20\x09-\x0D]+"

#: Bytes of one Arrow batch; long texts otherwise make batches of any size. A core holds a few copies of a batch,
#: in direct memory of its executor and in its Python worker.
ARROW_BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back: later steps reread it instead of computing it again.

    Written files outlive any executor, and values that depend on how rows were
    dealt out (partition numbers, generated ids) stay what they were.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Array of the words of a text: runs of anything but white space. Null has none."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed != "", F.split(trimmed, _BLANK_RUN)).otherwise(F.array().cast("array<string>"))


def n_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed != "", F.size(F.split(trimmed, _BLANK_RUN))).otherwise(0).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def release_memory() -> None:
    """Give what this process has freed back to the system.

    A Python worker serves the tasks of several steps, and what its allocators keep for later counts beside what the next step needs.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's; Arrow does not call it for the memory of others
        trim(0)
