"""Deduplication and key checks.

A key may be arbitrarily hot. Ranking keeps the first n rows per key *before* the
shuffle (Spark turns ``row_number() <= n`` into a per-task group limit, for any n
under this library's settings), and the counts combine on the map side, so no task
receives a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _newest_first(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group under ``order``."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The newest row per key: ``order_by`` descending, NULLs last.

    All other columns follow as tie-breakers, so reruns choose the same row.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    return first_per_group(df, keys, _newest_first([*order_by, *rest]))


def dedup_exact(df: DataFrame) -> DataFrame:
    """Drop rows that repeat another row in every column."""
    return df.dropDuplicates()


def has_key(keys: Sequence[str]) -> Column:
    """True where every key column is filled."""
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def split_rejects(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a complete key, and the others with a ``reject_reason``."""
    missing = F.concat_ws(",", *[F.when(F.col(k).isNull(), F.lit(k)) for k in keys])
    reason = F.concat(F.lit("missing or malformed key: "), missing).alias("reject_reason")
    return df.filter(has_key(keys)), df.filter(~has_key(keys)).select("*", reason)


def key_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with its number of rows, ``copies``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows before and after deduplication on ``keys``, and the difference."""
    return key_groups(df, keys).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        (F.coalesce(F.sum("copies"), F.lit(0)) - F.count(F.lit(1))).alias("duplicates_removed"),
    )


def audit_key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: row count, distinct keys (NULL counts as a key) and whether they agree."""
    report = duplicate_report(df, keys)
    return report.select(
        F.col("rows_before").alias("total_rows"),
        F.col("rows_after").alias("distinct_keys"),
        (F.col("duplicates_removed") == 0).alias("is_unique"),
    )
