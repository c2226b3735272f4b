"""The half-open extraction window and the high-water mark it advances to."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.measures import instant


def incremental_window(df: DataFrame, ts_col: str, low: datetime | str, high: datetime | str) -> DataFrame:
    """Rows with ``low < ts_col <= high``. Rows without a timestamp never qualify."""
    kind = df.schema[ts_col].dataType.typeName()
    column = F.col(ts_col)
    return df.filter((column > instant(low, kind)) & (column <= instant(high, kind)))


def high_water_mark(df: DataFrame, ts_col: str) -> DataFrame:
    """One row: rows in the batch and the latest ``ts_col``, the next run's lower bound."""
    return df.agg(F.count(F.lit(1)).alias("rows_read"), F.max(ts_col).alias("last_extracted_at"))
