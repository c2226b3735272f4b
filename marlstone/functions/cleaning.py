"""Column cleaning. Built-in expressions only, so every step stays in generated code."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def blank_as_null(column: Column, trim: bool = False) -> Column:
    """NULL where the text is empty or only spaces, else the text (trimmed on request)."""
    trimmed = F.trim(column)
    return F.nullif(trimmed, F.lit("")) if trim else F.when(trimmed != "", column)


def safe_cast(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to ``schema``: its columns, its order, its types.

    A value that does not parse becomes NULL. ``try_cast`` states that whatever
    the session's ANSI mode; a plain cast would fail the job.
    """
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def blank_to_null(df: DataFrame, cols: Iterable[str] | None = None, trim: bool = False) -> DataFrame:
    """Blank text to NULL in ``cols``, or in every string column."""
    names = string_columns(df) if cols is None else list(cols)
    return df.withColumns({c: blank_as_null(F.col(c), trim) for c in names}) if names else df


def normalise(df: DataFrame, lower: Iterable[str] = (), trim: Iterable[str] = ()) -> DataFrame:
    """Lower-case the ``lower`` columns and strip outer spaces from the ``trim`` columns."""
    lower, trim = set(lower), set(trim)
    changed = {}
    for name in df.columns:
        if name in lower or name in trim:
            column = F.lower(F.col(name)) if name in lower else F.col(name)
            changed[name] = F.trim(column) if name in trim else column
    return df.withColumns(changed) if changed else df


def drop_pii(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop sensitive columns; one that is absent is not an error."""
    return df.drop(*cols)


_DATE_PARTS = {"year": F.year, "month": F.month, "day": F.dayofmonth}


def add_date_parts(
    df: DataFrame,
    ts_col: str,
    parts: Sequence[str] = ("year", "month", "day"),
    as_string: bool = False,
) -> DataFrame:
    """Add partition columns taken from ``ts_col``.

    With ``as_string`` they are text, month and day padded to two digits.
    """
    columns = {}
    for part in parts:
        value = _DATE_PARTS[part](F.col(ts_col))
        if as_string:
            value = value.cast("string")
            value = value if part == "year" else F.lpad(value, 2, "0")
        columns[part] = value
    return df.withColumns(columns) if columns else df
