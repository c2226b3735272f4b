"""Bounded, parallel reads from a relational source."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.measures import utc_text
from marlstone.operators.windows import incremental_window

#: rows per round trip; without it some drivers fetch the whole result at once
FETCH_SIZE = 10_000

DRIVERS = {"jdbc:postgresql:": "org.postgresql.Driver"}


def _options(url: str, options: Mapping[str, str] | None) -> dict[str, str]:
    merged = {"url": url, "fetchsize": str(FETCH_SIZE)}
    for prefix, driver in DRIVERS.items():
        if url.startswith(prefix):
            merged["driver"] = driver
            # Pushed timestamp bounds carry no zone: make the server read them as UTC.
            merged["sessionInitStatement"] = "SET TIME ZONE 'UTC'"
    merged.update(options or {})
    return merged


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    ts_col: str,
    low: datetime | str,
    high: datetime | str,
    options: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    hash_expression: str | None = None,
) -> DataFrame:
    """Rows of ``table`` with ``low < ts_col <= high``.

    The window is pushed to the database. ``num_partitions`` tasks read, as many as the session has
    cores by default, each a range of ``partition_column`` (an integer key) in the range the
    window covers. The database reports that range and the number of rows. Equal strides are used
    where they cannot give a reader more than twice its share; where ids have gaps, it
    counts rows per stride, and again within strides that are too full, until ranges of about equal size are known.

    For a text or composite key give ``hash_expression``, SQL that makes an integer of it, such as
    PostgreSQL's ``hashtext(code)``: readers share the rows by its remainder. Without either
    one task would read everything, which has to be asked for by ``num_partitions=1``.
    """
    if partition_column is None and hash_expression is None and num_partitions != 1:
        raise ValueError("name a partition_column or a hash_expression, or ask for a single reader with num_partitions=1")
    num_partitions = num_partitions or spark.sparkContext.defaultParallelism
    settings, predicates = _options(url, options), None
    if num_partitions > 1 and hash_expression is not None:
        predicates = hash_predicates(hash_expression, num_partitions)
    elif num_partitions > 1:
        columns = _quoted(spark, settings, table)
        key, window = columns[partition_column.lower()], _window(columns[ts_col.lower()], low, high)
        ask = lambda query: spark.read.format("jdbc").options(**settings).option("query", query).load().collect()
        lowest, highest, rows = ask(f"SELECT MIN({key}) AS lowest, MAX({key}) AS highest, COUNT(*) AS n FROM {table} WHERE {window}")[0]
        if lowest is not None and highest - lowest < 2 * rows:
            settings.update(
                partitionColumn=partition_column, lowerBound=str(lowest), upperBound=str(highest + 1), numPartitions=str(num_partitions),
            )
        elif lowest is not None:
            bounds = quantile_bounds(lambda ranges: ask(_histogram(table, key, window, ranges)), lowest, highest, rows, num_partitions)
            predicates = range_predicates(key, bounds)
    return _scan(spark, settings, table, ts_col, low, high, predicates)


def _quoted(spark, settings, table) -> dict[str, str]:
    """The table's columns as the database wants them written, by lower-case name."""
    dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(settings["url"])
    return {c.lower(): dialect.quoteIdentifier(c) for c in _table(spark, settings, table).columns}


def _window(column: str, low: datetime | str, high: datetime | str) -> str:
    return f"{column} > {{ts '{utc_text(low)}'}} AND {column} <= {{ts '{utc_text(high)}'}}"


#: Strides that a range is counted by at a time.
STRIDES = 64


def _histogram(table: str, key: str, window: str, ranges: Sequence[tuple[int, int]]) -> str:
    """SQL that counts rows per stride of each range (first and last key)."""
    whole = f"CAST({key} AS BIGINT)"
    parts = [
        f"SELECT {n} AS part, ({whole} - {first}) / {_stride(first, last)} AS stride FROM {table} "
        f"WHERE {window} AND {key} BETWEEN {first} AND {last}"
        for n, (first, last) in enumerate(ranges)
    ]
    return f"SELECT part, stride, COUNT(*) AS n FROM ({' UNION ALL '.join(parts)}) strides GROUP BY part, stride"


def _stride(first: int, last: int) -> int:
    return -(-(last - first + 1) // STRIDES)


def quantile_bounds(
    count: Callable[[Sequence[tuple[int, int]]], Iterable[tuple[int, int, int]]], lowest: int, highest: int, rows: int, n: int
) -> list[int]:
    """Keys at which readers after the first begin, so that each of ``n`` gets at most one and a half times its share.

    ``count`` tells, for ranges of keys, (range, stride, rows) of the strides that hold rows. A key that alone
    holds more than that cannot be divided.
    """
    share, done, full = rows / n, [], [(lowest, highest)]
    while full:
        counted = list(count(full))
        ranges, full = full, []
        for part, stride, found in counted:
            first, last = ranges[part]
            width = _stride(first, last)
            begin, end = first + stride * width, min(first + (stride + 1) * width - 1, last)
            if found > share / 2 and end > begin:
                full.append((begin, end))
            else:
                done.append((begin, found))
    bounds, before = [], 0
    for begin, found in sorted(done):
        if before >= share * (len(bounds) + 1):
            bounds.append(begin)
        before += found
    return bounds


def range_predicates(key: str, bounds: Sequence[int]) -> list[str]:
    """One condition per reader; rows without a key go to the first."""
    if not bounds:
        return ["1 = 1"]
    between = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(bounds, bounds[1:])]
    return [f"{key} < {bounds[0]} OR {key} IS NULL", *between, f"{key} >= {bounds[-1]}"]


def hash_predicates(expression: str, n: int) -> list[str]:
    """One condition per reader, by the remainder of an integer expression, negative or not; NULLs go to the first."""
    shared = [f"MOD({expression}, {n}) IN ({k}, {k - n})" for k in range(n)]
    return [f"{shared[0]} OR ({expression}) IS NULL", *shared[1:]]


def _table(spark, settings, table) -> DataFrame:
    return spark.read.format("jdbc").options(**settings).option("dbtable", table).load()


def _scan(spark, settings, table, ts_col, low, high, predicates=None) -> DataFrame:
    if predicates is None:
        source = _table(spark, settings, table)
    else:
        source = spark.read.jdbc(settings["url"], table, predicates=predicates, properties={k: v for k, v in settings.items() if k != "url"})
    # Databases that fold names to upper case still get the lake's lower-case columns.
    source = source.select(*[F.col(c).alias(c.lower()) for c in source.columns])
    return incremental_window(source, ts_col, low, high)


def jdbc_source(spark: SparkSession, url: str, table: str, ts_col: str = "created_at", **kwargs) -> Callable:
    """A source for ``plans.pipeline``: called with the window, returns its rows."""
    return lambda low, high: read_jdbc(spark, url, table, ts_col, low, high, **kwargs)
