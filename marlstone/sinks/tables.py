"""Writing Silver and Gold: full overwrite, partition merge, catalog registration."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from marlstone.operators.dedup import dedup_latest
from marlstone.storage import path_exists, remove_path, stage

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def balanced(df: DataFrame, partition_cols: Sequence[str], tiny: bool = False) -> DataFrame:
    """Gather each partition's rows into few files of about the advisory size.

    ``rebalance`` lets adaptive execution split a hot partition over many tasks
    and pack small ones together, where a plain repartition would give a hot day
    to a single task. Partitions known to be ``tiny``, of a row or so, are better dealt out to all
    cores: then it is the number of directories that takes time, not the rows.
    """
    if tiny and partition_cols:
        return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *partition_cols)
    return df.hint("rebalance", *partition_cols) if partition_cols else df


def _write(
    df: DataFrame, path: str, partition_cols: Sequence[str], mode: str, cluster_by: Sequence[str] = (), tiny: bool = False
) -> None:
    rows = balanced(df, partition_cols, tiny)
    if cluster_by:  # readers of few values skip the other pages by their statistics
        rows = rows.sortWithinPartitions(*partition_cols, *cluster_by)
    writer = rows.write.mode("overwrite").option("compression", "snappy")
    if partition_cols:
        writer = writer.option("partitionOverwriteMode", mode).partitionBy(*partition_cols)
    writer.parquet(path)
    df.sparkSession.catalog.refreshByPath(path)


def overwrite_table(
    df: DataFrame, path: str, partition_cols: Sequence[str] = (), cluster_by: Sequence[str] = (), tiny: bool = False
) -> None:
    """Replace the whole table at ``path``. ``df`` must not read from it. Files are sorted by ``cluster_by``."""
    _write(df, path, partition_cols, "static", cluster_by, tiny)


def overwrite_partitions(
    df: DataFrame, path: str, partition_cols: Sequence[str], cluster_by: Sequence[str] = (), tiny: bool = False
) -> None:
    """Replace only the partitions ``df`` has rows for; it may read from ``path``."""
    _write(df, path, partition_cols, "dynamic", cluster_by, tiny)


def replace_partitions(
    df: DataFrame, path: str, partition_cols: Sequence[str], expected: Iterable[tuple], cluster_by: Sequence[str] = (),
    tiny: bool = False,
) -> None:
    """Replace partitions by ``df``'s rows; those of ``expected`` it has no row for are removed.

    The write itself reports which partitions it filled, so the driver touches
    only directories that became empty.
    """
    spark = df.sparkSession
    watch = Observation()
    watched = df.observe(watch, F.collect_set(F.struct(*partition_cols)).alias("filled"))
    overwrite_partitions(watched, path, partition_cols, cluster_by, tiny)
    filled = {tuple(row) for row in watch.get["filled"] or ()}
    for row in set(expected) - filled:
        remove_path(spark, _directory(path, row, partition_cols))
    spark.catalog.refreshByPath(path)


def merge_partitions(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    partition_cols: Sequence[str],
    track_moves: bool = True,
    cluster_by: Sequence[str] = (),
) -> None:
    """Upsert ``df`` into the partitioned table at ``path``: newest row per key wins.

    ``df`` may repeat keys. Only partitions the batch touches are read and
    rewritten. With ``track_moves`` that includes partitions holding another
    version of one of the batch's keys, found by a scan of the key columns alone;
    turn it off where the source never changes the timestamp the partitions come
    from. Files are sorted by ``cluster_by``, finer parts of the partition kept as columns.

    Repeating a merge changes nothing, so a failed run can simply be rerun.
    """
    spark = df.sparkSession
    staged = stage(df, path, "merge")
    try:
        batch = spark.read.schema(df.schema).parquet(staged)
        merge_stored(batch, path, keys, order_by, partition_cols, track_moves, cluster_by=cluster_by)
    finally:
        remove_path(spark, staged)


def merge_stored(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    partition_cols: Sequence[str],
    track_moves: bool = True,
    announce: Callable[[set[tuple]], None] | None = None,
    cluster_by: Sequence[str] = (),
    changes: str | None = None,
) -> int:
    """``merge_partitions`` for a batch that is already stored, and so cheap to read repeatedly; returns its number of keys.

    ``announce`` is called with the values of ``partition_cols`` and ``cluster_by`` that
    are about to change. ``changes`` is where to keep what the merge changes, see ``batch_changes``.
    """
    spark, schema = batch.sparkSession, batch.schema
    keys, partition_cols, parts = list(keys), list(partition_cols), [*partition_cols, *cluster_by]
    level, stored = len(partition_cols), path_exists(spark, path)
    # One pass over the batch tells both the partitions it touches and the range of its keys.
    extent = batch.groupBy(*parts).agg(F.min(keys[0]).alias("low"), F.max(keys[0]).alias("high")).collect()
    touched, holding, old = {tuple(row[: len(parts)]) for row in extent}, set(), None
    bounds = min((r.low for r in extent), default=None), max((r.high for r in extent), default=None)
    try:
        if stored and (track_moves or changes is not None):
            current = spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
            if not track_moves:
                current = read_partitions(spark, path, schema, {row[:level] for row in touched}, partition_cols)
            versions = key_range(current, keys[0], *bounds).join(batch.select(*keys).distinct(), keys, "left_semi")
            if changes is not None:  # whole rows, for the comparison below
                old = stage(versions.select(*schema.fieldNames()), path, "old")
                versions = spark.read.schema(schema).parquet(old)
            if track_moves:
                holding = set(partition_values(versions, parts))
        if announce is not None:
            announce(touched | holding)
        present = read_partitions(spark, path, schema, {row[:level] for row in touched | holding}, partition_cols)
        if changes is None:
            merged = dedup_latest(present.unionByName(batch) if stored else batch, keys, order_by)
        else:
            made, met = batch_changes(versions if stored else None, batch, keys, order_by)
            made.write.mode("overwrite").parquet(changes)
            signed = T.StructType([*schema.fields, T.StructField(SIGN, T.IntegerType())])
            merged = _changed(present if stored else None, spark.read.schema(signed).parquet(changes), keys)
        # Only a partition a row has moved out of can end up empty.
        replace_partitions(merged, path, partition_cols, {row[:level] for row in holding}, cluster_by)
        if not stored:  # the files' footers tell
            return spark.read.schema(schema).parquet(path).count()
        if changes is not None and touched:
            return met.get["keys"]
        return batch.select(*keys).distinct().count()
    finally:
        if old is not None:
            remove_path(spark, old)


#: In a table of changes: +1 for a row that appeared, -1 for one that went; 0 for one that is to stay although others of its key go.
SIGN = "_sign"


def signed_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What turns ``before`` into ``after``: rows that went and rows that appeared, told apart by ``SIGN``.

    An updated row is one of each; rows in both are left out.
    """
    rows = before.withColumn(SIGN, F.lit(-1)).unionByName(after.withColumn(SIGN, F.lit(1)))
    return rows.groupBy(*before.columns).agg(F.sum(SIGN).cast("int").alias(SIGN)).filter(F.col(SIGN) != 0)


def batch_changes(
    before: DataFrame | None, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> tuple[DataFrame, Observation]:
    """The signed changes that a batch makes to a table which holds ``before`` of the batch's keys; observes the number of ``keys``.

    The batch is reduced to its newest rows and these meet the table's by key, dealt alike, so rows are shuffled
    once. A merge that failed half-way may have left a key with several rows. The newest counts; where
    the batch does not replace it, it is repeated with sign 0, so that the others can be cut.
    """
    columns = batch.columns
    newest, met = dedup_latest(batch, keys, order_by), Observation()
    counted = F.count(F.lit(1)).alias("keys")
    if before is None:
        return newest.withColumn(SIGN, F.lit(1)).observe(met, counted), met
    rest = [c for c in columns if c not in keys]
    order = [*order_by, *(c for c in rest if c not in order_by)]
    held = before.withColumn("_held", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    held = dedup_latest(held, keys, order)
    old = held.select(*keys, F.struct(*rest).alias("_old"), "_held")
    both = newest.select(*keys, F.struct(*rest).alias("_new")).join(old, keys, "left").observe(met, counted)
    # NULL is oldest, as in ``dedup_latest``; so it is in comparisons of structs.
    new_wins = F.struct(*[F.col("_new")[c] for c in order]) > F.struct(*[F.col("_old")[c] for c in order])
    came = F.struct(F.col("_new").alias("row"), F.lit(1).alias(SIGN))
    went = F.struct(F.col("_old").alias("row"), F.lit(-1).alias(SIGN))
    stays = F.struct(F.col("_old").alias("row"), F.lit(0).alias(SIGN))
    made = F.when(F.col("_old").isNull(), F.array(came)).when(new_wins, F.array(went, came)).when(F.col("_held") > 1, F.array(stays))
    changed, change = both.select(*keys, F.explode(made).alias("_change")), F.col("_change")
    return changed.select(*[F.col(c) if c in keys else change["row"][c].alias(c) for c in columns], change[SIGN].alias(SIGN)), met


def _changed(present: DataFrame | None, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``present`` after ``batch_changes``."""
    put = changed.filter(F.col(SIGN) >= 0).drop(SIGN)
    if present is None:
        return put
    cut = changed.filter(F.col(SIGN) <= 0).select(*keys).distinct()
    return present.join(cut, list(keys), "left_anti").select(*put.columns).unionByName(put)


def within_range(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` lies in the range of ``other_column``, as a join partner must."""
    return key_range(df, column, *other.agg(F.min(other_column), F.max(other_column)).first())


def key_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows of ``df`` with ``column`` from ``low`` to ``high``; none if these are NULL.

    Keys are handed out in order, so those of a batch lie close together and the
    range, pushed to the scan, skips most row groups by their statistics.
    """
    if low is None:
        return df.limit(0)
    return df.filter(F.col(column).between(F.lit(low), F.lit(high)))


def read_partitions(
    spark: SparkSession, path: str, schema: StructType, rows: set[tuple], partition_cols: Sequence[str]
) -> DataFrame:
    """The named partitions of the table at ``path``; the scan opens no others."""
    if not rows or not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).parquet(path).filter(in_partitions(rows, partition_cols))
    return found.select(*schema.fieldNames())  # the reader puts directory levels last


def in_partitions(rows: Iterable[tuple], partition_cols: Sequence[str]) -> Column:
    """Whether a row lies in one of the partitions ``rows``; NULL names the NULL partition.

    A predicate on partition columns alone prunes the scan whatever their number. It
    lists the last level per combination of the others: a few hundred branches for years of days.
    """
    last: dict[tuple, list] = {}
    for row in sorted(set(rows), key=str):
        last.setdefault(row[:-1], []).append(row[-1])

    def among(column: str, values: Sequence) -> Column:
        known = F.col(column).isin(*[v for v in values if v is not None])
        return known | F.col(column).isNull() if None in values else known

    branches = [
        reduce(and_, [among(c, [v]) for c, v in zip(partition_cols, head)] + [among(partition_cols[-1], values)])
        for head, values in last.items()
    ]
    while len(branches) > 1:  # halved each time, so that the expression stays flat
        branches = [reduce(or_, branches[k : k + 2]) for k in range(0, len(branches), 2)]
    return branches[0]


def partition_values(df: DataFrame, partition_cols: Sequence[str]) -> list[tuple]:
    """The distinct partitions of ``df``: metadata-sized, as in Spark's own file index."""
    return [tuple(row) for row in df.select(*partition_cols).distinct().collect()]


def _levels(row: tuple, partition_cols: Sequence[str]) -> list[str]:
    return [f"{c}={NULL_PARTITION if v is None else v}" for c, v in zip(partition_cols, row)]


def _directory(path: str, row: tuple, partition_cols: Sequence[str]) -> str:
    return "/".join([path.rstrip("/"), *_levels(row, partition_cols)])


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    source_format: str = "parquet",
    schema: str | None = None,
    partition_cols: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Make the files at ``path`` a catalog table, or bring an existing one up to date.

    New partitions are discovered and columns that have appeared since are added
    in place. Without ``schema`` the files' own is used.
    """
    reader = spark.read.format(source_format).options(**(options or {}))
    found = (reader.schema(schema) if schema else reader).load(path).schema
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.fields)
        settings = ", ".join(f"'{k}' = '{_quoted(v)}'" for k, v in (options or {}).items())
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING {source_format}"
            + (f" OPTIONS ({settings})" if settings else "")
            + (f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_cols)})" if partition_cols else "")
            + f" LOCATION '{_quoted(path)}'"
        )
    else:
        known = {c.lower() for c in spark.table(name).columns}
        added = [f for f in found.fields if f.name.lower() not in known]
        if added:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    if partition_cols:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
