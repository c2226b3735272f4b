"""The whole run: extract, Silver, quality, Gold. Any failure stops it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions.cleaning import add_date_parts
from marlstone.operators import quality
from marlstone.operators.dedup import dedup_latest, has_key, split_rejects
from marlstone.operators.metrics import RunSummary, iso, observed, summary_frame
from marlstone.operators.windows import incremental_window
from marlstone.plans import changes, gold
from marlstone.plans.silver import typed_rows
from marlstone.schemas import BUCKET, TABLES, TableSpec
from marlstone.session import tune
from marlstone.sinks.bronze import write_bronze
from marlstone.sinks.tables import (
    in_partitions,
    merge_stored,
    overwrite_table,
    partition_values,
    read_partitions,
    register_table,
    replace_partitions,
    within_range,
)
from marlstone.sources import watermarks
from marlstone.sources.bronze import read_bronze, run_directory
from marlstone.sources.tables import read_table_or_path
from marlstone.storage import list_files, path_exists, remove_path, stage

#: A source is called with the window's bounds and returns the rows inside them.
Source = Callable[[datetime, datetime], DataFrame]


@dataclass(frozen=True)
class LakeConfig:
    """Where the lake lives and how its tables are extracted."""

    root: str
    #: extraction timestamp per table where it is not ``created_at``
    ts_columns: Mapping[str, str] = field(default_factory=dict)
    #: re-read this much before the last mark, for commits that arrived late
    overlap: timedelta = timedelta(0)
    #: see ``sinks.tables.merge_partitions``
    track_moves: bool = True
    #: 64-bit ids in Silver
    wide_keys: bool = False
    #: database of the catalog in which Silver and Gold tables are registered, as silver_… and gold_…
    catalog: str | None = None
    #: rebuild only the days of daily_sales and funnel_analysis whose input changed, and bring
    #: customer_ltv and top_products up to date from what Silver's merges changed;
    #: relies on a payment never changing its order, as at the source
    incremental_gold: bool = False
    #: Silver tables whose days are big enough (some hundred MB) to have a directory each;
    #: the others have one per month, its files sorted by day
    day_directories: frozenset[str] = frozenset()

    def directories(self, table: str) -> tuple[str, ...]:
        """Directory levels of a Silver table."""
        spec = TABLES[table]
        if spec.buckets:
            return (BUCKET,)
        return spec.partition_by if table in self.day_directories else spec.partition_by[:2]

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    @property
    def watermarks(self) -> str:
        return self.path("state", "watermarks")

    @property
    def merged_runs(self) -> str:
        return self.path("state", "merged_runs")

    @property
    def merged_files(self) -> str:
        return self.path("state", "merged_files")

    @property
    def totals_runs(self) -> str:
        return self.path("state", "totals_runs")

    def changes(self, table: str, run_id: str | None = None) -> str:
        """What merges changed in a Silver table, per run."""
        root = self.path("state", "changes") + f"/{table}"
        return root if run_id is None else f"{root}/run_id={run_id}"

    def totals(self, mart: str, version: int) -> str:
        """A version of the running totals that a mart is published from."""
        return self.path("state", f"{mart}_totals") + f"/version={version}"

    @property
    def touched_days(self) -> str:
        return self.path("state", "touched_days")

    @property
    def built_marts(self) -> str:
        return self.path("state", "built_marts")


def dataframe_source(df: DataFrame, ts_col: str = "created_at") -> Source:
    """A source over a table already readable as a DataFrame."""
    return lambda low, high: incremental_window(df, ts_col, low, high)


def make_run_id(run_ts: datetime) -> str:
    return run_ts.astimezone(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")


def extract_table(
    spark: SparkSession, lake: LakeConfig, table: str, source: Source, run_ts: datetime, run_id: str
) -> RunSummary:
    """Copy the rows since the last mark to Bronze, then advance the mark.

    The mark moves only after the write succeeded, and only if there were rows.
    """
    mark = watermarks.get_watermark(spark, lake.watermarks, table)
    low = max(mark - lake.overlap, watermarks.EPOCH)
    ts_col = lake.ts_columns.get(table, "created_at")
    written = write_bronze(source(low, run_ts), lake.path("bronze", table), run_ts, run_id, ts_col)
    if written.rows and written.last_extracted_at is not None:
        mark = max(mark, written.last_extracted_at)
        watermarks.put_watermark(spark, lake.watermarks, table, mark, run_id, run_ts)
    return RunSummary(
        "extract", table, run_id, rows_read=written.rows, rows_written=written.rows,
        window_low=iso(low), window_high=iso(run_ts), output=written.path if written.rows else None,
    )


def refine_table(spark: SparkSession, lake: LakeConfig, table: str, run_id: str) -> RunSummary:
    """Take every Bronze run Silver has not seen yet into the Silver table."""
    spec = TABLES[table]
    runs = watermarks.pending_runs(spark, lake.watermarks, lake.merged_runs, table)
    output = lake.path("silver", table)
    if not runs:
        return RunSummary("silver", table, run_id, rows_read=0, rows_written=0, output=None)
    raw = _untaken(spark, lake, table, runs)
    summary = load_silver(spark, lake, spec, raw, run_id)
    watermarks.mark_merged(spark, lake.merged_runs, table, [r for _, r in runs])
    return summary


def _untaken(spark: SparkSession, lake: LakeConfig, table: str, runs: Sequence[tuple[str, str]]) -> DataFrame:
    """Bronze rows of ``runs`` but for the files that a stream has taken already."""
    root = lake.path("bronze", table)
    taken = watermarks.merged_files(spark, lake.merged_files, table, [run_id for _, run_id in runs])
    whole, files = [], []
    for day, run_id in runs:
        if run_id not in taken:
            whole.append((day, run_id))
        else:
            path = run_directory(root, date.fromisoformat(day), run_id)
            files += [f"{path}/{name}" for name, _ in list_files(spark, path) if name not in taken[run_id]]
    return read_bronze(spark, root, TABLES[table].bronze_columns, runs=whole, files=files)


def rebuild_table(spark: SparkSession, lake: LakeConfig, table: str, run_id: str) -> RunSummary:
    """Recreate a Silver table from everything in Bronze."""
    raw = read_bronze(spark, lake.path("bronze", table), TABLES[table].bronze_columns)
    return load_silver(spark, lake, TABLES[table], raw, run_id, replace=True)


def load_silver(
    spark: SparkSession, lake: LakeConfig, spec: TableSpec, raw: DataFrame, run_id: str, replace: bool = False
) -> RunSummary:
    """Take raw rows into a Silver table: reject those without a key, note the days, merge (or replace)."""
    output, directories = lake.path("silver", spec.name), lake.directories(spec.name)
    usable = has_key(spec.keys)
    # Bronze text is parsed once; everything after works on the typed copy.
    rows = add_date_parts(typed_rows(raw, spec, lake.wide_keys), "created_at", spec.partition_by)
    if spec.buckets:
        rows = rows.withColumn(BUCKET, F.pmod(F.xxhash64(*spec.keys), F.lit(spec.buckets)).cast("int"))
    cluster_by = [c for c in spec.partition_by if c not in directories]
    watched, watch = observed(rows, rejected=F.count_if(~usable))
    staged = stage(watched, output, "typed")
    try:
        read, rejected = watch.get["rows"], watch.get["rejected"]
        typed = spark.read.schema(rows.schema).parquet(staged)
        batch = typed.filter(usable)
        if rejected:
            _, bad = split_rejects(typed.drop(*spec.partition_by, BUCKET), spec.keys)
            overwrite_table(bad, f"{lake.path('rejects', spec.name)}/run_id={run_id}")

        def note(parts: set[tuple]) -> None:
            # A bucket says nothing about days; that the table changed is all there is to note.
            days = parts if spec.partition_by else {()} if parts else set()
            watermarks.note_touched(spark, lake.touched_days, spec.name, run_id, days)

        if replace:
            changes.forget(spark, lake, spec.name)
            before = read_silver(spark, lake, spec.name)
            note({day for df in (before, batch) for day in partition_values(df, spec.partition_by)} if spec.partition_by else {()})
            overwrite_table(dedup_latest(batch, spec.keys, spec.newest_by), output, directories, cluster_by)
            written = spark.read.schema(batch.schema).parquet(output).count()
        else:
            with changes.recorded(spark, lake, spec.name, run_id) as feed:
                written = merge_stored(
                    batch, output, spec.keys, spec.newest_by, directories,
                    lake.track_moves and bool(spec.partition_by), note, cluster_by, feed,
                )
    finally:
        remove_path(spark, staged)
    return RunSummary(
        "silver", spec.name, run_id, rows_read=read, rows_written=written,
        duplicates_removed=read - rejected - written, rows_rejected=rejected, output=output,
    )


def check_table(
    spark: SparkSession,
    lake: LakeConfig,
    table: str,
    run_id: str,
    gate: bool = True,
    suite: Sequence[quality.Expectation] | None = None,
    whole: bool = True,
) -> RunSummary:
    """Run a Silver table's suite, store the results, and stop the run if an expectation failed.

    Without ``whole``, only the days that run ``run_id`` rewrote are judged: a
    merge keeps keys unique across partitions, so nothing else can have changed, and a run
    that brought no rows is noticed by the row-count check.
    """
    silver = read_silver(spark, lake, table)
    parts = TABLES[table].partition_by
    if parts and not whole:
        rewritten = watermarks.partitions_of_run(spark, lake.touched_days, table, run_id, parts)
        silver = silver_days(spark, lake, table, rewritten, parts)
    results = quality.evaluate(silver, suite or quality.SUITES[table])
    root = f"{lake.root.rstrip('/')}/quality"
    document = quality.write_results(results, root, table, run_id)
    if gate:
        quality.enforce(document.select(F.inline("results")), table)
    counts = document.select("statistics.*").first()
    return RunSummary(
        "quality", table, run_id, rows_read=counts.evaluated_expectations,
        rows_written=counts.successful_expectations, rows_rejected=counts.unsuccessful_expectations,
        output=f"{root}/table_name={table}/run_id={run_id}",
    )


def read_silver(spark: SparkSession, lake: LakeConfig, table: str) -> DataFrame:
    """A Silver table with its partition columns; empty if it was never loaded."""
    spec = TABLES[table]
    schema = spec.silver_schema(lake.wide_keys)
    for part in spec.partition_by:
        schema = schema.add(part, T.IntegerType())
    path = lake.path("silver", table)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def gold_marts(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The four marts over Silver tables, whose order ids are unique."""
    customers, orders, payments = tables["customers"], tables["orders"], tables["payments"]
    return {
        "daily_sales": gold.daily_sales(orders, payments, unique_orders=True),
        "customer_ltv": gold.customer_ltv(customers, orders, payments, unique_orders=True),
        "top_products": gold.top_products(tables["order_items"], tables["products"]),
        "funnel_analysis": gold.funnel(tables["page_views"], orders),
    }


#: tables whose changed days the daily marts follow
DAILY_INPUTS = ("orders", "payments", "page_views")


def refresh_mart(spark: SparkSession, lake: LakeConfig, mart: str, run_id: str) -> RunSummary:
    """Bring one mart up to date, by its changed partitions where that is possible and wanted.

    Changed days are noted before Silver is rewritten and ticked off after the
    mart is, so a failure in between only means that days are rebuilt again.
    """
    if not lake.incremental_gold:
        return build_mart(spark, lake, mart, gold_marts({t: read_silver(spark, lake, t) for t in TABLES})[mart], run_id)
    if mart in changes.TOTALS:
        path = lake.path("gold", mart)
        rows = changes.refresh(spark, lake, mart, lambda table: read_silver(spark, lake, table))
        return RunSummary("gold", mart, run_id, rows_written=rows, output=path)
    refresh = {"daily_sales": _changed_sales, "funnel_analysis": _changed_funnel}[mart]
    runs, days = set(), {}
    for table in DAILY_INPUTS:
        table_runs, days[table] = watermarks.pending_days(spark, lake.touched_days, lake.built_marts, table, mart)
        runs |= table_runs
    path = lake.path("gold", mart)
    if not path_exists(spark, path):
        df = gold_marts({t: read_silver(spark, lake, t) for t in TABLES})[mart]
        summary = build_mart(spark, lake, mart, df, run_id)
    else:
        df, changed = refresh(spark, lake, days)
        rows = 0
        if changed:
            parts = gold.GOLD_PARTITIONS[mart]
            replace_partitions(df, path, parts, changed, tiny=True)
            rows = read_partitions(spark, path, df.schema, changed, parts).count()
        summary = RunSummary("gold", mart, run_id, rows_written=rows, output=path)
    if runs:
        watermarks.mark_merged(spark, lake.built_marts, mart, sorted(runs))
    return summary


def silver_days(
    spark: SparkSession, lake: LakeConfig, table: str, days: set[tuple], parts: Sequence[str] = ("year", "month", "day")
) -> DataFrame:
    """Silver rows of some days, or months: whole directories are skipped, and of the others what their statistics exclude."""
    silver, levels = read_silver(spark, lake, table), lake.directories(table)
    if not days:
        return silver.limit(0)
    shared = [p for p in parts if p in levels]
    return silver.filter(in_partitions({day[: len(shared)] for day in days}, shared)).filter(in_partitions(days, parts))


def _changed_sales(
    spark: SparkSession, lake: LakeConfig, days: Mapping[str, set[tuple]]
) -> tuple[DataFrame, set[tuple]]:
    """daily_sales for the days of changed orders and of orders whose payments changed."""
    parts = TABLES["orders"].partition_by
    changed = set(days["orders"])
    if days["payments"]:
        paid = silver_days(spark, lake, "payments", days["payments"], parts).select(F.col("order_id").alias("id"))
        orders = within_range(read_silver(spark, lake, "orders"), "id", paid, "id")
        changed |= set(partition_values(orders.join(paid.distinct(), "id", "left_semi"), parts))
    orders = silver_days(spark, lake, "orders", changed, parts)
    payments = within_range(read_silver(spark, lake, "payments"), "order_id", orders, "id")
    return gold.daily_sales(orders, payments, unique_orders=True), {_padded(day) for day in changed}


def _padded(day: tuple) -> tuple:
    """A day as daily_sales spells its partitions."""
    return tuple(None if value is None else f"{value:02d}" for value in day)


def _changed_funnel(
    spark: SparkSession, lake: LakeConfig, days: Mapping[str, set[tuple]]
) -> tuple[DataFrame, set[tuple]]:
    """funnel_analysis for the months with changed page views or orders."""
    parts = gold.GOLD_PARTITIONS["funnel_analysis"]
    months = {(year, month) for year, month, _ in days["page_views"] | days["orders"]}
    views, orders = (silver_days(spark, lake, table, months, parts) for table in ("page_views", "orders"))
    return gold.funnel(views, orders), months


def stored_marts(spark: SparkSession, lake: LakeConfig) -> dict[str, DataFrame]:
    """The Gold tables that have been built, by name: from the catalog where the lake has one, else by path."""
    built = {mart: lake.path("gold", mart) for mart in gold.GOLD_PARTITIONS if path_exists(spark, lake.path("gold", mart))}
    if lake.catalog is None:
        return {mart: spark.read.parquet(path) for mart, path in built.items()}
    return {mart: read_table_or_path(spark, f"{lake.catalog}.gold_{mart}", path) for mart, path in built.items()}


def register_layer(spark: SparkSession, lake: LakeConfig, layer: str) -> None:
    """Bring the catalog's tables of a layer ("silver" or "gold") up to date, if the lake has a catalog."""
    if lake.catalog is None:
        return
    partitions = gold.GOLD_PARTITIONS if layer == "gold" else {name: lake.directories(name) for name in TABLES}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {lake.catalog}")
    for name, parts in partitions.items():
        path = lake.path(layer, name)
        if path_exists(spark, path):
            register_table(spark, f"{lake.catalog}.{layer}_{name}", path, partition_cols=parts)


def build_mart(spark: SparkSession, lake: LakeConfig, mart: str, df: DataFrame, run_id: str) -> RunSummary:
    path = lake.path("gold", mart)
    overwrite_table(df, path, gold.GOLD_PARTITIONS[mart], tiny=mart in gold.DAILY_MARTS)
    # Counted from the files' footers. The schema is given because an empty mart has no file.
    rows = spark.read.schema(df.schema).parquet(path).count()
    return RunSummary("gold", mart, run_id, rows_written=rows, output=path)


def compact_ledgers(spark: SparkSession, lake: LakeConfig) -> None:
    """Keep the number of ledger files bounded however many runs there have been."""
    for path, schema in (
        (lake.watermarks, watermarks.WATERMARK_SCHEMA), (lake.merged_runs, watermarks.MERGED_SCHEMA),
        (lake.merged_files, watermarks.FILES_SCHEMA), (lake.touched_days, watermarks.TOUCHED_SCHEMA),
        (lake.built_marts, watermarks.MERGED_SCHEMA), (lake.totals_runs, watermarks.TOTALS_SCHEMA),
    ):
        watermarks.compact(spark, path, schema)


def side_by_side(
    spark: SparkSession, job: Callable[[str], RunSummary], names: Iterable[str]
) -> list[RunSummary]:
    """Run a stage's jobs, which do not depend on each other, from one driver thread each.

    Small tables need not wait for large ones. All of them finish before the
    first failure, if any, is raised.
    """
    names = list(names)
    with ThreadPoolExecutor(max(1, len(names))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job), name) for name in names]
    return [each.result() for each in running]


def run_pipeline(
    spark: SparkSession,
    lake: LakeConfig,
    sources: Mapping[str, Source],
    run_ts: datetime,
    run_id: str | None = None,
    tables: Iterable[str] | None = None,
    gate: bool = True,
    whole_checks: bool = False,
) -> DataFrame:
    """Extract, refine, check and aggregate; returns one summary row per job.

    Checks cover the partitions this run rewrote, whole tables with ``whole_checks``.

    ``run_ts`` is the upper bound of every extraction window and dates the
    Bronze directories. An exception in any stage ends the run; what was already
    extracted is picked up by the next one.
    """
    tune(spark)
    if run_ts.tzinfo is None:
        run_ts = run_ts.replace(tzinfo=timezone.utc)
    run_ts = run_ts.astimezone(timezone.utc)
    run_id = run_id or make_run_id(run_ts)
    names = list(tables) if tables is not None else [t for t in TABLES if t in sources]
    compact_ledgers(spark, lake)
    summaries = side_by_side(
        spark, lambda t: extract_table(spark, lake, t, sources[t], run_ts, run_id), [t for t in names if t in sources]
    )
    summaries += side_by_side(spark, lambda t: refine_table(spark, lake, t, run_id), names)
    register_layer(spark, lake, "silver")
    checked = [t for t in quality.SUITES if path_exists(spark, lake.path("silver", t))]
    summaries += side_by_side(spark, lambda t: check_table(spark, lake, t, run_id, gate, whole=whole_checks), checked)
    summaries += side_by_side(spark, lambda m: refresh_mart(spark, lake, m, run_id), gold.GOLD_PARTITIONS)
    register_layer(spark, lake, "gold")
    return summary_frame(spark, summaries)
