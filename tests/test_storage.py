"""Bronze, Silver and catalog files: what survives a round trip, a rerun or a merge."""

import os
import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import marlstone as ms
from marlstone.plans.silver import silver
from marlstone.schemas import TABLES
from marlstone.sinks.tables import overwrite_partitions, overwrite_table, read_partitions
from marlstone.sources import watermarks
from marlstone.sources.bronze import CSV_OPTIONS, day_predicate, read_manifest, run_directory
from marlstone.storage import clear_scratch, list_files, path_exists, scratch_path

RUN = datetime(2024, 5, 6, 3, 0, tzinfo=timezone.utc)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def batch(spark, rows):
    """rows: (id, created_at text, version)"""
    df = spark.createDataFrame(rows, "id int, at string, version int")
    df = df.select("id", F.col("at").cast("timestamp").alias("created_at"), "version")
    return ms.add_date_parts(df, "created_at")


def stored(spark, path):
    df = spark.read.parquet(path)
    return sorted((r.id, r.version) for r in df.collect())


def merge(df, path, **kwargs):
    ms.merge_partitions(df, path, ["id"], ["version"], ["year", "month", "day"], **kwargs)


def test_bronze_keeps_text_and_microseconds(spark, tmp_path):
    root = str(tmp_path / "bronze")
    texts = ['line one\nline "two", three', "  outer spaces  ", "back\\slash", "naïve ✓", "'single'", "a,b;c", '"', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, address string")
    df = df.withColumn("created_at", F.lit("2024-05-05 01:02:03.456789").cast("timestamp"))
    written = ms.write_bronze(df, root, RUN, "r1")
    assert written.rows == len(texts)
    assert written.last_extracted_at == datetime(2024, 5, 5, 1, 2, 3, 456789, tzinfo=timezone.utc)
    back = ms.read_bronze(spark, root, ["id", "address", "created_at"])
    assert [r.address for r in back.orderBy(F.col("id").cast("int")).collect()] == texts
    assert back.select(F.unix_micros(F.col("created_at").cast("timestamp"))).distinct().count() == 1
    assert (back.first().year, back.first().month, back.first().day, back.first().run_id) == ("2024", "05", "06", "r1")


def test_whole_documents_survive_bronze(spark, tmp_path):
    root = str(tmp_path / "bronze")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("doc_id").alias("id"), "text", F.lit(RUN).alias("created_at"))
    ms.write_bronze(docs, root, RUN, "r1")
    back = ms.read_bronze(spark, root, ["id", "text", "created_at"])
    changed = back.select(F.col("id").cast("long").alias("id"), F.col("text").alias("stored")).join(docs, "id", "full")
    assert changed.filter(~F.col("stored").eqNullSafe(F.col("text"))).count() == 0


def test_two_runs_on_one_day_keep_both(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for run_id, n in (("r1", 2), ("r2", 3), ("r2", 4)):
        df = spark.range(n).withColumn("created_at", F.lit(RUN))
        ms.write_bronze(df, root, RUN, run_id)
    back = ms.read_bronze(spark, root, ["id", "created_at"])
    assert back.groupBy("run_id").count().orderBy("run_id").collect() == [("r1", 2), ("r2", 4)]


def test_long_rows_make_more_files(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "bronze")
    monkeypatch.setattr("marlstone.sinks.bronze.FILE_BYTES", 20_000)
    texts = [f'{k} "said",\n' + "x" * (900 if k < 60 else 10) for k in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, address string").withColumn("created_at", F.lit(RUN)).coalesce(1)
    assert ms.write_bronze(df, root, RUN, "r1").rows == 200
    path = run_directory(root, RUN.date(), "r1")
    sizes = [length for _, length in list_files(spark, path)]
    assert len(sizes) > 3 and max(sizes) <= 60_000 and len(read_manifest(spark, path)) == len(sizes)
    back = ms.read_bronze(spark, root, ["id", "address", "created_at"])
    assert sorted((int(r.id), r.address) for r in back.collect()) == list(enumerate(texts))
    assert back.select(F.col("created_at").cast("timestamp")).distinct().first()[0] is not None


def test_empty_batch_writes_nothing(spark, tmp_path):
    root = str(tmp_path / "bronze")
    df = spark.range(0).withColumn("created_at", F.lit(RUN))
    assert ms.write_bronze(df, root, RUN, "r1").rows == 0
    assert not [f for _, _, files in os.walk(root) for f in files]
    assert ms.read_bronze(spark, root, ["id", "created_at"]).count() == 0


def test_bronze_day_and_runs_open_only_their_directories(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for day in (1, 2):
        df = spark.range(day).withColumn("created_at", F.lit(RUN))
        ms.write_bronze(df, root, RUN.replace(day=day), f"r{day}")
    one = ms.read_bronze(spark, root, ["id", "created_at"], day=date(2024, 5, 2))
    assert one.count() == 2 and all("day=02" in f for f in one.inputFiles())
    runs = ms.read_bronze(spark, root, ["id", "created_at"], runs=[("2024-05-01", "r1"), ("2024-05-09", "gone")])
    assert runs.count() == 1


def test_default_partition_date_is_yesterday_utc():
    now = datetime(2024, 3, 1, 1, 0, tzinfo=timezone(timedelta(hours=2)))
    assert ms.resolve_partition_date(now=now) == date(2024, 2, 28)
    assert ms.resolve_partition_date("2024-01-05") == date(2024, 1, 5)


def test_merge_across_midnight_keeps_yesterday(spark, tmp_path):
    path = str(tmp_path / "t")
    merge(batch(spark, [(1, "2024-01-01 10:00:00", 1), (2, "2024-01-01 23:00:00", 1), (9, "2023-12-31 10:00:00", 1)]), path)
    merge(batch(spark, [(2, "2024-01-01 23:00:00", 2), (3, "2024-01-01 23:59:00", 1), (4, "2024-01-02 00:10:00", 1)]), path)
    assert stored(spark, path) == [(1, 1), (2, 2), (3, 1), (4, 1), (9, 1)]
    merge(batch(spark, [(2, "2024-01-01 23:00:00", 1)]), path)  # an older version arrives late
    assert stored(spark, path) == [(1, 1), (2, 2), (3, 1), (4, 1), (9, 1)]


def test_merge_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    merge(batch(spark, [(1, "2024-01-01 10:00:00", 1), (2, "2024-01-02 10:00:00", 1)]), path)
    untouched = sorted(os.listdir(f"{path}/year=2024/month=1/day=1"))
    merge(batch(spark, [(3, "2024-01-02 11:00:00", 1)]), path)
    assert sorted(os.listdir(f"{path}/year=2024/month=1/day=1")) == untouched
    assert stored(spark, path) == [(1, 1), (2, 1), (3, 1)]


def test_a_row_that_changes_partition_leaves_its_old_one(spark, tmp_path):
    path = str(tmp_path / "t")
    merge(batch(spark, [(1, "2024-01-01 10:00:00", 1), (2, "2024-01-05 10:00:00", 1), (3, None, 1)]), path)
    merge(batch(spark, [(1, "2024-02-01 10:00:00", 2), (3, "2024-01-05 10:00:00", 2), (2, "2024-03-01 00:00:00", 0)]), path)
    assert stored(spark, path) == [(1, 2), (2, 1), (3, 2)]
    rows = {r.id: (r.year, r.month, r.day) for r in spark.read.parquet(path).collect()}
    assert rows == {1: (2024, 2, 1), 2: (2024, 1, 5), 3: (2024, 1, 5)}


def test_merge_leaves_no_staging_behind(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared)) if os.path.exists(shared) else set()
    path = str(tmp_path / "t")
    merge(batch(spark, [(1, "2024-01-01 10:00:00", 1)]), path)
    merge(batch(spark, [(1, "2024-01-01 10:00:00", 2)]), path)
    assert set(os.listdir(shared)) == before


@pytest.mark.parametrize("track_moves", [True, False])
def test_batches_cut_anywhere_give_the_same_table(spark, tmp_path, track_moves):
    rng = random.Random(5)
    rows = []
    for version in range(60):
        key = rng.randrange(20)
        # Without move tracking the partitioning timestamp must not change for a key.
        day = rng.randrange(1, 6) if track_moves else key % 5 + 1
        rows.append((key, f"2024-01-{day:02d} 10:00:00", version))
    rng.shuffle(rows)
    whole = ms.dedup_latest(batch(spark, rows), ["id"], ["version"])
    expected = sorted((r.id, r.version) for r in whole.collect())
    path = str(tmp_path / "t")
    cuts = [0, *sorted(rng.sample(range(1, len(rows)), 3)), len(rows)]
    for low, high in zip(cuts, cuts[1:]):
        merge(batch(spark, rows[low:high]), path, track_moves=track_moves)
        merge(batch(spark, rows[low:high]), path, track_moves=track_moves)  # a rerun changes nothing
    assert stored(spark, path) == expected


@pytest.mark.parametrize("more", [0, 6_000])
def test_any_number_of_partitions_is_pruned_by_one_predicate(spark, tmp_path, more):
    path = str(tmp_path / "t")
    df = batch(spark, [(i, f"2024-01-{i:02d} 10:00:00", 1) for i in range(1, 8)] + [(9, None, 1)])
    merge(df, path)
    wanted = {(2024, 1, 2), (2024, 1, 3), (None, None, None)}
    wanted |= {(2030 + k // 336, k // 28 % 12 + 1, k % 28 + 1) for k in range(more)}
    read = read_partitions(spark, path, df.schema, wanted, ["year", "month", "day"])
    assert ids(read) == [2, 3, 9]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan and "Exchange" not in plan
    assert len(read.inputFiles()) <= len(df.select("year", "month", "day").distinct().collect())
    merge(batch(spark, [(2, "2024-01-02 10:00:00", 2), (3, "2024-01-03 10:00:00", 2)]), path)
    assert stored(spark, path) == [(1, 1), (2, 2), (3, 2), (4, 1), (5, 1), (6, 1), (7, 1), (9, 1)]


def test_dynamic_overwrite_is_per_write_and_full_overwrite_is_full(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(batch(spark, [(1, "2024-01-01 10:00:00", 1), (2, "2024-01-02 10:00:00", 1)]), path, ["year", "month", "day"])
    overwrite_partitions(batch(spark, [(3, "2024-01-02 10:00:00", 1)]), path, ["year", "month", "day"])
    assert stored(spark, path) == [(1, 1), (3, 1)]
    overwrite_table(batch(spark, [(4, "2024-01-03 10:00:00", 1)]), path, ["year", "month", "day"])
    assert stored(spark, path) == [(4, 1)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_catalog_finds_new_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    df = batch(spark, [(1, "2024-01-01 10:00:00", 1)])
    overwrite_table(df, path, ["year", "month", "day"])
    parts = ["year", "month", "day"]
    spark.sql("DROP TABLE IF EXISTS silver_reg")
    assert ms.register_table(spark, "silver_reg", path, partition_cols=parts).count() == 1
    wider = batch(spark, [(2, "2024-01-02 10:00:00", 1)]).withColumn("extra", F.lit("x"))
    overwrite_partitions(wider.select("id", "created_at", "version", "extra", *parts), path, parts)
    table = ms.register_table(spark, "silver_reg", path, partition_cols=parts, options={"mergeSchema": "true"})
    assert sorted((r.id, r.extra) for r in table.collect()) == [(1, None), (2, "x")]
    pruned = spark.table("silver_reg").filter("day = 2")
    assert len(pruned.inputFiles()) == 1
    spark.sql("DROP TABLE silver_reg")


def test_bronze_as_a_catalog_table_prunes_by_day(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for day in (1, 2):
        ms.write_bronze(spark.range(day).withColumn("created_at", F.lit(RUN)), root, RUN.replace(day=day), f"r{day}")
    parts = ["year", "month", "day", "run_id"]
    spark.sql("DROP TABLE IF EXISTS bronze_reg")
    table = ms.register_table(
        spark, "bronze_reg", root, "csv", "id string, created_at string, year string, month string, day string, run_id string",
        parts, CSV_OPTIONS)
    day = table.filter(day_predicate(date(2024, 5, 2)))
    assert day.count() == 2
    assert "PartitionFilters: [isnotnull(year" in day._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE bronze_reg")


def test_scratch_is_shared_and_cleared(spark):
    path = scratch_path(spark, "some")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    spark.range(3).write.parquet(path)
    assert path_exists(spark, path)
    clear_scratch(spark)
    assert not path_exists(spark, path)


def test_table_or_path(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(3).write.parquet(path)
    assert ms.read_table_or_path(spark, "no_such_table", path).count() == 3
    spark.sql("DROP TABLE IF EXISTS maybe_empty")
    spark.sql("CREATE TABLE maybe_empty (id BIGINT) USING parquet")
    assert ms.read_table_or_path(spark, "maybe_empty", path).count() == 3
    spark.range(5).write.mode("append").insertInto("maybe_empty")
    assert ms.read_table_or_path(spark, "maybe_empty", path).count() == 5
    spark.sql("DROP TABLE maybe_empty")


def test_watermarks(spark, tmp_path):
    path, merged = str(tmp_path / "marks"), str(tmp_path / "merged")
    assert ms.get_watermark(spark, path, "orders") == watermarks.EPOCH
    first = datetime(2024, 1, 1, 2, 3, 4, 567891, tzinfo=timezone.utc)
    ms.put_watermark(spark, path, "orders", first, "r1", RUN)
    ms.put_watermark(spark, path, "payments", RUN, "r1", RUN)
    assert ms.get_watermark(spark, path, "orders") == first
    ms.put_watermark(spark, path, "orders", first + timedelta(days=1), "r2", RUN + timedelta(days=1))
    assert ms.get_watermark(spark, path, "orders") == first + timedelta(days=1)
    assert watermarks.pending_runs(spark, path, merged, "orders") == [("2024-05-06", "r1"), ("2024-05-07", "r2")]
    watermarks.mark_merged(spark, merged, "orders", ["r1"])
    assert watermarks.pending_runs(spark, path, merged, "orders") == [("2024-05-07", "r2")]


def test_ledgers_of_many_runs_become_one_file(spark, tmp_path, monkeypatch):
    marks, merged, touched = (str(tmp_path / name) for name in ("marks", "merged", "touched"))
    for k in range(5):
        ms.put_watermark(spark, marks, "orders", RUN + timedelta(days=k), f"r{k}", RUN)
        watermarks.note_touched(spark, touched, "orders", f"r{k}", {(2024, 1, k + 1)})
    watermarks.mark_merged(spark, merged, "orders", ["r0", "r1"])
    ms.put_watermark(spark, marks, "payments", RUN, "r1", RUN)

    def state():
        return (
            [ms.get_watermark(spark, marks, t) for t in ("orders", "payments", "products")],
            watermarks.pending_runs(spark, marks, merged, "orders"),
            watermarks.partitions_of_run(spark, touched, "orders", "r3", ("year", "month", "day")),
        )

    before = state()
    for path, schema in ((marks, watermarks.WATERMARK_SCHEMA), (merged, watermarks.MERGED_SCHEMA), (touched, watermarks.TOUCHED_SCHEMA)):
        with monkeypatch.context() as patch:  # stopped before the old files went
            patch.setattr(watermarks, "remove_path", lambda *a: None)
            watermarks.compact(spark, path, schema, 2)
        assert state() == before
        watermarks.compact(spark, path, schema, 2)
        assert state() == before
    assert [len([f for f in os.listdir(f"{p}/table_name=orders") if f.endswith(".parquet")]) for p in (marks, merged, touched)] == [1, 1, 1]
    ms.put_watermark(spark, marks, "orders", RUN + timedelta(days=9), "r9", RUN)
    assert ms.get_watermark(spark, marks, "orders") == RUN + timedelta(days=9)


def test_stream_merges_new_bronze_files_once(spark, tmp_path):
    lake = ms.LakeConfig(str(tmp_path), wide_keys=True, incremental_gold=True)
    bronze, path, checkpoint = lake.path("bronze", "order_items"), lake.path("silver", "order_items"), str(tmp_path / "checkpoint")

    def extract(rows, run_id):
        df = spark.createDataFrame(rows, "id int, order_id int, product_id int, quantity int, unit_price string, at string")
        df = df.select("id", "order_id", "product_id", "quantity", "unit_price", F.col("at").cast("timestamp").alias("created_at"))
        ms.write_bronze(df, bronze, RUN, run_id)

    def run():
        return ms.stream_bronze_to_silver(spark, lake, "order_items", checkpoint)

    extract([(1, 1, 1, 2, "3.00", "2024-01-01 10:00:00"), (1, 1, 1, 5, "3.00", "2024-01-01 11:00:00")], "r1")
    run()
    extract([(2, 1, 1, 1, "3.00", "2024-01-01 12:00:00"), (None, 1, 1, 1, "3.00", "2024-01-01 12:00:00")], "r2")
    summary = run()
    assert (summary.rows_read, summary.rows_written, summary.rows_rejected) == (2, 1, 1)
    assert run().rows_read == 0
    rows = sorted((r.id, r.quantity) for r in spark.read.parquet(path).collect())
    assert rows == [(1, 5), (2, 1)]
    rejects = spark.read.parquet(lake.path("rejects", "order_items")).collect()
    assert [r.reject_reason for r in rejects] == ["missing or malformed key: id"]
    assert dict(spark.read.parquet(path).dtypes)["id"] == "bigint"
    ms.put_watermark(spark, lake.watermarks, "order_items", RUN, "r1", RUN)
    ms.put_watermark(spark, lake.watermarks, "order_items", RUN, "r2", RUN)
    assert watermarks.pending_runs(spark, lake.watermarks, lake.merged_runs, "order_items") == []
    raw = ms.read_bronze(spark, bronze, TABLES["order_items"].bronze_columns)
    assert ids(silver(raw, TABLES["order_items"])) == [1, 2]
