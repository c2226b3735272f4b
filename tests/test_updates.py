"""What follows changes instead of being rebuilt: the stream's ledger, products, customer and product totals, month layout."""

import os
import random
import shutil
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import marlstone as ms
from marlstone.plans import changes, gold, pipeline
from marlstone.schemas import SOURCE_SCHEMAS, TABLES
from marlstone.sinks import tables
from marlstone.sinks.tables import SIGN, overwrite_table, signed_changes
from marlstone.sources import watermarks
from marlstone.sources.bronze import read_manifest, run_directory
from marlstone.storage import path_exists
from marlstone.streaming import bronze_stream

RUN = datetime(2024, 5, 6, 3, 0, tzinfo=timezone.utc)
ITEM = "id int, order_id int, product_id int, quantity int, unit_price string, at string"


def bronze_items(spark, lake, run_id, ids, files=1, bad=0):
    """One run of order items in so many files, with rows that have no key."""
    rows = [(i, i, i % 3, 1, "2.00", f"2024-01-{i % 28 + 1:02d} 10:00:00") for i in ids]
    rows += [(None, 1, 1, 1, "2.00", "2024-01-01 10:00:00")] * bad
    df = spark.createDataFrame(rows, ITEM).withColumn("created_at", F.col("at").cast("timestamp")).drop("at")
    ms.write_bronze(df.coalesce(1) if files == 1 else df.repartitionByRange(files, "id"), lake.path("bronze", "order_items"), RUN, run_id)
    ms.put_watermark(spark, lake.watermarks, "order_items", RUN, run_id, RUN)
    return run_directory(lake.path("bronze", "order_items"), RUN.date(), run_id)


def silver_ids(spark, lake):
    return sorted(r.id for r in pipeline.read_silver(spark, lake, "order_items").select("id").collect())


def rejected(spark, lake):
    path = lake.path("rejects", "order_items")
    return spark.read.parquet(path).count() if path_exists(spark, path) else 0


def stream(spark, lake, **kwargs):
    return ms.stream_bronze_to_silver(spark, lake, "order_items", lake.path("state", "checkpoint"), **kwargs)


def pending(spark, lake):
    return [r for _, r in watermarks.pending_runs(spark, lake.watermarks, lake.merged_runs, "order_items")]


# --- stream and batch share a ledger --------------------------------------------

def test_manifest_names_files_with_rows(spark, tmp_path):
    lake = ms.LakeConfig(str(tmp_path))
    path = bronze_items(spark, lake, "r1", range(10), files=3)
    assert read_manifest(spark, path) == {f for f in os.listdir(path) if f.endswith(".csv")} and len(read_manifest(spark, path)) == 3
    assert ms.read_bronze(spark, lake.path("bronze", "order_items"), TABLES["order_items"].bronze_columns).count() == 10
    sparse = spark.createDataFrame([(1, 1, 1, 1, "2.00", RUN)], "id int, order_id int, product_id int, quantity int, unit_price string, created_at timestamp")
    empty = sparse.limit(0).unionByName(sparse)  # the first task has no row, but writes a header
    ms.write_bronze(empty, lake.path("bronze", "order_items"), RUN, "r2")
    path = run_directory(lake.path("bronze", "order_items"), RUN.date(), "r2")
    assert len(read_manifest(spark, path)) == 1
    assert read_manifest(spark, run_directory(lake.path("bronze", "order_items"), RUN.date(), "r3")) is None


def test_a_stream_that_stops_between_batches_is_made_up_for_by_a_batch_run(spark, tmp_path, monkeypatch):
    lake = ms.LakeConfig(str(tmp_path))
    bronze_items(spark, lake, "r1", range(6), files=2, bad=1)
    keep, seen = bronze_stream.set_aside, []

    def stops(batch, batch_id, aside):
        if batch_id == 1:
            raise RuntimeError("lost the driver")
        seen.append(batch_id)
        keep(batch, batch_id, aside)

    with monkeypatch.context() as patch:
        patch.setattr(bronze_stream, "set_aside", stops)
        with pytest.raises(Exception, match="lost the driver"):
            stream(spark, lake, max_files_per_trigger=1)
    assert seen == [0] and pending(spark, lake) == ["r1"]
    summary = pipeline.refine_table(spark, lake, "order_items", "batch")
    assert summary.rows_read == 7 and silver_ids(spark, lake) == list(range(6)) and rejected(spark, lake) == 1
    assert pending(spark, lake) == []
    # Resumed, the stream finds that what it had set aside, and the rest, has been taken.
    assert stream(spark, lake, max_files_per_trigger=1).rows_read == 0
    assert silver_ids(spark, lake) == list(range(6)) and rejected(spark, lake) == 1


def test_a_resumed_stream_takes_all_it_had_set_aside_by_one_merge(spark, tmp_path, monkeypatch):
    lake = ms.LakeConfig(str(tmp_path))
    bronze_items(spark, lake, "r1", range(6), files=2)
    keep = bronze_stream.set_aside
    merges = []
    monkeypatch.setattr(bronze_stream, "load_silver", lambda *a, **k: merges.append(a[4]) or pipeline.load_silver(*a, **k))
    with monkeypatch.context() as patch:
        patch.setattr(bronze_stream, "set_aside", lambda batch, n, aside: keep(batch, n, aside) if n < 1 else 1 / 0)
        with pytest.raises(Exception):
            stream(spark, lake, max_files_per_trigger=1)
    bronze_items(spark, lake, "r2", range(6, 9), bad=2)
    summary = stream(spark, lake, max_files_per_trigger=1)
    assert summary.rows_read == 11 and len(merges) == 1 and silver_ids(spark, lake) == list(range(9)) and rejected(spark, lake) == 2
    assert pending(spark, lake) == [] and pipeline.refine_table(spark, lake, "order_items", "b").rows_read == 0


def test_micro_batches_note_files_and_the_merge_reads_them_side_by_side(spark, tmp_path, monkeypatch):
    lake = ms.LakeConfig(str(tmp_path))
    path = bronze_items(spark, lake, "r1", range(8), files=4)
    keep, load, noted, tasks = bronze_stream.set_aside, pipeline.load_silver, [], []

    def aside(batch, n, path):
        keep(batch, n, path)
        noted.extend(spark.read.parquet(f"{path}/batch={n:09d}").collect())

    monkeypatch.setattr(bronze_stream, "set_aside", aside)
    monkeypatch.setattr(
        bronze_stream, "load_silver", lambda s, l, t, raw, *a: tasks.append(len(raw.inputFiles())) or load(s, l, t, raw, *a))
    assert stream(spark, lake, max_files_per_trigger=1).rows_read == 8 and silver_ids(spark, lake) == list(range(8))
    assert {r[bronze_stream.FILE] for r in noted} == read_manifest(spark, path) and len(noted) == 4  # a row per file, none of its rows
    assert tasks == [4]


def test_a_run_seen_in_part_is_finished_by_a_batch_run(spark, tmp_path):
    lake = ms.LakeConfig(str(tmp_path))
    path = bronze_items(spark, lake, "r1", range(9), files=3, bad=1)
    late = sorted(read_manifest(spark, path))[-1]
    shutil.move(f"{path}/{late}", tmp_path / late)  # its writer has not yet published it
    first = stream(spark, lake)
    assert 0 < first.rows_read < 10 and pending(spark, lake) == ["r1"]
    shutil.move(tmp_path / late, f"{path}/{late}")
    second = pipeline.refine_table(spark, lake, "order_items", "batch")
    assert first.rows_read + second.rows_read == 10  # no file was read twice
    assert silver_ids(spark, lake) == list(range(9)) and rejected(spark, lake) == 1 and pending(spark, lake) == []
    assert stream(spark, lake).rows_read == 0


def test_a_merge_that_fails_after_the_stream_is_repeated(spark, tmp_path, monkeypatch):
    lake = ms.LakeConfig(str(tmp_path))
    bronze_items(spark, lake, "r1", range(4), bad=2)

    def lost(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(watermarks, "mark_files", lost)
        with pytest.raises(RuntimeError):
            stream(spark, lake)
    assert pending(spark, lake) == ["r1"]
    bronze_items(spark, lake, "r2", range(4, 6), bad=1)
    assert stream(spark, lake).rows_read == 9
    assert silver_ids(spark, lake) == list(range(6)) and rejected(spark, lake) == 3 and pending(spark, lake) == []


def test_streams_of_products_upsert_buckets(spark, tmp_path):
    lake = ms.LakeConfig(str(tmp_path))
    for run_id, price in (("r1", "1.00"), ("r2", "2.00")):
        rows = [(1, f"P {run_id}", "c", None, Decimal(price), 1, None, RUN + timedelta(hours=price > "1.00"))]
        ms.write_bronze(spark.createDataFrame(rows, SOURCE_SCHEMAS["products"]), lake.path("bronze", "products"), RUN, run_id)
        ms.stream_bronze_to_silver(spark, lake, "products", lake.path("state", "checkpoint"))
    assert [(r.id, r.name) for r in pipeline.read_silver(spark, lake, "products").collect()] == [(1, "P r2")]


# --- layout ------------------------------------------------------------------

@pytest.mark.parametrize("day_directories", [frozenset(), frozenset({"order_items"})])
def test_days_are_found_in_either_layout(spark, tmp_path, day_directories):
    lake = ms.LakeConfig(str(tmp_path), day_directories=day_directories)
    bronze_items(spark, lake, "r1", range(400))
    pipeline.refine_table(spark, lake, "order_items", "r1")
    root = lake.path("silver", "order_items")
    assert sorted(os.listdir(f"{root}/year=2024/month=1"))[0].startswith("day=") == bool(day_directories)
    days = pipeline.silver_days(spark, lake, "order_items", {(2024, 1, 3), (2024, 1, 5), (2023, 1, 1), (None, None, None)})
    assert sorted(r.id for r in days.collect()) == [i for i in range(400) if i % 28 + 1 in (3, 5)]
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and (day_directories or "PushedFilters: []" not in plan)
    assert days.columns == [*TABLES["order_items"].silver_schema().fieldNames(), "year", "month", "day"]
    assert pipeline.silver_days(spark, lake, "order_items", set()).isEmpty()


def test_a_month_is_one_directory_sorted_by_day(spark, tmp_path):
    lake = ms.LakeConfig(str(tmp_path))
    bronze_items(spark, lake, "r1", range(300))
    pipeline.refine_table(spark, lake, "order_items", "r1")
    found = [f for _, _, files in os.walk(lake.path("silver", "order_items")) for f in files if f.endswith(".parquet")]
    assert len(found) == 1
    days = [r.day for r in spark.read.parquet(lake.path("silver", "order_items")).select("day").collect()]
    assert days == sorted(days)


# --- signed changes ----------------------------------------------------------

def test_signed_changes(spark):
    schema = "id int, v string"
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], schema)
    after = spark.createDataFrame([(1, "a"), (2, "c"), (3, None), (4, None)], schema)
    got = sorted(map(tuple, signed_changes(before, after).collect()))
    assert got == [(2, "b", -1), (2, "c", 1), (4, None, 1)] and signed_changes(before, after).columns == ["id", "v", SIGN]


@pytest.mark.parametrize("rows_per_key", [1, 2])
def test_changes_of_a_batch_are_those_of_the_plain_merge(spark, rows_per_key):
    rng, schema = random.Random(4), "id int, v int, at int, s string"
    held = [(i, rng.choice([None, k]), rng.choice([None, 1, 2]), f"h{k}") for i in range(12) for k in range(rows_per_key)]
    rows = [(rng.randrange(16), rng.choice([None, 0, 5]), rng.choice([None, 1, 2, 3]), rng.choice([None, "x"])) for _ in range(20)]
    before, batch = spark.createDataFrame(held, schema), spark.createDataFrame(rows + held[:3], schema)
    before = before.join(batch.select("id").distinct(), "id", "left_semi")
    after = ms.dedup_latest(before.unionByName(batch), ["id"], ["at"])
    made, _ = tables.batch_changes(before, batch, ["id"], ["at"])
    made = spark.createDataFrame(made.collect(), f"{schema}, {SIGN} int")
    if rows_per_key == 1:  # several rows of a key are what a merge that failed half-way leaves
        assert sorted(map(str, made.collect())) == sorted(map(str, signed_changes(before, after).collect()))
    left = tables._changed(before, made, ["id"])
    assert sorted(map(str, left.collect())) == sorted(map(str, after.collect()))


def test_a_recorded_merge_shuffles_a_batch_once_and_counts_its_keys(spark, tmp_path, monkeypatch):
    lake, seen, first = ms.LakeConfig(str(tmp_path), incremental_gold=True), [], tables.dedup_latest
    monkeypatch.setattr(tables, "dedup_latest", lambda df, *a: seen.append(df) or first(df, *a))
    columns = SOURCE_SCHEMAS["order_items"].fieldNames()

    def load(run_id, *rows):
        raw = spark.createDataFrame([(str(i), "1", "1", q, "2.00", day) for i, q, day in rows], [*columns]).select(
            *[F.col(c).cast("string") for c in columns])
        summary = pipeline.load_silver(spark, lake, TABLES["order_items"], raw, run_id)
        return summary.rows_written, summary.duplicates_removed

    assert load("r1", (1, "1", "2024-01-01"), (1, "1", "2024-01-01"), (2, "5", "2024-01-01")) == (2, 1) and len(seen) == 1
    assert load("r2", (2, "6", "2024-02-01"), (1, "1", "2024-01-01"), (3, "7", "2024-01-02")) == (3, 0)
    assert len(seen) == 3  # the batch and the rows it meets, not the whole months a second time
    silver = pipeline.read_silver(spark, lake, "order_items")
    assert sorted((r.id, r.quantity, r.month) for r in silver.collect()) == [(1, 1, 1), (2, 6, 2), (3, 7, 1)]
    made = spark.read.parquet(lake.changes("order_items", "r2"))
    assert sorted((r.id, r.quantity, r[SIGN]) for r in made.collect()) == [(2, 5, -1), (2, 6, 1), (3, 7, 1)]


# --- products ------------------------------------------------------------------

def test_products_read_only_pending_runs(spark, tmp_path):
    lake = ms.LakeConfig(str(tmp_path))

    def go(hours, *rows):
        full = [(i, name, "c", None, Decimal("1.00"), 1, None, RUN + timedelta(hours=at)) for i, name, at in rows]
        source = ms.dataframe_source(spark.createDataFrame(full, SOURCE_SCHEMAS["products"]))
        ms.run_pipeline(spark, lake, {"products": source}, RUN + timedelta(hours=hours), gate=False, tables=["products"])
        return sorted((r.id, r.name) for r in pipeline.read_silver(spark, lake, "products").collect())

    read = []
    assert go(1, *[(i, f"p{i}", 0) for i in range(20)]) == [(i, f"p{i}") for i in range(20)]
    first = {f: os.path.getmtime(f"{d}/{f}") for d, _, files in os.walk(lake.path("silver", "products")) for f in files}
    shutil.move(f"{tmp_path}/bronze/products", f"{tmp_path}/gone")  # nothing of it is needed any more
    expected = dict(enumerate(f"p{i}" for i in range(20))) | {3: "new", 50: "p50"}
    assert go(3, (3, "new", 2), (50, "p50", 2)) == sorted(expected.items())
    left = {f for _, _, files in os.walk(lake.path("silver", "products")) for f in files}
    assert len(set(first) & left) >= 2 and not read  # buckets without news keep their files
    assert "key_bucket" not in pipeline.read_silver(spark, lake, "products").columns


# --- totals --------------------------------------------------------------------

def _shop(spark, lake, rng, hours, n_users=6, n_orders=12, tables=None):
    """A run of random inserts, updates and moves of all tables that totals follow, or of some."""
    at = RUN + timedelta(hours=hours)

    def day():
        return RUN + timedelta(days=rng.randrange(-40, 0))

    users = [(i, f"u{i}-{rng.randrange(3)}@x", f"U{i}", "h", RUN, at) for i in rng.sample(range(n_users), 3)]
    orders = [(i, rng.choice([None, *range(n_users + 1)]), "confirmed", None, None, Decimal("5.00"), None, day(), at)
              for i in rng.sample(range(n_orders), 5)]
    payments = [(i, rng.randrange(n_orders), Decimal(rng.randrange(1, 900)) / 100, "card", rng.choice(["completed", "failed"]), None, at)
                for i in rng.sample(range(15), 5)]
    items = [(i, rng.choice([None, *range(5)]), rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 2]),
              rng.choice([None, Decimal(rng.randrange(1, 900)) / 100]), at) for i in rng.sample(range(20), 7)]
    products = [(i, f"p{i}-{rng.randrange(3)}", "c", None, Decimal("1.00"), 1, None, at) for i in rng.sample(range(1, 4), 1)]
    for table, rows in (("customers", users), ("orders", orders), ("payments", payments), ("order_items", items), ("products", products)):
        if tables is not None and table not in tables:
            continue
        raw = spark.createDataFrame(rows, SOURCE_SCHEMAS[TABLES[table].source])
        raw = raw.select(*[F.col(c).cast("string") for c in raw.columns])
        pipeline.load_silver(spark, lake, TABLES[table], raw, f"r{hours}")


def _agrees(spark, lake, marts=("customer_ltv", "top_products")):
    full = pipeline.gold_marts({t: pipeline.read_silver(spark, lake, t) for t in TABLES})
    for mart in marts:
        stored = spark.read.schema(full[mart].schema).parquet(lake.path("gold", mart))
        assert sorted(map(str, stored.collect())) == sorted(map(str, full[mart].collect())), mart


def test_totals_follow_inserts_updates_and_moves(spark, tmp_path, monkeypatch):
    rng = random.Random(1)
    lake = ms.LakeConfig(str(tmp_path), incremental_gold=True)
    whole = []
    monkeypatch.setitem(changes.TOTALS, "customer_ltv", _watched(changes.TOTALS["customer_ltv"], whole))
    monkeypatch.setitem(changes.TOTALS, "top_products", _watched(changes.TOTALS["top_products"], whole))
    for hours in range(3):
        _shop(spark, lake, rng, hours)
        if hours == 1:
            _shop(spark, lake, rng, 30)  # two runs before the marts are refreshed
        for mart in changes.TOTALS:
            pipeline.refresh_mart(spark, lake, mart, f"r{hours}")
        _agrees(spark, lake)
    assert whole == ["customer_ltv", "top_products"]  # built once, followed ever after
    assert pipeline.refresh_mart(spark, lake, "customer_ltv", "again").rows_written == 0
    assert not any(files for _, _, files in os.walk(lake.path("state", "changes")))


def _watched(totals, log):
    name = "customer_ltv" if totals.key == "customer_id" else "top_products"
    return changes.Totals(
        totals.key, totals.facts, totals.named, lambda now: log.append(name) or totals.whole(now), totals.gains, totals.added, totals.publish)


def test_a_customer_who_loses_the_first_order_is_looked_up_again(spark, tmp_path):
    lake = ms.LakeConfig(str(tmp_path), incremental_gold=True)

    def load(run_id, orders=(), payments=(), users=()):
        for table, rows in (("customers", users), ("orders", orders), ("payments", payments)):
            if rows:
                raw = spark.createDataFrame(rows, SOURCE_SCHEMAS[TABLES[table].source])
                pipeline.load_silver(spark, lake, TABLES[table], raw.select(*[F.col(c).cast("string") for c in raw.columns]), run_id)
        pipeline.refresh_mart(spark, lake, "customer_ltv", run_id)
        _agrees_on(spark, lake, "customer_ltv")
        rows = spark.read.parquet(lake.path("gold", "customer_ltv")).collect()
        return {r.customer_id: (r.total_orders, r.total_revenue, str(r.first_order_date)[:10], r.cohort_month) for r in rows}

    def order(i, user, day, hour=0):
        return (i, user, "confirmed", None, None, Decimal("5.00"), None, datetime(2024, *day), RUN + timedelta(hours=hour))

    users = [(i, f"u{i}", "U", "h", RUN, RUN) for i in (1, 2)]
    pay = [(1, 10, Decimal("3.00"), "card", "completed", None, RUN), (2, 99, Decimal("7.00"), "card", "completed", None, RUN)]
    assert load("a", [order(10, 1, (1, 5)), order(11, 1, (3, 5))], pay, users) == {1: (2, 3.0, "2024-01-05", 1), 2: (0, 0.0, "None", None)}
    assert load("b", [order(10, 2, (1, 5), 1)]) == {1: (1, 0.0, "2024-03-05", 3), 2: (1, 3.0, "2024-01-05", 1)}
    # An order that arrives after its payment, and a payment taken back together with its order's move.
    assert load("c", [order(99, 2, (2, 1))])[2] == (2, 10.0, "2024-01-05", 1)
    back = [(1, 10, Decimal("3.00"), "card", "refunded", None, RUN + timedelta(hours=2))]
    assert load("d", [order(10, 1, (1, 5), 2)], back) == {1: (2, 0.0, "2024-01-05", 1), 2: (1, 7.0, "2024-02-01", 2)}


def _agrees_on(spark, lake, mart):
    full = pipeline.gold_marts({t: pipeline.read_silver(spark, lake, t) for t in TABLES})[mart]
    stored = spark.read.schema(full.schema).parquet(lake.path("gold", mart))
    assert sorted(map(str, stored.collect())) == sorted(map(str, full.collect()))


@pytest.mark.parametrize("step", ["commit", "merge", "same id", "rebuild", "was not incremental"])
def test_totals_after_failures(spark, tmp_path, monkeypatch, step):
    rng = random.Random(11)
    lake = ms.LakeConfig(str(tmp_path), incremental_gold=True)
    mart, facts = ("customer_ltv", ("orders", "customers")) if step == "commit" else ("top_products", ("order_items",))

    def lost(*args, **kwargs):
        raise RuntimeError("lost")

    def shop(hours, rng=rng, lake=lake):
        _shop(spark, lake, rng, hours, tables=facts)

    shop(0)
    pipeline.refresh_mart(spark, lake, mart, "r0")
    if step == "commit":  # the mart was written, the version not put in force
        shop(1)
        with monkeypatch.context() as patch:
            patch.setattr(watermarks, "commit_totals", lost)
            with pytest.raises(RuntimeError):
                pipeline.refresh_mart(spark, lake, mart, "r1")
    elif step == "rebuild":
        raw = spark.createDataFrame([(1, 1, 1, 1, Decimal("2.00"), RUN)], SOURCE_SCHEMAS["order_items"])
        raw = raw.select(*[F.col(c).cast("string") for c in raw.columns])
        pipeline.load_silver(spark, lake, TABLES["order_items"], raw, "r0", replace=True)
    elif step == "was not incremental":
        shop(1, lake=ms.LakeConfig(str(tmp_path)))
    else:
        with monkeypatch.context() as patch:
            patch.setattr(tables, "replace_partitions", lost)
            with pytest.raises(RuntimeError):
                shop(1, random.Random(5))
        if step == "same id":
            shop(1, random.Random(5))
    for hours in (2, 3) if step == "same id" else (2,):
        shop(hours)
        pipeline.refresh_mart(spark, lake, mart, f"r{hours}")
        _agrees(spark, lake, [mart])


def test_only_cohorts_of_changed_customers_are_rewritten(spark, tmp_path):
    lake = ms.LakeConfig(str(tmp_path), incremental_gold=True)

    def load(run_id, table, rows):
        raw = spark.createDataFrame(rows, SOURCE_SCHEMAS[TABLES[table].source])
        pipeline.load_silver(spark, lake, TABLES[table], raw.select(*[F.col(c).cast("string") for c in raw.columns]), run_id)

    def files(month):
        return sorted(os.listdir(lake.path("gold", "customer_ltv") + f"/cohort_year=2024/cohort_month={month}"))

    load("a", "customers", [(i, f"u{i}", "U", "h", RUN, RUN) for i in (1, 2)])
    load("a", "orders", [(i, i, "confirmed", None, None, Decimal("5.00"), None, datetime(2024, i, 1), RUN) for i in (1, 2)])
    pipeline.refresh_mart(spark, lake, "customer_ltv", "a")
    before = files(1), files(2)
    load("b", "customers", [(2, "new", "U", "h", RUN, RUN + timedelta(hours=1))])
    assert pipeline.refresh_mart(spark, lake, "customer_ltv", "b").rows_written == 1
    assert files(1) == before[0] and files(2) != before[1]
    _agrees_on(spark, lake, "customer_ltv")


# --- reports -------------------------------------------------------------------

@pytest.mark.parametrize("mart, report", [("daily_sales", "daily_revenue"), ("funnel_analysis", "funnel_analysis")])
@pytest.mark.parametrize("plain_sql", [True, False])
def test_reports_open_only_partitions_of_their_period(spark, tmp_path, mart, report, plain_sql):
    days = spark.range(400).select(F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    numbers = {f.name: F.lit(3).cast(f.dataType).alias(f.name) for f in pipeline.gold_marts(
        {t: spark.createDataFrame([], spec.silver_schema()) for t, spec in TABLES.items()})[mart].schema}
    day = {"daily_sales": "sale_date", "funnel_analysis": "event_date"}[mart]
    parts = gold.GOLD_PARTITIONS[mart]
    df = days.select(*[F.col("day").alias(c) if c == day else numbers[c] for c in numbers if c not in parts])
    df = ms.add_date_parts(df, day, parts, as_string=mart == "daily_sales")
    path = str(tmp_path / mart)
    overwrite_table(df, path, parts)
    stored = spark.read.parquet(path)
    as_of = "2023-12-15"
    if plain_sql:
        found = ms.run_report(spark, report, as_of, **{mart: stored})
    else:
        found = {"daily_revenue": ms.report_daily_revenue}.get(report, ms.plans.reports.report_funnel)(stored, as_of)
    assert found.count() == 30 + 52  # 30 days before, that day, and the days after it that are stored
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    metrics = found._jdf.queryExecution().executedPlan()
    found.collect()
    scans = [n for n in _nodes(metrics) if "Scan" in n.nodeName()]
    opened = {n.metrics().apply("numPartitions").value() for n in scans}
    assert opened == {82 if mart == "daily_sales" else 4}


def _nodes(plan):
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _nodes(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return _nodes(plan.plan())
    children = plan.children()
    return [plan] + [n for k in range(children.size()) for n in _nodes(children.apply(k))]
