"""Whole runs: incremental equals one-shot, reruns are harmless, failures stop and recover."""

import os
import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import marlstone as ms
from marlstone.plans import pipeline
from marlstone.schemas import SOURCE_SCHEMAS, TABLES
from marlstone.sources import watermarks

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
END = START + timedelta(days=4)


def build_sources(spark, seed=3, dirty=True):
    """A small shop whose rows arrive over four days, as source tables would hold them."""
    rng = random.Random(seed)

    def at():
        return START + timedelta(microseconds=rng.randrange(4 * 86_400_000_000))

    data = {t: [] for t in SOURCE_SCHEMAS}
    for i in range(1, 9):
        t = at()
        data["users"].append((i, f" U{i}@X.Example", f"U{i} ", "hash", t, t))
        data["products"].append((i, f" P{i}", "Books", " ", Decimal("9.99"), 5, None, at()))
    for i in range(1, 41):
        t = at()
        data["orders"].append((i, rng.randrange(1, 8), " CONFIRMED", Decimal("10.00"), Decimal("1.00"),
                               Decimal("11.00") * rng.randrange(1, 9), "1 Main St,\n\"Flat\" 2", t, t))
        data["payments"].append((i, i, Decimal("11.00"), "Card", rng.choice(["completed", "failed"]), None, t))
        for n in range(rng.randrange(1, 4)):
            data["order_items"].append((i * 10 + n, i, rng.randrange(1, 9), rng.randrange(1, 5), Decimal("9.99"), t))
    for i in range(1, 121):
        path = rng.choice(["/", "/cart", "/products/1", "/products/2", "/?category=Books"])
        data["page_views"].append((i, None, f"s{rng.randrange(9)}", path, "", 5, at()))
    if dirty:  # the same keys again: only the newest version may survive
        data["products"] += [(i, "P new", "Books", "d", Decimal("1.00"), 6, None, END) for i in (1, 2)]
        data["order_items"] += [(10, 1, 3, 9, Decimal("9.99"), END)]
    return {t: spark.createDataFrame(rows, SOURCE_SCHEMAS[t]) for t, rows in data.items()}


def run(spark, root, frames, run_ts, config=None, **kwargs):
    sources = {name: ms.dataframe_source(frames[spec.source]) for name, spec in TABLES.items()}
    return ms.run_pipeline(spark, ms.LakeConfig(str(root), **(config or {})), sources, run_ts, **kwargs)


def table(spark, root, layer, name):
    df = spark.read.parquet(f"{root}/{layer}/{name}")
    return sorted(([str(r[c]) for c in sorted(df.columns)] for r in df.collect()))


SILVER = list(TABLES)
GOLD = ["daily_sales", "customer_ltv", "top_products", "funnel_analysis"]


@pytest.fixture(scope="module")
def frames(spark):
    return {t: df.cache() for t, df in build_sources(spark).items()}


@pytest.fixture(scope="module")
def one_shot(spark, frames, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    summary = run(spark, root, frames, END)
    return root, [r.asDict() for r in summary.collect()]


def test_one_run_fills_every_layer(spark, one_shot):
    root, summary = one_shot
    stages = {}
    for row in summary:
        stages.setdefault(row["stage"], set()).add(row["table_name"])
    assert stages == {"extract": set(SILVER), "silver": set(SILVER), "quality": {"orders", "payments"}, "gold": set(GOLD)}
    items = next(r for r in summary if (r["stage"], r["table_name"]) == ("silver", "order_items"))
    assert items["duplicates_removed"] == 1 and items["rows_rejected"] == 0
    assert items["rows_read"] == items["rows_written"] + 1
    customers = spark.read.parquet(f"{root}/silver/customers")
    assert "password_hash" not in customers.columns
    assert customers.filter("email = 'u1@x.example' and name = 'U1'").count() == 1
    address = spark.read.parquet(f"{root}/silver/orders").first().shipping_address
    assert address == '1 Main St,\n"Flat" 2'


def test_gold_in_the_lake_equals_the_functions(spark, frames, one_shot):
    root, _ = one_shot
    silver = {n: spark.read.parquet(f"{root}/silver/{n}") for n in SILVER}
    expected = ms.top_products(silver["order_items"], silver["products"])
    stored = spark.read.parquet(f"{root}/gold/top_products")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, expected.collect()))
    # Zero-padded partition values keep their zeros in the directory names.
    assert "month=01" in os.listdir(f"{root}/gold/daily_sales/year=2024")


@pytest.mark.parametrize("incremental_gold", [False, True])
def test_batches_cut_anywhere_give_the_same_lake(spark, frames, one_shot, tmp_path, incremental_gold):
    whole, _ = one_shot
    rng = random.Random(17)
    cuts = sorted(START + timedelta(seconds=rng.randrange(4 * 86_400)) for _ in range(2))
    for run_ts in [*cuts, END]:
        run(spark, tmp_path, frames, run_ts, {"incremental_gold": incremental_gold}, gate=False)
    for name in SILVER:
        assert table(spark, tmp_path, "silver", name) == table(spark, whole, "silver", name), name
    for name in GOLD:
        assert table(spark, tmp_path, "gold", name) == table(spark, whole, "gold", name), name


def test_a_run_without_news_changes_nothing(spark, frames, one_shot):
    root, _ = one_shot
    before = {n: table(spark, root, "silver", n) for n in SILVER}
    bronze = sorted(os.walk(f"{root}/bronze"))
    marks = {n: ms.get_watermark(spark, f"{root}/state/watermarks", n) for n in SILVER}
    with pytest.raises(ms.QualityGateError, match="row_count"):  # an empty load is noticed
        run(spark, root, frames, END + timedelta(hours=1))
    summary = run(spark, root, frames, END + timedelta(hours=1), gate=False)
    assert summary.filter("stage in ('extract', 'silver') and rows_read > 0").count() == 0
    assert run(spark, root, frames, END + timedelta(hours=1), whole_checks=True).filter("stage = 'quality'").count() == 2
    assert {n: table(spark, root, "silver", n) for n in SILVER} == before
    assert sorted(os.walk(f"{root}/bronze")) == bronze
    assert {n: ms.get_watermark(spark, f"{root}/state/watermarks", n) for n in SILVER} == marks


def test_a_failure_between_layers_is_made_up_for(spark, frames, one_shot, tmp_path, monkeypatch):
    whole, _ = one_shot

    def broken(*args, **kwargs):
        raise RuntimeError("lost the cluster")

    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "merge_stored", broken)
        with pytest.raises(RuntimeError):
            run(spark, tmp_path, frames, END)
    assert ms.get_watermark(spark, f"{tmp_path}/state/watermarks", "orders") > watermarks.EPOCH
    run(spark, tmp_path, frames, END + timedelta(hours=1))
    for name in SILVER:
        assert table(spark, tmp_path, "silver", name) == table(spark, whole, "silver", name), name


def test_a_failed_write_leaves_the_mark(spark, frames, tmp_path, monkeypatch):
    def broken(*args, **kwargs):
        raise RuntimeError("disk full")

    monkeypatch.setattr(pipeline, "write_bronze", broken)
    with pytest.raises(RuntimeError):
        run(spark, tmp_path, frames, END, tables=["orders"])
    assert ms.get_watermark(spark, f"{tmp_path}/state/watermarks", "orders") == watermarks.EPOCH


def test_the_gate_stops_before_gold_but_after_storing_results(spark, frames, tmp_path):
    bad = dict(frames, orders=frames["orders"].withColumn("status", F.lit("teleported")))
    with pytest.raises(ms.QualityGateError, match="expect_column_values_to_be_in_set"):
        run(spark, tmp_path, bad, END, run_id="r1")
    assert os.path.exists(f"{tmp_path}/quality/table_name=orders/run_id=r1")
    assert not os.path.exists(f"{tmp_path}/gold")


def test_rebuild_from_bronze_equals_the_incremental_table(spark, one_shot):
    root, _ = one_shot
    before = table(spark, root, "silver", "order_items")
    summary = ms.rebuild_table(spark, ms.LakeConfig(str(root)), "order_items", "rebuild")
    assert summary.rows_written == len(before)
    assert table(spark, root, "silver", "order_items") == before


def test_updates_arrive_by_updated_at_and_overlap(spark, tmp_path):
    """Extraction by another timestamp sees later changes; an overlap re-reads late commits."""
    t = START + timedelta(hours=5)
    schema = SOURCE_SCHEMAS["orders"]

    def orders(*rows):
        full = [(i, 1, status, None, None, Decimal("1.00"), None, t, updated) for i, status, updated in rows]
        return spark.createDataFrame(full, schema)

    lake = ms.LakeConfig(str(tmp_path), ts_columns={"orders": "updated_at"}, overlap=timedelta(minutes=10))

    def go(df, run_ts):
        ms.run_pipeline(spark, lake, {"orders": ms.dataframe_source(df, "updated_at")}, run_ts, gate=False)
        return sorted((r.id, r.status) for r in spark.read.parquet(lake.path("silver", "orders")).collect())

    later = t + timedelta(days=1)
    assert go(orders((1, "confirmed", t)), t + timedelta(hours=1)) == [(1, "confirmed")]
    late = orders((1, "shipped", later), (2, "confirmed", t - timedelta(minutes=5)))
    assert go(late, later + timedelta(hours=1)) == [(1, "shipped"), (2, "confirmed")]


def test_malformed_keys_are_kept_aside(spark, tmp_path):
    lake = ms.LakeConfig(str(tmp_path))
    rows = spark.createDataFrame(
        [("1", "1", "2", "3", "4.00", START), ("oops", "1", "2", "3", "4.00", START), ("5000000000", "1", "2", "3", "4.00", START)],
        "id string, order_id string, product_id string, quantity string, unit_price string, created_at timestamp")
    sources = {"order_items": ms.dataframe_source(rows)}
    summary = ms.run_pipeline(spark, lake, sources, END, run_id="r1").filter("stage = 'silver'").first()
    assert (summary.rows_read, summary.rows_written, summary.rows_rejected, summary.duplicates_removed) == (3, 1, 2, 0)
    assert spark.read.parquet(f"{tmp_path}/rejects/order_items").count() == 2
    wide = ms.LakeConfig(str(tmp_path / "wide"), wide_keys=True)
    summary = ms.run_pipeline(spark, wide, sources, END, run_id="r1").filter("stage = 'silver'").first()
    assert (summary.rows_written, summary.rows_rejected) == (2, 1)


def test_daily_marts_follow_changed_days_only(spark, tmp_path, monkeypatch):
    """Late payments, orders that move to another day, and a failure before Gold."""
    day = [START + timedelta(days=n, hours=1) for n in range(4)]
    lake = ms.LakeConfig(str(tmp_path), ts_columns={"orders": "updated_at"}, incremental_gold=True)
    spec = {t: SOURCE_SCHEMAS[TABLES[t].source] for t in ("orders", "payments", "page_views")}

    def go(hours, orders=(), payments=(), views=()):
        frames = {
            "orders": [(i, 1, "confirmed", None, None, Decimal("5.00"), None, created, updated) for i, created, updated in orders],
            "payments": [(i, o, Decimal("5.00"), "card", "completed", None, at) for i, o, at in payments],
            "page_views": [(i, None, f"s{i}", "/cart", None, 1, at) for i, at in views],
        }
        sources = {t: ms.dataframe_source(spark.createDataFrame(rows, spec[t]), lake.ts_columns.get(t, "created_at"))
                   for t, rows in frames.items()}
        return ms.run_pipeline(spark, lake, sources, START + timedelta(hours=hours), gate=False)

    def state():
        silver = {t: pipeline.read_silver(spark, lake, t) for t in TABLES}
        full = pipeline.gold_marts(silver)
        for mart in ("daily_sales", "funnel_analysis"):
            stored = spark.read.schema(full[mart].schema).parquet(lake.path("gold", mart))
            assert sorted(map(str, stored.collect())) == sorted(map(str, full[mart].collect())), mart
        sales = spark.read.parquet(lake.path("gold", "daily_sales"))
        return sorted((str(r.sale_date), r.total_orders, r.completed_payments) for r in sales.collect())

    def files(name):
        return sorted(os.listdir(lake.path("gold", "daily_sales") + f"/year=2024/month=01/day={name}"))

    go(100, orders=[(1, day[0], day[0]), (2, day[1], day[1])], payments=[(1, 1, day[0])], views=[(1, day[0]), (2, day[1])])
    assert state() == [("2024-01-01", 1, 1), ("2024-01-02", 1, 0)]
    first = files("01")
    later = START + timedelta(hours=101)
    # A payment two days after its order changes the order's day, not its own.
    go(102, orders=[(3, day[3], later)], payments=[(2, 2, later)])
    assert state() == [("2024-01-01", 1, 1), ("2024-01-02", 1, 1), ("2024-01-04", 1, 0)]
    assert files("01") == first
    # The only order of a day moves to another one: the day disappears.
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "replace_partitions", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            go(104, orders=[(2, day[3], START + timedelta(hours=103))])
    go(105)
    assert state() == [("2024-01-01", 1, 1), ("2024-01-04", 2, 1)]
    summary = go(106)
    assert summary.filter("table_name in ('daily_sales', 'funnel_analysis')").agg({"rows_written": "sum"}).first()[0] == 0
    # A rebuild rewrites every day, and the marts follow it.
    ms.rebuild_table(spark, lake, "orders", "rebuild")
    summary = go(107)
    assert state() == [("2024-01-01", 1, 1), ("2024-01-04", 2, 1)]
    assert summary.filter("table_name = 'daily_sales'").first().rows_written == 2
