"""Relational extraction against an embedded in-memory database (no server, no port)."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import marlstone as ms
from marlstone.sources import jdbc

URL = "jdbc:derby:memory:shop"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def orders(spark):
    df = spark.range(1, 101).select(
        F.col("id").cast("int").alias("id"),
        F.lit("confirmed").alias("status"),
        (F.lit(START) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("created_at"),
    )
    options = {"createTableColumnTypes": "status VARCHAR(50)"}
    df.write.format("jdbc").options(url=f"{URL};create=true", dbtable="orders", **options).mode("overwrite").save()
    return "orders"


def test_window_is_pushed_to_the_database(spark, orders):
    window = (START + timedelta(hours=10), START + timedelta(hours=20))
    with pytest.raises(ValueError):
        ms.read_jdbc(spark, URL, orders, "created_at", *window)
    assert ms.read_jdbc(spark, URL, orders, "created_at", *window, partition_column="id").rdd.getNumPartitions() > 1
    df = ms.read_jdbc(spark, URL, orders, "created_at", *window, num_partitions=1)
    assert df.columns == ["id", "status", "created_at"]
    assert sorted(r.id for r in df.collect()) == list(range(11, 21))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(created_a" in plan and "*LessThanOrEqual(created" in plan


def test_parallel_read_covers_the_window_once(spark, orders):
    df = ms.read_jdbc(spark, URL, orders, "created_at", START, START + timedelta(hours=60),
                      partition_column="id", num_partitions=4)
    assert df.rdd.getNumPartitions() == 4
    assert sorted(r.id for r in df.collect()) == list(range(1, 61))
    sizes = df.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) <= 16


def test_empty_window(spark, orders):
    df = ms.read_jdbc(spark, URL, orders, "created_at", START + timedelta(days=90), START + timedelta(days=99),
                      partition_column="id", num_partitions=4)
    assert df.isEmpty()


def test_a_lake_is_filled_from_the_database(spark, orders, tmp_path):
    lake = ms.LakeConfig(str(tmp_path))
    source = {"orders": ms.jdbc_source(spark, URL, orders, partition_column="id", num_partitions=2)}
    wanted = ["id", "status", "created_at"]
    for hours in (30, 100):
        rows = ms.plans.pipeline.extract_table(
            spark, lake, "orders", source["orders"], START + timedelta(hours=hours), f"r{hours}")
        assert rows.rows_written == {30: 30, 100: 70}[hours]
    back = ms.read_bronze(spark, lake.path("bronze", "orders"), wanted)
    assert sorted(int(r.id) for r in back.collect()) == list(range(1, 101))
    assert ms.get_watermark(spark, lake.watermarks, "orders") == START + timedelta(hours=100)


@pytest.fixture(scope="module")
def gapped(spark):
    """Ids as a shop that once restarted its sequence far away would have them, and text codes."""
    ids = spark.range(1, 401).select(F.when(F.col("id") <= 20, F.col("id")).otherwise(F.col("id") + 2_000_000_000).cast("int").alias("id"))
    df = ids.select(
        "id", F.concat(F.lit("c"), F.col("id").cast("string")).alias("code"), F.lit(START + timedelta(hours=1)).alias("created_at"))
    options = {"createTableColumnTypes": "code VARCHAR(50)"}
    df.write.format("jdbc").options(url=f"{URL};create=true", dbtable="gapped", **options).mode("overwrite").save()
    return "gapped"


def _sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_gaps_in_the_key_do_not_leave_the_rows_to_one_reader(spark, gapped):
    window = (START, START + timedelta(hours=2))
    df = ms.read_jdbc(spark, URL, gapped, "created_at", *window, partition_column="id", num_partitions=4)
    assert df.rdd.getNumPartitions() == 4 and max(_sizes(df)) <= 200 and df.count() == 400
    assert sorted(r.id for r in df.collect()) == [k if k <= 20 else k + 2_000_000_000 for k in range(1, 401)]
    strided = spark.read.jdbc(URL, gapped, column="ID", lowerBound=1, upperBound=2_000_000_400, numPartitions=4)
    assert max(_sizes(strided)) == 380  # what equal strides would do


def test_text_keys_are_shared_by_a_hash(spark, gapped):
    window = (START, START + timedelta(hours=2))
    code = 'CAST(SUBSTR("code", 2) AS INTEGER) - 200'  # negative for some, as hashes are
    df = ms.read_jdbc(spark, URL, gapped, "created_at", *window, num_partitions=4, hash_expression=code)
    assert df.rdd.getNumPartitions() == 4 and max(_sizes(df)) <= 200 and df.select("code").distinct().count() == df.count() == 400
    assert df.filter("id = 7").count() == 1


def test_quantile_bounds():
    def bounds(keys, n):
        asked = []

        def count(ranges):
            asked.append(ranges)
            found = {}
            for part, (first, last) in enumerate(ranges):
                for key in keys:
                    if first <= key <= last:
                        place = part, (key - first) // jdbc._stride(first, last)
                        found[place] = found.get(place, 0) + 1
            return [(*place, rows) for place, rows in found.items()]

        cuts = jdbc.quantile_bounds(count, min(keys), max(keys), len(keys), n)
        edges = [float("-inf"), *cuts, float("inf")]
        sizes = [sum(low <= key < high for key in keys) for low, high in zip(edges, edges[1:])]
        assert sum(sizes) == len(keys) and len(asked) < 13 and all(len(ranges) <= 2 * n for ranges in asked)
        return sizes

    clustered = [*range(100), *range(10**15, 10**15 + 500), 2**62]
    for n in (2, 5, 16):
        assert max(bounds(clustered, n)) <= 1.5 * len(clustered) / n + 1
    assert bounds([5] * 30 + [6], 4) == [30, 1]
    assert bounds([7], 4) == [1]
