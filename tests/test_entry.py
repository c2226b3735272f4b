"""The query registry without the corpus operators, and a stored order detail."""

import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import marlstone as ms
from marlstone.fixtures import view
from marlstone.operators.shop import store_order_parts, stored_order_detail

ROOT = os.path.dirname(os.path.abspath(contract.__file__))
SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("also", [(), ("corpus_pipeline.py",)])
def test_queries_without_the_corpus_operators(tmp_path, also):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", "tests", *also))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(q.startswith('op') and q[2].isdigit() for q in e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == [str(len(contract._QUERIES)), str(len(contract._ORACLES)), "False"]


def test_stored_order_detail_shuffles_nothing(spark, tmp_path):
    tables = [view(spark, SF_DIR, f"fx_{name}") for name in ("orders", "order_items", "products", "payments")]
    store_order_parts(*tables, "detail_test", str(tmp_path / "detail"), buckets=4)
    detail = stored_order_detail(spark, "detail_test")
    rows = detail.collect()
    plan = detail._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") >= 2 and "Bucketed: true" in plan
    expected = ms.order_detail(*tables)
    assert sorted(map(str, rows)) == sorted(map(str, expected.select(*detail.columns).collect()))
    for table in ("heads", "lines", "paid"):
        spark.sql(f"DROP TABLE detail_test_{table}")


def test_buckets_of_stored_order_detail_grow_with_the_tables(spark, tmp_path, monkeypatch):
    tables = [view(spark, SF_DIR, f"fx_{name}") for name in ("orders", "order_items", "products", "payments")]
    rows = tables[1].count()
    monkeypatch.setattr("marlstone.operators.shop.ROWS_PER_BUCKET", rows // 6, raising=False)
    store_order_parts(*tables, "detail_grown", str(tmp_path / "detail"), buckets=2)
    detail = stored_order_detail(spark, "detail_grown")
    assert detail.count() == ms.order_detail(*tables).count()
    assert "Exchange" not in detail._jdf.queryExecution().executedPlan().toString()
    per_bucket = [r["count"] for r in spark.table("detail_grown_lines").groupBy(F.input_file_name()).count().collect()]
    assert len(per_bucket) >= 6 and max(per_bucket) < rows / 3
    for table in ("heads", "lines", "paid"):
        spark.sql(f"DROP TABLE detail_grown_{table}")


def test_shuffle_partitions_of_a_query_follow_its_inputs(spark, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    size = sum(os.path.getsize(f"{SF_DIR}/orders.parquet") for _ in range(2))  # delivered twice
    monkeypatch.setattr("marlstone.session.BYTES_PER_SHUFFLE_TASK", size // 9)
    try:
        assert contract.queries()["silver_orders"](spark, SF_DIR).count() > 0
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) >= 9
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32m"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
