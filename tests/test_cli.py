"""Jobs started by name, one after the other, against an embedded database."""

import pytest

import marlstone as ms
import marlstone.__main__ as cli
from marlstone import QualityGateError
from marlstone.schemas import TABLES
from test_pipeline import END, build_sources

URL = "jdbc:derby:memory:cli"


@pytest.fixture(scope="module")
def database(spark):
    for table, df in build_sources(spark, dirty=False).items():
        df.write.format("jdbc").options(url=f"{URL};create=true", dbtable=table).mode("overwrite").save()
    return URL


def test_jobs_by_name_equal_one_run(spark, database, tmp_path):
    source = ["--jdbc-url", database, "--readers", "2"]

    def job(root, *argv):
        layout = ["--day-directories", "orders"] if root == "steps" else []
        return cli.execute(spark, ["--root", str(tmp_path / root), "--run-ts", END.isoformat(), "--run-id", "r1", *layout, *argv])

    whole = job("whole", "run", *source)
    assert whole.filter("stage = 'silver'").count() == len(TABLES)
    assert job("steps", "extract", *source).filter("rows_written > 0").count() == len(TABLES)
    assert job("steps", "silver").filter("rows_written > 0").count() == len(TABLES)
    levels = {root: sum("day=" in str(p) for p in (tmp_path / root / "silver" / "orders").rglob("*.parquet")) for root in ("whole", "steps")}
    assert levels["whole"] == 0 < levels["steps"]
    assert job("steps", "quality", "orders").first().rows_rejected == 0
    assert job("steps", "gold").count() == 4
    for report in ("daily_revenue", "customer_ltv", "top_products", "funnel_analysis"):
        rows = {root: list(map(tuple, job(root, "report", report, "--as-of", "2024-01-10").collect()))
                for root in ("whole", "steps")}
        assert rows["whole"] and rows["whole"] == rows["steps"], report


def test_a_suite_file_can_replace_the_built_in_suite(spark, database, tmp_path):
    base = ["--root", str(tmp_path / "lake"), "--run-ts", END.isoformat()]
    cli.execute(spark, [*base, "extract", "--jdbc-url", database, "orders"])
    cli.execute(spark, [*base, "silver", "orders"])
    suite = tmp_path / "suite.json"
    suite.write_text('{"expectations": [{"expectation_type": "expect_table_row_count_to_be_between", '
                     '"kwargs": {"min_value": 1000000, "max_value": null}}]}')
    with pytest.raises(QualityGateError):
        cli.execute(spark, [*base, "quality", "orders", "--suite", str(suite)])


def test_extraction_by_update_time_and_reports_by_table_name(spark, database, tmp_path):
    base = ["--root", str(tmp_path / "lake"), "--run-ts", END.isoformat(), "--catalog", "cli_lake", "--incremental-gold",
            "--timestamp-column", "orders=updated_at"]
    cli.execute(spark, [*base, "run", "--jdbc-url", database, "--readers", "2"])
    orders = spark.table("cli_lake.silver_orders")
    mark = ms.get_watermark(spark, ms.LakeConfig(str(tmp_path / "lake")).watermarks, "orders")
    latest = orders.selectExpr("max(unix_micros(cast(updated_at as timestamp)))").first()[0]
    assert mark == ms.sources.watermarks.from_micros(latest)
    by_name = cli.execute(spark, [*base, "report", "top_products"])
    assert by_name.count() > 0 and spark.table("cli_lake.gold_top_products").count() == by_name.count()
    with pytest.raises(SystemExit):
        cli.execute(spark, [*base, "--timestamp-column", "nonsense", "gold"])
    spark.sql("DROP DATABASE cli_lake CASCADE")


def test_unknown_names_are_refused(spark, tmp_path):
    with pytest.raises(SystemExit):
        cli.execute(spark, ["--root", str(tmp_path), "gold", "no_such_mart"])
