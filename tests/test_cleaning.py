from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone import add_date_parts, blank_to_null, drop_pii, incremental_window, normalise, safe_cast
from marlstone.functions import measures
from marlstone.plans.silver import silver, silver_rejects
from marlstone.schemas import TABLES


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_malformed_values_become_null(spark):
    df = spark.createDataFrame([("7", "12.345", "2024-01-02 03:04:05.678901"), ("x", "1,5", "soon"), (None, "", " ")],
                               "id string, price string, created_at string")
    schema = T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("created_at", T.TimestampType()),
    ])
    typed = safe_cast(df, schema)
    assert [f.dataType for f in typed.schema.fields] == [f.dataType for f in schema.fields]
    text = typed.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    assert rows(text) == [(7, Decimal("12.35"), "2024-01-02 03:04:05.678901"), (None, None, None), (None, None, None)]


def test_too_large_for_the_type_becomes_null(spark):
    df = spark.createDataFrame([("3000000000",)], "id string")
    narrow = T.StructType([T.StructField("id", T.IntegerType())])
    wide = T.StructType([T.StructField("id", T.LongType())])
    assert rows(safe_cast(df, narrow)) == [(None,)]
    assert rows(safe_cast(df, wide)) == [(3000000000,)]


def test_blanks_become_null_and_other_text_is_untouched(spark):
    df = spark.createDataFrame([(" a ", "", 1), ("   ", None, 2)], "x string, y string, n int")
    assert rows(blank_to_null(df)) == [(" a ", None, 1), (None, None, 2)]
    assert rows(blank_to_null(df, ["x"], trim=True)) == [("a", "", 1), (None, None, 2)]


def test_normalise_and_drop(spark):
    df = spark.createDataFrame([(" Ab ", " Cd ", "secret")], "email string, name string, password_hash string")
    clean = drop_pii(normalise(df, lower=["email"], trim=["email", "name"]), ["password_hash", "absent"])
    assert rows(clean) == [("ab", "Cd")]


def test_date_parts(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 5, 23, 59),), (None,)], "created_at timestamp_ntz")
    assert rows(add_date_parts(df, "created_at").drop("created_at")) == [(2024, 3, 5), (None, None, None)]
    text = add_date_parts(df, "created_at", as_string=True).drop("created_at")
    assert rows(text) == [("2024", "03", "05"), (None, None, None)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_window_is_open_below_and_closed_above(spark, kind):
    stamps = ["2024-01-01 00:00:00", "2024-01-01 00:00:00.000001", "2024-01-02 00:00:00", "2024-01-02 00:00:00.000001", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "id int, s string")
    df = df.withColumn("ts", F.col("s").cast(kind))
    kept = incremental_window(df, "ts", "2024-01-01", "2024-01-02T01:00:00+01:00")
    assert [r.id for r in kept.orderBy("id").collect()] == [1, 2]


def test_window_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.timestamp_seconds("id").alias("ts")).write.parquet(path)
    plan = incremental_window(spark.read.parquet(path), "ts", "1970-01-01 00:00:03", "1970-01-01 00:00:07")
    assert plan.count() == 4
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in text and "LessThanOrEqual(ts" in text


def test_tax_rounds_half_to_even(spark):
    df = spark.createDataFrame([(Decimal("1.25"),), (Decimal("1.35"),), (Decimal("1.26"),)], "amount decimal(18,2)")
    tax = df.select(measures.sales_tax(F.col("amount"), "0.10"))
    assert rows(tax) == [(Decimal("0.12"),), (Decimal("0.14"),), (Decimal("0.13"),)]


def test_ratio_and_days(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 2)], "a int, b int")
    assert rows(df.select(measures.safe_ratio(F.col("a"), F.col("b")))) == [(0.25,), (None,), (None,)]
    dates = spark.createDataFrame([(date(2024, 3, 1), date(2024, 2, 28)), (None, date(2024, 1, 1))], "x date, y date")
    assert rows(dates.select(measures.days_between(F.col("x"), F.col("y")))) == [(2,), (0,)]


def test_page_paths(spark):
    paths = ["/", "/?category=Home%20Garden", "/?x=1&category=Books", "/products/12", "/products/12?ref=a", "/products/x",
             "/cart", "/orders/3", "/nowhere"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    c = F.col("path")
    found = rows(df.select(measures.page_type(c), measures.page_product(c), measures.page_category(c)))
    assert found == [
        ("home", None, None), ("home", None, "Home%20Garden"), ("home", None, "Books"), ("product", 12, None),
        ("product", 12, None), ("product", None, None), ("cart", None, None), ("order", None, None), ("other", None, None),
    ]


def test_silver_is_independent_of_ansi_mode(spark):
    raw = spark.createDataFrame(
        [("1", "9", " PAID ", "x", "1.00", "2.00", "  ", "2024-01-01", "bad date")],
        "id string, user_id string, status string, subtotal string, tax string, total string, "
        "shipping_address string, created_at string, updated_at string",
    )
    results = []
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        results.append(rows(silver(raw, TABLES["orders"]).drop("created_at")))
    spark.conf.set("spark.sql.ansi.enabled", "true")
    expected = (1, 9, "paid", None, Decimal("1.00"), Decimal("2.00"), None, None, 2024, 1, 1)
    assert results == [[expected], [expected]]


def test_null_created_at_goes_to_the_null_partition(spark):
    raw = spark.createDataFrame([("1", "2", "3", "4", "5.00", "never")],
                                "id string, order_id string, product_id string, quantity string, unit_price string, "
                                "created_at string")
    row = silver(raw, TABLES["order_items"]).first()
    assert (row.id, row.created_at, row.year, row.month, row.day) == (1, None, None, None, None)


def test_rejects_carry_a_reason_and_never_reach_silver(spark):
    raw = spark.createDataFrame([("a1", "e", "n", "p", "2024-01-01", None), ("2", "e", "n", "p", "2024-01-01", None)],
                                "id string, email string, name string, password_hash string, created_at string, "
                                "updated_at string")
    assert [r.id for r in silver(raw, TABLES["customers"]).collect()] == [2]
    rejected = silver_rejects(raw, TABLES["customers"]).collect()
    assert [(r.id, r.reject_reason) for r in rejected] == [(None, "missing or malformed key: id")]
    assert "password_hash" not in silver_rejects(raw, TABLES["customers"]).columns
