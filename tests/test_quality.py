import json
from decimal import Decimal

import pytest

import marlstone as ms
from marlstone.operators import quality as q


@pytest.fixture
def payments(spark):
    return spark.createDataFrame(
        [(1, 1, Decimal("5.00"), "card", "completed"), (1, 2, Decimal("-1.00"), "cash", "lost"),
         (None, None, None, None, None), (3, 4, Decimal("0.00"), "upi", "failed")],
        "id int, order_id int, amount decimal(10,2), method string, status string",
    )


def test_each_kind_of_failure(spark, payments):
    results = {(r.expectation_type, r.column_name): r for r in ms.evaluate(payments, ms.SUITES["payments"]).collect()}
    assert len(results) == 14

    def outcome(kind, column):
        r = results[kind, column]
        return r.success, r.element_count, r.unexpected_count, r.unexpected_percent

    assert outcome(q.EXISTS, "created_at") == (False, None, None, None)
    assert outcome(q.EXISTS, "id") == (True, None, None, None)
    assert outcome(q.NOT_NULL, "id") == (False, 4, 1, 25.0)
    assert outcome(q.IN_SET, "method") == (False, 4, 1, 100 / 3)
    assert outcome(q.IN_SET, "status") == (False, 4, 1, 100 / 3)
    assert outcome(q.BETWEEN, "amount") == (False, 4, 1, 100 / 3)
    assert outcome(q.UNIQUE, "id") == (False, 4, 2, 200 / 3)


def test_suites_have_the_published_checks():
    assert [len(ms.SUITES[t]) for t in ("orders", "payments")] == [16, 14]
    last = ms.SUITES["orders"][-1]
    assert (last.kind, last.kwargs) == (q.ROW_COUNT, {"min_value": 1, "max_value": None})


def test_empty_table(spark, payments):
    results = ms.evaluate(payments.limit(0), [
        q.Expectation(q.ROW_COUNT, {"min_value": 1}), q.Expectation(q.UNIQUE, {"column": "id"}),
        q.Expectation(q.NOT_NULL, {"column": "id"}),
    ])
    rows = {r.expectation_type: (r.success, r.element_count, r.unexpected_percent) for r in results.collect()}
    assert rows == {q.ROW_COUNT: (False, 0, None), q.UNIQUE: (True, 0, None), q.NOT_NULL: (True, 0, None)}


def test_checks_of_an_absent_column_fail_without_counts(spark, payments):
    row = ms.evaluate(payments, [q.Expectation(q.BETWEEN, {"column": "nope", "min_value": 1})]).first()
    assert (row.success, row.element_count, row.unexpected_count) == (False, None, None)


def test_value_checks_share_one_scan(spark, tmp_path, payments):
    path = str(tmp_path / "t")
    payments.write.parquet(path)
    plan = ms.evaluate(spark.read.parquet(path), ms.SUITES["payments"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 2  # of values and masks, and of the totals


def test_statistics_listing_and_gate(spark, payments):
    suite = [q.Expectation(q.ROW_COUNT, {"min_value": 1}), q.Expectation(q.NOT_NULL, {"column": "id"})]
    results = ms.evaluate(payments, suite)
    assert tuple(ms.statistics(results).first()) == (2, 1, 1, 50.0)
    assert [tuple(r) for r in ms.listing(results).orderBy("position").collect()] == [
        (1, "PASS", q.ROW_COUNT, "<table>"), (2, "FAIL", q.NOT_NULL, "id")]
    with pytest.raises(ms.QualityGateError, match="1 expectation"):
        ms.enforce(results, "payments")
    ms.enforce(results.filter("success"), "payments")


def test_suite_files_and_unsupported_checks(tmp_path):
    path = tmp_path / "suite.json"
    path.write_text(json.dumps({"expectations": [
        {"expectation_type": q.IN_SET, "kwargs": {"column": "s", "value_set": ["a"]}, "meta": {}}]}))
    assert ms.load_suite(str(path)) == [q.Expectation(q.IN_SET, {"column": "s", "value_set": ["a"]})]
    with pytest.raises(ValueError):
        q.Expectation("expect_something_else", {})
    with pytest.raises(ValueError):
        q.Expectation(q.NOT_NULL, {"column": "id", "mostly": 0.9})


def test_results_are_kept_per_run(spark, tmp_path, payments):
    results = ms.evaluate(payments, ms.SUITES["payments"])
    for run_id in ("r1", "r2"):
        q.write_results(results, str(tmp_path), "payments", run_id)
    stored = spark.read.json(str(tmp_path))
    assert stored.count() == 2 and stored.groupBy("table_name", "run_id").count().count() == 2
    document = stored.filter("run_id = 'r1'").first()
    failed = results.filter("not success").count()
    assert document.success == (failed == 0) and document.statistics.unsuccessful_expectations == failed
    assert [r.position for r in document.results] == list(range(1, results.count() + 1))
    expected = {r.position: (r.missing_count, r.arguments) for r in results.collect()}
    assert {r.position: (r.missing_count, r.arguments) for r in document.results} == expected


def test_foreign_keys(spark, payments):
    orders = spark.createDataFrame([(1,), (2,)], "id int")
    assert tuple(ms.foreign_keys(payments, "order_id", orders).first()) == (1, 1)


def test_source_constraints_are_reported(spark, payments):
    orders = spark.createDataFrame([(1, 5), (2, None)], "id int, user_id int")
    found = {(r.kind, r.column_name): r.violating_rows
             for r in q.constraints({"payments": payments, "orders": orders}).collect()}
    assert found == {("unique", "payments.order_id"): 0, ("foreign key", "payments.order_id"): 1}


def _scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_a_suite_is_one_scan_and_one_shuffle_of_values(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(q, "_BITS", 4)
    path = str(tmp_path / "t")
    rows = [(1, "a", 2.5), (1, None, None), (2, "b", 0.0), (None, "b", -0.0), (3, "b", float("nan")), (4, "", float("nan"))]
    spark.createDataFrame(rows, "id int, email string, score double").write.parquet(path)
    df = spark.read.parquet(path)
    suite = [q.Expectation("expect_column_values_to_be_unique", {"column": c}) for c in ("id", "email", "score")]
    suite += [q.Expectation("expect_column_values_to_not_be_null", {"column": c}) for c in ("id", "email")]
    suite += [q.Expectation("expect_column_values_to_be_between", {"column": "id", "min_value": k, "max_value": None}) for k in range(7)]
    suite += [q.Expectation("expect_table_row_count_to_be_between", {"min_value": 6, "max_value": 6})]
    results = ms.evaluate(df, suite)
    got = {r.position: (r.success, r.element_count, r.unexpected_count, r.missing_count) for r in results.collect()}
    assert got[1] == (False, 6, 2, 1) and got[2] == (False, 6, 3, 1) and got[3] == (False, 6, 4, 1)
    assert got[4] == (False, 6, 1, 1) and got[5] == (False, 6, 1, 1) and got[13] == (True, 6, None, None)
    assert [got[6 + k][2] for k in range(7)] == [0, 0, 2, 3, 4, 5, 5]  # several masks
    assert _scans(results) == 1
    empty = {r.position: r.unexpected_count for r in ms.evaluate(df.limit(0), suite).collect()}
    assert empty[1] == 0 and empty[6] == 0
    with pytest.raises(ValueError):
        ms.evaluate(df, [])


def test_references_scan_each_table_once(spark, tmp_path):
    def stored(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    given = {
        "customers": stored("customers", [(1, "a"), (2, "a"), (3, None), (None, "b")], "id int, email string"),
        "orders": stored("orders", [(10, 1), (11, 9), (11, 9), (12, None)], "id int, user_id int"),
        "payments": stored("payments", [(1, 10), (2, 99), (3, 99), (4, None)], "id int, order_id long"),
        "products": stored("products", [("x",)], "id string"),
        "order_items": stored("order_items", [(1, 10, 5), (2, 98, 5)], "id int, order_id int, product_id int"),
    }
    found = q.references(given, [("customers", "email"), ("payments", "order_id"), ("suppliers", "id")])
    got = {(r.kind, r.column_name): (r.violating_rows, r.violating_values) for r in found.collect()}
    assert got == {
        ("unique", "customers.email"): (2, 1), ("unique", "payments.order_id"): (2, 1),
        ("foreign key", "orders.user_id"): (2, 1), ("foreign key", "payments.order_id"): (2, 1),
        ("foreign key", "order_items.order_id"): (1, 1), ("foreign key", "order_items.product_id"): (2, 1),
    }
    assert _scans(found) == 5
    for name in ("orders", "payments"):
        one = ms.foreign_keys(given[name], {"orders": "user_id", "payments": "order_id"}[name], given[{"orders": "customers", "payments": "orders"}[name]])
        assert tuple(one.first()) == got[("foreign key", f"{name}.{'user_id' if name == 'orders' else 'order_id'}")]
    with pytest.raises(ValueError):
        q.references({"products": given["products"]})
