from marlstone import audit_key_uniqueness, dedup_exact, dedup_latest, duplicate_report


def test_latest_ranks_null_last_and_breaks_ties_by_content(spark):
    df = spark.createDataFrame(
        [(1, None, "old"), (1, 5, "b"), (1, 5, "c"), (1, 4, "z"), (2, None, "x"), (2, None, None)],
        "id int, updated_at int, name string",
    )
    kept = sorted(tuple(r) for r in dedup_latest(df, ["id"], ["updated_at"]).collect())
    assert kept == [(1, 5, "c"), (2, None, "x")]
    again = sorted(tuple(r) for r in dedup_latest(df.orderBy("name"), ["id"], ["updated_at"]).collect())
    assert again == kept


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 10_000, 1, 8).selectExpr("cast(id % 3 as int) as key", "id as version")
    kept = dedup_latest(df, ["key"], ["version"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    partial, final = plan.index("Partial"), plan.index("Final")
    exchange = plan.index("Exchange hashpartitioning")
    assert final < exchange < partial  # printed top-down: the limit runs on both sides of the shuffle
    assert sorted(r.version for r in kept.collect()) == [9997, 9998, 9999]


def test_exact_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "id int, name string")
    assert dedup_exact(df).count() == 2


def test_reports(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id int")
    assert tuple(duplicate_report(df, ["id"]).first()) == (5, 3, 2)
    assert tuple(audit_key_uniqueness(df, ["id"]).first()) == (5, 3, False)
    assert tuple(duplicate_report(df.limit(0), ["id"]).first()) == (0, 0, 0)
