import random

from marlstone.operators.joins import left_join, missing_references


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_left_join_halves_equal_the_outer_join(spark):
    rng = random.Random(7)
    # A third of the right side sits on one key; NULL keys on both sides.
    left = [(rng.choice([None, *range(40)]), i) for i in range(200)]
    right = [(3 if i % 3 == 0 else rng.choice([None, *range(30)]), f"r{i}") for i in range(150)]
    left = spark.createDataFrame(left, "k int, a int")
    right = spark.createDataFrame(right, "k int, b string")
    expected = left.join(right, "k", "left")
    assert _sorted(left_join(left, right, ["k"])) == _sorted(expected)
    assert left_join(left, right, ["k"]).columns == expected.columns
    assert _sorted(left_join(left, right.limit(0), ["k"])) == _sorted(left.selectExpr("k", "a", "null as b"))


def test_missing_references(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "ref int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert _sorted(missing_references(child, "ref", parent)) == [(9, 2)]
