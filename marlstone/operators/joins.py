"""Outer joins that stay balanced when one key holds much of the right side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], right_unique: bool = False) -> DataFrame:
    """``left`` left outer join ``right`` on equally named ``keys``.

    Adaptive execution can split a hot partition on the left of a left outer
    join but not on the right. Unless the right side is known to be unique per
    key, the join is therefore stated as its two exact halves: the matches (an
    inner join, splittable on both sides) and the left rows without any match
    (an anti join against the right side's keys, reduced to distinct first). Both
    halves read the same left rows, those with all keys, so they share one shuffle
    of them; rows with a missing key match nothing and are not shuffled at all.
    """
    keys = list(keys)
    if right_unique:
        return left.join(right, keys, "left")
    keyed = reduce(and_, [F.col(key).isNotNull() for key in keys])
    candidates, partners = left.filter(keyed), right.filter(keyed)
    matched = candidates.join(partners, keys, "inner")
    unmatched = candidates.join(partners.select(*keys).distinct(), keys, "left_anti").unionByName(left.filter(~keyed))
    added = [f for f in right.schema.fields if f.name not in keys]
    unmatched = unmatched.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
    return matched.unionByName(unmatched)


def missing_references(child: DataFrame, column: str, parent: DataFrame, parent_column: str = "id") -> DataFrame:
    """Values of ``child.column`` absent from ``parent``, with the rows that carry each.

    The child is counted per value before the anti join, so a value shared by
    many rows travels once per task. NULL references are not violations.
    """
    references = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("missing_value"))
        .agg(F.count(F.lit(1)).alias("child_rows"))
    )
    # Same partitioning as the join needs, so this distinct adds no shuffle.
    parents = parent.select(F.col(parent_column).alias("missing_value")).distinct()
    return references.join(parents, "missing_value", "left_anti")
