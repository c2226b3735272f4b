"""Declarative data-quality suites, evaluated where the data is.

A suite is a list of expectations in the widely used JSON form (an
``expectation_type`` plus ``kwargs``). All value checks of a suite share one
aggregate over one scan, uniqueness checks included.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.operators.joins import missing_references
from marlstone.schemas import FOREIGN_KEYS, ORDER_STATUSES, PAYMENT_METHODS, PAYMENT_STATUSES

# Expectation names of the public suite format.
EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
UNIQUE = "expect_column_values_to_be_unique"
ROW_COUNT = "expect_table_row_count_to_be_between"
# End of fixed values.

_ARGUMENTS = {
    EXISTS: {"column"},
    NOT_NULL: {"column"},
    IN_SET: {"column", "value_set"},
    BETWEEN: {"column", "min_value", "max_value"},
    UNIQUE: {"column"},
    ROW_COUNT: {"min_value", "max_value"},
}

RESULT_COLUMNS = [
    "position", "expectation_type", "column_name", "success",
    "element_count", "unexpected_count", "unexpected_percent", "missing_count", "missing_percent", "arguments",
]


class QualityGateError(Exception):
    """At least one expectation of a suite failed."""


@dataclass(frozen=True)
class Expectation:
    kind: str
    kwargs: dict = field(default_factory=dict)

    def __post_init__(self):
        allowed = _ARGUMENTS.get(self.kind)
        if allowed is None:
            raise ValueError(f"unsupported expectation: {self.kind}")
        unknown = set(self.kwargs) - allowed
        if unknown:
            raise ValueError(f"unsupported arguments for {self.kind}: {sorted(unknown)}")

    @property
    def column(self) -> str | None:
        return self.kwargs.get("column")


def _suite(exist=(), not_null=(), in_set=(), non_negative=(), unique=(), min_rows=None) -> list[Expectation]:
    suite = [Expectation(EXISTS, {"column": c}) for c in exist]
    suite += [Expectation(NOT_NULL, {"column": c}) for c in not_null]
    suite += [Expectation(IN_SET, {"column": c, "value_set": list(v)}) for c, v in in_set]
    suite += [Expectation(BETWEEN, {"column": c, "min_value": 0, "max_value": None}) for c in non_negative]
    suite += [Expectation(UNIQUE, {"column": c}) for c in unique]
    if min_rows is not None:
        suite.append(Expectation(ROW_COUNT, {"min_value": min_rows, "max_value": None}))
    return suite


# The built-in suites, checks in their order.
SUITES = {
    "orders": _suite(
        exist=("id", "user_id", "status", "subtotal", "tax", "total", "created_at"),
        not_null=("id", "user_id", "status", "total", "created_at"),
        in_set=(("status", ORDER_STATUSES),),
        non_negative=("total",),
        unique=("id",),
        min_rows=1,
    ),
    "payments": _suite(
        exist=("id", "order_id", "amount", "method", "status", "created_at"),
        not_null=("id", "order_id", "amount", "status"),
        in_set=(("status", PAYMENT_STATUSES), ("method", PAYMENT_METHODS)),
        non_negative=("amount",),
        unique=("id",),
    ),
}
# End of fixed values.


#: Constraints the source database enforces but files do not; reported, not part of the suites.
UNIQUE_COLUMNS = {"customers": ("email",), "payments": ("order_id",)}


def load_suite(path: str) -> list[Expectation]:
    """Read a suite file: configuration of a few dozen entries."""
    with open(path, encoding="utf-8") as handle:
        document = json.load(handle)
    return [Expectation(e["expectation_type"], dict(e.get("kwargs", {}))) for e in document["expectations"]]


def _within(value: Column, low, high) -> Column:
    inside = F.lit(True)
    if low is not None:
        inside = inside & (value >= F.lit(low))
    if high is not None:
        inside = inside & (value <= F.lit(high))
    return inside


def _violation(expectation: Expectation) -> Column:
    """Condition that is true for a value the expectation rejects."""
    value = F.col(expectation.column)
    if expectation.kind == NOT_NULL:
        return value.isNull()
    if expectation.kind == IN_SET:
        return value.isNotNull() & ~value.isin(*expectation.kwargs["value_set"])
    return value.isNotNull() & ~_within(
        value, expectation.kwargs.get("min_value"), expectation.kwargs.get("max_value")
    )


def _result(position, expectation, success, elements=None, unexpected=None, checked=None, filled=None) -> Column:
    """One result row. The percentage is of the values checked, as the format defines it; ``filled`` counts values."""
    missing = F.lit(None).cast("bigint") if filled is None else elements - filled
    unexpected = F.lit(None).cast("bigint") if unexpected is None else unexpected
    elements = F.lit(None).cast("bigint") if elements is None else elements
    percent = F.lit(None).cast("double")
    if checked is not None:
        percent = unexpected.cast("double") * 100 / F.nullif(checked.cast("double"), F.lit(0.0))
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(expectation.kind).alias("expectation_type"),
        F.lit(expectation.column).cast("string").alias("column_name"),
        success.alias("success"),
        elements.alias("element_count"),
        unexpected.alias("unexpected_count"),
        percent.alias("unexpected_percent"),
        missing.alias("missing_count"),
        (missing.cast("double") * 100 / F.nullif(elements.cast("double"), F.lit(0.0))).alias("missing_percent"),
        F.lit(json.dumps(expectation.kwargs, sort_keys=True)).alias("arguments"),
    )


def evaluate(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """One result row per expectation, in suite order by ``position``.

    NULLs are judged only by the not-null check. Every row of a group of equal
    values counts against uniqueness. A check of an absent column fails without
    counts.

    The table is scanned once, whatever the suite. Each row's verdicts are the bits of a mask;
    masks, and the values of columns that have to be unique, are counted together
    by one aggregate, in which every task first counts its own.
    """
    if not suite:
        raise ValueError("empty suite")
    flags: dict[str, Column] = {}
    unique: list[str] = []
    rows = []
    for position, expectation in enumerate(suite, start=1):
        kind, column = expectation.kind, expectation.column
        if kind == EXISTS or (column is not None and column not in df.columns):
            success = F.lit(kind == EXISTS and column in df.columns)
            rows.append(_result(position, expectation, success))
        elif kind == ROW_COUNT:
            inside = _within(F.col("n"), expectation.kwargs.get("min_value"), expectation.kwargs.get("max_value"))
            rows.append(_result(position, expectation, inside, F.col("n")))
        elif kind == UNIQUE:
            if column not in unique:
                unique.append(column)
            k = unique.index(column)
            bad, filled = F.col(f"repeated_{k}"), F.col(f"values_{k}")
            rows.append(_result(position, expectation, bad == 0, F.col("n"), bad, filled, filled))
        else:
            flags[f"bad_{position}"] = _violation(expectation)
            flags[f"filled_{column}"] = F.col(column).isNotNull()
            filled = F.col(f"filled_{column}")
            checked = F.col("n") if kind == NOT_NULL else filled
            bad = F.col(f"bad_{position}")
            rows.append(_result(position, expectation, bad == 0, F.col("n"), bad, checked, filled))
    return _counted(df, flags, unique).select(F.inline(F.array(*rows))).select(*RESULT_COLUMNS)


#: verdicts per mask column
_BITS = 62


def _counted(df: DataFrame, flags: Mapping[str, Column], unique: Sequence[str]) -> DataFrame:
    """One row: the number of rows, ``n``, of those with each flag, and per unique column its values and repeated ones."""
    if not unique:
        return df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(flag).alias(name) for name, flag in flags.items()])
    names = list(flags)
    masks = [
        reduce(lambda x, y: x.bitwiseOR(y), [F.when(flags[name], F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, name in enumerate(part)])
        for part in (names[k : k + _BITS] for k in range(0, len(names), _BITS))
    ]
    none = [F.lit(None).cast(df.schema[column].dataType) for column in unique]

    def entry(check: int, masks: Sequence[Column], values: Sequence[Column]) -> Column:
        return F.struct(
            F.lit(check).alias("check"), *[mask.alias(f"mask_{k}") for k, mask in enumerate(masks)],
            *[value.alias(f"value_{k}") for k, value in enumerate(values)],
        )

    # The row's verdicts, and one entry per unique column with only its value filled.
    entries = [entry(-1, masks, none)]
    entries += [entry(k, [F.lit(0).cast("long")] * len(masks), [*none[:k], F.col(c), *none[k + 1 :]]) for k, c in enumerate(unique)]
    stacked = df.select(F.inline(F.array(*entries)))
    counts = stacked.groupBy(*stacked.columns).agg(F.count(F.lit(1)).alias("copies"))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("copies"))), F.lit(0))

    verdicts = F.col("check") == -1
    found = [total(verdicts).alias("n")]
    for k, name in enumerate(names):
        found.append(total(verdicts & (F.getbit(F.col(f"mask_{k // _BITS}"), F.lit(k % _BITS)) == 1)).alias(name))
    for k in range(len(unique)):
        filled = (F.col("check") == k) & F.col(f"value_{k}").isNotNull()
        found += [total(filled).alias(f"values_{k}"), total(filled & (F.col("copies") > 1)).alias(f"repeated_{k}")]
    return counts.agg(*found)


def statistics(results: DataFrame) -> DataFrame:
    """One row: expectations evaluated, passed, failed, and the percentage passed."""
    passed, total = F.count_if(F.col("success")), F.count(F.lit(1))
    return results.agg(
        total.alias("evaluated_expectations"),
        passed.alias("successful_expectations"),
        (total - passed).alias("unsuccessful_expectations"),
        (passed.cast("double") * 100 / F.nullif(total.cast("double"), F.lit(0.0))).alias("success_percent"),
    )


def listing(results: DataFrame) -> DataFrame:
    """PASS or FAIL per expectation, table-level checks shown as ``<table>``."""
    return results.select(
        "position",
        F.when(F.col("success"), "PASS").otherwise("FAIL").alias("status"),
        "expectation_type",
        F.coalesce("column_name", F.lit("<table>")).alias("column_name"),
    )


def result_document(results: DataFrame) -> DataFrame:
    """One row: the verdict, the statistics, and every result in suite order. A suite has a few dozen."""
    passed, total = F.count_if(F.col("success")), F.count(F.lit(1))
    return results.agg(
        (passed == total).alias("success"),
        F.struct(
            total.alias("evaluated_expectations"),
            passed.alias("successful_expectations"),
            (total - passed).alias("unsuccessful_expectations"),
            (passed.cast("double") * 100 / F.nullif(total.cast("double"), F.lit(0.0))).alias("success_percent"),
        ).alias("statistics"),
        F.array_sort(F.collect_list(F.struct(*RESULT_COLUMNS))).alias("results"),
    )


def write_results(results: DataFrame, root: str, table: str, run_id: str) -> DataFrame:
    """Store a suite's result document as JSON, one directory per run, and return it as stored."""
    path = f"{root.rstrip('/')}/table_name={table}/run_id={run_id}"
    document = result_document(results)
    document.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return results.sparkSession.read.schema(document.schema).json(path)


def enforce(results: DataFrame, table: str = "table") -> None:
    """Raise ``QualityGateError`` naming every failed expectation."""
    failed = listing(results).filter("status = 'FAIL'").orderBy("position").collect()
    if failed:
        names = "; ".join(f"{r.expectation_type}({r.column_name})" for r in failed)
        raise QualityGateError(f"{table}: {len(failed)} expectation(s) failed: {names}")


def constraints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Violations of the source's UNIQUE and foreign-key constraints, one row per constraint.

    Constraints of tables not given are left out.
    """
    found = references(tables, [(t, c) for t, columns in UNIQUE_COLUMNS.items() for c in columns])
    return found.select("kind", "column_name", "violating_rows")


def references(tables: Mapping[str, DataFrame], unique: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Rows, and distinct values, that violate each foreign key and UNIQUE constraint of ``tables``.

    Every table is scanned once and gives all its keys, references and unique values, each
    labelled with the set of values it belongs to. One aggregate per value then tells whether a
    parent has it and how often each constraint's rows name it: no join, and one shuffle, before
    which every task has counted its own. NULLs violate nothing.
    """
    # Sets of values: the ids of each parent, and each unique column. Constraints of one set take its slots in turn.
    wanted = [("unique", t, c, f"{t}.{c}") for t, c in unique if t in tables]
    wanted += [("foreign key", t, c, parent) for t, c, parent in FOREIGN_KEYS if t in tables and parent in tables]
    if not wanted:
        raise ValueError("no constraint concerns these tables")
    members: dict[str, list[tuple[str, str]]] = {}
    for _, table, column, values in wanted:
        members.setdefault(values, []).append((table, column))
    parents = {parent for kind, _, _, parent in wanted if kind == "foreign key"}
    width = max(map(len, members.values()))
    entries: dict[str, list[Column]] = {}
    for number, (values, columns) in enumerate(members.items()):
        places = [*columns, *([(values, "id")] if values in parents else [])]
        whole = all(tables[t].schema[c].dataType.typeName() in ("byte", "short", "integer", "long") for t, c in places)
        for slot, (table, column) in enumerate(places):
            value = F.col(column)
            entries.setdefault(table, []).append(F.struct(
                F.lit(number).alias("set"),
                (value.cast("long") if whole else F.lit(None).cast("long")).alias("number"),
                (F.lit(None).cast("string") if whole else value.cast("string")).alias("text"),
                F.lit(slot if slot < len(columns) else -1).alias("slot"),
            ))
    stacked = reduce(DataFrame.unionByName, [tables[t].select(F.inline(F.array(*each))) for t, each in entries.items()])
    per_value = stacked.filter(F.col("number").isNotNull() | F.col("text").isNotNull()).groupBy("set", "number", "text").agg(
        F.max(F.col("slot") == -1).alias("exists"), *[F.count_if(F.col("slot") == k).alias(f"rows_{k}") for k in range(width)]
    )
    results = []
    for kind, table, column, values in wanted:
        rows = F.col(f"rows_{members[values].index((table, column))}")
        bad = (rows > 1) if kind == "unique" else (~F.col("exists") & (rows > 0))
        bad = (F.col("set") == list(members).index(values)) & bad
        results.append((kind, f"{table}.{column}", F.coalesce(F.sum(F.when(bad, rows)), F.lit(0)), F.count_if(bad)))
    totals = per_value.agg(*[c.alias(f"{what}_{k}") for k, (_, _, *both) in enumerate(results) for what, c in zip(("rows", "values"), both)])
    return totals.select(F.inline(F.array(*[
        F.struct(
            F.lit(kind).alias("kind"), F.lit(name).alias("column_name"),
            F.col(f"rows_{k}").alias("violating_rows"), F.col(f"values_{k}").alias("violating_values"),
        )
        for k, (kind, name, _, _) in enumerate(results)
    ])))


def foreign_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str = "id") -> DataFrame:
    """One row: how many child rows, and distinct values, point at no parent."""
    missing = missing_references(child, column, parent, parent_column)
    return missing.agg(
        F.coalesce(F.sum("child_rows"), F.lit(0)).alias("orphan_rows"),
        F.count(F.lit(1)).alias("orphan_values"),
    )
