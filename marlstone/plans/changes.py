"""Marts that depend on all history, kept up to date from what Silver's merges changed.

With ``LakeConfig.incremental_gold`` every merge keeps its signed changes: rows that went and
rows that appeared. A mart is published from running totals per customer or product, and
these follow the changes: what sums and counts gain or lose is the signed sum of the changed rows. Minima and
maxima cannot lose, so customers who lose their first or last order are looked up again, and they alone.

Totals are stored as versions. A version and the runs it includes are put in force by one
ledger file, so a run's changes are applied once whatever fails. Where the changes of a
pending run are not known for certain (a merge that failed half-way, a rebuilt table, a lake that was
not incremental before), totals are computed anew from Silver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.plans import gold
from marlstone.sinks.tables import (
    SIGN,
    in_partitions,
    overwrite_table,
    partition_values,
    read_partitions,
    replace_partitions,
    within_range,
)
from marlstone.sources import watermarks
from marlstone.storage import path_exists, remove_path, stage, write_text

if TYPE_CHECKING:
    from marlstone.plans.pipeline import LakeConfig

#: Says that the merge whose changes a directory holds has succeeded.
_DONE = "_done"


@dataclass(frozen=True)
class Totals:
    """How a mart follows its tables."""

    key: str
    #: tables whose changes are kept; the mart also holds columns of ``named``, whose id is its key
    facts: tuple[str, ...]
    named: str
    #: totals of whole tables
    whole: Callable[[Mapping[str, DataFrame]], DataFrame]
    #: what changes of tables (and the tables as they are now) add to or take from the totals, per key
    gains: Callable[[Mapping[str, DataFrame], Mapping[str, DataFrame]], DataFrame]
    #: totals with such gains
    added: Callable[[DataFrame, DataFrame, Mapping[str, DataFrame]], DataFrame]
    #: the mart
    publish: Callable[[Mapping[str, DataFrame], DataFrame], DataFrame]


@contextmanager
def recorded(spark: SparkSession, lake: LakeConfig, table: str, run_id: str) -> Iterator[str | None]:
    """Where a merge is to keep its changes, if it is to; they count once the merge has succeeded.

    A second attempt under the same id would compare with a table that the first one may have changed
    in part, so its changes never count.
    """
    if not lake.incremental_gold or not any(table in (*t.facts, t.named) for t in TOTALS.values()):
        yield None
        return
    path = lake.changes(table, run_id)
    again = path_exists(spark, path)
    yield path
    if not again:
        write_text(spark, f"{path}/{_DONE}", "")


def forget(spark: SparkSession, lake: LakeConfig, table: str) -> None:
    """Drop the totals that follow ``table``, which is about to be replaced."""
    for mart, totals in TOTALS.items():
        if table in (*totals.facts, totals.named):
            remove_path(spark, lake.totals(mart, 0).rpartition("/")[0])


def refresh(spark: SparkSession, lake: LakeConfig, mart: str, silver: Callable[[str], DataFrame]) -> int:
    """Bring a mart's totals and then the mart up to date; returns the number of mart rows written."""
    spec = TOTALS[mart]
    tables = [*spec.facts, spec.named]
    version = watermarks.totals_version(spark, lake.totals_runs, mart)
    stored, following = path_exists(spark, lake.totals(mart, version)), lake.totals(mart, version + 1)
    pending = {t: watermarks.pending_changes(spark, lake.touched_days, lake.totals_runs, t, mart) for t in tables}
    path, parts = lake.path("gold", mart), gold.GOLD_PARTITIONS[mart]
    if stored and not any(pending.values()) and path_exists(spark, path):
        return 0
    known = stored and all(path_exists(spark, f"{lake.changes(t, r)}/{_DONE}") for t in tables for r in pending[t])
    # A version that was written but not put in force may have reached the mart.
    clean = known and path_exists(spark, path) and not path_exists(spark, following)
    now = {t: silver(t) for t in tables}
    gains = None
    try:
        if known:
            changed = {t: _changes(spark, lake, t, pending[t], now[t]) for t in tables}
            before = spark.read.parquet(lake.totals(mart, version))
            gains = stage(spec.gains(changed, now), path, "gains")
            gained = spark.read.parquet(gains)
            overwrite_table(spec.added(before, gained, now), following)
        else:
            overwrite_table(spec.whole(now), following)
        df = spec.publish(now, spark.read.parquet(following))
        rewritten = None
        if clean and parts:
            # Rows whose totals or names changed, and the partitions they were and are in.
            ids = gained.select(spec.key).unionByName(changed[spec.named].select(F.col("id").alias(spec.key))).distinct()
            places = [spark.read.schema(df.schema).parquet(path).select(spec.key, *parts), df.select(spec.key, *parts)]
            rewritten = set(partition_values(places[0].unionByName(places[1]).join(ids, spec.key, "left_semi"), parts))
        if rewritten is None:
            overwrite_table(df, path, parts)
            rows = spark.read.schema(df.schema).parquet(path).count()
        elif rewritten:
            replace_partitions(df.filter(in_partitions(rewritten, parts)), path, parts, rewritten)
            rows = read_partitions(spark, path, df.schema, rewritten, parts).count()
        else:
            rows = 0
    finally:
        if gains is not None:
            remove_path(spark, gains)
    watermarks.commit_totals(spark, lake.totals_runs, mart, version + 1, pending)
    remove_path(spark, lake.totals(mart, version))
    for table in tables:
        for run_id in pending[table]:
            remove_path(spark, lake.changes(table, run_id))
    return rows


def _changes(spark: SparkSession, lake: LakeConfig, table: str, runs: set[str], now: DataFrame) -> DataFrame:
    """The signed changes that ``runs`` made to a table."""
    schema = T.StructType([*now.schema.fields, T.StructField(SIGN, T.IntegerType())])
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[lake.changes(table, run_id) for run_id in sorted(runs)])


def _customer_gains(changed: Mapping[str, DataFrame], now: Mapping[str, DataFrame]) -> DataFrame:
    """What customers gain: with o for orders and p(o) for what was paid, before (0) and after (1) the changes,

    sum over o1 of p1 - sum over o0 of p0 = sum over o1 of (p1 - p0) + signed sum over changed orders of p0.

    The first needs the owners of orders whose payments changed, the second the payments of orders that are new or
    have another owner: both are looked up within the range of the changed ids.
    """
    orders = changed["orders"].groupBy("id", "user_id", "created_at").agg(F.sum(SIGN).alias("n")).filter("n != 0")
    amount = F.col("amount") * F.col(SIGN).cast("decimal(2,0)")
    paid = changed["payments"].filter("status = 'completed'").groupBy(F.col("order_id").alias("id")).agg(F.sum(amount).alias("paid_more"))
    paid = paid.filter("paid_more != 0")
    owners = within_range(now["orders"].select("id", "user_id"), "id", paid, "id").join(paid, "id")
    moved = orders.groupBy("id", "user_id").agg(F.sum("n").alias("n")).filter("n != 0")
    known = within_range(now["payments"], "order_id", moved, "id").join(moved.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    zero = F.lit(0).cast("decimal(38,2)")
    earlier = F.coalesce("paid", zero) - F.coalesce("paid_more", zero)
    carried = moved.join(gold.paid_per_order(known), "id", "left").join(paid, "id", "left")
    customer = F.col("user_id").alias("customer_id")
    money = owners.select(customer, F.col("paid_more").cast("decimal(38,2)").alias("revenue")).unionByName(
        carried.select(customer, (F.col("n").cast("decimal(2,0)") * earlier).cast("decimal(38,2)").alias("revenue"))
    )
    came, went = F.when(F.col("n") > 0, F.col("created_at")), F.when(F.col("n") < 0, F.col("created_at"))
    dates = orders.select(customer, F.col("n").alias("orders"), came.alias("came"), went.alias("went"))
    both = money.unionByName(dates, allowMissingColumns=True).filter("customer_id is not null")
    return both.groupBy("customer_id").agg(
        F.coalesce(F.sum("revenue"), zero).alias("more_revenue"), F.coalesce(F.sum("orders"), F.lit(0)).alias("more_orders"),
        F.min("came").alias("first_came"), F.max("came").alias("last_came"),
        F.min("went").alias("first_went"), F.max("went").alias("last_went"),
    )


def _customers_added(before: DataFrame, gains: DataFrame, now: Mapping[str, DataFrame]) -> DataFrame:
    both = before.join(gains, "customer_id", "full")
    lost = F.coalesce(F.col("first_went") <= F.col("first_order_date"), F.lit(False)) | F.coalesce(
        F.col("last_went") >= F.col("last_order_date"), F.lit(False))
    zero = F.lit(0).cast("decimal(38,2)")
    totals = both.select(
        "customer_id",
        F.least("first_order_date", "first_came").alias("first_order_date"),
        F.greatest("last_order_date", "last_came").alias("last_order_date"),
        (F.coalesce("total_orders", F.lit(0)) + F.coalesce("more_orders", F.lit(0))).alias("total_orders"),
        (F.coalesce("revenue", zero) + F.coalesce("more_revenue", zero)).cast("decimal(38,2)").alias("revenue"),
        lost.alias("lost"),
    ).filter("total_orders > 0")
    again = totals.filter("lost").select("customer_id")
    if not again.isEmpty():
        orders = now["orders"].select(F.col("user_id").alias("customer_id"), "created_at")
        dates = orders.join(again, "customer_id", "left_semi").groupBy("customer_id").agg(
            F.min("created_at").alias("first_now"), F.max("created_at").alias("last_now"))
        totals = totals.join(dates, "customer_id", "left").withColumns({
            "first_order_date": F.when(F.col("lost"), F.col("first_now")).otherwise(F.col("first_order_date")),
            "last_order_date": F.when(F.col("lost"), F.col("last_now")).otherwise(F.col("last_order_date")),
        })
    return totals.select(*before.columns)


def _whole_customers(now: Mapping[str, DataFrame]) -> DataFrame:
    totals = gold.customer_totals(now["orders"], now["payments"], unique_orders=True).filter("customer_id is not null")
    return totals.withColumn("revenue", F.col("revenue").cast("decimal(38,2)"))


def _product_gains(changed: Mapping[str, DataFrame], now: Mapping[str, DataFrame]) -> DataFrame:
    """What products gain. An order counts once however many of its lines name the product, so it is a gain if these
    are its first lines there and a loss if they were its last; how many there are now is looked up
    within the range of the changed orders."""
    items = changed["order_items"]
    sums = items.groupBy("product_id").agg(*gold.item_figures(F.col(SIGN)), F.lit(0).cast("long").alias("order_count"))
    pair = ["product_id", "order_id"]
    pairs = items.filter("order_id is not null").groupBy(*pair).agg(F.sum(SIGN).alias("more")).filter("more != 0")
    lines = within_range(now["order_items"].select(*pair), "order_id", pairs, "order_id")
    # Lines without a product are a product of their own, so the join holds NULLs equal.
    theirs, mine = lines.groupBy(*pair).agg(F.count(F.lit(1)).alias("now")).alias("theirs"), pairs.alias("mine")
    same = F.col("mine.product_id").eqNullSafe(F.col("theirs.product_id")) & (F.col("mine.order_id") == F.col("theirs.order_id"))
    present = F.coalesce(F.col("now"), F.lit(0))
    gain = (present > 0).cast("long") - (present > F.col("more")).cast("long")
    orders = mine.join(theirs, same, "left").select(F.col("mine.product_id").alias("product_id"), gain.alias("order_count"))
    return sums.unionByName(orders, allowMissingColumns=True).select(*gold.PRODUCT_TOTALS)


def _products_added(before: DataFrame, gains: DataFrame, now: Mapping[str, DataFrame]) -> DataFrame:
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast(before.schema[c].dataType).alias(c) for c in before.columns if c != "product_id"]
    return before.unionByName(gains).groupBy("product_id").agg(*sums).filter("lines > 0").select(*before.columns)


TOTALS = {
    "customer_ltv": Totals(
        "customer_id", ("orders", "payments"), "customers", _whole_customers, _customer_gains, _customers_added,
        lambda now, totals: gold.ltv_of(now["customers"], totals),
    ),
    "top_products": Totals(
        "product_id", ("order_items",), "products", lambda now: gold.product_totals(now["order_items"]), _product_gains, _products_added,
        lambda now, totals: gold.products_of(totals, now["products"]),
    ),
}
