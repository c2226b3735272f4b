"""

Each query is declared once, next to its oracle. Inputs are the shop views of
``marlstone.fixtures`` over whole test tables. Results are published in types
both engines print alike: decimals and integers that may be NULL as doubles, dates
and timestamps as text.
"""

from __future__ import annotations

import importlib
import importlib.util
import json
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import marlstone as ms
from marlstone.fixtures import input_bytes, oracle, view
from marlstone.functions.measures import days_between, safe_ratio, since
from marlstone.operators.joins import left_join
from marlstone.operators.metrics import summary_frame
from marlstone.operators.shop import store_order_parts, stored_order_detail
from marlstone.operators.quality import SUITES, Expectation, constraints, references
from marlstone.plans import gold
from marlstone.plans.pipeline import extract_table, load_silver, read_silver, refine_table, refresh_mart, side_by_side, silver_days
from marlstone.plans.silver import silver, silver_rejects, typed_rows
from marlstone.schemas import FOREIGN_KEYS, TABLES
from marlstone.sinks.tables import overwrite_table
from marlstone.sources.watermarks import watermark_lookup
from marlstone.storage import scratch_path

SMOKE_DIR = "/root/testdata/sf0.001"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}
_ORACLE_TEXT: dict[str, str] = {}

TS = "%Y-%m-%d %H:%M:%S.%f"


def _portable(df: DataFrame, gaps: Sequence[str] = ()) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType) or field.name in gaps:
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _query(name: str, sql: str, gaps: Sequence[str] = ()):
    """Register a query and its oracle; ``gaps`` names integer columns that may be NULL.

    The query is called with a view loader and the session.
    """
    _ORACLE_TEXT[name] = sql
    if gaps:
        doubles = ", ".join(f'cast("{c}" as double) as "{c}"' for c in gaps)
        sql = f"select * replace ({doubles}) from ({sql}) result"

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            def load(table: str) -> DataFrame:
                ms.tune(spark, shuffle_bytes=input_bytes(spark, sf_dir, table))
                return view(spark, sf_dir, table)

            ms.tune(spark)
            return _portable(build(load, spark), gaps)

        _QUERIES[name] = run
        _ORACLES[name] = oracle(sql)
        return build

    return register


def _scratch(spark: SparkSession) -> str:
    """A new directory for queries whose subject is writing."""
    return scratch_path(spark, "run")


# --- scans, sources, sinks ---------------------------------------------------

_ORDER_COLUMNS = "id, user_id, status, cast(subtotal as double) subtotal, cast(tax as double) tax, cast(total as double) total"
_WINDOW = "created_at > timestamp '1996-01-01 00:00:00' and created_at <= timestamp '1998-06-30 12:00:00'"


@_query("incremental_window", f"""
    select {_ORDER_COLUMNS}, shipping_address, strftime(created_at, '{TS}') created_at,
           strftime(updated_at, '{TS}') updated_at
    from fx_orders where {_WINDOW}""")
def _(v, spark):
    return ms.incremental_window(v("fx_orders"), "created_at", "1996-01-01", "1998-06-30 12:00:00")


@_query("watermark_lookup", f"""
    with tables as (select distinct event_type table_name from events union all select 'never_extracted')
    select t.table_name,
           strftime(coalesce(max(e.ts), timestamp '1970-01-01 00:00:00'), '{TS}') last_extracted_at
    from tables t left join events e on e.event_type = t.table_name group by t.table_name""")
def _(v, spark):
    marks = v("events").select(
        F.col("event_type").alias("table_name"), F.col("ts").alias("last_extracted_at"), F.col("ts").alias("written_at")
    )
    never = spark.createDataFrame([("never_extracted",)], "table_name string")
    return watermark_lookup(marks, marks.select("table_name").distinct().unionByName(never))


@_query("watermark_advance", f"""
    select count(*) rows_read, strftime(max(created_at), '{TS}') last_extracted_at from fx_orders where {_WINDOW}""")
def _(v, spark):
    batch = ms.incremental_window(v("fx_orders"), "created_at", "1996-01-01", "1998-06-30 12:00:00")
    return ms.high_water_mark(batch, "created_at")


_RUN = datetime(2002, 1, 2, 3, 0, tzinfo=timezone.utc)
_BRONZE_ORDERS = ["id", "user_id", "status", "subtotal", "tax", "total", "shipping_address", "created_at", "updated_at"]


@_query("bronze_csv_roundtrip", f"""
    select {_ORDER_COLUMNS}, shipping_address, strftime(created_at, '{TS}') created_at,
           strftime(updated_at, '{TS}') updated_at from fx_orders""")
def _(v, spark):
    root = f"{_scratch(spark)}/bronze/orders"
    ms.write_bronze(v("fx_orders"), root, _RUN, "r1")
    return ms.safe_cast(ms.read_bronze(spark, root, _BRONZE_ORDERS), TABLES["orders"].silver_schema())


@_query("bronze_partition_scan", """
    select id, status, cast(total as double) total, '02' as run_day
    from fx_orders where created_at > timestamp '1998-01-01 00:00:00'""")
def _(v, spark):
    root = f"{_scratch(spark)}/bronze/orders"
    orders = v("fx_orders")
    ms.write_bronze(ms.incremental_window(orders, "created_at", "1970-01-01", "1998-01-01"), root, _RUN.replace(day=1), "r1")
    ms.write_bronze(ms.incremental_window(orders, "created_at", "1998-01-01", _RUN), root, _RUN, "r2")
    day = ms.read_bronze(spark, root, _BRONZE_ORDERS, day="2002-01-02")
    return day.select(
        F.col("id").try_cast("int").alias("id"), "status",
        F.col("total").try_cast("decimal(10,2)").alias("total"), F.col("day").alias("run_day"),
    )


def _latest(source: str, columns: str, order: str, key: str = "id", where: str | None = None) -> str:
    """Oracle text: the first row per key of ``source`` under ``order``."""
    ranked = f"select *, row_number() over (partition by {key} order by {order}) rn from ({source}) s"
    return f"select {columns} from ({ranked}) ranked where rn = 1" + (f" and {where}" if where else "")


_TYPED_ORDERS = """
    select try_cast(id as int) id, try_cast(user_id as int) user_id, lower(trim(status)) status,
           try_cast(subtotal as decimal(10,2)) subtotal, try_cast(tax as decimal(10,2)) tax,
           try_cast(total as decimal(10,2)) total, nullif(trim(shipping_address), '') shipping_address,
           try_cast(created_at as timestamp) created_at, try_cast(updated_at as timestamp) updated_at
    from fx_orders_raw"""
_ORDERS_NEWEST = (
    "updated_at desc nulls last, created_at desc nulls last, user_id desc nulls last, status desc nulls last, "
    "subtotal desc nulls last, tax desc nulls last, total desc nulls last, shipping_address desc nulls last"
)


@_query("silver_partition_merge", _latest(
    _TYPED_ORDERS,
    f"""id, status, cast(total as double) total, strftime(updated_at, '{TS}') updated_at,
        cast(year(created_at) as int) "year", cast(month(created_at) as int) "month\"""",
    _ORDERS_NEWEST))
def _(v, spark):
    path = f"{_scratch(spark)}/silver/orders"
    spec = TABLES["orders"]
    rows = ms.add_date_parts(silver(v("fx_orders_raw"), spec), "created_at", ("year", "month")).drop("day")
    first = rows.withColumn("status", F.lit("confirmed")).withColumn("updated_at", F.col("created_at") - F.expr("interval 1 day"))
    for batch in (rows, first):  # the older versions arrive last and must lose
        ms.merge_partitions(batch, path, spec.keys, spec.newest_by, ("year", "month"))
    return spark.read.parquet(path).select("id", "status", "total", "updated_at", "year", "month")


# --- projections, predicates, scalar functions -------------------------------

@_query("safe_cast_nulls", f"""
    select try_cast(id as int) id, try_cast(order_id as int) order_id,
           cast(try_cast(amount as decimal(10,2)) as double) amount, method, status, transaction_ref,
           strftime(try_cast(created_at as timestamp), '{TS}') created_at
    from fx_payments_raw""", gaps=("id",))
def _(v, spark):
    return ms.safe_cast(v("fx_payments_raw"), TABLES["payments"].silver_schema())


@_query("blank_to_null", """
    select case when trim(id) = '' then null else id end id,
           case when trim(email) = '' then null else email end email,
           case when trim(name) = '' then null else name end as name,
           case when trim(updated_at) = '' then null else updated_at end updated_at
    from fx_users_raw""")
def _(v, spark):
    return ms.blank_to_null(v("fx_users_raw").select("id", "email", "name", "updated_at"))


@_query("partition_columns", """
    select id, cast(year(created_at) as int) "year", cast(month(created_at) as int) "month",
           cast(day(created_at) as int) "day"
    from fx_orders""")
def _(v, spark):
    return ms.add_date_parts(v("fx_orders"), "created_at").select("id", "year", "month", "day")


@_query("safe_ratio", """
    select id, cast(quantity as double) / nullif(cast(order_id % 4 as double), 0) as ratio from fx_order_items""")
def _(v, spark):
    return v("fx_order_items").select("id", safe_ratio(F.col("quantity"), F.col("order_id") % 4).alias("ratio"))


@_query("scalar_strings", """
    select id, lower(trim(email)) email, trim(name) as name, nullif(trim(name), '') name_or_null from fx_users_raw""")
def _(v, spark):
    clean = ms.normalise(v("fx_users_raw").select("id", "email", "name"), lower=["email"], trim=["email", "name"])
    return clean.withColumn("name_or_null", F.nullif("name", F.lit("")))


@_query("scalar_dates", """
    select id, cast(cast(created_at as date) as varchar) as "day_date",
           cast(year(created_at) as varchar) as "year", lpad(cast(month(created_at) as varchar), 2, '0') as "month",
           lpad(cast(day(created_at) as varchar), 2, '0') as "day",
           cast(date_diff('day', cast(created_at as date), date '2001-12-31') as int) days_left,
           cast(created_at as date) >= date '2001-12-31' - 400 as is_recent
    from fx_orders""")
def _(v, spark):
    end = F.lit("2001-12-31").cast("date")
    dated = ms.add_date_parts(v("fx_orders"), "created_at", as_string=True)
    day = F.to_date("created_at")
    return dated.select(
        "id", day.alias("day_date"), "year", "month", "day",
        days_between(end, day).alias("days_left"), since(day, "2001-12-31", 400).alias("is_recent"),
    )


@_query("scalar_conditionals", """
    select id, case when status = 'completed' then cast(amount as double) else 0.0 end paid,
           nullif(method, 'upi') method_or_null, coalesce(nullif(method, 'upi'), 'other') method_or_other,
           case when order_id < 0 then null else order_id end known_order
    from fx_payments""", gaps=("known_order",))
def _(v, spark):
    zero = F.lit(0).cast("decimal(10,2)")
    other = F.nullif("method", F.lit("upi"))
    return v("fx_payments").select(
        "id",
        F.when(F.col("status") == "completed", F.col("amount")).otherwise(zero).alias("paid"),
        other.alias("method_or_null"),
        F.coalesce(other, F.lit("other")).alias("method_or_other"),
        F.when(F.col("order_id") >= 0, F.col("order_id")).alias("known_order"),
    )


# --- joins and aggregates ----------------------------------------------------

@_query("join_orders_payments", """
    select o.id, o.user_id, cast(o.total as double) total, p.id as payment_id, p.status as payment_status,
           cast(p.amount as double) amount
    from fx_orders o left join fx_payments p on o.id = p.order_id""", gaps=("payment_id",))
def _(v, spark):
    payments = v("fx_payments").select(
        F.col("order_id").alias("id"), F.col("id").alias("payment_id"), F.col("status").alias("payment_status"), "amount"
    )
    return left_join(v("fx_orders").select("id", "user_id", "total"), payments, ["id"])


@_query("agg_count_distinct", """
    select cast(cast(created_at as date) as varchar) event_date, count(distinct session_id) unique_sessions
    from fx_page_views group by cast(created_at as date)""")
def _(v, spark):
    return gold.daily_visits(v("fx_page_views")).select("event_date", "unique_sessions")


@_query("agg_conditional", """
    select method, count(case when status = 'completed' then id end) completed_payments,
           cast(sum(case when status = 'completed' then amount else 0 end) as double) total_paid,
           count(*) payments
    from fx_payments group by method""")
def _(v, spark):
    found = gold.payments_per(v("fx_payments"), F.col("method"))
    return found.withColumnsRenamed({"completed": "completed_payments", "paid": "total_paid", "payment_rows": "payments"})


@_query("audit_key_uniqueness", """
    select count(*) total_rows, (select count(*) from (select distinct id from fx_order_items) d) distinct_keys,
           count(*) = (select count(*) from (select distinct id from fx_order_items) d) is_unique
    from fx_order_items""")
def _(v, spark):
    return ms.audit_key_uniqueness(v("fx_order_items"), ["id"])


# --- deduplication -----------------------------------------------------------

@_query("dedup_latest", _latest(
    "select * from fx_orders_raw", "id, status, shipping_address, updated_at",
    "updated_at desc nulls last, status desc nulls last, shipping_address desc nulls last"))
def _(v, spark):
    rows = v("fx_orders_raw").select("id", "status", "shipping_address", "updated_at")
    return ms.dedup_latest(rows, ["id"], ["updated_at"])


@_query("dedup_by_key", _latest(
    "select id, order_id, product_id, quantity, unit_price, created_at from fx_order_items",
    f"id, order_id, product_id, quantity, cast(unit_price as double) unit_price, strftime(created_at, '{TS}') created_at",
    "created_at desc nulls last, order_id desc nulls last, product_id desc nulls last, quantity desc nulls last, "
    "unit_price desc nulls last"))
def _(v, spark):
    return ms.dedup_latest(v("fx_order_items"), ["id"], ["created_at"])


@_query("dedup_exact", "select distinct order_id, product_id, quantity from fx_order_items")
def _(v, spark):
    return ms.dedup_exact(v("fx_order_items").select("order_id", "product_id", "quantity"))


@_query("dedup_report", """
    select count(*) rows_before, count(distinct id) rows_after, count(*) - count(distinct id) duplicates_removed
    from fx_orders_raw""")
def _(v, spark):
    return ms.duplicate_report(v("fx_orders_raw"), ["id"])


# --- Silver ------------------------------------------------------------------

_PARTS = """cast(year(created_at) as int) "year", cast(month(created_at) as int) "month\""""
_DAY_PARTS = _PARTS + """, cast(day(created_at) as int) "day\""""
_CREATED = f"strftime(created_at, '{TS}') created_at"

_TYPED_USERS = """
    select try_cast(id as int) id, nullif(lower(trim(email)), '') email, nullif(trim(name), '') as name,
           try_cast(created_at as timestamp) created_at, try_cast(updated_at as timestamp) updated_at
    from fx_users_raw"""
_TYPED_PAYMENTS = """
    select try_cast(id as int) id, try_cast(order_id as int) order_id, try_cast(amount as decimal(10,2)) amount,
           lower(trim(method)) as method, lower(trim(status)) status, nullif(trim(transaction_ref), '') transaction_ref,
           try_cast(created_at as timestamp) created_at
    from fx_payments_raw"""
_TYPED_PRODUCTS = """
    select try_cast(id as int) id, trim(name) as name, trim(category) category,
           nullif(trim(description), '') description, try_cast(price as decimal(10,2)) price,
           try_cast(stock_qty as int) stock_qty, try_cast(created_at as timestamp) created_at
    from fx_products_raw"""
_TYPED_ITEMS = """
    select try_cast(id as int) id, try_cast(order_id as int) order_id, try_cast(trim(product_id) as int) product_id,
           try_cast(quantity as int) quantity, try_cast(unit_price as decimal(10,2)) unit_price,
           try_cast(created_at as timestamp) created_at
    from fx_order_items_raw"""
_TYPED_VIEWS = """
    select try_cast(id as int) id, try_cast(user_id as int) user_id, trim(session_id) session_id, trim(path) path,
           nullif(trim(referrer), '') referrer, try_cast(duration_ms as int) duration_ms,
           try_cast(created_at as timestamp) created_at
    from fx_page_views_raw"""
_MONEY_COLUMNS = "cast(subtotal as double) subtotal, cast(tax as double) tax, cast(total as double) total"


@_query("silver_customers", _latest(
    _TYPED_USERS, f"id, email, name, {_CREATED}, strftime(updated_at, '{TS}') updated_at, {_PARTS}",
    "updated_at desc nulls last, email desc nulls last, name desc nulls last, created_at desc nulls last",
    where="id is not null"))
def _(v, spark):
    return ms.silver_customers(v("fx_users_raw"))


@_query("silver_orders", _latest(
    _TYPED_ORDERS,
    f"id, user_id, status, {_MONEY_COLUMNS}, shipping_address, {_CREATED}, "
    f"strftime(updated_at, '{TS}') updated_at, {_DAY_PARTS}",
    _ORDERS_NEWEST, where="id is not null"))
def _(v, spark):
    return ms.silver_orders(v("fx_orders_raw"))


_PAYMENTS_NEWEST = (
    "created_at desc nulls last, order_id desc nulls last, amount desc nulls last, method desc nulls last, "
    "status desc nulls last, transaction_ref desc nulls last"
)


@_query("silver_payments", _latest(
    _TYPED_PAYMENTS,
    f"id, order_id, cast(amount as double) amount, method, status, transaction_ref, {_CREATED}, {_DAY_PARTS}",
    _PAYMENTS_NEWEST, where="id is not null"))
def _(v, spark):
    return ms.silver_payments(v("fx_payments_raw"))


@_query("silver_products", _latest(
    _TYPED_PRODUCTS,
    f"id, name, category, description, cast(price as double) price, stock_qty, {_CREATED}",
    "created_at desc nulls last, name desc nulls last, category desc nulls last, description desc nulls last, "
    "price desc nulls last, stock_qty desc nulls last", where="id is not null"))
def _(v, spark):
    return ms.silver_products(v("fx_products_raw"))


@_query("silver_order_items", _latest(
    _TYPED_ITEMS,
    f"id, order_id, product_id, quantity, cast(unit_price as double) unit_price, {_CREATED}, {_DAY_PARTS}",
    "created_at desc nulls last, order_id desc nulls last, product_id desc nulls last, quantity desc nulls last, "
    "unit_price desc nulls last", where="id is not null"))
def _(v, spark):
    return ms.silver_order_items(v("fx_order_items_raw"))


@_query("silver_page_views", _latest(
    _TYPED_VIEWS, f"id, user_id, session_id, path, referrer, duration_ms, {_CREATED}, {_DAY_PARTS}",
    "created_at desc nulls last, user_id desc nulls last, session_id desc nulls last, path desc nulls last, "
    "referrer desc nulls last, duration_ms desc nulls last", where="id is not null"), gaps=("user_id",))
def _(v, spark):
    return ms.silver_page_views(v("fx_page_views_raw"))


@_query("silver_rejects", f"""
    select order_id, cast(amount as double) amount, method, status, transaction_ref, {_CREATED},
           'missing or malformed key: id' reject_reason
    from ({_TYPED_PAYMENTS}) typed where id is null""")
def _(v, spark):
    return silver_rejects(v("fx_payments_raw"), TABLES["payments"]).drop("id")


@_query("stream_silver", _latest(
    _TYPED_PAYMENTS,
    f"cast(id as bigint) id, order_id, cast(amount as double) amount, method, status, transaction_ref, {_CREATED}, 'kept' outcome",
    _PAYMENTS_NEWEST, where="id is not null") + f"""
    union all
    select null, order_id, cast(amount as double), method, status, transaction_ref, {_CREATED}, 'missing or malformed key: id'
    from ({_TYPED_PAYMENTS}) typed where id is null""", gaps=("id", "order_id"))
def _(v, spark):
    lake = ms.LakeConfig(_scratch(spark))
    raw, half = v("fx_payments_raw"), F.pmod(F.xxhash64("transaction_ref"), F.lit(2))
    for k, run_id in enumerate(("r1", "r2")):
        rows = raw.where(half == k).withColumn("created_at", F.col("created_at").cast("timestamp"))
        ms.write_bronze(rows, lake.path("bronze", "payments"), _RUN, run_id)
    ms.stream_bronze_to_silver(spark, lake, "payments", lake.path("state", "checkpoint"), max_files_per_trigger=1)
    columns = ["id", "order_id", "amount", "method", "status", "transaction_ref", "created_at"]
    kept = spark.read.parquet(lake.path("silver", "payments")).select(*columns, F.lit("kept").alias("outcome"))
    rejected = spark.read.parquet(lake.path("rejects", "payments")).select(*columns, F.col("reject_reason").alias("outcome"))
    return kept.unionByName(rejected)


# --- Gold --------------------------------------------------------------------

def _half_up(cents: str, count: str, digits: int) -> str:
    """Oracle text: cents / count rounded half-up to ``digits`` places, in integers, as double."""
    scale = 2 * 10 ** (digits - 2)
    return f"cast((cast({cents} as hugeint) * {scale} + {count}) // (2 * {count}) as double) / 1e{digits}"


_CENTS = "sum(cast(o.total * 100 as bigint))"
_DAILY = f"""
    select cast(o.created_at as date) sale_date, count(distinct o.id) total_orders, {_CENTS} cents,
           cast(sum(o.total) as double) total_revenue, {_half_up(_CENTS, 'count(o.total)', 6)} avg_order_value,
           count(case when p.status = 'completed' then p.id end) completed_payments,
           cast(sum(case when p.status = 'completed' then p.amount else 0 end) as double) total_paid
    from fx_orders o left join fx_payments p on o.id = p.order_id
    group by cast(o.created_at as date)"""
_LTV = """
    select c.id customer_id, c.email, c.name, min(o.created_at) first_order_date, max(o.created_at) last_order_date,
           count(distinct o.id) total_orders, coalesce(cast(sum(p.amount) as double), 0.0) total_revenue,
           case when count(distinct o.id) > 0
                then coalesce(cast(sum(p.amount) as double), 0.0) / cast(count(distinct o.id) as double)
                else 0.0 end avg_order_value,
           cast(coalesce(date_diff('day', cast(min(o.created_at) as date), cast(max(o.created_at) as date)), 0) as int)
               days_as_customer,
           cast(year(min(o.created_at)) as int) cohort_year, cast(month(min(o.created_at)) as int) cohort_month
    from fx_users c
    left join fx_orders o on o.user_id = c.id
    left join (select * from fx_payments where status = 'completed') p on o.id = p.order_id
    group by c.id, c.email, c.name"""
_TOP = f"""
    select i.product_id, any_value(p.name) product_name, any_value(p.category) category,
           cast(sum(i.quantity) as bigint) units_sold, cast(sum(i.quantity * i.unit_price) as double) total_revenue,
           count(distinct i.order_id) order_count,
           cast((cast({_half_up('sum(cast(i.unit_price * 100 as bigint))', 'count(i.unit_price)', 6)} * 1e6
                 as hugeint) + 50) // 100 as double) / 1e4 avg_unit_price
    from fx_order_items i left join fx_products p on p.id = i.product_id group by i.product_id"""
_FUNNEL = """
    select v.*, coalesce(s.total_orders, 0) total_orders, coalesce(cast(s.total_revenue as double), 0.0) total_revenue,
           cast(coalesce(s.total_orders, 0) as double) / nullif(cast(v.cart_views as double), 0) cart_to_purchase_rate,
           cast(v.cart_views as double) / nullif(cast(v.product_views as double), 0) product_to_cart_rate
    from (select cast(created_at as date) event_date, count(distinct session_id) unique_sessions,
                 count(case when starts_with(path, '/products/') then 1 end) product_views,
                 count(case when path = '/cart' then 1 end) cart_views
          from fx_page_views group by 1) v
    left join (select cast(created_at as date) event_date, count(id) total_orders, sum(total) total_revenue
               from fx_event_orders group by 1) s on s.event_date = v.event_date"""


@_query("gold_daily_sales", f"""
    select cast(sale_date as varchar) sale_date, total_orders, total_revenue, avg_order_value, completed_payments,
           total_paid, cast(year(sale_date) as varchar) "year", lpad(cast(month(sale_date) as varchar), 2, '0') "month",
           lpad(cast(day(sale_date) as varchar), 2, '0') "day"
    from ({_DAILY}) d""")
def _(v, spark):
    return ms.daily_sales(v("fx_orders"), v("fx_payments"))


@_query("gold_daily_sales_unique", _ORACLE_TEXT["gold_daily_sales"])
def _(v, spark):
    return ms.daily_sales(v("fx_orders"), v("fx_payments"), unique_orders=True)


_SILVER_ORDERS = _latest(_TYPED_ORDERS, "*", _ORDERS_NEWEST, where="id is not null")
_SILVER_PAYMENTS = _latest(_TYPED_PAYMENTS, "*", _PAYMENTS_NEWEST, where="id is not null")


@_query("gold_daily_sales_from_raw", _ORACLE_TEXT["gold_daily_sales"]
        .replace("fx_orders o", f"({_SILVER_ORDERS}) o").replace("fx_payments p", f"({_SILVER_PAYMENTS}) p"))
def _(v, spark):
    return ms.daily_sales(ms.silver_orders(v("fx_orders_raw")), ms.silver_payments(v("fx_payments_raw")), unique_orders=True)


_INSTALMENTS = "select * from fx_payments union all select * replace (id + 100000000 as id) from fx_payments where order_id % 3 = 0"


@_query("gold_daily_sales_instalments", _ORACLE_TEXT["gold_daily_sales"].replace("fx_payments p", f"({_INSTALMENTS}) p"))
def _(v, spark):
    payments = v("fx_payments")
    again = payments.where(F.col("order_id") % 3 == 0).withColumn("id", F.col("id") + F.lit(100_000_000))
    return ms.daily_sales(v("fx_orders"), payments.unionByName(again), unique_orders=True)


@_query("gold_customer_ltv", f"""
    select customer_id, email, name, strftime(first_order_date, '{TS}') first_order_date,
           strftime(last_order_date, '{TS}') last_order_date, total_orders, total_revenue, avg_order_value,
           days_as_customer, cohort_year, cohort_month
    from ({_LTV}) l""", gaps=("cohort_year", "cohort_month"))
def _(v, spark):
    return ms.customer_ltv(v("fx_users"), v("fx_orders"), v("fx_payments"))


@_query("gold_customer_ltv_unique", _ORACLE_TEXT["gold_customer_ltv"], gaps=("cohort_year", "cohort_month"))
def _(v, spark):
    return ms.customer_ltv(v("fx_users"), v("fx_orders"), v("fx_payments"), unique_orders=True)


@_query("gold_top_products", f"""
    select cast(product_id as varchar) product_id, product_name, category, units_sold, total_revenue, order_count,
           avg_unit_price
    from ({_TOP}) t order by total_revenue desc, product_id""")
def _(v, spark):
    return ms.top_products(v("fx_order_items"), v("fx_products"))


@_query("gold_funnel", f"""
    select cast(event_date as varchar) event_date, unique_sessions, product_views, cart_views, total_orders,
           total_revenue, cart_to_purchase_rate, product_to_cart_rate,
           cast(year(event_date) as int) "year", cast(month(event_date) as int) "month"
    from ({_FUNNEL}) f""")
def _(v, spark):
    return ms.funnel(v("fx_page_views"), v("fx_event_orders"))


# --- tables and marts kept up to date ------------------------------------------

_SILVER_USERS = _latest(
    _TYPED_USERS, "*", "updated_at desc nulls last, email desc nulls last, name desc nulls last, created_at desc nulls last",
    where="id is not null")
_SILVER_ITEMS = _latest(
    _TYPED_ITEMS, "*", "created_at desc nulls last, order_id desc nulls last, product_id desc nulls last, quantity desc nulls last, "
    "unit_price desc nulls last", where="id is not null")
_SILVER_PRODUCTS = _latest(
    _TYPED_PRODUCTS, "*", "created_at desc nulls last, name desc nulls last, category desc nulls last, description desc nulls last, "
    "price desc nulls last, stock_qty desc nulls last", where="id is not null")
_RAW_VIEWS = {
    "customers": "fx_users_raw", "orders": "fx_orders_raw", "payments": "fx_payments_raw", "products": "fx_products_raw",
    "order_items": "fx_order_items_raw", "page_views": "fx_page_views_raw",
}


def _in_two_runs(v, spark, tables: Sequence[str], mart: str | None = None) -> ms.LakeConfig:
    """Raw tables taken into Silver, and ``mart`` brought up to date, by two runs of half the rows each.

    Versions of a row fall into different halves, so the second run inserts, updates and moves rows.
    """
    lake = ms.LakeConfig(_scratch(spark), incremental_gold=True)
    for k in range(2):
        def load(table: str) -> ms.RunSummary:
            raw = v(_RAW_VIEWS[table])
            half = raw.where(F.pmod(F.xxhash64(*raw.columns), F.lit(2)) == k)
            return load_silver(spark, lake, TABLES[table], half, f"r{k}")

        side_by_side(spark, load, tables)
        if mart is not None:
            refresh_mart(spark, lake, mart, f"r{k}")
    return lake


@_query("incremental_customer_ltv", _ORACLE_TEXT["gold_customer_ltv"]
        .replace("fx_users c", f"({_SILVER_USERS}) c").replace("fx_orders o", f"({_SILVER_ORDERS}) o")
        .replace("fx_payments where", f"({_SILVER_PAYMENTS}) s where"), gaps=("cohort_year", "cohort_month"))
def _(v, spark):
    lake = _in_two_runs(v, spark, ("customers", "orders", "payments"), "customer_ltv")
    return spark.read.parquet(lake.path("gold", "customer_ltv"))


@_query("incremental_top_products", _ORACLE_TEXT["gold_top_products"]
        .replace("fx_order_items i", f"({_SILVER_ITEMS}) i").replace("fx_products p", f"({_SILVER_PRODUCTS}) p"))
def _(v, spark):
    lake = _in_two_runs(v, spark, ("order_items", "products"), "top_products")
    return spark.read.parquet(lake.path("gold", "top_products"))


@_query("silver_products_upsert", _ORACLE_TEXT["silver_products"])
def _(v, spark):
    return read_silver(spark, _in_two_runs(v, spark, ("products",)), "products")


@_query("silver_days", _latest(
    _TYPED_PAYMENTS, f"id, order_id, cast(amount as double) amount, status, {_CREATED}, {_DAY_PARTS}", _PAYMENTS_NEWEST,
    where="id is not null and cast(created_at as date) in (date '1996-01-02', date '1996-01-31', date '1997-06-30')"))
def _(v, spark):
    lake = _in_two_runs(v, spark, ("payments",))
    days = silver_days(spark, lake, "payments", {(1996, 1, 2), (1996, 1, 31), (1997, 6, 30)})
    return days.drop("method", "transaction_ref")


# --- reports -----------------------------------------------------------------

@_query("report_daily_revenue", f"""
    select cast(sale_date as varchar) sale_date, total_revenue, total_orders,
           {_half_up('cents', 'total_orders', 2)} avg_order_value
    from ({_DAILY}) d where sale_date >= date '2001-06-30' - 30 order by sale_date desc""")
def _(v, spark):
    return ms.report_daily_revenue(ms.daily_sales(v("fx_orders"), v("fx_payments")), "2001-06-30")


@_query("report_customer_ltv", f"""
    select email, total_orders, total_revenue, avg_order_value, days_as_customer
    from (select * from ({_LTV}) l order by total_revenue desc, customer_id limit 100) top""")
def _(v, spark):
    return ms.report_customer_ltv(ms.customer_ltv(v("fx_users"), v("fx_orders"), v("fx_payments")))


@_query("report_top_products", f"""
    select product_name, category, units_sold, total_revenue, order_count from ({_TOP}) t
    order by total_revenue desc, product_id""")
def _(v, spark):
    return ms.report_top_products(ms.top_products(v("fx_order_items"), v("fx_products")))


@_query("report_funnel", f"""
    select cast(event_date as varchar) event_date, unique_sessions, product_views, cart_views, total_orders,
           product_to_cart_rate, cart_to_purchase_rate
    from ({_FUNNEL}) f where event_date >= date '2024-02-10' - 30 order by event_date desc""")
def _(v, spark):
    mart = ms.funnel(v("fx_page_views"), v("fx_event_orders"))
    return ms.run_report(spark, "funnel_analysis", "2024-02-10", funnel_analysis=mart)


@_query("report_daily_revenue_stored", _ORACLE_TEXT["report_daily_revenue"])
def _(v, spark):
    path = f"{_scratch(spark)}/daily_sales"
    overwrite_table(ms.daily_sales(v("fx_orders"), v("fx_payments"), unique_orders=True), path, gold.GOLD_PARTITIONS["daily_sales"], tiny=True)
    return ms.report_daily_revenue(spark.read.parquet(path), "2001-06-30")


@_query("report_funnel_stored", _ORACLE_TEXT["report_funnel"])
def _(v, spark):
    path = f"{_scratch(spark)}/funnel_analysis"
    overwrite_table(ms.funnel(v("fx_page_views"), v("fx_event_orders")), path, gold.GOLD_PARTITIONS["funnel_analysis"], tiny=True)
    return ms.run_report(spark, "funnel_analysis", "2024-02-10", funnel_analysis=spark.read.parquet(path))


# --- data quality ------------------------------------------------------------

def _quality_sql(table: str, more: Sequence[Expectation] = ()) -> str:
    """Oracle text: one row per expectation, each counted by its own statement."""
    rows = []
    for position, e in enumerate([*SUITES[table], *more], start=1):
        column = e.kwargs.get("column")
        head = f"select {position} as position, '{e.kind}' expectation_type"
        name = f"'{column}' column_name" if column else "cast(null as varchar) column_name"
        arguments = f"'{json.dumps(e.kwargs, sort_keys=True)}' arguments"
        no_missing = f"cast(null as bigint) missing_count, cast(null as double) missing_percent, {arguments}"
        if e.kind == "expect_column_to_exist":
            rows.append(f"{head}, {name}, true success, cast(null as bigint) element_count, "
                        f"cast(null as bigint) unexpected_count, cast(null as double) unexpected_percent, {no_missing}")
            continue
        if e.kind == "expect_table_row_count_to_be_between":
            rows.append(f"{head}, {name}, count(*) >= {e.kwargs['min_value']} success, count(*) element_count, "
                        f"cast(null as bigint) unexpected_count, cast(null as double) unexpected_percent, {no_missing} from t")
            continue
        checked = f"count({column})"
        if e.kind == "expect_column_values_to_not_be_null":
            bad, checked = f"{column} is null", "count(*)"
        elif e.kind == "expect_column_values_to_be_in_set":
            allowed = ", ".join(f"'{x}'" for x in e.kwargs["value_set"])
            bad = f"{column} not in ({allowed})"
        elif e.kind == "expect_column_values_to_be_between":
            bad = f"{column} < {e.kwargs['min_value']}"
        else:
            bad = f"{column} in (select {column} from t where {column} is not null group by 1 having count(*) > 1)"
        counted = f"count(case when {bad} then 1 end)"
        rows.append(f"{head}, {name}, {counted} = 0 success, count(*) element_count, {counted} unexpected_count, "
                    f"cast({counted} as double) * 100 / nullif(cast({checked} as double), 0) unexpected_percent, "
                    f"count(*) - count({column}) missing_count, "
                    f"cast(count(*) - count({column}) as double) * 100 / nullif(cast(count(*) as double), 0) missing_percent, "
                    f"{arguments} from t")
    return " union all ".join(rows)


# The checks judge typed rows before deduplication, so every kind of failure occurs.
_SUITE_INPUT = {"orders": ("fx_orders_raw", _TYPED_ORDERS), "payments": ("fx_payments_raw", _TYPED_PAYMENTS)}


def _evaluated(v, table: str) -> DataFrame:
    return ms.evaluate(typed_rows(v(_SUITE_INPUT[table][0]), TABLES[table]), SUITES[table])


for _table in SUITES:
    @_query(f"quality_{_table}", f"with t as ({_SUITE_INPUT[_table][1]}) {_quality_sql(_table)}",
            gaps=("element_count", "unexpected_count", "missing_count"))
    def _(v, spark, table=_table):
        return _evaluated(v, table)


_TWO_MORE = [Expectation("expect_column_values_to_be_unique", {"column": c}) for c in ("order_id", "transaction_ref")]


@_query("quality_unique_columns", f"with t as ({_TYPED_PAYMENTS}) {_quality_sql('payments', _TWO_MORE)}",
        gaps=("element_count", "unexpected_count", "missing_count"))
def _(v, spark):
    return ms.evaluate(typed_rows(v("fx_payments_raw"), TABLES["payments"]), [*SUITES["payments"], *_TWO_MORE])


@_query("quality_statistics", f"""
    with t as ({_TYPED_PAYMENTS}), r as ({_quality_sql('payments')})
    select count(*) evaluated_expectations, count(case when success then 1 end) successful_expectations,
           count(case when not success then 1 end) unsuccessful_expectations,
           cast(count(case when success then 1 end) as double) * 100 / cast(count(*) as double) success_percent
    from r""")
def _(v, spark):
    return ms.statistics(_evaluated(v, "payments"))


@_query("quality_document", f"""
    with t as ({_TYPED_PAYMENTS}), r as ({_quality_sql('payments')})
    select bool_and(success) success, count(*) evaluated_expectations,
           cast(count(case when success then 1 end) as double) * 100 / cast(count(*) as double) success_percent,
           count(*) n_results, sum(missing_count)::double missing, string_agg(arguments, ';' order by position) arguments
    from r""")
def _(v, spark):
    document = ms.write_results(_evaluated(v, "payments"), _scratch(spark), "payments", "r1")
    missing = F.aggregate("results", F.lit(0).cast("bigint"), lambda total, r: total + F.coalesce(r["missing_count"], F.lit(0)))
    return document.select(
        "success", "statistics.evaluated_expectations", "statistics.success_percent",
        F.size("results").cast("bigint").alias("n_results"), missing.cast("double").alias("missing"),
        F.array_join("results.arguments", ";").alias("arguments"),
    )


@_query("quality_listing", f"""
    with t as ({_TYPED_PAYMENTS}), r as ({_quality_sql('payments')})
    select position, case when success then 'PASS' else 'FAIL' end status, expectation_type,
           coalesce(column_name, '<table>') column_name
    from r""")
def _(v, spark):
    return ms.listing(_evaluated(v, "payments"))


_FK_VIEWS = {
    "customers": "fx_users", "orders": "fx_orders", "payments": "fx_payments", "products": "fx_products",
    "order_items": "fx_order_items", "page_views": "fx_page_views",
}


@_query("quality_foreign_keys", " union all ".join(
    f"""select '{child}.{column}' relation, count(*) orphan_rows, count(distinct c.{column}) orphan_values
        from {_FK_VIEWS[child]} c where c.{column} is not null
          and not exists (select 1 from {_FK_VIEWS[parent]} p where p.id = c.{column})"""
    for child, column, parent in FOREIGN_KEYS))
def _(v, spark):
    found = references({table: v(name) for table, name in _FK_VIEWS.items()})
    return found.drop("kind").withColumnsRenamed(
        {"column_name": "relation", "violating_rows": "orphan_rows", "violating_values": "orphan_values"})


@_query("quality_foreign_key", """
    select count(*) orphan_rows, count(distinct order_id) orphan_values from fx_payments c
    where order_id is not null and not exists (select 1 from fx_orders p where p.id = c.order_id)""")
def _(v, spark):
    return ms.foreign_keys(v("fx_payments"), "order_id", v("fx_orders"))


@_query("quality_constraints", f"""
    with t as ({_TYPED_PAYMENTS}),
         c as (select nullif(lower(trim(email)), '') email from fx_users_raw)
    select 'unique' kind, 'payments.order_id' column_name, count(*) violating_rows from t
    where order_id in (select order_id from t group by 1 having count(*) > 1)
    union all
    select 'unique', 'customers.email', count(*) from c where email in (select email from c group by 1 having count(*) > 1)
    union all
    select 'foreign key', 'payments.order_id', count(*) from t
    where order_id is not null and not exists (select 1 from fx_orders o where o.id = t.order_id)
    union all
    select 'foreign key', 'orders.user_id', count(*) from fx_orders o
    where not exists (select 1 from (select try_cast(id as int) id from fx_users_raw) u where u.id = o.user_id)""")
def _(v, spark):
    tables = {name: typed_rows(v(raw), TABLES[name]) for name, raw in
              (("payments", "fx_payments_raw"), ("customers", "fx_users_raw"))}
    return constraints({**tables, "orders": v("fx_orders")})


@_query("run_summary", f"""
    with typed as ({_TYPED_USERS})
    select 'extract' stage, 'customers' table_name, count(*) rows_read, count(*) rows_written,
           cast(null as bigint) duplicates_removed, cast(null as bigint) rows_rejected from typed
    union all
    select 'silver', 'customers', count(*), count(distinct id), count(id) - count(distinct id), count(*) - count(id)
    from typed""", gaps=("duplicates_removed", "rows_rejected"))
def _(v, spark):
    lake = ms.LakeConfig(_scratch(spark))
    users = v("fx_users_raw").withColumns({c: F.col(c).cast("timestamp") for c in ("created_at", "updated_at")})
    source = ms.dataframe_source(users)
    summaries = [
        extract_table(spark, lake, "customers", source, _RUN, "r1"),
        refine_table(spark, lake, "customers", "r1"),
    ]
    return summary_frame(spark, summaries).select(
        "stage", "table_name", "rows_read", "rows_written", "duplicates_removed", "rows_rejected"
    )


# --- shop jobs ---------------------------------------------------------------

_CART = """
    select cart_id, product_id, sum(quantity) quantity from fx_cart_lines
    group by cart_id, product_id having sum(quantity) > 0"""


@_query("cart_consolidate", f"select cart_id, product_id, cast(quantity as bigint) quantity from ({_CART}) c")
def _(v, spark):
    return ms.consolidate_cart(v("fx_cart_lines"))


@_query("order_pricing", f"""
    with priced as (
        select c.cart_id, count(*) line_count, cast(sum(p.price * c.quantity) as decimal(18,2)) subtotal
        from ({_CART}) c join fx_products p on p.id = c.product_id where p.stock_qty >= c.quantity group by c.cart_id
    ), cents as (select *, cast(subtotal * 100 as bigint) s from priced),
    taxed as (
        select *, case when s % 10 > 5 or (s % 10 = 5 and (s // 10) % 2 = 1) then s // 10 + 1 else s // 10 end t from cents
    )
    select cart_id, line_count, cast(subtotal as double) subtotal, cast(t as double) / 100 tax,
           cast(s + t as double) / 100 total
    from taxed""")
def _(v, spark):
    return ms.price_orders(ms.consolidate_cart(v("fx_cart_lines")), v("fx_products"))


@_query("stock_position", """
    select p.id product_id, p.stock_qty, cast(coalesce(sum(i.quantity), 0) as bigint) units_sold,
           cast(p.stock_qty - coalesce(sum(i.quantity), 0) as bigint) stock_left
    from fx_products p left join fx_order_items i on i.product_id = p.id group by p.id, p.stock_qty""")
def _(v, spark):
    return ms.stock_position(v("fx_products"), v("fx_order_items"))


@_query("catalog_browse", """
    select id, name, category, cast(price as double) price, stock_qty from fx_products
    where category = 'ECONOMY' order by category, name, id""")
def _(v, spark):
    return ms.browse(v("fx_products"), "ECONOMY").select("id", "name", "category", "price", "stock_qty")


@_query("category_list", "select distinct category from fx_products order by category")
def _(v, spark):
    return ms.category_list(v("fx_products"))


@_query("related_products", """
    select product_id, category, position, related_id, related_name from (
        select a.id product_id, a.category, b.id related_id, b.name related_name,
               cast(row_number() over (partition by a.id order by b.id) as int) as position
        from fx_products a join fx_products b on b.category = a.category and b.id <> a.id) pairs
    where position <= 4""")
def _(v, spark):
    return ms.related_products(v("fx_products"))


@_query("order_history", f"""
    select user_id, id, status, cast(total as double) total, {_CREATED} from fx_orders
    order by user_id, created_at desc nulls last, id desc""")
def _(v, spark):
    return ms.order_history(v("fx_orders").select("user_id", "id", "status", "total", "created_at"))


@_query("order_history_latest", f"""
    select user_id, id, status, cast(total as double) total, {_CREATED} from (
        select *, row_number() over (partition by user_id order by created_at desc nulls last, id desc) rn
        from fx_orders) ranked
    where rn <= 3""")
def _(v, spark):
    return ms.order_history(v("fx_orders").select("user_id", "id", "status", "total", "created_at"), last_n=3)


@_query("order_detail", f"""
    select o.id order_id, o.user_id, o.status order_status, {_MONEY_COLUMNS.replace('cast(', 'cast(o.')},
           strftime(o.created_at, '{TS}') created_at, i.id item_id, i.product_id, i.quantity,
           cast(i.unit_price as double) unit_price, p.name product_name, p.category,
           cast(pay.amount as double) paid_amount, pay.method payment_method, pay.status payment_status,
           cast(i.unit_price * i.quantity as double) line_total
    from fx_orders o
    left join fx_order_items i on i.order_id = o.id
    left join fx_products p on p.id = i.product_id
    left join fx_payments pay on pay.order_id = o.id""", gaps=("item_id", "product_id", "quantity"))
def _(v, spark):
    return ms.order_detail(v("fx_orders"), v("fx_order_items"), v("fx_products"), v("fx_payments"))


@_query("order_detail_stored", _ORACLE_TEXT["order_detail"], gaps=("item_id", "product_id", "quantity"))
def _(v, spark):
    path = _scratch(spark)
    name = "detail_" + path.rpartition("-")[2]
    store_order_parts(v("fx_orders"), v("fx_order_items"), v("fx_products"), v("fx_payments"), name, path, buckets=8)
    return stored_order_detail(spark, name)


@_query("page_type_counts", r"""
    select page_type, product_id, category, count(*) as views from (
        select case when split_part(path, '?', 1) = '/' then 'home'
                    when starts_with(split_part(path, '?', 1), '/products/') then 'product'
                    when path in ('/cart', '/checkout', '/orders') then substr(path, 2)
                    else 'other' end page_type,
               try_cast(nullif(regexp_extract(path, '^/products/(\d+)$', 1), '') as bigint) product_id,
               nullif(regexp_extract(path, '^/\?category=([^&]*)', 1), '') category
        from fx_page_views) pages
    group by page_type, product_id, category""", gaps=("product_id",))
def _(v, spark):
    return ms.page_type_counts(v("fx_page_views"))


# --- contract ----------------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    """Raw orders and payments through Silver to the daily sales mart."""
    ms.tune(spark)
    orders = ms.silver_orders(view(spark, SMOKE_DIR, "fx_orders_raw"))
    payments = ms.silver_payments(view(spark, SMOKE_DIR, "fx_payments_raw"))
    return gold.daily_sales(orders, payments, unique_orders=True)


def _installed(name: str) -> bool:
    spec = importlib.util.find_spec(name)
    return spec is not None and spec.origin is not None


def _corpus(part: str) -> dict:
    """Queries or oracles of the corpus operators, where those are installed, and of their pipeline, which needs them."""
    found = {}
    if _installed("marlstone.llm"):
        found |= getattr(importlib.import_module("marlstone.llm.queries"), part)
        if _installed("corpus_pipeline"):
            found |= getattr(importlib.import_module("corpus_pipeline"), part)
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _corpus("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _ORACLES | _corpus("ORACLES")
