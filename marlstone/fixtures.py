"""The shop's tables, derived from the test data's star schema.

Each view is one SELECT that Spark and DuckDB both accept, so a query and its
oracle start from the same rows. ``{table}`` names an input. Every view reads its
input tables whole.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from marlstone.storage import list_files

_STATUS = "case o_orderstatus when 'O' then 'confirmed' when 'P' then 'shipped' else 'delivered' end"
_TOTAL = "cast(o_totalprice as decimal(10,2))"
_TAX = f"cast({_TOTAL} * cast(0.09 as decimal(3,2)) as decimal(10,2))"
# One customer in seven places no order (theirs go to a neighbour); every 13th
# payment points at an order that does not exist, leaving its own order unpaid.
_USER = "cast(case when o_custkey % 7 = 3 then o_custkey - 1 else o_custkey end as int)"
_PAID_ORDER = "cast(case when o_orderkey % 13 = 0 then -1 - o_orderkey else o_orderkey end as int)"
_METHOD = "case o_orderpriority when '1-URGENT' then 'card' when '2-HIGH' then 'paypal' else 'upi' end"
_PAY_STATUS = (
    "case o_orderkey % 10 when 0 then 'failed' when 1 then 'pending' when 2 then 'refunded' else 'completed' end"
)
_PATH = (
    "case event_type when 'view' then concat('/products/', cast(event_id % 2000 as varchar(20)))"
    " when 'click' then '/cart' when 'purchase' then '/checkout'"
    " when 'signup' then case when event_id % 2 = 0 then '/' else '/?category=ECONOMY' end else '/orders' end"
)
_SESSION = "concat(cast(user_id as varchar(20)), '-', cast(cast(ts as date) as varchar(20)))"



def _deliveries(table: str, times: int) -> str:
    """The whole table repeated, as at-least-once extraction may deliver it."""
    return " union all ".join(f"select *, {n} delivery from {{{table}}}" for n in range(1, times + 1))


VIEWS = {
    "fx_users": """
        select cast(c_custkey as int) id, concat('  ', upper(c_name), '@Shop.Example ') email,
               concat(c_name, ' ') name,
               cast(date '1995-01-01' + cast(c_custkey % 365 as int) as timestamp) created_at
        from {customer}""",
    "fx_products": """
        select cast(p_partkey as int) id, p_name name, p_type category, p_brand description,
               cast(p_retailprice as decimal(10,2)) price, p_size stock_qty,
               cast(date '1995-01-01' + cast(p_partkey % 30 as int) as timestamp) created_at
        from {part}""",
    "fx_orders": f"""
        select cast(o_orderkey as int) id, {_USER} user_id, {_STATUS} status,
               cast({_TOTAL} - {_TAX} as decimal(10,2)) subtotal, {_TAX} tax, {_TOTAL} total,
               concat('Street ', cast(o_orderkey as varchar(20))) shipping_address,
               o_orderdate created_at, o_orderdate updated_at
        from {{orders}}""",
    "fx_payments": f"""
        select cast(o_orderkey as int) id, {_PAID_ORDER} order_id, {_TOTAL} amount, {_METHOD} as method,
               {_PAY_STATUS} status, o_orderdate created_at
        from {{orders}}""",
    "fx_order_items": """
        select cast(l_orderkey * 10 + l_linenumber as int) id, cast(l_orderkey as int) order_id,
               cast(l_partkey as int) product_id, cast(l_quantity as int) quantity,
               cast(l_extendedprice as decimal(10,2)) unit_price, l_shipdate created_at
        from {lineitem}""",
    "fx_page_views": f"""
        select cast(event_id as int) id, cast(user_id as int) user_id, {_SESSION} session_id, {_PATH} path,
               ts created_at
        from {{events}}""",
    "fx_event_orders": """
        select cast(event_id as int) id, cast(value as decimal(10,2)) total, ts created_at
        from {events} where event_type = 'purchase'""",
    "fx_cart_lines": """
        select l_orderkey cart_id, cast(l_partkey as int) product_id, cast(l_quantity as int) - 5 quantity
        from {lineitem}""",
    # Raw tables: text columns, malformed ids, blanks, padded upper case. The whole table
    # is delivered more than once, some rows in another version the second or third time.
    "fx_users_raw": f"""
        select case when delivery = 1 and c_custkey % 500 = 1 then concat('bad', cast(c_custkey as string))
                    else cast(c_custkey as string) end id,
               case when delivery = 2 and c_custkey % 10 = 0 then concat(c_name, '@new.example')
                    when delivery = 3 and c_custkey % 15 = 0 then concat(c_name, '@null.example')
                    else concat('  ', upper(c_name), '@Shop.Example ') end email,
               case when delivery = 1 and c_custkey % 11 = 0 then '  ' else concat(c_name, ' ') end name,
               'secret' password_hash,
               cast(date '1995-01-01' + cast(c_custkey % 365 as int) as string) created_at,
               case when delivery = 2 and c_custkey % 10 = 0
                    then cast(date '1995-01-02' + cast(c_custkey % 365 as int) as string)
                    when delivery = 3 and c_custkey % 15 = 0 then null
                    else cast(date '1995-01-01' + cast(c_custkey % 365 as int) as string) end updated_at
        from ({_deliveries("customer", 3)}) delivered""",
    "fx_orders_raw": f"""
        select cast(o_orderkey as string) id, cast(o_custkey as string) user_id,
               case when delivery = 2 and o_orderkey % 20 = 0 then 'CANCELLED'
                    else concat(' ', upper({_STATUS})) end status,
               cast(cast({_TOTAL} - {_TAX} as decimal(10,2)) as string) subtotal,
               case when o_orderkey % 50 = 7 then 'n/a' else cast({_TAX} as string) end tax,
               cast({_TOTAL} as string) total,
               case when delivery = 2 and o_orderkey % 20 = 0 then '' when o_orderkey % 9 = 0 then '   '
                    else concat(' Street ', cast(o_orderkey as string)) end shipping_address,
               cast(cast(o_orderdate as date) as string) created_at,
               cast(cast(o_orderdate as date) + case when delivery = 2 and o_orderkey % 20 = 0 then 30
                    else cast(o_orderkey % 5 as int) end as string) updated_at
        from ({_deliveries("orders", 2)}) delivered""",
    "fx_payments_raw": f"""
        select case when delivery = 1 and o_orderkey % 700 = 5 then '' else cast(o_orderkey as string) end id,
               cast({_PAID_ORDER} as string) order_id,
               case when o_orderkey % 60 = 1 then '12,50' else cast({_TOTAL} as string) end amount,
               upper({_METHOD}) as method,
               case when delivery = 2 and o_orderkey % 25 = 0 then 'Completed' else concat({_PAY_STATUS}, '  ') end
                   status,
               case when o_orderkey % 8 = 0 then ' ' else concat(' ref-', cast(o_orderkey as string), ' ') end
                   transaction_ref,
               cast(cast(o_orderdate as date) + case when delivery = 2 and o_orderkey % 25 = 0 then 1 else 0 end
                    as string) created_at
        from ({_deliveries("orders", 2)}) delivered""",
    "fx_products_raw": f"""
        select cast(p_partkey as string) id, concat(' ', p_name) name, concat(p_type, ' ') category,
               case when p_partkey % 6 = 0 then '  ' else concat(' ', p_brand) end description,
               case when delivery = 2 and p_partkey % 12 = 0 then 'free'
                    else cast(cast(p_retailprice as decimal(10,2)) as string) end price,
               cast(p_size + case when delivery = 2 and p_partkey % 12 = 0 then 1 else 0 end as string) stock_qty,
               'img.png' image_url,
               cast(date '1995-01-01' + cast(p_partkey % 30 as int)
                    + case when delivery = 2 and p_partkey % 12 = 0 then 31 else 0 end as string) created_at
        from ({_deliveries("part", 2)}) delivered""",
    "fx_order_items_raw": f"""
        select case when delivery = 1 and l_orderkey % 600 = 7 then concat('#', cast(l_orderkey as string))
                    else cast(l_orderkey * 10 + l_linenumber as string) end id, cast(l_orderkey as string) order_id,
               concat(' ', cast(l_partkey as string)) product_id, cast(cast(l_quantity as int) as string) quantity,
               cast(cast(l_extendedprice as decimal(10,2)) as string) unit_price,
               cast(cast(l_shipdate as date) + case when delivery = 2 and l_orderkey % 15 = 0 then 1 else 0 end
                    as string) created_at
        from ({_deliveries("lineitem", 2)}) delivered""",
    "fx_page_views_raw": f"""
        select case when delivery = 1 and event_id % 900 = 5 then 'none' else cast(event_id as string) end id,
               case when event_id % 4 = 0 then '' else cast(user_id as string) end user_id,
               {_SESSION} session_id,
               case when delivery = 2 and event_id % 50 = 0 then '/orders ' else concat({_PATH}, ' ') end path,
               case when event_id % 3 = 0 then ' ' else '/home' end referrer,
               cast(cast(floor(value) as int) as string) duration_ms, cast(ts as string) created_at
        from ({_deliveries("events", 2)}) delivered""",
}

_INPUT = re.compile(r"\{(\w+)\}")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view, or a test table itself, as a DataFrame."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name]
    inputs = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(_INPUT.findall(text))}
    return spark.sql(text, **inputs)


def input_bytes(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Length of the files a view reads, each table counted as often as the view delivers it."""
    tables = _INPUT.findall(VIEWS[name]) if name in VIEWS else [name]
    return sum(length for t in tables for _, length in list_files(spark, f"{sf_dir}/{t}.parquet"))


def oracle(body: str) -> str:
    """``body`` with the fixture views it names in front, for an engine that has the tables."""
    used = [name for name in VIEWS if re.search(rf"\b{name}\b", body)]
    ctes = [f"{name} AS ({_INPUT.sub(lambda m: m.group(1), VIEWS[name])})" for name in used]
    body = body.strip()
    if not ctes:
        return body
    joined = ",\n".join(ctes)
    if body.upper().startswith("WITH "):
        return f"WITH {joined},\n{body[5:]}"
    return f"WITH {joined}\n{body}"
