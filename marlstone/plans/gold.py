"""Silver to Gold: the four business marts.

Facts are reduced per join key before they are joined. That bounds what a hot
key sends to one task, and an order's payments never multiply its row. The
figures are those of the row-level join, repeated payments included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.cleaning import add_date_parts
from marlstone.functions.measures import days_between, safe_ratio


def _per_day(facts: DataFrame, day: str, **figures: Column) -> DataFrame:
    """One row per calendar day of ``created_at``, the day first."""
    return facts.groupBy(F.to_date("created_at").alias(day)).agg(*[figure.alias(name) for name, figure in figures.items()])


def _or_zero(total):
    return F.coalesce(total, F.lit(0).cast("decimal(20,2)"))


def _completed(column):
    return F.when(F.col("status") == "completed", F.col(column))


def payments_per(payments: DataFrame, key: Column) -> DataFrame:
    """Payments, completed payments and their sum per ``key``."""
    return payments.groupBy(key).agg(
        F.count(F.lit(1)).alias("payment_rows"),
        F.count(_completed("id")).alias("completed"),
        F.sum(_completed("amount")).alias("paid"),
    )


def _count_ids(unique: bool) -> Column:
    return F.count("id") if unique else F.count_distinct("id")


def daily_sales(orders: DataFrame, payments: DataFrame, unique_orders: bool = False) -> DataFrame:
    """Sales per calendar day of the order.

    ``unique_orders`` says that order ids do not repeat, as in a Silver table:
    counting rows then gives the distinct count without grouping by id.

    An order with several payments counts once per payment in revenue and
    average, as in the row-level join; payments are unique per order at source
    and the quality checks watch that.
    """
    joined = (
        orders.select("id", "created_at", "total")
        .join(payments_per(payments, F.col("order_id").alias("id")), "id", "left")
        .withColumn("weight", F.coalesce("payment_rows", F.lit(1)).cast("decimal(12,0)"))
    )
    revenue = F.sum(F.col("total") * F.col("weight")).cast("decimal(20,2)")
    priced = F.sum(F.when(F.col("total").isNotNull(), F.col("weight"))).cast("decimal(20,0)")
    daily = _per_day(
        joined,
        "sale_date",
        total_orders=_count_ids(unique_orders),
        total_revenue=revenue,
        avg_order_value=(revenue / priced).cast("decimal(14,6)"),
        completed_payments=F.coalesce(F.sum("completed"), F.lit(0)),
        total_paid=_or_zero(F.sum("paid").cast("decimal(22,2)")),
    )
    return add_date_parts(daily, "sale_date", as_string=True)


def customer_ltv(
    customers: DataFrame, orders: DataFrame, payments: DataFrame, unique_orders: bool = False
) -> DataFrame:
    """Lifetime value per customer, customers without orders included.

    ``unique_orders`` as in ``daily_sales``.

    Dates and order counts cover orders of any status, revenue only completed
    payments.
    """
    return ltv_of(customers, customer_totals(orders, payments, unique_orders))


def customer_totals(orders: DataFrame, payments: DataFrame, unique_orders: bool = False) -> DataFrame:
    """First and last order, number of orders and exact revenue per customer with orders."""
    return (
        orders.select("id", "user_id", "created_at")
        .join(paid_per_order(payments), "id", "left")
        .groupBy(F.col("user_id").alias("customer_id"))
        .agg(
            F.min("created_at").alias("first_order_date"),
            F.max("created_at").alias("last_order_date"),
            _count_ids(unique_orders).alias("total_orders"),
            F.sum("paid").alias("revenue"),
        )
    )


def paid_per_order(payments: DataFrame) -> DataFrame:
    """Sum of the completed payments per order."""
    completed = payments.filter(F.col("status") == "completed")
    return completed.groupBy(F.col("order_id").alias("id")).agg(F.sum("amount").alias("paid"))


def ltv_of(customers: DataFrame, totals: DataFrame) -> DataFrame:
    """The mart from its customers and their totals."""
    # Grouped again on the join's own partitioning (no shuffle), so that a customer
    # listed twice yields one row, as the mart's key promises.
    per_customer = (
        customers.select(F.col("id").alias("customer_id"), "email", "name")
        .join(totals, "customer_id", "left")
        .groupBy("customer_id", "email", "name")
        .agg(
            F.min("first_order_date").alias("first_order_date"),
            F.max("last_order_date").alias("last_order_date"),
            F.coalesce(F.max("total_orders"), F.lit(0)).alias("total_orders"),
            # Money is added up in exact decimals; only the published figure is a double.
            F.coalesce(F.sum("revenue").cast("double"), F.lit(0.0)).alias("total_revenue"),
        )
    )
    return per_customer.select(
        "customer_id", "email", "name", "first_order_date", "last_order_date", "total_orders", "total_revenue",
        F.coalesce(safe_ratio(F.col("total_revenue"), F.col("total_orders")), F.lit(0.0)).alias("avg_order_value"),
        days_between(F.col("last_order_date"), F.col("first_order_date")).alias("days_as_customer"),
        F.year("first_order_date").alias("cohort_year"),
        F.month("first_order_date").alias("cohort_month"),
    )


def top_products(items: DataFrame, products: DataFrame) -> DataFrame:
    """Sales per product, in no order: the report sorts. Orders of every status count.

    Names are attached after aggregation. Counts are 64 bits wide: a best
    seller's units can exceed 32.
    """
    return products_of(product_totals(items), products)


def product_totals(items: DataFrame) -> DataFrame:
    """Sums and counts per product, of which the mart's figures are quotients and sums."""
    per_product = items.groupBy("product_id").agg(*item_figures(), F.count_distinct("order_id").alias("order_count"))
    return per_product.select(*PRODUCT_TOTALS)


#: columns of ``product_totals`` after the key; all but the last are sums over item lines
PRODUCT_TOTALS = ("product_id", "lines", "units", "unit_lines", "revenue", "revenue_lines", "prices", "price_lines", "order_count")


def item_figures(times: Column | None = None) -> list[Column]:
    """The sums of ``PRODUCT_TOTALS`` over item lines, each counted ``times`` (1 or -1); once by default."""
    quantity = F.col("quantity").cast("int")
    price = F.col("unit_price").cast("decimal(10,2)")

    def total(value: Column, kind: str) -> Column:
        return F.sum(value if times is None else value * times.cast(kind))

    def lines(value: Column) -> Column:
        return F.count(value) if times is None else F.sum(F.when(value.isNotNull(), times).otherwise(0))

    return [
        lines(F.lit(1)).alias("lines"),
        total(quantity, "int").alias("units"),
        lines(quantity).alias("unit_lines"),
        total(quantity * price, "decimal(2,0)").cast("decimal(38,2)").alias("revenue"),
        lines(quantity * price).alias("revenue_lines"),
        total(price, "decimal(2,0)").cast("decimal(38,2)").alias("prices"),
        lines(price).alias("price_lines"),
    ]


def products_of(totals: DataFrame, products: DataFrame) -> DataFrame:
    """The mart from its products' names and totals."""
    some = lambda column, lines: F.when(F.col(lines) > 0, F.col(column))
    mean = (F.col("prices").cast("decimal(20,2)") / F.nullif("price_lines", F.lit(0)).cast("decimal(20,0)")).cast("decimal(14,6)")
    names = products.select(F.col("id").alias("product_id"), F.col("name").alias("product_name"), "category")
    return totals.join(names, "product_id", "left").select(
        F.col("product_id").cast("string").alias("product_id"), "product_name", "category",
        some("units", "unit_lines").alias("units_sold"),
        some("revenue", "revenue_lines").cast("decimal(18,2)").alias("total_revenue"),
        "order_count",
        mean.cast("decimal(10,4)").alias("avg_unit_price"),
    )


def daily_visits(page_views: DataFrame) -> DataFrame:
    """Sessions, product and cart views per day."""
    path = F.col("path")
    return _per_day(
        page_views,
        "event_date",
        unique_sessions=F.count_distinct("session_id"),
        product_views=F.count_if(path.startswith("/products/")),
        cart_views=F.count_if(path == "/cart"),
    )


def funnel(page_views: DataFrame, orders: DataFrame) -> DataFrame:
    """Browse-to-purchase funnel per day with page views; both sides meet already daily."""
    visits = daily_visits(page_views)
    sales = _per_day(orders, "event_date", total_orders=F.count("id"), total_revenue=F.sum("total"))
    purchases = F.coalesce("total_orders", F.lit(0))
    daily = visits.join(sales, "event_date", "left").select(
        *visits.columns,
        purchases.alias("total_orders"),
        _or_zero(F.col("total_revenue")).alias("total_revenue"),
        safe_ratio(purchases, F.col("cart_views")).alias("cart_to_purchase_rate"),
        safe_ratio(F.col("cart_views"), F.col("product_views")).alias("product_to_cart_rate"),
    )
    return add_date_parts(daily, "event_date", ("year", "month"))


#: Fixed values, here and as the column names above: what the published marts are called and split by.
#: mart → partition columns of its stored table
GOLD_PARTITIONS = {
    "daily_sales": ("year", "month", "day"),
    "customer_ltv": ("cohort_year", "cohort_month"),
    "top_products": (),
    "funnel_analysis": ("year", "month"),
}

#: Marts with a row per day, so that a partition is a row or a month of rows.
DAILY_MARTS = ("daily_sales", "funnel_analysis")
