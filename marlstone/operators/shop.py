"""The shop's own computations as set-level table jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.measures import page_category, page_product, page_type, sales_tax
from marlstone.operators.dedup import first_per_group
from marlstone.operators.joins import left_join

# The shop's tax rate, and how many related products it shows.
TAX_RATE = "0.10"
RELATED = 4
# End of fixed values.


def consolidate_cart(lines: DataFrame) -> DataFrame:
    """One line per cart and product with the summed quantity; none at or below zero."""
    totals = lines.groupBy("cart_id", "product_id").agg(F.sum("quantity").alias("quantity"))
    return totals.filter(F.col("quantity") > 0)


def price_orders(lines: DataFrame, products: DataFrame, tax_rate: str = TAX_RATE) -> DataFrame:
    """Subtotal, tax and total per cart over the lines the stock can serve.

    Unknown products and lines beyond stock are left out; a cart with nothing
    left yields no order.
    """
    catalog = products.select(F.col("id").alias("product_id"), "price", "stock_qty")
    served = lines.join(catalog, "product_id").filter(F.col("stock_qty") >= F.col("quantity"))
    priced = served.groupBy("cart_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(F.col("price") * F.col("quantity").cast("decimal(10,0)")).cast("decimal(18,2)").alias("subtotal"),
    )
    taxed = priced.withColumn("tax", sales_tax(F.col("subtotal"), tax_rate))
    return taxed.withColumn("total", (F.col("subtotal") + F.col("tax")).cast("decimal(18,2)"))


def stock_position(products: DataFrame, items: DataFrame) -> DataFrame:
    """Stock left per product after subtracting everything sold."""
    sold = items.groupBy(F.col("product_id").alias("id")).agg(F.sum("quantity").alias("units_sold"))
    units = F.coalesce("units_sold", F.lit(0))
    return products.select("id", "stock_qty").join(sold, "id", "left").select(
        F.col("id").alias("product_id"),
        "stock_qty",
        units.alias("units_sold"),
        (F.col("stock_qty") - units).alias("stock_left"),
    )


def browse(products: DataFrame, category: str | None = None) -> DataFrame:
    """The catalog by category and name, or one category of it."""
    if category is not None:
        products = products.filter(F.col("category") == category)
    return products.orderBy("category", "name", "id")


def category_list(products: DataFrame) -> DataFrame:
    return products.select("category").distinct().orderBy("category")


def related_products(products: DataFrame, n: int = RELATED) -> DataFrame:
    """Up to ``n`` other products of the same category per product, lowest ids first.

    A product's neighbours are among the first ``n + 1`` of its category. Those
    are found once per category, so no pairs within a category are formed and a
    category of any size costs one short list.
    """
    head = first_per_group(products.select("category", "id", "name"), ["category"], [F.col("id").asc()], n + 1)
    heads = head.groupBy("category").agg(
        F.sort_array(F.collect_list(F.struct(F.col("id").alias("related_id"), F.col("name").alias("related_name"))))
        .alias("head")
    )
    mine = products.select(F.col("id").alias("product_id"), "category").join(heads, "category")
    others = F.filter("head", lambda entry: entry["related_id"] != F.col("product_id"))
    return mine.select("product_id", "category", F.posexplode(F.slice(others, 1, n)).alias("pos", "related")).select(
        "product_id", "category", (F.col("pos") + 1).alias("position"), "related.related_id", "related.related_name"
    )


def order_history(orders: DataFrame, user_id: int | None = None, last_n: int | None = None) -> DataFrame:
    """Orders per user, newest first: one user's or everyone's, all or the last ``last_n``.

    The full history is a sort, which spreads a very active user over several
    range partitions; only ``last_n`` needs ranking.
    """
    if user_id is not None:
        orders = orders.filter(F.col("user_id") == user_id)
    newest = [F.col("created_at").desc_nulls_last(), F.col("id").desc()]
    if last_n is not None:
        orders = first_per_group(orders, ["user_id"], newest, last_n)
    return orders.orderBy("user_id", *newest)


def order_detail(orders: DataFrame, items: DataFrame, products: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with their items, each item's product, and the payment: one row per item.

    Orders without items or payment keep one row with NULLs. Items stay rows
    rather than a nested list, so an order's size is not bounded by a task.
    """
    heads, lines, paid = _order_parts(orders, items, products, payments)
    # Payments are unique per key and on the right, so what can be hot, the item lines, is on
    # the left where a partition can be split.
    with_items = left_join(heads, lines, ["order_id"])
    detail = left_join(with_items, paid, ["order_id"], right_unique=True)
    return detail.withColumn("line_total", _line_total())


def _order_parts(orders: DataFrame, items: DataFrame, products: DataFrame, payments: DataFrame) -> tuple[DataFrame, ...]:
    """Order heads, item lines with their product, and payments, all by ``order_id``."""
    heads = orders.select(
        F.col("id").alias("order_id"), "user_id", F.col("status").alias("order_status"),
        "subtotal", "tax", "total", "created_at",
    )
    paid = payments.select(
        "order_id",
        F.col("amount").alias("paid_amount"),
        F.col("method").alias("payment_method"),
        F.col("status").alias("payment_status"),
    )
    names = products.select(F.col("id").alias("product_id"), F.col("name").alias("product_name"), "category")
    lines = items.select("order_id", F.col("id").alias("item_id"), "product_id", "quantity", "unit_price")
    return heads, left_join(lines, names, ["product_id"], right_unique=True), paid


def _line_total() -> Column:
    return (F.col("unit_price") * F.col("quantity").cast("decimal(10,0)")).cast("decimal(18,2)")


#: Tables that hold an order's parts, dealt alike by its id.
DETAIL_TABLES = ("heads", "lines", "paid")
#: Rows of one of them that a bucket holds about, so that a bucket's task sorts as many however large the tables are.
ROWS_PER_BUCKET = 500_000


def store_order_parts(
    orders: DataFrame, items: DataFrame, products: DataFrame, payments: DataFrame, name: str, path: str, buckets: int
) -> None:
    """Store what ``stored_order_detail`` reads: three catalog tables ``name``_… below ``path``, bucketed by order.

    Products are attached to the lines here, once. One task writes a bucket, as one sorted file; there are at least
    ``buckets`` of them, and as many as keep each near ``ROWS_PER_BUCKET``.
    """
    largest = max(part.count() for part in (orders, items, payments))
    buckets = max(buckets, -(-largest // ROWS_PER_BUCKET))
    heads, lines, paid = _order_parts(orders, items, products, payments)
    for table, df in zip(DETAIL_TABLES, (heads, lines, paid)):
        dealt = df.repartition(buckets, "order_id").write.mode("overwrite").option("path", f"{path}/{table}")
        dealt.bucketBy(buckets, "order_id").sortBy("order_id").saveAsTable(f"{name}_{table}")


def stored_order_detail(spark: SparkSession, name: str) -> DataFrame:
    """``order_detail`` of the tables ``store_order_parts`` made: buckets meet where they lie, nothing is shuffled."""
    heads, lines, paid = (spark.table(f"{name}_{table}") for table in DETAIL_TABLES)
    detail = heads.join(lines.hint("merge"), "order_id", "left").join(paid.hint("merge"), "order_id", "left")
    return detail.withColumn("line_total", _line_total())


def page_type_counts(page_views: DataFrame) -> DataFrame:
    """Views per kind of page, product and category filter, query strings aside."""
    path = F.col("path")
    return page_views.groupBy(
        page_type(path).alias("page_type"),
        page_product(path).alias("product_id"),
        page_category(path).alias("category"),
    ).agg(F.count(F.lit(1)).alias("views"))
