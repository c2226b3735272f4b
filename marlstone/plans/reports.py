"""The four standing reports on Gold, as DataFrame functions and as Spark SQL text."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.measures import may_reach_since, since
from marlstone.plans.gold import GOLD_PARTITIONS

# The published columns of each report, in order, its period and its length.
COLUMNS = {
    "daily_revenue": ("sale_date", "total_revenue", "total_orders", "avg_order_value"),
    "customer_ltv": ("email", "total_orders", "total_revenue", "avg_order_value", "days_as_customer"),
    "top_products": ("product_name", "category", "units_sold", "total_revenue", "order_count"),
    "funnel_analysis": (
        "event_date", "unique_sessions", "product_views", "cart_views", "total_orders",
        "product_to_cart_rate", "cart_to_purchase_rate",
    ),
}
DAYS = 30
TOP_CUSTOMERS = 100
# End of fixed values.


def _recent(gold: DataFrame, mart: str, day: str, as_of: date | str, days: int) -> DataFrame:
    """Rows of the last ``days`` days; of a stored mart only the partitions that can hold them are opened."""
    return gold.filter(may_reach_since(GOLD_PARTITIONS[mart], as_of, days)).filter(since(F.col(day), as_of, days))


def report_daily_revenue(gold: DataFrame, as_of: date | str, days: int = DAYS) -> DataFrame:
    """Revenue per day for the last ``days`` days, newest first."""
    per_order = F.round(F.col("total_revenue") / F.nullif(F.col("total_orders"), F.lit(0)), 2)
    recent = _recent(gold, "daily_sales", "sale_date", as_of, days).withColumn("avg_order_value", per_order)
    return recent.select(*COLUMNS["daily_revenue"]).orderBy(F.col("sale_date").desc())


def report_customer_ltv(gold: DataFrame, n: int = TOP_CUSTOMERS) -> DataFrame:
    """The ``n`` customers with the highest revenue; the id settles ties."""
    best = gold.orderBy(F.col("total_revenue").desc_nulls_last(), "customer_id").limit(n)
    return best.select(*COLUMNS["customer_ltv"])


def report_top_products(gold: DataFrame) -> DataFrame:
    """Every product by revenue, best first."""
    ranked = gold.orderBy(F.col("total_revenue").desc_nulls_last(), "product_id")
    return ranked.select(*COLUMNS["top_products"])


def report_funnel(gold: DataFrame, as_of: date | str, days: int = DAYS) -> DataFrame:
    """Funnel per day for the last ``days`` days, newest first."""
    recent = _recent(gold, "funnel_analysis", "event_date", as_of, days)
    return recent.select(*COLUMNS["funnel_analysis"]).orderBy(F.col("event_date").desc())


#: The same reports for SQL users, over the Gold tables. Columns and their order.
REPORT_SQL = {
    "daily_revenue": """
        SELECT sale_date, total_revenue, total_orders,
               round(total_revenue / nullif(total_orders, 0), 2) AS avg_order_value
        FROM {daily_sales}
        WHERE sale_date >= date_sub(CAST(:as_of AS DATE), :days)
          AND make_date(CAST(year AS INT), CAST(month AS INT), CAST(day AS INT)) >= date_sub(CAST(:as_of AS DATE), :days)
        ORDER BY sale_date DESC
    """,
    "customer_ltv": """
        SELECT email, total_orders, total_revenue, avg_order_value, days_as_customer
        FROM {customer_ltv}
        ORDER BY total_revenue DESC NULLS LAST, customer_id
        LIMIT :n
    """,
    "top_products": """
        SELECT product_name, category, units_sold, total_revenue, order_count
        FROM {top_products}
        ORDER BY total_revenue DESC NULLS LAST, product_id
    """,
    "funnel_analysis": """
        SELECT event_date, unique_sessions, product_views, cart_views, total_orders,
               product_to_cart_rate, cart_to_purchase_rate
        FROM {funnel_analysis}
        WHERE event_date >= date_sub(CAST(:as_of AS DATE), :days)
          AND last_day(make_date(CAST(year AS INT), CAST(month AS INT), 1)) >= date_sub(CAST(:as_of AS DATE), :days)
        ORDER BY event_date DESC
    """,
}


def run_report(
    spark: SparkSession, report: str, as_of: date | str, days: int = DAYS, n: int = TOP_CUSTOMERS, **marts: DataFrame
) -> DataFrame:
    """Run a report's SQL text over the given Gold DataFrames (named as the tables)."""
    text = REPORT_SQL[report]
    args = {name: value for name, value in {"as_of": str(as_of), "days": days, "n": n}.items() if f":{name}" in text}
    used = {name: df for name, df in marts.items() if "{" + name + "}" in text}
    return spark.sql(text, args=args or None, **used)
