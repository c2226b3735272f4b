"""Scalar expressions shared by marts, reports and shop jobs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL when the denominator is NULL or zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def days_between(later: Column, earlier: Column) -> Column:
    """Calendar days from ``earlier`` to ``later``; 0 if either is missing."""
    return F.coalesce(F.datediff(later, earlier), F.lit(0))


def sales_tax(amount: Column, rate: str) -> Column:
    """``rate`` of a decimal amount, rounded to cents half-to-even, in exact decimals."""
    return F.bround(amount * F.lit(rate).cast("decimal(6,4)"), 2).cast("decimal(18,2)")


def since(column: Column, as_of: date | str, days: int) -> Column:
    """True for dates from ``days`` before ``as_of`` onwards (that day included)."""
    return column >= F.date_sub(F.lit(str(as_of)).cast("date"), days)


def may_reach_since(levels: Sequence[str], as_of: date | str, days: int) -> Column:
    """True for partitions, named by year, month and perhaps day, that may hold dates for which ``since`` is true.

    It says nothing ``since`` does not, but concerns directory levels alone, so others are not opened.
    """
    parts = [F.col(level).cast("int") for level in levels]
    last = F.make_date(*parts) if len(parts) == 3 else F.last_day(F.make_date(*parts, F.lit(1)))
    return since(last, as_of, days)


def utc_text(value: datetime | str) -> str:
    """Date and time in UTC with microseconds. Text and naive datetimes are read as UTC."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc)
    return value.strftime("%Y-%m-%d %H:%M:%S.%f")


def instant(value: datetime | str, like: str = "timestamp") -> Column:
    """A timestamp literal. Text and naive datetimes are read as UTC.

    ``like`` is the type of the column it will be compared with: matching it
    keeps the comparison free of casts, so it can still reach the scan.
    """
    text = utc_text(value)
    if like == "timestamp_ntz":
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(text + "+00:00").cast("timestamp")


def page_type(path: Column) -> Column:
    """Kind of shop page a logged path shows, its query string ignored."""
    bare = bare_path(path)
    return (
        F.when(bare == "/", "home")
        .when(bare.startswith("/products/"), "product")
        .when(bare.isin("/cart", "/checkout", "/orders", "/login", "/register"), F.substr(bare, F.lit(2)))
        .when(bare.startswith("/orders/"), "order")
        .otherwise("other")
    )


def bare_path(path: Column) -> Column:
    """The path up to its query string."""
    return F.substring_index(path, "?", 1)


def page_product(path: Column) -> Column:
    """The product id of a product page, else NULL."""
    return F.regexp_extract(bare_path(path), r"^/products/(\d+)$", 1).try_cast("bigint")


def page_category(path: Column) -> Column:
    """The category a home-page view was filtered on, else NULL."""
    return F.nullif(F.regexp_extract(path, r"^/\?(?:.*&)?category=([^&]*)", 1), F.lit(""))
