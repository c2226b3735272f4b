"""Bronze to Silver: one recipe, driven by ``schemas.TABLES``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marlstone.functions.cleaning import add_date_parts, blank_to_null, drop_pii, normalise, safe_cast
from marlstone.operators.dedup import dedup_latest, split_rejects
from marlstone.schemas import TABLES, TableSpec


def typed_rows(raw: DataFrame, spec: TableSpec, wide_keys: bool = False) -> DataFrame:
    """Cast, normalise and null-standardise; one output row per raw row."""
    df = safe_cast(drop_pii(raw, spec.drop), spec.silver_schema(wide_keys))
    df = normalise(df, lower=spec.lower, trim=spec.trim)
    return blank_to_null(df, spec.blank_null)


def silver(raw: DataFrame, spec: TableSpec, wide_keys: bool = False) -> DataFrame:
    """The Silver rows of ``raw``: typed, newest per key, partition columns added.

    Rows without a usable key are left out; ``silver_rejects`` returns them.
    Exact duplicates need no pass of their own: they share a key, so keeping one
    row per key already removes them.
    """
    rows, _ = split_rejects(typed_rows(raw, spec, wide_keys), spec.keys)
    return add_date_parts(dedup_latest(rows, spec.keys, spec.newest_by), "created_at", spec.partition_by)


def silver_rejects(raw: DataFrame, spec: TableSpec, wide_keys: bool = False) -> DataFrame:
    """Rows whose key is missing or does not parse, as typed, with the reason."""
    return split_rejects(typed_rows(raw, spec, wide_keys), spec.keys)[1]


def silver_customers(raw: DataFrame) -> DataFrame:
    return silver(raw, TABLES["customers"])


def silver_orders(raw: DataFrame) -> DataFrame:
    return silver(raw, TABLES["orders"])


def silver_payments(raw: DataFrame) -> DataFrame:
    return silver(raw, TABLES["payments"])


def silver_products(raw: DataFrame) -> DataFrame:
    return silver(raw, TABLES["products"])


def silver_order_items(raw: DataFrame) -> DataFrame:
    return silver(raw, TABLES["order_items"])


def silver_page_views(raw: DataFrame) -> DataFrame:
    return silver(raw, TABLES["page_views"])
