"""marlstone: layered retail analytics on PySpark.

Every transform is a pure ``DataFrame -> DataFrame`` function that takes times
and paths as arguments; only ``sources``, ``sinks`` and the pipeline touch storage.
"""

from marlstone.functions.cleaning import add_date_parts, blank_to_null, drop_pii, normalise, safe_cast
from marlstone.operators.dedup import (
    audit_key_uniqueness,
    dedup_exact,
    dedup_latest,
    duplicate_report,
    split_rejects,
)
from marlstone.operators.metrics import RunSummary, summary_frame
from marlstone.operators.quality import (
    SUITES,
    QualityGateError,
    enforce,
    evaluate,
    foreign_keys,
    listing,
    load_suite,
    statistics,
    write_results,
)
from marlstone.operators.shop import (
    browse,
    category_list,
    consolidate_cart,
    order_detail,
    order_history,
    page_type_counts,
    price_orders,
    related_products,
    stock_position,
)
from marlstone.operators.windows import high_water_mark, incremental_window
from marlstone.plans.gold import customer_ltv, daily_sales, funnel, top_products
from marlstone.plans.pipeline import LakeConfig, dataframe_source, rebuild_table, run_pipeline
from marlstone.plans.reports import (
    report_customer_ltv,
    report_daily_revenue,
    report_funnel,
    report_top_products,
    run_report,
)
from marlstone.plans.silver import (
    silver_customers,
    silver_order_items,
    silver_orders,
    silver_page_views,
    silver_payments,
    silver_products,
)
from marlstone.session import build_session, tune
from marlstone.sinks.bronze import write_bronze
from marlstone.sinks.tables import merge_partitions, overwrite_table, register_table
from marlstone.sources.bronze import read_bronze, resolve_partition_date
from marlstone.sources.jdbc import jdbc_source, read_jdbc
from marlstone.sources.tables import read_table_or_path
from marlstone.sources.watermarks import get_watermark, put_watermark
from marlstone.streaming.bronze_stream import stream_bronze_to_silver
