"""Session settings the library relies on, and where its staged tables may live."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings only, so they can be applied to a session someone else built.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys: split the oversized partition even if that costs a later shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rankings keep their first n rows per group before the shuffle for any n: see operators.dedup.
    "spark.sql.optimizer.windowGroupLimitThreshold": str((1 << 31) - 1),
    # Hot output partitions: see sinks.tables.balanced.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Short rows of a few numbers take ten times their shuffled size and more where a join sorts them.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
}

#: Shuffle bytes one task should handle before adaptive execution has seen any.
BYTES_PER_SHUFFLE_TASK = 32 * 1024 * 1024


def tune(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply ``SETTINGS`` to an existing session and return it.

    ``shuffle_bytes``, the expected size of the largest shuffle, raises the
    number of shuffle partitions to match. Adaptive execution merges partitions
    that turn out small but cannot add any, so err on the high side.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if shuffle_bytes is not None:
        wanted = -(-shuffle_bytes // BYTES_PER_SHUFFLE_TASK)
        current = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set("spark.sql.shuffle.partitions", str(max(current, wanted)))
    return spark


def build_session(app_name: str = "marlstone", master: str | None = None, **conf) -> SparkSession:
    """A session with ``SETTINGS``; ``master`` and extra settings are optional."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def staging_path(spark: SparkSession, fallback: str, label: str) -> str:
    """A fresh directory for a table written to cut lineage.

    The cluster's shared ``spark.checkpoint.dir`` is used when the session names
    one; otherwise ``fallback``, which callers place beside the table they are
    writing, hence on the same shared storage.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or fallback
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
