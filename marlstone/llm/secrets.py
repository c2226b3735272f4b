"""Secret scans over an incremental ledger of blobs.

Every version of a text is addressed by its content (SHA-256). The ledger is a
Parquet table of (blob, rule version, spans): a blob is scanned once per rule version,
whatever number of paths or runs it turns up in, and findings are joined back
from blobs to all paths. Copies are reduced to one row per task before texts are shuffled, so a
blob shared by very many paths is scanned once and gathers nowhere.

Defined results: a null text counts as empty; an empty text is a blob without
findings; repeated rows are paths of one blob, each with its row; an empty table gives no
rows; other columns are ignored. Spans count code points, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import staged
from marlstone.storage import scratch_path

#: Rule version -> kind -> (text that any match contains, pattern, group whose length counts, its least length).
#: Fixed patterns; a changed or added rule gets a new version, so that only it is scanned anew.
RULES: dict[int, dict[str, tuple[str, str, int, int]]] = {
    1: {
        "assign": ("", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        "access": ("AKIA", r"AKIA[A-Z0-9]+", 0, 18),
        "hex": ("", r"[0-9a-f]{16,}", 0, 16),
    },
    2: {
        "pem": ("-----BEGIN ", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----", 0, 1),
        "jwt": ("eyJ", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
        "github": ("gh", r"\bgh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    },
}
KINDS = [kind for rules in RULES.values() for kind in rules]
_SPAN = "struct<start: long, rank: int, end: long, kind: string>"
LEDGER = f"blob binary, rule_version int, spans array<{_SPAN}>"


def scanner(versions=RULES) -> Callable[[str, int], list[dict]]:
    """A function giving the spans of a text under a rule version."""
    compiled = {v: [(KINDS.index(kind), kind, need, re.compile(p), g, n) for kind, (need, p, g, n) in rules.items()]
                for v, rules in versions.items()}

    def scan(text: str, version: int) -> list[dict]:
        found = []
        for rank, kind, need, pattern, group, least in compiled[version]:
            if need not in text or kind == "assign" and ":" not in text and "=" not in text:
                continue
            for m in pattern.finditer(text):
                if m.end(group) - m.start(group) >= least:
                    found.append({"start": m.start(), "rank": rank, "end": m.end(), "kind": kind})
        return found

    return scan


def _blob(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def update_ledger(docs: DataFrame, path: str, versions=tuple(RULES)) -> None:
    """Scan what the ledger at ``path`` lacks of the texts of ``docs`` and the rule versions, and append it."""
    spark = docs.sparkSession
    blobs = docs.select(_blob(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["blob"])
    wanted = F.array(*map(F.lit, versions))
    ledger = read_ledger(spark, path)
    if ledger is None:
        unseen = blobs.withColumn("missing", wanted)
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule_version").alias("seen"))
        unseen = blobs.join(seen, "blob", "left").select(
            "blob", "text", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<int>"))).alias("missing")
        ).where(F.size("missing") > 0)
    span = pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("kind", pa.string())])
    schema = pa.schema([("blob", pa.binary()), ("rule_version", pa.int32()), ("spans", pa.list_(span))])

    def scan(batches):
        find = scanner()
        for batch in batches:
            rows = [
                {"blob": blob, "rule_version": version, "spans": find(text.as_py(), version)}
                for blob, text, missing in zip(batch.column("blob").to_pylist(), batch.column("text"), batch.column("missing").to_pylist())
                for version in missing
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    unseen.select("blob", "text", "missing").mapInArrow(scan, LEDGER).write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    return spark.read.schema(LEDGER).parquet(path)


def findings(docs: DataFrame, path: str, versions=tuple(RULES)) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, blob, spans in order; from the ledger alone."""
    found = read_ledger(docs.sparkSession, path).where(F.col("rule_version").isin(*versions) & (F.size("spans") > 0))
    per_blob = found.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    per_blob = staged(per_blob, "findings")  # from a table, the join can split the paths of a hot blob
    return docs.select("doc_id", _blob(F.col("text")).alias("blob")).join(per_blob, "blob", "left").select(
        "doc_id", "blob", F.coalesce("spans", F.array().cast(f"array<{_SPAN}>")).alias("spans")
    )


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def of_kinds(spans: Column, kinds) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def scan_secrets(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Bring the ledger at ``path`` (a new one by default) up to date and return ``findings``."""
    path = path or scratch_path(docs.sparkSession, "secret-ledger")
    update_ledger(docs, path)
    return findings(docs, path)
