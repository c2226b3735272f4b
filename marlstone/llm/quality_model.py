"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of every whole text are computed once and stored. The trees are
grown, level by level from histograms of gradients over quantile bins, on at most
``TRAIN_ROWS`` labelled rows: those with the smallest hashes of their id, so the
same rows each time. All trees have the same depth and are kept as flat arrays, node k's
children at 2k+1 and 2k+2, so a batch of documents walks all trees at once in numpy.

Defined results: a null or empty text has all statistics 0 and gets a score like
any other; without usable labels, or with one class only, every score is the smoothed
share of label 1; repeated rows are scored each; rows whose labels repeat count as
often; a null id is scored and never used for training; an empty table gives no rows.
Labels, language, source and id are no inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import staged

#: Bound of the labelled rows that are sent to the driver for training.
TRAIN_ROWS = 40_000
TREES, DEPTH, BINS, RATE, RIDGE = 80, 4, 64, 0.15, 1.0
#: Scores of texts are computed for this many at once.
SCORED_AT_ONCE = 4096

FEATURES = (
    "log_words", "log_chars", "word_length", "distinct_words", "top_word", "repeated_windows", "symbols", "digits", "capitals",
    "stops", "commas", "beyond_ascii", "log_lines", "words_per_line", "repeated_lines", "longest_word",
)
_SYMBOLS, _DIGITS = b"#*$%&|<>", b"0123456789"
_CAPITALS, _STOPS, _COMMAS = bytes(range(65, 91)), b".!?", b",;:"


def statistics(text: str | None) -> tuple[float, ...]:
    words = (text or "").split()
    if not words:
        return (0.0,) * len(FEATURES)
    n, raw = len(words), text.encode()

    def count(of: bytes) -> int:
        return len(raw) - len(raw.translate(None, of))

    hashes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    _, each = np.unique(hashes, return_counts=True)
    repeated = 0.0
    if n > 2:
        m = np.uint64(0x9E3779B97F4A7C15)
        _, windows = np.unique((hashes[:-2] * m + hashes[1:-1]) * m + hashes[2:], return_counts=True)
        repeated = windows[windows > 1].sum() / (n - 2)
    lines = [line for line in text.split("\n") if line.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    chars = int(lengths.sum())
    return (
        np.log(n), np.log(chars), chars / n, len(each) / n, each.max() / n, repeated, count(_SYMBOLS) / n, count(_DIGITS) / n,
        count(_CAPITALS) / n, count(_STOPS) / n, count(_COMMAS) / n, (len(raw) - len(text)) / len(raw), np.log(len(lines)),
        n / len(lines), 1 - len(set(lines)) / len(lines), np.log(lengths.max()),
    )


def document_statistics(docs: DataFrame) -> DataFrame:
    """Columns doc_id, x (array of ``FEATURES``) per row of ``docs`` (doc_id, text)."""
    def measure(batches):
        for batch in batches:
            x = [statistics(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(measure, "doc_id long, x array<double>")


@dataclass
class Trees:
    """Flat trees: ``feature`` and ``threshold`` by tree and inner node, ``leaf`` by tree and leaf."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        trees = np.arange(len(self.leaf))
        inner = self.feature.shape[1] if len(self.leaf) else 0
        for at in range(0, len(x), SCORED_AT_ONCE):
            part = x[at : at + SCORED_AT_ONCE]
            node = np.zeros((len(part), len(trees)), np.int64)
            rows = np.arange(len(part))[:, None]
            while len(trees) and node[0, 0] < inner:
                node = 2 * node + 1 + (part[rows, self.feature[trees, node]] > self.threshold[trees, node])
            out[at : at + SCORED_AT_ONCE] = self.base + self.leaf[trees, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-out))


def fit(x: np.ndarray, y: np.ndarray, trees=TREES, depth=DEPTH, bins=BINS, rate=RATE, ridge=RIDGE) -> Trees:
    """Boosted trees for the logistic loss."""
    inner, n_features = (1 << depth) - 1, x.shape[1]
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return Trees(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T)])  # value > edge k: bin above k
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    raw = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        gradient, weight = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            best = np.full(width, 1e-9)
            at = node - first
            for f in range(n_features):
                cell = at * bins + binned[f]
                g = np.bincount(cell, gradient, width * bins).reshape(width, bins).cumsum(axis=1)
                h = np.bincount(cell, weight, width * bins).reshape(width, bins).cumsum(axis=1)
                total_g, total_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (total_g - g) ** 2 / (total_h - h + ridge) - total_g**2 / (total_h + ridge)
                gain = gain[:, : len(edges[f])]
                if not gain.shape[1]:
                    continue
                cut = gain.argmax(axis=1)
                better = gain[np.arange(width), cut] > best
                best[better] = gain[np.arange(width), cut][better]
                feature[t, first : first + width][better] = f
                threshold[t, first : first + width][better] = edges[f][cut[better]]
            chosen = feature[t, node]
            node = 2 * node + 1 + (x[np.arange(len(x)), chosen] > threshold[t, node])
        ends = node - inner
        g, h = np.bincount(ends, gradient, inner + 1), np.bincount(ends, weight, inner + 1)
        leaf[t] = -rate * g / (h + ridge)
        raw += leaf[t, ends]
    return Trees(base, feature, threshold, leaf)


def held_out(doc_id: Column) -> Column:
    """Rows kept for evaluation: a quarter, by a checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(measured: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Trees:
    """Trees fitted on at most ``most`` rows of ``labels`` (doc_id, quality) that are not held out."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    slot = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 31))
    # Of hashes, spread evenly, a limit leaves about twice the wanted rows, so what the tasks send does not grow with
    # their number. Where few ids make up most labels it is raised until it leaves enough.
    n, share = usable.count(), 2 * most + 64
    while True:
        least = usable.withColumn("slot", slot).where(F.col("slot") * F.lit(float(n)) <= F.lit(float(share)) * (1 << 31))
        if share >= n or least.count() >= most:
            break
        share *= 8
    chosen = least.join(measured, "doc_id").orderBy("slot", "doc_id", "quality").limit(most).select("x", "quality").toArrow()
    x = np.array(chosen["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, chosen["quality"].to_numpy().astype(float))


def score(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """Columns doc_id, held_out, score per row of ``docs``."""
    measured = staged(document_statistics(docs), "statistics")
    model = docs.sparkSession.sparkContext.broadcast(train(measured, labels, most))

    def rate(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.value.scores(x))], names=["doc_id", "score"])

    scored = measured.mapInArrow(rate, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")
