"""Language identification: cosine to several centroids per language of normalised TF-IDF n-gram vectors.

Letters of the lower-cased text, words apart by one space, give character n-grams of 1 to 3,
hashed to ``DIMENSIONS`` counters; a vector is (1 + ln count) x idf, of length 1. Document frequencies
are counted over all documents to learn from. The centroids of a language are
found by spherical k-means (farthest-first start) over at most ``SAMPLE`` of its documents, those with
the smallest hash of their id. A text goes to the language of its nearest centroid; if it is
farther from that centroid than all but ``REJECTED`` of the centroid's own sample documents, it
is marked as rejected. The nearest language is named all the same.

Memory of a task and of the driver: languages x ``CENTROIDS`` x ``DIMENSIONS`` x 4 bytes, whatever the number of documents.

Defined results: null texts and texts without a letter get ``und``, score 0, rejected, and so does every text
where nothing could be learned; rows with a null id or null language are scored and not
learned from; repeated rows are scored each and count as often; ties go to the first
language by name; an empty table gives no rows. Texts are read whole, ``CHUNK`` characters at a time.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import staged

DIMENSIONS = 1 << 14
CHUNK = 1 << 20
#: Centroids per language; labelled documents of a language that these are fitted on, at most.
CENTROIDS, SAMPLE, ROUNDS = 4, 1000, 12
REJECTED = 0.01
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _mixed(code: np.ndarray) -> np.ndarray:
    code = (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return (code ^ (code >> np.uint32(13))) * np.uint32(0xC2B2AE35)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The counters that the n-grams of a text fall on, and how often they do."""
    counts, tail = None, np.full(1, 32, np.uint32)
    for at in range(0, len(text or ""), CHUNK):
        # One space at the end closes the last word; a chunk's last two symbols begin the next one's n-grams.
        piece = text[at : at + CHUNK].lower() + (" " if at + CHUNK >= len(text) else "")
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[points]
        kept = letter.copy()
        kept[1:] |= letter[:-1]
        kept[0] |= tail[-1] != 32
        points = np.concatenate((tail, np.where(letter, points, np.uint32(32))[kept]))
        new = len(tail)
        if len(points) == new:
            continue
        grams, codes = [], np.zeros(len(points), np.uint32)
        for n in (1, 2, 3):
            codes = codes[: len(points) - n + 1] * np.uint32(0x9E3779B1) + points[n - 1 :] + np.uint32(n)
            grams.append(_mixed(codes[max(new - n + 1, 0) :]) >> np.uint32(18))
        counted = np.bincount(np.concatenate(grams), minlength=DIMENSIONS)
        counts = counted if counts is None else counts + counted
        tail = points[-2:]
    if counts is None:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.flatnonzero(counts)
    return at, counts[at]


def vector(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The TF-IDF vector of a text, of length 1, as positions and values; no positions without a letter."""
    at, counts = gram_counts(text)
    values = (1 + np.log(counts)) * idf[at]
    return at, (values / max(np.sqrt(values @ values), 1e-300)).astype(np.float32)


def centroids_of(vectors: np.ndarray, most: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means over the rows of ``vectors``: unit centroids, and how near their members have to be."""
    centre = vectors.sum(axis=0)
    chosen = [int(np.argmax(vectors @ centre))]
    near = vectors @ vectors[chosen[0]]
    while len(chosen) < min(most, len(vectors)) and near.min() < 1 - 1e-6:
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    centroids = vectors[chosen]
    for _ in range(rounds):
        home = np.argmax(vectors @ centroids.T, axis=1)
        for k in range(len(centroids)):
            members = vectors[home == k]
            if len(members):
                total = members.sum(axis=0)
                centroids[k] = total / np.sqrt(total @ total)
    similar = vectors @ centroids.T
    home, best = np.argmax(similar, axis=1), similar.max(axis=1)
    reach = [np.quantile(best[home == k], REJECTED) if (home == k).any() else 2.0 for k in range(len(centroids))]
    return centroids, np.array(reach)


def held_out(doc_id: Column) -> Column:
    """Rows kept for evaluation: a fifth, by a checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """How many rows of ``texts`` (text) have a letter, and how many fall on each counter."""

    def count(batches):
        rows, found = 0, np.zeros(DIMENSIONS, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                at, _ = gram_counts(text.as_py())
                found[at] += 1
                rows += len(at) > 0
        at = np.append(np.flatnonzero(found), DIMENSIONS)  # the number of rows comes last
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(found[at[:-1]], rows))], ["position", "n"])

    per_task = texts.select("text").mapInArrow(count, "position long, n long")
    totals = per_task.groupBy("position").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(DIMENSIONS + 1, np.int64)
    found[totals["position"].to_numpy()] = totals["n"].to_numpy()
    return int(found[-1]), found[:-1]


def _sampled(labelled: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of each language, by the smallest hash of their id.

    A threshold from the language's number of rows leaves little more than those before anything is shuffled.
    """
    slot = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 31))
    sizes = labelled.groupBy("lang").count()  # as many rows as the model has languages
    near = labelled.join(F.broadcast(sizes), "lang").withColumn("slot", slot).where(
        F.col("slot") * F.col("count") <= F.lit(float(2 * most)) * (1 << 31) + F.lit(1 << 31) * 64.0
    )
    ranked = Window.partitionBy("lang").orderBy("slot", "doc_id", F.xxhash64("text"))
    return near.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= most).select("lang", "rank", "text")


def fit(labelled: DataFrame, idf: np.ndarray, most: int = SAMPLE, centroids: int = CENTROIDS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The language, direction (a column each) and reach of all centroids, from ``labelled`` (doc_id, lang, text)."""
    weights = labelled.sparkSession.sparkContext.broadcast(idf)

    def vectors(batches):
        for batch in batches:
            made = [vector(text.as_py(), weights.value) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("rank"), pa.array([at for at, _ in made], pa.list_(pa.int64())),
                 pa.array([values for _, values in made], pa.list_(pa.float32()))],
                ["lang", "rank", "at", "values"],
            )

    def cluster(group: pa.Table) -> pa.Table:
        group = group.sort_by("rank")
        dense = np.zeros((len(group), DIMENSIONS), np.float32)
        for row, (at, values) in enumerate(zip(group["at"], group["values"])):
            dense[row, at.values.to_numpy()] = values.values.to_numpy()
        dense = dense[dense.any(axis=1)]
        found, reach = centroids_of(dense, centroids) if len(dense) else (dense, np.empty(0))
        return pa.table({
            "lang": pa.array([group["lang"][0].as_py()] * len(found), pa.string()), "number": pa.array(range(len(found)), pa.int32()),
            "centroid": pa.array(list(found), pa.list_(pa.float32())), "reach": pa.array(reach, pa.float64()),
        })

    made = _sampled(labelled, most).mapInArrow(vectors, "lang string, rank int, at array<long>, values array<float>")
    found = made.groupBy("lang").applyInArrow(cluster, "lang string, number int, centroid array<float>, reach double")
    rows = found.toArrow().sort_by([("lang", "ascending"), ("number", "ascending")])
    directions = np.array([c.values.to_numpy() for c in rows["centroid"]], np.float32).reshape(-1, DIMENSIONS)
    return rows["lang"].to_pylist(), np.ascontiguousarray(directions.T), rows["reach"].to_numpy()


def identify(docs: DataFrame, most: int = SAMPLE, centroids: int = CENTROIDS) -> DataFrame:
    """Columns doc_id, held_out, lang_pred, score, rejected per row of ``docs`` (doc_id, text, lang).

    Learns from the rows that have an id, a text and a language and are not held out.
    """
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    known = F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    labelled = docs.where(known).select(doc_id, F.col("lang").cast("string").alias("lang"), "text")
    n, found = document_frequencies(labelled)
    idf = np.log((1 + n) / (1 + found)) + 1
    model = docs.sparkSession.sparkContext.broadcast((idf, *fit(labelled, idf, most, centroids)))

    def name(batches):
        idf, languages, directions, reach = model.value
        for batch in batches:
            named = []
            for text in batch.column("text"):
                at, values = vector(text.as_py(), idf)
                if not len(at) or not languages:
                    named.append((UNKNOWN, 0.0, True))
                    continue
                similar = values @ directions[at]
                best = int(similar.argmax())
                score = float(min(max(similar[best], 0.0), 1.0))
                named.append((languages[best], score, score < reach[best]))
            columns = zip(*named) if named else ((), (), ())
            kinds = (pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(list(c), kind) for c, kind in zip(columns, kinds)]],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(doc_id, "text").mapInArrow(name, "doc_id long, lang_pred string, score double, rejected boolean")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
