"""Benchmark decontamination over a distributed positional inverted index.

The training documents are cut into shards, each a few million words of whole
documents from one input partition. A shard's index is one row: for every term
that the test items use, the ascending positions at which it stands in the shard.
The positions of a window's terms, each moved back by the term's offset in the
window, are intersected shard by shard, rarest term first, for all windows at
once. What remains are the places where the whole phrase stands; terms that only
lie near the rarest one, in any order, are proximity matches.

No posting is ever shuffled: a shard is searched where it is stored, and a hot
term or passage only adds positions to its own shards. The test items are taken in blocks of
bounded size, each sent to all tasks, so any number of items passes through.

Defined results: a null or empty text has no words, cannot be hit and as an item
has no window; repeated documents are rows of their own; repeated item ids count once,
with all their texts' windows; null item ids are left out; an empty table on either side
gives documents without hits; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import staged

WINDOW = 10
#: A proximity match has every term of the window at most this far from its rarest term.
NEAR = 12
#: Words after which a shard is closed.
SHARD_WORDS = 2_000_000
#: Text of test items that one pass sends to every task.
BLOCK_BYTES = 8 << 20

POSITION_BITS = 31
_SPACE = np.arange(256, dtype=np.uint8)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    _SPACE[_low : _high + 1] = 0x20
_SPACE[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
#: ASCII letters lower-cased, digits and all bytes of other characters kept, the rest blank.
TO_WORDS = _SPACE.tobytes()


def word_list(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TO_WORDS).split()


class Windows:
    """The distinct windows of a block of test items, as term numbers."""

    def __init__(self, items: list[tuple[int, str | None]], window: int = WINDOW):
        self.terms: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        for item_id, text in items:
            found = [self.terms.setdefault(word, len(self.terms)) for word in word_list(text)]
            for at in range(max(1, len(found) - window + 1) if found else 0):
                owners.setdefault(tuple(found[at : at + window]), set()).add(item_id)
        self.lengths = np.array([len(w) for w in owners], np.int64)
        self.table = np.zeros((len(owners), window), np.int64)
        for row, terms in zip(self.table, owners):
            row[: len(terms)] = terms
        self.owners = [sorted(ids) for ids in owners.values()]


def postings(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms, number of positions of each, and the positions, term after term. Negative ids are other words."""
    at = np.flatnonzero(ids >= 0)
    keys = (ids[at].astype(np.int64) << POSITION_BITS) | at
    keys.sort()
    terms, counts = np.unique(keys >> POSITION_BITS, return_counts=True)
    return terms.astype(np.int32), counts.astype(np.int32), (keys & ((1 << POSITION_BITS) - 1)).astype(np.int32)


def search(windows: Windows, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, near: int = NEAR):
    """Windows and starts of all phrase matches, and windows and places of the other proximity matches."""
    frequency = np.zeros(max(len(windows.terms), 1), np.int64)
    frequency[terms] = counts
    first = np.zeros(len(frequency), np.int64)
    first[terms] = np.cumsum(counts) - counts
    keys = (np.repeat(terms.astype(np.int64), counts) << POSITION_BITS) | positions
    nothing = np.zeros(0, np.int64)
    if not len(windows.lengths) or not len(keys):
        return nothing, nothing, nothing, nothing
    column = np.arange(windows.table.shape[1])
    rarity = np.where(column < windows.lengths[:, None], frequency[windows.table], np.iinfo(np.int64).max)
    order = np.argsort(rarity, axis=1, kind="stable")
    rows = np.arange(len(order))
    rarest = windows.table[rows, order[:, 0]]
    many = np.where(rarity[rows, order[:, 0]] > 0, frequency[rarest], 0)

    def listed(chosen: np.ndarray):
        """Each chosen window with every position of its rarest term."""
        n = many[chosen]
        window = np.repeat(chosen, n)
        place = positions[np.repeat(first[rarest[chosen]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        return window, place.astype(np.int64)

    def stands(term, low, high):
        found = np.searchsorted(keys, (term << POSITION_BITS) | np.maximum(low, 0))
        found = keys[np.minimum(found, len(keys) - 1)]
        return (found >= ((term << POSITION_BITS) | np.maximum(low, 0))) & (found <= ((term << POSITION_BITS) | high)) & (high >= 0)

    exact, loose = [], []
    live = np.flatnonzero(many)
    for part in np.array_split(live, max(1, int(many[live].sum() // 2_000_000))):
        window, place = listed(part)
        near_window, near_place = window, place
        start = place - order[window, 0]
        window, start = window[start >= 0], start[start >= 0]
        for rank in range(1, windows.table.shape[1]):
            offset = order[window, rank]
            at = start + offset
            ok = (rank >= windows.lengths[window]) | stands(windows.table[window, offset], at, at)
            window, start = window[ok], start[ok]
            ok = (rank >= windows.lengths[near_window]) | stands(
                windows.table[near_window, order[near_window, rank]], near_place - near, near_place + near
            )
            near_window, near_place = near_window[ok], near_place[ok]
        exact.append((window, start))
        loose.append((near_window, near_place))
    together = [np.concatenate(x) for side in (exact, loose) for x in zip(*side)] if exact else [nothing] * 4
    return tuple(together)


_INDEX = (
    "row array<long>, doc_id array<long>, text_key array<long>, starts array<long>, lengths array<long>, "
    "terms array<int>, counts array<int>, positions binary"
)


def build_index(docs: DataFrame, vocabulary, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per shard of ``docs`` (row, doc_id, text_key, text); ``vocabulary`` broadcasts the terms' numbers."""
    schema = pa.schema([
        *[(name, pa.list_(pa.int64())) for name in ("row", "doc_id", "text_key", "starts", "lengths")],
        ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("positions", pa.binary()),
    ])

    def index(batches):
        terms = vocabulary.value
        gap = np.full(2 * NEAR + WINDOW, -1, np.int64)  # no match runs from one document into the next
        kept, parts, held = [], [], 0

        def closed():
            found, counts, positions = postings(np.concatenate([x for part in parts for x in (part, gap)]))
            lengths = [len(part) for part in parts]
            starts = np.cumsum([0, *lengths[:-1]]) + np.arange(len(parts)) * len(gap)
            lists = [*map(list, zip(*kept)), starts, lengths, found, counts]
            return pa.RecordBatch.from_arrays(
                [*[pa.array([x], kind) for x, kind in zip(lists, schema.types)], pa.array([positions.astype("<i4").tobytes()])],
                schema=schema,
            )

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                words = word_list(row[-1])
                kept.append(row[:-1])
                parts.append(np.fromiter(map(terms.get, words, repeat(-1)), np.int64, len(words)))
                held += len(words) + len(gap)
                if held >= shard_words:
                    yield closed()
                    kept, parts, held = [], [], 0
        if kept:
            yield closed()

    return docs.select("row", "doc_id", "text_key", "text").mapInArrow(index, _INDEX)


def merged_stretches(stretches: list[int]) -> list[int]:
    """Begin, end, begin, end, ... of the union of stretches given the same way, in any order."""
    out: list[int] = []
    for begin, end in sorted(zip(stretches[::2], stretches[1::2])):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [begin, end]
    return out


_FOUND = (
    "row long, doc_id long, text_key long, n_words long, n_hit long, hits array<long>, items array<long>, near_items array<long>"
)
_FOUND_ARROW = pa.schema([
    *[(name, pa.int64()) for name in ("row", "doc_id", "text_key", "n_words", "n_hit")],
    *[(name, pa.list_(pa.int64())) for name in ("hits", "items", "near_items")],
])


def search_index(index: DataFrame, block) -> DataFrame:
    """What the windows of a block (a broadcast) find in each document of an index."""

    def found_in(shard: dict, windows: Windows):
        starts = np.array(shard["starts"], np.int64)
        window, at, near_window, near_at = search(
            windows, np.array(shard["terms"], np.int64), np.array(shard["counts"], np.int64),
            np.frombuffer(shard["positions"], "<i4"),
        )
        hits: dict[int, list[int]] = {}
        for doc, begin, length in zip(
            (docs := np.searchsorted(starts, at, "right") - 1).tolist(), (at - starts[docs]).tolist(), windows.lengths[window].tolist()
        ):
            hits.setdefault(doc, []).extend((begin, begin + length))
        owned: list[dict[int, set[int]]] = []
        for places, of in ((at, window), (near_at, near_window)):
            owned.append({})
            pairs = np.stack([np.searchsorted(starts, places, "right") - 1, of], axis=1)
            for doc, k in np.unique(pairs, axis=0).tolist():
                owned[-1].setdefault(doc, set()).update(windows.owners[k])
        return {doc: merged_stretches(x) for doc, x in hits.items()}, *owned

    def look(batches):
        windows = block.value
        for batch in batches:
            for shard in batch.to_pylist():
                hits, items, near = found_in(shard, windows)
                n = len(shard["row"])
                stretches = [hits.get(d, []) for d in range(n)]
                columns = [
                    shard["row"], shard["doc_id"], shard["text_key"], shard["lengths"],
                    [sum(x[1::2]) - sum(x[::2]) for x in stretches], stretches,
                    [sorted(items.get(d, ())) for d in range(n)], [sorted(near.get(d, ())) for d in range(n)],
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(columns, _FOUND_ARROW.types)], schema=_FOUND_ARROW
                )

    return index.mapInArrow(look, _FOUND)


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[int, Iterator[list[tuple[int, str]]]]:
    """How many blocks the test items make, and the blocks; each is meant to hold ``block_bytes`` of text."""
    sized = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text")
    total = sized.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return n, ([tuple(row) for row in sized.where(part == k).distinct().collect()] for k in range(n))


def _joined(found: DataFrame) -> DataFrame:
    """One row per document from what each block found in it."""
    lists = found.groupBy("row").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "text_key", "n_words")], F.lit(0).cast("long").alias("n_hit"),
        *[F.flatten(F.collect_list(c)).alias(c) for c in ("hits", "items", "near_items")],
    )

    def merge(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                row["hits"] = merged_stretches(row["hits"])
                row["n_hit"] = sum(row["hits"][1::2]) - sum(row["hits"][::2])
                row |= {c: sorted(set(row[c])) for c in ("items", "near_items")}
            yield pa.RecordBatch.from_pylist(rows, schema=_FOUND_ARROW)

    return lists.mapInArrow(merge, _FOUND)


def decontaminate(
    docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS, window: int = WINDOW
) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key (xxhash64 of the text), n_words, n_hit, hits, items, near_items.

    ``hits`` are the stretches of words inside any phrase match, begin and end
    (exclusive) in turn; ``items`` the items with an exact match, ``near_items``
    those with a proximity match, which an exact match is as well.
    """
    spark = docs.sparkSession
    n, blocks = item_blocks(items, block_bytes)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    if n > 1:  # each block has to meet the same numbered rows
        rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    else:
        rows = rows.withColumn("row", F.lit(0).cast("long"))
    found = []
    for block in blocks:
        windows = Windows(block, window)
        index = staged(build_index(rows, spark.sparkContext.broadcast(windows.terms), shard_words), "postings")
        found.append(search_index(index, spark.sparkContext.broadcast(windows)))
    result = found[0] if n == 1 else _joined(reduce(DataFrame.unionByName, found))
    return result.drop("row")


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs``, all columns, without the rows in which a phrase match was found."""
    found = decontaminate(docs, items).where("n_hit > 0").select(
        F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")
    ).distinct()
    return docs.join(
        found, docs["doc_id"].eqNullSafe(found["hit_id"]) & (F.xxhash64(docs["text"]) == found["hit_key"]), "left_anti"
    )
