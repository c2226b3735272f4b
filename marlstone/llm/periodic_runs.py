"""Periodic runs of words: recompression into a run-length grammar, exact extensions by grammar queries.

The words of a pack of texts, a separator of its own between any two, are numbered and
compressed level by level: block compression replaces every stretch of one symbol by one
symbol for (symbol, count); where no stretch is left, pair compression splits the symbols at
random into a left and a right half and replaces each left symbol followed by a right one.
Whether two neighbours are joined depends on these two symbols alone, so equal texts are
compressed alike up to one symbol at either end of a level, and a longest common
extension is found by climbing the levels while symbols agree and descending where they
stop doing so: a constant number of steps a level, for all queries of a pack at once.

A run of period q covers at least two neighbouring points of the grid 0, q, 2q, ... followed
by equal words, so the grid points of all periods, n log n of them, are all candidates
needed. Each is extended both ways by the grammar; a run found by several points or by
multiples of its period is kept once, with the smallest period.

Defined results: null, empty and blank texts have no run and keep their words (none); rows
are judged each by itself, repeated rows, equal and null ids included; an empty table gives
no rows. A text is one row and one task's work, at about 150 bytes of memory a word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run is at least this long, and at least this many times its period.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Texts are compressed together until they have this many words.
PACK_WORDS = 100_000
#: Grid points looked at together.
POINTS = 1 << 19


@dataclass
class Level:
    """Symbols, and how they were joined: ``parent`` of each, ``first`` symbol of each parent and the end."""

    symbols: np.ndarray
    blocks: bool
    parent: np.ndarray
    first: np.ndarray


def _pairs(symbols: np.ndarray, salt: int) -> np.ndarray:
    """Which symbols (but the last) are joined to the next: those of one half before one of the other."""
    mixed = (symbols.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    half = (mixed >> np.uint64(63)).astype(bool)
    rising, falling = half[1:] & ~half[:-1], half[:-1] & ~half[1:]
    return rising if rising.sum() >= falling.sum() else falling


def recompress(symbols: np.ndarray) -> list[Level]:
    """The levels of the grammar, from the text up to a single symbol, which is left out."""
    levels, salt = [], 0
    while len(symbols) > 1:
        joined = symbols[1:] == symbols[:-1]
        blocks = bool(joined.any())
        while not joined.any():
            salt += 1
            joined = _pairs(symbols, salt)
        heads = np.concatenate(([True], ~joined))
        first = np.append(np.flatnonzero(heads), len(symbols))
        levels.append(Level(symbols, blocks, np.cumsum(heads) - 1, first))
        size = np.diff(first)
        tail = size if blocks else np.where(size == 2, symbols[first[1:] - 1] + 1, 0)
        symbols = pd.factorize(symbols[first[:-1]].astype(np.int64) * (int(tail.max()) + 1) + tail)[0]
    return levels


def extensions(levels: list[Level], i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
    """Number of equal symbols from ``i`` and ``j`` on, forwards (step 1) or backwards (-1).

    ``i`` and ``j`` differ, and a symbol that occurs nowhere else ends the text at both sides.
    """
    a, b = i.astype(np.int64), j.astype(np.int64)
    reached = np.zeros(len(a), np.int64)  # the level on which a and b are known to differ
    live = np.arange(len(a))

    def rest(level: Level, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols left in the parent from ``at`` on, itself included, and whether that is all of it."""
        low, high = level.first[level.parent[at]], level.first[level.parent[at] + 1]
        return (high - at, at == low) if step > 0 else (at - low + 1, at == high - 1)

    for number, level in enumerate(levels):
        x, y = a[live], b[live]
        equal = level.symbols[x] == level.symbols[y]
        reached[live[~equal]] = number
        live, x, y = live[equal], x[equal], y[equal]
        if not len(live):
            break
        (x_rest, x_whole), (y_rest, y_whole) = rest(level, x), rest(level, y)
        inside = ~(x_whole & y_whole)
        # Joined pairs end after one symbol on both sides; blocks of unequal rests end the extension.
        taken = np.where(inside, np.minimum(x_rest, y_rest) if level.blocks else 1, 0) * step
        x, y = x + taken, y + taken
        a[live], b[live] = x, y
        ends = inside & (x_rest != y_rest) if level.blocks else np.zeros(len(live), bool)
        reached[live[ends]] = number
        live, x, y = live[~ends], x[~ends], y[~ends]
        a[live], b[live] = level.parent[x], level.parent[y]
    for number in range(int(reached.max(initial=0)) - 1, -1, -1):
        level, down = levels[number], np.flatnonzero(reached > number)
        first, x, y = level.first, a[down], b[down]
        size = np.minimum(first[x + 1] - first[x], first[y + 1] - first[y]) if level.blocks else 1
        x, y = (first[x], first[y]) if step > 0 else (first[x + 1] - 1, first[y + 1] - 1)
        taken = np.where(level.symbols[x] == level.symbols[y], size, 0) * step
        a[down], b[down] = x + taken, y + taken
    return (a - i) * step


def _grid(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least_periods: int):
    """Arrays (position, period) of grid points whose word recurs one and two periods later."""
    periods = sizes // least_periods
    text = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    points = (sizes[text] - 1) // period - 1  # those with two periods to follow
    upto = np.cumsum(points)
    at = 0
    while at < len(text):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + POINTS, "right")))
        each = points[at:end]
        q = np.repeat(period[at:end], each)
        nth = np.arange(len(q)) - np.repeat(np.cumsum(each) - each, each)
        here = np.repeat(starts[text[at:end]], each) + nth * q
        same = symbols[here] == symbols[here + q]
        here, q = here[same], q[same]
        same = symbols[here] == symbols[here + 2 * q]
        yield here[same], q[same]
        at = end


def find_in_pack(
    texts: list[list], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of a pack of word lists, as arrays text, start, length, period, by text, start and period."""
    if least_periods < 3:
        raise ValueError("runs are looked for from three periods on")
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + 1) - sizes  # a separator comes before each text, and one at the end
    symbols = np.empty(int(sizes.sum()) + len(texts) + 1, np.int64)
    numbers: dict = {}
    for start, words in zip(starts, texts):
        symbols[start : start + len(words)] = [numbers.setdefault(word, len(numbers)) for word in words]
    separators = np.append(starts - 1, len(symbols) - 1)
    symbols[separators] = len(numbers) + np.arange(len(separators))
    levels = recompress(symbols)
    found = [np.empty((0, 3), np.int64)]
    long_enough = np.where(sizes >= least_words, sizes, 0)
    for here, q in _grid(symbols, starts, long_enough, least_periods):
        if not len(here):
            continue
        before = extensions(levels, here - 1, here + q - 1, -1)
        length = before + extensions(levels, here, here + q, 1) + q
        long = length >= np.maximum(least_words, least_periods * q)
        if long.any():
            runs = np.stack([here[long] - before[long], length[long], q[long]], axis=1)
            found.append(np.unique(runs, axis=0))
    runs = np.unique(np.concatenate(found), axis=0)  # by start, length, period
    smallest = np.ones(len(runs), bool)
    smallest[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    start, length, period = runs[smallest].T
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    text = np.searchsorted(starts, start, "right") - 1
    return text, start - starts[text], length, period


def kept_words(words: list, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> list:
    """The words that no run contains after its first period."""
    if not len(start):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return [words[k] for k in np.flatnonzero(change.cumsum()[:-1] == 0)]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS_SCHEMA = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def find_runs(
    docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS, pack_words: int = PACK_WORDS
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): its runs by start and period, and the text without their repeats."""

    def report(ids: list, texts: list[list]) -> pa.RecordBatch:
        text, start, length, period = find_in_pack(texts, least_words, least_periods)
        edges = np.searchsorted(text, np.arange(len(texts) + 1))
        collapsed = [
            b" ".join(kept_words(words, start[low:high], length[low:high], period[low:high])).decode()
            for words, low, high in zip(texts, edges[:-1], edges[1:])
        ]
        runs = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], fields=list(_RUN))
        listed = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), runs)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), listed, pa.array(collapsed, pa.string())], ["doc_id", "runs", "collapsed"])

    def search(batches):
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = (text.as_py() or b"").split()  # of bytes: at ASCII white space only
                if ids and size + len(words) > pack_words:
                    yield report(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                size += len(words)
        if ids:
            yield report(ids, texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(search, RUNS_SCHEMA)
