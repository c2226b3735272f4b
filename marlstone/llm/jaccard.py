"""N-gram Jaccard join: documents whose shingle sets have a similarity of 0.8 or more, as connected classes.

1. Screen. A document can only have a partner if ``part``/``whole`` of its shingles
   occur in some other set. Shingle hashes are counted in packed blocks of a
   few thousand documents, dealt out by hash range; a hash goes out once per
   block, however many documents have it. Equal sets count as one.
2. Candidates. Of the sets that pass, only the rarest shingles (the prefix that
   any partner must share one of) are exchanged, and every shingle hangs its sets
   on the smallest: a star, not all pairs. Connected stars are a candidate group; all
   links lie inside one. "Rarest" follows a count sketch of fixed size, which
   only has to give all sets the same order.
3. Signature trees (``signature_tree``) join each group exactly. A group beyond
   ``CHUNK_SETS`` is cut by size class and id; chunks are joined alone, then the
   representatives of their classes, then those pairs of chunks that are not yet one class.

Shingle hashes have 64 bits; comparisons are exact on them. A set is named by a
digest of 64 bits.

Defined results: a null text counts as empty; a text without words has no
shingles, is linked with nothing and is its own component; a null id takes part but
never names a component that has another id; components without any id, or that share
their smallest id, have the same name but are different ones, told apart by ``root``; repeated rows are equal sets, each
with its row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import staged
from marlstone.llm.components import components
from marlstone.llm.signature_tree import link

WORDS = 5
PART, WHOLE = 80, 100

#: A block is closed at this many sets or shingles.
BLOCK_SETS, BLOCK_SHINGLES = 30_000, 3_000_000
#: Sets that one signature tree holds.
CHUNK_SETS = 2048
#: Size of the filter of passing sets, in bits, and of the count sketch: both are sent to every task.
FILTER_BITS = 1 << 25
SKETCH_COUNTERS = 1 << 20
_CACHED_WORDS = 1_000_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """Texts to sorted arrays of distinct shingle hashes."""

    def __init__(self, words: int = WORDS):
        self.words, self.known = words, _Hashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()  # bytes: only A-Z, only ASCII white space
        if len(self.known) > _CACHED_WORDS:
            self.known.clear()
        hashes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        width = min(self.words, len(words))
        if not width:
            return hashes
        n = len(words) - width + 1
        x = np.full(n, width, np.uint64)
        for k in range(width):
            x = x * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        return np.unique(x)


def set_name(shingles: np.ndarray) -> int:
    digest = hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


# --- 1. screen ---------------------------------------------------------------

_BLOCK = pa.schema([
    ("bucket", pa.int32()), ("block", pa.int64()), ("hashes", pa.binary()), ("owners", pa.binary()), ("names", pa.binary()),
    ("doc_id", pa.list_(pa.int64())), ("text_key", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())),
    ("set_of", pa.list_(pa.int64())), ("credit", pa.binary()),
])
_BLOCK_SQL = (
    "bucket int, block long, hashes binary, owners binary, names binary, doc_id array<long>, text_key array<long>, "
    "n array<long>, set_of array<long>, credit binary"
)
_SHARED = np.uint16(0xFFFF)  # in place of an owner: the block alone has two sets with this hash


def _blocks(docs: DataFrame, words: int, bucket_bits: int) -> DataFrame:
    def pack(batches):
        shingler, serial = Shingler(words), 0
        rows, sets, held = [], {}, 0

        def closed():
            block = ((TaskContext.get().partitionId() if TaskContext.get() else 0) << 32) + serial
            names = np.array(list(sets), np.int64)
            arrays = [s for _, s in sets.values()]
            number = {name: k for k, name in enumerate(sets)}
            hashes = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
            owners = np.repeat(np.arange(len(arrays), dtype=np.uint16), [len(s) for s in arrays])
            order = np.argsort(hashes)
            hashes, owners = hashes[order], owners[order]
            first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
            count = np.diff(np.append(first, len(hashes)))
            credit = np.bincount(owners[np.repeat(count > 1, count)], minlength=len(arrays)).astype("<u4")
            hashes, owners = hashes[first], np.where(count > 1, _SHARED, owners[first])
            shift = np.uint64(64 - bucket_bits)
            bucket = (hashes >> shift).astype(np.int64) if bucket_bits else np.zeros(len(hashes), np.int64)
            cuts = np.searchsorted(bucket, np.arange((1 << bucket_bits) + 1))
            low = ((hashes << np.uint64(bucket_bits)) >> np.uint64(32)).astype("<u4")
            for k in range(1 << bucket_bits):
                begin, end = cuts[k], cuts[k + 1]
                if begin == end:
                    continue
                own = owners[begin:end]
                used = np.unique(own[own != _SHARED])
                renumbered = np.where(own == _SHARED, _SHARED, np.searchsorted(used, own)).astype("<u2")
                yield _row(bucket=k, block=block, hashes=low[begin:end].tobytes(), owners=renumbered.tobytes(),
                           names=names[used].astype("<i8").tobytes() + used.astype("<u2").tobytes())
            ids, keys, sizes, of = zip(*rows)
            yield _row(bucket=block % (1 << bucket_bits), block=block, doc_id=list(ids), text_key=list(keys), n=list(sizes),
                       set_of=[-1 if x is None else number[x] for x in of], credit=credit.tobytes(),
                       names=names.astype("<i8").tobytes())

        for batch in batches:
            for doc_id, key, text in zip(*(column.to_pylist() for column in batch.columns)):
                shingles = shingler(text)
                name = set_name(shingles) if len(shingles) else None
                if name is not None and name not in sets:
                    sets[name] = (len(sets), shingles)
                    held += len(shingles)
                rows.append((doc_id, key, len(shingles), name))
                if held >= BLOCK_SHINGLES or len(sets) >= BLOCK_SETS or len(rows) >= 4 * BLOCK_SETS:
                    yield from closed()
                    rows, sets, held, serial = [], {}, 0, serial + 1
        if rows:
            yield from closed()

    return docs.mapInArrow(pack, _BLOCK_SQL)


def _row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{name: values.get(name) for name in _BLOCK.names}], schema=_BLOCK)


def _credited(bucket: pa.Table) -> pa.Table:
    """Per block, how many hashes of this bucket each of its sets shares with another set; headers pass through."""
    rows = bucket.to_pylist()
    out = [row for row in rows if row["doc_id"] is not None]
    packed = [row for row in rows if row["doc_id"] is None]
    if packed:
        hashes = [np.frombuffer(row["hashes"], "<u4") for row in packed]
        owners = [np.frombuffer(row["owners"], "<u2") for row in packed]
        n_sets = [len(row["names"]) // 10 for row in packed]
        names = [np.append(np.frombuffer(row["names"][: 8 * n], "<i8"), 0) for row, n in zip(packed, n_sets)]
        base = np.concatenate([[0], np.cumsum(n_sets)])
        alone = np.concatenate(owners) != _SHARED
        who = np.concatenate([np.minimum(o, n).astype(np.int64) + b for o, n, b in zip(owners, n_sets, base)])
        name = np.concatenate([x[np.minimum(o, n)] for x, o, n in zip(names, owners, n_sets)])
        h = np.concatenate(hashes)
        order = np.argsort(h)
        h, alone, who, name = h[order], alone[order], who[order], name[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        shared = np.minimum.reduceat(name, first) != np.maximum.reduceat(name, first)
        shared |= ~np.logical_and.reduceat(alone, first)
        mine = np.repeat(shared, np.diff(np.append(first, len(h)))) & alone
        credit = np.bincount(who[mine], minlength=base[-1] + 1)
        for row, n, b in zip(packed, n_sets, base):
            used = row["names"][8 * n :]
            out.append({"block": row["block"], "owners": used, "credit": credit[b : b + n].astype("<u4").tobytes()})
    return pa.Table.from_pylist([{name: row.get(name) for name in _BLOCK.names} for row in out], schema=_BLOCK)


_SCREENED = "doc_id long, text_key long, n long, sid long, shared long"


def _screened(block: pa.Table) -> pa.Table:
    header, credit = None, None
    for row in block.select(["doc_id", "text_key", "n", "set_of", "credit", "names"]).to_pylist():
        if row["doc_id"] is not None:
            header, credit = row, np.frombuffer(row["credit"], "<u4").astype(np.int64)
    for used, more in zip(block["owners"].to_pylist(), block["credit"].to_pylist()):
        if used is not None:
            np.add.at(credit, np.frombuffer(used, "<u2"), np.frombuffer(more, "<u4"))
    names, of = np.frombuffer(header["names"], "<i8").tolist(), header["set_of"]
    shared = credit.tolist()
    return pa.table({
        "doc_id": pa.array(header["doc_id"], pa.int64()), "text_key": pa.array(header["text_key"], pa.int64()),
        "n": pa.array(header["n"], pa.int64()), "sid": pa.array([names[k] if k >= 0 else None for k in of], pa.int64()),
        "shared": pa.array([shared[k] if k >= 0 else 0 for k in of], pa.int64()),
    })


def screen(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row: doc_id, text_key, n (shingles), sid (name of its set), shared (shingles that some other set has too)."""
    bits = max(0, math.ceil(math.log2(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    credits = _blocks(picked, words, bits).groupBy("bucket").applyInArrow(lambda t: _credited(t), _BLOCK_SQL)
    return credits.groupBy("block").applyInArrow(lambda t: _screened(t), _SCREENED)


# --- 2. candidates -----------------------------------------------------------

def _summed(df: DataFrame, make, size: int, kind: str, combine) -> np.ndarray:
    """An array of fixed ``size`` that ``make`` fills per task, combined slice by slice, then sent to the driver."""
    step = 1 << 16

    def parts(batches):
        total = np.zeros(size, kind)
        for batch in batches:
            make(total, batch)
        for k, at in enumerate(range(0, size, step)):
            piece = total[at : at + step]
            if piece.any():
                yield pa.RecordBatch.from_pydict({"k": pa.array([k], pa.int32()), "piece": pa.array([piece.tobytes()], pa.binary())})

    def merged(table: pa.Table) -> pa.Table:
        pieces = [np.frombuffer(x, kind) for x in table["piece"].to_pylist()]
        return pa.table({"k": table["k"].slice(0, 1), "piece": pa.array([combine.reduce(pieces, axis=0).astype(kind).tobytes()], pa.binary())})

    out = np.zeros(size, kind)
    for row in df.mapInArrow(parts, "k int, piece binary").groupBy("k").applyInArrow(merged, "k int, piece binary").collect():
        out[row.k * step : (row.k + 1) * step] = np.frombuffer(row.piece, kind)
    return out


def _filter_places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    x = keys.astype(np.int64).view(np.uint64)
    return [((x * np.uint64(m)) >> np.uint64(20)) % np.uint64(bits) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def passing_sets(docs: DataFrame, screened: DataFrame, words: int, part: int, whole: int) -> DataFrame:
    """Columns sid, n, hashes (packed) of each distinct set that may have a partner."""
    spark = docs.sparkSession
    keys = (
        screened.where((F.col("n") > 0) & (whole * F.col("shared") >= part * F.col("n")))
        .groupBy("sid").agg(F.min("text_key").alias("text_key"))
    )
    keys = staged(keys, "passing")

    def note(total, batch):
        for place in _filter_places(batch.column("text_key").to_numpy(), FILTER_BITS):
            np.bitwise_or.at(total, (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))

    wanted = spark.sparkContext.broadcast(_summed(keys.select("text_key"), note, FILTER_BITS // 8, "u1", np.bitwise_or))

    def sets(batches):
        shingler, bits = Shingler(words), wanted.value
        for batch in batches:
            ok = np.ones(batch.num_rows, bool)
            for place in _filter_places(batch.column("text_key").to_numpy(), FILTER_BITS):
                ok &= (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            chosen = batch.filter(pa.array(ok)) if len(ok) else batch
            found: dict[int, np.ndarray] = {}
            for text in chosen.column("text"):
                shingles = shingler(text.as_py())
                if len(shingles):
                    found[set_name(shingles)] = shingles
            if found:
                yield pa.RecordBatch.from_pydict({
                    "sid": pa.array(list(found), pa.int64()), "n": pa.array([len(s) for s in found.values()], pa.int64()),
                    "hashes": pa.array([s.astype("<u8").tobytes() for s in found.values()], pa.binary()),
                })

    made = docs.select(F.xxhash64("text").alias("text_key"), "text").mapInArrow(sets, "sid long, n long, hashes binary")
    # A set comes once from each task that holds a copy; one of them stays, before its bytes are shuffled to a hot key.
    return staged(made.join(keys.select("sid"), "sid", "left_semi").dropDuplicates(["sid"]), "sets")


def candidate_edges(sets: DataFrame, part: int, whole: int) -> DataFrame:
    """Edges a, b between sets that share a shingle of their prefixes: each to the smallest set with that shingle."""
    def count(total, batch):
        for packed in batch.column("hashes"):
            places = (np.frombuffer(packed.as_py(), "<u8") % np.uint64(SKETCH_COUNTERS)).astype(np.int64)
            np.add.at(total, places, 1)

    sketch = sets.sparkSession.sparkContext.broadcast(_summed(sets.select("hashes"), count, SKETCH_COUNTERS, "<i8", np.add))

    def prefixes(batches):
        counts = sketch.value
        for batch in batches:
            for sid, packed in zip(batch.column("sid").to_pylist(), batch.column("hashes")):
                hashes = np.frombuffer(packed.as_py(), "<u8")
                order = np.lexsort((hashes, counts[(hashes % np.uint64(SKETCH_COUNTERS)).astype(np.int64)]))
                prefix = hashes[order[: len(hashes) - -(-part * len(hashes) // whole) + 1]]
                yield pa.RecordBatch.from_pydict({
                    "shingle": pa.array(prefix.view(np.int64), pa.int64()), "sid": pa.array(np.full(len(prefix), sid), pa.int64()),
                })

    rows = staged(sets.select("sid", "hashes").mapInArrow(prefixes, "shingle long, sid long"), "prefixes")
    stars = rows.groupBy("shingle").agg(F.min("sid").alias("b"), F.max("sid").alias("last")).where("b < last").select("shingle", "b")
    return rows.join(stars, "shingle").where("sid <> b").select(F.col("sid").alias("a"), "b").distinct()


# --- 3. signature trees ------------------------------------------------------

_EDGES = "a long, b long"


def _edges(table: pa.Table, part: int, whole: int) -> pa.Table:
    """Edges that span what is linked among the sets of a table, found by one signature tree."""
    ids = table["sid"].to_numpy()
    start = table["label"].to_numpy() if "label" in table.column_names else ids
    side = table["side"].to_numpy() if "side" in table.column_names else None
    sets = [np.frombuffer(x, "<u8") for x in table["hashes"].to_pylist()]
    labels = link(sets, part, whole, start, side)
    far = np.flatnonzero(labels != np.arange(len(ids)))
    return pa.table({"a": pa.array(ids[far], pa.int64()), "b": pa.array(ids[labels[far]], pa.int64())})


def _tree_join(sets: DataFrame, group: list[str], part: int, whole: int) -> DataFrame:
    """Edges inside each group of sets; groups are small, so whole partitions of them are taken in turn."""
    columns = [c for c in ("sid", "hashes", "label", "side") if c in sets.columns]

    def flush(parts: list[pa.Table]):
        return _edges(pa.concat_tables(parts).select(columns), part, whole).to_batches()

    def run(batches):
        held, name = [], None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in group)))
            cuts = [0, *[k for k in range(1, len(keys)) if keys[k] != keys[k - 1]], len(keys)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                if held and keys[begin] != name:
                    yield from flush(held)
                    held = []
                name = keys[begin]
                held.append(pa.Table.from_batches([batch.slice(begin, end - begin)]))
        if held:
            yield from flush(held)

    return sets.repartition(*group).sortWithinPartitions(*group).select(*group, *columns).mapInArrow(run, _EDGES)


def links(sets: DataFrame, groups: DataFrame, part: int, whole: int, chunk_sets: int = CHUNK_SETS) -> DataFrame:
    """Edges spanning exactly the classes of linked sets; ``groups`` (node, root) are the candidate groups."""
    size_class = F.floor(F.log(F.col("n").cast("double")) / math.log(whole / part) + 1e-9).cast("int")
    grouped = sets.join(groups.select(F.col("node").alias("sid"), F.col("root").alias("group")), "sid")
    thin = grouped.select("group", size_class.alias("size_class"))
    totals = thin.groupBy("group").agg(F.count(F.lit(1)).alias("total"))
    in_class = thin.groupBy("group", "size_class").agg(F.count(F.lit(1)).alias("in_class"))
    cuts = in_class.join(totals, "group").where(F.col("total") > chunk_sets).select(
        "group", "size_class", F.ceil(F.col("in_class") / chunk_sets).cast("int").alias("pieces")
    )
    chunked = grouped.withColumn("size_class", size_class).join(cuts, ["group", "size_class"], "left").select(
        "sid", "hashes", "group", F.when(F.col("pieces").isNull(), -1).otherwise(F.col("size_class")).alias("band"),
        F.coalesce(F.pmod(F.xxhash64("sid"), F.col("pieces")), F.lit(0)).cast("int").alias("piece"),
    )
    chunked = staged(chunked, "chunks")
    alone = staged(_tree_join(chunked, ["group", "band", "piece"], part, whole), "links")
    large = chunked.where("band >= 0")
    if large.isEmpty():
        return alone

    def labelled(edges: DataFrame) -> DataFrame:
        roots = components(edges)
        return large.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("label", F.coalesce("root", "sid")).drop("root")

    # One set of each class in each chunk, so that most classes of different chunks meet early.
    heads = labelled(alone).groupBy("group", "band", "piece", "label").agg(F.min("sid").alias("sid"))
    heads = heads.select("sid", F.pmod(F.xxhash64("label"), F.ceil(F.count(F.lit(1)).over(Window.partitionBy("group", "band")) / chunk_sets)).alias("deal"))
    met = _tree_join(large.join(heads, "sid"), ["group", "band", "deal"], part, whole)
    edges = staged(alone.unionByName(met), "links")

    known = staged(labelled(edges), "labelled")
    chunks = known.groupBy("group", "band", "piece").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    other = chunks.select("group", *[F.col(c).alias(f"o_{c}") for c in ("band", "piece", "low", "high")])
    pairs = chunks.join(other, "group").where(
        "(band = o_band and piece < o_piece or o_band = band + 1) and (low <> o_low or high <> o_high or low <> high)"
    )
    pairs = pairs.select(
        "group", F.xxhash64("group", "band", "piece", "o_band", "o_piece").alias("pair"),
        F.explode(F.array(*[
            F.struct(F.col(b).alias("band"), F.col(p).alias("piece"), F.lit(k).alias("side"))
            for k, (b, p) in enumerate((("band", "piece"), ("o_band", "o_piece")))
        ])).alias("c"),
    ).select("group", "pair", "c.*")
    across = _tree_join(known.join(pairs, ["group", "band", "piece"]), ["group", "pair"], part, whole)
    return staged(edges.unionByName(across), "links")


def classes(docs: DataFrame, words: int = WORDS, part: int = PART, whole: int = WHOLE, chunk_sets: int = CHUNK_SETS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text_key (xxhash64 of the text), n_shingles, component_id, root.

    ``component_id`` is the class's smallest id; ``root``, the smallest name of its sets, is what
    identifies it (null without shingles, where each row is its own class).
    Two documents link when ``whole`` * shared >= ``part`` * united shingles. ``docs`` is read
    several times and should be a stored table, as its tasks must see the same rows
    in the same order when one is run again.
    """
    screened = staged(screen(docs, words), "screened")
    sets = passing_sets(docs, screened, words, part, whole)
    groups = components(candidate_edges(sets, part, whole))
    roots = components(links(sets, groups, part, whole, chunk_sets)).withColumnRenamed("node", "sid")
    firsts = screened.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("first_doc"))
    firsts = firsts.join(roots, "sid", "left")
    named = firsts.where("root is not null").groupBy("root").agg(F.min("first_doc").alias("class_doc"))
    named = firsts.join(named, "root", "left").select(
        "sid", F.when(F.col("root").isNull(), F.col("first_doc")).otherwise(F.col("class_doc")).alias("class_doc"),
        F.coalesce("root", "sid").alias("root"),
    )
    return screened.join(named, "sid", "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("class_doc")).alias("component_id"), "root",
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with one row of each class, that with the smallest id, nulls last; rows without shingles all stay."""
    found = classes(docs)
    kept = found.where(F.col("n_shingles") == 0).select("doc_id", "text_key", F.lit(False).alias("once")).unionByName(
        found.where((F.col("n_shingles") > 0) & F.col("component_id").eqNullSafe(F.col("doc_id")))
        .groupBy("root", "component_id").agg(F.min("text_key").alias("text_key"))
        .select(F.col("component_id").alias("doc_id"), "text_key", F.lit(True).alias("once"))
    ).distinct()
    return _matching(docs, kept)


def _matching(docs: DataFrame, kept: DataFrame) -> DataFrame:
    row = docs.select(
        F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k1"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("k2"),
    )
    kept = kept.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k1"), F.col("text_key").alias("k2"), "once")
    found = row.join(kept, ["k1", "k2"])
    number = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("k2"))
    return found.withColumn("number", number).where(~F.col("once") | (F.col("number") == 1)).select("row.*")
