"""Token ids of documents as length-delimited binary records with masked checksums and an offset index.

A file starts with ``MAGIC``, a byte telling the width of an id (2 or 4) and the
length of the records that follow. A record frames one document:

    length of the payload (8 bytes), masked CRC-32 of those 8 bytes (4),
    payload, masked CRC-32 of the payload (4)

The payload is a byte telling whether there is a document id, the id (8 bytes)
and the token ids, the last one the end id. All numbers are little-endian. The
newline at the end of a file is Spark's text writer's: it writes the files, so
tasks that are run again or lost never leave half a file. Documents are in
ascending id order over the files in name order. The index is a Parquet table beside the
files: file, document, offset and length of its record, number of ids.

Defined results: a null or empty text is the end id alone; a null document id
sorts first; a repeated id is a record each time, in order of its text's hash; an
empty table gives no records; other columns are ignored. A text of any length is
one record, and a file holds at least one.
"""

from __future__ import annotations

import json
import os
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.llm.common import release_memory
from marlstone.storage import scratch_path

MAGIC = b"TOKREC1\n"
HEAD, LENGTH, CHECK, OWNER = "<BQ", "<Q", "<I", "<?q"
LENGTH_BYTES, CHECK_BYTES = struct.calcsize(LENGTH), struct.calcsize(CHECK)
FRAME_BYTES = LENGTH_BYTES + 2 * CHECK_BYTES
#: A file is closed once it holds this much.
FILE_BYTES = 16 << 20
#: Texts that are encoded at a time, of an Arrow batch of any size.
TEXTS = 2_500
#: A worker remembers the pieces that are no plain words up to this much, at ``ENTRY_BYTES`` each besides their own; forgetting only costs time.
#: An executor holds it once per core, beside a JVM whose heap may be full.
CACHED_BYTES, ENTRY_BYTES = 64 << 20, 120
END_ID = 2


def masked(data) -> int:
    """CRC-32, rotated and shifted so that the checksum of data holding checksums stays useful."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = struct.pack(LENGTH, len(payload))
    return b"".join((length, struct.pack(CHECK, masked(length)), payload, struct.pack(CHECK, masked(payload))))


def _byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself where printable, else the next from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


#: Latin letters but the dotted capital I, then ASCII punctuation without the apostrophe of contractions.
_PLAIN = (
    "^(?P<stem>[A-Za-z\u00AA\u00B5\u00BA\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u024F]+)"
    r"(?P<tail>[!-&(-/:-@\[-`{-~]*)$"
)
#: Stands behind each of so many words that are encoded together: a token that letters never make.
_BETWEEN, TOGETHER = "!", 100


# The parts of a tokenizer file that decide where its pieces begin and end, for which encoding by runs is right.
_BY_RUNS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
}
# End of fixed values.


class Encoder(dict):
    """Texts to packed token ids; as a dictionary, from pieces of text without ASCII white space to theirs.

    A tokenizer file that splits texts in any other way than ``_BY_RUNS`` says encodes whole texts. One that does
    drops white space and never joins across it, so each distinct run of a batch is encoded once. Letters with
    punctuation behind them are two of its pieces. Such letters are lower-cased one by one and already in composed
    form, so the library's model takes them as they are, many words at a time, and none is remembered: most words
    of a large table are rare. All else goes through the whole encoder, one by one, and is
    remembered here until it takes half of ``CACHED_BYTES``; then it becomes the older half, of which only what is met again is kept.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        super().__init__()
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model
        with open(tokenizer_file, encoding="utf-8") as file:
            described = json.load(file)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.letter = {2: "H", 4: "I"}[self.width]
        self.held = 0
        self.older: dict[bytes, bytes] = {}
        self.bare = Tokenizer(self.model)  # takes words as they are
        self.bare.pre_tokenizer = WhitespaceSplit()
        self.characters = np.array([ord(" ") if byte == ord(" ") else ord(c) for byte, c in enumerate(_byte_characters())], "<u4")
        self.after = f" {_BETWEEN} ".encode()
        self.between = [token.id for token in self.model.tokenize(_BETWEEN)]
        self.by_runs = (
            described["model"]["type"] == "BPE" and len(self.between) == 1
            and all(described.get(part) == known for part, known in _BY_RUNS.items())
        )

    def packed(self, ids: list[int]) -> bytes:
        numbers = array(self.letter, ids)
        if sys.byteorder == "big":
            numbers.byteswap()
        return numbers.tobytes()

    def remember(self, piece: bytes, value: bytes) -> bytes:
        size = ENTRY_BYTES + len(piece) + len(value)
        if self.held + size > CACHED_BYTES // 2:
            self.older = dict(self)
            self.clear()
            self.held = 0
        if size <= CACHED_BYTES // 2:
            self[piece] = value
            self.held += size
        return value

    def __missing__(self, piece: bytes) -> bytes:
        value = self.older.pop(piece, None)
        if value is None:
            value = self.packed(self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids)
        return self.remember(piece, value)

    def words(self, stems: pa.Array) -> pa.Array:
        """Packed ids of words of lower-case letters."""
        groups = pa.ListArray.from_arrays(np.append(np.arange(0, len(stems), TOGETHER), len(stems)).astype("i4"), stems.cast(pa.binary()))
        joined = [group.as_py() + self.after for group in pc.binary_join(groups, self.after)]
        texts = [self.characters[np.frombuffer(group, "u1")].tobytes().decode("utf-32-le") for group in joined]
        found = self.bare.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(encoding.ids, self.kind) for encoding in found] or [np.empty(0, self.kind)])
        ends = np.flatnonzero(ids == self.between[0])
        offsets = np.append(0, ends - np.arange(len(ends))) * self.width
        return pa.Array.from_buffers(
            pa.large_binary(), len(stems), [None, pa.py_buffer(offsets), pa.py_buffer(np.delete(ids, ends))]
        )

    def __call__(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        if not self.by_runs:
            texts = texts.to_pylist() if isinstance(texts, pa.Array) else texts
            found = self.tokenizer.encode_batch([text or "" for text in texts], add_special_tokens=False)
            return [self.packed(encoding.ids) for encoding in found]
        by_text = pc.ascii_split_whitespace(pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), ""))
        runs = by_text.flatten().dictionary_encode()
        split = pc.extract_regex(runs.dictionary, _PLAIN)
        stems = pc.utf8_lower(pc.struct_field(split, "stem")).dictionary_encode()
        others = pc.if_else(pc.is_valid(split), pc.struct_field(split, "tail"), runs.dictionary).dictionary_encode()
        heads = self.words(stems.dictionary).take(stems.indices)
        rests = pa.array([self[other] for other in _listed(others.dictionary)], pa.large_binary()).take(others.indices)
        joined = pc.binary_join_element_wise(pc.fill_null(heads, b""), rests, pa.scalar(b"", pa.large_binary()))
        found = joined.take(runs.indices)
        ends, data = np.frombuffer(found.buffers()[1], "i8", len(found) + 1), found.buffers()[2]
        bounds = ends[by_text.offsets.to_numpy() - by_text.offsets[0].as_py()].tolist()
        packed = memoryview(data or b"")
        return [bytes(packed[start:end]) for start, end in zip(bounds, bounds[1:])]


def _listed(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


@lru_cache(maxsize=1)
def encoder_for(tokenizer_file: str) -> Encoder:
    """The worker's encoder, which later tasks of the worker find with what it has learnt."""
    return Encoder(tokenizer_file)


def write_sequences(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    """Write the files below ``path``/data and the index below ``path``/index."""

    def write(batches):
        release_memory()  # of earlier steps
        encoder = encoder_for(tokenizer_file)
        end = np.array([end_id], encoder.kind).tobytes()
        unsized = MAGIC + struct.pack(HEAD, encoder.width, 0)
        file = bytearray(unsized)

        def closed():  # Arrow takes the file where it lies
            struct.pack_into(HEAD, file, len(MAGIC), encoder.width, len(file) - len(unsized))
            ends = pa.py_buffer(np.array([0, len(file)], "<i4").tobytes())
            return pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), 1, [None, ends, pa.py_buffer(file)])], names=["file"])

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                ids, texts = batch.slice(at, TEXTS).columns
                for doc_id, tokens in zip(ids.to_pylist(), encoder(texts)):
                    file += framed(struct.pack(OWNER, doc_id is not None, doc_id or 0) + tokens + end)
                    if len(file) - len(unsized) >= file_bytes:
                        yield closed()
                        file = bytearray(unsized)
        if len(file) > len(unsized):
            yield closed()

    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
    )
    files = ordered.select("doc_id", "text").mapInArrow(write, "file binary")
    files.select(F.col("file").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(f"{path}/data")
    _scanned(docs.sparkSession, path, check=False).drop("ids_crc32").write.parquet(f"{path}/index")


def parse_file(data, check: bool) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """Offset, record length, document id and ids of each record; checksums are verified if ``check``."""
    view = memoryview(data)
    if view[: len(MAGIC)] != MAGIC:
        if bytes(view).strip():
            raise ValueError("not a file of token records")
        return
    width, size = struct.unpack_from(HEAD, view, len(MAGIC))
    at = len(MAGIC) + struct.calcsize(HEAD)
    end = at + size
    if len(view) < end:
        raise ValueError("the file is cut off")
    while at < end:
        yield parse_record(view, at, width, check)
        at += FRAME_BYTES + struct.unpack_from(LENGTH, view, at)[0]


def parse_record(view, at: int, width: int, check: bool = True) -> tuple[int, int, int | None, np.ndarray]:
    """The record at an offset, as the index gives it."""
    (length,) = struct.unpack_from(LENGTH, view, at)
    start = at + LENGTH_BYTES + CHECK_BYTES
    payload = view[start : start + length]
    if check:
        stated = struct.unpack_from(CHECK, view, at + LENGTH_BYTES)[0], struct.unpack_from(CHECK, view, start + length)[0]
        if stated != (masked(view[at : at + LENGTH_BYTES]), masked(payload)):
            raise ValueError(f"checksum of the record at byte {at} does not match")
    owned, doc_id = struct.unpack_from(OWNER, payload)
    return at, FRAME_BYTES + length, doc_id if owned else None, np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(OWNER))


_SCANNED = "file string, doc_id long, offset long, length long, n_tokens long, start_in_file long, ids_crc32 long"


def _scanned(spark: SparkSession, path: str, check: bool) -> DataFrame:
    def scan(batches):
        encoder_for.cache_clear()  # a worker that has written needs its room for files now
        release_memory()
        for batch in batches:
            for name, content in zip(*batch.columns):
                rows, start = [], 0
                for at, length, doc_id, ids in parse_file(content.as_buffer(), check):
                    crc = zlib.crc32(ids.astype("<u4")) if check else None
                    rows.append((doc_id, at, length, len(ids), start, crc))
                    start += len(ids)
                if rows:
                    columns = [pa.array(x, pa.int64()) for x in zip(*rows)]
                    file = pa.array([name.as_py()] * len(rows))
                    yield pa.RecordBatch.from_arrays([file, *columns], names=[x.split()[0] for x in _SCANNED.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return named.mapInArrow(scan, _SCANNED)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def file_order(name: Column) -> list[Column]:
    """Task and number within the task of a file; the job's id between them may hold ``-c`` and digits too."""
    return [F.regexp_extract(name, pattern, 1).cast("long") for pattern in (r"^part-(\d+)", r"-c(\d+)\.[^-]*$")]


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """Per record, from the files: doc_id, start (ids of all records before it), n_tokens, ids_crc32, file, offset.

    Every checksum is verified. Totals per file come from the index, so only one
    number per file is summed up in order.
    """
    totals = read_index(spark, path).groupBy("file").agg(F.sum("n_tokens").alias("ids"))
    before = Window.partitionBy().orderBy(*file_order(F.col("file"))).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("file_start"))
    return _scanned(spark, path, check=True).join(starts, "file").select(
        "doc_id", (F.col("file_start") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32", "file", "offset"
    )


def read_at(wanted: DataFrame, path: str) -> DataFrame:
    """Records at given places (file, offset), e.g. a shuffled part of the index: file, offset, doc_id, ids.

    The places of a file are dealt to one task with the file, which is at most
    ``FILE_BYTES`` and one document long.
    """

    def take(key, places):
        data = next((x.as_py() for x in places["content"] if x.is_valid), b"")
        width = data[len(MAGIC)] if data else 2
        found = [(key[0].as_py(), at, *parse_record(memoryview(data), at, width)[2:]) for at in sorted(x.as_py() for x in places["offset"] if x.is_valid)]
        file, at, doc_id, ids = zip(*found) if found else ((), (), (), ())
        return pa.table({
            "file": pa.array(file, pa.string()), "offset": pa.array(at, pa.int64()), "doc_id": pa.array(doc_id, pa.int64()),
            "ids": pa.array([x.tolist() for x in ids], pa.list_(pa.int64())),
        })

    spark = wanted.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")
    contents = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.lit(None).cast("long").alias("offset"), "content")
    places = wanted.select("file", "offset", F.lit(None).cast("binary").alias("content"))
    return contents.unionByName(places).groupBy("file").applyInArrow(take, "file string, offset long, doc_id long, ids array<long>")


def round_trip(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    path = scratch_path(docs.sparkSession, "tokens")
    write_sequences(docs, path, tokenizer_file)
    return read_sequences(docs.sparkSession, path)
