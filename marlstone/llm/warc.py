"""WARC archives: write one transaction per page, read archives back, and assemble transactions.

A capture is three records: the request, the response (or a revisit, where
another page already stored the same payload), and metadata. Request and
metadata name the response in WARC-Concurrent-To. Writing is built-in
expressions and Spark's text writer, whose record separator is the empty line
that ends a WARC record; files are compressed and committed like any Spark
output. Record ids are new with every call and the same for a task that is run again. Reading
takes plain files and gzip files of any number of members, a piece at a time, and goes by
Content-Length, so a payload may hold any bytes; a task holds one compressed file and one record.

Records of a capture meet by the identifiers they are concurrent to, any number of them, directly or
through other records. Of several records of a kind the capture's row holds one; ``further_records``
are the rest, a row each, so nothing grows with a capture.

Defined results: a null payload counts as empty; a null URL leaves out the target
field; a null page id leaves out the page field, and such a page is never the one
that others revisit; a page id with several different payloads is several
captures, and a repeated row is a capture each time; an empty table writes
archives without records; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import staged
from marlstone.llm.components import components
from marlstone.storage import scratch_path

#: Payloads below this many bytes are always stored.
REVISIT_FROM = 100
#: Uncompressed size that one file is meant to have.
FILE_BYTES = 16 << 20
RECORD_OVERHEAD = 1500
#: Bytes unpacked at a time.
PIECE_BYTES = 1 << 16
DATE = "2024-01-01T00:00:00Z"
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = (
    "record_id string, record_type string, concurrent_to array<string>, target_uri string, page_id long, refers_to long, "
    "payload_bytes long, payload_digest string, payload_ok boolean, payload binary"
)


def _line(name: str, value: Column) -> Column:
    """A header line; nothing where the value is null. Control characters cannot end the line."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\x00-\x1F]", " "), F.lit(END)), F.lit(""))


def _record(kind: Column, record_id: Column, fields: list[Column], block: Column) -> Column:
    return F.concat(
        F.lit(f"WARC/1.1{END}"), _line("WARC-Type", kind), _line("WARC-Record-ID", record_id),
        _line("WARC-Date", F.lit(DATE)), *fields, _line("Content-Length", F.octet_length(block)), F.lit(END), block,
    )


def _urn(capture: Column, part: str) -> Column:
    return F.concat(F.lit("<urn:uuid:"), capture, F.lit(f"{part}>"))


def revisits(pages: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """Columns page_id, digest, first_page, first_url of the pages whose payload another page stores.

    ``pages`` has page_id, url, digest, bytes. Equal payloads are reduced to
    their first page before anything is joined, and only payloads that occur
    again take part, so a payload shared by many pages stays one small row.
    """
    large = pages.where(F.col("bytes") >= least)
    first = large.where("page_id is not null").groupBy("digest").agg(F.min("page_id").alias("first_page"))
    first = staged(first, "first-pages")  # from a table, the join can split the pages of a hot payload
    urls = large.groupBy("digest", "page_id").agg(F.min("url").alias("url"))
    others = urls.select("digest", "page_id").join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("first_page")))
    stored = urls.select("digest", F.col("page_id").alias("first_page"), F.col("url").alias("first_url"))
    needed = others.select("digest", "first_page").distinct()
    return others.join(needed.join(stored, ["digest", "first_page"]), ["digest", "first_page"])


def write_archives(pages: DataFrame, path: str, least: int = REVISIT_FROM, file_bytes: int = FILE_BYTES) -> None:
    """Write all pages (page_id, url, html) as WARC files below ``path``."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    taken = pages.select(
        "page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )
    thin = staged(taken.select("page_id", "url", "digest", "bytes"), "page-digests")
    mean = thin.agg(F.avg("bytes")).first()[0] or 0
    later = revisits(thin, least).select(
        F.col("page_id").alias("later_page"), F.col("digest").alias("later_digest"), "first_page", "first_url"
    )
    # The page id deals out the payloads evenly, however many of them are equal.
    captures = taken.join(
        later, F.col("page_id").eqNullSafe(F.col("later_page")) & (F.col("digest") == F.col("later_digest")), "left"
    ).withColumn("capture", F.expr(f"uuid({uuid.uuid4().int >> 65})"))
    revisit = F.col("first_page").isNotNull()
    response_id = _urn(F.col("capture"), "")
    target = _line("WARC-Target-URI", F.col("url"))
    concurrent = _line("WARC-Concurrent-To", response_id)
    host = F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[a-z]+://([^/?#]*)", 1)
    route = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"^[a-z]+://[^/?#]*|#.*$|[\x00-\x20]", "")
    answer = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"),
        _line("Content-Length", F.col("bytes")), F.lit(END), F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    )
    request = _record(
        F.lit("request"), _urn(F.col("capture"), "/request"),
        [target, concurrent, _line("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.when(route.startswith("/"), route).otherwise(F.concat(F.lit("/"), route)),
                 F.lit(f" HTTP/1.1{END}"), _line("Host", host), F.lit(END)),
    )
    response = _record(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), response_id,
        [target, _line("Content-Type", F.lit("application/http; msgtype=response")),
         _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
         _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
         _line("WARC-Refers-To-Target-URI", F.col("first_url")), _line("WARC-Refers-To-Page", F.col("first_page"))],
        answer,
    )
    metadata = _record(
        F.lit("metadata"), _urn(F.col("capture"), "/metadata"),
        [target, concurrent, _line("Content-Type", F.lit("application/warc-fields"))],
        _line("page-id", F.col("page_id")),
    )
    records = captures.select(F.explode(F.array(request, response, metadata)).alias("value"))
    per_file = 3 * max(1, int(file_bytes / (mean + RECORD_OVERHEAD)))
    (records.write.option("lineSep", 2 * END).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", per_file).text(path))


def _fields(head: bytes) -> dict[str, list[str]]:
    """Header lines by lower-case name; a name may repeat, and an indented line continues the one before."""
    found: dict[str, list[str]] = {}
    for line in re.sub(r"\r\n[ \t]+", " ", head.decode("utf-8", "replace")).split(END):
        name, colon, value = line.partition(":")
        if colon:
            found.setdefault(name.strip().lower(), []).append(value.strip())
    return found


def _one(fields: dict[str, list[str]], name: str) -> str | None:
    return fields[name][0] if name in fields else None


def _number(value: str | None) -> int | None:
    return int(value) if value and re.fullmatch(r"-?\d+", value) else None


def unpacked(data: bytes) -> Iterator[bytes]:
    """The content of a file in pieces: of all members, one after the other, if it is compressed."""
    if not data.startswith(b"\x1f\x8b"):
        yield data
        return
    member = None
    for at in range(0, len(data), PIECE_BYTES):
        piece = data[at : at + PIECE_BYTES]
        while piece := piece if member else piece.lstrip(b"\0"):  # zeros may pad the file
            member = member or zlib.decompressobj(31)
            yield member.decompress(piece)
            piece = member.unused_data
            if member.eof:
                member = None
    if member:
        raise ValueError("the compressed file is cut off")


def parse_records(pieces: Iterable[bytes]) -> Iterator[dict]:
    """The records of one archive, given in pieces, in order."""
    pieces, held, place = iter(pieces), bytearray(), 0

    def more() -> bool:
        piece = next(pieces, None)
        held.extend(piece or b"")
        return piece is not None

    while True:
        while len(held) < 5 and more():
            pass
        if not held:
            return
        while (end := held.find(b"\r\n\r\n")) < 0 and held.startswith(b"WARC/") and more():
            pass
        if end < 0 or not held.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {place}")
        fields = _fields(bytes(held[:end]))
        length = _number(_one(fields, "content-length"))
        if length is None:
            raise ValueError(f"the record at byte {place} has no length")
        while len(held) < end + 4 + length and more():
            pass
        block = bytes(held[end + 4 : end + 4 + length])
        if len(block) < length:
            raise ValueError(f"the record at byte {place} is cut off")
        while len(held) < end + 8 + length and more():
            pass
        del held[: end + 8 + length]
        place += end + 8 + length
        yield _row(fields, block)


def _row(fields: dict[str, list[str]], block: bytes) -> dict:
    kind = _one(fields, "warc-type")
    row = {
        "record_id": _one(fields, "warc-record-id"), "record_type": kind, "concurrent_to": fields.get("warc-concurrent-to", []),
        "target_uri": _one(fields, "warc-target-uri"), "page_id": None, "refers_to": None, "payload_bytes": None,
        "payload_digest": None, "payload_ok": None, "payload": None,
    }
    if kind == "metadata":
        row["page_id"] = _number(_one(_fields(block), "page-id"))
    elif kind in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        stated = (_one(fields, "warc-payload-digest") or "").removeprefix("sha256:")
        if kind == "response":
            digest = hashlib.sha256(payload).hexdigest()
            row |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest, "payload_ok": digest == stated}
        else:
            row |= {
                "payload_bytes": _number(_one(_fields(head), "content-length")), "payload_digest": stated,
                "refers_to": _number(_one(fields, "warc-refers-to-page")),
            }
    return row


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the .warc and .gz files below ``path``; ``payloads=False`` leaves the payload itself out."""
    schema = pa.schema([
        ("record_id", pa.string()), ("record_type", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("target_uri", pa.string()),
        ("page_id", pa.int64()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("payload_ok", pa.bool_()), ("payload", pa.binary()),
    ])

    def read(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for row in parse_records(unpacked(content.as_py())):
                    held += len(row["payload"] or b"")
                    rows.append(row if payloads else row | {"payload": None})
                    if len(rows) >= 5000 or payloads and held > FILE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{gz,warc}").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(read, RECORD_SCHEMA)


#: What is kept of a record in its capture's row, the order in which one is chosen among several.
_KEPT = ("record_id", "record_type", "target_uri", "page_id", "refers_to", "payload_bytes", "payload_digest", "payload_ok", "payload")
_KIND = {"request": "request", "response": "response", "revisit": "response", "metadata": "metadata"}


def captures_of(records: DataFrame) -> DataFrame:
    """``records`` with capture_id: what a record is concurrent to, or itself.

    Mostly that names a record that is concurrent to nothing, and no record names two. The identifiers of
    other records are joined transitively, and the smallest names the capture.
    """
    edges = staged(records.select("record_id", F.explode("concurrent_to").alias("target")).distinct(), "concurrent")
    sources = edges.groupBy("record_id").agg(F.count(F.lit(1)).alias("n"))
    onward = edges.join(sources.select(F.col("record_id").alias("target")), "target", "left_semi").select("record_id", "target")
    forked = edges.join(sources.where("n > 1").select("record_id"), "record_id", "left_semi").select("record_id", "target")
    # Every edge of a record that forks or leads on; an edge onto such a record is found by its target below.
    odd = staged(onward.unionByName(forked).unionByName(
        edges.join(onward.select(F.col("target").alias("record_id")).distinct(), "record_id", "left_semi").select("record_id", "target")
    ).distinct(), "joined-captures")
    place = F.coalesce(F.get("concurrent_to", F.lit(0)), F.col("record_id"))
    if odd.isEmpty():
        return records.withColumn("capture_id", place)
    names = odd.select(F.col("record_id").alias("name")).unionByName(odd.select(F.col("target").alias("name"))).distinct()
    names = names.withColumn("node", F.xxhash64("name"))
    found = components(odd.select(F.xxhash64("record_id").alias("a"), F.xxhash64("target").alias("b")))
    labels = names.join(found, "node")
    smallest = labels.groupBy("root").agg(F.min("name").alias("label"))
    labels = staged(labels.join(smallest, "root").select(F.col("name").alias("place"), "label"), "capture-labels")
    return records.withColumn("place", place).join(labels, "place", "left").withColumn("capture_id", F.coalesce("label", "place")).drop("place", "label")


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: capture_id and the structs request, response, metadata (null where missing).

    Only the largest record of a kind is kept for a capture, which partial aggregation does before the
    shuffle, so many records of one capture never gather in a task; ``n_records`` tells how
    many there were and ``further_records`` gives the others. ``records`` is read several times.
    """

    def one(kind: str) -> Column:
        return F.max(F.when(F.col("record_type").isin(*[k for k, v in _KIND.items() if v == kind]), F.struct(*_KEPT)))

    return captures_of(records).groupBy("capture_id").agg(
        *[one(kind).alias(kind) for kind in ("request", "response", "metadata")], F.count(F.lit(1)).alias("n_records")
    )


def further_records(records: DataFrame) -> DataFrame:
    """capture_id and columns of the records that ``assemble`` leaves out: kinds other than its own, and all but one of a kind."""
    keyed = captures_of(records).withColumn("kind", F.coalesce(*[F.when(F.col("record_type") == k, F.lit(v)) for k, v in _KIND.items()]))
    kept = keyed.where("kind is not null").groupBy("capture_id", "kind").agg(
        F.max(F.struct(*_KEPT)).alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # The row kept is told by its values, not by its id: an id may repeat, and equal records are one.
    several = keyed.join(kept.select("capture_id", "kind", "kept"), ["capture_id", "kind"]).where(~F.struct(*_KEPT).eqNullSafe(F.col("kept")))
    other = keyed.where("kind is null")
    return other.unionByName(several.drop("kept")).drop("kind", "concurrent_to")


def round_trip(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back and assemble the captures."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    records = read_records(pages.sparkSession, path, payloads)
    return assemble(records if payloads else staged(records, "records"))
