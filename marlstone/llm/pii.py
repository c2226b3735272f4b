"""Personal data, and terms that reveal it.

Entities (emails, addresses, cards, phones) are found by pattern. What else a
document must hide follows from the corpus: with N documents, n_c that hold an
entity c, n_t that hold a term t, and n_ct that hold both, wherever in the text,
copies counted as one document,

    information of c    IC = ln(N / n_c)
    disclosure by t     PMI = ln(n_ct * N / (n_c * n_t))

t discloses PMI / IC of c. From ``GENERALISE`` on it is generalised to its shape, from
``REMOVE`` on it is removed, at every place where it stands in a document that holds c.

Copies say nothing new: what stands in one text stands in all its copies, and would seem to reveal
every entity of theirs. So texts are counted once, and of texts with an entity that several
texts hold, those linked as near copies (see ``jaccard``) are one document, which holds what any of them holds.

Support: fewer than ``SUPPORT`` documents with both show no rule, so an entity of one
document, however often copied, discloses nothing. An entity that all documents hold has no information.
Documents without c keep t: nothing there ties it to c. Places inside an entity count
for n_t and n_ct but are hidden by the entity's own span.

All counts are over all documents; terms are reduced to one count per task
before they are shuffled. Nothing grows with a group: a frequent entity only means more rows
to aggregate, and a document's entities and spans come together by its row.

Defined results: a null text counts as empty and has no spans; repeated rows
count once and each has its row; an empty table gives no rows; other columns are ignored.
Spans count code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm import jaccard
from marlstone.llm.common import staged

SUPPORT = 2
GENERALISE, REMOVE = 0.75, 0.95
#: Of the terms in at least one of ``COMMON_SHARE`` documents, so many are known to all tasks, which leave out the pairs
#: that cannot reach the threshold even with n_ct = n_c. All other pairs are counted first; results are the same.
COMMON_TERMS, COMMON_SHARE = 4096, 256
_PAIRS = 50_000
#: Bits of the filter of texts with copies, which is sent to every task.
FILTER_BITS = 1 << 25

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "generalised", "removed")
#: What stands for a span in sanitised text.
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "removed": ""}

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_EMAIL = rf"{_LOCAL}++@{_LABEL}+(?:\.{_LABEL}+)+"
#: Matches start where a run of their first characters starts, so no run is scanned twice;
#: a match that ends inside such a run is followed by a try right there.
EMAIL_AT, EMAIL = re.compile(_EMAIL), re.compile(rf"(?<!{_LOCAL}){_EMAIL}")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Terms are runs of ASCII letters, digits and all other characters beyond ASCII.
_NOT_TERM = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
TERM = re.compile(rf"[^{_NOT_TERM}]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while "@" in text and (m := (EMAIL_AT.match(text, at) if at else None) or EMAIL.search(text, at)):
        yield m.span()
        at = m.end()


def entities(text: str) -> list[tuple[int, int, int, str]]:
    """start, rank, end, kind of each entity, in order."""
    found = [(b, 0, e, "email") for b, e in _emails(text)]
    if "." in text:
        found += [(*m.span()[:1], 1, m.end(), "ip") for m in IP.finditer(text)
                  if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end(), "card"))
    if "+" in text:
        found += [(m.start(), 3, m.end(), "phone") for m in PHONE.finditer(text) if 10 <= sum(map(str.isdigit, m.group())) <= 15]
    return sorted(found)


def entity_name(text: str, begin: int, end: int, kind: str) -> str:
    value = text[begin:end].lower() if kind == "email" else re.sub(r"[^0-9.]" if kind == "ip" else r"[^0-9]", "", text[begin:end])
    return hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=16).hexdigest()


def places(text: str, spans: list[tuple[int, int]]) -> dict[str, list[int]]:
    """Each distinct term of a text, and where it starts outside the spans (start, end) of all entities."""
    taken: list[list[int]] = []  # the union of the spans
    for b, e in sorted(spans):
        if taken and b <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([b, e])
    out: dict[str, list[int]] = {}
    for m in TERM.finditer(text):
        starts = out.setdefault(m.group(), [])
        k = bisect_left(taken, [m.end(), 0]) - 1  # the last that starts before the end
        if k < 0 or taken[k][1] <= m.start():
            starts.append(m.start())
    return out


_SPAN = "struct<start: long, rank: int, end: long, kind: string>"
_FOUND = f"doc_id long, text_key long, spans array<{_SPAN}>, entities array<string>, text string"


def detect(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key (xxhash64 of the text), entity spans, distinct entities, and the text if it has any."""
    span = pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("kind", pa.string())])
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("spans", pa.list_(span)),
                        ("entities", pa.list_(pa.string())), ("text", pa.string())])

    def find(batches):
        for batch in batches:
            spans, names, texts = [], [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                found = entities(text)
                spans.append([dict(zip(("start", "rank", "end", "kind"), x)) for x in found])
                names.append(sorted({entity_name(text, b, e, kind) for b, _, e, kind in found}))
                texts.append(text if found else None)
            lists = [pa.array(x, schema.field(k).type) for x, k in ((spans, "spans"), (names, "entities"), (texts, "text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *lists], schema=schema)

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return picked.mapInArrow(find, _FOUND)


def distinct_texts(detected: DataFrame, support: int) -> DataFrame:
    """text_key, class, spans, entities, text of each text with an entity that ``support`` texts hold, once.

    ``class`` is the same for near copies.
    """
    entity = detected.where("text is not null").select("text_key", F.explode("entities").alias("entity")).distinct()
    shared = entity.groupBy("entity").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support)
    keys = staged(entity.join(shared, "entity", "left_semi").select("text_key").distinct(), "shared_texts")
    # Spans and entities are functions of the text, so any row of a text tells them.
    rows = detected.where("text is not null").join(keys, "text_key", "left_semi")
    once = staged(rows.groupBy("text_key").agg(F.first(F.struct("spans", "entities", "text")).alias("of")).select("text_key", "of.*"), "texts")
    found = jaccard.classes(once.select(F.col("text_key").alias("doc_id"), "text"))
    # A text too short for a class is its own.
    named = found.select(F.col("doc_id").alias("text_key"), F.coalesce("component_id", "doc_id").alias("class"))
    return staged(once.join(named, "text_key"), "classes")


def _in_filter(keys: DataFrame):
    """A column function: false only for longs that are not in ``keys`` (key); a bitmap of fixed size at every task."""
    place = F.pmod(F.xxhash64("key"), F.lit(FILTER_BITS)) + 1  # places and buckets count from 1
    bits = keys.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    found = bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    bitmap = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in found:
        at = (row.bucket - 1) * len(row.bits)
        bitmap[at : at + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    held = keys.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def contains(place: pd.Series) -> pd.Series:
        at = place.to_numpy()
        return pd.Series((held.value[at >> 3] >> (at & 7)).astype(np.uint8) & 1 == 1)

    return lambda key: contains(F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)))


def document_frequencies(docs: DataFrame, detected: DataFrame, texts: DataFrame) -> DataFrame:
    """Columns term, n_t: in how many documents of ``docs`` each term stands, copies and near copies (``texts``) counted as one.

    Only texts that a filter cannot tell from those with copies are shuffled, to keep one of each.
    """
    copied = detected.groupBy("text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("text_key")
    special = staged(copied.unionByName(texts.select("text_key")).distinct().withColumnRenamed("text_key", "key"), "copied")
    perhaps = _in_filter(special)
    rows = docs.select(F.xxhash64("text").alias("text_key"), "text").withColumn("perhaps", perhaps(F.col("text_key")))
    once = rows.where("perhaps").join(texts.select("text_key"), "text_key", "left_anti").dropDuplicates(["text_key"])
    terms = F.explode(F.array_distinct(F.split(F.coalesce("text", F.lit("")), f"[{_NOT_TERM}]+"))).alias("term")
    near = texts.select("class", terms).distinct()
    parts = [rows.where("not perhaps").select(terms), once.select(terms), near.select("term")]
    each = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return each.where("term <> ''").groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))


def holders(texts: DataFrame, total: int, support: int) -> DataFrame:
    """Columns text_key, class, spans, text, held (entity, n_c) of the texts that hold an entity which terms may disclose."""
    held = texts.select("text_key", "class", F.explode("entities").alias("entity"))
    counts = staged(
        held.groupBy("entity").agg(F.count_distinct("class").alias("n_c")).where(F.col("n_c").between(support, total - 1)), "entity_counts"
    )
    per_text = held.join(counts, "entity").groupBy("text_key").agg(F.collect_list(F.struct("entity", "n_c")).alias("held"))
    return texts.select("text_key", "class", "spans", "text").join(per_text, "text_key")


def _pairs(held: DataFrame, common, total: int, generalise: float, starts: bool) -> DataFrame:
    """Each text's pairs of an entity and a distinct term, with n_c and class to count them or with the key and places to mark them."""
    names = ("entity", "term", "text_key", "starts") if starts else ("entity", "term", "n_c", "class")
    types = {"entity": pa.string(), "term": pa.string(), "text_key": pa.int64(), "starts": pa.list_(pa.int64()), "n_c": pa.int64(), "class": pa.int64()}

    def find(batches):
        frequent, out, n = common.value, {name: [] for name in names}, 0

        def full():
            return pa.RecordBatch.from_arrays([pa.array(out[name], types[name]) for name in names], names=list(names))

        for batch in batches:
            for key, group, spans, text, held in zip(*(batch.column(c) for c in ("text_key", "class", "spans", "text", "held"))):
                key, group = key.as_py(), group.as_py()
                found = places(text.as_py(), [(s["start"], s["end"]) for s in spans.as_py()])
                for entity in held.as_py():
                    most = total * (entity["n_c"] / total) ** generalise * (1 + 1e-9)
                    for term, at in found.items():
                        if starts and not at or frequent.get(term, 0) > most:
                            continue
                        for name, value in zip(names, (entity["entity"], term, *((key, at) if starts else (entity["n_c"], group)))):
                            out[name].append(value)
                        n += 1
                        if n == _PAIRS:
                            yield full()
                            out, n = {name: [] for name in names}, 0
        if n:
            yield full()

    return held.mapInArrow(find, "entity string, term string, " + ("text_key long, starts array<long>" if starts else "n_c long, class long"))


def disclosures(pairs: DataFrame, frequencies: DataFrame, total: int, support=SUPPORT, generalise=GENERALISE, remove=REMOVE) -> DataFrame:
    """Columns entity, term, action of the terms that disclose an entity, and disclosed, the part of it they do."""
    together = pairs.distinct().groupBy("entity", "n_c", "term").agg(F.count(F.lit(1)).alias("n_ct")).where(F.col("n_ct") >= support)
    counted, n = together.join(frequencies, "term"), F.lit(float(total))
    share = F.log(F.col("n_ct") * n / (F.col("n_c") * F.col("n_t"))) / F.log(n / F.col("n_c"))
    return counted.select("entity", "term", share.alias("disclosed")).where(F.col("disclosed") >= generalise).withColumn(
        "action", F.when(F.col("disclosed") >= remove, "removed").otherwise("generalised")
    )


def protected_spans(docs: DataFrame, support=SUPPORT, generalise=GENERALISE, remove=REMOVE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text_key and all spans, entities and disclosing terms, in order.

    ``docs`` is read several times and should be a stored table.
    """
    detected = staged(detect(docs), "entities")
    texts = distinct_texts(detected, support)
    apart, near, classes = (
        detected.agg(F.count_distinct("text_key")).first()[0], *texts.agg(F.count(F.lit(1)), F.count_distinct("class")).first()
    )
    total = apart - near + classes
    held = staged(holders(texts, total, support), "holders")
    # A term of fewer documents cannot stand beside an entity in enough of them.
    frequencies = staged(document_frequencies(docs, detected, texts).where(F.col("n_t") >= support), "frequencies")
    often = frequencies.where(F.col("n_t") * COMMON_SHARE >= total).orderBy(F.desc("n_t"), "term").limit(COMMON_TERMS).collect()
    common = docs.sparkSession.sparkContext.broadcast({r.term: r.n_t for r in often})
    pairs = _pairs(held, common, total, generalise, starts=False)
    telling = staged(disclosures(pairs, frequencies, total, support, generalise, remove), "disclosures")
    terms = _pairs(held, common, total, generalise, starts=True).join(telling, ["entity", "term"]).select(
        "text_key", F.explode("starts").alias("start"), (F.col("start") + F.length("term")).alias("end"), "action"
    )
    ranks = F.when(F.col("action") == "generalised", KINDS.index("generalised")).otherwise(KINDS.index("removed"))
    # A term may disclose several entities; what discloses most decides.
    worst = terms.groupBy("text_key", "start", "end").agg(F.max(ranks).alias("rank"))
    span = F.struct("start", F.col("rank").cast("int").alias("rank"), "end", F.get(F.array(*map(F.lit, KINDS)), F.col("rank")).alias("kind"))
    # From a table, the join can split the rows of a text with very many copies.
    per_text = staged(worst.select("text_key", span.alias("span")).groupBy("text_key").agg(F.collect_list("span").alias("more")), "term_spans")
    return detected.join(per_text, "text_key", "left").select(
        "doc_id", "text_key", F.array_sort(F.concat("spans", F.coalesce("more", F.array().cast(f"array<{_SPAN}>")))).alias("spans")
    )


def sanitised_text(text: str, spans: list[dict]) -> str:
    """The text with spans replaced; where spans overlap, the one that starts first stands for its whole length."""
    parts, at = [], 0
    for s in spans:
        if s["start"] < at:
            if s["end"] > at:  # the rest of an overlapping span goes as well
                at = s["end"]
            continue
        term = text[s["start"] : s["end"]]
        shape = "[NUMBER]" if term.isdigit() else "[NAME]" if term[:1].isupper() else "[WORD]"
        parts += [text[at : s["start"]], MARKS.get(s["kind"], shape)]
        at = s["end"]
    return "".join([*parts, text[at:]])


def sanitise(docs: DataFrame, **thresholds) -> DataFrame:
    """Columns doc_id and sanitised text of each row of ``docs``."""
    spans = protected_spans(docs, **thresholds).where(F.size("spans") > 0).dropDuplicates(["doc_id", "text_key"])
    keyed = docs.select(F.col("doc_id").cast("long").alias("id"), "text", F.xxhash64("text").alias("key"))
    both = keyed.join(spans, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key")), "left")

    def apply(batches):
        for batch in batches:
            texts = [t if not s else sanitised_text(t, s) for t, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return both.select("id", "text", "spans").mapInArrow(apply, "doc_id long, text string")
