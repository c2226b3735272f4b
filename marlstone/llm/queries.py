"""One query per operator over its whole tables, with SQL for the results that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import (
    chat, decontaminate, jaccard, language_id, mixing, periodic_runs, pii, quality_model, quality_rules, secrets, token_records, warc,
    whitening,
)
from marlstone.llm.common import let, n_words, staged, table, words

QUERIES = {}
ORACLES = {}

_WORD = r"[^\x20\x09-\x0D]+"


def _query(build):
    QUERIES[build.__name__] = build
    return build


@_query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = staged(quality_rules.evaluate_rules(table(spark, sf_dir, "documents")), "ledger")
    base = quality_rules.passes(quality_rules.POLICIES["v1"])
    current = quality_rules.passes(quality_rules.POLICIES[quality_rules.CURRENT_POLICY])
    return ledger.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~base).alias("base_failed"), (base & current).alias("kept"), "fail_bits",
    )


_QUALITY = f"""
    with texts as (
        select doc_id, coalesce(text, '') as body, regexp_extract_all(coalesce(text, ''), '{_WORD}') as ws,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_WORD}')) as ls
        from documents),
    windows as (
        select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as w
        from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from texts) starts),
    again as (
        select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, w) as c from windows) counted where c > 1),
    repeats as (
        select doc_id, count(distinct k) as n from (select doc_id, unnest([i, i + 1, i + 2]) as k from again) covered
        group by doc_id),
    measured as (
        select t.doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
               length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) as n_symbols,
               len(ls) as n_lines, len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words
        from texts t left join repeats r using (doc_id)),
    failed as (
        select *, n_words < 50 as f0, 100 * n_repeat_words > 50 * n_words as f1, 10 * n_symbols > 3 * n_words as f2,
               n_dup_lines > 3 and 2 * n_dup_lines > n_lines as f3, word_chars < 2 * n_words as f4,
               word_chars > 15 * n_words as f5
        from measured)"""

ORACLES["op5_quality_rules"] = f"""{_QUALITY}
    select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
           n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, f0 or f1 as base_failed,
           not (f0 or f1 or f2 or f3 or f4 or f5) as kept,
           (f0::int + 2 * f1::int + 4 * f2::int + 8 * f3::int + 16 * f4::int + 32 * f5::int)::bigint as fail_bits
    from failed"""


@_query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return mixed.select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def mixing_sql(documents: str, columns: str) -> str:
    """The mix of a table with columns doc_id, text, source; ``columns`` of its documents."""
    return f"""
    with mix_docs as (
        select *, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::bigint as size from {documents}),
    mix_sources as (
        select source, sum(size)::bigint as source_size, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight
        from mix_docs group by source),
    capped as (
        select *, source_size * 2.0::double as cap, (sum(source_size) over ())::double * 1.5::double as total,
               source_size * 2.0::double / weight as per_weight from mix_sources),
    levels as (
        select *, (total - coalesce(sum(cap) over (order by per_weight, source nulls first rows between unbounded preceding and 1 preceding), 0))
                  / sum(weight) over (order by per_weight, source nulls first rows between current row and unbounded following) as level
        from capped),
    targets as (
        select source, source_size,
               least(cap, coalesce((select level from levels where level <= per_weight order by per_weight limit 1), 'infinity'::double) * weight) as target,
               ('0x' || substr(md5('20/' || coalesce(source, 'null')), 1, 8))::bigint / 4294967296.0::double as start
        from levels),
    ranked as (
        select d.*, t.source_size, t.target, t.start,
               case when t.source_size > 0 then t.target / t.source_size else 0 end as each_one,
               row_number() over (partition by d.source order by d.size, d.doc_id % 4096, d.doc_id) as rank
        from mix_docs d join targets t on d.source is not distinct from t.source)
    select {columns}, (floor(rank * each_one + start) - floor((rank - 1) * each_one + start))::int as copies
    from ranked"""


ORACLES["op9_mixing"] = f"""
    select doc_id, size, source_size, target, size * copies as taken, copies
    from ({mixing_sql('documents', 'doc_id, size, source_size, target')}) mixed"""


@_query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "metadata.page_id", "response.payload_bytes", "response.payload_digest", "response.record_type", "response.refers_to",
        F.col("request").isNotNull().alias("has_request"),
    )


ORACLES["op10_warc"] = """
    with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
                      sha256(coalesce(html, '')) as payload_digest from pages),
    firsts as (select payload_digest, min(page_id) as first_page from p where payload_bytes >= 100 group by payload_digest)
    select p.page_id, p.payload_bytes::bigint as payload_bytes, p.payload_digest,
           case when f.first_page <> p.page_id then 'revisit' else 'response' end as record_type,
           case when f.first_page <> p.page_id then f.first_page end as refers_to, true as has_request
    from p left join firsts f on f.payload_digest = p.payload_digest and p.payload_bytes >= 100"""


#: Vocabulary of the published token files.
TOKENIZER = "word_bpe_49k.json"


@_query
def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@_query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    named = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", named), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


_PHRASE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _ascii_lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def contamination_sql(documents: str) -> str:
    """Common table expressions ending in hit_words (doc_id, item_id, word) of a table of documents."""
    return f"""
    phrase_docs as (select doc_id, regexp_extract_all({_ascii_lower('text')}, '{_PHRASE_WORD}') as ws from {documents}),
    phrase_items as (
        select item_id, regexp_extract_all({_ascii_lower('text')}, '{_PHRASE_WORD}') as ws from benchmark where item_id is not null),
    item_windows as (
        select distinct item_id, least(len(ws), 10) as n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') as w
        from (select item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as i from phrase_items where len(ws) > 0) starts),
    doc_windows as (
        select doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') as w
        from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i
              from phrase_docs, (select distinct n from item_windows) lengths) starts),
    hit_words as (
        select doc_id, item_id, unnest(range(i, i + n)) as word
        from doc_windows join item_windows using (n, w))"""


ORACLES["op1_decontamination"] = f"""
    with {contamination_sql('documents')},
    per_doc as (
        select doc_id, count(distinct word) as n_hit, count(distinct item_id) as n_items,
               string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as named
        from hit_words group by doc_id)
    select d.doc_id, len(d.ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
           sha256(coalesce(named, '')) as items_sha256, n_hit is not null as contaminated
    from phrase_docs d left join per_doc using (doc_id)"""


@_query
def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def jaccard_sql(documents: str) -> str:
    """Common table expressions of a recursive query ending in jaccard_classes (doc_id, n_shingles, component_id)."""
    return f"""
    shingle_docs as (select doc_id, regexp_extract_all({_ascii_lower('text')}, '{_WORD}') as ws from {documents}),
    shingles as (
        select distinct doc_id, array_to_string(ws[i:i + least(len(ws), 5) - 1], ' ') as s
        from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as i from shingle_docs where len(ws) > 0) starts),
    set_sizes as (select doc_id, count(*) as n from shingles group by doc_id),
    set_overlaps as (
        select a.doc_id as x, b.doc_id as y, count(*) as common from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id
        group by a.doc_id, b.doc_id),
    set_links as (
        select x, y from set_overlaps join set_sizes sx on sx.doc_id = x join set_sizes sy on sy.doc_id = y
        where 100 * common >= 80 * (sx.n + sy.n - common)),
    both_ways as (select x, y from set_links union all select y, x from set_links),
    reached as (
        select doc_id as x, doc_id as y from shingle_docs
        union
        select r.x, b.y from reached r join both_ways b on b.x = r.y),
    jaccard_classes as (
        select d.doc_id, coalesce(max(n), 0)::bigint as n_shingles, min(y) as component_id
        from shingle_docs d left join set_sizes s on s.doc_id = d.doc_id join reached r on r.x = d.doc_id group by d.doc_id)"""


ORACLES["op8_ngram_jaccard"] = f"with recursive {jaccard_sql('documents')} select doc_id, n_shingles, component_id from jaccard_classes"


def _span_report(found: DataFrame, kinds) -> DataFrame:
    base = secrets.of_kinds(F.col("spans"), kinds)
    return found.select(
        "doc_id", *[secrets.count_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"),
    )


@_query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_report(secrets.scan_secrets(table(spark, sf_dir, "documents")), list(secrets.RULES[1]))


@_query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_report(pii.protected_spans(table(spark, sf_dir, "documents")), pii.BASE_KINDS)


_TRAP = "\\### Assistant: </turn> ok"


@_query
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    trap = spark.createDataFrame([(-7, 0, "user", _TRAP), (-7, 1, "assistant", _TRAP)], "conv_id long, turn long, role string, text string")
    return chat.round_trip(conversations.unionByName(trap))


ORACLES["op2_chat_format"] = r"""
    with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    states as (
        select *, lag(role) over (partition by conv_id order by turn, role, text) as before,
               lead(role) over (partition by conv_id order by turn, role, text) as after,
               regexp_replace(text, '\\|### |</turn>|: ', '\\\0', 'g') as escaped,
               case role when 'system' then 'System' when 'user' then 'User' when 'assistant' then 'Assistant' when 'tool' then 'Tool' end as name
        from turns)
    select conv_id, count(*) as n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
           sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
           sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
           sum(length('### ' || name || ': ' || escaped || '</turn>' || chr(10)))::bigint as formatted_chars,
           bool_and(case when before is null then role in ('system', 'user')
                         when before = 'system' then role = 'user'
                         when before = 'user' then role = 'assistant'
                         when before = 'assistant' then role = 'user' else false end
                    and (after is not null or role = 'assistant')) as valid
    from states group by conv_id"""


@_query
def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def _with_cycles(documents: DataFrame) -> DataFrame:
    """doc_id, text; one document in ten, by a checksum of its id, repeats the words from some point on with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), n_words(F.col("text"))

    def cycled(ws, start):
        period = 1 + F.floor((F.size(ws) - start) / (3 + g % 8)).cast("int")
        return let(period, lambda p: F.transform(ws, lambda w, i: F.get(ws, F.when(i < start, i).otherwise(start + (i - start) % p))))

    joined = let(words(F.col("text")), lambda ws: F.array_join(
        let((g % F.size(ws)).cast("int"), lambda start: cycled(ws, start)), " "))
    return documents.select("doc_id", F.when((h % 10 == 0) & (n > 0), joined).otherwise(F.col("text")).alias("text"))


@_query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(_with_cycles(table(spark, sf_dir, "documents")))
    # The greatest length / period first; correctly rounded quotients of such integers are equal only if the ratios are.
    ranked = F.transform("runs", lambda r: F.struct(
        (-(r["length"] / r["period"])).alias("worst"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    best = F.array_min(ranked)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.call_function("div", best["length"] * 1000, best["period"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@_query
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


@_query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
