"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns; and the parts no query reaches."""

import gzip
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from marlstone.llm import chat, common, decontaminate, jaccard, mixing, pii, quality_model, quality_rules, secrets, token_records, warc
from marlstone.storage import scratch_path
from marlstone.llm.components import components
from marlstone.llm.queries import TOKENIZER
import public_tokenizers

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{k % 997}x{k}" for k in range(30_000))
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
ROWS = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4), (4, LONG, "en", "a", len(LONG)),
    (5, WORDS, "en", "b", 1), (5, WORDS, "en", "b", 1), (6, WORDS.upper(), "en", "b", 1), (7, "one two three", "en", None, 1),
    (None, "no id at all here, only words", "en", "b", 1), (8, "Ünï çode ### </turn> \\ 'S", "en", "b", 1),
]
#: Names that operators use for their own columns.
CLASHES = ("row", "size", "n_words", "label", "sid", "text_key", "tie", "spans", "blob")


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, DOCS)
    return frame.select("*", *[F.lit("other").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, "Beta, gamma delta; epsilon zeta eta theta iota kappa lambda mu"), (2, "TWO three"), (3, None), (4, " ,. "), (None, "one two"),
         (2, "TWO three"), (5, "mu lambda kappa")],
        "item_id long, text string",
    )


# --- quality rules -----------------------------------------------------------

def test_rules_on_odd_texts(docs, nothing, spark):
    ledger = quality_rules.evaluate_rules(docs)
    got = {r.row.doc_id: r for r in ledger.collect()}
    assert got[1].n_words == got[2].n_words == got[3].n_words == 0 and got[3].n_lines == 0
    assert got[4].n_words == 30_000 and got[4].n_repeat_words == 0 and got[4].fail_bits == 0
    assert ledger.count() == len(ROWS) and quality_rules.evaluate_rules(nothing).count() == 0
    text = "a b c a b c x\nsame\nsame\n\nsame #|"
    row = quality_rules.evaluate_rules(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_words, row.n_repeat_words, row.n_symbols, row.n_lines, row.n_dup_lines) == (11, 6, 2, 4, 1)
    again = spark.createDataFrame([(1, "x x x x y")], "doc_id long, text string")  # windows that overlap themselves
    assert quality_rules.evaluate_rules(again).first().n_repeat_words == 4


def test_ablations(spark):
    ledger = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,), (5,)], "fail_bits long")
    got = {(r.policy, r.rule): tuple(r)[2:] for r in quality_rules.ablations(
        ledger, {"p": ("r0", "r1"), "q": ("r2",)}, {"r0": "", "r1": "", "r2": ""}).collect()}
    assert got == {("p", "r0"): (4, 4, 3, 1), ("p", "r1"): (1, 4, 0, 4), ("q", "r2"): (2, 2, 2, 0)}


# --- mixing ------------------------------------------------------------------

def test_mix_comes_near_targets(spark):
    rng = random.Random(1)
    rows = [(k, " ".join(["w"] * rng.choice([1, 3, 50, 400])), rng.choice(["a", "a", "a", "b", "c", None])) for k in range(3000)]
    mixed = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), sub_buckets=16)
    per = mixed.groupBy("row.source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"),
        F.first("source_size").alias("size"), F.max("copies").alias("most"),
    ).collect()
    for r in per:
        assert abs(r.taken - r.target) <= 401 and r.target <= 2 * r["size"] and r.most <= 2
    assert abs(sum(r.target for r in per) - 1.5 * sum(r["size"] for r in per)) < 1e-6
    again = mixing.mix_sources(spark.createDataFrame(rows[::-1], "doc_id long, text string, source string").repartition(7), sub_buckets=16)
    assert sorted((r.row.doc_id, r.copies) for r in mixed.collect()) == sorted((r.row.doc_id, r.copies) for r in again.collect())


def test_mix_of_odd_rows(docs, nothing, spark):
    mixed = mixing.mix_sources(docs)
    assert mixed.count() == len(ROWS) and mixing.mix_sources(nothing).count() == 0
    assert mixing.emitted(mixed).columns == docs.columns
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.target, r.copies) for r in mixing.mix_sources(empty).collect()] == [(0.0, 0), (0.0, 0)]


# --- decontamination ---------------------------------------------------------

@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_hits(docs, items, nothing, block_bytes):
    found = decontaminate.decontaminate(docs, items, block_bytes=block_bytes, shard_words=40)
    got = sorted((r.doc_id or -1, r.n_words, r.hits, r["items"]) for r in found.collect())
    assert got == sorted([
        (1, 0, [], []), (2, 0, [], []), (3, 0, [], []), (4, 30_000, [], []), (5, 12, [1, 12], [1]), (5, 12, [1, 12], [1]),
        (6, 12, [1, 12], [1]), (7, 3, [1, 3], [2]), (-1, 7, [], []), (8, 4, [], []),
    ])
    near = {r.doc_id: r.near_items for r in found.collect()}
    assert 5 in near[5] and near[8] == []  # the three words stand near each other, in another order
    assert decontaminate.decontaminate(nothing, items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).where("n_hit > 0").count() == 0
    assert sorted(r.doc_id or -1 for r in decontaminate.without_contaminated(docs, items).collect()) == [-1, 1, 2, 3, 4, 8]


def test_search_equals_scanning(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("abcdef") for _ in range(n))
    docs, items = [(k, text(rng.randint(0, 60))) for k in range(60)], [(k, text(rng.randint(0, 14))) for k in range(30)]
    got = {r.doc_id: r for r in decontaminate.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
        window=4, shard_words=200).collect()}
    for doc_id, body in docs:
        words, hit, named = body.split(), set(), set()
        for item_id, item in items:
            w = item.split()
            for at in range(max(1, len(w) - 3) if w else 0):
                window = w[at : at + 4]
                for k in range(len(words) - len(window) + 1):
                    if words[k : k + len(window)] == window:
                        hit |= set(range(k, k + len(window)))
                        named.add(item_id)
        assert got[doc_id].n_hit == len(hit) and got[doc_id]["items"] == sorted(named)


# --- Jaccard join ------------------------------------------------------------

def _brute_classes(docs):
    sets = {}
    for doc_id, text in docs:
        words = (text or "").encode().lower().split()
        n = min(5, len(words))
        sets[doc_id] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()
    least = {d: d for d in sets}
    moved = True
    while moved:
        moved = False
        for a in sets:
            for b in sets:
                shared = len(sets[a] & sets[b])
                if a < b and shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared) and least[a] != least[b]:
                    least[a] = least[b] = min(least[a], least[b])
                    moved = True
    return {d: (len(sets[d]), least[d]) for d in sets}


@pytest.mark.parametrize("chunk_sets", [jaccard.CHUNK_SETS, 8])
def test_classes_equal_brute_force(spark, chunk_sets):
    rng = random.Random(chunk_sets)
    docs = [(0, None), (1, ""), (2, "a b"), (3, "A b"), (4, "a b c")]
    shared = [f"s{k}" for k in range(40)]
    for base in range(5):
        words = [f"w{base}_{rng.randrange(300)}" for _ in range(rng.randint(20, 120))] + shared
        for _ in range(24):
            copy = words[:]
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            docs.append((len(docs), " ".join(copy[: rng.choice([len(copy), len(copy) - 5])])))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(frame, chunk_sets=chunk_sets).collect()}
    assert got == _brute_classes(docs)


def test_join_of_odd_rows(docs, nothing):
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in jaccard.classes(docs).collect())
    assert [x for x in got if x[0] in (1, 2, 3)] == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert [x for x in got if x[0] in (5, 6)] == [(5, 8, 5), (5, 8, 5), (6, 8, 5)]
    assert (7, 1, 7) in got and (-1, 3, None) in got
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 5, 7, 8]
    assert jaccard.classes(nothing).count() == 0


def test_one_of_each_keeps_every_class(spark):
    """Classes without any id, and different texts under one id, are classes of their own."""
    near = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [(None, "red green blue"), (None, "red green blue"), (None, "cyan pink"), (None, WORDS), (None, f"{near} a"), (None, f"{near} b"),
            (1, "first version of it"), (1, "quite another version"), (2, "First version of IT"), (None, "quite another version"),
            (None, ""), (None, ""), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in jaccard.one_of_each(docs).collect()]
    near_kept = [r for r in kept if r[1] and r[1].startswith(near)]
    assert len(near_kept) == 1
    assert sorted((r for r in kept if r not in near_kept), key=str) == sorted(
        [(None, "red green blue"), (None, "cyan pink"), (None, WORDS), (1, "first version of it"), (1, "quite another version"),
         (None, ""), (None, ""), (3, None)], key=str)
    assert jaccard.classes(docs).where("n_shingles > 0").select("root").distinct().count() == 6


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 200), (200, 100), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 200: 100}


# --- chat --------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def test_chat_reads_back(spark):
    odd = ["", None, "\\", "\\\\</turn>", "### User: hi</turn>\n### Assistant: ", "a\\", ": ", "</turn</turn>", "é\n\n"]
    rows = [(c, t, r, odd[(c + t) % len(odd)]) for c in range(9) for t, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    rows += [(50, 0, "assistant", "x"), (51, 0, "user", "x"), (52, None, None, "y"), (52, 1, "Odd: </turn>\\", "z"), (None, 0, "user", "q"),
             (53, 0, "user", "a"), (53, 1, "assistant", "b"), (53, 1, "assistant", "b")]
    got = {r.conv_id: r for r in chat.round_trip(spark.createDataFrame(rows, TURNS)).collect()}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=order)
        said = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        plain = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        g = got[conv]
        assert (g.n_turns, g.turns_sha256) == (len(turns), hashlib.sha256(plain.encode()).hexdigest())
        assert (g.loss_chars, g.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert g.valid == (conv in range(9))
    assert chat.round_trip(spark.createDataFrame([], TURNS)).count() == 0


def test_segments_bear_loss_on_answers_only(spark):
    rows = chat.format_conversations(spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a ### b")], TURNS)).orderBy("seq").collect()
    assert "".join(r.text for r in rows) == "### User: q</turn>\n### Assistant: a \\### b</turn>\n"
    assert [r.text for r in rows if r.loss] == ["a \\### b"] and rows[-1].state == chat.ACCEPTED


# --- secrets -----------------------------------------------------------------

def test_ledger_scans_only_what_is_unseen(spark):
    path = scratch_path(spark, "ledger")
    first = spark.createDataFrame([(1, "password = abcdefghijkl"), (2, "password = abcdefghijkl"), (3, None)], "doc_id long, text string")
    secrets.update_ledger(first, path, versions=(1,))
    assert spark.read.parquet(path).count() == 2
    more = first.unionByName(spark.createDataFrame([(4, "ghp_" + "a1B2" * 9)], "doc_id long, text string"))
    secrets.update_ledger(more, path)
    ledger = spark.read.parquet(path)
    assert sorted((r.rule_version, r["count"]) for r in ledger.groupBy("rule_version").count().collect()) == [(1, 3), (2, 3)]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secrets.findings(more, path).collect()}
    assert got == {1: [("assign", 0, 23)], 2: [("assign", 0, 23)], 3: [], 4: [("github", 0, 40)]}
    secrets.update_ledger(more, path)
    assert spark.read.parquet(path).count() == 6


def test_secrets_in_odd_rows(docs, nothing):
    assert secrets.scan_secrets(docs).count() == len(ROWS) and secrets.scan_secrets(nothing).count() == 0
    find = secrets.scanner()
    assert find("secret: token = abcdefghijkl", 1) == []  # the first match is too short and is not tried again
    assert [(s["start"], s["end"]) for s in find("x API_KEY='ABC=def/ghi+12'", 1)] == [(2, 25)]
    assert find("paſſword = abcdefghijklmn", 1) == []


# --- personal data -----------------------------------------------------------

def test_entities():
    kinds = lambda text: [(k, text[b:e]) for b, _, e, k in pii.entities(text)]
    assert kinds("a@b.c_x@d.ee @ x@y") == [("email", "a@b.c"), ("email", "_x@d.ee")]
    assert kinds("1.2.3.4.5 256.1.1.1 010.0.0.255") == [("ip", "1.2.3.4"), ("ip", "010.0.0.255")]
    assert kinds("4111 1111-1111 1111x") == [("card", "4111 1111-1111 1111")] and kinds("4111111111111112") == []
    assert kinds("+1 (555) 010-9999. +12") == [("phone", "+1 (555) 010-9999")]
    assert kinds("a" * 200_000 + " " + "1." * 50_000) == [("ip", "1.1.1.1")] * 12_500


#: Different texts that share no five words in a row.
OTHERS = [f"{a} {b} {c} by {k} {a}{k} and {b}{k}" for k, (a, b, c) in enumerate(
    (x, y, z) for x in ("red", "blue", "green", "grey") for y in ("barn", "mill", "farm", "ford") for z in ("roof", "door", "gate", "wall"))]


def test_terms_that_disclose_are_hidden(spark):
    rows = [(k, f"{OTHERS[k]} please write to Quibbleton the clerk at me{k % 2}@x.org about it {OTHERS[k + 5]}") for k in range(4)]
    rows += [(k, f"please write to the clerk about it at noon {OTHERS[k]}") for k in range(10, 60)] + [(99, None), (99, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.sanitise(docs, generalise=0.5, remove=0.99).collect()}
    assert " please write to [NAME] the clerk at [EMAIL] about it " in got[0] and got[10] == rows[4][1] and got[99] is None
    assert len(got) == len(rows) - 1 and "[NAME]" in got[1]


def _shingles(text):
    words = text.lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()


def _documents_of(rows, names):
    """Texts of each document: equal texts are one, and so are linked texts with an entity that several texts hold."""
    texts = sorted({text for _, text in rows})
    shared = {c for c in set().union(*names.values()) if sum(c in names[t] for t in texts) >= pii.SUPPORT}
    near = [t for t in texts if names[t] & shared]
    home = {t: {t} for t in texts}
    for x in near:
        for y in near:
            a, b = _shingles(x), _shingles(y)
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                both = home[x] | home[y]
                for t in both:
                    home[t] = both
    return {frozenset(x) for x in home.values()}


def _brute_disclosed(rows, generalise, remove):
    """All spans of each document by the formula, over sets of whole documents."""
    spans = {text: pii.entities(text) for _, text in rows}
    names = {text: {pii.entity_name(text, b, e, kind) for b, _, e, kind in found} for text, found in spans.items()}
    groups = _documents_of(rows, names)
    held = [set().union(*(names[t] for t in group)) for group in groups]
    terms = [set().union(*(pii.TERM.findall(t) for t in group)) for group in groups]
    out = {}
    for k, text in rows:
        out[k] = [(b, e, kind) for b, _, e, kind in spans[text]]
        for m in pii.TERM.finditer(text):
            if any(b < m.end() and m.start() < e for b, _, e, _ in spans[text]):
                continue
            most = 0
            for c in names[text]:
                n_c, n_t = sum(c in x for x in held), sum(m.group() in x for x in terms)
                n_ct = sum(c in x and m.group() in y for x, y in zip(held, terms))
                if n_ct >= pii.SUPPORT and n_c < len(groups):
                    most = max(most, math.log(n_ct * len(groups) / (n_c * n_t)) / math.log(len(groups) / n_c))
            if most >= generalise:
                out[k].append((m.start(), m.end(), "removed" if most >= remove else "generalised"))
    return {k: sorted(x) for k, x in out.items()}


def _protected(docs, **thresholds):
    return {r.doc_id: sorted((s["start"], s["end"], s["kind"]) for s in r.spans) for r in pii.protected_spans(docs, **thresholds).collect()}


def test_disclosing_terms_of_whole_documents(spark):
    far, long = "and so on " * 60, "x" * 500
    rows = [(k, f"Quibbleton {OTHERS[k]} {far} at me@x.org {long} {OTHERS[k + 9]} says Quibbleton {OTHERS[k + 20]}") for k in range(3)]
    rows += [(3, f"Quibbleton {far} call +1 555 010 9999"), (4, "Quibbleton only"), (5, "me@x.org")]
    rows += [(k, f"{far} at noon nr {k}") for k in range(10, 64)] + [(k, f"{far} at noon nr 60") for k in range(64, 70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert _protected(docs, generalise=0.1, remove=0.2) == _brute_disclosed(rows, 0.1, 0.2)
    hidden = {r.doc_id: r.text for r in pii.sanitise(docs, generalise=0.4, remove=0.99).collect()}
    assert all("Quibbleton" not in hidden[k] and long not in hidden[k] for k in range(3))
    assert hidden[3].startswith("Quibbleton") and hidden[4] == "Quibbleton only"


def test_copies_disclose_nothing(spark):
    """Two copies, exact or near, of a text with an entity hide no word of it; the name that different texts share is hidden."""
    copy = "contact ann at ann@ex.org about maple walnut cherry timber before the end of the month or later on if need be thanks"
    rows = [(1, copy), (2, copy), (3, copy + " ann"), (4, copy + " again ann"), (5, copy)]
    plain = [(k, f"about the {OTHERS[k]} timber") for k in range(10, 60)]
    planted = [(100 + k, f"{OTHERS[k]} ask Quibbleton or ann@ex.org for {OTHERS[k + 7]}") for k in range(3)]
    planted += [(200 + k, text) for k, (_, text) in enumerate(planted)]
    docs = spark.createDataFrame(rows + plain + planted, "doc_id long, text string").repartition(4)
    got = _protected(docs)
    assert got == _brute_disclosed(rows + plain + planted, 0.75, 0.95)
    # Of the copies' words only those are hidden that the other texts with this address have as well.
    assert {rows[k - 1][1][b:e] for k in range(1, 6) for b, e, kind in got[k] if kind in ("generalised", "removed")} <= {"ann", "or"}
    for k, text in planted:
        at = text.index("Quibbleton")
        assert [s for s in got[k] if s[2] in ("generalised", "removed") and s[:2] == (at, at + 10)]


def test_entities_without_neighbours_count(spark):
    """Documents that are only an entity, or entities alone, hold it: n_c is 5 here, and the name discloses less of it."""
    rows = [(k, f"Quibbleton {OTHERS[k]} at me@x.org") for k in range(2)]
    rows += [(2, "me@x.org"), (3, "me@x.org "), (4, "me@x.org,me@x.org"), (5, "me@x.org")]
    rows += [(k, f"noon {k}") for k in range(10, 64)] + [(k, f"Quibbleton {k}") for k in range(70, 76)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _protected(docs, generalise=0.4, remove=0.5) == _brute_disclosed(rows, 0.4, 0.5)


def test_personal_data_in_odd_rows(docs, nothing):
    found = pii.protected_spans(docs).collect()
    assert len(found) == len(ROWS) and not any(r.spans for r in found) and pii.protected_spans(nothing).count() == 0


# --- quality model -----------------------------------------------------------

def test_model_without_labels(docs, nothing, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_model.score(docs, labels).collect()} == {0.5}
    odd = spark.createDataFrame([(5, 1, 0), (5, 1, 0), (None, 0, 0), (7, None, 0), (8, 1, None)], labels.schema)
    got = quality_model.score(docs, odd).collect()
    assert len(got) == len(ROWS) and all(0 < r.score < 1 for r in got)
    assert quality_model.score(nothing, odd).count() == 0


# --- token records -----------------------------------------------------------

def test_token_files(docs, nothing, spark):
    tokenizer = public_tokenizers.path(TOKENIZER)
    path = scratch_path(spark, "tokens")
    token_records.write_sequences(docs, path, tokenizer, file_bytes=100)
    got = token_records.read_sequences(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 4, 5, 5, 6, 7, 8] and [r.n_tokens for r in got[1:4]] == [1, 1, 1]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    places = token_records.read_index(spark, path).where("doc_id in (7, 8)")
    taken = {r.doc_id: r.ids for r in token_records.read_at(places, path).collect()}
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokenizer)
    assert taken == {k: [*library.encode(t, add_special_tokens=False).ids, 2] for k, t in ((7, ROWS[7][1]), (8, ROWS[9][1]))}
    assert token_records.round_trip(nothing, tokenizer).count() == 0


def test_files_are_in_order_whatever_the_job_s_id(spark):
    names = [f"part-{task:05}-{job}-c{n:03}.txt" for task in (0, 1, 12) for job in ("7d0e51aa-c41b-4f0c-9c1d-c0ffee123456",) for n in (0, 1, 2, 1000)]
    table = spark.createDataFrame([(name,) for name in reversed(names)], "file string").coalesce(1)
    assert [r.file for r in table.orderBy(*token_records.file_order(F.col("file"))).collect()] == names


def test_encoder_agrees_with_the_library():
    encoder = token_records.Encoder(public_tokenizers.path(TOKENIZER))
    rng = random.Random(5)
    pieces = [*"aZ eÉßİıſƻK'.,<|>!́ 　\t\n0½ªΣς一_-’«…\U0001F600ẞ", "<|endoftext|>", "<|STARTOFTEXT|>", "don't", "I'LL"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert encoder([text]) == [encoder.packed(encoder.tokenizer.encode(text, add_special_tokens=False).ids)], repr(text)


def test_encoder_s_memory_is_bounded_in_bytes(monkeypatch):
    encoder = token_records.Encoder(public_tokenizers.path(TOKENIZER))
    monkeypatch.setattr(token_records, "CACHED_BYTES", 20_000, raising=False)
    most = 0
    for k in range(60):  # the last runs are too long to be remembered at all
        text = " ".join(f"w{k}x{n}{'q' * k * 10}, Abc{n}" for n in range(10)) + " é" * (k > 55) + "9z" * 200 * k
        assert encoder([text]) == [encoder.packed(encoder.tokenizer.encode(text, add_special_tokens=False).ids)]
        most = max(most, sum(len(run) + len(ids) for run, ids in encoder.items()))
    assert 0 < most <= 20_000


def test_plain_words_are_encoded_once_a_batch_without_memory(monkeypatch):
    class Counted:
        def __init__(self, inner):
            self.inner, self.words = inner, 0

        def tokenize(self, word):
            self.words += 1
            return self.inner.tokenize(word)

        def encode_batch_fast(self, texts, **options):
            self.words += sum(text.count("!") for text in texts)
            return self.inner.encode_batch_fast(texts, **options)

    encoder = token_records.Encoder(public_tokenizers.path(TOKENIZER))
    monkeypatch.setattr(token_records, "CACHED_BYTES", 2_000)
    words = [f"{a}{b}{c}" for a in ("stone", "über", "née") for b in "abcdefghij" for c in "klmnopqrst"]
    texts = [" ".join(word.title() + "!" * (k % 3) if k % 2 else word for word in words) for k in range(20)]
    expected = [encoder.packed(encoder.tokenizer.encode(text, add_special_tokens=False).ids) for text in texts]
    encoder.model, encoder.bare = Counted(encoder.model), Counted(getattr(encoder, "bare", None))
    assert encoder(texts) == expected and encoder.model.words + encoder.bare.words == len(words) == 300


def test_plain_letters_are_lowered_as_the_library_does():
    encoder = token_records.Encoder(public_tokenizers.path(TOKENIZER))
    texts = [f"a{chr(code)}b {chr(code)} {chr(code)}," for code in range(0x21, 0x2AF)]
    for text, ids in zip(texts, encoder(texts)):
        assert ids == encoder.packed(encoder.tokenizer.encode(text, add_special_tokens=False).ids), repr(text)
    assert encoder([None, "", " \n"]) == [b"", b"", b""] and encoder(["", "one", None]) == [b"", *encoder(["one"]), b""]


def test_a_worker_gives_back_what_earlier_steps_freed():
    def held():
        with open("/proc/self/smaps_rollup") as file:
            return sum(int(line.split()[1]) for line in file if line.startswith("Pss_Anon:")) / 1024

    texts = [bytes(5_000) for _ in range(40_000)]
    last = bytes(5_000)  # lies behind them, so that the C library cannot shorten its heap by itself
    full = held()
    del texts
    common.release_memory()
    assert len(last) == 5_000 and full - held() > 150


def test_token_steps_begin_by_giving_memory_back(docs, tmp_path, monkeypatch):
    def noted():
        with open(f"{folder}/notes", "a") as file:
            file.write("x\n")

    folder = str(tmp_path)
    monkeypatch.setattr(token_records, "release_memory", noted, raising=False)
    assert token_records.round_trip(docs, public_tokenizers.path(TOKENIZER)).count() == len(ROWS)
    assert len(open(f"{folder}/notes").readlines()) >= 3  # files written, index made, files read


def test_damaged_record_is_noticed():
    data = token_records.framed(token_records.struct.pack(token_records.OWNER, True, 7) + b"\x01\x00")
    head = token_records.MAGIC + token_records.struct.pack(token_records.HEAD, 2, len(data))
    assert [(d, ids.tolist()) for _, _, d, ids in token_records.parse_file(head + data + b"\n", True)] == [(7, [1])]
    with pytest.raises(ValueError):
        list(token_records.parse_file(head + data[:-6] + b"\x02" + data[-5:], True))


# --- WARC --------------------------------------------------------------------

def test_archives(spark):
    big = "x\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(3, "http://h.org/a?b#c", big), (1, "http://h.org/b", big), (2, None, None), (4, "bad url\r\nX: y", "tiny"), (5, "u", "tiny"),
            (None, "http://n", big), (6, "http://h", big + "ü"), (6, "http://h", big + "ü"), (6, "http://h", "other" * 40)]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"), payloads=True).collect()
    seen = sorted((r.metadata.page_id or -1, r.response.record_type, r.response.refers_to, r.response.payload_bytes) for r in got)
    n = len(big)
    assert seen == sorted([
        (-1, "revisit", 1, n), (1, "response", None, n), (2, "response", None, 0), (3, "revisit", 1, n), (4, "response", None, 4),
        (5, "response", None, 4), (6, "response", None, n + 2), (6, "response", None, n + 2), (6, "response", None, 200)],
        key=lambda x: tuple(map(str, x))) or sorted(seen, key=str) == sorted([
        (-1, "revisit", 1, n), (1, "response", None, n), (2, "response", None, 0), (3, "revisit", 1, n), (4, "response", None, 4),
        (5, "response", None, 4), (6, "response", None, n + 2), (6, "response", None, n + 2), (6, "response", None, 200)], key=str)
    assert all(r.request and r.n_records == 3 for r in got)
    assert {bytes(r.response.payload) for r in got if r.response.payload_ok} == {big.encode(), b"", b"tiny", (big + "ü").encode(), b"other" * 40}
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- pipeline ----------------------------------------------------------------

def test_stages_keep_the_columns(spark, docs, tmp_path):
    spark.createDataFrame([(1, WORDS)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    current = docs
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        current = stage(spark, current, str(tmp_path))
        assert current.columns == docs.columns
    assert [r.doc_id for r in current.select("doc_id").distinct().collect()] == [4]


def _warc(kind, name, block=b"", *, to=(), **fields):
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", *[f"WARC-Concurrent-To: {t}" for t in to]]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in fields.items()] + [f"Content-Length: {len(block)}"]
    return ("WARC/1.0\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


ANSWER = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\nbody \r\n\r\n\x00 more"


def _archive(k):
    return [
        _warc("warcinfo", f"<info{k}>", b"software: x"), _warc("request", f"<q{k}>", b"GET / HTTP/1.1\r\n\r\n", to=[f"<r{k}>"]),
        _warc("response", f"<r{k}>", ANSWER), _warc("metadata", f"<m{k}>", b"page-id: 7\r\nvia: a\r\n", to=[f"<r{k}>"]),
        _warc("resource", f"<s{k}>", b"no capture"),
    ]


@pytest.mark.parametrize("form", ["members", "one member", "padded", "plain"])
def test_foreign_archives_of_any_form(spark, tmp_path, monkeypatch, form):
    monkeypatch.setattr(warc, "PIECE_BYTES", 7)
    for k in range(2):
        records = _archive(k)
        if form == "plain":
            (tmp_path / f"a{k}.warc").write_bytes(b"".join(records))
        elif form == "one member":
            (tmp_path / f"a{k}.warc.gz").write_bytes(gzip.compress(b"".join(records)))
        else:
            (tmp_path / f"a{k}.warc.gz").write_bytes(b"".join(map(gzip.compress, records)) + b"\0" * (20 * (form == "padded")))
    found = warc.read_records(spark, str(tmp_path))
    assert sorted(r.record_id for r in found.collect()) == sorted(f"<{x}{k}>" for k in range(2) for x in ("info", "q", "r", "m", "s"))
    captures = {r.capture_id: r for r in warc.assemble(found).collect()}
    for k in range(2):
        one = captures[f"<r{k}>"]
        assert one.n_records == 3 and one.request.record_id == f"<q{k}>" and one.metadata.page_id == 7
        assert bytes(one.response.payload) == ANSWER.partition(b"\r\n\r\n")[2]
    assert sorted(r.record_id for r in warc.further_records(found).collect()) == ["<info0>", "<info1>", "<s0>", "<s1>"]


def test_archives_that_are_cut_off(tmp_path):
    data = gzip.compress(b"".join(_archive(0)))
    with pytest.raises(ValueError):
        list(warc.parse_records(warc.unpacked(data[:-30])))
    plain = b"".join(_archive(0))
    for end in (len(plain) - 9, 40, len(plain) // 2):
        with pytest.raises(ValueError):
            list(warc.parse_records([plain[:end]]))
    with pytest.raises(ValueError, match="no WARC record at byte"):
        list(warc.parse_records([plain + b"rest"]))
    assert list(warc.parse_records(warc.unpacked(b""))) == []


def test_captures_are_found_by_any_chain_of_identifiers(spark, tmp_path):
    """Repeated headers, identifiers that name the request, several records of a kind; and plain captures beside them."""
    records = [
        _warc("response", "<r1>", ANSWER), _warc("request", "<q1>", to=["<r1>"]), _warc("metadata", "<m1>", b"page-id: 1", to=["<q1>"]),
        _warc("metadata", "<m1b>", b"page-id: 2", to=["<q1>"]),
        _warc("request", "<q2>"), _warc("response", "<r2>", ANSWER, to=["<q2>", "<m2>"]), _warc("metadata", "<m2>", b"page-id: 5"),
        _warc("request", "<q2b>", to=["<q2>"]), _warc("request", "<q2c>", to=["<m2>"]),
        _warc("response", "<r3>", ANSWER), _warc("request", "<q3>", to=["<r3>"]), _warc("request", "<q3b>", to=["<r3>"]),
        _warc("metadata", "<m9>", b"page-id: 9", to=["<gone>"]), _warc("conversion", "<c3>", b"x", to=["<r3>"]),
    ]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    found = warc.read_records(spark, str(tmp_path))
    got = {r.capture_id: r for r in warc.assemble(found).collect()}
    assert {k: r.n_records for k, r in got.items()} == {"<m1>": 4, "<m2>": 5, "<r3>": 4, "<gone>": 1}
    assert got["<m1>"].response.record_id == "<r1>" and got["<m1>"].metadata.record_id == "<m1b>"
    assert got["<m2>"].request.record_id == "<q2c>" and got["<m2>"].response.record_id == "<r2>" and got["<m2>"].metadata.page_id == 5
    rest = sorted((r.capture_id, r.record_id) for r in warc.further_records(found).collect())
    assert rest == [("<m1>", "<m1>"), ("<m2>", "<q2>"), ("<m2>", "<q2b>"), ("<r3>", "<c3>"), ("<r3>", "<q3>")]


def test_two_writes_share_no_record_id(spark):
    pages = spark.createDataFrame([(1, "http://a/", "x" * 200, "c"), (2, "http://b/", "y" * 400_000, "c")], "page_id long, url string, html string, capture string")
    path = scratch_path(spark, "twice")
    for part in ("a", "b"):
        warc.write_archives(pages.withColumn("digest", F.lit("other")), f"{path}/{part}")
    captures = warc.assemble(warc.read_records(spark, path))
    assert captures.count() == 4 and captures.where("n_records = 3 and response.payload_ok").count() == 4


# --- other tokenizers ----------------------------------------------------------

@pytest.mark.parametrize("name, by_runs", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_any_tokenizer_file_gives_the_library_s_ids(spark, docs, name, by_runs):
    file = public_tokenizers.path(name)
    encoder, tokenizer = token_records.Encoder(file), Tokenizer.from_file(file)
    texts = [r[1] for r in ROWS] + ["Hello World,  it's\n\n12 o'clock <|endoftext|>x\u00a0y", " lead", "Stra\u00dfe e\u0301a \u0130"]
    assert encoder.by_runs == by_runs
    for text, ids in zip(texts, encoder(texts)):
        assert np.frombuffer(ids, encoder.kind).tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids
    got = sorted((r.doc_id is not None, r.doc_id, r.n_tokens) for r in token_records.round_trip(docs, file).collect())
    expected = [(r[0] is not None, r[0], len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1) for r in ROWS]
    assert sorted(got, key=str) == sorted(expected, key=str)
