"""Periodic runs, language identification and embedding whitening: brute force, held-out accuracy, odd rows."""

import hashlib
import math
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone.llm import bidiagonal, language_id, periodic_runs, whitening
from marlstone.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("runs", "x", "keep", "slot", "rank", "count", "component", "n", "position", "score")


def _documents(sf_dir):
    return sorted(pq.read_table(f"{sf_dir}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"])


# --- periodic runs -----------------------------------------------------------

def _runs(words, least_words=24, least_periods=3):
    """Every period on its own: stretches of words equal to the word one period on."""
    numbers = {}
    x = np.array([numbers.setdefault(w, len(numbers)) for w in words])
    found = {}
    for period in range(1, len(x) // least_periods + 1):
        equal = np.concatenate(([0], x[:-period] == x[period:], [0])).astype(int)
        edges = np.diff(equal)
        for start, end in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)):
            length = int(end - start + period)
            if length >= max(least_words, least_periods * period):
                found.setdefault((int(start), length), period)
    return sorted((start, length, period) for (start, length), period in found.items())


@st.composite
def _word_lists(draw):
    words = draw(st.lists(st.integers(0, draw(st.sampled_from([0, 1, 2, 40]))), max_size=120))
    if words and draw(st.booleans()):
        a = draw(st.integers(0, len(words) - 1))
        p = draw(st.integers(1, max(1, (len(words) - a) // 3)))
        words = [words[k] if k < a else words[a + (k - a) % p] for k in range(len(words))]
    return words


@settings(max_examples=150, deadline=None)
@given(st.lists(_word_lists(), max_size=5), st.sampled_from([3, 7, 24]))
def test_runs_of_packs_equal_brute_force(texts, least_words):
    text, start, length, period = periodic_runs.find_in_pack(texts, least_words)
    assert text.tolist() == sorted(text.tolist())
    for k, words in enumerate(texts):
        mine = text == k
        got = list(zip(start[mine].tolist(), length[mine].tolist(), period[mine].tolist()))
        assert sorted(got) == _runs(words, least_words) and got == sorted(got, key=lambda r: (r[0], r[2]))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=90), st.data())
def test_extensions(words, data):
    symbols = np.array([3, *words, 4])
    levels = periodic_runs.recompress(symbols)
    i = data.draw(st.integers(1, len(words) - 1))
    j = data.draw(st.integers(i + 1, len(words)))

    def plain(step):
        n = 0
        while symbols[i + n * step] == symbols[j + n * step]:
            n += 1
        return n

    for step in (1, -1):
        assert periodic_runs.extensions(levels, np.array([i]), np.array([j]), step).tolist() == [plain(step)]


def test_grammar_is_a_grammar():
    symbols = np.random.default_rng(0).integers(0, 3, 5000)
    levels = periodic_runs.recompress(np.concatenate([symbols, symbols[:1000]]))
    assert len(levels) < 60 and any(level.blocks for level in levels)
    for below, above in zip(levels, levels[1:]):
        parts = {}
        for k, symbol in enumerate(above.symbols):
            children = tuple(below.symbols[below.first[k] : below.first[k + 1]])
            assert parts.setdefault(symbol, children) == children and (len(children) <= 2 or len(set(children)) == 1)
        assert len(set(parts.values())) == len(parts)


def _cycled(doc_id, words):
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 or not words:
        return words
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    return [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]


def _report(doc_id, text):
    words = [w.decode() for w in _cycled(doc_id, (text or "").encode().split())]
    runs = _runs(words)
    dropped = {k for start, length, period in runs for k in range(start + period, start + length)}
    best = min(runs, key=lambda r: (-np.longdouble(r[1]) / r[2], r[0], r[2]), default=None)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in sorted(runs, key=lambda r: (r[0], r[2])))
    collapsed = " ".join(w for k, w in enumerate(words) if k not in dropped)
    exponent = (None,) if best is None else (1000 * best[1] // best[2],)
    return (doc_id, len(runs), *(best or (None,) * 3), *exponent,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed.encode()).hexdigest())


def test_periodic_runs_query(spark):
    got = sorted(tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF_DIR).collect())
    expected = [_report(r["doc_id"], r["text"]) for r in _documents(SF_DIR)]
    assert got == expected and sum(r[1] for r in got) > 10


def test_runs_of_odd_texts(spark):
    long = " ".join(["ab cd ef"] * 5000 + [f"w{k}" for k in range(20_000)] + ["ab cd ef"] * 5000)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, long), (5, "x " * 24), (5, "x " * 24), (6, "x " * 23), (None, "a b " * 12), (7, "ü ü " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("other").alias(c) for c in CLASHES])
    found = periodic_runs.find_runs(docs, pack_words=100)
    assert found.columns == ["doc_id", "runs", "collapsed"]
    got = {}
    for r in found.collect():
        got.setdefault(r.doc_id, []).append(([tuple(x) for x in r.runs], r.collapsed))
    assert got[1] == got[2] == got[3] == [([], "")]
    assert got[4][0][0] == [(0, 15_000, 3), (35_000, 15_000, 3)] and len(got[4][0][1].split()) == 20_006
    assert got[5] == [([(0, 24, 1)], "x")] * 2 and got[6] == [([], " ".join("x" * 23))]
    assert got[None] == [([(0, 24, 2)], "a b")] and got[7] == [([(0, 30, 1)], "ü ü")]
    assert periodic_runs.find_runs(docs.limit(0)).collect() == []


# --- language identification -------------------------------------------------

def test_languages_of_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op12_language_id"](spark, sf_dir).collect()}
    rows = _documents(sf_dir)
    assert len(got) == len(rows) and all(got[r["doc_id"]].held_out == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    unseen = [r for r in rows if got[r["doc_id"]].held_out and any(map(str.isalpha, r["text"] or ""))]
    right = sum(got[r["doc_id"]].lang_pred == r["lang"] for r in unseen)
    assert len(unseen) > 100 and right >= 0.97 * len(unseen)
    assert all(0 <= r.score <= 1 for r in got.values())


def _plain_grams(text):
    spaced = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split(" "))
    while "  " in spaced:
        spaced = spaced.replace("  ", " ")
    spaced = f" {spaced.strip()} "
    return [spaced[k : k + n] for n in (1, 2, 3) for k in range(len(spaced) - n + 1)]


def test_grams_do_not_depend_on_chunks(monkeypatch):
    text = "Der Älteste,  de l'été 12 abéc. x  "
    whole = language_id.gram_counts(text)
    assert whole[1].sum() == len([g for g in _plain_grams(text)]) - 1  # the space before the text starts n-grams, but is none
    for size in (1, 2, 3, 5):
        monkeypatch.setattr(language_id, "CHUNK", size)
        parts = language_id.gram_counts(text)
        assert parts[0].tolist() == whole[0].tolist() and parts[1].tolist() == whole[1].tolist()


def test_nearest_centroid_by_hand(spark):
    texts = {"aa": ["lorem ipsum dolor sit amet", "dolor amet lorem", "ipsum sit"], "bb": ["kva qua xyl zork", "zork kva xyl", "qua qua"]}
    rows = [(k * 7 + j, t, lang, "s", 1) for j, (lang, ts) in enumerate(texts.items()) for k, t in enumerate(ts * 6)]
    docs = spark.createDataFrame(rows, DOCS)
    got = language_id.identify(docs, centroids=2).collect()
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    df = np.zeros(language_id.DIMENSIONS)
    for r in train:
        df[language_id.gram_counts(r[1])[0]] += 1
    idf = np.log((1 + len(train)) / (1 + df)) + 1

    def dense(text):
        at, values = language_id.vector(text, idf)
        out = np.zeros(language_id.DIMENSIONS, np.float32)
        out[at] = values
        return out

    centres = [(lang, c) for lang in texts for c in language_id.centroids_of(np.array([dense(r[1]) for r in train if r[2] == lang]), 2)[0]]
    for r in got:
        text = next(x[1] for x in rows if x[0] == r.doc_id)
        near = [float(dense(text) @ c) for _, c in centres]
        assert r.lang_pred == centres[int(np.argmax(near))][0] and math.isclose(r.score, min(max(near), 1), abs_tol=1e-5)


def test_languages_of_odd_rows(spark):
    long = "palabra larga y otra " * 80_000
    rows = [(k, "the quick brown fox and the dog", "en", "a", 1) for k in range(40)] + [
        (k, "la palabra larga y otra mas", "es", "a", 1) for k in range(40, 80)] + [
        (100, None, "en", "a", 1), (101, "", "en", "a", 1), (102, " 12, 34! ", None, "a", 1), (103, long, None, None, 1),
        (None, "the dog", "en", "a", 1), (None, "la palabra", "xx", "a", 1), (104, "the fox", None, "a", 1), (104, "the fox", None, "a", 1),
        (105, "zzzz qqqq", None, "a", 1)]
    docs = spark.createDataFrame(rows, DOCS).select("*", *[F.lit("other").alias(c) for c in CLASHES])
    found = language_id.identify(docs)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score", "rejected"]
    got = {}
    for r in found.collect():
        got.setdefault(r.doc_id, []).append(r)
    assert {k: got[k][0].lang_pred for k in (100, 101, 102, 103, 104)} == {100: "und", 101: "und", 102: "und", 103: "es", 104: "en"}
    assert len(got[104]) == 2 and sorted(r.lang_pred for r in got[None]) == ["en", "es"]  # xx was never learned from
    assert got[105][0].rejected and got[100][0].score == 0 and not got[0][0].rejected
    assert language_id.identify(docs.limit(0)).collect() == []
    unlabelled = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in unlabelled.collect()} == {("und", 0.0)}


def test_sample_is_bounded_and_the_same_each_time(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.concat(F.lit("t"), "id").alias("text"))
    first, second = (sorted(map(tuple, language_id._sampled(docs.repartition(n), 50).collect())) for n in (3, 7))
    assert first == second and len(first) == 50
    same_id = docs.withColumn("doc_id", F.lit(1).cast("long"))
    assert language_id._sampled(same_id, 50).count() <= 50


# --- whitening ---------------------------------------------------------------

MATRICES = {
    "plain": lambda rng: rng.standard_normal((300, 24)),
    "fewer rows than columns": lambda rng: rng.standard_normal((5, 24)),
    "graded": lambda rng: rng.standard_normal((300, 24)) * np.logspace(0, -7, 24),
    "equal values": lambda rng: np.repeat([4.0, 3, 2, 1], 6)[:, None] * np.linalg.qr(rng.standard_normal((24, 24)))[0],
    "rank one": lambda rng: np.ones((9, 6)),
    "one column": lambda rng: rng.standard_normal((9, 1)),
    "repeated columns": lambda rng: rng.integers(0, 2, (40, 3)).astype(float)[:, [0, 1, 1, 2, 0]],
}


@pytest.mark.parametrize("name", MATRICES)
def test_solver_against_lapack(name):
    a = MATRICES[name](np.random.default_rng(1))
    r = np.zeros((a.shape[1], a.shape[1]))
    triangle = np.linalg.qr(a, mode="r")
    r[: len(triangle)] = triangle
    values, vectors = bidiagonal.right_vectors(r, 16)
    expected = np.linalg.svd(r, compute_uv=False)[:16]
    assert np.allclose(np.sqrt(values), expected, rtol=0, atol=1e-13 * expected[0])
    rank, used = np.linalg.matrix_rank(r), vectors.shape[1]
    assert used == min(rank, 16)
    assert np.allclose(vectors.T @ vectors, np.eye(used), atol=1e-12)
    assert np.allclose(r.T @ r @ vectors, vectors * values[:used], atol=1e-12 * values[0])


def test_dqds_keeps_small_values():
    """Singular values of a bidiagonal matrix over 30 orders of magnitude, to relative accuracy."""
    diagonal, above = np.logspace(0, -30, 16), np.logspace(-1, -31, 16)[:-1]
    got = np.sqrt(bidiagonal.singular_squares(diagonal, above))
    assert np.isclose(np.prod(got / np.sort(diagonal)[::-1]), 1, rtol=1e-12)  # the determinant, exactly known


def _expected(vectors):
    x = np.floor(64 * vectors.astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = (fit * n - s) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:16], directions[:, ::-1][:, :16]
    deviation = ((x * n - s).astype(object) ** 2).sum(axis=1)
    return n, deviation, (x * n - s) / n @ directions / np.sqrt(values), values / (centred**2).sum() * n


def test_whitening_query(spark):
    rows = sorted(pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pylist(), key=lambda r: r["vec_id"])
    vectors = np.array([r["embedding"] for r in rows], np.float32)
    n, deviation, whitened, explained = _expected(vectors)
    got = sorted(QUERIES["op13_whitening"](spark, SF_DIR).collect(), key=lambda r: (r.vec_id, r.component))
    assert [(r.vec_id, r.component) for r in got] == [(r["vec_id"], k) for r in rows for k in range(1, 17)]
    assert {r.n for r in got} == {n} and [r.deviation for r in got[::16]] == deviation.tolist()
    mine = np.array([r.whitened for r in got]).reshape(-1, 16)
    signs = np.sign((mine * whitened).sum(axis=0))
    assert np.allclose(mine * signs, whitened, atol=1e-8)
    assert np.allclose([r.explained for r in got[:16]], explained, rtol=1e-9)
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-10


def test_whitening_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(3)
    plain = rng.standard_normal((200, 4)).tolist()
    rows = [(k, v) for k, v in enumerate(plain)] + [(900 + k, plain[0]) for k in range(3)] + [
        (None, plain[1]), (1000, None), (1001, [1.0, None, 1.0, 1.0]), (1002, [1.0, math.nan, 1.0, 1.0]), (1003, [math.inf] * 4),
        (1004, [1.0, 2.0]), (1005, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    found = whitening.whiten(table.select("*", *[F.lit("other").alias(c) for c in CLASHES]))
    got = {}
    for r in found.collect():
        got.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert not {1000, 1001, 1002, 1003} & set(got) and all(sorted(c) == [1, 2, 3, 4] for c in got.values())
    assert all(r.whitened is None and r.deviation is None for k in (1004, 1005) for c in got[k].values() for r in c)
    n, deviation, whitened, _ = _expected(np.array(plain))
    for k in range(200):
        assert got[k][1][0].deviation == deviation[k] and got[k][1][0].n == n == 200
        assert all(math.isclose(abs(got[k][c + 1][0].whitened), abs(whitened[k, c]), abs_tol=1e-8) for c in range(4))
    assert got[900][1][0].whitened == got[0][1][0].whitened and got[None][2][0].whitened == got[1][2][0].whitened
    assert whitening.whiten(table.limit(0)).collect() == []
    assert whitening.whiten(table.where("vec_id = 1005")).collect() == []


def test_whitening_without_variance_and_with_huge_entries(spark):
    flat = spark.createDataFrame([(k, [float(k), 5.0]) for k in range(8)], "vec_id long, embedding array<double>")
    got = {r.component: r for r in whitening.whiten(flat).where("vec_id = 3").collect()}
    assert got[1].whitened is not None and got[1].explained == 1 and got[2].whitened is None and got[2].explained == 0
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    for r in whitening.whiten(huge).collect():
        assert r.deviation is None and r.n == 2 and (r.whitened is None) == (r.component == 2)
    one = spark.createDataFrame([(1, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert [(r.deviation, r.whitened, r.explained) for r in whitening.whiten(one).collect()] == [(0, None, 0.0)] * 2
