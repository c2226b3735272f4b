"""The corpus queries against their SQL and, where SQL cannot express them, against plain Python."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from compare import connect, differences
from marlstone.llm import queries
from marlstone.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def documents():
    return sorted(pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


def _spans(text, patterns):
    found = []
    for rank, (kind, pattern, ok) in enumerate(patterns):
        found += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text) if ok(m)]
    return sorted(found)


SECRETS = (
    ("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
)


def _digits(m):
    return re.sub("[^0-9]", "", m[0])


def _luhn(digits):
    doubled = [int(d) * (2 if k % 2 else 1) for k, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


PERSONAL = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(_digits(m)) <= 19 and _luhn(_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(_digits(m)) <= 15),
)


@pytest.mark.parametrize("name, patterns", [("op3_secret_scan", SECRETS), ("op4_pii", PERSONAL)])
def test_base_spans(spark, documents, name, patterns):
    got = {row.doc_id: row for row in QUERIES[name](spark, SF_DIR).collect()}
    assert len(got) == len(documents)
    for doc in documents:
        spans = _spans(doc["text"] or "", patterns)
        listed = [f"{kind}:{b}:{e}" for b, _, kind, e in spans]
        row = got[doc["doc_id"]]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind, *_ in patterns] == [sum(s[2] == kind for s in spans) for kind, *_ in patterns]
        assert set(listed) <= set(row.spans.split(","))
        assert spans or not row.spans  # nothing is added where there is nothing to protect


def _token_rows(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    rows, start = [], 0
    for doc in docs:
        ids = [*tokenizer.encode(doc["text"] or "", add_special_tokens=False).ids, 2]
        rows.append((doc["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return rows


def test_token_records(spark, documents):
    got = QUERIES["op7_token_records"](spark, SF_DIR).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == _token_rows(documents)


def test_quality_model_on_held_out_rows(spark):
    scored = {r.doc_id: r for r in QUERIES["op6_quality_model"](spark, "/root/testdata/sf0.01").collect()}
    labels = [r for r in pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pylist() if scored[r["doc_id"]].held_out]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in labels) and len(labels) > 50
    right = sum(scored[r["doc_id"]].predicted == r["quality"] for r in labels)
    assert right >= 0.95 * len(labels)
    assert all(0 <= r.score <= 1 for r in scored.values())


def test_pipeline(spark, con):
    con.execute(f"create table s1 as select d.* from documents d join ({ORACLES['op5_quality_rules']}) q using (doc_id) where kept")
    con.execute(f"""create table s2 as with recursive {queries.jaccard_sql('s1')}
                    select s1.* from s1 join jaccard_classes using (doc_id) where doc_id = component_id""")
    con.execute(f"create table s3 as with {queries.contamination_sql('s2')} select * from s2 where doc_id not in (select doc_id from hit_words)")
    drawn = con.execute(queries.mixing_sql("s3", "doc_id, text")).fetchall()
    docs = [{"doc_id": doc_id, "text": text} for doc_id, text, copies in sorted(drawn) for _ in range(copies)]
    counts = [con.execute(f"select count(*) from {t}").fetchall()[0][0] for t in ("documents", "s1", "s2", "s3")]
    assert counts == sorted(counts, reverse=True) and counts[-1] < counts[0]
    got = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == sorted(_token_rows(docs))
