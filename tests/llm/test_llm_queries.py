"""Every query of the subpackage on the smallest tables, against SQL or brute force."""

import base64
import hashlib
import math
import re
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
from quern.llm import queries
from tools.check import TABLES, digest


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(con):
    return con.execute("SELECT doc_id, text, lang FROM documents ORDER BY doc_id").fetchall()


def rows(spark, sf, name):
    return {r[0]: r for r in entry.queries()[name](spark, sf).collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, con, sf, name):
    df = entry.queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns) and got
    assert digest(df.columns, got) == digest(columns, cur.fetchall())


def fold(doc_id, n):
    import zlib
    return zlib.crc32(str(doc_id).encode()) % n


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]


def test_scores(spark, sf, texts):
    got = rows(spark, sf, "op1_pitman_yor")
    train = Counter()
    for i, text, _ in texts:
        if fold(i, 7) != 2:
            train.update([*words(text), None])
    n, v = sum(train.values()), len(train)
    assert len(got) == len(texts)
    held = [0.0, 0.0]
    for i, text, _ in texts:
        tokens, r = [*words(text), None], got[i]
        base = sum(math.log10((train[t] + 1) / (n + 1 * (v + 1))) for t in tokens)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(i, 7) == 2, len(tokens), sum(t in train for t in tokens), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
        if r.held_out:
            held[0] += r.base_score
            held[1] += r.score
    assert held[1] > 0.97 * held[0]


def test_languages(spark, sf, texts):
    got = rows(spark, sf, "op5_language_id")
    held = [(got[i].lang_pred, lang) for i, _, lang in texts if fold(i, 5) == 0]
    assert all(got[i].held_out == (fold(i, 5) == 0) and 0 <= got[i].score <= 1 for i, _, _ in texts)
    assert sum(a == b for a, b in held) >= 0.97 * len(held)


def test_bytes(spark, sf, texts):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows(spark, sf, "op9_byte_bpe")
    for i, text, _ in texts:
        ids = plain.encode_ordinary(text)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_edits(spark, sf, texts):
    got = rows(spark, sf, "op8_imatch")
    follower = {i: texts[k - 1] for k, (i, _, _) in enumerate(texts)}  # next smaller id, the last one's is the first
    by_text = {}
    for i, text, _ in texts:
        half = len(text) // 2
        edited = text[:len(text) - half] + follower[i][1][:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert by_text.setdefault(text, got[i].fingerprint) == got[i].fingerprint
        if text == follower[i][1]:
            assert got[i].near_next == 1
    mean = lambda name: sum(r[name] for r in got.values()) / len(got)
    assert mean("near_edited") > 0.2 > 0.1 > mean("near_next")


def test_derivatives(spark, sf, con):
    made = entry.queries()["op6_warc_derivatives"](spark, sf).collect()
    pages = dict(con.execute("SELECT page_id, html FROM pages").fetchall())
    assert Counter(r.record_type for r in made) == {"metadata": len(pages), "conversion": len(pages)}
    assert len({r.record_id for r in made}) == 2 * len(pages)
    for r in made:
        sha1 = base64.b32encode(hashlib.sha1(pages[r.page_id].encode()).digest()).decode()
        assert r.source_digest == f"sha1:{sha1}" and r.refers_to.startswith("<urn:uuid:") and r.content_length > 0


def test_every_operator_has_a_query():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES) and "pipeline" in entry.queries()
