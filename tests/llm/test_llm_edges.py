"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns, hot groups."""

import base64
import gzip
import hashlib
import json
import math
import os
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quern.llm import (bpe_files, common, components, imatch, language_id, line_dedup, lm_score, mixing, multi_index, ngram_join, passage_dedup,
                       perfect_hash, pitman_yor, queries, recompression, warc)
from quern.plans import stage
from tools.check import digest

RANKS, PATTERN = queries.RANKS, queries.PATTERN
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, n_lines string, n_dropped int, lang_pred int, score string, "
          "ids string, bytes string, epoch string, n_tokens string, component_id string, kept string, n_words string, fingerprint int, block string")
LINE = "A line of more than forty characters that recurs in many documents"
PASSAGE = " ".join(f"word{i}" for i in range(60))


def vocabulary(seed, n, size):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(size)]
    return " ".join(rng.choice(words) for _ in range(n))


def documents():
    near = vocabulary(1, 200, 5000).split()
    texts = [(1, None), (2, ""), (3, "  \n\t "), (4, "a b"), (5, "a b"), (5, "a b"), (None, "a b"), (None, None), (6, "!!! 123"), (7, "The end"),
             (8, "same " * 300), (9, vocabulary(2, 30000, 20000)), (10, f"{LINE}\nx y z"), (11, f"x\n  {LINE.upper()}\t\n{LINE}"), (12, LINE),
             (13, LINE + "\n"), (14, f"{LINE}\r\nmore"), (15, f"before {PASSAGE} after"), (16, f"another {PASSAGE}\nand more"), (17, " ".join(near)),
             (18, "café naïve straße"), (19, "日本語のテキスト")]
    texts += [(100 + i, " ".join(near[:i] + ["changed"] + near[i + 1:])) for i in range(0, 200, 5)]  # one large group of near copies
    texts += [(400 + i, vocabulary(5, 50, 3000)) for i in range(30)]  # one large group of copies
    sources = ["big", "big", None, "small", "tiny"]
    return [(i, t, ["en", None, "fr"][k % 3], sources[k % 5], None, "x", 1, 2, "y", "z", "b", "e", "t", "c", "k", "w", 3, "q") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def sql(docs, text, **tables):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    return con.execute(text)


def same(df, cur):
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(columns, cur.fetchall())


# 1

def test_scores_of_edge_rows(docs, none):
    got = lm_score.scores(docs).collect()
    assert len(got) == docs.count() and all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert all(r.n_tokens == 1 for r in got if r.doc_id in (1, 2, 3)) and len([r for r in got if r.doc_id == 5]) == 2
    assert len({r.score for r in got if r.doc_id in (4, 5)}) == 1
    assert lm_score.scores(none).collect() == []


def test_table_counts_follow_the_seating_probabilities():
    stirling = pitman_yor.log_stirling(0.5)
    n, c = 40000, 3
    got = pitman_yor.seat(np.full(n, c), np.full(n, 4), np.full(n, 0.3), 1.0, 0.5, stirling, np.random.default_rng(1))
    weight = [math.exp(stirling[c, t]) * np.prod([1.0 + 0.5 * (4 + i) for i in range(t)]) * 0.3**t for t in (1, 2, 3)]
    assert np.allclose(np.bincount(got)[1:] / n, np.array(weight) / sum(weight), atol=0.01)
    large = pitman_yor.seat(np.full(50, 5000), np.full(50, 4), np.full(50, 0.3), 1.0, 0.5, stirling, np.random.default_rng(1))
    assert (large >= 1).all() and (large <= 5000).all() and large.mean() > 5


def test_predictive_probabilities_sum_to_one():
    counts, tables = np.array([5, 2, 1]), np.array([2, 1, 1])
    root = pitman_yor.predictive(np.array([2, 1, 1, 0]), np.array([1, 1, 1, 0]), 4, 3, 1 / 4, 1.0, 0.3)
    own = pitman_yor.predictive(np.append(counts, 0), np.append(tables, 0), 8, 4, root, 1.0, 0.5)
    assert math.isclose(root.sum(), 1) and math.isclose(own.sum(), 1)


# 2

def brute_classes(rows):
    sets, parent = [], {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
        parent[i] = i

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, (i, _) in enumerate(rows):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(i), top(rows[b][0])))
                parent[y] = x
    return {i: (len(s), top(i)) for (i, _), s in zip(rows, sets)}


@pytest.mark.parametrize("block", [4, 256])
def test_classes_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(3)
    rows = []
    for family in range(12):
        base = vocabulary(family, rng.choice([3, 5, 9, 40, 120]), 40 if family % 2 else 4000).split()
        for _ in range(45 if family < 2 else 6):
            own = [w if rng.random() > rng.choice([0, .01, .03, .06]) else f"x{rng.randrange(1000)}" for w in base]
            rows.append((len(rows), " ".join(own)))
    rows += [(len(rows), None), (len(rows) + 1, " \n")]
    got = ngram_join.classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_classes(rows)


@pytest.mark.parametrize("most", [{"WAVE_CELLS": 400}, {"WAVE_CELLS": 40, "MOST_WAVES": 0}, {"WAVE_BYTES": 4096}])
def test_waves_and_levels_lose_no_link(spark, monkeypatch, most):
    """Chained families of many sizes, whose blocks are compared in several waves."""
    for name, value in (most | {"BLOCK": 8, "FEW": 3, "SHORT_RUN": 4}).items():
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(5)
    rows, common_part = [], vocabulary(30, 12, 900).split()
    for family in range(6):
        base = vocabulary(31 + family, 260, 4000).split()
        for _ in range(40):  # beginnings of one text: neighbours in length link, and all share shingles
            rows.append((len(rows), " ".join(common_part + base[:rng.randrange(8, 260)])))
    got = ngram_join.classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_classes(rows)


def test_sets_of_pairs_move_once(spark):
    """Every set of a small class goes to one cell, however many candidate pairs it is in."""
    pairs = spark.createDataFrame([(a, b) for k in range(0, 300, 10) for a in range(k, k + 10) for b in range(a + 1, k + 10)], "a bigint, b bigint")
    heads = spark.createDataFrame([(i, i, 1, 5) for i in range(300)], "sid bigint, id bigint, copies bigint, size bigint")
    none = spark.createDataFrame([], "sid bigint, gid bigint")
    met = ngram_join._bundles(pairs, none, heads).collect()
    assert sorted(r.sid for r in met) == list(range(300)) and len({(r.cell, r.tag) for r in met}) == 30


def test_links_in_cells():
    sets = [np.arange(40, dtype=np.uint64) + np.uint64(x) for x in (0, 1, 900, 901, 2, 902, 5000)]
    tag = np.array([1, 1, 2, 2, 1, 2, 2])
    for few in (0, 8):
        ngram_join.FEW, before = few, ngram_join.FEW
        try:
            found = {frozenset(map(int, p)) for p in zip(*ngram_join.links_in_cell(2, tag, sets))}
        finally:
            ngram_join.FEW = before
        assert found == {frozenset(p) for p in ((0, 1), (0, 4), (1, 4), (2, 3), (2, 5), (3, 5))}
    across = ngram_join.links_in_cell(3, np.array([7, 9, 7, 9, 9, 7, 9]), sets)
    assert {frozenset(map(int, p)) for p in zip(*across)} == {frozenset(p) for p in ((0, 1), (0, 4), (2, 3), (3, 5))}


def test_steps_leave_no_tables_or_shuffle_files(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    rows = [(i, vocabulary(40 + i // 4, 80, 4000) + f" {i % 4}") for i in range(80)]
    table = common.kept(spark.createDataFrame(rows, "doc_id bigint, text string"), "rows")
    before, held = shuffled(), set(os.listdir(stage.shared_dir(spark)))
    common.kept(table.repartition(4, "doc_id").sortWithinPartitions("text"), "kept")
    assert shuffled() <= before
    assert spark.conf.get(common.RELEASE) == "false"
    assert ngram_join.classes(table).select("component_id").distinct().count() == 20
    left = {f.rpartition("-")[0] for f in set(os.listdir(stage.shared_dir(spark))) - held}
    assert not left & {"meetings", "pairs", "sets", "wanted", "groups", "bundles", "blocks", "found"}


def test_classes_of_edge_rows(docs, none):
    got = [tuple(r) for r in ngram_join.classes(docs).collect()]
    assert len(got) == docs.count()
    found = {r[0]: r[2] for r in got if r[0] is not None}
    assert found[1] == 1 and found[2] == 2 and found[5] == 4 and found[429] == 400 and found[195] == 17
    assert sorted((r[1], r[2]) for r in got if r[0] is None) == [(0, None), (1, 4)] or (1, 4) in [(r[1], r[2]) for r in got if r[0] is None]
    left = ngram_join.representatives(docs)
    assert left.columns == docs.columns and left.where("doc_id >= 100 OR text = 'a b'").count() == 2
    assert ngram_join.classes(none).collect() == [] and ngram_join.representatives(none).collect() == []


def test_one_row_of_each_class_stays(spark):
    copied, other = vocabulary(21, 60, 4000), vocabulary(22, 60, 4000)
    near, lone = " ".join(copied.split()[:-1]), vocabulary(23, 60, 4000)
    rows = [(1, copied), (None, copied), (None, lone),  # a copy of null id, a clean row of null id
            (2, near), (2, "kept beside a copy of its id"),  # one id, two texts
            (3, "twice"), (3, "twice"), (4, "as a pair"), (4, "AS A  pair"),  # repeated rows; equal sets
            (None, "never named"), (None, "never named"),  # a class of null ids only
            (5, other), (5, other + " more"), (5, other + " more"),  # one id, several sets of a class
            (6, None), (6, ""), (None, " ")]  # without words: link with nothing
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, source string").repartition(5)
    left = [tuple(r)[:2] for r in ngram_join.representatives(docs).collect()]
    free = [(1, copied), (None, lone), (2, "kept beside a copy of its id"), (3, "twice"), (None, "never named"), (6, None), (6, ""), (None, " ")]
    assert all(left.count(r) == 1 for r in free)
    rest = [r for r in left if r not in free]
    assert sorted(i for i, _ in rest) == [4, 5] and all(r in rows for r in rest)


def test_representatives_leave_one_table(spark):
    """A pipeline's later stages need the disk: only the table that the result reads stays."""
    rows = [(i, vocabulary(60 + i // 3, 70, 4000) + f" {i % 3}") for i in range(45)]
    table = common.kept(spark.createDataFrame(rows, "doc_id bigint, text string"), "rows")
    held = set(os.listdir(stage.shared_dir(spark)))
    left = ngram_join.representatives(table)
    assert sorted(r.doc_id for r in left.collect()) == list(range(0, 45, 3))
    assert {f.rpartition("-")[0] for f in set(os.listdir(stage.shared_dir(spark))) - held} == {"copies"}


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150)] + [(500, 500 + i) for i in range(1, 300)] + [(7, 7)]
    got = components.components(spark.createDataFrame(links, "a bigint, b bigint").repartition(9))
    want = {i: 0 for i in range(1, 61)} | {150: 100, 200: 100} | {500 + i: 500 for i in range(1, 300)}
    assert {r.node: r.root for r in got.collect()} == want


# 3

def test_vectors_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "CHUNK", 16)
    rng = np.random.default_rng(2)
    rows = []
    for k in range(300):
        centre = rng.normal(size=8) if k % 3 else np.ones(8)
        rows.append((k, [float(x) for x in centre + rng.normal(size=8) * 0.15], k % 2))
    rows += [(300 + i, [1.0] * 8, 0) for i in range(40)]
    rows += [(400, None, 0), (401, [0.0] * 8, 0), (402, [float("nan")] + [1.0] * 7, 0), (403, [float("inf")] * 8, 0), (404, [1.0] * 8, None),
             (405, [None] + [1.0] * 7, 0), (406, [1.0] * 7, 0), (407, [], 0), (300, [1.0] * 8, 0), (None, [1.0] * 8, 0)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, label int, n_links string, kept int").repartition(4)
    got = multi_index.near_vectors(df, target_recall=1.0).collect()
    assert len(got) == len(rows)
    ok = [r for r in rows if r[0] is not None and r[1] and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    unit = np.array([np.pad(r[1], (0, 8 - len(r[1]))) / np.linalg.norm(r[1]) for r in ok])
    label = np.array([r[2] for r in ok])
    linked = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    want = {}
    for r, n in zip(ok, linked.sum(1)):
        want[r[0]] = int(n)
    found = {r.vec_id: r.n_links for r in got}
    assert all(r.n_links == 0 and (r.kept or r.vec_id is None) for r in got if r.vec_id is None or r.vec_id in (400, 401, 402, 403, 404, 405, 407))
    truth, reached = sum(want.values()), sum(min(found[i], n) for i, n in want.items())
    assert all(found[i] <= n for i, n in want.items()) and reached >= 0.95 * truth > 0
    assert multi_index.near_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("most", [100_000, 8])
def test_rare_links_are_all_found(spark, monkeypatch, most):
    monkeypatch.setattr(multi_index, "PROBES", 8)  # none of them has a neighbour
    monkeypatch.setattr(multi_index, "MOST", most, raising=False)
    rng = np.random.default_rng(3)
    clean = rng.normal(size=(3000, 32))
    clean /= np.linalg.norm(clean, axis=1, keepdims=True)
    near = clean[:12] + 0.36 * rng.normal(size=(12, 32)) / np.sqrt(32)
    every = np.concatenate([clean, near / np.linalg.norm(near, axis=1, keepdims=True)])
    links = np.argwhere(np.triu(every @ every.T >= multi_index.SIMILARITY, 1))
    assert 5 <= len(links) <= 12
    df = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(every)], "vec_id bigint, embedding array<double>, label string")
    got = {r.vec_id: r for r in multi_index.near_vectors(df.repartition(4)).collect()}
    assert len(got) == len(every) and sum(r.n_links for r in got.values()) == 2 * len(links)
    assert all(got[b].component_id == a and got[a].n_links == got[b].n_links == 1 for a, b in links.tolist())


def test_cells_are_visited_nearest_first():
    rng = np.random.default_rng(1)
    a, b = rng.random(9), rng.random(7)
    order = multi_index.sequence(a, b, 63)
    assert [c for _, c in order] == [int(c) for c in np.argsort((a[:, None] + b[None, :]).ravel(), kind="stable")]


# 4

def brute_passages(rows, size):
    where = {}
    split = [(i, (t or "").split()) for i, t in rows]
    for k, (_, w) in enumerate(split):
        for p in range(len(w) - size + 1):
            where.setdefault(tuple(w[p:p + size]), []).append((k, p))
    gone = [set() for _ in split]
    for places in where.values():
        if len(places) > 1:
            for k, p in places:
                gone[k] |= set(range(p, p + size))
    return sorted((i, len(w), len(g), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in g).encode()).hexdigest())
                  for (i, w), g in zip(split, gone))


@pytest.mark.parametrize("size, words", [(5, 3), (12, 2), (35, 30)])
def test_passages_by_brute_force(spark, size, words):
    rng = random.Random(size)
    rows = [(i, vocabulary(i, rng.randrange(0, 150), words)) for i in range(60)]
    passages = [vocabulary(100 + i, 80, 1000) for i in range(4)]
    rows += [(60 + i, f"{vocabulary(200 + i, 40, 500)} {' '.join(passages[i % 4].split()[i % 7:80 - i % 5])} {vocabulary(300 + i, 9, 500)}") for i in range(40)]
    rows += [(100, "a " * 200), (101, "a " * 36), (102, "a " * 35), (103, "b " * 35), (104, None), (105, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert sorted(tuple(r) for r in passage_dedup.digests(df, size=size).collect()) == brute_passages(rows, size)


def test_passages_of_edge_rows(docs, none):
    out = passage_dedup.dedup_passages(docs)
    assert out.columns == [c for c in docs.columns if c != "n_words"] + ["n_words", "n_removed"] and out.count() == docs.count()
    left = {r.doc_id: r.text for r in out.collect()}
    assert left[15] == "before after" and left[16] == "another and more" and left[8] == "" and left[1] is None and left[3] == "  \n\t "
    assert passage_dedup.dedup_passages(none).collect() == []


def test_equal_stretches_hold_equal_symbols():
    rng = np.random.default_rng(4)
    inner = rng.integers(0, 6, 80).astype(np.uint64)
    parses = []
    for n in (11, 40):
        words = np.concatenate([rng.integers(0, 6, n).astype(np.uint64), inner, rng.integers(0, 6, 30).astype(np.uint64)])
        doc = np.zeros(len(words), np.int64)
        found = []
        for level in recompression.levels(words, doc, np.array([0]), np.array([len(words)])):
            inside = (level.a >= n) & (level.b <= n + 80)
            found.append(list(zip(level.name[inside].tolist(), (level.a[inside] - n).tolist(), (level.b[inside] - n).tolist())))
        parses.append(found)
    assert parses[0] == parses[1] and all(parses[0][:4])


# 5

def test_languages_of_edge_rows(docs, none):
    filters = language_id.learn(docs)
    out = language_id.identify(docs, filters)
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == docs.count() and filters.langs == ["en", "fr"]
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 6)) and got[7].lang_pred in ("en", "fr") and got[19].lang_pred != "und"
    assert language_id.identify(none, filters).collect() == [] and language_id.learn(none).langs == []
    assert {r.lang_pred for r in language_id.identify(docs, language_id.learn(none)).collect()} == {"und"}
    assert set(language_id.predictions(docs).columns) == {"doc_id", "held_out", "lang_pred", "score"}


def test_more_languages_than_bits_in_a_word(spark):
    rows = [(i, " ".join(chr(0x4E00 + 10 * i + j) * 3 for j in range(5)) * 5, f"l{i:03d}") for i in range(70)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = language_id.identify(df, language_id.learn(df)).collect()
    assert all(r.lang == r.lang_pred for r in got)


# 6

def test_derived_records(spark):
    page = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\nServer: x\r\n\r\n<html><head><title>A &amp; B</title><style>p{}</style></head>"
            b"<body><!-- <a href='/no'>no</a> --><p>caf\xe9 &lt;1&gt;</p><script>var a = '<p>';</script><a href=\"/x?a=1&amp;b=2\">link</a><br>end<b")
    rows = [("<urn:uuid:1>", "http://e.org/d/", "2024", bytearray(page)), (None, None, None, None), ("<urn:uuid:1>", "http://e.org/d/", "2024", bytearray(page)),
            ("i", "http://e.org", "2024", bytearray(b"HTTP/1.1 404 Not Found\r\nContent-Type: image/png\r\n\r\n\x89PNG")), ("", "u", "", bytearray(b"plain <b>x</b>"))]
    df = spark.createDataFrame([(*r, "c") for r in rows], "record_id string, target_uri string, date string, block binary, content string")
    made = warc.derive(df)
    got = made.collect()
    assert len(got) == 10 and all(r.refers_to for r in got)
    meta, text = (next(r for r in got if r.refers_to == "<urn:uuid:1>" and r.record_type == k) for k in ("metadata", "conversion"))
    assert bytes(text.content).decode() == "café <1>\nlink\nend" and text.content_length == len(text.content)
    body = page.partition(b"\r\n\r\n")[2]
    assert text.source_digest == meta.source_digest == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
    about = json.loads(bytes(meta.content))["Envelope"]
    http = about["Payload-Metadata"]["HTTP-Response-Metadata"]
    assert about["WARC-Header-Metadata"]["WARC-Record-ID"] == "<urn:uuid:1>" and ["Server", "x"] in http["Headers"] and http["Response-Message"]["Status"] == 200
    assert http["HTML-Metadata"] == {"Title": "A & B", "Links": [{"path": "a@href", "url": "http://e.org/x?a=1&b=2"}]}
    assert all(r.content_length == 0 for r in got if r.refers_to == "i" and r.record_type == "conversion")
    for r in warc.members(made).collect():
        head, _, content = gzip.decompress(bytes(r.member)).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode()) and content[:-4] == bytes(r.content)
        assert f"WARC-Refers-To: {r.refers_to}".encode() in head
    assert warc.derive(df.limit(0)).collect() == []


# 7

def test_mixture_equals_sql_on_edge_rows(docs, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 4)
    got = mixing.mixture(docs, budget_share=1.0, target_entropy=queries.ENTROPY, max_epochs=4.0)
    want = queries.SQL_MIX.replace("/ 4096.0", "/ 4.0")
    same(got, sql(docs, want))


def test_largest_source_is_read_once(docs, none):
    out = mixing.mix(docs, max_epochs=2.0, target_entropy=1.0)
    assert set(out.columns) == set(docs.columns) | {"place"} and mixing.mix(none).collect() == []
    taken = out.groupBy("doc_id", "source", "text").count().collect()
    sizes = {}
    for r in docs.collect():
        sizes.setdefault(r.source, 0)
        sizes[r.source] += len((r.text or "").split())
    biggest = max(sizes, key=sizes.get)
    assert out.select("doc_id", "text").distinct().count() == docs.select("doc_id", "text").distinct().count()
    assert all(r["count"] <= 3 * 3 for r in taken) and all(r.epoch == 0 for r in out.collect() if r.source == biggest)


def test_exponent_meets_entropy_or_repetition(spark):
    shares = spark.createDataFrame([("a", 0.9), ("b", 0.09), ("c", 0.01)], "_skey string, _share double")
    step = mixing.exponent(shares, 3, 0.9, 1.0, 0.8, 100.0)
    entropy = lambda k: mixing._stats(shares, [k], 0.9, 1.0)[0][0]
    assert entropy(step) >= 0.8 * math.log(3) > entropy(step + 1)
    step = mixing.exponent(shares, 3, 0.9, 1.0, 0.8, 2.0)
    assert mixing._stats(shares, [step], 0.9, 1.0)[0][1] <= 2.0 < mixing._stats(shares, [step - 1], 0.9, 1.0)[0][1]


# 8

def test_fingerprints_of_edge_rows(docs, none):
    got = imatch.edits(docs).collect()
    assert len(got) == docs.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint) == 16 * imatch.FAMILIES for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[4].fingerprint == by_id[5].fingerprint and by_id[2].fingerprint == by_id[3].fingerprint and by_id[429].near_next == 1
    assert imatch.edits(none).collect() == []
    out = imatch.fingerprints(docs)
    assert {r.doc_id: r.fingerprint for r in out.collect()}[17] == by_id[17].fingerprint and out.count() == docs.count()
    assert imatch.edits(docs.where("doc_id = 7")).first().near_next == 1


# 9

def test_bytes_of_edge_rows(docs, none):
    out = bpe_files.decode(bpe_files.encode(docs, RANKS, PATTERN), RANKS, PATTERN)
    assert sorted(out.columns) == sorted(docs.columns)
    assert all(bytes(r.bytes).decode() == (r.text or "") for r in out.collect())
    once = bpe_files.encode(docs, RANKS, PATTERN, digest="kept")
    assert all(r.kept == hashlib.sha256((r.text or "").encode()).hexdigest() for r in once.collect())
    assert bpe_files.digests(none, RANKS, PATTERN).collect() == [] and bpe_files.digests(docs, RANKS, PATTERN).count() == docs.count()


def test_long_texts_are_cut_at_safe_places(monkeypatch):
    plain, rng = bpe_files.coder(public_tokenizers.path("byte_bpe_50k.tiktoken"), PATTERN), random.Random(1)
    monkeypatch.setattr(bpe_files, "PIECE", 40)
    monkeypatch.setattr(bpe_files, "_RUN", bpe_files.re.compile(f"[{bpe_files.SPACE}]{{5,}}"))
    parts = ["a", "b", "é", "1", "'s", " ", "  ", "\n", "\t", "\x1c", "\x85", "!", "日", " " * 7, "\n" * 6]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(300)))
        assert bpe_files.encode_text(plain, text) == plain.encode_ordinary(text)


def test_a_cut_character_decodes_to_raw_bytes(spark):
    df = spark.createDataFrame([([i],) for i in range(256)] + [(None,), ([],)], "ids array<int>")
    got = [r.bytes for r in bpe_files.decode(df, RANKS, PATTERN).collect()]
    assert got[-2] is None and bytes(got[-1]) == b"" and len({bytes(x) for x in got[:256]}) == 256
    million = bpe_files.encode_text(bpe_files.coder(RANKS, PATTERN), " " * 1_500_000 + "x")
    assert bpe_files.coder(RANKS, PATTERN).decode(million) == " " * 1_500_000 + "x"


# 10

@pytest.mark.parametrize("broadcast_keys", [None, 0])
def test_lines_equal_sql_on_edge_rows(docs, none, broadcast_keys):
    rows = docs.where("doc_id IS NOT NULL AND NOT (doc_id = 5)")
    same(line_dedup.digests(rows, broadcast_keys=broadcast_keys), sql(rows, queries.SQL_LINES))
    out = line_dedup.dedup_lines(docs, broadcast_keys=broadcast_keys)
    assert sorted(out.columns) == sorted(docs.columns) and out.count() == docs.count()
    left = {r.doc_id: r for r in out.collect()}
    assert left[10].text == "x y z" and left[12].text == "" and left[14].text == f"{LINE}\r\nmore" and left[11].n_dropped == 2 and left[1].text is None
    assert line_dedup.dedup_lines(none, broadcast_keys=broadcast_keys).collect() == []


def test_places_are_a_bijection():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 20000).astype(np.uint64))
    places = perfect_hash.Places(*perfect_hash.build(keys))
    assert sorted(places.of(keys).tolist()) == list(range(len(keys)))
    assert len(perfect_hash.Places(*perfect_hash.build(keys[:0])).of(keys)) == len(keys)
