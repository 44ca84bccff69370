"""Merkle manifest, whitening and token counts against brute force, edge rows included."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from quern.llm import merkle, queries, token_counts, whitening
from tests.llm.test_llm_edges import SCHEMA, documents, vocabulary


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# 11

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def up(nodes):
    """All levels of a tree, and of each place the steps to the top."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    paths = []
    for place in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            first = place - place % 3
            path.append(("".join(level[first:place]), "".join(level[place + 1:first + 3])))
            place //= 3
        paths.append(path)
    return levels[-1][0], paths


def expected_manifest(rows):
    groups = {}
    for i, source, lang, n_chars, text in rows:
        own = sha("".join(map(field, (i, source, lang, n_chars, text))))
        touched = i is not None and zlib.crc32(str(i).encode()) % 2 == 0
        seen = sha("".join(map(field, (i, source, lang, n_chars, text.replace("\n", "") if touched and text is not None else text))))
        groups.setdefault(source, []).append((i is not None, i or 0, own, seen, i))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort()
        trees[g] = up([m[2] for m in groups[g]])
    root, tops = up([trees[g][0] for g in order])
    out = []
    for g, top in zip(order, tops):
        for (_, _, own, seen, i), path in zip(groups[g], trees[g][1]):
            node = seen
            for left, right in [*path, *top]:
                node = sha(left + node + right)
            out.append((i, own, trees[g][0], root, sha("".join(a + b for a, b in [*path, *top])), node, node == root))
    return out


def manifest_rows(df):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]


def test_manifest_of_edge_rows(docs, none):
    got = [tuple(r) for r in merkle.tampered_proofs(docs).collect()]
    assert sorted(got, key=repr) == sorted(expected_manifest(manifest_rows(docs)), key=repr)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)
    assert merkle.tampered_proofs(none).collect() == []


@pytest.mark.parametrize("levels, sizes", [(1, [1, 2, 3, 4, 9, 10, 28, 100]), (2, [1, 9, 10, 27, 28, 82]), (1, [40]), (1, [1]), (3, [2, 30, 1])])
def test_blocks_swap_roots_until_all_know_their_proofs(spark, levels, sizes):
    rows = [(k * 7 % n, None if g == 0 else f"s{g}", "en", None, f"{g}\n{k}") for g, n in enumerate(sizes) for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(4)
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    made = merkle.manifest(df, merkle.leaf(*fields), "source", "doc_id", levels=levels)
    got = made.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")).cast("binary"), 256), merkle.fold(F.col("seen"), F.col("path")))
    want = [(i, own, sub, root, proof, root) for i, own, sub, root, proof, _, _ in expected_manifest(rows)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_partners_serve_every_block_once():
    for total in (1, 2, 5, 9, 10, 13, 30):
        width = 1
        while width < total:
            sizes = {t: min(width, total - t * width) for t in range(math.ceil(total / width))}
            taken = Counter()
            for p in range(total):
                tree, offset = divmod(p, width)
                first = tree - tree % 3
                for u in range(first, min(first + 3, len(sizes))):
                    taken.update((u * width + o, tree) for o in range(offset, sizes[u], sizes[tree]))
            for p in range(total):
                tree = p // width
                first = tree - tree % 3
                assert all(taken[p, t] == 1 for t in range(first, min(first + 3, len(sizes))))
            width *= 3


# 12

VECTORS = "vec_id bigint, embedding array<float>, label int, n string, component string, whitened int"


def vectors(seed, n, dims):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims)) @ rng.normal(size=(dims, dims)) * 0.3
    rows = [(i, [float(v) for v in np.float32(x)], 1, "a", "b", 3) for i, x in enumerate(base)]
    rows += [(n + i, rows[5][1], 1, "a", "b", 3) for i in range(60)]  # one vector of many copies
    rows += [(3, rows[3][1], 1, "a", "b", 3), (None, rows[4][1], 1, "a", "b", 3), (7001, None, 1, "a", "b", 3), (7002, [], 1, "a", "b", 3),
             (7003, [None] + [1.0] * (dims - 1), 1, "a", "b", 3), (7004, [math.nan] * dims, 1, "a", "b", 3),
             (7005, [math.inf] * dims, 1, "a", "b", 3), (7006, [1.0] * (dims + 1), 1, "a", "b", 3)]
    return rows


def expected_whitening(rows, dims, by_count=False):
    good = [(r[0], r[1]) for r in rows if r[1] is not None and len(r[1]) == dims and all(v is not None and math.isfinite(v) for v in r[1])]
    exact = [(i, tuple(math.floor(64 * float(c)) + 1000000 for c in v)) for i, v in good]
    counts = Counter(x for _, x in exact)
    fitted = list(counts)
    weights = np.array([counts[x] if by_count else 1 for x in fitted])
    n = int(weights.sum())
    sums = [sum(int(w) * x[d] for w, x in zip(weights, fitted)) for d in range(dims)]
    centred = {x: np.array([(n * v - s) / n for v, s in zip(x, sums)]) for x in fitted}
    m = np.array([centred[x] for x in fitted])
    cov = (m * weights[:, None]).T @ m / n
    values, parts = np.linalg.eigh(cov)
    return exact, n, sums, centred, values[::-1], parts[:, ::-1], np.trace(cov)


@pytest.mark.parametrize("fit", ["one", "counts"])
def test_whitening_equals_brute_force(spark, fit):
    dims, rows = 20, vectors(1, 300, 20)
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = whitening.whiten(df, fit=fit).collect()
    exact, n, sums, centred, values, parts, trace = expected_whitening(rows, dims, fit == "counts")
    assert Counter(r.vec_id for r in got) == Counter(i for i, _ in exact)
    by_id = {r.vec_id: r for r in got}
    first = by_id[0]
    signs = np.sign(np.array(first.whitened) * (centred[exact[0][1]] @ parts)[:16])
    for i, x in exact:
        r = by_id[i]
        assert r.n == n and r.deviation == sum((n * v - s) ** 2 for v, s in zip(x, sums)) and r.identity_error < 1e-9
        assert np.allclose(r.whitened, (centred[x] @ parts / np.sqrt(values))[:16] * signs, rtol=1e-7, atol=1e-9)
        assert np.allclose(r.explained, values[:16] / trace, rtol=1e-9)


def test_components_of_all_embeddings(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    dims = len(rows[0][1])
    exact, n, sums, centred, values, parts, trace = expected_whitening(rows, dims)
    got = queries.op12_whitening(spark, sf).collect()
    want = {(i, c + 1): (n, sum((n * v - s) ** 2 for v, s in zip(x, sums)), abs(y)) for i, x in exact
            for c, y in enumerate((centred[x] @ parts / np.sqrt(values))[:16])}
    assert len(got) == len(want)
    for r in got:
        number, deviation, size = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (number, deviation) and math.isclose(abs(r.whitened), size, rel_tol=1e-6, abs_tol=1e-7)
        assert math.isclose(r.explained, values[r.component - 1] / trace, rel_tol=1e-9) and r.identity_error < 1e-9


def test_whitening_without_variance_or_rows(spark):
    none = whitening.components_of_rows(spark.createDataFrame([], VECTORS))
    same = whitening.components_of_rows(spark.createDataFrame([(i, [1.0, 2.0], 1, "a", "b", 3) for i in range(5)], VECTORS))
    assert none.collect() == same.collect() == [] and none.columns == same.columns
    flat = spark.createDataFrame([(i, [float(i), 2.0, float(i)], 1, "a", "b", 3) for i in range(5)], VECTORS)
    assert {r.component for r in whitening.components_of_rows(flat).collect()} == {1}
    far = whitening.components_of_rows(spark.createDataFrame([(i, [3e38 * (-1) ** i, float(i)], 1, "a", "b", 3) for i in range(6)], VECTORS)).collect()
    assert {r.component for r in far} == {1} and all(r.deviation is None and math.isclose(abs(r.whitened), 1, rel_tol=1e-9) for r in far)
    with pytest.raises(ValueError, match="counts"):
        whitening.whiten(flat, fit="other")


def test_vectors_of_many_copies_are_salted(spark, monkeypatch):
    rows = vectors(2, 50, 6)
    df = spark.createDataFrame(rows, VECTORS)
    plain = sorted(map(tuple, whitening.components_of_rows(df).collect()), key=repr)
    monkeypatch.setattr(whitening, "MIN_COPIES", 2)
    salted = sorted(map(tuple, whitening.components_of_rows(df).collect()), key=repr)
    assert [r[:4] for r in plain] == [r[:4] for r in salted] and np.allclose([r[4] for r in plain], [r[4] for r in salted], rtol=1e-9)


def test_sums_are_exact_beyond_64_bits():
    exact = whitening._differences(3, (1 << 61, -5))
    assert exact(np.array([[1 << 60, 7]], np.int64)).tolist() == [[3 * (1 << 60) - (1 << 61), 26]]
    assert whitening._squares(np.array([[1 << 20, 3]], np.int64)) == [(1 << 40) + 9]
    assert whitening._squares(np.array([[1 << 40, 3]], np.int64)) == [None]


# 13

@pytest.fixture(scope="module")
def plain():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)


def expected_counts(plain, rows):
    return Counter((r.doc_id, len((r.text or "").encode()), len(plain.encode(r.text or ""))) for r in rows)


def test_counts_of_edge_rows(docs, none, plain):
    got = token_counts.count_tokens(docs, queries.PIECES)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    assert Counter(map(tuple, got.collect())) == expected_counts(plain, docs.collect())
    assert token_counts.count_tokens(none, queries.PIECES).collect() == []


def test_counts_of_odd_texts(spark, plain, monkeypatch):
    rng = random.Random(3)
    signs = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "▁", "a", "The", "ing", "é", "日本", "😀", "　", "\0", "<s>", "</s>", "<unk>", "<0x0A>", "123", "...", "ﬁ", "‍", "́"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 40))) for _ in range(400)]
    texts += [" " * 5000, "x" * 300000, "\n" * 3000, "word " * 60000, "日本語" * 5000, "", " ", "▁", "\n", "a ", " a", None]
    df = spark.createDataFrame([(i % 100, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    want = expected_counts(plain, df.collect())
    assert Counter(map(tuple, token_counts.count_tokens(df, queries.PIECES).collect())) == want
    # No common pre-tokens: everything goes by exchange; and everything in small pieces.
    monkeypatch.setattr(token_counts, "COMMON", 0)
    monkeypatch.setattr(token_counts, "GATHERED", 3)
    monkeypatch.setattr(token_counts, "CODED_CHARS", 10)
    monkeypatch.setattr(token_counts, "ROWS", 5)
    assert Counter(map(tuple, token_counts.count_tokens(df, queries.PIECES).collect())) == want


def test_counts_of_all_documents(spark, sf, plain):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op13_token_counts(spark, sf).collect()}
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got.values()) == expected_counts(plain, rows)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got.values())


def test_a_hot_document_and_repeated_rows(spark, plain):
    text = vocabulary(9, 3000, 500)
    df = spark.createDataFrame([(1, text)] * 50 + [(1, "other text"), (None, text), (None, text)], "doc_id bigint, text string")
    assert Counter(map(tuple, token_counts.count_tokens(df, queries.PIECES).collect())) == expected_counts(plain, df.collect())
