"""The preparation step: same table with and without the bound, coded documents bounded by the caps."""

import pytest
from pyspark.sql import functions as F

from quern.operators import bpe, pieces, prepare, tokens
from quern.plans.stage import fresh_path


@pytest.fixture(scope="module")
def vocab(documents):
    return bpe.train(pieces.piece_counts(documents), 300)


def flat(spark, path):
    out = {}
    for r in spark.read.parquet(path).orderBy("split", "chunk_id").collect():
        out.setdefault(r.split, []).extend(r.tokens)
    return out


@pytest.mark.parametrize("caps", [None, {"train": 20_000, "val": 3_000}, {"train": None, "val": 1}, {"train": 0, "val": 10**9}])
def test_prepared_stream_is_that_of_a_loop(spark, documents, vocab, caps):
    out = fresh_path(spark, "prepared")
    assert prepare.prepare(documents, vocab, out, "doc_id", ["doc_id"], 512, caps)
    assert not prepare.prepare(documents, vocab, out, "doc_id", ["doc_id"], 512, caps)
    want, limits = {}, caps or {}
    coded = bpe.with_eot(bpe.encode(documents, vocab), vocab.eot_id).orderBy("doc_id").collect()
    for i, r in enumerate(coded):
        split = "val" if i % 20 == 0 else "train"
        if limits.get(split) is None or len(want.get(split, [])) < limits[split]:
            want[split] = want.get(split, []) + r.ids
    assert flat(spark, out) == want


def test_only_what_caps_may_keep_is_coded(spark, documents, vocab):
    caps = {"train": 5_000, "val": 500}
    all_, some = (prepare.coded(documents, vocab, "doc_id", ["doc_id"], c) for c in (None, caps))
    kept = tokens.cap(all_.select("doc_id", "doc_index", "split", "n_tokens"), caps)
    assert all_.count() == documents.count() and kept.join(some, "doc_id", "left_anti").count() == 0
    pieces_coded = some.groupBy("split").agg(F.sum("n_tokens").alias("n")).collect()
    assert some.count() < documents.count() / 4 and all(r.n < 8 * caps[r.split] + 20_000 for r in pieces_coded)


@pytest.mark.parametrize("step", [1, 10, 37, 10**6])
@pytest.mark.parametrize("caps", [{"train": 20_000, "val": 3_000}, {"train": 0, "val": 900}, {"train": 10**9, "val": 10**9}])
def test_stretches_are_the_whole(spark, documents, vocab, step, caps):
    """However long the stretches are, what is kept is what one pass keeps, numbers included."""
    some = prepare.coded(documents, vocab, "doc_id", ["doc_id"], caps, rows_per_range=step)
    all_ = prepare.coded(documents, vocab, "doc_id", ["doc_id"])
    cols = ["doc_id", "doc_index", "split", "n_tokens"]
    got, want = (sorted(map(tuple, tokens.cap(x.select(*cols), caps).collect())) for x in (some, all_))
    assert got == want


def test_texts_after_the_caps_are_never_looked_at(spark, documents, vocab):
    """With caps that forty documents fill, a text far behind them may even fail to be read."""
    caps = {"train": 3_000, "val": 300}
    kept = tokens.cap(prepare.coded(documents, vocab, "doc_id", ["doc_id"]).drop("ids"), caps)
    last = kept.agg(F.max("doc_id")).first()[0]
    far = sorted(r.doc_id for r in documents.select("doc_id").collect() if r.doc_id > 8 * last + 80)
    assert far
    broken = documents.withColumn("text", F.when(F.col("doc_id") >= far[0], F.raise_error(F.lit("read too far"))).otherwise(F.col("text")))
    some = prepare.coded(broken, vocab, "doc_id", ["doc_id"], caps, rows_per_range=5)
    cols = ["doc_id", "doc_index", "split", "n_tokens"]
    assert sorted(map(tuple, tokens.cap(some.select(*cols), caps).select(*cols).collect())) == sorted(map(tuple, kept.select(*cols).collect()))


def test_stretches_of_several_columns_and_nulls(spark, vocab):
    rows = [(i, None if i % 7 == 0 else chr(97 + i % 5), float(i % 3), None if i == 5 else f"some words {i}" * (i % 4)) for i in range(120)]
    docs = spark.createDataFrame(rows, "id long, a string, b double, text string")
    for order in (["a", "b", "id"], ["b", "a", "id"], ["id"]):
        caps = {"train": 300, "val": 40}
        some, all_ = (prepare.coded(docs, vocab, "id", order, c, rows_per_range=9) for c in (caps, None))
        cols = ["id", "doc_index", "split", "n_tokens"]
        got, want = (sorted(map(tuple, tokens.cap(x.select(*cols), caps).collect())) for x in (some, all_))
        assert got == want and some.count() < all_.count()
    assert prepare.coded(docs.limit(0), vocab, "id", ["id"], caps).count() == 0


def test_another_vocabulary_is_refused(spark, documents, vocab):
    out = fresh_path(spark, "prepared")
    prepare.prepare(documents.limit(30), vocab, out, "doc_id", ["doc_id"], 512)
    other = bpe.train(pieces.piece_counts(documents), 290)
    with pytest.raises(ValueError, match="vocabulary"):
        prepare.prepare(documents.limit(30), other, out, "doc_id", ["doc_id"], 512)
