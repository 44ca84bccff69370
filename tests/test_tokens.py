import random

import pytest
from pyspark.sql import functions as F

from quern.functions.draw import unit
from quern.operators import tokens

RANGES = [{}, {"rows_per_range": 9}]


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(2)
    return [(i, [rng.randrange(1, 60_000) for _ in range(rng.choice([0, 1, 3, 20, 300]))] + [0]) for i in range(120)]


def frame(spark, docs, parts=4):
    df = spark.createDataFrame(docs, "doc_index bigint, ids array<int>").repartition(parts)
    return tokens.split(df).withColumn("n_tokens", F.size("ids"))


def streams(docs):
    out = {"train": [], "val": []}
    for i, ids in docs:
        out["val" if i % 20 == 0 else "train"] += ids
    return out


@pytest.mark.parametrize("ranges", RANGES)
def test_doc_index_skips_empty_texts(spark, ranges):
    rows = [(i, "" if i % 7 == 0 else None if i % 11 == 0 else "x") for i in range(200)]
    got = tokens.with_doc_index(spark.createDataFrame(rows, "o int, text string").repartition(6), ["o"], **ranges)
    kept = sorted((r.o, r.doc_index) for r in got.collect())
    assert [o for o, _ in kept] == [o for o, t in rows if t] and [d for _, d in kept] == list(range(len(kept)))


def test_split(spark):
    got = {r.doc_index: r.split for r in tokens.split(spark.range(41).withColumnRenamed("id", "doc_index")).collect()}
    assert [got[i] for i in (0, 1, 19, 20, 21, 40)] == ["val", "train", "train", "val", "train", "val"]


@pytest.mark.parametrize("ranges", RANGES)
@pytest.mark.parametrize("caps", [{"train": 500, "val": 10}, {"train": None, "val": None}, {"train": 0, "val": 5}, {"train": 700}])
def test_cap_equals_a_loop(spark, docs, caps, ranges):
    totals, want = {"train": 0, "val": 0}, set()
    for i, ids in docs:
        s = "val" if i % 20 == 0 else "train"
        if caps.get(s) is None or totals[s] < caps[s]:
            want.add(i)
            totals[s] += len(ids)
    got = tokens.cap(frame(spark, docs), caps, **ranges)
    assert {r.doc_index for r in got.collect()} == want


def test_cap_edges(spark):
    df = frame(spark, [(1, [1] * 5), (2, [1] * 5), (3, [1] * 100), (4, [1])])
    assert {r.doc_index for r in tokens.cap(df, {"train": 10}).collect()} == {1, 2}
    assert {r.doc_index for r in tokens.cap(df, {"train": 11}).collect()} == {1, 2, 3}


@pytest.mark.parametrize("parts", [1, 17])
@pytest.mark.parametrize("size", [7, 64, 100_000])
@pytest.mark.parametrize("ranges", RANGES)
def test_chunks_are_the_flat_stream(spark, docs, size, parts, ranges):
    chunks = tokens.chunk(tokens.offsets(frame(spark, docs, parts), **ranges), size).collect()
    for s, flat in streams(docs).items():
        mine = sorted((c.chunk_id, c.tokens) for c in chunks if c.split == s)
        assert [c for c, _ in mine] == list(range(-(-len(flat) // size)))
        assert all(len(t) == size for _, t in mine[:-1]) and sum((t for _, t in mine), []) == flat


@pytest.mark.parametrize("caps", [None, {"train": 900, "val": 50}])
@pytest.mark.parametrize("ranges", RANGES)
def test_lay_out(spark, docs, caps, ranges):
    df = frame(spark, docs).drop("split").withColumn("key", F.concat(F.lit("k"), "doc_index")).withColumnRenamed("doc_index", "o")
    got = {r.key: r for r in tokens.lay_out(df, "key", ["o"], caps=caps, **ranges).collect()}
    at = {"train": 0, "val": 0}
    for i, ids in docs:
        s = "val" if i % 20 == 0 else "train"
        if caps and at[s] >= caps[s]:
            assert f"k{i}" not in got
            continue
        r = got[f"k{i}"]
        assert (r.doc_index, r.split, r.start) == (i, s, at[s])
        at[s] += len(ids)


def test_range_check(spark):
    df = spark.createDataFrame([(1, [0, 65_535]), (2, [65_536]), (3, [-1]), (4, [])], "i int, ids array<int>")
    assert {r.i for r in tokens.check_u16(df).collect()} == {2, 3}


@pytest.mark.parametrize("size", [7, 64, 100_000])
def test_windows_match_slices(spark, docs, size):
    flat = streams(docs)["train"]
    chunks = tokens.chunk(tokens.offsets(frame(spark, docs)), size).where("split = 'train'")
    rows = tokens.windows(chunks, 200, 16, 9, size, len(flat)).collect()
    assert sorted(r.window_id for r in rows) == list(range(200))
    for r in rows:
        assert r.x == flat[r.start: r.start + 16] and r.y == flat[r.start + 1: r.start + 17]
        assert 0 <= r.start < len(flat) - 17


def test_window_bounds(spark):
    one = spark.createDataFrame([(0, list(range(10)))], "chunk_id bigint, tokens array<int>")
    with pytest.raises(ValueError):
        tokens.windows(one, 3, 9, 1, 10, 10)
    assert {r.start for r in tokens.windows(one, 30, 8, 1, 10, 10).collect()} == {0}


def test_windows_depend_on_the_seed(spark, docs):
    ids = spark.range(50)
    assert ids.select(unit(1, F.col("id")).alias("u")).exceptAll(ids.select(unit(2, F.col("id")).alias("u"))).count() == 50


def test_summary(spark, docs):
    got = {r.split: (r.n_docs, r.n_tokens) for r in tokens.split_summary(frame(spark, docs)).collect()}
    assert got == {"val": (6, len(streams(docs)["val"])), "train": (114, len(streams(docs)["train"]))}


@pytest.mark.parametrize("ranges", RANGES)
@pytest.mark.parametrize("caps", [None, {"train": 900, "val": 50}, {"train": 3000, "val": 700}])
def test_progress_equals_a_loop(spark, docs, caps, ranges):
    totals, want = {"train": 0, "val": 0}, []
    limit = caps or {"train": float("inf"), "val": float("inf")}
    for i, ids in docs:
        s = "val" if i % 20 == 0 else "train"
        if totals[s] < limit[s]:
            totals[s] += len(ids)
        if all(totals[k] >= limit[k] for k in totals):
            break
        if i % 10 == 0 and i > 0:
            want.append((i, totals["train"], totals["val"]))
    got = tokens.progress(frame(spark, docs), 10, caps=caps, **ranges)
    assert sorted(tuple(r) for r in got.collect()) == want
