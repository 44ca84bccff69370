import json
import os
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern import catalog
from quern.operators import retention, tokens
from quern.plans import prefix
from quern.plans.stage import complete, fresh_path
from quern.sources import jsonl, sinks
from quern.streaming import corpus_stream

SCHEMA = "instruction string, n bigint"


LINES = ["", " \t ", "{bad", "7", "[1]", '{"instruction":1}', ' {"instruction":"é","n":2,"other":true}\r', "null", '"s"', "{}",
         '{"n":1} x', '{"n":1},{"n":2}', '{"n":1}, "x": 2', '{"n":1}} x', '{"n":1}]', "{'n':1}", '{"n":1,}', '{"n":01}', "7]",
         '{"instruction":"a\tb"}', '{"n":"text"}', '{"instruction":{"a":[1]},"n":5}', '{"n":1,"n":9}', '{"n":1}},"y":{"a":2}']


def test_bad_lines(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(LINES)], "i int, value string")
    got = {r.i: r for r in jsonl.parse_jsonl(df, SCHEMA).collect()}
    want = {}
    for i, x in enumerate(LINES):
        try:
            value = json.loads(x.strip())
        except json.JSONDecodeError:
            continue
        if isinstance(value, dict):
            want[i] = value
    assert set(got) == set(want)
    assert got[5].instruction == "1" and got[6].instruction == "é" and got[6].n == 2
    assert [got[i].n for i, x in enumerate(LINES) if "text" in x or "9" in x] == [None, 9]
    kinds = {r.kind: r.n_lines for r in jsonl.line_report(df).collect()}
    assert kinds == {"blank": 2, "not_object": 4, "object": len(want), "broken": len(LINES) - 6 - len(want)}


def test_lines_keep_their_order(spark, tmp_path):
    for name, start in (("a.jsonl", 0), ("b.jsonl", 500)):
        (tmp_path / name).write_text("".join(json.dumps({"instruction": "x", "n": i}) + "\n\n" for i in range(start, start + 500)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = jsonl.read_jsonl(spark, str(tmp_path), SCHEMA, rows_per_range=100).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 1000 and all(r.n == r.ord for r in got)


def test_jsonl_sink(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("é\n", "story", None)], "text string, recipe string, teacher string")
    jsonl.write_jsonl(df, path)
    jsonl.write_jsonl(df, path)
    lines = [x for f in os.listdir(path) if f.endswith(".json") for x in open(f"{path}/{f}", encoding="utf-8")]
    assert lines == ['{"text":"é\\n","recipe":"story","teacher":null}\n'] * 2


@pytest.fixture(scope="module")
def chunks(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_index"), F.sequence(F.lit(1), F.col("id").cast("int") + 1).alias("ids"))
    placed = tokens.offsets(tokens.split(docs).withColumn("n_tokens", F.size("ids")))
    return tokens.chunk(placed, 16).cache()


def test_token_sink(spark, chunks):
    path = fresh_path(spark, "tokens")
    assert sinks.write_tokens(chunks, path, "abc") is True
    assert sinks.write_tokens(chunks, path) is False and sinks.write_tokens(chunks, path, "abc") is False
    with pytest.raises(ValueError, match="not abd"):
        sinks.write_tokens(chunks, path, "abd")
    back = spark.read.parquet(path)
    assert back.count() == chunks.count() and {r.vocabulary for r in back.select("vocabulary").distinct().collect()} == {"abc"}
    assert back.select("split", "chunk_id", "tokens").exceptAll(chunks).count() == 0


def test_a_half_written_table_is_written_again(spark, chunks, tmp_path):
    path = str(tmp_path / "half")
    sinks.write_tokens(chunks.limit(1), path)
    os.remove(f"{path}/_SUCCESS")
    assert not complete(spark, path) and sinks.write_tokens(chunks, path)
    assert spark.read.parquet(path).count() == chunks.count()


def test_u16_shards_are_the_stream(spark, chunks, tmp_path):
    path = f"{tmp_path}/shards"
    manifest = sorted(sinks.export_u16(chunks, path, 16, 8).collect(), key=lambda r: (r.split, r.shard_id))
    flat = {"train": [], "val": []}
    for i in range(100):
        flat["val" if i % 20 == 0 else "train"] += list(range(1, i + 2))
    for split, want in flat.items():
        mine = [r for r in manifest if r.split == split]
        assert [r.start for r in mine] == [128 * i for i in range(len(mine))]
        assert np.concatenate([np.fromfile(r.path, dtype="<u2") for r in mine]).tolist() == want
    back = {(r.split, r.shard_id): r.tokens for r in sinks.read_u16(spark, path).collect()}
    assert all(back[(r.split, r.shard_id)] == flat[r.split][r.start: r.start + r.n_tokens] for r in manifest)
    # A second, smaller export is the only one readers see.
    sinks.export_u16(chunks.where("split = 'train'").limit(3), path, 16, 8)
    again = sinks.read_u16(spark, path).collect()
    assert {r.split for r in again} == {"train"} and sum(r.n_tokens for r in again) <= 48


def test_u16_refuses_wide_ids(spark, tmp_path):
    wide = spark.createDataFrame([("train", 0, [65_536])], "split string, chunk_id bigint, tokens array<int>")
    with pytest.raises(Exception, match="16 bits"):
        sinks.export_u16(wide, f"file://{tmp_path}/wide", 16).collect()


def test_retention(spark):
    names = [f"v1/ckpt_{s:06d}.pt" for s in (5, 999_999, 1_000_000, 20)] + ["ckpt_7.pt", "ckpt_9.pt"] + [
        "v1/ckpt_x.pt", "v1/other_1.pt", "v1/ckpt_3.tmp", "notes"]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    assert {(r.prefix, r.step, r.path) for r in retention.latest(df).collect()} == {
        ("v1/", 1_000_000, "v1/ckpt_1000000.pt"), ("", 9, "ckpt_9.pt")}
    plan = {r.path: r.action for r in retention.retention(df, 2).collect()}
    assert plan == {names[0]: "delete", names[1]: "keep", names[2]: "keep", names[3]: "delete", "ckpt_7.pt": "keep", "ckpt_9.pt": "keep"}
    for keep in (0, -1):
        assert {r.action for r in retention.retention(df, keep).collect()} == {"keep"}
    for keep in (100, 1_000, 1_001):
        assert {r.action for r in retention.retention(df, keep).collect()} == {"keep"}


def test_retention_has_no_cap(spark, monkeypatch):
    df = spark.range(60).select(F.format_string("p%d/ckpt_%06d.pt", F.col("id") % 2, F.col("id")).alias("path"))
    plans = []
    for limit in (1_000, 5):
        monkeypatch.setattr(retention, "GROUP_LIMIT", limit)
        plans.append(sorted(map(tuple, retention.retention(df, 12).collect())))
    assert plans[0] == plans[1] and sum(r[-1] == "keep" for r in plans[0]) == 24


def test_stream_equals_batch(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()

    def add(name, first, n):
        (folder / name).write_text("".join(json.dumps({"id": i, "body": "x" * (i % 5 + 1)}) + "\n{broken\n" for i in range(first, first + n)))

    def run():
        rows = corpus_stream.open_stream(spark, str(folder), "id bigint, body string", field="body", files_per_batch=1)
        corpus_stream.start_indexed(rows, out, state, ["id"],
                                    lambda df: df.withColumn("n_tokens", F.char_length("text"))).awaitTermination()

    add("a.jsonl", 0, 30)
    run()
    add("b.jsonl", 30, 25)
    os.utime(folder / "b.jsonl", (2e9, 2e9))
    run()
    got = sorted(spark.read.parquet(f"{out}/docs").collect(), key=lambda r: r.doc_index)
    assert [r.id for r in got] == [r.doc_index for r in got] == list(range(55))
    for s in ("train", "val"):
        at = 0
        for r in (r for r in got if r.split == s):
            assert r.start == at
            at += r.n_tokens


@pytest.mark.parametrize("files", [0, 3])
def test_a_table_of_one_file_or_of_many_is_streamed_whole(spark, sf, documents, tmp_path, files):
    place = tmp_path / "documents.parquet"
    if files:
        documents.repartition(files).write.parquet(str(place))
    else:
        shutil.copy(f"{sf}/documents.parquet", place)
    got = {r.doc_id for r in catalog.QUERIES["stream_corpus"](spark, str(tmp_path)).collect()}
    assert got == {r.doc_id for r in documents.where("text <> ''").collect()}


def test_a_lot_arrives_as_the_files_of_many_tasks_and_is_one_batch(spark, documents, tmp_path, monkeypatch):
    documents.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(prefix, "WIDE_ROWS_PER_RANGE", 9)
    paths = {}
    monkeypatch.setattr(catalog, "fresh_path", lambda spark, name: paths.setdefault(name, str(tmp_path / name)))
    rows = sorted(catalog.QUERIES["stream_lines"](spark, str(tmp_path)).collect(), key=lambda r: r.doc_index)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda i: (i % 3, i))
    assert len(list((tmp_path / "arriving").glob("*.json"))) > 3 and len(list((tmp_path / "stream" / "docs").glob("batch=*"))) == 3


def test_lines_are_spread_over_as_many_files_as_their_number_asks_for(spark, sf, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "WIDE_ROWS_PER_RANGE", 20)
    monkeypatch.setattr(prefix, "WIDE_ROWS_PER_RANGE", 20)
    monkeypatch.setattr(catalog, "fresh_path", lambda spark, name: str(tmp_path / name))
    rows = sorted(catalog.QUERIES["jsonl_files"](spark, sf).collect(), key=lambda r: r["ord"])
    assert [r["ord"] for r in rows] == list(range(documents.count())) and [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    assert len(list((tmp_path / "lines").glob("*.txt"))) > 8


def test_lines_of_a_dry_run_are_written_small(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "fresh_path", lambda spark, name: str(tmp_path / name))
    rows = catalog.QUERIES["jsonl_sink"](spark, sf)
    written = sum(f.stat().st_size for f in (tmp_path / "corpus").glob("*.json.gz"))
    assert 0 < written < 100 * rows.count() == 100 * spark.read.parquet(f"{sf}/orders.parquet").count()


def test_a_replayed_batch_gives_the_same_numbers(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    for b, docs in ((0, 10), (1, 15)):
        spark.createDataFrame([("train", docs, docs * 2)], corpus_stream.LEDGER).write.parquet(f"{ledger}/{b}")
    assert corpus_stream.totals_before(spark, ledger, 0) == {}
    assert corpus_stream.totals_before(spark, ledger, 1) == {"train": (10, 20)}
    assert corpus_stream.totals_before(spark, ledger, 2) == {"train": (15, 30)}
    with pytest.raises(Exception):
        corpus_stream.totals_before(spark, ledger, 9)
    batch = spark.createDataFrame([(i, "xx", 2) for i in range(50)], "id int, text string, n_tokens int")
    a, b = (sorted(map(tuple, corpus_stream.index_batch(batch.repartition(n), ["id"], {"train": (15, 30)}).collect())) for n in (1, 7))
    assert a == b and min(r[3] for r in a) == 15
