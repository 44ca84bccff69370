"""The operators together, as a user would chain them: sources to windows."""

import json

from pyspark.sql import functions as F

from quern.operators import bpe, tokens
from quern.plans.stage import cut, fresh_path
from quern.session import tune
from quern.sources import corpus, sinks


def test_sources_to_windows(spark, sf, tmp_path):
    spark = tune(spark)
    tasks = tmp_path / "tasks.jsonl"
    tasks.write_text("".join(json.dumps({"instruction": f"say {i}", "output": f"it is {i}"}) + "\n" for i in range(12)))
    entries = [
        corpus.MixSource("web", path=f"{sf}/documents.parquet", order="doc_id", weight=0.8),
        corpus.MixSource("tasks", path=str(tasks), kind="jsonl", format="alpaca", weight=0.2, looped=True,
                         schema="instruction string, input string, output string"),
    ]
    docs = cut(corpus.open_corpus(spark, mix=entries, seed=42, stop="finite_exhausted"))
    rows = docs.orderBy("ord").collect()
    assert [r.ord for r in rows] == list(range(len(rows))) and sum(r.source_id == "web" for r in rows) == 200
    assert 12 < sum(r.source_id == "tasks" for r in rows) < 120

    path = fresh_path(spark, "vocabulary")
    vocab = bpe.ensure(spark, path, 300, docs.where("ord < 100"))
    assert bpe.ensure(spark, path, 300, required=True) == vocab
    ids = cut(bpe.with_eot(bpe.encode(docs, vocab), vocab.eot_id).selectExpr("ord", "ids", "size(ids) AS n_tokens"))
    caps = {"train": 60_000, "val": 5_000}
    place = tokens.lay_out(ids, "ord", ["ord"], caps=caps)
    out = fresh_path(spark, "tokens")
    assert sinks.write_tokens(tokens.chunk(ids.join(place, "ord"), 1_024), out, vocab.fingerprint)

    flat = {"train": [], "val": []}
    for r in ids.orderBy("ord").collect():
        split = "val" if r.ord % 20 == 0 else "train"
        if len(flat[split]) < caps[split]:
            flat[split] += r.ids
    table = spark.read.parquet(out)
    for split, want in flat.items():
        got = [t for r in table.where(F.col("split") == split).orderBy("chunk_id").collect() for t in r.tokens]
        assert got == want and len(want) >= caps[split]

    train = table.where("split = 'train'")
    for w in tokens.windows(train, 50, 64, 7, 1_024, len(flat["train"])).collect():
        assert w.x == flat["train"][w.start: w.start + 64] and w.y == flat["train"][w.start + 1: w.start + 65]
    assert sum(r.n_tokens for r in sinks.export_u16(train, fresh_path(spark, "shards"), 1_024, 16).collect()) == len(flat["train"])
