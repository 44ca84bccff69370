"""The pipeline, stage by stage."""

import hashlib
import random

import corpus_pipeline
from quern.llm import common, language_id, ngram_join, queries


def test_stages(spark, sf):
    docs = common.table(spark, sf, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_join", "mixing", "byte_bpe"]
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        held[name] = (docs, common.kept(stage(spark, docs, sf), name))
        docs = held[name][1]
        if name != "byte_bpe":
            assert docs.columns == held["language_id"][0].columns
    before, after = held["language_id"]
    assert after.count() >= 0.99 * before.count()
    before, after = held["line_dedup"]
    digests = {r.doc_id: r.kept_sha256 for r in queries.line_dedup.digests(before).collect()}
    assert {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in after.collect()} == digests
    assert all(r.n_chars == len(r.text) for r in after.collect())
    before, after = held["ngram_join"]
    kept = {r.doc_id for r in ngram_join.classes(before).where("doc_id = component_id").collect()}
    assert {r.doc_id for r in after.collect()} == kept and after.count() == len(kept) < before.count()
    before, after = held["mixing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} and after.count() >= before.count()
    before, after = held["byte_bpe"]
    text = {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in before.collect()}
    assert after.count() == before.count() and all(text[r.doc_id] == r.decoded_sha256 and r.n_tokens == len(r.ids) for r in after.collect())


def test_documents_without_letters_go(spark):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(["The end of it all is here", None, "", "12 %%", "and the rest is here"] + ["the and of it is here"] * 20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    left = {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, docs, "").collect()}
    assert not left & {1, 2, 3} and {0, *range(4, 25)} <= left


def test_clean_documents_of_small_or_unnamed_languages_stay(spark):
    rng = random.Random(4)
    english = [" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(3)) for _ in range(2000)) for _ in range(15)]
    rare = "".join(chr(0x13A0 + rng.randrange(80)) + " " * (i % 5 == 0) for i in range(300))
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(english)] + [(100, rare, "chr", "s", 1), (101, "12 %%", "en", "s", 1)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, schema)
    assert language_id.learn(docs).seen >= corpus_pipeline.LEAST_LEARNED
    assert {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, docs, "").collect()} == {*range(15), 100}
    assert {r.doc_id: r.lang_pred for r in language_id.identify(docs, language_id.learn(docs)).collect()}[100] == "chr"
    unnamed = spark.createDataFrame([(*r[:2], None, *r[3:]) for r in rows], schema)
    assert {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, unnamed, "").collect()} == {*range(15), 100}


def test_verdicts_do_not_turn_on_the_size_of_the_input(spark):
    rng = random.Random(7)
    english = [" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(3)) for _ in range(2000)) for _ in range(16)]
    foreign = "".join(chr(0x13A0 + rng.randrange(80)) for _ in range(300))
    seen = set()
    for n in (2, 15):
        rows = [(i, t, "en", "s", 1) for i, t in enumerate(english[:n])] + [(100, foreign, None, "s", 1), (101, english[-1], None, "s", 1)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        seen.add(language_id.learn(docs).seen >= corpus_pipeline.LEAST_LEARNED)
        assert {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, docs, "").collect()} == {*range(n), 101}
    assert seen == {False, True}


def test_slots_follow_the_trigrams(spark):
    texts = ["".join(chr(0x4E00 + random.Random(i).randrange(2000) + j % 7) for j in range(3000)) for i in range(20)]
    docs = spark.createDataFrame([(t, "zh") for t in texts], "text string, lang string")
    assert language_id.learn(docs, slots=64).wrong[0] < 0.05


def test_whole_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"] and out.count() > 0
