"""Every query runs at the smallest scale and agrees with its SQL counterpart."""

import duckdb
import pytest

import __spark_entry__ as entry
from quern import catalog
from quern.plans import prefix, skew
from tools.check import TABLES, digest

# Queries that order, number or join by group: run again with many small ranges and hot keys.
RANGED = ["weighted_interleave", "loop_source", "head_docs", "doc_index", "token_budget", "token_offsets", "token_chunks",
          "progress_report", "assign_teachers", "resume_plan", "group_softmax", "group_top_k", "group_nucleus",
          "sft_from_turns", "stream_corpus"]


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["split", "n_docs", "n_tokens"] and df.count() == 2


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, con, sf, name):
    df = entry.queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns) and got
    assert digest(df.columns, got) == digest(columns, cur.fetchall())


@pytest.mark.parametrize("name", RANGED)
def test_many_ranges_and_hot_keys_change_nothing(spark, con, sf, name, monkeypatch):
    monkeypatch.setattr(prefix, "ROWS_PER_RANGE", 40)
    monkeypatch.setattr(skew, "MIN_HOT_ROWS", 20)
    monkeypatch.setattr(skew, "SHARE", 20)
    test_query_equals_sql(spark, con, sf, name)


def test_every_sql_has_a_query():
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == {"bpe_train_large"} and set(entry.oracle_sql()) <= set(entry.queries())


def test_a_vocabulary_is_kept_by_content(spark, tmp_path):
    for i, text in enumerate(("zx zx zx", "ab ab ab")):
        folder = tmp_path / str(i) / "sf9"
        spark.createDataFrame([(1, text, "en", "s", 8)], "doc_id bigint, text string, lang string, source string, n_chars bigint") \
            .write.parquet(f"{folder}/documents.parquet")
        assert catalog.vocabulary(spark, str(folder)).tokens[257] == text[:2]
