import collections

import pytest
from pyspark.sql import functions as F

from quern.operators import mix
from quern.sources.corpus import MixSource, build_mix, open_corpus, synthetic


def sources(spark, sizes, empty=()):
    rows = [(s, i, "" if (s, i) in empty else f"{s}{i}") for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "source_id string, ord bigint, text string")


def in_order(df):
    return [(r.source_id, r.ord) for r in df.orderBy("doc_index").collect()]


@pytest.mark.parametrize("per_range", [10, 10**6])
def test_interleave_keeps_source_order_and_loses_nothing(spark, per_range):
    df = sources(spark, {"a": 120, "b": 30, "c": 1}, empty={("a", 5), ("b", 0)})
    got = mix.interleave(df.repartition(7), {"a": 3, "b": 1, "c": 1}, rows_per_range=per_range)
    order = in_order(got)
    assert len(order) == 149 and [r.doc_index for r in got.orderBy("doc_index").collect()] == list(range(149))
    for s in "abc":
        mine = [o for t, o in order if t == s]
        assert mine == sorted(mine)
    assert order == in_order(mix.interleave(df.coalesce(1), {"a": 3, "b": 1, "c": 1}))


@pytest.mark.parametrize("budget", [1, 25, 300, 2950, 10_000])
@pytest.mark.parametrize("per_range", [None, 40])
def test_a_budget_orders_only_a_beginning(spark, monkeypatch, budget, per_range):
    """A source with most of the rows, one that soon runs out, one of empty texts: the blend's first documents, from few rows."""
    sizes = {"a": 2700, "b": 15, "c": 400, "d": 100}
    df = sources(spark, sizes, empty={("d", i) for i in range(95)}).repartition(6)
    weights = {"a": 1, "b": 2, "c": 3, "d": 1, "none": 1}
    options = {} if per_range is None else {"rows_per_range": per_range}
    whole = in_order(mix.interleave(df, weights))
    ordered, plain = [], mix.arrivals
    monkeypatch.setattr(mix, "arrivals", lambda rows, *a, **k: (ordered.append(rows.count()), plain(rows, *a, **k))[1])
    assert in_order(mix.interleave(df, weights, budget=budget, **options)) == whole[:budget]
    assert max(ordered) <= 4 * budget + 400 and (budget > 300 or sum(ordered) < 1400)


def test_a_horizon_holds_the_wanted_rows():
    assert mix._horizon(10, {"a": 0.5, "b": 0.5}, {"a": 100, "b": 100}) == pytest.approx(10, rel=1e-6)
    assert mix._horizon(50, {"a": 0.5, "b": 0.5}, {"a": 10, "b": 100}) == pytest.approx(80, rel=1e-6)
    assert mix._horizon(200, {"a": 0.5, "b": 0.5}, {"a": 100, "b": 100}) == float("inf")


def test_rows_without_or_with_the_same_order_are_refused(spark):
    df = sources(spark, {"a": 30, "b": 30})
    lacking = df.withColumn("ord", F.when(F.col("ord") != 4, F.col("ord")))
    twice = df.withColumn("ord", F.when(F.col("ord") == 5, 4).otherwise(F.col("ord")).cast("bigint"))
    for bad, message in ((lacking, "has no ord"), (twice, "occurs twice")):
        with pytest.raises(Exception, match=message):
            mix.interleave(bad, {"a": 1.0, "b": 1.0}).collect()
    assert len(in_order(mix.interleave(df, {"a": 1.0, "b": 1.0}, looped=("b",), budget=200))) == 200


def test_interleave_follows_the_weights(spark):
    df = sources(spark, {"a": 4000, "b": 4000, "c": 4000})
    head = in_order(mix.head(mix.interleave(df, {"a": 0.7, "b": 0.2, "c": 0.1}, seed=5), 4000))
    share = collections.Counter(s for s, _ in head)
    assert abs(share["a"] / 4000 - 0.7) < 0.03 and abs(share["c"] / 4000 - 0.1) < 0.02


def test_first_draw_frequencies(spark):
    """The first source drawn, over many seeds, follows the weights."""
    w = {"a": 0.5, "b": 0.3, "c": 0.2}
    seeds = spark.range(4000).withColumnRenamed("id", "s")
    from quern.functions.draw import unit
    gaps = [(-F.log(unit(F.col("s"), F.lit(k), F.lit(0), F.lit(0))) / v).alias(k) for k, v in w.items()]
    first = seeds.select("s", *gaps).select(F.expr("CASE WHEN a < b AND a < c THEN 'a' WHEN b < c THEN 'b' ELSE 'c' END").alias("f"))
    counts = {r.f: r["count"] / 4000 for r in first.groupBy("f").count().collect()}
    assert all(abs(counts[k] - w[k]) < 0.03 for k in w)


def test_seed_changes_the_order(spark):
    df = sources(spark, {"a": 50, "b": 50})
    assert in_order(mix.interleave(df, {"a": 1, "b": 1}, 1)) != in_order(mix.interleave(df, {"a": 1, "b": 1}, 2))


def test_bad_weights(spark):
    df = sources(spark, {"a": 3, "b": 3})
    for weights in ({"a": 1.0, "b": 0.0}, {"a": -1.0, "b": 1.0}, {}):
        with pytest.raises(ValueError):
            mix.interleave(df, weights)
    with pytest.raises(Exception, match="no weight"):
        mix.interleave(df, {"a": 1.0}).collect()


def test_loop_until_finite_sources_end(spark):
    df = sources(spark, {"big": 300, "small": 5})
    got = mix.interleave(df, {"big": 0.5, "small": 0.5}, looped=("small",), stop="finite_exhausted")
    rows = got.orderBy("doc_index").collect()
    assert [r.ord for r in rows if r.source_id == "big"] == list(range(300))
    small = [(r.epoch, r.ord) for r in rows if r.source_id == "small"]
    assert small == [(i // 5, i % 5) for i in range(len(small))] and 240 < len(small) < 360
    assert rows[-1].source_id == "big"


def test_loop_until_budget(spark):
    df = sources(spark, {"big": 20, "small": 3}, empty={("small", 1)})
    got = mix.interleave(df, {"big": 0.5, "small": 0.5}, looped=("small",), budget=500)
    rows = got.orderBy("doc_index").collect()
    assert len(rows) == 500 and sum(r.source_id == "big" for r in rows) == 20
    small = [(r.epoch, r.ord) for r in rows if r.source_id == "small"]
    assert small == [(i // 2, (i % 2) * 2) for i in range(480)]


def test_loop_errors(spark):
    df = sources(spark, {"a": 3, "b": 2}, empty={("b", 0), ("b", 1)})
    with pytest.raises(ValueError, match="no usable rows"):
        mix.interleave(df, {"a": 1, "b": 1}, looped=("b",), budget=9)
    with pytest.raises(ValueError, match="budget"):
        mix.interleave(df, {"a": 1, "b": 1}, looped=("a",))
    with pytest.raises(ValueError, match="finite"):
        mix.interleave(df.where("source_id = 'a'"), {"a": 1}, looped=("a",), stop="finite_exhausted")
    assert mix.loop(df, 3).count() == 15


def test_budget_without_loops_is_a_prefix(spark):
    df = sources(spark, {"a": 90, "b": 90})
    whole = in_order(mix.interleave(df, {"a": 2, "b": 1}))
    assert in_order(mix.interleave(df, {"a": 2, "b": 1}, budget=40, rows_per_range=10)) == whole[:40]


def test_mix_report(spark):
    rows = {r.source_id: r for r in mix.mix_report(sources(spark, {"a": 30, "b": 10}), {"a": 3, "b": 1}).collect()}
    assert (rows["a"].weight, rows["a"].n_docs, rows["a"].share) == (0.75, 30, 0.75)


def test_build_mix_templates_before_the_draw(spark):
    plain = spark.createDataFrame([(0, "x", "t"), (1, "", ""), (2, "", "t")], "ord int, body string, text string")
    tasks = spark.createDataFrame([(0, "i", "o"), (1, "", "o")], "ord int, instruction string, output string")
    got = build_mix(spark, [MixSource("p", df=plain, text_field="body", weight=2), MixSource("t", df=tasks, format="alpaca")])
    assert {(r.source_id, r.ord, r.text, r.weight) for r in got.collect()} == {
        ("p", 0, "x", 2.0), ("p", 1, "", 2.0), ("p", 2, "t", 2.0),
        ("t", 0, "### Instruction:\ni\n\n### Response:\no", 1.0)}


def test_open_corpus_priority(spark, documents):
    entry = MixSource("d", df=documents, order="doc_id")
    single = documents.withColumnRenamed("doc_id", "ord")
    offline = open_corpus(spark, offline=True, n_offline=7, mix=[entry], single=single)
    assert offline.count() == 7 and offline.first()["text"].startswith("Once upon a time, there was a ")
    assert open_corpus(spark, mix=[entry], single=documents.limit(1)).count() == 200
    assert open_corpus(spark, single=single).count() == 200
    for bad in ({"offline": True}, {}):
        with pytest.raises(ValueError):
            open_corpus(spark, **bad)


def test_synthetic_is_stable(spark):
    a = {r.id: r.text for r in synthetic(spark.range(0, 40, 1, 1)).collect()}
    assert a == {r.id: r.text for r in synthetic(spark.range(0, 40, 1, 9)).collect()} and len(set(a.values())) > 35
