import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quern.plans import prefix, skew
from quern.plans.prefix import cut_points, dense_rank_from_zero, prefix_sum
from quern.plans.stage import RollingTable, complete, fresh_path


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    # One key holds most rows; another holds one.
    keys = ["hot"] * 700 + ["warm"] * 250 + [f"k{i}" for i in range(49)] + ["one"]
    return [(k, rng.randrange(40), i, rng.randrange(100)) for i, k in enumerate(keys)]


def expected(rows, keyed=True):
    out, run = {}, {}
    for k, a, i, v in sorted(rows, key=lambda r: (r[0], r[1], r[2]) if keyed else (r[1], r[2])):
        key = k if keyed else None
        out[i] = run.get(key, 0)
        run[key] = out[i] + v
    return out


@pytest.mark.parametrize("parts", [1, 4, 17])
@pytest.mark.parametrize("per_range", [7, 60, 10**6])
@pytest.mark.parametrize("keyed", [True, False])
def test_prefix_sum_equals_a_loop(spark, rows, parts, per_range, keyed):
    df = spark.createDataFrame(rows, "k string, a int, i int, v int").repartition(parts)
    got = prefix_sum(df, {"before": F.col("v")}, ["a", "i"], ["k"] if keyed else [], rows_per_range=per_range)
    assert {r.i: r.before for r in got.collect()} == expected(rows, keyed)
    assert set(got.columns) == {"k", "a", "i", "v", "before"}


@pytest.mark.parametrize("per_range", [3, 10**6])
@pytest.mark.parametrize("parts", [1, 9])
def test_dense_order_equals_a_loop(spark, rows, parts, per_range):
    df = spark.createDataFrame(rows, "k string, a int, i int, v int").repartition(parts)
    got = prefix_sum(df, {"before": F.col("v")}, ["i"], ["k"], dense=True, rows_per_range=per_range)
    run, want = {}, {}
    for k, _, i, v in rows:
        want[i] = run.get(k, 0)
        run[k] = want[i] + v
    assert {r.i: r.before for r in got.collect()} == want


@pytest.mark.parametrize("per_range", [7, 10**6])
def test_ceilings_drop_rows_past_them(spark, rows, per_range):
    df = spark.createDataFrame(rows, "k string, a int, i int, v int")
    top = F.when(F.col("k") == "hot", F.lit(5000)).when(F.col("k") == "warm", F.lit(0))
    got = prefix_sum(df, {"before": F.col("v")}, ["a", "i"], ["k"], ceilings={"before": top}, rows_per_range=per_range)
    want = {r[2] for r in rows if r[0] not in ("hot", "warm") or (r[0] == "hot" and expected(rows)[r[2]] < 5000)}
    assert {r.i for r in got.collect()} == want


def test_several_values_and_many_range_totals(spark, rows, monkeypatch):
    monkeypatch.setattr(prefix, "SMALL_ROWS", 3)
    df = spark.createDataFrame(rows, "k string, a int, i int, v int")
    got = prefix_sum(df, {"s": F.col("v"), "n": F.lit(1)}, ["a", "i"], ["k"], ceilings={"s": F.lit(10**9)}, rows_per_range=9)
    assert {r.i: r.s for r in got.collect()} == expected(rows)
    assert sorted(r.n for r in got.where("k = 'hot'").collect()) == list(range(700))


@pytest.mark.parametrize("order", [["t"], ["d"], ["x"], ["s", "i"]])
def test_order_columns_of_other_types(spark, order):
    df = spark.range(300).select(
        F.col("id").alias("i"), F.expr("timestamp'2020-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id*1.5)").alias("t"),
        F.expr("date'2020-01-01' + int(id)").alias("d"), (F.col("id") / 7.0).alias("x"),
        F.concat(F.lit("é"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("s"))
    got = dense_rank_from_zero(df.repartition(5), "at", order, rows_per_range=20)
    assert all(r.i == r["at"] for r in got.collect())


def test_null_keys_are_a_key_of_their_own(spark):
    rows = [(None if i % 3 == 0 else "a", i) for i in range(90)]
    df = spark.createDataFrame(rows, "k string, i int").repartition(3)
    got = sorted((r.i, r["at"]) for r in dense_rank_from_zero(df, "at", ["i"], ["k"], dense=True, rows_per_range=10).collect())
    want, seen = [], {}
    for k, i in rows:
        want.append((i, seen.get(k, 0)))
        seen[k] = seen.get(k, 0) + 1
    assert got == want


ODD = {
    "null": ("bigint", [None if i % 5 == 0 else i // 2 for i in range(80)]),
    "decimal": ("decimal(20,3)", [Decimal(i * 7 % 50) / 8 if i % 9 else None for i in range(80)]),
    "date": ("date", [date(2020, 1, 1) + timedelta(days=i * 13 % 60) if i % 11 else None for i in range(80)]),
    "binary": ("binary", [bytes([i % 7, 255 - i]) if i % 10 else None for i in range(80)]),
    "nan": ("double", [float("nan") if i % 8 == 0 else float("inf") if i % 8 == 1 else (i * 3 % 40) / 7 for i in range(80)]),
    "string": ("string", ["" if i % 6 == 0 else None if i % 6 == 1 else f"é{i * 5 % 30}" for i in range(80)]),
    "boolean": ("boolean", [None if i % 3 == 0 else i % 2 == 0 for i in range(80)]),
}


@pytest.mark.parametrize("kind", sorted(ODD))
def test_any_plain_type_orders_alike_in_one_range_or_many(spark, kind):
    sql_type, values = ODD[kind]
    df = spark.createDataFrame([(v, None if i % 4 == 0 else f"k{i % 3}", i, i % 13) for i, v in enumerate(values)],
                               f"v {sql_type}, k string, i int, n int").repartition(5)
    for order, keys in ((["v", "i"], ["k"]), (["i"], ["v"]), (["v", "i"], [])):
        got = [{r.i: r.s for r in prefix_sum(df, {"s": F.col("n")}, order, keys, rows_per_range=n).collect()} for n in (10, 10**6)]
        assert got[0] == got[1] and len(got[0]) == 80


def test_group_statistics_of_hot_and_null_keys(spark, rows):
    df = spark.createDataFrame(rows, "k string, a int, i int, v int").withColumn("k", F.when(F.col("k") != "warm", F.col("k")))
    got = [sorted((r.i, r.top) for r in skew.with_group_stat(df, ["k"], F.max("v"), "top", hot).collect()) for hot in ([], [("hot",), (None,)])]
    assert got[0] == got[1] and len(got[0]) == len(rows)


def test_cut_points_are_bounded_and_spread_hot_keys(spark, rows):
    df = spark.createDataFrame(rows, "k string, a int, i int, v int")
    points = cut_points(df, ["k", "a", "i"], rows_per_range=20)
    assert len(points) <= 50 and sum(p[0] == "hot" for p in points) > 25
    ranges = df.withColumn("r", prefix.range_of(df, ["k", "a", "i"], points)).groupBy("r").count()
    assert ranges.agg(F.max("count")).first()[0] <= 60


def test_no_task_holds_a_whole_hot_key(spark, rows):
    df = spark.createDataFrame(rows, "k string, a int, i int, v int")
    plan = prefix_sum(df, {"b": F.col("v")}, ["a", "i"], ["k"], rows_per_range=20)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(k#" in text and "_range#" in text


@pytest.mark.parametrize("min_rows", [None, 100])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_a_join(spark, rows, min_rows, how):
    big = spark.createDataFrame(rows, "k string, a int, i int, v int")
    small = big.where("k <> 'one'").groupBy("k").agg(F.max("v").alias("top"))
    got = skew.spread_join(big, small, ["k"], ["i"], how, hot=skew.hot_keys(big, ["k"], min_rows))
    assert sorted(map(str, got.select("k", "i", "top").collect())) == sorted(
        map(str, big.join(small, "k", how).select("k", "i", "top").collect()))


def test_hot_keys_are_few_and_found(spark, rows):
    big = spark.createDataFrame(rows, "k string, a int, i int, v int")
    assert skew.hot_keys(big, ["k"]) == []
    assert set(skew.hot_keys(big, ["k"], min_rows=200)) == {("hot",), ("warm",)}


def test_rolling_table_keeps_one_version(spark):
    stage = RollingTable(spark, "roll")
    first = stage.put(spark.range(10))
    old = stage.path
    second = stage.put(first.where("id > 4"))
    assert second.count() == 5 and not complete(spark, old) and complete(spark, stage.path)
    stage.drop()
    assert not complete(spark, fresh_path(spark, "roll"))
