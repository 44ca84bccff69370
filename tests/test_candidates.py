import math
import random

import pytest

from quern.operators import candidates as c

SKEW = [{}, {"min_hot_rows": 50}]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for g, n in [("hot", 400), ("mid", 40), ("few", 3), ("one", 1)]:
        out += [(g, i, float(rng.randrange(-6, 7))) for i in range(n)]
    return out


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, "group string, item int, score double").repartition(parts)


def by_group(rows):
    out = {}
    for g, i, s in rows:
        out.setdefault(g, []).append((i, s))
    return out


def soft(pairs, t=1.0):
    top = max(s for _, s in pairs)
    z = sum(math.exp((s - top) / t) for _, s in pairs)
    return {i: math.exp((s - top) / t) / z for i, s in pairs}


def test_penalty(spark):
    df = frame(spark, [("a", 1, 2.0), ("a", 2, -2.0), ("a", 3, 0.0), ("a", 4, 2.0), ("b", 1, 2.0)])
    seen = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("a", 3), ("b", 9)], "group string, item int")
    got = {(r.group, r.item): r.score for r in c.penalise(df, seen, 2.0).collect()}
    assert got == {("a", 1): 1.0, ("a", 2): -4.0, ("a", 3): 0.0, ("a", 4): 2.0, ("b", 1): 2.0}
    assert c.penalise(df, seen, 1.0) is df


@pytest.mark.parametrize("skew", SKEW)
@pytest.mark.parametrize("t", [0.5, 1.0, 3.0])
def test_softmax(spark, rows, t, skew):
    got = c.softmax(frame(spark, rows), t, **skew).collect()
    want = {g: soft(p, t) for g, p in by_group(rows).items()}
    assert len(got) == len(rows) and all(abs(r.prob - want[r.group][r.item]) < 1e-12 for r in got)


def test_softmax_of_huge_scores(spark):
    got = {r.item: r.prob for r in c.softmax(frame(spark, [("a", 1, 9000.0), ("a", 2, 9000.0), ("a", 3, -9000.0)])).collect()}
    assert got == {1: 0.5, 2: 0.5, 3: 0.0}
    with pytest.raises(ValueError):
        c.softmax(frame(spark, [("a", 1, 1.0)]), 0.0)


@pytest.mark.parametrize("skew", SKEW)
@pytest.mark.parametrize("k", [1, 3, 10, 1000, 1001])
def test_top_k_keeps_ties(spark, rows, k, skew):
    got = {(r.group, r.item) for r in c.top_k(frame(spark, rows), k, rows_per_range=30, **skew).collect()}
    want = set()
    for g, pairs in by_group(rows).items():
        floor = sorted((s for _, s in pairs), reverse=True)[min(k, len(pairs)) - 1]
        want |= {(g, i) for i, s in pairs if s >= floor}
    assert got == want


@pytest.mark.parametrize("per_range", [20, 10**6])
@pytest.mark.parametrize("p", [0.05, 0.5, 0.9, 0.999])
def test_nucleus(spark, rows, p, per_range):
    got = {(r.group, r.item) for r in c.nucleus(frame(spark, rows), p, rows_per_range=per_range).collect()}
    want = set()
    for g, pairs in by_group(rows).items():
        prob, run = soft(pairs), 0.0
        for i, s in sorted(pairs, key=lambda x: (-x[1], x[0])):
            if run <= p:
                want.add((g, i))
            run += prob[i]
    assert got == want


def test_nucleus_edges(spark):
    ln = math.log
    exact = frame(spark, [("a", 1, ln(4)), ("a", 2, ln(2)), ("a", 3, ln(1)), ("a", 4, ln(1))])
    assert {r.item for r in c.nucleus(exact, 0.4).collect()} == {1}
    assert {r.item for r in c.nucleus(exact, 0.7).collect()} == {1, 2}
    equal = frame(spark, [("a", i, 0.0) for i in range(4)])
    assert {r.item for r in c.nucleus(equal, 0.5).collect()} == {0, 1, 2}
    for off in (0.0, 1.0, 1.5):
        assert c.nucleus(equal, off) is equal


def test_argmax(spark, rows):
    got = {r.group: (r.item, r.score) for r in c.argmax(frame(spark, rows)).collect()}
    assert got == {g: min(p, key=lambda x: (-x[1], x[0])) for g, p in by_group(rows).items()}


def test_pick_follows_the_probabilities(spark):
    n = 6000
    probs = {0: 0.6, 1: 0.3, 2: 0.1, 3: 0.0}
    df = spark.range(n).selectExpr("id AS group", "explode(array(0, 1, 2, 3)) AS item").selectExpr(
        "group", "item", "element_at(array(0.6D, 0.3D, 0.1D, 0.0D), item + 1) AS prob")
    got = c.pick(df, 7)
    assert got.count() == n
    share = {r["item"]: r["count"] / n for r in got.groupBy("item").count().collect()}
    assert 3 not in share and all(abs(share[i] - p) < 0.03 for i, p in probs.items() if p)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in c.pick(df.repartition(3), 7).collect()}


def test_choose_applies_filters_in_order(spark, rows):
    df = frame(spark, rows)
    greedy = {r.group: r.item for r in c.choose(df, 1, temperature=0.0).collect()}
    assert greedy == {r.group: r.item for r in c.argmax(df).collect()}
    got = {r.group: r.item for r in c.choose(df, 1, temperature=0.7, k=2, p=0.5).collect()}
    best = {g: {i for i, s in p if s >= sorted((x for _, x in p), reverse=True)[min(2, len(p)) - 1]} for g, p in by_group(rows).items()}
    assert all(got[g] in best[g] for g in best)
    seen = spark.createDataFrame([("one", 0)], "group string, item int")
    assert c.choose(df, 1, seen=seen, penalty=1.3).count() == 4


def test_null_and_nan_scores_are_never_candidates(spark):
    rows = [("a", i, float(i % 40)) for i in range(60)] + [("a", 100 + i, None) for i in range(9)] + [("a", 200 + i, float("nan")) for i in range(9)]
    rows += [(None, i, float(i)) for i in range(5)] + [("z", 1, None)]
    df = frame(spark, rows)
    real = {(g, i) for g, i, s in rows if s is not None and s == s}
    assert {(r.group, r.item) for r in c.top_k(df, 1_000).collect()} == {(r.group, r.item) for r in c.top_k(df, 1_001).collect()} == real
    assert {(r.group, r.item) for r in c.argmax(df).collect()} == {("a", 39), (None, 4)}
    soft = c.softmax(df).collect()
    assert len(soft) == len(rows) and abs(sum(r.prob for r in soft if r.prob is not None) - 2) < 1e-9
    assert {(r.group, r.item) for r in c.nucleus(df, 0.999999).collect()} <= real
    assert {r.group for r in c.pick(c.softmax(df), 1).collect()} == {"a", None}


@pytest.mark.parametrize("k", [1, 7, 30])
def test_top_k_is_the_same_by_either_way(spark, rows, monkeypatch, k):
    df = frame(spark, rows)
    got = []
    for limit in (1_000, 0):
        monkeypatch.setattr(c, "GROUP_LIMIT", limit)
        got.append(sorted(map(tuple, c.top_k(df, k, rows_per_range=11).collect())))
    assert got[0] == got[1]


def test_probabilities_do_not_depend_on_partitions(spark, rows):
    def probs(parts, **skew):
        return sorted((r.group, r.item, r.prob) for r in c.softmax(frame(spark, [(g, i, s / 7 + i * 1e-3) for g, i, s in rows], parts), **skew).collect())
    assert probs(1) == probs(4) == probs(17) == probs(5, min_hot_rows=50)


def test_softmax_moves_ordinary_groups_once(spark, rows):
    plan = c.softmax(spark.createDataFrame(rows, "group string, item int, score double"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") <= 2
