"""Blending sources by weight without a sequential loop.

Each source gets a Poisson process whose rate is its weight: the k-th row of a
source arrives at the sum of its first k exponential gaps, and sorting all rows
by arrival gives the blend. Because the gaps are memoryless, the next row comes
from source i with probability w_i over the weights still active, and a source
that has run out simply stops arriving.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.draw import unit
from quern.plans import prefix
from quern.plans.prefix import cut_points, dense_rank_from_zero, prefix_sum, range_of
from quern.plans.stage import cut

TICKS = 2**20  # arrival times are BIGINT ticks, so that sums are exact


def normalised(weights: dict[str, float]) -> dict[str, float]:
    if not weights or any(not w > 0 for w in weights.values()):
        raise ValueError("every source needs a weight above zero")
    total = sum(weights.values())
    return {s: w / total for s, w in weights.items()}


def _share(weights: dict[str, float], source: Column) -> Column:
    """The normalised weight of a row's source; a source without one is an error."""
    out = None
    for name, w in normalised(weights).items():
        hit = source == F.lit(name)
        out = F.when(hit, F.lit(w)) if out is None else out.when(hit, F.lit(w))
    return out.otherwise(F.raise_error(F.concat(F.lit("no weight for source "), source)).cast("double"))


def arrivals(df: DataFrame, weights: dict[str, float], seed: int = 42, source: str = "source_id",
             order: str = "ord", epoch: str = "epoch", **ranges) -> DataFrame:
    """Add ``arrival``: the tick at which each row is drawn."""
    gap = F.floor(-F.log(unit(seed, F.col(source), F.col(epoch), F.col(order)))
                  / _share(weights, F.col(source)) * F.lit(float(TICKS))).cast("bigint")
    df = df.withColumn("_gap", gap)
    before = prefix_sum(df, {"arrival": F.col("_gap")}, [epoch, order], [source], **ranges)
    return before.withColumn("arrival", F.col("arrival") + F.col("_gap")).drop("_gap")


def loop(df: DataFrame, epochs: int) -> DataFrame:
    """Repeat a source ``epochs`` times; order inside the result is (epoch, ord)."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))


def blend_order(df: DataFrame, weights: dict[str, float], seed: int = 42, *, source: str = "source_id",
                order: str = "ord", text: str = "text", looped: tuple[str, ...] = (),
                stop: str = "budget", budget: int | None = None, **ranges) -> DataFrame:
    """The blend as (source, ord, epoch, doc_index), without the texts.

    With a ``budget`` only that many documents are placed, and only a beginning
    of every source that surely holds them is ordered. A row without an order
    is an error.
    """
    filled = F.coalesce(F.col(text), F.lit("")) != ""
    kind = df.schema[order].dataType
    given = F.when(F.col(order).isNull(), F.raise_error(F.lit(f"a row has no {order}")).cast(kind)).otherwise(F.col(order))
    slim = df.select(source, given.alias(order), filled.alias("_filled"))
    if looped:
        drawn = _looped_arrivals(slim, weights, seed, source, order, looped, stop, budget, ranges)
    elif budget is not None:
        drawn = _budgeted_arrivals(df.select(source, order, filled.alias("_filled")), slim, weights, seed, source, order, budget, ranges)
    else:
        drawn = arrivals(slim.withColumn("epoch", F.lit(0)), weights, seed, source, order, **ranges)
    drawn = cut(drawn.where("_filled").drop("_filled"))
    placed = dense_rank_from_zero(drawn, "doc_index", ["arrival", source, "epoch", order],
                                  ceilings=None if budget is None else {"doc_index": F.lit(budget)}, **ranges)
    return placed.drop("arrival")


def interleave(df: DataFrame, weights: dict[str, float], seed: int = 42, *, source: str = "source_id",
               order: str = "ord", **options) -> DataFrame:
    """Blend ``df`` (source, ord, text) by weight; adds ``epoch`` and ``doc_index``.

    Empty texts take part in the draw and are dropped after it. ``looped``
    sources start over until ``stop``: after ``budget`` documents, or once every
    other source is used up (``finite_exhausted``). Only (source, ord) and the
    draw go through the ordering; the text is joined back once by its key, which
    must be unique: a repeated one is an error.
    """
    placed = blend_order(df, weights, seed, source=source, order=order, **options)
    # Rows of one key meet for the join anyway.
    before = F.lag("epoch").over(Window.partitionBy(source, order).orderBy("epoch"))
    repeated = F.raise_error(F.concat(F.lit(f"a {order} occurs twice in source "), F.col(source))).cast("int")
    return df.join(placed.withColumn("epoch", F.when(before == F.col("epoch"), repeated).otherwise(F.col("epoch"))), [source, order])


def _horizon(wanted: float, share: dict[str, float], sizes: dict[str, int]) -> float:
    """By which tick, in units of TICKS, about ``wanted`` rows have arrived; infinite if there are fewer."""
    if wanted >= sum(sizes.values()):
        return math.inf
    low, high = 0.0, 1.0
    while sum(min(n, share.get(s, 0.0) * high) for s, n in sizes.items()) < wanted and high < 1e18:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        enough = sum(min(n, share.get(s, 0.0) * middle) for s, n in sizes.items()) >= wanted
        low, high = (low, middle) if enough else (middle, high)
    return high


def _budgeted_arrivals(raw, slim, weights, seed, source, order, budget, ranges) -> DataFrame:
    """Arrivals of a beginning of each source that holds the first ``budget`` filled rows of the blend.

    By the law of the gaps a source has sent about its share of the ticks by a
    given tick. Rows are counted per source and range of its order, without
    their texts, so that a beginning of as many rows, with slack for chance, is
    a plain filter on the source and its order. The draw of a row does not
    depend on the rows after it; so if enough filled rows arrive before the
    first of the beginnings ends, they are those of the whole blend. If not,
    more is taken.
    """
    share = normalised(weights)
    keys = raw.select(source, order)
    step = ranges.get("rows_per_range") or max(1, min(prefix.ROWS_PER_RANGE, budget // 4))
    points = cut_points(keys, [source, order], step)
    parts = keys.groupBy(source, range_of(keys, [source, order], points).alias("_part")).count().collect()  # ranges and sources at most
    counts: dict[str, list[tuple[int, int]]] = {}
    for name, part, n in sorted(map(tuple, parts), key=lambda r: (r[0] is not None, r)):
        counts.setdefault(name, []).append((part, n))
    sizes = {s: sum(n for _, n in held) for s, held in counts.items()}
    kind = raw.schema[order].dataType
    wanted = budget
    while True:
        tick = _horizon(wanted + 6 * math.sqrt(wanted) + 36, share, sizes)
        mine, open_ended = F.lit(False), []
        for name, held in counts.items():
            rows = share.get(name, math.inf) * tick
            needed, last, taken = rows + 6 * math.sqrt(rows) + 36, None, 0
            for part, n in held:
                taken += n
                if taken >= needed:
                    last = part
                    break
            here = F.col(source).eqNullSafe(F.lit(name))
            if last is not None and taken < sizes[name]:
                # The range ends before its point, which is the same source's: more of it follows.
                here = here & (F.col(order) < F.lit(points[last][1]).cast(kind))
                open_ended.append(name)
            mine = mine | here
        drawn = cut(arrivals(slim.where(mine).withColumn("epoch", F.lit(0)), weights, seed, source, order, **ranges))
        if not open_ended:
            return drawn
        ends = {r[0]: r[1] for r in drawn.groupBy(source).agg(F.max("arrival")).collect()}
        limit = min(ends.get(name, -1) for name in open_ended)
        sure = drawn.where(F.col("arrival") < limit)
        if sure.where("_filled").count() >= budget:
            return sure
        wanted *= 2


def _looped_arrivals(slim, weights, seed, source, order, looped, stop, budget, ranges) -> DataFrame:
    """Arrivals with the looped sources repeated just often enough."""
    share = normalised(weights)
    counts = {r[source]: (r["n"], r["filled"]) for r in
              slim.groupBy(source).agg(F.count("*").alias("n"), F.count_if("_filled").alias("filled")).collect()}
    for s in looped:
        if counts.get(s, (0, 0))[1] == 0:
            raise ValueError(f"looped source {s!r} has no usable rows")
    finite = [s for s in counts if s not in looped]
    once = arrivals(slim.where(~F.col(source).isin(*looped)).withColumn("epoch", F.lit(0)),
                    weights, seed, source, order, **ranges)
    if stop == "finite_exhausted":
        if not finite:
            raise ValueError("no finite source to wait for")
        once = cut(once)
        horizon = once.agg(F.max("arrival")).first()[0]
    elif stop == "budget":
        if budget is None:
            raise ValueError("a looped source needs a document budget or stop='finite_exhausted'")
        # The looped sources alone fill the budget by this tick, with slack for chance.
        rate = sum(share[s] * counts[s][1] / counts[s][0] for s in looped)
        horizon = int((budget + 6 * math.sqrt(budget) + 36) / rate * TICKS)
    else:
        raise ValueError(f"unknown stop rule {stop!r} (use budget / finite_exhausted)")
    parts = [once.where(F.col("arrival") <= horizon)]
    for s in looped:
        rows = counts[s][0]
        expected = horizon / TICKS * share[s]
        epochs = math.ceil((expected + 6 * math.sqrt(expected) + 36) / rows)
        while True:
            again = cut(arrivals(loop(slim.where(F.col(source) == s), epochs), weights, seed, source, order, **ranges))
            if again.agg(F.max("arrival")).first()[0] > horizon:
                break
            epochs *= 2
        parts.append(again.where(F.col("arrival") <= horizon))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if stop == "budget":
        out = cut(out)
        if out.where("_filled").count() < budget:
            raise RuntimeError("the draw fell short of the budget; use another seed")
    return out


def head(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` documents by index."""
    return df.where(F.col("doc_index") < n)


def mix_report(df: DataFrame, weights: dict[str, float], source: str = "source_id") -> DataFrame:
    """Per source: weight asked for, documents, and the share they came to."""
    share = normalised(weights)
    names = F.create_map(*[F.lit(x) for s, w in share.items() for x in (s, float(w))])
    counts = df.groupBy(source).agg(F.count("*").alias("n_docs"))
    total = counts.agg(F.sum("n_docs").alias("_total"))
    return (counts.withColumn("_total", total.scalar())
            .select(source, F.try_element_at(names, F.col(source)).alias("weight"), "n_docs",
                    (F.col("n_docs") / F.col("_total")).alias("share")))
