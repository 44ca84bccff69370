"""Filters over scored candidates: (group, item, score) tables of any size.

Statistics of ordinary groups are windows over one exchange; those of hot groups
are aggregates, combined before the shuffle. Cumulative rules use the ranged
running total. No step gathers a hot group in one task. Null is a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.draw import unit
from quern.plans.prefix import dense_rank_from_zero, prefix_sum
from quern.plans.skew import hot_keys, null_safe_join, spread_join, with_group_stat

ONE = 2**62         # probability 1 as BIGINT, so that running totals are exact sums
GROUP_LIMIT = 1_000  # up to this k the optimiser limits groups before the shuffle


def penalise(df: DataFrame, seen: DataFrame, penalty: float, group: str = "group", item: str = "item",
             score: str = "score") -> DataFrame:
    """Push down the score of items already seen, once however often they were."""
    if penalty == 1.0:
        return df
    once = seen.select(group, item).distinct().withColumn("_seen", F.lit(True))
    lower = F.when(F.col(score) > 0, F.col(score) / F.lit(penalty)).otherwise(F.col(score) * F.lit(penalty))
    return (null_safe_join(df, once, [group, item], "left")
            .withColumn(score, F.when(F.col("_seen"), lower).otherwise(F.col(score)))
            .drop("_seen"))


def usable(df: DataFrame, score: str = "score") -> DataFrame:
    """Rows with a number for a score: null and NaN are never candidates."""
    return df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))


def softmax(df: DataFrame, temperature: float = 1.0, group: str = "group", item: str = "item",
            score: str = "score", min_hot_rows: int | None = None) -> DataFrame:
    """Add ``prob``: scores over the temperature as probabilities per group.

    Null is a group; rows without a usable score get a null probability and
    count for nothing. The sums are over whole numbers, so that a probability
    does not depend on the order in which rows are added.
    """
    if temperature <= 0:
        raise ValueError("temperature must be above zero; use argmax for greedy choice")
    hot = hot_keys(df, [group], min_hot_rows)
    number = F.col(score).cast("double")
    scaled = df.withColumn("_x", F.when(~F.isnan(number), number) / F.lit(float(temperature)))
    raised = with_group_stat(scaled, [group], F.max("_x"), "_top", hot).withColumn(
        "_e", F.floor(F.exp(F.col("_x") - F.col("_top")) * F.lit(float(ONE))).cast("decimal(20,0)"))
    return (with_group_stat(raised, [group], F.sum("_e"), "_z", hot)
            .withColumn("prob", F.col("_e").cast("double") / F.col("_z").cast("double")).drop("_x", "_top", "_e", "_z"))


def top_k(df: DataFrame, k: int, group: str = "group", item: str = "item", score: str = "score",
          min_hot_rows: int | None = None, **ranges) -> DataFrame:
    """Keep scores not below the k-th of their group; ties with the k-th stay, null and NaN go.

    To find the k-th score, groups are limited per task, then per slot of items,
    then as a whole, so that a group's rows from all tasks never meet in one.
    The rows are then filtered by it, so any number of ties costs nothing extra.
    """
    df = usable(df, score)
    slim = df.select(group, item, score)
    if k <= GROUP_LIMIT:
        slots = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranked = slim.withColumn("_slot", F.pmod(F.xxhash64(item), F.lit(slots)))
        for keys in ([group, "_slot"], [group]):
            best = Window.partitionBy(*keys).orderBy(F.desc(score))
            ranked = ranked.withColumn("_at", F.row_number().over(best)).where(F.col("_at") <= k).drop("_at")
    else:
        ordered = slim.withColumn("_down", -F.col(score))
        ranked = dense_rank_from_zero(ordered, "_at", ["_down", item], [group], **ranges).where(F.col("_at") < k)
    floors = ranked.groupBy(group).agg(F.min(score).alias("_floor"))
    return (spread_join(df, floors, [group], [item], hot=hot_keys(df, [group], min_hot_rows))
            .where(F.col(score) >= F.col("_floor")).drop("_floor"))


def nucleus(df: DataFrame, p: float, group: str = "group", item: str = "item", score: str = "score",
            min_hot_rows: int | None = None, **ranges) -> DataFrame:
    """Keep a row while the probability ranked before it is at most ``p``.

    The first row always stays; p outside (0, 1) turns the filter off. Equal
    scores rank by item; null and NaN are no candidates.
    """
    if not 0.0 < p < 1.0:
        return df
    df = usable(df, score)
    ordered = softmax(df, 1.0, group, item, score, min_hot_rows).withColumn("_down", -F.col(score))
    mass = F.floor(F.col("prob") * F.lit(float(ONE))).cast("bigint")
    before = prefix_sum(ordered, {"_before": mass}, ["_down", item], [group],
                        points_from=df.withColumn("_down", -F.col(score)), **ranges)
    return before.where(F.col("_before") <= F.lit(int(p * ONE))).drop("_before", "_down", "prob")


def argmax(df: DataFrame, group: str = "group", item: str = "item", score: str = "score") -> DataFrame:
    """The best item per group; the lowest item among equals. Null and NaN are no candidates."""
    df = usable(df, score)
    best = F.min(F.struct((-F.col(score)).alias("down"), F.col(item).alias("item")))
    return df.groupBy(group).agg(best.alias("_best")).select(
        group, F.col("_best.item").alias(item), (-F.col("_best.down")).alias(score))


def pick(df: DataFrame, seed: int, group: str = "group", item: str = "item", prob: str = "prob") -> DataFrame:
    """One item per group, drawn with its probability.

    The largest ln(p) - ln(-ln(u)) of independent uniform u falls on an item
    with exactly its probability, and a maximum needs no gathering.
    """
    noise = -F.log(-F.log(unit(seed, F.col(group), F.col(item))))
    key = F.log(prob) + noise
    best = F.min(F.struct((-key).alias("down"), F.col(item).alias("item")))
    return (df.where(F.col(prob) > 0).groupBy(group).agg(best.alias("_best"))
            .select(group, F.col("_best.item").alias(item)))


def choose(df: DataFrame, seed: int, seen: DataFrame | None = None, penalty: float = 1.0, temperature: float = 1.0,
           k: int | None = None, p: float | None = None, group: str = "group", item: str = "item",
           score: str = "score") -> DataFrame:
    """All filters in their order, then one item per group."""
    names = {"group": group, "item": item, "score": score}
    if seen is not None:
        df = penalise(df, seen, penalty, **names)
    if temperature <= 0:
        return argmax(df, **names).select(group, item)
    df = df.withColumn(score, F.col(score) / F.lit(float(temperature)))
    if k is not None:
        df = top_k(df, k, **names)
    if p is not None:
        df = nucleus(df, p, **names)
    return pick(softmax(df, 1.0, **names), seed, group, item)
