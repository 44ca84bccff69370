"""Equi-joins in which a few keys of the large side may hold most of its rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARE = 1_000  # a key is hot from 1/SHARE of the rows on, so at most SHARE keys are hot
MIN_HOT_ROWS = 1_000_000


def hot_keys(big: DataFrame, keys: list[str], min_rows: int | None = None) -> list[tuple]:
    """Keys holding at least 1/SHARE of the rows: never more than SHARE of them."""
    floor = MIN_HOT_ROWS if min_rows is None else min_rows
    n = big.count()
    if n < floor:
        return []
    bound = max(floor, -(-n // SHARE))
    counts = big.groupBy(*keys).count().where(F.col("count") >= bound)
    return [tuple(r)[:-1] for r in counts.collect()]


def is_hot(keys: list[str], hot: list[tuple]) -> Column:
    """True for the rows of a hot key; null is a key like any other."""
    return reduce(lambda a, b: a | b,
                  [reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(keys, key)]) for key in hot],
                  F.lit(False))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which null keys meet; the keys of ``left`` stay."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(other, on, how).drop(*[f"_right_{k}" for k in keys])


def spread_join(big: DataFrame, small: DataFrame, keys: list[str], spread_on: list[str], how: str = "inner",
                hot: list[tuple] | None = None) -> DataFrame:
    """Join ``small`` (unique on ``keys``) to ``big``, spreading the ``hot`` keys of ``big``.

    Rows of a hot key are salted by ``spread_on`` over as many slots as there
    are shuffle partitions; only the hot rows of ``small`` are repeated. Without
    hot keys this is a plain join that adaptive execution may turn into a
    broadcast once it has seen the real sizes. Null keys meet.
    """
    if hot is None:
        hot = hot_keys(big, keys)
    if not hot:
        return null_safe_join(big, small, keys, how)
    slots = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = big.withColumn(
        "_slot", F.when(is_hot(keys, hot), F.pmod(F.xxhash64(*spread_on), F.lit(slots)).cast("int")).otherwise(0))
    repeated = small.withColumn(
        "_slot", F.explode(F.sequence(F.lit(0), F.when(is_hot(keys, hot), slots - 1).otherwise(0))))
    return null_safe_join(salted, repeated, [*keys, "_slot"], how).drop("_slot")


def with_group_stat(df: DataFrame, keys: list[str], stat: Column, name: str, hot: list[tuple]) -> DataFrame:
    """Add an aggregate of each row's group as ``name``, without gathering a hot group in one task.

    Ordinary groups take one exchange and a window. Hot keys (``hot_keys`` finds
    no more than SHARE) are aggregated, and their few rows are sent to all tasks.
    """
    if not hot:
        return df.withColumn(name, stat.over(Window.partitionBy(*keys)))
    mine = is_hot(keys, hot)
    many = df.where(mine)
    found = F.broadcast(many.groupBy(*keys).agg(stat.alias(name)))
    return null_safe_join(many, found, keys).unionByName(
        df.where(~mine).withColumn(name, stat.over(Window.partitionBy(*keys))))
