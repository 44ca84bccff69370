"""Ranges of an integer order, and each row's follower in descending order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm import common

LOWEST = -(1 << 63)


def cut_points(ids: DataFrame, column: str, ranges: int) -> list[int]:
    """At most ``ranges`` - 1 ascending values that split a BIGINT column about evenly."""
    parts = [i / ranges for i in range(1, ranges)]
    found = ids.agg(F.percentile_approx(column, parts, 10 * ranges).alias("p")).first()[0] if parts else []
    return sorted(set(found or []))


def range_of(column: Column, points: list[int]) -> Column:
    """How many of the points are not above the value, by binary search."""
    if not points:
        return F.lit(0)
    array = F.lit(points).cast("array<bigint>")
    strides = F.lit([1 << i for i in range(len(points).bit_length() - 1, -1, -1)])
    return F.aggregate(strides, F.lit(0), lambda at, step: F.when(F.get(array, at + step - 1) <= column, at + step).otherwise(at))


def with_follower(docs: DataFrame, doc_id: str, tie: str, columns: list[str], made=lambda df: df) -> DataFrame:
    """Add ``next_<column>`` of the next row in descending ``doc_id`` (the last row's is the first).

    Equal ids are ordered by ``tie``; a null id comes last. Rows are dealt into
    ranges of ids. The head of each range also goes, as a ghost, to the end of
    the range before it, so that a window per range is enough and rows move
    once. ``made`` adds the columns to be looked up, before the window.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LOWEST))
    points = cut_points(docs.select(key.alias("k")), "k", 2 * common.slots(spark))
    dealt = docs.withColumn("_key", key).withColumn("_range", range_of(F.col("_key"), points))
    # One id per range at most: the heads.
    heads = dict(dealt.groupBy("_range").agg(F.max("_key")).collect())
    order = sorted(heads, reverse=True)
    goes_to = {heads[r]: before for before, r in zip([order[-1], *order], order)} if order else {}
    first = Window.partitionBy("_key").orderBy(F.col(tie).asc_nulls_first())
    ghosts = dealt.where(F.col("_key").isin(list(goes_to)))
    ghosts = ghosts.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")
    if goes_to:
        to = spark.createDataFrame(list(goes_to.items()), "_key bigint, _to int")
        ghosts = ghosts.join(F.broadcast(to), "_key").withColumn("_range", F.col("_to")).drop("_to")
    both = made(dealt.withColumn("_ghost", F.lit(0)).unionByName(ghosts.withColumn("_ghost", F.lit(1))))
    down = Window.partitionBy("_range").orderBy("_ghost", F.col("_key").desc(), F.col(tie).asc_nulls_first())
    out = both.withColumns({f"next_{c.lstrip('_')}": F.lead(c).over(down) for c in columns})
    return out.where("_ghost = 0").drop("_ghost", "_key", "_range")
