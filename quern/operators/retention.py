"""Which numbered artifacts are newest, and which may go."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.plans.prefix import dense_rank_from_zero

# Artifact names, as an optional folder prefix and a step number.
NAME_PATTERN = r"^(.*/)?ckpt_([0-9]+)\.pt$"
GROUP_LIMIT = 1_000  # up to this number the optimiser limits prefixes before the shuffle


def steps(listing: DataFrame, path: str = "path") -> DataFrame:
    """Add ``prefix`` and the integer ``step``; other files are left out."""
    return (listing.where(F.col(path).rlike(NAME_PATTERN))
            .withColumns({"prefix": F.regexp_extract(path, NAME_PATTERN, 1),
                          "step": F.regexp_extract(path, NAME_PATTERN, 2).cast("bigint")}))


def latest(listing: DataFrame, path: str = "path") -> DataFrame:
    """The artifact with the highest step of every prefix."""
    best = F.max(F.struct("step", F.col(path).alias("path")))
    return (steps(listing, path).groupBy("prefix").agg(best.alias("_best"))
            .select("prefix", F.col("_best.step").alias("step"), F.col("_best.path").alias(path)))


def retention(listing: DataFrame, keep: int, path: str = "path") -> DataFrame:
    """Add ``action``: ``keep`` for the newest ``keep`` per prefix, else ``delete``.

    ``keep`` <= 0 keeps everything. Up to GROUP_LIMIT the newest are found per
    prefix and task, then per slot of paths, then as a whole, so that a prefix
    never meets in one task; beyond, they are numbered by ranges. The listing is
    then matched by its unique path.
    """
    known = steps(listing, path)
    if keep <= 0:
        return known.withColumn("action", F.lit("keep"))
    ordered = known.withColumn("_down", -F.col("step"))
    if keep <= GROUP_LIMIT:
        slots = int(listing.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranked = ordered.select("prefix", "_down", path, F.pmod(F.xxhash64(path), F.lit(slots)).alias("_slot"))
        for keys in (["prefix", "_slot"], ["prefix"]):
            newest = Window.partitionBy(*keys).orderBy("_down", path)
            ranked = ranked.withColumn("_at", F.row_number().over(newest)).where(F.col("_at") <= keep).drop("_at")
    else:
        ranked = dense_rank_from_zero(ordered.select("prefix", "_down", path), "_at", ["_down", path], ["prefix"]).where(F.col("_at") < keep)
    kept = ranked.select(path, F.lit("keep").alias("action"))
    return (known.join(kept, path, "left")
            .withColumn("action", F.coalesce("action", F.lit("delete"))))
