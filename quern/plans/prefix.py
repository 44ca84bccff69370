"""Running totals over an ordered table without a single-task window.

``Window.orderBy`` without partitions, or with a few large ones, sorts a whole
corpus in one task. Here the order is cut into ranges:

1. a bounded sample gives literal cut points (one count, one small collect);
   where the order is a dense document number, plain division does;
2. the values are summed per (keys, range), with map-side combining;
3. the total of the earlier ranges enters each (keys, range) as one extra first
   row, so a single window, and a single shuffle of the rows, finishes the job.

Cut points are taken over (keys, order) together, so a key with a third of all
rows spans about a third of the ranges, and millions of small keys still give
only about one range each. Values are BIGINT: sums do not depend on the order
in which partitions are added, so neither does the result.
"""

from __future__ import annotations

import json
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_RANGE = 500_000
WIDE_ROWS_PER_RANGE = 25_000  # of rows that carry whole texts through the exchange
MAX_RANGES = 8_192
RANGES_PER_SLOT = 8  # on clusters with more shuffle partitions than that
SAMPLES_PER_RANGE = 24
SMALL_ROWS = 100_000
SAMPLE_SEED = 20_240_501

_RANGE = "_range"
_FIRST = "_first"
_VALUE = "_value_"


def wide() -> dict[str, int]:
    """Options for rows that carry whole texts: a task gathers a few ranges, so these hold fewer rows."""
    return {"rows_per_range": min(ROWS_PER_RANGE, WIDE_ROWS_PER_RANGE)}


def _sortable(df: DataFrame, cols: list[str]) -> list[Column]:
    """Columns with the order of ``cols`` that a string can hold; bytes compare as their hexadecimal form does."""
    out = []
    for c in cols:
        kind = df.schema[c].dataType
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            raise TypeError(f"{c!r} is not a plain value; order by its parts")
        out.append(F.hex(F.col(c)) if isinstance(kind, T.BinaryType) else F.col(c))
    return out


def cut_points(df: DataFrame, cols: list[str], rows_per_range: int | None = None,
               n_rows: int | None = None) -> list[tuple]:
    """Ascending cut points over ``cols``, as strings, for ranges of about equal row counts.

    Spark sorts the sample, so nulls, NaN and every plain type have their usual
    order. At most SAMPLES_PER_RANGE key tuples per range reach the driver. The
    points steer balance only; any points give the same totals.
    """
    rows_per_range = rows_per_range or ROWS_PER_RANGE
    n = df.count() if n_rows is None else n_rows
    most = max(MAX_RANGES, RANGES_PER_SLOT * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = min(most, math.ceil(n / rows_per_range))
    if ranges <= 1:
        return []
    wanted = ranges * SAMPLES_PER_RANGE
    keys = [f"c{i}" for i in range(len(cols))]
    narrow = df.select(*[c.alias(k) for k, c in zip(keys, _sortable(df, cols))])
    if wanted < n:
        narrow = narrow.sample(fraction=wanted / n, seed=SAMPLE_SEED)
    rows = [tuple(r) for r in narrow.orderBy(*keys).select(*[F.col(k).cast("string") for k in keys]).collect()]
    picked = [rows[len(rows) * i // ranges] for i in range(1, ranges)] if rows else []
    return list(dict.fromkeys(picked))


def _literal_points(points: list[tuple], kinds: list[T.DataType]) -> Column:
    """All points as one sorted, foldable array instead of one plan node per value."""
    names = [f"c{i}" for i in range(len(kinds))]
    text = json.dumps([dict(zip(names, p)) for p in points])
    plain = F.from_json(F.lit(text), T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in names])))
    return F.sort_array(plain.cast(T.ArrayType(T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))))


def range_of(df: DataFrame, cols: list[str], points: list[tuple]) -> Column:
    """Number of cut points not above the row's key, by binary search; nulls come first."""
    if not points:
        return F.lit(0).cast("bigint")
    kinds = [T.StringType() if isinstance(df.schema[c].dataType, T.BinaryType) else df.schema[c].dataType for c in cols]
    array = _literal_points(points, kinds)
    key = F.struct(*[k.alias(f"c{i}") for i, k in enumerate(_sortable(df, cols))])
    strides = [2**i for i in range(len(points).bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(s) for s in strides]),
        F.lit(0),
        lambda at, stride: F.when(F.get(array, at + stride - 1) <= key, at + stride).otherwise(at),
    )


def _past_ceilings(bases: DataFrame, keys: list[str], ceilings: dict[str, Column]) -> tuple[DataFrame, DataFrame | None]:
    """The range totals, and the (keys, range) pairs that lie past a ceiling.

    Totals are collected if they are few (SMALL_ROWS at most); the pairs can
    then be broadcast safely. Otherwise nothing is dropped ahead of time.
    """
    rows = bases.limit(SMALL_ROWS + 1).collect()
    if len(rows) > SMALL_ROWS:
        return bases, None
    known = bases.sparkSession.createDataFrame(rows, bases.schema)
    past = reduce(lambda a, b: a | b,
                  [top.isNotNull() & (F.col(_VALUE + name) >= top) for name, top in ceilings.items()])
    return known, known.where(past).select(
        *[F.col(k).alias(f"_past_{k}") for k in keys], F.col(_RANGE).alias("_past_range"))


def prefix_sum(df: DataFrame, values: dict[str, Column], order: list[str],
               keys: list[str] | None = None, *, dense: bool = False, ceilings: dict[str, Column] | None = None,
               rows_per_range: int | None = None, n_rows: int | None = None,
               points_from: DataFrame | None = None) -> DataFrame:
    """Add, per output name, the total of the value over earlier rows of the key.

    ``order`` must be unique inside a key and ascending; nulls come first. The total
    excludes the row itself. With ``dense`` the order is one column of document
    numbers, and ranges need no look at the data. ``ceilings`` maps an output
    name to an exclusive upper bound that depends on the keys only: rows whose
    total reaches it are dropped, whole ranges past it before anything is
    shuffled. ``points_from`` is a cheaper table holding the same key and order
    columns, used for the cut points.
    """
    keys = list(keys or [])
    ceilings = ceilings or {}
    tagged = df.withColumns({_VALUE + n: c.cast("bigint") for n, c in values.items()})
    if dense:
        ranged = True
        tagged = tagged.withColumn(_RANGE, F.expr(f"`{order[0]}` div {rows_per_range or ROWS_PER_RANGE}"))
    else:
        points = cut_points(points_from if points_from is not None else df, keys + list(order), rows_per_range, n_rows)
        ranged = bool(points)
        tagged = tagged.withColumn(_RANGE, range_of(df, keys + list(order), points))
    tagged = tagged.withColumn(_FIRST, F.lit(False))
    if ranged:
        earlier = (Window.partitionBy(*(keys or [F.lit(0)])).orderBy(_RANGE)
                   .rowsBetween(Window.unboundedPreceding, -1))
        bases = (tagged.groupBy(*keys, _RANGE)
                 .agg(*[F.sum(_VALUE + n).alias(_VALUE + n) for n in values])
                 .select(*keys, _RANGE, *[F.coalesce(F.sum(_VALUE + n).over(earlier), F.lit(0)).alias(_VALUE + n)
                                          for n in values]))
        if ceilings:
            bases, past = _past_ceilings(bases, keys, ceilings)
            if past is not None:
                on = F.col(_RANGE) == F.col("_past_range")
                for k in keys:
                    on = on & F.col(k).eqNullSafe(F.col(f"_past_{k}"))
                tagged = tagged.join(F.broadcast(past), on, "left_anti")
        tagged = tagged.unionByName(bases.withColumn(_FIRST, F.lit(True)), allowMissingColumns=True)
    before = (Window.partitionBy(*keys, _RANGE).orderBy(F.desc(_FIRST), *order)
              .rowsBetween(Window.unboundedPreceding, -1))
    out = tagged.withColumns({n: F.coalesce(F.sum(_VALUE + n).over(before), F.lit(0).cast("bigint")) for n in values})
    out = out.where(~F.col(_FIRST))
    for name, top in ceilings.items():
        out = out.where(top.isNull() | (F.col(name) < top))
    return out.drop(*[_VALUE + n for n in values], _RANGE, _FIRST)


def dense_rank_from_zero(df: DataFrame, name: str, order: list[str],
                         keys: list[str] | None = None, **kwargs) -> DataFrame:
    """Add the dense 0-based position of each row in ``order`` as ``name``."""
    return prefix_sum(df, {name: F.lit(1)}, order, keys, **kwargs)
