"""Whitening of embeddings, with each distinct vector handled once.

1. Vectors become whole numbers, x = floor(SCALE * c) + SHIFT, and equal ones
   are counted: one exchange, combined per task, so that a vector that a third
   of all rows share is one row afterwards.
2. The fit runs over the distinct vectors, each weighted by its count or by
   one: exact sums per dimension, then one centred product per block of
   vectors. Spark adds the D x D partial sums; the driver sees D sums and one
   D x D matrix, whatever the number of rows, and takes its eigenvectors.
3. Each distinct vector is centred and projected once, again a product per
   block, and the result is joined back to the rows. The few vectors of very
   many copies are salted in that join.

Cases: rows whose vector is null or holds a null, NaN or infinite entry are
dropped, and so are empty vectors and those of another length than most (of
equally frequent lengths the larger counts). Entries are held within
+-2**52 / SCALE, so that x is exact as double. Directions without variance
(eigenvalue not above D * 2**-52 of the largest) have no component; if there is
no other, the result is empty. Null and repeated ids stay, a row for each. A
deviation beyond 64 bits is null. Other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm import common
from quern.plans.skew import SHARE, spread_join

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
#: Rows of a matrix that a task multiplies at a time.
BLOCK = 4_096
LARGEST = float(1 << 52)
LOW_BITS = 26
#: A vector with fewer copies is never salted.
MIN_COPIES = 10_000


@dataclass(frozen=True)
class Fit:
    """What the rows' transformation needs: total weight, exact sums, components by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray  # a component per column
    trace: float


def quantised(vector: Column) -> Column:
    """Whole-number form of a vector; null if it has a null or non-finite entry, or none at all."""
    ok = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    held = F.transform(vector, lambda c: (F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-LARGEST)), F.lit(LARGEST)))
                                          + SHIFT).cast("bigint"))
    return F.when((F.size(vector) > 0) & ok, held)


def _matrix(column: pa.ListArray, lo: int, hi: int, dims: int) -> np.ndarray:
    return column.slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _blocks(batch: pa.RecordBatch, column: str, dims: int):
    values, weights = batch.column(column), batch.column("_weight").to_numpy()
    for lo in range(0, batch.num_rows, BLOCK):
        hi = min(lo + BLOCK, batch.num_rows)
        yield _matrix(values, lo, hi, dims), weights[lo:hi]


def exact_sums(table: DataFrame, column: str, dims: int) -> tuple[int, list[int]]:
    """Total weight and weighted sums per dimension of whole numbers, added up in two halves so that none overflows."""
    def run(batches):
        high, low = [0] * dims, [0] * dims
        for batch in batches:
            for x, w in _blocks(batch, column, dims):
                # In floats nothing here would be exact; halves of 26 and 27 bits times a count stay within 64.
                w = w[:, None]
                for held, part in ((high, x >> LOW_BITS), (low, x & ((1 << LOW_BITS) - 1))):
                    for i, s in enumerate((part * w).sum(axis=0).tolist()):
                        held[i] += s
        yield pa.RecordBatch.from_pydict({"i": list(range(dims)), "high": [str(v) for v in high], "low": [str(v) for v in low]})

    n = table.agg(F.sum("_weight")).first()[0] or 0
    halves = (table.select(column, "_weight").mapInArrow(common.tidy(run), "i bigint, high string, low string")
              .groupBy("i").agg(F.sum(F.col("high").cast("decimal(38,0)")), F.sum(F.col("low").cast("decimal(38,0)"))))
    found = {i: (int(high) << LOW_BITS) + int(low) for i, high, low in halves.collect()}
    return n, [found.get(i, 0) for i in range(dims)]


def covariance(table: DataFrame, column: str, dims: int, n: int, centred) -> np.ndarray:
    """Weighted covariance, divisor ``n``; ``centred`` turns a block of rows into differences from their mean."""
    def run(batches):
        product, rest = np.zeros((dims, dims)), np.zeros(dims)
        for batch in batches:
            for x, w in _blocks(batch, column, dims):
                d = centred(x)
                heavy = d * w[:, None]
                product += heavy.T @ d
                rest += heavy.sum(axis=0)
        rows = pa.ListArray.from_arrays(pa.array(np.arange(dims + 1) * (dims + 1), pa.int32()), pa.array(np.column_stack([product, rest]).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), rows], ["i", "row"])

    cells = (table.select(column, "_weight").mapInArrow(common.tidy(run), "i bigint, row array<double>")
             .select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v")))
    full = np.zeros((dims, dims + 1))
    for i, j, v in cells.collect():
        full[i, j] = v
    # What rounding left of the mean is taken out again.
    rest = full[:, dims] / n
    return full[:, :dims] / n - np.outer(rest, rest)


def _differences(n: int, sums: tuple[int, ...]):
    """A block of x as n * x - sums, exact: 64-bit if that surely fits, Python's integers if not."""
    lowest, highest = min(sums, default=0), max(sums, default=0)

    def run(x: np.ndarray) -> np.ndarray:
        most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(abs(lowest), abs(highest))
        if most < 1 << 62:
            return x * n - np.array(sums, np.int64)
        return x.astype(object) * n - np.array(sums, object)
    return run


def _squares(d: np.ndarray) -> list[int | None]:
    top = max(abs(int(d.max(initial=0))), abs(int(d.min(initial=0))))
    if d.dtype == object or top * top * d.shape[1] >= 1 << 63:
        sums = [sum(int(v) ** 2 for v in row) for row in d.tolist()]
        return [s if s < 1 << 63 else None for s in sums]
    return (d * d).sum(axis=1).tolist()


def distinct_vectors(df: DataFrame, vector: str, fit: str = "one") -> DataFrame:
    """Each distinct whole-number vector with its key, copies and weight; written once."""
    if fit not in ("one", "counts"):
        raise ValueError("vectors are fitted by 'one' or by 'counts'")
    found = df.select(quantised(F.col(vector)).alias("_x")).where(F.col("_x").isNotNull()).groupBy("_x").agg(F.count(F.lit(1)).alias("_copies"))
    weight = F.lit(1).cast("bigint") if fit == "one" else F.col("_copies")
    return common.kept(found.select(*_key(F.col("_x")), "_x", "_copies", weight.alias("_weight")), "vectors")


def _key(x: Column) -> list[Column]:
    """128 bits of a whole-number vector, to join by."""
    return [F.xxhash64(x).alias("_k1"), F.xxhash64(F.lit("second"), x).alias("_k2")]


def usual_length(table: DataFrame) -> int:
    row = (table.groupBy(F.size("_x").alias("d")).agg(F.sum("_copies").alias("n")).orderBy(F.desc("n"), F.desc("d")).first())
    return row["d"] if row else 0


def fit_components(table: DataFrame, dims: int) -> Fit:
    n, sums = exact_sums(table, "_x", dims)
    exact = _differences(n, tuple(sums))
    matrix = covariance(table, "_x", dims, n, lambda x: exact(x).astype(np.float64) / n)
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    usable = values > max(values[0], 0.0) * dims * 2.0**-52
    return Fit(n, tuple(sums), values[usable], vectors[:, usable], float(np.trace(matrix)))


def project(table: DataFrame, dims: int, fit: Fit, components: int) -> DataFrame:
    """(key, deviation, whitened, weight) of each distinct vector; written once."""
    k = min(components, len(fit.values))
    scaled = fit.vectors[:, :k] / np.sqrt(fit.values[:k])
    exact, n = _differences(fit.n, fit.sums), fit.n

    def run(batch: pa.RecordBatch):
        at = batch.schema.get_field_index
        for lo in range(0, batch.num_rows, BLOCK):
            hi = min(lo + BLOCK, batch.num_rows)
            d = exact(_matrix(batch.column(at("_x")), lo, hi, dims))
            y = (d.astype(np.float64) / n) @ scaled
            made = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * k, pa.int32()), pa.array(y.ravel()))
            kept = [batch.column(at(c)).slice(lo, hi - lo) for c in ("_k1", "_k2", "_weight")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(_squares(d), pa.int64()), made], ["_k1", "_k2", "_weight", "_deviation", "_whitened"])

    schema = "_k1 bigint, _k2 bigint, _weight bigint, _deviation bigint, _whitened array<double>"
    return common.kept(common.map_arrow(table.select("_k1", "_k2", "_weight", "_x"), run, schema), "whitened")


def whiten(df: DataFrame, vector: str = "embedding", keep: tuple[str, ...] = ("vec_id",), components: int = COMPONENTS, fit: str = "one") -> DataFrame:
    """Rows that take part, as ``keep`` and ``n``, ``deviation``, ``whitened`` (an array), ``explained`` (likewise), ``identity_error``.

    ``fit`` says what a distinct vector counts for: ``one``, or its ``counts``.
    """
    table = distinct_vectors(df, vector, fit)
    dims = usual_length(table)
    same = table.where(F.size("_x") == dims)
    found = fit_components(same, dims) if dims else None
    kinds = [df.schema[c] for c in keep]
    if found is None or not len(found.values):
        return df.sparkSession.createDataFrame([], T.StructType([*kinds, *T._parse_datatype_string(
            "n bigint, deviation bigint, whitened array<double>, explained array<double>, identity_error double").fields]))
    white = project(same, dims, found, components)
    k = min(components, len(found.values))
    error = float(np.abs(covariance(white, "_whitened", k, found.n, lambda y: y) - np.eye(k)).max())
    # At most SHARE vectors can have so many copies.
    rows = table.agg(F.sum("_copies")).first()[0]
    hot = [tuple(r) for r in same.where(F.col("_copies") >= max(MIN_COPIES, rows // SHARE + 1)).select("_k1", "_k2").collect()]
    x = quantised(F.col(vector))
    mine = df.select(*[F.col(f"`{c}`") for c in keep], x.alias("_x")).where(F.col("_x").isNotNull()).select(*[f"`{c}`" for c in keep], *_key(F.col("_x")))
    joined = spread_join(mine, white.drop("_weight"), ["_k1", "_k2"], list(keep), hot=hot)
    share = [float(v) / found.trace for v in found.values[:k]]
    return joined.select(*[F.col(f"`{c}`") for c in keep], F.lit(found.n).cast("bigint").alias("n"), F.col("_deviation").alias("deviation"),
                         F.col("_whitened").alias("whitened"), F.lit(share).cast("array<double>").alias("explained"), F.lit(error).alias("identity_error"))


def components_of_rows(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector and component."""
    rows = whiten(common.narrow(df, vec_id=vec_id, vector=vector), "_vector", ("_vec_id",))
    listed = rows.select("_vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("_at", "whitened"))
    return listed.select(F.col("_vec_id").alias("vec_id"), (F.col("_at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                         F.get("explained", F.col("_at")).alias("explained"), "identity_error")
