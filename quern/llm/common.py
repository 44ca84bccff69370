"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.plans import stage

WORD_CACHE = 1 << 17
GOLDEN = 0x9E3779B97F4A7C15
#: With it, what a query shuffled goes when the query ends; else when the driver happens to collect its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slots(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read again; what was shuffled for it is deleted."""
    path, conf = stage.fresh_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(RELEASE, None)
    conf.set(RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(RELEASE) if before is None else conf.set(RELEASE, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_by(df: DataFrame, name: str, column: str) -> dict:
    """``kept``, with a folder per value of ``column``: a function from a value to its table, one to delete it."""
    spark, path = df.sparkSession, stage.fresh_path(df.sparkSession, name)
    df.write.partitionBy(column).parquet(path)
    schema = T.StructType([f for f in df.schema.fields if f.name != column])

    def folder(value):
        return spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")

    def read(value) -> DataFrame:
        place = folder(value)
        found = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
        return spark.read.schema(schema).parquet(str(place)) if found else spark.createDataFrame([], schema)

    def delete(value) -> None:
        place = folder(value)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

    return {"read": read, "delete": delete}


def drop_kept(df: DataFrame) -> None:
    """Delete a table that ``kept`` wrote and nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns called like the results (case does not matter)."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c.replace('`', '``')}`"] for c in df.columns if c.lower() not in taken])


def narrow(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, as ``_name``; other columns cannot clash then."""
    return df.select(*[df[f"`{c}`"].alias(f"_{n}") for n, c in cols.items()])


class WordHashes(dict):
    """64-bit hash of each word (bytes); emptied when it holds WORD_CACHE words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def text_bytes(values: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [v if v is not None else b"" for v in values.cast(pa.large_binary()).to_pylist()]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix64)."""
    with np.errstate(over="ignore"):
        z = x + np.uint64((salt * GOLDEN + GOLDEN) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def windows(h: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of k consecutive values; empty if there are fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        acc = np.full(n, (salt * 2 + 1) & 0xFFFFFFFFFFFFFFFF, np.uint64)
        for i in range(k):
            acc = acc * np.uint64(GOLDEN) + h[i:i + n]
            acc ^= acc >> np.uint64(29)
        return mix(acc, salt)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on after a task, beside others on their machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run):
    """A task's function that gives its memory back when it is done."""
    def tidied(batches):
        yield from run(batches)
        give_back()
    return tidied


def map_arrow(df: DataFrame, fn, schema: T.StructType | str) -> DataFrame:
    """mapInArrow over a function from one record batch to batches or one batch."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None:
                    yield from ([out] if isinstance(out, pa.RecordBatch) else out)
    return df.mapInArrow(tidy(run), schema)


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the BIGINT with the same bits."""
    return x.view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.int64).view(np.uint64)


def total_rows(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]
