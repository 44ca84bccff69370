"""Places for intermediate tables that must outlive the executors that wrote them."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is made up only on a ``local`` master, where the
    driver and the executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quern-"))
    return sc.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nothing has been written to yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme Spark would give it, for readers and writers outside Spark."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = fs.makeQualified(hadoop_path).toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and drop its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def content_key(spark: SparkSession, path: str) -> str:
    """Digest of a table's full path and of the sizes and times of its files."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(f"{s.getPath()}|{s.getLen()}|{s.getModificationTime()}" for s in fs.listStatus(place))
    return hashlib.sha256("\n".join([str(fs.makeQualified(place)), *parts]).encode()).hexdigest()[:24]


class RollingTable:
    """A table rewritten many times by a loop: each version replaces the last.

    The old version is deleted only once the new one is committed, so a lost
    executor finds its input, and a long loop leaves one version on disk.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.path = spark, name, None

    def put(self, df: DataFrame) -> DataFrame:
        path = fresh_path(self.spark, self.name)
        df.write.parquet(path)
        self.drop()
        self.path = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        if self.path is not None:
            drop_path(self.spark, self.path)
            self.path = None


def complete(spark: SparkSession, path: str) -> bool:
    """True once a write to ``path`` was committed, not merely started."""
    return exists(spark, f"{path}/_SUCCESS")
