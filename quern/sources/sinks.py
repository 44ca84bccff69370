"""Token tables and 16-bit shards."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.plans.stage import complete, qualified

MANIFEST = "split string, shard_id long, path string, start long, n_tokens long"
CHUNKS_PER_FILE = 1_024


def write_tokens(chunks: DataFrame, path: str, fingerprint: str | None = None, chunks_per_file: int = CHUNKS_PER_FILE) -> bool:
    """Write (split, chunk_id, tokens) as Parquet by split, sorted by chunk.

    Returns False, writing nothing, if a committed table is already there. The
    commit marker decides, so a half-written table is written again. A table
    that was coded with another vocabulary is an error, never taken for this one.
    """
    spark = chunks.sparkSession
    if complete(spark, path):
        if fingerprint is not None:
            there = spark.read.parquet(path)
            found = there.select("vocabulary").first() if "vocabulary" in there.columns else None
            if found is None and there.isEmpty():
                return False
            if found is None or found[0] != fingerprint:
                raise ValueError(f"the table at {path!r} was coded with vocabulary {found and found[0]}, not {fingerprint}")
        return False
    if fingerprint is not None:
        chunks = chunks.withColumn("vocabulary", F.lit(fingerprint))
    # Chunk ids are dense, so equal runs of them need no sample of the data.
    (chunks.repartition("split", F.expr(f"chunk_id div {chunks_per_file}")).sortWithinPartitions("split", "chunk_id")
     .write.mode("overwrite").partitionBy("split").parquet(path))
    return True


def export_u16(chunks: DataFrame, path: str, size: int, chunks_per_shard: int = 512) -> DataFrame:
    """Write each split as little-endian 16-bit shards; returns the manifest.

    A shard is a fixed run of chunks, so its place in the stream follows from
    its number. Every export writes into a folder of its own, every attempt of a
    task under names of its own; the manifest, committed last as a table, says
    which files make up the export. Readers follow the manifest, so neither an
    older export nor a repeated task can mix its files in. ``path`` must be a
    folder every executor can reach.
    """
    shard = F.expr(f"chunk_id div {chunks_per_shard}")
    placed = (chunks.select("split", shard.alias("shard_id"), "chunk_id", "tokens")
              .repartition("split", "shard_id").sortWithinPartitions("split", "shard_id", "chunk_id"))
    span = size * chunks_per_shard
    path = qualified(chunks.sparkSession, path)
    folder = f"{path}/run-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        import numpy as np
        import pyarrow as pa
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        key, out, name, written = None, None, None, 0

        def finish():
            out.close()
            return pa.RecordBatch.from_pydict(
                {"split": [key[0]], "shard_id": [key[1]], "path": [name], "start": [key[1] * span],
                 "n_tokens": [written]},
                schema=pa.schema([("split", pa.string()), ("shard_id", pa.int64()), ("path", pa.string()),
                                  ("start", pa.int64()), ("n_tokens", pa.int64())]))

        for batch in batches:
            splits, shards = batch.column("split").to_pylist(), batch.column("shard_id").to_pylist()
            tokens = batch.column("tokens")
            for i, at in enumerate(zip(splits, shards)):
                if at != key:
                    if key is not None:
                        yield finish()
                    key, written = at, 0
                    name = f"{root}/{at[0]}-{at[1]:08d}-{uuid.uuid4().hex}.u16"
                    out = files.open_output_stream(name)
                ids = tokens[i].values.to_numpy(zero_copy_only=False)
                if len(ids) and (ids.min() < 0 or ids.max() > 65_535):
                    raise ValueError("an id does not fit in 16 bits")
                out.write(ids.astype("<u2").tobytes())
                written += len(ids)
        if key is not None:
            yield finish()

    placed.mapInArrow(write, MANIFEST).withColumn("folder", F.lit(folder)).write.mode("overwrite").parquet(f"{path}/manifest")
    return _manifest(chunks.sparkSession, path).drop("folder")


def _manifest(spark, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST + ", folder string").parquet(f"{path}/manifest")


def read_u16(spark, path: str) -> DataFrame:
    """The shards of the manifest as (split, shard_id, n_tokens, tokens)."""
    manifest = _manifest(spark, path)
    first = manifest.first()

    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            yield pa.array([np.frombuffer(b, dtype="<u2").astype(np.int32) for b in batch.to_pylist()],
                           type=pa.list_(pa.int32()))

    if first is None:
        return spark.createDataFrame([], "split string, shard_id bigint, n_tokens bigint, tokens array<int>")
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.u16").load(first["folder"])
    name = F.substring_index("path", "/", -1).alias("_name")
    listed = manifest.select("split", "shard_id", name)
    return (raw.select(name, F.expr("length div 2").alias("n_tokens"), F.arrow_udf(ids, "array<int>")(F.col("content")).alias("tokens"))
            .join(listed, "_name").select("split", "shard_id", "n_tokens", "tokens"))
