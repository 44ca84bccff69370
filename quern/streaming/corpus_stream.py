"""Reading a folder that keeps growing, and indexing what arrives.

Projections (text normalising, templating, pre-tokenising, coding) run on the
stream as they do on a table. Document numbers and stream offsets need running
totals; they are kept in a ledger with one row per batch and split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quern.operators.tokens import offsets, split, split_summary, with_doc_index
from quern.plans.prefix import wide
from quern.plans.stage import cut
from quern.sources.corpus import text_of
from quern.sources.jsonl import parse_jsonl

LEDGER = "split string, n_docs long, n_tokens long"


def open_stream(spark: SparkSession, folder: str, schema: T.StructType | str, kind: str = "jsonl",
                field: str = "text", glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Streaming rows of ``folder`` with ``text`` set and empty texts dropped."""
    reader = spark.readStream
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if kind == "jsonl":
        rows = parse_jsonl(reader.text(folder), schema)
    else:
        rows = reader.schema(schema).format(kind).load(folder)
    return text_of(rows, field)


def totals_before(spark: SparkSession, ledger: str, batch_id: int) -> dict[str, tuple[int, int]]:
    """(documents, tokens) per split over all batches before ``batch_id``.

    Batches are numbered without gaps and each leaves running totals, so only
    the entry of the one before is read, however long the stream has run.
    """
    if batch_id == 0:
        return {}
    rows = spark.read.schema(LEDGER).parquet(f"{ledger}/{batch_id - 1}").collect()
    return {r["split"]: (r["n_docs"], r["n_tokens"]) for r in rows}


def index_batch(batch: DataFrame, order: list[str], totals: dict[str, tuple[int, int]],
                n_tokens: str = "n_tokens") -> DataFrame:
    """Number one batch's documents and place its tokens after ``totals``."""
    first_doc = sum(d for d, _ in totals.values())
    indexed = with_doc_index(batch, order, **wide()).withColumn("doc_index", F.col("doc_index") + F.lit(first_doc))
    placed = offsets(split(indexed), n_tokens, **wide())
    base = F.lit(0)
    for name, (_, tokens) in totals.items():
        base = F.when(F.col("split") == name, F.lit(tokens)).otherwise(base)
    return placed.withColumn("start", F.col("start") + base)


def start_indexed(rows: DataFrame, out: str, checkpoint: str, order: list[str],
                  prepare: Callable[[DataFrame], DataFrame] = lambda df: df, n_tokens: str = "n_tokens",
                  available_now: bool = True) -> StreamingQuery:
    """Write every batch, indexed, under ``out/docs`` and its totals under ``out/ledger``.

    Both go to a folder named after the batch and are overwritten if the batch
    is replayed, and totals are read from the batch before, so a replay gives
    the same numbers.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = totals_before(spark, f"{out}/ledger", batch_id)
        placed = cut(index_batch(prepare(batch), order, before, n_tokens))
        placed.write.mode("overwrite").parquet(f"{out}/docs/batch={batch_id}")
        after = dict(before)
        for row in split_summary(placed, n_tokens).collect():
            docs, size = before.get(row["split"], (0, 0))
            after[row["split"]] = (docs + row["n_docs"], size + row["n_tokens"])
        (spark.createDataFrame([(s, d, t) for s, (d, t) in after.items()], LEDGER)
         .coalesce(1).write.mode("overwrite").parquet(f"{out}/ledger/{batch_id}"))

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
