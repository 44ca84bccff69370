"""Indexing, splits, budgets, and the flat token stream as a table of chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.draw import below
from quern.plans.prefix import dense_rank_from_zero, prefix_sum

# Every 20th document is held out; ids are stored in 16 bits.
HOLD_OUT_EVERY = 20
MAX_U16 = 65_535
REPORT_EVERY = 50_000


def with_doc_index(df: DataFrame, order: list[str], text: str = "text", **ranges) -> DataFrame:
    """Dense 0-based index over the non-empty documents in ``order``."""
    return dense_rank_from_zero(df.where(F.coalesce(F.col(text), F.lit("")) != ""), "doc_index", order, **ranges)


def split(df: DataFrame, every: int = HOLD_OUT_EVERY) -> DataFrame:
    """Add ``split``: document 0 and every ``every``-th after it is ``val``."""
    return df.withColumn("split", F.when(F.pmod("doc_index", F.lit(every)) == 0, "val").otherwise("train"))


def _cap_of(caps: dict[str, int | None]) -> Column:
    out = F.lit(None).cast("bigint")
    for name, cap in caps.items():
        out = F.when(F.col("split") == name, F.lit(cap).cast("bigint")).otherwise(out)
    return out


def cap(df: DataFrame, caps: dict[str, int | None], n_tokens: str = "n_tokens", **ranges) -> DataFrame:
    """Keep whole documents while their split's running total before them is below its cap.

    Adds ``before``. A cap of None keeps everything; a split may pass its cap by
    its last document only.
    """
    return prefix_sum(df, {"before": F.col(n_tokens)}, ["doc_index"], ["split"], dense=True,
                      ceilings={"before": _cap_of(caps)}, **ranges)


def offsets(df: DataFrame, n_tokens: str = "n_tokens", **ranges) -> DataFrame:
    """Add ``start``: where each document begins in its split's flat stream."""
    return prefix_sum(df, {"start": F.col(n_tokens)}, ["doc_index"], ["split"], dense=True, **ranges)


def lay_out(docs: DataFrame, key: str, order: list[str], n_tokens: str = "n_tokens", every: int = HOLD_OUT_EVERY,
            caps: dict[str, int | None] | None = None, **ranges) -> DataFrame:
    """(key, doc_index, split, start) of every document that is kept.

    Only key, order and token count go through the orderings; join the result
    to the tokens by ``key`` once, instead of carrying them through each step.
    """
    slim = docs.select(key, *[c for c in order if c != key], n_tokens)
    placed = split(dense_rank_from_zero(slim, "doc_index", order, **ranges), every)
    if caps:
        # What is kept of a split is its beginning, so the total before a kept
        # document is also its place in the stream.
        placed = cap(placed, caps, n_tokens, **ranges).withColumnRenamed("before", "start")
    else:
        placed = offsets(placed, n_tokens, **ranges)
    return placed.select(key, "doc_index", "split", "start")


def check_u16(df: DataFrame, ids: str = "ids") -> DataFrame:
    """Rows whose ids do not fit in 16 bits."""
    return df.where((F.array_max(ids) > MAX_U16) | (F.array_min(ids) < 0))


def chunk(df: DataFrame, size: int, ids: str = "ids") -> DataFrame:
    """Cut the flat stream of every split into chunks of ``size`` tokens.

    Needs ``split``, ``start`` (from ``offsets``) and the ids. A document is cut
    into its pieces before anything moves, so a shuffled row never exceeds one
    chunk and a chunk gathers at most ``size`` tokens, however long documents are.
    """
    start, n = F.col("start"), F.size(ids)
    size_l = F.lit(size).cast("bigint")
    first, last = F.expr(f"`start` div {size}"), F.expr(f"(`start` + size(`{ids}`) - 1) div {size}")
    pieces = F.transform(
        F.sequence(first, last),
        lambda c: F.struct(
            c.alias("chunk_id"),
            F.greatest(start, c * size_l).alias("at"),
            F.slice(ids,
                    (F.greatest(start, c * size_l) - start + 1).cast("int"),
                    (F.least(start + n, (c + 1) * size_l) - F.greatest(start, c * size_l)).cast("int"),
                    ).alias("part")))
    # An empty document is left out here, not by a filter: a filter would move
    # below whatever makes the ids and have them made twice.
    return (df.select("split", F.inline(F.when(n > 0, pieces)))
            .groupBy("split", "chunk_id")
            .agg(F.sort_array(F.collect_list(F.struct("at", "part"))).alias("parts"))
            .select("split", "chunk_id", F.flatten(F.col("parts.part")).alias("tokens")))


def windows(chunks: DataFrame, n: int, block: int, seed: int, size: int, total: int,
            rows: DataFrame | None = None) -> DataFrame:
    """``n`` random windows of ``block`` tokens with replacement; y is x one step on.

    ``chunks`` holds one split cut into ``size`` tokens, ``total`` tokens in all.
    Starts lie in [0, total - block - 1), so the last window that would fit is
    never drawn. Chunks are met by equality on their id, and each is sliced down
    to what the window needs before it is shuffled again.
    """
    top = total - block - 1
    if top <= 0:
        raise ValueError(f"{total} tokens are too few for windows of {block}")
    ids = chunks.sparkSession.range(n).withColumnRenamed("id", "window_id") if rows is None else rows
    starts = ids.select("window_id", below(top, seed, F.col("window_id")).alias("start"))
    size_l = F.lit(size).cast("bigint")
    touched = starts.withColumn("chunk_id", F.explode(
        F.expr(f"sequence(`start` div {size}, (`start` + {block}) div {size})")))
    begin = F.col("chunk_id") * size_l
    low = F.greatest(F.col("start"), begin)
    high = F.least(F.col("start") + block + 1, begin + size_l)
    pieces = (touched.join(chunks.select("chunk_id", "tokens"), "chunk_id")
              .select("window_id", "start", low.alias("at"),
                      F.slice("tokens", (low - begin + 1).cast("int"), (high - low).cast("int")).alias("part")))
    run = F.flatten(F.sort_array(F.collect_list(F.struct("at", "part")))["part"])
    return (pieces.groupBy("window_id", "start").agg(run.alias("run"))
            .select("window_id", "start", F.slice("run", 1, block).alias("x"), F.slice("run", 2, block).alias("y")))


def split_summary(df: DataFrame, n_tokens: str = "n_tokens") -> DataFrame:
    """Documents and tokens per split."""
    return df.groupBy("split").agg(F.count("*").alias("n_docs"),
                                   F.sum(F.col(n_tokens).cast("bigint")).alias("n_tokens"))


def progress(df: DataFrame, every: int = REPORT_EVERY, n_tokens: str = "n_tokens",
             caps: dict[str, int | None] | None = None, **ranges) -> DataFrame:
    """Running train and val totals at every ``every``-th document.

    With ``caps`` only documents that were kept count, and lines end where both
    splits are full. Documents are summed per stretch between two lines first,
    so the running total goes over lines, not over documents.
    """
    counted = F.col(n_tokens).cast("bigint")
    caps = {k: v for k, v in (caps or {}).items() if v is not None}
    if caps:
        df = prefix_sum(df, {"_before": counted}, ["doc_index"], ["split"], dense=True, **ranges)
        limit = _cap_of(caps)
        counted = F.when(limit.isNull() | (F.col("_before") < limit), counted).otherwise(F.lit(0))
    stretch = F.expr(f"(`doc_index` + {every - 1}) div {every}")
    sums = (df.groupBy(stretch.alias("line"))
            .agg(F.coalesce(F.sum(F.when(F.col("split") == "train", counted)), F.lit(0)).alias("_train"),
                 F.coalesce(F.sum(F.when(F.col("split") == "val", counted)), F.lit(0)).alias("_val"),
                 F.max("doc_index").alias("doc_index")))
    run = prefix_sum(sums, {"train_tokens": F.col("_train"), "val_tokens": F.col("_val")}, ["line"], dense=True, **ranges)
    lines = (run.where((F.col("line") > 0) & (F.col("doc_index") == F.col("line") * every))
             .select("doc_index", (F.col("train_tokens") + F.col("_train")).alias("train_tokens"),
                     (F.col("val_tokens") + F.col("_val")).alias("val_tokens")))
    if {"train", "val"} <= set(caps):
        lines = lines.where((F.col("train_tokens") < caps["train"]) | (F.col("val_tokens") < caps["val"]))
    return lines
