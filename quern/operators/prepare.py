"""From documents to a table of token chunks, in one step that is safe to repeat.

With caps only a beginning of each split is kept, and only that is coded. Where
every split has a cap, documents are taken in stretches of their order, each
some ranges longer than the last needed, until all caps are full: texts after
that are never looked at. Inside a stretch pieces are counted first: a piece of
text is one token at least, so the running total of pieces bounds the running
total of tokens from below, and a document whose bound is past the cap can never
be kept, so no id is made for it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators import tokens
from quern.operators.bpe import Vocabulary, encode, with_eot
from quern.operators.pieces import split_pieces
from quern.plans import prefix
from quern.plans.prefix import cut_points, dense_rank_from_zero, range_of
from quern.plans.stage import complete, cut, drop_path, fresh_path
from quern.sources.sinks import write_tokens

SPLITS = ("train", "val")
GROWTH = 4  # a stretch is at most this many times the ones before it


def candidates(docs: DataFrame, vocabulary: Vocabulary, key: str, order: list[str], caps: dict[str, int | None] | None,
               text: str = "text", every: int = tokens.HOLD_OUT_EVERY) -> DataFrame:
    """(key, doc_index, split) of the documents that a cap may keep: a beginning of each split that holds all of them."""
    filled = docs.where(F.coalesce(F.col(text), F.lit("")) != "")
    if not caps or not any(v is not None for v in caps.values()):
        return tokens.split(dense_rank_from_zero(filled.select(key, *[c for c in order if c != key]), "doc_index", order),
                            every).select(key, "doc_index", "split")
    least = F.size(split_pieces(F.col(text), vocabulary.specials[0])) + 1  # and the end of the text
    sized = filled.select(key, *[c for c in order if c != key], least.cast("bigint").alias("_least"))
    return tokens.lay_out(sized, key, order, "_least", every, caps).select(key, "doc_index", "split")


def coded(docs: DataFrame, vocabulary: Vocabulary, key: str, order: list[str], caps: dict[str, int | None] | None = None,
          text: str = "text", every: int = tokens.HOLD_OUT_EVERY, rows_per_range: int | None = None) -> DataFrame:
    """(key, doc_index, split, ids, n_tokens) of the candidates, ids ended by the end-of-text id; written once."""
    spark = docs.sparkSession
    path = fresh_path(spark, "coded")

    def write(chosen: DataFrame, part: DataFrame, folder: str) -> DataFrame:
        ids = with_eot(encode(part.select(key, text).join(chosen, key), vocabulary, text), vocabulary.eot_id)
        made = ids.select(key, "doc_index", "split", "ids")
        made.write.parquet(folder)
        return spark.read.schema(made.schema).parquet(folder)

    if caps and all(caps.get(s) is not None for s in SPLITS):
        held = _coded_until_full(docs, write, path, vocabulary, key, order, caps, text, every, rows_per_range)
    else:
        held = write(candidates(docs, vocabulary, key, order, caps, text, every), docs, path)
    return held.withColumn("n_tokens", F.size("ids").cast("bigint"))


def _coded_until_full(docs: DataFrame, write, path: str, vocabulary: Vocabulary, key: str, order: list[str],
                      caps: dict[str, int], text: str, every: int, rows_per_range: int | None) -> DataFrame:
    """Candidates of stretches of ``order`` from the first document on, until every split has reached its cap.

    Cut points come from the columns of the order alone. Document numbers and
    totals go on from one stretch to the next, so the stretches are to the caps
    what one pass over all documents is. A split that is full sends no more.
    """
    spark = docs.sparkSession
    step = rows_per_range or max(every, min(prefix.ROWS_PER_RANGE, max(caps.values()) // 64))
    points = cut_points(docs.select(*order), order, step)
    n_docs, totals = 0, dict.fromkeys(SPLITS, 0)
    done, taken, folders, held = 0, 1, [], None
    while True:
        upto = min(done + taken, len(points) + 1)
        part = docs.where(_between(docs, order, points, done, upto))
        left = {s: max(0, caps[s] - totals[s]) for s in SPLITS}
        filled = part.where(F.coalesce(F.col(text), F.lit("")) != "")
        least = F.size(split_pieces(F.col(text), vocabulary.specials[0])) + 1  # and the end of the text
        sized = filled.select(key, *[c for c in order if c != key], least.cast("bigint").alias("_least"))
        numbered = dense_rank_from_zero(cut(sized), "doc_index", order).withColumn("doc_index", F.col("doc_index") + F.lit(n_docs))
        numbered = cut(tokens.split(numbered, every).select(key, "doc_index", "split", "_least"))
        chosen = tokens.cap(numbered, left, "_least").select(key, "doc_index", "split")
        folders.append(f"{path}/stretch-{len(folders)}")
        made = write(chosen, part, folders[-1])
        for r in made.groupBy("split").agg(F.sum(F.size("ids")).alias("n")).collect():
            totals[r["split"]] += r["n"]
        n_docs += numbered.count()
        held = spark.read.schema(made.schema).parquet(*folders)
        if upto > len(points) or all(totals[s] >= caps[s] for s in SPLITS):
            return held
        # As many ranges as the caps still ask for at the rate so far; the most if a split has sent nothing.
        still = [(caps[s] - totals[s]) / totals[s] if totals[s] else GROWTH for s in SPLITS if totals[s] < caps[s]]
        done, taken = upto, math.ceil(upto * min(GROWTH, 1.1 * max(still)))


def _between(docs: DataFrame, order: list[str], points: list[tuple], first: int, end: int) -> Column:
    """Whether a row lies in the ranges from ``first`` up to ``end``, as plain comparisons that a scan can use where it may."""
    part = range_of(docs, order, points)
    inside = (part >= first) & (part < end)
    field = docs.schema[order[0]]
    low = points[first - 1][0] if first > 0 else None
    high = points[end - 1][0] if end <= len(points) else None
    if field.dataType.typeName() in ("string", "binary"):  # binary points are hexadecimal; strings may have an order of their own
        return inside
    if low is not None:
        inside = inside & (F.col(order[0]) >= F.lit(low).cast(field.dataType))
    if high is not None:
        below = F.col(order[0]) <= F.lit(high).cast(field.dataType)
        inside = inside & (below if low is not None else below | F.col(order[0]).isNull())
    return inside


def prepare(docs: DataFrame, vocabulary: Vocabulary, out: str, key: str, order: list[str], size: int = 65_536,
            caps: dict[str, int | None] | None = None, text: str = "text", every: int = tokens.HOLD_OUT_EVERY,
            rows_per_range: int | None = None) -> bool:
    """Write the token table of ``docs`` (unique on ``key``) to ``out``; False if it is there already.

    Empty texts are left out before documents are numbered in ``order``. Every
    ``every``-th one, from the first on, is held out. Whole documents are kept
    while their split's total before them is below its cap.
    """
    spark = docs.sparkSession
    if complete(spark, out):
        return write_tokens(spark.createDataFrame([], "split string, chunk_id bigint, tokens array<int>"), out, vocabulary.fingerprint)
    held = coded(docs, vocabulary, key, order, caps, text, every, rows_per_range)
    slim = held.select(key, "doc_index", "split", "n_tokens")
    if caps:
        # Candidates are a beginning of each split, so their running totals are those of all documents.
        placed = tokens.cap(slim, caps).withColumnRenamed("before", "start")
    else:
        placed = tokens.offsets(slim)
    chunks = tokens.chunk(held.select(key, "ids").join(placed.select(key, "split", "start"), key), size)
    written = write_tokens(chunks, out, vocabulary.fingerprint)
    for folder in {f.rpartition("/")[0] for f in held.inputFiles()}:
        drop_path(spark, folder)
    return written
