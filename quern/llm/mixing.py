"""Temperature mixing of sources, realised as budgeted block permutations.

The weight of a source is its share of all tokens to the power of an exponent
between 0 (all alike) and 1 (as they are), normalised. The exponent is the
largest on a grid of GRID steps at which the weights reach a target entropy (as
a part of the entropy of equal weights); if a source would then be repeated
more often than allowed, it is the smallest one that keeps to that limit. It is
found by bisection with many cuts per pass, over the table of sources.

A budget of tokens gives each source a quota. A source is read in epochs, each
a permutation of its documents of its own: a document's draw decides its block
and its place in the block. Epochs that fit the quota are whole; the last one
stops with the document that reaches the quota. Where it stops is found from
sums per block, and from the documents of the one block that is cut. Texts are
not shuffled for any of this; a document learns from its source's row whether
and how often it is taken.

Only DataFrame functions are used. Cases: a null source is a source of its own;
a null text or one without words has no tokens, and is taken whenever its draw
lies before the cut; a source without tokens is left out. Rows that repeat an
id get the same draws and are judged alike, each counting its own tokens. Empty
tables give no rows. Columns called like the results are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm import common

GRID = 1 << 20
CUTS = 32
BLOCK_DOCS = 4_096
#: Sources whose table may be sent to every task; with more it is joined by shuffle.
BROADCAST_SOURCES = 20_000
WORDS = "[^\\x20\\x09-\\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def source_key(source: Column) -> Column:
    return F.when(source.isNull(), "null").otherwise(F.concat(F.lit("s"), source.cast("string")))


def draw(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def draw_unit(key: Column) -> Column:
    """The draw as a number from 0 up to 1."""
    return F.conv(F.substring(key, 1, 12), 16, 10).cast("double") / float(16**12)


def _stats(shares: DataFrame, grid: list[int], largest: float, ratio: float | None) -> list[tuple[float, float]]:
    """(entropy of the weights, epochs of the source that is repeated most) at each step."""
    aggs = []
    for i, k in enumerate(grid):
        powered = F.pow("_share", F.lit(k / GRID))
        aggs += [F.sum(powered).alias(f"z{i}"), F.sum(powered * F.log("_share")).alias(f"y{i}"),
                 F.max(F.pow("_share", F.lit(k / GRID - 1.0))).alias(f"m{i}")]
    row = shares.agg(*aggs).first()
    out = []
    for i, k in enumerate(grid):
        z, y, most = row[f"z{i}"], row[f"y{i}"], row[f"m{i}"]
        epochs = most * ratio / z if ratio is not None else most / largest ** (k / GRID - 1.0)
        out.append((math.log(z) - k / GRID * y / z, epochs))
    return out


def _last(stats, holds) -> int:
    """The largest step that holds, if those from 0 on hold up to some step; -1 if none."""
    lo, hi = -1, GRID + 1
    while hi - lo > 1:
        grid = sorted({lo + (hi - lo) * i // (CUTS + 1) for i in range(1, CUTS + 1)} - {lo})
        good = [holds(*x) for x in stats(grid)]
        lo, hi = max([lo, *[k for k, ok in zip(grid, good) if ok]]), min([hi, *[k for k, ok in zip(grid, good) if not ok]])
    return lo


def exponent(shares: DataFrame, n_sources: int, largest: float, ratio: float | None, target_entropy: float,
             max_epochs: float) -> int:
    """The step of the exponent. ``ratio`` is the budget as a part of all tokens, None if the largest source is read once."""
    def stats(grid):
        return _stats(shares, grid, largest, ratio)

    goal = target_entropy * math.log(n_sources) - 1e-12
    step = max(0, _last(stats, lambda entropy, _: entropy >= goal))
    if stats([step])[0][1] > max_epochs:
        step = min(GRID, _last(stats, lambda _, epochs: epochs > max_epochs) + 1)
    return step


def plan(sizes: DataFrame, budget: int | None, target_entropy: float, max_epochs: float, seed: int) -> DataFrame:
    """One row per source: ``_size``, ``_quota``, ``_whole`` epochs, and ``_stop``, the draw that ends the last one.

    ``sizes`` has ``_skey``, ``_doc_id``, ``_n`` per document. Without a budget
    the largest source is read once: nothing is lost and others are repeated.
    """
    sources = common.kept(sizes.groupBy("_skey").agg(F.sum("_n").alias("_size"), F.count(F.lit(1)).alias("_docs"))
                          .where(F.col("_size") > 0), "sources")
    n_sources, total, largest = sources.agg(F.count(F.lit(1)), F.sum("_size"), F.max("_size")).first()
    if not n_sources:
        return sources.selectExpr("_skey", "_size", "_docs", "_size AS _quota", "_size AS _whole", "'' AS _stop")
    shares = sources.withColumn("_share", F.col("_size") / F.lit(float(total)))
    ratio = None if budget is None else budget / total
    alpha = exponent(shares, n_sources, largest / total, ratio, target_entropy, max_epochs) / GRID
    z = shares.agg(F.sum(F.pow("_share", F.lit(alpha)))).first()[0]
    weight = F.round(F.pow("_share", F.lit(alpha)) / F.lit(z), 9)
    if budget is None:
        quota = F.greatest(F.floor(weight * F.lit(largest * z / (largest / total) ** alpha)).cast("bigint"), F.col("_size"))
    else:
        quota = F.floor(weight * F.lit(float(budget))).cast("bigint")
    quotas = (shares.withColumn("_quota", quota).withColumn("_whole", F.expr("_quota div _size"))
              .withColumn("_rest", F.expr("_quota % _size")).drop("_share"))
    last = (sizes.join(_small(quotas.where("_rest > 0"), n_sources), "_skey")
            .withColumn("_key", draw(seed, F.col("_whole"), F.col("_doc_id")))
            .withColumn("_block", F.floor(draw_unit(F.col("_key")) * F.ceil(F.col("_docs") / F.lit(BLOCK_DOCS)))))
    earlier = Window.partitionBy("_skey").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (last.groupBy("_skey", "_block", "_rest").agg(F.sum("_n").alias("_sum"))
              .withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))))
    cut = blocks.where((F.col("_before") < F.col("_rest")) & (F.col("_before") + F.col("_sum") >= F.col("_rest")))
    inside = (Window.partitionBy("_skey", "_block").orderBy("_key", "_doc_id", "_n")
              .rowsBetween(Window.unboundedPreceding, -1))
    stop = (last.join(_small(cut.select("_skey", "_block", "_before"), n_sources), ["_skey", "_block"])
            .withColumn("_at", F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
            .where("_at < _rest").groupBy("_skey").agg(F.max("_key").alias("_stop")))
    return common.kept(quotas.drop("_rest").join(stop, "_skey", "left").withColumn("_stop", F.coalesce("_stop", F.lit(""))), "quotas")


def _small(df: DataFrame, rows: int) -> DataFrame:
    """A table with a row per source, sent to every task if it was counted to be small."""
    return F.broadcast(df) if rows <= BROADCAST_SOURCES else df


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", budget: int | None = None,
        budget_share: float | None = None, target_entropy: float = 0.95, max_epochs: float = 4.0, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` as often as they are taken, with ``epoch``, ``block`` and ``place``.

    Ordered by ``place`` (0 to 1), the rows hold the sources in proportion to
    their weights from the start. The budget is a number of tokens or a part of
    all tokens; with neither, the largest source is read exactly once.
    """
    base = common.without(docs, ["epoch", "block", "place", "n_tokens"])
    id_, key, words = F.col(f"`{doc_id}`"), source_key(F.col(f"`{source}`")), n_words(F.col(f"`{text}`"))
    sizes = common.kept(base.select(id_.alias("_doc_id"), key.alias("_skey"), words.alias("_n")), "sizes")
    if budget is None and budget_share is not None:
        budget = int((sizes.agg(F.sum("_n")).first()[0] or 0) * budget_share)
    quotas = plan(sizes, budget, target_entropy, max_epochs, seed)
    taken = (base.withColumn("_skey", key).join(_small(quotas, common.total_rows(quotas)), "_skey")
             .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_whole"))))
             .withColumn("_key", draw(seed, F.col("epoch"), id_))
             .where("epoch < _whole OR _key <= _stop"))
    unit = draw_unit(F.col("_key"))
    return taken.withColumns({
        "block": F.floor(unit * F.ceil(F.col("_docs") / F.lit(BLOCK_DOCS))),
        "place": (F.col("epoch") + unit) * F.col("_size") / F.col("_quota"), "n_tokens": words,
    }).drop("_skey", "_size", "_docs", "_quota", "_whole", "_stop", "_key")


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """The taken documents by id, with tokens, epoch, block and place."""
    rows = common.narrow(docs, doc_id="doc_id", text="text", source="source")
    return mix(rows, "_doc_id", "_text", "_source", **settings).select(
        F.col("_doc_id").alias("doc_id"), F.col("_source").alias("source"), "n_tokens", "epoch", "block",
        F.round("place", 9).alias("place"))
