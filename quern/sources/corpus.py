"""Opening corpora: plain text, weighted mixes, synthetic stories."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.draw import choice
from quern.functions.text import field_or_empty, first_filled
from quern.operators.mix import interleave
from quern.operators.templates import format_examples
from quern.sources.jsonl import read_jsonl

# Word pools and wording of the synthetic stories.
NAMES = ["Tom", "Lily", "Sam", "Mia", "Ben", "Anna", "Max", "Sara", "Leo", "Zoe"]
ANIMALS = ["dog", "cat", "bird", "fish", "frog", "bunny", "duck", "bear", "fox", "owl"]
PLACES = ["park", "house", "garden", "forest", "beach", "river", "school", "farm"]
ADJECTIVES = ["big", "small", "happy", "sad", "red", "blue", "soft", "shiny", "funny", "kind"]
VERBS = ["ran", "played", "jumped", "looked", "smiled", "walked", "found", "helped"]
STORY = (
    "Once upon a time, there was a %1$s %2$s. "
    "%3$s and the %2$s %4$s in the %5$s. "
    "The %2$s was very %6$s and %3$s was happy. "
    "They %7$s all day and then went home to sleep."
)
STORY_SEED = 1234


def text_of(df: DataFrame, field: str = "text", drop_empty: bool = True) -> DataFrame:
    """Set ``text`` from ``field``, then ``text``, then empty; drop empty rows if asked."""
    out = df.withColumn("text", first_filled(field_or_empty(df, field), field_or_empty(df, "text")))
    return out.where(F.col("text") != "") if drop_empty else out


@dataclass(frozen=True)
class MixSource:
    """One entry of a mix: a table given as ``df`` or read from ``path``.

    ``order`` names the column that orders the source; JSON lines read from a
    path are numbered by line. ``schema`` is needed for JSON lines.
    """

    source_id: str
    df: DataFrame | None = None
    path: str | None = None
    kind: str = "parquet"
    schema: str | None = None
    order: str = "ord"
    text_field: str = "text"
    weight: float = 1.0
    format: str | None = None
    instr_field: str = "instruction"
    input_field: str = "input"
    output_field: str = "output"
    prompt_field: str = "question"
    response_field: str = "answer"
    conv_field: str = "conversations"
    looped: bool = False

    def rows(self, spark: SparkSession) -> DataFrame:
        if self.df is not None:
            return self.df
        if self.kind == "jsonl":
            return read_jsonl(spark, self.path, self.schema)
        return spark.read.format(self.kind).load(self.path)


def build_mix(spark: SparkSession, entries: list[MixSource]) -> DataFrame:
    """All entries as (source_id, ord, text, weight): templated, or their text field.

    Rows that yield no text are skipped in templated entries but kept, empty, in
    plain ones, where they still take part in the draw.
    """
    def one(entry: MixSource) -> DataFrame:
        rows = entry.rows(spark)
        if entry.format:
            fields = {k: v for k, v in _fields(entry).items() if k.endswith("_field") or k == "format"}
            rows = format_examples(rows, fields)
        else:
            rows = text_of(rows, entry.text_field, drop_empty=False)
        return rows.select(F.lit(entry.source_id).alias("source_id"), F.col(entry.order).cast("bigint").alias("ord"),
                           "text", F.lit(float(entry.weight)).alias("weight"))

    return reduce(DataFrame.unionByName, [one(e) for e in entries])


def _fields(entry: MixSource) -> dict:
    return {k: getattr(entry, k) for k in entry.__dataclass_fields__}


def synthetic(ids: DataFrame, key: str = "id", seed: int = STORY_SEED) -> DataFrame:
    """Add a template story to every row, drawn from the row's key."""
    pools = [ADJECTIVES, ANIMALS, NAMES, VERBS, PLACES, ADJECTIVES, VERBS]
    words = [choice(pool, seed, i, F.col(key)) for i, pool in enumerate(pools)]
    return ids.withColumn("text", F.format_string(STORY, *words))


def open_corpus(spark: SparkSession, *, offline: bool = False, n_offline: int | None = None,
                mix: list[MixSource] | None = None, single: DataFrame | None = None, order: str = "ord",
                seed: int = 42, **blend) -> DataFrame:
    """The corpus as (doc order, text): synthetic if offline, else the mix, else one table.

    A source that cannot be read is an error; synthetic text never stands in for it.
    """
    if offline:
        if n_offline is None:
            raise ValueError("an offline corpus needs its number of documents")
        return synthetic(spark.range(n_offline).withColumnRenamed("id", "ord"), "ord").select("ord", "text")
    if mix:
        weights = {e.source_id: float(e.weight) for e in mix}
        looped = tuple(e.source_id for e in mix if e.looped)
        return (interleave(build_mix(spark, mix), weights, seed, looped=looped, **blend)
                .select(F.col("doc_index").alias("ord"), "source_id", "text"))
    if single is None:
        raise ValueError("no corpus: give offline, mix or single")
    return text_of(single).select(F.col(order).alias("ord"), "text")
