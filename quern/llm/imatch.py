"""I-Match fingerprints over several randomised lexicons.

A term is a run of letters and digits, in lower case. The lexicon holds the
terms within a band of inverse document frequency. Frequencies are counted over
all documents, per slot of a table of fixed size, so that the lexicon is a
bitmap of the same size for any corpus; terms that share a slot share its count.

A text's lexicon terms are made distinct and, in each of several families,
drawn anew: a family is a nest of random subsets of the lexicon, each half of
the one around it. The text's entry in a family is the hash of its sorted terms
in the smallest subset that holds any, so short and long texts alike are
represented by a few terms of each family. Texts with the same lexicon terms
have the same fingerprint; the likeness of two is the part of equal entries.

Only DataFrame functions are used. Cases: a null text is an empty one. A text
with no term in the band uses all its terms; without terms its entries are all
alike, so two such texts have likeness 1. The next document is the one with the
next smaller id, the last one's is the first; rows that repeat an id follow one
another in order of text; a null id ranks below all others. A table of one row
is its own next. Texts are read whole; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm import common, ordering

SLOTS = 1 << 20
FAMILIES = 16
#: Band of ln(documents / frequency) / ln(documents): neither the rarest nor the commonest terms.
BAND = (0.15, 0.85)
NOT_TERM = "[^\\p{L}\\p{N}]+"


def terms(text: Column) -> Column:
    """Distinct 64-bit hashes of the terms."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_TERM), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def slot(term: Column, slots: int) -> Column:
    return F.pmod(term, F.lit(slots))


def _shift(name: str, value: Column, by: Column) -> Column:
    return F.call_function(name, value, by.cast("int"))


def lexicon(docs: DataFrame, text: str, slots: int = SLOTS, band: tuple[float, float] = BAND) -> list[int]:
    """The bitmap of slots in the band, as words of 64 bits."""
    counts = (docs.select(F.explode(terms(F.col(text))).alias("_t")).groupBy(slot(F.col("_t"), slots).alias("_s"))
              .agg(F.count(F.lit(1)).alias("_df")))
    n = max(2, common.total_rows(docs))
    idf = F.log(F.lit(float(n)) / F.col("_df")) / F.lit(math.log(n))
    words = (counts.where(idf.between(*band)).groupBy(F.shiftright("_s", 6).cast("int").alias("_w"))
             .agg(F.bit_or(_shift("shiftleft", F.lit(1).cast("bigint"), F.col("_s").bitwiseAND(63))).alias("_b")))
    bitmap = [0] * -(-slots // 64)
    for w, b in words.collect():  # slots / 64 rows at most
        bitmap[w] = b
    return bitmap


def _drawn(family: int):
    return lambda term: F.xxhash64(term, F.lit(family)).bitwiseAND((1 << 62) - 1)


def _below(top: Column):
    return lambda draw: draw < top


def _entries(df: DataFrame, text: str, bitmap: list[int], slots: int, out: str) -> DataFrame:
    """Add ``out``: one hash per family."""
    bits = F.split(F.lit(",".join(map(str, bitmap))), ",").cast("array<bigint>")  # folded to one constant, of a fixed size
    df = df.withColumn("_terms", terms(F.col(text)))

    def in_band(t):
        s = slot(t, slots)
        word = F.get(bits, F.shiftright(s, 6).cast("int"))
        return _shift("shiftright", word, s.bitwiseAND(63)).bitwiseAND(1) == 1

    df = df.withColumn("_band", F.filter("_terms", in_band))
    df = df.withColumn("_use", F.when(F.size("_band") > 0, F.col("_band")).otherwise(F.col("_terms")))
    # The smallest subset that holds a term: draws below the power of two above the smallest draw.
    df = df.withColumns({f"_draw{r}": F.transform("_use", _drawn(r)) for r in range(FAMILIES)})
    df = df.withColumns({f"_top{r}": _shift("shiftleft", F.lit(1).cast("bigint"), F.length(F.bin(F.coalesce(F.array_min(f"_draw{r}"), F.lit(0)))))
                         for r in range(FAMILIES)})
    # The bound is hashed too; used twice, it stays a column of its own and is not worked out again per term.
    entries = [F.xxhash64(F.col(f"_top{r}"), F.sort_array(F.filter(f"_draw{r}", _below(F.col(f"_top{r}"))))) for r in range(FAMILIES)]
    scratch = [f"_{n}{r}" for n in ("draw", "top") for r in range(FAMILIES)]
    return df.withColumn(out, F.array(*entries)).drop("_terms", "_band", "_use", *scratch)


def likeness(a: Column, b: Column) -> Column:
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)
    return F.size(same) / F.lit(float(FAMILIES))


def written(entries: Column) -> Column:
    return F.array_join(F.transform(entries, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def fingerprints(docs: DataFrame, text: str = "text", slots: int = SLOTS, band: tuple[float, float] = BAND,
                 out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text, by the lexicon of them all."""
    base = common.without(docs, [out])
    bitmap = lexicon(common.narrow(base, text=text), "_text", slots, band)
    made = _entries(base.withColumn("_text", F.col(f"`{text}`")), "_text", bitmap, slots, "_entries")
    return made.withColumn(out, written(F.col("_entries"))).drop("_entries", "_text")


def edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS,
          band: tuple[float, float] = BAND) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness to it and to the next document."""
    rows = common.narrow(docs, doc_id=doc_id, text=text).withColumn("_text", F.coalesce("_text", F.lit("")))
    bitmap = lexicon(rows, "_text", slots, band)
    pairs = ordering.with_follower(rows, "_doc_id", "_text", ["_text", "_entries"],
                                   lambda df: _entries(df, "_text", bitmap, slots, "_entries"))
    half = F.expr("n_chars div 2").cast("int")
    pairs = (pairs.withColumn("n_chars", F.char_length("_text").cast("bigint"))
             .withColumn("_edited", F.concat(F.substring(F.col("_text"), F.lit(1), F.col("n_chars").cast("int") - half),
                                             F.substring(F.col("next_text"), F.lit(1), half))))
    made = _entries(pairs, "_edited", bitmap, slots, "_edited_entries")
    return made.select(
        F.col("_doc_id").alias("doc_id"), "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        written(F.col("_entries")).alias("fingerprint"), written(F.col("_edited_entries")).alias("edited_fingerprint"),
        likeness(F.col("_entries"), F.col("_edited_entries")).alias("near_edited"),
        likeness(F.col("_entries"), F.col("next_entries")).alias("near_next"))
