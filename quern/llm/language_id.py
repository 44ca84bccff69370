"""Language identification by Bloom filters that answer with a bitmask of languages.

Learning counts the character trigrams of every training text per language, and
puts a trigram into the filter of each language in which it is common enough
beside the language that uses it most. All filters share their slots: slot i
holds one bit per language, so the AND of a trigram's slots is the mask of all
languages that may contain it. A prediction adds these masks up bit by bit over
all trigrams of the text, takes from each language's count the false positives
expected at its filter's fill, and picks the language with the largest rest.

The filters are all that is sent to tasks; their slots follow from the counted
trigrams of the language that has the most. The counts come from all training
rows. How often a trigram must be seen depends on its language's total: once in
a small language, LEAST times in others, a millionth part of very large ones.
So a language holds a million trigrams at most. Trigrams run over letters in lower case,
each run of other characters being one space.

Cases: a null text or one without a letter is ``und`` with score 0, as is any
text when nothing could be learned. Equal rests go to the language first by
name. Rows with null language teach nothing. Repeated rows count again. Texts
are read whole. Columns called like the results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm import common

#: Slots at least, and per trigram of the language that has the most.
SLOTS = 1 << 20
SLOTS_EACH = 8
HASHES = 3
#: A language has a trigram if its share there is this part, at least, of the largest share in any language.
NEAR_MOST = 0.25
#: ... and if it was seen so often there, in a language of SMALL trigrams LEAST times, in smaller ones in proportion,
LEAST = 3
SMALL = 150_000
#: ... and is this part of all that was seen there.
LEAST_SHARE = 1e-6
CHARS = 1 << 19
UNKNOWN = "und"

_letters: list = []


def letters() -> np.ndarray:
    """Which code points are letters (surrogates are not)."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(row, trigram) of all texts, in order; a trigram is three code points in 63 bits."""
    rows, grams, is_letter = [], [], letters()
    for i, text in enumerate(texts):
        if not text:
            continue
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        known = is_letter[points]
        if not known.any():
            continue
        points = np.where(known, points, 32)
        keep = np.ones(len(points), bool)
        keep[1:] = known[1:] | known[:-1]
        points = np.concatenate([[32], points[keep][not known[0]:], [32][:int(known[-1])]]).astype(np.int64)
        if len(points) >= 3:
            gram = (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]
            grams.append(gram)
            rows.append(np.full(len(gram), i, np.int32))
    if not grams:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(grams)


def pieces(batch: pa.RecordBatch, text: str):
    """Ranges of rows with about CHARS characters, and their texts."""
    column, lo, size, held = batch.column(batch.schema.get_field_index(text)), 0, 0, []
    for i in range(batch.num_rows):
        held.append(column[i].as_py())
        size += len(held[-1] or "")
        if size >= CHARS or i == batch.num_rows - 1:
            yield lo, i + 1, held
            lo, size, held = i + 1, 0, []


def slots_of(grams: np.ndarray, size: int) -> list[np.ndarray]:
    return [(common.mix(grams.view(np.uint64), 11 + k) % np.uint64(size)).astype(np.int64) for k in range(HASHES)]


@dataclass
class Filters:
    """``masks[slot, word]``: bits of the languages; ``wrong``: chance that a foreign trigram hits; ``seen``: trigrams
    of the largest language that it was learned from; ``covered``: part of the trigrams of a further text of the language
    learned best that were seen before, by the trigrams seen once (Good and Turing); 0 if nothing was learned."""

    langs: list[str]
    masks: np.ndarray
    wrong: np.ndarray = field(init=False)
    seen: int = 0
    covered: float = 0.0

    def __post_init__(self):
        fill = [(self.masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(self.langs))]
        self.wrong = np.minimum(np.array(fill, np.float64) ** HASHES, 0.999)

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(trigrams per text, corrected hits per text and language)."""
        rows, grams = trigrams(texts)
        found = self.masks[slots_of(grams, len(self.masks))[0]]
        for slot in slots_of(grams, len(self.masks))[1:]:
            found &= self.masks[slot]
        n = np.bincount(rows, minlength=len(texts))
        hits = np.empty((len(texts), len(self.langs)))
        for i in range(len(self.langs)):
            bit = (found[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            hits[:, i] = np.bincount(rows, weights=bit, minlength=len(texts))
        return n, np.clip((hits - n[:, None] * self.wrong) / (1 - self.wrong), 0, None)


def gram_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n) over all rows, added up per batch before the shuffle."""
    def run(batch):
        names, held = np.array(batch.column(1).to_pylist(), object), {}
        for lo, hi, texts in pieces(batch, "_text"):
            rows, grams = trigrams(texts)
            own = names[lo:hi]
            for name in dict.fromkeys(own):
                gram, n = np.unique(grams[(own == name)[rows]], return_counts=True)
                if name in held:
                    gram, at = np.unique(np.concatenate([held[name][0], gram]), return_inverse=True)
                    n = np.bincount(at, weights=np.concatenate([held[name][1], n])).astype(np.int64)
                held[name] = gram, n
        for name, (gram, n) in held.items():
            lang = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(gram), np.int32)), pa.array([name])).cast(pa.string())
            yield pa.RecordBatch.from_arrays([lang, pa.array(gram, pa.int64()), pa.array(n, pa.int64())], ["_lang", "_gram", "_n"])

    rows = common.narrow(docs, text=text, lang=lang).where(F.col("_lang").isNotNull())
    return common.map_arrow(rows, run, "_lang string, _gram bigint, _n bigint").groupBy("_lang", "_gram").agg(F.sum("_n").alias("_n"))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", slots: int = SLOTS) -> Filters:
    """Filters of all languages in ``docs``, of ``slots`` or more; only slots and names reach the driver."""
    counts = common.kept(gram_counts(docs, text, lang), "trigrams")
    totals = counts.groupBy("_lang").agg(F.sum("_n").alias("_all"), F.count_if(F.col("_n") == 1).alias("_once")).collect()
    langs = sorted(r[0] for r in totals)
    number = {name: i for i, name in enumerate(langs)}
    if not langs:
        return Filters([], np.zeros((1, 1), np.uint64))
    spark = docs.sparkSession
    known = spark.createDataFrame([(r[0], r[1], number[r[0]]) for r in totals], "_lang string, _all bigint, _at int")
    shares = counts.join(known, "_lang").withColumn("_share", F.col("_n") / F.col("_all"))
    most = shares.groupBy("_gram").agg(F.max("_share").alias("_most"))
    least = F.greatest(F.least(F.lit(float(LEAST)), F.col("_all") * (LEAST / SMALL)), F.col("_all") * LEAST_SHARE)
    chosen = common.kept(shares.join(most, "_gram").where((F.col("_share") >= NEAR_MOST * F.col("_most")) & (F.col("_n") >= least))
                         .select("_gram", "_at"), "chosen")
    largest = chosen.groupBy("_at").count().agg(F.max("count")).first()[0] or 0
    slots = max(slots, 1 << (SLOTS_EACH * largest - 1).bit_length()) if largest else slots

    def place(batch):
        grams, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        slot = np.concatenate(slots_of(np.ascontiguousarray(grams), slots))
        bit = np.tile(np.left_shift(np.uint64(1), (at % 64).astype(np.uint64)).view(np.int64), HASHES)
        return pa.RecordBatch.from_arrays([pa.array(slot), pa.array(np.tile(at // 64, HASHES).astype(np.int64)), pa.array(bit)],
                                          ["slot", "word", "bits"])

    bits = (common.map_arrow(chosen, place, "slot bigint, word bigint, bits bigint").groupBy("slot", "word")
            .agg(F.bit_or("bits").alias("bits")).toArrow())
    masks = np.zeros((slots, -(-len(langs) // 64)), np.uint64)
    masks[bits["slot"].to_numpy(), bits["word"].to_numpy()] = common.unsigned(bits["bits"].to_numpy())
    common.drop_kept(counts)
    common.drop_kept(chosen)
    return Filters(langs, masks, max(r[1] for r in totals), max(1 - r[2] / r[1] for r in totals))


def identify(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``: the part of the trigrams that the language holds."""
    base = common.without(docs, ["lang_pred", "score"])
    schema = T.StructType([*base.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batch):
        own = shared.value
        names = np.array([*own.langs, UNKNOWN], object)
        for lo, hi, texts in pieces(batch, text):
            if own.langs:
                n, rest = own.counts(texts)
                best = np.where(n > 0, rest.argmax(axis=1), len(own.langs))
                score = np.clip(rest.max(axis=1) / np.maximum(n, 1), 0, 1)
            else:
                best, score = np.zeros(hi - lo, np.int64), np.zeros(hi - lo)
            cols = [c.slice(lo, hi - lo) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(names[best], pa.string()), pa.array(score)], schema.names)

    return common.map_arrow(base, run, schema)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def predictions(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Learn from the rows outside fold 0 and predict all rows."""
    rows = common.narrow(docs, doc_id="doc_id", text="text", lang="lang").withColumn("_out", remainder(F.col("_doc_id"), folds) == 0)
    filters = learn(rows.where(~F.col("_out")), "_text", "_lang")
    return identify(rows.select("_doc_id", "_text", "_out"), filters, "_text").select(
        F.col("_doc_id").alias("doc_id"), F.col("_out").alias("held_out"), "lang_pred", "score")
