import random

import pytest
from pyspark.sql import functions as F

from quern import catalog
from quern.operators import pieces, trials


ODD = ["", " ", "  ", " a", "a b", "a  b", "a \n b", "a\n b c ", None, "　 x  y", "don't I'll we 've", "x\u0085 y\x0b z\x1c w  ",
       "\U0001f600 é\n\n  1２ Ⅷ", "\x00 a\x00", "a" * 900 + " " + "b" * 900]


def _pieces_of_texts(df):
    return {r["piece"]: r["n"] for r in df.select(F.explode(pieces.split_pieces(F.col("text"))).alias("piece"))
            .groupBy("piece").agg(F.count("*").alias("n")).collect()}


@pytest.mark.parametrize("held", [1 << 20, 64])
def test_piece_counts_are_those_of_whole_texts(spark, documents, monkeypatch, held):
    """Cutting texts before spaces changes no piece, whatever white space surrounds them, and however much a task holds."""
    monkeypatch.setattr(pieces, "HELD_BYTES", held)
    rng = random.Random(5)
    made = ["".join(rng.choice("aB1'.s \n\t   é") for _ in range(rng.randrange(25))) for _ in range(3_000)]
    around = [f"x{chr(c)} y" for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    few = spark.createDataFrame([(t,) for t in ODD + made + around], "text string").repartition(3)
    for df in (few, documents.select("text"), few.where("text IS NULL")):
        got = pieces.piece_counts(df).collect()
        assert len({r["piece"] for r in got}) == len(got)
        assert {r["piece"]: r["n"] for r in got} == _pieces_of_texts(df)


def test_the_pattern_is_matched_on_distinct_stretches_only(spark, monkeypatch):
    df = spark.createDataFrame([("some words, some  words",)] * 500, "text string").coalesce(1)
    monkeypatch.setattr(pieces, "split_pieces", lambda text: F.array(text))
    assert {r["piece"]: r["n"] for r in pieces.piece_counts(df).collect()} == {
        "some": 500, " words,": 500, " some": 500, "  words": 500}


def test_plain_text_is_that_of_replacing_every_run(spark):
    rng = random.Random(6)
    made = ["".join(rng.choice("ab \n\t   \x1c") for _ in range(rng.randrange(12))) for _ in range(2_000)]
    df = spark.createDataFrame([(t,) for t in ODD + made], "text string")
    whole = F.trim(F.regexp_replace("text", r"[\p{IsWhite_Space}]+", " "))
    assert df.where(~catalog.plain("text").eqNullSafe(whole)).count() == 0


def test_the_sample_for_the_first_guess_is_sorted_from_few_rows(spark, monkeypatch):
    """Every task of the sort sends its share to the driver, so what is sorted must not follow the table."""
    rng = random.Random(7)
    rows = [(f"{k:05d}", 1 + int(20 / rng.random())) for k in range(20_000)]
    words = spark.createDataFrame(rows, "symbols string, n bigint").repartition(16)
    ranked = [(r["symbols"], r["n"], r["p"]) for r in words.selectExpr(
        "symbols", "n", "n / ((pmod(xxhash64(symbols), 1048576) + 1) / 1048576D) AS p").collect()]
    ranked.sort(key=lambda r: (-r[2], r[0]))
    seen, plain = [], type(words).orderBy
    monkeypatch.setattr(type(words), "orderBy", lambda self, *by: (seen.append(self.count()), plain(self, *by))[1])
    for size in (1_000, 19_999, 20_000, 30_000):
        least = int(ranked[size][2]) if size < len(ranked) else 0
        seen.clear()
        assert trials._sample(words, size) == [(s, max(n, least)) for s, n, _ in ranked[:size]]
        assert max(seen) <= 1.5 * size
