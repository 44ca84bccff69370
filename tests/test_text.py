import pytest
from pyspark.sql import functions as F

from quern.functions.draw import below, choice, unit
from quern.functions.text import STRIP_CHARS, strip
from quern.sources.corpus import text_of


def test_strip_matches_python_for_every_bmp_character(spark):
    chars = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    rows = spark.createDataFrame([(c, f"{c}x{c}") for c in chars], "c string, t string")
    stripped = {r["c"] for r in rows.where(strip(F.col("t")) == "x").collect()}
    assert stripped == {c for c in chars if f"{c}x{c}".strip() == "x"} == set(STRIP_CHARS)


def test_draws_do_not_depend_on_partitions(spark):
    def draw(parts):
        df = spark.range(0, 500, 1, parts)
        return {tuple(r) for r in df.select("id", unit(7, F.col("id")), below(9, 7, F.col("id")),
                                            choice(["a", "b", "c"], 7, F.col("id"))).collect()}
    assert draw(1) == draw(4) == draw(17)


def test_draws_are_spread_evenly(spark):
    row = spark.range(20000).select(unit(1, F.col("id")).alias("u"), below(4, 1, F.col("id")).alias("k")).agg(
        F.avg("u"), F.min("u"), F.max("u"), F.count_if(F.col("k") == 0), F.max("k")).first()
    assert abs(row[0] - 0.5) < 0.01 and 0 < row[1] and row[2] < 1
    assert abs(row[3] - 5000) < 250 and row[4] == 3


def test_text_falls_through_empty_fields(spark):
    df = spark.createDataFrame([(1, "body", "t"), (2, "", "t"), (3, None, "t"), (4, "", ""), (5, None, None)],
                               "id int, body string, text string")
    assert {(r.id, r.text) for r in text_of(df, "body").collect()} == {(1, "body"), (2, "t"), (3, "t")}
    assert text_of(df, "body", drop_empty=False).count() == 5
    assert text_of(df.drop("text"), "missing").count() == 0


@pytest.mark.parametrize("n", [1, 3])
def test_below_one_is_zero(spark, n):
    assert spark.range(50).select(below(n, 1, F.col("id")).alias("k")).agg(F.max("k")).first()[0] <= n - 1
