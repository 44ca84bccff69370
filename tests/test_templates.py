import pytest
from pyspark.sql import functions as F

from quern.operators import templates as t

SHORT = "### Instruction:\n{}\n\n### Response:\n{}"
LONG = "### Instruction:\n{}\n\n### Input:\n{}\n\n### Response:\n{}"


def texts(df, key="id"):
    return {r[key]: r["text"] for r in df.collect()}


def test_alpaca(spark):
    df = spark.createDataFrame([
        (1, " do ", "  ", "\tdone\n"), (2, "do", "this", "done"), (3, "do", None, " 　"), (4, "", "x", "y"),
        (5, None, None, "y"), (6, "{a}", "{b}", "100%")], "id int, instruction string, input string, output string")
    assert texts(t.alpaca(df)) == {1: SHORT.format("do", "done"), 2: LONG.format("do", "this", "done"),
                                   6: LONG.format("{a}", "{b}", "100%")}
    assert texts(t.alpaca(df.drop("input")))[2] == SHORT.format("do", "done")


def test_qa(spark):
    df = spark.createDataFrame([(1, "q ", " a"), (2, " ", "a"), (3, "q", None)], "id int, question string, answer string")
    assert texts(t.qa(df)) == {1: SHORT.format("q", "a")}


CONVERSATIONS = {
    "assistant first": [("assistant", "no"), ("user", "q"), ("assistant", "a")],
    "empty first human": [("user", " "), ("user", "q"), ("assistant", "a")],
    "two humans": [("human", "q1"), ("user", "q2"), ("gpt", "a")],
    "second pair ignored": [("user", "q"), ("assistant", "a"), ("user", "q2"), ("assistant", "a2")],
    "empty reply": [("user", "q"), ("assistant", ""), ("assistant", "a")],
    "no assistant": [("user", "q"), ("system", "s")],
    "no human": [("assistant", "a")],
}
WANT = {"assistant first": SHORT.format("q", "a"), "two humans": SHORT.format("q1", "a"),
        "second pair ignored": SHORT.format("q", "a")}


def test_sharegpt_arrays(spark):
    rows = [(k, [(r if i % 2 else None, "" if i % 2 else r, None, v) for i, (r, v) in enumerate(c)])
            for k, c in CONVERSATIONS.items()] + [("null", None), ("empty", [])]
    df = spark.createDataFrame(rows, "id string, conversations array<struct<`from`:string,role:string,value:string,content:string>>")
    assert texts(t.sharegpt(df)) == WANT


def test_sharegpt_with_two_fields(spark):
    df = spark.createDataFrame([(1, [("human", "q"), ("gpt", "a")])], "id int, conversations array<struct<`from`:string,value:string>>")
    assert texts(t.sharegpt(df)) == {1: SHORT.format("q", "a")}
    df = spark.createDataFrame([(1, [("user", "q"), ("assistant", "a")])], "id int, messages array<struct<role:string,content:string>>")
    assert texts(t.format_examples(df, {"format": "sharegpt", "conv_field": "messages"})) == {1: SHORT.format("q", "a")}


@pytest.mark.parametrize("min_rows", [None, 2])
def test_sharegpt_rows(spark, min_rows):
    rows = [(k, i, r, v) for k, c in CONVERSATIONS.items() for i, (r, v) in enumerate(c)]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string").repartition(5)
    assert texts(t.sharegpt_rows(df, min_hot_rows=min_rows), "conv_id") == WANT


def test_one_long_conversation(spark):
    turns = spark.range(20_000).select(F.lit(1).alias("conv_id"), "id", F.concat(F.lit("t"), "id").alias("text"),
                                       F.when(F.col("id") < 9_000, "system").when(F.col("id") % 2 == 0, "user")
                                       .otherwise("assistant").alias("role")).withColumnRenamed("id", "turn")
    assert texts(t.sharegpt_rows(turns, min_hot_rows=100), "conv_id") == {1: SHORT.format("t9000", "t9001")}


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="xml"):
        t.format_examples(spark.range(1), {"format": "xml"})
    turns = spark.createDataFrame([(1, "x")], "id int, conversations string")
    with pytest.raises(ValueError, match="sharegpt_rows"):
        t.format_examples(turns, {"format": "sharegpt"})


def test_prompts_and_replies(spark):
    df = spark.createDataFrame([(1, " hi\n")], "id int, message string")
    assert t.frame_prompts(df).first()["prompt"] == SHORT.format("hi", "")
    ids = spark.createDataFrame([([5, 6],)], "ids array<int>")
    assert t.frame_prompt_ids(ids, 0).first()["ids"] == [0, 5, 6]
    replies = spark.createDataFrame([
        (1, " a ### Instruction: b"), (2, "a\n### Response:\nb ### Instruction c"), (3, "### Response x"), (4, " a "), (5, None)],
        "id int, reply string")
    assert {r.id: r.reply for r in t.trim_replies(replies).collect()} == {1: "a", 2: "a", 3: "", 4: "a", 5: ""}
