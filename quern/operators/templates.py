"""Instruction examples and conversations rendered into training text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import field_or_empty, first_filled, strip
from quern.plans.skew import hot_keys, spread_join

# Section marks and role names of the text format.
INSTRUCTION_MARK = "### Instruction:\n"
INPUT_MARK = "\n\n### Input:\n"
RESPONSE_MARK = "\n\n### Response:\n"
CUT_MARKS = ("### Instruction", "### Response")
HUMAN_ROLES = ("human", "user")
ASSISTANT_ROLES = ("gpt", "assistant")


def _short(instruction: Column, response: Column) -> Column:
    return F.concat(F.lit(INSTRUCTION_MARK), instruction, F.lit(RESPONSE_MARK), response)


def alpaca(df: DataFrame, instruction: str = "instruction", extra: str = "input",
           output: str = "output") -> DataFrame:
    """Add ``text`` from instruction, optional input and output; skip unusable rows."""
    ask, more, reply = (strip(field_or_empty(df, c)) for c in (instruction, extra, output))
    long = F.concat(F.lit(INSTRUCTION_MARK), ask, F.lit(INPUT_MARK), more, F.lit(RESPONSE_MARK), reply)
    return (df.where((ask != "") & (reply != ""))
            .withColumn("text", F.when(more != "", long).otherwise(_short(ask, reply))))


def qa(df: DataFrame, prompt: str = "question", response: str = "answer") -> DataFrame:
    """Add ``text`` from a prompt and a response column; skip unusable rows."""
    ask, reply = (strip(field_or_empty(df, c)) for c in (prompt, response))
    return df.where((ask != "") & (reply != "")).withColumn("text", _short(ask, reply))


def sharegpt(df: DataFrame, conversation: str = "conversations") -> DataFrame:
    """Add ``text`` from an array of turns: first human turn, first assistant turn after it.

    Turns are structs with any of from/role and value/content. An empty first
    human turn is still the one used, so its conversation is skipped.
    """
    names = {f.name for f in df.schema[conversation].dataType.elementType.fields}

    def part(turn: Column, *choices: str) -> Column:
        return first_filled(*[turn[c] for c in choices if c in names], F.lit(""))

    turns = F.transform(
        F.col(conversation),
        lambda t: F.struct(part(t, "from", "role").alias("role"),
                           strip(part(t, "value", "content")).alias("said")))
    shaped = df.withColumn("_turns", turns)
    shaped = shaped.withColumn(
        "_first", F.array_position(F.transform("_turns", lambda t: t["role"].isin(*HUMAN_ROLES)), True).cast("int"))
    after = F.filter(F.slice("_turns", F.col("_first") + 1, F.size("_turns")),
                     lambda t: t["role"].isin(*ASSISTANT_ROLES))
    pair = F.struct(F.get("_turns", F.col("_first") - 1)["said"].alias("ask"),
                    F.get(after, F.lit(0))["said"].alias("reply"))
    # ``explode`` of one element keeps the filter from repeating the work above.
    shaped = shaped.withColumn("_pair", F.explode(F.array(pair)))
    return (shaped.where((F.col("_pair.ask") != "") & (F.col("_pair.reply") != ""))
            .withColumn("text", _short(F.col("_pair.ask"), F.col("_pair.reply")))
            .drop("_turns", "_first", "_pair"))


def sharegpt_rows(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text", min_hot_rows: int | None = None) -> DataFrame:
    """``sharegpt`` over one row per turn; gives (conversation, text).

    Both steps are minimum aggregates, combined before the shuffle, so a
    conversation of any length never gathers in one task.
    """
    said = strip(F.coalesce(F.col(text), F.lit("")))
    human = (turns.where(F.col(role).isin(*HUMAN_ROLES))
             .groupBy(conversation)
             .agg(F.min(F.struct(F.col(turn).alias("at"), said.alias("said"))).alias("_ask"))
             .select(conversation, F.col("_ask.at").alias("_asked_at"), F.col("_ask.said").alias("_ask")))
    assistant = (turns.where(F.col(role).isin(*ASSISTANT_ROLES))
                 .select(conversation, F.col(turn).alias("_at"), said.alias("_said")))
    hot = hot_keys(assistant, [conversation], min_hot_rows)
    joined = spread_join(assistant, human, [conversation], ["_at"], hot=hot)
    pairs = (joined.where(F.col("_at") > F.col("_asked_at"))
             .groupBy(conversation)
             .agg(F.min(F.struct("_at", "_said")).alias("_reply"), F.min("_ask").alias("_ask")))
    reply = F.col("_reply._said")
    return (pairs.where((F.col("_ask") != "") & (reply != ""))
            .select(conversation, _short(F.col("_ask"), reply).alias("text")))


def format_examples(df: DataFrame, entry: dict) -> DataFrame:
    """Render rows by ``entry["format"]``; an unknown format is an error."""
    kind = entry["format"]
    if kind == "alpaca":
        return alpaca(df, entry.get("instr_field", "instruction"),
                      entry.get("input_field", "input"), entry.get("output_field", "output"))
    if kind == "qa":
        return qa(df, entry.get("prompt_field", "question"), entry.get("response_field", "answer"))
    if kind == "sharegpt":
        field = entry.get("conv_field", "conversations")
        if isinstance(df.schema[field].dataType, T.ArrayType):
            return sharegpt(df, field)
        raise ValueError(f"{field!r} is not an array of turns; use sharegpt_rows for one row per turn")
    raise ValueError(f"no template is called {kind!r}; there are alpaca, qa and sharegpt")


def frame_prompts(df: DataFrame, message: str = "message", out: str = "prompt") -> DataFrame:
    """Wrap a message in the short template with the response left open."""
    return df.withColumn(out, _short(strip(F.coalesce(F.col(message), F.lit(""))), F.lit("")))


def frame_prompt_ids(df: DataFrame, eot_id: int, ids: str = "ids") -> DataFrame:
    """Start a framed prompt's ids with the end-of-text id: a fresh document."""
    return df.withColumn(ids, F.concat(F.array(F.lit(eot_id)), F.col(ids)))


def trim_replies(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Cut a reply where it starts a new instruction or response section."""
    col = strip(F.coalesce(F.col(reply), F.lit("")))
    for mark in CUT_MARKS:
        col = strip(F.substring_index(col, mark, 1))
    return df.withColumn(reply, col)
