"""Every operator as a query over the test tables, with its SQL counterpart.

Each entry runs over whole tables. Where a result is long text or a token
array, the query returns its MD5 digest instead, so that results stay small.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import STRIP_CHARS
from quern.operators import bpe, candidates, distill, mix, pieces, prepare, retention, templates, tokens
from quern.plans.prefix import WIDE_ROWS_PER_RANGE, dense_rank_from_zero
from quern.plans.stage import content_key, cut, fresh_path, shared_dir
from quern.session import tune
from quern.sources import corpus, jsonl, sinks
from quern.streaming import corpus_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SEED = 42
WEIGHTS = {"en": 0.4, "fr": 0.3, "de": 0.2, "es": 0.1}
LOOP_WEIGHTS = {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}
CHUNK = 4_096
BLOCK = 128
VOCAB_SIZE = 384
LARGE_VOCAB_SIZE = 2_048
TEACHERS = "groq:openai/gpt-oss-120b, qwen/qwen3-32b, openrouter:meta-llama/llama-3.1-8b-instruct:free"
WHITE = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
RE2_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(tune(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def spread(scan: DataFrame) -> DataFrame:
    """On a local master only: deal the one file of a test table out over the cores.

    Heavy work per row (patterns, coding) would otherwise run in one task. On a
    cluster scans are never shuffled.
    """
    context = scan.sparkSession.sparkContext
    if not re.match(r"local(\[|$)", context.master):
        return scan
    return scan.repartition(context.defaultParallelism) if scan.rdd.getNumPartitions() < context.defaultParallelism else scan


def md5(col: Column | str) -> Column:
    return F.md5((F.col(col) if isinstance(col, str) else col).cast("binary"))


def joined(ids: str) -> Column:
    return F.array_join(F.col(ids).cast("array<string>"), ",")


# --- SQL building blocks -------------------------------------------------------

def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_unit(*parts: str) -> str:
    text = " || '|' || ".join(f"({p})::VARCHAR" for p in parts)
    return f"((('0x' || substr(md5({text}), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0)"


def sql_choice(values: list[str], *parts: str) -> str:
    return f"({sql_list(values)})[floor({sql_unit(*parts)} * {len(values)})::INT + 1]"


def sql_strip(expr: str) -> str:
    return f"trim({expr}, " + " || ".join(f"chr({ord(c)})" for c in STRIP_CHARS) + ")"


def sql_mix(weights: dict[str, float]) -> str:
    """CTEs: documents blended by language; ``placed`` holds doc_index, lang, doc_id."""
    cases = " ".join(f"WHEN '{s}' THEN {w!r}" for s, w in mix.normalised(weights).items())
    return f"""
      WITH gaps AS (
        SELECT doc_id, lang, text, floor(-ln({sql_unit(str(SEED), "lang", "0", "doc_id")})
               / (CASE lang {cases} END) * 1048576.0)::BIGINT AS gap FROM documents),
      drawn AS (SELECT *, sum(gap) OVER (PARTITION BY lang ORDER BY doc_id) AS arrival FROM gaps),
      placed AS (SELECT (row_number() OVER (ORDER BY arrival, lang, doc_id) - 1)::BIGINT AS doc_index,
                        lang, doc_id, text FROM drawn WHERE text <> '')"""


SQL_CHARS = """
      WITH indexed AS (
        SELECT (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS doc_index, doc_id, text,
               length(text)::BIGINT + 1 AS n_tokens FROM documents WHERE text <> ''),
      divided AS (SELECT *, CASE WHEN doc_index % 20 = 0 THEN 'val' ELSE 'train' END AS split FROM indexed),
      placed AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY split ORDER BY doc_index
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM divided)"""

SQL_SCORES = """
      scores AS (SELECT l_suppkey AS "group", l_partkey AS item, max(l_extendedprice) / 10000.0 - 3.0 AS score
                 FROM lineitem GROUP BY ALL)"""

SQL_PLAN = f"""
      drawn AS (SELECT o_orderkey AS plan_id,
          {sql_choice(list(distill.RECIPES), "0", "'recipe'", "o_orderkey")} AS recipe,
          {sql_choice(distill.TOPICS, "0", "'topic'", "o_orderkey")} AS topic,
          {sql_choice(distill.AUDIENCES, "0", "'audience'", "o_orderkey")} AS audience,
          {sql_choice(distill.STYLES, "0", "'style'", "o_orderkey")} AS style FROM orders),
      recipes(recipe, system, template) AS (VALUES {", ".join(
          "(" + ", ".join("'" + x.replace("'", "''") + "'" for x in (n, *r)) + ")" for n, r in distill.RECIPES.items())}),
      plan AS (SELECT plan_id, recipe, topic, audience, style, system,
                 replace(replace(replace(template, '{{topic}}', topic), '{{audience}}', audience), '{{style}}', style) AS "user"
               FROM drawn JOIN recipes USING (recipe))"""

SQL_ASSIGNED = SQL_PLAN + f""",
      assigned AS (SELECT *, ({sql_list([p for p, _ in distill.parse_teachers(TEACHERS)])})[slot] AS provider,
                          ({sql_list([m for _, m in distill.parse_teachers(TEACHERS)])})[slot] AS model
                   FROM (SELECT *, ((row_number() OVER (ORDER BY plan_id) - 1) % 3 + 1)::INT AS slot FROM plan))"""

SQL_DRY = SQL_ASSIGNED + """,
      written AS (SELECT plan_id, recipe, model, repeat('[dry-run/' || recipe || '/' || model || '] ' || "user" || ' ', 8) AS text
                  FROM assigned)"""

SQL_REPLIES = f"""
      replies AS (SELECT conv_id, turn, text,
          CASE (conv_id + turn) % 7 WHEN 0 THEN NULL WHEN 1 THEN 429 WHEN 2 THEN 503 WHEN 3 THEN 404 ELSE 200 END AS status,
          CASE WHEN turn % 2 = 0 THEN (conv_id % 90)::VARCHAR WHEN turn % 3 = 0 THEN 'soon' END AS retry_after,
          CASE WHEN (conv_id + turn) % 5 = 0 THEN NULL ELSE {sql_strip("text")} END AS content
        FROM conversations)"""

SQL_ALPACA_VIEW = """
      ask AS (SELECT doc_id, split_part(text, chr(10), 1) AS instruction,
                     CASE WHEN doc_id % 3 = 0 THEN lang ELSE '' END AS input,
                     substr(text, length(split_part(text, chr(10), 1)) + 2) AS output FROM documents)"""

SQL_QA_VIEW = """
      pairs AS (SELECT a.conv_id * 1000 + a.turn AS ord, a.text AS question, b.text AS answer
                FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
                WHERE a.role = 'user')"""

SQL_SHORT = "'### Instruction:' || chr(10) || {} || chr(10) || chr(10) || '### Response:' || chr(10) || {}"
SQL_LONG = ("'### Instruction:' || chr(10) || {} || chr(10) || chr(10) || '### Input:' || chr(10) || {} "
            "|| chr(10) || chr(10) || '### Response:' || chr(10) || {}")

SQL_ALPACA = f"""{SQL_ALPACA_VIEW},
      stripped AS (SELECT doc_id, {sql_strip("instruction")} AS i, {sql_strip("input")} AS x, {sql_strip("output")} AS o FROM ask),
      alpaca AS (SELECT doc_id, CASE WHEN x <> '' THEN {SQL_LONG.format("i", "x", "o")} ELSE {SQL_SHORT.format("i", "o")} END AS text
                 FROM stripped WHERE i <> '' AND o <> '')"""

SQL_QA = f"""{SQL_QA_VIEW},
      qa AS (SELECT ord, {SQL_SHORT.format("q", "a")} AS text
             FROM (SELECT ord, {sql_strip("question")} AS q, {sql_strip("answer")} AS a FROM pairs) WHERE q <> '' AND a <> '')"""

SQL_SHAREGPT = f"""
      WITH human AS (SELECT conv_id, min(turn) AS asked FROM conversations WHERE role IN ('human', 'user') GROUP BY conv_id),
      reply AS (SELECT c.conv_id, min(c.turn) AS answered FROM conversations c JOIN human h ON c.conv_id = h.conv_id
                WHERE c.role IN ('gpt', 'assistant') AND c.turn > h.asked GROUP BY c.conv_id),
      said AS (SELECT r.conv_id, {sql_strip("a.text")} AS q, {sql_strip("b.text")} AS a FROM reply r
               JOIN human h ON r.conv_id = h.conv_id
               JOIN conversations a ON a.conv_id = r.conv_id AND a.turn = h.asked
               JOIN conversations b ON b.conv_id = r.conv_id AND b.turn = r.answered)
      SELECT conv_id, {SQL_SHORT.format("q", "a")} AS text FROM said WHERE q <> '' AND a <> ''"""


# --- Fixture views -------------------------------------------------------------

def alpaca_view(spark, sf_dir) -> DataFrame:
    first = F.substring_index("text", "\n", 1)
    return table(spark, sf_dir, "documents").select(
        "doc_id", first.alias("instruction"),
        F.when(F.col("doc_id") % 3 == 0, F.col("lang")).otherwise("").alias("input"),
        F.expr("substring(text, char_length(substring_index(text, '\\n', 1)) + 2)").alias("output"))


def qa_view(spark, sf_dir) -> DataFrame:
    said = table(spark, sf_dir, "conversations")
    asked = said.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    after = said.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return asked.join(after, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"), "question", "answer")


def by_language(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("lang").alias("source_id"), F.col("doc_id").alias("ord"), "text")


def held_ids(spark, sf_dir) -> DataFrame:
    """Documents indexed, split and coded by the learned vocabulary, written once."""
    return prepare.coded(plain_documents(spark, sf_dir), vocabulary(spark, sf_dir), "doc_id", ["doc_id"])


def coded(spark, sf_dir) -> DataFrame:
    return held_ids(spark, sf_dir).drop("ids")


def stream_chunks(spark, sf_dir) -> DataFrame:
    held = held_ids(spark, sf_dir)
    placed = tokens.offsets(held.select("doc_id", "doc_index", "split", "n_tokens"))
    return tokens.chunk(held.select("doc_id", "ids").join(placed.select("doc_id", "split", "start"), "doc_id"), CHUNK)


def scores(spark, sf_dir, value: Column | None = None) -> DataFrame:
    value = F.max("l_extendedprice") / 10000.0 - 3.0 if value is None else value
    return cut(table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_suppkey").alias("group"), F.col("l_partkey").alias("item")).agg(value.alias("score")))


def plan(spark, sf_dir) -> DataFrame:
    return distill.plan_prompts(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("plan_id")))


def assigned(spark, sf_dir) -> DataFrame:
    rows = dense_rank_from_zero(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("plan_id")),
                                "request_no", ["plan_id"])
    return distill.assign(distill.plan_prompts(rows), distill.parse_teachers(TEACHERS), "request_no")


def replies(spark, sf_dir) -> DataFrame:
    key = F.col("conv_id") + F.col("turn")
    good = F.to_json(F.struct(F.array(F.struct(F.struct(
        F.concat(F.lit(" \n"), "text", F.lit("　")).alias("content")).alias("message"))).alias("choices")))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        F.when(key % 7 == 0, None).when(key % 7 == 1, 429).when(key % 7 == 2, 503).when(key % 7 == 3, 404)
        .otherwise(200).alias("status"),
        F.when(F.col("turn") % 2 == 0, (F.col("conv_id") % 90).cast("string"))
        .when(F.col("turn") % 3 == 0, "soon").alias("retry_after"),
        F.when(key % 5 != 0, good).when(key % 2 == 0, F.substring(good, 1, 20)).otherwise('{"choices": []}').alias("body"))


def listing(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.format_string(
        "%s/ckpt_%06d%s", F.col("o_orderpriority"), F.col("o_orderkey"),
        F.when(F.col("o_orderstatus") == "P", ".tmp").otherwise(".pt")).alias("path"))


SQL_LISTING = """
      listing AS (SELECT o_orderpriority || '/' AS prefix, o_orderkey AS step,
                         o_orderpriority || '/ckpt_' || printf('%06d', o_orderkey) || '.pt' AS path
                  FROM orders WHERE o_orderstatus <> 'P')"""


def vocabulary(spark, sf_dir) -> bpe.Vocabulary:
    """Learned from the normalised texts once per application and content, then read back."""
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/vocabulary-{app}-{content_key(spark, f'{sf_dir}/documents.parquet')}-{VOCAB_SIZE}"
    return bpe.ensure(spark, path, VOCAB_SIZE, plain_documents(spark, sf_dir))


def learned(spark, sf_dir) -> bpe.Vocabulary:
    """Learned from the normalised texts in this very run."""
    return bpe.train(pieces.piece_counts(plain_documents(spark, sf_dir)), VOCAB_SIZE)


# --- Sources -------------------------------------------------------------------

@query("jsonl_source", "SELECT doc_id, lang, md5(text) AS text_md5 FROM documents")
def jsonl_source(spark, sf_dir):
    """Good lines between blank, cut-off and non-object ones."""
    good = F.to_json(F.struct("doc_id", "lang", "text"))
    lines = table(spark, sf_dir, "documents").select(F.explode(F.array(
        F.concat(F.lit(" \t"), good, F.lit("\r")), F.lit("  "), F.expr("left('{\"doc_id\": 1, \"lang', char_length(lang) + 9)"),
        F.col("doc_id").cast("string"), F.lit('["text"]'))).alias("value"))
    return jsonl.parse_jsonl(lines, "doc_id long, lang string, text string").select(
        "doc_id", "lang", md5("text").alias("text_md5"))


@query("text_source", """
      SELECT doc_id, CASE WHEN lang = 'en' THEN md5('# ' || text) ELSE md5(text) END AS text_md5
      FROM documents WHERE lang <> 'es'""")
def text_source(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "en", F.concat(F.lit("# "), "text")).when(F.col("lang") == "fr", None).otherwise("").alias("body"),
        F.when(F.col("lang") != "es", F.col("text")).otherwise("").alias("text"))
    return corpus.text_of(rows, "body").select("doc_id", md5("text").alias("text_md5"))


@query("mix_sources", f"""
      WITH {SQL_ALPACA}, {SQL_QA}
      SELECT 'plain' AS source_id, doc_id AS ord, md5(text) AS text_md5, 0.6::DOUBLE AS weight FROM documents
      UNION ALL SELECT 'tasks', doc_id, md5(text), 0.25 FROM alpaca
      UNION ALL SELECT 'talk', ord, md5(text), 0.15 FROM qa""")
def mix_sources(spark, sf_dir):
    entries = [
        corpus.MixSource("plain", path=f"{sf_dir}/documents.parquet", order="doc_id", weight=0.6),
        corpus.MixSource("tasks", df=alpaca_view(spark, sf_dir), order="doc_id", format="alpaca", weight=0.25),
        corpus.MixSource("talk", df=qa_view(spark, sf_dir), format="qa", weight=0.15),
    ]
    return corpus.build_mix(spark, entries).select("source_id", "ord", md5("text").alias("text_md5"), "weight")


@query("source_choice", sql_mix(WEIGHTS) + " SELECT doc_index AS ord, lang AS source_id, md5(text) AS text_md5 FROM placed")
def source_choice(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    entries = [corpus.MixSource(s, df=docs.where(F.col("lang") == s), order="doc_id", weight=w) for s, w in WEIGHTS.items()]
    return corpus.open_corpus(spark, mix=entries, seed=SEED).select("ord", "source_id", md5("text").alias("text_md5"))


_POOLS = [corpus.ADJECTIVES, corpus.ANIMALS, corpus.NAMES, corpus.VERBS, corpus.PLACES, corpus.ADJECTIVES, corpus.VERBS]


@query("synthetic_corpus", f"""
      WITH w AS (SELECT o_orderkey AS id, {", ".join(
          f"{sql_choice(p, str(corpus.STORY_SEED), str(i), 'o_orderkey')} AS w{i}" for i, p in enumerate(_POOLS))} FROM orders)
      SELECT id, 'Once upon a time, there was a ' || w0 || ' ' || w1 || '. ' || w2 || ' and the ' || w1 || ' ' || w3
        || ' in the ' || w4 || '. The ' || w1 || ' was very ' || w5 || ' and ' || w2 || ' was happy. They ' || w6
        || ' all day and then went home to sleep.' AS text FROM w""")
def synthetic_corpus(spark, sf_dir):
    return corpus.synthetic(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")))


@query("stream_corpus", SQL_CHARS + " SELECT doc_id, doc_index, split, n_tokens, start FROM placed")
def stream_corpus(spark, sf_dir):
    """The folder's documents as a stream, indexed batch by batch, read back."""
    schema = table(spark, sf_dir, "documents").schema
    # In braces the path is a pattern, which takes a table of one file as well as a folder of files.
    rows = corpus_stream.open_stream(spark, f"{sf_dir}/{{documents.parquet}}", schema, "parquet")
    out = fresh_path(spark, "stream")
    coded_rows = rows.withColumn("n_tokens", (F.char_length("text") + 1).cast("bigint"))
    corpus_stream.start_indexed(coded_rows, out, fresh_path(spark, "offsets"), ["doc_id"]).awaitTermination()
    return spark.read.parquet(f"{out}/docs").select("doc_id", "doc_index", "split", "n_tokens", "start")


# --- Templates -----------------------------------------------------------------

@query("sft_alpaca", f"WITH {SQL_ALPACA} SELECT doc_id, text FROM alpaca")
def sft_alpaca(spark, sf_dir):
    return templates.alpaca(alpaca_view(spark, sf_dir)).select("doc_id", "text")


@query("sft_qa", f"WITH {SQL_QA} SELECT ord, text FROM qa")
def sft_qa(spark, sf_dir):
    return templates.qa(qa_view(spark, sf_dir)).select("ord", "text")


@query("sft_sharegpt", f"""
      WITH said AS (SELECT doc_id, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i,
                           unnest(string_split(text, chr(10))) AS line FROM documents),
      turns AS (SELECT doc_id, i, {sql_strip("line")} AS line, length(line) % 3 AS speaker FROM said),
      human AS (SELECT doc_id, min(i) AS i FROM turns WHERE speaker = 1 GROUP BY doc_id),
      reply AS (SELECT t.doc_id, min(t.i) AS i FROM turns t JOIN human h ON t.doc_id = h.doc_id AND t.i > h.i
                WHERE speaker = 2 GROUP BY t.doc_id),
      pairs AS (SELECT r.doc_id, a.line AS q, b.line AS a FROM reply r JOIN human h ON r.doc_id = h.doc_id
                JOIN turns a ON a.doc_id = h.doc_id AND a.i = h.i JOIN turns b ON b.doc_id = r.doc_id AND b.i = r.i)
      SELECT doc_id, {SQL_SHORT.format("q", "a")} AS text FROM pairs WHERE q <> '' AND a <> ''""")
def sft_sharegpt(spark, sf_dir):
    """The lines of a document as turns; a line's length says who speaks, in either spelling."""
    def turn(line):
        speaker = F.char_length(line) % 3
        return F.struct(F.when(speaker == 1, "human").when(speaker == 0, "system").alias("from"),
                        F.when(speaker == 2, "assistant").otherwise("").alias("role"),
                        F.when(speaker == 1, line).alias("value"), F.when(speaker != 1, line).alias("content"))
    nested = table(spark, sf_dir, "documents").select("doc_id", F.transform(F.split("text", "\n"), turn).alias("conversations"))
    return templates.sharegpt(nested).select("doc_id", "text")


@query("sft_from_turns", SQL_SHAREGPT)
def sft_from_turns(spark, sf_dir):
    return templates.sharegpt_rows(table(spark, sf_dir, "conversations"))


@query("sft_format", f"""
      WITH {SQL_ALPACA}, {SQL_QA}
      SELECT 'alpaca' AS kind, doc_id AS id, md5(text) AS text_md5 FROM alpaca
      UNION ALL SELECT 'qa', ord, md5(text) FROM qa""")
def sft_format(spark, sf_dir):
    asks = alpaca_view(spark, sf_dir).withColumnsRenamed({"instruction": "ask", "output": "reply"})
    a = templates.format_examples(asks, {"format": "alpaca", "instr_field": "ask", "output_field": "reply"})
    b = templates.format_examples(qa_view(spark, sf_dir), {"format": "qa"})
    return (a.select(F.lit("alpaca").alias("kind"), F.col("doc_id").alias("id"), md5("text").alias("text_md5"))
            .unionByName(b.select(F.lit("qa").alias("kind"), F.col("ord").alias("id"), md5("text").alias("text_md5"))))


@query("prompt_frame", f"""
      SELECT conv_id, turn, {SQL_SHORT.format(sql_strip("text"), "''")} AS prompt FROM conversations""")
def prompt_frame(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(F.lit("\n "), "text").alias("message"))
    return templates.frame_prompts(said).select("conv_id", "turn", "prompt")


@query("reply_trim", f"""
      SELECT conv_id, turn, {sql_strip("CASE turn % 3 WHEN 2 THEN '' ELSE text END")} AS reply FROM conversations""")
def reply_trim(spark, sf_dir):
    tail = (F.when(F.col("turn") % 3 == 0, F.concat("text", F.lit(" \n### Response: x\n### Instruction:\ny")))
            .when(F.col("turn") % 3 == 2, F.concat(F.lit("### Response:"), "text"))
            .otherwise(F.col("text")))
    return templates.trim_replies(table(spark, sf_dir, "conversations").select("conv_id", "turn", tail.alias("reply")))


# --- Mixing --------------------------------------------------------------------

@query("weighted_interleave", sql_mix(WEIGHTS) + " SELECT doc_index, lang AS source_id, doc_id AS ord FROM placed")
def weighted_interleave(spark, sf_dir):
    return mix.blend_order(by_language(spark, sf_dir), WEIGHTS, SEED).select("doc_index", "source_id", "ord")


@query("loop_source", f"""
      WITH shares AS (SELECT lang, CASE lang {" ".join(
          f"WHEN '{s}' THEN {w!r}" for s, w in mix.normalised(LOOP_WEIGHTS).items())} END AS w, doc_id, epoch
        FROM documents CROSS JOIN range(0, 40) r(epoch) WHERE lang = 'es' OR epoch = 0),
      gaps AS (SELECT *, floor(-ln({sql_unit(str(SEED), "lang", "epoch", "doc_id")}) / w * 1048576.0)::BIGINT AS gap FROM shares),
      drawn AS (SELECT *, sum(gap) OVER (PARTITION BY lang ORDER BY epoch, doc_id) AS arrival FROM gaps)
      SELECT (row_number() OVER (ORDER BY arrival, lang, epoch, doc_id) - 1)::BIGINT AS doc_index,
             lang AS source_id, epoch::INT AS epoch, doc_id AS ord
      FROM drawn WHERE arrival <= (SELECT max(arrival) FROM drawn WHERE lang <> 'es')""")
def loop_source(spark, sf_dir):
    """One source starts over until every other one is used up."""
    return mix.blend_order(by_language(spark, sf_dir), LOOP_WEIGHTS, SEED, looped=("es",), stop="finite_exhausted").select(
        "doc_index", "source_id", "epoch", "ord")


@query("head_docs", sql_mix(WEIGHTS) + " SELECT doc_index, md5(text) AS text_md5 FROM placed WHERE doc_index < 200")
def head_docs(spark, sf_dir):
    return mix.head(mix.interleave(by_language(spark, sf_dir), WEIGHTS, SEED, budget=200), 200).select(
        "doc_index", md5("text").alias("text_md5"))


@query("mix_report", f"""
      SELECT lang AS source_id, CASE lang {" ".join(f"WHEN '{s}' THEN {w!r}" for s, w in mix.normalised(WEIGHTS).items())} END::DOUBLE AS weight,
             count(*) AS n_docs, round(count(*) / (SELECT count(*) FROM documents), 9) AS share FROM documents GROUP BY lang""")
def mix_report(spark, sf_dir):
    return mix.mix_report(by_language(spark, sf_dir), WEIGHTS).withColumn("share", F.round("share", 9))


# --- Vocabulary and coding -----------------------------------------------------

SQL_PIECES = f"""
      plain AS (SELECT doc_id, trim(regexp_replace(text, '{WHITE}', ' ', 'g')) AS text FROM documents),
      split_up AS (SELECT doc_id, regexp_extract_all(text, '{RE2_PIECES.replace("'", "''")}') AS pieces FROM plain)"""


def plain_documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").withColumn("text", plain("text"))


def plain(text: str) -> Column:
    """Runs of white space as one space each, none at the ends. Single spaces, most by far, need no replacement."""
    return F.trim(F.regexp_replace(text, r" [\p{IsWhite_Space}]+|[\p{IsWhite_Space}&&[^ ]][\p{IsWhite_Space}]*", " "))


@query("pretokenize", f"""
      WITH {SQL_PIECES}
      SELECT doc_id, (unnest(generate_series(1, len(pieces))) - 1)::INT AS pos, unnest(pieces) AS piece FROM split_up""")
def pretokenize(spark, sf_dir):
    return pieces.pretokenize(plain_documents(spark, sf_dir), keep=("doc_id",))


@query("piece_counts", f"""
      WITH {SQL_PIECES} SELECT piece, count(*) AS n FROM (SELECT unnest(pieces) AS piece FROM split_up) GROUP BY piece""")
def piece_counts(spark, sf_dir):
    return pieces.piece_counts(plain_documents(spark, sf_dir))


@query("pair_counts", f"""
      WITH {SQL_PIECES},
      counted AS (SELECT hex(encode(piece)) AS h, count(*) AS n FROM (SELECT unnest(pieces) AS piece FROM split_up) GROUP BY piece),
      steps AS (SELECT h, n, unnest(generate_series(0, len(h) // 2 - 2)) AS i FROM counted WHERE len(h) >= 4)
      SELECT ('0x' || substr(h, 2 * i + 1, 2))::INT AS left_byte, ('0x' || substr(h, 2 * i + 3, 2))::INT AS right_byte,
             sum(n)::BIGINT AS n FROM steps GROUP BY ALL""")
def pair_counts(spark, sf_dir):
    pairs = pieces.pair_counts(pieces.piece_counts(plain_documents(spark, sf_dir)))
    symbols = F.split(F.lit("\n".join(pieces.BYTE_SYMBOLS)), "\n")
    return pairs.select(*[(F.array_position(symbols, F.col(c)) - 1).cast("int").alias(f"{c}_byte") for c in ("left", "right")], "n")


# Learning as a recursive query: the most frequent pair, lowest first among equals,
# becomes one character from chr(512) on; bytes are their alphabet characters.
SQL_LEARN = f"""
      WITH RECURSIVE {SQL_PIECES.strip()},
      bag AS MATERIALIZED (SELECT piece, count(*)::BIGINT AS n,
          array_to_string(list_transform(regexp_extract_all(hex(encode(piece)), '..'),
                                         lambda h: ({sql_list(pieces.BYTE_SYMBOLS)})[('0x' || h)::INT + 1]), '') AS sym
        FROM (SELECT unnest(pieces) AS piece FROM split_up) GROUP BY piece),
      learn AS (
        SELECT 0 AS step, '' AS pair, sym, n FROM bag WHERE length(sym) > 1
        UNION ALL
        SELECT step + 1, best, replace(sym, best, chr(512 + step)), n
        FROM learn, (SELECT gram AS best FROM (SELECT substr(sym, i, 2) AS gram, n
                       FROM (SELECT sym, n, unnest(generate_series(1, length(sym) - 1)) AS i FROM learn))
                     GROUP BY gram ORDER BY sum(n) DESC, gram LIMIT 1)
        WHERE step < {VOCAB_SIZE - 257}),
      merges AS MATERIALIZED (SELECT step - 1 AS rank, pair, chr(511 + step) AS symbol
                              FROM (SELECT DISTINCT step, pair FROM learn WHERE step > 0))"""


def sql_id(char: str) -> str:
    return (f"(CASE WHEN unicode({char}) >= 512 THEN unicode({char}) - 255 "
            f"ELSE list_position({sql_list(sorted(pieces.BYTE_SYMBOLS))}, {char}) END)::INT")


@query("bpe_train", SQL_LEARN + f"""
      SELECT rank::INT AS rank, {sql_id("substr(pair, 1, 1)")} AS "left", {sql_id("substr(pair, 2, 1)")} AS "right",
             (rank + 257)::INT AS merged FROM merges""")
def bpe_train(spark, sf_dir):
    return learned(spark, sf_dir).merge_table(spark)


@query("bpe_train_large")
def bpe_train_large(spark, sf_dir):
    """A vocabulary of the size that models use; recursion in SQL takes too long for it, a test compares the public package."""
    return bpe.train(pieces.piece_counts(plain_documents(spark, sf_dir)), LARGE_VOCAB_SIZE).merge_table(spark)


@query("vocab_table", SQL_LEARN + f""",
      undo AS (SELECT list(symbol || pair ORDER BY rank DESC) AS steps FROM merges)
      SELECT (rank + 257)::INT AS token_id,
             list_reduce(steps, lambda t, m: replace(t, substr(m, 1, 1), substr(m, 2, 2)), symbol) AS token FROM merges, undo
      UNION ALL SELECT 0, '{pieces.END_OF_TEXT}'
      UNION ALL SELECT unnest(generate_series(1, 256))::INT, unnest({sql_list(sorted(pieces.BYTE_SYMBOLS))})""")
def vocab_table(spark, sf_dir):
    return learned(spark, sf_dir).table(spark)


@query("bpe_encode", SQL_LEARN + f""",
      apply AS (SELECT list(symbol || pair ORDER BY rank) AS steps FROM merges),
      coded AS (SELECT piece, list_transform(string_split(list_reduce(steps,
                  lambda t, m: replace(t, substr(m, 2, 2), substr(m, 1, 1)), sym), ''), lambda c: {sql_id("c")}) AS ids FROM bag, apply),
      placed AS (SELECT doc_id, unnest(generate_series(1, len(pieces))) AS pos, unnest(pieces) AS piece FROM split_up)
      SELECT doc_id, sum(len(ids))::INT AS n_ids, md5(string_agg(array_to_string(ids, ','), ',' ORDER BY pos)) AS ids_md5
      FROM placed JOIN coded USING (piece) GROUP BY doc_id""")
def bpe_encode(spark, sf_dir):
    coded_docs = bpe.encode(plain_documents(spark, sf_dir), vocabulary(spark, sf_dir))
    return coded_docs.select("doc_id", F.size("ids").alias("n_ids"), md5(joined("ids")).alias("ids_md5"))


# Every document as the ids of the learned vocabulary, 0 ending it; where it stands in its split's stream.
SQL_CODED = SQL_LEARN + f""",
      apply AS (SELECT list(symbol || pair ORDER BY rank) AS steps FROM merges),
      code AS (SELECT piece, list_transform(string_split(list_reduce(steps,
                 lambda t, m: replace(t, substr(m, 2, 2), substr(m, 1, 1)), sym), ''), lambda c: {sql_id("c")}) AS ids FROM bag, apply),
      spots AS (SELECT doc_id, unnest(generate_series(1, len(pieces))) AS pos, unnest(pieces) AS piece FROM split_up),
      coded AS (SELECT doc_id, list_append(flatten(list(ids ORDER BY pos)), 0) AS ids FROM spots JOIN code USING (piece) GROUP BY doc_id),
      indexed AS (SELECT (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS doc_index, doc_id, ids, len(ids)::BIGINT AS n_tokens FROM coded),
      divided AS (SELECT *, CASE WHEN doc_index % 20 = 0 THEN 'val' ELSE 'train' END AS split FROM indexed),
      placed AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY split ORDER BY doc_index
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM divided)"""

SQL_STREAM = SQL_CODED + """,
      flat AS (SELECT split, start + unnest(generate_series(0, len(ids) - 1)) AS loc, unnest(ids) AS id FROM placed)"""


@query("append_eot", SQL_CODED + """
      SELECT doc_id, len(ids)::INT AS n_ids, ids[-1]::INT AS last_id, md5(array_to_string(ids, ',')) AS ids_md5 FROM coded""")
def append_eot(spark, sf_dir):
    vocab = vocabulary(spark, sf_dir)
    docs = bpe.with_eot(bpe.encode(plain_documents(spark, sf_dir), vocab), vocab.eot_id)
    return docs.select("doc_id", F.size("ids").alias("n_ids"), F.get("ids", F.size("ids") - 1).alias("last_id"),
                       md5(joined("ids")).alias("ids_md5"))


@query("bpe_decode", "SELECT doc_id, md5(text) AS text_md5 FROM documents")
def bpe_decode(spark, sf_dir):
    vocab = vocabulary(spark, sf_dir)
    ids = bpe.with_eot(bpe.encode(table(spark, sf_dir, "documents"), vocab), vocab.eot_id)
    return bpe.decode(ids, vocab).select("doc_id", md5("decoded").alias("text_md5"))


@query("tokenizer_guard", "SELECT doc_id, TRUE AS same_ids FROM documents")
def tokenizer_guard(spark, sf_dir):
    """A second opening, which may not learn anew, codes every document alike."""
    first = vocabulary(spark, sf_dir)
    path = fresh_path(spark, "vocabulary")
    first.save(spark, path)
    again = bpe.ensure(spark, path, VOCAB_SIZE, required=True)
    if again.fingerprint != first.fingerprint:
        raise RuntimeError("the vocabulary changed between two openings")
    both = bpe.encode(bpe.encode(table(spark, sf_dir, "documents"), first), again, ids="again")
    return both.select("doc_id", (F.col("ids") == F.col("again")).alias("same_ids"))


# --- Indexing, splits, budgets, token tables -----------------------------------

@query("doc_index", """
      SELECT doc_id, (row_number() OVER (ORDER BY lang, doc_id) - 1)::BIGINT AS doc_index FROM documents WHERE text <> ''""")
def doc_index(spark, sf_dir):
    return tokens.with_doc_index(table(spark, sf_dir, "documents"), ["lang", "doc_id"]).select("doc_id", "doc_index")


@query("split_docs", SQL_CODED + " SELECT doc_id, doc_index, split FROM divided")
def split_docs(spark, sf_dir):
    return coded(spark, sf_dir).select("doc_id", "doc_index", "split")


@query("token_budget", SQL_CODED + """,
      total AS (SELECT sum(n_tokens) AS t FROM indexed)
      SELECT doc_id, split, start AS before FROM placed
      WHERE start < (SELECT CASE WHEN placed.split = 'val' THEN t // 50 ELSE t // 3 END FROM total)""")
def token_budget(spark, sf_dir):
    """A third of all tokens for training, a fiftieth for validation."""
    docs = coded(spark, sf_dir)
    total = docs.agg(F.sum("n_tokens")).first()[0]
    return tokens.cap(docs, {"train": total // 3, "val": total // 50}).select("doc_id", "split", "before")


@query("token_offsets", SQL_CODED + " SELECT doc_id, split, start FROM placed")
def token_offsets(spark, sf_dir):
    return tokens.offsets(coded(spark, sf_dir)).select("doc_id", "split", "start")


@query("token_range_check", SQL_CODED + """
      SELECT doc_id, max_id FROM (SELECT doc_id, (list_max(ids) * 180)::INT AS max_id FROM coded) WHERE max_id > 65535""")
def token_range_check(spark, sf_dir):
    """Ids stretched so that the later merges leave 16 bits."""
    docs = held_ids(spark, sf_dir).withColumn("ids", F.transform("ids", lambda i: i * 180))
    return tokens.check_u16(docs).select("doc_id", F.array_max("ids").alias("max_id"))


@query("token_chunks", SQL_STREAM + f"""
      SELECT split, loc // {CHUNK} AS chunk_id, count(*)::INT AS n_tokens, md5(string_agg(id::VARCHAR, ',' ORDER BY loc)) AS tokens_md5
      FROM flat GROUP BY ALL""")
def token_chunks(spark, sf_dir):
    return stream_chunks(spark, sf_dir).select("split", "chunk_id", F.size("tokens").alias("n_tokens"),
                                               md5(joined("tokens")).alias("tokens_md5"))


@query("sample_windows", SQL_STREAM + f""",
      size AS (SELECT sum(n_tokens)::BIGINT AS total FROM placed WHERE split = 'train'),
      starts AS (SELECT window_id, floor({sql_unit(str(SEED), "window_id")} * (total - {BLOCK} - 1))::BIGINT AS start
                 FROM size, LATERAL (SELECT unnest(generate_series(0, total // {BLOCK} - 1)) AS window_id)),
      spread AS (SELECT window_id, start, unnest(generate_series(0, {BLOCK})) AS i FROM starts),
      run AS (SELECT window_id, spread.start, i, id FROM spread JOIN flat ON flat.split = 'train' AND flat.loc = spread.start + i)
      SELECT window_id, start, md5(string_agg(id::VARCHAR, ',' ORDER BY i) FILTER (i < {BLOCK})) AS x_md5,
             md5(string_agg(id::VARCHAR, ',' ORDER BY i) FILTER (i > 0)) AS y_md5 FROM run GROUP BY ALL""")
def sample_windows(spark, sf_dir):
    """As many random windows as would cover the training stream once."""
    chunks = cut(stream_chunks(spark, sf_dir).where("split = 'train'"))
    total = chunks.agg(F.sum(F.size("tokens"))).first()[0]
    drawn = tokens.windows(chunks, total // BLOCK, BLOCK, SEED, CHUNK, total)
    return drawn.select("window_id", "start", md5(joined("x")).alias("x_md5"), md5(joined("y")).alias("y_md5"))


@query("split_summary", SQL_CODED + " SELECT split, count(*) AS n_docs, sum(n_tokens)::BIGINT AS n_tokens FROM divided GROUP BY split")
def split_summary(spark, sf_dir):
    return tokens.split_summary(coded(spark, sf_dir))


@query("progress_report", SQL_CODED + """
      SELECT * FROM (SELECT doc_index,
        (sum(CASE WHEN split = 'train' THEN n_tokens ELSE 0 END) OVER (ORDER BY doc_index))::BIGINT AS train_tokens,
        (sum(CASE WHEN split = 'val' THEN n_tokens ELSE 0 END) OVER (ORDER BY doc_index))::BIGINT AS val_tokens FROM divided)
      WHERE doc_index % 50 = 0 AND doc_index > 0""")
def progress_report(spark, sf_dir):
    return tokens.progress(coded(spark, sf_dir), every=50)


# --- Distilled corpus ----------------------------------------------------------

@query("prompt_plan", f'WITH {SQL_PLAN} SELECT plan_id, recipe, topic, audience, style, system, "user" FROM plan')
def prompt_plan(spark, sf_dir):
    return plan(spark, sf_dir)


@query("prompt_space", f"""
      WITH {SQL_PLAN},
      space AS (SELECT DISTINCT recipe, replace(replace(replace(template, '{{topic}}', topic), '{{audience}}', audience), '{{style}}', style) AS "user"
                FROM recipes, (SELECT unnest({sql_list(distill.TOPICS)}) AS topic), (SELECT unnest({sql_list(distill.AUDIENCES)}) AS audience),
                     (SELECT unnest({sql_list(distill.STYLES)}) AS style)),
      used AS (SELECT recipe, "user", count(*) AS n FROM plan GROUP BY ALL)
      SELECT recipe, "user", coalesce(n, 0)::BIGINT AS n_requests FROM space LEFT JOIN used USING (recipe, "user")""")
def prompt_space(spark, sf_dir):
    """How often a plan over all orders uses each prompt the pools can produce."""
    return distill.prompt_coverage(plan(spark, sf_dir))


@query("assign_teachers", f"WITH {SQL_ASSIGNED} SELECT plan_id, provider, model FROM assigned")
def assign_teachers(spark, sf_dir):
    return assigned(spark, sf_dir).select("plan_id", "provider", "model")


@query("parse_replies", f"WITH {SQL_REPLIES} SELECT conv_id, turn, content AS text FROM replies")
def parse_replies(spark, sf_dir):
    return distill.parse_replies(replies(spark, sf_dir)).select("conv_id", "turn", "text")


@query("reply_triage", f"""
      WITH {SQL_REPLIES}
      SELECT conv_id, turn,
        CASE WHEN status IS NULL THEN 'network' WHEN status = 200 AND content IS NOT NULL THEN 'accepted' WHEN status = 200 THEN 'unreadable'
             WHEN status IN (429, 500, 502, 503, 529) THEN 'busy' ELSE 'refused' END AS outcome,
        CASE WHEN status IS NULL THEN 15 WHEN status = 200 AND content IS NOT NULL THEN 0 WHEN status = 200 THEN 5
             WHEN status IN (429, 500, 502, 503, 529) THEN coalesce(TRY_CAST(retry_after AS INT), 60) ELSE 3600 END::INT AS cooldown_s
      FROM replies""")
def reply_triage(spark, sf_dir):
    return distill.triage(distill.parse_replies(replies(spark, sf_dir))).select("conv_id", "turn", "outcome", "cooldown_s")


@query("dry_run_corpus", f"WITH {SQL_DRY} SELECT plan_id, recipe, md5(text) AS text_md5, NULL::VARCHAR AS teacher FROM written")
def dry_run_corpus(spark, sf_dir):
    return distill.dry_run(assigned(spark, sf_dir)).select("plan_id", "recipe", md5("text").alias("text_md5"), "teacher")


@query("resume_plan", f"""
      WITH {SQL_PLAN}, todo AS (SELECT plan_id, recipe, row_number() OVER (ORDER BY plan_id) AS nr FROM plan WHERE recipe NOT IN ('story', 'howto'))
      SELECT plan_id, recipe FROM todo WHERE nr <= (SELECT count(*) * 3 // 4 FROM plan) - (SELECT count(*) FROM plan WHERE recipe IN ('story', 'howto'))""")
def resume_plan(spark, sf_dir):
    """Stories and guides are there; three quarters of the plan are wanted."""
    wanted = plan(spark, sf_dir)
    done = wanted.where(F.col("recipe").isin("story", "howto"))
    return distill.remaining(wanted, done, wanted.count() * 3 // 4).select("plan_id", "recipe")


@query("corpus_report", f"""
      WITH {SQL_DRY}
      SELECT recipe, model AS teacher, grouping(recipe, model)::INT AS level, count(*) AS n_docs, sum(length(text))::BIGINT AS n_chars,
             (sum(length(text)) // count(*))::BIGINT AS mean_chars, (sum(length(text)) // 4)::BIGINT AS est_tokens
      FROM written GROUP BY ROLLUP (recipe, model)""")
def corpus_report(spark, sf_dir):
    return distill.corpus_report(distill.dry_run(assigned(spark, sf_dir)).withColumn("teacher", F.col("model")))


@query("corpus_report_texts", """
      SELECT lang AS recipe, source AS teacher, grouping(lang, source)::INT AS level, count(*) AS n_docs, sum(length(text))::BIGINT AS n_chars,
             (sum(length(text)) // count(*))::BIGINT AS mean_chars, (sum(length(text)) // 4)::BIGINT AS est_tokens
      FROM documents GROUP BY ROLLUP (lang, source)""")
def corpus_report_texts(spark, sf_dir):
    """The report over documents, a language as recipe and a source as teacher."""
    return distill.corpus_report(table(spark, sf_dir, "documents").withColumnsRenamed({"lang": "recipe", "source": "teacher"}))


# --- Candidate filters ---------------------------------------------------------

@query("penalise_seen", f"""
      WITH {SQL_SCORES}, seen AS (SELECT DISTINCT l_suppkey AS "group", l_partkey AS item, 1 AS s FROM lineitem WHERE l_returnflag = 'R')
      SELECT "group", item, CASE WHEN s IS NULL THEN score WHEN score > 0 THEN score / 1.3 ELSE score * 1.3 END AS score
      FROM scores LEFT JOIN seen USING ("group", item)""")
def penalise_seen(spark, sf_dir):
    seen = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(
        F.col("l_suppkey").alias("group"), F.col("l_partkey").alias("item"))
    return candidates.penalise(scores(spark, sf_dir), seen, 1.3)


SQL_PROB = SQL_SCORES + """,
      probs AS (SELECT *, exp(score / 0.8 - max(score / 0.8) OVER (PARTITION BY "group")) AS e FROM scores),
      soft AS (SELECT "group", item, score, e / sum(e) OVER (PARTITION BY "group") AS prob FROM probs)"""


@query("group_softmax", f'WITH {SQL_PROB} SELECT "group", item, round(prob, 9) AS prob FROM soft')
def group_softmax(spark, sf_dir):
    return candidates.softmax(scores(spark, sf_dir), 0.8).select("group", "item", F.round("prob", 9).alias("prob"))


@query("group_top_k", """
      WITH q AS (SELECT l_suppkey AS "group", l_partkey AS item, max(l_quantity) AS score FROM lineitem GROUP BY ALL)
      SELECT "group", item, score FROM (SELECT *, rank() OVER (PARTITION BY "group" ORDER BY score DESC) AS r FROM q) WHERE r <= 10""")
def group_top_k(spark, sf_dir):
    """Quantities are whole numbers up to 50, so many items tie with the tenth."""
    return candidates.top_k(scores(spark, sf_dir, F.max("l_quantity")), 10)


@query("group_nucleus", f"""
      WITH {SQL_SCORES},
      probs AS (SELECT *, exp(score - max(score) OVER (PARTITION BY "group")) AS e FROM scores),
      soft AS (SELECT *, e / sum(e) OVER (PARTITION BY "group") AS prob FROM probs),
      ranked AS (SELECT *, coalesce(sum(prob) OVER (PARTITION BY "group" ORDER BY score DESC, item
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM soft)
      SELECT "group", item, round(score, 9) AS score FROM ranked WHERE before <= 0.9""")
def group_nucleus(spark, sf_dir):
    return candidates.nucleus(scores(spark, sf_dir), 0.9).select("group", "item", F.round("score", 9).alias("score"))


@query("group_argmax", f"""
      WITH {SQL_SCORES} SELECT "group", item, round(score, 9) AS score FROM
        (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY score DESC, item) AS r FROM scores) WHERE r = 1""")
def group_argmax(spark, sf_dir):
    return candidates.argmax(scores(spark, sf_dir)).select("group", "item", F.round("score", 9).alias("score"))


@query("group_pick", f"""
      WITH {SQL_PROB},
      noisy AS (SELECT *, ln(prob) - ln(-ln({sql_unit(str(SEED), '"group"', "item")})) AS k FROM soft)
      SELECT "group", item FROM (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY k DESC, item) AS r FROM noisy) WHERE r = 1""")
def group_pick(spark, sf_dir):
    return candidates.pick(candidates.softmax(scores(spark, sf_dir), 0.8), SEED)


# --- Retention -----------------------------------------------------------------

@query("latest_artifact", f"WITH {SQL_LISTING} SELECT prefix, max(step) AS step, arg_max(path, step) AS path FROM listing GROUP BY prefix")
def latest_artifact(spark, sf_dir):
    return retention.latest(listing(spark, sf_dir))


@query("retention_plan", f"""
      WITH {SQL_LISTING} SELECT path, prefix, step,
        CASE WHEN row_number() OVER (PARTITION BY prefix ORDER BY step DESC) <= 8 THEN 'keep' ELSE 'delete' END AS action FROM listing""")
def retention_plan(spark, sf_dir):
    return retention.retention(listing(spark, sf_dir), 8).select("path", "prefix", "step", "action")


# --- Sinks, read back ----------------------------------------------------------

@query("jsonl_sink", f"WITH {SQL_DRY} SELECT md5(text) AS text_md5, recipe, NULL::VARCHAR AS teacher FROM written")
def jsonl_sink(spark, sf_dir):
    path = fresh_path(spark, "corpus")
    # A dry run repeats its prompts, so its lines shrink to a small part; no file holds more than one task wrote.
    jsonl.write_jsonl(distill.dry_run(assigned(spark, sf_dir)).select("text", "recipe", "teacher"), path, "gzip")
    back = jsonl.parse_jsonl(spark.read.text(path), "text string, recipe string, teacher string")
    return back.select(md5("text").alias("text_md5"), "recipe", "teacher")


@query("jsonl_sink_texts", """
      SELECT doc_id, lang, CASE WHEN doc_id % 3 > 0 THEN source END AS source, md5(text) AS text_md5 FROM documents""")
def jsonl_sink_texts(spark, sf_dir):
    """Documents written as lines, some fields null, and read back."""
    path = fresh_path(spark, "corpus")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.when(F.col("doc_id") % 3 > 0, F.col("source")).alias("source"), "text")
    jsonl.write_jsonl(docs, path)
    back = jsonl.parse_jsonl(spark.read.text(path), "doc_id long, lang string, source string, text string")
    return back.select("doc_id", "lang", "source", md5("text").alias("text_md5"))


@query("token_sink", SQL_STREAM + f"""
      SELECT split, loc // {CHUNK} AS chunk_id, count(*)::INT AS n_tokens, md5(string_agg(id::VARCHAR, ',' ORDER BY loc)) AS tokens_md5
      FROM flat GROUP BY ALL""")
def token_sink(spark, sf_dir):
    path = fresh_path(spark, "tokens")
    chunks = stream_chunks(spark, sf_dir)
    if not sinks.write_tokens(chunks, path) or sinks.write_tokens(chunks, path):
        raise RuntimeError("a token table is written once")
    return spark.read.parquet(path).select("split", F.col("chunk_id").cast("bigint").alias("chunk_id"),
                                           F.size("tokens").alias("n_tokens"), md5(joined("tokens")).alias("tokens_md5"))


@query("u16_export", SQL_STREAM + f"""
      SELECT split, loc // {CHUNK * 64} AS shard_id, min(loc) AS start, count(*)::BIGINT AS n_tokens,
             md5(string_agg(id::VARCHAR, ',' ORDER BY loc)) AS tokens_md5 FROM flat GROUP BY ALL""")
def u16_export(spark, sf_dir):
    """Shards of 64 chunks: the manifest, joined with what the files hold."""
    path = fresh_path(spark, "shards")
    manifest = sinks.export_u16(stream_chunks(spark, sf_dir), path, CHUNK, 64)
    files = sinks.read_u16(spark, path).select("split", "shard_id", md5(joined("tokens")).alias("tokens_md5"))
    return manifest.join(files, ["split", "shard_id"]).select("split", "shard_id", "start", "n_tokens", "tokens_md5")


@query("prepare_tokens", SQL_CODED + f""",
      kept AS (SELECT split, start, ids FROM placed, (SELECT sum(length(text)) AS chars FROM plain)
               WHERE start < CASE split WHEN 'val' THEN chars // 100 ELSE chars // 6 END),
      flat AS (SELECT split, start + unnest(generate_series(0, len(ids) - 1)) AS loc, unnest(ids) AS id FROM kept)
      SELECT split, loc // {CHUNK} AS chunk_id, count(*)::INT AS n_tokens, md5(string_agg(id::VARCHAR, ',' ORDER BY loc)) AS tokens_md5
      FROM flat GROUP BY ALL""")
def prepare_tokens(spark, sf_dir):
    """The whole preparation with ids of the learned vocabulary: a sixth and a hundredth of the characters as caps."""
    docs, out = plain_documents(spark, sf_dir), fresh_path(spark, "prepared")
    chars = docs.agg(F.sum(F.char_length("text"))).first()[0]
    args = dict(key="doc_id", order=["doc_id"], size=CHUNK, caps={"train": chars // 6, "val": chars // 100})
    vocab = vocabulary(spark, sf_dir)
    if not prepare.prepare(docs, vocab, out, **args) or prepare.prepare(docs, vocab, out, **args):
        raise RuntimeError("a token table is prepared once")
    return spark.read.parquet(out).select("split", F.col("chunk_id").cast("bigint").alias("chunk_id"),
                                          F.size("tokens").alias("n_tokens"), md5(joined("tokens")).alias("tokens_md5"))


@query("validation_windows", SQL_STREAM + f""",
      size AS (SELECT sum(n_tokens)::BIGINT AS total FROM placed WHERE split = 'val'),
      starts AS (SELECT window_id, floor({sql_unit(str(SEED), "window_id")} * (total - {BLOCK} - 1))::BIGINT AS start
                 FROM size, LATERAL (SELECT unnest(generate_series(0, total // {BLOCK} - 1)) AS window_id)),
      spread AS (SELECT window_id, start, unnest(generate_series(0, {BLOCK})) AS i FROM starts),
      run AS (SELECT window_id, spread.start, i, id FROM spread JOIN flat ON flat.split = 'val' AND flat.loc = spread.start + i)
      SELECT window_id, start, md5(string_agg(id::VARCHAR, ',' ORDER BY i) FILTER (i < {BLOCK})) AS x_md5,
             md5(string_agg(id::VARCHAR, ',' ORDER BY i) FILTER (i > 0)) AS y_md5 FROM run GROUP BY ALL""")
def validation_windows(spark, sf_dir):
    """As many random windows as would cover the validation stream once."""
    chunks = cut(stream_chunks(spark, sf_dir).where("split = 'val'"))
    total = chunks.agg(F.sum(F.size("tokens"))).first()[0]
    drawn = tokens.windows(chunks, total // BLOCK, BLOCK, SEED, CHUNK, total)
    return drawn.select("window_id", "start", md5(joined("x")).alias("x_md5"), md5(joined("y")).alias("y_md5"))


@query("prompt_ids", SQL_LEARN + f""",
      apply AS (SELECT list(symbol || pair ORDER BY rank) AS steps FROM merges),
      asked AS (SELECT conv_id, turn, regexp_extract_all(trim(regexp_replace(text, '{WHITE}', ' ', 'g')), '{RE2_PIECES.replace("'", "''")}') AS pieces
                FROM conversations),
      spots AS (SELECT conv_id, turn, unnest(generate_series(1, len(pieces))) AS pos, unnest(pieces) AS piece FROM asked),
      spelt AS (SELECT piece, array_to_string(list_transform(regexp_extract_all(hex(encode(piece)), '..'),
                  lambda h: ({sql_list(pieces.BYTE_SYMBOLS)})[('0x' || h)::INT + 1]), '') AS sym FROM (SELECT DISTINCT piece FROM spots)),
      code AS (SELECT piece, list_transform(string_split(list_reduce(steps,
                 lambda t, m: replace(t, substr(m, 2, 2), substr(m, 1, 1)), sym), ''), lambda c: {sql_id("c")}) AS ids FROM spelt, apply)
      SELECT conv_id, turn, (sum(len(ids)) + 1)::INT AS n_ids, md5('0,' || string_agg(array_to_string(ids, ','), ',' ORDER BY pos)) AS ids_md5
      FROM spots JOIN code USING (piece) GROUP BY conv_id, turn""")
def prompt_ids(spark, sf_dir):
    """Every turn as the ids of a fresh prompt, by the vocabulary learned from documents."""
    said = table(spark, sf_dir, "conversations").withColumn("text", F.trim(F.regexp_replace("text", r"[\p{IsWhite_Space}]+", " ")))
    vocab = vocabulary(spark, sf_dir)
    framed = templates.frame_prompt_ids(bpe.encode(said, vocab), vocab.eot_id)
    return framed.select("conv_id", "turn", F.size("ids").alias("n_ids"), md5(joined("ids")).alias("ids_md5"))


@query("jsonl_files", """
      SELECT (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS ord, doc_id, lang, md5(text) AS text_md5 FROM documents""")
def jsonl_files(spark, sf_dir):
    """Documents in the order of their lines in files that also hold blank and broken lines."""
    path = fresh_path(spark, "lines")
    good = F.to_json(F.struct("doc_id", "lang", "text"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    files = max(4, -(-docs.count() // WIDE_ROWS_PER_RANGE))
    (docs.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id")
     .select(F.explode(F.array(good, F.lit(" "), F.concat(F.lit("{"), good), F.lit("[1]"))).alias("value")).write.text(path))
    return jsonl.read_jsonl(spark, path, "doc_id long, lang string, text string").select("ord", "doc_id", "lang", md5("text").alias("text_md5"))


@query("stream_lines", """
      WITH indexed AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id % 3, doc_id) - 1)::BIGINT AS doc_index,
                              length(text)::BIGINT AS n_tokens FROM documents WHERE text <> ''),
      divided AS (SELECT *, CASE WHEN doc_index % 20 = 0 THEN 'val' ELSE 'train' END AS split FROM indexed)
      SELECT doc_id, doc_index, split, n_tokens, coalesce(sum(n_tokens) OVER (PARTITION BY split ORDER BY doc_index
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM divided""")
def stream_lines(spark, sf_dir):
    """Files of JSON lines that arrive in three lots, one after another, numbered over three batches through the ledger."""
    folder, out, state = fresh_path(spark, "arriving"), fresh_path(spark, "stream"), fresh_path(spark, "offsets")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    for part in range(3):
        # What arrives at a time is as many files as tasks wrote; the stream takes up again where it was and makes one batch of them.
        docs.where(F.col("doc_id") % 3 == part).write.mode("append").json(folder)
        rows = corpus_stream.open_stream(spark, folder, "doc_id long, text string", glob="*.json")
        sized = rows.withColumn("n_tokens", F.char_length("text").cast("bigint"))
        corpus_stream.start_indexed(sized, out, state, ["doc_id"]).awaitTermination()
    return spark.read.parquet(f"{out}/docs").select("doc_id", "doc_index", "split", "n_tokens", "start")


# --- Flagship ------------------------------------------------------------------

def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted blend of four sources, held-out split, documents and characters per split."""
    docs = by_language(spark, sf_dir)
    sizes = docs.select("source_id", "ord", F.char_length("text").alias("n_tokens"))  # texts take no part in the join
    return tokens.split_summary(tokens.split(mix.blend_order(docs, WEIGHTS, SEED)).join(sizes, ["source_id", "ord"]))


query("mix_split_summary", sql_mix(WEIGHTS) + """
      SELECT CASE WHEN doc_index % 20 = 0 THEN 'val' ELSE 'train' END AS split, count(*) AS n_docs,
             sum(length(text))::BIGINT AS n_tokens FROM placed GROUP BY ALL""")(flagship)
