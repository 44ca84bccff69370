"""Planning prompts for teacher models, triaging their replies, reporting the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.draw import choice
from quern.functions.text import strip
from quern.plans.prefix import dense_rank_from_zero
from quern.plans.stage import cut

# The pools and recipes prompts are drawn from.
TOPICS = [
    "how rainbows form", "why the sky is blue", "the water cycle", "how plants make food",
    "the life of a honeybee", "how computers store numbers", "what makes a bridge strong",
    "why ice floats", "how the heart pumps blood", "the phases of the moon", "how magnets work",
    "what causes the seasons", "how sound travels", "why we dream", "how a seed becomes a tree",
    "the basics of fractions", "how to compare two numbers", "what a prime number is",
    "how volcanoes erupt", "why leaves change color", "how birds fly", "the parts of a story",
    "how to make a simple budget", "what gravity does", "how a battery works", "the food chain",
    "how rain is measured", "what an ecosystem is", "how to solve a simple word problem",
    "why we need sleep", "how a rocket lifts off", "what friction is", "how shadows are made",
    "the idea of cause and effect", "how to write a clear paragraph", "what a fraction of a pizza means",
    "how bees help flowers", "why exercise is good for you", "how a thermometer works",
    "the difference between weather and climate",
]
AUDIENCES = [
    "a curious 8-year-old", "a 12-year-old student", "a high-school beginner",
    "a complete beginner adult", "a hobbyist who likes clear explanations",
]
STYLES = [
    "a clear, self-contained textbook passage", "an engaging explainer with a real example",
    "a short story that gently teaches the idea", "a friendly step-by-step walkthrough",
    "a question-and-answer that thinks out loud",
]
RECIPES = {
    "textbook": (
        "You are an expert educator. You write clear, accurate, self-contained explanations "
        "in simple language. No preamble, no meta-commentary -- output only the passage.",
        "Write {style} for {audience} about: {topic}. Be concrete, include one simple example, "
        "and explain the reasoning step by step. About 250-450 words.",
    ),
    "qa_reason": (
        "You write question-and-answer pairs that demonstrate careful, step-by-step reasoning. "
        "Output exactly in the form 'Question: ...' then 'Answer: ...'.",
        "Pose a thoughtful question about {topic} suitable for {audience}, then answer it by "
        "reasoning step by step and explaining WHY each step follows. About 200-350 words.",
    ),
    "story": (
        "You are a skilled children's author. Output only the story -- no title, no notes.",
        "Write a short, vivid, COMPLETE story (about 250 words) that naturally involves "
        "{topic}. It should make sense from beginning to end and be suitable for {audience}.",
    ),
    "howto": (
        "You write practical, numbered how-to guides in plain language. Output only the guide.",
        "Write a simple step-by-step guide for {audience} explaining {topic}. Number the steps "
        "and end with one short 'why this works' sentence. About 200-350 words.",
    ),
    "dialogue": (
        "You write short, informative dialogues where a curious learner asks and a patient "
        "teacher explains. Output only the dialogue.",
        "Write a short dialogue where {audience} asks about {topic} and a teacher explains it "
        "clearly with an example. About 200-350 words.",
    ),
}
PROVIDERS = ("groq", "openrouter")
BUSY_STATUSES = (429, 500, 502, 503, 529)
UNREADABLE_SECONDS, BUSY_SECONDS, REFUSED_SECONDS, NETWORK_SECONDS = 5, 60, 3600, 15
DRY_RUN_REPEATS = 8
CHARS_PER_TOKEN = 4

REPLY_SCHEMA = "choices array<struct<message: struct<content: string>>>"


def known_recipes(names: list[str] | None) -> list[str]:
    """The names that exist, in the order given; none left is an error."""
    if names is None:
        return list(RECIPES)
    kept = [n.strip() for n in names if n.strip() in RECIPES]
    if not kept:
        raise ValueError(f"none of {names} is a recipe; there are {list(RECIPES)}")
    return kept


def _by_recipe(names: list[str], part: int) -> Column:
    out = None
    for n in names:
        text = F.lit(RECIPES[n][part])
        out = F.when(F.col("recipe") == n, text) if out is None else out.when(F.col("recipe") == n, text)
    return out


def _rendered(template: Column) -> Column:
    for slot in ("topic", "audience", "style"):
        template = F.replace(template, F.lit("{" + slot + "}"), F.col(slot))
    return template


def plan_prompts(requests: DataFrame, request: str = "plan_id", recipes: list[str] | None = None,
                 seed: int = 0) -> DataFrame:
    """One prompt per request id: recipe, topic, audience and style by seeded draw."""
    names = known_recipes(recipes)
    picks = {"recipe": names, "topic": TOPICS, "audience": AUDIENCES, "style": STYLES}
    drawn = requests.withColumns({k: choice(v, seed, k, F.col(request)) for k, v in picks.items()})
    return drawn.withColumns({"system": _by_recipe(names, 0), "user": _rendered(_by_recipe(names, 1))})


def prompt_space(spark, recipes: list[str] | None = None) -> DataFrame:
    """Every distinct (recipe, system, user) the pools can produce."""
    names = known_recipes(recipes)
    pools = spark.range(1)
    for col, values in {"recipe": names, "topic": TOPICS, "audience": AUDIENCES, "style": STYLES}.items():
        pools = pools.withColumn(col, F.explode(F.array(*[F.lit(v) for v in values])))
    return (pools.select("recipe", _by_recipe(names, 0).alias("system"), _rendered(_by_recipe(names, 1)).alias("user"))
            .distinct())


def prompt_coverage(plan: DataFrame) -> DataFrame:
    """How often a plan uses each distinct prompt of its recipes' space, zero included."""
    drawn = plan.groupBy("recipe", "user").agg(F.count("*").alias("n_requests"))
    space = prompt_space(plan.sparkSession).select("recipe", "user")
    return (space.join(drawn, ["recipe", "user"], "left")
            .withColumn("n_requests", F.coalesce("n_requests", F.lit(0).cast("bigint"))))


def parse_teachers(specs: str, default_provider: str = PROVIDERS[0]) -> list[tuple[str, str]]:
    """(provider, model) per comma-separated ``[provider:]model``; models may hold colons."""
    out = []
    for spec in filter(None, (s.strip() for s in specs.split(","))):
        head, colon, rest = spec.partition(":")
        out.append((head, rest) if colon and head in PROVIDERS else (default_provider, spec))
    if not out:
        raise ValueError("no teachers given")
    return out


def assign(df: DataFrame, teachers: list[tuple[str, str]], row: str = "plan_id") -> DataFrame:
    """Rotate requests over the teachers by their dense row number."""
    pool = F.array(*[F.struct(F.lit(p).alias("provider"), F.lit(m).alias("model")) for p, m in teachers])
    return (df.withColumn("_teacher", F.get(pool, F.pmod(row, F.lit(len(teachers))).cast("int")))
            .withColumns({"provider": F.col("_teacher.provider"), "model": F.col("_teacher.model")})
            .drop("_teacher"))


def parse_replies(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``text``: the stripped content of a reply body's first choice, null if unreadable."""
    reply = F.from_json(F.col(body), REPLY_SCHEMA)
    return df.withColumn("text", strip(F.get(reply["choices"], F.lit(0))["message"]["content"]))


def triage(df: DataFrame, status: str = "status", text: str = "text", retry_after: str = "retry_after") -> DataFrame:
    """Add ``outcome`` and ``cooldown_s`` per stored reply; a null status is a network error."""
    code = F.col(status)
    wait = F.coalesce(F.col(f"`{retry_after}`").try_cast("int"), F.lit(BUSY_SECONDS))

    def cases(network, accepted, unreadable, busy, refused) -> Column:
        return (F.when(code.isNull(), network)
                .when((code == 200) & F.col(text).isNotNull(), accepted)
                .when(code == 200, unreadable)
                .when(code.isin(*BUSY_STATUSES), busy)
                .otherwise(refused))

    return df.withColumns({
        "outcome": cases(*map(F.lit, ("network", "accepted", "unreadable", "busy", "refused"))),
        "cooldown_s": cases(F.lit(NETWORK_SECONDS), F.lit(0), F.lit(UNREADABLE_SECONDS), wait, F.lit(REFUSED_SECONDS)),
    })


def dry_run(plan: DataFrame) -> DataFrame:
    """Stand-in documents for an assigned plan: tag and prompt, repeated; teacher null."""
    tag = F.concat(F.lit("[dry-run/"), "recipe", F.lit("/"), "model", F.lit("] "), "user", F.lit(" "))
    return plan.withColumns({"text": F.repeat(tag, F.lit(DRY_RUN_REPEATS)),
                             "teacher": F.lit(None).cast("string")})


def remaining(plan: DataFrame, corpus: DataFrame, target: int, request: str = "plan_id", **ranges) -> DataFrame:
    """The next requests to send so that the corpus reaches ``target`` documents."""
    missing = max(0, target - corpus.count())
    # Ids alone are compared and ranked, and written once; the plan meets them in one join.
    todo = cut(plan.select(request).join(corpus.select(request), request, "left_anti"))
    ids = dense_rank_from_zero(todo, "_at", [request], ceilings={"_at": F.lit(missing)}, **ranges)
    return plan.join(ids.drop("_at"), request, "left_semi")


def corpus_report(df: DataFrame) -> DataFrame:
    """Documents, mean characters and estimated tokens per recipe and teacher, with totals.

    ``level`` is 0 for a (recipe, teacher) row, 1 for a recipe total, 3 for the total.
    """
    per_pair = (df.groupBy("recipe", "teacher")
                .agg(F.count("*").alias("n"), F.sum(F.char_length("text").cast("bigint")).alias("chars")))
    return (per_pair.rollup("recipe", "teacher")
            .agg(F.grouping_id().cast("int").alias("level"), F.sum("n").alias("n_docs"), F.sum("chars").alias("n_chars"))
            .withColumns({"mean_chars": F.expr("n_chars div n_docs"),
                          "est_tokens": F.expr(f"n_chars div {CHARS_PER_TOKEN}")}))
