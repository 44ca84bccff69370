import pytest
from pyspark.sql import functions as F

from quern.operators import distill as d


def test_recipes():
    assert d.known_recipes(["story", "nope", " qa_reason "]) == ["story", "qa_reason"]
    assert len(d.known_recipes(None)) == 5 and len(d.TOPICS) == 40
    with pytest.raises(ValueError):
        d.known_recipes(["nope"])


def test_plan_and_space(spark):
    plan = d.plan_prompts(spark.range(4000).withColumnRenamed("id", "plan_id"), seed=3)
    rows = plan.collect()
    assert not any("{" in r.user for r in rows)
    assert {r.recipe for r in rows} == set(d.RECIPES)
    assert all(r.topic in r.user and r.audience in r.user and (r.style in r.user) == (r.recipe == "textbook") for r in rows)
    space = d.prompt_space(spark)
    assert space.count() == 1800 and d.prompt_space(spark, ["story"]).count() == 200
    assert plan.join(space, ["recipe", "system", "user"], "left_anti").count() == 0
    cover = d.prompt_coverage(plan)
    assert cover.count() == 1800 and cover.agg(F.sum("n_requests")).first()[0] == 4000


def test_teachers(spark):
    spec = "groq:a/b:free, a/b:free,, openrouter:x ,unknown:y"
    teachers = d.parse_teachers(spec)
    assert teachers == [("groq", "a/b:free"), ("groq", "a/b:free"), ("openrouter", "x"), ("groq", "unknown:y")]
    assert d.parse_teachers("m", "openrouter") == [("openrouter", "m")]
    with pytest.raises(ValueError):
        d.parse_teachers(" , ")
    got = d.assign(spark.range(9).withColumnRenamed("id", "plan_id"), teachers).collect()
    assert all((r.provider, r.model) == teachers[r.plan_id % 4] for r in got)


def test_replies(spark):
    body = '{"id": 1, "choices": [{"index": 0, "message": {"role": "assistant", "content": %s}}]}'
    rows = [
        ("ok", 200, None, body % '"\\n hi \\u3000"', "accepted", 0),
        ("empty", 200, None, body % '"  "', "accepted", 0),
        ("null content", 200, None, body % "null", "unreadable", 5),
        ("broken", 200, "9", '{"choices": [', "unreadable", 5),
        ("no choice", 200, None, '{"choices": []}', "unreadable", 5),
        ("no body", 200, None, None, "unreadable", 5),
        ("busy", 429, "17", None, "busy", 17),
        ("busy no header", 429, None, None, "busy", 60),
        ("busy bad header", 529, "soon", None, "busy", 60),
        ("server", 503, "0", body % '"x"', "busy", 0),
        ("gone", 404, "9", None, "refused", 3600),
        ("network", None, None, None, "network", 15),
    ]
    df = spark.createDataFrame([r[:4] for r in rows], "k string, status int, retry_after string, body string")
    got = {r.k: r for r in d.triage(d.parse_replies(df)).collect()}
    for k, _, _, _, outcome, cooldown in rows:
        assert (got[k].outcome, got[k].cooldown_s) == (outcome, cooldown), k
    assert got["ok"].text == "hi" and got["empty"].text == "" and got["broken"].text is None


def test_dry_run_and_report(spark):
    plan = spark.createDataFrame([(0, "story", "m1", "u"), (1, "story", "m2", "uu"), (2, "howto", "m1", "u")],
                                 "plan_id int, recipe string, model string, user string")
    docs = d.dry_run(plan)
    assert docs.where("plan_id = 0").first()["text"] == "[dry-run/story/m1] u " * 8
    assert docs.where("teacher is not null").count() == 0
    report = {(r.recipe, r.teacher, r.level): r for r in
              d.corpus_report(docs.withColumn("teacher", F.col("model"))).collect()}
    chars = [len(r.text) for r in docs.orderBy("plan_id").collect()]
    assert report[(None, None, 3)].n_docs == 3 and report[(None, None, 3)].est_tokens == sum(chars) // 4
    assert report[("story", None, 1)].mean_chars == (chars[0] + chars[1]) // 2
    assert report[("howto", "m1", 0)].n_chars == chars[2]


@pytest.mark.parametrize("ranges", [{}, {"rows_per_range": 10}])
def test_resume(spark, ranges):
    plan = spark.range(100).withColumnRenamed("id", "plan_id")
    done = plan.where("plan_id % 3 = 0")
    left = [i for i in range(100) if i % 3]
    for target, want in ((50, left[:16]), (34, []), (10, []), (1000, left)):
        assert sorted(r.plan_id for r in d.remaining(plan, done, target, **ranges).collect()) == want


def test_a_header_may_be_called_as_it_is(spark):
    df = spark.createDataFrame([(429, None, "7"), (429, None, "soon")], "status int, text string, `retry-after` string")
    assert [r.cooldown_s for r in d.triage(df, retry_after="retry-after").collect()] == [7, 60]
