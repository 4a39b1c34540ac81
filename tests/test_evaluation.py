import math

import pytest
from pyspark.sql import functions as F

from finetide.operators import evaluation as ev
from finetide.operators import rl


def test_perplexity_weighs_predicted_tokens(spark):
    scores = spark.createDataFrame([(0, 2.0, 11), (1, 1.0, 31), (2, 99.0, 1), (3, None, 0)], "id int, loss double, n_tokens int")
    row = ev.perplexity(scores).collect()[0]
    assert row["avg_loss"] == pytest.approx((2.0 * 10 + 1.0 * 30) / 40)
    assert row["perplexity"] == pytest.approx(math.exp(row["avg_loss"]))
    assert ev.perplexity(scores.limit(0)).collect() == [(1.0, 0.0)]


def test_generation_quality_counts_failures(spark):
    outputs = spark.createDataFrame([(0, "a b c"), (1, None), (2, " ")], "id int, output string")
    assert ev.generation_quality(outputs).collect() == [(1.0, 3)]
    assert ev.generation_quality(outputs.limit(0)).collect() == [(0.0, 0)]


def test_instruction_following(spark):
    outputs = spark.createDataFrame([(0, "Response: " + "x" * 300), (1, "no"), (2, None)], "id int, output string")
    checks = {r["id"]: (r["passed"], len(r["sample_output"])) for r in ev.instruction_checks(outputs).collect()}
    assert checks == {0: (True, 200), 1: (False, 2), 2: (False, 0)}
    row = ev.instruction_following(outputs).collect()[0]
    assert row["passed"] is False and row["pass_rate"] == pytest.approx(1 / 3)


def suite(spark, rows, names, **kw):
    def score(texts):
        return texts.select("id", F.lit(0.5).alias("loss"), F.size(F.split("text", " ")).alias("n_tokens"))

    def write(texts):
        return texts.select("id", F.concat("text", F.lit(" more")).alias("output"))

    table = ev.run_benchmarks(rows, "id", names, score, write, **kw)
    return {(r["bench"], r["metric"]): r["value"] if r["error"] is None else r["error"] for r in table.collect()}


def test_suite_samples_defaults_and_errors(spark):
    rows = spark.range(100).select("id", F.lit("one two three").alias("text"))
    got = suite(spark, rows, ["perplexity", "generation_quality", "instruction_following", "nope"])
    assert got[("perplexity", "avg_loss")] == 0.5
    assert got[("generation_quality", "num_samples")] == 5.0
    assert got[("generation_quality", "avg_output_length")] == 4.0
    assert got[("instruction_following", "passed")] == 1.0
    assert got[("nope", None)] == "Unknown benchmark: nope"
    assert suite(spark, rows, ["generation_quality"], max_samples=50)[("generation_quality", "num_samples")] == 50.0


def test_suite_takes_more_benchmarks(spark):
    rows = spark.range(10).select("id", F.lit("t").alias("text"))
    got = suite(spark, rows, ["size"], more={"size": lambda: rows.agg(F.count("*").alias("n"))})
    assert got == {("size", "n"): 10.0}


def test_suite_without_texts_uses_the_default_ones(spark):
    empty = spark.range(5).select("id", F.lit("  ").alias("text"))
    got = suite(spark, empty, ["generation_quality"])
    assert got[("generation_quality", "num_samples")] == len(ev.DEFAULT_PROMPTS)
    got = suite(spark, empty, ["generation_quality"], max_samples=1)
    assert got[("generation_quality", "num_samples")] == 1


def test_flatten_keeps_numbers_and_booleans(spark):
    df = spark.sql("select 1 as run, map('p', map('x', '1.5', 's', 'text', 't', 'true'), 'q', map('f', 'False')) as m")
    got = {r["name"]: r["value"] for r in ev.flatten_metrics(df, "m", "run").collect()}
    assert got == {"p_x": 1.5, "p_t": 1.0, "q_f": 0.0}


def test_merge_prefers_the_new(spark):
    df = spark.sql("select map('a', 1.0D, 'eval_b', 2.0D) as old, map('b', 3.0D, 'c', 4.0D) as new")
    df = df.unionByName(spark.sql("select map('a', 1.0D) as old, cast(null as map<string,double>) as new"))
    merged = [r[0] for r in df.select(ev.merge_metrics(F.col("old"), F.col("new"))).collect()]
    assert merged == [{"a": 1.0, "eval_b": 3.0, "eval_c": 4.0}, {"a": 1.0}]


def test_metrics_are_written(spark, tmp_path):
    rows = spark.createDataFrame([("b", "m", 1.0, None)], ev.METRICS_SCHEMA)
    ev.write_metrics(rows, str(tmp_path / "m"))
    assert spark.read.schema(ev.METRICS_SCHEMA).json(str(tmp_path / "m")).collect() == rows.collect()


def test_rewards(spark):
    texts = spark.createDataFrame([("w " * 25,), ("w " * 80,), (None,), ("",)], "c string")
    assert [r["reward"] for r in rl.reward_length(texts, "c").collect()] == [0.5, 1.0, 0.02, 0.0]
    chats = spark.createDataFrame([([("user", "a b")],), ([],), (None,)], "c array<struct<role:string,content:string>>")
    assert [r["reward"] for r in rl.reward_length(chats, "c").collect()] == [0.04, 0.02, 0.02]
    plain = spark.createDataFrame([(["a b c", "d"],)], "c array<string>")
    assert [r["reward"] for r in rl.reward_length(plain, "c").collect()] == [0.06]
    custom = rl.reward_by(texts, "c", lambda values: [float(len(v)) for v in values])
    assert [r["reward"] for r in custom.collect()] == [50.0, 160.0, 4.0, 0.0]


def test_prompts_and_tokens(spark):
    df = spark.createDataFrame([(1, "\U0001f600bcd")], "id int, text string")
    assert rl.rl_prompts(df, 2).collect()[0]["prompt"] == "\U0001f600b"
    prompts = spark.createDataFrame([(1, "abc")], "id int, prompt string")
    assert rl.rl_prompts(prompts, 2).collect()[0]["prompt"] == "ab"
    words = spark.createDataFrame([(1, "  a b\tc d")], "id int, text string")
    assert rl.tokenize(words, 3).collect() == [(["a", "b", "c"],)]
    ids = rl.tokenize(words, 2, lambda texts: [[len(w) for w in t.split()] for t in texts], keep=("id",))
    assert ids.collect() == [(1, [1, 1])]
