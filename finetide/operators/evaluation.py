"""Evaluation: aggregate scores and outputs that model plug-ins supply, and keep metrics.

Metrics travel as a long table (bench, metric, value, error).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finetide.functions.text import word_count
from finetide.operators.split import rank_of, sample_texts
from finetide.session import written

METRICS_SCHEMA = "bench string, metric string, value double, error string"

# Sample sizes per benchmark, the texts scored when there are none, and messages.
DEFAULT_SAMPLES = {"perplexity": 10, "generation_quality": 5, "instruction_following": 3}
DEFAULT_TEXTS = [
    "The quick brown fox jumps over the lazy dog.",
    "Machine learning models learn patterns from data.",
    "Fine-tuning adapts pretrained weights to downstream tasks.",
]
DEFAULT_PROMPTS = ["Explain AI in simple terms.", "What is LoRA?"]
INSTRUCTION_PROMPT = "Instruction: List three colors.\nResponse:"
RESPONSE_MARK = "Response:"
UNKNOWN_BENCHMARK = "Unknown benchmark: "
SAMPLE_CHARS = 200

Scorer = Callable[[DataFrame], DataFrame]  # (id, text) -> (id, loss, n_tokens)
Writer = Callable[[DataFrame], DataFrame]  # (id, text) -> (id, output); null output = failed


def perplexity(scores: DataFrame) -> DataFrame:
    """One row from (loss, n_tokens) per text. A text of n tokens predicts n-1 of them and
    weighs by that number; a text of fewer than two predicts none."""
    predicted = F.greatest(F.col("n_tokens") - 1, F.lit(0))
    weighted = F.when(predicted > 0, F.col("loss") * predicted)
    total = F.coalesce(F.sum(weighted), F.lit(0.0))
    weight = F.greatest(F.coalesce(F.sum(predicted), F.lit(0)), F.lit(1))
    return scores.agg((total / weight).alias("avg_loss")).select(F.exp("avg_loss").alias("perplexity"), "avg_loss")


def generation_quality(outputs: DataFrame) -> DataFrame:
    """Mean words per output and the number of outputs; a failed one counts with no words."""
    n = word_count(F.coalesce(F.col("output"), F.lit("")))
    return outputs.agg(
        F.coalesce(F.avg(n), F.lit(0.0)).alias("avg_output_length"), F.count("*").alias("num_samples")
    )


def instruction_checks(outputs: DataFrame) -> DataFrame:
    """Per output: does it carry the response mark, and its first characters."""
    output = F.coalesce(F.col("output"), F.lit(""))
    return outputs.select(
        "id",
        F.contains(output, F.lit(RESPONSE_MARK)).alias("passed"),
        F.substring(output, 1, SAMPLE_CHARS).alias("sample_output"),
    )


def instruction_following(outputs: DataFrame) -> DataFrame:
    checks = instruction_checks(outputs)
    return checks.agg(
        F.coalesce(F.bool_and("passed"), F.lit(False)).alias("passed"),
        F.coalesce(F.avg(F.col("passed").cast("double")), F.lit(0.0)).alias("pass_rate"),
    )


def texts_or_defaults(texts: DataFrame, defaults: list[str]) -> DataFrame:
    """``texts`` (id, text), or the default texts if it has no row; one lazy plan."""
    spare = texts.sparkSession.createDataFrame(list(enumerate(defaults)), "id bigint, text string")
    return texts.select(F.col("id").cast("bigint").alias("id"), "text").unionByName(spare.where(~texts.exists()))


def long_metrics(one_row: DataFrame, bench: str) -> DataFrame:
    """A one-row result as one line per column."""
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in one_row.columns]
    lines = one_row.select(F.explode(F.array(*cells)).alias("m"))
    return lines.select(
        F.lit(bench).alias("bench"), "m.metric", "m.value", F.lit(None).cast("string").alias("error")
    )


def error_line(spark: SparkSession, bench: str) -> DataFrame:
    return spark.createDataFrame([(bench, None, None, UNKNOWN_BENCHMARK + bench)], METRICS_SCHEMA)


def run_benchmarks(
    rows: DataFrame,
    id_col: str,
    names: list[str],
    score: Scorer,
    write: Writer,
    max_samples: int | None = None,
    seed: int = 42,
    more: dict[str, Callable[[], DataFrame]] | None = None,
) -> DataFrame:
    """The named benchmarks over a seeded sample of ``rows``; an unknown name gets an error
    line. ``more`` adds benchmarks: functions that give a one-row result."""
    spark = rows.sparkSession
    sizes = {b: max_samples or n for b, n in DEFAULT_SAMPLES.items() if b in names and b != "instruction_following"}
    largest = max(sizes.values(), default=0)
    # Drawn once at the largest size and stored; smaller samples are its first rows.
    drawn = written(sample_texts(rows, id_col, largest, seed).withColumnRenamed(id_col, "id"), "sample") if sizes else None

    def sample(bench: str, defaults: list[str]) -> DataFrame:
        n = sizes[bench]
        picked = drawn if n == largest else drawn.orderBy(rank_of("id", seed)).limit(n)
        return texts_or_defaults(picked, defaults[:n])

    def run_perplexity() -> DataFrame:
        return perplexity(score(sample("perplexity", DEFAULT_TEXTS)))

    def run_quality() -> DataFrame:
        return generation_quality(write(sample("generation_quality", DEFAULT_PROMPTS)))

    def run_instruction() -> DataFrame:
        prompt = spark.createDataFrame([(0, INSTRUCTION_PROMPT)], "id bigint, text string")
        return instruction_following(write(prompt)).select("passed")

    known = {
        "perplexity": run_perplexity,
        "generation_quality": run_quality,
        "instruction_following": run_instruction,
        **(more or {}),
    }
    tables = [long_metrics(known[n](), n) if n in known else error_line(spark, n) for n in names]
    return reduce(DataFrame.unionByName, tables)


def metric_value(text: Column) -> Column:
    """Numbers as doubles, booleans as 1 and 0, anything else null."""
    truth = F.when(F.lower(text) == "true", 1.0).when(F.lower(text) == "false", 0.0)
    return F.coalesce(truth, text.try_cast("double"))


def flatten_metrics(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """``bench -> metric -> text`` maps as (name, value) rows, numbers and booleans only."""
    benches = df.select(*keep, F.explode(column).alias("_bench", "_metrics"))
    cells = benches.select(*keep, "_bench", F.explode("_metrics").alias("_metric", "_text"))
    named = cells.select(
        *keep, F.concat_ws("_", "_bench", "_metric").alias("name"), metric_value(F.col("_text")).alias("value")
    )
    return named.filter(F.col("value").isNotNull())


def merge_metrics(old: Column, new: Column, prefix: str = "eval_") -> Column:
    """Add ``new`` metrics under a prefix; they replace old ones of the same name."""
    none = F.create_map().cast("map<string,double>")
    added = F.transform_keys(F.coalesce(new, none), lambda k, _: F.concat(F.lit(prefix), k))
    kept = F.map_filter(F.coalesce(old, none), lambda k, _: ~F.map_contains_key(added, k))
    return F.map_concat(kept, added)


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
