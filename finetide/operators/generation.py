"""Synthetic rows from seed prompts. Models are plug-ins; Spark spreads and stores the work.

A plug-in is a factory called once per task, so a client or model is opened there and not
shipped. Model output differs from call to call: write it before using it twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finetide.errors import DataError
from finetide.functions.text import strip
from finetide.operators.filters import generated_length_ok
from finetide.operators.journal import Journal
from finetide.session import written

Transport = Callable[[str], tuple[str, int]]  # prompt -> (text, tokens used)
TextModel = Callable[[list[str]], list[str]]  # prompts -> completions

# Seeds used when none are given, prompt wording, and the row that stands in
# for a run in which nothing passed.
API_SEEDS = ["Generate a helpful instruction-response pair for LLM fine-tuning."]
LOCAL_SEEDS = [
    "Write a question about machine learning.",
    "Write a question about Python programming.",
    "Write a question about cooking.",
]
REQUEST_SUFFIX = (
    "\n\nRespond with a single instruction-response training example in the format:\n"
    "Instruction: ...\nResponse: ..."
)
ANSWER_PREFIX = "Answer this instruction helpfully:\n"
ANSWER_SUFFIX = "\n\nResponse:"
FALLBACK_TEXT = (
    "Instruction: What is fine-tuning?\n"
    "Response: Fine-tuning adapts a pretrained model to a specific task."
)
# Seconds to pause after each call, by backend.
CALL_DELAYS = {"openai": 0.5, "anthropic": 1.0}

# Seeds beyond these sizes are joined by shuffle instead of broadcast.
BROADCAST_SEEDS = 100_000
BROADCAST_SEED_BYTES = 32 * 1024 * 1024
# Requests of one seed that share a copy of it in such a shuffle.
SEED_SHARE = 10_000


def request_prompt(seed: Column) -> Column:
    return F.concat(seed, F.lit(REQUEST_SUFFIX))


def answer_prompt(instruction: Column) -> Column:
    return F.concat(F.lit(ANSWER_PREFIX), instruction, F.lit(ANSWER_SUFFIX))


def record_text(instruction: Column, response: Column) -> Column:
    return F.concat(F.lit("Instruction: "), strip(instruction), F.lit("\nResponse: "), strip(response))


def seed_table(spark: SparkSession, seeds: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(seeds)), "idx bigint, seed string")


@dataclass(frozen=True)
class SeedList:
    """Seeds (idx, seed) with idx dense from 0, their number, and whether they may be broadcast."""

    rows: DataFrame
    count: int
    small: bool

    def requests(self, start: int, end: int) -> DataFrame:
        """(id, seed) for ids start..end-1: sample i takes seed i modulo the number of seeds."""
        samples = self.rows.sparkSession.range(start, end).withColumn("idx", F.pmod("id", F.lit(self.count)))
        if self.small:
            return samples.join(F.broadcast(self.rows), "idx").select("id", "seed")
        # Few large seeds would each meet all their requests in one task: copies of a seed share them.
        copies = -(-(end - start) // (self.count * SEED_SHARE))
        samples = samples.withColumn("copy", F.pmod(F.floor(F.col("id") / self.count), F.lit(copies)))
        seeds = self.rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint"))))
        return samples.join(seeds, ["idx", "copy"]).select("id", "seed")


def seed_list(seeds: DataFrame, defaults: list[str]) -> SeedList:
    """Count and weigh the seeds once; without any, ``defaults`` stand in."""
    size = seeds.agg(F.count("*").alias("n"), F.sum(F.octet_length("seed")).alias("bytes")).head()
    if size["n"] == 0:
        return SeedList(seed_table(seeds.sparkSession, defaults), len(defaults), True)
    small = size["n"] <= BROADCAST_SEEDS and (size["bytes"] or 0) <= BROADCAST_SEED_BYTES
    return SeedList(seeds, size["n"], small)


def assign_seeds(seeds: DataFrame, n_samples: int, defaults: list[str]) -> DataFrame:
    return seed_list(seeds, defaults).requests(0, n_samples)


def call_with_retry(call: Transport, prompt: str, max_retries: int) -> tuple[str, int]:
    """Up to ``max_retries`` tries, pausing 1, 2, 4 ... seconds between them."""
    pauses = [2**n for n in range(max(1, max_retries) - 1)]
    while True:
        try:
            text, tokens = call(prompt)
        except Exception as error:
            if not pauses:
                raise RuntimeError(f"generation failed after {max_retries} tries: {error}") from error
            time.sleep(pauses.pop(0))
        else:
            return text or "", tokens or 0


def generate_single(
    requests: DataFrame,
    connect: Callable[[], Transport],
    max_concurrency: int = 4,
    max_retries: int = 3,
    delay: float = 0.5,
    journal: Journal | None = None,
) -> DataFrame:
    """One call per request: (id, text, tokens). Each task calls one at a time, so the
    number of partitions bounds the calls in flight. With a ``journal`` a task that starts
    again asks only what it has no answer for."""
    tasks = max(1, max_concurrency)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = connect()
        with noted(journal, "single", tasks) as notes:
            for batch in batches:
                prompts = dict(zip(batch["id"].tolist(), batch["prompt"], strict=True))

                def ask(ids: list[int]) -> list[tuple[str, int]]:
                    found = [call_with_retry(call, prompts[i], max_retries) for i in ids]
                    if delay:
                        time.sleep(delay)
                    return found

                answers = notes.answers(list(prompts), ask)
                yield pd.DataFrame([(i, *a) for i, a in zip(prompts, answers, strict=True)], columns=["id", "text", "tokens"])

    prompts = requests.select("id", request_prompt(F.col("seed")).alias("prompt"))
    return prompts.repartition(tasks, "id").mapInPandas(run, "id bigint, text string, tokens bigint")


class _Unnoted:
    """Asks without a journal."""

    def answers(self, ids: list[int], ask: Callable[[list[int]], list], size: int = 1) -> list:
        return [answer for start in range(0, len(ids), size) for answer in ask(ids[start : start + size])]


def noted(journal: Journal | None, stage: str, tasks: int) -> AbstractContextManager:
    return journal.of_task(stage, tasks) if journal else nullcontext(_Unnoted())


def complete(
    df: DataFrame, prompt: Column, name: str, load: Callable[[], TextModel], batch_size: int, journal: Journal | None = None, tasks: int = 0
) -> DataFrame:
    """Add a model completion of ``prompt`` to (id, ...) rows, in batches of ``batch_size``. Rows of
    one id in a batch share its answer."""
    size = max(1, batch_size)
    kept = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        with noted(journal, name, tasks) as notes:
            for batch in batches:
                ids = batch["id"].tolist()
                prompts = dict(zip(ids, batch.pop("_prompt"), strict=True))

                def ask(chunk: list[int]) -> list[str]:
                    answers = model([prompts[i] for i in chunk])
                    if len(answers) != len(chunk):
                        raise RuntimeError(f"model returned {len(answers)} texts for {len(chunk)} prompts")
                    return answers

                answers = dict(zip(prompts, notes.answers(list(prompts), ask, size), strict=True))
                yield batch.assign(**{name: [answers[i] for i in ids]})

    schema = df.select(*kept, F.lit("").alias(name)).schema
    return df.withColumn("_prompt", prompt).mapInPandas(run, schema)


def two_stage_rows(
    requests: DataFrame, load: Callable[[], TextModel], batch_size: int = 4, tasks: int | None = None, journal: Journal | None = None
) -> DataFrame:
    """Instructions from seeds, responses from instructions: (id, text) of the rows that
    pass the length test. Prompts are small but each costs model time, so they are dealt
    out to a fixed number of tasks, by default one per core."""
    tasks = tasks or requests.sparkSession.sparkContext.defaultParallelism
    spread = requests.repartition(tasks, "id")
    asked = complete(spread, F.col("seed"), "instruction", load, batch_size, journal, tasks)
    answered = complete(asked, answer_prompt(F.col("instruction")), "response", load, batch_size, journal, tasks)
    text = record_text(F.col("instruction"), F.col("response"))
    return answered.select("id", text.alias("text")).filter(generated_length_ok(F.col("text")))


def stand_in(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(0, FALLBACK_TEXT)], "id bigint, text string")


def or_stand_in(rows: DataFrame) -> DataFrame:
    """``rows``, or the one stand-in row if there are none. Written once, then read."""
    stored = written(rows, "generated")
    return stand_in(rows.sparkSession) if stored.isEmpty() else stored


def token_usage(generated: DataFrame) -> DataFrame:
    """Summed from rows, so a retried task counts once."""
    return generated.agg(
        F.count("*").alias("n_samples"), F.coalesce(F.sum("tokens"), F.lit(0)).cast("bigint").alias("total_tokens")
    )


@dataclass(frozen=True)
class Backend:
    """How a named generator turns (id, seed) requests into rows with its plug-in."""

    default_seeds: list[str]
    run: Callable[..., DataFrame]  # (requests, plug_in, **options) -> rows
    has_stand_in: bool = False
    notes: bool = False  # whether ``run`` takes a ``journal``

    def generate(self, seeds: DataFrame, n_samples: int, plug_in: Callable, **options) -> DataFrame:
        requests = assign_seeds(seeds, n_samples, self.default_seeds)
        rows = self.run(requests, plug_in, **options)
        return or_stand_in(rows) if self.has_stand_in else rows


def _api(name: str) -> Backend:
    return Backend(API_SEEDS, partial(generate_single, delay=CALL_DELAYS[name]), notes=True)


BACKENDS: dict[str, Backend] = {
    "openai": _api("openai"),
    "anthropic": _api("anthropic"),
    "self_instruct": Backend(LOCAL_SEEDS, two_stage_rows, has_stand_in=True, notes=True),
}


def get_backend(name: str) -> Backend:
    """A registered generator; users may add theirs to ``BACKENDS``."""
    if name not in BACKENDS:
        raise DataError(f"unknown generator backend: {name}", "synthetic.backend")
    return BACKENDS[name]
