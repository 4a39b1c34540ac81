"""Inputs for the registered queries, all derived by Spark from the given tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finetide.functions.text import word_count
from finetide.operators.positions import with_position
from finetide.sources.files import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sft(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = spark.sparkContext.defaultParallelism  # the table may be a single row group
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), tasks)


def pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn after them."""
    turns = table(spark, sf_dir, "conversations")
    user = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    answer = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    row_id = F.col("conv_id") * 1000 + F.col("turn")
    return user.join(answer, ["conv_id", "turn"]).select(row_id.alias("row_id"), "prompt", "response")


def preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with the assistant turn three after the user's as the rejected answer."""
    turns = table(spark, sf_dir, "conversations").filter("role = 'assistant'")
    rejected = turns.select(
        (F.col("conv_id") * 1000 + F.col("turn") - 3).alias("row_id"), F.col("text").alias("rejected")
    )
    pairs = pair(spark, sf_dir).withColumnRenamed("response", "chosen")
    return pairs.join(rejected, "row_id")


COPY_IDS = 1_000_000_000
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def disguised(text: str) -> Column:
    """The same text in other case and spacing, so that it counts as a duplicate."""
    swapped = F.translate(text, LETTERS + LETTERS.upper(), LETTERS.upper() + LETTERS)
    return F.concat(F.lit("  "), F.replace(swapped, F.lit(" "), F.lit("   ")), F.lit("\n"))


def with_copies(rows: DataFrame, id_col: str, **changes: Column) -> DataFrame:
    """Every row again under a new id, with some columns changed."""
    cells = [changes.get(c, F.col(c)).alias(c) for c in rows.columns if c != id_col]
    copies = rows.select((F.col(id_col) + COPY_IDS).alias(id_col), *cells)
    return rows.unionByName(copies.select(*rows.columns))


def copied_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_copies(pair(spark, sf_dir), "row_id", prompt=disguised("prompt"), response=disguised("response"))


def copied_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies with a disguised prompt and the answers swapped."""
    rows = preference(spark, sf_dir)
    return with_copies(rows, "row_id", prompt=disguised("prompt"), chosen=F.col("rejected"), rejected=F.col("chosen"))


def short_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat_ws(" ", "c_name", "c_mktsegment")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("c_custkey"), text.alias("text"))
    return with_copies(rows, "c_custkey", text=disguised("text"))


def mixed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON: ``wide`` is an integer first and a fraction later, ``kinds`` also text."""
    half = (F.col("n_chars") / 2).cast("string")
    whole = F.col("n_chars").cast("string")
    wide = F.when(F.col("doc_id") % 3 == 1, half).otherwise(whole)
    kinds = F.when(F.col("doc_id") % 5 == 2, F.concat(F.lit('"'), "lang", F.lit('"'))).otherwise(wide)
    odd = F.when(F.col("doc_id") % 2 == 1, F.concat(F.lit(',"odd_source":"'), "source", F.lit('"'))).otherwise("")
    record = F.concat(
        F.lit('{"doc_id":'), F.col("doc_id").cast("string"), F.lit(',"wide":'), wide, F.lit(',"kinds":'), kinds, odd, F.lit("}")
    )
    return table(spark, sf_dir, "documents").select("doc_id", record.alias("record"))


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("seed"))
    return with_position(items, "item_id", "idx").select("idx", "seed")


def sample_count(spark: SparkSession, sf_dir: str) -> int:
    """As many generated samples as there are documents."""
    return table(spark, sf_dir, "documents").count()


def scores(texts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    loss = (F.length("text") % 97) / F.lit(20.0)
    return texts.select(F.col(id_col).alias("id"), loss.alias("loss"), word_count(F.col("text")).alias("n_tokens"))


def outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns; every third is put in the response form."""
    turns = table(spark, sf_dir, "conversations").filter("role = 'assistant'")
    row_id = F.col("conv_id") * 1000 + F.col("turn")
    output = F.when(row_id % 3 == 0, F.concat(F.lit("Response: "), "text")).otherwise(F.col("text"))
    return turns.select(row_id.alias("id"), output.alias("output"))


def run_name(order_key: str) -> Column:
    return F.concat(F.lit("run-"), F.col(order_key).cast("string"))


def iso(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss+00:00")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run record per order."""
    orders = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "training")
    config = F.format_string(
        '{"priority": "%s", "method": "sft", "data": {"train_split": 0.9, "seed": %d}}', "o_orderpriority", "o_custkey"
    )
    return orders.select(
        run_name("o_orderkey").alias("run_id"),
        F.concat(F.lit("customer-"), F.col("o_custkey").cast("string")).alias("run_name"),
        status.otherwise("failed").alias("status"),
        config.alias("config"),
        iso("o_orderdate").alias("created_at"),
        iso("o_orderdate").alias("updated_at"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("outputs/"), run_name("o_orderkey"), F.lit("/final"))).alias(
            "checkpoint_path"
        ),
        F.lit(0).cast("bigint").alias("global_step"),
        F.create_map(F.lit("loss"), "o_totalprice", F.lit("eval_items"), F.lit(0.0)).alias("metrics"),
    )


def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a new run and every line item as a later state of its run."""
    created = runs(spark, sf_dir).select("run_id", F.lit("pending").alias("status"), "updated_at", "global_step")
    status = F.when(F.col("l_returnflag") == "R", "failed").when(F.col("l_linestatus") == "F", "completed")
    later = table(spark, sf_dir, "lineitem").select(
        run_name("l_orderkey").alias("run_id"),
        status.otherwise("training").alias("status"),
        iso("l_shipdate").alias("updated_at"),
        (F.col("l_linenumber") * 100).cast("bigint").alias("global_step"),
    )
    return created.unionByName(later)


def checkpoint_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    name = F.when(F.col("l_returnflag") == "R", "checkpoint-best").otherwise(
        F.concat(F.lit("checkpoint-"), (F.col("l_linenumber") * 100).cast("string"))
    )
    root = F.concat(F.lit("outputs/"), run_name("l_orderkey"), F.lit("/checkpoints/"))
    return items.select(run_name("l_orderkey").alias("run_id"), F.concat(root, name).alias("path"))


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page as an artifact: path and bytes."""
    pages = table(spark, sf_dir, "pages")
    path = F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".html"))
    return pages.select(path.alias("path"), F.encode("html", "UTF-8").alias("content"), "page_id", "url")


def hex_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def stub_transport():
    """A stand-in for a model service whose answers depend on the prompt alone."""

    def call(prompt: str) -> tuple[str, int]:
        return f"Instruction: {hex_of(prompt)}\nResponse: ok", len(prompt)

    return call


def stub_model():
    """A stand-in for a local model; one answer in sixteen is too long to be kept."""

    def answer(prompts: list[str]) -> list[str]:
        digests = [hex_of(p) for p in prompts]
        return [f" {d * 80} " if d[0] == "0" else f" {d}\n" for d in digests]

    return answer
