"""The corpus pipeline: documents through five of the operators, each stage's rows written and read again.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the rows that
go on. All but the last return the columns of documents, whatever further ones there are; the last
gives each row's place in the token files. An empty table gives an empty one at every stage.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import finetide
from finetide.llm import decontaminate, mixing, quality, simhash, token_store
from finetide.llm.queries import tokenizer_path
from finetide.session import scratch_path

# Functions travel to the workers by value, whatever folder those start in.
cloudpickle.register_pickle_by_value(finetide)

#: SQL cannot express the classifier and the tokenizer; tests compare with plain Python instead.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go, by their id; rows of a null id stay. Null texts are
    judged as empty ones; rows that repeat an id go together."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id stays of each group of near copies; rows of a null id stay, and
    texts without words are copies of each other."""
    return simhash.one_per_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of which benchmark windows are one word in twenty or more, by their id; rows of a
    null id and texts without words stay."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per epoch that the mix takes of a document, whole and unchanged; texts without words go,
    and a null source is a source."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files, and returns what is read back from them: a row per row, rows of a null
    id first, a null text as the end id alone."""
    path = scratch_path(spark, "tokens")
    # The workers also hold what earlier stages left in their processes, so they remember fewer words.
    token_store.write_tokens(docs, path, tokenizer_path(), remembered=300_000)
    return token_store.token_digests(spark, path)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-ID / binary output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
