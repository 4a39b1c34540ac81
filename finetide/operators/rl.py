"""Data preparation for reinforcement learning: prompts, rewards, tokens."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from finetide.functions.text import text_or_none, word_count, words
from finetide.operators.normalize import text_key

# Fixed value: the completion length, in words, that earns the full reward.
FULL_REWARD_WORDS = 50


def rl_prompts(df: DataFrame, max_prompt_length: int) -> DataFrame:
    """Set ``prompt`` to the first characters of the text, or of the prompt for want of it."""
    return df.withColumn("prompt", F.substring(F.col(text_key(df)), 1, max_prompt_length))


def completion_text(df: DataFrame, column: str) -> Column:
    """A completion's text: itself, or the first message's content of a chat."""
    c = F.col(column)
    kind = df.schema[column].dataType
    if not isinstance(kind, ArrayType):
        return text_or_none(c)
    first = F.get(c, F.lit(0))
    if isinstance(kind.elementType, StructType) and "content" in kind.elementType.names:
        first = first.getField("content")
    elif isinstance(kind.elementType, StructType):
        first = F.to_json(first)
    # An empty or absent chat is scored by its printed form, which is one word.
    return F.when(F.size(c) > 0, text_or_none(first)).otherwise(F.when(c.isNull(), "None").otherwise("[]"))


def reward_length(df: DataFrame, column: str, name: str = "reward") -> DataFrame:
    """Length reward: words over fifty, at most one."""
    n = word_count(completion_text(df, column))
    return df.withColumn(name, F.least(F.lit(1.0), n / F.lit(float(FULL_REWARD_WORDS))))


def _as_type(values: pa.Array | pa.ChunkedArray, kind: pa.DataType) -> pa.Array:
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return values.cast(kind)


def reward_by(
    df: DataFrame, column: str, fn: Callable[[list[str]], list[float]] | Callable[[pa.Array], pa.Array], name: str = "reward", arrow: bool = False
) -> DataFrame:
    """A user's reward function, called once per Arrow batch, with a list of texts or with
    ``arrow`` the Arrow array itself."""
    if arrow:

        def score_array(texts: pa.Array) -> pa.Array:
            return _as_type(fn(texts), pa.float64())

        return df.withColumn(name, F.arrow_udf(score_array, "double")(completion_text(df, column)))

    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(fn(texts.tolist()), dtype="float64")

    return df.withColumn(name, F.pandas_udf(score, "double")(completion_text(df, column)))


def tokenize(
    df: DataFrame,
    max_length: int,
    tokenizer: Callable[[list[str]], list[list[int]]] | None = None,
    keep: tuple[str, ...] = (),
    arrow: bool = False,
) -> DataFrame:
    """Token ids (``input_ids``) from a user's batch tokenizer, or white-space tokens
    (``tokens``) without one; cut to ``max_length``, original columns dropped but ``keep``. With
    ``arrow`` the tokenizer takes the Arrow array of texts and gives one of lists."""
    text = F.col(text_key(df))
    if tokenizer is None:
        return df.select(*keep, F.slice(words(text_or_none(text)), 1, max_length).alias("tokens"))

    if arrow:

        def id_lists(texts: pa.Array) -> pa.Array:
            return _as_type(pc.list_slice(tokenizer(texts), 0, max_length), pa.list_(pa.int32()))

        return df.select(*keep, F.arrow_udf(id_lists, "array<int>")(text_or_none(text)).alias("input_ids"))

    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series([row[:max_length] for row in tokenizer(texts.tolist())])

    return df.select(*keep, F.pandas_udf(ids, "array<int>")(text_or_none(text)).alias("input_ids"))
