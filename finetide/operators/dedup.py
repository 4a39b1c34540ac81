"""Exact duplicate removal that keeps the first row of each group.

Only (digest, order value) pairs are grouped, and they are reduced before the shuffle, so
a text that fills a third of the table costs one small row per map task. The texts
themselves are matched on the order value, which is unique and therefore never skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finetide.functions.text import digest, text_or_none
from finetide.operators.normalize import text_key


def first_rows(df: DataFrame, order_col: str, key: str | None = None) -> DataFrame:
    """The order values of the rows to keep: one per distinct normalised text.

    A null or repeated order value fails the query, wherever it occurs: rows could not be told
    apart by it. That costs one exchange of order values beside the plan, none where the table
    is bucketed by them.
    """
    column = F.col(key or text_key(df))
    return first_of(df.select(order_col, digest(text_or_none(column)).alias("_digest")), order_col)


def first_of(digests: DataFrame, order_col: str) -> DataFrame:
    """:func:`first_rows` from (order value, ``_digest``)."""
    first = digests.groupBy("_digest").agg(F.min(order_col).alias(order_col)).select(order_col)
    message = F.concat(F.lit(f"{order_col} is null or repeats: "), F.col("_bad"))
    checked = first.withColumn("_bad", bad_value(digests, order_col).scalar())
    return checked.filter(F.when(F.col("_bad").isNull(), True).otherwise(F.raise_error(message).cast("boolean"))).select(order_col)


def bad_value(df: DataFrame, order_col: str) -> DataFrame:
    """An order value that is null or there more than once, as text, or no row."""
    counted = df.groupBy(order_col).agg(F.count("*").alias("_n")).filter(F.col(order_col).isNull() | (F.col("_n") > 1))
    return counted.limit(1).select(F.coalesce(F.col(order_col).cast("string"), F.lit("null")).alias("_bad"))


def deduplicate(df: DataFrame, order_col: str, key: str | None = None, threshold: float | None = None) -> DataFrame:
    """Keep the row with the lowest ``order_col`` (unique, not null) of each text, or with a
    ``threshold`` of each group of near copies (see :mod:`finetide.operators.near_dedup`)."""
    return df.join(kept_rows(df, order_col, key, threshold), order_col, "left_semi")


def kept_rows(df: DataFrame, order_col: str, key: str | None = None, threshold: float | None = None) -> DataFrame:
    """The order values of the rows that :func:`deduplicate` keeps."""
    if threshold is None:
        return first_rows(df, order_col, key)
    from finetide.operators.near_dedup import near_first_rows

    return near_first_rows(df, order_col, threshold, key)
