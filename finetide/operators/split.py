"""Seeded train/validation split with exact counts and no sort of the table.

Rows rank by a seeded hash of their id. Instead of ranking all of them, the split finds
the one (hash, id) pair that ends the validation part: counts per hash prefix name the
prefix in which the cut falls, and only that prefix (1/65,536 of the ids) is ranked.
Labelling is then a comparison with that pair and moves no row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finetide.errors import DataError
from finetide.functions.keys import seeded_key
from finetide.functions.text import is_blank, text_or_none
from finetide.operators.normalize import text_key
from finetide.specs import SPLIT_NAMES, SplitSpec

PREFIX_DIGITS = 4


def validation_rows(total: Column, train_split: float) -> Column:
    """How many of ``total`` rows validate: rounded half to even, at least 1, never all."""
    wanted = F.bround(total * F.lit(1.0 - train_split), 0).cast("bigint")
    bounded = F.least(F.greatest(F.lit(1), wanted), total - 1)
    return F.when(total <= 1, F.lit(0)).otherwise(bounded).cast("bigint")


def required(name: str) -> Column:
    """The order value; a null one fails the query, for no comparison could place its row."""
    message = F.lit(f"null in the order column {name}")
    return F.when(F.col(name).isNull(), F.raise_error(message)).otherwise(F.col(name))


def rank_of(id_col: str, seed: int) -> Column:
    return F.struct(seeded_key(seed, F.col(id_col)).alias("k"), F.col(id_col).alias("id"))


def rank_cut(ids: DataFrame, id_col: str, seed: int, wanted: Callable[[Column], Column]) -> DataFrame:
    """One row, one column: the last (hash, id) pair among the ``wanted`` lowest ones, a
    function of the row count. No row if none is wanted. A null id fails the query, as does
    an id that lies on both sides of the cut."""
    keyed = ids.select(required(id_col).alias(id_col)).select(rank_of(id_col, seed).alias("rank"))
    keyed = keyed.withColumn("prefix", F.substring("rank.k", 1, PREFIX_DIGITS))
    counts = keyed.groupBy("prefix").agg(F.count("*").alias("n"))
    # At most 16 ** PREFIX_DIGITS rows reach these two windows, whatever the table holds.
    one_task = Window.partitionBy(F.lit(0))
    running = counts.select(
        "prefix",
        "n",
        F.sum("n").over(one_task.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("n").over(one_task).alias("total"),
    )
    before = F.col("upto") - F.col("n")
    boundary = (
        running.withColumn("wanted", wanted(F.col("total")))
        .filter((before < F.col("wanted")) & (F.col("wanted") <= F.col("upto")))
        .select(F.struct("prefix", (F.col("wanted") - before).alias("need")))
        .scalar()
    )
    within = Window.partitionBy("prefix").orderBy("rank")
    repeated = F.raise_error(F.concat(F.lit(f"{id_col} repeats: "), F.col("rank.id").cast("string")))
    again = F.col("rank") == F.col("following")
    return (
        keyed.filter(F.col("prefix") == boundary.getField("prefix"))
        .withColumn("position", F.row_number().over(within))
        .withColumn("following", F.lead("rank").over(within))
        .filter(F.col("position") == boundary.getField("need"))
        .select(F.when(again, repeated.cast(keyed.schema["rank"].dataType)).otherwise(F.col("rank")).alias("rank"))
    )


def split_cut(ids: DataFrame, id_col: str, spec: SplitSpec) -> DataFrame:
    """Where the validation part ends."""
    return rank_cut(ids, id_col, spec.seed, lambda total: validation_rows(total, spec.train_split))


def label(df: DataFrame, id_col: str, cut: DataFrame, spec: SplitSpec) -> DataFrame:
    held_out = F.coalesce(rank_of(id_col, spec.seed) <= cut.scalar(), F.lit(False))
    return df.withColumn("split", F.when(held_out, "validation").otherwise("train"))


def split_exact(df: DataFrame, id_col: str, spec: SplitSpec = SplitSpec()) -> DataFrame:
    """Add ``split``; a table of one row or none is all train."""
    return label(df, id_col, split_cut(df.select(id_col), id_col, spec), spec)


def split_by_fraction(df: DataFrame, id_col: str, spec: SplitSpec = SplitSpec()) -> DataFrame:
    """Add ``split`` row by row, for unbounded input: the counts are only near the ratio."""
    leading = F.conv(F.substring(seeded_key(spec.seed, F.col(id_col)), 1, 8), 16, 10).cast("double")
    held_out = leading / F.lit(2.0**32) < F.lit(1.0 - spec.train_split)
    return df.withColumn("split", F.when(held_out, "validation").otherwise("train"))


def checked_splits(df: DataFrame) -> DataFrame:
    """Fail, while the rows pass by, on a split name outside the allowed ones."""
    message = F.concat(F.lit("split name not allowed: "), F.col("split"))
    bad = F.raise_error(message).cast("string")
    return df.withColumn("split", F.when(F.col("split").isin(*SPLIT_NAMES), F.col("split")).otherwise(bad))


def take_split(df: DataFrame, name: str) -> DataFrame:
    """One split by name; a table without splits answers every name with itself."""
    if name not in SPLIT_NAMES:
        raise DataError(f"unknown split {name!r}", "split")
    if "split" not in df.columns:
        return df
    return df.filter(F.col("split") == name).drop("split")


def sample_texts(df: DataFrame, id_col: str, limit: int = 32, seed: int = 42) -> DataFrame:
    """A seeded sample of at most ``limit`` rows with non-blank text, as (id, text), cut off
    like the part of a split: ids must not be null, nor repeat at the cut."""
    texts = df.select(id_col, text_or_none(F.col(text_key(df))).alias("text"))
    texts = texts.filter(~is_blank(F.col("text")))
    cut = rank_cut(texts.select(id_col), id_col, seed, lambda total: F.least(F.lit(limit), total))
    return texts.filter(rank_of(id_col, seed) <= cut.scalar())


def split_by_ids(df: DataFrame, held_out: DataFrame, id_col: str) -> DataFrame:
    """Add ``split`` from an explicit list of ids. One join that only adds a flag: ids may
    repeat or name no row, and the table is read once for both parts."""
    ids = held_out.select(id_col).filter(F.col(id_col).isNotNull())
    return df.withColumn("split", F.when(F.col(id_col).isin(ids), "validation").otherwise("train"))
