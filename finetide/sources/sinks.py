"""Writers. Each is one distributed write; none brings rows to the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from finetide.errors import DataError
from finetide.functions.text import strip, text_or_none
from finetide.operators.normalize import text_key
from finetide.operators.split import checked_splits
from finetide.sources.paths import exists, move, remove
from finetide.specs import SPLIT_NAMES


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines that keep null fields, so every line names every column."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV that ``read_csv`` reads back unchanged: quotes doubled, white space kept."""
    df.write.mode(mode).csv(
        path,
        header=True,
        quote='"',
        escape='"',
        quoteAll=True,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def storable(df: DataFrame) -> DataFrame:
    """Columns of nothing but untyped nulls become strings: Parquet has no type for them."""
    untyped = [f.name for f in df.schema.fields if isinstance(f.dataType, NullType)]
    return df.withColumns({name: F.col(f"`{name}`").cast("string") for name in untyped})


def _trainer_text(df: DataFrame) -> Column:
    return strip(text_or_none(F.col(text_key(df)))).alias("text")


def trainer_texts(df: DataFrame) -> DataFrame:
    """What a trainer file holds: stripped, non-blank ``text`` (or the prompt for want of it)."""
    return df.select(_trainer_text(df)).filter("text <> ''")


def in_order(df: DataFrame, order_col: str | None, *first: str) -> DataFrame:
    """Rows dealt out by ranges of ``order_col`` and sorted in their task, so that files in the order
    of their names hold them in that order; ``first`` are columns that files are parted by."""
    return df.repartitionByRange(order_col).sortWithinPartitions(*first, order_col) if order_col else df


def write_trainer_layout(splits: DataFrame, out_dir: str, batch_size: int = 1, order_col: str | None = None) -> dict[str, str]:
    """``train.jsonl`` and, unless empty, ``valid.jsonl`` under ``out_dir``, in the order of ``order_col`` if given.

    One pass writes both beside their places and counts the rows; they are moved there if the train
    part has ``batch_size`` rows and as many that are not blank. Files read in the order of
    their names hold the lines in order.
    """
    spark = splits.sparkSession
    rows = splits if "split" in splits.columns else splits.withColumn("split", F.lit("train"))
    rows = rows.filter(F.col("split").isin("train", "validation")).select("split", _trainer_text(rows), *([F.col(order_col).alias("_order")] if order_col else []))
    counts, train = Observation(), F.col("split") == "train"
    rows = in_order(rows, order_col and "_order", "split").observe(
        counts, F.count_if(train).alias("train"), F.count_if(train & (F.col("text") != "")).alias("texts"), F.count_if(~train).alias("validation")
    )
    root = out_dir.rstrip("/")
    draft = f"{root}/_draft-{uuid.uuid4().hex}"
    rows.filter("text <> ''").select("split", "text").write.partitionBy("split").option("ignoreNullFields", "false").json(draft)
    found = counts.get
    for key, what in (("train", "train rows"), ("texts", "non-blank train rows")):
        if found[key] < batch_size:
            remove(spark, draft)
            raise DataError(f"need at least {batch_size} {what}, found {found[key]}", "training.batch_size")
    paths = {"train": f"{root}/train.jsonl"}
    if found["validation"]:
        paths["validation"] = f"{root}/valid.jsonl"
    for name, target in paths.items():
        remove(spark, target)
        if exists(spark, f"{draft}/split={name}"):
            move(spark, f"{draft}/split={name}", target)
        else:
            write_jsonl(spark.createDataFrame([], "text string"), target)
    remove(spark, draft)
    return paths


def hand_off(splits: DataFrame, out_dir: str, order_col: str | None = None) -> dict[str, str]:
    """Columnar hand-off: one Parquet folder per split, written in a single pass, in the order of
    ``order_col`` if given."""
    rows = in_order(checked_splits(storable(splits)), order_col, "split")
    rows.write.mode("overwrite").partitionBy("split").parquet(out_dir)
    folders = {name: f"{out_dir.rstrip('/')}/split={name}" for name in SPLIT_NAMES}
    return {name: folder for name, folder in folders.items() if exists(splits.sparkSession, folder)}
