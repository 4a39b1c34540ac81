"""The main plan: normalise, filter, remove duplicates, split."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from finetide.errors import DataError
from finetide.operators.dedup import kept_rows
from finetide.operators.filters import apply_filters
from finetide.operators.normalize import normalize_columns
from finetide.operators.positions import cap_rows
from finetide.operators.split import label, split_cut
from finetide.sources.files import load
from finetide.specs import DatasetSpec, Filters, GenerationSpec, SplitSpec


def preprocess(
    df: DataFrame,
    order_col: str,
    method: str = "sft",
    dataset: DatasetSpec | None = None,
    filters: Filters = Filters(),
    split: SplitSpec = SplitSpec(),
) -> DataFrame:
    """Rows that pass, first of each text, with their ``split``. One lazy plan, unless near copies
    are asked for, whose groups are found in jobs of their own.

    The filter runs before duplicates are looked for: a filtered row must not claim a text.
    The exchange of (digest, order value) pairs is the same subplan wherever it is needed,
    so Spark runs it once. The texts are shuffled at most once, on the order column.
    """
    rows = normalize_columns(df, method, dataset or DatasetSpec(path=""), order_col)
    kept = kept_rows(apply_filters(rows, filters, method), order_col, threshold=filters.similarity)
    cut = split_cut(kept, order_col, split)
    # Rows in ``kept`` have passed both tests. Repeating the length test is cheap and spares
    # the join the long texts; repeating the quality test would cost more than it spares.
    candidates = apply_filters(rows, replace(filters, min_quality_score=0.0), method)
    return label(candidates.join(kept, order_col, "left_semi"), order_col, cut, split)


def preprocess_dataset(
    spark: SparkSession,
    dataset: DatasetSpec,
    order_col: str,
    method: str = "sft",
    filters: Filters | None = None,
    split: SplitSpec = SplitSpec(),
    generation: GenerationSpec | None = None,
) -> DataFrame:
    """The same from files: any format takes the same path, with an optional row cap. Without
    ``filters`` those of the run's generation settings hold, where it has some."""
    if dataset.streaming:
        raise DataError("a streaming dataset is prepared by streaming.preprocess.prepare_stream", "dataset.streaming")
    df = load(spark, dataset)
    if dataset.max_rows is not None:
        df = cap_rows(df, order_col, dataset.max_rows)
    return preprocess(df, order_col, method, dataset, filters_of(filters, generation), split)


def filters_of(filters: Filters | None, generation: GenerationSpec | None) -> Filters:
    return filters or (generation.filters if generation else Filters())
