"""Prepared data for a run: from the split cache if it fits, else made and cached."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from finetide.plans.appended import Prepared
from finetide.plans.cache import data_cache_key, is_cached, load_splits, save_splits
from finetide.plans.estimate import plan_estimate
from finetide.plans.preprocess import filters_of, preprocess_dataset
from finetide.sources.files import count_rows
from finetide.specs import DatasetSpec, Filters, GenerationSpec, SplitSpec


def cache_dir_of(
    spark: SparkSession,
    dataset: DatasetSpec,
    method: str,
    cache_root: str,
    filters: Filters,
    split: SplitSpec,
    order_col: str | None,
) -> str:
    key = data_cache_key(spark, dataset, method, filters, split, order_col)
    return f"{cache_root.rstrip('/')}/processed/{key}"


def prepare(
    spark: SparkSession,
    dataset: DatasetSpec,
    order_col: str,
    cache_root: str,
    method: str = "sft",
    filters: Filters | None = None,
    split: SplitSpec = SplitSpec(),
    generation: GenerationSpec | None = None,
    appending: bool = False,
) -> DataFrame:
    """The dataset's splits as stored rows. The main plan runs only if there is no whole
    cache of the same settings and source. ``appending``: the source is a folder that gains files,
    of which only new ones are read (see :mod:`finetide.plans.appended`); the rows are the same."""
    filters = filters_of(filters, generation)
    if appending:
        return Prepared(spark, dataset, order_col, cache_root, method, filters, split).refreshed()
    cache = cache_dir_of(spark, dataset, method, cache_root, filters, split, order_col)
    stored = load_splits(spark, cache)
    if stored is not None:
        return stored
    save_splits(preprocess_dataset(spark, dataset, order_col, method, filters, split), cache, method)
    return load_splits(spark, cache)


def plan_dataset(
    spark: SparkSession,
    dataset: DatasetSpec,
    cache_root: str,
    method: str = "sft",
    filters: Filters = Filters(),
    split: SplitSpec = SplitSpec(),
    order_col: str | None = None,
    **settings,
) -> DataFrame:
    """Estimates for a dataset, without preparing it. ``settings`` go to ``plan_estimate``; with
    the ``order_col`` that ``prepare`` gets, the estimate knows whether its cache is there."""
    cache = cache_dir_of(spark, dataset, method, cache_root, filters, split, order_col)
    return plan_estimate(count_rows(spark, dataset), cached=is_cached(spark, cache), **settings)
