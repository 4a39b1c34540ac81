"""Length and quality predicates. They are narrow: no filter moves rows between tasks."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finetide.functions.text import quality, text_or_none
from finetide.specs import Filters, is_preference

# Limits for texts a generator has written.
GENERATED_LENGTHS = (20, 4096)


def length_between(c: Column, low: int, high: int) -> Column:
    """Length in code points, both ends included."""
    return F.length(c).between(low, high)


def passes(c: Column, filters: Filters) -> Column:
    """Both tests on one text, the cheap one first. No score is below zero, so a zero
    threshold leaves the word splitting out of the plan."""
    ok = length_between(c, filters.min_length, filters.max_length)
    if filters.min_quality_score > 0.0:
        ok = ok & (quality(c) >= filters.min_quality_score)
    return ok


def with_quality(df: DataFrame, column: str, at_least: float, name: str = "score") -> DataFrame:
    """Rows of at least the given quality, with the score. Exploding a one-element array
    keeps Spark from pushing the test down, where the score would be computed again."""
    score = F.explode_outer(F.array(quality(text_or_none(F.col(column))))).alias(name)
    return df.select("*", score).filter(F.col(name) >= at_least)


def filtered_columns(method: str) -> tuple[str, ...]:
    return ("prompt", "chosen", "rejected") if is_preference(method) else ("text",)


def apply_filters(df: DataFrame, filters: Filters, method: str = "sft") -> DataFrame:
    """Keep rows whose texts all pass; an absent column counts as empty text."""
    tests = [
        passes(text_or_none(F.col(name)) if name in df.columns else F.lit(""), filters)
        for name in filtered_columns(method)
    ]
    return df.filter(reduce(and_, tests))


def generated_length_ok(c: Column) -> Column:
    return length_between(c, *GENERATED_LENGTHS)
