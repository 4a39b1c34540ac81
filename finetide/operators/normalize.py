"""Bring source columns into the row shapes trainers read: text, or prompt/chosen/rejected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finetide.errors import DataError
from finetide.functions.text import text_or_none
from finetide.specs import DatasetSpec, is_preference


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns; a result with two columns of one name is refused."""
    result = [mapping.get(name, name) for name in df.columns]
    if len(set(result)) != len(result):
        raise DataError(f"renaming would leave duplicate columns: {result}", "rename")
    return df.withColumnsRenamed(mapping)


def text_key(df: DataFrame) -> str:
    for name in ("text", "prompt"):
        if name in df.columns:
            return name
    raise DataError(f"no text or prompt column among {df.columns}", "columns")


def to_text_rows(df: DataFrame, spec: DatasetSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """One ``text`` column, from the text column itself or from prompt and response.

    ``keep`` names columns (the order column) that must survive the merge.
    """
    if spec.text_column in df.columns:
        return df if spec.text_column == "text" else rename(df, {spec.text_column: "text"})
    if spec.prompt_column and spec.response_column:
        absent = {spec.prompt_column, spec.response_column} - set(df.columns)
        if absent:
            raise DataError(f"missing columns: {sorted(absent)}", "dataset")
        parts = [text_or_none(F.col(n)) for n in (spec.prompt_column, spec.response_column)]
        return df.select(*keep, F.concat_ws("\n", *parts).alias("text"))
    raise DataError(
        f"column {spec.text_column!r} not found and no prompt and response columns set",
        "dataset.text_column",
    )


def to_preference_rows(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    sources = {
        spec.prompt_column or "prompt": "prompt",
        spec.chosen_column or "chosen": "chosen",
        spec.rejected_column or "rejected": "rejected",
    }
    absent = [target for source, target in sources.items() if source not in df.columns]
    if absent:
        raise DataError(f"missing preference columns: {absent}, have {df.columns}", "dataset")
    return rename(df, {s: t for s, t in sources.items() if s != t})


def normalize_columns(df: DataFrame, method: str, spec: DatasetSpec, order_col: str) -> DataFrame:
    if is_preference(method):
        return to_preference_rows(df, spec)
    return to_text_rows(df, spec, keep=(order_col,))
