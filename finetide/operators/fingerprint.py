"""Content fingerprint and per-split statistics."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, TimestampType

from finetide.functions.keys import KEY_LENGTH, short_hash

HEX_DIGITS = 15  # 60 bits, so one value fits a bigint and a decimal sum never overflows


def _cell(df: DataFrame, name: str) -> Column:
    """A cell as its length and text, so that no two different rows read alike."""
    c = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    text = F.to_json(_ordered(c, kind)) if isinstance(kind, (ArrayType, MapType, StructType)) else _ordered(c, kind).cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _ordered(c: Column, kind: DataType) -> Column:
    """The value with instants as microseconds, whatever the session's time zone, and map entries in key order."""
    if isinstance(kind, TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: _ordered(x, kind.elementType))
    if isinstance(kind, MapType):
        pairs = F.transform(F.map_entries(c), lambda e: F.struct(e["key"].alias("key"), _ordered(e["value"], kind.valueType).alias("value")))
        return F.array_sort(pairs, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    if isinstance(kind, StructType):
        fields = F.struct(*[_ordered(c.getField(f.name), f.dataType).alias(f.name) for f in kind.fields])
        return F.when(c.isNotNull(), fields)
    return c


def row_hash(df: DataFrame, more: dict[str, Column] | None = None) -> Column:
    """The hash of a row, as if it also had the text columns ``more``."""
    cells = {name: _cell(df, name) for name in df.columns}
    cells |= {name: F.concat(F.length(c).cast("string"), F.lit(":"), c) for name, c in (more or {}).items()}
    return F.sha2(F.concat_ws("|", *[cells[name] for name in sorted(cells)]), 256)


def _sums(row: str) -> list[Column]:
    def total(start: int) -> Column:
        number = F.conv(F.substring(row, start, HEX_DIGITS), 16, 10).cast("decimal(20,0)")
        return F.coalesce(F.sum(number), F.lit(0)).cast("string")

    return [F.count("*").alias("n_rows"), total(1).alias("low"), total(1 + HEX_DIGITS).alias("high")]


def content_fingerprint(df: DataFrame) -> DataFrame:
    """One row: ``n_rows`` and a 16-digit ``fingerprint`` of the multiset of rows.

    Rows are hashed where they lie and the hashes are added up, so neither row order nor
    partitioning matters and only sums are shuffled. ``split``, if present, counts in.
    """
    sums = df.select(row_hash(df).alias("row")).agg(*_sums("row"))
    return sums.select("n_rows", short_hash(F.concat_ws(":", "n_rows", "low", "high")).alias("fingerprint"))


def fingerprinted(df: DataFrame) -> tuple[DataFrame, Callable[[], str]]:
    """``df`` unchanged, and a function that gives its fingerprint once ``df`` has been written.

    The sums are taken while the rows pass to the writer, which saves reading them again.
    They belong to the tasks that write, whose results count once however often they run.
    """
    seen = Observation()
    watched = df.withColumn("_row_hash", row_hash(df)).observe(seen, *_sums("_row_hash")).drop("_row_hash")

    def result() -> str:
        sums = seen.get
        text = f"{sums['n_rows']}:{sums['low']}:{sums['high']}"
        return hashlib.sha256(text.encode()).hexdigest()[:KEY_LENGTH]

    return watched, result


def split_stats(df: DataFrame) -> DataFrame:
    """Rows per split and the columns they have."""
    columns = F.array(*[F.lit(c) for c in df.columns if c != "split"])
    return df.groupBy("split").agg(F.count("*").alias("num_rows")).withColumn("columns", columns)
