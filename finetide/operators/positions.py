"""Dense positions and what the library does by position.

A position needs a total order. The table is range-sorted by Spark, one task per range,
and written once; a row's position is then its index in its file plus the rows in the
files before it. That holds for any order columns and any distribution of their values,
and no task sees more than its own range.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from finetide.errors import DataError
from finetide.session import scratch_path


def with_position(df: DataFrame, order_by: str | Sequence[str], name: str = "position") -> DataFrame:
    """Add the 0-based rank of each row by ``order_by``, whose values must be unique."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    path = scratch_path(df.sparkSession, "ordered")
    df.orderBy(*order).write.parquet(path)
    rows = _stored_rows(df.sparkSession.read.schema(df.schema).parquet(path))
    return rows.join(_offsets(rows), "_pos_file").select(*df.columns, (F.col("_pos_offset") + F.col("_pos_index")).alias(name))


def _stored_rows(stored: DataFrame) -> DataFrame:
    """Rows of sorted files with their file and their place in it."""
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("bigint")
    place = [F.col("_metadata.file_name").alias("_pos_file"), F.col("_metadata.row_index").alias("_pos_index")]
    return stored.select(*stored.columns, part.alias("_pos_part"), *place)


def _offsets(rows: DataFrame, *more: Column) -> DataFrame:
    """Per file the rows in the files before it. One row per file, so the window stays small."""
    sizes = rows.groupBy("_pos_part", "_pos_file").agg(F.count("*").alias("_pos_n"), *more)
    before = Window.partitionBy(F.lit(0)).orderBy("_pos_part", "_pos_file").rowsBetween(Window.unboundedPreceding, -1)
    kept = [c for c in sizes.columns if c not in ("_pos_part", "_pos_file", "_pos_n")]
    return sizes.select("_pos_file", "_pos_n", F.coalesce(F.sum("_pos_n").over(before), F.lit(0)).alias("_pos_offset"), *kept)


class PositionIndex:
    """A table stored in its order, with a line per file: rows before it, rows in it, first and last
    order value. Built once by one range sort; a look-up then opens only the files that hold the
    positions or values it asks for.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.rows = spark.read.parquet(f"{self.path}/rows")
        # A line per file: Spark's own file list, which lies on the driver too, is longer.
        self.files = spark.read.parquet(f"{self.path}/files").orderBy("_pos_offset").collect()

    @classmethod
    def build(cls, df: DataFrame, order_by: str, path: str) -> PositionIndex:
        """Stores ``df`` in the order of ``order_by`` (unique) under ``path``, with its index."""
        root = path.rstrip("/")
        df.orderBy(order_by).write.parquet(f"{root}/rows")
        rows = _stored_rows(df.sparkSession.read.parquet(f"{root}/rows"))
        ends = [F.min(order_by).alias("first"), F.max(order_by).alias("last")]
        _offsets(rows, *ends).coalesce(1).write.parquet(f"{root}/files")
        return cls(df.sparkSession, root)

    def __len__(self) -> int:
        return sum(f["_pos_n"] for f in self.files)

    def _opened(self, names: set[str]) -> DataFrame:
        """The rows of some files, with their positions."""
        if not names:
            empty = self.spark.createDataFrame([], self.rows.schema)
            return empty.withColumn("_position", F.lit(0).cast("bigint"))
        stored = self.spark.read.schema(self.rows.schema).parquet(*[f"{self.path}/rows/{n}" for n in sorted(names)])
        offset = F.create_map(*[F.lit(x) for f in self.files if f["_pos_file"] in names for x in (f["_pos_file"], f["_pos_offset"])])
        place = offset[F.col("_metadata.file_name")] + F.col("_metadata.row_index")
        return stored.select(*stored.columns, place.alias("_position"))

    def row_at(self, index: int) -> DataFrame:
        """The row at a position, counted from the end if negative; reads one file."""
        index = index + len(self) if index < 0 else index
        held = [f for f in self.files if f["_pos_offset"] <= index < f["_pos_offset"] + f["_pos_n"]]
        if not held:
            raise DataError(f"position out of range: {index}", "position")
        return self._opened({held[0]["_pos_file"]}).filter(F.col("_position") == index).drop("_position")

    def between(self, start: int, end: int) -> DataFrame:
        """The rows from position ``start`` up to ``end``, as a slice gives them."""
        start, end, _ = slice(start, end).indices(len(self))
        names = {f["_pos_file"] for f in self.files if f["_pos_offset"] < end and f["_pos_offset"] + f["_pos_n"] > start}
        return self._opened(names).filter(F.col("_position").between(start, end - 1)).drop("_position")

    def numbered(self, name: str = "position") -> DataFrame:
        """All rows with their positions."""
        rows = _stored_rows(self.rows)
        lines = self.spark.read.parquet(f"{self.path}/files").select("_pos_file", "_pos_offset")
        return rows.join(lines, "_pos_file").select(*self.rows.columns, (F.col("_pos_offset") + F.col("_pos_index")).alias(name))

    def gather(self, indices: DataFrame, ordinal: str, index: str) -> DataFrame:
        """The rows at the given positions, one per request, duplicates and negatives allowed.

        The files that are asked for are found first; a position outside the table fails the query.
        """
        total = len(self)
        position = F.when(F.col(index) < 0, F.col(index) + total).otherwise(F.col(index)).cast("bigint")
        message = F.concat(F.lit("position out of range: "), F.col(index).cast("string"))
        checked = F.when(position.between(0, total - 1), position).otherwise(F.raise_error(message).cast("bigint"))
        requests = indices.select(F.col(ordinal), checked.alias("_position"))
        starts = np.array([f["_pos_offset"] for f in self.files], np.int64)

        @F.pandas_udf("int")
        def file_of(places: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(starts, places.to_numpy(), side="right") - 1)

        asked = requests.select(file_of("_position").alias("at")).distinct()
        names = {self.files[r["at"]]["_pos_file"] for r in asked.collect()}  # a number per file at most
        return requests.join(self._opened(names), "_position").drop("_position")


#: Ranges counted per round of a cap, and the rows that are few enough to rank.
RANGES, RANKED_ROWS = 4096, 100_000


def batch_of(df: DataFrame, batch_size: int, position: str = "position", name: str = "batch") -> DataFrame:
    """Number consecutive batches of ``batch_size`` rows; the last one may be short."""
    size = max(1, batch_size)
    return df.withColumn(name, F.floor(F.col(position) / size))


def gather(df: DataFrame, order_by: str, indices: DataFrame, ordinal: str, index: str) -> DataFrame:
    """The rows at the given positions, one per request, duplicates and negatives allowed.

    Only order values are ranked; the requested rows are then fetched by them. A position
    outside the table fails the query.
    """
    places = with_position(df.select(order_by), order_by, "_position")
    total = places.groupBy().count().scalar()
    requests = indices.select(
        F.col(ordinal), F.when(F.col(index) < 0, F.col(index) + total).otherwise(F.col(index)).alias("_position")
    )
    message = F.concat(F.lit("position out of range: "), F.col("_position").cast("string"))
    placed = requests.join(places, "_position", "left").select(
        ordinal, F.coalesce(F.col(order_by), F.raise_error(message).cast(df.schema[order_by].dataType)).alias(order_by)
    )
    return placed.join(df, order_by)


def row_at(df: DataFrame, order_by: str, index: int) -> DataFrame:
    request = df.sparkSession.createDataFrame([(0, index)], "_ordinal bigint, _at bigint")
    return gather(df, order_by, request, "_ordinal", "_at").drop("_ordinal")


def cap_rows(df: DataFrame, order_col: str, cap: int) -> DataFrame:
    """The first ``cap`` rows by ``order_col``: finds the last order value, then filters.

    Numbers are counted in ranges, and the range in which the cap falls is counted again until
    it holds few rows; only those are ranked. Order values of other types are range-sorted.
    The order column must be unique; a null in it fails the query.
    """
    if cap < 1:
        raise DataError("the row cap must be at least 1", "max_rows")
    null = F.raise_error(F.lit(f"null in the order column {order_col}"))
    value = F.when(F.col(order_col).isNull(), null.cast(df.schema[order_col].dataType)).otherwise(F.col(order_col))
    ids = df.select(value.alias(order_col))
    if isinstance(df.schema[order_col].dataType, NumericType):
        ids, cap = _narrowed(ids, order_col, cap)
        last = ids.orderBy(order_col).limit(cap).agg(F.max(order_col))
    else:
        last = with_position(ids, order_col).filter(F.col("position") < cap).agg(F.max(order_col))
    return df.filter(F.col(order_col) <= last.scalar())


def _narrowed(ids: DataFrame, order_col: str, cap: int) -> tuple[DataFrame, int]:
    """The range of order values in which the ``cap``-th row falls, and the rows it still needs.

    Each round reads the one column and gives ``RANGES`` counts at most.
    """
    while True:
        low, high, n = ids.agg(F.min(order_col), F.max(order_col), F.count("*")).head()
        if n <= max(cap, RANKED_ROWS) or low == high:
            return ids, min(cap, max(n, 1))
        share = (F.col(order_col).cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low))
        place = F.least(F.floor(share * RANGES), F.lit(RANGES - 1))
        counts = sorted((r[0], r[1]) for r in ids.groupBy(place.alias("place")).count().collect())
        before = 0
        for chosen, count in counts:
            if before + count >= cap:
                break
            before += count
        if count == n:
            return ids, cap
        ids, cap = ids.filter(place == chosen), cap - before
