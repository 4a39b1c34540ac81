"""Prepared data that follow a growing folder: what has been prepared is not read again.

Each run reads only the data files that no earlier run has read. Their rows are normalised,
filtered, thinned to the first of each text and stored as a segment. What decides over all rows is
narrow and stored beside them: per kept text its digest, its order value and its row's hashes under
both split names. Merging these gives the rows that an earlier or later file's copy has displaced,
the cut of the split, and the fingerprint, all without a look at an old text. The split is a
comparison with the cut when the rows are read, so a moved cut rewrites nothing.

A file that has changed or gone, or new files with other columns, means a run from the start.
"""

from __future__ import annotations

import hashlib
from dataclasses import asdict
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finetide.errors import DataError
from finetide.functions.keys import KEY_LENGTH
from finetide.functions.text import digest, text_or_none
from finetide.operators.dedup import bad_value
from finetide.operators.filters import apply_filters
from finetide.operators.fingerprint import HEX_DIGITS, row_hash
from finetide.operators.normalize import normalize_columns, text_key
from finetide.operators.split import label, split_cut
from finetide.plans.cache import Versions, address
from finetide.session import written
from finetide.sources import files, paths
from finetide.specs import DatasetSpec, Filters, SplitSpec

#: Segments that are rewritten as one, without the rows displaced since.
MOST_SEGMENTS = 32
NAMES = ("train", "validation")
_HASHES = [f"_{name}_{part}" for name in NAMES for part in ("low", "high")]
_FILE = ["path", "length", "modified"]


def _parts(hashed: Column, name: str) -> list[Column]:
    number = lambda start: F.conv(F.substring(hashed, start, HEX_DIGITS), 16, 10).cast("bigint")
    return [number(1).alias(f"_{name}_low"), number(1 + HEX_DIGITS).alias(f"_{name}_high")]


def _file_list(spark: SparkSession, path: str) -> DataFrame:
    rows = paths.leaf_files(spark, path).select("path", "length", F.unix_micros("modificationTime").alias("modified"))
    return written(rows, "listing")


class Prepared:
    """The stored state of one dataset under one group of settings."""

    def __init__(
        self, spark: SparkSession, dataset: DatasetSpec, order_col: str, cache_root: str,
        method: str = "sft", filters: Filters = Filters(), split: SplitSpec = SplitSpec(),
    ) -> None:
        if dataset.max_rows is not None or filters.near_copies:
            raise DataError("a row cap and near copies depend on all rows at once; prepare without appending", "appending")
        self.spark, self.dataset, self.order_col = spark, dataset, order_col
        self.method, self.filters, self.split = method, filters, split
        settings = {
            "method": method, "dataset": asdict(dataset), "filters": asdict(filters), "split": asdict(split),
            "path": paths.qualified(spark, dataset.path), "order": order_col,
        }
        self.versions = Versions(spark, f"{cache_root.rstrip('/')}/appended/{address(settings)}")

    def _path(self, name: str) -> str:
        return f"{self.versions.root}/{name}"

    def _table(self, names: str | list[str]) -> DataFrame:
        names = [names] if isinstance(names, str) else names
        return self.spark.read.parquet(*[self._path(n) for n in names])

    def _state(self) -> dict[str, Any] | None:
        entry = self.versions.read(self.versions.newest())
        if entry is None or not all(paths.exists(self.spark, self._path(f"{n}/_SUCCESS")) for n in entry["segments"]):
            return None
        return entry

    def refreshed(self) -> DataFrame:
        """The prepared rows with their ``split``, brought up to the files that are there now."""
        if not paths.exists(self.spark, self.dataset.path):
            raise DataError(f"dataset path not found: {self.dataset.path}", "dataset.path")
        number, state = self.versions.newest(), self._state()
        now = _file_list(self.spark, self.dataset.path)
        new = now
        if state is not None:
            known = self._table(f"{state['tables']}/files")
            if not known.join(now, _FILE, "left_anti").isEmpty():
                state = None
            else:
                new = now.join(known, _FILE, "left_anti")
        wanted = sorted(r["path"] for r in new.select("path").collect())  # Spark's own reader holds this list too
        if state is None and not wanted:
            raise DataError(f"no data files under {self.dataset.path}", "dataset.path")
        if wanted:
            state = self._extended(number, state, wanted, now)
        return self.refreshed() if state is None else self._rows(state)

    def fingerprint(self) -> str | None:
        """The content fingerprint of the prepared rows, as it would be taken from them."""
        state = self._state()
        return state and state["hash"]

    def _extended(self, number: int, state: dict[str, Any] | None, wanted: list[str], now: DataFrame) -> dict[str, Any] | None:
        """The state with the ``wanted`` files added, or None if another writer was first."""
        segment = self.versions.fresh("segment")
        columns = self._write_segment(segment, wanted)
        if state is not None and state["columns"] != columns:
            return self._extended(number, None, sorted(r["path"] for r in now.select("path").collect()), now)
        segments = [*(state["segments"] if state else []), segment]
        orders = self._table([f"{s}/orders" for s in segments])
        if bad := bad_value(orders, self.order_col).head():
            raise DataError(f"{self.order_col} is null or repeats: {bad[0]}", self.order_col)
        tables = self.versions.fresh("tables")
        narrow = [self.order_col, "_digest", *_HASHES]
        found = self._table(f"{segment}/rows").select(*narrow)
        if state is not None:
            found = found.unionByName(self._table(f"{state['tables']}/kept").select(*narrow))
        first = found.groupBy("_digest").agg(F.min(self.order_col).alias(self.order_col)).select(self.order_col)
        found.join(first, self.order_col, "left_semi").write.parquet(self._path(f"{tables}/kept"))
        kept = self._table(f"{tables}/kept")
        stored = self._table([f"{s}/rows" for s in segments]).select(self.order_col)
        stored.join(kept.select(self.order_col), self.order_col, "left_anti").write.parquet(self._path(f"{tables}/displaced"))
        split_cut(kept.select(self.order_col), self.order_col, self.split).write.parquet(self._path(f"{tables}/cut"))
        now.write.parquet(self._path(f"{tables}/files"))
        entry = {"segments": segments, "tables": tables, "columns": columns, "method": self.method}
        entry["hash"] = self._hash(self._labelled(kept, tables))
        if len(segments) > MOST_SEGMENTS:
            entry = self._compacted(entry)
        if not self.versions.publish(number + 1, entry):
            for name in (segment, tables, *entry["segments"][len(segments) :]):
                paths.remove(self.spark, self._path(name))
            return None
        self.versions.sweep([*entry["segments"], entry["tables"]])
        return entry

    def _write_segment(self, segment: str, wanted: list[str]) -> list[str]:
        """Stores the kept rows of some files, and the order values of all their rows."""
        raw = files.load_files(self.spark, self.dataset, wanted)
        raw.select(self.order_col).write.parquet(self._path(f"{segment}/orders"))
        rows = normalize_columns(raw, self.method, self.dataset, self.order_col)
        columns = [f"{name} {kind}" for name, kind in rows.dtypes]
        passed = apply_filters(rows, self.filters, self.method).withColumn("_digest", digest(text_or_none(F.col(text_key(rows)))))
        first = passed.groupBy("_digest").agg(F.min(self.order_col).alias(self.order_col)).select(self.order_col)
        kept = passed.join(first, self.order_col, "left_semi")
        data = [F.col(f"`{c}`") for c in rows.columns]
        hashes = [h for name in NAMES for h in _parts(row_hash(rows, {"split": F.lit(name)}), name)]
        kept.select(*data, "_digest", *hashes).write.parquet(self._path(f"{segment}/rows"))
        paths.publish_text(self.spark, "", self._path(f"{segment}/_SUCCESS"))
        return columns

    def _labelled(self, rows: DataFrame, tables: str) -> DataFrame:
        return label(rows, self.order_col, self._table(f"{tables}/cut"), self.split)

    def _hash(self, kept: DataFrame) -> str:
        def total(part: str) -> Column:
            value = F.when(F.col("split") == "train", F.col(f"_train_{part}")).otherwise(F.col(f"_validation_{part}"))
            return F.coalesce(F.sum(value.cast("decimal(20,0)")), F.lit(0)).cast("string")

        sums = kept.agg(F.count("*"), total("low"), total("high")).head()
        return hashlib.sha256(":".join(map(str, sums)).encode()).hexdigest()[:KEY_LENGTH]

    def _stored(self, state: dict[str, Any]) -> DataFrame:
        rows = self._table([f"{s}/rows" for s in state["segments"]])
        return rows.join(self._table(f"{state['tables']}/displaced"), self.order_col, "left_anti")

    def _rows(self, state: dict[str, Any]) -> DataFrame:
        return self._labelled(self._stored(state).drop("_digest", *_HASHES), state["tables"])

    def _compacted(self, entry: dict[str, Any]) -> dict[str, Any]:
        """All segments as one, without displaced rows; the old ones are swept when they are old."""
        segment, tables = self.versions.fresh("segment"), self.versions.fresh("tables")
        self._stored(entry).write.parquet(self._path(f"{segment}/rows"))
        self._table([f"{s}/orders" for s in entry["segments"]]).write.parquet(self._path(f"{segment}/orders"))
        paths.publish_text(self.spark, "", self._path(f"{segment}/_SUCCESS"))
        for name in ("kept", "cut", "files"):
            self._table(f"{entry['tables']}/{name}").write.parquet(self._path(f"{tables}/{name}"))
        self._table(f"{entry['tables']}/displaced").limit(0).write.parquet(self._path(f"{tables}/displaced"))
        return {**entry, "segments": [segment], "tables": tables}
