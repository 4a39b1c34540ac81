"""The split cache: Parquet by split, published by a manifest, and its content address."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import asdict
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finetide.operators.fingerprint import fingerprinted
from finetide.operators.split import checked_splits
from finetide.sources import paths
from finetide.sources.sinks import storable
from finetide.specs import SPLIT_NAMES, DatasetSpec, Filters, SplitSpec

#: Hours for which folders that no manifest names any more are kept.
KEEP_HOURS = 24.0


def address(payload: dict[str, Any]) -> str:
    """The content address of settings, equal to ``keys.config_key`` of their JSON text."""
    text = json.dumps(payload, sort_keys=True, default=str, separators=(",", ":"), ensure_ascii=False)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def data_cache_key(
    spark: SparkSession,
    dataset: DatasetSpec,
    method: str,
    filters: Filters = Filters(),
    split: SplitSpec = SplitSpec(),
    order_col: str | None = None,
) -> str:
    """Changes with the method, any data setting, the order column, and the source: a data file
    at any depth that is added, removed or overwritten gives another key."""
    payload: dict[str, Any] = {
        "method": method,
        "dataset": asdict(dataset),
        "filters": asdict(filters),
        "split": asdict(split),
        "path": paths.qualified(spark, dataset.path),
        "files": paths.content_state(spark, dataset.path),
        "order": order_col,
    }
    return address(payload)


class Versions:
    """Numbered manifests in a folder, each of which names data folders beside it.

    Data are written into fresh folders and become visible with their manifest, which is published
    only if its number is free. So readers see whole data only, what they have opened stays as it is,
    and of two writers that started from the same number one wins and the other takes its manifest.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def newest(self) -> int:
        names = paths.listed(self.spark, f"{self.root}/manifests")
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:1] != "."), default=0)

    def read(self, number: int) -> dict[str, Any] | None:
        """A manifest's entries, or None if there is none or it is no JSON object."""
        if not number:
            return None
        try:
            entry = json.loads(paths.read_text(self.spark, f"{self.root}/manifests/{number:08d}.json"))
        except ValueError:
            return None
        return entry if isinstance(entry, dict) else None

    def fresh(self, kind: str) -> str:
        """The name of a folder no one else writes."""
        return f"{kind}-{uuid.uuid4().hex}"

    def publish(self, number: int, entry: dict[str, Any]) -> bool:
        return paths.publish_text(self.spark, json.dumps(entry, sort_keys=True), f"{self.root}/manifests/{number:08d}.json")

    def sweep(self, kept: list[str], keep_hours: float = KEEP_HOURS) -> None:
        """Removes folders that are neither in ``kept`` nor changed of late: those of replaced
        versions and of writers that died. Rows opened before stay readable until then."""
        before = time.time() - 3600 * keep_hours
        for name, changed in paths.listed(self.spark, self.root).items():
            if name != "manifests" and name not in kept and changed < before:
                paths.remove(self.spark, f"{self.root}/{name}")


def save_splits(df: DataFrame, cache_dir: str, method: str, cache_key: str | None = None) -> str:
    """Write the splits and return the cache's fingerprint.

    A cache that is there is replaced for later readers. If another writer publishes meanwhile, its
    rows stay, these go, and its fingerprint is returned: under one address both are the same. The
    plan runs once: the fingerprint is taken during the write.
    """
    spark = df.sparkSession
    versions = Versions(spark, cache_dir)
    number = versions.newest() + 1
    folder = versions.fresh("data")
    data = f"{versions.root}/{folder}"
    rows, fingerprint = fingerprinted(checked_splits(storable(df)))
    rows.write.partitionBy("split").parquet(data)
    # A train or validation part without rows leaves no folder, but it is a split all the same.
    names = [n for n in SPLIT_NAMES if n != "test" or paths.exists(spark, f"{data}/split={n}")]
    content_hash = fingerprint()
    key = cache_key or versions.root.rsplit("/", 1)[-1]
    entry = {"hash": content_hash, "method": method, "splits": names, "format": "parquet", "cache_key": key, "data": folder}
    if not versions.publish(number, entry):
        paths.remove(spark, data)
        return versions.read(versions.newest())["hash"]
    versions.sweep([folder])
    return content_hash


def is_cached(spark: SparkSession, cache_dir: str) -> bool:
    """Whether a version has been published."""
    return Versions(spark, cache_dir).newest() > 0


def load_splits(spark: SparkSession, cache_dir: str, expected_hash: str | None = None) -> DataFrame | None:
    """The cached rows with their ``split``, or None on any doubt about the cache."""
    versions = Versions(spark, cache_dir)
    entry = versions.read(versions.newest())
    if entry is None or (entry.get("cache_key") and entry["cache_key"] != versions.root.rsplit("/", 1)[-1]):
        return None
    if expected_hash and entry.get("hash") != expected_hash:
        return None
    folder, splits = entry.get("data"), entry.get("splits")
    if not isinstance(folder, str) or "/" in folder or not splits or set(splits) - set(SPLIT_NAMES):
        return None
    if not paths.exists(spark, f"{versions.root}/{folder}/_SUCCESS"):
        return None
    return spark.read.parquet(f"{versions.root}/{folder}").filter(F.col("split").isin(splits))
