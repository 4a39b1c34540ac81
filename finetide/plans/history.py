"""Run history with snapshots: old records are read once and then known by their latest states.

Records are appended as JSON lines and never change. A snapshot holds the latest state per run of
all record files there were, as Parquet, and their names. Reading joins it with the files written
since, whose names are those that Spark lists and the snapshot does not know: no clock decides.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finetide.operators.catalog import RUN_SCHEMA, latest_states, read_runs
from finetide.plans.cache import Versions
from finetide.session import written
from finetide.sources import paths

SNAPSHOTS = "_snapshots"  # Spark's readers pass by names with an underscore


def _record_files(spark: SparkSession, path: str) -> DataFrame:
    return paths.leaf_files(spark, path).select("path")


def _read_files(spark: SparkSession, files: list[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], RUN_SCHEMA)
    named = [re.sub(r"([\\{}\[\]*?])", r"\\\1", f) for f in files]
    return spark.read.schema(RUN_SCHEMA).option("mode", "FAILFAST").json(named)


def read_latest(spark: SparkSession, path: str, *tie_breakers: str) -> DataFrame:
    """The latest state of every run: as ``latest_states(read_runs(...))``, of a snapshot and the
    records since. A snapshot taken with other tie-breakers is not used."""
    if not paths.exists(spark, path):
        return read_runs(spark, path)
    versions = Versions(spark, f"{path.rstrip('/')}/{SNAPSHOTS}")
    entry = versions.read(versions.newest())
    if entry is None or entry["tie_breakers"] != list(tie_breakers):
        return latest_states(read_runs(spark, path), *tie_breakers)
    root = f"{versions.root}/{entry['data']}"
    covered = spark.read.schema("path string").parquet(f"{root}/files")
    later = _record_files(spark, path).join(covered, "path", "left_anti")
    files = sorted(r["path"] for r in later.collect())  # the files since the snapshot; their reader holds the list too
    known = spark.read.schema(RUN_SCHEMA).parquet(f"{root}/states")
    return latest_states(known.unionByName(_read_files(spark, files)), *tie_breakers) if files else known


def compact_runs(spark: SparkSession, path: str, *tie_breakers: str) -> None:
    """Takes a snapshot of the latest states, from the last one and the records since.

    It is published as a whole; of two compactions at once one stays. Records stay where they are.
    A snapshot goes a day after the next one has replaced it.
    """
    versions = Versions(spark, f"{path.rstrip('/')}/{SNAPSHOTS}")
    number, folder = versions.newest() + 1, versions.fresh("data")
    # The list is taken first: a file that comes in between is read again, which changes nothing.
    files = written(_record_files(spark, path), "record-files")
    read_latest(spark, path, *tie_breakers).write.parquet(f"{versions.root}/{folder}/states")
    files.write.parquet(f"{versions.root}/{folder}/files")
    if not versions.publish(number, {"data": folder, "tie_breakers": list(tie_breakers)}):
        paths.remove(spark, f"{versions.root}/{folder}")
        return
    versions.sweep([folder])


def list_latest(spark: SparkSession, path: str) -> DataFrame:
    """The current record of every run, newest run first, through the snapshot."""
    return read_latest(spark, path).orderBy(F.desc("created_at"), "run_id")
