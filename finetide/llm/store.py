"""Intermediate tables in the shared folder, and their removal once they are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finetide.session import scratch_path


class Stored:
    """A table written once under ``spark.checkpoint.dir``; a lost executor loses nothing of it."""

    def __init__(self, df: DataFrame, name: str) -> None:
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def held_out(name: str) -> Column:
    """Rows that no model may learn from: crc32 of the id's text modulo 3 is 1. A null id is not held out."""
    crc = F.crc32(F.col(name).cast("string").cast("binary"))
    return F.coalesce(crc % 3 == 1, F.lit(False))


def bounded_sample(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` distinct values of the one column of ``ids``, those of the lowest hashes.

    Values above a hash that leaves about half as many again are dropped where they lie, so the
    tasks together hand on a bounded number, however many they are.
    """
    (name,) = ids.columns
    share = min(1.0, 1.5 * most / max(ids.count(), 1))
    low = F.shiftrightunsigned(F.xxhash64(name), 34) < int(share * (1 << 30)) if share < 1 else F.lit(True)
    return ids.filter(low & F.col(name).isNotNull()).distinct().orderBy(F.xxhash64(name), name).limit(most)


def one_each(rows: DataFrame, mark: str) -> DataFrame:
    """One row per ``id``, that of the least ``mark``: what comes of a sample of ids is as many rows at most."""
    others = [F.col(c) for c in rows.columns if c != "id"]
    least = rows.groupBy("id").agg(F.min_by(F.struct(*others), F.col(mark)).alias("row"))
    return least.select("id", "row.*")
