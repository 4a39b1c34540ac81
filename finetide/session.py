"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # At run time a join whose build partitions all stay below this size skips its sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The file inventory takes conditions on the path.
    "spark.sql.python.filterPushdown.enabled": "true",
    # The digests a stream has seen outgrow executor heaps; this store keeps them on disk.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("finetide")
    settings = {
        **RECOMMENDED,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8" if cores == "*" else str(cores),
        "spark.driver.memory": "12g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it; else one in the warehouse,
    which the session's own default file system holds."""
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate, from file sizes; plans no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, removed when the session's JVM ends."""
    path = f"{shared_dir(spark)}/finetide/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so later steps neither recompute nor reroll it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
