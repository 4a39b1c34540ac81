"""Run history: an append-only table of run states, and the questions asked of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from finetide.errors import DataError
from finetide.functions.keys import config_key
from finetide.sources.paths import exists

# The states a run can be in, and the fields of a run record.
RUN_STATUSES = ("pending", "data_gen", "training", "eval", "export", "completed", "failed", "interrupted")
RUN_SCHEMA = (
    "run_id string, run_name string, status string, config string, created_at string, updated_at string, "
    "git_commit string, data_hash string, checkpoint_path string, global_step bigint, "
    "metrics map<string,double>, error string, config_dir string"
)
CHECKPOINT_PATTERN = r"^((?:.*/)?checkpoint-(?:[^/]*-)?([0-9]+))(?:/.*)?$"
FINAL_PATTERN = r"^((?:.*/)?final)(?:/.*)?$"


def utc_now() -> Column:
    """The current time in ISO form, in UTC whatever the session's time zone."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def create_runs(configs: DataFrame) -> DataFrame:
    """New pending run records for (run_name, config[, git_commit, config_dir]) rows."""
    schema = StructType.fromDDL(RUN_SCHEMA)
    fresh = {"run_id": F.uuid(), "status": F.lit("pending"), "created_at": utc_now(), "updated_at": utc_now()}
    fresh["global_step"] = F.lit(0)
    fresh["metrics"] = F.create_map()

    def cell(name: str, kind) -> Column:
        source = fresh.get(name, F.col(name) if name in configs.columns else F.lit(None))
        return source.cast(kind).alias(name)

    return configs.select(*[cell(f.name, f.dataType) for f in schema.fields])


def append_runs(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("ignoreNullFields", "false").json(path)


def check_status(status: Column) -> Column:
    message = F.concat(F.lit("unknown run status: "), status)
    return F.when(status.isin(*RUN_STATUSES), status).otherwise(F.raise_error(message).cast("string"))


def updated_runs(current: DataFrame, updates: DataFrame) -> DataFrame:
    """State rows to append: current records with the fields that (run_id, ...) updates set.

    An update sets every column it has, to null as well. Of several updates of a run the latest
    counts, by ``updated_at`` or, without that column, by their values. Columns that no record
    has are ignored; an update of an unknown run fails the query.
    """
    known = [c for c in current.columns if c in updates.columns and c != "run_id"]
    renamed = latest_states(updates).select("run_id", *[F.col(c).alias(f"_new_{c}") for c in known])
    found = renamed.join(current.withColumn("_known", F.lit(True)), "run_id", "left")
    unknown = F.raise_error(F.concat(F.lit("run not found: "), F.coalesce("run_id", F.lit("null"))))
    joined = found.withColumn("run_id", F.when(F.col("_known"), F.col("run_id")).otherwise(unknown.cast("string")))
    merged = {c: F.col(f"_new_{c}") for c in known}
    if "status" in merged:
        merged["status"] = check_status(merged["status"])
    if "updated_at" not in known:
        merged["updated_at"] = utc_now()
    return joined.select(*[merged.get(c, F.col(c)).alias(c) for c in current.columns])


def read_runs(spark: SparkSession, path: str, prefix: str = "", one_per_file: bool = False) -> DataFrame:
    """Run states stored as JSON lines, or ``one_per_file``; ``prefix`` selects files by name."""
    if not exists(spark, path):
        return spark.createDataFrame([], RUN_SCHEMA)
    reader = spark.read.schema(RUN_SCHEMA).option("mode", "FAILFAST").option("multiLine", one_per_file)
    rows = reader.json(path)
    return rows.filter(F.col("_metadata.file_name").startswith(prefix.replace("/", "_"))) if prefix else rows


def latest_states(states: DataFrame, *tie_breakers: str) -> DataFrame:
    """The last written state of each run; states of the same time rank by ``tie_breakers``, or
    without any by their whole content. Spark keeps one row per run in each map task before
    the shuffle, so a run with very many states costs no more than others."""
    order = [F.desc(c) for c in tie_breakers] or [F.desc(F.to_json(F.struct("*")))]
    time = [F.desc("updated_at")] if "updated_at" in states.columns else []
    newest = Window.partitionBy("run_id").orderBy(*time, *order)
    return states.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def list_runs(states: DataFrame) -> DataFrame:
    """The current record of every run, newest run first."""
    return latest_states(states).orderBy(F.desc("created_at"), "run_id")


def find_run(states: DataFrame, run_id: str) -> DataFrame:
    """The current record of one run."""
    return latest_states(states.filter(F.col("run_id") == run_id))


def latest_checkpoints(
    paths: DataFrame, recorded: DataFrame | None = None, recorded_must_exist: bool = False
) -> DataFrame:
    """Per run the checkpoint folder with the highest number; names without one are ignored.

    ``paths`` is (run_id, path): folders, or the files in them. ``recorded`` (run_id,
    checkpoint_path) serves runs without a numbered folder, if need be only where ``paths``
    shows it.
    """
    step = F.regexp_extract("path", CHECKPOINT_PATTERN, 2).try_cast("bigint")
    folder = F.regexp_extract("path", CHECKPOINT_PATTERN, 1)
    numbered = paths.select("run_id", folder.alias("folder"), step.alias("step")).filter("step is not null")
    # One row per run and map task passes to the shuffle; of equal numbers the last folder by name.
    highest = Window.partitionBy("run_id").orderBy(F.desc("step"), F.desc("folder"))
    best = numbered.withColumn("_n", F.row_number().over(highest)).filter("_n = 1")
    best = best.select("run_id", "step", F.col("folder").alias("checkpoint"))
    if recorded is None:
        return best
    if recorded_must_exist:
        listed = paths.select("run_id", F.col("path").alias("checkpoint_path"))
        recorded = recorded.join(listed, ["run_id", "checkpoint_path"], "left_semi")
    joined = recorded.select("run_id", "checkpoint_path").join(best, "run_id", "full")
    chosen = F.coalesce("checkpoint", "checkpoint_path").alias("checkpoint")
    return joined.select("run_id", "step", chosen).filter("checkpoint is not null")


def resume_checkpoint(paths: DataFrame) -> DataFrame:
    """Per run the numbered folder to resume from, or else the one called ``final``."""
    final = paths.select("run_id", F.regexp_extract("path", FINAL_PATTERN, 1).alias("folder")).filter("folder <> ''")
    return latest_checkpoints(paths, final.groupBy("run_id").agg(F.max("folder").alias("checkpoint_path")))


def config_drift(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Runs whose current configuration is no longer the one stored, with both hashes.
    Key order and number spelling do not count as a difference. Only configurations whose
    text differs are parsed."""
    pairs = stored.select("run_id", "config").join(current.select("run_id", F.col("config").alias("_new")), "run_id")
    pairs = pairs.filter(~F.col("config").eqNullSafe(F.col("_new")))
    pairs = pairs.select("run_id", config_key(F.col("config")).alias("original_hash"), config_key(F.col("_new")).alias("new_hash"))
    # A null-safe test, because Spark would guard a plain one by computing each hash once more.
    return pairs.filter(~F.col("original_hash").eqNullSafe(F.col("new_hash")))


def check_resume(stored: DataFrame, current: DataFrame) -> None:
    drifted = config_drift(stored, current).head(1)
    if drifted:
        row = drifted[0]
        raise DataError(
            f"configuration of run {row['run_id']} has changed: {row['original_hash']} -> {row['new_hash']}", "config"
        )
