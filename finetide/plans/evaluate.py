"""Evaluate a registered run: benchmarks on its validation rows, metrics into its record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finetide.errors import DataError
from finetide.operators import catalog, evaluation


def metrics_map(metrics: DataFrame) -> DataFrame:
    """A long metrics table as one row with one map; it has a line per metric, not per text."""
    named = metrics.filter("value is not null").select(F.concat_ws("_", "bench", "metric").alias("key"), "value")
    return named.agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("new"))


def evaluate_run(
    spark: SparkSession,
    runs_path: str,
    run_id: str,
    validation: DataFrame,
    id_col: str,
    names: list[str],
    score: evaluation.Scorer,
    write: evaluation.Writer,
    results_path: str,
    max_samples: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Run the benchmarks, store their table, append the run's new state; gives the table.

    Scores are stored before they are used again, as a model would score anew.
    """
    run = catalog.find_run(catalog.read_runs(spark, runs_path), run_id)
    if run.isEmpty():
        raise DataError(f"run not found: {run_id}", "run_id")
    results = evaluation.run_benchmarks(validation, id_col, names, score, write, max_samples, seed)
    evaluation.write_metrics(results, results_path)
    stored = spark.read.schema(evaluation.METRICS_SCHEMA).json(results_path)
    new = metrics_map(stored).withColumn("run_id", F.lit(run_id))
    merged = evaluation.merge_metrics(F.col("metrics"), F.col("new"))
    updates = run.join(new, "run_id").select("run_id", merged.alias("metrics"))
    catalog.append_runs(catalog.updated_runs(run, updates), runs_path)
    return stored
