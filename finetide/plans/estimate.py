"""Step, time and disk estimates from a row count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The planner's cost constants.
GPU_HOURS_PER_STEP = 0.001
DISK_MB_PER_ROW = 0.5
DISK_MB_BASE = 500
DISK_MB_CONVERTED_MODEL = 800
PREPROCESS_SECONDS_PER_ROW = 0.0001


def plan_estimate(
    counted: DataFrame,
    batch_size: int = 4,
    gradient_accumulation_steps: int = 1,
    epochs: int = 1,
    max_iters: int | None = None,
    num_gpus: int = 1,
    cached: bool = False,
    converted_model: bool = False,
) -> DataFrame:
    """One row of estimates from a one-row ``n_rows`` table."""
    n = F.col("n_rows")
    per_step = max(batch_size * gradient_accumulation_steps, 1)
    per_epoch = F.greatest(F.lit(1), F.floor(n / per_step))
    steps = F.lit(max_iters) if max_iters else per_epoch * epochs
    disk = n * DISK_MB_PER_ROW + DISK_MB_BASE + (DISK_MB_CONVERTED_MODEL if converted_model else 0)
    seconds = F.lit(0.0) if cached else F.round(F.greatest(n, F.lit(1)) * PREPROCESS_SECONDS_PER_ROW, 2)
    return counted.select(
        n.alias("data_samples"),
        per_epoch.cast("bigint").alias("steps_per_epoch"),
        steps.cast("bigint").alias("estimated_steps"),
        F.round(steps * GPU_HOURS_PER_STEP * max(num_gpus, 1), 3).alias("estimated_gpu_hours"),
        F.round(disk, 1).alias("estimated_disk_mb"),
        seconds.alias("estimated_preprocess_seconds"),
        F.lit(cached).alias("data_cache_hit"),
    )
