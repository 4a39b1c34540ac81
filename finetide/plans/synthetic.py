"""Synthetic data end to end: seeds, generation with a raw cache, split, split cache."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession

from finetide.operators.dedup import deduplicate
from finetide.operators.filters import apply_filters
from finetide.operators.fingerprint import content_fingerprint
from finetide.operators.generation import get_backend, seed_list, stand_in
from finetide.operators.journal import Journal
from finetide.operators.split import split_exact
from finetide.plans.cache import address, load_splits, save_splits
from finetide.sources import paths
from finetide.sources.files import read_jsonl, read_lines
from finetide.sources.sinks import write_jsonl
from finetide.specs import Filters, GenerationSpec, SplitSpec

WAVE_ROWS = 100_000


def seeds_from(spark: SparkSession, path: str | None) -> DataFrame:
    """Seed prompts as (idx, seed): one per line of a text file, or none."""
    return read_lines(spark, path, "seed") if path else spark.createDataFrame([], "idx bigint, seed string")


def raw_cache_key(spark: SparkSession, spec: GenerationSpec, seeds: DataFrame, base_model: str) -> str:
    payload = {
        "base_model": base_model,
        "synthetic": asdict(spec),
        "seeds": content_fingerprint(seeds).head()["fingerprint"],
        "files": paths.content_state(spark, spec.seed_prompts) if spec.seed_prompts else None,
    }
    return address(payload)


def generate_cached(
    spec: GenerationSpec,
    seeds: DataFrame,
    plug_in: Callable,
    cache_root: str,
    base_model: str = "",
    wave_rows: int = WAVE_ROWS,
    journal_every: int = 1,
    **options,
) -> DataFrame:
    """Generated rows from the raw cache; the generator runs only for what is not there yet.

    Samples are made and stored in waves. A task or job that dies resumes in the first wave not
    finished, with the answers its tasks have noted: after every ``journal_every`` answers, so no
    more than that per task are paid for twice. 0 leaves the notes out, and then a wave is a job.
    As notes lose nothing, one job makes and stores as many missing waves as ``WAVE_ROWS`` hold.
    """
    spark = seeds.sparkSession
    backend = get_backend(spec.backend)
    path = f"{cache_root.rstrip('/')}/raw/{raw_cache_key(spark, spec, seeds, base_model)}.jsonl"
    known = seed_list(seeds, backend.default_seeds)
    noted = backend.notes and journal_every
    size = wave_rows * max(1, WAVE_ROWS // wave_rows) if noted else wave_rows
    there = finished(spark, path)
    missing = list(parts_between(there, spec.n_samples, size))
    for start, end in missing:
        notes = paths.qualified(spark, f"{path}.notes/{start}-{end}")
        more = {"journal": Journal(notes, journal_every)} if noted else {}
        made = backend.run(known.requests(start, end), plug_in, **options, **more)
        write_jsonl(made, f"{path}/{start}-{end}", "overwrite")
        paths.remove(spark, notes)
    schema = backend.run(known.requests(0, 0), plug_in, **options).schema
    rows = read_jsonl(spark, [f"{path}/{start}-{end}" for start, end in there + missing], schema=schema)
    return stand_in(spark) if backend.has_stand_in and rows.isEmpty() else rows


def finished(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """The id ranges stored whole below ``path``, without those that meet an earlier one: waves may
    have had other sizes."""
    ranges = [tuple(map(int, name.split("-"))) for name in paths.listed(spark, path) if re.fullmatch(r"\d+-\d+", name)]
    apart: list[tuple[int, int]] = []
    for start, end in sorted(ranges, key=lambda r: (r[0], -r[1])):
        if (not apart or start >= apart[-1][1]) and paths.exists(spark, f"{path}/{start}-{end}/_SUCCESS"):
            apart.append((start, end))
    return apart


def parts_between(there: list[tuple[int, int]], total: int, size: int) -> Iterator[tuple[int, int]]:
    """What is missing of 0..total-1 beside the ranges that are there, in parts of ``size`` at most."""
    start = 0
    for low, high in [*there, (total, total)]:
        yield from ((at, min(at + size, low)) for at in range(start, low, size))
        start = high


def synthetic_dataset(
    spec: GenerationSpec,
    seeds: DataFrame,
    plug_in: Callable,
    cache_root: str,
    split: SplitSpec = SplitSpec(),
    filters: Filters | None = None,
    method: str = "sft",
    base_model: str = "",
    **options,
) -> DataFrame:
    """Generate, split and cache. Generated rows are neither filtered nor deduplicated
    unless ``filters`` is given."""
    spark = seeds.sparkSession
    raw_key = raw_cache_key(spark, spec, seeds, base_model)
    settings = {"raw": raw_key, "split": asdict(split), "filters": filters and asdict(filters), "method": method}
    cache_dir = f"{cache_root.rstrip('/')}/processed/{address(settings)}"
    cached = load_splits(spark, cache_dir)
    if cached is not None:
        return cached
    rows = generate_cached(spec, seeds, plug_in, cache_root, base_model, **options)
    if filters is not None:
        rows = deduplicate(apply_filters(rows, filters, method), "id", threshold=filters.similarity)
    save_splits(split_exact(rows, "id", split), cache_dir, method)
    return load_splits(spark, cache_dir)
