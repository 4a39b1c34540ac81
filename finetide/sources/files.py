"""Reading JSONL, CSV, Parquet and plain lines; counting rows without loading them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from finetide.errors import DataError
from finetide.functions.text import is_blank, strip
from finetide.operators.positions import with_position
from finetide.sources.paths import exists, is_file, leaf_files
from finetide.specs import DatasetSpec

# The file names looked for under a dataset root, in this order.
CANDIDATE_FILES = ("train.jsonl", "data.jsonl", "train.csv", "validation.jsonl")
#: Files looked into in one job for a first record.
FILES_AT_A_TIME = 4096


def read_jsonl(
    spark: SparkSession, path: str | list[str], schema: StructType | str | None = None, schema_mode: str = "union", **options: str
) -> DataFrame:
    """JSON lines; blank lines are skipped and a malformed one fails the query.

    Without ``schema`` Spark infers one in an extra pass over the files; give one for large
    input. ``schema_mode="first_row"`` keeps the first record's columns, in its order.
    """
    if schema_mode not in ("union", "first_row"):
        raise DataError(f"unknown schema mode {schema_mode!r}", "schema_mode")
    reader = spark.read.option("mode", "FAILFAST").options(**options)
    rows = (reader.schema(schema) if schema is not None else reader).json(path)
    return rows.select(*_first_record_keys(spark, path)) if schema_mode == "first_row" else rows


def _first_record_keys(spark: SparkSession, path: str) -> list[str]:
    """Keys of the first record in the first file by name that holds one.

    Spark lists the files. One is looked into, then more at a time, so many files without a record
    cost few jobs; the files of the round that has one are halved down to the first.
    """
    records = lambda names: spark.read.text(names).filter(~is_blank(F.col("value")))
    files = leaf_files(spark, path).filter("length > 0").select("path")
    done, some = F.lit(True), 1
    while names := [r["path"] for r in files.filter(done).orderBy("path").limit(some).collect()]:
        done, some = F.col("path") > names[-1], min(8 * some, FILES_AT_A_TIME)
        if records(names).isEmpty():
            continue
        while len(names) > 1:
            half = names[: len(names) // 2]
            names = names[len(half) :] if records(half).isEmpty() else half
        return records(names).select(F.json_object_keys("value").alias("keys")).head()["keys"]
    raise DataError(f"no record in {path}", "dataset.path")


def read_csv(spark: SparkSession, path: str | list[str], multiline: bool = False, **options: str) -> DataFrame:
    """CSV with a header; every cell is a string and an empty or missing one is ``''``.

    Spark splits the files unless ``multiline`` is asked for, which quoted line breaks need and
    which reads each file in one task. Cells beyond the header's are dropped.
    """
    rows = spark.read.options(**options).csv(path, header=True, multiLine=multiline, quote='"', escape='"', inferSchema=False)
    return rows.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns])


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deal out the rows of an input that one row group or one unsplittable file would leave
    to a single task, where the caller asks for it."""
    return df.repartition(partitions) if partitions else df


def first_candidate(spark: SparkSession, root: str) -> DatasetSpec:
    """The first of the well-known files that exists under ``root``."""
    for name in CANDIDATE_FILES:
        path = f"{root.rstrip('/')}/{name}"
        if exists(spark, path):
            return DatasetSpec(path=path, format=name.rsplit(".", 1)[-1])
    raise DataError(f"none of {', '.join(CANDIDATE_FILES)} under {root}", "dataset.path")


def read_first_candidate(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, first_candidate(spark, root))


def load(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    if not exists(spark, spec.path):
        raise DataError(f"dataset path not found: {spec.path}", "dataset.path")
    if spec.format == "candidates":
        return read_first_candidate(spark, spec.path)
    if spec.format == "jsonl":
        return spread(read_jsonl(spark, spec.path, spec.schema), spec.partitions)
    if spec.format == "csv":
        return spread(read_csv(spark, spec.path, spec.multiline), spec.partitions)
    return spread(read_parquet(spark, spec.path), spec.partitions)


def load_files(spark: SparkSession, spec: DatasetSpec, paths: list[str]) -> DataFrame:
    """Some of a dataset's files, with the columns that the folders between give."""
    if spec.format == "candidates":
        spec = first_candidate(spark, spec.path)
    named = [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths]
    base = {"basePath": spec.path} if not is_file(spark, spec.path) else {}
    if spec.format == "jsonl":
        rows = read_jsonl(spark, named, spec.schema, **base)
    elif spec.format == "csv":
        rows = read_csv(spark, named, spec.multiline, **base)
    else:
        rows = spark.read.options(**base).parquet(*named)
    return spread(rows, spec.partitions)


def read_lines(spark: SparkSession, path: str, name: str = "value") -> DataFrame:
    """Lines in file order as (idx, line), stripped, without blank ones; no path, no lines.

    Within a task rows come in file order, so file, split start and a rising id order all.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], f"idx bigint, {name} string")
    lines = spark.read.text(path).select(
        strip(F.col("value")).alias(name),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
    )
    ranked = with_position(lines.filter(F.col(name) != ""), ["_file", "_start", "_row"], "idx")
    return ranked.select("idx", name)


def read_numbered(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with ``line``, their number over all files in the order of their names."""
    lines = read_lines(spark, path)
    return lines.select(F.col("idx").alias("line"), F.from_json("value", schema, {"mode": "FAILFAST"}).alias("row")).select("line", "row.*")


def count_rows(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    """One row, ``n_rows``. Reads no cell values: lines for JSONL, footers for Parquet."""
    if not exists(spark, spec.path):
        return spark.createDataFrame([(0,)], "n_rows bigint")
    if spec.format == "jsonl":
        rows = spark.read.text(spec.path).filter(~is_blank(F.col("value")))
    elif spec.format == "parquet":
        rows = read_parquet(spark, spec.path)
    elif spec.format == "csv":
        rows = read_csv(spark, spec.path, spec.multiline)
    else:
        return count_rows(spark, first_candidate(spark, spec.path))
    return rows.agg(F.count("*").alias("n_rows"))
