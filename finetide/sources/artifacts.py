"""Artifact inventory: every file under a root with its size, SHA-256 and first bytes.

Spark's own file sources skip empty files and names that start with a dot or underscore, and would
hold a file whole. So the files are a data source of their own.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith
from pyspark.sql.types import StructType

from finetide.errors import DataError
from finetide.sources.paths import exists, make_folder, qualified

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: What a task takes of the files, in path order.
FILES_PER_TASK = 200
BYTES_PER_TASK = 256 * 1024 * 1024
SAMPLE_BYTES = 512
CHUNK_BYTES = 8 * 1024 * 1024

SCHEMA = "path string, size bigint, sha256 string, sample binary"


def described(files: DataFrame) -> DataFrame:
    """(path, content) rows as (path, size, sha256, sample)."""
    return files.select(
        "path",
        F.octet_length("content").cast("bigint").alias("size"),
        F.sha2("content", 256).alias("sha256"),
        F.substring("content", 1, SAMPLE_BYTES).alias("sample"),
    )


def opened(root: str):
    """The file system of a root URI and the root's path in it."""
    from pyarrow import fs

    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root.removeprefix("file:").strip("/")
    store, path = fs.FileSystem.from_uri(root)
    return store, path.rstrip("/")


def write_files(files: DataFrame, root: str) -> int:
    """Each row (path, content) as a file of its own below ``root``; paths must be unique. Returns their number.

    Tasks write the files themselves, each beside its place and then moved there, so a task that
    starts again writes the same. Spark's writers would go through a folder of the job, a checksum
    file and a move by the driver for each.
    """
    spark = files.sparkSession
    make_folder(spark, root)
    target = qualified(spark, root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(target)
        for batch in batches:
            for path, content in zip(*batch.columns, strict=True):
                parts = (path.as_py() or "").split("/")
                if not content.is_valid or {"", ".", ".."} & set(parts):
                    raise DataError(f"no file to write: {path}", "path")
                folder = "/".join([base, *parts[:-1]])
                draft = f"{folder}/.{uuid.uuid4().hex}"
                store.create_dir(folder, recursive=True)
                with store.open_output_stream(draft) as stream:
                    stream.write(content.as_buffer())
                store.move(draft, f"{folder}/{parts[-1]}")
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(batch)], pa.int64())})

    done = files.select("path", F.col("content").cast("binary").alias("content")).mapInArrow(run, "n bigint")
    return done.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]


class Slice(InputPartition):
    """Neighbouring files in path order, few enough and small enough for a task."""

    def __init__(self, files: list[tuple[str, int]]) -> None:
        self.files = files


class InventoryReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.root = options["path"]
        self.hashed = options.get("hashed", "true") == "true"
        self.paths: set[str] | None = None
        self.prefix = ""

    def _found(self) -> list[tuple[str, int]]:
        """(path below the root, size) of the files that the filters leave, in path order."""
        from pyarrow import fs

        store, base = opened(self.root)
        if self.paths is not None:
            infos = store.get_file_info([f"{base}/{p}" for p in self.paths])
        elif store.get_file_info(base).type == fs.FileType.File:
            infos, base = [store.get_file_info(base)], base.rsplit("/", 1)[0]
        else:
            folder = f"{base}/{self.prefix}".rsplit("/", 1)[0]  # folders beside the prefix's are not listed
            infos = store.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
        files = [(f.path[len(base) + 1 :], f.size) for f in infos if f.type == fs.FileType.File]
        return sorted(f for f in files if f[0].startswith(self.prefix))

    def partitions(self) -> list[InputPartition]:
        slices: list[list[tuple[str, int]]] = [[]]
        size = 0
        for file in self._found():
            if slices[-1] and (len(slices[-1]) >= FILES_PER_TASK or size + file[1] > BYTES_PER_TASK):
                slices.append([])
                size = 0
            slices[-1].append(file)
            size += file[1]
        return [Slice(files) for files in slices]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        store, base = opened(self.root)
        for path, size in partition.files:
            if not self.hashed:
                yield path, size, None, None
                continue
            full = f"{base}/{path}" if store.get_file_info(base).type.name == "Directory" else base
            with store.open_input_stream(full) as stream:
                sample = stream.read(SAMPLE_BYTES)
                digest = hashlib.sha256(sample)
                for chunk in iter(partial(stream.read, CHUNK_BYTES), b""):
                    digest.update(chunk)
            yield path, size, digest.hexdigest(), sample


class FilteredReader(InventoryReader):
    """Takes conditions on the path, so that other folders are neither listed nor read."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            on_path = getattr(f, "attribute", None) == ("path",)
            if on_path and isinstance(f, EqualTo):
                self.paths = {f.value} if self.paths is None else self.paths & {f.value}
            elif on_path and isinstance(f, In):
                self.paths = set(f.value) if self.paths is None else self.paths & set(f.value)
            elif on_path and isinstance(f, StringStartsWith) and f.value.startswith(self.prefix):
                self.prefix = f.value
            else:
                yield f


class Inventory(DataSource):
    """The files below a folder as rows, listed and hashed when the query runs."""

    @classmethod
    def name(cls) -> str:
        return "file_inventory"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return (FilteredReader if self.options.get("filtered") == "true" else InventoryReader)(dict(self.options))


def inventory(spark: SparkSession, root: str, hashed: bool = True) -> DataFrame:
    """All files under ``root``, hidden and empty ones too, with path, size, SHA-256 and first bytes;
    without ``hashed`` only path and size, and no file is opened.

    A lazy scan: listing belongs to planning, as for any file source, hashing to the tasks, chunk by
    chunk. Where ``spark.sql.python.filterPushdown.enabled`` is set, conditions on the path limit
    what is listed.
    """
    if not exists(spark, root):
        raise DataError(f"no folder to list: {root}", "path")
    spark.dataSource.register(Inventory)
    reader = spark.read.format(Inventory.name()).option("hashed", str(hashed).lower())
    return reader.option("filtered", spark.conf.get(PUSHDOWN, "false")).load(qualified(spark, root))


def upload_plan(files: DataFrame, modes: DataFrame, contents: DataFrame) -> DataFrame:
    """Each file with its upload mode: ``regular`` unless the mode table says otherwise; ignored
    files are dropped. ``files`` is (path, size, sha256), as :func:`inventory` gives it. Large
    files carry hash and size; only regular ones fetch their ``contents`` (path, content)."""
    joined = files.join(modes.select("path", F.col("mode").alias("_mode")), "path", "left")
    chosen = joined.withColumn("mode", F.coalesce("_mode", F.lit("regular"))).filter("mode <> 'ignored'")
    large = F.col("mode") == "lfs"
    wanted = chosen.filter(~large).select("path").join(contents.select("path", "content"), "path")
    # Spark breaks base64 into lines; consumers expect one.
    coded = wanted.select("path", F.replace(F.base64("content"), F.lit("\r\n"), F.lit("")).alias("content"))
    return chosen.join(coded, "path", "left").select(
        "path",
        F.when(large, "lfsFile").otherwise("file").alias("key"),
        "mode",
        F.when(large, F.col("sha256")).alias("oid"),
        F.when(large, F.col("size")).alias("size"),
        "content",
    )
