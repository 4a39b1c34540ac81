"""Repeated lines: an index of line hashes in levelled sorted runs, fed batch by batch.

A run is a table of one row per line key, bucketed and sorted by the key, so a batch is merge-joined
with the runs without moving them: only the batch's own keys are shuffled, once, after they are
counted per task. The anti-join tells the batch's new keys, whose keeper is the batch's largest id
that holds them; keys that some run has are only counted. Both become a run of level 0. When a level
has ``FAN_OUT`` runs they are compacted into one of the next level, so a batch meets few runs and a
key is rewritten once a level.

The texts are read twice: for their keys, and to leave lines out. What is shuffled between are
keys of 16 bytes; a line that stands in a third of all documents is one row per task there.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finetide.llm.store import Stored, bounded_sample, remove
from finetide.llm.textcodes import INK_BYTES, lowered, span_hashes, text_parts
from finetide.session import scratch_path

#: Shorter keys are never dropped, nor are keys in fewer documents.
LEAST_LENGTH = 40
LEAST_DOCS = 5
#: Batches that a whole table is fed in, and runs of a level that are compacted into one.
BATCHES = 4
FAN_OUT = 2
#: Ids that are looked at to cut the table into batches of about one size.
SAMPLED_IDS = 1000
_OTHER_BASE = 0xA0761D6478BD642F
KEY = ["h", "g"]


def text_lines(low: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the lines, and each text's first line and the end; an empty text has one."""
    breaks = np.flatnonzero(low == 10)
    text = np.searchsorted(off, breaks, side="right") - 1
    first = np.concatenate([[0], np.cumsum(1 + np.bincount(text, minlength=len(off) - 1))])
    starts, ends = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    inner = np.ones(first[-1], bool)
    inner[first[:-1]] = False
    starts[first[:-1]], starts[inner] = off[:-1], breaks + 1
    inner = np.ones(first[-1], bool)
    inner[first[1:] - 1] = False
    ends[first[1:] - 1], ends[inner] = off[1:], breaks
    return starts, ends, first


def line_keys(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, h, g) of the lines with ``least`` code points or more between the blanks at their ends."""
    ink = np.flatnonzero(INK_BYTES[low])
    a, b = np.searchsorted(ink, starts), np.searchsorted(ink, ends)
    line = np.flatnonzero(a < b)
    head, tail = ink[a[line]], ink[b[line] - 1] + 1
    points = np.zeros(len(low) + 1, np.int64)
    np.cumsum((low & 0xC0) != 0x80, out=points[1:])
    long = points[tail] - points[head] >= least
    line, head, tail = line[long], head[long], tail[long]
    return line, span_hashes(low, head, tail).view(np.int64), span_hashes(low, head, tail, _OTHER_BASE).view(np.int64)


def document_keys(docs: DataFrame, least: int) -> DataFrame:
    """(id, mark, batch, h, g) for each different key of each row of (id, mark, batch, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, data, off in text_parts(batch.column(3)):
                low = lowered(data)
                starts, ends, first = text_lines(low, off)
                line, h, g = line_keys(low, starts, ends, least)
                text = np.searchsorted(first, line, side="right") - 1
                order = np.lexsort((g, h, text))
                text, h, g = text[order], h[order], g[order]
                new = np.ones(len(h), bool)
                new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1]) | (g[1:] != g[:-1])
                own = batch.take(pa.array(text[new] + i))
                yield pa.RecordBatch.from_arrays([*own.columns[:3], pa.array(h[new]), pa.array(g[new])], names=["id", "mark", "batch", *KEY])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, mark bigint, batch int, h bigint, g bigint")


class LineRuns:
    """The index: (h, g, docs, keeper) rows in sorted runs by level.

    ``keeper`` stands in the run of the batch that had a key first and is null in later ones. Runs
    lie under ``spark.checkpoint.dir``; :meth:`drop` removes them.
    """

    def __init__(self, spark: SparkSession, fan_out: int = FAN_OUT, buckets: int | None = None) -> None:
        if fan_out < 2:
            raise ValueError("fan_out must be 2 or more")
        self.spark, self.fan_out = spark, fan_out
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []

    def _written(self, rows: DataFrame) -> tuple[str, str]:
        name, path = f"finetide_line_run_{uuid.uuid4().hex}", scratch_path(self.spark, "line-run")
        rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).format("parquet").saveAsTable(name)
        return name, path

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.spark.sql(f"drop table if exists {name}")
            remove(self.spark, path)

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def add(self, lines: DataFrame) -> None:
        """Adds a batch's (id, h, g) rows, each key once per document: a run of its own, then
        compaction where a level is full."""
        own = lines.groupBy(*KEY).agg(F.count("*").alias("docs"), F.max("id").alias("keeper"))
        known: list[Column] = []
        for number, run in enumerate(self.runs()):
            own = own.join(run.select(*KEY, F.lit(True).alias(f"in_{number}")), KEY, "left")
            known.append(F.col(f"in_{number}"))
        keeper = F.when(F.coalesce(*known).isNull(), F.col("keeper")) if known else F.col("keeper")
        self._put(self._written(own.select(*KEY, "docs", keeper.alias("keeper"))), 0)

    def _put(self, run: tuple[str, str], level: int) -> None:
        self.levels += [[] for _ in range(level + 1 - len(self.levels))]
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_out:
            full, self.levels[level] = self.levels[level], []
            self._put(self._compacted(full), level + 1)

    def _compacted(self, full: list[tuple[str, str]]) -> tuple[str, str]:
        """One run from several, two at a time, the oldest first."""
        done = full[0]
        for run in full[1:]:
            both = self._written(merged(self.spark.table(done[0]), self.spark.table(run[0])))
            self._drop([done, run])
            done = both
        return done

    def entries(self) -> DataFrame:
        """(h, g, docs, keeper), one row per key: all runs compacted into one."""
        live = [run for level in self.levels for run in level]
        self.levels = [[] for _ in self.levels] + [[self._compacted(live)]]
        return self.runs()[0]

    def drop(self) -> None:
        for level in self.levels:
            self._drop(level)
        self.levels = []


def merged(one: DataFrame, other: DataFrame) -> DataFrame:
    """Two sorted runs as one: they lie bucket by bucket, so the merge moves no row."""
    names = {"docs": "more_docs", "keeper": "more_keeper"}
    both = one.join(other.withColumnsRenamed(names), KEY, "full_outer")
    docs = F.coalesce("docs", F.lit(0)) + F.coalesce("more_docs", F.lit(0))
    return both.select(*KEY, docs.cast("bigint").alias("docs"), F.coalesce("keeper", "more_keeper").alias("keeper"))


def _batch_of(docs: DataFrame, batches: int) -> Column:
    """The batch of each id, the largest ids in the first; any cuts are right, these are about even."""
    sample = bounded_sample(docs.select("id"), SAMPLED_IDS)
    ids = sorted((r[0] for r in sample.collect()), reverse=True)
    cuts = sorted({ids[k * len(ids) // batches] for k in range(1, batches)}, reverse=True) if ids else []
    number = F.lit(0)
    for cut in cuts:
        number = number + (F.col("id") < F.lit(cut)).cast("int")
    return F.coalesce(number, F.lit(len(cuts))).alias("batch")


def dedupe(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least_length: int = LEAST_LENGTH, least_docs: int = LEAST_DOCS, batches: int = BATCHES,
) -> DataFrame:
    """``docs`` without the lines that many documents share, and ``n_lines``, ``n_dropped``.

    A text's lines lie between line feeds; a line's key is what is between the blanks at its ends,
    in lower case. Keys of ``least_length`` code points in ``least_docs`` documents stay in the
    largest id that holds them. A null text stays null and counts as one empty line, as an empty one
    does. Every row is a document, also one that repeats an id; of rows with the largest id all keep
    the line. A null id is below all others; a line that only such rows hold stays in all of them.
    Columns keep their places; the counts come last and replace columns of their names. An empty
    table gives an empty one.
    """
    spark = docs.sparkSession
    text, mark = F.col(text_col).cast("string"), F.xxhash64(F.col(text_col).cast("string"))
    own = docs.select(F.col(id_col).alias("id"), mark.alias("mark"), text.alias("text"))
    keys = document_keys(own.select("id", "mark", _batch_of(own, batches), "text"), least_length)
    path = scratch_path(spark, "line-keys")
    keys.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(keys.schema).parquet(path)
    index = LineRuns(spark)
    for number in range(batches):  # the largest ids first, so that a key's first batch has its keeper
        index.add(lines.filter(F.col("batch") == number).select("id", *KEY))
    shared = Stored(index.entries().filter(F.col("docs") >= least_docs).select(*KEY, "keeper"), "shared-lines").df
    index.drop()
    elsewhere = F.coalesce(F.col("id") < F.col("keeper"), F.col("keeper").isNotNull())
    doomed = lines.join(shared, KEY).filter(elsewhere).groupBy("id", "mark").agg(F.collect_set(F.struct(*KEY)).alias("doomed"))
    doomed = Stored(doomed.withColumnsRenamed({"id": "own_id", "mark": "own_mark"}), "doomed-lines").df
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    shape = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    rows = docs.select(shape, F.col(id_col).alias("id"), mark.alias("mark"), text.alias("text"))
    rows = rows.join(doomed, (F.col("mark") == F.col("own_mark")) & F.col("id").eqNullSafe(F.col("own_id")), "left")
    cut = _without(rows.select("row", "text", "doomed"), least_length)
    return cut.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in kept], "n_lines", "n_dropped")


def _without(rows: DataFrame, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, doomed = batch.column("text"), batch.column("doomed")
            out = texts.to_pylist()
            n_lines, n_dropped = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            cut = doomed.is_valid().to_numpy(zero_copy_only=False)
            for i, j, data, off in text_parts(texts):
                low = lowered(data)
                starts, ends, first = text_lines(low, off)
                n_lines[i:j] = np.diff(first)
                if not cut[i:j].any():
                    continue
                line, h, g = line_keys(low, starts, ends, least)
                bounds = np.searchsorted(line, first)
                for k in np.flatnonzero(cut[i:j]).tolist():
                    gone = {(p["h"], p["g"]) for p in doomed[i + k].as_py()}
                    a, b = bounds[k], bounds[k + 1]
                    stay = np.ones(first[k + 1] - first[k], bool)
                    stay[line[a:b] - first[k]] = [pair not in gone for pair in zip(h[a:b].tolist(), g[a:b].tolist(), strict=True)]
                    n_dropped[i + k] = len(stay) - int(stay.sum())
                    at = first[k] + np.flatnonzero(stay)
                    out[i + k] = b"\n".join(data[s:e].tobytes() for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)).decode()
            columns = [batch.column("row"), pa.array(out, pa.string()), pa.array(n_lines), pa.array(n_dropped)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "text", "n_lines", "n_dropped"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, text string, n_lines bigint, n_dropped bigint")
