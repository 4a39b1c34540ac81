"""The same preparation over a landing folder, as Structured Streaming.

Progress and state live in the checkpoint folder of each query, so a lost executor or a
restart continues where the last committed batch ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from finetide.errors import DataError
from finetide.functions.text import digest, text_or_none
from finetide.operators.filters import apply_filters
from finetide.operators.normalize import normalize_columns, text_key
from finetide.operators.positions import cap_rows
from finetide.operators.split import split_by_fraction
from finetide.session import written
from finetide.sources import paths
from finetide.specs import DatasetSpec, Filters, SplitSpec


def read_stream(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "jsonl", max_files: int = 1000, multiline: bool = False
) -> DataFrame:
    """New files of a folder, ``max_files`` per batch. A stream needs its schema up front. CSV files
    are split among tasks unless ``multiline`` is asked for, which quoted line breaks need."""
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if fmt == "jsonl":
        return source.option("mode", "FAILFAST").json(path)
    if fmt == "csv":
        cells = source.csv(path, header=True, multiLine=multiline, quote='"', escape='"')
        return cells.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in cells.columns])
    if fmt == "parquet":
        return source.parquet(path)
    raise DataError(f"format {fmt!r} cannot be streamed", "dataset.format")


def preprocess_stream(
    stream: DataFrame,
    order_col: str,
    method: str = "sft",
    dataset: DatasetSpec | None = None,
    filters: Filters = Filters(),
) -> DataFrame:
    """Normalise and filter; stateless, and the same expressions as in batch."""
    rows = normalize_columns(stream, method, dataset or DatasetSpec(path=""), order_col)
    return apply_filters(rows, filters, method)


def deduplicate_stream(
    stream: DataFrame, key: str | None = None, event_time: str | None = None, delay: str | None = None
) -> DataFrame:
    """Let each normalised text through once, adding its ``digest``.

    The first copy to arrive survives, which is not always the one with the lowest order
    value. Rows move to their digest's state, so this suits rows without long texts; whole
    documents take :func:`write_deduplicated`. State keeps every digest unless ``event_time``
    and ``delay`` bound it.
    """
    keyed = _with_digest(stream, key)
    if event_time and delay:
        return keyed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["digest"])
    return keyed.dropDuplicates(["digest"])


def _with_digest(rows: DataFrame, key: str | None = None) -> DataFrame:
    return rows.withColumn("digest", digest(text_or_none(F.col(key or text_key(rows)))))


def write_deduplicated(
    stream: DataFrame,
    order_col: str,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = (),
    event_time: str | None = None,
    delay: str | None = None,
) -> StreamingQuery:
    """Append each normalised text once, with its ``digest``: of a batch's copies the lowest
    ``order_col``, of an earlier batch's the one already written.

    A batch is thinned by the batch plan to one (digest, order value) pair per text, reduced before
    its shuffle; the pairs pass through a stateful query of their own, which knows the digests of all
    batches before (see :class:`Seen`), and what it lets through picks the batch's rows. Texts move
    once, on the order column; nothing that was written is read. With ``event_time`` and ``delay`` a
    text counts as new again if its copies are older than the batch's oldest row by more than the
    delay. A repeated batch replaces its own folder.
    """
    seen = Seen(f"{checkpoint.rstrip('/')}/digests", order_col, delay if event_time else None)

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = _with_digest(batch)
        times = [F.min(event_time).alias("at")] if event_time and delay else []
        pairs = fresh.groupBy("digest").agg(F.min(order_col).alias(order_col), *times)
        new = seen.new(pairs, batch_id)
        kept = fresh.join(new.select(order_col), order_col, "left_semi")
        kept.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/_batch={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


class Seen:
    """The digests of all earlier batches, as the state of a streaming query over narrow rows.

    The pairs of a batch are files of that query's source, so it is run once per batch and ends; its
    state lies in its checkpoint, in RocksDB with the recommended setting. A batch that is repeated
    finds its pairs and the answer where the first attempt left them. Folders of batches before the
    last are removed. With a ``delay`` the state forgets: before the pairs a row with the batch's
    oldest time is sent ahead, which moves the watermark, so that what is older by more than the
    delay has left the state when the pairs come.
    """

    def __init__(self, folder: str, order_col: str, delay: str | None) -> None:
        self.folder, self.order_col, self.delay = folder, order_col, delay

    def new(self, pairs: DataFrame, batch_id: int) -> DataFrame:
        """Those of the (digest, order value[, at]) rows, one per digest, whose digest is new."""
        spark = pairs.sparkSession
        source, answer = f"{self.folder}/pairs/n={batch_id}", f"{self.folder}/new/{batch_id}"
        if not paths.exists(spark, f"{source}/_SUCCESS"):
            pairs = self._timed(pairs, batch_id) if self.delay else pairs
            pairs.write.mode("overwrite").parquet(source)
        kind = spark.read.parquet(source).schema
        self._run(spark, kind, batch_id, answer)
        for folder in ("pairs/n=", "clock/n=", "new/"):
            paths.remove(spark, f"{self.folder}/{folder}{batch_id - 2}")
        narrow = kind[self.order_col].dataType.simpleString()
        if not paths.exists(spark, answer):
            return spark.createDataFrame([], f"{self.order_col} {narrow}")
        return spark.read.schema(f"{self.order_col} {narrow}").option("recursiveFileLookup", "true").parquet(answer)

    def _timed(self, pairs: DataFrame, batch_id: int) -> DataFrame:
        """Moves the watermark to the oldest row, and sets times before it to it: no row is too late."""
        spark = pairs.sparkSession
        pairs = written(pairs, "pairs")
        oldest = pairs.agg(F.unix_micros(F.min("at"))).head()[0]
        last = f"{self.folder}/clock/n={batch_id - 1}"
        before = int(paths.read_text(spark, last)) if paths.exists(spark, last) else None
        clock = max(t for t in (oldest, before, 1000) if t is not None)  # watermarks start at 1970
        if not paths.exists(spark, f"{self.folder}/clock/n={batch_id}"):
            paths.publish_text(spark, str(clock), f"{self.folder}/clock/n={batch_id}")
        ahead = F.timestamp_micros(F.lit(clock - 1000)) + F.expr(f"interval {self.delay}")
        values = {"digest": F.encode(F.lit(f"clock {batch_id}"), "UTF-8"), "at": ahead}
        row = spark.range(1).select(*[values.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in pairs.schema])
        row.write.mode("overwrite").parquet(f"{self.folder}/pairs/n=-{batch_id + 1}")
        self._run(spark, pairs.schema, batch_id, None)
        paths.remove(spark, f"{self.folder}/pairs/n=-{batch_id}")
        return pairs.withColumn("at", F.greatest("at", F.timestamp_micros(F.lit(clock))))

    def _run(self, spark: SparkSession, kind: StructType, batch_id: int, answer: str | None) -> None:
        stream = spark.readStream.schema(StructType([*kind.fields, StructField("n", LongType())])).parquet(f"{self.folder}/pairs")
        if self.delay:
            new = stream.withWatermark("at", self.delay).dropDuplicatesWithinWatermark(["digest"])
        else:
            new = stream.dropDuplicates(["digest"])

        def store(rows: DataFrame, epoch: int) -> None:
            rows = rows.filter(F.col("n") == batch_id).select(self.order_col)
            if answer:
                rows.write.mode("overwrite").parquet(f"{answer}/{epoch}")
            else:
                rows.write.format("noop").mode("overwrite").save()

        writer = new.writeStream.foreachBatch(store).option("checkpointLocation", f"{self.folder}/progress")
        writer.trigger(availableNow=True).start().awaitTermination()


def write_stream(stream: DataFrame, path: str, checkpoint: str, *partition_by: str) -> StreamingQuery:
    """Append everything available now to Parquet, then stop."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.outputMode("append").trigger(availableNow=True).start(path)


def prepare_stream(
    spark: SparkSession,
    dataset: DatasetSpec,
    schema: StructType | str,
    order_col: str,
    path: str,
    checkpoint: str,
    method: str = "sft",
    filters: Filters = Filters(),
    split: SplitSpec = SplitSpec(),
    max_files: int = 1000,
    event_time: str | None = None,
    delay: str | None = None,
) -> StreamingQuery:
    """A landing folder prepared end to end: normalised, filtered, each text once, split.

    Run it again when files have arrived; it takes up where it stopped. Texts are compared with
    all that were written before, or with ``delay`` only with those of that time.
    """
    rows = read_stream(spark, dataset.path, schema, dataset.format, max_files, dataset.multiline)
    kept = split_by_fraction(preprocess_stream(rows, order_col, method, dataset, filters), order_col, split)
    return write_deduplicated(kept, order_col, path, checkpoint, ("split",), event_time, delay)


def write_capped(stream: DataFrame, order_col: str, cap: int, path: str, checkpoint: str) -> StreamingQuery:
    """Append at most ``cap`` rows in all: each batch gives its first rows by ``order_col``
    until the cap is reached. A batch writes its own folder, so a repeated one replaces it, and the
    number of rows so far beside its checkpoint, so the next one reads a number."""
    totals = f"{checkpoint.rstrip('/')}/taken"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = f"{totals}/{batch_id - 1}"
        taken = int(paths.read_text(spark, last)) if paths.exists(spark, last) else 0
        if taken < cap:
            counted = Observation()
            rows = cap_rows(batch, order_col, cap - taken).observe(counted, F.count("*").alias("n"))
            rows.write.mode("overwrite").parquet(f"{path}/_batch={batch_id}")
            taken += counted.get["n"]
        paths.remove(spark, f"{totals}/{batch_id}")
        paths.publish_text(spark, str(taken), f"{totals}/{batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
