import pytest
from pyspark.sql import functions as F

from finetide import DataError, DatasetSpec, Filters
from finetide.functions.text import digest
from finetide.operators.dedup import deduplicate
from finetide.operators.split import split_by_fraction
from finetide.sources import paths
from finetide.sources.sinks import write_csv, write_jsonl
from finetide.streaming import preprocess as st

SCHEMA = "id bigint, text string"


def landing(spark, folder, df, parts=6):
    path = str(folder / "in")
    write_jsonl(df.repartition(parts, "id"), path, "append")
    return path


def rows(spark):
    text = F.when(F.col("id") % 3 == 0, F.lit("The same text everywhere ")).otherwise(
        F.concat(F.lit("distinct text number "), (F.col("id") % 200).cast("string"))
    )
    return spark.range(900).select("id", text.alias("text"))


def drain(spark, stream, folder, *by):
    out, progress = str(folder / "out"), str(folder / "progress")
    st.write_stream(stream, out, progress, *by).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def test_stream_dedup_equals_batch_with_a_hot_text(spark, tmp_path):
    source = rows(spark)
    path = landing(spark, tmp_path, source)
    stream = st.deduplicate_stream(st.read_stream(spark, path, SCHEMA, max_files=2))
    kept = drain(spark, stream, tmp_path)
    got = [bytes(r["digest"]) for r in kept.select("digest").collect()]
    want = [bytes(r[0]) for r in deduplicate(source, "id").select(digest(F.col("text"))).collect()]
    assert len(got) == len(set(got)) and set(got) == set(want)


def test_stream_resumes_with_new_files(spark, tmp_path):
    path = landing(spark, tmp_path, rows(spark).filter("id < 300"))

    def run():
        stream = st.deduplicate_stream(st.read_stream(spark, path, SCHEMA))
        return drain(spark, stream, tmp_path).count()

    first = run()
    landing(spark, tmp_path, rows(spark).filter("id >= 300"))
    assert run() == deduplicate(rows(spark), "id").count() > first
    assert run() == deduplicate(rows(spark), "id").count()


def test_bounded_state(spark, tmp_path):
    source = rows(spark).withColumn("ts", F.timestamp_seconds(F.col("id")))
    path = landing(spark, tmp_path, source)
    stream = st.deduplicate_stream(
        st.read_stream(spark, path, SCHEMA + ", ts timestamp"), event_time="ts", delay="1 hour"
    )
    assert drain(spark, stream, tmp_path).count() == deduplicate(rows(spark), "id").count()


def test_written_once_over_batches_and_restarts(spark, tmp_path):
    path, out, progress = landing(spark, tmp_path, rows(spark).filter("id < 300")), str(tmp_path / "out"), str(tmp_path / "p")

    def run():
        stream = st.read_stream(spark, path, SCHEMA, max_files=2)
        st.write_deduplicated(stream, "id", out, progress).awaitTermination()
        return spark.read.parquet(out)

    first = run().count()
    landing(spark, tmp_path, rows(spark).filter("id >= 300"))
    got = run()
    want = {bytes(r[0]) for r in deduplicate(rows(spark), "id").select(digest(F.col("text"))).collect()}
    digests = [bytes(r["digest"]) for r in got.select("digest").collect()]
    assert len(digests) == len(want) > first and set(digests) == want


def test_written_once_within_a_delay(spark, tmp_path):
    hours = lambda n: F.timestamp_seconds(F.lit(n * 3600))
    out, progress = str(tmp_path / "out"), str(tmp_path / "p")
    for hour in (0, 1, 9):
        path = landing(spark, tmp_path, spark.range(1).select(F.lit(hour).alias("id"), F.lit("one text").alias("text"), hours(hour).alias("ts")), 1)
        stream = st.read_stream(spark, path, SCHEMA + ", ts timestamp")
        st.write_deduplicated(stream, "id", out, progress, (), "ts", "2 hours").awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 9]


def test_earlier_output_is_not_read(spark, tmp_path):
    """What was written may be gone: the state alone tells which texts have been seen."""
    path, out, progress = landing(spark, tmp_path, rows(spark).filter("id < 300")), str(tmp_path / "out"), str(tmp_path / "p")

    def run():
        st.write_deduplicated(st.read_stream(spark, path, SCHEMA, max_files=2), "id", out, progress).awaitTermination()
        return {bytes(r["digest"]) for r in spark.read.parquet(out).collect()}

    first = run()
    paths.remove(spark, out)
    landing(spark, tmp_path, rows(spark).filter("id >= 100"))
    second = run()
    want = {bytes(r[0]) for r in deduplicate(rows(spark), "id").select(digest(F.col("text"))).collect()}
    assert second and not first & second and first | second == want
    # Pairs and answers of the last two batches stay, for a repeated batch.
    kept = [n for n in paths.listed(spark, f"{progress}/digests/new")]
    assert len(kept) <= 2


def test_a_repeated_batch_finds_its_answer(spark, tmp_path):
    """A batch that failed after its digests entered the state gives the same rows again."""
    path, out, progress = landing(spark, tmp_path, rows(spark), 2), str(tmp_path / "out"), str(tmp_path / "p")
    seen = st.Seen(f"{progress}/digests", "id", None)
    batch = st._with_digest(spark.read.schema(SCHEMA).json(path))
    pairs = batch.groupBy("digest").agg(F.min("id").alias("id"))
    want = sorted(r["id"] for r in seen.new(pairs, 0).collect())
    assert want == sorted(r["id"] for r in deduplicate(rows(spark), "id").collect())
    st.write_deduplicated(st.read_stream(spark, path, SCHEMA), "id", out, progress).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == want


def test_late_rows_are_kept_within_a_delay(spark, tmp_path):
    """A batch older than the ones before it loses nothing but copies."""
    out, progress = str(tmp_path / "out"), str(tmp_path / "p")
    batches = [[(1, "one text", 100)], [(2, "one text", 101), (3, "other text", 5)], [(4, "other text", 6), (5, "third text", 1)], [(6, "one text", 200)]]
    for batch in batches:
        df = spark.createDataFrame(batch, "id long, text string, h long").select("id", "text", F.timestamp_seconds(F.col("h") * 3600).alias("ts"))
        path = landing(spark, tmp_path, df, 1)
        stream = st.read_stream(spark, path, SCHEMA + ", ts timestamp")
        st.write_deduplicated(stream, "id", out, progress, (), "ts", "2 hours").awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 3, 5, 6]


def test_no_python_in_the_stream_plan(spark, tmp_path):
    path = landing(spark, tmp_path, rows(spark))
    stream = st.deduplicate_stream(st.preprocess_stream(st.read_stream(spark, path, SCHEMA), "id"))
    assert "Python" not in stream._jdf.queryExecution().analyzed().toString()


def test_preprocess_and_split(spark, tmp_path):
    path = landing(spark, tmp_path, rows(spark))
    stream = st.preprocess_stream(st.read_stream(spark, path, SCHEMA), "id", filters=Filters(min_length=23))
    parts = drain(spark, split_by_fraction(stream, "id"), tmp_path, "split")
    assert parts.count() == rows(spark).filter(F.length("text") >= 23).count()
    assert {r["split"] for r in parts.select("split").distinct().collect()} == {"train", "validation"}


def test_prepared_end_to_end(spark, tmp_path):
    spec = DatasetSpec(path=landing(spark, tmp_path, rows(spark).withColumnRenamed("text", "body")), text_column="body")
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    st.prepare_stream(spark, spec, "id bigint, body string", "id", out, progress).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == deduplicate(rows(spark), "id").count()
    assert set(got.columns) == {"id", "text", "digest", "split", "_batch"}


def test_cap_over_batches(spark, tmp_path):
    path = landing(spark, tmp_path, rows(spark))
    stream = st.read_stream(spark, path, SCHEMA, max_files=1)
    out = str(tmp_path / "out")
    st.write_capped(stream, "id", 400, out, str(tmp_path / "p")).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == got.select("id").distinct().count() == 400


def test_csv_stream_and_unknown_format(spark, tmp_path):
    path = str(tmp_path / "csv")
    write_csv(rows(spark).withColumn("text", F.when(F.col("id") > 0, F.col("text"))), path)
    stream = st.read_stream(spark, path, "id string, text string", "csv")
    got = drain(spark, stream, tmp_path)
    assert got.count() == 900 and got.filter("text = ''").count() == 1
    broken = str(tmp_path / "broken")
    write_csv(spark.createDataFrame([(1, "two\nlines")], SCHEMA), broken)
    stream = st.read_stream(spark, broken, "id string, text string", "csv", multiline=True)
    folder = tmp_path / "more"
    folder.mkdir()
    assert [r["text"] for r in drain(spark, stream, folder).collect()] == ["two\nlines"]
    with pytest.raises(DataError, match="orc"):
        st.read_stream(spark, path, SCHEMA, "orc")
