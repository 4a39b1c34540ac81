"""Sources, sinks and caches, on real files."""

import hashlib
import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from finetide import DataError, DatasetSpec, Filters, SplitSpec
from finetide.operators.fingerprint import content_fingerprint
from finetide.operators.split import split_exact
from finetide.plans.cache import data_cache_key, load_splits, save_splits
from finetide.plans.estimate import plan_estimate
from finetide.plans.preprocess import preprocess_dataset
from finetide.session import scratch_path, shared_dir
from finetide.sources import artifacts, files, paths, sinks


def put(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def test_scratch_lies_in_the_folder_the_session_names(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_jsonl_blank_lines_and_late_keys(spark, tmp_path):
    path = put(tmp_path, "a.jsonl", '{"b": 1, "a": "x"}\n\n   \n{"a": "y", "c": true}\n')
    union = files.read_jsonl(spark, path)
    assert set(union.columns) == {"a", "b", "c"} and union.count() == 2
    first = files.read_jsonl(spark, path, schema_mode="first_row")
    assert first.columns == ["b", "a"]
    assert sorted(map(tuple, first.collect()), key=str) == [(1, "x"), (None, "y")]
    assert files.count_rows(spark, DatasetSpec(path=path)).collect() == [(2,)]


@pytest.mark.parametrize("first", [0, 1, 17, 29])
def test_first_record_after_files_without_one(spark, tmp_path, first):
    """The keys are those of the first file by name with a record."""
    for k in range(30):
        blank = k < first or k % 7 == 3
        put(tmp_path, f"part-{k:02}.jsonl", "" if k % 5 == 4 and blank else "\n  \n" if blank else f'\n{{"k{k:02}": {k}}}\n{{"late": 1}}\n')
    want = next(k for k in range(first, 30) if k % 7 != 3)
    assert files._first_record_keys(spark, str(tmp_path)) == [f"k{want:02}"]


def test_first_record_after_many_blank_files_costs_few_jobs(spark, tmp_path):
    for k in range(200):
        put(tmp_path, f"part-{k:03}.jsonl", "\n" if k < 190 else '{"a": 1}\n')
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("first-record", "first record")
    try:
        assert files._first_record_keys(spark, str(tmp_path)) == ["a"]
        assert len(tracker.getJobIdsForGroup("first-record")) < 100  # a job per file would be 191 or more
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_first_record_of_none(spark, tmp_path):
    put(tmp_path, "a.jsonl", "\n")
    put(tmp_path, "b.jsonl", " \n")
    with pytest.raises(DataError):
        files._first_record_keys(spark, str(tmp_path))


def test_jsonl_malformed_line_fails(spark, tmp_path):
    path = put(tmp_path, "a.jsonl", '{"a": 1}\n{"a": \n')
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        files.read_jsonl(spark, path, schema="a int").collect()


def test_csv_edges(spark, tmp_path):
    text = 'id,text\n1,"two\nlines"\n2,"a ""quoted"" word"\n3,\n4\n5,x,extra\n\n6,"  kept  "\n'
    path = put(tmp_path, "a.csv", text)
    rows = {r["id"]: r["text"] for r in files.read_csv(spark, path, multiline=True).collect()}
    assert rows == {"1": "two\nlines", "2": 'a "quoted" word', "3": "", "4": "", "5": "x", "6": "  kept  "}
    assert files.count_rows(spark, DatasetSpec(path=path, format="csv", multiline=True)).collect() == [(6,)]


def test_csv_roundtrip_keeps_any_text(spark, tmp_path):
    values = ["", " ", 'q"q', "a,b", "line\nbreak", "tab\t", "\\", '\\"', "é\U0001f600", " lead"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, text string")
    path = str(tmp_path / "t.csv")
    sinks.write_csv(df, path)
    assert {int(r["id"]): r["text"] for r in files.read_csv(spark, path, multiline=True).collect()} == dict(enumerate(values))


def test_candidates_in_order(spark, tmp_path):
    with pytest.raises(DataError, match="train.jsonl"):
        files.read_first_candidate(spark, str(tmp_path))
    put(tmp_path, "validation.jsonl", '{"text": "v"}\n')
    put(tmp_path, "train.csv", "text\nc\n")
    assert files.read_first_candidate(spark, str(tmp_path)).collect() == [("c",)]
    put(tmp_path, "data.jsonl", '{"text": "d"}\n')
    spec = DatasetSpec(path=str(tmp_path), format="candidates")
    assert files.load(spark, spec).collect() == [("d",)]
    assert files.count_rows(spark, spec).collect() == [(1,)]


def test_given_schema_needs_no_inference(spark, tmp_path):
    path = put(tmp_path, "a.jsonl", '{"a": 1, "b": "x"}\n')
    assert files.load(spark, DatasetSpec(path=path, schema="a string")).collect() == [("1",)]
    single = put(tmp_path, "a.csv", "a,b\n1,2\n")
    assert files.load(spark, DatasetSpec(path=single, format="csv", multiline=False)).collect() == [("1", "2")]


def test_missing_path(spark, tmp_path):
    gone = str(tmp_path / "gone")
    with pytest.raises(DataError, match="not found"):
        files.load(spark, DatasetSpec(path=gone))
    assert files.count_rows(spark, DatasetSpec(path=gone)).collect() == [(0,)]
    assert files.read_lines(spark, gone).count() == 0


def test_lines_keep_their_order_across_splits(spark, tmp_path):
    lines = [f"  line {i} {'x' * (i % 50)}" for i in range(2000)]
    path = put(tmp_path, "seeds.txt", "\n\n".join(lines) + "\n \n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    rows = files.read_lines(spark, path, "seed").collect()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r["seed"] for r in sorted(rows, key=lambda r: r["idx"])] == [line.strip() for line in lines]
    assert sorted(r["idx"] for r in rows) == list(range(2000))


def test_small_inputs_are_dealt_out(spark, tmp_path):
    df = spark.range(400_000).withColumn("text", F.sha2(F.col("id").cast("string"), 256)).coalesce(1)
    path = str(tmp_path / "one")
    df.write.parquet(path)
    assert files.load(spark, DatasetSpec(path=path, format="parquet")).rdd.getNumPartitions() == 4
    tiny = str(tmp_path / "tiny")
    spark.range(3).write.parquet(tiny)
    loaded = files.load(spark, DatasetSpec(path=tiny, format="parquet"))
    assert "RoundRobin" not in loaded._jdf.queryExecution().executedPlan().toString()


def test_row_cap_and_all_formats_take_one_path(spark, tmp_path):
    rows = [{"id": i, "body": f"text number {i} is long enough"} for i in range(50)]
    path = put(tmp_path, "a.jsonl", "\n".join(map(json.dumps, rows)))
    spec = DatasetSpec(path=path, text_column="body", max_rows=20)
    got = preprocess_dataset(spark, spec, "id").collect()
    assert sorted(r["id"] for r in got) == list(range(20))
    assert sum(r["split"] == "validation" for r in got) == 2


def test_trainer_layout(spark, tmp_path):
    data = [(0, " a ", "train"), (1, " ", "train"), (2, "b", "train"), (3, "c", "validation"), (4, None, "train")]
    df = spark.createDataFrame(data, "id int, text string, split string")
    out = sinks.write_trainer_layout(df, str(tmp_path / "out"), batch_size=3)
    assert sorted(r["text"] for r in files.read_jsonl(spark, out["train"]).collect()) == ["None", "a", "b"]
    assert files.read_jsonl(spark, out["validation"]).collect() == [("c",)]
    with pytest.raises(DataError, match="5 train rows"):
        sinks.write_trainer_layout(df, str(tmp_path / "no"), batch_size=5)
    with pytest.raises(DataError, match="4 non-blank"):
        sinks.write_trainer_layout(df, str(tmp_path / "no"), batch_size=4)
    alone = df.filter("split = 'train'")
    assert set(sinks.write_trainer_layout(alone, str(tmp_path / "alone"))) == {"train"}
    prompts = df.select(F.col("text").alias("prompt"), "split")
    assert sinks.trainer_texts(prompts.filter("prompt = 'b'")).collect() == [("b",)]


@pytest.mark.parametrize("records", [0, 7])
def test_trainer_files_keep_the_order(spark, tmp_path, many_files, records):
    """Lines follow the order column over many files, whatever the partitioning of the rows."""
    rows = spark.range(500).select(F.col("id"), F.format_string(" row %d\n", F.col("id") * 7 % 500).alias("text"), (F.col("id") * 7 % 500).alias("place"))
    rows = rows.withColumn("text", F.when(F.col("place") % 11 == 0, " ").otherwise(F.col("text")))
    splits = split_exact(rows, "id", SplitSpec(0.8, 1)).repartition(5)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", records)
    try:
        out = sinks.write_trainer_layout(splits, str(tmp_path / "t"), order_col="place")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    held = {r["place"] for r in splits.filter("split = 'validation'").collect()}
    for name, want in (("train", set(range(500)) - held), ("validation", held)):
        got = [r["text"] for r in files.read_numbered(spark, out[name], "text string").orderBy("line").collect()]
        assert got == [f"row {k}" for k in sorted(want) if k % 11]
        plain = [json.loads(line)["text"] for f in sorted(os.listdir(out[name])) if f.startswith("part-") for line in open(f"{out[name]}/{f}")]
        assert plain == got
    assert len(os.listdir(out["train"])) > 2 and set(os.listdir(tmp_path / "t")) == {"train.jsonl", "valid.jsonl"}
    folders = sinks.hand_off(splits, str(tmp_path / "h"), order_col="place")
    import pyarrow.parquet as pq

    for path in folders.values():
        found = [x for f in sorted(os.listdir(path)) if f.endswith(".parquet") for x in pq.ParquetFile(f"{path}/{f}").read()["place"].to_pylist()]
        assert found == sorted(found)


def test_trainer_files_replace_and_may_be_empty(spark, tmp_path):
    out = str(tmp_path / "t")
    sinks.write_trainer_layout(spark.createDataFrame([("a", "train"), ("b", "validation")], "text string, split string"), out)
    paths_of = sinks.write_trainer_layout(spark.createDataFrame([("c", "train"), (" ", "validation")], "text string, split string"), out)
    read = lambda p: [r["text"] for r in files.read_jsonl(spark, p, "text string").collect()]
    assert read(paths_of["train"]) == ["c"] and read(paths_of["validation"]) == []


def test_jsonl_keeps_nulls(spark, tmp_path):
    path = str(tmp_path / "n")
    sinks.write_jsonl(spark.createDataFrame([(1, None)], "a int, b string"), path)
    lines = [line for f in os.listdir(path) if f.endswith(".json") for line in open(f"{path}/{f}")]
    assert [json.loads(line) for line in lines] == [{"a": 1, "b": None}]


def test_cache_roundtrip_and_misses(spark, tmp_path):
    df = split_exact(spark.range(30).withColumn("text", F.lit("t")), "id")
    cache = str(tmp_path / "key1")
    assert load_splits(spark, cache) is None
    fingerprint = save_splits(df, cache, "sft")
    stored = load_splits(spark, cache, fingerprint)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.collect()))
    assert content_fingerprint(stored).collect() == [(30, fingerprint)]
    assert load_splits(spark, cache, "0" * 16) is None
    assert save_splits(df.repartition(7), cache, "sft") == fingerprint

    other = str(tmp_path / "key2")
    save_splits(df, other, "sft", cache_key="key3")
    assert load_splits(spark, other) is None

    paths.remove(spark, f"{cache}/manifests/00000002.json")
    put(tmp_path, f"{os.path.basename(cache)}/manifests/00000003.json", "half a manif")
    assert load_splits(spark, cache) is None


def test_two_writers_and_a_reader_that_holds_rows(spark, tmp_path, monkeypatch):
    from finetide.plans import cache as module

    cache = str(tmp_path / "shared")
    one, other = (split_exact(spark.range(n).withColumn("by", F.lit(n)), "id") for n in (20, 30))
    first = save_splits(one, cache, "sft")
    held = load_splits(spark, cache)
    # The second writer starts from the same version as a third one, which publishes before it.
    real, began = module.fingerprinted, []

    def slow(df):
        if not began:
            began.append(True)
            began.append(save_splits(other, cache, "sft"))
        return real(df)

    monkeypatch.setattr(module, "fingerprinted", slow)
    assert save_splits(split_exact(spark.range(50).withColumn("by", F.lit(50)), "id"), cache, "sft") == began[1] != first
    now = load_splits(spark, cache, began[1])
    assert {r["by"] for r in now.collect()} == {30} and now.count() == 30
    assert sorted(r["id"] for r in held.collect()) == list(range(20))
    folders = lambda: sorted(n for n in os.listdir(cache) if n.startswith("data-"))
    assert len(folders()) == 2  # the loser's rows are gone, the replaced ones not yet
    module.Versions(spark, cache).sweep([now.inputFiles()[0].split("/")[-3]], keep_hours=0)
    assert len(folders()) == 1 and load_splits(spark, cache).count() == 30


def test_a_manifest_is_published_once(spark, tmp_path):
    target = f"{tmp_path}/m/1.json"
    assert paths.publish_text(spark, "é one", target) and not paths.publish_text(spark, "two", target)
    assert paths.read_text(spark, target) == "é one" and set(paths.listed(spark, f"{tmp_path}/m")) == {"1.json"}


def test_cache_of_one_row_keeps_an_empty_validation(spark, tmp_path):
    cache = str(tmp_path / "one")
    save_splits(split_exact(spark.range(1), "id"), cache, "sft")
    rows = load_splits(spark, cache)
    assert rows.filter("split = 'validation'").count() == 0 and rows.count() == 1


def test_split_names_are_checked_while_writing(spark, tmp_path):
    df = spark.createDataFrame([(1, "../dev")], "id int, split string")
    with pytest.raises(PySparkException, match="not allowed"):
        save_splits(df, str(tmp_path / "bad"), "sft")
    assert load_splits(spark, str(tmp_path / "bad")) is None


def test_cache_key_follows_every_setting_and_the_file(spark, tmp_path):
    path = put(tmp_path, "a.jsonl", "{}\n")
    spec = DatasetSpec(path=path)
    key = data_cache_key(spark, spec, "sft")
    assert key == data_cache_key(spark, DatasetSpec(path=path), "sft") and len(key) == 16
    changed = [
        data_cache_key(spark, spec, "dpo"),
        data_cache_key(spark, DatasetSpec(path=path, text_column="t"), "sft"),
        data_cache_key(spark, spec, "sft", Filters(min_length=11)),
        data_cache_key(spark, spec, "sft", split=SplitSpec(seed=1)),
    ]
    os.utime(path, (1, 1))
    changed.append(data_cache_key(spark, spec, "sft"))
    assert len({key, *changed}) == 6


def test_estimates(spark):
    def plan(n, **kw):
        return plan_estimate(spark.createDataFrame([(n,)], "n_rows bigint"), **kw).collect()[0].asDict()

    row = plan(50, batch_size=4, gradient_accumulation_steps=2, epochs=3, num_gpus=2)
    assert (row["steps_per_epoch"], row["estimated_steps"], row["estimated_gpu_hours"]) == (6, 18, 0.036)
    assert (row["estimated_disk_mb"], row["estimated_preprocess_seconds"]) == (525.0, 0.01)
    assert plan(0, max_iters=7)["estimated_steps"] == 7
    assert plan(0)["steps_per_epoch"] == 1
    assert plan(10, cached=True)["estimated_preprocess_seconds"] == 0.0
    assert plan(10, converted_model=True)["estimated_disk_mb"] == 1305.0


def test_inventory_sees_every_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(artifacts, "CHUNK_BYTES", 100)
    contents = {"a.bin": b"\x00" * 700, "sub dir/b é.txt": "héllo".encode(), "sub dir/deep/c": b"x" * 2000, "empty": b""}
    contents |= {".hidden": b"h", "_meta/_x": b"m", "pct%20x#y?.txt": b"odd"}
    for name, content in contents.items():
        put(tmp_path, name, content)
    rows = {r["path"]: r for r in artifacts.inventory(spark, str(tmp_path)).collect()}
    assert set(rows) == set(contents)
    for name, content in contents.items():
        row = rows[name]
        assert row["size"] == len(content) and bytes(row["sample"]) == content[:512]
        assert row["sha256"] == hashlib.sha256(content).hexdigest()


def test_inventory_is_lazy_and_filters_by_path(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(artifacts, "FILES_PER_TASK", 3)
    for n in range(20):
        put(tmp_path, f"d{n % 4}/f{n}", b"x" * n)
    files = artifacts.inventory(spark, str(tmp_path))
    put(tmp_path, "d0/later", b"late")
    assert files.count() == 21  # listed when the query runs
    assert files.rdd.getNumPartitions() == 7
    near = files.filter(F.col("path").startswith("d2/"))
    assert near.rdd.getNumPartitions() == 2 and near.count() == 5
    one = files.filter("path = 'd1/f5'")
    assert one.rdd.getNumPartitions() == 1 and [(r["size"], r["sha256"]) for r in one.collect()] == [(5, hashlib.sha256(b"xxxxx").hexdigest())]
    assert files.filter("path in ('d1/f5', 'd3/f7', 'none')").count() == 2
    assert files.filter("path = 'd1/f5' and path = 'd3/f7'").count() == 0
    assert files.filter("path like 'd1/%' and size > 5").count() == 3
    spark.conf.set(artifacts.PUSHDOWN, "false")
    try:
        assert artifacts.inventory(spark, str(tmp_path)).filter("path = 'd1/f5'").count() == 1
    finally:
        spark.conf.set(artifacts.PUSHDOWN, "true")
    listed = artifacts.inventory(spark, str(tmp_path), hashed=False).collect()
    assert len(listed) == 21 and all(r["sha256"] is None for r in listed)
    alone = artifacts.inventory(spark, str(tmp_path / "d0" / "later")).collect()
    assert [(r["path"], r["size"], bytes(r["sample"])) for r in alone] == [("later", 4, b"late")]
    (tmp_path / "nothing").mkdir()
    assert artifacts.inventory(spark, str(tmp_path / "nothing")).collect() == []
    with pytest.raises(DataError, match="no folder"):
        artifacts.inventory(spark, str(tmp_path / "gone"))


def test_upload_modes(spark):
    data = spark.createDataFrame([(n, bytearray(b"x" * 100)) for n in "abc"], "path string, content binary")
    modes = spark.createDataFrame([("a", "lfs"), ("b", "ignored")], "path string, mode string")
    rows = {r["path"]: r for r in artifacts.upload_plan(artifacts.described(data), modes, data).collect()}
    assert set(rows) == {"a", "c"}
    assert rows["a"]["key"] == "lfsFile" and rows["a"]["size"] == 100 and rows["a"]["content"] is None
    assert rows["c"]["mode"] == "regular" and "\n" not in rows["c"]["content"]


def test_prepare_runs_the_plan_once_per_content(spark, tmp_path, monkeypatch):
    from finetide.plans import prepare as pr

    runs = []
    real = pr.preprocess_dataset
    monkeypatch.setattr(pr, "preprocess_dataset", lambda *a, **k: runs.append(1) or real(*a, **k))
    rows = [{"id": i, "text": f"text number {i} is long enough"} for i in range(30)]
    path = put(tmp_path, "a.jsonl", "\n".join(map(json.dumps, rows)))
    spec, root = DatasetSpec(path=path), str(tmp_path / "cache")

    assert pr.plan_dataset(spark, spec, root, order_col="id", batch_size=3).collect()[0]["data_cache_hit"] is False
    assert pr.prepare(spark, spec, "id", root).count() == 30
    assert pr.prepare(spark, spec, "id", root).count() == 30
    assert len(runs) == 1
    plan = pr.plan_dataset(spark, spec, root, order_col="id", batch_size=3).collect()[0]
    assert plan["data_cache_hit"] is True and plan["estimated_steps"] == 10
    os.utime(path, (1, 1))
    assert pr.prepare(spark, spec, "id", root).count() == 30
    assert pr.prepare(spark, spec, "id", root, filters=Filters(min_length=29)).count() == 20
    assert len(runs) == 3


def test_prepare_follows_the_leaf_files_of_a_folder(spark, tmp_path):
    from finetide.plans import prepare as pr

    def write(name, ids):
        rows = [{"id": i, "text": f"text number {i} is long enough"} for i in ids]
        return put(tmp_path, name, "\n".join(map(json.dumps, rows)))

    write("src/day=1/a.jsonl", range(10))
    spec, root = DatasetSpec(path=str(tmp_path / "src"), schema="id bigint, text string"), str(tmp_path / "cache")
    count = lambda: pr.prepare(spark, spec, "id", root).count()
    assert count() == 10
    added = write("src/day=1/b.jsonl", range(10, 15))
    assert count() == 15
    write("src/day=1/b.jsonl", range(10, 12))
    assert count() == 12
    os.remove(added)
    assert count() == 10
    keys = {data_cache_key(spark, spec, "sft", order_col=c) for c in ("id", "text", None)}
    assert len(keys) == 3


def test_columns_of_untyped_nulls_are_stored_as_strings(spark, tmp_path):
    df = split_exact(spark.range(4).withColumn("nothing", F.lit(None)), "id")
    cache = str(tmp_path / "nulls")
    save_splits(df, cache, "sft")
    assert dict(load_splits(spark, cache).dtypes)["nothing"] == "string"
    folders = sinks.hand_off(df, str(tmp_path / "out"))
    assert sum(files.read_parquet(spark, p).count() for p in folders.values()) == 4


def test_rows_as_files(spark, tmp_path):
    """A file per row: nothing else is left below the root, and nothing is written outside it."""
    rows = [(f"key={i}/part-0.txt", f"text {i}\n".encode()) for i in range(30)] + [("top", b""), ("a/b/c.bin", bytes(range(256)))]
    data = spark.createDataFrame(rows, "path string, content binary").repartition(5)
    root = str(tmp_path / "files")
    assert artifacts.write_files(data, root) == 32
    assert artifacts.write_files(data, root) == 32  # again: the same files
    found = {str(p.relative_to(root)): p.read_bytes() for p in (tmp_path / "files").rglob("*") if p.is_file()}
    assert found == dict(rows)
    assert {r["path"] for r in artifacts.inventory(spark, root).collect()} == set(found)
    assert artifacts.write_files(data.limit(0), str(tmp_path / "none")) == 0
    assert artifacts.inventory(spark, str(tmp_path / "none")).collect() == []
    for bad in [("../out", b"x"), (None, b"x"), ("a", None)]:
        with pytest.raises(PySparkException, match="no file to write"):
            artifacts.write_files(spark.createDataFrame([bad], "path string, content binary"), root)


def test_inventory_query_leaves_no_files_but_its_own(spark, tmp_path, monkeypatch):
    """One file per supplier; checksum files and marks of a job beside each would double the work."""
    from registry import queries

    monkeypatch.setattr(queries, "scratch_path", lambda *_: str(tmp_path / "made"))
    folder = "/root/testdata/sf0.001"
    n = queries.QUERIES["artifact_inventory"](spark, folder).count()
    assert n == spark.read.parquet(f"{folder}/supplier.parquet").count()
    assert n == sum(p.is_file() for p in (tmp_path / "made").rglob("*"))
