import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from finetide import DataError
from finetide.operators import catalog as cat


def record(run_id, created="2024-01-01T00:00:00+00:00", updated=None, **fields):
    base = dict.fromkeys(name.split()[0] for name in cat.RUN_SCHEMA.replace("<string,double>", "").split(", "))
    return base | dict(
        run_id=run_id, run_name="n", status="pending", config="{}", created_at=created,
        updated_at=updated or created, global_step=0, metrics={}, **fields,
    )


def frame(spark, *records):
    return spark.createDataFrame(list(records), cat.RUN_SCHEMA)


def test_create_append_update_and_look_up(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert cat.read_runs(spark, path).count() == 0
    configs = spark.createDataFrame([("first", '{"a": 1}'), ("second", "{}")], "run_name string, config string")
    created = spark.createDataFrame(cat.create_runs(configs).collect(), cat.RUN_SCHEMA)
    cat.append_runs(created, path)
    listed = cat.list_runs(cat.read_runs(spark, path)).collect()
    assert {r["run_name"] for r in listed} == {"first", "second"}
    assert {r["status"] for r in listed} == {"pending"} and len({r["run_id"] for r in listed}) == 2

    run_id = next(r["run_id"] for r in listed if r["run_name"] == "first")
    updates = spark.createDataFrame([(run_id, "training", 7, 1)], "run_id string, status string, global_step bigint, zzz int")
    current = cat.latest_states(cat.read_runs(spark, path))
    cat.append_runs(cat.updated_runs(current, updates), path)
    now = cat.latest_states(cat.read_runs(spark, path), "global_step")
    row = cat.find_run(now, run_id).collect()[0]
    assert (row["status"], row["global_step"], row["config"]) == ("training", 7, '{"a": 1}')
    assert now.count() == 2


def test_times_are_utc_in_any_session(spark):
    from datetime import datetime, timedelta, timezone

    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    stamp = spark.range(1).select(cat.utc_now()).head()[0]
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert abs(datetime.fromisoformat(stamp) - datetime.now(timezone.utc)) < timedelta(minutes=5)


def test_unknown_status_fails(spark):
    updates = spark.createDataFrame([("a", "resting")], "run_id string, status string")
    with pytest.raises(PySparkException, match="unknown run status"):
        cat.updated_runs(frame(spark, record("a")), updates).collect()


def test_one_document_per_file_and_prefix(spark, tmp_path):
    for name in ("exp_a", "exp_b", "other"):
        (tmp_path / f"{name}.json").write_text(json.dumps(record(name), indent=2))
    rows = cat.read_runs(spark, str(tmp_path), prefix="exp/", one_per_file=True)
    assert sorted(r["run_id"] for r in rows.collect()) == ["exp_a", "exp_b"]


def test_newest_first(spark):
    rows = frame(spark, record("a", "2024-01-01"), record("b", "2024-03-01"), record("c", "2024-02-01"))
    assert [r["run_id"] for r in cat.list_runs(rows).collect()] == ["b", "c", "a"]


def test_latest_state_reduces_before_the_shuffle(spark, plan):
    states = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("run_id"),
        F.format_string("%05d", "id").alias("updated_at"),
        "id",
    )
    latest = cat.latest_states(states)
    assert sorted(map(tuple, latest.collect())) == [("cold", "00998", 998), ("hot", "00999", 999)]
    text = plan(latest)
    assert text.index("Exchange") < text.index("Partial") and "WindowGroupLimit" in text


def test_latest_checkpoint_is_numeric(spark):
    names = [("a", "o/checkpoint-9"), ("a", "o/checkpoint-10"), ("a", "o/checkpoint-best"), ("a", "o/final"), ("b", "p/final")]
    paths = spark.createDataFrame(names, "run_id string, path string")
    assert cat.latest_checkpoints(paths).collect() == [("a", 10, "o/checkpoint-10")]
    recorded = spark.createDataFrame([("a", "x"), ("c", "y"), ("d", None)], "run_id string, checkpoint_path string")
    got = {r["run_id"]: r["checkpoint"] for r in cat.latest_checkpoints(paths, recorded).collect()}
    assert got == {"a": "o/checkpoint-10", "c": "y"}
    shown = spark.createDataFrame([("b", "p/final"), ("c", "y")], "run_id string, checkpoint_path string")
    got = {r["run_id"]: r["checkpoint"] for r in cat.latest_checkpoints(paths, shown, True).collect()}
    assert got == {"a": "o/checkpoint-10", "b": "p/final"}
    inside = [("a", "o/checkpoint-9/model.bin"), ("a", "checkpoint-best-11/x/y"), ("a", "o/checkpoint-9"), ("b", "final/w")]
    listed = spark.createDataFrame(inside, "run_id string, path string")
    got = {r["run_id"]: r["checkpoint"] for r in cat.resume_checkpoint(listed).collect()}
    assert got == {"a": "checkpoint-best-11", "b": "final"}
    resumed = {r["run_id"]: r["checkpoint"] for r in cat.resume_checkpoint(paths).collect()}
    assert resumed == {"a": "o/checkpoint-10", "b": "p/final"}


def test_drift(spark):
    stored = spark.createDataFrame([("a", '{"x": 1, "y": {"q": 1, "p": 2}}'), ("b", '{"x": 1}')], "run_id string, config string")
    same = spark.createDataFrame([("a", '{"y": {"p": 2, "q": 1}, "x": 1}'), ("b", '{"x":1}')], "run_id string, config string")
    assert cat.config_drift(stored, same).count() == 0
    cat.check_resume(stored, same)
    moved = spark.createDataFrame([("b", '{"x": 2}')], "run_id string, config string")
    row = cat.config_drift(stored, moved).collect()[0]
    assert row["run_id"] == "b" and row["original_hash"] != row["new_hash"]
    with pytest.raises(DataError, match="run b"):
        cat.check_resume(stored, moved)


def test_evaluating_a_run_adds_to_its_metrics(spark, tmp_path):
    from finetide.plans.evaluate import evaluate_run

    path = str(tmp_path / "runs")
    cat.append_runs(frame(spark, record("a") | {"metrics": {"loss": 1.0, "eval_perplexity_avg_loss": 9.0}}, record("b")), path)
    texts = spark.range(20).select("id", F.lit("one two three").alias("text"))

    def score(df):
        return df.select("id", F.lit(0.5).alias("loss"), F.lit(3).alias("n_tokens"))

    def write(df):
        return df.select("id", F.lit("Response: x").alias("output"))

    names = ["perplexity", "instruction_following", "nope"]
    got = evaluate_run(spark, path, "a", texts, "id", names, score, write, str(tmp_path / "out"))
    assert {r["error"] for r in got.collect()} == {None, "Unknown benchmark: nope"}
    states = {r["run_id"]: r for r in cat.latest_states(cat.read_runs(spark, path)).collect()}
    metrics = states["a"]["metrics"]
    assert metrics["loss"] == 1.0 and metrics["eval_perplexity_avg_loss"] == 0.5
    assert metrics["eval_instruction_following_passed"] == 1.0 and states["b"]["metrics"] == {}
    with pytest.raises(DataError, match="not found"):
        evaluate_run(spark, path, "zzz", texts, "id", names, score, write, str(tmp_path / "no"))


def test_updates_clear_fields_and_the_latest_counts(spark):
    current = frame(spark, {**record("a"), "error": "boom"}, record("b"))
    updates = spark.createDataFrame(
        [("a", "training", "2030-01-01", None), ("a", "completed", "2030-01-02", None), ("b", "failed", "2030-01-01", "late")],
        "run_id string, status string, updated_at string, error string",
    )
    rows = {r["run_id"]: r for r in cat.updated_runs(current, updates).collect()}
    assert rows["a"]["status"] == "completed" and rows["a"]["error"] is None and rows["b"]["error"] == "late"
    states = current.unionByName(cat.updated_runs(current, updates))
    assert cat.list_runs(states).count() == 2
    assert cat.find_run(states, "a").collect()[0]["status"] == "completed"
    with pytest.raises(PySparkException, match="run not found"):
        cat.updated_runs(current, spark.createDataFrame([("zz", "failed")], "run_id string, status string")).collect()


def test_snapshots_leave_old_records_unread(spark, tmp_path):
    from finetide.plans import history

    path = str(tmp_path / "runs")
    assert history.read_latest(spark, path).count() == 0
    states = lambda n, time: frame(spark, *[record(f"r{i}", updated=f"2024-01-0{time}", error=f"at {time}") for i in n])
    cat.append_runs(states(range(20), 2), path)
    cat.append_runs(states(range(5), 3), path)
    history.compact_runs(spark, path)
    cat.append_runs(states(range(3, 25), 4).repartition(1), path)

    def check():
        got, want = history.read_latest(spark, path), cat.latest_states(cat.read_runs(spark, path))
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        return [f for f in got.inputFiles() if f.endswith(".json")]

    assert len(check()) == 1 < len(cat.read_runs(spark, path).inputFiles())
    history.compact_runs(spark, path)
    assert check() == [] and history.read_latest(spark, path).count() == 25
    assert [r["run_id"] for r in history.list_latest(spark, path).collect()] == [r["run_id"] for r in cat.list_runs(cat.read_runs(spark, path)).collect()]
    # A late record with an older time changes nothing; other tie-breakers read all records.
    cat.append_runs(states([1], 1).repartition(1), path)
    assert len(check()) == 1
    assert len(history.read_latest(spark, path, "global_step").inputFiles()) > 3
    assert {r["error"] for r in history.read_latest(spark, path).filter("run_id = 'r1'").collect()} == {"at 3"}
