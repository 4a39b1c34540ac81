import sys

import pytest
from py4j.protocol import Py4JJavaError
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from finetide import DataError, GenerationSpec, SplitSpec
from finetide.operators import generation as gen
from finetide.plans.synthetic import generate_cached, seeds_from, synthetic_dataset

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def seeds(spark, values):
    return gen.seed_table(spark, values) if values else seeds_from(spark, None)


def echo():
    return lambda prompt: (f"<{prompt.splitlines()[0]}>", 3)


def shout():
    return lambda prompts: [p.upper() for p in prompts]


def test_round_robin_and_defaults(spark):
    rows = gen.assign_seeds(seeds(spark, ["a", "b", "c"]), 7, []).orderBy("id").collect()
    assert [r["seed"] for r in rows] == list("abcabca")
    rows = gen.assign_seeds(seeds(spark, []), 4, gen.LOCAL_SEEDS).orderBy("id").collect()
    assert [r["seed"] for r in rows] == gen.LOCAL_SEEDS + gen.LOCAL_SEEDS[:1]


def test_many_seeds_are_not_broadcast(spark, monkeypatch, plan):
    monkeypatch.setattr(gen, "BROADCAST_SEEDS", 2)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = gen.assign_seeds(seeds(spark, ["a", "b", "c"]), 7, [])
    assert "BroadcastHashJoin" not in plan(df)
    assert [r["seed"] for r in df.orderBy("id").collect()] == list("abcabca")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_single_stage(spark):
    generate = gen.get_backend("openai").generate
    rows = generate(seeds(spark, ["s", "t"]), 5, echo, delay=0).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(i, "<s>" if i % 2 == 0 else "<t>", 3) for i in range(5)]
    assert generate(seeds(spark, ["s"]), 5, echo, delay=0).rdd.getNumPartitions() == 4
    usage = gen.token_usage(generate(seeds(spark, ["s"]), 5, echo, delay=0)).collect()
    assert usage == [(5, 15)]


def test_retry_backs_off_and_gives_up(monkeypatch):
    pauses, calls = [], []
    monkeypatch.setattr(gen.time, "sleep", pauses.append)

    def flaky(prompt):
        calls.append(prompt)
        if len(calls) < 3:
            raise OSError("busy")
        return None, None

    assert gen.call_with_retry(flaky, "p", 3) == ("", 0)
    assert pauses == [1, 2]

    def broken(prompt):
        raise OSError("down")

    with pytest.raises(RuntimeError, match="after 2 tries: down"):
        gen.call_with_retry(broken, "p", 2)
    assert pauses == [1, 2, 1]


def test_failing_service_fails_the_query(spark):
    def connect():
        def call(prompt):
            raise OSError("down")

        return call

    requests = gen.assign_seeds(seeds(spark, ["s"]), 2, [])
    with pytest.raises(PySparkException, match="down"):
        gen.generate_single(requests, connect, max_retries=1, delay=0).collect()


def test_two_stages(spark):
    rows = gen.get_backend("self_instruct").generate(seeds(spark, [" ask "]), 3, shout).orderBy("id").collect()
    text = "Instruction: ASK\nResponse: ANSWER THIS INSTRUCTION HELPFULLY:\n ASK \n\nRESPONSE:"
    assert [tuple(r) for r in rows] == [(i, text) for i in range(3)]


def test_model_gets_bounded_batches(spark):
    def picky():
        def model(prompts):
            assert len(prompts) <= 4
            return [f"batch of {len(prompts)}" for _ in prompts]

        return model

    requests = gen.assign_seeds(seeds(spark, ["s"]), 10, []).coalesce(1)
    done = gen.complete(requests, F.col("seed"), "out", picky, 4).orderBy("id").collect()
    assert [r["out"] for r in done] == ["batch of 4"] * 8 + ["batch of 2"] * 2


def test_wrong_number_of_answers_fails(spark):
    def short():
        return lambda prompts: prompts[:-1]

    with pytest.raises(PySparkException, match="returned"):
        gen.complete(gen.assign_seeds(seeds(spark, ["s"]), 3, []), F.col("seed"), "o", short, 4).collect()


def test_nothing_left_gives_the_stand_in(spark):
    def endless():
        return lambda prompts: ["x" * 5000 for _ in prompts]

    rows = gen.get_backend("self_instruct").generate(seeds(spark, ["s"]), 3, endless).collect()
    assert [r["text"] for r in rows] == [gen.FALLBACK_TEXT]


def test_unknown_backend():
    with pytest.raises(DataError, match="unheard"):
        gen.get_backend("unheard")


def test_raw_cache_calls_the_model_once(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def counting(folder=str(log)):
        import uuid

        def call(prompt):
            open(f"{folder}/{uuid.uuid4().hex}", "w").close()
            return f"made {uuid.uuid4().hex}", 1

        return call

    spec = GenerationSpec(n_samples=6, backend="openai")
    root = str(tmp_path / "cache")
    first = generate_cached(spec, seeds(spark, ["s"]), counting, root, delay=0).collect()
    again = generate_cached(spec, seeds(spark, ["s"]), counting, root, delay=0).collect()
    assert sorted(r["text"] for r in first) == sorted(r["text"] for r in again)
    assert len(list(log.iterdir())) == 6
    generate_cached(spec, seeds(spark, ["other"]), counting, root, delay=0)
    assert len(list(log.iterdir())) == 12


def test_a_dead_job_resumes_with_the_unfinished_wave(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def service(fail_at):
        def connect(folder=str(log)):
            import os

            def call(prompt):
                name = prompt.splitlines()[0]
                if name == fail_at:
                    raise OSError("down")
                open(f"{folder}/{name}-{len(os.listdir(folder))}", "w").close()
                return name, 1

            return call

        return connect

    spec = GenerationSpec(n_samples=10, backend="anthropic")
    source = seeds(spark, [f"s{i}" for i in range(10)])
    options = dict(wave_rows=4, delay=0, max_retries=1, max_concurrency=1)
    with pytest.raises(PySparkException, match="down"):
        generate_cached(spec, source, service("s5"), str(tmp_path / "c"), **options)
    rows = generate_cached(spec, source, service(None), str(tmp_path / "c"), **options).collect()
    assert sorted((r["id"], r["text"]) for r in rows) == [(i, f"s{i}") for i in range(10)]
    calls = [f.name.split("-")[0] for f in log.iterdir()]
    assert all(calls.count(f"s{i}") == 1 for i in (0, 1, 2, 3, 8, 9))


def test_another_wave_size_mixes_nothing_in(spark, tmp_path):
    spec = GenerationSpec(n_samples=10, backend="openai")
    for size in (4, 3):
        rows = generate_cached(spec, seeds(spark, ["s"]), echo, str(tmp_path), wave_rows=size, delay=0)
        assert sorted(r["id"] for r in rows.collect()) == list(range(10))


def test_stand_in_only_when_all_waves_are_empty(spark, tmp_path):
    def endless():
        return lambda prompts: ["x" * 5000 for _ in prompts]

    rows = generate_cached(GenerationSpec(n_samples=5), seeds(spark, ["s"]), endless, str(tmp_path), wave_rows=2)
    assert [r["text"] for r in rows.collect()] == [gen.FALLBACK_TEXT]


def test_end_to_end_is_cached_and_split(spark, tmp_path):
    spec = GenerationSpec(n_samples=20)
    root = str(tmp_path / "root")
    rows = synthetic_dataset(spec, seeds(spark, ["a", "b"]), shout, root, SplitSpec(0.8))
    assert rows.count() == 20 and rows.filter("split = 'validation'").count() == 4

    def never():
        raise AssertionError("the cache should have answered")

    assert synthetic_dataset(spec, seeds(spark, ["a", "b"]), never, root, SplitSpec(0.8)).count() == 20


def test_filters_are_optional_for_generated_rows(spark, tmp_path):
    from finetide import Filters

    spec = GenerationSpec(n_samples=20)
    rows = synthetic_dataset(spec, seeds(spark, ["a", "b"]), shout, str(tmp_path / "f"), filters=Filters())
    assert rows.count() == 2


def counting(folder, dies_after=None, how="error"):
    """A service that notes every call in a file, and once dies in the middle."""

    def connect():
        made = [0]

        def call(prompt):
            import os
            import uuid

            if dies_after is not None and made[0] == dies_after and not os.path.exists(f"{folder}/died"):
                open(f"{folder}/died", "w").close()
                if how == "kill":
                    os._exit(1)
                raise OSError("gone")
            made[0] += 1
            with open(f"{folder}/call-{uuid.uuid4().hex}", "w") as file:
                file.write(prompt)
            return f"answer to {len(prompt)}", 1

        return call

    return connect


@pytest.mark.parametrize("how", ["error", "kill"])
def test_a_task_that_dies_asks_nothing_twice(spark, tmp_path, how):
    import os

    calls, root = tmp_path / "calls", str(tmp_path / "raw")
    calls.mkdir()
    spec, known = GenerationSpec(n_samples=40, backend="openai"), seeds(spark, [f"seed {i}" for i in range(40)])
    generate = lambda service, **more: generate_cached(spec, known, service, root, wave_rows=25, delay=0, max_retries=1, **more)
    with pytest.raises((PySparkException, Py4JJavaError)):
        generate(counting(str(calls), 4, how)).collect()
    before = len(os.listdir(calls)) - 1
    assert before >= 4
    # The job starts again, in one case with another number of tasks.
    rows = generate(counting(str(calls)), **({"max_concurrency": 3} if how == "kill" else {}))
    assert sorted(r["id"] for r in rows.collect()) == list(range(40))
    asked = [open(calls / f).read() for f in os.listdir(calls) if f.startswith("call-")]
    # A worker that is killed may lose the one answer that it was about to note.
    assert len(set(asked)) == 40 and len(asked) <= (40 if how == "error" else 43)
    assert not [f for _, _, files in os.walk(f"{root}/raw") for f in files if f.endswith(".jsonl")]  # notes go with the wave


def test_two_stage_answers_are_noted(spark, tmp_path):
    from finetide.operators.journal import Journal

    folder = tmp_path.as_uri().replace("file://", "file:")
    requests = gen.assign_seeds(seeds(spark, ["a", "b", "c"]), 9, [])
    first = gen.two_stage_rows(requests, lambda: lambda prompts: [f"{p} and more words" for p in prompts], 2, 3, Journal(f"{folder}/notes", 4))
    want = sorted(map(tuple, first.collect()))

    def closed():
        def model(prompts):
            raise RuntimeError("asked again")

        return model

    again = gen.two_stage_rows(requests, closed, 2, 3, Journal(f"{folder}/notes", 4))
    assert sorted(map(tuple, again.collect())) == want and len(want) == 9


def test_noted_waves_share_a_job(spark, tmp_path):
    """Small waves cost no job each where answers are noted; without notes a wave is still a job."""
    spec, known = GenerationSpec(n_samples=40, backend="openai"), seeds(spark, ["a", "b", "c"])
    for every, stored in ((1, 1), (0, 10)):
        root = tmp_path / f"every-{every}"
        rows = generate_cached(spec, known, echo, str(root), wave_rows=4, journal_every=every, delay=0)
        assert sorted(r["id"] for r in rows.collect()) == list(range(40))
        assert len(list(root.glob("raw/*.jsonl/*/_SUCCESS"))) == stored


def test_only_what_no_wave_holds_is_made(spark, tmp_path):
    """Gaps between stored waves are filled, whatever their sizes; a wave without its mark counts as none."""
    spec, known = GenerationSpec(n_samples=10, backend="openai"), seeds(spark, ["s"])
    generate_cached(spec, known, echo, str(tmp_path), wave_rows=4, journal_every=0, delay=0)
    (mark,) = tmp_path.glob("raw/*.jsonl/4-8/_SUCCESS")
    mark.unlink()

    def numbered():
        return lambda prompt: ("new", 1)

    rows = generate_cached(spec, known, numbered, str(tmp_path), wave_rows=3, journal_every=0, delay=0)
    assert sorted(r["id"] for r in rows.collect()) == list(range(10))
    assert sorted(r["id"] for r in rows.filter("text = 'new'").collect()) == [4, 5, 6, 7]


def test_a_folder_that_appears_while_it_is_listed(tmp_path):
    """Tasks start together: one looks for the notes' folder just before another makes it."""
    from pyarrow import fs

    from finetide.operators.journal import TaskJournal

    notes = TaskJournal(tmp_path.as_uri().replace("file://", "file:") + "/notes", 0, 2, 1)

    class Raced:
        def get_file_info(self, selector):
            if selector.allow_not_found:
                (tmp_path / "notes").mkdir()
                raise FileNotFoundError("Cannot list directory")
            return fs.LocalFileSystem().get_file_info(selector)

    notes.store = Raced()
    assert notes._listed(str(tmp_path / "notes")) == []
