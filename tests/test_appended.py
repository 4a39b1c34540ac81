"""Prepared data over a growing folder equal a run from the start, and old files stay unread."""

import json
import os

import pytest
from pyspark.sql import functions as F

from finetide import DataError, DatasetSpec, Filters, SplitSpec
from finetide.operators.fingerprint import content_fingerprint
from finetide.plans import appended
from finetide.plans.prepare import prepare
from finetide.plans.preprocess import preprocess_dataset

SCHEMA = "id bigint, text string, n int"


@pytest.fixture
def read(monkeypatch):
    """The file names that each run reads."""
    seen = []
    real = appended.files.load_files
    monkeypatch.setattr(appended.files, "load_files", lambda s, d, p: seen.append(sorted(os.path.basename(x) for x in p)) or real(s, d, p))
    return seen


def put(folder, name, ids, text="text number {} is long enough"):
    path = folder / "src" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps({"id": i, "text": text.format(i % 40), "n": i}) for i in ids))
    return str(path)


def rows(df):
    return sorted(map(repr, (r.asDict() for r in df.collect())))


def check(spark, spec, root, split=SplitSpec(), filters=Filters()):
    """What appending gives, against the whole plan over all files."""
    got = prepare(spark, spec, "id", root, filters=filters, split=split, appending=True)
    want = preprocess_dataset(spark, spec, "id", filters=filters, split=split)
    assert rows(got) == rows(want)
    state = appended.Prepared(spark, spec, "id", root, filters=filters, split=split)
    assert state.fingerprint() == content_fingerprint(want).head()["fingerprint"]
    return got


def test_only_new_files_are_read(spark, tmp_path, read):
    spec, root = DatasetSpec(path=str(tmp_path / "src"), schema=SCHEMA), str(tmp_path / "cache")
    put(tmp_path, "day=1/b.jsonl", range(100, 130))
    assert check(spark, spec, root).count() == 30
    put(tmp_path, "day=2/a [1]{x}*.jsonl", range(0, 60))  # lower ids of texts that are there, repeats, and a cut that moves
    put(tmp_path, "day=2/blank.jsonl", range(500, 505), "short")
    kept = check(spark, spec, root)
    assert kept.count() == 40 and kept.agg(F.max("id")).head()[0] < 100
    assert {r["day"] for r in kept.select("day").collect()} == {2}
    check(spark, spec, root)
    assert read == [["b.jsonl"], ["a [1]{x}*.jsonl", "blank.jsonl"]]
    files = {os.path.basename(f) for f in kept.inputFiles()}
    assert not files & {"b.jsonl", "blank.jsonl"}


def test_changed_or_removed_files_start_again(spark, tmp_path, read):
    spec, root = DatasetSpec(path=str(tmp_path / "src"), schema=SCHEMA), str(tmp_path / "cache")
    put(tmp_path, "a.jsonl", range(10))
    extra = put(tmp_path, "b.jsonl", range(10, 25))
    check(spark, spec, root)
    put(tmp_path, "b.jsonl", range(10, 12))
    assert check(spark, spec, root).count() == 12
    os.remove(extra)
    assert check(spark, spec, root).count() == 10
    assert read == [["a.jsonl", "b.jsonl"], ["a.jsonl", "b.jsonl"], ["a.jsonl"]]


def test_new_columns_start_again(spark, tmp_path, read):
    spec, root = DatasetSpec(path=str(tmp_path / "src")), str(tmp_path / "cache")
    put(tmp_path, "a.jsonl", range(10))
    check(spark, spec, root)
    (tmp_path / "src" / "b.jsonl").write_text(json.dumps({"id": 50, "text": "a text with a further column", "n": 1, "extra": "x"}))
    assert "extra" in check(spark, spec, root).columns
    assert read == [["a.jsonl"], ["b.jsonl"], ["a.jsonl", "b.jsonl"]]


def test_segments_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(appended, "MOST_SEGMENTS", 2)
    spec, root = DatasetSpec(path=str(tmp_path / "src"), schema=SCHEMA), str(tmp_path / "cache")
    for n in range(4):
        put(tmp_path, f"f{n}.jsonl", range(90 - 30 * n, 120 - 30 * n))
        check(spark, spec, root, SplitSpec(0.7, 3), Filters(min_length=28))
    state = appended.Prepared(spark, spec, "id", root, filters=Filters(min_length=28), split=SplitSpec(0.7, 3))
    assert len(state._state()["segments"]) == 2


def test_order_values_are_checked_over_all_files(spark, tmp_path):
    spec, root = DatasetSpec(path=str(tmp_path / "src"), schema=SCHEMA), str(tmp_path / "cache")
    put(tmp_path, "a.jsonl", range(10))
    check(spark, spec, root)
    put(tmp_path, "b.jsonl", [3], "x{}")  # too short to be kept, and yet the id repeats
    with pytest.raises(DataError, match="repeats: 3"):
        prepare(spark, spec, "id", root, appending=True)
    os.remove(tmp_path / "src" / "b.jsonl")
    assert check(spark, spec, root).count() == 10


def test_two_writers(spark, tmp_path, monkeypatch):
    """One of two runs that start alike publishes; the other takes up its state."""
    spec, root = DatasetSpec(path=str(tmp_path / "src"), schema=SCHEMA), str(tmp_path / "cache")
    put(tmp_path, "a.jsonl", range(10))
    check(spark, spec, root)
    put(tmp_path, "b.jsonl", range(10, 20))
    real, began = appended.Prepared._write_segment, []

    def slow(self, segment, wanted):
        if not began:
            began.append(True)
            prepare(spark, spec, "id", root, appending=True)
        return real(self, segment, wanted)

    monkeypatch.setattr(appended.Prepared, "_write_segment", slow)
    assert check(spark, spec, root).count() == 20
    state = appended.Prepared(spark, spec, "id", root)
    assert state.versions.newest() == 2 and len(state._state()["segments"]) == 2


def test_unsuited_settings_and_missing_folders(spark, tmp_path):
    root = str(tmp_path / "cache")
    with pytest.raises(DataError, match="row cap"):
        prepare(spark, DatasetSpec(path=str(tmp_path), max_rows=5), "id", root, appending=True)
    with pytest.raises(DataError, match="not found"):
        prepare(spark, DatasetSpec(path=str(tmp_path / "none")), "id", root, appending=True)
    (tmp_path / "src").mkdir()
    with pytest.raises(DataError, match="no data files"):
        prepare(spark, DatasetSpec(path=str(tmp_path / "src"), schema=SCHEMA), "id", root, appending=True)
