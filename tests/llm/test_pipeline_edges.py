"""The pipeline's stages on an odd table and on an empty one."""

import pytest

import corpus_pipeline
from finetide.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, row string, key string, mark string"
TEXT = "A plain text of quite a few words that has two sentences. Here is the second one of them."
ROWS = [
    (1, TEXT, "en", "s1"), (1, TEXT, "en", "s1"), (2, None, "en", None), (3, "", None, "s2"), (4, " \n\t", "fr", None),
    (None, TEXT + " And a third.", "en", "s1"), (None, None, None, None), (7, " ".join(f"word{i % 977}" for i in range(30_000)), "en", "s2"),
    (8, "漢字 \U0001f600 ασδ", "xx", "s/deep"), (9, " ".join(f"passage{i}" for i in range(40)), "en", "s1"),
]


@pytest.fixture(params=["odd", "empty"])
def folder(spark, tmp_path, request):
    rows = [(*r, None if r[1] is None else len(r[1]), *["clash"] * 4) for r in ROWS] if request.param == "odd" else []
    tables = {
        "documents": spark.createDataFrame(rows, SCHEMA),
        "labels": spark.createDataFrame([(1, 1, 0), (8, None, None), (None, 1, 1)] if rows else [], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, " ".join(f"passage{i}" for i in range(40))), (None, None)] if rows else [], "item_id long, text string"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path), len(rows)


def test_every_stage(spark, folder):
    path, n = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = scratch_path(spark, f"odd-{number}")
        stage(spark, docs, path).write.parquet(out)
        before, docs = docs, spark.read.parquet(out)
        if number < 4:
            assert docs.columns == before.columns, name
            assert docs.distinct().exceptAll(before.distinct()).count() == 0, name  # rows stay as they are
            ids = {r["doc_id"] for r in docs.collect()}
            assert not n or None in ids, name
            assert number < 2 or 9 not in ids, name
    assert docs.count() == before.count() and (n == 0) == (docs.count() == 0)
