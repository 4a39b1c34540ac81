"""Bounded samples are bounded by rows: an id that very many rows repeat gives one."""

import pytest
from pyspark.sql import functions as F

from finetide.llm import language_id, quality, toxicity


@pytest.fixture(scope="module")
def docs(spark):
    text = F.concat(F.lit("Some words of a text in a language, number "), F.concat_ws(" ", F.transform(F.split(F.col("id").cast("string"), ""), lambda c: F.concat(F.lit("n"), c))))
    hot = spark.range(5000).select(F.lit(2).cast("bigint").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    return hot.union(spark.range(100, 160).select("id", text, F.lit("de"), F.lit("t")))


@pytest.fixture(scope="module")
def labels(spark):
    ids = [2, *range(100, 160)]
    return spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in ids], "doc_id long, quality int, toxic int")


def test_toxicity(docs, labels, monkeypatch):
    seen = []
    real = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda p, u, prior: seen.append((len(p), len(u))) or real(p, u, prior))
    toxicity.train(docs, labels, most_positive=10, most_unlabelled=20)
    assert seen and seen[0][0] <= 10 and seen[0][1] <= 20


def test_quality(docs, labels, monkeypatch):
    seen = []
    real = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append(x.shape[0]) or real(x, y))
    quality.train(docs, labels, most_rows=20)
    quality.train(docs, labels)
    assert seen[0] <= 20 and seen[1] <= 61


def test_language(docs, monkeypatch):
    seen = []
    real = language_id.Models.calibrate
    monkeypatch.setattr(language_id.Models, "calibrate", lambda self, costs, n, truth: seen.append(len(costs)) or real(self, costs, n, truth))
    language_id.train(docs, calibration_rows=15)
    assert seen and seen[0] <= 15
