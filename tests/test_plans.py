"""The shape of physical plans: what must hold on a large cluster."""

import re

import pytest
from conftest import DATA

from finetide import Filters
from finetide.operators.dedup import deduplicate
from finetide.operators.split import split_exact
from finetide.plans.preprocess import preprocess


@pytest.fixture
def shuffled(spark):
    """As at scale, no table is small enough to broadcast on its own."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")


def executed_plan(df):
    """Plans before and after run-time re-planning, subqueries included."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def top_level(text):
    """The lines of the outermost plan: those of its subqueries hang on a colon."""
    return [line for line in text.splitlines() if not re.match(r"\s*:", line)]


@pytest.mark.parametrize("quality", [0.0, 0.6])
def test_main_plan(shuffled, quality):
    df = preprocess(documents(shuffled), "doc_id", filters=Filters(min_quality_score=quality))
    text = executed_plan(df)
    assert not re.search(r"Python|Pandas|InArrow|BatchEval", text)
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "BroadcastHashJoin" not in text
    # The digest exchange runs once and serves the two other branches.
    assert text.count("ReusedExchange") >= 2
    # Only digests and ids are grouped; the one exchange of texts is on the id.
    assert set(re.findall(r"hashpartitioning\((\w+)#", text)) == {"doc_id", "_digest", "prefix"}
    # With all build partitions small the join needs no sort.
    assert "ShuffledHashJoin" in text
    # A single task sees counts per prefix, never rows; of bad order values it sees one per task.
    lines = text.splitlines()
    below = [lines[n + 1] for n, line in enumerate(lines) if "SinglePartition" in line]
    counts = [line for line in below if "LocalLimit 1" not in line]
    assert counts and all("HashAggregate(keys=[prefix" in line and "count(1)" in line for line in counts)


def test_bucketed_source_needs_no_shuffle_of_texts(shuffled, tmp_path):
    """A table bucketed by the order column is joined where it lies: only ids move."""
    buckets = 8
    documents(shuffled).write.bucketBy(buckets, "doc_id").option("path", str(tmp_path / "t")).saveAsTable("bucketed_docs")
    df = preprocess(shuffled.table("bucketed_docs"), "doc_id")
    want = sorted(map(tuple, preprocess(documents(shuffled), "doc_id").collect()))
    assert sorted(map(tuple, df.collect())) == want
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in text
    on_id = [line for line in text.split("\n") if "hashpartitioning(doc_id" in line]
    # Order values are checked in their buckets; kept ids move to theirs.
    assert on_id and all(f", {buckets})" in line for line in on_id)
    shuffled.sql("drop table bucketed_docs")


def test_zero_quality_threshold_splits_no_words(spark, plan):
    text = plan(preprocess(documents(spark), "doc_id"))
    assert "split(" not in text


def test_quality_is_scored_on_the_digest_side_only(spark, plan):
    text = plan(preprocess(documents(spark), "doc_id", filters=Filters(min_quality_score=0.5)))
    assert text.count("FileScan") > 1
    assert text.count("array_distinct") == text.count("FileScan") - 1


def test_dedup_aggregates_before_the_exchange(shuffled, plan):
    text = plan(deduplicate(documents(shuffled), "doc_id"))
    assert "partial_min" in text and "SortAggregate" not in text


def test_split_moves_no_wide_row(spark, plan):
    text = plan(split_exact(documents(spark), "doc_id"))
    top = "\n".join(top_level(text))
    assert not re.search("Exchange|Join|Window", top.replace("AdaptiveSparkPlan", ""))
    assert "doc_id:bigint,text:string" in top
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas.count("doc_id:bigint,text:string") == 1
    assert set(schemas) == {"doc_id:bigint,text:string", "doc_id:bigint"}
