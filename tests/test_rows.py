"""Normalising, filtering, deduplicating."""

import random
import re
from datetime import date, datetime
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from finetide import DataError, DatasetSpec, Filters, SplitSpec
from finetide.operators import rows as ops
from finetide.operators.dedup import deduplicate
from finetide.operators.filters import apply_filters, with_quality
from finetide.operators.normalize import rename, text_key, to_preference_rows, to_text_rows
from finetide.specs import is_preference


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id bigint, text string")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_settings_are_checked():
    for make in (
        lambda: Filters(min_length=0),
        lambda: Filters(min_quality_score=1.5),
        lambda: SplitSpec(train_split=1.0),
        lambda: DatasetSpec(path="x", format="orc"),
        lambda: is_preference("unheard-of"),
    ):
        with pytest.raises(DataError):
            make()
    assert is_preference("dpo") and not is_preference("grpo")


def test_text_column_is_renamed(spark):
    df = spark.createDataFrame([(1, "a")], "id bigint, body string")
    assert to_text_rows(df, DatasetSpec(path="", text_column="body")).columns == ["id", "text"]


def test_prompt_and_response_merge_with_nulls(spark):
    df = spark.createDataFrame([(1, "p", None)], "id bigint, p string, r string")
    spec = DatasetSpec(path="", prompt_column="p", response_column="r")
    assert to_text_rows(df, spec, keep=("id",)).collect() == [(1, "p\nNone")]


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([(1, "p")], "id bigint, prompt string")
    with pytest.raises(DataError, match="chosen.*rejected"):
        to_preference_rows(df, DatasetSpec(path=""))
    with pytest.raises(DataError, match="text"):
        to_text_rows(df, DatasetSpec(path=""))


def test_rename_refuses_duplicates(spark):
    df = spark.createDataFrame([(1, "p")], "id bigint, prompt string")
    with pytest.raises(DataError, match="duplicate"):
        rename(df, {"prompt": "id"})
    assert text_key(df) == "prompt"


def test_length_bounds_are_inclusive_and_in_code_points(spark):
    values = ["x" * n for n in (9, 10, 4096, 4097)] + ["\U0001f600" * 10, None, ""]
    assert ids(apply_filters(texts(spark, values), Filters())) == [1, 2, 4]


def test_null_is_tested_as_its_text_and_absent_column_as_empty(spark):
    assert ids(apply_filters(texts(spark, [None]), Filters(min_length=4))) == [0]
    df = spark.createDataFrame([(0, "long enough prompt")], "id bigint, prompt string")
    assert ids(apply_filters(df, Filters(), "sft")) == []


def test_preference_rows_need_all_three(spark):
    good, bad = "long enough text", "short"
    data = [(0, good, good, good), (1, bad, good, good), (2, good, bad, good), (3, good, good, bad)]
    df = spark.createDataFrame(data, "id bigint, prompt string, chosen string, rejected string")
    assert ids(apply_filters(df, Filters(), "dpo")) == [0]


def test_quality_threshold(spark):
    values = ["", "one two", "a a a a a a a a", "a b c d"]
    df = texts(spark, values)
    assert ids(df.filter("id >= 0").transform(lambda d: with_quality(d, "text", 0.6))) == [3]
    assert ids(apply_filters(df, Filters(min_length=1, min_quality_score=0.2))) == [1, 2, 3]
    assert ids(apply_filters(df, Filters(min_length=1, min_quality_score=0.5))) == [2, 3]


def test_dedup_keeps_the_lowest_id_whatever_the_partitioning(spark):
    rng = random.Random(3)
    base = ["Hello  World", "hello world", " HELLO WORLD ", "other", "Other\n", None, "None", "x y", "x  y", "xy"]
    values = [rng.choice(base) for _ in range(400)]
    first = {}
    for i, value in enumerate(values):
        first.setdefault(re.sub(r"\s+", " ", str(value).lower().strip()), i)
    want = sorted(first.values())
    df = texts(spark, values)
    for n in (1, 4, 37):
        shuffled = df.orderBy(F.rand(n)).repartition(n)
        once = deduplicate(shuffled, "id")
        assert ids(once) == want
    assert ids(deduplicate(once, "id")) == want


def test_dedup_uses_the_prompt_when_there_is_no_text(spark):
    df = spark.createDataFrame([(0, "p", "a"), (1, "P ", "b")], "id bigint, prompt string, chosen string")
    assert ids(deduplicate(df, "id")) == [0]


def test_from_columns_needs_equal_lengths(spark):
    df = spark.createDataFrame([(1, [1, 2], ["a", "b"])], "k int, a array<int>, b array<string>")
    rows = ops.from_columns(df, {"x": "a", "y": "b"}, keep=["k"]).collect()
    assert [tuple(r) for r in rows] == [(1, 0, 1, "a"), (1, 1, 2, "b")]
    ragged = spark.createDataFrame([(1, [1, 2], ["a"])], "k int, a array<int>, b array<string>")
    with pytest.raises(PySparkException, match="differ in length"):
        ops.from_columns(ragged, {"x": "a", "y": "b"}).collect()


def test_records_follow_the_first_row(spark):
    lines = [(0, '{"b": 1, "a": "x"}'), (1, '{"a": "y", "c": true}')]
    df = ops.from_records(spark.createDataFrame(lines, "pos int, line string"), "line", "pos")
    assert df.columns == ["b", "a"]
    assert sorted(map(tuple, df.collect()), key=str) == [(1, "x"), (None, "y")]


def test_map_and_filter_with_callables(spark):
    df = texts(spark, ["a", "bb", "ccc"])
    mapped = ops.map_rows(df, lambda b: b.assign(n=b["text"].str.len())[["id", "n"]], "id bigint, n bigint")
    assert sorted(map(tuple, mapped.collect())) == [(0, 1), (1, 2), (2, 3)]
    assert ids(ops.filter_rows(df, lambda s: s.str.len() > 1, "text")) == [1, 2]
    assert ops.map_columns(df, {"text": F.upper("text")}, remove=["text", "id"]).columns == ["text"]


def test_arrow_functions_keep_types(spark):
    import pyarrow as pa
    import pyarrow.compute as pc

    schema = "id bigint, price decimal(20,4), raw binary, tags array<struct<k:string,v:array<int>>>, seen timestamp, m map<string,decimal(8,2)>"
    values = [
        (1, Decimal("12345678901234.5678"), bytearray(b"\x00\xff"), [("a", [1, None]), ("b", None)], datetime(2024, 1, 2, 3, 4, 5, 6), {"x": Decimal("1.10")}),
        (2, None, None, None, None, None),
    ]
    df = spark.createDataFrame(values, schema)
    out = ops.map_arrow(df, lambda b: b, schema)
    assert out.dtypes == df.dtypes and sorted(map(repr, out.collect())) == sorted(map(repr, df.collect()))
    doubled = ops.map_arrow(df, lambda b: pa.table({"n": pc.add(b["id"], 1), "id": b["id"], "unused": b["price"]}), "id bigint, n bigint")
    assert sorted(map(tuple, doubled.collect())) == [(1, 2), (2, 3)]
    with pytest.raises(PySparkException, match="no column n"):
        ops.map_arrow(df, lambda b: b, "id bigint, n bigint").collect()
    assert ids(ops.filter_rows(df, lambda price: pc.greater(price, 5), "price", arrow=True)) == [1]
    assert "ArrowEvalPython" in df.select("*").transform(lambda d: ops.filter_rows(d, lambda i: pc.greater(i, 1), "id", arrow=True))._jdf.queryExecution().executedPlan().toString()


def test_arrow_rewards_and_tokens(spark):
    import pyarrow as pa
    import pyarrow.compute as pc

    from finetide.operators import rl

    df = texts(spark, ["a bb", "", None])
    scored = rl.reward_by(df, "text", lambda t: pa.chunked_array([pc.utf8_length(t)]), arrow=True)
    assert {r["id"]: r["reward"] for r in scored.collect()} == {0: 4.0, 1: 0.0, 2: 4.0}
    tokens = rl.tokenize(df, 1, lambda t: pa.array([[1, 2, 3]] * len(t)), keep=("id",), arrow=True)
    assert all(r["input_ids"] == [1] for r in tokens.collect()) and tokens.columns == ["id", "input_ids"]


def test_a_predicate_sees_long_texts_in_parts(spark, monkeypatch):
    """A batch of long texts never becomes pandas objects as a whole; the answers are those of the rows."""
    seen = spark.sparkContext.accumulator(0)

    def odd(text: pd.Series, other: pd.Series) -> pd.Series:
        if text.str.len().sum() + other.str.len().sum() > 3_000_000 and len(text) > 1:
            raise RuntimeError("too much at once")
        seen.add(len(text))
        found = text.str.endswith("1").astype(object)
        return found.where(other != "none", None)

    row = F.col("id").cast("string")
    text = F.when(F.col("id") % 50 == 7, F.lit(None)).otherwise(F.concat(F.repeat(F.lit("x"), 20_000), row))
    df = spark.range(0, 1000, 1, 1).select("id", text.alias("text"), F.when(F.col("id") == 11, "none").otherwise(row).alias("other"))
    got = sorted(r["id"] for r in ops.filter_rows(df, odd, "text", "other").select("id").collect())
    assert got == [i for i in range(1000) if i % 10 == 1 and i != 11] and seen.value == 1000
    with pytest.raises(PySparkException, match="answers for"):
        ops.filter_rows(df, lambda text: text.iloc[:-1].isnull(), "text").count()


def test_a_map_sees_long_texts_in_parts(spark):
    """A batch of long texts never becomes pandas objects as a whole; the rows are those of the table."""
    seen = spark.sparkContext.accumulator(0)

    def lengths(batch: pd.DataFrame) -> pd.DataFrame:
        if len(batch) > 1 and batch["text"].str.len().sum() > 3_000_000:
            raise RuntimeError("too much at once")
        seen.add(len(batch))
        return pd.DataFrame({"n": batch["text"].str.len().astype("Int64"), "id": batch["id"]})

    text = F.when(F.col("id") % 50 == 7, F.lit(None)).otherwise(F.concat(F.repeat(F.lit("x"), 20_000), F.col("id").cast("string")))
    df = spark.range(0, 1000, 1, 1).select("id", F.when(F.col("id") == 3, F.repeat(F.lit("y"), 5_000_000)).otherwise(text).alias("text"))
    got = {r["id"]: r["n"] for r in ops.map_rows(df, lengths, "id bigint, n bigint").collect()}
    assert got == {i: None if i % 50 == 7 else 5_000_000 if i == 3 else 20_000 + len(str(i)) for i in range(1000)} and seen.value == 1000


def test_a_map_gives_what_spark_gives(spark):
    """Plain columns are converted in parts as ``mapInPandas`` converts whole batches."""
    schema = "s string, b binary, t boolean, i tinyint, j int, k bigint, f float, d double, day date, m decimal(20,4)"
    values = [("a", bytearray(b"\x00"), True, 1, 2, 2**53 + 1, 1.5, float("nan"), date(2024, 1, 2), Decimal("1.1000")), (None,) * 10, ("", bytearray(), False, -1, 0, 7, 0.0, -0.0, date(1, 1, 1), Decimal(0))]
    for rows in (values, values[:1], []):
        df = spark.createDataFrame(rows, schema).coalesce(1)
        kinds = lambda b: pd.DataFrame({"n": [len(b)], "kinds": [",".join(f"{n}:{t}" for n, t in b.dtypes.items())]})
        for fn, out in ((lambda b: b[b.columns[::-1]], schema), (lambda b: b.set_axis(range(10), axis=1), schema), (kinds, "kinds string, n bigint"), (lambda b: pd.DataFrame(), schema)):
            want = df.mapInPandas(lambda batches, fn=fn: map(fn, batches), out)
            got = ops.map_rows(df, fn, out)
            assert got.schema == want.schema and list(map(repr, got.collect())) == list(map(repr, want.collect()))
    one = spark.createDataFrame(values[:1], schema)
    for wrong, message in ((lambda b: b.rename(columns={"s": "u"}), "differ in s, u"), (lambda b: b["s"], "not a pandas"), (lambda b: b.set_axis(range(10), axis=1)[[0, 1]], "gave 2 columns")):
        with pytest.raises(PySparkException, match=message):
            ops.map_rows(one, wrong, schema).collect()
    nested = spark.createDataFrame([([1, 2], datetime(2024, 1, 2))], "a array<int>, at timestamp")
    assert ops.map_rows(nested, lambda b: b, "a array<int>, at timestamp").collect() == nested.collect()
