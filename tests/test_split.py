"""Splits, samples and positions against plain Python."""

import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from finetide import DataError, SplitSpec
from finetide.operators import positions as pos
from finetide.operators import split as sp
from finetide.operators.fingerprint import content_fingerprint, split_stats


def key(seed, i):
    return hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()


def held_out(n, ratio, seed):
    count = 0 if n <= 1 else min(max(1, round(n * (1 - ratio))), n - 1)
    return set(sorted(range(n), key=lambda i: (key(seed, i), i))[:count])


@pytest.mark.parametrize("n,ratio", [(0, 0.9), (1, 0.9), (2, 0.9), (2, 0.1), (3, 0.9), (5, 0.9), (100, 0.8), (1015, 0.9), (25, 0.5)])
def test_split_equals_ranking_every_row(spark, n, ratio):
    df = sp.split_exact(spark.range(n), "id", SplitSpec(ratio, 42))
    rows = df.collect()
    assert len(rows) == n
    assert {r["id"] for r in rows if r["split"] == "validation"} == held_out(n, ratio, 42)


def test_split_does_not_depend_on_layout(spark):
    def labels(df):
        return sorted(map(tuple, sp.split_exact(df, "id").collect()))

    want = labels(spark.range(500))
    for n in (1, 9, 60):
        assert labels(spark.range(500).orderBy(F.rand(n)).repartition(n)) == want
    for partitions in ("1", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        assert labels(spark.range(500)) == want
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_split_by_name_and_ids(spark):
    df = sp.split_exact(spark.range(20), "id")
    assert sp.take_split(df, "train").count() == 18
    assert sp.take_split(spark.range(3), "validation").count() == 3
    with pytest.raises(DataError):
        sp.take_split(df, "dev")
    ids = spark.createDataFrame([(1,), (1,), (2,), (None,), (99,)], "id bigint")
    rows = sp.split_by_ids(spark.range(10), ids, "id").collect()
    assert sorted(r["id"] for r in rows if r["split"] == "validation") == [1, 2] and len(rows) == 10


def test_fraction_split_is_near_the_ratio(spark):
    n = sp.split_by_fraction(spark.range(20_000), "id").filter("split = 'validation'").count()
    assert abs(n - 2000) < 200


@pytest.mark.parametrize("limit", [1, 7, 999, 2500])
def test_sample_is_the_lowest_ranks_of_non_blank_texts(spark, limit):
    df = spark.range(2000).select("id", F.when(F.col("id") % 5 == 0, " 　").otherwise("t").alias("text"))
    want = sorted((i for i in range(2000) if i % 5), key=lambda i: (key(42, i), i))[:limit]
    assert sorted(r["id"] for r in sp.sample_texts(df, "id", limit).collect()) == sorted(want)


def test_positions_for_any_order(spark):
    names = spark.range(300).select(F.concat(F.lit("k"), F.col("id") * 37 % 300).alias("name"), "id")
    got = {r["name"]: r["position"] for r in pos.with_position(names.repartition(7), "name").collect()}
    assert got == {name: i for i, name in enumerate(sorted(got))}
    two = spark.range(100).select((F.col("id") % 3).alias("a"), (-F.col("id")).alias("b"))
    rows = pos.with_position(two, ["a", "b"]).collect()
    ordered = sorted((r["a"], r["b"]) for r in rows)
    assert all(ordered[r["position"]] == (r["a"], r["b"]) for r in rows)
    assert pos.with_position(spark.range(0), "id").count() == 0


def test_positions_when_one_order_value_prefix_dominates(spark):
    skewed = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("k"), "id")
    rows = pos.with_position(skewed, ["k", "id"]).collect()
    ordered = sorted((r["k"], r["id"]) for r in rows)
    assert all(ordered[r["position"]] == (r["k"], r["id"]) for r in rows)


def test_gather_takes_duplicates_and_negatives_and_refuses_the_rest(spark):
    df = spark.range(10).select((F.col("id") * 10).alias("k"))
    picks = spark.createDataFrame([(0, 3), (1, -1), (2, 3)], "o bigint, i bigint")
    got = sorted((r["o"], r["k"]) for r in pos.gather(df, "k", picks, "o", "i").collect())
    assert got == [(0, 30), (1, 90), (2, 30)]
    assert pos.row_at(df, "k", -10).collect() == [(0,)]
    for bad in (10, -11):
        with pytest.raises(PySparkException, match="out of range"):
            pos.row_at(df, "k", bad).collect()


def test_batches(spark):
    df = pos.batch_of(spark.range(10).withColumnRenamed("id", "position"), 4)
    assert sorted(r["batch"] for r in df.collect()) == [0] * 4 + [1] * 4 + [2] * 2


@pytest.mark.parametrize("ranked", [1, 100_000])
def test_row_cap_by_numbers_and_by_names(spark, monkeypatch, ranked):
    monkeypatch.setattr(pos, "RANKED_ROWS", ranked)
    monkeypatch.setattr(pos, "RANGES", 4)
    df = spark.range(100).select((F.lit(99) - F.col("id")).alias("k"))
    df = df.withColumn("name", F.format_string("%03d", "k"))
    for cap in (1, 25, 99):
        assert sorted(r["k"] for r in pos.cap_rows(df, "k", cap).collect()) == list(range(cap))
        assert sorted(r["k"] for r in pos.cap_rows(df, "name", cap).collect()) == list(range(cap))
    assert pos.cap_rows(df, "k", 500).count() == 100
    assert pos.cap_rows(df.limit(0), "k", 5).count() == 0


def test_null_and_repeated_order_values_fail(spark):
    from finetide.operators.dedup import deduplicate
    from finetide.plans.preprocess import preprocess

    null = spark.createDataFrame([(1, "first long text"), (None, "second long text"), (3, "third long text")], "id int, text string")
    same = spark.createDataFrame([(7, f"long text number {i}") for i in range(10)], "id int, text string")
    copy = spark.createDataFrame([(7, "the same long text")] * 2 + [(8, "another long text")], "id int, text string")
    for df in (null, same):
        for plan in (sp.split_exact, lambda d, c: sp.sample_texts(d, c, 2), deduplicate, preprocess):
            with pytest.raises(Exception, match="null in the order column|repeats"):
                plan(df, "id").collect()
    for plan in (deduplicate, preprocess):
        with pytest.raises(Exception, match="repeats"):
            plan(copy, "id").collect()
    with pytest.raises(Exception, match="null in the order column"):
        pos.cap_rows(null, "id", 2).collect()


def test_fingerprint_ignores_order_and_sees_everything_else(spark):
    def of(rows, schema="a string, b string, split string"):
        return content_fingerprint(spark.createDataFrame(rows, schema)).collect()[0]["fingerprint"]

    rows = [("x", "y", "train"), ("p", None, "validation")]
    assert of(rows) == of(rows[::-1])
    assert of(rows) != of([("x", "y", "validation"), ("p", None, "validation")])
    assert of(rows) != of(rows + rows[:1])
    assert of([("x|1:y", "z", "t")]) != of([("x", "y|1:z", "t")])
    assert of([(None, "-", "t")]) != of([("-", None, "t")])
    assert len(of([])) == 16


def test_split_stats(spark):
    df = sp.split_exact(spark.range(10), "id")
    assert sorted(map(tuple, split_stats(df).collect())) == [("train", 9, ["id"]), ("validation", 1, ["id"])]


def test_fingerprint_is_the_same_in_every_zone(spark):
    df = spark.range(20).select("id", F.timestamp_seconds(F.col("id") * 86_399).alias("at"))
    df = df.withColumn("nested", F.array(F.struct("at"))).withColumn("m", F.create_map(F.lit("b"), "at", F.lit("a"), "at"))
    turned = df.withColumn("m", F.create_map(F.lit("a"), "at", F.lit("b"), "at"))
    seen = set()
    for zone in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        seen |= {content_fingerprint(t).collect()[0]["fingerprint"] for t in (df, turned)}
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(seen) == 1


def test_address_equals_the_configuration_key(spark):
    import json

    from finetide.functions.keys import config_key
    from finetide.plans.cache import address

    payload = {"b": [1, 2.5, None], "a": {"z": "é", "y": True}, "ratio": 0.9}
    assert spark.range(1).select(config_key(F.lit(json.dumps(payload)))).head()[0] == address(payload)


def test_few_large_seeds_share_their_requests(spark, monkeypatch):
    from finetide.operators import generation as gen

    monkeypatch.setattr(gen, "BROADCAST_SEEDS", 1)
    monkeypatch.setattr(gen, "SEED_SHARE", 10)
    got = gen.assign_seeds(gen.seed_table(spark, ["a", "b", "c"]), 500, []).collect()
    assert sorted((r["id"], r["seed"]) for r in got) == [(i, "abc"[i % 3]) for i in range(500)]


def test_position_index(spark, tmp_path, many_files):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), F.concat(F.lit("v"), (F.col("id") * 37 % 1000).cast("string")).alias("v"))
    index = pos.PositionIndex.build(rows.repartition(8), "k", str(tmp_path / "index"))
    again = pos.PositionIndex(spark, str(tmp_path / "index"))
    assert len(again) == 1000 and len(again.files) > 1
    assert index.row_at(617).collect() == [(617, "v617")] and index.row_at(-1).collect() == [(999, "v999")]
    for bad in (1000, -1001):
        with pytest.raises(DataError, match="out of range"):
            index.row_at(bad)
    # A look-up opens the one file that holds the position, a slice those it touches.
    assert len(index.row_at(617).inputFiles()) == 1 < len(index.rows.inputFiles())
    first = index.files[0]["_pos_n"]
    assert len(index.between(0, first).inputFiles()) == 1 and len(index.between(first - 1, first + 1).inputFiles()) == 2
    assert sorted(r["k"] for r in index.between(-5, 10_000).collect()) == list(range(995, 1000))
    assert index.between(5, 5).collect() == []
    assert sorted(map(tuple, index.numbered("p").select("p", "k").collect())) == [(i, i) for i in range(1000)]
    picks = spark.createDataFrame([(i, (i * 31) % 1000 if i % 2 else -1 - i) for i in range(300)], "o long, at long")
    got = {r["o"]: r["k"] for r in index.gather(picks, "o", "at").collect()}
    assert got == {i: (i * 31) % 1000 if i % 2 else 999 - i for i in range(300)}
    near = spark.createDataFrame([(i, i % 3) for i in range(20)], "o long, at long")
    assert len([f for f in index.gather(near, "o", "at").inputFiles() if "/index/rows/" in f]) == 1
    with pytest.raises(PySparkException, match="out of range: 1000"):
        index.gather(spark.createDataFrame([(0, 1000)], "o long, at long"), "o", "at").collect()


def test_position_index_of_an_empty_table(spark, tmp_path):
    index = pos.PositionIndex.build(spark.range(0), "id", str(tmp_path / "index"))
    assert len(index) == 0 and index.numbered().collect() == [] and index.between(0, 5).collect() == []
    requests = spark.createDataFrame([], "o long, at long")
    assert index.gather(requests, "o", "at").collect() == []
