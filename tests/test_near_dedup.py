"""Near copies against all pairs in plain Python."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from finetide import DataError, Filters
from finetide.operators import near_dedup
from finetide.operators.components import groups
from finetide.operators.dedup import deduplicate
from finetide.plans.preprocess import preprocess

LARGER = "/root/testdata/sf0.01"


def shingles(text):
    words = ("None" if text is None else text).lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def roots(nodes, links):
    name = {n: n for n in nodes}

    def find(n):
        while name[n] != n:
            n = name[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        name[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def similar(rows, threshold):
    sets = {i: shingles(t) for i, t in rows}
    held = {}
    for i, found in sets.items():
        for s in found:
            held.setdefault(s, []).append(i)
    pairs = {p for ids in held.values() for p in combinations(sorted(ids), 2)}
    return {(a, b) for a, b in pairs if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold}


def plain(rows, threshold):
    return sorted(n for n, r in roots([i for i, _ in rows], similar(rows, threshold)).items() if n == r)


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.95, 1.0])
def test_equals_all_pairs(spark, threshold):
    rows = [tuple(r) for r in spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text").collect()]
    got = deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", threshold=threshold)
    assert sorted(r["doc_id"] for r in got.collect()) == plain(rows, threshold)


def test_recall_of_pairs(spark):
    """Of the pairs at least that similar nine in ten must share a band; nearly all do."""
    rows = [tuple(r) for r in spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text").collect()]
    links = similar(rows, 0.8)
    words = spark.createDataFrame(rows, "id long, text string").select("id", near_dedup.word_hashes(F.col("text")).alias("words"))
    keys = {r["id"]: r["keys"] for r in near_dedup.sketched(words, 0.8).collect()}
    met = sum(any(x == y for x, y in zip(keys[a], keys[b], strict=True)) for a, b in links)
    assert len(links) > 50 and met >= 0.999 * len(links)


def test_odd_texts(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [
        (9, base), (4, base.upper() + " \n"), (12, base + " more"), (13, None), (14, None), (15, ""), (16, " \t"), (17, "a b"), (18, "A  b"),
        (19, "a b c"), (20, "x " * 3000 + "y"), (21, "x " * 5000 + "y"), (22, " ".join(f"v{i % 4000}" for i in range(50_000))),
    ]
    df = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], "doc_id long, text string, id string, shingles string, root string")
    assert sorted(r["doc_id"] for r in deduplicate(df, "doc_id", threshold=0.9).collect()) == plain(rows, 0.9)
    assert deduplicate(df, "doc_id", threshold=0.9).columns == df.columns
    assert deduplicate(df.limit(0), "doc_id", threshold=0.9).collect() == []


def test_chains_and_a_large_group(spark):
    """A third of the rows are near copies of one text, of which neighbours alone may be linked."""
    draw = random.Random(5)
    rows = [(1000 + i, " ".join(f"t{(i // 3 if j % 40 == 7 else 0)}w{j}" for j in range(400))) for i in range(300)]
    rows += [(i, " ".join(f"c{j}" for j in range(8 * i, 8 * i + 160))) for i in range(80)]
    rows += [(2000 + i, " ".join(draw.choice("abcdefghij") * 3 for _ in range(50))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in deduplicate(df, "doc_id", threshold=0.8).collect()) == plain(rows, 0.8)


def test_buckets_split_into_groups_lose_no_link(spark, monkeypatch):
    """With one-row bands dissimilar texts share buckets, so stars alone would miss links."""
    monkeypatch.setattr(near_dedup, "rows_per_band", lambda _: 1)
    rows = [(i, " ".join(["common words that all of them share for long"] * 2 + [f"own{(i // 2) % 40}x{j}" for j in range(30)])) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in deduplicate(df, "doc_id", threshold=0.6).collect()) == plain(rows, 0.6)


def test_bands_follow_the_threshold():
    for threshold in (0.5, 0.8, 0.95):
        rows = near_dedup.rows_per_band(threshold)
        assert (1 - threshold**rows) ** near_dedup.BANDS <= near_dedup.MISSED < (1 - threshold ** (rows + 1)) ** near_dedup.BANDS
    with pytest.raises(DataError, match="similarity"):
        near_dedup.rows_per_band(0.3)
    few = near_dedup.shingles(np.arange(3, dtype=np.uint64))
    assert len(few) == 1 and len(near_dedup.shingles(np.arange(9, dtype=np.uint64))) == 5


def test_setting_has_an_effect(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text")
    exact = preprocess(docs, "doc_id", filters=Filters(dedup_threshold=0.8)).count()
    near = preprocess(docs, "doc_id", filters=Filters(dedup_threshold=0.8, near_copies=True)).count()
    assert near < exact


def test_groups_of_chains(spark):
    links = [(i, i + 1) for i in range(100)] + [(200, 150), (150, 170)] + [(300, i) for i in range(400, 460)] + [(5, 5)]
    found = groups(spark.createDataFrame(links, "a long, b long"), "a", "b")
    want = roots({n for link in links[:-1] for n in link}, links)
    assert {r["node"]: r["root"] for r in found.collect()} == want


def test_sets_are_stored_only_for_rows_that_share_a_bucket(spark, monkeypatch):
    """Shingle sets outweigh the texts: those of rows without a candidate are neither stored nor shuffled."""
    stored = {}

    def noting(df, name):
        stored.setdefault(name, []).append(kept(df, name))
        return stored[name][-1]

    kept = near_dedup.written
    monkeypatch.setattr(near_dedup, "written", noting)
    base = " ".join(f"c{j}" for j in range(200))
    rows = [(i, " ".join(f"t{i}w{j}" for j in range(200))) for i in range(60)]
    rows += [(100, base), (101, base + " more"), (102, base[:300]), (103, f"{base} {base.replace('c', 'd')}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in deduplicate(df, "doc_id", threshold=0.8).collect()) == plain(rows, 0.8)
    holding = [t for tables in stored.values() for t in tables if "shingles" in t.columns]
    assert len(holding) == 1 and {100, 101} <= {r["id"] for r in holding[0].collect()} <= {100, 101, 102, 103}
    # Sizes decide first: 102 and 103 are too short and too long to be a copy of 100.
    assert {(r["a"], r["b"]) for t in stored["pairs"] for r in t.collect()} == {(100, 101)}


def test_the_plan_stores_sets_of_candidates_only(spark, monkeypatch):
    """The main plan at the configured similarity: filtered rows without a candidate have no stored set."""
    stored = []

    def noting(df, name):
        stored.append(kept(df, name))
        return stored[-1]

    kept = near_dedup.written
    monkeypatch.setattr(near_dedup, "written", noting)
    rows = [(i, " ".join(f"t{i}w{j}" for j in range(50))) for i in range(40)] + [(90 + i, " ".join(f"c{j}" for j in range(100 + i))) for i in range(3)]
    docs = spark.createDataFrame([*rows, (99, "short")], "doc_id long, text string")
    filters = Filters(min_length=20, max_length=20_000, dedup_threshold=0.85, near_copies=True)
    assert sorted(r["doc_id"] for r in preprocess(docs, "doc_id", filters=filters).collect()) == plain(rows, 0.85) == [*range(40), 90]
    sets = [t for t in stored if "shingles" in t.columns]
    assert len(sets) == 1 and sorted(r["id"] for r in sets[0].collect()) == [90, 91, 92]


@pytest.mark.parametrize("threshold", [0.5, 0.85, 1.0])
def test_cells_lose_no_pair(spark, threshold):
    """The overlap by cells is a bound, also of sets of different sizes with different numbers of cells."""
    draw = np.random.Generator(np.random.PCG64(3))
    sets = {}
    for i in range(60):
        base = draw.integers(0, 1 << 63, int(draw.choice([1, 2, 31, 33, 64, 65, 300])), dtype=np.uint64)
        less = base[: max(1, int(len(base) * draw.choice([0.5, 0.85, 0.86, 1.0])))]
        more = np.concatenate([base[: max(1, int(len(base) * draw.choice([0.5, 0.9, 1.0])))], draw.integers(0, 1 << 63, int(len(base) * draw.choice([0, 0.1, 0.5])), dtype=np.uint64)])
        sets |= {3 * i + k: np.unique(s) for k, s in enumerate((base, less, more))}
    rows = [(i, s.view(np.int64).tolist(), near_dedup.cells(s).view(np.int64).tolist(), len(s)) for i, s in sets.items()]
    pairs = [(3 * i + a, 3 * i + b) for i in range(60) for a, b in ((0, 1), (2, 0), (1, 2))] + [(i, i + 3) for i in range(170)]
    table = spark.createDataFrame(rows, "id long, shingles array<long>, cells array<long>, n int")
    found = near_dedup._similar(spark.createDataFrame(pairs, "a long, b long"), table, threshold)
    overlap = lambda a, b: len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b]))
    want = {p for p in pairs if overlap(*p) >= threshold}
    assert {tuple(r) for r in found.collect()} == want and want


def test_a_family_below_the_threshold_moves_no_sets(spark, monkeypatch):
    """Texts that share half of their shingles meet in buckets; what moves for each such pair is small."""
    stored, plans = {}, {}

    def noting(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        stored.setdefault(name, []).append(kept(df, name))
        return stored[name][-1]

    kept = near_dedup.written
    monkeypatch.setattr(near_dedup, "written", noting)
    base = " ".join(f"c{j}" for j in range(200))
    rows = [(i, base + " " + " ".join(f"t{i}w{j}" for j in range(100))) for i in range(30)]
    rows += [(60 + i, rows[0][1].upper() + " x" * i) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted(r["doc_id"] for r in deduplicate(df, "doc_id", threshold=0.8).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == plain(rows, 0.8)
    met = sum(t.count() for t in stored["members"])
    moved = {(r["a"], r["b"]) for t in stored["pairs"] for r in t.collect()}
    assert met > 100 and all(len(shingles(dict(rows)[a]) & shingles(dict(rows)[b])) > 200 for a, b in moved)
    # Candidates' texts are picked where they lie, by the ids.
    assert len(plans["sets"]) == 1 and "BroadcastHashJoin" in plans["sets"][0] and "SortMergeJoin" not in plans["sets"][0]
