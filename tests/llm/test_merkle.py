"""The Merkle tree against plain Python, over the queries' tables and over odd small ones."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from finetide.llm import merkle
from finetide.llm.queries import QUERIES

LARGER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, at string, n string, id string, tree string, digest string, version string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def cell(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    return h(*[cell(row[c]) for c in ("doc_id", "source", "lang", "n_chars")], cell(text))


def plain(rows, tampered):
    """(doc_id, leaf, subroot, root, proof, folded root) per row."""
    trees = defaultdict(list)
    for row in rows:
        trees[row["source"]].append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))

    def levels(nodes):
        found = [nodes]
        while len(nodes) > 1:
            nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
            found.append(nodes)
        return found

    def others(found, i):
        for nodes in found[:-1]:
            start = i // 16 * 16
            yield nodes[start:i], nodes[i + 1 : start + 16]
            i //= 16

    for s in order:
        trees[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"], leaf_of(r, r["text"])))
    grown = {s: levels([leaf_of(r, r["text"]) for r in trees[s]]) for s in order}
    top = levels([grown[s][-1][0] for s in order])
    for k, s in enumerate(order):
        for i, row in enumerate(trees[s]):
            path = [*others(grown[s], i), *others(top, k)]
            new = leaf_of(row, tampered(row))
            for left, right in path:
                new = h(*left, new, *right)
            yield row["doc_id"], grown[s][0][i], grown[s][-1][0], top[-1][0], h(*[d for a, b in path for d in (*a, *b)]), new


def lower(row):
    if row["text"] is None or row["doc_id"] is None or zlib.crc32(str(row["doc_id"]).encode()) % 5:
        return row["text"]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])


def test_query_equals_plain_python(spark):
    rows = spark.read.parquet(f"{LARGER}/documents.parquet").collect()
    got = [tuple(r)[:6] for r in QUERIES["op11_merkle"](spark, LARGER).collect()]
    assert sorted(got) == sorted(plain(rows, lower))
    bad = [r["doc_id"] for r in rows if lower(r) != r["text"]]
    failed = [r["doc_id"] for r in QUERIES["op11_merkle"](spark, LARGER).filter("not verified").collect()]
    assert sorted(failed) == sorted(bad) and bad


def small(spark, sizes):
    """A table with so many rows per source; rows of source None repeat an id and have nulls."""
    rows = []
    for source, n in sizes.items():
        for i in range(n):
            number = None if source is None and i % 3 == 0 else i // 2 if source is None else i
            text = None if i % 7 == 3 else "" if i % 7 == 4 else f"Text {source} é {i // 2 if source is None else i}"
            rows.append((number, text, "en" if i % 2 else None, source, None if i % 5 == 0 else i, *["clash"] * 6))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 1, None: 1}, {"a": 17, "b": 16, None: 33}, {"a": 257, "é": 4, "z": 1}, {"big": 4200, "s": 300}])
def test_tree_shapes(spark, sizes):
    docs = small(spark, sizes)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle.proofs(docs, {"text": F.lower("text")}, chosen).collect()
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"], r["folded_root"]) for r in found]
    want = list(plain(docs.collect(), lower))
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    subroots = {(r["source"], r["n_rows"], r["subroot"]) for r in merkle.manifest(docs).collect()}
    assert {(s, n) for s, n, _ in subroots} == set(sizes.items())
    assert {x for *_, x in subroots} == {r["subroot"] for r in found}


def test_many_sources(spark):
    """More sources than a block holds: the tree of sources has several blocks itself."""
    docs = small(spark, {f"s{i:04}": 1 + i % 2 for i in range(300)})
    found = merkle.proofs(docs, {"text": F.lower("text")}, F.lit(False))
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"], r["folded_root"]) for r in found.collect()]
    assert sorted(got) == sorted(plain(docs.collect(), lambda r: r["text"]))
    assert all(r["version"] is None and r["folded_root"] == r["root"] for r in found.collect())


def test_versions_share_untouched_nodes(spark):
    """A version copies its leaf's ancestors and nothing else: other paths meet none of its nodes."""
    docs = small(spark, {"a": 300, "b": 20})
    found = merkle.proofs(docs, {"lang": F.lit("xx")}, F.col("doc_id") == 7).collect()
    changed = [r for r in found if r["version"] is not None]
    assert len(changed) == 2 and all(r["doc_id"] == 7 for r in changed)
    for row in changed:
        assert len(row["version"]) == (1 + 3 + 1 if len(row["version"]) == 5 else 1 + 2 + 1)
        assert row["version"][-1] == row["folded_root"] != row["root"] and row["leaf"] not in row["version"]
    assert all(r["folded_root"] == r["root"] for r in found if r["version"] is None)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert merkle.proofs(docs).collect() == [] and merkle.manifest(docs).collect() == []


def test_paths_survive_packing():
    path = [(3, [h(str(i)) for i in range(15)]), (0, []), (1, [h("x")])]
    assert merkle.unpacked(merkle.packed(path)) == path
