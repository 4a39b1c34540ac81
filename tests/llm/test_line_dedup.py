"""Line dedup against plain Python, and the index by itself."""

from collections import defaultdict

import pytest

from finetide.llm import line_dedup

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, id string, mark string, batch string, h string, g string, row string, n_lines string, doomed string"
LINE = "A line of rather more than forty code points, é."


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def plain(rows, least_docs=5):
    """(id, n_lines, n_dropped, text) per row of (id, text)."""
    held = defaultdict(list)
    for i, text in rows:
        for key in {key_of(line) for line in (text or "").split("\n")}:
            if len(key) >= 40:
                held[key].append(i)
    top = {k: max((i for i in ids if i is not None), default=None) for k, ids in held.items() if len(ids) >= least_docs}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [s for s in lines if key_of(s) not in top or top[key_of(s)] == i]
        yield i, len(lines), len(lines) - len(kept), text if len(kept) == len(lines) else "\n".join(kept)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, *["clash"] * 8) for i, t in rows], SCHEMA)


ODD = [
    *[(i, f"{' ' * i}{LINE.upper() if i % 2 else LINE}\t\nown {i}\r\n\n{LINE}") for i in range(9)],
    *[(None, f"{LINE}\nnameless") for _ in range(3)],
    *[(None, "x" * 40) for _ in range(6)],
    *[(3, f"{LINE}\nown 3") for _ in range(2)],
    (20, None), (21, ""), (22, "\n"), (23, " \x0b\x0c\n" * 3),
    *[(30 + i, "y" * 39 + "\n" + "ü" * 39 + "\n" + "ü" * 40) for i in range(6)],
    *[(40 + i, "z" * 50 + " ") for i in range(4)],
    (50, "\n".join(f"line {i % 700} that is repeated inside a very long text only" for i in range(30_000))),
    *[(60 + i, "\n".join(f"line {j} that is repeated inside a very long text only" for j in range(i, 400 + i))) for i in range(5)],
]


@pytest.mark.parametrize("batches", [1, 3, 8])
def test_odd_rows(spark, batches):
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in line_dedup.dedupe(frame(spark, ODD), batches=batches).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain(ODD)))
    assert sum(r[2] for r in got) > 0


def test_columns_and_empty_table(spark):
    out = line_dedup.dedupe(frame(spark, ODD[:2]))
    assert out.columns == ["doc_id", "text", "id", "mark", "batch", "h", "g", "row", "doomed", "n_lines", "n_dropped"]
    assert {r["mark"] for r in out.collect()} == {"clash"}
    assert line_dedup.dedupe(frame(spark, [])).collect() == []


def test_runs_are_levelled_and_need_no_shuffle(spark, plan):
    index = line_dedup.LineRuns(spark, fan_out=2, buckets=4)
    seen = []
    for n in range(5):
        keys = [(i, k, k) for i in (10 * n, 10 * n + 1) for k in range(n, n + 3)]
        index.add(spark.createDataFrame(keys, "id long, h long, g long"))
        seen.append([len(level) for level in index.levels])
    assert seen == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]]
    old, new = index.runs()[-1], index.runs()[0]
    for how in (lambda: new.join(old.select("h", "g"), ["h", "g"], "left"), lambda: line_dedup.merged(old, new)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            joined = plan(how())
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "SortMergeJoin" in joined and "Exchange" not in joined
    rows = {r["h"]: (r["docs"], r["keeper"]) for r in index.entries().collect()}
    # Keys are kept by the first batch that had them, by its larger id.
    assert rows == {k: (2 * len([n for n in range(5) if n <= k < n + 3]), 10 * max(0, k - 2) + 1) for k in range(7)}
    index.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("finetide_line_run")]
