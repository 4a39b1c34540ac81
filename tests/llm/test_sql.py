"""The queries that have SQL, against DuckDB."""

import pytest
from conftest import DATA
from test_registered import canonical

from finetide.llm.oracles import ORACLES
from finetide.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(result.fetchall(), columns)


def test_repeated_and_null_items_equal_sql(spark, tmp_path):
    """Items of one id count once, those of a null id by a name; long items keep what a hit needs."""
    import duckdb

    words = [f"w{i}" for i in range(400)]
    items = [(4, "one two three"), (4, "three four"), (None, "two three four"), (5, " ".join(words)), (6, " ".join(words[100:])), (7, "never seen here")]
    docs = [(1, "x one two three four y"), (2, "one two x"), (3, " ".join(words[90:150]) + " z " + " ".join(words[380:])), (None, "one two three"), (8, None)]
    docs += [(9, " ".join(words[7:19])), (10, " ".join(words[7:20])), (11, " ".join(words) + " tail"), (12, "head " + " ".join(words[387:]))]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(ORACLES["op2_decontamination"].replace("using (doc_id)", "on pos.doc_id is not distinct from d.doc_id", 1).replace(
        "left join its using (doc_id)", "left join its on its.doc_id is not distinct from d.doc_id").replace("select doc_id, len(w)", "select d.doc_id, len(w)"))
    columns = [c[0] for c in want.description]
    df = QUERIES["op2_decontamination"](spark, str(tmp_path)).select(*columns)
    assert canonical([tuple(r) for r in df.collect()], columns) == canonical(want.fetchall(), columns)
