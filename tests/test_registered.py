"""Every registered query against its SQL in DuckDB."""

import pytest
from conftest import DATA

from registry.oracles import ORACLES
from registry.queries import QUERIES


def cell(value):
    return bytes(value).hex() if isinstance(value, (bytes, bytearray)) else value


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr(cell(row[i])) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(result.fetchall(), columns)


@pytest.mark.parametrize("name", ["dedup_prompt", "preprocess_dpo", "preprocess_pairs", "preprocess_short_rows"])
def test_operators_have_something_to_drop(spark, name):
    from registry import fixtures as fx

    source = {"preprocess_pairs": fx.copied_pair, "preprocess_short_rows": fx.short_rows}.get(name, fx.copied_preference)
    before, after = source(spark, DATA).count(), QUERIES[name](spark, DATA).count()
    assert 0 < after < before
