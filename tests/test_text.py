import random
import re

import pytest
from pyspark.sql import functions as F

from finetide.functions import text as tx
from finetide.functions.keys import canonical_json, config_key

SPACES = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isspace()]
EDGE_TEXTS = (
    ["", " ", "   \t\n", "a", "ab cd", "one two three", "same same same same", "A  b 　c ", "ΟΔΟΣ", "İstanbul"]
    + ["x" * n for n in (9, 10, 4096, 4097)]
    + [f"{ch}left{ch}{ch}mid {ch} right{ch}" for ch in SPACES]
    + ["\U0001f600 \U0001f600\U0001f601 end", "tab\tnew\nline\r\n  both", "​zero width﻿"]
)


def python_normalize(text):
    return re.sub(r"\s+", " ", text.lower().strip())


def python_quality(text):
    words = text.split()
    if not words:
        return 0.0
    return 0.2 if len(words) < 3 else min(1.0, 0.5 + len(set(words)) / len(words) * 0.5)


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(list(enumerate(EDGE_TEXTS)), "id int, t string")
    c = F.col("t")
    exprs = [
        tx.strip(c).alias("strip"),
        tx.is_blank(c).alias("blank"),
        tx.squeeze(c).alias("squeeze"),
        tx.normalize(c).alias("norm"),
        tx.words(c).alias("words"),
        tx.quality(c).alias("quality"),
    ]
    return df.select("id", "t", *exprs).collect()


def test_whitespace_is_exactly_pythons():
    assert sorted(tx.WHITESPACE) == sorted(SPACES) and len(SPACES) == 29


def test_expressions_agree_with_python(rows):
    assert len(rows) == len(EDGE_TEXTS)
    for row in rows:
        text = row["t"]
        assert row["strip"] == text.strip()
        assert row["blank"] == (not text.strip())
        assert row["squeeze"] == " ".join(text.split())
        assert row["norm"] == python_normalize(text)
        assert row["words"] == text.split()
        assert row["quality"] == python_quality(text)


def test_random_texts(spark):
    rng = random.Random(11)
    alphabet = SPACES * 3 + list("aAbBzZ09.,!") + list("éÉßäÄøØñçŁłΑαΩωЖжשمあ漢") + ["\U0001f600", "\U00010400", "\u200b", "\x00"]
    values = ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, t string")
    c = F.col("t")
    exprs = [tx.strip(c), tx.normalize(c), tx.words(c), tx.quality(c)]
    for row in df.select("id", *exprs).collect():
        text = values[row[0]]
        assert tuple(row[1:]) == (text.strip(), python_normalize(text), text.split(), python_quality(text))


def test_null_reads_none(spark):
    df = spark.createDataFrame([(None,), ("x",)], "t string")
    assert [r[0] for r in df.select(tx.text_or_none(F.col("t"))).collect()] == ["None", "x"]


def test_canonical_json_orders_keys_at_every_level(spark):
    pairs = [
        ('{"b": 1, "a": {"d": [1, {"z": null, "y": true}], "c": "q"}}', '{"a":{"c":"q","d":[1,{"y":true,"z":null}]},"b":1}'),
        ('{"n": 0.90}', '{"n":0.9}'),
    ]
    df = spark.createDataFrame(pairs, "given string, want string")
    for row in df.select(canonical_json(F.col("given")).alias("got"), "want").collect():
        assert row["got"] == row["want"]
    same = df.select(config_key(F.col("given")).alias("a"), config_key(F.col("want")).alias("b")).collect()
    assert all(r["a"] == r["b"] and len(r["a"]) == 16 for r in same)


def test_numbered_values(spark):
    from finetide.functions.maps import numbered_values, upload_parts

    df = spark.sql("select map('10', 'c', '2', 'b', 'chunk_size', 'x', '01', 'a', '1a', 'y') as m, 25 as n")
    assert df.select(numbered_values(F.col("m"))).collect()[0][0] == ["a", "b", "c"]
    assert df.select(upload_parts(F.col("m"), F.col("n"), 10)).collect()[0][0] == ["a", "b", "c"]
    with pytest.raises(Exception, match="expected 5"):
        df.select(upload_parts(F.col("m"), F.col("n"), 5)).collect()
