"""Token files: ids equal to the tokenizer's, places under any file layout, skipped row groups."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from finetide.llm import token_store
from finetide.llm.queries import tokenizer_path
from finetide.session import scratch_path

LARGER = "/root/testdata/sf0.01"


def encoded(path, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [[*e.ids, 2] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def by_encoder(encoder, texts):
    out = []
    for sizes, ids in encoder.encode(pa.array(texts), 2):
        out += [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]
    return out


def test_ids_of_random_texts():
    draw = random.Random(3)
    pieces = ["a", "word", "It's", "don't,", "x!!", "12.5", "é", "漢字", "\U0001f600", "<|endoftext|>", "...", "a|", "#", "’s", "“q”", "\xa0", "　"]
    blanks = [" "] * 12 + ["\n"] * 3 + ["  ", "\n\n", " \n", "\t", "\r\n", ""]
    texts = ["", " ", "\n", "a", " "]
    texts += ["".join(draw.choice(pieces) + draw.choice(blanks) for _ in range(draw.randrange(1, 40))).strip(" \n" if draw.random() < 0.9 else "") for _ in range(3000)]
    encoder = token_store.Encoder(tokenizer_path(), remembered=50)
    assert encoder.by_unit
    assert by_encoder(encoder, texts) == encoded(tokenizer_path(), texts)


def test_a_tokenizer_that_cuts_elsewhere_is_used_whole():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["Two words", "a b  c\n\nd", "", "x" * 200 + " y", "é ü"] * 2
    encoder = token_store.Encoder(path)
    assert by_encoder(encoder, texts) == encoded(path, texts)


@pytest.mark.parametrize("change", [{}, {"add_prefix_space": True}, {"use_regex": False}, {"type": "Whitespace"}])
def test_pre_tokenizers_are_told_apart(change):
    import json

    class Fake:
        def to_str(self):
            return json.dumps({"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True} | change, "added_tokens": []})

    assert token_store.cuts_at_blanks(Fake()) == (not change)


def places(spark, path, rows):
    """Rows in the files' order with their starts, checked against the sizes."""
    got = sorted(token_store.token_digests(spark, path).collect(), key=lambda r: r["start"])
    assert len(got) == rows and got[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:], strict=False))
    return got


@pytest.mark.parametrize("records", [0, 3])
def test_starts_under_any_file_size(spark, many_files, records):
    docs = spark.range(40).select((F.col("id") * 7 % 40).alias("doc_id"), F.repeat(F.lit("word "), F.col("id").cast("int")).alias("text"))
    path = scratch_path(spark, "tokens")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", records)
    try:
        token_store.write_tokens(docs, path, tokenizer_path())
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    got = places(spark, path, 40)
    assert [r["doc_id"] for r in got] == list(range(40))


def test_more_than_a_hundred_thousand_files(spark, many_files, tmp_path):
    """Part numbers count as numbers: part-100000 comes after part-99999."""
    path = str(tmp_path / "tokens")
    token_store.write_tokens(spark.range(40).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text")), path, tokenizer_path())
    parts = sorted(f for f in os.listdir(path) if f.endswith(".orc"))
    assert len(parts) > 1
    for number, name in enumerate(parts, 100_001 - len(parts)):
        new = name.replace(name.split("-")[1], f"{number:05d}", 1)
        os.rename(f"{path}/{name}", f"{path}/{new}")
        os.rename(f"{path}/.{name}.crc", f"{path}/.{new}.crc")
    assert [r["doc_id"] for r in places(spark, path, 40)] == list(range(40))


def test_null_ids_in_a_third_of_all_rows(spark, many_files):
    ids = F.when(F.col("id") % 3 > 0, F.col("id"))
    docs = spark.range(3000).select(ids.alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 500).cast("string")).alias("text"))
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(docs, path, tokenizer_path())
    got = places(spark, path, 3000)
    named = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert all(r["doc_id"] is None for r in got[:1000]) and named == sorted(named)
    files = token_store.read_tokens(spark, path).filter("doc_id is null").select(F.input_file_name()).distinct().count()
    assert files > 1  # the hot id is not one task's


def test_row_groups_are_skipped_and_files_hold_what_is_said(spark, tmp_path):
    path = str(tmp_path / "tokens")
    docs = spark.range(9000).select((F.col("id") * 2).alias("doc_id"), F.lit("a few words of a text").alias("text"))
    token_store.write_tokens(docs, path, tokenizer_path())

    def read(wanted):
        found = token_store.read_tokens(spark, path).filter(wanted)
        rows = found.collect()
        leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        return len(rows), leaf.metrics().apply("numOutputRows").value()

    rows, seen = read("doc_id = 9000")
    assert rows == 1 and seen <= 1000
    assert read("doc_id = 9001")[1] == 0  # between two ids that are there: only the Bloom filter can tell
    jvm = spark._jvm
    file = next(f for f in os.listdir(path) if f.endswith(".orc"))
    options = jvm.org.apache.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration())
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(f"{path}/{file}"), options)
    footer = reader.rows().readStripeFooter(reader.getStripes().get(0))
    kinds = {footer.getStreams(i).getKind().toString() for i in range(footer.getStreamsCount())}
    assert {"ROW_INDEX", "BLOOM_FILTER_UTF8"} <= kinds
    assert {footer.getColumns(i).getKind().toString() for i in range(1, footer.getColumnsCount())} == {"DIRECT_V2"}


def test_every_document_of_the_query(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").orderBy("doc_id").collect()
    encoder = token_store.Encoder(tokenizer_path())
    texts = [r["text"] or "" for r in docs]
    assert by_encoder(encoder, texts) == encoded(tokenizer_path(), texts)


def test_memory_compares_words_of_one_hash():
    words = [b"one", b"two", b"four", b"six"]
    data = np.frombuffer(b"".join(words), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    keys = np.array([7, 7, 7, 9], np.uint64)
    memory = token_store.Memory(10)
    for k in (0, 3):
        memory.add(keys[k : k + 1], data, off[k : k + 1], off[k + 1 : k + 2], np.array([2]), np.array([k, 100 + k], "<u4"))
    found = {int(w): ids[2 * i : 2 * i + 2].tolist() for at, _, ids in memory.find(keys, data, off) for i, w in enumerate(at)}
    assert found == {0: [0, 100], 3: [3, 103]}
    full = token_store.Memory(1)
    for k in (0, 3):
        full.add(keys[k : k + 1], data, off[k : k + 1], off[k + 1 : k + 2], np.array([1]), np.array([k], "<u4"))
    assert len(full) == 1
