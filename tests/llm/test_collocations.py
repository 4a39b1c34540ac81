"""Collocations against plain Python, with whole and with very short fingerprints."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from finetide.llm import collocations
from finetide.llm.bitfilter import fixed_filter, passes

SCHEMA = "doc_id long, text string, lang string, h string, g string, n string, mark string, key string, phrase string, a string, l string, rank string"


def plain(rows, most=3, least=10, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, most + 1):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    for lang, f in counts.items():
        scored = []
        candidates = [p for p, a in f.items() if len(p) >= 2 and a >= least]
        inside = Counter()
        for p in candidates:
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    inside[p[i : i + n]] = max(inside[p[i : i + n]], f[p])
        for p in candidates:
            a = f[p]
            score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            if 100 * inside[p] < 50 * a:
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            yield lang, rank, phrase.decode(), -a, left, right, totals[lang], -score


def texts():
    rows = []
    for i in range(400):
        lang = ("en", "de", None, "und")[i % 4]
        rows.append((i, f"The New\tYork  times; of new york times, and {i % 37} new-york city! word{i % 11} word{i % 7} word{i % 5}\r\nof the of the of the", lang))
    rows += [(None, "a b c. A B C", "xx") for _ in range(6)] + [(7, "é É ß", "xx") for _ in range(12)]
    rows += [(500, None, "en"), (501, "", None), (502, " \t.,;\n", "yy"), (503, "once", "zz")]
    rows.append((504, " ".join(f"w{i % 977} of" for i in range(60_000)), "long"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["clash"] * 9) for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize(("most", "bits", "top"), [(3, 64, 2000), (3, 9, 2000), (4, 64, 7), (2, 12, 2000)])
def test_odd_rows(spark, most, bits, top):
    rows = texts()
    found = collocations.collocations(frame(spark, rows), max_words=most, bits=bits, top=top)
    got = [tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert sorted(got) == sorted(plain([r[1:] for r in rows], most, top=top))
    assert {"en", "und", "xx", "long"} <= {r[0] for r in got}


def test_small_batches(spark, monkeypatch):
    """Tasks add up what they hold many times over; nothing is lost or counted twice."""
    rows = texts()[:200]
    monkeypatch.setattr(collocations, "HELD", 50)
    monkeypatch.setattr(collocations, "ROWS", 7)
    got = [tuple(r) for r in collocations.collocations(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(plain([r[1:] for r in rows]))


def test_scores_beyond_64_bits(spark):
    rows = [(3_000_000_000_000, 5_000_000_000_001, 7_000_000_000_003), (10, 10, 10), (99_999, 100_000, 100_000)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = [r[0] for r in df.select(collocations.floored(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [1_000_000 * a * a // (left * right) for a, left, right in rows]


def test_empty_table(spark):
    assert collocations.collocations(frame(spark, [])).collect() == []


def test_filter_has_a_bit_for_every_value(spark):
    import numpy as np

    values = [0, 1, 7, 8, -1, 1 << 40, -(1 << 62), 123_456_789_012]
    bits = fixed_filter(spark.createDataFrame([(v,) for v in values], "v long"), "v", 25)
    assert passes(bits, np.array(values, np.int64)).all()
    assert not passes(bits, np.array([2, 9, 1 << 20], np.uint64)).any()
