"""Removal of near copies: texts whose word shingles overlap by a threshold or more.

MinHash signatures are cut into bands; texts that agree in a band are candidates, and each
candidate pair is decided by the exact Jaccard similarity of its shingle sets. The bands follow
from the threshold so that a pair on it is missed once in a million.

No pair is made inside a group of copies beyond need. Texts of one normalised form count as one
beforehand. In each bucket the members first meet its least one alone; only those that are then in
another group than the bucket's meet the members of other groups. So a bucket of many copies costs a
pair per copy, and no link between different groups is lost.

Families of texts that are alike, but not enough, still make as many pairs as they have. Those move
a few bytes each: sizes and cells (see :func:`cells`) give a bound of the overlap, and only pairs that
may reach the threshold by it are decided by their sets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from finetide.errors import DataError
from finetide.functions.text import digest, normalize, text_or_none
from finetide.operators.components import groups
from finetide.operators.dedup import first_of
from finetide.operators.normalize import text_key
from finetide.session import estimated_bytes, written

SHINGLE_WORDS = 5
BANDS = 24
MISSED = 1e-6
LEAST_THRESHOLD = 0.5
_SEED = 20_240_229
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Shingles whose signatures are worked out at once.
_PART = 4096
#: Stored bytes of the ids that are sent to the texts; for more, the texts are shuffled to the ids.
SENT_BYTES = 4 * 1024 * 1024


def rows_per_band(threshold: float) -> int:
    """The most rows for which ``BANDS`` bands miss a pair on the threshold with ``MISSED`` at most."""
    if not LEAST_THRESHOLD <= threshold <= 1.0:
        raise DataError(f"the similarity must be between {LEAST_THRESHOLD} and 1", "dedup_threshold")
    share = 1.0 - MISSED ** (1.0 / BANDS)
    return 64 if threshold == 1.0 else min(64, math.floor(math.log(share) / math.log(threshold)))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingles(words: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """The different shingles of a sequence of word hashes; a shorter sequence is one shingle."""
    width = min(k, len(words))
    n = len(words) - width + 1
    total = np.full(n if len(words) else 0, width, np.uint64)
    for i in range(width):
        total = total * _STEP + words[i : i + n]
    return np.unique(_mixed(total))


def band_keys(found: np.ndarray, rows: int) -> np.ndarray:
    """A key per band: the hash of its rows' least permuted shingles."""
    random = np.random.Generator(np.random.PCG64(_SEED))
    factors = random.integers(0, 1 << 63, BANDS * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = random.integers(0, 1 << 63, BANDS * rows, dtype=np.uint64)
    least = np.full(BANDS * rows, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(found), _PART):
        permuted = found[i : i + _PART, None] * factors + shifts
        least = np.minimum(least, (permuted ^ (permuted >> np.uint64(32))).min(axis=0))
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, rows).T:
        keys = _mixed(keys * _STEP + column)
    return keys


def cells(found: np.ndarray) -> np.ndarray:
    """A bit for each cell that holds a shingle, as 64-bit words. There are 2 to 4 cells a shingle, 64 at
    least, a power of two; a shingle's is its lowest bits, so half the words laid over the other
    half are the cells of half that number."""
    count = max(64, 1 << (2 * len(found) - 1).bit_length())
    held = np.zeros(count, np.uint8)
    held[found & np.uint64(count - 1)] = 1
    return np.packbits(held, bitorder="little").view(np.uint64)


def _per_text(rows: DataFrame, made: dict[str, Callable[[np.ndarray], np.ndarray]]) -> DataFrame:
    """``rows`` with arrays of 64-bit numbers made of each text's shingles in place of ``words``, which
    holds the words as 64-bit hashes."""
    others = [f for f in rows.schema.fields if f.name != "words"]
    schema = StructType([*others, *[StructField(name, ArrayType(LongType())) for name in made]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words")
            off, values = words.offsets.to_numpy(), words.values.to_numpy(zero_copy_only=False).view(np.uint64)
            numbers = {name: [] for name in made}
            for start, end in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                found = shingles(values[start:end])
                for name, make in made.items():
                    numbers[name].append(make(found).view(np.int64))
            columns = [batch.column(f.name) for f in others] + [pa.array(n, pa.list_(pa.int64())) for n in numbers.values()]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def sketched(rows: DataFrame, threshold: float) -> DataFrame:
    """(id, ..., keys) from (id, ..., words)."""
    per_band = rows_per_band(threshold)
    return _per_text(rows, {"keys": lambda found: band_keys(found, per_band)})


def shingle_sets(rows: DataFrame) -> DataFrame:
    """(id, shingles, cells) from (id, words)."""
    return _per_text(rows, {"shingles": lambda found: found, "cells": cells})


def word_hashes(text: Column) -> Column:
    return F.transform(F.split(normalize(text), " "), lambda w: F.xxhash64(w))


def _folded(x: Column, y: Column) -> Column:
    """The cells ``x`` as many as those of ``y``, where they are twice as many."""
    n = F.size(y)
    halves = F.zip_with(F.slice(x, 1, n), F.slice(x, n + 1, n), lambda p, q: p.bitwiseOR(q))
    return F.when(F.size(x) > n, halves).otherwise(x)


def _only(x: Column, y: Column) -> Column:
    """How many cells ``x`` holds and ``y`` does not: each has a shingle that the other set lacks."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda total, n: total + n)


def _similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sets (id, shingles, cells, n) overlap enough."""
    ends = lambda end: sets.select(F.col("id").alias(end), F.col("n").alias(f"n_{end}"), F.col("cells").alias(f"cells_{end}"))
    # Sizes and cells rule most pairs out before a set is moved for them. With a threshold of a half or
    # more, sets that pass by their sizes have as many cells, or one twice those of the other.
    near = pairs.join(ends("a"), "a").join(ends("b"), "b").filter(F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b"))
    cells_a, cells_b = _folded(F.col("cells_a"), F.col("cells_b")), _folded(F.col("cells_b"), F.col("cells_a"))
    most = F.least(F.col("n_a") - _only(cells_a, cells_b), F.col("n_b") - _only(cells_b, cells_a))
    near = near.select("a", "b", (F.col("n_a") + F.col("n_b")).alias("n"), F.explode(F.array(most)).alias("most"))
    near = written(near.filter(F.col("most") / (F.col("n") - F.col("most")) >= threshold).drop("most"), "pairs")
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("one"))
    other = sets.select(F.col("id").alias("b"), F.col("shingles").alias("other"))
    both = near.join(one, "a").join(other, "b")
    # The overlap is bound once, as an exploded array keeps it from being repeated.
    both = both.select("a", "b", "n", F.explode(F.array(F.size(F.array_intersect("one", "other")))).alias("shared"))
    return both.filter(F.col("shared") / (F.col("n") - F.col("shared")) >= threshold).select("a", "b")


def near_copies(words: Callable[[DataFrame], DataFrame], sketches: DataFrame, threshold: float) -> DataFrame:
    """(node, root) for the rows of ``sketches`` (id, keys) that are linked to others; ``root`` is the
    least id of the group.

    ``words`` gives the rows (id, words) of a table of ids: shingle sets, larger than the texts, are
    made, stored and shuffled only for rows that share a bucket.
    """
    bands = sketches.select("id", F.posexplode("keys").alias("band", "key"))
    buckets = bands.groupBy("band", "key").agg(F.min("id").alias("least"), F.max("id").alias("last"))
    shared = written(buckets.filter("least < last").select("band", "key", "least"), "buckets")
    members = written(bands.join(shared, ["band", "key"]), "members")
    sharing = written(members.select("id").distinct(), "sharing")
    sets = written(shingle_sets(words(sharing)).withColumn("n", F.size("shingles")), "sets")
    stars = members.filter("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    links = written(_similar(stars, sets, threshold), "links")
    named = members.join(groups(links, "a", "b").withColumnRenamed("node", "id"), "id", "left")
    named = written(named.select("band", "key", "id", F.coalesce("root", "id").alias("root")), "named")
    split = named.groupBy("band", "key").agg(F.min("root").alias("main"), F.max("root").alias("other_root"))
    split = split.filter("main < other_root").select("band", "key", "main")
    apart = named.join(split, ["band", "key"]).filter("root <> main").select("band", "key", F.col("id").alias("b"), F.col("root").alias("root_b"))
    met = named.withColumnsRenamed({"id": "a", "root": "root_a"}).join(apart, ["band", "key"]).filter("root_a <> root_b")
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    more = _similar(pairs, sets, threshold)
    return groups(links.union(more), "a", "b")


def near_first_rows(df: DataFrame, order_col: str, threshold: float, key: str | None = None) -> DataFrame:
    """The order values of the rows to keep: the lowest of each group of near copies.

    Two texts are near copies if their sets of five neighbouring words, taken from the normalised
    texts, have a Jaccard similarity of ``threshold`` or more; a shorter text is one shingle. Groups
    are what links connect. A null cell reads ``None``; blank texts are copies of each other. Order
    values must be unique and not null, as for exact copies.
    """
    text = text_or_none(F.col(key or text_key(df)))
    read = df.select(F.col(order_col).alias("id"), digest(text).alias("_digest"), word_hashes(text).alias("words"))
    # Digests and band keys, a tenth of the texts, are made where the texts lie.
    every = written(sketched(read, threshold), "every-sketch")
    first = written(first_of(every.select(F.col("id").alias(order_col), "_digest"), order_col), "first-rows")
    ids = first.withColumnRenamed(order_col, "id")
    sketches = written(every.select("id", "keys").join(ids, "id", "left_semi"), "sketches")

    def words(ids: DataFrame) -> DataFrame:
        named = ids.withColumnRenamed("id", order_col)
        sent = F.broadcast(named) if estimated_bytes(ids) <= SENT_BYTES else named
        rows = df.join(sent, order_col, "left_semi")
        return rows.select(F.col(order_col).alias("id"), word_hashes(text).alias("words"))

    later = near_copies(words, sketches, threshold).filter("node <> root").select(F.col("node").alias(order_col))
    return first.join(later, order_col, "left_anti")
