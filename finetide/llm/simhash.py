"""Near duplicates by SimHash: pivot distance tables over pigeonhole buckets.

Fingerprints within ``RADIUS`` bits of each other link. A candidate search by the distances to
full-width reference fingerprints alone keeps about 46 % of unrelated pairs per reference, too
many for any grid of cells. So the tables come in two steps:

* Distances over block-wide references give the buckets. With six blocks a pair within three
  bits has at least three blocks in which it differs from every reference alike, that is, in
  which it is equal. Each fingerprint goes to the 20 buckets of its block triples.
* Inside a bucket the distances to ``REFERENCES`` full-width references are tabled, pairs are
  dropped when any coordinate differs by more than ``RADIUS``, and the survivors are verified.

Both steps lose no pair: a distance to a reference changes by at most the distance of the pair.
A bucket gives a star per group of linked members and not its pairs, so a large group of near
copies costs as many rows as it has members. Copies with equal fingerprints are one member.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finetide.llm.components import components
from finetide.llm.store import Stored
from finetide.llm.textcodes import lowered, mixed, text_parts

RADIUS = 3
SHINGLE = 3
SEED = 42
REFERENCES = 16
PAIRS_HELD = 1 << 21
#: Buckets of more fingerprints are split in parts, and each two parts meet in a task of their own.
BUCKET_ROWS = 20_000
#: Widths of six blocks that make up 64 bits.
BLOCKS = (11, 11, 11, 11, 10, 10)


def shingle_hashes(text: bytes) -> np.ndarray:
    """XXH64 of each run of three words, or of the whole word sequence when it is shorter."""
    words = text.split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    width = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(width + 1) - 1
    starts = ends - width
    k = min(SHINGLE, len(words))
    places = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in places), dtype=np.uint64, count=len(words) - k + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Each bit is the majority of the hashes' bits; a tie and no hash at all read 0."""
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long) per row of ``docs``; a null or blank text has fingerprint 0."""
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            for i, _, data, off in text_parts(batch.column(1)):
                low = lowered(data).tobytes()
                for k in range(len(off) - 1):
                    out[i + k] = fingerprint(shingle_hashes(low[off[k] : off[k + 1]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["id", "fp"])

    return kept.mapInArrow(run, f"id {kept.schema['id'].dataType.simpleString()}, fp bigint")


def bucket_keys(fp) -> list:
    """The 20 bucket keys of a fingerprint: number of the block triple, then the triple's bits."""
    shifts = [sum(BLOCKS[:i]) for i in range(len(BLOCKS))]
    parts = [F.shiftrightunsigned(fp, s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in zip(shifts, BLOCKS, strict=True)]
    keys = []
    for number, (a, b, c) in enumerate(combinations(range(len(BLOCKS)), 3)):
        key = F.lit(number) * (1 << 33) + parts[a] * (1 << 22) + parts[b] * (1 << 11) + parts[c]
        keys.append(key)
    return keys


def stars(left: np.ndarray, right: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The links (member, smallest member of its group) that hold the same groups as the given pairs."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        while True:
            jump = label[label]
            if np.array_equal(jump, label):
                break
            label = jump
        if np.array_equal(label[left], label[right]):
            break
    own = np.flatnonzero(label != np.arange(size))
    return own, label[own]


def linked_members(keys: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Stars over the fingerprints that lie within ``radius`` of each other in the same bucket."""
    refs = mixed(np.arange(1, REFERENCES + 1, dtype=np.uint64))
    table = np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)
    order = np.lexsort((table[:, 0], keys))
    keys, fps, table = keys[order], fps[order], table[order]
    n = len(keys)
    lefts, rights, held, step = [], [], 0, 1
    at = np.arange(n)
    while len(at):
        at = at[at + step < n]
        other = at + step
        near = (keys[at] == keys[other]) & (table[other, 0] - table[at, 0] <= radius)
        at = at[near]
        i, j = at, at + step
        for c in range(1, REFERENCES):
            if not len(i):
                break
            keep = np.abs(table[i, c] - table[j, c]) <= radius
            i, j = i[keep], j[keep]
        if len(i):
            keep = np.bitwise_count(fps[i] ^ fps[j]) <= radius
            lefts.append(i[keep])
            rights.append(j[keep])
            held += int(keep.sum())
            if held > PAIRS_HELD:
                own, root = stars(np.concatenate(lefts), np.concatenate(rights), n)
                lefts, rights, held = [own], [root], len(own)
        step += 1
    if not lefts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    own, root = stars(np.concatenate(lefts), np.concatenate(rights), n)
    return fps[own], fps[root]


def _split(keyed: DataFrame, large: DataFrame) -> DataFrame:
    """``keyed`` with a key for each two parts of the ``large`` buckets; two that hash alike are compared in vain."""
    dealt = keyed.join(large, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).filter("parts = 1 or other <> part")
    pair = F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other"))
    return dealt.select(F.when(F.col("parts") == 1, F.col("key")).otherwise(pair).alias("key"), "fp")


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) links over distinct fingerprints ``fp`` that join all fingerprints within the radius.

    Buckets pass through a task in key order; only the members of one bucket, or of two parts of a
    large one, are held together, 16 bytes each, and their links are folded to stars when they are many.
    """
    keyed = fps.select(F.explode(F.array(*bucket_keys(F.col("fp")))).alias("key"), "fp")
    large = keyed.groupBy("key").agg(F.count("*").alias("rows")).filter(F.col("rows") > BUCKET_ROWS)
    large = Stored(large.select("key", F.ceil(F.col("rows") / BUCKET_ROWS).cast("int").alias("parts")), "large-buckets").df
    if large.take(1):
        keyed = _split(keyed, large)
    keyed = keyed.repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = [], []

        def flush(k: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
            a, b = linked_members(k, v, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column(0).to_numpy(zero_copy_only=False)
            v = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            cut = int(np.searchsorted(k, k[-1]))  # the last bucket may go on in the next batch
            if cut or (keys and keys[-1][-1] != k[0]):
                yield flush(np.concatenate([*keys, k[:cut]]), np.concatenate([*values, v[:cut]]))
                keys, values = [], []
            keys.append(k[cut:])
            values.append(v[cut:])
        if keys:
            yield flush(np.concatenate(keys), np.concatenate(values))

    return keyed.mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """(id, fp long, component) per row: component is the smallest id reachable by links.

    Null and empty texts have fingerprint 0 and link like others. Repeated ids each get a row. A
    null id gets its group's smallest id, null if it has none. An empty table gives an empty one.
    ``radius`` may be 0 to 3, the distance up to which the buckets lose no pair.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"radius must be 0 to {RADIUS}")
    rows = Stored(fingerprints(docs, id_col, text_col), "fingerprints").df
    members = Stored(rows.groupBy("fp").agg(F.min("id").alias("low")), "members").df
    groups = Stored(components(links(members.select("fp"), radius), "a", "b"), "groups").df
    rooted = members.join(groups.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component"))
    named = rooted.join(lowest, "root").select("fp", "component")
    return rows.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component")


def fingerprint_text(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is its group's smallest; columns stay as they are.

    Rows of a null id stay. Rows that repeat an id are one document: they stay if one of them does.
    """
    found = near_duplicates(docs, id_col, text_col).filter(F.col(id_col).isNotNull())
    first = found.groupBy(id_col).agg(F.max(F.col(id_col) == F.col("component")).alias("first"))
    later = Stored(first.filter(~F.coalesce("first", F.lit(False))).select(id_col), "later-copies").df
    return docs.join(later, id_col, "left_anti").select(*docs.columns)
