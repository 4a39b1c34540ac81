"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors of cosine c lie at squared distance 2 - 2c. After one rotation, the same for all,
they are split into ``blocks`` equal blocks of few dimensions. Two vectors within the threshold
are, in one block at least, within that block's share of the squared distance. Each block is a
range join: its first coordinate gives slabs no narrower than the block's radius, a vector is at
home in one slab and a guest in the one below if it is within the radius of its edge, and
neighbours in coordinate order are compared over the block's dimensions. Block candidates are
verified by their exact cosine. A pair counts in the first block that finds it and nowhere else.

A slab of many vectors is cut into parts of bounded size, and every two parts meet in a task of
their own. A task gives each vector's number of links and a star of links per group, never the pairs, so a
dense group costs as many rows as it has members. Equal vectors are joined once, by their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finetide.llm.components import components
from finetide.llm.simhash import stars
from finetide.llm.store import Stored

THRESHOLD = 0.93
BLOCKS = 8
#: Width of a slab, in a coordinate's range of -1 to 1; never below the radius.
SLAB = 0.25
#: A slab with more rows is compared part by part, each part with each.
PART_ROWS = 20_000
SLACK = 1e-9
CHUNK = 512


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    """A fixed orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, scaled first so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def block_edges(dims: int, blocks: int) -> list[tuple[int, int]]:
    blocks = max(1, min(blocks, dims))
    cuts = [dims * k // blocks for k in range(blocks + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def linked(x: np.ndarray, home: np.ndarray, part: np.ndarray, block: int, blocks: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows of unit vectors ``x`` within the threshold that this block is the first to find.

    At least one of a pair is at home; two guests meet in their own slab. Where rows of two parts
    are given, pairs inside one part are left to that part's own task.
    """
    dims = x.shape[1]
    edges = block_edges(dims, blocks)
    budget = (2 - 2 * threshold) / len(edges) + SLACK
    turned = x @ rotation(dims)
    lo, hi = edges[block]
    order = np.argsort(turned[:, lo], kind="stable")
    own = turned[order, lo:hi]
    squares = (own * own).sum(axis=1)
    ends = np.searchsorted(own[:, 0], own[:, 0] + np.sqrt(budget) + SLACK, side="right")
    lefts, rights = [], []
    across = len(np.unique(part)) > 1
    for a in range(0, len(own), CHUNK):
        b = min(len(own), a + CHUNK)
        for c in range(a, int(ends[b - 1]), 8 * CHUNK):
            d = min(int(ends[b - 1]), c + 8 * CHUNK)
            near = squares[a:b, None] + squares[None, c:d] - 2 * own[a:b] @ own[c:d].T <= budget + 1e-6
            i, j = np.nonzero(near)
            i, j = i + a, j + c
            keep = i < j
            i, j = order[i[keep]], order[j[keep]]
            keep = home[i] | home[j]
            if across:
                keep &= part[i] != part[j]
            i, j = i[keep], j[keep]
            for s in range(0, len(i), 1 << 15):
                p, q = i[s : s + (1 << 15)], j[s : s + (1 << 15)]
                good = np.einsum("ij,ij->i", x[p], x[q]) >= threshold
                p, q = p[good], q[good]
                if not len(p):
                    continue
                gap = (turned[p] - turned[q]) ** 2
                found = np.stack([gap[:, u:v].sum(axis=1) <= budget for u, v in edges], axis=1)
                first = found.argmax(axis=1) == block
                lefts.append(p[first])
                rights.append(q[first])
    none = np.zeros(0, np.int64)
    return (np.concatenate(lefts), np.concatenate(rights)) if lefts else (none, none)


def _named(embeddings: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, v, label, usable): whether a row can link at all."""
    kind = embeddings.schema[vector_col].dataType.simpleString()
    wanted = kind if kind in ("array<float>", "array<double>") else "array<double>"
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(vector_col).cast(wanted).alias("v"), F.col(label_col).cast("string").alias("label"))
    finite = ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = finite & F.exists("v", lambda c: c != 0) & F.col("label").isNotNull() & F.col("id").isNotNull()
    return rows.withColumn("usable", F.coalesce(usable, F.lit(False)))


def links(rows: DataFrame, threshold: float, blocks: int) -> tuple[DataFrame, DataFrame]:
    """Classes (label, v, node, n) of equal vectors, and (a, b, n_links): counts where a = b, links elsewhere."""
    grouped = rows.groupBy("label", "v").agg(F.min("id").alias("low"), F.count("*").alias("n"))
    classes = Stored(grouped.withColumn("node", F.monotonically_increasing_id()), "classes").df  # numbered once, when written
    spread = classes.select("label", "node", "n", "v")
    kind = rows.schema["v"].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(3)
            sizes = np.diff(vectors.offsets.to_numpy())
            values = vectors.values.to_numpy(zero_copy_only=False)[int(vectors.offsets[0].as_py()) :] if len(vectors) else np.zeros(0)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            for dims in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dims)
                x = unit(np.stack([values[starts[k] : starts[k + 1]] for k in own]).astype(np.float64))
                turned = x @ rotation(dims)
                edges = block_edges(dims, blocks)
                radius = np.sqrt((2 - 2 * threshold) / len(edges) + SLACK) + SLACK
                width = max(SLAB, radius)
                picks, block_of, slab_of, home_of = [], [], [], []
                for b, (lo, _) in enumerate(edges):
                    slab = np.floor(turned[:, lo] / width).astype(np.int64)
                    guest = np.flatnonzero(turned[:, lo] - slab * width <= radius + SLACK)
                    picks += [np.arange(len(own)), guest]
                    block_of += [np.full(len(own), b), np.full(len(guest), b)]
                    slab_of += [slab, slab[guest] - 1]
                    home_of += [np.ones(len(own), bool), np.zeros(len(guest), bool)]
                pick = np.concatenate(picks)
                at = pa.array(own[pick])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at), pa.array(np.full(len(pick), dims, np.int32)), pa.array(np.concatenate(block_of).astype(np.int32)),
                        pa.array(np.concatenate(slab_of).astype(np.int32)), pa.array(np.concatenate(home_of)), batch.column(1).take(at), batch.column(2).take(at), vectors.take(at),
                    ],
                    names=["label", "dims", "block", "slab", "home", "node", "n", "v"],
                )

    cell = ["label", "dims", "block", "slab"]
    dealt = spread.mapInArrow(deal, f"label string, dims int, block int, slab int, home boolean, node bigint, n bigint, v {kind}")
    large = dealt.groupBy(*cell).agg(F.count("*").alias("rows")).filter(F.col("rows") > PART_ROWS)
    large = Stored(large.select(*cell, F.ceil(F.col("rows") / PART_ROWS).cast("int").alias("parts")), "large-slabs").df
    dealt = dealt.join(large, cell, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.withColumn("one", F.least("part", "other")).withColumn("two", F.greatest("part", "other"))

    def join(key: tuple, table: pa.Table) -> pa.Table:
        x = unit(table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1).astype(np.float64))
        i, j = linked(x, table.column("home").to_numpy().astype(bool), table.column("part").to_numpy(), key[2].as_py(), blocks, threshold)
        nodes, n = table.column("node").to_numpy(), table.column("n").to_numpy()
        count = np.bincount(i, weights=n[j], minlength=len(n)) + np.bincount(j, weights=n[i], minlength=len(n))
        own, root = stars(i, j, len(n)) if len(i) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        counted = np.flatnonzero(count)
        a = np.concatenate([nodes[counted], nodes[own]])
        b = np.concatenate([nodes[counted], nodes[root]])
        counts = np.concatenate([count[counted], np.zeros(len(own))]).astype(np.int64)
        return pa.Table.from_arrays([pa.array(a), pa.array(b), pa.array(counts)], names=["a", "b", "n_links"])

    dealt = dealt.select(*cell, "one", "two", "part", "home", "node", "n", "v")
    found = dealt.groupBy(*cell, "one", "two").applyInArrow(join, "a bigint, b bigint, n_links bigint")
    return classes, Stored(found, "vector-links").df


def near_duplicates(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = THRESHOLD, blocks: int = BLOCKS,
) -> DataFrame:
    """(id, n_links, component) per row of ``embeddings``.

    Vectors link within a label at a cosine of ``threshold`` or more. Vectors that are null, empty,
    zero or hold null or non-finite numbers, those of a null label and those of another length
    link with nothing; their component is their own id. A null id links with nothing. Rows that
    repeat an id count each. An empty table gives an empty one.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    named = _named(embeddings, id_col, vector_col, label_col)
    rows = named.filter("usable").select("id", "v", "label")
    classes, found = links(rows, threshold, blocks)
    counts = found.filter("n_links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n_links").alias("others"))
    roots = components(found.filter("a <> b").select("a", "b"), "a", "b")
    placed = classes.join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = placed.groupBy("root").agg(F.min("low").alias("component"))
    placed = placed.join(lowest, "root").select("label", "v", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component")
    placed = rows.join(placed, ["label", "v"]).select("id", "n_links", "component")
    alone = named.filter("not usable").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component"))
    return placed.union(alone).select(F.col("id").alias(id_col), "n_links", "component")
