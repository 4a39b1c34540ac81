"""A Merkle tree over a dataset whose changes are versions that share every untouched node.

Each row is a leaf. A source's leaves, in ascending id order, are hashed in runs of ``FAN``, and so
are the nodes above them until one is left, the source's subroot; the subroots are hashed alike to
the root. A changed leaf makes a version: only its ancestors are copied, everything else is the
original's.

Nothing is hashed in one task but aligned blocks of ``FAN ** BLOCK_LEVELS`` neighbouring nodes, a
Spark group each. The way up gives one node per block and repeats until a tree has one node, so
there are a few rounds however long the table. The way down hands each block the siblings on the
path from it to the root: versions are copied inside their block and go on up those siblings in the
same task, block by block, all over the cluster. A hot source is many blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finetide.llm.store import Stored
from finetide.operators.positions import with_position

FAN = 16
#: Levels of the tree that a block holds.
BLOCK_LEVELS = 2
BLOCK = FAN**BLOCK_LEVELS
# Fixed value: the columns that make a leaf, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TREE_OF_SOURCES = -1


def _h(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def cell(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(cells: Sequence[Column]) -> Column:
    """The digest of a row as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[cell(c) for c in cells]), 256))


def levels(nodes: list[str], n: int) -> Iterator[tuple[list[str], bool]]:
    """Each level of a block from ``nodes`` up, and whether it is the block's top; the whole tree
    has ``n`` nodes on the lowest one. A tree of one node needs no more hashing."""
    for climbed in range(BLOCK_LEVELS + 1):
        top = n <= 1 or climbed == BLOCK_LEVELS
        yield nodes, top
        if top:
            return
        nodes, n = [_h(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)], -(-n // FAN)


def _in_order(block: pa.Table) -> tuple[pa.Table, list[str], int]:
    block = block.sort_by("at")
    return block, [d.hex() for d in block["digest"].to_pylist()], block["n"][0].as_py()


def _block_top(block: pa.Table) -> pa.Table:
    block, nodes, n = _in_order(block)
    *_, ((top,), _) = levels(nodes, n)
    above = n
    for _ in range(BLOCK_LEVELS):
        above = -(-above // FAN)
    place = block["at"][0].as_py() // BLOCK
    columns = [[block["tree"][0].as_py()], [place], [above], [bytes.fromhex(top)]]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["tree", "at", "n", "digest"])


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("at") / BLOCK))


def _up(nodes: DataFrame) -> list[Stored]:
    """``nodes`` and the block tops above them, until every tree has one node."""
    longest = nodes.agg(F.max("n")).first()[0] or 0
    found: list[Stored] = []
    while longest > 1:
        tops = _blocks(nodes).groupBy("tree", "block").applyInArrow(_block_top, "tree bigint, at bigint, n bigint, digest binary")
        found.append(Stored(tops, "merkle-level"))
        nodes, longest = found[-1].df, -(-longest // BLOCK)
    return found


def _siblings(nodes: list[str], n: int, place: int) -> Iterator[tuple[int, list[str]]]:
    """Per level of a block: where in its run a node's ancestor stands, and the run's others."""
    for level, top in levels(nodes, n):
        if top:
            return
        start = place // FAN * FAN
        run = level[start : start + FAN]
        yield place - start, run[: place - start] + run[place - start + 1 :]
        place //= FAN


def packed(path: Sequence[tuple[int, list[str]]]) -> bytes:
    """A path as bytes: per level the place, the number of siblings, and their digests."""
    return b"".join(bytes([place, len(others)]) + bytes.fromhex("".join(others)) for place, others in path)


def unpacked(raw: bytes) -> list[tuple[int, list[str]]]:
    path, i = [], 0
    while i < len(raw):
        end = i + 2 + 32 * raw[i + 1]
        digests = raw[i + 2 : end].hex()
        path.append((raw[i], [digests[j : j + 64] for j in range(0, len(digests), 64)]))
        i = end
    return path


def _node_paths(block: pa.Table, above: pa.Table) -> pa.Table:
    """(tree, at, path, subroot) of a block's nodes, from the path of the node above the block."""
    block, nodes, n = _in_order(block)
    rest, subroots = above["path"][0].as_py(), [above["subroot"][0].as_py()] * len(nodes)
    paths = [packed(list(_siblings(nodes, n, i))) + rest for i in range(len(nodes))]
    names, places = block["tree"], block["at"]
    if "name" in block.column_names:  # the subroots themselves: each is the one node of a source's tree
        names, places, subroots = block["name"], pa.array([0] * len(nodes), pa.int64()), block["digest"].to_pylist()
    return pa.table([names, places, pa.array(paths, pa.binary()), pa.array(subroots, pa.binary())], names=["tree", "at", "path", "subroot"])


def _down(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    kind = "tree bigint, at bigint, path binary, subroot binary"
    above = paths.withColumnRenamed("at", "block").groupBy("tree", "block")
    return _blocks(nodes).groupBy("tree", "block").cogroup(above).applyInArrow(_node_paths, kind)


def folded(digest: str, path: Sequence[tuple[int, list[str]]]) -> list[str]:
    """The nodes of the version that ``digest`` makes: itself and its ancestors up to the root."""
    copied = [digest]
    for place, others in path:
        copied.append(_h([*others[:place], copied[-1], *others[place:]]))
    return copied


def _versions(block: pa.Table, above: pa.Table) -> pa.Table:
    """A block's leaves with their proofs and versions; the siblings above the block are the block's."""
    block, nodes, n = _in_order(block)
    upper, subroot = unpacked(above["path"][0].as_py()), above["subroot"][0].as_py().hex()
    upper_text = "".join("".join(others) for _, others in upper).encode()
    proofs, roots, versions = [], [], []
    for i, (own, new) in enumerate(zip(nodes, block["changed"].to_pylist(), strict=True)):
        path = list(_siblings(nodes, n, i))
        proof = hashlib.sha256("".join("".join(others) for _, others in path).encode())
        proof.update(upper_text)
        proofs.append(proof.hexdigest())
        copied = folded(new.hex() if new is not None else own, [*path, *upper])
        roots.append(copied[-1])
        versions.append(copied if new is not None else None)
    columns = [block["id"], pa.array(nodes), pa.array([subroot] * len(nodes)), pa.array(proofs, pa.string()), pa.array(roots, pa.string()), pa.array(versions, pa.list_(pa.string()))]
    return pa.table(columns, names=["id", "leaf", "subroot", "proof", "folded_root", "version"])


def _placed(docs: DataFrame, id_col: str, source_col: str, digests: dict[str, Column]) -> DataFrame:
    """(tree, at, n, id, digests) per row: a source's tree is named by the place of its first row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), *[c.alias(k) for k, c in digests.items()])
    rows = with_position(Stored(rows, "leaves").df, ["source", "id", "digest"], "place")
    sources = rows.groupBy(F.col("source").alias("own")).agg(F.min("place").alias("tree"), F.count("*").alias("n"))
    joined = rows.join(sources, F.col("source").eqNullSafe(F.col("own")))  # both from the stored order
    return joined.select("tree", (F.col("place") - F.col("tree")).alias("at"), "n", "id", "source", *digests)


def proofs(
    docs: DataFrame, changes: dict[str, Column] | None = None, where: Column | None = None,
    id_col: str = "doc_id", source_col: str = "source", columns: Sequence[str] = LEAF_COLUMNS,
) -> DataFrame:
    """(id, leaf, subroot, root, proof, folded_root, version) per row of ``docs``.

    ``changes`` gives new values of some columns for the rows ``where`` holds. ``leaf``, ``subroot``
    and ``root`` are the original's. ``proof`` hashes the siblings from the leaf to the root.
    ``folded_root`` is recomputed from the changed leaf, or the own one, and those siblings.
    ``version`` has the copied nodes of a changed row from its leaf to its root, and is null else.

    Null cells are hashed as ``-``; a null id comes first in its source, a null source is the first
    source; rows that repeat an id are leaves of their own, ordered by digest. Columns that are not
    among ``columns`` play no part, whatever their names. An empty table gives an empty one.
    """
    changes = changes or {}
    new = leaf([changes.get(c, F.col(c)) for c in columns])
    digests = {"digest": leaf([F.col(c) for c in columns]), "changed": F.when(F.coalesce(where if where is not None else F.lit(False), F.lit(False)), new)}
    leaves = _placed(docs, id_col, source_col, digests)
    up = _up(leaves.select("tree", "at", "n", "digest"))
    tops = up[-1].df if up else leaves
    ranked = with_position(tops.select(F.col("tree").alias("name"), "digest"), "name", "at")
    kind = f"id {leaves.schema['id'].dataType.simpleString()}, leaf string, subroot string, proof string, folded_root string, version array<string>"
    out = [F.col("id").alias(id_col), "leaf", "subroot", "root", "proof", "folded_root", "version"]
    n_sources = ranked.count()
    if not n_sources:
        return docs.sparkSession.createDataFrame([], f"{kind}, root string").select(*out)
    subroots = Stored(ranked.select(F.lit(TREE_OF_SOURCES).cast("bigint").alias("tree"), "at", F.lit(n_sources).cast("bigint").alias("n"), "digest", "name"), "subroots")
    above = _up(subroots.df.drop("name"))
    root = (above[-1] if above else subroots).df.select(F.lower(F.hex("digest"))).first()
    paths = docs.sparkSession.createDataFrame([(TREE_OF_SOURCES, 0, b"", None)], "tree bigint, at bigint, path binary, subroot binary")
    for level in [*above[:-1][::-1], subroots]:
        paths = Stored(_down(level.df, paths), "paths").df
    for level in up[:-1][::-1]:
        paths = Stored(_down(level.df, paths), "paths").df
    groups = _blocks(leaves.drop("source")).groupBy("tree", "block").cogroup(paths.withColumnRenamed("at", "block").groupBy("tree", "block"))
    return groups.applyInArrow(_versions, kind).withColumn("root", F.lit(root[0])).select(*out)


def manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", columns: Sequence[str] = LEAF_COLUMNS) -> DataFrame:
    """(source, n_rows, subroot) per source, null first: what a copy of the dataset is compared with.

    The proofs of :func:`proofs` end in these subroots. Edge cases are as there.
    """
    leaves = _placed(docs, id_col, source_col, {"digest": leaf([F.col(c) for c in columns])})
    up = _up(leaves.select("tree", "at", "n", "digest"))
    tops = (up[-1].df if up else leaves).select("tree", F.lower(F.hex("digest")).alias("subroot"))
    names = leaves.filter("at = 0").select("tree", "source", F.col("n").alias("n_rows"))
    return names.join(tops, "tree").select("source", "n_rows", "subroot")
