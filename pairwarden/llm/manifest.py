"""Merkle manifest of a table, as a persistent tree with path copying.

Every row is a leaf: the digest of its fields. Per language the leaves are ordered by id, and
every two consecutive nodes become their digest until one, the subroot, is left; a last node
on its own is digested alone. Subroots, ordered by language (null first, by bytes), are joined
in the same way to the root.

Trees are cut into aligned blocks of ``2 ** BLOCK_LEVELS`` nodes; a block is one group, and
the roots of a tree's blocks are the nodes of the next, smaller table, until one is left. Then
siblings go down the same tables: a node's path is its siblings inside its block, followed by
the path of the block's root. A path has at most a digest a level, and each path row meets the
nodes of one block only, so neither a large language nor the last levels gather anything.

A tampered row is a new version of the tree. Inside the block the nodes are a store that is
only ever added to (``Store``): the version is a new root that shares every untouched node and
adds copies of the changed leaf's ancestors. Above the block the version goes on by itself
along the block's path, one new node a level, without gathering the versions anywhere.

Null fields are ``-``, empty texts ``0:``. Rows without an id come first; rows of equal id are
ordered by leaf, exact copies are leaves of their own. An empty table has no rows.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairwarden.session import stage

BLOCK_LEVELS = 10
_BLOCK = 1 << BLOCK_LEVELS
_LOCAL_BITS = 33  # monotonically_increasing_id: partition above, row below
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


class Store:
    """Nodes of a block's binary tree. Nodes are never changed, so versions share them.

    ``levels`` is the number of levels above the leaves; a node without a right sibling is
    digested alone.
    """

    def __init__(self, leaves: list[str], levels: int):
        self.hash, self.left, self.right = list(leaves), [-1] * len(leaves), [-1] * len(leaves)
        self.levels = levels
        row = list(range(len(leaves)))
        for _ in range(levels):
            row = [self._add(row[i], row[i + 1] if i + 1 < len(row) else -1) for i in range(0, len(row), 2)]
        (self.root,) = row

    def _add(self, left: int, right: int) -> int:
        self.left.append(left)
        self.right.append(right)
        self.hash.append(digest(self.hash[left] + (self.hash[right] if right >= 0 else "")))
        return len(self.hash) - 1

    def path(self, place: int, root: int | None = None) -> list[tuple[str, str]]:
        """(side, digest) of the siblings of a leaf, from the bottom; side N: no sibling."""
        node, out = self.root if root is None else root, []
        for level in range(self.levels - 1, -1, -1):
            goes_right = place >> level & 1
            other = self.left[node] if goes_right else self.right[node]
            out.append(("L" if goes_right else "R", self.hash[other]) if other >= 0 else ("N", ""))
            node = self.right[node] if goes_right else self.left[node]
        return out[::-1]

    def set(self, place: int, leaf: str, root: int | None = None) -> int:
        """Root of a version in which one leaf is another: only its ancestors are copied."""
        node, passed = self.root if root is None else root, []
        for level in range(self.levels - 1, -1, -1):
            goes_right = place >> level & 1
            passed.append((node, goes_right))
            node = self.right[node] if goes_right else self.left[node]
        self.hash.append(leaf)
        self.left.append(-1)
        self.right.append(-1)
        copy = len(self.hash) - 1
        for node, goes_right in reversed(passed):
            copy = self._add(self.left[node], copy) if goes_right else self._add(copy, self.right[node])
        return copy

    def copies(self, root: int, place: int) -> list[str]:
        """Digests of a version's own nodes, from the leaf up."""
        out, node = [self.hash[root]], root
        for level in range(self.levels - 1, -1, -1):
            node = self.right[node] if place >> level & 1 else self.left[node]
            out.append(self.hash[node])
        return out[::-1]


def spell(path: list[tuple[str, str]]) -> str:
    """A path as text: a letter for the side, then the digest."""
    return "".join(side + other for side, other in path)


def read_path(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(text):
        size = 0 if text[at] == "N" else 64
        out.append((text[at], text[at + 1 : at + 1 + size]))
        at += 1 + size
    return out


def fold(node: str, path: list[tuple[str, str]]) -> list[str]:
    """New nodes above a node along its path, the root last."""
    out = []
    for side, other in path:
        node = digest(other + node if side == "L" else node + other)
        out.append(node)
    return out


def _levels(size: int) -> int:
    """Levels inside a block of a tree with ``size`` nodes: all of them in a tree of one block."""
    return min(BLOCK_LEVELS, (size - 1).bit_length())


def _sorted_block(part: pa.Table) -> pa.Table:
    return part.take(pa.array(np.argsort(part["idx"].to_numpy(), kind="stable")))


def _block_root(part: pa.Table) -> pa.Table:
    part = _sorted_block(part)
    size = part["size"][0].as_py()
    store = Store(part["hash"].to_pylist(), _levels(size))
    row = {
        "tree": part["tree"][0].as_py(), "idx": part["idx"][0].as_py() >> BLOCK_LEVELS,
        "hash": store.hash[store.root], "size": -(-size // _BLOCK),
    }
    return pa.Table.from_pylist([row])


_NODE = "tree string, idx long, hash string, size long"


def _block(idx: str = "idx") -> Column:
    return F.shiftright(idx, BLOCK_LEVELS).alias("block")


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """Tables of nodes from the leaves to one root per tree, each the roots of the blocks below."""
    tables, most = [nodes], nodes.agg(F.max("size")).first()[0] or 0
    while most > 1:
        below = tables[-1].select("tree", "idx", "hash", "size", _block())
        tables.append(stage(below.groupBy("tree", "block").applyInArrow(_block_root, _NODE), "block-roots"))
        most = -(-most // _BLOCK)
    return tables


def _block_paths(part: pa.Table, above: pa.Table) -> pa.Table:
    part = _sorted_block(part)
    store = Store(part["hash"].to_pylist(), _levels(part["size"][0].as_py()))
    rest, subroot = (above[c][0].as_py() for c in ("path", "subroot"))
    return pa.table({
        "tree": part["tree"], "idx": part["idx"],
        "path": [spell(store.path(i)) + rest for i in range(part.num_rows)],
        "subroot": pa.array([subroot] * part.num_rows, pa.string()),
    })


_PATH = "tree string, idx long, path string, subroot string"


def _descend(tables: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths of the nodes of the second table, given those of the last one's."""
    for nodes in reversed(tables[1:-1]):
        below = nodes.withColumn("block", F.shiftright("idx", BLOCK_LEVELS)).groupBy("tree", "block")
        above = paths.groupBy("tree", "idx")
        paths = stage(below.cogroup(above).applyInArrow(_block_paths, _PATH), "paths")
    return paths


def numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Adds idx, the row's place in its tree by ``order``, and size, the tree's number of rows.

    Rows are spread by range over (tree, order, row number), so that neither one tree nor
    equal rows end up in one task.
    """
    first = stage(leaves.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    keys = ["tree", *order, "_row"]
    placed = first.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row")
    placed = stage(placed.withColumn("_at", F.monotonically_increasing_id()), "ordered-leaves")
    part = F.shiftright("_at", _LOCAL_BITS).alias("_part")
    runs = placed.groupBy("tree", part).agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
    before = Window.partitionBy("tree").orderBy("_part")  # a row per task in a tree
    runs = runs.withColumn("_base", F.sum("_n").over(before) - F.col("_n")).withColumn(
        "size", F.sum("_n").over(Window.partitionBy("tree"))
    )
    return placed.withColumn("_part", part).join(runs, ["tree", "_part"]).withColumn(
        "idx", F.col("_at") - F.col("_from") + F.col("_base")
    ).drop("_at", "_part", "_from", "_n", "_base")


def _field(name: str, plus: int = 0) -> Column:
    value = (F.col(name) + plus if plus else F.col(name)).cast("string")
    size = F.octet_length(value).cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(size, F.lit(":"), value))


def _leaf(plus: int = 0) -> Column:
    """Digest of a row's fields; ``plus`` is added to n_chars."""
    return F.sha2(F.concat(*[_field(c, plus if c == "n_chars" else 0) for c in FIELDS]), 256)


def _fold_block(with_copies: bool):
    def fold_block(part: pa.Table, above: pa.Table) -> pa.Table:
        part = _sorted_block(part)
        leaves, size = part["hash"].to_pylist(), part["size"][0].as_py()
        store = Store(leaves, _levels(size))
        rest_text, subroot = (above[c][0].as_py() for c in ("path", "subroot"))
        rest = read_path(rest_text)
        proofs, folded, copies, paths = [], [], [], []
        for i, changed in enumerate(part["tampered"].to_pylist()):
            inside = store.path(i)
            path = inside + rest
            proofs.append(digest("".join(other for _, other in path)))
            if changed is None:
                own = fold(leaves[i], path)
                folded.append(own[-1] if own else leaves[i])
            else:
                version = store.set(i, changed)
                own = store.copies(version, i)
                own += fold(own[-1], rest)
                folded.append(own[-1])
            if with_copies:
                copies.append(own if changed is not None else [])
                paths.append(spell(path))
        columns = {
            "doc_id": part["doc_id"], "lang": part["lang"], "idx": part["idx"], "leaf": part["hash"],
            "subroot": pa.array([subroot] * len(leaves), pa.string()), "proof_sha256": proofs, "folded_root": folded,
        }
        if with_copies:
            columns |= {"path": paths, "copies": pa.array(copies, pa.list_(pa.string()))}
        return pa.table(columns)

    return fold_block


def merkle_manifest(docs: DataFrame, tampered: Column | None = None, with_copies: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, lang, n_chars, text): doc_id, lang, idx (place
    among the language's leaves), leaf, subroot, root, proof_sha256 (digest of the siblings up to
    the root), folded_root and verified.

    Where ``tampered`` holds, the version in which n_chars is one more is folded instead; its
    own nodes from the leaf up are ``copies``, and the siblings ``path``, with ``with_copies``.
    """
    spark = docs.sparkSession
    typed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"),
        F.col("text").cast("string").alias("text"),
        (F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))).alias("_tampered"),
    )
    leaves = typed.select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"),  # null first
        "lang", "doc_id", _leaf().alias("hash"), F.when(F.col("_tampered"), _leaf(1)).alias("tampered"),
    )
    leaves = stage(numbered(leaves, ["doc_id", "hash"]), "numbered-leaves")
    tables = _climb(leaves)
    tops = tables[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash")
    tops = stage(numbered(tops, ["name"]), "subroots")
    upper = _climb(tops)
    root = upper[-1].select("hash").first()
    whole = spark.createDataFrame([("", 0, "", "")] if root else [], _PATH)
    above = _descend([None, *upper], whole)  # paths of the subroots
    paths = tops.join(above.drop("subroot"), ["tree", "idx"]).select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("idx"), "path", F.col("hash").alias("subroot")
    )
    paths = _descend(tables, stage(paths, "subroot-paths"))
    shape = "doc_id long, lang string, idx long, leaf string, subroot string, proof_sha256 string, folded_root string"
    below = leaves.withColumn("block", F.shiftright("idx", BLOCK_LEVELS))
    out = below.groupBy("tree", "block").cogroup(paths.groupBy("tree", "idx")).applyInArrow(
        _fold_block(with_copies), shape + (", path string, copies array<string>" if with_copies else "")
    )
    known = F.lit(root.hash if root else None).cast("string")
    return out.withColumn("root", known).withColumn("verified", F.col("folded_root") == F.col("root"))
