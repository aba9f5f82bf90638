"""Merkle manifest of a dataset: one tree per language, one above them, and proofs for many rows at once.

A row's leaf is the SHA-256 of its fields. The leaves of a language stand in the order of ``doc_id``; every
``FAN`` neighbours become their parent until one node, the subroot, is left. The subroots, in the order of the
language, are the leaves of the crown, whose last node is the root.

Leaves are numbered by a range sort: their place inside a range plus the sizes of earlier ranges. Nodes are made
``BLOCK`` leaves at a time, several levels per pass, so the number of passes is the logarithm of the largest tree to the base
``BLOCK``. Proofs are octopus multiproofs: a block of leaves works out which nodes above and beside it can't be
derived from its own leaves, each of these coordinates is fetched once for the whole block, interiors are derived
once and shared, and each leaf's own path is expanded from them in the block.

Nulls are written ``-`` in a leaf and differ from empty values; a null language is a tree of its own, the first. Rows
without an id stand before all others. Rows with one id stand in the order of their leaves; which of two equal rows is
first changes nothing. A language with one row has the row's leaf as its subroot, and with one language the root is
the subroot. An empty table gives no rows. Other columns than the five fields are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.session import written

FAN = 8
#: Levels that one task climbs, and the leaves it holds for that.
CLIMB = 4
BLOCK = FAN**CLIMB
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree over the subroots; a language's tree is named ``=`` and the language, that of null is empty.
CROWN = "*"


def leaf_digest(**replaced: Column) -> Column:
    """SHA-256 (lowercase hex) of a row's fields; ``replaced`` gives other values for some of them."""

    def field(name: str) -> Column:
        value = replaced.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[field(f) for f in FIELDS]), 256)


def node_digest(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def place_leaves(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (``tree, digest, ...``) with their place ``pos`` in their tree and its number of leaves ``width``."""
    keys = ["tree", *order, "digest", "__tie"]
    ranged = (
        rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    )
    # Numbered after the sort: the partition in the upper bits, the row's place in it in the lower 33.
    stored = written(ranged.drop("__tie").withColumn("seq", F.monotonically_increasing_id()), "leaves")
    stored = stored.withColumn("part", F.shiftright("seq", 33))
    ahead = W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        stored.groupBy("tree", "part").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("held"))
        .select(
            "tree", "part", (F.coalesce(F.sum("held").over(ahead), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("held").over(W.partitionBy("tree")).alias("width"),
        )
    )
    placed = stored.join(starts, ["tree", "part"]).withColumn("pos", F.col("seq") + F.col("shift"))
    return written(placed.drop("seq", "part", "shift"), "placed")


def _climb(base: int):
    def task(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        at, digests, width = int(rows["idx"].iat[0]), rows["digest"].tolist(), int(rows["width"].iat[0])
        out = []
        for level in range(base + 1, base + CLIMB + 1):
            if width == 1:
                break
            digests = [node_digest(digests[k : k + FAN]) for k in range(0, len(digests), FAN)]
            at, width = at // FAN, -(-width // FAN)
            out += [(key[0], level, at + k, d, width) for k, d in enumerate(digests)]
        return pd.DataFrame(out, columns=["tree", "level", "idx", "digest", "width"])

    return task


def interior_nodes(placed: DataFrame) -> DataFrame:
    """``tree, level, idx, digest, width`` of all nodes above the leaves; ``width`` is that of their level."""
    schema = "tree string, level int, idx long, digest string, width long"
    current = placed.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), "digest", "width")
    widest, base = current.agg(F.max("width")).first()[0] or 0, 0
    nodes = written(current.where("false").to(placed.sparkSession.createDataFrame([], schema).schema), "nodes")
    while widest > 1:
        groups = current.where("width > 1").groupBy("tree", F.expr(f"idx div {BLOCK}").alias("block"))
        made = written(groups.applyInPandas(_climb(base), schema), "nodes")
        nodes, base, widest = nodes.unionByName(made), base + CLIMB, -(-widest // BLOCK)
        current = made.where(F.col("level") == base)
    return nodes


@dataclass
class Tree:
    """Placed leaves (``tree, pos, width, digest, ...``) and the nodes above them."""

    placed: DataFrame
    nodes: DataFrame

    def tops(self) -> DataFrame:
        """``tree, digest`` of the last node of each tree."""
        lone = self.placed.where("width = 1").select("tree", "digest")
        return self.nodes.where("width = 1").select("tree", "digest").unionByName(lone)

    def all_nodes(self) -> DataFrame:
        leaves = self.placed.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), "digest")
        return self.nodes.select("tree", "level", "idx", "digest").unionByName(leaves)


@dataclass
class Manifest:
    leaves: Tree
    crown: Tree

    def root(self) -> str | None:
        """The digest of the whole dataset; none for an empty table."""
        found = self.crown.tops().first()
        return found["digest"] if found else None


def _tree(rows: DataFrame, order: list[str]) -> Tree:
    placed = place_leaves(rows, order)
    return Tree(placed, interior_nodes(placed))


def build_manifest(docs: DataFrame, found: Column | None = None) -> Manifest:
    """The trees of ``docs``; ``found`` is the leaf digest of each row as it is met later (by default as it is)."""
    leaf = leaf_digest()
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf.alias("digest"), (leaf if found is None else found).alias("found"),
    )
    leaves = _tree(rows, ["doc_id"])
    subroots = leaves.tops().select(F.lit(CROWN).alias("tree"), "digest", F.col("tree").alias("of"))
    return Manifest(leaves, _tree(subroots, ["of"]))


def missing_nodes(positions: np.ndarray, width: int) -> Iterator[tuple[int, int]]:
    """``level, idx`` of the fewest nodes that, with the leaves at ``positions``, give every node above these."""
    level, own = 0, np.unique(positions)
    while width > 1:
        parents = np.unique(own // FAN)
        children = (parents[:, None] * FAN + np.arange(FAN)).ravel()
        for idx in np.setdiff1d(children[children < width], own, assume_unique=True).tolist():
            yield level, idx
        own, width, level = parents, -(-width // FAN), level + 1


def _wanted(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    lacking = list(missing_nodes(rows["pos"].to_numpy(), int(rows["width"].iat[0])))
    return pd.DataFrame([(*key, level, idx) for level, idx in lacking], columns=["tree", "block", "level", "idx"])


def _levels(leaves: dict[int, str], fetched: dict[tuple[int, int], str], width: int) -> list[tuple[dict[int, str], int]]:
    """Nodes known and width, level by level up to the last node."""
    levels, own = [], leaves
    while True:
        known = own | {idx: d for (level, idx), d in fetched.items() if level == len(levels)}
        levels.append((known, width))
        if width == 1:
            return levels
        own = {
            p: node_digest([known[c] for c in range(p * FAN, min(p * FAN + FAN, width))]) for p in {c // FAN for c in own}
        }
        width = -(-width // FAN)


Path = tuple[tuple[str, str], ...]


def _path(levels: list[tuple[dict[int, str], int]], level: int, idx: int, cache: dict) -> Path:
    """Left and right siblings of a node and of those above it; the last node of the tree has none."""
    if level == len(levels) - 1:
        return ()
    if (level, idx) not in cache:
        known, width = levels[level]
        first = idx - idx % FAN
        left = "".join(known[c] for c in range(first, idx))
        right = "".join(known[c] for c in range(idx + 1, min(first + FAN, width)))
        cache[level, idx] = ((left, right), *_path(levels, level + 1, idx // FAN, cache))
    return cache[level, idx]


def _fold(digest: str, path: Path) -> str:
    for left, right in path:
        digest = hashlib.sha256(f"{left}{digest}{right}".encode()).hexdigest()
    return digest


def _expand(paths: bool):
    """One block: its leaves, and the nodes fetched for it (of its tree, and of the crown)."""

    def task(key: tuple, leaves: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
        mine = {k: {} for k in (0, 1)}
        for kind, level, idx, digest in fetched[["kind", "level", "idx", "digest"]].itertuples(index=False):
            if kind < 2:
                mine[kind][level, idx] = digest
        at = fetched[fetched["kind"] == 2].iloc[0]
        positions, width = leaves["pos"].tolist(), int(leaves["width"].iat[0])
        tree = _levels(dict(zip(positions, leaves["digest"])), mine[0], width)
        (subroot,) = tree[-1][0].values()
        crown = _levels({int(at["idx"]): subroot}, mine[1], int(at["level"]))
        (root,) = crown[-1][0].values()
        over, cache, out = _path(crown, 0, int(at["idx"]), {}), {}, []
        over_text = "".join(left + right for left, right in over)
        texts: dict[int, str] = {}
        for doc_id, pos, leaf, found in zip(leaves["id_text"], positions, leaves["digest"], leaves["found"]):
            path = _path(tree, 0, pos, cache)
            cache.pop((0, pos), None)
            if pos // FAN not in texts:
                texts[pos // FAN] = "".join(left + right for left, right in path[1:]) + over_text
            beside = "".join(path[0]) if path else ""
            proof = hashlib.sha256((beside + texts[pos // FAN]).encode()).hexdigest()
            folded = _fold(found, (*path, *over))
            row = (doc_id, leaf, subroot, root, proof, folded, folded == root)
            out.append((*row, [{"before": a, "after": b} for a, b in (*path, *over)]) if paths else row)
        names = ["id_text", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", *["path"] * paths]
        return pd.DataFrame(out, columns=names)

    return task


def prove(manifest: Manifest, leaves: DataFrame | None = None, paths: bool = False) -> DataFrame:
    """Proofs for all leaves, or for some rows of ``manifest.leaves.placed``.

    ``doc_id, leaf, subroot, root, proof_sha256`` (digest of all siblings on the way up), ``folded_root`` (the root as it
    comes out for the row as found) and ``verified``. With ``paths`` also ``path``, the siblings before and after each
    node on the way, which ``fold_path`` checks against a root without any table.
    """
    block = F.expr(f"pos div {BLOCK}").alias("block")
    rows = manifest.leaves.placed if leaves is None else leaves
    blocks = rows.select("tree", block, "pos", "width").groupBy("tree", "block")
    wanted = written(blocks.applyInPandas(_wanted, "tree string, block long, level int, idx long"), "wanted")
    beside = wanted.join(manifest.leaves.all_nodes(), ["tree", "level", "idx"]).select(
        "tree", "block", F.lit(0).alias("kind"), "level", "idx", "digest"
    )
    # The crown is asked once per tree; its answer goes to all blocks of the tree.
    subroots = manifest.crown.placed.select(F.col("of").alias("tree"), "pos", "width", "digest")
    asked = subroots.select("tree", F.lit(0).cast("long").alias("block"), "pos", "width").groupBy("tree", "block")
    asked = asked.applyInPandas(_wanted, "tree string, block long, level int, idx long")
    over = asked.join(manifest.crown.all_nodes().drop("tree"), ["level", "idx"]).select(
        "tree", F.lit(1).alias("kind"), "level", "idx", "digest"
    )
    place = subroots.select(
        "tree", F.lit(2).alias("kind"), F.col("width").cast("int").alias("level"), F.col("pos").alias("idx"), "digest"
    )
    crown = rows.select("tree", block).distinct().join(over.unionByName(place), "tree")
    fetched = written(beside.unionByName(crown.select(*beside.columns)), "fetched")
    schema = "id_text string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if paths:
        schema += ", path array<struct<before: string, after: string>>"
    # As text, since pandas has no null among whole numbers.
    id_text = F.col("doc_id").cast("string").alias("id_text")
    held = rows.select("tree", block, id_text, "pos", "width", "digest", "found").groupBy("tree", "block")
    proven = held.cogroup(fetched.groupBy("tree", "block")).applyInPandas(_expand(paths), schema)
    return proven.select(F.col("id_text").cast("long").alias("doc_id"), *proven.columns[1:])


def fold_path(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its ``path`` lead to."""
    return F.aggregate(path, leaf, lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]), 256))


def tampered_leaf() -> Column:
    """The leaf of a row whose text has lost its capital letters A-Z, where 3 divides crc32 of the id; else its leaf."""
    marked = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return leaf_digest(text=F.when(marked, F.translate("text", capitals, capitals.lower())).otherwise(F.col("text")))
