"""Merkle manifest of a dataset: ternary hash trees per source under one root, stored as aligned blocks in van Emde Boas order.

A document is a leaf, a source a tree, and the sources' roots the leaves of one more tree. A tree is cut into
aligned blocks of HEIGHT levels; the roots of its blocks are the leaves of the next tier, until one block is left.
A block is one row: its nodes are a single value, subtrees of half the height stored together, again and again, so
that a way up touches few cache lines whatever their size. Building and reading siblings use the same addresses.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import cut, ranked

#: Nodes that become one.
ARITY = 3

#: Levels between a block's leaves and its root: a block has 729 leaves and 1093 nodes of 32 bytes at most.
HEIGHT = 6

_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left: int, siblings: binary>>"


def _field(value: Column) -> Column:
    """`-` for null, else the byte count, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(text: Column | None = None) -> Column:
    """A document's digest of 32 bytes; ``text`` takes the place of its text, if given."""
    values = [F.col(c) if c != "text" or text is None else text for c in _COLUMNS]
    return F.unhex(F.sha2(F.concat(*[_field(v) for v in values]), 256))


def _combined(*parts: bytes) -> bytes:
    """The digest of digests, taken over their lowercase hex."""
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


def address(depth: int, index: int, levels: int) -> int:
    """Where the ``index``-th node at ``depth`` stands in a tree of so many levels.

    The upper half of the levels comes first, then the subtrees below it from left to right, each in the same order.
    """
    at = 0
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below = ARITY ** (depth - top)
        at += (ARITY**top - 1) // (ARITY - 1) + index // below * ((ARITY ** (levels - top) - 1) // (ARITY - 1))
        depth, index, levels = depth - top, index % below, levels - top
    return at


@lru_cache(64)
def addresses(depth: int, levels: int) -> tuple[int, ...]:
    """The addresses of all nodes at a depth, from left to right."""
    return tuple(address(depth, i, levels) for i in range(ARITY**depth))


def levels_of(leaves: int) -> int:
    """Levels of a whole tree of so many leaves; a lone leaf is its own root."""
    levels = 1
    while ARITY ** (levels - 1) < leaves:
        levels += 1
    return levels


class Block:
    """An aligned part of a tree, in van Emde Boas order; its last runs may be short."""

    def __init__(self, nodes: bytes | bytearray, leaves: int, levels: int):
        self.nodes, self.leaves, self.levels = nodes, leaves, levels

    @classmethod
    def build(cls, leaves: list[bytes], levels: int) -> Block:
        block = cls(bytearray(32 * ((ARITY**levels - 1) // (ARITY - 1))), len(leaves), levels)
        for at, leaf in zip(addresses(levels - 1, levels), leaves):
            block.nodes[32 * at : 32 * at + 32] = leaf
        for depth in range(levels - 2, -1, -1):
            for index, at in enumerate(addresses(depth, levels)[: block.count(depth)]):
                block.nodes[32 * at : 32 * at + 32] = _combined(*block.run(depth + 1, index * ARITY))
        return block

    def count(self, depth: int) -> int:
        """Nodes that are there at a depth."""
        return -(-self.leaves // ARITY ** (self.levels - 1 - depth))

    def node(self, depth: int, index: int) -> bytes:
        at = 32 * addresses(depth, self.levels)[index]
        return bytes(self.nodes[at : at + 32])

    def run(self, depth: int, index: int) -> list[bytes]:
        """The nodes that become one with this one, itself included."""
        first = index - index % ARITY
        return [self.node(depth, i) for i in range(first, min(first + ARITY, self.count(depth)))]

    def path(self, leaf: int) -> list[tuple[int, bytes]]:
        """For each level from a leaf up: how many siblings stand left of the way, and all siblings."""
        out, index = [], leaf
        for depth in range(self.levels - 1, 0, -1):
            left, run = index % ARITY, self.run(depth, index)
            out.append((left, b"".join(run[:left] + run[left + 1 :])))
            index //= ARITY
        return out


def fold(node: bytes, path: Iterable[tuple[int, bytes]]) -> bytes:
    """The root that a node and its siblings give."""
    for left, siblings in path:
        node = _combined(siblings[: 32 * left], node, siblings[32 * left :])
    return node


def _blocks(members: DataFrame, tag: str) -> DataFrame:
    """(scope, pos, n, node, carried) to stored blocks: scope, block, n, levels, nodes, root, and the members' carried values in order."""
    carried = members.schema["carried"].dataType

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        n = table["n"][0].as_py()
        levels = levels_of(n) if n <= ARITY**HEIGHT else HEIGHT + 1
        block = Block.build(table["node"].to_pylist(), levels)
        values = table["carried"].combine_chunks()
        if isinstance(values, pa.ChunkedArray):
            values = values.chunk(0)
        return pa.table(
            {
                "scope": [table["scope"][0].as_py()], "block": [table["block"][0].as_py()], "n": [n], "leaves": [block.leaves],
                "levels": pa.array([levels], pa.int32()), "nodes": [bytes(block.nodes)], "root": [block.node(0, 0)],
                "members": pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values),
            }
        )

    cols = members.select("scope", F.floor(F.col("pos") / ARITY**HEIGHT).cast("long").alias("block"), "pos", "n", "node", "carried")
    schema = f"scope string, block long, n long, leaves long, levels int, nodes binary, root binary, members array<{carried.simpleString()}>"
    return cut(cols.groupBy("scope", "block").applyInArrow(build, schema), tag)


def _tiers(members: DataFrame, largest: int, tag: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of all trees, tier by tier, and each tree's root (scope, root)."""
    tiers, roots = [], None
    while True:
        blocks = _blocks(members, tag)
        tiers.append(blocks)
        done = blocks.filter(F.col("n") <= ARITY**HEIGHT).select("scope", "root")
        roots = done if roots is None else roots.unionByName(done)
        if largest <= ARITY**HEIGHT:
            return tiers, roots
        largest = -(-largest // ARITY**HEIGHT)
        members = blocks.filter(F.col("n") > ARITY**HEIGHT).select(
            "scope", F.col("block").alias("pos"), F.ceil(F.col("n") / ARITY**HEIGHT).alias("n"), F.col("root").alias("node"), F.col("block").alias("carried")
        )


def _way_up(batch: pa.RecordBatch) -> Iterator[tuple[dict, Block, list[tuple[int, bytes]]]]:
    """Each stored block of a batch, and the path from its root on."""
    for row in batch.to_pylist():
        yield row, Block(row["nodes"], row["leaves"], row["levels"]), [(p["left"], p["siblings"]) for p in row["above"] or []]


def _paths_down(tiers: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """The lowest tier's blocks with ``above``: the siblings from a block's root up to the root of all.

    ``above`` (scope, above) has the siblings of the trees' roots, from the tree of trees.
    """

    def members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("left", pa.int32()), ("siblings", pa.binary())]))
        for batch in batches:
            out = [(row["scope"], m, [{"left": a, "siblings": s} for a, s in block.path(i) + up]) for row, block, up in _way_up(batch) for i, m in enumerate(row["members"])]
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], kind)], ["scope", "block", "above"])

    ways = None  # of the blocks of the tier below: scope, block, above
    for k in range(len(tiers) - 1, -1, -1):
        tier = tiers[k]
        last = tier.filter(F.col("n") <= ARITY**HEIGHT)
        known = last.join(above, "scope", "left") if above is not None else last.withColumn("above", F.lit(None).cast(_PATH))
        if ways is not None:
            known = known.unionByName(tier.filter(F.col("n") > ARITY**HEIGHT).join(ways, ["scope", "block"]))
        if k:
            ways = cut(known.mapInArrow(members, f"scope string, block long, above {_PATH}"), "merkle-ways")
    return known


@dataclass
class Manifest:
    """The stored trees: ``sources`` with a tier of blocks after the other, and the tree of the sources' roots above them."""

    sources: list[DataFrame]
    tops: list[DataFrame]
    subroots: DataFrame
    root: bytes | None


def build(docs: DataFrame, shown: Column | None = None) -> Manifest:
    """The manifest of ``docs`` (doc_id, source, lang, n_chars, text; other columns play no part).

    ``shown`` is a digest to be checked later in place of a document's own (its own by default). Within a source
    leaves ascend by doc_id (null first), rows of one doc_id by digest; a null source is the first one. Equal rows
    are leaves of their own. An empty table has no root.
    """
    leaf = leaf_digest()
    rows = docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("scope"),  # null sorts first and stays apart from empty
        F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("node"), (leaf if shown is None else F.coalesce(shown, leaf)).alias("shown"),
    )
    rows = cut(rows, "merkle-digests")  # texts are read and hashed once; what follows moves digests
    rows = ranked(rows, ["scope"], [F.col("doc_id").asc_nulls_first(), F.col("node")], "merkle-leaves")
    members = rows.select("scope", "pos", "n", "node", F.struct("doc_id", F.when(F.col("shown") != F.col("node"), F.col("shown")).alias("shown")).alias("carried"))
    largest = rows.agg(F.max("n")).first()[0]
    if largest is None:
        return Manifest([], [], rows.select("scope", F.col("node").alias("root")), None)
    tiers, roots = _tiers(members, largest, "merkle-blocks")
    subroots = cut(roots, "merkle-subroots")
    named = ranked(subroots.select(F.lit("").alias("scope"), F.col("scope").alias("name"), F.col("root").alias("node")), ["scope"], [F.col("name")], "merkle-sources")
    tops, root = _tiers(named.select("scope", "pos", "n", "node", F.col("name").alias("carried")), named.agg(F.max("n")).first()[0], "merkle-tops")
    return Manifest(tiers, tops, subroots, bytes(root.first()["root"]))


def audit(manifest: Manifest) -> DataFrame:
    """For each leaf its proof, and whether the digest that was shown gives the root again by it.

    Returns doc_id, leaf, subroot, root, proof_sha256 (over the siblings' hex, from the leaf up), folded_root and verified.
    """
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if manifest.root is None:
        return manifest.subroots.sparkSession.createDataFrame([], schema)
    root = manifest.root

    def tops(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("left", pa.int32()), ("siblings", pa.binary())]))
        for batch in batches:
            out = [(m, [{"left": a, "siblings": s} for a, s in block.path(i) + up]) for row, block, up in _way_up(batch) for i, m in enumerate(row["members"])]
            columns = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], kind)], ["scope", "above"])

    def leaves(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 16):
                out = []
                for row, block, up in _way_up(batch.slice(lo, 16)):
                    above = b"".join(s for _, s in up).hex().encode()
                    for i, m in enumerate(row["members"]):
                        path = block.path(i)
                        proof = hashlib.sha256(b"".join(s for _, s in path).hex().encode() + above).hexdigest()
                        leaf = block.node(block.levels - 1, i)
                        folded = fold(m["shown"] or leaf, path + up)
                        out.append((m["doc_id"], leaf.hex(), row["subroot"].hex(), root.hex(), proof, folded.hex(), folded == root))
                kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
                names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    ways = cut(_paths_down(manifest.tops, None).mapInArrow(tops, f"scope string, above {_PATH}"), "merkle-ways")
    known = _paths_down(manifest.sources, ways)
    known = known.join(manifest.subroots.select("scope", F.col("root").alias("subroot")), "scope")
    return known.select("nodes", "leaves", "levels", "members", "above", "subroot").mapInArrow(leaves, schema)


def audit_tampered(docs: DataFrame) -> DataFrame:
    """The audit of all documents, where those whose decimal doc_id has an even CRC-32 lost the line ends of their text.

    A null doc_id is never tampered with, a null text stays null.
    """
    even = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, leaf_digest(F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    return audit(build(docs, tampered))
