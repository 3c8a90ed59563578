"""Merkle manifest of a dataset: a tree of hashes per language below one root, its append log, and proofs.

Nodes are hex SHA-256 digests. A parent is the hash of its two children's text, or of one at the ragged end of a level. The
log of a tree holds its nodes in postorder, which is the order in which they are completed as leaves are appended: leaves
are cut into aligned blocks, and each builder writes the nodes of its block, which stand together in the log. Where a
node stands follows in closed form from the sizes of the subtrees before it, so that a proof finds siblings by their
positions. Block tops are the leaves of the next tier, which is built the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtide.llm.ranks import ranked
from labtide.llm.staging import staged

BITS = 9
ROOT = "root"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_OF = 7

SEGMENT = "tree string, block bigint, n bigint, items array<{item}>, nodes array<string>, top string"
PROOF = "tree string, rank bigint, item {item}, leaf string, sides string, proof string, subroot string, root string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A field's part of a leaf: ``-`` for null, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return (n - 1).bit_length()


def subtree(leaves: int, level: int) -> int:
    """Nodes of a subtree of this level with so many leaves, at most 2 ** level."""
    return sum(-(-leaves >> t) for t in range(level + 1))


def position(level: int, index: int, n: int) -> int:
    """Where the node stands in the log of a tree of ``n`` leaves, from 0.

    Before a leaf stand the nodes that are complete without it: 2 i - popcount(i) for leaf i. A node closes the subtree
    that begins at its first leaf.
    """
    first = index << level
    return 2 * first - first.bit_count() + subtree(min(n - first, 1 << level), level) - 1


def _segment(table: pa.Table, bits: int) -> pa.Table:
    """One aligned block, in a single row: its nodes in the order of the log, and its top node."""
    table = table.combine_chunks().sort_by("rank").combine_chunks()
    tree, n, level = table.column("tree")[0].as_py(), table.column("n")[0].as_py(), table.column("leaf").to_pylist()
    block = table.column("rank")[0].as_py() >> bits
    first = block << bits
    start = 2 * first - first.bit_count()
    nodes: dict[int, str] = {}
    for at in range(min(bits, height(n)) + 1):
        if at:
            level = [digest("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        for i, node in enumerate(level):
            nodes[position(at, (first >> at) + i, n) - start] = node
    log = [nodes[i] for i in range(len(nodes))]
    held = table.column("item").chunk(0) if table.column("item").num_chunks else pa.array([], table.schema.field("item").type)
    items = pa.ListArray.from_arrays(pa.array([0, table.num_rows], pa.int32()), held)
    arrays = [pa.array([tree]), pa.array([block]), pa.array([n]), items, pa.array([log], pa.list_(pa.string())), pa.array([level[0]])]
    return pa.Table.from_arrays(arrays, names=["tree", "block", "n", "items", "nodes", "top"])


def _tiers(leaves: DataFrame, bits: int) -> list[DataFrame]:
    """Log segments of every tier, lowest first, from rows (tree, rank, n, item, leaf). Each tier is written out."""
    tiers: list[DataFrame] = []
    while True:
        kind = SEGMENT.format(item=leaves.schema["item"].dataType.simpleString())
        rows = leaves.withColumn("block", F.shiftright("rank", bits))
        segments = staged(rows.groupBy("tree", "block").applyInArrow(lambda t: _segment(t, bits), kind), "log")
        tiers.append(segments)
        over = F.shiftright(F.col("n") + F.lit((1 << bits) - 1), bits)
        leaves = segments.where(over > 1).select(
            "tree", F.col("block").alias("rank"), over.alias("n"), F.lit(None).cast("boolean").alias("item"), F.col("top").alias("leaf")
        )
        if leaves.isEmpty():
            return tiers


def _tops(tiers: list[DataFrame], bits: int) -> DataFrame:
    """(tree, top) of every tree: the top of its only block, in the tier where it has one."""
    found = [t.where(F.col("n") <= 1 << bits).select("tree", "top") for t in tiers]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _members(parts: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """A row for each leaf of each segment: the siblings from the leaf to the root, as far as there are any.

    ``sides`` has a letter for each level: the sibling is on the left (L) or right (R), or there is none (-).
    """
    for part in parts:
        for row in range(part.num_rows):
            values = {name: part.column(name)[row] for name in part.schema.names}
            n, block, nodes = values["n"].as_py(), values["block"].as_py(), values["nodes"].as_py()
            tree, above, proof_above = (values[c].as_py() for c in ("tree", "sides", "proof"))
            subroot, root = values["subroot"].as_py(), values["root"].as_py()
            items = values["items"].values
            first = block << bits
            start = 2 * first - first.bit_count()
            leaves, sides, proofs = [], [], []
            own = min(bits, height(n))
            widths = [-(-n >> level) for level in range(own)]
            where: dict[tuple[int, int], str] = {}
            for rank in range(first, first + len(items)):
                side, proof = [], []
                for level in range(own):
                    index = rank >> level
                    sibling = index ^ 1
                    if sibling >= widths[level]:
                        side.append("-")
                        continue
                    side.append("L" if sibling < index else "R")
                    if (level, sibling) not in where:
                        where[level, sibling] = nodes[position(level, sibling, n) - start]
                    proof.append(where[level, sibling])
                leaves.append(nodes[position(0, rank, n) - start])
                sides.append("".join(side) + above)
                proofs.append("".join(proof) + proof_above)
            count = len(leaves)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([tree] * count, pa.string()),
                    pa.array(range(first, first + count), pa.int64()),
                    items,
                    *[pa.array(c, pa.string()) for c in (leaves, sides, proofs, [subroot] * count, [root] * count)],
                ],
                names=["tree", "rank", "item", "leaf", "sides", "proof", "subroot", "root"],
            )


def _proofs(tiers: list[DataFrame], tops: DataFrame, bits: int) -> DataFrame:
    """Proofs of the leaves of the lowest tier; ``tops`` has (tree, sides, proof, subroot, root) of every tree's top."""
    path = ["sides", "proof", "subroot", "root"]
    seeds = tops.select(F.col("tree").alias("of"), F.lit(0).cast("bigint").alias("place"), *path)
    known = None
    for tier, segments in reversed([*enumerate(tiers)]):
        single = segments.where(F.col("n") <= 1 << bits).select("tree")
        here = seeds.join(single, F.col("of") == F.col("tree"), "left_semi")
        here = here if known is None else here.unionByName(known)
        met = (F.col("tree") == F.col("of")) & (F.col("block") == F.col("place"))
        rows = segments.drop("top").join(here, met).drop("of", "place")
        kind = PROOF.format(item=segments.schema["items"].dataType.elementType.simpleString())
        found = rows.mapInArrow(lambda parts: _members(parts, bits), kind)
        if not tier:
            return found
        known = found.select(F.col("tree").alias("of"), F.col("rank").alias("place"), *path)
    raise ValueError("a forest has one tier at least")


def proofs(docs: DataFrame, claim: Column | None = None, bits: int = BITS) -> DataFrame:
    """Per document: doc_id, tree, rank, leaf, sides, proof (its siblings joined), subroot, root, and ``claim``.

    ``claim`` is a column over ``docs`` that is carried along. A null lang is a tree of its own, before all others; rows
    with equal ids are ordered by their leaves; null ids come first. A tree of one leaf has that leaf as subroot, one tree
    alone has its subroot as root, and both then add nothing to the proof. An empty table has no root and gives no rows.
    Other columns than ``FIELDS`` do not count.
    """
    carried = (F.lit(None).cast("string") if claim is None else claim).alias("claim")
    rows = docs.select(
        F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), carried).alias("item"),
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"),
        F.col("doc_id").cast("bigint").alias("by"),
        leaf([F.col(c) for c in FIELDS]).alias("leaf"),
    )
    low = _tiers(ranked(staged(rows, "leaves"), "tree", ["by", "leaf"]), bits)
    tops = staged(_tops(low, bits).select(F.lit(ROOT).alias("forest"), F.col("tree").alias("item"), F.col("top").alias("leaf")), "tops")
    high = _tiers(ranked(tops, "forest", ["item"]).withColumnRenamed("forest", "tree"), bits)
    root = _tops(high, bits).select("tree", F.lit("").alias("sides"), F.lit("").alias("proof"), F.lit(None).cast("string").alias("subroot"), F.col("top").alias("root"))
    over = _proofs(high, root, bits).select(F.col("item").alias("tree"), "sides", "proof", F.col("leaf").alias("subroot"), "root")
    found = _proofs(low, staged(over, "trees"), bits)
    return found.select("item.doc_id", "tree", "rank", "leaf", "sides", "proof", "subroot", "root", "item.claim")


def _folded(node: str, sides: str, proof: str) -> str:
    at = 0
    for side in sides:
        if side == "-":
            node = digest(node)
            continue
        sibling = proof[at : at + 64]
        at += 64
        node = digest(sibling + node if side == "L" else node + sibling)
    return node


def folded(rows: DataFrame, leaf_column: str = "leaf") -> DataFrame:
    """``rows`` of ``proofs`` with ``folded_root``: the root that the leaf in ``leaf_column`` and the siblings give."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            columns = [part.column(part.schema.get_field_index(c)).to_pylist() for c in (leaf_column, "sides", "proof")]
            roots = pa.array([_folded(*row) for row in zip(*columns)], pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns, roots], names=[*part.schema.names, "folded_root"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(batches, f"{kinds}, folded_root string")


def tampered_leaf(of: int = TAMPERED_OF) -> Column:
    """The leaf after tampering: n_chars grows by one where ``of`` divides the CRC of the id; else the leaf as it is."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == 0
    grown = F.when(chosen, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars"))
    return F.when(chosen, leaf([grown if c == "n_chars" else F.col(c) for c in FIELDS]))


def verified(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """The manifest of ``docs`` and, per document, whether its leaf after ``tampered_leaf`` still gives the root."""
    rows = proofs(docs, tampered_leaf(), bits).withColumn("claim", F.coalesce("claim", "leaf"))
    rows = folded(rows, "claim")
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
