"""Merkle manifest of a dataset: a hash tree per group, a tree over the groups, proofs and versions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableflow.llm.rows import stored

DIGITS = 64
BLOCK_LEVELS = 10


def _hash(digits: bytes) -> bytes:
    return sha256(digits).hexdigest().encode()


class PersistentTree:
    """The binary hash tree of one aligned block, with versions that share every untouched node.

    A node is a number; its digest and children never change. A version is the number of its root.
    """

    def __init__(self, leaves: list[bytes], levels: int):
        self.levels = levels
        self.digests: list[bytes] = []
        self.children: list[tuple[int, int]] = []
        row = [self._node(digest) for digest in leaves]
        for _ in range(levels):
            row = [self._parent(*row[i : i + 2]) for i in range(0, len(row), 2)]
        (self.root,) = row

    def _node(self, digest: bytes, left: int = -1, right: int = -1) -> int:
        self.digests.append(digest)
        self.children.append((left, right))
        return len(self.digests) - 1

    def _parent(self, left: int, right: int = -1) -> int:
        """A last node without a partner has a parent of its own."""
        below = self.digests[left] + (self.digests[right] if right >= 0 else b"")
        return self._node(_hash(below), left, right)

    def _path(self, at: int) -> Iterator[tuple[int, int]]:
        """The ancestors of a leaf from the root on, and the side on which each leaves them."""
        node = self.root
        for level in reversed(range(self.levels)):
            side = at >> level & 1
            yield node, side
            node = self.children[node][side]

    def changed(self, at: int, leaf: bytes) -> int:
        """The version in which one leaf differs: its ancestors are copied, everything else is shared."""
        copy = self._node(leaf)
        for node, side in reversed([*self._path(at)]):
            left, right = self.children[node]
            copy = self._parent(left, copy) if side else self._parent(copy, right)
        return copy

    def proof(self, at: int) -> tuple[bytes, str]:
        """The siblings of a leaf and its ancestors, lowest first, and for each level the side the
        sibling is on: L, R, or - where there is none."""
        siblings, sides = [], ""
        for node, side in reversed([*self._path(at)]):
            other = self.children[node][1 - side]
            siblings.append(self.digests[other] if other >= 0 else b"")
            sides += "-" if other < 0 else "RL"[side]
        return b"".join(siblings), sides


def fold(digest: bytes, siblings: bytes, sides: str) -> bytes:
    """The root that follows from a digest and its proof."""
    at = 0
    for side in sides:
        sibling = b"" if side == "-" else siblings[at : at + DIGITS]
        digest = _hash(sibling + digest if side == "L" else digest + sibling)
        at += len(sibling)
    return digest


def leaf(columns: Iterable[Column]) -> Column:
    """Digest of a row: of each value ``-`` if null, else its length in bytes, ``:`` and its text."""
    def entry(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(entry, columns)), 256))


def numbered(spark: SparkSession, rows: DataFrame, group: str, order: Iterable[str]) -> DataFrame:
    """The rows with their place ``pos`` in their group, from zero on, and the group's size ``n``.

    Rows are sorted over all tasks at once, so a group may be of any size; only the number of rows that
    each task holds of each group is summed up along the tasks.
    """
    order = [group, *order]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # A monotonically increasing id is the task's number and, in 33 bits, the row's place in it.
    dealt = stored(spark, ranged.withColumn("__at", F.monotonically_increasing_id()), "ranked")
    dealt = dealt.withColumn("__task", F.shiftright("__at", 33))
    runs = dealt.groupBy(group, "__task").agg(F.min("__at").alias("__from"), F.count("*").alias("__rows"))
    tasks = Window.partitionBy(group)
    since = tasks.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        group, "__task",
        (F.coalesce(F.sum("__rows").over(since), F.lit(0)) - F.col("__from")).alias("__shift"),
        F.sum("__rows").over(tasks).alias("n"),
    )
    return dealt.join(runs, [group, "__task"]).withColumn("pos", F.col("__at") + F.col("__shift")).drop(
        "__at", "__task", "__shift"
    )


def _blocks(nodes: DataFrame, levels: int, *carried: str) -> DataFrame:
    """Nodes gathered in aligned blocks of at most 2**levels: (grp, block, n, nodes by place)."""
    return nodes.groupBy("grp", F.shiftright("pos", levels).alias("block")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "digest", *carried))).alias("nodes")
    )


def _levels_of(n: int, levels: int) -> int:
    """How many levels a block has: all of them, unless its group ends within it."""
    return levels if n > 1 << levels else (n - 1).bit_length()


def _each_block(batches: Iterator[pa.RecordBatch], levels: int):
    """Per row of blocks: its place in the batch, the nodes' fields, and the tree over them."""
    for batch in batches:
        sizes = batch.column("n").to_pylist()
        for i, nodes in enumerate(batch.column("nodes")):
            fields = nodes.values
            digests = [d.hex().encode() for d in fields.field("digest").to_pylist()]
            yield batch, i, fields, digests, PersistentTree(digests, _levels_of(sizes[i], levels))


def _lifted(blocks: DataFrame, levels: int) -> DataFrame:
    """Per node of the blocks: its proof within the block, and the block's root ``above``."""
    def lift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, fields, digests, tree in _each_block(batches, levels):
            proofs = [tree.proof(at) for at in range(len(digests))]
            above = bytes.fromhex(tree.digests[tree.root].decode())
            k = len(digests)
            yield pa.RecordBatch.from_arrays(
                [_repeated(batch, "grp", i, k), fields.field("pos"), _repeated(batch, "block", i, k),
                 _repeated(batch, "n", i, k), pa.array([p.decode() for p, _ in proofs], pa.string()),
                 pa.array([s for _, s in proofs], pa.string()), pa.array([above] * k, pa.binary())],
                ["grp", "pos", "block", "n", "proof", "sides", "above"],
            )

    return blocks.mapInArrow(
        lift, "grp string, pos long, block long, n long, proof string, sides string, above binary"
    )


def _repeated(batch: pa.RecordBatch, column: str, i: int, times: int) -> pa.Array:
    return pa.repeat(batch.column(column)[i], times)


def _block_roots(blocks: DataFrame, levels: int) -> DataFrame:
    def lift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, _, _, tree in _each_block(batches, levels):
            root = bytes.fromhex(tree.digests[tree.root].decode())
            yield pa.RecordBatch.from_arrays(
                [_repeated(batch, c, i, 1) for c in ("grp", "block", "n")] + [pa.array([root], pa.binary())],
                ["grp", "block", "n", "digest"],
            )

    found = blocks.select("grp", "block", "n", "nodes").mapInArrow(lift, "grp string, block long, n long, digest binary")
    return found.select("grp", F.col("block").alias("pos"), _above(levels), "digest")


def _above(levels: int) -> Column:
    """Number of nodes where blocks were, per group."""
    return F.shiftright(F.col("n") + (1 << levels) - 1, levels).alias("n")


def climb(spark: SparkSession, nodes: DataFrame, levels: int) -> DataFrame:
    """Per node (grp, pos): its proof up to the root of its group, and that root.

    Each round replaces aligned blocks by their roots, so the number of rounds is the logarithm of
    the largest group to the base of a block; on the way back each node meets the one row of its block.
    """
    rounds = []
    while True:
        rounds.append(stored(spark, _lifted(_blocks(nodes, levels), levels), "nodes"))
        if (rounds[-1].agg(F.max("n")).first()[0] or 0) <= 1 << levels:
            break
        first = rounds[-1].where(F.col("pos") == F.shiftleft("block", levels))
        nodes = first.select("grp", F.col("block").alias("pos"), _above(levels), F.col("above").alias("digest"))
    found = rounds.pop().select("grp", "pos", "proof", "sides", F.col("above").alias("root"))
    for below in reversed(rounds):
        upper = found.select(
            "grp", F.col("pos").alias("block"), F.col("proof").alias("proof_above"), F.col("sides").alias("sides_above"), "root"
        )
        found = below.join(upper, ["grp", "block"]).select(
            "grp", "pos", F.concat("proof", "proof_above").alias("proof"), F.concat("sides", "sides_above").alias("sides"), "root"
        )
    return found


def manifest(
    spark: SparkSession,
    rows: DataFrame,
    columns: Iterable[str],
    group: str = "lang",
    order: str = "doc_id",
    altered: dict[str, Column] | None = None,
    where: Column | None = None,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """Per row: ``order``, its ``leaf``, the ``subroot`` of its group, the ``root`` of the dataset, its
    ``proof`` (the siblings from the leaf to the root) with the ``sides`` they are on, and
    ``folded_root``, the root of the row's own version: in rows that meet ``where`` the columns of
    ``altered`` have other values; all other leaves are as they are. Digests are lowercase hex.

    Leaves of a group ascend by ``order``, nulls first, equal ones by digest; groups ascend by the bytes
    of their text, null first and apart from ''. While there are several nodes, each two in a row become
    their hash, and so does a last one alone. Equal rows are leaves of their own with equal digests.
    Texts may be empty or of any length: they are hashed inside Spark and don't move. An empty table
    gives no rows. Other columns, of whatever name, aren't looked at.

    Leaves are numbered over all tasks and gathered in aligned blocks of 2**block_levels, the only
    thing that one task holds at once. In a block each altered leaf is a version of a persistent
    tree that copies its ancestors alone; above the block the version goes on through the trees over
    block roots, whose nodes it shares too, so one row of them per block is all it needs.
    """
    columns = list(columns)
    other = [(altered or {}).get(c, F.col(c)) for c in columns]
    changed = F.coalesce(where, F.lit(False)) if where is not None else F.lit(False)
    leaves = rows.select(
        # Nulls come before every text, the empty one too.
        F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit("")).alias("grp"),
        F.col(order).alias("id"),
        leaf([F.col(c) for c in columns]).alias("digest"),
        F.when(changed, leaf(other)).alias("other"),
        # Spreads rows that are equal in everything over the tasks that sort.
        F.rand(0).alias("salt"),
    )
    leaves = numbered(spark, stored(spark, leaves, "leaves"), "grp", ["id", "digest", "salt"])
    blocks = stored(spark, _blocks(leaves, block_levels, "id", "other"), "blocks")

    up = stored(spark, climb(spark, _block_roots(blocks, block_levels), block_levels), "blocks-up")
    subroots = up.where("pos = 0").select(F.col("grp").alias("name"), F.col("root").alias("digest"))
    tops = numbered(spark, subroots.withColumn("grp", F.lit("")), "grp", ["name"])
    tops = tops.select("grp", "name", "pos", "n", "digest")
    top = climb(spark, tops, block_levels).select("pos", "proof", "sides", "root")
    top = tops.select("name", "pos", F.col("digest").alias("subroot")).join(top, "pos").select(
        F.col("name").alias("grp"), "subroot", "root", F.col("proof").alias("proof_top"), F.col("sides").alias("sides_top")
    )
    above = stored(spark, top, "groups").join(up.drop("root"), "grp").select(
        "grp", F.col("pos").alias("block"), F.hex("subroot").alias("subroot"), F.hex("root").alias("root"),
        F.concat("proof", "proof_top").alias("proof"), F.concat("sides", "sides_top").alias("sides"),
    )
    kind = rows.schema[order].dataType.simpleString()
    return blocks.join(stored(spark, above, "above"), ["grp", "block"]).mapInArrow(
        lambda batches: _versions(batches, block_levels, order),
        f"`{order}` {kind}, leaf string, subroot string, root string, proof string, sides string, folded_root string",
    )


def _versions(batches: Iterator[pa.RecordBatch], levels: int, order: str) -> Iterator[pa.RecordBatch]:
    """The rows of blocks that know their way to the root."""
    for batch, i, fields, digests, tree in _each_block(batches, levels):
        subroot, root, proof, sides = (batch.column(c)[i].as_py() for c in ("subroot", "root", "proof", "sides"))
        above = proof.encode()
        folded = [fold(tree.digests[tree.root], above, sides).decode()] * len(digests)
        proofs, all_sides = [], []
        for at, other in enumerate(fields.field("other").to_pylist()):
            own, own_sides = tree.proof(at)
            proofs.append((own + above).decode())
            all_sides.append(own_sides + sides)
            if other is not None:
                version = tree.changed(at, other.hex().encode())
                folded[at] = fold(tree.digests[version], above, sides).decode()
        k = len(digests)
        yield pa.RecordBatch.from_arrays(
            [fields.field("id"), pa.array([d.decode() for d in digests], pa.string()),
             pa.array([subroot.lower()] * k, pa.string()), pa.array([root.lower()] * k, pa.string()),
             pa.array(proofs, pa.string()), pa.array(all_sides, pa.string()), pa.array(folded, pa.string())],
            [order, "leaf", "subroot", "root", "proof", "sides", "folded_root"],
        )
