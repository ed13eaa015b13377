"""Merkle manifest of a dataset with incremental witnesses.

A row's leaf is the hash of its fields.  The leaves of a tree (a value of
``tree``, the language) are appended in key order to open subtrees.  Every
leaf carries its witness so far, the siblings up to the root of its open
subtree; when a later sibling is complete, the two subtrees become one and the
witnesses of both sides are extended by the other's root.  Every two
consecutive nodes become one; the last of an odd number is hashed alone.  The
subtrees' roots, ordered by tree, are appended to the tree of the dataset.

Scale: leaves are hashed where the rows are read, so texts are never shuffled.
Positions come from a global sort of the digests (``common.numbered``): a tree
with a third of all rows is cut into slices like any other.  A task appends an
aligned block of ``BLOCK`` consecutive leaves; the block's root is a further
append one round up, among the roots of the other blocks, and so on until a
tree has one block.  The witnesses of the rounds are joined on (tree, block):
nothing holds a tree.  Each round writes a table in the shared folder, so a
lost executor repeats its own blocks.

Defined results: a null field is ``-``, any other its UTF-8 byte count, ``:``
and its value, so empty and null differ; a null tree is a tree of its own and
comes first; null keys come first; equal keys stand in order of their leaves,
repeated rows are leaves each; an empty table has no rows and no root.  Only
the named columns are read, others may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import numbered, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaves, or block roots, that a task appends in one go; a power of two.
BLOCK_BITS = 12

ALONE, LEFT, RIGHT = 0, 1, 2  # a level of a witness: no sibling, or the side it stands on
_WITNESS = [T.StructField(c, T.BinaryType()) for c in ("path", "block_root")]
_PROOF = [T.StructField(c, T.BinaryType()) for c in ("proof", "folded")]
LEVEL = 33  # bytes of a level: the side and the sibling's digest


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of the fields as bytes."""
    text = [c.cast("string") for c in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def parent(*nodes: bytes) -> bytes:
    """Digest of a run of nodes, taken as lower-case hex text."""
    return sha256(b"".join(nodes).hex().encode()).digest()


class Subtrees:
    """Open subtrees of the nodes appended so far, and a witness for each."""

    def __init__(self, most: int, levels: int):
        import numpy as np

        self.open: list[tuple[int, int, int, bytes]] = []  # (height, first node, end, root)
        self.paths = np.zeros((most, levels, LEVEL), dtype=np.uint8)
        self.n = 0

    def _extend(self, height: int, first: int, end: int, side: int, sibling: bytes) -> None:
        import numpy as np

        self.paths[first:end, height] = np.frombuffer(bytes([side]) + sibling, dtype=np.uint8)

    def _merge(self) -> None:
        """The last two, of one height, become one; both sides learn of the other."""
        height, middle, end, right = self.open.pop()
        _, first, _, left = self.open.pop()
        self._extend(height, first, middle, RIGHT, right)
        self._extend(height, middle, end, LEFT, left)
        self.open.append((height + 1, first, end, parent(left, right)))

    def append(self, digest: bytes) -> None:
        self.open.append((0, self.n, self.n + 1, digest))
        self.n += 1
        while len(self.open) > 1 and self.open[-2][0] == self.open[-1][0]:
            self._merge()

    def close(self, height: int = 0) -> bytes:
        """Root once no more nodes come, of a tree of that height at least."""
        while len(self.open) > 1 or self.open[0][0] < height:
            if len(self.open) > 1 and self.open[-2][0] == self.open[-1][0]:
                self._merge()
            else:  # no sibling will come: hashed alone
                at, first, end, root = self.open.pop()
                self.open.append((at + 1, first, end, parent(root)))
        return self.open[0][3]

    def witnesses(self) -> list[bytes]:
        height = self.open[0][0]
        return [p.tobytes() for p in self.paths[: self.n, :height]]


def _append_block(bits: int, out: list[str]):
    def run(group):
        group = group.sort_values("position")
        subtrees = Subtrees(len(group), bits)
        for digest in group["digest"]:
            subtrees.append(digest)
        # one of several blocks is a full subtree of its tree, whatever it holds
        root = subtrees.close(bits if group["size"].iloc[0] > 1 << bits else 0)
        return group.assign(path=subtrees.witnesses(), block_root=root)[out]

    return run


def climb(nodes: DataFrame, finish: Callable[[DataFrame], DataFrame], bits: int = BLOCK_BITS) -> DataFrame:
    """``nodes`` (tree, position, size, digest and any others) with path, subroot
    and root: a block is appended as a whole, its root is a node of the next
    round.  ``finish`` gets one node for each tree."""
    schema = T.StructType([*nodes.schema, *_WITNESS])
    blocks = nodes.groupBy("tree", F.shiftright("position", bits))
    low = stored(blocks.applyInPandas(_append_block(bits, schema.names), schema), "witnesses")
    roots = low.filter(F.expr(f"position & {(1 << bits) - 1} = 0")).select(
        "tree",
        F.shiftright("position", bits).alias("position"),
        F.shiftright(F.col("size") + (1 << bits) - 1, bits).alias("size"),
        F.col("block_root").alias("digest"),
    )
    several = not roots.filter("size > 1").isEmpty()
    above = climb(roots, finish, bits) if several else finish(roots)
    above = above.select("tree", F.col("position").alias("block"), F.col("path").alias("rest"), "subroot", "root")
    met = low.withColumn("block", F.shiftright("position", bits)).join(above, ["tree", "block"])
    return met.select(*nodes.columns, F.concat("path", "rest").alias("path"), "subroot", "root")


def _dataset_tree(bits: int) -> Callable[[DataFrame], DataFrame]:
    """The roots of all trees, in order of the trees, are the nodes of one more."""

    def top(roots: DataFrame) -> DataFrame:
        return roots.select("tree", "position", F.lit(b"").alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))

    def finish(roots: DataFrame) -> DataFrame:
        subroots = stored(roots.select(F.lit("").alias("all"), "tree", "digest"), "subroots")
        order = stored(numbered(subroots, "all", "tree"), "subroot-order")
        nodes = order.select(F.col("all").alias("tree"), "position", "size", "digest", F.col("tree").alias("of"))
        out = climb(nodes, top, bits)
        return out.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("position"), "path", F.col("digest").alias("subroot"), "root")

    return finish


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    tree: str = "lang",
    key: str = "doc_id",
    claimed: Column | None = None,
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """One row per row of ``docs``: key, leaf, path (witness), subroot, root and
    ``claimed``, another leaf of the same row to hold against the root (by
    default its own)."""
    own = leaf([F.col(c) for c in fields])
    # "" is the null tree, "=" before a value: null comes first, the rest bytewise
    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("")).alias("tree"),
        own.alias("digest"),
        (own if claimed is None else claimed).alias("claimed"),
    )
    leaves = stored(numbered(rows, "tree", F.col("key").asc_nulls_first(), "digest"), "leaves")
    out = climb(leaves, _dataset_tree(bits), bits)
    return out.select(F.col("key").alias(key), F.col("digest").alias("leaf"), "claimed", "path", "subroot", "root")


def _fold(batches):
    import pyarrow as pa

    for batch in batches:
        proofs, folded = [], []
        for node, path in zip(batch.column("claimed").to_pylist(), batch.column("path").to_pylist()):
            siblings = []
            for at in range(0, len(path), LEVEL):
                side, other = path[at], path[at + 1 : at + LEVEL]
                if side == ALONE:
                    node = parent(node)
                    continue
                siblings.append(other)
                node = parent(other, node) if side == LEFT else parent(node, other)
            proofs.append(parent(*siblings))
            folded.append(node)
        kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name not in ("path", "claimed")]
        names = [n for n in batch.schema.names if n not in ("path", "claimed")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(proofs, pa.binary()), pa.array(folded, pa.binary())], [*names, "proof", "folded"])


def verified(witnessed: DataFrame) -> DataFrame:
    """A manifest's rows with ``proof``, the digest of the siblings up to the
    root, ``folded``, the root that the claimed leaf leads to, and whether it
    is the manifest's."""
    schema = T.StructType([*witnessed.drop("path", "claimed").schema, *_PROOF])
    return witnessed.mapInArrow(_fold, schema).withColumn("verified", F.col("folded") == F.col("root"))
