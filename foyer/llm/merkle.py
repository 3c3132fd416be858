"""A Merkle manifest of a dataset, with proofs, and versions of it after tampering.

Rows are leaves. In each group they ascend by their key, and every eight
consecutive nodes become one node until a single one, the group's subroot,
remains; the subroots, ordered by group, likewise become the root.

The tree is cut into aligned blocks of ``ARITY ** HEIGHT`` leaves, each held by
one task. The roots of the blocks are the leaves of the next blocks upward, so
that no task holds more than one block whatever the size of a group. Blocks are
persistent trees: a tampered leaf makes a new version of its block that shares
every node but the leaf's ancestors, which are copied. A version goes on above
its block along the path that its block hands down: siblings from the block's
root to the root of all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.tables import select_into

#: Children of a node, and levels of a block. The second bounds what a task holds and changes no digest.
ARITY, HEIGHT = 8, 4

#: A path upward: for each level the node's place in its run and the run's other nodes.
PATH = "array<struct<place: int, siblings: array<string>>>"


def digest(parts: Iterable[str]) -> str:
    """The lowercase hex SHA-256 of the texts' concatenation."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields: each ``-`` if null, else its UTF-8 byte count, ``:`` and its text."""
    texts = [f.cast("string") for f in fields]
    coded = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*coded), 256)


Node = tuple[str, tuple["Node", ...]]


class Block:
    """A persistent tree over the nodes of one aligned block.

    A block that is all of its group, whose nodes on this level number
    ``total``, has as many levels as a single root takes; any other has
    ``height`` levels, however few nodes the last one holds.
    """

    def __init__(self, digests: Sequence[str], total: int, height: int):
        nodes: list[Node] = [(d, ()) for d in digests]
        whole, self.height = total <= ARITY**height, 0
        while len(nodes) > 1 if whole else self.height < height:
            runs = [tuple(nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]
            nodes = [(digest(n[0] for n in run), run) for run in runs]
            self.height += 1
        self.root = nodes[0]

    def path(self, at: int) -> list[dict]:
        """From the leaf at ``at`` (of the block or of its group) upward, its place in each run and the run's other digests."""
        out, node = [], self.root
        for height in range(self.height, 0, -1):
            place = at // ARITY ** (height - 1) % ARITY
            run = node[1]
            out.append({"place": place, "siblings": [n[0] for n in run[:place] + run[place + 1 :]]})
            node = run[place]
        return out[::-1]

    def version(self, at: int, leaf: str) -> Node:
        """The root after the leaf at ``at`` becomes ``leaf``; only its ancestors are copied."""
        return replaced(self.root, self.height, at, leaf)


def replaced(node: Node, height: int, at: int, leaf: str) -> Node:
    if not height:
        return leaf, ()
    place = at // ARITY ** (height - 1) % ARITY
    run = node[1]
    run = (*run[:place], replaced(run[place], height - 1, at, leaf), *run[place + 1 :])
    return digest(n[0] for n in run), run


def carried(version: str, path: Sequence[dict]) -> str:
    """The root of a version whose block has the root ``version`` and the path ``path``."""
    for step in path:
        run = step["siblings"]
        version = digest((*run[: step["place"]], version, *run[step["place"] :]))
    return version


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with their number ``at`` in their group ``grp`` by ``order``, and the group's ``total``.

    Rows are dealt by ranges, so a group of any size lies in many partitions;
    rows that repeat are told apart by a number and don't meet in one. The
    written table fixes the ranges, and offsets follow from one count for each
    partition and group.
    """
    own = rows.withColumn("row", F.monotonically_increasing_id())
    ranged = select_into(
        own.repartitionByRange("grp", *order, "row")
        .sortWithinPartitions("grp", *order, "row")
        .select(*rows.columns, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq"))
    )
    counts = ranged.groupBy("part", "grp").agg(F.count("*").alias("many"), F.min("seq").alias("first"))
    group = Window.partitionBy("grp")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "part", "grp", "first",
        F.coalesce(F.sum("many").over(earlier), F.lit(0)).alias("before"), F.sum("many").over(group).alias("total"),
    )
    at = (F.col("before") + F.col("seq") - F.col("first")).alias("at")
    return ranged.join(counts, ["part", "grp"]).select(*rows.columns, at, "total")


def _sorted(rows: pa.Table) -> pa.Table:
    return rows.sort_by("at")


def _block(rows: pa.Table, height: int) -> Block:
    return Block(rows.column("h").to_pylist(), rows.column("total")[0].as_py(), height)


def grown(nodes: DataFrame, height: int) -> list[DataFrame]:
    """``nodes`` (``grp``, ``at``, ``h``, ``total``) and above them the roots of their blocks, up to one for each group.

    Each level is written to the shared folder; the driver learns whether one more is needed.
    """

    def run(rows: pa.Table) -> pa.Table:
        rows = _sorted(rows)
        first = rows.slice(0, 1).to_pylist()[0]
        size = ARITY**height
        above = {"grp": first["grp"], "at": first["at"] // size, "h": _block(rows, height).root[0], "total": -(-first["total"] // size)}
        return pa.table({k: [v] for k, v in above.items()})

    levels = [nodes]
    while not levels[-1].where("total > 1").isEmpty():
        rows = levels[-1].select("grp", "at", "h", "total", _above(height).alias("block"))
        above = rows.groupBy("grp", "block").applyInArrow(run, "grp string, at long, h string, total long")
        levels.append(select_into(above))
    return levels


def _above(height: int) -> Column:
    return F.floor(F.col("at") / ARITY**height)


def handed_down(children: DataFrame, parents: DataFrame, height: int, each, schema: T.StructType | str) -> DataFrame:
    """``each(rows of a block, their tree, their parent)`` over all blocks.

    ``parents`` has ``grp``, ``at``, its ``path`` and what else is handed down,
    one row for each block of ``children``.
    """

    def run(rows: pa.Table, parent: pa.Table) -> pa.Table:
        rows = _sorted(rows)
        return each(rows, _block(rows, height), parent.to_pylist()[0])

    left = children.withColumn("block", _above(height)).groupBy("grp", "block")
    right = parents.withColumnRenamed("at", "block").groupBy("grp", "block")
    return left.cogroup(right).applyInArrow(run, schema)


def _paths(rows: pa.Table, block: Block, parent: dict) -> pa.Table:
    path = [block.path(at) + parent["path"] for at in rows.column("at").to_pylist()]
    same = {k: [parent[k]] * rows.num_rows for k in ("subroot", "root")}
    columns = {"grp": rows.column("grp"), "at": rows.column("at"), "h": rows.column("h"), "path": path, **same}
    kind = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.list_(pa.string()))]))
    return pa.table({k: pa.array(v, kind) if k == "path" else v for k, v in columns.items()})


PATHS = f"grp string, at long, h string, path {PATH}, subroot string, root string"


def descended(levels: Sequence[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """From the paths of the highest level's nodes those of the lowest one's."""
    for level in reversed(levels):
        tops = handed_down(level, tops, height, _paths, PATHS)
    return tops


@dataclass(frozen=True)
class Manifest:
    """Levels of all groups, from leaves to subroots, and those above the subroots."""

    levels: list[DataFrame]
    above: list[DataFrame]
    height: int = HEIGHT

    def roots(self) -> DataFrame:
        """One row ``root``; none where there are no rows."""
        return self.above[-1].select(F.col("h").alias("root"))


def build(docs: DataFrame, key: str, group: str, leaf: Column, height: int = HEIGHT, **extra: Column) -> Manifest:
    """The manifest of ``docs``: leaves ``leaf`` by ``key`` in each ``group``, and ``extra`` columns beside them.

    Groups compare by their UTF-8 bytes, null first, as do null keys. Rows that
    repeat a key follow by their leaf. Nothing but the whole number of levels
    reaches the driver.
    """
    name = F.col(f"`{group}`").cast("string")
    grp = F.when(name.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), name))
    rows = docs.select(grp.alias("grp"), F.col(f"`{key}`").alias("key"), leaf.alias("h"), *[c.alias(k) for k, c in extra.items()])
    levels = grown(select_into(placed(rows, ("key", "h"))), height)
    subroots = levels[-1].select(F.lit("").alias("grp"), F.col("grp").alias("key"), "h")
    return Manifest(levels, grown(select_into(placed(subroots, ("key",))), height), height)


def proofs(manifest: Manifest, found: str = "h") -> DataFrame:
    """For each leaf its proof, and the root that the column ``found`` of the leaves folds to.

    Returns ``key``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of all
    siblings from the leaf to the root, left to right), ``folded_root`` and
    ``verified``, whether the two roots are equal. ``found`` holds the leaf as
    it is met now, changed or not; each makes its own version.
    """
    leaves, height = manifest.levels[0], manifest.height
    top = manifest.above[-1].select("grp", "at", "h", F.array().cast(PATH).alias("path"), F.lit("").alias("subroot"), F.col("h").alias("root"))
    top = descended(manifest.above[:-1], top, height).withColumnRenamed("h", "own")
    names = manifest.above[0].select("grp", "at", "key")
    named = top.join(names, ["grp", "at"])
    tops = named.select(F.col("key").alias("grp"), F.lit(0).cast("long").alias("at"), "path", F.col("own").alias("subroot"), "root")
    # Above the leaves' own blocks paths are few; they are written once and met by whole blocks.
    tops = select_into(descended(manifest.levels[1:-1], tops, height)) if len(manifest.levels) > 2 else tops
    kind = leaves.schema["key"].dataType
    fields = [("key", kind), *[(n, T.StringType()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", T.BooleanType())]

    def prove(rows: pa.Table, block: Block, parent: dict) -> pa.Table:
        beyond = "".join(s for step in parent["path"] for s in step["siblings"])
        proof, folded = [], []
        for at, now in zip(rows.column("at").to_pylist(), rows.column(found).to_pylist(), strict=True):
            own = [s for step in block.path(at) for s in step["siblings"]]
            proof.append(digest((*own, beyond)))
            folded.append(carried(block.version(at, now)[0], parent["path"]))
        root = parent["root"]
        columns = [rows.column("key"), rows.column("h"), *[pa.array([parent[k]] * rows.num_rows, pa.string()) for k in ("subroot", "root")]]
        columns += [pa.array(proof, pa.string()), pa.array(folded, pa.string()), pa.array([f == root for f in folded], pa.bool_())]
        return pa.table(columns, [n for n, _ in fields])

    if len(manifest.levels) == 1:
        # Every group is a lone leaf: each is a block of its own below its subroot.
        leaves = leaves.withColumn("at", F.lit(0).cast("long"))
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    return handed_down(leaves, tops, height, prove, schema)
