"""Merkle manifest of a table: a postorder log per group, written by aligned builders.

Rows are leaves. In each group (a language, say) they are numbered in order; every
``ARITY`` consecutive nodes of a level hang under one node of the next, the last of
them perhaps under a node with fewer, until one node is left, the group's root. The
group roots are the leaves of one more tree, whose root stands for the whole table.

A builder takes ``ARITY ** HEIGHT`` consecutive nodes that begin at a multiple of that
number, so every node below its top depends on its own rows alone, and writes the nodes
in the order in which they are completed: children before their parent. Where a node
stands in its group's log follows from its level, its index and the number of leaves
(`places`), so the siblings that a proof needs are looked up by position. A level of
builders leaves one node in 4,096, which the next level takes.

Proofs are read downwards: a block of builders' nodes gets the path above its top, and
hands each of its nodes the path above that. No group is ever in one task, however
large; one task holds 4,096 leaves and their nodes.

Null ids come first in their group, null groups come first among groups; rows with equal
ids are ordered by their leaf, and rows equal in all columns are equal leaves side by
side. Any column may be null or empty (`-` stands for null, so it differs from empty).
An empty table has an empty manifest, no root and no proofs. Only the named columns
are looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .batches import small_batches

ARITY = 8
#: Levels that one builder adds above its nodes.
HEIGHT = 4

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
LOG = "grp string, n long, level int, idx long, pos long, hash string"
PATH = "array<struct<before:string,after:string>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def level_sizes(n: int) -> list[int]:
    """Number of nodes per level of a tree over n leaves, from the leaves to the root."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // ARITY))
    return out


def places(level: int, index: np.ndarray, n: int) -> np.ndarray:
    """Positions in the log of nodes of a level: how many nodes are completed before each.

    A node is complete with its last leaf. Up to that leaf all nodes of its own and lower
    levels that began are complete, and of higher levels those that ended before it.
    """
    end = np.minimum(n, (np.asarray(index, np.int64) + 1) * ARITY**level)
    before = -np.ones_like(end)
    for k in range(len(level_sizes(n))):
        width = ARITY**k
        before += -(-end // width) if k <= level else (end - 1) // width
    return before


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def group_key(value: Column) -> Column:
    """A key without nulls that sorts as the values do, null first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows(grp, ...)`` with idx, their place in their group by `order`, and n, the group's rows.

    Rows are dealt out by ranges of the whole order, so a group may fill any number of
    tasks; places inside a task are made up with the counts of the tasks before it.
    """
    spark = rows.sparkSession
    by = ["grp", *order]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage_table(
        rows.repartitionByRange(ranges, *by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()), "ranges"
    )
    part = F.shiftright("at", 33)
    held = dealt.groupBy("grp", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("held"))
    # One row per range and group.
    held = held.selectExpr(
        "*",
        "sum(held) over (partition by grp) as n",
        "coalesce(sum(held) over (partition by grp order by part rows between unbounded preceding and 1 preceding), 0) as earlier",
    )
    placed = dealt.withColumn("part", part).join(held, ["grp", "part"])
    return placed.withColumn("idx", F.col("at") - F.col("first") + F.col("earlier")).drop("at", "part", "first", "held", "earlier")


def _builder(base: int, height: int):
    def build(nodes: pa.Table) -> pa.Table:
        grp, n = nodes["grp"][0].as_py(), nodes["n"][0].as_py()
        index = nodes["idx"].to_numpy()
        order = np.argsort(index)
        row = nodes["hash"].take(pa.array(order)).to_pylist()
        index, sizes = index[order], level_sizes(n)
        found: list[tuple[np.ndarray, int, np.ndarray, list[str]]] = []
        for level in range(base, base + height + 1):
            if level > base:
                row = [digest("".join(row[k : k + ARITY])) for k in range(0, len(row), ARITY)]
                index = index[::ARITY] // ARITY
            if level > base or base == 0:
                found.append((places(level, index, n), level, index, row))
            if sizes[level] == 1:
                break
        pos = np.concatenate([x[0] for x in found])
        made = pa.table(
            {
                "grp": pa.array([grp] * len(pos), pa.string()),
                "n": pa.array(np.full(len(pos), n, np.int64)),
                "level": pa.array(np.concatenate([np.full(len(x[0]), x[1], np.int32) for x in found])),
                "idx": pa.array(np.concatenate([x[2] for x in found])),
                "pos": pa.array(pos),
                "hash": pa.array([h for x in found for h in x[3]], pa.string()),
            }
        )
        return made.take(pa.array(np.argsort(pos)))

    return build


def append_log(leaves: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The log (grp, n, level, idx, pos, hash) of ``leaves(grp, n, idx, hash)``: all nodes, in completion order per builder."""
    nodes = small_batches(leaves.select("grp", "n", "idx", "hash"))
    most = nodes.agg(F.max("n")).first()[0] or 0
    base, logs = 0, []
    while base == 0 or ARITY**base < most:
        blocks = nodes.withColumn("block", F.expr(f"idx div {ARITY**height}"))
        logs.append(stage_table(blocks.groupBy("grp", "block").applyInArrow(_builder(base, height), LOG), "log"))
        base += height
        nodes = logs[-1].where((F.col("level") == base) & (F.col("n") > ARITY**base)).select("grp", "n", "idx", "hash")
    out = logs[0]
    for more in logs[1:]:
        out = out.union(more)
    return out


def roots(log: DataFrame) -> DataFrame:
    """(grp, n, hash): the last node of each group's log."""
    return log.where(F.col("n") <= F.pow(F.lit(float(ARITY)), F.col("level"))).select("grp", "n", "hash")


def _siblings(log: pa.Table, n: int, base: int, block: int, height: int) -> list[tuple[list[str], list[str]]]:
    """Per level of a block, what stands before and after each node in its run."""
    at = dict(zip(log["pos"].to_pylist(), log["hash"].to_pylist(), strict=True))
    sizes, out = level_sizes(n), []
    for level in range(base, min(base + height, len(sizes) - 1)):
        width = ARITY ** (base + height - level)
        index = np.arange(block * width, min(sizes[level], (block + 1) * width))
        row = [at[p] for p in places(level, index, n).tolist()]
        before, after = [], []
        for k in range(0, len(row), ARITY):
            run = row[k : k + ARITY]
            before += ["".join(run[:j]) for j in range(len(run))]
            after += ["".join(run[j + 1 :]) for j in range(len(run))]
        out.append((before, after))
    return out


def _block(log: pa.Table, base: int, height: int):
    """(block, its siblings by level, the row with the path above it) of a block's log."""
    above = log.filter(pc.is_valid(log["above"]))
    nodes = log.filter(pc.is_valid(log["pos"]))
    block = log["block"][0].as_py()
    return block, _siblings(nodes, above["n"][0].as_py(), base, block, height), above


def _path(at: int, siblings) -> Iterator[tuple[str, str]]:
    for before, after in siblings:
        yield before[at], after[at]
        at //= ARITY


def _descend(base: int, height: int):
    def paths(members: pa.Table, log: pa.Table) -> pa.Table:
        block, siblings, above = _block(log, base, height)
        rest, first = above["above"][0].as_py(), block * ARITY**height
        found = [[{"before": b, "after": a} for b, a in _path(i - first, siblings)] + rest for i in members["idx"].to_pylist()]
        kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        return pa.table({"grp": members["grp"], "idx": members["idx"], "path": pa.array(found, kind)})

    return paths


def _folder(height: int):
    def verify(leaves: pa.Table, log: pa.Table) -> pa.Table:
        block, siblings, above = _block(log, 0, height)
        rest = [(x["before"], x["after"]) for x in above["above"][0].as_py()]
        subroot, root = above["subroot"][0].as_py(), above["root"][0].as_py()
        upper = "".join(b + a for b, a in rest)
        proofs, folded = [], []
        for index, start in zip(leaves["idx"].to_pylist(), leaves["shown"].to_pylist(), strict=True):
            own = list(_path(index - block * ARITY**height, siblings))
            proofs.append(digest("".join(b + a for b, a in own) + upper))
            for before, after in (*own, *rest):
                start = digest(before + start + after)
            folded.append(start)
        same = lambda x: pa.array([x] * len(folded), pa.string())
        return pa.table(
            {
                "id": leaves["id"],
                "leaf": leaves["hash"],
                "subroot": same(subroot),
                "root": same(root),
                "proof_sha256": pa.array(proofs, pa.string()),
                "folded_root": pa.array(folded, pa.string()),
                "verified": pa.array([x == root for x in folded], pa.bool_()),
            }
        )

    return verify


def _in_blocks(log: DataFrame, base: int, above: DataFrame, height: int) -> DataFrame:
    """The log's nodes of `height` levels from `base`, by block, each block with the row above(grp, n, block, above, subroot, root)."""
    block = F.expr(f"idx div cast(pow({ARITY}, {base + height} - level) as long)")
    inner = (F.col("level") >= base) & (F.col("level") < base + height) & (F.col("n") > F.pow(F.lit(float(ARITY)), F.col("level")))
    nodes = log.where(inner).select("grp", "n", block.alias("block"), "pos", "hash")
    return nodes.unionByName(above, allowMissingColumns=True)


def paths(log: DataFrame, above: DataFrame, base: int, height: int = HEIGHT) -> DataFrame:
    """(grp, idx, path) of all nodes of level `base` in groups that have more than one, given the rows above their blocks."""
    members = log.where((F.col("level") == base) & (F.col("n") > ARITY**base)).select(F.col("grp").alias("grp"), "idx", F.expr(f"idx div {ARITY**height}").alias("block"))
    blocks = _in_blocks(log, base, above, height)
    found = members.groupBy("grp", "block").cogroup(blocks.groupBy("grp", "block"))
    return found.applyInArrow(_descend(base, height), f"grp string, idx long, path {PATH}")


@dataclass(frozen=True)
class Manifest:
    """Leaves (grp, n, idx, hash and their own columns), the groups' log, the log of the tree over the groups, and its leaves."""

    leaves: DataFrame
    log: DataFrame
    top_log: DataFrame
    groups: DataFrame
    height: int = HEIGHT

    def root(self) -> str | None:
        found = roots(self.top_log).first()
        return found.hash if found else None


def build(leaves: DataFrame, order: Sequence[str] = ("id", "hash"), height: int = HEIGHT) -> Manifest:
    """The manifest of ``leaves(grp, hash, ...)``, in each group in the given order."""
    placed = stage_table(numbered(leaves, order), "leaves")
    log = append_log(placed, height)
    tops = roots(log).select(F.lit("").alias("grp"), F.col("grp").alias("of"), F.col("n").alias("of_n"), "hash")
    groups = stage_table(numbered(tops, ["of"]), "groups")
    return Manifest(placed, log, append_log(groups, height), groups, height)


def _above_groups(made: Manifest) -> DataFrame:
    """(grp, n, above, subroot, root): the path from each group's root to the root of all."""
    nothing = F.array().cast(PATH)
    n = made.groups.agg(F.max("n")).first()[0] or 0
    found = made.groups.select("idx", F.col("of").alias("grp"), F.col("of_n").alias("n"), F.col("hash").alias("subroot"))
    if n <= 1:
        return found.select("grp", "n", nothing.alias("above"), "subroot", F.col("subroot").alias("root"))
    base, height = 0, made.height
    while ARITY ** (base + height) < n:
        base += height
    above = made.groups.limit(1).select(F.lit("").alias("grp"), "n", F.lit(0).cast("long").alias("block"), nothing.alias("above"))
    while True:
        reached = stage_table(paths(made.top_log, above, base, height), "paths")
        if base == 0:
            break
        base -= height
        above = reached.select("grp", F.lit(n).alias("n"), F.col("idx").alias("block"), F.col("path").alias("above"))
    joined = found.join(reached.select("idx", F.col("path").alias("above")), "idx")
    return joined.withColumn("root", F.lit(made.root())).select("grp", "n", "above", "subroot", "root")


def prove(made: Manifest) -> DataFrame:
    """One row per leaf: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The leaf ``shown`` of ``made.leaves`` is what somebody holds now; it is folded with the
    siblings that the log has, and verified if that gives the root. proof_sha256 is the
    digest of all siblings, level by level from the leaf to the root, left to right.
    """
    most = made.leaves.agg(F.max("n")).first()[0] or 0
    base, height = 0, made.height
    while ARITY ** (base + height) < most:
        base += height
    tops, reached = stage_table(_above_groups(made), "tops"), None
    while True:
        # A group begins where one block of builders holds all that is left of it.
        begins = (F.col("n") <= ARITY ** (base + height)) & ((F.col("n") > ARITY**base) if base else F.lit(True))
        above = tops.where(begins).select("grp", "n", F.lit(0).cast("long").alias("block"), "above", "subroot", "root")
        if reached is not None:
            larger = tops.where(F.col("n") > ARITY ** (base + height)).select("grp", "n", "subroot", "root")
            deeper = reached.withColumnsRenamed({"idx": "block", "path": "above"}).join(larger, "grp")
            above = above.unionByName(deeper)
        if base == 0:
            break
        reached = stage_table(paths(made.log, above, base, height), "paths")
        base -= height
    members = made.leaves.select("grp", "id", "idx", "hash", "shown", F.expr(f"idx div {ARITY**height}").alias("block"))
    found = members.groupBy("grp", "block").cogroup(_in_blocks(made.log, 0, above, height).groupBy("grp", "block"))
    kind = made.leaves.schema["id"].dataType.simpleString()
    return found.applyInArrow(
        _folder(height), f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )


def tampered(doc_id: Column) -> Column:
    """The rows that the check of the manifest changes: every third by the checksum of their id; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def document_leaves(docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(grp, id, hash, shown): the leaf of each row, and the leaf after tampering (A-Z of the text made small)."""
    small = F.translate(F.col(text_col), UPPER, LOWER)
    shown = [F.when(tampered(F.col(id_col)), small).otherwise(F.col(c)) if c == text_col else F.col(c) for c in columns]
    leaves = docs.select(
        group_key(F.col(group_col)).alias("grp"),
        F.col(id_col).alias("id"),
        leaf([F.col(c) for c in columns]).alias("hash"),
        leaf(shown).alias("shown"),
    )
    return stage_table(leaves, "digests")


def verify_documents(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The manifest of documents, and for each the proof of its row as it is after tampering: see `prove`."""
    proved = prove(build(document_leaves(docs), height=height))
    return proved.withColumnRenamed("id", "doc_id")
