"""Near copies among vectors: an exact range join by pivots.

Two vectors are linked if their cosine reaches a limit, which is to say that their unit
vectors are at most a certain distance apart. Pivots cut the space into cells: a vector
is at home in the cell of its nearest pivot. What is linked with it may be at home in
another cell, but the triangle inequality says in which not: a vector reaches a cell only
if the cell's pivot is no further than the cell's radius and the distance together, and
if it is near enough to the plane between both pivots. Of two cells one is sent the
other's vectors that reach it, and then each cell is joined by itself, in double precision.

Work is dealt out in bounded parts. A cell is cut into blocks, a block's visitors into
portions; a task holds one block and one portion, or two blocks of a cell. Members
within half the distance of their pivot are linked with each other without a comparison
(triangle inequality again), so a cell that a third of all vectors crowd into is counted,
not compared. Pivots that are too near to an earlier one are left out, so that such a
crowd has few cells. Equal vectors become one class before anything else. A task returns
numbers of links and a forest, never its pairs.

Which pivots are taken never changes the result. Vectors far from all others reach most
cells, as in any exact method in many dimensions; then the number of comparisons grows
with the square of the number of vectors, and what is sent with it divided by the size
of a cell.

Vectors that are null, empty, zero or hold null or non-finite components are linked
with nothing and are components by themselves. Vectors of different lengths aren't
linked. Rows with equal ids are vectors of their own. Ids may be null; a component of
null ids alone has a null id. Tables may be empty; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .batches import small_batches
from .components import connected

#: Vectors for which one more pivot is drawn, pivots and bytes of pivots at most.
CELL, PIVOTS, PIVOT_BYTES = 4096, 1024, 8 << 20
#: Vectors of a block, visitors of a portion, and bytes of either at most.
BLOCK, PORTION, PART_BYTES = 8192, 32768, 32 << 20
#: Distances are told apart if they differ by more than double precision may blur.
BLUR = 1e-9
FOUND = "id long, links long, a long, b long"


def usable(vector: Column) -> Column:
    """Whether the vector has a direction: finite components, not all zero."""
    value = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))


def unit(values: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled first, so that no square overflows or vanishes."""
    values = values.astype(np.float64)
    values /= np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of vectors that all have `size` components."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def choose_pivots(classes: DataFrame, reach: float, cell: int = CELL, most: int = PIVOTS) -> dict[int, np.ndarray]:
    """Pivots by vector length: vectors drawn by their hash, at most `most` and 8 MB, none within `reach` of an earlier one."""
    size = classes.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("wide")).first()
    if not size.n:
        return {}
    drawn = max(1, min(-(-size.n // cell), most, PIVOT_BYTES // (8 * size.wide)))
    rows = classes.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(drawn).collect()
    out: dict[int, list[np.ndarray]] = {}
    for r in rows:
        x = unit(np.array([r.vec], np.float64))[0]
        kept = out.setdefault(len(x), [])
        if not kept or distance(np.array(kept) @ x).min() > reach:
            kept.append(x)
    return {k: np.array(v) for k, v in out.items()}


def _at_home(pivots: dict[int, np.ndarray], reach: float):
    """Adds dims, cell, away (distance to the pivot) and reached [(cell, away)] to (id, n, vec)."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = {k: distance(p @ p.T) for k, p in pivots.items()}
        for batch in batches:
            sizes = batch["vec"].value_lengths().to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                own = pivots.get(size, np.eye(1, size))
                cosine = unit(matrix(part["vec"], size)) @ own.T
                home, every = cosine.argmax(axis=1), np.arange(len(own))
                apart = near.get(size, np.zeros((1, 1)))[home]
                gap = cosine.max(axis=1, keepdims=True) - cosine
                # Of two cells the one is sent the other's vectors; which one changes from pair to pair.
                turn = np.where((home[:, None] + every) % 2 == 0, every > home[:, None], every < home[:, None])
                row, cell = np.nonzero(turn & (gap <= reach * apart + BLUR))
                ends = np.searchsorted(row, np.arange(len(home) + 1)).astype(np.int32)
                away = distance(cosine)
                reached = pa.StructArray.from_arrays([pa.array(cell.astype(np.int32)), pa.array(away[row, cell])], ["cell", "away"])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part[c] for c in ("id", "n", "vec")),
                        pa.array(np.full(len(home), size, np.int32)),
                        pa.array(home.astype(np.int32)),
                        pa.array(away[np.arange(len(home)), home]),
                        pa.ListArray.from_arrays(pa.array(ends), reached),
                    ],
                    ["id", "n", "vec", "dims", "cell", "away", "reached"],
                )

    return assign


def _cells(home: DataFrame, block: int, portion: int) -> DataFrame:
    """One row per cell: its radius, its core, and how many blocks and portions it is dealt out to."""
    part = F.lit(PART_BYTES) / (F.col("dims") * 8)
    block_ = F.greatest(F.lit(1.0), F.least(F.lit(float(block)), part))
    portion_ = F.greatest(F.lit(1.0), F.least(F.lit(float(portion)), part))
    members = home.groupBy("dims", "cell").agg(
        F.max("away").alias("radius"),
        F.count_if("core").alias("cores"),
        F.count_if(~F.col("core")).alias("others"),
        F.coalesce(F.sum(F.when(F.col("core"), F.col("n"))), F.lit(0)).alias("core_n"),
        F.min(F.when(F.col("core"), F.col("id"))).alias("core_id"),
    )
    visits = home.select("dims", F.explode("reached.cell").alias("cell")).groupBy("dims", "cell").agg(F.count("*").alias("visits"))
    cells = members.join(visits, ["dims", "cell"], "left").withColumn("visits", F.coalesce("visits", F.lit(0)) + F.col("others"))
    # A cell that fits one block has no block for its core alone.
    small = F.col("cores") + F.col("others") <= block_
    return cells.select(
        "dims",
        "cell",
        "radius",
        "core_n",
        "core_id",
        F.when(small, 0).otherwise(F.ceil(F.col("cores") / block_)).cast("int").alias("core_blocks"),
        F.when(small, 1).otherwise(F.ceil(F.col("others") / block_)).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("visits") / portion_)).cast("int").alias("portions"),
    )


def _parts(home: DataFrame, cells: DataFrame, reach: float) -> DataFrame:
    """The rows of each task: (dims, cell, block, portion), whether the row is of the cell's core or a visitor, id, node, n, vec."""
    draw = F.xxhash64("id")
    core_block = F.pmod(draw, F.greatest(F.col("core_blocks"), F.lit(1)))
    other_block = F.col("core_blocks") + F.pmod(draw, F.greatest(F.col("blocks"), F.lit(1)))
    apart = F.col("core") & (F.col("core_blocks") > 0)
    own = home.join(F.broadcast(cells), ["dims", "cell"]).withColumn("block", F.when(apart, core_block).otherwise(other_block).cast("int"))
    row = ["dims", "cell", "block", "portion", "core", "visitor", "id", "node", "n", "vec"]
    at_home = own.withColumn("portion", F.explode(F.sequence(F.lit(0), F.col("portions") - 1)))
    at_home = at_home.select(*row[:5], F.lit(False).alias("visitor"), *row[6:])
    visiting = lambda df: df.select(
        *row[:3],
        F.pmod(F.xxhash64("id", "block"), F.col("portions")).cast("int").alias("portion"),
        F.lit(False).alias("core"),
        F.lit(True).alias("visitor"),
        *row[6:],
    )
    # Inside a cell: from each block to the ones before it; core members need not meet.
    inside = own.where(~F.col("core") & (F.col("block") > 0)).withColumn("block", F.explode(F.expr("sequence(0, block - 1)")))
    sent = home.select("dims", "id", "node", "n", "vec", F.inline("reached")).join(F.broadcast(cells), ["dims", "cell"])
    sent = sent.where(F.col("away") <= F.col("radius") + reach + BLUR)
    sent = sent.withColumn("block", F.explode(F.expr("sequence(0, core_blocks + blocks - 1)")))
    return at_home.union(visiting(inside)).union(visiting(sent))


class _Forest:
    """Union-find over numbered nodes."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, nodes: list[int]) -> None:
        tops = {self.top(x) for x in nodes}
        least = min(tops)
        for x in tops:
            self.up[x] = least


def _join_cell(limit: float, rows: int = 1024):
    """Links of one block with itself and with one portion of its visitors."""

    def links(part: pa.Table) -> pa.Table:
        dims = part["dims"][0].as_py()
        visitor = part["visitor"].to_numpy()
        x = unit(matrix(part["vec"], dims))
        ids, n, nodes, core = (part[c].to_numpy() for c in ("id", "n", "node", "core"))
        here, there = np.flatnonzero(~visitor), np.flatnonzero(visitor)
        names, label = np.unique(nodes, return_inverse=True)
        total, forest = np.zeros(len(ids), np.int64), _Forest(len(names))

        def compare(who: np.ndarray, later: bool) -> None:
            for k in range(0, len(who), rows):
                some = who[k : k + rows]
                hit = x[some] @ x[here].T >= limit
                if later:
                    hit &= np.arange(len(here)) > k + np.arange(len(some))[:, None]
                    # Linked without a comparison, and counted so.
                    hit &= ~(core[some][:, None] & core[here])
                total[some] += hit @ n[here]
                total[here] += n[some] @ hit
                for r in np.flatnonzero(hit.any(axis=1)):
                    forest.join([label[some[r]], *np.unique(label[here[hit[r]]]).tolist()])

        if part["portion"][0].as_py() == 0 and not core[here].all():
            compare(here, True)
        compare(there, False)
        counted = np.flatnonzero(total)
        tops = np.array([forest.top(k) for k in range(len(names))], np.int64)
        moved = np.flatnonzero(tops != np.arange(len(names)))
        none = lambda k: pa.nulls(k, pa.int64())
        return pa.table(
            {
                "id": pa.chunked_array([pa.array(ids[counted]), none(len(moved))]),
                "links": pa.chunked_array([pa.array(total[counted]), none(len(moved))]),
                "a": pa.chunked_array([none(len(counted)), pa.array(names[moved])]),
                "b": pa.chunked_array([none(len(counted)), pa.array(names[tops[moved]])]),
            }
        )

    return links


def near_vectors(
    df: DataFrame,
    limit: float = 0.95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cell: int = CELL,
    pivots: int = PIVOTS,
    block: int = BLOCK,
    portion: int = PORTION,
) -> DataFrame:
    """One row per row of `df`: id, n_links, component_id, kept.

    n_links is the number of other vectors whose cosine with it is `limit` or more (copies
    each count), component_id the smallest id that links lead to, kept whether it is its own.
    """
    reach = math.sqrt(2.0 - 2.0 * limit)
    rows = df.select(F.col(id_col).alias("own"), F.when(usable(F.col(vector_col)), F.col(vector_col)).alias("vec"))
    held = rows.where("vec is not null").groupBy("vec").agg(F.min("own").alias("least"), F.count("*").alias("n"))
    classes = stage_table(held.withColumn("id", F.monotonically_increasing_id()), "vectors")
    drawn = choose_pivots(classes, reach, cell, pivots)

    kind = classes.schema["vec"].dataType.simpleString()
    schema = f"id long, n long, vec {kind}, dims int, cell int, away double, reached array<struct<cell:int,away:double>>"
    home = small_batches(classes).select("id", "n", "vec").mapInArrow(_at_home(drawn, reach), schema)
    home = stage_table(home.withColumn("core", F.col("away") <= reach / 2 - BLUR), "cells")
    # One row per pivot.
    cells = stage_table(_cells(home, block, portion), "pivots")
    heads = F.broadcast(cells.select("dims", "cell", "core_n", "core_id"))
    placed = home.join(heads, ["dims", "cell"]).withColumn("node", F.when(F.col("core"), F.col("core_id")).otherwise(F.col("id")))

    parts = _parts(placed.drop("core_n", "core_id"), cells, reach)
    found = parts.groupBy("dims", "cell", "block", "portion").applyInArrow(_join_cell(limit), FOUND)
    found = stage_table(found, "found")
    counts = found.where("id is not null").groupBy("id").agg(F.sum("links").alias("links"))
    ends = connected(found.where("a is not null").select("a", "b"))

    sure = F.when(F.col("core"), F.col("core_n")).otherwise(F.col("n")) - 1
    told = placed.select("id", "node", sure.alias("sure")).join(counts, "id", "left").join(ends, "node", "left")
    told = told.select("id", (F.col("sure") + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root"))
    told = stage_table(told.join(classes.select("id", "least"), "id"), "classes")
    least = told.groupBy("root").agg(F.min("least").alias("component_id"))
    told = told.join(least, "root").select("id", "n_links", "component_id")

    named = classes.select("vec", "id").join(told, "id").select("vec", "n_links", "component_id")
    out = rows.join(named, "vec", "left")
    component = F.when(F.col("n_links").isNull(), F.col("own")).otherwise(F.col("component_id"))
    return out.select(
        F.col("own").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("own").eqNullSafe(component).alias("kept"),
    )
