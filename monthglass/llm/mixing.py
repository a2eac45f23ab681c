"""Mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size is the number of copies each of its documents
should get; the whole part is given, the fraction is a probability. Pairs of
documents of one source pass probability mass between them, weighed by their sizes,
until one of the two is 0 or 1; so the expected number of words stays the same at
each step. Blocks of documents are rounded where they are; each block leaves one
document at most with a fraction, and these meet in the blocks of the next level.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table
from .batches import small_batches
from .names import fresh
from .words import U64, mix

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 4096  # documents, expected, in a block of the first level
FAN = 256  # blocks that meet in one of the next level


def word_count(text) -> F.Column:
    """Number of words of a text column; null has none."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    inner = F.trim(spaced)
    gaps = F.length(inner) - F.length(F.replace(inner, F.lit(" "), F.lit("")))
    return F.when(inner == "", F.lit(0)).otherwise(gaps + 1).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), total: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target for ``sizes(source, size)``.

    Sources by code point, null last, take the weights in turn and share ``total``
    times all sizes. A target stops at ``most`` times its source's size; the excess is
    shared by weight among the rest until none is above. With sources in order of
    limit per weight, those at their limit come first; the others share what is left.
    One row per source is ordered here, whatever the number of documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_turn = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(in_turn) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.lit(float(total)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(from_here)
    per = per.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") >= F.col("limit"))
    # The first source below its limit has the level of all that are; later sources' own figures are lower.
    open_level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return per.select(
        "source", "source_size", F.when(F.col("full") | open_level.isNull(), F.col("limit")).otherwise(open_level * F.col("weight")).alias("target")
    )


def pivot(ids: np.ndarray, masses: np.ndarray, parts: np.ndarray, seed: int) -> np.ndarray:
    """Fractions after pairwise rounding in the order given; one at most stays fractional.

    A draw depends on an id and the seed alone, so that a rerun ends alike.
    """
    out = parts.copy()
    draws = (mix(ids.astype(np.int64).view(U64) ^ mix(U64(seed + 1))) >> U64(11)).astype(np.float64) / float(1 << 53)
    i = None
    for j in np.flatnonzero((out > 0) & (out < 1)).tolist():
        if i is None:
            i = j
            continue
        p, q, a, b = out[i], out[j], masses[i], masses[j]
        # What i can gain from j, and lose to it, in words.
        up, down = min((1 - p) * a, q * b), min(p * a, (1 - q) * b)
        if draws[j] * (up + down) < down:
            out[i] = 1.0 if up == (1 - p) * a else p + up / a
            out[j] = 0.0 if up == q * b else q - up / b
        else:
            out[i] = 0.0 if down == p * a else p - down / a
            out[j] = 1.0 if down == (1 - q) * b else q + down / b
        i = next((k for k in (i, j) if 0 < out[k] < 1), None)
    return out


UNIT = "source string, block long, blocks long, unit long, doc_id long, text_hash long, mass double, base long, part double"


def _level(seed: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["unit", "doc_id", "mass"], kind="stable", ignore_index=True)
        group["part"] = pivot(group["unit"].to_numpy(), group["mass"].to_numpy(), group["part"].to_numpy(), seed)
        return group

    return run


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    total: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """doc_id, text_hash, source, size, source_size, target, copies, taken: one row per document.

    A source's taken words differ from its target by one document at most. Rows that
    agree in id, text and source are rounded as one and get the same number of copies.
    Texts without words have size 0 and get the whole part of their source's share;
    null sources are one source, the last; a null id is an id like others. A source
    without words has target 0 and its documents no copies. No rows give no rows.
    """
    rows = small_batches(docs).select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
    )
    rows = stage_table(rows, "sizes")
    targets = stage_table(source_targets(rows, weights, total, most), "targets")
    units = rows.groupBy("doc_id", "text_hash", "source").agg((F.count("*") * F.max("size")).cast("double").alias("mass"))
    counts = units.groupBy(F.col("source").alias("s")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    about = targets.join(counts, targets.source.eqNullSafe(counts.s)).select(F.col("source").alias("s"), "blocks", share.alias("share"))
    unit = F.xxhash64("doc_id", "text_hash", "source")
    state = units.join(about, units.source.eqNullSafe(about.s)).select(
        "source",
        F.pmod(F.xxhash64(unit), F.col("blocks")).alias("block"),
        "blocks",
        unit.alias("unit"),
        "doc_id",
        "text_hash",
        "mass",
        F.floor("share").alias("base"),
        F.when(F.col("mass") > 0, F.col("share") - F.floor("share")).otherwise(0.0).alias("part"),
    )
    decided, level = None, 0
    while True:
        state = stage_table(state.groupBy("source", "block").applyInPandas(_level(seed + level), UNIT), "level")
        open_ = (F.col("part") > 0) & (F.col("part") < 1)
        decided = state.where(~open_) if decided is None else decided.union(state.where(~open_))
        state = state.where(open_)
        if state.where("blocks > 1").isEmpty():
            break
        level += 1
        state = state.withColumn("block", F.floor(F.col("block") / FAN)).withColumn("blocks", F.ceil(F.col("blocks") / FAN))
    # One document of a source may be left: its draw decides.
    draw = F.pmod(F.xxhash64("unit", F.lit(seed + level + 1)), F.lit(1 << 30)) / float(1 << 30)
    decided = decided.union(state.withColumn("part", (draw < F.col("part")).cast("double")))
    copies = decided.select(
        F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("source").alias("s"), (F.col("base") + F.col("part")).cast("long").alias("copies")
    )
    same = rows.doc_id.eqNullSafe(copies.d) & (rows.text_hash == copies.h) & rows.source.eqNullSafe(copies.s)
    out = rows.join(copies, same).drop("d", "h", "s")
    names = targets.select(F.col("source").alias("s"), "source_size", "target")
    out = out.join(names, out.source.eqNullSafe(names.s)).drop("s")
    return out.select("doc_id", "text_hash", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, numbered from 1 in ``copy`` (replaced if there)."""
    mixed = mix_sources(docs, id_col=id_col, text_col=text_col, source_col=source_col, **settings)
    ids, hashes, source, number = fresh(docs, "_id", "_hash", "_source", "_copies")
    mixed = mixed.where("copies > 0").select(
        F.col("doc_id").alias(ids), F.col("text_hash").alias(hashes), F.col("source").alias(source), F.col("copies").alias(number)
    )
    same = (
        F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(ids))
        & (F.xxhash64(F.col(f"`{text_col}`")) == F.col(hashes))
        & F.col(f"`{source_col}`").cast("string").eqNullSafe(F.col(source))
    )
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "copy"]
    return docs.join(mixed.distinct(), same).select(*kept, F.explode(F.sequence(F.lit(1).cast("long"), F.col(number))).alias("copy"))
