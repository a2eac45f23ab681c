"""Near-duplicate documents by HyperMinHash.

A document's word shingles fall into buckets. A bucket keeps, of its smallest hash,
the number of leading zeros and a few mantissa bits (16 bits in all). Bands of
these registers find candidates; the registers' share of matches, corrected for
chance collisions, estimates the similarity; what may pass is verified on the full
shingle sets. No bucket's pairs are all formed: see ``near_duplicates``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table
from .batches import small_batches
from .components import connected
from .names import fresh
from .words import U64, mix, pieces, runs, seeds, strings, word_hashes

MANTISSA = 10
BITS = 48  # of a hash that the leading zeros are counted in
ROWS = 6  # registers in a band
BLOCK = 1024  # members of a cluster that one task compares with as many
BLOCK_BYTES = 16 << 20  # of their sets


class Shape:
    """Numbers of bands and registers for a threshold (percent of the union)."""

    def __init__(self, percent: int, words: int, miss: float = 1e-6):
        self.percent, self.words = percent, words
        self.bands = math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** ROWS))
        self.registers = self.bands * ROWS
        #: Registers of a band are spread, so that neighbours' filled-in values don't share one.
        self.order = np.argsort(seeds(self.registers, 3), kind="stable").reshape(self.bands, ROWS)


# --- signatures ---------------------------------------------------------------


def shingle_sets(texts: pa.Array, lo: int, hi: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of rows lo to hi, one after another, and each row's first."""
    hashes, first = word_hashes(texts, lo, hi)
    grams, at = runs(hashes, first, words)
    for a, b in zip(at[:-1], at[1:]):
        grams[a:b].sort()
    new = np.ones(len(grams), bool)
    new[1:] = grams[1:] != grams[:-1]
    new[at[:-1][at[:-1] < len(grams)]] = True
    return grams[new], np.concatenate([[0], np.cumsum(new)])[at]


def registers(grams: np.ndarray, at: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows x m compressed registers, which of them hold an own value).

    An empty register copies another one of its row, found by a fixed sequence of
    probes, so that the chance of a match stays the similarity for short texts.
    """
    rows = len(at) - 1
    doc = np.repeat(np.arange(rows), np.diff(at))
    scrambled = mix(grams ^ U64(0x5851F42D4C957F2D))
    bucket = ((scrambled & U64(0xFFFF)) * U64(m) >> U64(16)).astype(np.int64)
    least = np.full(rows * m, np.iinfo(np.uint64).max, U64)
    np.minimum.at(least, doc * m + bucket, scrambled >> U64(16))
    least = least.reshape(rows, m)
    own = least != np.iinfo(np.uint64).max
    part, exponent = np.frexp(np.where(own, least, 1).astype(np.float64))
    zeros = (BITS - exponent).astype(np.uint16)
    tail = ((part - 0.5) * (2 << MANTISSA)).astype(np.uint16)
    out = (zeros << np.uint16(MANTISSA)) | tail
    r, c = np.nonzero(~own & own.any(axis=1)[:, None])
    for probe in range(64 * m):
        if not len(r):
            break
        to = (mix(c.astype(U64) + U64(probe + 1) * U64(m)) % U64(m)).astype(np.int64)
        found = own[r, to]
        out[r[found], c[found]] = out[r[found], to[found]]
        r, c = r[~found], c[~found]
    return out, own


def band_keys(regs: np.ndarray, shape: Shape) -> np.ndarray:
    """One key per band; a key names its band."""
    cut = regs[:, shape.order].astype(U64)
    weight = seeds(shape.registers, 11).reshape(shape.bands, ROWS)
    return mix((cut * weight).sum(axis=2, dtype=U64) + seeds(shape.bands, 13))


def set_ids(grams: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that name a set; 0 for the empty set."""
    n = np.diff(at)
    full = n > 0
    out = []
    for salt in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
        total = np.zeros(len(n), U64)
        if full.any():
            total[full] = np.add.reduceat(mix(grams ^ U64(salt)), at[:-1][full])
        out.append(np.where(full, mix(total + n.astype(U64)), U64(0)))
    return out[0], out[1]


# --- estimate and verification ---------------------------------------------------


@cache
def _chance() -> tuple[np.ndarray, np.ndarray]:
    """Chance that registers of unrelated sets agree, over pairs of log2 loads (values per bucket)."""
    loads = np.arange(-8, 25)
    edges = [np.zeros(1)]
    for zeros in range(BITS, -1, -1):
        low = 2.0 ** -(zeros + 1)
        edges.append(low * (1 + np.arange(1, (1 << MANTISSA) + 1) / (1 << MANTISSA)))
    cut = np.concatenate(edges)
    alive = np.exp(-np.outer(2.0**loads, cut))
    cell = alive[:, :-1] - alive[:, 1:]
    filled = 1 - np.exp(-(2.0**loads))
    return loads, (cell @ cell.T) / np.outer(filled, filled)


def estimate(match: np.ndarray, filled: np.ndarray, n1: np.ndarray, n2: np.ndarray, m: int) -> np.ndarray:
    """Similarity from the number of agreeing registers, less the agreements due to chance."""
    loads, chance = _chance()
    at = [np.clip(np.rint(np.log2(np.maximum(n, 1) / m)).astype(int) - loads[0], 0, len(loads) - 1) for n in (n1, n2)]
    luck = chance[at[0], at[1]]
    share = match / np.maximum(filled, 1)
    return np.clip((share - luck) / (1 - luck), 0, 1)


def may_pass(regs1, regs2, own1, own2, n1, n2, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """(estimate, whether the pair can reach the threshold) along the last axis.

    Four deviations below the threshold still pass. The ratio of the sizes is exact.
    """
    own = own1 | own2
    filled = own.sum(axis=-1)
    match = ((regs1 == regs2) & own).sum(axis=-1)
    value = estimate(match, filled, n1, n2, shape.registers)
    t = shape.percent / 100
    slack = 4 * np.sqrt(t * (1 - t) / np.maximum(filled, 1))
    sizes = 100 * np.minimum(n1, n2) >= shape.percent * np.maximum(n1, n2)
    return value, sizes & (value >= t - slack)


def linked(set1: np.ndarray, set2: np.ndarray, percent: int) -> bool:
    """Exact: percent * union <= 100 * intersection."""
    both = np.concatenate([set1, set2])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


# --- Arrow functions -------------------------------------------------------------


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _blobs(rows) -> pa.Array:
    return pa.array([np.ascontiguousarray(r).tobytes() for r in rows], pa.binary())


SIGNATURE = "doc_id long, text_hash long, set_id long, set_id2 long, n_shingles long, bands array<long>"
FULL_SET = "set_id long, n long, regs binary, own binary, grams binary"


def _signatures(shape: Shape):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("set_id", pa.int64()), ("set_id2", pa.int64()),
         ("n_shingles", pa.int64()), ("bands", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = strings(batch.column("text"))
            for lo, hi in pieces(texts):
                grams, at = shingle_sets(texts, lo, hi, shape.words)
                regs, _ = registers(grams, at, shape.registers)
                one, two = set_ids(grams, at)
                n = np.diff(at)
                keys = _signed(band_keys(regs, shape)[n > 0]).ravel()
                ends = np.concatenate([[0], np.cumsum(np.where(n > 0, shape.bands, 0))]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys))
                head = [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_hash")]
                columns = [*head, _signed(one), _signed(two), n.astype(np.int64), bands]
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], schema=schema)

    return run


def _full_sets(shape: Shape):
    schema = pa.schema([("set_id", pa.int64()), ("n", pa.int64()), ("regs", pa.binary()), ("own", pa.binary()), ("grams", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = strings(batch.column("text"))
            for lo, hi in pieces(texts):
                grams, at = shingle_sets(texts, lo, hi, shape.words)
                regs, own = registers(grams, at, shape.registers)
                one, _ = set_ids(grams, at)
                sets = _blobs(grams[a:b] for a, b in zip(at[:-1], at[1:]))
                columns = [pa.array(_signed(one)), pa.array(np.diff(at).astype(np.int64)), _blobs(regs), _blobs(np.packbits(own, axis=1)), sets]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _rows(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _verify(shape: Shape):
    """Pairs with both sides' registers and sets -> the links among them."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            if batch.num_rows:
                side = lambda k: (
                    _rows(batch.column(f"regs_{k}"), np.uint16, shape.registers),
                    _bits(batch.column(f"own_{k}"), shape.registers),
                    batch.column(f"n_{k}").to_numpy(),
                )
                (r1, o1, n1), (r2, o2, n2) = side("a"), side("b")
                _, keep = may_pass(r1, r2, o1, o2, n1, n2, shape)
                one, two = batch.column("grams_a"), batch.column("grams_b")
                for i in np.flatnonzero(keep).tolist():
                    keep[i] = linked(np.frombuffer(one[i].as_buffer(), U64), np.frombuffer(two[i].as_buffer(), U64), shape.percent)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], schema=schema).filter(pa.array(keep))

    return run


def common_counts(one: list[np.ndarray], two: list[np.ndarray], wide: int = 2048) -> np.ndarray:
    """Sizes of all intersections of the sets in `one` with those in `two`, exact.

    Over the values that both sides hold, 0/1 matrices are multiplied slice by slice.
    """
    sides = []
    for sets in (one, two):
        sides.append((np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])))
    both = np.intersect1d(np.unique(sides[0][0]), np.unique(sides[1][0]), assume_unique=True)
    out = np.zeros((len(one), len(two)), np.int64)
    if not len(both):
        return out
    placed = []
    for values, row in sides:
        at = np.minimum(np.searchsorted(both, values), len(both) - 1)
        there = both[at] == values
        at, row = at[there], row[there]
        order = np.argsort(at, kind="stable")
        placed.append((at[order], row[order]))
    for low in range(0, len(both), wide):
        parts = []
        for (at, row), n in zip(placed, out.shape):
            a, b = np.searchsorted(at, [low, low + wide])
            part = np.zeros((n, min(wide, len(both) - low)), np.float32)
            part[row[a:b], at[a:b] - low] = 1
            parts.append(part)
        out += np.rint(parts[0] @ parts[1].T).astype(np.int64)
    return out


def forest(ids, comps, left, right, regs, own, n, sets, shape: Shape) -> list[tuple[int, int]]:
    """Links between members of different components, left ones with right ones, without cycles.

    The estimate rules pairs out; the rest is verified on the full sets.
    """
    lefts, rights = np.flatnonzero(left), np.flatnonzero(right)
    passing = np.zeros((len(lefts), len(rights)), bool)
    for k, x in enumerate(lefts.tolist()):
        other = comps[rights] != comps[x]
        if other.any():
            y = rights[other]
            passing[k, other] = may_pass(regs[x], regs[y], own[x], own[y], n[x], n[y], shape)[1]
    rows, cols = np.flatnonzero(passing.any(axis=1)), np.flatnonzero(passing.any(axis=0))
    if not len(rows):
        return []
    lefts, rights, passing = lefts[rows], rights[cols], passing[np.ix_(rows, cols)]
    common = common_counts([sets[x] for x in lefts], [sets[y] for y in rights])
    union = n[lefts][:, None] + n[rights][None, :] - common
    passing &= 100 * common >= shape.percent * union
    parent: dict[int, int] = {}

    def root(c):
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    out = []
    for k, x in enumerate(lefts.tolist()):
        ys = rights[passing[k]]
        _, one_each = np.unique(comps[ys], return_index=True)
        for y in ys[one_each].tolist():
            p, q = root(int(comps[x])), root(int(comps[y]))
            if p != q:
                parent[max(p, q)] = min(p, q)
                out.append((min(int(ids[x]), int(ids[y])), max(int(ids[x]), int(ids[y]))))
    return out


def _cross(shape: Shape):
    """Rows sorted by (cluster, i, j): the left members of a block meet the right ones -> links."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        keys = _keys(table)
        for s in np.split(np.arange(len(keys)), np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1):
            part = table.slice(int(s[0]), len(s))
            col = {c: part.column(c).to_numpy(zero_copy_only=False) if isinstance(part.column(c), pa.Array) else part.column(c).to_numpy() for c in ("set_id", "comp", "left", "right", "n")}
            regs = _rows(part.column("regs"), np.uint16, shape.registers)
            own = _bits(part.column("own"), shape.registers)
            sets = [np.frombuffer(x, U64) for x in part.column("grams").to_pylist()]
            found = forest(col["set_id"], col["comp"], col["left"], col["right"], regs, own, col["n"], sets, shape)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            # A group may go on in the next batch: its rows are held until it has ended.
            keys = _keys(batch)
            if held and (keys[0] != last).any():
                yield from links(held)
                held = []
            change = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            if len(change):
                yield from links([*held, batch.slice(0, int(change[-1]))])
                held = [batch.slice(int(change[-1]))]
            else:
                held.append(batch)
            last = keys[-1]
        if held:
            yield from links(held)

    return run


def _keys(rows) -> np.ndarray:
    return np.column_stack([rows.column(c).to_numpy() for c in ("cluster", "i", "j")])


def _bits(column, m: int) -> np.ndarray:
    return np.unpackbits(_rows(column, np.uint8, (m + 7) // 8), axis=1, count=m).astype(bool)


# --- the operator ------------------------------------------------------------------


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id, kept, group_id.

    1. Signatures. Equal sets are one class from here on, so copies cost one row each.
    2. Each band key's members are paired with its least and greatest member only.
       Estimate, then verification on the full sets, then components.
    3. Keys of four or more members that are still in different components make
       clusters of documents. In a cluster, blocks of the members outside its largest
       component meet blocks of all its members; the estimate rules pairs out, the rest
       is verified on the full sets. A task gives links without cycles, so no pair list
       grows with the square of a group.

    So every pair that shares a band key is either verified, ruled out by the
    estimate (four deviations below the threshold), or already connected.

    Empty and null texts are linked with nothing and kept. Rows with the same id stay
    separate rows. A set is known by 64 bits of a hash of its shingles, which two of 10^9
    different sets share with a chance of some percent. A null id is never a component's label unless nothing else is in it
    (then component_id is null and kept is true). group_id names the component where
    ids can't; it is null for empty texts. No rows give no rows. Other columns of
    ``docs`` are not looked at.
    """
    shape = Shape(percent, words)
    plain = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    plain = plain.withColumn("text_hash", F.xxhash64("text"))
    rows = stage_table(plain.mapInArrow(_signatures(shape), SIGNATURE), "signatures")

    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "bands")
    classes = rows.where("n_shingles > 0").groupBy("set_id", "set_id2").agg(F.min(first).alias("f"))
    classes = classes.select("set_id", "f.doc_id", "f.text_hash", "f.bands")
    members = stage_table(classes.select("set_id", "doc_id", "text_hash", F.explode("bands").alias("key")), "bands")
    shared = (
        members.groupBy("key").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high"), F.count("*").alias("size")).where("low < high")
    )
    members = stage_table(members.join(shared, "key"), "members")

    pairs = members.select("set_id", F.explode(F.array("low", "high")).alias("to")).where("set_id <> to")
    pairs = stage_table(pairs.select(F.least("set_id", "to").alias("a"), F.greatest("set_id", "to").alias("b")).distinct(), "pairs")

    wanted = members.select("set_id", "doc_id", "text_hash").distinct().select("doc_id", "text_hash")
    own = plain.join(wanted.distinct(), plain.doc_id.eqNullSafe(wanted.doc_id) & (plain.text_hash == wanted.text_hash), "left_semi")
    sets = own.select("text").mapInArrow(_full_sets(shape), FULL_SET)
    sets = stage_table(sets, "sets").dropDuplicates(["set_id"])
    sets = stage_table(sets, "sets")

    links = stage_table(_verified(pairs, sets, shape), "found")
    labels = stage_table(connected(links), "labels")
    rest = _unsettled(members, labels, sets)
    links = stage_table(links.union(rest.mapInArrow(_cross(shape), "a long, b long")), "found")
    labels = stage_table(connected(links), "labels")
    return _result(rows, classes.select("set_id", "doc_id"), labels)


def _verified(pairs: DataFrame, sets: DataFrame, shape: Shape) -> DataFrame:
    side = lambda k: sets.select([F.col(c).alias(f"{c}_{k}") for c in ("set_id", "n", "regs", "own", "grams")])
    both = pairs.join(side("a"), F.col("a") == F.col("set_id_a")).join(side("b"), F.col("b") == F.col("set_id_b"))
    return both.drop("set_id_a", "set_id_b").mapInArrow(_verify(shape), "a long, b long")


def _unsettled(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of the blocks in which members of still separate components meet."""
    named = members.where("size > 3").join(labels, members.set_id == labels.node, "left")
    named = named.select("key", "set_id", F.coalesce("root", "set_id").alias("comp"))
    apart = named.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.min("set_id").alias("head")).where("c1 < c2")
    named = stage_table(named.join(apart.select("key", "head"), "key").select("set_id", "comp", "head"), "apart")
    clusters = connected(named.select(F.col("set_id").alias("a"), F.col("head").alias("b")).distinct())
    member = named.select("set_id", "comp").distinct().join(clusters, F.col("set_id") == F.col("node"))
    rows = stage_table(member.select(F.col("root").alias("cluster"), "set_id", "comp").join(sets, "set_id"), "clusters")

    parts = rows.groupBy("cluster", "comp").agg(F.count("*").alias("n"), F.sum(F.length("grams")).alias("bytes"))
    whole = parts.groupBy("cluster").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("bytes") / BLOCK_BYTES))
    whole = whole.select(F.col("cluster").alias("c"), F.col("top.comp").alias("largest"), blocks.alias("blocks"))
    at = rows.join(whole, F.col("cluster") == F.col("c")).withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    # All are right members of their block, in each (i, own); those outside the largest component left ones in each (own, j).
    ends = [
        at.select("*", F.explode(every).alias("i"), F.col("block").alias("j"), F.lit(False).alias("left"), F.lit(True).alias("right")),
        at.where("comp <> largest").select("*", F.col("block").alias("i"), F.explode(every).alias("j"), F.lit(True).alias("left"), F.lit(False).alias("right")),
    ]
    both = ends[0].union(ends[1]).repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return both.select("cluster", "i", "j", "set_id", "comp", "left", "right", "n", "regs", "own", "grams")


def _result(rows: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    named = classes.join(labels, classes.set_id == labels.node, "left").select("set_id", "doc_id", F.coalesce("root", "set_id").alias("root"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = stage_table(named.join(least, "root").select("set_id", "component_id", "root"), "classes")
    out = rows.select("doc_id", "text_hash", "n_shingles", "set_id").join(named.withColumnRenamed("set_id", "cid"), F.col("set_id") == F.col("cid"), "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), F.col("root").alias("group_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    )


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without all but one of each group of near copies; all columns stay.

    The row with the smallest id stays (null ids last, then by the text's hash); of rows
    that agree in id and text any one. Empty and null texts are in no group and all stay.
    """
    found = near_duplicates(docs, words, percent, id_col, text_col)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("f")
    chosen = found.where("group_id is not null").groupBy("group_id").agg(first).select("f.doc_id", "f.text_hash", F.lit(True).alias("_one"))
    empty = found.where("group_id is null").select("doc_id", "text_hash", F.lit(False).alias("_one")).distinct()
    ids, hashes, one, nth = fresh(docs, "_id", "_hash", "_one", "_nth")
    stay = chosen.distinct().union(empty).select(F.col("doc_id").alias(ids), F.col("text_hash").alias(hashes), F.col("_one").alias(one))
    own_id, own_hash = F.col(f"`{id_col}`").cast("long"), F.xxhash64(F.col(f"`{text_col}`"))
    kept = docs.join(stay, own_id.eqNullSafe(F.col(ids)) & (own_hash == F.col(hashes)))
    # Rows that agree in id and text meet here; they are one document.
    number = F.row_number().over(Window.partitionBy(ids, hashes).orderBy(F.lit(0)))
    kept = kept.withColumn(nth, number).where(~F.col(one) | (F.col(nth) == 1))
    return kept.select([F.col(f"`{c}`") for c in docs.columns])
