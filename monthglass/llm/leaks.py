"""Benchmark passages inside documents: random-walk embedding, bit sampling, exact edit distance.

The walk reads a word sequence: at step j it writes down the word it stands on and
goes on by one word or not, as a random bit of (j, word) says. Sequences that differ
by few edits walk apart at an edit and fall into step again, so their embeddings
differ in few places. A hash function samples a few steps of an item's embedding;
a window of a text collides if its walk shows the same words at these steps. Walks
depend on what lies ahead only, so a text's walks are started at its words that a
function has for its first sampled step; most of them end there.

Each collision gives a window of the item's size, a little longer at both ends, and
the item's edit distance to its best part is worked out in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .batches import small_batches
from .names import fresh
from .words import SYMBOLS, U64, mix, pieces, strings, word_hashes

SAMPLED = 3  # steps in a hash function
SPAN = 16  # steps that they lie within
TRIED = (64, 256)  # functions per item with which a length class is measured, until it reaches the target recall
PIECES = -1  # in place of a number of functions: one for each piece of the item, which leaves out nothing
ITEM_WORDS = 2_000_000  # words of the items that are compared with the texts in one pass
MEET = 1 << 17  # walks followed at a time
WALKED = 1 << 22  # steps of an item's walks that are held at a time


def _bit(seed: np.ndarray, step: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (mix(word ^ mix(seed * U64(1 << 20) + step)) & U64(1)).astype(np.int64)


def walks(words: np.ndarray, seeds: np.ndarray, steps: int) -> np.ndarray:
    """(steps, walks): place of each seed's walk at each step; len(words) after its end.

    Only the bit of the word stood on is taken at a step.
    """
    out = np.full((steps, len(seeds)), len(words), np.int64)
    at = np.zeros(len(seeds), np.int64)
    for j in range(steps if len(words) else 0):
        out[j] = at
        inside = at < len(words)
        if not inside.any():
            break
        at = at + inside * _bit(seeds, U64(j), words[np.minimum(at, len(words) - 1)])
    return out


def embed(words: np.ndarray, seed: int, steps: int) -> np.ndarray:
    """Place of the walk at each step; len(words) after its end."""
    return walks(words, np.array([seed], U64), steps)[:, 0]


@dataclass
class Functions:
    """Hash functions of all items, ordered by the word of their first sampled step."""

    anchor: np.ndarray  # word of the first step
    item: np.ndarray
    seed: np.ndarray
    step: np.ndarray  # number of the first step
    place: np.ndarray  # item place of the first step
    later: np.ndarray  # (functions, SAMPLED - 1) steps after the first one, -1: none
    words: np.ndarray  # the item's words there

    def __post_init__(self):
        order = np.argsort(self.anchor, kind="stable")
        for name in ("anchor", "item", "seed", "step", "place", "later", "words"):
            setattr(self, name, getattr(self, name)[order])
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.anchor & U64((1 << 20) - 1)).astype(np.int64)] = True


def holders(items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The items' words in order, and in how many items each occurs."""
    return np.unique(np.concatenate([np.unique(words) for words in items] or [np.zeros(0, U64)]), return_counts=True)


def functions(items: list[np.ndarray], rounds: int | np.ndarray, held: tuple[np.ndarray, np.ndarray] | None = None, share: float = 0.2) -> Functions:
    """`rounds` functions per item (one number, or one per item); the first step is drawn among the item's rarer words.

    With `PIECES` an item is cut into one piece more than the edits it allows. One of them
    is whole in any text that holds the item, so each piece's rarest word is a function
    without later steps, and together they miss nothing.
    """
    rounds = np.broadcast_to(rounds, len(items))
    known, times = holders(items) if held is None else held
    cuts = [np.array_split(np.arange(len(w)), allowed(len(w), share) + 1) if n == PIECES else [] for w, n in zip(items, rounds)]
    size = sum(len(c) or n for w, n, c in zip(items, rounds.tolist(), cuts) if len(w))
    anchor, item, seed, step, at = (np.zeros(size, kind) for kind in (U64, np.int64, U64, np.int64, np.int64))
    later, value = np.full((size, SAMPLED - 1), -1, np.int64), np.zeros((size, SAMPLED - 1), U64)
    n = 0
    for k, words in enumerate(items):
        if not len(words):
            continue
        common = times[np.searchsorted(known, words)]
        for part in cuts[k]:
            rarest = part[common[part].argmin()]
            anchor[n], item[n], at[n] = words[rarest], k, rarest
            n += 1
        rarer = common <= np.sort(common)[len(common) // 2]
        steps = 3 * len(words)
        some = max(1, WALKED // steps)
        own = int(max(0, rounds[k]))
        for r in range(own):
            if r % some == 0:
                walked = walks(words, np.arange(r, min(r + some, own), dtype=U64), steps)
            draw = np.random.default_rng([len(words), int(words[0] & U64(0xFFFFFFFF)), r])
            place = walked[:, r % some]
            # Each place's last step: the next one stands on the next word.
            inside = np.flatnonzero(place < len(words))
            first = draw.choice(inside[rarer[place[inside]]])
            ahead = inside[(inside > first) & (inside <= first + SPAN) & (place[inside] > place[first])]
            take = np.sort(draw.choice(ahead, min(SAMPLED - 1, len(ahead)), replace=False)) if len(ahead) else np.zeros(0, np.int64)
            anchor[n], item[n], seed[n], step[n], at[n] = words[place[first]], k, r, first, place[first]
            later[n, : len(take)], value[n, : len(take)] = take, words[place[take]]
            n += 1
    return Functions(anchor, item, seed, step, at, later, value)


def collisions(words: np.ndarray, first: np.ndarray, f: Functions) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, word place in the batch where the item would begin, function's seed) per collision."""
    if not len(words) or not len(f.anchor):
        return (np.zeros(0, np.int64),) * 4
    at = np.flatnonzero(f.maybe[(words & U64((1 << 20) - 1)).astype(np.int64)])
    low, high = np.searchsorted(f.anchor, words[at], "left"), np.searchsorted(f.anchor, words[at], "right")
    n = high - low
    at, low, n = at[n > 0], low[n > 0], n[n > 0]
    out = []
    cut = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(n) // MEET)) + 1, [len(n)]])
    for a, b in zip(cut[:-1], cut[1:]):
        size = n[a:b]
        begin = np.repeat(at[a:b], size)
        which = np.repeat(low[a:b] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        out.append(_walk(words, first, f, begin, which))
    if not out:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*out))


def _walk(words, first, f: Functions, begin, which):
    """The walks from `begin` that show their function's words at all sampled steps."""
    row = np.searchsorted(first, begin, "right") - 1
    end = first[row + 1]
    place = begin.copy()
    alive = np.arange(len(begin))
    for ahead in range(SPAN + 1):
        fn, now = which[alive], place[alive]
        word = words[now]
        step = f.step[fn] + ahead
        asked = f.later[fn] == step[:, None]
        ok = ~(asked & (f.words[fn] != word[:, None])).any(axis=1)
        now = now + _bit(f.seed[fn], step.astype(U64), word)
        # A walk that leaves its text goes on only if nothing more is asked of it.
        ok &= (now < end[alive]) | (f.later[fn].max(axis=1) <= step)
        place[alive] = np.minimum(now, end[alive] - 1)
        alive = alive[ok]
        if not len(alive):
            break
    fn = which[alive]
    return row[alive], f.item[fn], begin[alive] - f.place[fn], f.seed[fn].astype(np.int64)


def distance(item: np.ndarray, window: np.ndarray) -> int:
    """Edit distance of the item to the window's best part, in words."""
    if len(item) == len(window) and (item == window).all():
        return 0
    row = np.zeros(len(window) + 1, np.int64)
    index = np.arange(len(window) + 1)
    for i, w in enumerate(item):
        new = row + 1
        new[0] = i + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (window != w))
        row = np.minimum.accumulate(new - index) + index
    return int(row.min())


def allowed(n: int, share: float) -> int:
    return int(share * n + 1e-9)


def matches(words: np.ndarray, first: np.ndarray, items: list[np.ndarray], f: Functions, share: float) -> dict[tuple[int, int], tuple[int, int]]:
    """(row, item) -> (distance, word place) of the best verified window."""
    row, item, begin, _ = collisions(words, first, f)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    if not len(row):
        return best
    for r, k, p in np.unique(np.column_stack([row, item, begin]), axis=0).tolist():
        known = best.get((r, k))
        if known and known[0] == 0:
            continue
        n, lo, hi = len(items[k]), int(first[r]), int(first[r + 1])
        most = allowed(n, share)
        whole = words[max(lo, p) : min(hi, p + n)]
        d = 0 if len(whole) == n and (whole == items[k]).all() else distance(items[k], words[max(lo, p - most) : min(hi, p + n + most)])
        if d <= most and (known is None or (d, p) < known):
            best[r, k] = (d, max(p, lo))
    return {key: (d, p - int(first[key[0]])) for key, (d, p) in best.items()}


def length_class(words: np.ndarray) -> int:
    """Items of a class differ in length by less than a factor of two."""
    return len(words).bit_length()


def rounds_for(items: list[np.ndarray], share: float, recall: float, trials: int = 12, sample: int = 100) -> np.ndarray:
    """Per item, how many functions find a copy with as many random edits as are allowed.

    Measured for each length class by itself, on edited copies of (at most `sample`) of its
    items: words replaced, put in or taken out. A class that the largest number of functions
    doesn't bring to the target recall is searched by pieces, which find every copy.
    """
    out, held = np.ones(len(items), np.int64), holders(items)
    classes = np.array([length_class(w) for w in items])
    for c in np.unique(classes[classes > 0]).tolist():
        members = np.flatnonzero(classes == c)
        draw = np.random.default_rng([7, c])
        chosen = [items[k] for k in members[draw.permutation(len(members))[:sample]]]
        needed = (_measured(chosen, most, held, share, recall, trials, draw) for most in TRIED)
        out[members] = next((n for n in needed if n is not None), PIECES)
    return out


def _measured(chosen: list[np.ndarray], most: int, held, share: float, recall: float, trials: int, draw) -> int | None:
    """How many functions of `most` reach the recall on edited copies of the chosen items; None if these are too few."""
    f = functions(chosen, most, held)
    texts, owner = [], []
    for at, item in enumerate(chosen):
        for _ in range(trials):
            w = item.tolist()
            for _ in range(allowed(len(item), share)):
                i, kind = int(draw.integers(len(w))), int(draw.integers(3))
                new = int(draw.integers(1 << 62))
                w = w[:i] + ([new] if kind == 0 else [new, w[i]] if kind == 1 else []) + w[i + 1 :]
            texts.append(np.array(w, U64))
            owner.append(at)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    row, item, _, seed = collisions(np.concatenate(texts), first, f)
    earliest = np.full(len(texts), most)
    own = item == np.array(owner)[row]
    np.minimum.at(earliest, row[own], seed[own])
    found = int(np.sort(earliest)[min(len(texts) - 1, int(np.ceil(recall * len(texts))) - 1)]) + 1
    return found if found <= most else None


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[tuple[list[int], list[np.ndarray], bool]]:
    """The items' ids and words, at most about ITEM_WORDS words at a time, and whether more blocks follow.

    The size is measured first; items are dealt to blocks by hash, so each block is bounded.
    """
    plain = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    words = plain.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + words // (4 * ITEM_WORDS)
    for b in range(blocks):
        rows = plain.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).distinct().orderBy("id", "text").collect()
        texts = pa.array([r.text for r in rows], pa.string())
        hashes = []
        for lo, hi in pieces(texts):
            h, at = word_hashes(texts, lo, hi, stops=SYMBOLS)
            hashes += [h[x:y] for x, y in zip(at[:-1], at[1:])]
        yield [r.id for r in rows], hashes, b < blocks - 1


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    share: float = 0.2,
    recall: float = 0.99,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, item_id, distance, item_words, first_word: the best window of each text and item.

    A text holds an item if some part of it is within `share` of the item's words in
    edit distance. Words are letters and digits, A-Z made small; an item without words
    is never found. Null and empty texts hold nothing; rows with the same id are found
    one by one, a null id stays null. Items are read in blocks of a bounded size; a
    block's matches are written before the next one is read.
    """
    plain = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for ids, words, more in item_blocks(items, item_col, item_text):
        run = _finder(ids, words, functions(words, rounds_for(words, share, recall), share=share), share)
        found = plain.mapInArrow(run, "doc_id long, item_id long, distance long, item_words long, first_word long")
        found = stage_table(found, "leaks") if more else found
        out = found if out is None else out.union(found)
    return out


def _finder(ids: list[int], items: list[np.ndarray], f: Functions, share: float):
    names = ["doc_id", "item_id", "distance", "item_words", "first_word"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = strings(batch.column("text"))
            for lo, hi in pieces(texts):
                words, first = word_hashes(texts, lo, hi, stops=SYMBOLS)
                found = matches(words, first, items, f, share)
                if found:
                    doc = batch.column("doc_id").slice(lo, hi - lo).to_pylist()
                    rows = [(doc[r], ids[k], d, len(items[k]), p) for (r, k), (d, p) in found.items()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    return run


def without_leaks(docs: DataFrame, items: DataFrame, share: float = 0.2, recall: float = 0.99, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no item; all columns stay as they are.

    With one block of items nothing is shuffled. Of several, each but the last has the
    hashes of the texts it was found in written before the next one is read.
    """
    small_batches(docs)
    text = F.col(f"`{text_col}`")
    keys = [F.xxhash64(text), F.xxhash64(F.lit(1), text)]
    names = fresh(docs, "_key", "_key2")
    found, out = None, docs
    for _, words, more in item_blocks(items):
        holds = _holds(words, functions(words, rounds_for(words, share, recall), share=share), share)(text)
        if more:
            marks = stage_table(docs.where(holds).select(*[k.alias(n) for k, n in zip(keys, names)]).distinct(), "leaks")
            found = marks if found is None else found.union(marks)
        else:
            out = out.where(~holds)
    if found is None:
        return out
    same = [k == F.col(n) for k, n in zip(keys, names)]
    return out.join(found.distinct(), same[0] & same[1], "left_anti")


def _holds(items: list[np.ndarray], f: Functions, share: float):
    def run(column: pa.Array) -> pa.Array:
        texts = strings(column)
        out = np.zeros(len(texts), bool)
        for lo, hi in pieces(texts):
            words, first = word_hashes(texts, lo, hi, stops=SYMBOLS)
            out[[lo + r for r, _ in matches(words, first, items, f, share)]] = True
        return pa.array(out)

    return F.arrow_udf(run, "boolean")
