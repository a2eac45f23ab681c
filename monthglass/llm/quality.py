"""Quality rules as a short-circuit cascade.

Each rule rejects texts by one measure. Their cost and the share they reject are
measured on a sample; they then run in order of rejection per cost, each one on
the texts that all earlier ones let through. The verdict doesn't depend on the order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import small_batches
from .words import SPACES, U64, hashed, mix, pieces, raw, strings, word_marks

NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True
SIGNS = np.zeros(256, bool)
SIGNS[[ord(c) for c in "#*$%&|<>"]] = True
UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
LOWERS = np.zeros(256, bool)
LOWERS[0x61:0x7B] = True


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of values per row; at has each row's first value, and the end."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is the key there more than once, is it there before) for each place."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    before = np.zeros(len(keys), bool)
    before[order[1:]] = same
    often = before.copy()
    often[order[:-1]] |= same
    return often, before


@dataclass
class Texts:
    """A piece of a batch; measures are worked out when a rule first asks for them."""

    texts: pa.Array

    @cached_property
    def bytes(self):
        return raw(self.texts, 0, len(self.texts))

    @cached_property
    def marks(self):
        return word_marks(*self.bytes, SPACES)

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.diff(self.marks[2])

    @cached_property
    def word_chars(self) -> np.ndarray:
        buf, at = self.bytes
        return _sums(self.marks[0] & ((buf & 0xC0) != 0x80), at)

    @cached_property
    def hashes(self) -> np.ndarray:
        return hashed(self.bytes[0], *self.marks[:2])

    @cached_property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.texts)), self.n_words)

    def count(self, kind: np.ndarray) -> np.ndarray:
        return _sums(kind[self.bytes[0]], self.bytes[1])

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """(lines with a word, those equal to an earlier line) per text."""
        buf, at = self.bytes
        inside, starts, first = word_marks(buf, at, NEWLINE)
        worded = _sums(self.marks[0], np.append(starts, len(buf))) > 0 if len(starts) else np.zeros(0, bool)
        row = np.repeat(np.arange(len(at) - 1), np.diff(first))
        _, before = _repeated(mix(hashed(buf, inside, starts) ^ row.astype(U64) * U64(0x2545F4914F6CDD1D)))
        return _sums(worded, first), _sums(worded & before, first)

    @cached_property
    def repeat_words(self) -> np.ndarray:
        """Words in 3-word windows that the text holds twice or more."""
        h, first = self.hashes, self.marks[2]
        there = np.zeros(len(h), bool)
        if len(h) >= 3:
            own = np.flatnonzero(self.rows[2:] == self.rows[:-2])
            a, b, c = h[own], h[own + 1], h[own + 2]
            key = mix(a + mix(b + mix(c + self.rows[own].astype(U64) * U64(0x2545F4914F6CDD1D))))
            hit = own[_repeated(key)[0]]
            for k in range(3):
                there[hit + k] = True
        return _sums(there, first)

    @cached_property
    def distinct_words(self) -> np.ndarray:
        _, before = _repeated(mix(self.hashes + self.rows.astype(U64) * U64(0x2545F4914F6CDD1D)))
        return self.n_words - _sums(before, self.marks[2])

    @cached_property
    def shouted(self) -> np.ndarray:
        """Words with a capital and no small letter (A-Z, a-z), of two bytes or more."""
        buf, at = self.bytes
        _, starts, first = self.marks
        cuts = np.append(starts, len(buf))
        caps, small = _sums(UPPER[buf], cuts), _sums(LOWERS[buf], cuts)
        return _sums((caps >= 2) & (small == 0), first)


@dataclass(frozen=True)
class Rule:
    """True where a text is to be rejected."""

    name: str
    rejects: Callable[[Texts], np.ndarray] = field(compare=False)


#: Few words, or most of the text said twice.
BASE = (
    Rule("few_words", lambda t: t.n_words < 50),
    Rule("repeated_words", lambda t: 100 * t.repeat_words > 50 * t.n_words),
)

RULES = (
    Rule("symbols", lambda t: 100 * t.count(SIGNS) > 20 * t.n_words),
    Rule("word_length", lambda t: (2 * t.word_chars < 5 * t.n_words) | (t.word_chars > 14 * t.n_words)),
    Rule("repeated_lines", lambda t: 2 * t.lines[1] > t.lines[0]),
    Rule("shouting", lambda t: 100 * t.shouted > 50 * t.n_words),
    Rule("few_distinct_words", lambda t: 100 * t.distinct_words < 20 * t.n_words),
)


def measure(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = 512, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, float, float]]:
    """(rule, seconds per text, share rejected) on `sample` texts chosen by hash.

    One task works on the sample; one row per rule reaches the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, took, hits = 0, [0.0] * len(rules), [0] * len(rules)
        for batch in batches:
            texts = strings(batch.column(0))
            n += len(texts)
            for k, rule in enumerate(rules):
                for lo, hi in pieces(texts):
                    piece = texts.slice(lo, hi - lo)
                    began = time.perf_counter()
                    hits[k] += int(rule.rejects(Texts(piece)).sum())
                    took[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict({"k": list(range(len(rules))), "cost": [x / max(n, 1) for x in took], "share": [x / max(n, 1) for x in hits]})

    # A share of about four samples is drawn by hash first, so that few rows are ordered however large the table is.
    share = min(1.0, 4 * sample / max(docs.count(), 1))
    by_hash = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    texts = docs.select(F.col(f"`{text_col}`").alias("text"), by_hash.alias("h")).where("text is not null")
    chosen = texts.where(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)).orderBy("h").limit(sample).select("text")
    found = chosen.coalesce(1).mapInArrow(run, "k long, cost double, share double").groupBy("k").agg(F.max("cost"), F.max("share")).collect()
    return [(rules[k].name, cost, share) for k, cost, share in sorted(found)]


def by_worth(rules: Sequence[Rule], measured: Sequence[tuple[str, float, float]]) -> list[Rule]:
    """The rule that rejects most per second first; ties keep their order."""
    worth = {name: share / max(cost, 1e-12) for name, cost, share in measured}
    return sorted(rules, key=lambda r: -worth.get(r.name, 0.0))


def cascade(texts: pa.Array, rules: Sequence[Rule], alive: np.ndarray) -> np.ndarray:
    """Which of the texts marked alive pass all rules; a rule sees only those that are left."""
    alive = alive.copy()
    rest, at = None, np.zeros(0, np.int64)
    for rule in rules:
        if rest is None or len(at) != alive.sum():
            at = np.flatnonzero(alive)
            rest = Texts(texts.take(pa.array(at)))
        if not len(at):
            break
        alive[at[rule.rejects(rest)]] = False
    return alive


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    The base measures are worked out for every text; the cascade runs on those that
    pass the base rules. A null or empty text has no words and so fails them. Rows
    are judged one by one: repeated ids, null ids and other columns change nothing.
    """
    order = by_worth(rules, measure(small_batches(docs), rules, sample, id_col, text_col))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = strings(batch.column("text"))
            for lo, hi in pieces(texts):
                piece = texts.slice(lo, hi - lo)
                t = Texts(piece)
                failed = BASE[0].rejects(t) | BASE[1].rejects(t)
                kept = cascade(piece, order, ~failed)
                numbers = [t.n_words, t.word_chars, t.count(SIGNS), t.lines[1], t.repeat_words]
                columns = [batch.column("doc_id").slice(lo, hi - lo), *(pa.array(x.astype(np.int64)) for x in numbers), pa.array(failed), pa.array(kept)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the cascade, unchanged; nothing is shuffled."""
    order = [*BASE, *by_worth(rules, measure(small_batches(docs), rules, sample, id_col, text_col))]

    def run(column: pa.Array) -> pa.Array:
        texts = strings(column)
        out = [cascade(texts.slice(lo, hi - lo), order, np.ones(hi - lo, bool)) for lo, hi in pieces(texts)]
        return pa.array(np.concatenate(out) if out else np.zeros(0, bool))

    return docs.where(F.arrow_udf(run, "boolean")(F.col(f"`{text_col}`")))
