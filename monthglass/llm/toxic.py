"""Toxicity by a chain of linear models.

Categories stand in a fixed order. Each has a logistic model over the text's words;
the models of later categories also see the probabilities of the earlier ones. In
training these come from models that have not seen the document (folds), in scoring
from the models fitted on the whole sample.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import small_batches
from .samples import whole_bags
from .words import SYMBOLS, U64, pieces, strings, word_hashes

SLOTS = 1 << 18  # hashed words
CHOSEN = 2048  # words a model uses
FOLDS = 3
#: Bounds of what is fitted on: labelled documents, and bytes of all their slot numbers (see `samples`); one has 4 * SLOTS at most.
SAMPLE, TOTAL = 12_000, 64 << 20


def slots(texts: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct word slots of rows lo to hi, each row's first and the end)."""
    h, first = word_hashes(texts, lo, hi, stops=SYMBOLS)
    row = np.repeat(np.arange(hi - lo), np.diff(first))
    both = np.unique(row * SLOTS + ((h >> U64(17)) % U64(SLOTS)).astype(np.int64))
    return both % SLOTS, np.searchsorted(both, np.arange(hi - lo + 1) * SLOTS)


def _sig(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


@dataclass
class Linear:
    """One category: a weight per slot, per earlier category, and a constant."""

    slots: np.ndarray
    earlier: np.ndarray
    constant: float

    def __call__(self, words: np.ndarray, begin: np.ndarray, before: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(self.slots[words])])
        return _sig(total[begin[1:]] - total[begin[:-1]] + _logit(before) @ self.earlier + self.constant)


@dataclass
class Chain:
    names: list[str]
    models: list[Linear]
    limits: list[float]

    def __call__(self, words: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Probabilities, one column per category, in the chain's order."""
        out = np.zeros((len(begin) - 1, 0))
        for model in self.models:
            out = np.column_stack([out, model(words, begin, out)])
        return out


def fit_linear(words, begin, before, label, rounds: int = 150) -> Linear:
    """Logistic regression by Adam over the words that tell the label's sides apart best."""
    n, k = len(label), before.shape[1]
    if label.min() == label.max():
        return Linear(np.zeros(SLOTS), np.zeros(k), float(_logit(np.array(label[0]))))
    row = np.repeat(np.arange(n), np.diff(begin))
    yes, all_ = np.bincount(words[label[row] == 1], minlength=SLOTS), np.bincount(words, minlength=SLOTS)
    p = label.mean()
    gap = yes - all_ * p
    apart = np.where(all_ >= 3, gap * gap / np.maximum(all_ * p * (1 - p), 1e-9), 0)
    chosen = np.flatnonzero(apart >= max(4.0, np.sort(apart)[-CHOSEN]))
    place = np.full(SLOTS, -1)
    place[chosen] = np.arange(len(chosen))
    there = place[words] >= 0
    col, row = place[words][there], row[there]
    extra = _logit(before)
    w = np.concatenate([np.zeros(len(chosen) + k), [_logit(np.array(p))]])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        y = _sig(np.bincount(row, w[col], minlength=n) + extra @ w[len(chosen) : -1] + w[-1])
        d = (y - label) / n
        g = np.concatenate([np.bincount(col, d[row], minlength=len(chosen)), extra.T @ d, [d.sum()]])
        g[:-1] += 2e-4 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.15 * (1 - t / (rounds + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    out = np.zeros(SLOTS)
    out[chosen] = w[: len(chosen)]
    return Linear(out, w[len(chosen) : -1], float(w[-1]))


def _rows(words, begin, which):
    size = np.diff(begin)[which]
    at = np.concatenate([[0], np.cumsum(size)])
    return words[np.repeat(begin[which] - at[:-1], size) + np.arange(at[-1])], at


def best_limit(p: np.ndarray, label: np.ndarray) -> float:
    """The limit with the best F1 on probabilities of unseen documents."""
    if not label.any():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(label[order])
    f1 = 2 * hit / (np.arange(1, len(p) + 1) + label.sum())
    k = int(np.argmax(f1))
    below = p[order[k + 1]] if k + 1 < len(p) else 0.0
    return float((p[order[k]] + below) / 2)


def fit_chain(words, begin, labels: Mapping[str, np.ndarray], folds: int = FOLDS) -> Chain:
    """Models in the order of `labels`; each one's training sees the earlier ones' out-of-fold probabilities."""
    n = len(begin) - 1
    fold = np.arange(n) % folds
    unseen = np.zeros((n, 0))
    models, limits = [], []
    for label in labels.values():
        p = np.zeros(n)
        for k in range(folds):
            train, test = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            if len(train) and len(test):
                model = fit_linear(*_rows(words, begin, train), unseen[train], label[train])
                p[test] = model(*_rows(words, begin, test), unseen[test])
        models.append(fit_linear(words, begin, unseen, label))
        limits.append(best_limit(p, label))
        unseen = np.column_stack([unseen, p])
    return Chain(list(labels), models, limits)


#: Category -> condition on a row of labels, in the chain's order.
CATEGORIES = {"junk": "quality = 0", "toxic": "toxic = 1"}


def train(docs: DataFrame, labels: DataFrame, categories: Mapping[str, str] = CATEGORIES, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """Fits on at most `sample` labelled documents, chosen by hash of their id.

    Rows whose labels leave a category open (null) are passed over; of an id with
    several label rows each category holds if it does in any; of an id with several texts
    one is taken. Whole documents reach the driver as slot numbers, in the order of the
    hash, as long as they are TOTAL bytes together: 16 million distinct words.
    """
    sides = [F.max(F.expr(c).cast("int")).alias(f"c{k}") for k, c in enumerate(categories.values())]
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("l")).agg(*sides).na.drop().withColumn("h", F.xxhash64("l"))
    share = min(1.0, 4 * sample / max(known.count(), 1))
    known = known.where(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)).orderBy("h", "l").limit(sample)
    heads = ["h", "l", *(f"c{k}" for k in range(len(categories)))]
    rows = small_batches(docs).select(F.col(id_col).alias("d"), F.col(text_col).alias("text")).join(F.broadcast(known), F.col("d") == F.col("l")).select(*heads, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = strings(b.column("text"))
            for lo, hi in pieces(texts):
                words, begin = slots(texts, lo, hi)
                bags = pa.array([words[p:q].astype(np.int32).tobytes() for p, q in zip(begin[:-1], begin[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(lo, hi - lo).cast(pa.int64()) for c in heads), bags], names=[*heads, "bag"])

    bags = rows.mapInArrow(run, ", ".join(f"{c} long" for c in heads) + ", bag binary").groupBy(*heads).agg(F.min("bag").alias("bag"))
    got = sorted(whole_bags(bags, 4 * SLOTS, TOTAL), key=lambda r: (r.h, r.l))
    if not got:
        return Chain(list(categories), [Linear(np.zeros(SLOTS), np.zeros(k), 0.0) for k in range(len(categories))], [1.0] * len(categories))
    x = [np.frombuffer(r.bag, np.int32).astype(np.int64) for r in got]
    begin = np.concatenate([[0], np.cumsum([len(v) for v in x])])
    return fit_chain(np.concatenate(x), begin, {c: np.array([r[f"c{k}"] for r in got], float) for k, c in enumerate(categories)})


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, p_<category> ..., is_<category> ... for every row, from whole texts.

    Null and empty texts have no words; their probabilities come from the constants.
    Without labels all probabilities are 0.5 and nothing is marked. Ids may repeat or be null.
    """
    names = ["doc_id", *(f"p_{c}" for c in chain.names), *(f"is_{c}" for c in chain.names)]
    limits = np.array(chain.limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = strings(b.column("text"))
            for lo, hi in pieces(texts):
                p = chain(*slots(texts, lo, hi))
                columns = [pa.array(p[:, k]) for k in range(p.shape[1])] + [pa.array((p >= limits)[:, k]) for k in range(p.shape[1])]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), *columns], names=names)

    schema = ", ".join(["doc_id long", *(f"`{c}` {'double' if c.startswith('p_') else 'boolean'}" for c in names[1:])])
    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
