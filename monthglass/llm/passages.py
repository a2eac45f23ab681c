"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages; only the document has a label. Each passage is
encoded as numbers; a gated attention (tanh times sigmoid) gives each passage a
weight, learned from the documents' labels alone; the weighted sum of the passages'
representations is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import small_batches
from .samples import whole_bags
from .words import LOWER, SPACES, U64, hashed, mix, pieces, raw, strings, word_marks

PASSAGE = 64  # words in a passage; a text's last one has what is left
HASHED = 48  # slots that hashed words are counted in
SIGNS = 12  # numbers about characters and words
WIDTH = HASHED + SIGNS
HIDDEN, GATE = 24, 12
#: Bounds of what is fitted on: labelled documents, bytes of one's encoded passages, and of all together (see `samples`).
SAMPLE, LARGEST, TOTAL = 6000, 6 << 20, 48 << 20


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


CLASSES = [
    np.isin(np.arange(256), np.arange(0x41, 0x5B)),
    np.isin(np.arange(256), np.arange(0x61, 0x7B)),
    np.isin(np.arange(256), np.arange(0x30, 0x3A)),
    _table(".,;:?'\"()-"),
    _table("#*$%&|<>{}[]\\/=+~^@_`"),
    _table("!"),
    np.arange(256) >= 0x80,
]


def encode(texts: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(passages x WIDTH numbers, each row's first passage and the end) for rows lo to hi.

    A text without words is one passage of zeros.
    """
    buf, at = raw(texts, lo, hi)
    inside, starts, first = word_marks(buf, at, SPACES)
    n = np.diff(first)
    count = np.maximum(1, -(-n // PASSAGE))
    begin = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(n)), n)
    owner = begin[row] + (np.arange(len(starts)) - first[row]) // PASSAGE
    out = np.zeros((begin[-1], WIDTH))
    if not len(starts):
        return out, begin
    said = np.bincount(owner, minlength=begin[-1])
    words = np.maximum(said, 1)

    # Words counted in hashed slots, signed, by the square root of the length.
    h = hashed(LOWER[buf], inside, starts)
    slot = ((h >> U64(20)) % U64(HASHED)).astype(np.int64)
    sign = np.where((h >> U64(60)) & U64(1), 1.0, -1.0)
    counts = np.bincount(owner * HASHED + slot, sign, minlength=begin[-1] * HASHED).reshape(-1, HASHED)
    out[:, :HASHED] = counts / np.sqrt(words)[:, None]

    # Shares of kinds of bytes among a passage's word bytes.
    cuts = np.append(starts, len(buf))
    total = _per_word(inside, cuts)
    size = np.maximum(np.bincount(owner, total, minlength=begin[-1]), 1)
    for k, kind in enumerate(CLASSES):
        out[:, HASHED + k] = np.bincount(owner, _per_word(kind[buf] & inside, cuts), minlength=begin[-1]) / size
    k = HASHED + len(CLASSES)
    out[:, k] = np.where(said > 0, np.log1p(size / words), 0)
    out[:, k + 1] = np.log1p(said) / 4
    # Words said before: in the passage, and in the text.
    for j, scope in enumerate((owner, row)):
        key = mix(h + scope.astype(U64) * U64(0x2545F4914F6CDD1D))
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(key))
        again[order[1:]] = key[order][1:] == key[order][:-1]
        out[:, k + 2 + j] = np.bincount(owner, again, minlength=begin[-1]) / words
    # Sequences of three words said before in the text.
    if len(h) > 2:
        three = mix(h[:-2] + mix(h[1:-1] + mix(h[2:] + row[:-2].astype(U64) * U64(0x2545F4914F6CDD1D))))
        order = np.argsort(three, kind="stable")
        again = np.zeros(len(h))
        again[order[1:]] = three[order][1:] == three[order][:-1]
        again[:-2] *= row[2:] == row[:-2]
        out[:, k + 4] = np.bincount(owner, again, minlength=begin[-1]) / words
    return out, begin


def _per_word(kind: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(kind, dtype=np.int64)])
    return (total[cuts[1:]] - total[cuts[:-1]]).astype(float)


@dataclass
class Attention:
    """Weights of the passage layer, the two halves of the gate, and the document's score."""

    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]

    def __call__(self, x: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score per bag, attention per passage)."""
        p = _forward(self.w, (x - self.mean) / self.scale, begin)
        return p["y"], p["a"]


def _sig(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w, x, begin):
    bag = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    h = np.tanh(x @ w["V"] + w["b"])
    t, g = np.tanh(h @ w["T"]), _sig(h @ w["G"])
    s = (t * g) @ w["u"]
    top = np.maximum.reduceat(s, begin[:-1])
    e = np.exp(s - top[bag])
    a = e / np.add.reduceat(e, begin[:-1])[bag]
    z = np.add.reduceat(a[:, None] * h, begin[:-1], axis=0)
    return {"bag": bag, "h": h, "t": t, "g": g, "a": a, "z": z, "y": _sig(z @ w["o"] + w["c"])}


def fit(x: np.ndarray, begin: np.ndarray, label: np.ndarray, steps: int = 1500, batch: int = 128, seed: int = 0) -> Attention:
    """Weights by Adam on the label's cross entropy, both labels weighing the same; passages have no labels.

    At least `steps` steps, and 25 rounds, are taken.
    """
    rounds = max(25, -(-steps // -(-len(label) // batch)))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 0.05
    x = (x - mean) / scale
    draw = np.random.default_rng(seed)
    some = lambda *shape: draw.normal(size=shape) / np.sqrt(shape[0])
    w = {"V": some(WIDTH, HIDDEN), "b": np.zeros(HIDDEN), "T": some(HIDDEN, GATE), "G": some(HIDDEN, GATE), "u": some(GATE), "o": some(HIDDEN), "c": np.zeros(1)}
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    share = np.clip(label.mean(), 0.02, 0.98)
    step = 0
    for epoch in range(rounds):
        order = draw.permutation(len(label))
        for low in range(0, len(order), batch):
            bags = order[low : low + batch]
            size = np.diff(begin)[bags]
            at = np.concatenate([[0], np.cumsum(size)])
            rows = np.repeat(begin[bags] - at[:-1], size) + np.arange(at[-1])
            grad = _gradient(w, x[rows], at, label[bags], np.where(label[bags] == 1, 0.5 / share, 0.5 / (1 - share)))
            step += 1
            rate = 0.01 * (1 - epoch / rounds) + 0.0005
            for k in w:
                g = grad[k] + 1e-4 * w[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    # The intercept is put back to the labels' real share.
    w["c"] = w["c"] + np.log(share / (1 - share))
    return Attention(mean, scale, w)


def _gradient(w, x, begin, label, weight):
    p = _forward(w, x, begin)
    bag, h, t, g, a = p["bag"], p["h"], p["t"], p["g"], p["a"]
    dy = (p["y"] - label) * weight / len(label)
    dz = dy[:, None] * w["o"][None, :]
    da = (dz[bag] * h).sum(axis=1)
    ds = a * (da - np.add.reduceat(a * da, begin[:-1])[bag])
    dt, dg = ds[:, None] * w["u"] * g * (1 - t * t), ds[:, None] * w["u"] * t * g * (1 - g)
    dh = a[:, None] * dz[bag] + dt @ w["T"].T + dg @ w["G"].T
    dpre = dh * (1 - h * h)
    return {"V": x.T @ dpre, "b": dpre.sum(axis=0), "T": h.T @ dt, "G": h.T @ dg, "u": (t * g).T @ ds, "o": p["z"].T @ dy, "c": np.array([dy.sum()])}


def held_out(id_col) -> F.Column:
    """Documents kept for measuring: crc32 of the id as text divisible by 5; a null id is held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Attention:
    """Fits on at most `sample` labelled documents, chosen by hash among those that are not held out.

    The passages are encoded on the executors; whole documents reach the driver, in the
    order of the hash, as long as they are TOTAL bytes together: 12 million words. One of
    more than LARGEST bytes, 1.6 million words, is passed over. An id with several labels is
    left out if they differ; of an id with several texts one is taken.
    """
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("l")).agg(F.min(label_col).alias("y"), F.max(label_col).alias("y2"))
    known = known.where("y = y2 and l is not null").select("l", "y", F.xxhash64("l").alias("h"))
    share = min(1.0, 4 * sample / max(known.count(), 1))
    known = known.where(~held_out("l")).where(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)).orderBy("h", "l").limit(sample)
    rows = small_batches(docs).select(F.col(id_col).alias("d"), F.col(text_col).alias("text")).join(F.broadcast(known), F.col("d") == F.col("l")).select("h", "d", "text", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = strings(b.column("text"))
            for lo, hi in pieces(texts):
                x, begin = encode(texts, lo, hi)
                bags = [x[p:q].astype(np.float32).tobytes() for p, q in zip(begin[:-1], begin[1:])]
                head = [b.column(c).slice(lo, hi - lo) for c in ("h", "d", "y")]
                yield pa.RecordBatch.from_arrays([head[0], head[1].cast(pa.int64()), head[2].cast(pa.int64()), pa.array(bags, pa.binary())], names=["h", "d", "y", "bag"])

    # Repeated rows of an id are one bag.
    bags = rows.mapInArrow(run, "h long, d long, y long, bag binary").groupBy("h", "d", "y").agg(F.min("bag").alias("bag"))
    got = sorted(whole_bags(bags, LARGEST, TOTAL), key=lambda r: (r.h, r.d))
    if len({r.y for r in got}) < 2:
        # With one label, or none, there is nothing to learn: its share is the score of every text.
        y = float(got[0].y) if got else 0.5
        zero = {"V": (WIDTH, HIDDEN), "b": (HIDDEN,), "T": (HIDDEN, GATE), "G": (HIDDEN, GATE), "u": (GATE,), "o": (HIDDEN,)}
        return Attention(np.zeros(WIDTH), np.ones(WIDTH), {k: np.zeros(v) for k, v in zero.items()} | {"c": np.array([(y - 0.5) * 20])})
    x = [np.frombuffer(r.bag, np.float32).reshape(-1, WIDTH) for r in got]
    begin = np.concatenate([[0], np.cumsum([len(v) for v in x])])
    return fit(np.concatenate(x).astype(float), begin, np.array([r.y for r in got], float))


def score(docs: DataFrame, model: Attention, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, n_passages, top_passage (the one with most attention, from 0), top_weight for every row.

    All passages of the whole text count. Null and empty texts are one empty passage.
    Ids are only passed through, so they may repeat or be null.
    """
    names = ["doc_id", "score", "n_passages", "top_passage", "top_weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = strings(b.column("text"))
            for lo, hi in pieces(texts):
                x, begin = encode(texts, lo, hi)
                y, a = model(x, begin)
                top = [int(np.argmax(a[p:q])) for p, q in zip(begin[:-1], begin[1:])]
                best = a[begin[:-1] + np.array(top, int)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), pa.array(y), pa.array(np.diff(begin)), pa.array(top, pa.int64()), pa.array(best)], names=names)

    plain = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, "doc_id long, score double, n_passages long, top_passage long, top_weight double")
