"""Exact token counts at every prefix of a text, by dynamic programming.

In a byte-pair encoding with ranked merges, a prefix of a piece of text has exactly
one encoding, and its last token is the only vocabulary entry that ends there and
can stand after the last token of what precedes it. So one pass over a piece gives
the last token and the number of tokens at each byte; the count at any prefix, the
longest prefix within a budget, and the place to cut for a window follow by lookup.
Pieces are cut by the vocabulary's pattern; a special string is a token by itself.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import small_batches
from .words import strings

#: The public splitting pattern of byte-level vocabularies, and its byte alphabet.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

#: Pieces of text, and pairs of tokens, that a worker remembers; beyond that it starts anew. Pieces of more bytes than LONG aren't.
REMEMBERED, LONG = 1_000_000, 64


def _alphabet() -> dict[str, int]:
    """Character of the vocabulary file -> byte: printable bytes stand for themselves, the rest from U+0100 on."""
    out = {chr(b): b for b in PLAIN_BYTES}
    rest = [b for b in range(256) if b not in set(PLAIN_BYTES)]
    return out | {chr(0x100 + k): b for k, b in enumerate(rest)}


class _Remembered(dict):
    """Results of a function by its argument; emptied when full."""

    def __init__(self, work):
        self.work = work

    def __missing__(self, key):
        if len(self) >= REMEMBERED:
            self.clear()
        out = self[key] = self.work(key)
        return out


class Vocabulary:
    """A byte-level vocabulary file for the library `tokenizers`."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        to_byte = _alphabet()
        decode = lambda s: bytes(to_byte[c] for c in s)
        self.special = [t["content"] for t in data["added_tokens"]]
        model = data["model"]
        tokens = {decode(t): i for t, i in model["vocab"].items() if t not in set(self.special)}
        self.width = max(tokens.values()) + 1
        #: token -> (rank of the merge that makes it, its two parts); single bytes have none.
        self.made: dict[int, tuple[int, int, int]] = {}
        self.ranks: dict[int, int] = {}
        for rank, m in enumerate(model["merges"]):
            left, right = map(decode, m if isinstance(m, list) else m.split(" "))
            x, y, both = tokens[left], tokens[right], tokens[left + right]
            self.ranks[x * self.width + y] = rank
            if both in self.made or any(self.made.get(z, (-1,))[0] >= rank for z in (x, y)):
                raise ValueError("a merge must make a new token from earlier ones")
            self.made[both] = (rank, x, y)
        self.ids = {t: i for t, i in tokens.items() if len(t) == 1 or i in self.made}
        self.longest = max(map(len, self.ids))
        self.split = regex.compile(PATTERN).findall
        self.parts = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else lambda s: [s]
        self._finder = None
        self._fits = _Remembered(self._stands_after)
        self._counts = _Remembered(self._tokens_of)

    def _stands_after(self, pair: int) -> bool:
        """Can token b stand after token a: would no merge across their border come first?

        A token's parts are made by lower ranks than the token, so at each rank the
        border lies between one part on a's right edge and one on b's left edge.
        """
        never = len(self.ranks)
        a, b = divmod(pair, self.width)
        rights, lefts = [(a, never)], [(b, never)]  # (part, rank of the merge that takes it up)
        while rights[-1][0] in self.made:
            rank, _, y = self.made[rights[-1][0]]
            rights.append((y, rank))
        while lefts[-1][0] in self.made:
            rank, x, _ = self.made[lefts[-1][0]]
            lefts.append((x, rank))
        i, j = len(rights) - 1, len(lefts) - 1
        while True:
            (x, up_x), (y, up_y) = rights[i], lefts[j]
            rank = self.ranks.get(x * self.width + y, never)
            if rank < up_x and rank <= up_y and rank < never:
                return False
            if up_x == never and up_y == never:
                return True
            if up_x <= up_y:
                i -= 1
            else:
                j -= 1

    def _ending(self, piece: bytes) -> Iterator[tuple[int, int, int]]:
        """(end, start, token) of all vocabulary entries inside a piece, by end, longer ones first."""
        if self._finder is None:
            self._finder = ahocorasick.Automaton()
            for text, token in self.ids.items():
                self._finder.add_word(text.decode("latin-1"), (len(text), token))
            self._finder.make_automaton()
        for last, (size, token) in self._finder.iter(piece.decode("latin-1")):
            yield last + 1, last + 1 - size, token

    def prefixes(self, piece: bytes) -> tuple[list[int], list[int]]:
        """(number of tokens, begin of the last token) of each prefix, from the empty one on.

        In a long piece the entries that end at each byte come from an automaton over the
        vocabulary; in a short one looking all of them up is faster.
        """
        if len(piece) > LONG:
            return self._prefixes_of_long(piece)
        count, begin, last = [0], [0], [0]
        ids, fits, width, longest = self.ids.get, self._fits, self.width, self.longest
        for end in range(1, len(piece) + 1):
            for start in range(max(0, end - longest), end):
                token = ids(piece[start:end])
                if token is not None and (not start or fits[last[start] * width + token]):
                    count.append(count[start] + 1)
                    begin.append(start)
                    last.append(token)
                    break
        return count, begin

    def _prefixes_of_long(self, piece: bytes) -> tuple[list[int], list[int]]:
        fits, width = self._fits, self.width
        count, begin, last = [0], [0], [0]
        for end, start, token in self._ending(piece):
            if len(count) == end and (not start or fits[last[start] * width + token]):
                count.append(count[start] + 1)
                begin.append(start)
                last.append(token)
        return count, begin

    def _tokens_of(self, piece: str) -> int:
        data = piece.encode("utf-8", "surrogatepass")
        return 1 if data in self.ids else self.prefixes(data)[0][-1]

    def _count_of(self, piece: str) -> int:
        return self._counts[piece] if len(piece) <= LONG else self._tokens_of(piece)

    def count(self, text: str) -> int:
        """Tokens of a whole text: the entry of its longest prefix."""
        total = 0
        for k, part in enumerate(self.parts(text)):
            if k % 2:
                total += 1
            elif part:
                total += sum(map(self._count_of, self.split(part)))
        return total

    def marks(self, text: str) -> tuple[list[int], list[int]]:
        """(end in bytes, tokens so far) of each piece: the prefix table at the pieces' ends."""
        ends, counts, at, total = [], [], 0, 0
        for k, part in enumerate(self.parts(text)):
            for piece in [part] if k % 2 else self.split(part):
                at += len(piece.encode("utf-8", "surrogatepass"))
                total += 1 if k % 2 else self._count_of(piece)
                ends.append(at)
                counts.append(total)
        return ends, counts

    def longest_prefix(self, text: str, budget: int) -> tuple[int, int]:
        """(bytes, tokens) of the longest run of the text's own first tokens within the budget."""
        ends, counts = self.marks(text)
        k = bisect_right(counts, budget)
        at, used = (ends[k - 1], counts[k - 1]) if k else (0, 0)
        if k == len(ends):
            return at, used
        # The budget ends inside piece k: follow its tokens back from its end.
        piece = text.encode("utf-8", "surrogatepass")[at : ends[k]]
        count, begin = self.prefixes(piece)
        place = len(piece)
        while used + count[place] > budget:
            place = begin[place]
        return at + place, used + count[place]


@cache
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker process."""
    return Vocabulary(path)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens for every row; a null text is empty. Ids may repeat or be null."""
    names = ["doc_id", "n_bytes", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = vocabulary(path).count
        for batch in batches:
            texts = [x or "" for x in strings(batch.column("text")).to_pylist()]
            sizes = [len(x.encode("utf-8", "surrogatepass")) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(map(count, texts), pa.int64())], names=names)

    plain = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def token_marks(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ends, counts: bytes and tokens up to the end of each piece, for questions about prefixes.

    Store it once; `within` and `tokens_before` answer from it without the texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = vocabulary(path).marks
        for batch in batches:
            found = [marks(x or "") for x in strings(batch.column("text")).to_pylist()]
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], kind), pa.array([f[1] for f in found], kind)], names=["doc_id", "ends", "counts"]
            )

    plain = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, "doc_id long, ends array<long>, counts array<long>")


def within(budget: int) -> F.Column:
    """Over `token_marks`: bytes of the longest prefix of whole pieces with at most `budget` tokens."""
    fitting = F.size(F.filter("counts", lambda c: c <= budget))
    return F.when(fitting > 0, F.element_at("ends", fitting)).otherwise(F.lit(0))


def tokens_before(n_bytes: int) -> F.Column:
    """Over `token_marks`: tokens of the longest prefix of whole pieces within `n_bytes` bytes."""
    fitting = F.size(F.filter("ends", lambda e: e <= n_bytes))
    return F.when(fitting > 0, F.element_at("counts", fitting)).otherwise(F.lit(0))


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts: tokens of the text's own encoding that end at or before each byte, from 0 bytes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            rows = []
            for text in strings(batch.column("text")).to_pylist():
                row, total = [0], 0
                for k, part in enumerate(v.parts(text or "")):
                    for piece in [part] if k % 2 else v.split(part):
                        data = piece.encode("utf-8", "surrogatepass")
                        table = [0] * len(data) + [1] if k % 2 else v.prefixes(data)[0]
                        row += [total + c for c in table[1:]]
                        total += table[-1]
                rows.append(row)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.int64()))], names=["doc_id", "counts"])

    plain = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, "doc_id long, counts array<long>")
