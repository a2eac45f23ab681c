"""Token counts against the public library that reads the same file."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from monthglass.llm.tokens import Vocabulary, prefix_counts, token_counts, token_marks, tokens_before, within

PATH = public_tokenizers.path("byte_bpe_50k.json")
POOL = ["\x1c", "\x85", "\xa0", " ", "  ", " ", "​", "é", "a", "b", "é", "ß", "中文", "😀", "\n", "\r\n", "1", "٣", "½", "²", "_", "-", "'s", "'", "<|endoftext|>", "<|end", "İ", "क्", "𝒳", "the", " the", "ing", "=====", "."]


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(PATH)
    return lambda s: tok.encode(s, add_special_tokens=False)


def texts(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice(POOL) for _ in range(r.randint(0, 20))) for _ in range(n)]


def test_whole_texts(spark, library):
    rows = [(i, t, 9) for i, t in enumerate(texts(1, 1500))] + [(9000, None, 1), (9001, "", 1), (9002, "x" * 30000 + " " + "y" * 5000 + "  " * 3000, 1), (9002, "again", 1), (None, "a b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(4)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts(docs, PATH).collect())
    assert got == sorted((str(d), len((t or "").encode()), len(library(t or "").ids)) for d, t, _ in rows)
    assert token_counts(docs.limit(0), PATH).count() == 0


def test_every_prefix_of_a_piece(library):
    v = Vocabulary(PATH)
    r = random.Random(2)
    for _ in range(300):
        word = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(1, 14)))
        counts, _ = v.prefixes(word.encode())
        assert counts[1:] == [len(library(word[:i]).ids) for i in range(1, len(word) + 1)]


def test_budgets(library):
    v = Vocabulary(PATH)
    for text in texts(3, 300):
        encoded = library(text)
        ends = [e.encode() for e in encoded.tokens]
        for budget in (0, 1, 3, 7, 1000):
            at, used = v.longest_prefix(text, budget)
            assert used <= min(budget, len(ends)) and at <= len(text.encode())
            if budget >= len(ends):
                assert (at, used) == (len(text.encode()), len(ends))


def test_prefix_tables(spark, library):
    rows = list(enumerate(["Hello there, general.", "", None, "naïve 中文 <|endoftext|> done"]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = token_marks(docs, PATH)
    got = {r.doc_id: (r.w, r.t) for r in marks.select("doc_id", within(3).alias("w"), tokens_before(5).alias("t")).collect()}
    assert got[0] == (len("Hello there,"), 1) and got[1] == (0, 0) and got[2] == (0, 0)
    for row in prefix_counts(docs, PATH).collect():
        text = rows[row.doc_id][1] or ""
        assert len(row.counts) == len(text.encode()) + 1 and row.counts[-1] == len(library(text).ids)
    last = marks.select("doc_id", F.try_element_at("counts", F.lit(-1)).alias("n")).where("n is not null").collect()
    assert all(r.n == len(library(rows[r.doc_id][1]).ids) for r in last)


def test_long_pieces(library):
    """Unspaced text: the same prefixes as by plain lookups, in time and memory in proportion to its length."""
    import time

    from monthglass.llm import tokens

    r = random.Random(5)
    v, plain = Vocabulary(PATH), Vocabulary(PATH)
    for k in range(40):
        alphabet = "abcdefghijklmnopqrstuvwxyz" if k % 2 else "aé=中"
        piece = "".join(r.choice(alphabet) for _ in range(r.randint(65, 300))).encode()
        long = v.prefixes(piece)
        tokens_long, tokens.LONG = tokens.LONG, 1 << 30
        try:
            assert long == plain.prefixes(piece)
        finally:
            tokens.LONG = tokens_long
    text = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") for _ in range(300_000))
    start = time.monotonic()
    assert v.count(text) == len(library(text).ids)
    assert time.monotonic() - start < 10 and not any(len(x) > tokens.LONG for x in v._counts)
