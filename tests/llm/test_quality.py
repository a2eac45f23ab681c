"""Base measures and the cascade against a plain reading of the rules."""

import collections
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from monthglass.llm.batches import KEY, small_batches
from monthglass.llm.quality import BASE, RULES, Rule, Texts, by_worth, cascade, keep_good, measure, quality_rules
from monthglass.llm.words import pieces
from monthglass.session import apart


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    there = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(there)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(1)
    made = ["".join(r.choice(["a", "b", " ", "\n", "\t", "é", "#", "AB", "\x0b", "中"]) for _ in range(r.randint(0, 80))) for _ in range(600)]
    return [*made, None, "", " ", "\n\n", "a\na\n a\na", "x x x x x", "HELLO THERE " * 60, "w " * 49, " ".join(map(str, range(50))), "long " * 40_000]


def test_measures(texts):
    column = pa.array(texts)
    for lo, hi in pieces(column, 500):
        t = Texts(column.slice(lo, hi - lo))
        got = list(zip(*(x.tolist() for x in (t.n_words, t.word_chars, t.count(np.isin(np.arange(256), list(b"#*$%&|<>"))), t.lines[1], t.repeat_words))))
        assert got == [brute(x) for x in texts[lo:hi]]
        assert t.distinct_words.tolist() == [len(set(re.findall(r"[^\x20\x09-\x0D]+", x or ""))) for x in texts[lo:hi]]


def test_verdict_does_not_depend_on_the_order(texts):
    column = pa.array(texts)
    alive = ~(BASE[0].rejects(Texts(column)) | BASE[1].rejects(Texts(column)))
    first = cascade(column, RULES, alive)
    assert (cascade(column, RULES[::-1], alive) == first).all()
    each = alive & ~np.any([r.rejects(Texts(column)) for r in RULES], axis=0)
    assert (each == first).all() and not first[texts.index("HELLO THERE " * 60)]


def test_later_rules_see_only_what_is_left(texts):
    looked = []

    def counting(t):
        looked.append(len(t.texts))
        return t.n_words < 10

    cascade(pa.array(texts), [Rule("short", counting), Rule("again", counting)], np.ones(len(texts), bool))
    assert looked[0] == len(texts) and looked[1] == sum(brute(x)[0] >= 10 for x in texts)


def test_order_by_rejection_per_cost(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    found = measure(df, [*RULES, *BASE], sample=200)
    assert [n for n, _, _ in found] == [r.name for r in (*RULES, *BASE)]
    assert all(cost > 0 and 0 <= share <= 1 for _, cost, share in found) and dict((n, s) for n, _, s in found)["few_words"] > 0.5
    order = by_worth([Rule("a", None), Rule("b", None), Rule("c", None)], [("a", 1.0, 0.5), ("b", 0.1, 0.4), ("c", 5.0, 0.0)])
    assert [r.name for r in order] == ["b", "a", "c"]


def test_operator(spark, texts):
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, kept string").repartition(3)
    rows = {r.doc_id: r for r in quality_rules(df).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    kept = keep_good(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.kept}


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert quality_rules(none).count() == 0 and keep_good(none).count() == 0
    good = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(None, good), (1, good), (1, good), (2, None)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.kept) for r in quality_rules(df).collect()) == [("1", True), ("1", True), ("2", False), ("None", True)]


def test_memory_of_a_worker(spark):
    """A worker's arrays are many times a piece's bytes, so pieces and batches are small."""
    column = pa.array(["some words of a plain text " * 80] * 4_000)
    rules = [*BASE, *RULES]
    tracemalloc.start()
    try:
        kept = [cascade(column.slice(lo, hi - lo), rules, np.ones(hi - lo, bool)) for lo, hi in pieces(column)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(map(len, kept)) == len(column)
    assert peak < 15e6
    own = apart(spark)
    own.conf.unset(KEY)
    small_batches(own.range(1))
    assert int(own.conf.get(KEY)) <= 4 << 20
