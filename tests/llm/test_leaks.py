"""Decontamination against the edit distance of every item to every text."""

import random
import re
import tracemalloc

import numpy as np
import pytest

from monthglass.llm import leaks
from monthglass.llm.leaks import allowed, distance, embed, find_leaks, functions, without_leaks


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def fitting(item, text):
    """Plain table: least edits from the item to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item):
        new = [i + 1]
        for j, v in enumerate(text):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (v != w)))
        row = new
    return min(row)


def made(seed, n_items, n_docs):
    r = random.Random(seed)
    common = ["the", "of", "and", "de", "la"]
    word = lambda: r.choice(common) if r.random() < 0.4 else "".join(r.choice("abcdeé") for _ in range(5))
    items = [(k, " ".join(word() for _ in range(r.randint(8, 60)))) for k in range(n_items)]
    docs = []
    for d in range(n_docs):
        body = [word() for _ in range(r.randint(0, 150))]
        if d % 2:
            w = items[r.randrange(n_items)][1].split()
            for _ in range(r.randint(0, len(w) // 4)):
                i = r.randrange(len(w))
                w[i : i + 1] = r.choice([[word()], [word(), w[i]], []])
                w = w or [word()]
            at = r.randint(0, len(body))
            body[at:at] = [x.upper() for x in w]
        docs.append((d, r.choice([" ", ", ", "\n"]).join(body)))
    return docs, items


def test_distance():
    r = random.Random(1)
    for _ in range(300):
        a, b = ([r.randrange(4) for _ in range(r.randint(1, 9))] for _ in range(2))
        assert distance(np.array(a, np.uint64), np.array(b, np.uint64)) == fitting(a, b)


def test_recall_and_exactness(spark):
    docs, items = made(2, 40, 400)
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item_id int").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id): x.distance for x in find_leaks(df, bench).collect()}
    want = {}
    for d, t in docs:
        w = words(t)
        for k, item in items:
            i = words(item)
            least = fitting(i, w)
            if least <= allowed(len(i), 0.2):
                want[d, k] = least
    assert set(got) <= set(want) and len(got) >= 0.98 * len(want)
    assert all(got[x] >= want[x] for x in got) and np.mean([got[x] == want[x] for x in got]) > 0.95
    assert {x for x, d in want.items() if d == 0} <= set(got)
    kept = {x.doc_id for x in without_leaks(df, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in got}


def test_walk_moves_by_random_bits():
    words = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    place = embed(words, 3, 1500)
    assert place[0] == 0 and set(np.diff(place)) == {0, 1} and 650 < place[-1] < 850
    assert len(functions([words[:5], words[:0], words[:1]], 4).anchor) == 8


def test_long_items_need_little_memory():
    words = np.arange(5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    tracemalloc.start()
    place = embed(words, 5, 15000)
    made = functions([words], 8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20 and len(made.anchor) == 8
    at = 0
    for j in range(300):
        assert place[j] == at
        at += int(leaks._bit(np.uint64(5), np.uint64(j), words[at : at + 1])[0])


def test_every_function_finds_an_exact_copy():
    """Also those of items of one to three words, which start at step 0 with fewer later steps."""
    for n in (1, 2, 3, 9):
        item = np.arange(7, 7 + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        row, _, begin, seed = leaks.collisions(item, np.array([0, n]), functions([item], 32))
        assert set(seed.tolist()) == set(range(32)) and set(begin.tolist()) == {0}, n


def test_blocks_are_found_one_after_another(spark, monkeypatch):
    _, items = made(5, 30, 0)
    docs = [(d, f"before {items[d % 30][1]} after" if d % 2 else f"nothing {d}") for d in range(120)] + [(None, None), (None, items[0][1])]
    df = spark.createDataFrame([(d, t, "k") for d, t in docs], "doc_id long, text string, _key string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(leaks, "ITEM_WORDS", 400)
    blocks = [(len(ids), more) for ids, _, more in leaks.item_blocks(bench)]
    assert len(blocks) > 2 and sum(n for n, _ in blocks) == 30 and [more for _, more in blocks] == [True] * (len(blocks) - 1) + [False]
    out = find_leaks(df, bench)
    # Only the last block is still to be searched; the others' matches are tables.
    assert out._jdf.queryExecution().analyzed().toString().count("MapInArrow") == 1
    got = {(x.doc_id, x.item_id): x.distance for x in out.collect()}
    assert {x for x, far in got.items() if far == 0} == {(d, d % 30) for d, _ in docs if d and d % 2} | {(None, 0)}
    kept = without_leaks(df, bench)
    assert kept.columns == df.columns and sorted((str(x.doc_id), str(x.text)) for x in kept.collect()) == sorted((str(d), str(t)) for d, t in docs if not t or t.startswith("nothing"))


@pytest.mark.parametrize("which", ["docs", "items", "both"])
def test_empty_tables(spark, which):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([] if which in ("docs", "both") else [(1, "a b c")], schema)
    items = spark.createDataFrame([] if which in ("items", "both") else [(1, "a b c")], "item_id long, text string")
    assert find_leaks(docs, items).count() == 0 and without_leaks(docs, items).count() == docs.count()


def test_edges(spark):
    items = spark.createDataFrame([(1, "one"), (2, "one two three four five"), (None, "six seven"), (4, ""), (5, None), (6, "..."), (2, "one two three four five")], "item_id long, text string")
    rows = [(None, "x One y"), (1, "ONE, two three.four five"), (1, "ONE, two three.four five"), (2, None), (3, ""), (4, "six\nseven"), (5, "one two three nine five")]
    got = sorted((str(x.doc_id), str(x.item_id), x.distance, x.first_word) for x in find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect())
    one = [("1", "1", 0, 0), ("1", "2", 0, 0)]
    assert got == sorted([("None", "1", 0, 1), *one, *one, ("4", "None", 0, 0), ("5", "1", 0, 0), ("5", "2", 1, 0)])


def edited(item, r):
    w = list(item)
    for _ in range(allowed(len(item), 0.2)):
        i = r.randrange(len(w))
        w[i : i + 1] = r.choice([[r.randrange(1 << 60)], [r.randrange(1 << 60), w[i]], []])
    return w


def found_share(items, f, classes, trials=6):
    """Per class, the share of copies with all allowed edits that are found among other words."""
    r = random.Random(3)
    hit, total = {}, {}
    for k, item in enumerate(items):
        for _ in range(trials):
            around = [r.randrange(1 << 60) for _ in range(40)]
            text = np.array([*around[:20], *edited(item.tolist(), r), *around[20:]], np.uint64)
            got = leaks.matches(text, np.array([0, len(text)]), items, f, 0.2)
            total[classes[k]] = total.get(classes[k], 0) + 1
            hit[classes[k]] = hit.get(classes[k], 0) + ((0, k) in got)
    return {c: hit[c] / total[c] for c in total}


def test_every_length_class_reaches_the_target():
    """Many short items, which need one function each, beside few long ones."""
    r = np.random.default_rng(5)
    vocabulary = r.integers(0, 1 << 62, 400).astype(np.uint64)
    items = [r.choice(vocabulary, n) for n, many in ((4, 300), (7, 60), (20, 60), (60, 60), (200, 12)) for _ in range(many)]
    rounds = leaks.rounds_for(items, 0.2, 0.99)
    classes = [leaks.length_class(w) for w in items]
    assert {c: len({n for n, x in zip(rounds.tolist(), classes) if x == c}) for c in classes} == dict.fromkeys(classes, 1)
    shares = found_share(items, functions(items, rounds), classes)
    assert min(shares.values()) >= 0.98 and np.mean(list(shares.values())) >= 0.99, shares


def test_pieces_miss_nothing(monkeypatch):
    monkeypatch.setattr(leaks, "TRIED", (1,))
    r = np.random.default_rng(6)
    items = [r.integers(0, 50, n).astype(np.uint64) for n in (5, 9, 30, 80) for _ in range(15)]
    rounds = leaks.rounds_for(items, 0.2, 0.99)
    assert set(rounds.tolist()) == {leaks.PIECES}
    f = functions(items, rounds)
    assert len(f.anchor) == sum(allowed(len(w), 0.2) + 1 for w in items)
    assert set(found_share(items, f, [len(w) for w in items]).values()) == {1.0}
