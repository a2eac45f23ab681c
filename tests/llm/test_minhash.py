"""HyperMinHash near-duplicates against brute force over all pairs."""

import itertools
import random
import re

import numpy as np
import pytest

from monthglass.llm.minhash import Shape, estimate, near_duplicates, registers
from monthglass.llm.words import mix


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)}


def brute(rows, k, percent):
    """{doc_id: (set size, smallest reachable id)}"""
    sets = {d: shingles(t, k) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((root(a), root(b)))
            parent[q] = p
    return {d: (len(sets[d]), root(d)) for d in sets}


def made(seed=1, groups=25):
    """Groups of near copies around the threshold, short texts, chains and copies."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(2, 5)))
    texts = []
    for g in range(groups):
        base = [word() for _ in range(r.choice([1, 2, 4, 7, 9, 30, 120, 400]))]
        for _ in range(r.randint(1, 9)):
            t = list(base)
            for _ in range(r.randint(0, 1 + len(t) // 25)):
                t[r.randrange(len(t))] = word()
            if r.random() < 0.3:
                t = [w.upper() for w in t]
            texts.append(r.choice([" ", "\n", "\t "]).join(t))
    texts += ["", None, " \n ", texts[0], texts[0], "solo"]
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("k", "percent", "seed"), [(3, 85, 1), (5, 80, 2)])
def test_matches_brute_force(spark, k, percent, seed):
    rows = made(seed)
    docs = spark.createDataFrame([(d, t, "x", d) for d, t in rows], "doc_id long, text string, set_id string, key long").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, k, percent).collect()}
    assert got == brute(rows, k, percent)


def test_large_group_of_near_copies(spark):
    """Variants whose similarity to each other lies around the threshold: most links are not with the least or greatest."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for d in range(400):
        t = list(base)
        for _ in range(r.randint(1, 4)):
            t[r.randrange(90)] = f"x{r.random()}"
        rows.append((d, " ".join(t)))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == brute(rows, 3, 85)


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(none, 3, 85).count() == 0
    rows = [(None, "one two three four"), (7, "one two three four"), (7, "one two three four"), (None, None), (3, None), (None, "nothing else like it")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert sorted((str(x.doc_id), x.n_shingles, str(x.component_id), x.kept) for x in got) == sorted(
        [("None", 2, "7", False), ("7", 2, "7", True), ("7", 2, "7", True), ("None", 0, "None", True), ("3", 0, "3", True), ("None", 2, "None", True)]
    )


def test_estimate_corrects_chance():
    shape = Shape(85, 3)
    rng = np.random.default_rng(0)
    worst = []
    for share in (0.0, 0.5, 0.85):
        values = []
        for _ in range(30):
            n = 4000
            common = int(2 * n * share / (1 + share))
            both = rng.integers(0, 2**63, common, dtype=np.uint64)
            sets = [mix(np.concatenate([both, rng.integers(0, 2**63, n - common, dtype=np.uint64)])) for _ in range(2)]
            regs, own = registers(np.concatenate(sets), np.array([0, n, 2 * n]), shape.registers)
            values.append(estimate(np.array([(regs[0] == regs[1]).sum()]), np.array([(own[0] | own[1]).sum()]), np.array([n]), np.array([n]), shape.registers)[0])
        worst.append(abs(np.mean(values) - share))
    assert max(worst) < 0.02
