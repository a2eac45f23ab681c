import hashlib
import zlib

import numpy as np
import pytest

from monthglass.llm import manifest

UP = str.maketrans(manifest.UPPER, manifest.LOWER)
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, text):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return digest("".join(map(part, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text))))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][k : k + 8])) for k in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        start = i // 8 * 8
        out.append(("".join(level[start:i]), "".join(level[i + 1 : start + 8])))
        i //= 8
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    keys = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for k in keys:
        groups[k].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = {k: tree([leaf(r, r["text"]) for r in groups[k]]) for k in keys}
    top = tree([trees[k][-1][0] for k in keys])
    out = []
    for g, k in enumerate(keys):
        for i, r in enumerate(groups[k]):
            steps = path(trees[k], i) + path(top, g)
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = text.translate(UP)
            node = leaf(r, text)
            for before, after in steps:
                node = digest(before + node + after)
            proof = digest("".join(b + a for b, a in steps))
            out.append((r["doc_id"], trees[k][0][i], trees[k][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, leaf string, grp int")


def case(n, langs):
    r = np.random.default_rng(n)
    rows = [(i * 3, f"Text {i} À{'X' * (i % 5)}", langs[min(int(r.integers(0, 2 * len(langs))), len(langs) - 1)], "s", i, "x", i) for i in range(n)]
    return [tuple(x) for x in r.permutation(np.array(rows, object)).tolist()]


def got(df, **kw):
    return sorted((tuple(r) for r in manifest.verify_documents(df, **kw).select(COLUMNS).collect()), key=str)


@pytest.mark.parametrize("height", [1, 2, 4])
@pytest.mark.parametrize(("n", "langs"), [(1, ["a"]), (9, ["a"]), (700, ["a", None, "é", "Z", ""]), (90, [f"l{k}" for k in range(70)])])
def test_equals_brute_force(spark, n, langs, height):
    df = documents(spark, case(n, langs)).repartition(5)
    assert got(df, height=height) == brute([r.asDict() for r in df.collect()])


def test_nulls_and_repeated_rows(spark):
    rows = [(None, None, None, None, None, None, None)] * 3 + [(1, "", "", "", 0, "", 1)] * 9 + [(1, None, "", "", 0, "", 1), (3, "A" * 300_000, "x", None, None, None, 2)]
    df = documents(spark, rows)
    assert got(df) == brute([r.asDict() for r in df.collect()])
    assert manifest.verify_documents(df.limit(0)).count() == 0
    assert manifest.build(manifest.document_leaves(df.limit(0))).root() is None


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 100, 513, 4097])
def test_positions_are_those_of_a_walk(n):
    sizes, order = manifest.level_sizes(n), []

    def walk(level, i):
        if level:
            for k in range(8 * i, min(8 * i + 8, sizes[level - 1])):
                walk(level - 1, k)
        order.append((level, i))

    walk(len(sizes) - 1, 0)
    for level, size in enumerate(sizes):
        want = [p for p, (k, _) in enumerate(order) if k == level]
        assert manifest.places(level, np.arange(size), n).tolist() == want


def test_log_is_in_completion_order(spark):
    leaves = manifest.document_leaves(documents(spark, case(300, ["a", "b"])))
    log = manifest.build(leaves, height=1).log.collect()
    for g in {r.grp for r in log}:
        own = sorted(r.pos for r in log if r.grp == g)
        assert own == list(range(len(own)))
        n = next(r.n for r in log if r.grp == g)
        assert len(own) == sum(manifest.level_sizes(n))


def test_a_changed_leaf_fails_and_the_rest_hold(spark):
    df = documents(spark, case(200, ["a", "b"]))
    rows = got(df)
    assert all(r[-1] == (zlib.crc32(str(r[0]).encode()) % 3 != 0) for r in rows)
