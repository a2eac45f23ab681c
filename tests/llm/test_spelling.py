import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from monthglass.llm import spelling

UP = str.maketrans(spelling.UPPER, spelling.LOWER)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(docs):
    out = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 3}


def brute(v):
    near = {w: [x for x in v if x != w and one_edit(w, x)] for w in v}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-v[x], x))
            if v[best] >= 2 * v[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(((w, form.get(w), root(w), v[w], len(near[w]), v[form[w]] if w in form else None) for w in v), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_pairs_of_a_list():
    r = random.Random(4)
    for t in range(600):
        words = sorted({"".join(r.choice("abé" if t % 2 else "ab") for _ in range(r.randint(0, 8))) for _ in range(r.randint(1, 30))})
        want = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_edit(words[i], words[j])]
        assert sorted(spelling.near_pairs(words)) == want


@pytest.mark.parametrize(("windows", "most"), [(4, 64), (1, 3), (2, 8), (40, 2)])
def test_words_equal_brute_force(spark, windows, most):
    r = random.Random(windows)
    v = defaultdict(int)
    for _ in range(700):
        stem = "".join(r.choice("abcdé") for _ in range(r.randint(1, 7)))
        v[stem + "tion" * r.randint(0, 2)] += r.choice([1, 3, 7, 20, 90])
    words = spark.createDataFrame(list(v.items()), "word string, n long")
    assert got(spelling.variants(words, windows, most)) == brute(v)


def test_long_chain_of_forms(spark):
    v = {"a" * k: 3 * 2**k for k in range(1, 40)} | {"b" * 50: 4, "c" * 3000: 5, "c" * 3001: 50}
    assert got(spelling.variants(spark.createDataFrame(list(v.items()), "word string, n long"))) == brute(v)


def test_documents(spark):
    r = random.Random(8)
    vocabulary = ["".join(r.choice("abÀèz×") for _ in range(r.randint(3, 6))) for _ in range(150)]
    docs = [(i if i % 9 else None, r.choice([" ", "-", "1", "一"]).join(r.choice(vocabulary).title() for _ in range(60))) for i in range(80)]
    docs += [(1, None), (2, ""), (3, "Word" * 50_000 + " " + "ÀB" * 9), docs[0], docs[0], (3, "😀abcde😀".encode("utf-16", "surrogatepass").decode("utf-16"))]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as word", "'x' as n", "0 as run")
    want = brute(counted(docs))
    assert got(spelling.document_variants(df)) == want and any(x[1] for x in want)
    assert spelling.document_variants(df.limit(0)).count() == 0


def test_a_common_beginning_is_dealt_out(spark):
    words = spark.createDataFrame([("prefix" + f"{i:05d}".translate(str.maketrans("0123456789", "abcdefghij")), 3 + i % 50) for i in range(3000)], "word string, n long")
    dealt = spelling.lists(words, windows=2, most=20)
    sizes = dealt.groupBy(*spelling.LIST).count().where("hi - lo > 1").agg({"count": "max"}).first()[0]
    assert sizes <= 20
