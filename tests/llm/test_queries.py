"""The registered queries that SQL can't express, against brute force over the same tables."""

import re
from collections import Counter

import public_tokenizers
import pytest
from test_leaks import fitting
from test_leaks import words as alnum_words
from test_licences import brute as licence_brute
from test_mixing import loop_targets
from tokenizers import Tokenizer

import __spark_entry__ as entry
from monthglass.llm.components import connected
from monthglass.llm.leaks import allowed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(spark, name):
    return entry.queries()[name](spark, SF).collect()


def test_one_query_per_operator():
    names = [re.match(r"op(\d+)_", q)[1] for q in entry.queries() if re.match(r"op\d+_", q)]
    assert sorted(map(int, names)) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = rows(spark, "op3_page_layout")
    assert {r.page_id for r in got} == set(pages) and len(got) == len(pages)
    import html

    for r in got:
        seen = re.sub(r"(?is)<!--.*?-->|<(script|style|title)\b.*?</\1>", " ", pages[r.page_id].html)
        seen = html.unescape(re.sub(r"(?s)<[^>]*>?", " ", seen))
        assert r.text.replace("- ", "").split() == [w for w in seen.split() if w != "-"]


def test_quality_scores(spark, docs):
    got = rows(spark, "op4_attention_quality")
    assert {r.doc_id for r in got} == set(docs) and all(r.predicted == int(r.score >= 0.3) for r in got)


def test_leaks(spark, docs):
    items = {r.item_id: alnum_words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = {}
    for d, r in docs.items():
        w = alnum_words(r.text)
        there = Counter(w)
        for k, item in items.items():
            # An item's word that the text lacks is an edit: most pairs need no table.
            if sum((Counter(item) - there).values()) <= allowed(len(item), 0.2):
                least = fitting(item, w)
                if least <= allowed(len(item), 0.2):
                    want[d, k] = least
    got = {(r.doc_id, r.item_id): r.distance for r in rows(spark, "op6_walk_decontamination")}
    assert got == want and want


def test_mix(spark, docs):
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for d, r in docs.items()}
    total = Counter()
    for d, r in docs.items():
        total[r.source] += size[d]
    target = loop_targets(dict(total))
    taken, most = Counter(), Counter()
    for r in rows(spark, "op8_pivotal_mix"):
        s = docs[r.doc_id].source
        assert (r.size, r.source_size) == (size[r.doc_id], total[s]) and r.target == pytest.approx(target[s])
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[s] += r.taken
        most[s] = max(most[s], r.size)
    assert all(abs(taken[s] - target[s]) <= most[s] for s in total)


def test_tokens(spark, docs):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in rows(spark, "op9_prefix_tokens"):
        text = docs[r.doc_id].text
        n = len(tok.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 1024)


def test_licences(spark, docs):
    found = rows(spark, "op10_licence_index")
    assert len(found) == len(docs)
    for r in found:
        n, at, labels = licence_brute(docs[r.doc_id].text)
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(at), labels)
        assert (r.first_word, r.last_word) == ((at[0], at[-1]) if at else (None, None))


def test_components(spark):
    import random

    r = random.Random(2)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000, 1000 + i) for i in range(500)] + [(i, i + 1) for i in range(2000, 2060)]
    parent = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        p, q = sorted((root(a), root(b)))
        parent[q] = p
    df = spark.createDataFrame([*links, (None, 3), (7, 7)], "a long, b long")
    for hub in (1, 40, 1000):
        got = {x.node: x.root for x in connected(df, hub).collect()}
        assert got == {x: root(x) for a, b in links if a != b for x in (a, b)}
    assert connected(df.limit(0)).count() == 0
