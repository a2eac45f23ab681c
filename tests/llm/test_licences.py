"""Licence scan against a direct reading of the rule."""

import random
import re

from monthglass.llm.licences import PHRASES, TEMPLATES, scan


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at, labels = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        hit = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        at += hit
        labels |= {label} if hit else set()
    return len(words), sorted(at), ",".join(sorted(labels))


def test_base_matches_brute_force(spark):
    r = random.Random(4)
    pool = ["GNU", "gnu general", "General", "public", "License", "Apache", "apache license", "CC", "by", "BY-NC", "MIT", "mit license", "x", "é", "licenKe", "K", "İ", "0"]
    gaps = [" ", "-", "_", ".", "\x00", "\n", "", "\t(", "[", "`", "{", "\x7f", "\x80", "é"]
    texts = ["".join(r.choice(pool) + r.choice(gaps) for _ in range(r.randint(0, 25))) for _ in range(400)]
    texts += [None, "", "...", " MIT License ", "CC BY", "mit\nlicense", "MIT LICENSE" * 2]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int").repartition(4)
    for row in scan(df).collect():
        assert (row.n_words, list(row.places), row.base_labels) == brute(texts[row.doc_id]), repr(texts[row.doc_id])
        assert set(row.base_labels.split(",")) <= set(row.labels.split(",")) and 0 <= row.score <= 1


def test_templates(spark):
    r = random.Random(1)
    rows, wanted = [], {}
    for i, (label, (text, _)) in enumerate(TEMPLATES.items()):
        words = text.split()
        rows.append((i, "Filler words before. " + " ".join(w.title() for w in words) + ". And after."))
        wanted[i] = label
        shuffled = words[:]
        r.shuffle(shuffled)
        rows.append((100 + i, " ".join(shuffled)))
    rows += [(200, "free software"), (201, "a mozilla in public"), (202, "This is free, unencumbered"), (300, "\n".join(t for t, _ in TEMPLATES.values()))]
    got = {x.doc_id: x for x in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, label in wanted.items():
        assert label in got[i].labels.split(","), (label, got[i])
    assert not [g for g in got.values() if g.doc_id in (200, 201, 202) and g.labels]
    assert all(not got[100 + i].found for i, label in wanted.items() if label in ("gpl", "mit", "bsd", "apache-2.0"))
    assert len(got[300].found) >= 3


def test_notices_in_many_texts(spark):
    """Notices that a third of the texts hold each, and one that all hold, are found in each of them."""
    filler = [" ".join(f"w{i}x{j}" for j in range(5)) for i in range(90)]
    for labels in (("bsd", "mpl-2.0", "unlicense"), ("isc",)):
        rows = [(i, f"{f} {TEMPLATES[labels[i % len(labels)]][0]} {f}") for i, f in enumerate(filler)]
        for x in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
            assert (x.labels, x.score) == (labels[x.doc_id % len(labels)], 1.0), x


def test_all_notices_in_one_text(spark):
    """A text that holds every notice gets every label, wherever the notices stand in it."""
    joined = "\n".join(f"{t}\nother words {k} of and the use" for k, (t, _) in enumerate(TEMPLATES.values()))
    other = " ".join(sorted({w for t, _ in TEMPLATES.values() for w in t.split()}))
    rows = [(0, joined), (1, f"{other} {joined} {other}"), (2, other)]
    got = {x.doc_id: x for x in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in (0, 1):
        assert set(TEMPLATES) <= set(got[i].labels.split(",")) and len(got[i].found) == len(TEMPLATES)
    assert not got[2].labels and got[2].score == 0


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert scan(none).count() == 0
    rows = [(None, "MIT License"), (1, "MIT License"), (1, "MIT License"), (2, None)]
    got = sorted((str(x.doc_id), x.n_words, x.base_labels, x.score) for x in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [("1", 2, "mit", 1.0), ("1", 2, "mit", 1.0), ("2", 0, "", 0.0), ("None", 2, "mit", 1.0)]


MENTIONS = [
    "Returns are accepted with or without fee at the counter",
    "redistribution and use in source and binary forms of heat",
    "we sell unencumbered software",
    "the Mozilla Public License is one of several licences",
    "he joined the free software foundation last year, without restriction",
    "charges are hereby granted free of charge and without restriction of use",
]


def test_mentions_are_not_marked(spark):
    """Key phrases alone, or next to a few other words of their notice, mark nothing; whole notices beside them are found."""
    r = random.Random(7)
    pool = [f"word{k}" for k in range(50)]
    filler = lambda: " ".join(r.choice(pool) for _ in range(30))
    rows = [(i, f"{filler()} {m} {filler()}") for i, m in enumerate(MENTIONS * 5)]
    rows += [(100 + i, f"{filler()} {t} {filler()} {MENTIONS[i % len(MENTIONS)]}") for i, (t, _) in enumerate(TEMPLATES.values())]
    got = {x.doc_id: x for x in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(i, got[i].labels) for i in range(len(MENTIONS) * 5) if got[i].labels] == []
    for i, label in enumerate(TEMPLATES):
        assert label in got[100 + i].labels.split(",")


def template_brute(texts, kept=16, support=0.6):
    """Labels and shares by trying every distance of every template in every text."""
    import math

    split = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower()) for t in texts]
    df = {}
    for w in split:
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    out = []
    for words in split:
        found = {}
        for label, (text, keys) in TEMPLATES.items():
            own = text.split()
            rare = sorted(set(own), key=lambda w: (df.get(w, 0), w))[:kept]
            weigh = {w: max(1, round(1000 * math.log((len(texts) + 1) / (df.get(w, 0) + 1)))) for w in rare}
            indexed = [(p, w) for p, w in enumerate(own) if w in weigh]
            if not all(any(words[i : i + len(k.split())] == k.split() for i in range(len(words))) for k in keys):
                continue
            best = max(
                (sum(weigh[w] for p, w in hits), len(hits))
                for d in range(-len(own), len(words))
                for hits in [[(p, w) for p, w in indexed if 0 <= p + d < len(words) and words[p + d] == w]]
            )
            share = best[0] / sum(weigh[w] for _, w in indexed)
            if share >= support and 2 * best[1] >= len(indexed) and best[1] >= 2:
                found[label] = share
        out.append(found)
    return out


def test_templates_match_brute_force(spark):
    r = random.Random(12)
    texts = []
    for _ in range(150):
        words = []
        for _ in range(r.randint(1, 3)):
            own = r.choice(list(TEMPLATES.values()))[0].split()
            start, end = (0, len(own)) if r.random() < 0.4 else sorted((r.randrange(len(own)), r.randint(1, len(own))))
            words += [w if r.random() > 0.06 else "other" for w in own[start:end]] + ["between", f"n{r.randrange(9)}"]
        texts.append(" ".join(words))
    got = {x.doc_id: x for x in scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    marked = 0
    for i, want in enumerate(template_brute(texts)):
        assert {f["label"]: round(f["share"], 9) for f in got[i].found} == {k: round(v, 9) for k, v in want.items()}, texts[i]
        marked += len(want)
    assert marked > 40
