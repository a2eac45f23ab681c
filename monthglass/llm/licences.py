"""Licence scan: a positional index of rare words, in DataFrame functions only.

Templates are short public licence notices. The index holds, for each word of a
template that is among its rarest in the corpus, its places in the templates. Where a
template's mandatory key phrases stand in a text, all the text's words of its index are
looked up; places that stand at the same distance in the text and in the template
support each other, each by its word's IDF. A template is reported if they hold enough of
its whole indexed weight and at least half of its indexed places: a text that only
mentions a licence, or holds its key phrase in other matters, is not marked. Plain names
(`PHRASES`) are found by themselves and always reported.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names that count as a licence mention, and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: label -> (opening of the public notice, key phrases that must all be there).
TEMPLATES: Mapping[str, tuple[str, tuple[str, ...]]] = {
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
        "as published by the free software foundation either version 3 of the license or at your option any later version",
        ("free software foundation",),
    ),
    "gpl-grant": ("this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    "lgpl": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license",
        ("gnu lesser general public license",),
    ),
    "apache-2.0": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
        "you may obtain a copy of the license at",
        ("apache license version 2 0",),
    ),
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction",
        ("hereby granted free of charge", "without restriction"),
    ),
    "mit-grant": ("released under the mit license", ("mit license",)),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("with or without fee",),
    ),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    "cc-by": ("this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    "cc-by-nc": ("licensed under cc by nc 4 0", ("cc by nc",)),
    "unlicense": ("this is free and unencumbered software released into the public domain", ("unencumbered software",)),
}

#: Bytes between words: all ASCII but letters and digits.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAPS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words_of(text: Column) -> Column:
    """The text's words, A-Z made small: runs of ASCII letters and digits and of all other characters; null has none.

    Only one other character has a small form in ASCII, the Kelvin sign; it is taken out
    of the way. Other capitals may become small, but no word of ASCII letters arises.
    """
    folded = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138")))
    inner = F.trim(folded, F.lit(GAPS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, GAP))


def vocabulary(templates: Mapping[str, tuple[str, Sequence[str]]] = TEMPLATES) -> list[str]:
    return sorted({w for text, _ in templates.values() for w in text.split()})


def document_frequency(texts: DataFrame, words: Sequence[str], text_col: str = "text") -> tuple[int, dict[str, int]]:
    """(number of texts, texts that hold each of the given words).

    Only words of the given list leave a task, so what comes back has one row a word.
    """
    held = F.array_distinct(F.filter(words_of(F.col(text_col)), lambda w: w.isin(list(words))))
    counted = texts.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    found = {r.w: r.n for r in counted.collect()}
    return found.pop("", 0), found


def positional_index(df: Mapping[str, int], n: int, kept: int, templates=TEMPLATES) -> dict[str, tuple[float, list[tuple[int, int]]]]:
    """word -> (idf, its (template, place) postings), for the `kept` rarest words of each template.

    However frequent a template's words are, its rarest ones are in the index.
    """
    out: dict[str, tuple[float, list[tuple[int, int]]]] = {}
    for k, (text, _) in enumerate(templates.values()):
        words = text.split()
        own = sorted(set(words), key=lambda w: (df.get(w, 0), w))[:kept]
        for place, w in enumerate(words):
            if w in own:
                out.setdefault(w, (math.log((n + 1) / (df.get(w, 0) + 1)), []))[1].append((k, place))
    return out


def _places(words: Column, phrase: str) -> Column:
    """Where the phrase's words stand one after another (0: the first word)."""
    parts = phrase.split()
    starts = F.sequence(F.lit(0), F.size(words) - F.lit(len(parts)))
    hit = lambda i: _all([F.get(words, i + k) == w for k, w in enumerate(parts)])
    return F.when(F.size(words) >= len(parts), F.filter(starts, hit)).otherwise(F.array().cast("array<int>"))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _heaviest_run(sorted_places: Column) -> Column:
    """(weight, n) of the distance whose places weigh most; places are (d, weight) in the order of d."""
    start = F.struct(F.lit(None).cast("int").alias("d"), *[F.lit(0).cast("long").alias(c) for c in ("weight", "n", "best", "best_n")])

    def step(acc, v):
        same = F.coalesce(acc["d"] == v["d"], F.lit(False))
        weight, n = F.when(same, acc["weight"]).otherwise(F.lit(0)) + v["weight"], F.when(same, acc["n"]).otherwise(F.lit(0)) + 1
        more = weight > acc["best"]
        best, best_n = F.when(more, weight).otherwise(acc["best"]), F.when(more, n).otherwise(acc["best_n"])
        return F.struct(v["d"].alias("d"), weight.alias("weight"), n.alias("n"), best.alias("best"), best_n.alias("best_n"))

    return F.aggregate(sorted_places, start, step, lambda acc: F.struct(acc["best"].alias("weight"), acc["best_n"].alias("n")))


def scan(
    docs: DataFrame,
    templates: Mapping[str, tuple[str, Sequence[str]]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    kept: int = 16,
    support: float = 0.6,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, places, base_labels, labels, score, found.

    ``places`` are the starts of all base phrases in order, ``found`` the templates
    with their share of supporting words. The score is 1 for a base label, else the
    best template's share, else 0. Null and empty texts have no words, no labels and
    score 0. Every row is scanned by itself; ids may repeat or be null, other columns
    are not looked at.
    """
    vocab = vocabulary(templates)
    n, df = document_frequency(docs.select(F.col(text_col).alias("text")), vocab)
    index = positional_index(df, n, kept, templates)
    heads = {p.split()[0] for p, _ in phrases}
    # A template needs all its key phrases, hence the rarest word of any one of them.
    needed = {min(keys[0].split(), key=lambda w: (df.get(w, 0), w)) for _, keys in templates.values()}

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Texts without any of the words that a finding needs are not looked at further.
    anything = F.col("text").rlike("(?i)" + "|".join(sorted(heads | needed)))
    listed = plain.select("doc_id", words_of(F.col("text")).alias("all"), F.coalesce(anything, F.lit(False)).alias("any"))
    nothing = F.array().cast("array<string>")
    listed = listed.select("doc_id", F.size("all").cast("long").alias("n_words"), F.when(F.col("any"), F.col("all")).otherwise(nothing).alias("words"))
    for k, (phrase, _) in enumerate(phrases):
        listed = listed.withColumn(f"p{k}", _places(F.col("words"), phrase))
    places = F.array_sort(F.concat(*[F.col(f"p{k}") for k in range(len(phrases))]))
    base = F.array_compact(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(phrases)]))
    listed = listed.withColumn("places", places).withColumn("base", F.array_sort(F.array_distinct(base)))

    found = _templates_found(listed, index, templates, support)
    labels = F.array_sort(F.array_distinct(F.concat("base", F.transform("found", lambda f: f["label"]))))
    best = F.coalesce(F.array_max(F.transform("found", lambda f: f["share"])), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        "places",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(best).alias("score"),
        "found",
    )


def _templates_found(listed: DataFrame, index, templates, support: float) -> DataFrame:
    """Adds found: the templates whose indexed words stand in the text in their own order and distance.

    Templates whose key phrases are not all in the text are passed over before any posting
    is met; for the others all hits of all their indexed words count.
    """
    none = F.array().cast("array<struct<label:string,share:double>>")
    if not index:
        return listed.withColumn("found", none)
    # No word holds a space, so the phrase between spaces is the phrase's words one after another.
    spaced = listed.withColumn("spaced", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    keyed = [_all([F.contains(F.col("spaced"), F.lit(f" {' '.join(key.split())} ")) for key in keys]) for _, keys in templates.values()]
    held = spaced.select("*", *[x.alias(f"k{k}") for k, x in enumerate(keyed)])
    at = F.filter(F.transform(F.col("words"), lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: h["w"].isin(sorted(index)))
    any_key = F.array_contains(F.array(*[F.col(f"k{k}") for k in range(len(templates))]), True)
    held = held.withColumn("hits", F.when(any_key, at).otherwise(F.array().cast("array<struct<w:string,i:int>>")))
    made = []
    for k, label in enumerate(templates):
        postings = {w: [p for t, p in found if t == k] for w, (_, found) in index.items()}
        postings = {w: places for w, places in postings.items() if places}
        if not postings:
            continue
        # A word weighs as its IDF says, in thousandths; words that all texts hold count among themselves.
        weigh = {w: max(1, round(1000 * index[w][0])) for w in postings}
        at_ = lambda w, ps: F.array(*[F.struct(F.lit(p).alias("p"), F.lit(weigh[w]).cast("long").alias("weight")) for p in ps])  # noqa: B023, E731
        places = F.create_map(*[x for w, ps in postings.items() for x in (F.lit(w), at_(w, ps))])
        own = F.filter("hits", lambda h: h["w"].isin(list(postings)))  # noqa: B023
        held = held.withColumn(f"own{k}", F.when(F.col(f"k{k}"), own))
        met = lambda h: F.transform(F.element_at(places, h["w"]), lambda q: F.struct((h["i"] - q["p"]).alias("d"), q["weight"].alias("weight")))  # noqa: B023, E731
        held = held.withColumn(f"run{k}", F.when(F.col(f"k{k}"), _heaviest_run(F.sort_array(F.flatten(F.transform(f"own{k}", met))))))
        # Of the template's whole indexed weight, and of its indexed places, so a key phrase alone is not enough.
        whole, n_places = sum(weigh[w] * len(ps) for w, ps in postings.items()), sum(map(len, postings.values()))
        run, share = F.col(f"run{k}"), F.col(f"run{k}.weight").cast("double") / F.lit(float(whole))
        enough = (run["n"] >= min(2, n_places)) & (2 * run["n"] >= n_places) & (share >= support)
        made.append(F.when(enough, F.struct(F.lit(label).alias("label"), F.least(share, F.lit(1.0)).alias("share"))))
    return held.withColumn("found", F.array_compact(F.array(*made)) if made else none)
