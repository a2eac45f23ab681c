"""Three-line windows against a direct reading of the rule."""

import random

from monthglass.llm.windows import drop_repeated_windows


def brute(rows):
    """rows in (doc_id, ...) order with distinct ids."""
    seen, out = set(), {}
    for d, text in sorted(rows):
        lines = text.split("\n")
        full = [i for i, x in enumerate(lines) if x.strip(" \t\r\x0b\x0c")]
        gone = set()
        for k in range(len(full) - 2):
            key = tuple(lines[i] for i in full[k : k + 3])
            if key in seen:
                gone |= set(full[k : k + 3])
            seen.add(key)
        out[d] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(full), len(gone))
    return out


def test_matches_brute_force(spark):
    r = random.Random(3)
    rows = [(d, "\n".join(r.choice(["a", "b", "c", " ", "", "é x", "\t"]) for _ in range(r.randint(0, 12)))) for d in range(200)]
    rows += [(500, "same\n" * 30), (501, "\n\n" + "same\n" * 5)]
    docs = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id long, text string, at int, key string").repartition(4)
    out = drop_repeated_windows(docs)
    assert out.columns == ["doc_id", "text", "at", "key", "n_lines", "n_removed"]
    assert {x.doc_id: (x.text, x.n_lines, x.n_removed) for x in out.collect()} == brute(rows)


def test_edges(spark):
    schema = "doc_id long, text string, n_lines string"
    assert drop_repeated_windows(spark.createDataFrame([], schema)).count() == 0
    three = "x\ny\nz"
    rows = [(1, three), (1, three), (2, three), (None, three), (3, None), (None, None), (4, "x\ny"), (5, "")]
    got = sorted((str(x.doc_id), str(x.text), x.n_lines, x.n_removed) for x in drop_repeated_windows(spark.createDataFrame([(*r, "") for r in rows], schema)).collect())
    assert got == sorted(
        [("1", three, 3, 0), ("1", three, 3, 0), ("2", "", 3, 3), ("None", "", 3, 3), ("3", "None", 0, 0), ("None", "None", 0, 0), ("4", "x\ny", 2, 0), ("5", "", 0, 0)]
    )
