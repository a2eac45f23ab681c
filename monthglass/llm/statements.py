"""SQL of the vector join, the spelling variants and the manifest, for DuckDB."""

from __future__ import annotations

#: Levels of the manifest's trees that the statement has: over up to 8^7 documents a language, and 8^3 languages.
LEVELS, TOP_LEVELS = 7, 3

#: The remainders of the public checksum for half a byte.
HALF_BYTES = (
    0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
    0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C,
)


def crc32(text: str) -> str:
    """The unsigned checksum of a text's UTF-8 bytes: half bytes, the lower one first."""
    digits = f"hex(encode({text}))"
    half = f"strpos('0123456789ABCDEF', substr({digits}, 2 * ((k - 1) // 2) + 2 - (k - 1) % 2, 1)) - 1"
    halves = f"list_transform(range(1, len({digits}) + 1), lambda k: CAST({half} AS BIGINT))"
    table = f"[{', '.join(map(str, HALF_BYTES))}]"
    start = "CAST(4294967295 AS BIGINT)"
    return f"xor(list_reduce({halves}, lambda c, x: xor({table}[(xor(c, x) & 15) + 1], c >> 4), {start}), {start})"


VECTORS = """
WITH RECURSIVE t AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
v AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM t
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.size * b.size) >= 0.95),
r(vec, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.vec),
c AS (SELECT vec, min(root) AS root FROM r GROUP BY vec),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT c.vec AS vec_id, coalesce(n.n, 0) AS n_links, c.root AS component_id, c.vec = c.root AS kept
FROM c LEFT JOIN n ON n.a = c.vec"""

SMALL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

VARIANTS = f"""
WITH RECURSIVE o AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all({SMALL.format("coalesce(text, '')")}, '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
d AS (SELECT id, run, count(*) AS n FROM o WHERE length(run) >= 5 GROUP BY id, run),
h AS (SELECT run, n, {crc32("id || ':' || run")} AS h FROM d),
k AS (SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM k WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
c AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
m AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM c),
p AS (
  SELECT a.word, b.word AS other, b.n FROM m AS a JOIN m AS b ON a.i = b.i AND a.rest = b.rest AND length(a.word) = length(b.word) AND a.word <> b.word
  UNION SELECT m.word, v.word, v.n FROM m JOIN v ON v.word = m.rest
  UNION SELECT v.word, m.word, m.n FROM m JOIN v ON v.word = m.rest),
q AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM p),
f AS (
  SELECT v.word, v.n, coalesce(q.n_near, 0) AS n_near, CASE WHEN q.n >= 2 * v.n THEN q.other END AS form, CASE WHEN q.n >= 2 * v.n THEN q.n END AS form_n
  FROM v LEFT JOIN q ON q.word = v.word AND q.place = 1),
g(word, last) AS (SELECT word, word FROM f UNION ALL SELECT g.word, f.form FROM g JOIN f ON f.word = g.last WHERE f.form IS NOT NULL)
SELECT f.word, f.form, g.last AS root, f.n, f.n_near, f.form_n
FROM f JOIN g ON g.word = f.word JOIN f AS e ON e.word = g.last WHERE e.form IS NULL"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, levels: int) -> str:
    """CTEs of a tree's levels over {name}0(g, i, h), and per level what stands before and after a node."""
    out = []
    for k in range(levels):
        out.append(
            f"{name}c{k} AS (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM {name}{k}),\n"
            f"{name}{k + 1} AS (SELECT g, i // 8 AS i, CASE WHEN max(c) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h\n"
            f"  FROM {name}c{k} GROUP BY g, i // 8),\n"
            f"{name}s{k} AS (\n"
            f"  SELECT x.g, x.i, any_value(x.c) AS c, coalesce(string_agg(CASE WHEN y.i < x.i THEN y.h END, '' ORDER BY y.i), '') AS b,\n"
            f"    coalesce(string_agg(CASE WHEN y.i > x.i THEN y.h END, '' ORDER BY y.i), '') AS a\n"
            f"  FROM {name}c{k} AS x JOIN {name}c{k} AS y ON x.g = y.g AND x.i // 8 = y.i // 8 GROUP BY x.g, x.i),\n"
        )
    return "".join(out)


def _folds(source: str, name: str, group: str, at: str, levels: int, out: str) -> str:
    """CTEs that carry each row's node and siblings up through a tree."""
    made = []
    for k in range(levels):
        last = source if k == 0 else f"{out}{k}"
        made.append(
            f"{out}{k + 1} AS (\n"
            f"  SELECT z.* EXCLUDE (node, sib), CASE WHEN s.c = 1 THEN z.node ELSE sha256(s.b || z.node || s.a) END AS node, z.sib || s.b || s.a AS sib\n"
            f"  FROM {last} AS z JOIN {name}s{k} AS s ON s.g = z.{group} AND s.i = z.{at} // {8**k}),\n"
        )
    return "".join(made)


MANIFEST = f"""
WITH d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf("text")} AS h,
    CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {_leaf(SMALL.format("text"))} ELSE {_leaf("text")} END AS node FROM documents),
e AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM d),
n0 AS (SELECT g, i, h FROM e),
{_tree("n", LEVELS)}
w AS (SELECT g AS lang, h, row_number() OVER (ORDER BY g) - 1 AS place FROM n{LEVELS}),
t0 AS (SELECT '' AS g, place AS i, h FROM w),
{_tree("t", TOP_LEVELS)}
y AS (SELECT e.doc_id, e.g, e.h AS leaf, e.i, w.h AS subroot, w.place, '' AS top, e.node, '' AS sib FROM e JOIN w ON w.lang = e.g),
{_folds("y", "n", "g", "i", LEVELS, "u")}
{_folds(f"u{LEVELS}", "t", "top", "place", TOP_LEVELS, "x")}
z AS (SELECT x.*, r.h AS root FROM x{TOP_LEVELS} AS x, t{TOP_LEVELS} AS r)
SELECT doc_id, leaf, subroot, root, sha256(sib) AS proof_sha256, node AS folded_root, node = root AS verified FROM z"""
