"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import query
from . import leaks, licences, manifest, metric_join, minhash, mixing, pages, passages, quality, spelling, tokens, toxic, windows
from .statements import MANIFEST, VARIANTS, VECTORS

WORDS_SQL = "list_filter(regexp_split_to_array({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_minhash_near_dedup",
    f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {WORDS_SQL.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n AS x ON x.doc_id = p.a JOIN n AS y ON y.doc_id = p.b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc)
SELECT q.doc AS doc_id, coalesce(n.n, 0) AS n_shingles, q.root AS component_id, q.doc = q.root AS kept
FROM (SELECT doc, min(root) AS root FROM r GROUP BY doc) AS q LEFT JOIN n ON n.doc_id = q.doc""",
)
def op1(spark, sf):
    found = minhash.near_duplicates(table(spark, sf, "documents"), words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query(
    "op2_line_windows",
    """
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
f AS (
  SELECT doc_id, line, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
w AS (
  SELECT doc_id, k, line, lead(line, 1) OVER (PARTITION BY doc_id ORDER BY k) AS l2, lead(line, 2) OVER (PARTITION BY doc_id ORDER BY k) AS l3 FROM f),
z AS (SELECT doc_id, k, row_number() OVER (PARTITION BY line, l2, l3 ORDER BY doc_id, k) AS nth FROM w WHERE l3 IS NOT NULL),
c AS (SELECT DISTINCT doc_id, k + j AS k FROM z, (SELECT unnest([0, 1, 2]) AS j) AS t WHERE nth > 1),
m AS (SELECT f.doc_id, f.i, c.k IS NOT NULL AS gone FROM f LEFT JOIN c ON c.doc_id = f.doc_id AND c.k = f.k),
o AS (
  SELECT l.doc_id, string_agg(CASE WHEN coalesce(m.gone, FALSE) THEN NULL ELSE l.line END, chr(10) ORDER BY l.i) AS text,
    count(m.i) AS n_lines, count(CASE WHEN m.gone THEN 1 END) AS n_removed
  FROM l LEFT JOIN m ON m.doc_id = l.doc_id AND m.i = l.i GROUP BY l.doc_id)
SELECT doc_id, coalesce(text, '') AS text, n_lines, n_removed FROM o""",
)
def op2(spark, sf):
    return windows.drop_repeated_windows(table(spark, sf, "documents")).select("doc_id", "text", "n_lines", "n_removed")


@query("op3_page_layout")
def op3(spark, sf):
    return pages.extract_text(table(spark, sf, "pages"))


@query("op4_attention_quality")
def op4(spark, sf):
    docs = table(spark, sf, "documents")
    model = passages.train(docs, table(spark, sf, "labels"))
    found = passages.score(docs, model).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
    return found.withColumn("held_out", passages.held_out("doc_id"))


@query("op5_toxicity_chain")
def op5(spark, sf):
    docs = table(spark, sf, "documents")
    return toxic.score(docs, toxic.train(docs, table(spark, sf, "labels")))


@query("op6_walk_decontamination")
def op6(spark, sf):
    return leaks.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query(
    "op7_rule_cascade",
    f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS_SQL.format("coalesce(text, '')")} AS w FROM documents),
u AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
g AS (SELECT doc_id, i, x, lead(x, 1) OVER (PARTITION BY doc_id ORDER BY i) AS x2, lead(x, 2) OVER (PARTITION BY doc_id ORDER BY i) AS x3 FROM u),
m AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x, x2, x3) AS c FROM g WHERE x3 IS NOT NULL),
r AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM m, (SELECT unnest([0, 1, 2]) AS j) AS t WHERE c > 1 GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
li AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM ln WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
a AS (
  SELECT doc_id, sum(length(x)) AS chars, count(DISTINCT x) AS kinds,
    count(CASE WHEN length(regexp_replace(x, '[^A-Z]', '', 'g')) >= 2 AND NOT regexp_matches(x, '[a-z]') THEN 1 END) AS shouted FROM u GROUP BY doc_id),
b AS (
  SELECT d.doc_id, len(w) AS n, coalesce(a.chars, 0) AS chars, coalesce(kinds, 0) AS kinds, coalesce(shouted, 0) AS shouted,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS signs, coalesce(li.n, 0) AS lines, coalesce(li.dup, 0) AS dup, coalesce(r.n, 0) AS rep
  FROM d LEFT JOIN a ON a.doc_id = d.doc_id LEFT JOIN li ON li.doc_id = d.doc_id LEFT JOIN r ON r.doc_id = d.doc_id)
SELECT doc_id, n AS n_words, CAST(chars AS BIGINT) AS word_chars, signs AS n_symbols, dup AS n_dup_lines, rep AS n_repeat_words,
  n < 50 OR 100 * rep > 50 * n AS base_failed,
  NOT (n < 50 OR 100 * rep > 50 * n OR 100 * signs > 20 * n OR 2 * chars < 5 * n OR chars > 14 * n OR 2 * dup > lines
    OR 100 * shouted > 50 * n OR 100 * kinds < 20 * n) AS kept
FROM b""",
)
def op7(spark, sf):
    return quality.quality_rules(table(spark, sf, "documents"))


@query("op8_pivotal_mix")
def op8(spark, sf):
    mixed = mixing.mix_sources(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op9_prefix_tokens")
def op9(spark, sf):
    import public_tokenizers

    counts = tokens.token_counts(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query("op10_licence_index")
def op10(spark, sf):
    found = licences.scan(table(spark, sf, "documents"))
    first = lambda i: F.get("places", i).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        first(F.lit(0)).alias("first_word"),
        first(F.size("places") - 1).alias("last_word"),
        "base_labels",
        "labels",
        "score",
    )


@query("op11_metric_range_join", VECTORS)
def op11(spark, sf):
    return metric_join.near_vectors(table(spark, sf, "embeddings"))


@query("op12_spelling_variants", VARIANTS)
def op12(spark, sf):
    return spelling.document_variants(table(spark, sf, "documents"))


@query("op13_merkle_manifest", MANIFEST)
def op13(spark, sf):
    return manifest.verify_documents(table(spark, sf, "documents"))
