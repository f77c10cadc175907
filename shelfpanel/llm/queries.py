"""The operators as queries over whole tables, with SQL where SQL can say the same."""

from pyspark.sql import functions as F

from shelfpanel.llm import (
    bpe, decontaminate, divergence, exact_dedup, language_id, language_model, licenses, near_dedup, pii, quality, toxicity,
    url_filter, va_clusters,
)
from shelfpanel.llm.common import held_out

FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocab_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_pii(spark, sf_dir):
    found = pii.disclosure(table(spark, sf_dir, "documents"), everywhere=True)
    return found.select(
        "doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2("base", 256).alias("base_sha256"),
        pii.all_spans(F.col("base"), F.col("terms")).alias("spans"),
    )


def op2_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_url_filter(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def op5_near_dedup(spark, sf_dir):
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), width=5, percent=85)


def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def digests(encoded):
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op7_bpe(spark, sf_dir):
    return digests(bpe.encode_decode(table(spark, sf_dir, "documents"), vocab_path()))


def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_licenses(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op10_quality(spark, sf_dir):
    """Grades: 0 for low quality, 1 for good but toxic texts, 2 for good and clean ones."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    found = quality.rate(docs, quality.train(docs, labels.select("doc_id", grade.alias("grade"))))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "expected_grade", "tail", "kept")


def op11_lm_score(spark, sf_dir):
    """Held out: documents whose crc32 of the id as text leaves 2 when divided by 7."""
    docs = table(spark, sf_dir, "documents")
    apart = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    found = language_model.score(docs, *language_model.train(docs, ~apart))
    return found.select("doc_id", apart.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_centroids(spark, sf_dir):
    first = F.sha2(F.concat(F.lit("3:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return va_clusters.cluster_vectors(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64, scale=1024, first=first)


def op13_divergence(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"), least=30, add=5, unit=1_000_000_000, top=50)


OP2_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, k, list_slice(w, s, s + k - 1) AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS s
        FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT k FROM win),
pos AS (
  SELECT doc_id, k, s, list_slice(w, s, s + k - 1) AS g
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s FROM d, lens WHERE len(w) >= k)),
hit AS (SELECT doc_id, s, pos.k AS k, item_id FROM pos JOIN win USING (k, g)),
words AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(generate_series(s, s + k - 1)) AS x FROM hit) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

OP4_SQL = f"""
WITH n AS (SELECT doc_id, {FOLDED} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
"""

OP5_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({FOLDED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT doc_id, w, least(len(w), 5) AS k, unnest(generate_series(1, len(w) - least(len(w), 5) + 1)) AS i
        FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT e.b, reach.r FROM reach JOIN e ON e.a = reach.doc_id),
c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

def canonical_sql(lines: str) -> str:
    """SQL of the canonical form of a list of folded lines."""
    text = f"array_to_string(list_filter({lines}, lambda x: {no_copyright_sql('x')}), chr(10))"
    return words_sql(text)


def no_copyright_sql(line: str) -> str:
    return f"(NOT regexp_matches({line}, '{licenses.COPYRIGHT}') OR regexp_matches({line}, '{licenses.PROSE}'))"


def words_sql(text: str) -> str:
    for found, instead in licenses.SPELLINGS:
        text = f"replace({text}, '{found}', '{instead}')"
    return f"trim(regexp_replace({text}, '{licenses.MARKS}', ' ', 'g'))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP9_SQL = f"""
WITH k AS (SELECT * FROM (VALUES {", ".join(f"({_quoted(n)}, {_quoted(b)})" for n, b in licenses.known_bodies())}) v(license, text)),
known AS (
  SELECT digest, min(license) AS found FROM (
    SELECT sha256({canonical_sql(f"string_split({FOLDED}, chr(10))")}) AS digest, license FROM k
    UNION ALL VALUES {", ".join(f"({_quoted(h)}, {_quoted(n)})" for n, h in licenses.known_digests())}) t GROUP BY 1),
d AS (SELECT doc_id, string_split({FOLDED}, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, sha256({canonical_sql("lines")}) AS digest FROM d),
l AS (SELECT doc_id, unnest(lines) AS line FROM d),
n AS (
  SELECT doc_id, found FROM (
    SELECT doc_id, {words_sql("line")} AS unit FROM l WHERE {no_copyright_sql("line")})
  JOIN known ON sha256(unit) = digest WHERE unit <> ''),
c AS (SELECT doc_id, count(*) AS n FROM n GROUP BY 1),
s AS (SELECT doc_id, string_agg(found, ',' ORDER BY found) AS names FROM (SELECT DISTINCT doc_id, found FROM n) GROUP BY 1)
SELECT w.doc_id, known.found AS license, coalesce(c.n, 0) AS n_notices, coalesce(s.names, '') AS notices,
       w.digest AS canonical_sha256
FROM w LEFT JOIN known USING (digest) LEFT JOIN c ON c.doc_id = w.doc_id LEFT JOIN s ON s.doc_id = w.doc_id
"""

def _centroid_sql(rounds: int = 10, k: int = 8) -> str:
    """Each round: nearest centroid of every vector, then the floors of the means."""
    parts = [f"""WITH x AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = 64),
c0 AS (
  SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, v AS c
  FROM (SELECT v, sha256('3:' || vec_id) AS h FROM x ORDER BY h LIMIT {k}))"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, v, cluster, d FROM (
    SELECT vec_id, v, cluster, d, row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) AS place FROM (
      SELECT vec_id, v, cluster, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
      FROM x CROSS JOIN c{i}))
  WHERE place = 1)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c{i}.cluster, coalesce(n.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY place) AS c FROM (
      SELECT cluster, place, CAST(sum(e) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT cluster, unnest(v) AS e, generate_subscripts(v, 1) AS place FROM a{i}) GROUP BY cluster, place)
    GROUP BY cluster) n USING (cluster))""")
    return ",\n".join(parts) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)
"""


OP13_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT row, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY 1, 2 HAVING count(DISTINCT row) >= 30),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
g AS (
  SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY 1, 2) USING (lang, source)),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
         1 + CAST(1000000000 * CAST(coalesce(c.n, 0) + 5 AS HUGEINT) // (g.total + 5 * v.v) AS BIGINT) AS p,
         1 + CAST(1000000000 * CAST(kept.n + 5 AS HUGEINT) // (v.total + 5 * v.v) AS BIGINT) AS q
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM r)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""

QUERIES = {
    "op1_pii": op1_pii,
    "op2_decontaminate": op2_decontaminate,
    "op3_url_filter": op3_url_filter,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_near_dedup": op5_near_dedup,
    "op6_language_id": op6_language_id,
    "op7_bpe": op7_bpe,
    "op8_toxicity": op8_toxicity,
    "op9_licenses": op9_licenses,
    "op10_quality": op10_quality,
    "op11_lm_score": op11_lm_score,
    "op12_centroids": op12_centroids,
    "op13_divergence": op13_divergence,
}
ORACLES = {
    "op2_decontaminate": OP2_SQL, "op4_exact_dedup": OP4_SQL, "op5_near_dedup": OP5_SQL, "op9_licenses": OP9_SQL,
    "op12_centroids": _centroid_sql(), "op13_divergence": OP13_SQL,
}
