"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from reuselens.llm import (centroids, decontaminate, divergence, exact_dedup, html_extract, jaccard_join, language_id, mixing, packing,
                           pu_quality, suffix_dedup, suffix_tree, url_filter)
from reuselens.llm.common import held_out, table

# The rules of the URL query (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

#: Draw weight of a document by its quality label; unlabelled documents have 1.
QUALITY_WEIGHT = {1: 2.0, 0: 0.5}


def quality_weights(spark, sf_dir):
    """``doc_id, weight`` of the labelled documents."""
    q, w = F.col("quality"), F.lit(None).cast("double")
    for value, weight in QUALITY_WEIGHT.items():
        w = F.when(q == value, F.lit(weight)).otherwise(w)
    return table(spark, sf_dir, "labels").select("doc_id", w.alias("weight"))


def op1_suffix_tree(spark, sf_dir):
    return suffix_tree.score_texts(table(spark, sf_dir, "documents"), ~held_out(7, 2))


def op2_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept", "starts", "ends")


def op3_decontaminate(spark, sf_dir):
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), quality_weights(spark, sf_dir)) \
        .drop("draw_key")


def op5_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = held_out(3, 1)
    model = language_id.fit(docs.where(~out))
    return language_id.predict(docs, model, {"held_out": out})


def op6_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))[0]


def op7_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


#: A text is predicted good from this score on.
QUALITY_AT = 0.3


def quality_model(docs, labels):
    """The classifier, learned from the labels that are not held out."""
    out = held_out(5, 0)
    positives = labels.where((F.col("quality") == 1) & ~out)
    return pu_quality.fit(docs, positives, labels, ~out)


def op8_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return pu_quality.score(docs, model, {"doc_id": F.col("doc_id"), "held_out": held_out(5, 0)}) \
        .withColumn("predicted", (F.col("score") >= QUALITY_AT).cast("int"))


def op9_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op10_html(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


#: Vocabulary of the packed sequences; its place is asked of the installed package.
TOKENIZER = "word_bpe_49k.json"


def op11_packing(spark, sf_dir):
    import public_tokenizers
    packed = packing.pack(table(spark, sf_dir, "documents"), str(public_tokenizers.path(TOKENIZER)))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_centroids(spark, sf_dir):
    return centroids.with_inertia(*centroids.cluster(table(spark, sf_dir, "embeddings")))


def op13_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_suffix_tree": op1_suffix_tree,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_mixing": op4_mixing,
    "op5_language": op5_language,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_url_filter": op7_url_filter,
    "op8_quality": op8_quality,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_html": op10_html,
    "op11_packing": op11_packing,
    "op12_centroids": op12_centroids,
    "op13_divergence": op13_divergence,
}


def _centroid_sql() -> str:
    """Rounds of assignment and update, written one after the other."""
    assign = """a{i} AS (SELECT vec_id, x, d.c AS cluster, d.d AS distance FROM (
  SELECT vec_id, v.x AS x, min(struct_pack(d := list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, c := c.c)) AS d
  FROM v, c{i} c GROUP BY vec_id, v.x))"""
    update = """s{i} AS (SELECT cluster, j, sum(x[j])::BIGINT AS s, count(*) AS n FROM a{i}, range(1, 65) r(j) GROUP BY cluster, j),
m{i} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY j) AS x FROM s{i} GROUP BY cluster),
c{k} AS (SELECT c.c, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON m.cluster = c.c)"""
    rounds = ",\n".join(assign.format(i=i) + ",\n" + update.format(i=i, k=i + 1) for i in range(3))
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: floor(e::DOUBLE * 64)::BIGINT) AS x FROM embeddings
           WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e::DOUBLE))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, x FROM v QUALIFY c < 16),
{rounds},
{assign.format(i=3)}
SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c3.x, ',')) AS centroid_sha256
FROM a3 JOIN c3 ON c3.c = a3.cluster
"""


ORACLES = {
    "op12_centroids": _centroid_sql(),
    "op13_divergence": """
WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
w AS (SELECT d, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
c AS (SELECT w.lang, source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY w.lang, source, w.term),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(s.n, 0) + 5 * l.v) AS p,
             1 + (1000000000::HUGEINT * (k.total + 5)) // (l.n + 5 * l.v) AS q
      FROM g JOIN k ON g.lang = k.lang JOIN l ON l.lang = g.lang
      LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM o QUALIFY part = 'pair' OR rank <= 50
""",
    "op4_mixing": """
WITH q AS (SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 END)::DOUBLE AS weight
           FROM labels GROUP BY doc_id),
d AS (SELECT documents.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
             coalesce(weight, 1.0)::DOUBLE AS weight
      FROM documents LEFT JOIN q ON documents.doc_id = q.doc_id),
p AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
      FROM d GROUP BY source),
o AS (SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total FROM p),
c AS (SELECT *, cap::HUGEINT * sum(w) OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST
                                            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                <= w::HUGEINT * (total - coalesce(sum(cap) OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS capped
      FROM o),
t AS (SELECT source, source_size,
             CASE WHEN capped THEN cap::DOUBLE
                  ELSE (total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0))::DOUBLE * w::DOUBLE
                       / (sum(CASE WHEN NOT capped THEN w END) OVER ())::DOUBLE END AS target
      FROM c),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
r AS (SELECT d.doc_id, d.source, d.size, e.source_size, e.target, e.epochs,
             -ln((('0x' || substr(md5('mix-1:' || d.doc_id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
               / d.weight AS draw_key
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
s AS (SELECT *, floor(target)::BIGINT - epochs * source_size
               - coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw_key, doc_id, size
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM r)
SELECT doc_id, source, size, source_size, target, epochs,
       (epochs * size + greatest(0, least(size, room)))::BIGINT AS taken FROM s
""",
    "op7_url_filter": """
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                      ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (SELECT host, path, min(struct_pack(n := -length(r.h || r.p), rule := r.h || r.p, v := v)) AS best
      FROM (SELECT DISTINCT host, path FROM h) x JOIN r
        ON (x.host = r.h OR ends_with(x.host, '.' || r.h)) AND starts_with(x.path, r.p) GROUP BY host, path)
SELECT page_id, h.host, h.path, m.best.rule AS rule, coalesce(m.best.v, 'allow') AS verdict
FROM h LEFT JOIN m ON h.host = m.host AND h.path = m.path
""",
    "op9_exact_dedup": """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256 FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS nth,
             first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
             count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, nth = 1 AS kept, text_sha256 FROM r
""",
}
