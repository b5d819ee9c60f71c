"""Oracle SQL for the registered queries (DuckDB dialect)."""

from __future__ import annotations

from reuselens.functions import labels as L
from reuselens.operators import cowords as CW
from reuselens.operators import minhash as MH
from reuselens.plans import sql as S

MH_BASE = [S.cte_params(), S.CTE_LABELS, S.CTE_TEXTS, S.cte_signature(), S.cte_minhash_best()]

EV_MH = f"""ev AS (
  SELECT l.doc_id, l.task, l.category, l.truth_level, b.best_original, b.best_sim,
         {S.level_case('b.best_sim')} AS level
  FROM labs l JOIN mhb b ON l.doc_id = b.doc_id),
evl AS (SELECT * FROM ev WHERE truth_level IS NOT NULL)"""

LEVELS_VALUES = "lv(label) AS (VALUES " + ", ".join(f"('{x}')" for x in L.LEVELS) + ")"


def per_class_sql(src: str, truth: str = "truth_level", pred: str = "level",
                  px: str = "") -> str:
    return f"""{px}lu AS (SELECT {truth} AS label FROM {src} WHERE {truth} IS NOT NULL
        UNION SELECT {pred} FROM {src} WHERE {pred} IS NOT NULL),
{px}pc AS (
  SELECT lu.label,
    (SELECT count(*) FROM {src} WHERE {truth} = lu.label AND {pred} = lu.label) AS tp,
    (SELECT count(*) FROM {src} WHERE {truth} = lu.label) AS support,
    (SELECT count(*) FROM {src} WHERE {pred} = lu.label) AS predicted
  FROM {px}lu lu),
{px}pcm AS (
  SELECT label, tp, support, predicted,
    CASE WHEN predicted > 0 THEN tp::DOUBLE / predicted ELSE 0.0 END AS precision,
    CASE WHEN support > 0 THEN tp::DOUBLE / support ELSE 0.0 END AS recall,
    CASE WHEN support + predicted > 0 THEN 2.0 * tp / (support + predicted) ELSE 0.0 END AS f1
  FROM {px}pc)"""


def acc_expr(truth="truth_level", pred="level"):
    return f"avg(CASE WHEN {truth} = {pred} THEN 1.0 ELSE 0.0 END)::DOUBLE"


def tune_sql(src: str, sim: str = "best_sim", truth: str = "truth_level", px: str = "") -> str:
    return f"""{px}gridc AS (SELECT t_cut::DOUBLE AS t_cut, t_light::DOUBLE AS t_light,
                      t_heavy::DOUBLE AS t_heavy FROM grid),
{px}scored AS (
  SELECT g.t_cut, g.t_light, g.t_heavy,
    sum(CASE WHEN (CASE WHEN r.{sim} > g.t_cut THEN 'cut / near copy'
                        WHEN r.{sim} > g.t_light THEN 'light plagiarism'
                        WHEN r.{sim} > g.t_heavy THEN 'heavy plagiarism'
                        ELSE 'non-plagiarised' END) = r.{truth} THEN 1 ELSE 0 END) AS hits,
    count(*) AS total
  FROM {px}gridc g, {src} r GROUP BY g.t_cut, g.t_light, g.t_heavy),
{px}best AS (
  SELECT t_cut, t_light, t_heavy, hits::DOUBLE / total AS accuracy FROM {px}scored
  ORDER BY hits DESC, t_cut, t_light, t_heavy LIMIT 1)"""


TF_BASE = [S.CTE_TEXTS, """tfg AS (
  SELECT doc_id, list_filter(string_split(clean_text, ' '), lambda t: length(t) >= 2) AS t FROM txt),
grams AS (
  SELECT doc_id, unnest(list_concat(t, CASE WHEN len(t) >= 2
         THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])
         ELSE []::VARCHAR[] END)) AS gram FROM tfg),
tf AS (SELECT doc_id, gram, count(*) AS tf FROM grams GROUP BY doc_id, gram),
ndocs AS (SELECT count(*)::DOUBLE AS n FROM documents),
dfq AS (SELECT gram, count(*) AS df FROM tf GROUP BY gram),
vocab AS (SELECT gram, df, ln((1 + n) / (1 + df)) + 1 AS idf FROM dfq, ndocs
          WHERE df >= 2 AND df <= 0.85::DOUBLE * n),
w0 AS (SELECT tf.doc_id, tf.gram, tf.tf * v.idf AS w FROM tf JOIN vocab v ON tf.gram = v.gram),
nrm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w0 GROUP BY doc_id),
tfw AS (SELECT w0.doc_id, w0.gram, w0.w / nrm.norm AS w FROM w0 JOIN nrm ON w0.doc_id = nrm.doc_id)"""]

TF_BEST = """origw AS (SELECT * FROM tfw WHERE doc_id % 20 = 0),
tpairs AS (SELECT d.doc_id, o.doc_id AS orig_id, round(sum(d.w * o.w), 9) AS sim
           FROM tfw d JOIN origw o ON d.gram = o.gram GROUP BY d.doc_id, o.doc_id),
alldo AS (SELECT d.doc_id, o.doc_id AS orig_id FROM documents d,
          (SELECT doc_id FROM documents WHERE doc_id % 20 = 0) o),
tfull AS (SELECT a.doc_id, a.orig_id, coalesce(p.sim, 0.0) AS sim FROM alldo a
          LEFT JOIN tpairs p ON a.doc_id = p.doc_id AND a.orig_id = p.orig_id),
tfb AS (SELECT doc_id, orig_id AS best_original, sim AS best_sim FROM (
   SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sim DESC, orig_id) AS rn FROM tfull)
   WHERE rn = 1)"""

EV_TF = f"""tev AS (
  SELECT l.doc_id, l.task, l.category, l.truth_level, b.best_original,
         round(b.best_sim, 6) AS best_sim, {S.level_case('round(b.best_sim, 6)')} AS level
  FROM labs l JOIN tfb b ON l.doc_id = b.doc_id),
tevl AS (SELECT * FROM tev WHERE truth_level IS NOT NULL)"""

P9 = """p9 AS (SELECT a.doc_id, b.doc_id AS other_id, sum(a.w * b.w) AS sim
       FROM tfw a JOIN tfw b ON a.gram = b.gram WHERE a.doc_id <> b.doc_id
       GROUP BY a.doc_id, b.doc_id)"""

EMB = """e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
en AS (SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nrm FROM e),
ex AS (SELECT vec_id, label, unnest(range(len(v))) AS j, unnest(v) AS val, nrm FROM en),
xn AS (SELECT vec_id, label, j, CASE WHEN nrm > 0 THEN val / nrm ELSE val END AS u FROM ex)"""

SPLIT = """sp0 AS (SELECT vec_id, label, embedding,
             ('0x' || substr(md5('42:' || vec_id::VARCHAR), 1, 8))::BIGINT AS u FROM embeddings),
sp1 AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY u, vec_id) AS rn,
               count(*) OVER (PARTITION BY label) AS nc FROM sp0),
split AS (SELECT vec_id, label, embedding, rn <= floor(nc * 0.2::DOUBLE + 0.5) AS is_test FROM sp1)"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    W = S.with_

    q["clean_text"] = W(S.CTE_TEXTS) + "SELECT doc_id, clean_text FROM txt"
    q["label_ids"] = W(S.CTE_LABELS) + \
        "SELECT doc_id, task, category, category_id, plag_label, truth_level FROM labs"
    q["tokens"] = W(S.CTE_TEXTS, S.CTE_TOKENS) + \
        "SELECT doc_id, len(w)::INTEGER AS n_tokens, len(list_distinct(w))::INTEGER AS n_distinct FROM tok"
    q["shingles"] = W(S.CTE_TEXTS, S.CTE_TOKENS, S.CTE_SHINGLES) + "SELECT doc_id, s AS shingle FROM sh"
    q["shingle_hash"] = W(S.CTE_TEXTS, S.CTE_TOKENS, S.CTE_SHINGLES) + f"""
SELECT t.doc_id, count(h.x) AS n_shingles, min(h.x) AS min_x, max(h.x) AS max_x,
       sum(h.x)::BIGINT AS sum_x
FROM txt t LEFT JOIN (SELECT doc_id, {S.hash32('s')} AS x FROM sh) h ON t.doc_id = h.doc_id
GROUP BY t.doc_id"""
    q["minhash_signature"] = W(S.cte_params(), S.CTE_TEXTS, S.cte_signature()) + \
        "SELECT doc_id, i::INTEGER AS i, m FROM sig"
    q["minhash_best"] = W(*MH_BASE) + "SELECT doc_id, best_original, best_sim FROM mhb"
    q["minhash_best_other"] = W(S.cte_params(), S.CTE_TEXTS, S.cte_signature(), S.cte_minhash_best(
        orig_filter="o.doc_id % 20 = 0 AND d.doc_id <> o.doc_id")) + "SELECT doc_id, best_original, best_sim FROM mhb"
    jac = [S.CTE_TEXTS, S.CTE_TOKENS, S.CTE_SHINGLES, """jn AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
jp AS (SELECT d.doc_id, o.doc_id AS o, count(*) AS c FROM sh d JOIN sh o ON d.s = o.s
       WHERE o.doc_id % 20 = 0 AND d.doc_id <> o.doc_id GROUP BY d.doc_id, o.doc_id),
jall AS (SELECT d.doc_id, o.doc_id AS o FROM documents d JOIN documents o ON o.doc_id % 20 = 0 AND d.doc_id <> o.doc_id),
js AS (SELECT a.doc_id, a.o, coalesce(p.c::DOUBLE / (x.n + y.n - p.c), 0.0) AS sim FROM jall a
       LEFT JOIN jp p ON p.doc_id = a.doc_id AND p.o = a.o LEFT JOIN jn x ON x.doc_id = a.doc_id LEFT JOIN jn y ON y.doc_id = a.o),
jb AS (SELECT doc_id, o AS best_original, sim AS best_sim FROM (
       SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sim DESC, o) AS rn FROM js) WHERE rn = 1)"""]
    q["jaccard_best"] = W(*jac) + f"SELECT doc_id, best_original, best_sim, {S.level_case('best_sim')} AS level FROM jb"
    q["minhash_vs_jaccard"] = W(S.cte_params(), *jac, S.cte_signature(), S.cte_minhash_best(
        orig_filter="o.doc_id % 20 = 0 AND d.doc_id <> o.doc_id"), LEVELS_VALUES, f"""mj AS (
  SELECT {S.level_case('jb.best_sim')} AS truth, {S.level_case('mhb.best_sim')} AS pred
  FROM jb JOIN mhb ON jb.doc_id = mhb.doc_id)""") + """
SELECT a.label AS truth, b.label AS pred, (SELECT count(*) FROM mj WHERE truth = a.label AND pred = b.label) AS n
FROM lv a, lv b"""
    q["cooccurrence"] = W(S.CTE_TEXTS, S.CTE_TOKENS) + f"""
, occ AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM tok),
voc AS (SELECT word FROM occ GROUP BY word HAVING count(DISTINCT doc_id) >= {CW.MIN_DF}
        ORDER BY count(DISTINCT doc_id) DESC, word LIMIT {CW.VOCABULARY}),
kept AS (SELECT occ.* FROM occ JOIN voc ON occ.word = voc.word),
off AS (SELECT unnest(range(-{CW.WINDOW}, {CW.WINDOW} + 1)) AS o)
SELECT x.word AS a, y.word AS b, count(*) AS n
FROM kept x JOIN off ON o <> 0 JOIN kept y ON y.doc_id = x.doc_id AND y.i = x.i + o GROUP BY x.word, y.word"""
    q["minhash_pairs"] = W(S.cte_params(), S.CTE_TEXTS, S.cte_signature()) + f"""
, cls AS (SELECT list(m ORDER BY i) AS s, doc_id FROM sig GROUP BY doc_id HAVING min(m) < {MH.P}),
rep AS (SELECT s, min(doc_id) AS doc_id, count(*) AS n FROM cls GROUP BY s),
pos AS (SELECT doc_id, n, unnest(range(0, {MH.NUM_HASHES})) AS i, unnest(s) AS m FROM rep)
SELECT a.doc_id, b.doc_id AS other_id, count(*)::DOUBLE / {float(MH.NUM_HASHES)}::DOUBLE AS sim, a.n AS n_docs, b.n AS n_others
FROM pos a JOIN pos b ON a.i = b.i AND a.m = b.m AND a.doc_id < b.doc_id
GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) > {round(MH.NUM_HASHES * L.DEFAULT_THRESHOLDS[1])}"""
    q["minhash_levels"] = W(*MH_BASE, EV_MH) + \
        "SELECT doc_id, task, category, truth_level, best_original, best_sim, level FROM ev"
    btxt = f"""btxt AS (SELECT item_id, {S.clean('text')} AS clean_text FROM benchmark)"""
    q["minhash_benchmark"] = W(S.cte_params(), S.CTE_TEXTS, S.cte_signature(), btxt,
                               S.cte_signature("btxt", "item_id", "bsig"),
                               S.cte_minhash_best("sig", "bsig", "item_id", "TRUE")) + \
        "SELECT doc_id, best_original AS best_item, best_sim FROM mhb"

    q["confusion_matrix"] = W(*MH_BASE, EV_MH, LEVELS_VALUES) + """
SELECT a.label AS truth, b.label AS pred,
       (SELECT count(*) FROM evl WHERE truth_level = a.label AND level = b.label) AS n
FROM lv a, lv b"""
    counts = """(SELECT count(*) FROM evl) AS n_scored,
       (SELECT count(*) FROM ev WHERE truth_level IS NULL) AS n_unlabelled"""
    q["accuracy"] = W(*MH_BASE, EV_MH) + f"SELECT {acc_expr()} AS accuracy, {counts} FROM evl"
    q["macro_prf"] = W(*MH_BASE, EV_MH, per_class_sql("evl")) + f"""
SELECT (SELECT {acc_expr()} FROM evl) AS accuracy, avg(precision) AS precision,
       avg(recall) AS recall, avg(f1) AS f1, {counts} FROM pcm"""
    q["classification_report"] = W(*MH_BASE, EV_MH, per_class_sql("evl")) + f"""
SELECT label, precision, recall, f1, support FROM pcm
UNION ALL SELECT 'accuracy', NULL, NULL, {acc_expr()}, count(*) FROM evl
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM pcm
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
       sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
       sum(support)::BIGINT FROM pcm"""
    q["mismatches"] = W(*MH_BASE, EV_MH) + """
SELECT doc_id, task, category, truth_level, level FROM evl
WHERE truth_level IS DISTINCT FROM level"""
    q["tune_thresholds"] = W(*MH_BASE, EV_MH, S.cte_grid(), tune_sql("evl")) + \
        "SELECT t_cut, t_light, t_heavy, accuracy FROM best"
    q["tuned_levels"] = W(*MH_BASE, EV_MH, S.cte_grid(), tune_sql("evl")) + f"""
SELECT e.doc_id, e.best_sim, e.truth_level,
  {S.level_case('e.best_sim', 'b.t_cut', 'b.t_light', 'b.t_heavy')} AS tuned_level
FROM evl e, best b"""
    # ---- TF-IDF ----
    q["gram_tf"] = W(*TF_BASE) + "SELECT doc_id, gram, tf FROM tf"
    q["gram_df"] = W(*TF_BASE) + "SELECT gram, df, round(idf, 6) AS idf FROM vocab"
    q["tfidf"] = W(*TF_BASE) + "SELECT doc_id, gram, round(w, 6) AS w FROM tfw"
    q["tfidf_best"] = W(*TF_BASE, TF_BEST) + \
        "SELECT doc_id, best_original, round(best_sim, 6) AS best_sim FROM tfb"
    q["tfidf_levels"] = W(S.CTE_LABELS, *TF_BASE, TF_BEST, EV_TF) + \
        "SELECT doc_id, task, category, truth_level, best_original, best_sim, level FROM tev"
    q["tfidf_tuned"] = W(S.CTE_LABELS, *TF_BASE, TF_BEST, EV_TF, S.cte_grid(), tune_sql("tevl")) + \
        "SELECT t_cut, t_light, t_heavy, accuracy FROM best"
    q["tfidf_best_other"] = W(*TF_BASE, TF_BEST.replace("WHERE doc_id % 20 = 0) o)", "WHERE doc_id % 20 = 0) o WHERE d.doc_id <> o.doc_id)")) + \
        "SELECT doc_id, best_original, round(best_sim, 6) AS best_sim FROM tfb"
    q["similar_pairs"] = W(*TF_BASE, P9) + \
        "SELECT doc_id, other_id, round(sim, 6) AS sim FROM p9 WHERE doc_id < other_id AND round(sim, 9) >= 0.6::DOUBLE"
    q["all_pairs_cosine"] = W(*TF_BASE, P9) + "SELECT doc_id, other_id, round(sim, 6) AS sim FROM p9"
    q["top3_neighbours"] = W(*TF_BASE, P9.replace("sum(a.w * b.w)", "round(sum(a.w * b.w), 9)")) + """,
fullp AS (SELECT d1.doc_id, d2.doc_id AS other_id, coalesce(p9.sim, 0.0) AS sim
          FROM documents d1 JOIN documents d2 ON d1.doc_id <> d2.doc_id
          LEFT JOIN p9 ON p9.doc_id = d1.doc_id AND p9.other_id = d2.doc_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sim DESC, other_id) AS rank FROM fullp)
SELECT doc_id, rank::INTEGER AS rank, other_id, round(sim, 6) AS sim FROM rk WHERE rank <= 3"""
    tuned_mh = f"""mtl AS (SELECT e.truth_level,
  {S.level_case('e.best_sim', 'b.t_cut', 'b.t_light', 'b.t_heavy')} AS tuned_level
  FROM evl e, m_best b)"""
    tuned_tf = f"""ttl AS (SELECT e.truth_level,
  {S.level_case('e.best_sim', 'b.t_cut', 'b.t_light', 'b.t_heavy')} AS tuned_level
  FROM tevl e, t_best b)"""
    q["method_comparison"] = W(*MH_BASE, EV_MH, *TF_BASE[1:], TF_BEST, EV_TF, S.cte_grid(),
                               tune_sql("evl", px="m_"), tune_sql("tevl", px="t_"),
                               tuned_mh, tuned_tf,
                               per_class_sql("mtl", "truth_level", "tuned_level", "m_"),
                               per_class_sql("ttl", "truth_level", "tuned_level", "t_")) + f"""
SELECT 'minhash' AS model, (SELECT {acc_expr('truth_level', 'tuned_level')} FROM mtl) AS accuracy,
       avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1 FROM m_pcm
UNION ALL
SELECT 'tfidf_cosine', (SELECT {acc_expr('truth_level', 'tuned_level')} FROM ttl),
       avg(precision), avg(recall), avg(f1) FROM t_pcm"""

    # ---- labels, selections, sources ----
    q["answers_only"] = W(S.CTE_LABELS) + \
        "SELECT doc_id, category, category_id, plag_label FROM labs WHERE plag_label <> -1"
    q["originals"] = W(S.CTE_LABELS) + "SELECT doc_id, task FROM labs WHERE category = 'orig'"
    q["label_counts"] = W(S.CTE_LABELS) + \
        "SELECT category_id AS value, count(*) AS n FROM labs WHERE plag_label <> -1 GROUP BY category_id"
    q["task_count"] = W(S.CTE_LABELS) + "SELECT count(DISTINCT task) AS n_tasks FROM labs"
    q["encode_task"] = """SELECT doc_id, lang AS task,
  CASE WHEN lang IS NULL THEN NULL ELSE (dense_rank() OVER (ORDER BY lang) - 1)::INTEGER END AS task_id
FROM documents"""
    q["preview"] = W(S.CTE_LABELS, S.CTE_TEXTS) + """SELECT l.doc_id, l.task, l.category, t.clean_text
FROM labs l JOIN txt t ON l.doc_id = t.doc_id ORDER BY l.doc_id LIMIT 5"""
    q["missing_report"] = """SELECT d.doc_id FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""
    q["tolerant_load"] = """SELECT l.doc_id, d.text IS NOT NULL AS has_text,
  length(coalesce(d.text, ''))::INTEGER AS n_chars
FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id"""

    # ---- clustering metrics on the fixed (task, source) assignment ----
    cnt = "c AS (SELECT lang AS t, source AS p, count(*) AS n FROM documents GROUP BY lang, source)"
    q["purity"] = W(cnt) + """SELECT sum(m)::DOUBLE / sum(s) AS purity
FROM (SELECT p, max(n) AS m, sum(n) AS s FROM c GROUP BY p)"""
    q["ari"] = W(cnt, """a AS (SELECT sum(x * (x - 1) / 2.0) AS sa FROM (SELECT sum(n) AS x FROM c GROUP BY t)),
b AS (SELECT sum(x * (x - 1) / 2.0) AS sb FROM (SELECT sum(n) AS x FROM c GROUP BY p)),
ij AS (SELECT sum(n * (n - 1) / 2.0) AS sij, sum(n)::DOUBLE AS nn FROM c),
v AS (SELECT sij, sa * sb / (nn * (nn - 1) / 2.0) AS ex, (sa + sb) / 2.0 AS mx FROM ij, a, b)""") + \
        "SELECT round(CASE WHEN mx = ex THEN 1.0 ELSE (sij - ex) / (mx - ex) END, 6) AS ari FROM v"
    q["cluster_to_task"] = """SELECT cluster, t AS mapped FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, t) AS rn FROM (
    SELECT source AS cluster, lang AS t, count(*) AS n FROM documents
    WHERE lang IS NOT NULL GROUP BY source, lang)) WHERE rn = 1"""
    q["cluster_mapped"] = """WITH m AS (SELECT cluster, t FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, t) AS rn FROM (
    SELECT source AS cluster, lang AS t, count(*) AS n FROM documents
    WHERE lang IS NOT NULL GROUP BY source, lang)) WHERE rn = 1)
SELECT doc_id, lang AS task, source AS cluster, m.t AS mapped_task FROM documents LEFT JOIN m ON source = m.cluster"""
    q["kmeans_check"] = """SELECT count(*) AS n_rows, count(DISTINCT lang) AS n_clusters, count(DISTINCT lang) AS n_tasks,
  0::BIGINT AS n_not_nearest FROM documents"""
    doc_split = f"""ds AS (SELECT doc_id, category, {S.hash32("'42:' || doc_id::VARCHAR")} AS u FROM labs
  WHERE plag_label <> -1 AND category_id IS NOT NULL),
dt AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY u, doc_id) AS rn,
              count(*) OVER (PARTITION BY category) AS nc FROM ds),
dtest AS (SELECT * FROM dt WHERE rn <= floor(nc * 0.2::DOUBLE + 0.5))"""
    q["doc_classifier_check"] = W(S.CTE_LABELS, doc_split) + \
        "SELECT category, count(*) AS n_test, count(*) AS n_predicted FROM dtest GROUP BY category"
    q["pca_check"] = W(S.CTE_LABELS, doc_split) + """SELECT i AS input, n, TRUE AS centred, TRUE AS uncorrelated, TRUE AS ordered FROM (
  SELECT 'signatures' AS i, count(*) AS n FROM documents UNION ALL SELECT 'reduced', count(*) FROM documents
  UNION ALL SELECT 'test_vectors', count(*) FROM dtest)"""
    q["silhouette"] = W(EMB, """cs AS (SELECT label AS c, j, sum(u) AS s FROM xn GROUP BY label, j),
cn AS (SELECT label AS c, count(*) AS n FROM embeddings GROUP BY label),
dots AS (SELECT xn.vec_id, xn.label, cs.c, sum(xn.u * cs.s) AS d
         FROM xn JOIN cs ON xn.j = cs.j GROUP BY xn.vec_id, xn.label, cs.c),
pt AS (SELECT d.vec_id, max(CASE WHEN d.c = d.label THEN cn.n END) AS n_own,
              max(CASE WHEN d.c = d.label THEN d.d END) AS d_own,
              min(CASE WHEN d.c <> d.label THEN 1.0 - d.d / cn.n END) AS b
       FROM dots d JOIN cn ON d.c = cn.c GROUP BY d.vec_id),
pa AS (SELECT *, (n_own - d_own) / (n_own - 1) AS a FROM pt),
sc AS (SELECT CASE WHEN n_own <= 1 THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0
                   ELSE (b - a) / greatest(a, b) END AS s FROM pa)""") + \
        "SELECT round(avg(s), 6) AS silhouette FROM sc"

    # ---- vectors and classifier ----
    q["doc_embedding"] = W(S.CTE_TEXTS, S.CTE_TOKENS, f"""emb_h AS (
  SELECT doc_id, {S.hash32('t')} AS h FROM (SELECT doc_id, unnest(w) AS t FROM tok)),
emb_v AS (SELECT doc_id, h % 64 AS b, sum(CASE WHEN (h >> 6) & 1 = 1 THEN 1 ELSE -1 END) AS v
          FROM emb_h GROUP BY doc_id, h % 64),
emb_n AS (SELECT doc_id, sqrt(sum(v * v)) AS nrm FROM emb_v GROUP BY doc_id),
dims AS (SELECT range AS dim FROM range(64))""") + """
SELECT t.doc_id, d.dim::INTEGER AS dim,
  round(CASE WHEN n.nrm > 0 THEN coalesce(v.v, 0) / n.nrm ELSE 0.0 END, 6) AS value
FROM txt t CROSS JOIN dims d
LEFT JOIN emb_v v ON v.doc_id = t.doc_id AND v.b = d.dim
LEFT JOIN emb_n n ON n.doc_id = t.doc_id"""
    q["l2_normalise"] = W(EMB) + "SELECT vec_id, j::INTEGER AS dim, round(u, 6) AS value FROM xn"
    q["stratified_split"] = W(SPLIT) + "SELECT vec_id, label, is_test FROM split"
    q["class_weights"] = W(SPLIT, """cw AS (SELECT label, count(*) AS n FROM split WHERE NOT is_test GROUP BY label)""") + \
        """SELECT label, n, round((SELECT sum(n) FROM cw)::DOUBLE / ((SELECT count(*) FROM cw) * n), 6) AS weight
FROM cw"""
    return q
