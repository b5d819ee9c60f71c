"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables (whole tables, whole texts) and calls
the library operators. Floating outputs that depend on summation order are
rounded to 6 decimals here and in the matching oracle SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reuselens.functions import labels as L
from reuselens.functions import text as X
from reuselens.operators import banding as BA
from reuselens.operators import classify as CL
from reuselens.operators import clustering as CU
from reuselens.operators import cosine as CO
from reuselens.operators import cowords as CW
from reuselens.operators import evaluation as EV
from reuselens.operators import jaccard as JA
from reuselens.operators import vectors as VE
from reuselens.operators import minhash as MH
from reuselens.operators import tfidf as TF
from reuselens.operators import tuning as TU
from reuselens.session import cut_lineage
from reuselens.sources import corpus as C

DEC = 6


def _r(c, d=DEC):
    return F.round(c, d)


# ------------------------------------------------------------- building ----

def mh_signatures(spark, sf_dir):
    """Signatures of all documents, written once to the checkpoint folder:
    the best-original search reads them in several branches."""
    return cut_lineage(MH.signatures(C.corpus_texts(spark, sf_dir)))


def mh_best(spark, sf_dir, exclude_self=False):
    sigs = mh_signatures(spark, sf_dir)
    origs = sigs.where(C.is_original())
    return MH.best_original(sigs, origs, exclude_self=exclude_self)


def mh_eval_frame(spark, sf_dir):
    """All documents with MinHash best similarity and fixed level."""
    lab = C.corpus_labels(spark, sf_dir)
    b = mh_best(spark, sf_dir)
    return (lab.join(b, "doc_id")
               .withColumn("level", L.copy_level("best_sim"))
               .select("doc_id", "task", "category", "truth_level", "best_original",
                       "best_sim", "level"))


def _labelled(df):
    """The rows that every metric is over: those with a truth."""
    return df.where(F.col("truth_level").isNotNull())


def _with_counts(metrics, frame):
    """Metrics (one row) with the rows they are over and those without a truth."""
    return metrics.join(EV.truth_counts(frame, "truth_level"), how="inner", on=F.lit(True))


def tf_weights(spark, sf_dir, max_df=TF.MAX_DF_SIMILARITY):
    """Long TF-IDF weights of all documents."""
    return TF.tfidf(C.corpus_texts(spark, sf_dir), max_df=max_df)


def tf_vectors(spark, sf_dir):
    """TF-IDF vectors of all documents, written once."""
    return cut_lineage(TF.tfidf_vectors(C.corpus_texts(spark, sf_dir)))


def _doc_ids(spark, sf_dir):
    return C.read_table(spark, sf_dir, "documents").select("doc_id")


def _original_ids(spark, sf_dir):
    return _doc_ids(spark, sf_dir).where(C.is_original())


def tf_best(spark, sf_dir, exclude_self=False):
    rows, ids = _doc_ids(spark, sf_dir).agg(F.count("doc_id"), F.countDistinct("doc_id")).first()
    # where ids repeat, their rows' vectors meet as before, by blocks
    v = TF.tfidf_slices(C.corpus_texts(spark, sf_dir), C.is_original()) if rows == ids else tf_vectors(spark, sf_dir)
    b = CO.best_match(v, _original_ids(spark, sf_dir), _doc_ids(spark, sf_dir), exclude_self)
    return b.select("doc_id", F.col("other_id").alias("best_original"),
                    F.col("sim").alias("best_sim"))


def tf_eval_frame(spark, sf_dir):
    lab = C.corpus_labels(spark, sf_dir)
    b = tf_best(spark, sf_dir)
    return (lab.join(b, "doc_id")
               .withColumn("best_sim", _r(F.col("best_sim")))
               .withColumn("level", L.copy_level("best_sim"))
               .select("doc_id", "task", "category", "truth_level", "best_original",
                       "best_sim", "level"))


# -------------------------------------------------------------- queries ----

def q_clean_text(spark, sf_dir):
    return C.corpus_texts(spark, sf_dir).select("doc_id", "clean_text")


def q_label_ids(spark, sf_dir):
    return C.corpus_labels(spark, sf_dir)


def q_tokens(spark, sf_dir):
    t = C.corpus_texts(spark, sf_dir).select("doc_id", X.tokens("clean_text").alias("w"))
    return t.select("doc_id", F.size("w").alias("n_tokens"),
                    F.size(F.array_distinct("w")).alias("n_distinct"))


def q_shingles(spark, sf_dir):
    t = C.corpus_texts(spark, sf_dir)
    return t.select("doc_id", F.explode(X.shingles("clean_text")).alias("shingle"))


def q_shingle_hash(spark, sf_dir):
    x = C.corpus_texts(spark, sf_dir).select("doc_id", F.transform(X.shingles("clean_text"), X.hash32).alias("x"))
    total = F.aggregate("x", F.lit(0).cast("bigint"), lambda acc, v: acc + v)
    return x.select("doc_id", F.size("x").cast("bigint").alias("n_shingles"), F.array_min("x").alias("min_x"),
                    F.array_max("x").alias("max_x"), F.when(F.size("x") > 0, total).alias("sum_x"))


def q_minhash_signature(spark, sf_dir):
    return MH.signature_long(mh_signatures(spark, sf_dir))


def q_minhash_best(spark, sf_dir):
    return mh_best(spark, sf_dir)


def q_minhash_best_other(spark, sf_dir):
    """Originals aren't scored against themselves."""
    return mh_best(spark, sf_dir, exclude_self=True)


def q_minhash_pairs(spark, sf_dir):
    """Pairs of documents from light copying on, by bands that lose none."""
    return BA.similar_signatures(mh_signatures(spark, sf_dir), int(MH.NUM_HASHES * MIN_SIM) + 1)


def q_minhash_levels(spark, sf_dir):
    return mh_eval_frame(spark, sf_dir)


def q_minhash_benchmark(spark, sf_dir):
    sigs = mh_signatures(spark, sf_dir)
    bsig = cut_lineage(MH.signatures(C.benchmark_texts(spark, sf_dir), key="item_id"))
    return MH.best_original(sigs, bsig, orig_key="item_id").withColumnRenamed(
        "best_original", "best_item")


def q_confusion_matrix(spark, sf_dir):
    return EV.confusion_matrix(_labelled(mh_eval_frame(spark, sf_dir)), "truth_level", "level",
                               labels=L.LEVELS)


def q_accuracy(spark, sf_dir):
    ev = cut_lineage(mh_eval_frame(spark, sf_dir))
    return _with_counts(EV.accuracy(_labelled(ev), "truth_level", "level"), ev)


def q_macro_prf(spark, sf_dir):
    ev = cut_lineage(mh_eval_frame(spark, sf_dir))
    return _with_counts(EV.macro_prf(_labelled(ev), "truth_level", "level"), ev)


def q_jaccard_best(spark, sf_dir):
    """Exact 3-shingle Jaccard to the best other original, and its level: what
    the MinHash estimates can be judged against."""
    b = JA.best_original(C.corpus_texts(spark, sf_dir), _original_ids(spark, sf_dir))
    return b.withColumn("level", L.copy_level("best_sim"))


def q_minhash_vs_jaccard(spark, sf_dir):
    """MinHash levels against the levels of the exact Jaccard."""
    truth = q_jaccard_best(spark, sf_dir).select("doc_id", F.col("level").alias("truth_level"))
    est = mh_best(spark, sf_dir, exclude_self=True).withColumn("level", L.copy_level("best_sim"))
    return EV.confusion_matrix(cut_lineage(truth.join(est, "doc_id")), "truth_level", "level", labels=L.LEVELS)


def q_classification_report(spark, sf_dir):
    return EV.classification_report(_labelled(mh_eval_frame(spark, sf_dir)), "truth_level", "level")


def q_mismatches(spark, sf_dir):
    return EV.mismatches(_labelled(mh_eval_frame(spark, sf_dir)), "truth_level", "level") \
        .select("doc_id", "task", "category", "truth_level", "level")


def q_tune_thresholds(spark, sf_dir):
    return TU.tune_thresholds(_labelled(mh_eval_frame(spark, sf_dir)), "best_sim", "truth_level")


def q_tuned_levels(spark, sf_dir):
    # read twice (tuning, then levels): materialise once
    ev = cut_lineage(_labelled(mh_eval_frame(spark, sf_dir)))
    return TU.tuned_levels(ev, "best_sim", "truth_level").select(
        "doc_id", "best_sim", "truth_level", "tuned_level")


# ---- TF-IDF ----

def q_gram_tf(spark, sf_dir):
    return TF.term_frequencies(C.corpus_texts(spark, sf_dir))


def q_gram_df(spark, sf_dir):
    texts = C.corpus_texts(spark, sf_dir)
    n = _doc_ids(spark, sf_dir).count()
    d = TF.document_frequencies(TF.term_frequencies(texts), n)
    return d.select("gram", "df", _r(F.col("idf")).alias("idf"))


def q_tfidf(spark, sf_dir):
    return tf_weights(spark, sf_dir).select("doc_id", "gram", _r(F.col("w")).alias("w"))


def q_tfidf_best(spark, sf_dir):
    return tf_best(spark, sf_dir).withColumn("best_sim", _r(F.col("best_sim")))


def q_tfidf_levels(spark, sf_dir):
    return tf_eval_frame(spark, sf_dir)


def q_tfidf_tuned(spark, sf_dir):
    return TU.tune_thresholds(_labelled(tf_eval_frame(spark, sf_dir)), "best_sim", "truth_level")


def q_tfidf_best_other(spark, sf_dir):
    """Originals aren't compared with themselves."""
    return tf_best(spark, sf_dir, exclude_self=True).withColumn("best_sim", _r(F.col("best_sim")))


def q_all_pairs_cosine(spark, sf_dir):
    p = CO.all_pairs(tf_vectors(spark, sf_dir))
    return p.select("doc_id", "other_id", _r(F.col("sim")).alias("sim"))


#: Pairs from the similarity on that counts as light copying.
MIN_SIM = L.DEFAULT_THRESHOLDS[1]


def q_similar_pairs(spark, sf_dir):
    p = CO.similar_pairs(tf_vectors(spark, sf_dir), MIN_SIM)
    return p.select("doc_id", "other_id", _r(F.col("sim")).alias("sim"))


def q_top3_neighbours(spark, sf_dir):
    t = CO.top_neighbours(tf_vectors(spark, sf_dir), _doc_ids(spark, sf_dir), k=3)
    return t.select("doc_id", "rank", "other_id", _r(F.col("sim")).alias("sim"))


def q_method_comparison(spark, sf_dir):
    mh_ev = cut_lineage(_labelled(mh_eval_frame(spark, sf_dir)))
    tf_ev = cut_lineage(_labelled(tf_eval_frame(spark, sf_dir)))
    mh = TU.tuned_levels(mh_ev, "best_sim", "truth_level")
    tf = TU.tuned_levels(tf_ev, "best_sim", "truth_level")
    a = EV.result_row(EV.macro_prf(mh, "truth_level", "tuned_level"), "minhash")
    b = EV.result_row(EV.macro_prf(tf, "truth_level", "tuned_level"), "tfidf_cosine")
    return a.unionByName(b)


def q_method_comparison_all(spark, sf_dir):
    """The result table with its third row, the classifier on document vectors."""
    pred = doc_classifier_frame(spark, sf_dir)
    c = EV.result_row(EV.macro_prf(pred, "label", "prediction"), "embedding_logistic")
    return q_method_comparison(spark, sf_dir).unionByName(c)


# ---- labels, selections, sources ----

def q_answers_only(spark, sf_dir):
    return C.corpus_labels(spark, sf_dir).where(F.col("plag_label") != -1) \
        .select("doc_id", "category", "category_id", "plag_label")


def q_originals(spark, sf_dir):
    return C.corpus_labels(spark, sf_dir).where(F.col("category") == "orig").select("doc_id", "task")


def q_label_counts(spark, sf_dir):
    a = C.corpus_labels(spark, sf_dir).where(F.col("plag_label") != -1)
    return EV.value_counts(a, "category_id")


def q_task_count(spark, sf_dir):
    return EV.distinct_count(C.corpus_labels(spark, sf_dir), "task", "n_tasks")


def q_encode_task(spark, sf_dir):
    df, _ = EV.encode_sorted(C.corpus_labels(spark, sf_dir).select("doc_id", "task"), "task", "task_id")
    return df.select("doc_id", "task", "task_id")


def q_preview(spark, sf_dir, n=5):
    """The first n documents by key. The n keys are chosen from the
    small label columns first; only their texts are then cleaned (n rows,
    a bounded broadcast), not the whole corpus."""
    head = C.corpus_labels(spark, sf_dir).orderBy("doc_id").limit(n) \
        .select("doc_id", "task", "category")
    docs = C.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.join(F.broadcast(head), "doc_id").select(
        "doc_id", "task", "category", X.clean_text("text").alias("clean_text"))


def q_missing_report(spark, sf_dir):
    docs = C.read_table(spark, sf_dir, "documents").select("doc_id")
    lab = C.read_table(spark, sf_dir, "labels").select("doc_id")
    return C.missing_report(docs, lab, "doc_id")


def q_tolerant_load(spark, sf_dir):
    lab = C.read_table(spark, sf_dir, "labels").select("doc_id")
    docs = C.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    j = lab.join(docs, "doc_id", "left")
    return j.select("doc_id", F.col("text").isNotNull().alias("has_text"),
                    F.length(F.coalesce("text", F.lit(""))).alias("n_chars"))


# ---- clustering metrics on a fixed assignment (task vs source) ----

def _task_source(spark, sf_dir):
    return C.read_table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("task"),
                                                            "source")


def q_purity(spark, sf_dir):
    return EV.purity(_task_source(spark, sf_dir), "task", "source")


def q_ari(spark, sf_dir):
    return EV.adjusted_rand_index(_task_source(spark, sf_dir), "task", "source")


def q_cluster_to_task(spark, sf_dir):
    return EV.cluster_to_majority(_task_source(spark, sf_dir), "task", "source")


def q_cluster_mapped(spark, sf_dir):
    """The majority task of a row's cluster, row by row."""
    rows = _task_source(spark, sf_dir)
    mapped = EV.apply_mapping(rows.withColumnRenamed("source", "cluster"), "cluster",
                              EV.cluster_to_majority(rows, "task", "source"), "mapped_task")
    return mapped.select("doc_id", "task", "cluster", "mapped_task")


def q_silhouette(spark, sf_dir):
    e = C.read_table(spark, sf_dir, "embeddings")
    return EV.silhouette_cosine(e, "embedding", "label").select(_r(F.col("silhouette")).alias("silhouette"))


def svd_frame(spark, sf_dir):
    """TF-IDF (max_df 0.8) reduced to 50 dimensions (or its rank, if that is
    less) for every document; zero vectors reduce to zero."""
    cells = TF.tfidf_cells(C.corpus_texts(spark, sf_dir), max_df=TF.MAX_DF_CLUSTERING)
    red = CU.svd_of_cells(cells, last_use=True)
    some = red.select(F.size("reduced")).first()
    zero = F.array_repeat(F.lit(0.0), some[0] if some else CU.SVD_COMPONENTS)
    all_ids = _doc_ids(spark, sf_dir).join(red, "doc_id", "left")
    return cut_lineage(all_ids.select("doc_id", F.coalesce("reduced", zero).alias("reduced")))


def q_svd_features(spark, sf_dir):
    return svd_frame(spark, sf_dir)


def kmeans_frame(spark, sf_dir):
    """``(rows, model, tasks)``: reduced vectors, clusters and their majority
    task; the fitted model; task names by id (one a cluster)."""
    red = svd_frame(spark, sf_dir)
    lab = C.corpus_labels(spark, sf_dir).select("doc_id", "task")
    enc, names = EV.encode_sorted(lab, "task", "task_id")
    k = lab.agg(F.countDistinct("task")).first()[0]
    model, clustered = CU.kmeans_best_of(red.join(enc, "doc_id"), "reduced", k)
    mapping = EV.cluster_to_majority(clustered, "task_id", "cluster")
    rows = cut_lineage(EV.apply_mapping(clustered, "cluster", mapping, "cluster_task_id"))
    return rows, model, {r["id"]: r["value"] for r in names.collect()}


def q_kmeans_clusters(spark, sf_dir):
    return kmeans_frame(spark, sf_dir)[0].select("doc_id", "task", "task_id", "cluster",
                                                 "cluster_task_id")


def q_kmeans_quality(spark, sf_dir):
    """Internal and external quality of the clustering, and of the mapped tasks."""
    km = kmeans_frame(spark, sf_dir)[0]
    one = [EV.silhouette_cosine(km, "reduced", "cluster"), EV.adjusted_rand_index(km, "task_id", "cluster"),
           EV.purity(km, "task_id", "cluster"), EV.macro_prf(km, "task_id", "cluster_task_id")]
    out = reduce(lambda a, b: a.join(b, how="inner", on=F.lit(True)), one)
    return out.select(*[_r(F.col(c)).alias(c) for c in out.columns])


def q_kmeans_report(spark, sf_dir):
    """Per-task report of the mapped clusters, with task names."""
    km, _, names = kmeans_frame(spark, sf_dir)
    return EV.classification_report(km, "task_id", "cluster_task_id", names=names)


def q_kmeans_matrix(spark, sf_dir):
    km = kmeans_frame(spark, sf_dir)[0]
    return EV.confusion_matrix(km, "task_id", "cluster")


def q_kmeans_check(spark, sf_dir):
    """What any clustering must satisfy: every row, as many clusters as tasks,
    and no row nearer to another centre than to its own."""
    km, model, names = kmeans_frame(spark, sf_dir)

    def apart(centre):
        return F.aggregate(F.zip_with("reduced", F.array(*[F.lit(float(x)) for x in centre]), lambda a, b: (a - b) * (a - b)),
                           F.lit(0.0), lambda acc, v: acc + v)

    d = [apart(c) for c in model.clusterCenters()]       # one a task
    own = F.element_at(F.array(*d), F.col("cluster") + 1)
    far = own > F.array_min(F.array(*d)) + 1e-9
    return km.agg(F.count("*").alias("n_rows"), F.countDistinct("cluster").alias("n_clusters"),
                  F.lit(len(names)).cast("bigint").alias("n_tasks"),
                  F.sum(far.cast("bigint")).alias("n_not_nearest"))


def q_pca_coords(spark, sf_dir):
    return CU.pca_2d(mh_signatures(spark, sf_dir), "doc_id", "signature")


def q_pca_reduced(spark, sf_dir):
    """Coordinates of the reduced TF-IDF vectors, with the task."""
    red = svd_frame(spark, sf_dir)
    return CU.pca_2d(red, "doc_id", "reduced").join(C.corpus_labels(spark, sf_dir).select("doc_id", "task", "category"), "doc_id")


def q_pca_test_vectors(spark, sf_dir):
    """Coordinates of the test documents' vectors, with class and prediction."""
    sp = doc_split(spark, sf_dir)
    pred = doc_classifier_frame(spark, sf_dir, sp)
    return CU.pca_2d(sp.where(F.col("is_test")), "doc_id", "embedding").join(pred, "doc_id") \
        .select("doc_id", "pc1", "pc2", L.class_name("label").alias("category"), L.class_name("prediction").alias("predicted"))


def q_pca_check(spark, sf_dir):
    """What principal components must satisfy, for each of the three inputs."""
    rows = []
    for name, p in (("signatures", q_pca_coords(spark, sf_dir)), ("reduced", q_pca_reduced(spark, sf_dir)),
                    ("test_vectors", q_pca_test_vectors(spark, sf_dir))):
        size = F.greatest(F.stddev("pc1"), F.lit(1e-300))
        rows.append(p.agg(F.lit(name).alias("input"), F.count("*").alias("n"),
                          (F.abs(F.avg("pc1")) + F.abs(F.avg("pc2")) < size * 1e-6).alias("centred"),
                          (F.abs(F.corr("pc1", "pc2")) < 1e-6).alias("uncorrelated"),
                          (F.variance("pc1") >= F.variance("pc2")).alias("ordered")))
    return reduce(DataFrame.unionByName, rows)


# ---- vectors and classifier ----

def q_doc_embedding(spark, sf_dir):
    e = VE.embed_documents(C.corpus_texts(spark, sf_dir))
    return VE.vector_long(e, "doc_id")


def q_cooccurrence(spark, sf_dir):
    """Windowed counts of word pairs, the input of the learned vectors."""
    texts = C.corpus_texts(spark, sf_dir)
    return CW.cooccurrence(texts, [w for w, _ in CW.vocabulary(texts)])


def q_learned_embedding(spark, sf_dir):
    texts = C.corpus_texts(spark, sf_dir)
    return CW.embed_batched(texts, CW.fit(texts))


def q_embedding_comparison(spark, sf_dir):
    """The document classifier's scores on hashed and on learned vectors, on
    the same test documents."""
    sp = doc_split(spark, sf_dir)
    learned = cut_lineage(sp.drop("embedding").join(q_learned_embedding(spark, sf_dir), "doc_id"))
    rows = []
    for name, rows_of in (("hashed", sp), ("learned", learned)):
        model = CL.fit_logistic(rows_of.where(~F.col("is_test")), "embedding", "label")
        pred = cut_lineage(CL.predict(model, rows_of.where(F.col("is_test")), "doc_id", "embedding", "label"))
        rows.append(EV.result_row(EV.macro_prf(pred, "label", "prediction"), name))
    return reduce(DataFrame.unionByName, rows)


def q_l2_normalise(spark, sf_dir):
    e = C.read_table(spark, sf_dir, "embeddings")
    n = e.select("vec_id", EV.l2_normalise(F.col("embedding")).alias("embedding"))
    return VE.vector_long(n, "vec_id")


def _split(spark, sf_dir):
    e = C.read_table(spark, sf_dir, "embeddings")
    return CL.stratified_split(e, "vec_id", "label")


def q_stratified_split(spark, sf_dir):
    return _split(spark, sf_dir).select("vec_id", "label", "is_test")


def q_class_weights(spark, sf_dir):
    tr = _split(spark, sf_dir).where(~F.col("is_test"))
    return CL.class_weights(tr, "label").select("label", "n", _r(F.col("weight")).alias("weight"))


def lr_frame(spark, sf_dir):
    sp = cut_lineage(_split(spark, sf_dir))
    model = CL.fit_logistic(sp.where(~F.col("is_test")), "embedding", "label")
    return CL.predict(model, sp.where(F.col("is_test")), "vec_id", "embedding", "label")


def q_lr_predictions(spark, sf_dir):
    return lr_frame(spark, sf_dir)


def q_lr_report(spark, sf_dir):
    return EV.classification_report(lr_frame(spark, sf_dir), "label", "prediction")


# ---- classifier on documents ----

def doc_split(spark, sf_dir):
    """Vectors of the labelled answers (no originals) with class and split."""
    lab = C.corpus_labels(spark, sf_dir).where((F.col("plag_label") != -1) & F.col("category_id").isNotNull()) \
        .select("doc_id", F.col("category_id").alias("label"))
    vec = VE.embed_documents(C.corpus_texts(spark, sf_dir)).join(lab, "doc_id")
    return cut_lineage(CL.stratified_split(vec, "doc_id", "label"))


def doc_classifier_frame(spark, sf_dir, split=None):
    """Test documents with class and prediction (``split``: where it is there already)."""
    sp = doc_split(spark, sf_dir) if split is None else split
    model = CL.fit_logistic(sp.where(~F.col("is_test")), "embedding", "label")
    return cut_lineage(CL.predict(model, sp.where(F.col("is_test")), "doc_id", "embedding", "label"))


def q_doc_classifier_report(spark, sf_dir):
    return EV.classification_report(doc_classifier_frame(spark, sf_dir), "label", "prediction", names=L.CLASS_NAMES)


def q_doc_classifier_matrix(spark, sf_dir):
    m = EV.confusion_matrix(doc_classifier_frame(spark, sf_dir), "label", "prediction", labels=list(L.CLASS_NAMES))
    return m.select(L.class_name("truth").alias("truth"), L.class_name("pred").alias("pred"), "n")


def q_doc_classifier_check(spark, sf_dir):
    """What any classifier must leave: the test rows of each class, by name."""
    pred = doc_classifier_frame(spark, sf_dir)
    return pred.groupBy(L.class_name("label").alias("category")).agg(
        F.count("*").alias("n_test"), F.count(L.class_name("prediction")).alias("n_predicted"))


QUERIES = {
    "clean_text": q_clean_text,
    "label_ids": q_label_ids,
    "tokens": q_tokens,
    "shingles": q_shingles,
    "shingle_hash": q_shingle_hash,
    "minhash_signature": q_minhash_signature,
    "minhash_best": q_minhash_best,
    "minhash_best_other": q_minhash_best_other,
    "jaccard_best": q_jaccard_best,
    "minhash_vs_jaccard": q_minhash_vs_jaccard,
    "minhash_levels": q_minhash_levels,
    "minhash_pairs": q_minhash_pairs,
    "minhash_benchmark": q_minhash_benchmark,
    "confusion_matrix": q_confusion_matrix,
    "accuracy": q_accuracy,
    "macro_prf": q_macro_prf,
    "classification_report": q_classification_report,
    "mismatches": q_mismatches,
    "tune_thresholds": q_tune_thresholds,
    "tuned_levels": q_tuned_levels,
    "gram_tf": q_gram_tf,
    "gram_df": q_gram_df,
    "tfidf": q_tfidf,
    "tfidf_best": q_tfidf_best,
    "tfidf_levels": q_tfidf_levels,
    "tfidf_tuned": q_tfidf_tuned,
    "all_pairs_cosine": q_all_pairs_cosine,
    "tfidf_best_other": q_tfidf_best_other,
    "similar_pairs": q_similar_pairs,
    "top3_neighbours": q_top3_neighbours,
    "method_comparison": q_method_comparison,
    "method_comparison_all": q_method_comparison_all,
    "answers_only": q_answers_only,
    "originals": q_originals,
    "label_counts": q_label_counts,
    "task_count": q_task_count,
    "encode_task": q_encode_task,
    "preview": q_preview,
    "missing_report": q_missing_report,
    "tolerant_load": q_tolerant_load,
    "purity": q_purity,
    "ari": q_ari,
    "cluster_to_task": q_cluster_to_task,
    "cluster_mapped": q_cluster_mapped,
    "silhouette": q_silhouette,
    "svd_features": q_svd_features,
    "kmeans_clusters": q_kmeans_clusters,
    "kmeans_quality": q_kmeans_quality,
    "kmeans_report": q_kmeans_report,
    "kmeans_matrix": q_kmeans_matrix,
    "kmeans_check": q_kmeans_check,
    "pca_coords": q_pca_coords,
    "pca_reduced": q_pca_reduced,
    "pca_test_vectors": q_pca_test_vectors,
    "pca_check": q_pca_check,
    "doc_classifier_report": q_doc_classifier_report,
    "doc_classifier_matrix": q_doc_classifier_matrix,
    "doc_classifier_check": q_doc_classifier_check,
    "doc_embedding": q_doc_embedding,
    "cooccurrence": q_cooccurrence,
    "learned_embedding": q_learned_embedding,
    "embedding_comparison": q_embedding_comparison,
    "l2_normalise": q_l2_normalise,
    "stratified_split": q_stratified_split,
    "class_weights": q_class_weights,
    "lr_predictions": q_lr_predictions,
    "lr_report": q_lr_report,
}
