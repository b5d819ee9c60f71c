"""Packed rows: hashes as Spark's, chunks and cells as the plain rule."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from reuselens.operators import clustering as CU
from reuselens.operators import packed as P
from reuselens.operators import tfidf as TF
from reuselens.session import cut_lineage


def test_hashes_are_those_of_spark(spark):
    texts = ["x" * n for n in range(1, 70)] + ["größe straße", "a b", "日本 語", "0123456789abcdef" * 5]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h")).collect()
    assert P.xxhash64(pa.array([r.t for r in rows])).tolist() == [r.h for r in rows]


def _texts(spark, monkeypatch):
    """Many chunks and buckets; two rows of one id."""
    monkeypatch.setattr(TF, "CHUNK_BYTES", 400)
    rnd = np.random.RandomState(3)
    words = [f"w{i}" for i in range(30)] + ["a"]
    rows = [(i, " ".join(rnd.choice(words, 25))) for i in range(60)] + [(7, "w1 w2 w3 w1"), (500, ""), (501, "a b c")]
    return rows, spark.createDataFrame(rows, "doc_id long, clean_text string")


def _expected(rows):
    n, df, tfs = len(rows), {}, []
    for key, text in rows:
        t = [w for w in text.split() if len(w) > 1]
        tf = {}
        for g in t + [f"{x} {y}" for x, y in zip(t, t[1:])]:
            tf[g] = tf.get(g, 0) + 1
        tfs.append((key, tf))
        for g in tf:
            df[g] = df.get(g, 0) + 1
    kept = [(key, g, c * (math.log((1 + n) / (1 + df[g])) + 1)) for key, tf in tfs for g, c in tf.items() if 2 <= df[g] <= 0.8 * n]
    square = {}
    for key, _, x in kept:
        square[key] = square.get(key, 0) + x * x
    return sorted((key, g, df[g], round(x / math.sqrt(square[key]), 9)) for key, g, x in kept)


def test_weights_of_many_chunks(spark, monkeypatch):
    rows, texts = _texts(spark, monkeypatch)
    got = TF.tfidf(texts, max_df=0.8)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan      # no row a document and gram is shuffled
    assert sorted((r.doc_id, r.gram, r.df, round(r.w, 9)) for r in got.collect()) == _expected(rows)
    vectors = {r.doc_id: sorted(round(w, 9) for w in r.w) for r in TF.tfidf_vectors(texts, max_df=0.8).collect()}
    assert vectors == {key: sorted(x[3] for x in _expected(rows) if x[0] == key) for key in {x[0] for x in _expected(rows)}}


def test_cells_give_the_svd_of_the_long_weights(spark, monkeypatch):
    """The same blocks' products; nothing by gram is written or shuffled."""
    _, texts = _texts(spark, monkeypatch)
    monkeypatch.setattr(CU, "COLUMN_WEIGHTS", 200)
    a = {r.doc_id: r.reduced for r in CU.svd_of_cells(cut_lineage(TF.tfidf_cells(texts, max_df=0.8)), k=5, n_iter=3).collect()}
    b = {r.doc_id: r.reduced for r in CU.randomized_svd_reduce(TF.tfidf(texts, max_df=0.8), k=5, n_iter=3).collect()}
    assert set(a) == set(b) == set(range(60))
    ids = sorted(a)
    x, y = (np.array([m[i] for i in ids]) for m in (a, b))
    assert x.shape == (60, 5) and np.allclose(x @ x.T, y @ y.T, atol=1e-9)


def test_no_weights_at_all(spark):
    texts = spark.createDataFrame([(1, "one"), (2, "two")], "doc_id long, clean_text string")
    assert CU.svd_of_cells(cut_lineage(TF.tfidf_cells(texts))).count() == 0 and TF.tfidf(texts).count() == 0
