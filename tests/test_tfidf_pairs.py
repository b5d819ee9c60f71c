import math
import re
from collections import Counter

import numpy as np
import pytest

from reuselens.operators import blocks as BL
from reuselens.operators import cosine as CO
from reuselens.operators import tfidf as TF
from reuselens.session import cut_lineage

DOCS = ["the cat sat on the mat", "the cat sat on the mat", "a dog sat on a log",
        "cats and dogs", "completely different words here", "", "x y z",
        "the mat the cat the dog", "log on the dog", "words words words here"]


def py_tfidf(docs, min_df=2, max_df=0.85):
    grams = []
    for d in docs:
        t = [w for w in d.split() if len(w) >= 2]
        grams.append(t + [f"{a} {b}" for a, b in zip(t, t[1:])])
    n = len(docs)
    df = Counter(g for gs in grams for g in set(gs))
    keep = {g for g, c in df.items() if min_df <= c <= max_df * n}
    out = []
    for gs in grams:
        tf = Counter(g for g in gs if g in keep)
        w = {g: c * (math.log((1 + n) / (1 + df[g])) + 1) for g, c in tf.items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        out.append({g: v / norm for g, v in w.items()} if norm else {})
    return out


def _weights(spark):
    t = spark.createDataFrame(list(enumerate(DOCS)), "doc_id long, clean_text string")
    return t, TF.tfidf(t)


def _vectors(spark):
    t, _ = _weights(spark)
    return t, cut_lineage(TF.tfidf_vectors(t))


def test_tfidf_matches_reference_rule(spark):
    _, w = _weights(spark)
    exp = py_tfidf(DOCS)
    got = {}
    for r in w.collect():
        got.setdefault(r.doc_id, {})[r.gram] = r.w
    for i, e in enumerate(exp):
        assert set(got.get(i, {})) == set(e)
        for g, v in e.items():
            assert abs(got[i][g] - v) < 1e-12


def _cos_matrix(exp):
    n = len(exp)
    m = np.zeros((n, n))
    for i in range(n):
        for j in range(n):
            m[i, j] = sum(v * exp[j].get(g, 0.0) for g, v in exp[i].items())
    return m


@pytest.mark.parametrize("docs, products", [(BL.BLOCK_DOCS, BL.PRODUCTS), (3, 2), (1, 1)])
def test_top_neighbours_brute_force(spark, monkeypatch, docs, products):
    """Also with many blocks and a few products at a time."""
    monkeypatch.setattr(BL, "BLOCK_DOCS", docs)
    monkeypatch.setattr(BL, "PRODUCTS", products)
    t, w = _vectors(spark)
    got = {(r.doc_id, r.rank): (r.other_id, round(r.sim, 9)) for r in CO.top_neighbours(w, t.select("doc_id"), k=3).collect()}
    m = np.round(_cos_matrix(py_tfidf(DOCS)), 9)
    assert len(got) == 3 * len(DOCS)
    for i in range(len(DOCS)):
        order = sorted((j for j in range(len(DOCS)) if j != i), key=lambda j: (-m[i, j], j))[:3]
        for r, j in enumerate(order, 1):
            assert got[(i, r)][0] == j, (i, r, got[(i, r)], j)
            assert abs(got[(i, r)][1] - m[i, j]) < 1e-9


@pytest.mark.parametrize("exclude_self", [False, True])
@pytest.mark.parametrize("docs", [BL.BLOCK_DOCS, 2])
def test_best_match_brute_force(spark, monkeypatch, docs, exclude_self):
    monkeypatch.setattr(BL, "BLOCK_DOCS", docs)
    t, w = _vectors(spark)
    m = np.round(_cos_matrix(py_tfidf(DOCS)), 9)
    ids = t.select("doc_id")
    got = {r.doc_id: (r.other_id, r.sim) for r in CO.best_match(w, ids.where("doc_id in (1, 4, 6)"), ids, exclude_self).collect()}
    assert len(got) == len(DOCS)
    for i in range(len(DOCS)):
        best = min((j for j in (1, 4, 6) if not exclude_self or j != i), key=lambda j: (-m[i, j], j))
        assert got[i][0] == best and abs(got[i][1] - m[i, best]) < 1e-9


@pytest.mark.parametrize("docs", [BL.BLOCK_DOCS, 2])
def test_all_and_similar_pairs(spark, monkeypatch, docs):
    monkeypatch.setattr(BL, "BLOCK_DOCS", docs)
    _, w = _vectors(spark)
    m = _cos_matrix(py_tfidf(DOCS))
    n = range(len(DOCS))
    pairs = {(r.doc_id, r.other_id): r.sim for r in CO.all_pairs(w).collect()}
    exp = {(i, j): m[i, j] for i in n for j in n if i != j and m[i, j] > 0}
    assert set(pairs) == set(exp) and all(abs(pairs[k] - exp[k]) < 1e-12 for k in exp)
    for least in (0.05, 0.25, 0.6, 1.0):
        near = {(r.doc_id, r.other_id): r.sim for r in CO.similar_pairs(w, least).collect()}
        assert set(near) == {(i, j) for i, j in exp if i < j and round(exp[i, j], 9) >= least}


def test_similar_pairs_of_many_short_documents(spark):
    """20,000 documents of three words, in ten blocks."""
    rows = spark.range(20000).selectExpr(
        "id AS doc_id", "concat('a', id % 4000, ' b', id % 37, ' c', id % 2000) AS clean_text")
    vectors = lambda t: cut_lineage(TF.tfidf_vectors(t))
    near = CO.similar_pairs(vectors(rows), 0.99)
    # the same three words: ids equal modulo 4000 and 37, and so never
    assert near.where("doc_id % 4000 != other_id % 4000").count() == 0
    assert CO.similar_pairs(vectors(rows.limit(3000).union(rows.limit(3000).selectExpr("doc_id + 50000", "clean_text"))), 0.99).count() >= 3000


def test_neighbours_of_short_documents(spark):
    """20,000 documents of three words: a task holds the sums of one pair of blocks."""
    rows = spark.range(20000).selectExpr("id AS doc_id", "concat('a', id % 4000, ' b', id % 37, ' c', id % 2000) AS clean_text")
    top = CO.top_neighbours(cut_lineage(TF.tfidf_vectors(rows)), rows.select("doc_id"), 1)
    assert top.count() == 20000
    assert top.where("doc_id % 4000 != other_id % 4000").count() == 0


def test_gram_counts_stay_in_place(spark):
    """No exchange by document and gram, however the input is split."""
    plans = set()
    for n in (2, 64):
        t = spark.createDataFrame(list(enumerate(DOCS)), "doc_id long, clean_text string").repartition(n)
        plan = TF.term_frequencies(t)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan   # the test's own repartition
        plans.add(re.sub(r"[0-9]+", "", plan))
    assert len(plans) == 1


def test_lists_are_counted_a_slice_at_a_time():
    """A batch of long lists is cut; counts don't change, and nulls have none."""
    import pyarrow as pa
    from reuselens.operators import tfidf as TF
    lists = [["a", "b", "a"], [], None, ["c"] * 5, ["a"], ["d", "d"]]
    batch = pa.record_batch({"doc_id": pa.array(range(6), pa.int64()), "grams": pa.array(lists, pa.list_(pa.string()))})
    parts = list(TF.slices([batch, batch.slice(3)], most=4))
    assert [p.column(0).to_pylist() for p in parts] == [[0, 1, 2], [3], [4, 5], [3], [4, 5]]
    rows = sorted(tuple(r.values()) for p in TF._count_lists(iter(parts[:3])) for r in p.to_pylist())
    assert rows == [(0, "a", 2), (0, "b", 1), (3, "c", 5), (4, "a", 1), (5, "d", 2)]
