import numpy as np
from pyspark.sql import functions as F

from reuselens.operators import minhash as MH


def _texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, clean_text string")


def test_identical_disjoint_half(spark):
    base = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    half = " ".join(f"w{i}" for i in range(30)) + " " + " ".join(f"u{i}" for i in range(30))
    sigs = MH.signatures(_texts(spark, [(1, base), (2, base), (3, other), (4, half)]))
    s = {r.doc_id: r.signature for r in sigs.collect()}
    sim = lambda a, b: float(np.mean(np.array(s[a]) == np.array(s[b])))
    assert sim(1, 2) == 1.0
    assert sim(1, 3) <= 0.05
    assert 0.15 < sim(1, 4) < 0.55  # exact Jaccard 28/90 ~ 0.31


def test_vectorised_equals_aggregate(spark):
    rows = [(i, " ".join(f"t{(i * 7 + j) % 40}" for j in range(5 + i))) for i in range(30)]
    rows += [(100, ""), (101, "one two")]
    t = _texts(spark, rows)
    a = MH.signatures(t).withColumnRenamed("signature", "a")
    b = MH.signatures(t, method="aggregate").withColumnRenamed("signature", "b")
    assert a.join(b, "doc_id").where(F.col("a") != F.col("b")).count() == 0
    empty = [r.a for r in a.where(F.col("doc_id") >= 100).collect()]
    assert all(v == [MH.SENTINEL] * MH.NUM_HASHES for v in empty)


def test_minhash_estimates_jaccard(spark):
    """Pairs whose shingle sets are known by construction: a text of n words
    w0 w1 ... and one that goes on differently after the first m of them share
    the m - 2 shingles within those."""
    cases = [(80, m) for m in (20, 30, 40, 50, 60, 70, 76)] * 3
    rows, truth = [], []
    for i, (n, m) in enumerate(cases):
        words = [f"w{i}_{j}" for j in range(n)]
        rows.append((2 * i, " ".join(words)))
        rows.append((2 * i + 1, " ".join(words[:m] + [f"v{i}_{j}" for j in range(n - m)])))
        truth.append((m - 2) / (2 * (n - 2) - (m - 2)))
    s = {r.doc_id: np.array(r.signature) for r in MH.signatures(_texts(spark, rows)).collect()}
    errs = [np.mean(s[2 * i] == s[2 * i + 1]) - t for i, t in enumerate(truth)]
    assert abs(np.mean(errs)) < 0.04 and np.std(errs) < 0.08


def test_best_original_ties_empty_and_copies(spark):
    base = " ".join(f"w{i}" for i in range(50))
    rows = [(0, base), (20, base), (40, ""), (60, "p q r s t u"),     # originals
            (1, base), (2, ""), (3, "zz yy xx ww"), (4, "a b")]
    t = _texts(spark, rows)
    sigs = MH.signatures(t)
    origs = sigs.where(F.col("doc_id") % 20 == 0)
    got = {r.doc_id: (r.best_original, r.best_sim) for r in MH.best_original(sigs, origs).collect()}
    assert got[1] == (0, 1.0)          # copies of two originals: lowest id wins
    assert got[20] == (0, 1.0)         # originals are scored too
    assert got[2] == (40, 1.0)         # empty vs empty original
    assert got[4] == (40, 1.0)         # < 3 words is empty too
    assert got[3] == (0, 0.0)          # nothing shared: first original


def test_best_original_without_empty_original(spark):
    rows = [(0, "a b c d e"), (20, "f g h i j"), (5, "")]
    sigs = MH.signatures(_texts(spark, rows))
    got = {r.doc_id: (r.best_original, r.best_sim)
           for r in MH.best_original(sigs, sigs.where(F.col("doc_id") % 20 == 0)).collect()}
    assert got[5] == (0, 0.0)


def test_salted_hot_keys_give_same_answer(spark):
    base = [f"w{i}" for i in range(60)]
    rows = []
    for d in range(0, 200):
        ws = list(base)
        ws[d % 60] = f"edit{d}"          # near copies: distinct signatures
        rows.append((d, " ".join(ws)))
    rows.append((1000, "unrelated words only here and there"))
    sigs = MH.signatures(_texts(spark, rows))
    origs = sigs.where(F.col("doc_id") % 20 == 0)
    a = sorted(tuple(r) for r in MH.best_original(sigs, origs).collect())
    b = sorted(tuple(r) for r in MH.best_original(sigs, origs, hot_limit=2).collect())
    assert a == b and len(a) == 201


def test_no_key_group_is_above_the_limit(spark):
    """1,000 near copies against 200 near copies among the originals."""
    d = spark.range(1000).selectExpr("id AS _rep", "posexplode(array(7, id % 3, 9)) AS (i, m)")
    o = spark.range(200).selectExpr("id AS _orig", "posexplode(array(7, id % 3, id)) AS (i, m)")
    plain = sorted(map(tuple, d.join(o, ["i", "m"]).groupBy("_rep", "_orig").count().collect()))
    a, b = MH.salted(d, o, 50)
    for side in (a, b):
        assert side.groupBy("i", "m", "_salt").count().agg({"count": "max"}).first()[0] <= 100   # 50 on average
    assert sorted(map(tuple, MH.salted_match_counts(d, o, 50).collect())) == plain


def test_exclude_self(spark):
    base = " ".join(f"w{i}" for i in range(50))
    rows = [(0, base), (20, base), (40, ""), (60, "p q r s t u"), (80, base + " more"),
            (1, base), (2, ""), (3, "zz yy xx ww")]
    sigs = MH.signatures(_texts(spark, rows))
    got = {r.doc_id: (r.best_original, r.best_sim) for r in
           MH.best_original(sigs, sigs.where(F.col("doc_id") % 20 == 0), exclude_self=True).collect()}
    assert got[0] == (20, 1.0) and got[20] == (0, 1.0) and got[1] == (0, 1.0)
    assert got[40] == (0, 0.0)          # no other empty original: the first
    assert got[60] == (0, 0.0)          # shares nothing with another original
    assert got[80][0] == 0 and 0.8 < got[80][1] < 1.0
    assert got[2] == (40, 1.0) and got[3] == (0, 0.0)
    one = MH.best_original(sigs, sigs.where("doc_id = 60"), exclude_self=True).where("doc_id = 60").first()
    assert one.best_original is None and one.best_sim is None
