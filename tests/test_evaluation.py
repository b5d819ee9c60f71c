import numpy as np
from pyspark.sql import functions as F

from reuselens.operators import evaluation as EV


def _frame(spark, t, p):
    return spark.createDataFrame(list(zip(t, p)), "t string, p string")


def test_confusion_and_prf_with_unseen_labels(spark):
    t = ["a", "a", "b", "b", "c", "c"]
    p = ["a", "b", "b", "b", "d", "a"]   # c never predicted, d only predicted
    df = _frame(spark, t, p)
    cm = {(r.truth, r.pred): r.n for r in EV.confusion_matrix(df, "t", "p").collect()}
    assert len(cm) == 16 and sum(cm.values()) == 6 and cm[("c", "d")] == 1 and cm[("d", "d")] == 0
    m = EV.macro_prf(df, "t", "p").first()
    # per label (a, b, c, d): P = .5, 2/3, 0, 0 ; R = .5, 1, 0, 0
    assert abs(m.precision - (0.5 + 2 / 3) / 4) < 1e-12
    assert abs(m.recall - 1.5 / 4) < 1e-12
    f1 = [0.5, 0.8, 0.0, 0.0]
    assert abs(m.f1 - np.mean(f1)) < 1e-12
    assert abs(m.accuracy - 3 / 6) < 1e-12
    rep = {r.label: r for r in EV.classification_report(df, "t", "p").collect()}
    assert rep["accuracy"].support == 6 and rep["accuracy"].precision is None
    assert abs(rep["weighted avg"].recall - (2 * 0.5 + 2 * 1 + 2 * 0) / 6) < 1e-12


def test_accuracy_null_is_a_miss(spark):
    df = spark.createDataFrame([("a", "a"), (None, "a"), (None, None)], "t string, p string")
    assert abs(EV.accuracy(df, "t", "p").first()[0] - 1 / 3) < 1e-12
    assert EV.mismatches(df, "t", "p").count() == 1


def test_purity_ari_majority(spark):
    t = [0, 0, 1, 1, 2, 2]
    c = [5, 5, 6, 6, 7, 7]
    df = spark.createDataFrame(list(zip(t, c)), "t int, c int")
    assert EV.purity(df, "t", "c").first()[0] == 1.0
    assert abs(EV.adjusted_rand_index(df, "t", "c").first()[0] - 1.0) < 1e-12
    # a tie between two majority tasks goes to the lowest id
    df2 = spark.createDataFrame([(1, 0), (2, 0), (2, 1), (0, 1), (0, 1)], "t int, c int")
    m = {r.cluster: r.mapped for r in EV.cluster_to_majority(df2, "t", "c").collect()}
    assert m == {0: 1, 1: 0}


def test_ari_known_value(spark):
    t = [0, 0, 0, 1, 1, 1]
    c = [0, 0, 1, 1, 2, 2]
    df = spark.createDataFrame(list(zip(t, c)), "t int, c int")
    # contingency [[2,1,0],[0,1,2]]: index 2, row pairs 6, column pairs 3,
    # expected 6*3/15, max (6+3)/2
    exp = 6 * 3 / 15
    assert abs(EV.adjusted_rand_index(df, "t", "c").first()[0] - (2 - exp) / (4.5 - exp)) < 1e-12


def test_silhouette_matches_pairwise(spark):
    rng = np.random.RandomState(3)
    x = rng.normal(size=(40, 5))
    lab = rng.randint(0, 3, 40)
    lab[0] = 3  # a singleton cluster
    df = spark.createDataFrame([(int(l), [float(v) for v in row]) for l, row in zip(lab, x)],
                               "c int, v array<double>")
    got = EV.silhouette_cosine(df, "v", "c").first()[0]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    d = 1 - u @ u.T
    s = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    assert abs(got - np.mean(s)) < 1e-9


def test_encode_sorted(spark):
    df = spark.createDataFrame([("c",), ("a",), ("b",), ("a",), (None,)], "x string")
    out, mapping = EV.encode_sorted(df, "x", "xid")
    assert {r.value: r.id for r in mapping.collect()} == {"a": 0, "b": 1, "c": 2}
    assert out.where(F.col("xid").isNull()).count() == 1
