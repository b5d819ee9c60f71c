import numpy as np
import pytest
from pyspark.sql import functions as F

from reuselens.operators import classify as CL
from reuselens.operators import clustering as CU
from reuselens.operators import evaluation as EV


def _long(spark, x):
    rows = [(i, f"g{j}", float(x[i, j])) for i in range(x.shape[0]) for j in range(x.shape[1]) if x[i, j]]
    return spark.createDataFrame(rows, "doc_id long, gram string, w double")


@pytest.mark.parametrize("block, cell", [(CU.BLOCK, CU.CELL_WEIGHTS), (17, 100)])
def test_randomized_svd_matches_numpy(spark, monkeypatch, block, cell):
    """Also with many document and gram blocks."""
    monkeypatch.setattr(CU, "BLOCK", block)
    monkeypatch.setattr(CU, "CELL_WEIGHTS", cell)
    x = np.random.RandomState(5).poisson(0.2, size=(60, 40)).astype(float)
    red = {r.doc_id: np.array(r.reduced) for r in CU.randomized_svd_reduce(_long(spark, x), k=5, n_iter=12).collect()}
    ids = sorted(red)
    xv = np.array([red[i] for i in ids])
    u, s, _ = np.linalg.svd(x[ids], full_matrices=False)
    # a flat random spectrum: more steps than the default, for a tight comparison
    assert np.allclose(np.linalg.norm(xv, axis=0), s[:5], rtol=1e-6)
    assert np.allclose(xv @ xv.T, (u[:, :5] * s[:5] ** 2) @ u[:, :5].T, atol=0.02)


def test_svd_has_the_width_of_the_rank(spark):
    x = np.outer([1.0, 2, 3, 4], [1.0, 0, 2]) + np.outer([0.0, 1, 0, 1], [0, 3.0, 0])
    red = [r.reduced for r in CU.randomized_svd_reduce(_long(spark, x), k=50).collect()]
    assert {len(r) for r in red} == {2}
    assert np.allclose(sorted(np.linalg.norm(np.array(red), axis=0)), sorted(np.linalg.svd(x, compute_uv=False)[:2]))


def test_kmeans_and_pca(spark):
    rng = np.random.RandomState(1)
    centres = np.array([[5, 0, 0], [0, 5, 0], [0, 0, 5]])
    rows = [(i, [float(v) for v in centres[i % 3] + rng.normal(0, 0.3, 3)], i % 3) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, f array<double>, t int")
    _, out = CU.kmeans_best_of(df, "f", 3, n_init=3)
    assert out.select("cluster").distinct().count() == 3
    assert EV.purity(out, "t", "cluster").first()[0] == 1.0
    p = CU.pca_2d(df, "id", "f")
    m = p.agg(F.avg("pc1"), F.avg("pc2")).first()
    assert abs(m[0]) < 1e-9 and abs(m[1]) < 1e-9


def test_kmeans_fits_run_side_by_side(spark, monkeypatch):
    """The starts overlap in time, and the best is the one that fits in a row find."""
    import threading

    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rng = np.random.RandomState(3)
    df = spark.createDataFrame([(i, [float(v) for v in rng.normal(0, 1, 3)]) for i in range(200)], "id long, f array<double>")
    x = df.withColumn("_f", array_to_vector("f")).cache()
    x.count()
    alone = [KMeans(k=4, seed=42 + i, maxIter=300, tol=1e-4, featuresCol="_f").fit(x).summary.trainingCost for i in range(3)]
    together, fit = threading.Barrier(3, timeout=60), KMeans.fit

    def met(self, data):
        together.wait()                                      # breaks where one fit waits for another
        return fit(self, data)

    monkeypatch.setattr(KMeans, "fit", met)
    model, _ = CU.kmeans_best_of(df, "f", 4, n_init=3)
    assert model.summary.trainingCost == pytest.approx(min(alone), rel=1e-6)


def test_logistic_regression_separable(spark):
    rng = np.random.RandomState(2)
    rows = []
    for i in range(300):
        c = i % 3
        v = np.zeros(4)
        v[c] = 3.0
        rows.append((i, [float(a) for a in v + rng.normal(0, 0.3, 4)], c))
    df = spark.createDataFrame(rows, "id long, f array<double>, label int")
    sp = CL.stratified_split(df, "id", "label")
    model = CL.fit_logistic(sp.where(~F.col("is_test")), "f", "label")
    pred = CL.predict(model, sp.where(F.col("is_test")), "id", "f", "label")
    assert EV.accuracy(pred, "label", "prediction").first()[0] > 0.95
