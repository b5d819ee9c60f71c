"""Stratified split, class weights and logistic regression (M4-M8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reuselens.functions import text as X

SEED = 42
TEST_SIZE = 0.2
# 2^16 hash buckets per class for the exact split (see stratified_split)
_BUCKET_BITS = 16


def split_hash(key, seed: int = SEED):
    """Deterministic 32-bit draw per row: md5 of 'seed:key'."""
    return X.hash32(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def stratified_split(df: DataFrame, key: str, label: str, test_size: float = TEST_SIZE,
                     seed: int = SEED) -> DataFrame:
    """M4: adds ``is_test``. Per class c with n_c rows, the floor(test_size *
    n_c + 0.5) rows with the smallest (draw, key) are the test rows.

    Exact without sorting a class in one task: rows are counted per
    (class, high 16 bits of the draw); cumulative counts over that bounded
    histogram find each class's boundary bucket, and only the rows of the
    boundary bucket (about n_c / 65536) are ranked individually.
    """
    u = split_hash(key, seed)
    x = df.withColumn("_u", u).withColumn("_hb", F.shiftright("_u", _BUCKET_BITS))
    hist = x.groupBy(label, "_hb").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(label).orderBy("_hb").rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumn("_cum", F.sum("_n").over(w))
    k = hist.groupBy(label).agg(
        F.floor(F.sum("_n") * F.lit(float(test_size)) + F.lit(0.5)).alias("_k"))
    hist = hist.join(k, label).withColumn("_before", F.col("_cum") - F.col("_n"))
    # the bucket containing the k-th row (if k > 0)
    bound = hist.where((F.col("_before") < F.col("_k")) & (F.col("_cum") >= F.col("_k"))) \
        .select(label, F.col("_hb").alias("_bhb"), "_before", "_k")
    k_only = k.join(bound.select(label, "_bhb", "_before"), label, "left")
    x = x.join(k_only, label, "left")
    in_bound = F.col("_hb") == F.col("_bhb")
    wb = Window.partitionBy(label, "_hb").orderBy("_u", key)
    ranked = x.where(in_bound).withColumn("_r", F.row_number().over(wb))
    ranked = ranked.withColumn("is_test", (F.col("_before") + F.col("_r")) <= F.col("_k"))
    rest = x.where(~in_bound | F.col("_bhb").isNull()).withColumn(
        "is_test", F.coalesce(F.col("_hb") < F.col("_bhb"), F.lit(False)))
    cols = df.columns + ["is_test"]
    return ranked.select(*cols).unionByName(rest.select(*cols))


def class_weights(train: DataFrame, label: str) -> DataFrame:
    """M5: balanced weights n / (k * n_c): (label, n, weight)."""
    c = train.groupBy(label).agg(F.count("*").alias("n"))
    tot = c.agg(F.sum("n").alias("_tot"), F.count("*").alias("_k"))
    return c.join(tot, how="inner", on=F.lit(True)).select(
        label, "n", (F.col("_tot") / (F.col("_k") * F.col("n"))).alias("weight"))


def fit_logistic(train: DataFrame, features: str, label: str, max_iter: int = 1000, c: float = 1.0):
    """M6: multinomial logistic regression with balanced class weights and
    L2 penalty matching C = 1 on the summed loss: regParam = 1 / (C * sum w).
    Features are used as given (no standardisation)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql.types import ArrayType

    f = F.col(features)
    if isinstance(train.schema[features].dataType, ArrayType):
        f = array_to_vector(f)
    wts = class_weights(train, label)
    t = train.select(f.alias("_features"), F.col(label).cast("double").alias("_label"), label) \
        .join(wts.select(label, "weight"), label)
    n_w = t.agg(F.sum("weight")).first()[0]
    lr = LogisticRegression(featuresCol="_features", labelCol="_label", weightCol="weight",
                            family="multinomial", maxIter=max_iter, regParam=1.0 / (c * n_w),
                            elasticNetParam=0.0, standardization=False, tol=1e-6)
    return lr.fit(t)


def predict(model, df: DataFrame, key: str, features: str, label: str) -> DataFrame:
    """M7: (key, label, prediction) on the given rows."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql.types import ArrayType

    f = F.col(features)
    if isinstance(df.schema[features].dataType, ArrayType):
        f = array_to_vector(f)
    x = df.select(key, label, f.alias("_features"))
    out = model.transform(x)
    return out.select(key, label, F.col("prediction").cast("int").alias("prediction"))
