"""Evaluation metrics as DataFrame aggregations.

Every metric starts with one aggregation over all rows (partial aggregation
map-side) down to a contingency table whose size is bounded by the number of
labels; the rest works on that small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reuselens.session import cut_lineage


def _eq(t, p):
    """np.mean(a == b) semantics: a NULL on either side is a miss."""
    return F.coalesce(F.col(t) == F.col(p), F.lit(False))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """G1: (value, n) for every distinct value."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n"))


def distinct_count(df: DataFrame, col: str, alias: str = "n_distinct") -> DataFrame:
    """Number of distinct non-NULL values."""
    return df.agg(F.countDistinct(col).alias(alias))


def accuracy(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Share of rows where truth equals prediction."""
    return df.agg(F.avg(_eq(truth, pred).cast("double")).alias("accuracy"))


def truth_counts(df: DataFrame, truth: str) -> DataFrame:
    """One row: n_scored (rows with a truth, which all metrics are over) and
    n_unlabelled (rows without one, which none counts)."""
    return df.agg(F.count(truth).alias("n_scored"), (F.count("*") - F.count(truth)).alias("n_unlabelled"))


def mismatches(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Rows whose prediction differs from the truth (NULL-safe)."""
    return df.filter(~F.col(truth).eqNullSafe(F.col(pred)))


def confusion_counts(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Observed cells only: (truth, pred, n)."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")) \
             .agg(F.count("*").alias("n"))


def label_union(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Sorted union of true and predicted labels (NULL excluded)."""
    t = df.select(F.col(truth).alias("label"))
    p = df.select(F.col(pred).alias("label"))
    return t.union(p).where(F.col("label").isNotNull()).distinct()


def confusion_matrix(df: DataFrame, truth: str, pred: str, labels: list | None = None) -> DataFrame:
    """Zero-filled (truth, pred, n) over the label list (or the union of
    observed labels). Rows whose labels are not in the list are dropped,
    as with an explicit label list in the usual confusion matrix."""
    counts = confusion_counts(df, truth, pred)
    if labels is not None:
        lab = df.sparkSession.createDataFrame([(x,) for x in labels], ["label"])
    else:
        lab = label_union(df, truth, pred)
    # one cell for each pair of labels: the result itself, whatever its size
    cells = lab.select(F.col("label").alias("truth")).join(
        lab.select(F.col("label").alias("pred")), how="inner", on=F.lit(True))
    return cells.join(counts, ["truth", "pred"], "left") \
                .select("truth", "pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def per_class(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Per label of the union: tp, support, predicted, precision, recall, f1
    (zero where the denominator is zero)."""
    counts = confusion_counts(df, truth, pred).where(
        F.col("truth").isNotNull() | F.col("pred").isNotNull())
    t = counts.groupBy(F.col("truth").alias("label")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0)).alias("tp"))
    p = counts.groupBy(F.col("pred").alias("label")).agg(F.sum("n").alias("predicted"))
    lab = label_union(df, truth, pred)
    j = lab.join(t, "label", "left").join(p, "label", "left").select(
        "label", F.coalesce("tp", F.lit(0)).alias("tp"),
        F.coalesce("support", F.lit(0)).alias("support"),
        F.coalesce("predicted", F.lit(0)).alias("predicted"))
    tp, sup, prd = F.col("tp"), F.col("support"), F.col("predicted")
    return j.select(
        "label", "tp", "support", "predicted",
        F.when(prd > 0, tp / prd).otherwise(F.lit(0.0)).alias("precision"),
        F.when(sup > 0, tp / sup).otherwise(F.lit(0.0)).alias("recall"),
        F.when(sup + prd > 0, 2 * tp / (sup + prd)).otherwise(F.lit(0.0)).alias("f1"))


def macro_prf(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """G4 + G5: one row with accuracy and macro precision, recall, f1."""
    pc = per_class(df, truth, pred).agg(
        F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"))
    acc = accuracy(df, truth, pred)
    return acc.join(pc, how="inner", on=F.lit(True))


def classification_report(df: DataFrame, truth: str, pred: str,
                          names: dict | None = None) -> DataFrame:
    """Per-class rows, then 'accuracy', 'macro avg', 'weighted avg'.

    Columns: label, precision, recall, f1, support. The accuracy row has
    NULL precision and recall, and the accuracy in f1.
    """
    pc = per_class(df, truth, pred)
    label = F.col("label").cast("string")
    if names:
        expr = None
        for k, v in names.items():
            expr = F.when(F.col("label") == k, F.lit(v)) if expr is None else \
                expr.when(F.col("label") == k, F.lit(v))
        label = F.coalesce(expr, label)
    rows = pc.select(label.alias("label"), "precision", "recall", "f1",
                     F.col("support").cast("bigint").alias("support"))
    n = F.sum("support")
    macro = pc.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                   F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                   n.cast("bigint").alias("support"))
    weighted = pc.agg(F.lit("weighted avg").alias("label"),
                      (F.sum(F.col("precision") * F.col("support")) / n).alias("precision"),
                      (F.sum(F.col("recall") * F.col("support")) / n).alias("recall"),
                      (F.sum(F.col("f1") * F.col("support")) / n).alias("f1"),
                      n.cast("bigint").alias("support"))
    acc = df.agg(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"),
                 F.avg(_eq(truth, pred).cast("double")).alias("f1"),
                 F.count("*").cast("bigint").alias("support"))
    return rows.unionByName(acc).unionByName(macro).unionByName(weighted)


def purity(df: DataFrame, truth: str, cluster: str) -> DataFrame:
    """Sum over clusters of the largest true-class count, over n."""
    c = confusion_counts(df, truth, cluster)
    per = c.groupBy("pred").agg(F.max("n").alias("m"), F.sum("n").alias("s"))
    return per.agg((F.sum("m") / F.sum("s")).alias("purity"))


def adjusted_rand_index(df: DataFrame, truth: str, cluster: str) -> DataFrame:
    """Adjusted Rand index from the contingency table; 1.0 when both
    partitions are trivial in the same way (max index == expected)."""
    c = confusion_counts(df, truth, cluster)

    def comb2(x):
        return x * (x - 1) / 2.0

    a = c.groupBy("truth").agg(F.sum("n").alias("a")).agg(F.sum(comb2(F.col("a"))).alias("sa"))
    b = c.groupBy("pred").agg(F.sum("n").alias("b")).agg(F.sum(comb2(F.col("b"))).alias("sb"))
    ij = c.agg(F.sum(comb2(F.col("n"))).alias("sij"), F.sum("n").alias("n"))
    j = ij.join(a, how="inner", on=F.lit(True)).join(b, how="inner", on=F.lit(True))
    expected = F.col("sa") * F.col("sb") / comb2(F.col("n"))
    mx = (F.col("sa") + F.col("sb")) / 2.0
    ari = F.when(mx == expected, F.lit(1.0)).otherwise((F.col("sij") - expected) / (mx - expected))
    return j.select(ari.alias("ari"))


def cluster_to_majority(df: DataFrame, truth: str, cluster: str) -> DataFrame:
    """(cluster, mapped) = the most frequent truth per cluster, ties to
    the lowest truth value. Aggregation, not a window: no cluster is ever
    gathered into one task."""
    c = confusion_counts(df, truth, cluster).where(F.col("truth").isNotNull())
    best = c.groupBy("pred").agg(
        F.min(F.struct((-F.col("n")).alias("neg"), F.col("truth").alias("t"))).alias("b"))
    return best.select(F.col("pred").alias("cluster"), F.col("b.t").alias("mapped"))


def apply_mapping(df: DataFrame, cluster: str, mapping: DataFrame, out: str) -> DataFrame:
    """Join the (cluster, mapped) lookup back onto the rows."""
    m = mapping.select(F.col("cluster").alias(cluster), F.col("mapped").alias(out))
    return df.join(m, cluster, "left")


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def l2_normalise(v):
    """Divide a numeric array by its L2 norm (a zero vector stays zero)."""
    d = F.transform(v, lambda x: x.cast("double"))
    norm = F.sqrt(_dot(d, d))
    return F.when(norm > 0, F.transform(d, lambda x: x / norm)).otherwise(d)


def silhouette_cosine(df: DataFrame, features: str, cluster: str) -> DataFrame:
    """Mean cosine silhouette over all rows.

    The mean cosine distance from a unit vector x to a cluster C is
    1 - x.S_C / |C| with S_C the sum of the cluster's unit vectors, so only
    per-cluster sums are needed, never the n x n distance matrix. The sums are
    a table of one row per cluster, met by a plain join (Spark broadcasts it
    where it measures it small); a row's distances are reduced to the own one
    and the least other one by a partial aggregate. Singletons score 0.
    """
    x = df.select(F.monotonically_increasing_id().alias("_id"), F.col(cluster).alias("_c"),
                  l2_normalise(F.col(features)).alias("_x"))
    long = x.select("_c", F.posexplode("_x").alias("j", "v"))
    sums = long.groupBy("_c", "j").agg(F.sum("v").alias("s"))
    sums = sums.groupBy("_c").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "s"))),
                                              lambda e: e["s"]).alias("_s"))
    centres = sums.join(x.groupBy("_c").agg(F.count("*").alias("n")), "_c") \
        .select(F.col("_c").alias("_k"), "_s", "n")
    each = x.join(centres, how="inner", on=F.lit(True)).select(
        "_id", (F.col("_c") == F.col("_k")).alias("own"), "n", _dot(F.col("_x"), F.col("_s")).alias("d"))
    per = each.groupBy("_id").agg(
        F.max(F.when(F.col("own"), F.col("n"))).alias("n"),
        F.max(F.when(F.col("own"), (F.col("n") - F.col("d")) / F.when(F.col("n") > 1, F.col("n") - 1))).alias("a"),
        F.min(F.when(~F.col("own"), 1.0 - F.col("d") / F.col("n"))).alias("b"))
    a, b = F.col("a"), F.col("b")
    s = (F.when(F.col("n") <= 1, F.lit(0.0)).when(F.greatest(a, b) == 0, F.lit(0.0))
         .otherwise((b - a) / F.greatest(a, b)))
    return per.select(s.alias("s")).agg(F.avg("s").alias("silhouette"))


def encode_sorted(df: DataFrame, col: str, out: str) -> tuple[DataFrame, DataFrame]:
    """id = position of the value among the sorted distinct values.

    Returns (df with ``out``, mapping (value, id)). The distinct values are
    dealt by range; a value's id is the number of values in the ranges before
    its own plus its rank there, so no task orders all of them."""
    vals = df.select(F.col(col).alias("value")).where(F.col("value").isNotNull()).distinct()
    vals = cut_lineage(vals.repartitionByRange("value").select("value", F.spark_partition_id().alias("part")))
    sizes = vals.groupBy("part").agg(F.count("*").alias("n"))      # one row a task
    before = sizes.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("value"))
    mapping = vals.withColumn("r", rank).join(before, "part") \
        .select("value", (F.col("before") + F.col("r") - 1).cast("int").alias("id"))
    out_df = df.join(mapping.select(F.col("value").alias(col), F.col("id").alias(out)), col, "left")
    return out_df, mapping


def decode(df: DataFrame, mapping: DataFrame, col: str, out: str) -> DataFrame:
    """P12 inverse: the value of an id."""
    return df.join(mapping.select(F.col("id").alias(col), F.col("value").alias(out)), col, "left")


def result_row(metrics: DataFrame, model: str) -> DataFrame:
    """One-row result table (model, accuracy, precision, recall, f1)."""
    return metrics.select(F.lit(model).alias("model"), "accuracy", "precision", "recall", "f1")
