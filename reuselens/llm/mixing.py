"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets: the sources, in code-point order with null last, weigh 1, 2, 3, 1, 2,
3, ... and share the words of the whole corpus in proportion; no target
exceeds ``max_epochs`` times its source's words, what is above is shared anew
by weight among the others until none is above.

Documents: a source gives as many complete epochs as its target holds. The
rest is filled from documents in ascending order of ``-ln(u) / weight`` with
``u`` uniform from a hash of the document's id, which draws them without
replacement by weight. A running sum of sizes meets the rest of the budget;
the document in which it ends gives the words that still fit.

The running sum never puts a source into one task: keys are cut into buckets
in key order (about ``BUCKET_ROWS`` documents each, whatever the source's
share of the rows), sums of whole buckets are added up per source, and rows
are ordered within (source, bucket) only. Only DataFrame functions are used.

Defined results: null or empty text has size 0 and gives 0 words; a null
source is a source of its own; rows with equal id have equal keys and are
taken in order of size; null weights count as 1, weights of 0 or less draw
last; a null id draws by a key of its own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reuselens.llm.common import WORD, materialise

MAX_EPOCHS = 3
BUCKET_ROWS = 2000
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from the first 52 bits of an md5."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sized: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, n_docs, mean_weight, target``: one row a source.

    A source is at its cap when its cap is not above its share of what is
    left once all sources with a smaller cap per weight have theirs.  The two
    windows run over one row per source.
    """
    big = "decimal(38,0)"
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"),
                                      F.avg("weight").alias("mean_weight"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("w", ((rank - 1) % 3 + 1).cast("long"))
    all_ = W.partitionBy(F.lit(1))
    order = W.orderBy((F.col("source_size") / F.col("w")), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    cap = (F.col("source_size") * max_epochs).cast("long")
    per = (per.withColumn("cap", cap)
           .withColumn("left", F.sum("source_size").over(all_) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
           .withColumn("w_left", F.sum("w").over(after))
           .withColumn("capped", F.col("cap").cast(big) * F.col("w_left").cast(big)
                       <= F.col("w").cast(big) * F.col("left").cast(big)))
    free = F.when(~F.col("capped"), F.col("w"))
    held = F.when(F.col("capped"), F.col("cap"))
    share = ((F.sum("source_size").over(all_) - F.coalesce(F.sum(held).over(all_), F.lit(0))).cast("double")
             * F.col("w").cast("double") / F.sum(free).over(all_).cast("double"))
    return per.select("source", "source_size", "n_docs", "mean_weight",
                      F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, weights: DataFrame | None = None, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``doc_id, source, size, source_size, target, epochs, draw_key, taken``
    for every row of ``docs`` (``doc_id, text, source``).

    ``weights``: ``doc_id, weight`` of some documents, the largest weight if
    an id occurs twice. Sizes are counted before that join, so no text moves.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    if weights is None:
        sized = sized.withColumn("weight", F.lit(1.0))
    else:
        given = weights.groupBy(F.col("doc_id").alias("w_id")).agg(F.max("weight").cast("double").alias("weight"))
        sized = sized.join(given, F.col("doc_id") == F.col("w_id"), "left").drop("w_id")
    sized = materialise(sized.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(1.0)), F.lit(1e-9))))
    targets = (source_targets(sized, max_epochs)
               .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                           .otherwise(F.lit(0)).cast("long"))
               .withColumn("budget", F.floor("target") - F.col("epochs") * F.col("source_size"))
               .withColumn("buckets", F.ceil(F.col("n_docs") / bucket_rows).cast("long")))
    targets = targets.withColumnRenamed("source", "t_source")
    rows = sized.join(targets, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    rows = rows.withColumn("draw_key", -F.log(uniform(F.col("doc_id"), seed)) / F.col("weight"))
    spread = 1 - F.exp(-F.col("draw_key") * F.col("mean_weight"))
    rows = rows.withColumn("bucket", F.least(F.floor(spread * F.col("buckets")), F.col("buckets") - 1))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    upto = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"),
                       F.coalesce(F.sum("in_bucket").over(upto), F.lit(0)).alias("before_bucket"))
    within = (W.partitionBy("source", "bucket").orderBy("draw_key", "doc_id", "size")
              .rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    room = F.col("budget") - F.col("before_bucket") - F.col("before")
    part = F.greatest(F.lit(0), F.least(F.col("size"), room))
    return rows.select("doc_id", "source", "size", "source_size", "target", "epochs", "draw_key",
                       (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"))
