"""Learned document vectors (T10, F5): words that keep the same company lie
close together.

1. Windowed counts of word pairs over the whole corpus, for the ``VOCABULARY``
   words in most documents (a documented bound of the model: what tasks and
   the driver hold of it is that many words and vectors).
2. Shifted positive pointwise mutual information of the counts.
3. Its truncated SVD by the block iteration of ``clustering``; a word's vector
   is its row of U times the square root of the singular values.
4. A document's vector is the mean of its words' vectors, weighted by smooth
   idf, at unit length; without a known word it is zero.

Counting is per task (numbers of pairs, not texts, are shuffled). A document is
embedded where its row is: ``embed_batched`` reads the fitted model once per
task, as a broadcast of checked size, and goes through Arrow batches;
``embed_joined`` gives the same vectors by joins.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reuselens.functions import text as X
from reuselens.operators.clustering import randomized_svd_reduce
from reuselens.operators.tfidf import slices
from reuselens.session import cut_lineage

VOCABULARY = 20_000
MIN_DF = 5
WINDOW = 4
SHIFT = 2.0
DIM = 50
MODEL_BYTES = 64 << 20       # of a model that is sent to tasks
HELD = 4_000_000             # pairs a task holds before it hands them on

# the workers get this module's functions with the job; they need numpy and pyarrow only
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _words_in(batches):
    """Rows (list of words) -> (word, lists that hold it), for a slice at a time."""
    for batch in slices(batches, 0):
        lists = batch.column(0)
        coded = pc.list_flatten(lists).dictionary_encode()
        n = len(coded.dictionary)
        of = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        held = np.unique(of * n + coded.indices.to_numpy())
        yield pa.record_batch({"word": coded.dictionary, "df": pa.array(np.bincount(held % max(1, n), minlength=n))})


def vocabulary(texts: DataFrame, size: int = VOCABULARY, min_df: int = MIN_DF, clean: str = "clean_text") -> list[tuple[str, int]]:
    """``(word, df)`` of the ``size`` words in most documents, ties by word."""
    words = texts.select(X.tokens(clean).alias("w")).mapInArrow(_words_in, "word string, df long")
    df = words.groupBy("word").agg(F.sum("df").alias("df")).where(F.col("df") >= min_df)
    return [(r["word"], r["df"]) for r in df.orderBy(F.desc("df"), "word").limit(size).collect()]


def _codes(lists, words: pa.Array):
    """Place in the vocabulary (-1: none) and document of each token."""
    at = pc.fill_null(pc.index_in(pc.list_flatten(lists), words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    return at, pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def cooccurrence(texts: DataFrame, words: list[str], window: int = WINDOW, clean: str = "clean_text") -> DataFrame:
    """``a, b, n``: times that the known words a and b stand at most ``window``
    places apart in a document, in either order (a pair of one word counts
    from both ends). Unordered pairs are counted, as numbers; the words and the
    other order follow from the sums."""
    v = len(words)

    def run(batches):
        known = pa.array(words, pa.string())
        held, n = [], 0

        def out():
            key, times = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.record_batch({"pair": pa.array(key), "n": pa.array(times.astype(np.int64))})

        for batch in slices(batches, 0):
            code, of = _codes(batch.column(0), known)
            for d in range(1, window + 1):
                a, b = code[:-d], code[d:]
                own = (a >= 0) & (b >= 0) & (of[:-d] == of[d:])
                a, b = a[own], b[own]
                held.append(np.minimum(a, b) * v + np.maximum(a, b))
                n += len(a)
            if n > HELD:
                yield out()
                n = 0
        if n:
            yield out()

    def both(batches):
        known = pa.array(words, pa.string())
        for batch in batches:
            a, b = np.divmod(batch.column(0).to_numpy(), max(1, v))
            n, two = batch.column(1).to_numpy(), a != b
            take = lambda x: known.take(pa.array(x))
            yield pa.record_batch({"a": take(np.r_[a, b[two]]), "b": take(np.r_[b, a[two]]), "n": pa.array(np.r_[np.where(two, n, 2 * n), n[two]])})

    pairs = texts.select(X.tokens(clean).alias("w")).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return pairs.mapInArrow(both, "a string, b string, n long")


def ppmi(counts: DataFrame, shift: float = SHIFT) -> DataFrame:
    """``a, b, w``: ``ln(n * total / (n_a * n_b)) - ln(shift)`` where over 0."""
    per = counts.groupBy("a").agg(F.sum("n").alias("n_a"))
    total = per.agg(F.sum("n_a")).first()[0] or 0
    rows = counts.join(per, "a").join(per.select(F.col("a").alias("b"), F.col("n_a").alias("n_b")), "b")
    value = F.log(F.col("n") * F.lit(float(total)) / (F.col("n_a").cast("double") * F.col("n_b"))) - F.log(F.lit(float(shift)))
    return rows.select("a", "b", value.alias("w")).where(F.col("w") > 0)


@dataclass
class WordVectors:
    """A fitted model: words, their idf, and a row of ``vectors`` each."""
    words: list[str]
    idf: np.ndarray
    vectors: np.ndarray

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame([(w, float(i), v.tolist()) for w, i, v in zip(self.words, self.idf, self.vectors, strict=True)],
                                     "word string, idf double, vector array<double>")

    def save(self, spark, path: str) -> None:
        self.table(spark).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path: str) -> WordVectors:
        rows = spark.read.parquet(path).orderBy("word").collect()
        return WordVectors([r["word"] for r in rows], np.array([r["idf"] for r in rows]),
                           np.array([r["vector"] for r in rows]).reshape(len(rows), -1))


def fit(texts: DataFrame, size: int = VOCABULARY, min_df: int = MIN_DF, window: int = WINDOW, shift: float = SHIFT,
        dim: int = DIM, clean: str = "clean_text") -> WordVectors:
    known = vocabulary(texts, size, min_df, clean)
    words, n = [w for w, _ in known], texts.count()
    idf = np.log((1.0 + n) / (1.0 + np.array([d for _, d in known], float))) + 1.0
    place = texts.sparkSession.createDataFrame([(w, i) for i, w in enumerate(words)], "a string, doc_id long")
    weights = ppmi(cut_lineage(cooccurrence(texts, words, window, clean)), shift)
    weights = cut_lineage(weights.join(place, "a").select("doc_id", F.col("b").alias("gram"), "w"))
    vectors = np.zeros((len(words), dim))
    if not weights.isEmpty():
        reduced = randomized_svd_reduce(weights, k=dim).collect()          # size x dim numbers
        us = np.array([r["reduced"] for r in reduced])
        vectors[[r["doc_id"] for r in reduced], :us.shape[1]] = us / np.sqrt(np.linalg.norm(us, axis=0))
    return WordVectors(words, idf, vectors)


def embed_batched(texts: DataFrame, model: WordVectors, key: str = "doc_id", clean: str = "clean_text") -> DataFrame:
    """(key, embedding array<double>) by a model call on Arrow batches."""
    if model.vectors.nbytes > MODEL_BYTES:
        raise ValueError(f"the model has {model.vectors.nbytes} bytes; up to {MODEL_BYTES} are sent to tasks")
    dim = model.vectors.shape[1]
    sent = texts.sparkSession.sparkContext.broadcast((model.words, model.idf[:, None] * model.vectors))

    def run(batches):
        words, rows = pa.array(sent.value[0], pa.string()), sent.value[1]
        for batch in batches:
            code, of = _codes(batch.column(1), words)
            own = code >= 0
            code, of, n = code[own], of[own], batch.num_rows
            v = np.stack([np.bincount(of, rows[code, j], minlength=n) for j in range(dim)], axis=1).astype(float)
            norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
            v = np.divide(v, norm, out=v, where=norm > 0)
            flat = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * dim, pa.array(v.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), flat], names=[batch.schema.names[0], "embedding"])

    t = texts.select(key, X.tokens(clean).alias("w"))
    return t.mapInArrow(run, f"`{key}` {t.schema[key].dataType.simpleString()}, embedding array<double>")


def embed_joined(texts: DataFrame, model: WordVectors, key: str = "doc_id", clean: str = "clean_text") -> DataFrame:
    """The same vectors, by a join of the words with the model's table."""
    dim = model.vectors.shape[1]
    rows = texts.select(key, F.explode(X.tokens(clean)).alias("word")).groupBy(key, "word").agg(F.count("*").alias("tf")) \
        .join(model.table(texts.sparkSession), "word")
    sums = rows.groupBy(key).agg(*[F.sum(F.col("tf") * F.col("idf") * F.col("vector")[j]).alias(f"v{j}") for j in range(dim)])
    norm = F.sqrt(sum(F.col(f"v{j}") * F.col(f"v{j}") for j in range(dim)))
    unit = sums.withColumn("norm", norm).select(key, F.array(*[F.when(F.col("norm") > 0, F.col(f"v{j}") / F.col("norm")).otherwise(0.0)
                                                               for j in range(dim)]).alias("embedding"))
    zero = F.array_repeat(F.lit(0.0), dim)
    return texts.select(key).join(unit, key, "left").select(key, F.coalesce("embedding", zero).alias("embedding"))
