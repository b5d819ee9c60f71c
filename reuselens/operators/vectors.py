"""Document vectors.

The reference encodes each text with a pretrained sentence model. Running a
transformer per row is out of scope (see README); two Spark-native stand-ins
are offered: consume a precomputed vector table (``embeddings``), or
``embed_documents``, a signed hashed bag of words with a fixed dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reuselens.functions import text as X
from reuselens.operators.tfidf import slices

# Embedding width of the hashed bag of words.
EMBED_DIM = 64


def embed_documents(texts: DataFrame, key: str = "doc_id", clean: str = "clean_text",
                    dim: int = EMBED_DIM) -> DataFrame:
    """T10 stand-in: (key, embedding array<double>), L2-normalised.

    Token t adds sign(t) to bucket(t), both taken from its 32-bit md5 hash
    h: bucket = h mod dim, sign = +1 if bit 6 of h is set, else -1. A document's
    tokens are in one row: they are hashed in the JVM and summed up by one
    vectorised count per slice of an Arrow batch, without a shuffle. A document without
    tokens has the zero vector.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in slices(batches):
            lists = batch.column(1)
            h = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            of = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            v = np.bincount(of * dim + h % dim, weights=np.where((h >> 6) & 1 == 1, 1.0, -1.0),
                            minlength=len(lists) * dim).reshape(len(lists), dim)
            norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
            v = np.divide(v, norm, out=v, where=norm > 0)
            flat = pa.ListArray.from_arrays(np.arange(len(lists) + 1, dtype=np.int32) * dim, pa.array(v.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), flat], names=[batch.schema.names[0], "embedding"])

    t = texts.select(key, F.transform(X.tokens(clean), X.hash32).alias("h"))
    kind = t.schema[key].dataType.simpleString()
    return t.mapInArrow(run, f"`{key}` {kind}, embedding array<double>")


def vector_long(df: DataFrame, key: str, col: str = "embedding", decimals: int | None = 6) -> DataFrame:
    """(key, dim, value) rows of an array column."""
    x = df.select(key, F.posexplode(col).alias("dim", "value"))
    if decimals is not None:
        x = x.withColumn("value", F.round("value", decimals))
    return x
