"""TF-IDF weights.

Weights are kept as rows ``(key, gram, df, w)``, for cosine search as one row of
arrays per document, and for the SVD as packed cells; nothing is widened into a
vocabulary-sized vector. Cosine search (J1, J2, W1, W2) is in ``cosine``.

Texts are dealt to chunks of about ``CHUNK_BYTES`` by a hash of the key. A chunk
sends each of its distinct grams once, with the number of rows that hold it, in
one packed row for each bucket of grams; the bucket adds up document frequencies
and answers with those of the grams that stay, in the order in which they came.
The chunk then weighs its rows. So a gram is shuffled once for each chunk that
holds it, not once for each document, and a task holds a chunk or a bucket.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reuselens.functions import text as X
from reuselens.operators import packed as P
from reuselens.session import cut_lineage, drop_table, free_shuffles

# TF-IDF settings of the two configurations.
MIN_DF = 2
MAX_DF_CLUSTERING = 0.8
MAX_DF_SIMILARITY = 0.85

SLICE = 250_000              # list entries that a Python worker works on at once
CHUNK_BYTES = 4 << 20        # of the texts of a chunk, on average
BUCKET_CHUNKS = 2            # a bucket has the grams of so many chunks, on average

ANSWER = "chunk int, bucket int, n long, blob binary"
SLICES = "mark boolean, docs long, n long, blob binary, ids binary, grams binary"
CELL = "db int, gb int, n long, blob binary"

# the workers get this module's functions with the job; they need numpy and pyarrow only
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def slices(batches, column: int = 1, most: int = SLICE):
    """The rows of all batches, ``most`` list entries at a time (or one row)."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        lo = 0
        while lo < len(ends):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def _count_lists(batches):
    """Rows (key, list of strings) -> (key, string, times in this list)."""
    for batch in slices(batches):
        key, lists = batch.column(0), batch.column(1)
        flat = pa.table({"p": pc.list_parent_indices(lists), "g": pc.list_flatten(lists)})
        n = flat.group_by(["p", "g"]).aggregate([([], "count_all")])
        yield from pa.table({batch.schema.names[0]: pa.chunked_array([key]).take(n["p"]), "gram": n["g"],
                             "tf": n["count_all"]}).to_batches()


def term_frequencies(texts: DataFrame, key: str = "doc_id", clean: str = "clean_text") -> DataFrame:
    """(key, gram, tf) with unigrams and bigrams of >=2-char tokens.

    All grams of a document are in one row, so they are counted where the row
    is (one group-by per slice of an Arrow batch); nothing is shuffled."""
    g = texts.select(key, X.word_ngrams(clean).alias("grams"))
    kind = g.schema[key].dataType.simpleString()
    return g.mapInArrow(_count_lists, f"`{key}` {kind}, gram string, tf long")


def document_frequencies(tf: DataFrame, n_docs: int, min_df: int = MIN_DF,
                         max_df: float = MAX_DF_SIMILARITY) -> DataFrame:
    """(gram, df, idf) for grams with min_df <= df <= max_df * n_docs;
    smooth idf = ln((1 + n) / (1 + df)) + 1."""
    d = tf.groupBy("gram").agg(F.count("*").alias("df"))
    d = d.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(float(max_df) * n_docs)))
    return d.withColumn(
        "idf", F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0))


class Grams:
    """The grams of some texts (unigrams and bigrams of >=2-char tokens) and how
    often each has them: entries ``row, at, tf`` with the place of a gram. A gram
    is a number made of its words' places; the order depends on the set of
    texts alone."""

    def __init__(self, texts: pa.Array):
        lists = pc.split_pattern(texts, " ")
        of = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
        words = pc.list_flatten(lists)
        long = pc.greater_equal(pc.utf8_length(words), 2)
        words, of = words.filter(long), of[long.to_numpy(zero_copy_only=False)].astype(np.int64)
        coded = words.dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy().astype(np.int64)
        self.words, self.width = coded.dictionary.take(pa.array(order)), len(order) + 1
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        code = place[coded.indices.to_numpy()]
        same = of[:-1] == of[1:]
        pairs = (code[:-1] * self.width + code[1:] + 1)[same]
        self.grams, at = np.unique(np.concatenate([code * self.width, pairs]), return_inverse=True)
        n = max(1, len(self.grams))
        entry, self.tf = np.unique(np.concatenate([of, of[:-1][same]]) * n + at, return_counts=True)
        self.row, self.at = np.divmod(entry, n)

    def strings(self) -> pa.Array:
        first, second = np.divmod(self.grams, self.width)
        after = pa.array(np.maximum(second - 1, 0), mask=second == 0)
        return pc.binary_join_element_wise(self.words.take(pa.array(first)), self.words.take(after), " ", null_handling="skip")

    def buckets(self, n: int) -> np.ndarray:
        """A number below ``n`` by hash of the gram's words."""
        if not len(self.grams):
            return np.zeros(0, np.int64)
        h = np.fromiter((zlib.crc32(w) for w in self.words.cast(pa.binary()).to_pylist()), np.uint64, len(self.words))
        first, second = np.divmod(self.grams, self.width)
        after = np.where(second > 0, h[second - 1] + np.uint64(1), np.uint64(0))
        x = h[first] * np.uint64(0x9E3779B97F4A7C15) + after * np.uint64(0xD1B54A32D192ED03)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((x >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def _send(n: int):
    def run(key, table):
        g = Grams(table["text"].combine_chunks())
        bucket, strings, rows = g.buckets(n), g.strings(), np.bincount(g.at, minlength=len(g.grams)).astype(np.int32)
        by = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[by], np.arange(n + 1))
        some = np.flatnonzero(np.diff(cut))
        own = [by[cut[b]:cut[b + 1]] for b in some]
        return pa.table({"chunk": pa.array([key[0].as_py()] * len(some), pa.int32()), "bucket": pa.array(some, pa.int32()),
                         "blob": pa.array([P.pack(gram=strings.take(pa.array(x)), rows=rows[x]) for x in own], pa.binary())})

    return run


def idf(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.log((1.0 + n_docs) / (1.0 + df)) + 1.0


def _meet(least: int, most: float, n_docs: int, hashes: bool):
    """Document frequencies (0: not kept) and numbers in the bucket, to each
    chunk in the order it sent its grams; with ``hashes`` also a row of chunk -1,
    the hashes and idf of the kept grams in the order of their numbers."""
    def run(key, table):
        table = table.sort_by("chunk")
        parts = [P.unpack(x) for x in table["blob"]]
        coded = pa.concat_arrays([x.column("gram") for x in parts]).dictionary_encode()
        at = coded.indices.to_numpy()
        df = np.bincount(at, np.concatenate([P.numbers(x, "rows") for x in parts]), minlength=len(coded.dictionary)).astype(np.int64)
        kept = (df >= least) & (df <= most)
        # numbers in the order of the strings, in which a chunk sends its grams: their steps are small
        order = pc.sort_indices(coded.dictionary).to_numpy().astype(np.int64)
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(kept[order])        # of the last kept so far, from 1 on
        df = np.where(kept, df, 0)
        ends = np.cumsum([0] + [x.num_rows for x in parts])
        chunk, n, blob = table["chunk"].to_pylist(), [0] * len(parts), []
        for lo, hi in zip(ends[:-1], ends[1:], strict=True):
            own = at[lo:hi]
            blob.append(P.pack(**P.bytes_apart("df", df[own]), **P.bytes_apart("step", np.diff(number[own], prepend=0))))
        if hashes:
            chunk, n = [*chunk, -1], [*n, int(kept.sum())]
            order = order[kept[order]]
            blob.append(P.pack(hash=P.xxhash64(coded.dictionary.take(pa.array(order))), factor=idf(df[order], n_docs)))
        return pa.table({"chunk": pa.array(chunk, pa.int32()), "bucket": pa.array([key[0].as_py()] * len(n), pa.int32()),
                         "n": pa.array(n, pa.int64()), "blob": pa.array(blob, pa.binary())})

    return run


class Weighed:
    """The kept entries of a chunk: ``row, at, doc`` (place of the key among the
    chunk's ``keys``), ``tf``, ``x`` = tf * idf, and the norm of each key's entries."""

    def __init__(self, texts: pa.Table, answers: pa.Table, n_buckets: int, n_docs: int):
        self.g = g = Grams(texts["text"].combine_chunks())
        self.df, self.number = np.zeros(len(g.grams), np.int64), np.zeros(len(g.grams), np.int64)
        self.bucket = g.buckets(n_buckets)
        if len(g.grams):
            by = np.argsort(self.bucket, kind="stable")
            parts = [P.unpack(x) for x in answers.sort_by("bucket")["blob"]]
            self.df[by] = np.concatenate([P.bytes_joined(x, "df") for x in parts])
            self.number[by] = np.concatenate([np.cumsum(P.bytes_joined(x, "step")) for x in parts]) - 1
        kept = self.df[g.at] > 0
        self.row, self.at = g.row[kept], g.at[kept]
        self.tf = g.tf[kept]
        self.x = self.tf * idf(self.df, n_docs)[self.at]
        coded = texts["key"].combine_chunks().dictionary_encode(null_encoding="encode")
        self.keys, self.doc = coded.dictionary, coded.indices.to_numpy()[self.row].astype(np.int64)
        self.norm = np.sqrt(np.bincount(self.doc, self.x * self.x, minlength=len(self.keys)))


def _grouped(run):
    """As a function of two arguments, which Spark tells by the signature."""
    run = P.handing_back(run)
    return lambda key, table: run(key, table)


def _weighed(texts: DataFrame, key: str, clean: str, min_df: int, max_df: float, n_docs: int | None, make, schema: str,
             hashes: bool = False, mark=None) -> tuple[DataFrame, DataFrame]:
    """``make(Weighed, key of the group, texts, answers)`` of each chunk; chunk -1
    has answers alone. With it the table of the answers, which is written first, so
    that what was sent for them needs no disk any more."""
    length = F.octet_length("raw_text" if "raw_text" in texts.columns else clean)
    rows, size = texts.agg(F.count("*"), F.coalesce(F.sum(length), F.lit(0))).first()
    n_docs = rows if n_docs is None else n_docs
    n = max(1, -(-size // CHUNK_BYTES))
    n_buckets = max(min(n, 8), n // BUCKET_CHUNKS)
    # as many tasks as chunks or buckets, not merged: the work isn't told by the packed bytes
    chunks = texts.select(F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias("chunk"), F.col(key).alias("key"),
                          F.col(clean).alias("text"), *([] if mark is None else [F.coalesce(mark, F.lit(False)).alias("mark")])).repartition(n, "chunk")
    sent = chunks.groupBy("chunk").applyInArrow(_grouped(_send(n_buckets)), "chunk int, bucket int, blob binary")
    answers = cut_lineage(sent.repartition(n_buckets, "bucket").groupBy("bucket").applyInArrow(
        _grouped(_meet(min_df, float(max_df) * n_docs, n_docs, hashes)), ANSWER), packed=True)
    free_shuffles(texts.sparkSession)

    def run(key, left, right):
        return weigh(key, left, right)

    @P.handing_back
    def weigh(key, left, right):
        return make(Weighed(left, right, n_buckets, n_docs) if left.num_rows else None, key[0].as_py(), left, right)

    return chunks.groupBy("chunk").cogroup(answers.repartition(n, "chunk").groupBy("chunk")).applyInArrow(run, schema), answers


def _written(made: tuple[DataFrame, DataFrame]) -> DataFrame:
    """As a table, without the answers it was made with."""
    table = cut_lineage(made[0], packed=True)
    drop_table(made[1])
    free_shuffles(table.sparkSession)
    return table


def _kind(texts: DataFrame, key: str) -> str:
    return texts.schema[key].dataType.simpleString()


def tfidf(texts: DataFrame, key: str = "doc_id", clean: str = "clean_text",
          min_df: int = MIN_DF, max_df: float = MAX_DF_SIMILARITY,
          n_docs: int | None = None) -> DataFrame:
    """(key, gram, df, w): tf * idf, L2-normalised per document.
    Documents whose grams are all pruned have no rows (zero vector)."""
    def make(e, chunk, left, right):
        return pa.table({key: left["key"].take(pa.array(e.row)), "gram": e.g.strings().take(pa.array(e.at)), "df": e.df[e.at],
                         "w": e.x / e.norm[e.doc]})

    return _weighed(texts, key, clean, min_df, max_df, n_docs, make, f"`{key}` {_kind(texts, key)}, gram string, df long, w double")[0]


def tfidf_vectors(texts: DataFrame, key: str = "doc_id", clean: str = "clean_text",
                  min_df: int = MIN_DF, max_df: float = MAX_DF_SIMILARITY,
                  n_docs: int | None = None) -> DataFrame:
    """T9 as one row a document: (key, g, w), gram numbers and unit weights.
    A gram's number is that of its bucket and its number there."""
    def make(e, chunk, left, right):
        by = np.argsort(e.doc, kind="stable")
        sizes = np.bincount(e.doc, minlength=len(e.keys))
        at = pa.array(np.r_[0, np.cumsum(sizes[sizes > 0])].astype(np.int32))
        gram = (e.bucket[e.at] << 32) | e.number[e.at]
        return pa.table({key: e.keys.filter(pa.array(sizes > 0)), "g": pa.ListArray.from_arrays(at, pa.array(gram[by])),
                         "w": pa.ListArray.from_arrays(at, pa.array((e.x / e.norm[e.doc])[by]))})

    return _weighed(texts, key, clean, min_df, max_df, n_docs, make,
                    f"`{key}` {_kind(texts, key)}, g array<bigint>, w array<double>")[0]


def tfidf_slices(texts: DataFrame, mark, key: str = "doc_id", clean: str = "clean_text",
                 min_df: int = MIN_DF, max_df: float = MAX_DF_SIMILARITY, n_docs: int | None = None) -> DataFrame:
    """T9 as packed slices of about ``SLICE`` weights, a written table: ``mark, docs,
    n, blob``. All documents are in rows without ``mark``, those for which it is true
    are in rows with it besides. Null keys have no vector."""
    def make(e, chunk, left, right):
        known = e.keys.is_valid().to_numpy(zero_copy_only=False)
        marked = np.zeros(len(e.keys), bool)
        coded = left["key"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        marked[coded[left["mark"].to_numpy()]] = True
        ids = e.keys.fill_null(0).cast(pa.int64()).to_numpy()
        gram = (e.bucket[e.at] << 32) | e.number[e.at]
        by = np.lexsort((gram, e.doc))
        by = by[known[e.doc[by]]]
        doc, gram, tf, factor = e.doc[by], gram[by], e.tf[by], (e.x / e.tf)[by]
        first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])]) if len(doc) else np.zeros(0, np.int64)
        doc, gram, factor, tf = doc[first], gram[first], factor[first], np.add.reduceat(tf, first) if len(first) else tf
        rows = []
        for side in (False, True):
            own = marked[doc] if side else np.ones(len(doc), bool)
            d, g, t, f = doc[own], gram[own], tf[own], factor[own]
            begin = np.flatnonzero(np.r_[True, d[1:] != d[:-1]]) if len(d) else np.zeros(0, np.int64)
            cut = begin[np.r_[True, np.diff(begin // SLICE) > 0]] if len(begin) else begin
            for lo, hi in zip(cut, np.append(cut, len(d))[1:], strict=True):
                rows.append((side, *pack_slice(ids, e.norm, d[lo:hi], g[lo:hi], t[lo:hi], f[lo:hi])))
        return pa.table({"mark": pa.array([r[0] for r in rows], pa.bool_()), "docs": pa.array([r[1] for r in rows], pa.int64()),
                         "n": pa.array([r[2] for r in rows], pa.int64()), "blob": pa.array([r[3] for r in rows], pa.binary()),
                         "ids": pa.array([r[4] for r in rows], pa.binary()), "grams": pa.array([r[5] for r in rows], pa.binary())})

    return _written(_weighed(texts, key, clean, min_df, max_df, n_docs, make, SLICES, mark=mark))


def pack_slice(ids, norm, doc, gram, tf, factor) -> tuple:
    """Numbers of documents and entries, and blobs of the entries by gram, the
    documents, and the grams."""
    used, doc = np.unique(doc, return_inverse=True)
    by = np.lexsort((doc, gram))
    grams, first, at = np.unique(gram[by], return_index=True, return_inverse=True)
    high, low = grams >> 32, grams & 0xFFFFFFFF
    return (len(used), len(gram), P.pack(step=np.diff(at, prepend=0).astype(np.uint8), row=P.smallest(doc[by]), tf=P.smallest(tf[by])),
            P.pack(id=ids[used], norm=norm[used]),
            P.pack(high=P.smallest(np.diff(high, prepend=0)), **P.bytes_apart("low", np.diff(low, prepend=0)), factor=factor[by][first]))


def unpack_slice(blob, ids, grams) -> tuple:
    """``(ids, grams, weights, row)`` of a slice, entries by gram and row."""
    entry, docs, grams = P.unpack(blob), P.unpack(ids), P.unpack(grams)
    gram = (np.cumsum(P.numbers(grams, "high"), dtype=np.int64) << 32) | np.cumsum(P.bytes_joined(grams, "low"))
    at, row = np.cumsum(P.numbers(entry, "step"), dtype=np.int64), P.numbers(entry, "row").astype(np.int64)
    x = P.numbers(entry, "tf") * P.numbers(grams, "factor")[at]
    return P.numbers(docs, "id"), gram[at], x / P.numbers(docs, "norm")[row], row


def pack_cells(db: int, ids: pa.Array, norm: np.ndarray, doc: np.ndarray, gb: np.ndarray, number: np.ndarray, x: np.ndarray) -> pa.Table:
    """The cells (``clustering``) of a block of documents from its entries: the
    place of the document, the gram's block and number, and a value (without the
    factor that the row of the gram's hash may have)."""
    used, doc = np.unique(doc, return_inverse=True)
    ids = ids.take(pa.array(used)).cast(pa.int64()).fill_null(np.iinfo(np.int64).min)
    rows = [(-1, len(used), P.pack(id=ids, norm=norm[used]))]
    grams, at = np.unique((gb << 32) | number, return_inverse=True)
    by = np.argsort(at * max(1, len(used)) + doc, kind="stable")
    gram, doc, x = grams[at[by]], P.smallest(doc[by]), x[by]
    blocks, begin = np.unique(gram >> 32, return_index=True)
    for b, lo, hi in zip(blocks, begin, np.append(begin, len(gram))[1:], strict=True):
        step = np.diff(gram[lo:hi] & 0xFFFFFFFF, prepend=0)
        rows.append((int(b), int(hi - lo), P.pack(**P.bytes_apart("step", step), row=doc[lo:hi], x=x[lo:hi])))
    rows = rows if len(used) else []
    return pa.table({"db": pa.array([db] * len(rows), pa.int32()), "gb": pa.array([r[0] for r in rows], pa.int32()),
                     "n": pa.array([r[1] for r in rows], pa.int64()), "blob": pa.array([r[2] for r in rows], pa.binary())})


def tfidf_cells(texts: DataFrame, key: str = "doc_id", clean: str = "clean_text",
                min_df: int = MIN_DF, max_df: float = MAX_DF_SIMILARITY,
                n_docs: int | None = None) -> DataFrame:
    """T9 as the packed cells that ``clustering.svd_of_cells`` takes, a written table."""
    def make(e, chunk, left, right):
        if e is None:
            return pa.table({"db": right["chunk"], "gb": right["bucket"], "n": right["n"], "blob": right["blob"]})
        return pack_cells(chunk, e.keys, e.norm, e.doc, e.bucket[e.at], e.number[e.at], P.smallest(e.tf))

    return _written(_weighed(texts, key, clean, min_df, max_df, n_docs, make, CELL, hashes=True))
