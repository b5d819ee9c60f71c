"""Reduced TF-IDF features, KMeans and PCA (M1-M3).

The truncated SVD is a randomised subspace iteration over packed cells: the
weights of a block of documents for a block of grams, one row each, which are put
together once by grams: a gram row has all documents' weights of some grams. For
each gram row and each column of the matrix by document, X transposed times the
column and X times that are formed in one task, and the parts are added up by block
of documents. So an iteration shuffles a few (``PARTS``) copies of the matrix by document and
nothing by gram. A task holds a few columns of the matrix by document and of the
product (``HELD_BYTES``) and one gram row (``ENTRIES``); gram rows and columns are read
from files. Only matrices of (k + oversample) x (k + oversample) numbers, and the
sizes of the blocks, reach the driver. All numbers are 64-bit floats.

Cells (``tfidf.CELL``): ``db, gb`` and a packed blob of entries by gram (``step`` to
the gram's number, ``row`` in the block of documents, ``x``). ``gb`` -1: the block's
document ids, and ``norm``, which its values are divided by; ``db`` -1: the 64-bit
hashes of a block's grams, in the order of their numbers, and maybe a ``factor`` of
each gram's values.
"""

from __future__ import annotations

import sys
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reuselens.operators import packed as P
from reuselens.operators import tfidf as TF
from reuselens.session import cut_lineage, default_parallelism, drop_table, free_shuffles, large_rows

SVD_COMPONENTS = 50
SEED = 42
N_INIT = 10
FITS = 5                    # KMeans fits at once
BLOCK = 20_000              # documents or grams of a block
CELL_WEIGHTS = 1_000_000    # weights of a block of documents or grams, on average
PARTS = 2                   # of the gram rows, each read by one task a group of columns, at least
MOST_PARTS = 8              # and where there are cores for them
ENTRIES = 500_000           # weights of a gram row, about
COLUMNS = 3                 # groups of columns, at least (for few weights: fewer)
COLUMN_WEIGHTS = 2_000_000  # weights from which there is one more
HELD_BYTES = 192 << 20      # of two groups of columns that a task holds

STATE = "db int, n long, who binary, m binary"

# the workers get this module's functions with the job; they need numpy and pyarrow only
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _start(ids: np.ndarray, width: int, seed: int, lo: int, hi: int) -> np.ndarray:
    """Columns ``lo`` to ``hi`` of normal numbers from a hash of each id, so that no order matters."""
    def uniform(column):
        x = ids.astype(np.uint64) + np.uint64(column * 0x9E3779B97F4A7C15 % (1 << 64)) + np.uint64(seed * 0xD1B54A32D192ED03 % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53

    return np.stack([np.sqrt(-2 * np.log1p(-uniform(j))) * np.cos(2 * np.pi * uniform(width + j)) for j in range(lo, hi)])


def _matrix(blob, n: int, width: int) -> np.ndarray:
    return np.frombuffer(blob.as_buffer(), np.float64).reshape(n, width)


def weight_cells(w: DataFrame) -> DataFrame:
    """The cells of long weights ``(doc_id, gram, w)``, written once. A gram is
    known by a 64-bit hash with which its block is drawn."""
    w = w.select("doc_id", F.xxhash64("gram").alias("gid"), F.col("w").cast("double").alias("w"))
    n_docs, n_grams, n_w = w.agg(F.countDistinct("doc_id"), F.countDistinct("gid"), F.count("*")).first()
    nd, ng = (max(1, -(-n // BLOCK), -(-n_w // CELL_WEIGHTS)) for n in (n_docs, n_grams))
    grams = w.select("gid").distinct().withColumn("gb", F.pmod(F.xxhash64(F.lit("block"), "gid"), F.lit(ng)).cast("int"))
    grams = cut_lineage(grams.withColumn("number", F.row_number().over(Window.partitionBy("gb").orderBy("gid")) - 1))
    rows = w.join(grams, "gid").select(F.pmod(F.xxhash64("doc_id"), F.lit(nd)).cast("int").alias("db"), "doc_id", "gb", "number", "w")

    def build(key, t):
        coded = t["doc_id"].combine_chunks().dictionary_encode(null_encoding="encode")
        return TF.pack_cells(key[0].as_py(), coded.dictionary, np.ones(len(coded.dictionary)), coded.indices.to_numpy().astype(np.int64),
                             t["gb"].to_numpy().astype(np.int64), t["number"].to_numpy().astype(np.int64), t["w"].to_numpy())

    def hashes(key, t):
        t = t.sort_by("number")
        return pa.table({"db": pa.array([-1], pa.int32()), "gb": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([t.num_rows], pa.int64()),
                         "blob": pa.array([P.pack(hash=t["gid"].combine_chunks())], pa.binary())})

    return cut_lineage(rows.groupBy("db").applyInArrow(build, TF.CELL).unionByName(grams.groupBy("gb").applyInArrow(hashes, TF.CELL)), packed=True)


def _square(m: DataFrame, make) -> np.ndarray:
    """The sum of a small matrix of each row: one a task, added up in Spark."""
    def run(batches):
        total = None
        for batch in batches:
            for row in range(batch.num_rows):
                a = make({c: batch.column(c)[row] for c in batch.schema.names})
                total = a if total is None else total + a
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    rows = m.mapInArrow(run, "i long, v array<double>").select("i", F.posexplode("v").alias("j", "v")) \
        .groupBy("i", "j").agg(F.sum("v").alias("v")).collect()    # width x width numbers
    out = np.zeros((max(r["i"] for r in rows) + 1,) * 2)
    for r in rows:
        out[r["i"], r["j"]] = r["v"]
    return out


def _whitening(square: np.ndarray) -> np.ndarray:
    """What turns columns with this Gram matrix into orthonormal ones."""
    lam, e = np.linalg.eigh((square + square.T) / 2)
    keep = lam > lam.max() * 1e-13
    return e[:, keep] / np.sqrt(lam[keep])


def _turn(m: DataFrame, by: np.ndarray) -> DataFrame:
    """Each row times a small matrix."""
    width = by.shape[0]

    def run(batches):
        for batch in batches:
            out = [np.ascontiguousarray(_matrix(x, n.as_py(), width) @ by).tobytes() for n, x in zip(batch.column(1), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary())], names=["db", "n", "who", "m"])

    return m.select("db", "n", "who", "m").mapInArrow(run, STATE)


def _norm(who) -> np.ndarray:
    return P.numbers(P.unpack(who), "norm")[:, None]


def gram_rows(cells: DataFrame, sizes: list, parts: int) -> DataFrame:
    """``part, blob``, written once: the entries of all documents for about ``ENTRIES``
    weights of a block of grams, whole grams; ``doc`` is the document's place among
    all (blocks in the order of ``sizes``, their ``(db, documents)``), ``gram`` the place
    in ``hash``, the grams' hashes and the factors of their weights, a blob of their own."""
    base, at = {}, 0
    for db, n in sizes:
        base[db], at = at, at + n

    @P.handing_back
    def merged(key, table):
        start, factor, gram, doc, x = np.zeros(0, np.int64), None, [], [], []
        for db, blob in zip(table["db"].to_pylist(), table["blob"], strict=True):
            entry = P.unpack(blob)
            if db < 0:
                start, factor = P.numbers(entry, "hash"), P.numbers(entry, "factor") if "factor" in entry.schema.names else None
                continue
            gram.append(np.cumsum(P.bytes_joined(entry, "step")))
            doc.append(P.numbers(entry, "row").astype(np.int32) + base[db])
            x.append(P.numbers(entry, "x"))
        out = []
        if gram:
            gram, doc, x = np.concatenate(gram), np.concatenate(doc).astype(np.int32), np.concatenate(x)
            by = np.lexsort((doc, gram))
            gram, doc, x = gram[by], doc[by], x[by]
            first = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
            cut = first[np.r_[True, np.diff(first // ENTRIES) > 0]]
            for lo, hi in zip(cut, np.append(cut, len(gram))[1:], strict=True):
                known, own = np.unique(gram[lo:hi], return_inverse=True)
                by = np.lexsort((own, doc[lo:hi]))            # by document, for the memory's caches
                out.append((P.pack(**P.bytes_apart("step", np.diff(doc[lo:hi][by], prepend=np.int32(0))), gram=P.smallest(own[by]), x=x[lo:hi][by]),
                            P.pack(hash=start[known], factor=np.ones(len(known)) if factor is None else factor[known])))
        return pa.table({"part": pa.array([key[0].as_py() % parts] * len(out), pa.int32()), "blob": pa.array([b for b, _ in out], pa.binary()),
                         "hash": pa.array([h for _, h in out], pa.binary())})

    return cut_lineage(cells.where(F.col("gb") >= 0).groupBy("gb").applyInArrow(lambda key, table: merged(key, table),
                                                                               "part int, blob binary, hash binary"), by="part", packed=True)


class Product:
    """X times X transposed times a matrix by document, and X times the start.

    A task has one part of the gram rows, which it reads one at a time, and one
    group of columns; both come from files, so only products are shuffled."""

    def __init__(self, cells: DataFrame, sizes: list, n_weights: int, width: int):
        n_docs = sum(n for _, n in sizes)
        self.sizes, self.tasks = sizes, max(min(len(sizes), 12), len(sizes) // 8)
        self.groups = min(width, max(1, min(COLUMNS, n_weights // COLUMN_WEIGHTS), -(-16 * n_docs * width // HELD_BYTES)))
        self.parts = 1 if n_weights < COLUMN_WEIGHTS else max(PARTS, min(MOST_PARTS, -(-default_parallelism(cells.sparkSession) // self.groups)))
        self.rows = gram_rows(cells, sizes, self.parts)

    def __call__(self, state: DataFrame, width: int, seed: int | None = None) -> DataFrame:
        """``db, n, who, m, a``, written: the product (with a seed: X times the start)
        and the matrix, transposed, times the product."""
        groups, first, sizes = min(self.groups, width), seed is not None, self.sizes
        cut = [min(width, -(-width * c // (2 * groups)) * 2) for c in range(groups + 1)]
        base, n_docs = {}, 0
        for db, n in sizes:
            base[db], n_docs = (n_docs, n), n_docs + n

        def pairs(x):
            """Two columns each as one of complex numbers, column by column."""
            y = np.zeros((len(x), x.shape[1] + x.shape[1] % 2))
            y[:, :x.shape[1]] = x
            return np.ascontiguousarray(y.view(np.complex128).T)

        def columns(batches):
            for batch in batches:
                for db, n, who, m in zip(*batch.columns, strict=True):
                    x = _matrix(m, n.as_py(), width) / _norm(who)
                    blobs = [pairs(x[:, lo:hi]).tobytes() for lo, hi in zip(cut, cut[1:])]
                    yield pa.RecordBatch.from_arrays([pa.array([db.as_py()] * groups, pa.int32()), pa.array(blobs, pa.binary()),
                                                      pa.array(range(groups), pa.int32())], names=["db", "m", "c"])

        def multiply(c):
            lo, hi = cut[c], cut[c + 1]

            def run(batches):
                half = (hi - lo + 1) // 2
                q, missing, early = np.zeros((0 if first else half, n_docs), np.complex128), 0 if first else len(sizes), []
                out = np.zeros((half, n_docs), np.complex128)

                def add(blob, hashes):
                    entry, grams = P.unpack(blob), P.unpack(hashes)
                    doc, gram = np.cumsum(P.bytes_joined(entry, "step")), P.numbers(entry, "gram").astype(np.int64)
                    x = P.numbers(entry, "x") * P.numbers(grams, "factor")[gram]
                    begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                    docs, of = doc[begin], np.repeat(np.arange(len(begin)), np.diff(begin, append=len(doc)))
                    start = pairs(_start(P.numbers(grams, "hash"), width, seed, lo, hi).T) if first and half else None
                    for j in range(half):
                        if first:
                            z = start[j]
                        else:
                            v = q[j][docs][of]
                            v *= x
                            z = np.zeros(grams.num_rows, np.complex128)
                            np.add.at(z, gram, v)
                        v = z[gram]
                        v *= x
                        sums = np.zeros(len(docs), np.complex128)
                        np.add.at(sums, of, v)
                        out[j][docs] += sums

                for batch in batches:
                    for db, blob, hashes in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                        if db is not None:
                            at, n = base[db]
                            q[:, at:at + n] = np.frombuffer(blob.as_buffer(), np.complex128).reshape(half, n)
                            missing -= 1
                        elif missing:                            # the matrix's files come first; if not, this waits
                            early.append((blob, hashes))
                        else:
                            while early:
                                add(*early.pop())
                            add(blob, hashes)
                while early:
                    add(*early.pop())
                for db, (at, n) in base.items():
                    yield pa.RecordBatch.from_arrays([pa.array([db], pa.int32()), pa.array([c], pa.int32()),
                                                      pa.array([np.ascontiguousarray(out[:, at:at + n].T).tobytes()], pa.binary())], names=["db", "c", "m"])

            return run

        def add(key, parts, state):
            n, who = state["n"][0].as_py(), state["who"][0]
            out = np.zeros((n, width))
            for c, m in zip(parts["c"].to_pylist(), parts["m"], strict=True):
                if cut[c + 1] > cut[c]:
                    out[:, cut[c]:cut[c + 1]] += np.frombuffer(m.as_buffer(), np.float64).reshape(n, -1)[:, :cut[c + 1] - cut[c]]
            out /= _norm(who)
            a = b"" if first else (_matrix(state["m"][0], n, width).T @ out).tobytes()
            return pa.table({"db": state["db"], "n": state["n"], "who": state["who"], "m": pa.array([out.tobytes()], pa.binary()),
                             "a": pa.array([a], pa.binary())})

        state = state.select("db", "n", "who", "m")
        sides = None if first else cut_lineage(state.mapInArrow(columns, "db int, m binary, c int"), by="c", packed=True)
        made = []
        for part in range(self.parts):
            rows = self.rows.where(F.col("part") == part).select(F.lit(None).cast("int").alias("db"), "blob", "hash")
            for c in range(groups):
                own = rows if first else sides.where(F.col("c") == c).select("db", F.col("m").alias("blob"), F.lit(None).cast("binary").alias("hash")) \
                    .unionByName(rows)
                # dealt one by one: a union of single partitions would be one task
                made.append(own.coalesce(1).mapInArrow(multiply(c), "db int, c int, m binary").repartition(self.tasks, "db"))
        out = cut_lineage(reduce(DataFrame.unionByName, made).groupBy("db").cogroup(state.groupBy("db")).applyInArrow(add, STATE + ", a binary"), packed=True)
        if sides is not None:
            drop_table(sides)
        return out


def svd_of_cells(cells: DataFrame, key: str = "doc_id", k: int = SVD_COMPONENTS,
                 oversample: int = 10, n_iter: int = 5, seed: int = SEED, last_use: bool = False) -> DataFrame:
    """M1 over packed cells (a written table, dropped with ``last_use``): ``(key,
    reduced)``, the rows of X V_k of the truncated SVD.

    ``reduced`` has as many numbers as the matrix has rank, k at most."""
    with large_rows(cells.sparkSession):
        return _svd(cells, key, k, oversample, n_iter, seed, last_use)


def _svd(cells: DataFrame, key: str, k: int, oversample: int, n_iter: int, seed: int, last_use: bool) -> DataFrame:
    spark, schema = cells.sparkSession, f"`{key}` long, reduced array<double>"
    docs, grams = F.col("gb") < 0, F.col("db") < 0
    n_docs, n_grams, n_w = cells.agg(*[F.coalesce(F.sum(F.when(x, F.col("n"))), F.lit(0)) for x in (docs, grams, ~docs & ~grams)]).first()
    if not n_w:
        return spark.createDataFrame([], schema)
    width = max(1, min(k + oversample, n_docs, n_grams))
    sizes = [tuple(r) for r in cells.where(docs).select("db", "n").orderBy("db").collect()]      # one a block
    times = Product(cells, sizes, n_w, width)
    state = cells.where(docs).select("db", "n", F.col("blob").alias("who"), F.lit(b"").alias("m"))
    free_shuffles(spark)
    made = times(state, width, seed)
    if last_use:
        drop_table(cells)
    by = _whitening(_square(made, lambda r, w=width: _matrix(r["m"], r["n"].as_py(), w).T @ _matrix(r["m"], r["n"].as_py(), w)))
    for step in range(n_iter + 1):
        old, state, rank = made, _turn(made, by), by.shape[1]    # orthonormal columns
        made = times(state, rank)
        square = _square(made.select("a"), lambda r, w=rank: _matrix(r["a"], w, w))      # of X transposed times them
        if step < n_iter:
            drop_table(old)
            free_shuffles(spark)
            first = _whitening(square)

            def own(r, w=rank, first=first):
                y = _matrix(r["m"], r["n"].as_py(), w) @ first
                return y.T @ y

            by = first @ _whitening(_square(made, own))
    lam, e = np.linalg.eigh((square + square.T) / 2)         # of (Q'X)(Q'X)'
    top = np.argsort(lam)[::-1][:k]
    top = top[lam[top] > lam.max() * 1e-12]
    u = e[:, top] * np.sqrt(lam[top])                        # X V = Q U S

    def out(batches):
        for batch in batches:
            for n, who, m in zip(*batch.columns[1:], strict=True):
                rows = _matrix(m, n.as_py(), rank) @ u
                lists = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * len(top), pa.array(rows.reshape(-1)))
                yield pa.RecordBatch.from_arrays([P.unpack(who).column("id"), lists], names=[key, "reduced"])

    found = cut_lineage(state.mapInArrow(out, schema))
    for table in (old, made, times.rows):
        drop_table(table)
    return found


def randomized_svd_reduce(w: DataFrame, key: str = "doc_id", k: int = SVD_COMPONENTS,
                          oversample: int = 10, n_iter: int = 5, seed: int = SEED) -> DataFrame:
    """M1 over long weights: ``(key, reduced)``, as ``svd_of_cells``."""
    return svd_of_cells(weight_cells(w.withColumnRenamed(key, "doc_id")), key, k, oversample, n_iter, seed, last_use=True)


def kmeans_best_of(df: DataFrame, features: str, k: int, n_init: int = N_INIT,
                   seed: int = SEED, max_iter: int = 300, tol: float = 1e-4):
    """M2: KMeans fitted with n_init seeds; the lowest training cost wins, then
    the first seed (Spark has no n_init). The fits run side by side: each is many
    short jobs that leave most cores idle."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    x = df.withColumn("_f", array_to_vector(F.col(features))).cache()
    x.count()                                                # all fits read the cached rows

    def fit(i):
        m = KMeans(k=k, seed=seed + i, maxIter=max_iter, tol=tol, featuresCol="_f", predictionCol="cluster").fit(x)
        return m.summary.trainingCost, m

    with ThreadPoolExecutor(min(n_init, FITS)) as pool:
        model = min(pool.map(inheritable_thread_target(df.sparkSession)(fit), range(n_init)), key=lambda cost_model: cost_model[0])[1]
    out = cut_lineage(model.transform(x).drop("_f"))
    x.unpersist()
    return model, out.withColumn("cluster", F.col("cluster").cast("int"))


def pca_2d(df: DataFrame, key: str, features: str, k: int = 2) -> DataFrame:
    """M3: centred PCA coordinates (key, pc1, pc2). Spark's PCA does not
    centre on transform, so the mean is removed first. Signs are free."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.sql.types import ArrayType

    f = F.col(features)
    if isinstance(df.schema[features].dataType, ArrayType):
        f = array_to_vector(F.transform(f, lambda v: v.cast("double")))
    x = df.select(key, f.alias("_f"))
    x = StandardScaler(withMean=True, withStd=False, inputCol="_f", outputCol="_c").fit(x).transform(x)
    p = PCA(k=k, inputCol="_c", outputCol="_p").fit(x).transform(x)
    a = vector_to_array("_p")
    return p.select(key, *[a[i].alias(f"pc{i + 1}") for i in range(k)])
