"""The suffix tree of a corpus whose strings are too many for one task.

Method and results are those of ``suffix_tree``; no string that occurs
``least`` times is left out and nothing of the model is sent to all tasks.

Texts are read once, in chunks of ``CHUNK`` symbols. A chunk deals its distinct
words to buckets by hash, with how often its training texts hold them; buckets
add them up and answer with a number for each that is frequent enough. A string
of two words or more is the pair of the numbers of its first and its last part,
dealt to buckets and answered in the same way, so a length is asked for only
where both parts are frequent. Totals, parents and states come from joins and a
window over the strings (a context's window holds its distinct next words).
Last, buckets answer the same rows with what they know of their strings, and a
chunk puts the answers to its texts.

A task holds one chunk, or of one bucket (``BUCKET`` symbols of the corpus) its
rows and states. Words and pairs are told apart by 64-bit hashes.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reuselens.llm import kernels as K
from reuselens.llm.common import materialise
from reuselens.llm.packed import BUCKET_KEYS, pack, unpack
from reuselens.session import drop_table, free_shuffles

CHUNK = 1 << 21             # symbols of a chunk, or one text
BUCKET = 1 << 21            # symbols of the corpus a bucket

ASKED = "chunk long, bucket int, blob binary"
TOLD = "chunk long, part int, bucket int, blob binary"


class Strings:
    """The distinct strings of a chunk, length by length: ``columns`` (of words
    their hashes, of longer ones the numbers of their parts) and ``rank``,
    the string that ends at each symbol or -1."""

    def __init__(self, words: np.ndarray, codes: np.ndarray, sizes: np.ndarray, buckets: int):
        self.at = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.columns, self.rank, self.buckets = [words], codes, buckets

    def longer(self, numbers: np.ndarray) -> None:
        """On to the next length; ``numbers`` of the present strings, -1: rare."""
        size, known = len(numbers), np.append(numbers >= 0, False)[self.rank]
        own = np.flatnonzero((self.at[1:] > 0) & known[1:] & known[:-1]) + 1
        pairs, place = np.unique(self.rank[own - 1] * size + self.rank[own], return_inverse=True)
        self.rank = np.full(len(self.rank), -1)
        self.rank[own] = place
        self.columns = [numbers[x].astype(np.uint64) for x in (pairs // max(size, 1), pairs % max(size, 1))]

    def dealt(self) -> tuple[np.ndarray, np.ndarray]:
        """The strings in the order of their buckets, and where each begins."""
        bucket = (K.mix(K.chain(*self.columns)) >> np.uint64(20)) % np.uint64(self.buckets)
        order = np.lexsort((self.columns[0], bucket))
        return order, np.searchsorted(bucket[order], np.arange(self.buckets + 1, dtype=np.uint64))

    def counts(self, learnt: np.ndarray) -> np.ndarray:
        return np.bincount(self.rank[learnt & (self.rank >= 0)], minlength=len(self.columns[0]))

    def rows(self, learnt: np.ndarray):
        """``(bucket, packed strings and counts)``."""
        (order, begin), counts = self.dealt(), self.counts(learnt)
        for b in np.flatnonzero(np.diff(begin)):
            own = order[begin[b]:begin[b + 1]]
            yield int(b), pack([*[c[own] for c in self.columns], counts[own]])

    def told(self, blobs: list[bytes], n: int) -> list[np.ndarray]:
        """The answers, ``n`` columns, in the order of the strings."""
        order, _ = self.dealt()
        out = []
        for i in range(n):
            x = np.empty(len(order))
            if len(order):
                x[order] = np.concatenate([unpack(b, n + 1)[i + 1] for b in blobs]).view(np.float64)
            out.append(x)
        return out


def _chunk(own: pa.Table, told: pa.Table, buckets: int):
    """A chunk as it was cut: ``(strings, sizes, learnt symbols, blobs by part)``."""
    sizes = np.array(own["sizes"][0].as_py(), np.int64)
    strings = Strings(unpack(own["words"][0].as_py(), 1)[0], unpack(own["codes"][0].as_py(), 2)[1].astype(np.int64), sizes, buckets)
    learnt = np.repeat(~np.array(own["held"][0].as_py(), bool), sizes)
    told = told.sort_by([("part", "ascending"), ("bucket", "ascending")])
    parts = told["part"].to_numpy()

    def blobs(part):
        return [x.as_py() for x in told["blob"].slice(int(np.searchsorted(parts, part)), int((parts == part).sum()))]

    return strings, sizes, learnt, blobs


def _asked(chunk: list, rows: list) -> pa.Table:
    return pa.table({"chunk": pa.array(chunk * len(rows), pa.int64()), "bucket": pa.array([r[0] for r in rows], pa.int32()),
                     "blob": pa.array([r[1] for r in rows], pa.binary())})


def chunks(docs: DataFrame, train: Column, symbols, buckets: int) -> DataFrame:
    """A row for each chunk (``bucket`` null: its texts, words and symbols) and
    for each chunk and bucket (``blob``: its words)."""
    schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("blob", pa.binary()), ("ids", pa.list_(pa.int64())),
                        ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("words", pa.binary()), ("codes", pa.binary())])

    def rows(chunk, ids, held, sizes, syms):
        ids, held, sizes = pa.concat_arrays(ids), pa.concat_arrays(held), np.concatenate(sizes)
        words, codes, times = np.unique(np.concatenate(syms), return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")                # frequent words first: small numbers
        words, codes = words[order], np.argsort(order)[codes]
        learnt = np.repeat(~held.to_numpy(zero_copy_only=False), sizes)
        made = [{"chunk": chunk, "ids": ids.to_pylist(), "held": held.to_pylist(), "sizes": sizes.tolist(),
                 "words": pack([words]), "codes": pack([np.zeros(len(codes)), codes])}]
        made += [{"chunk": chunk, "bucket": b, "blob": blob} for b, blob in Strings(words, codes, sizes, buckets).rows(learnt)]
        return pa.RecordBatch.from_pylist(made, schema=schema)

    def run(batches):
        chunk, kept, n = TaskContext.get().partitionId() << 32, ([], [], [], []), 0
        for batch in batches:
            for at, data, off in K.utf8_pieces(batch.column(2)):
                syms, bounds = symbols(data, off)
                texts = slice(at, at + len(off) - 1)
                for column, value in zip(kept, (batch.column(0)[texts], batch.column(1)[texts], np.diff(bounds), syms), strict=True):
                    column.append(value)
                n += len(syms)
                if n >= CHUNK:
                    yield rows(chunk, *kept)
                    chunk, kept, n = chunk + 1, ([], [], [], []), 0
        if kept[0]:
            yield rows(chunk, *kept)
        K.release_memory()

    return materialise(docs.select(F.col("doc_id").cast("long"), (~train).alias("held"), F.col("text").cast("string")).mapInArrow(
        run, "chunk long, bucket int, blob binary, ids array<long>, held array<boolean>, sizes array<long>, words binary, codes binary"))


def _add_up(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Equal strings once, in the order of their hash, their counts (the last
    column) added up."""
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
    key = K.chain(*columns[:-1])
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    return [c[order][first] for c in columns[:-1]] + [np.add.reduceat(columns[-1][order], first) if len(first) else columns[-1]]


def counted(asked: DataFrame, names: list[str], least: int, keep: int, buckets: int) -> DataFrame:
    """``bucket, *names, n, id``: the strings that training texts hold ``keep``
    times; their number, if they hold them ``least`` times (else -1)."""
    def merge(key, table):
        total, held, n = [np.zeros(0, np.uint64)] * (len(names) + 1), [], 0
        for blob in table["blob"]:
            columns = unpack(blob.as_py(), len(names) + 1)
            own = columns[-1] > 0
            held.append([c[own] for c in columns])
            n += int(own.sum())
            if n > 2 * len(total[0]) + BUCKET_KEYS:
                total, held, n = _add_up([total, *held]), [], 0
        total = _add_up([total, *held])
        own = total[-1] >= keep
        total = [c[own].view(np.int64) for c in total]
        often, bucket = total[-1] >= least, key[0].as_py()
        number = np.where(often, bucket + buckets * (np.cumsum(often) - 1), -1)
        K.release_memory()
        return pa.table({"bucket": pa.array(np.full(len(number), bucket, np.int32)),
                         **dict(zip([*names, "n"], total, strict=True)), "id": number})

    return asked.groupBy("bucket").applyInArrow(merge, "bucket int, " + ", ".join(f"{c} long" for c in [*names, "n", "id"]))


def weighed(strings: DataFrame, shorter: DataFrame, discount: float) -> DataFrame:
    """The strings (``rest, last, n, id``) with ``lp``, the log probability of the last word after the
    rest, ``root``, that of the word alone, and ``left``, the log of the mass left
    to the parent where the rest is a state (else null).

    ``shorter``: the strings one word shorter, with ``id, n, lp, root``."""
    x = strings.drop("bucket").join(shorter.select(F.col("id").alias("last"), F.col("lp").alias("parent"), "root"), "last") \
        .join(shorter.select(F.col("id").alias("rest"), F.col("n").cast("double").alias("total")), "rest")
    by = Window.partitionBy("rest")
    x = x.withColumn("kinds", F.count("*").over(by).cast("double")).withColumn("seen", F.sum("n").over(by).cast("double"))
    x = x.withColumn("mass", F.greatest(1 - (F.col("seen") - discount * F.col("kinds")) / F.col("total"), F.lit(1e-12)))
    x = x.withColumn("p", F.log((F.col("n") - discount) / F.col("total") + F.col("mass") * F.exp("parent")))
    gain = F.sum(F.col("n") * (F.col("p") - F.col("parent"))).over(by) + (F.col("total") - F.col("seen")) * F.log("mass")
    x = x.withColumn("keep", 2 * gain > F.col("kinds") + 3.1 * F.sqrt(2 * F.col("kinds")) + 4)
    return x.select("rest", "last", "n", "id", F.when(F.col("keep"), F.col("p")).otherwise(F.col("parent")).alias("lp"), "root",
                    F.when(F.col("keep"), F.log("mass")).alias("left"))


def answers(asked: DataFrame, model: DataFrame, names: list[str], values: list[str], part: int) -> DataFrame:
    """``chunk, part, bucket, blob``: ``values`` of the strings of each row, nan
    where ``model`` (``bucket, *names, *values``) has none."""
    def answer(key, asked, model):
        known = K.chain(*[model[c].to_numpy().view(np.uint64) for c in names])
        order = np.argsort(known)
        known = known[order]
        found = [np.append(model[c].to_numpy().astype(np.float64)[order], np.nan) for c in values]
        out = []
        for blob in asked["blob"]:
            keys = K.chain(*unpack(blob.as_py(), len(names) + 1)[:-1])
            at = np.full(len(keys), -1)
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                at[known[at] != keys] = -1
            out.append(pack([np.zeros(len(keys)), *[x[at].view(np.uint64) for x in found]]))
        K.release_memory()
        return pa.table({"chunk": asked["chunk"], "part": pa.array([part] * len(out), pa.int32()), "bucket": asked["bucket"],
                         "blob": pa.array(out, pa.binary())})

    return materialise(asked.groupBy("bucket").cogroup(model.select("bucket", *names, *values).groupBy("bucket")).applyInArrow(answer, TOLD))


def score_texts(docs: DataFrame, train: Column, symbols, n_symbols: int, max_depth: int, least: int, discount: float) -> DataFrame:
    """As ``suffix_tree.score_texts``; ``symbols`` cuts a piece of texts into
    hashes, ``n_symbols`` is about how many there are."""
    longest, spark = max_depth + 1, docs.sparkSession
    buckets = max(16, -(-n_symbols // BUCKET))
    made = chunks(docs, train, symbols, buckets)
    own = made.where(F.col("bucket").isNull()).select("chunk", "ids", "held", "sizes", "words", "codes")
    asked, names = made.where(F.col("bucket").isNotNull()).select("chunk", "bucket", "blob"), ["last"]
    words = materialise(counted(asked, names, least, 1, buckets))
    n_train, n_words = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    z = float(n_train + n_words + 1)
    level = words.withColumn("lp", F.log(F.col("n") + 1.0) - F.log(F.lit(z))).withColumn("root", F.col("lp"))
    value, numbers, parts = F.col("n").cast("double"), [], []

    def longer(steps):
        def run(key, own, told):
            strings, _, learnt, blobs = _chunk(own, told, buckets)
            for length in range(1, steps + 1):
                strings.longer(np.nan_to_num(strings.told(blobs(-length), 1)[0], nan=-1).astype(np.int64))
            made = list(strings.rows(learnt))
            K.release_memory()
            return _asked([key[0].as_py()], made)

        return run

    for length in range(1, longest + 1):
        model = level.withColumn("value", value)
        if length < longest:
            numbers.append(answers(asked, model.where(F.col("id") >= 0), names, ["id"], -length))
            more = materialise(own.groupBy("chunk").cogroup(reduce(DataFrame.unionByName, numbers).groupBy("chunk"))
                               .applyInArrow(longer(length), ASKED))
            free_shuffles(spark)
            strings = materialise(counted(more, ["rest", "last"], least, least, buckets))
            free_shuffles(spark)
            following = weighed(strings, level.where(F.col("id") >= 0), discount)
            if length + 1 == longest:                            # nobody's parents or totals
                following = following.where(F.col("left").isNotNull()).select("rest", "last", "id", "lp", "root", "left")
            following = materialise(following)
            free_shuffles(spark)
            drop_table(strings)
            state = following.where(F.col("left").isNotNull()).groupBy(F.col("rest").alias("id")).agg(F.first("left").alias("after"))
            model = model.join(state, "id", "left")
        else:
            model = model.withColumn("after", F.lit(None).cast("double"))
        model = model.where(F.col("value").isNotNull() | F.col("after").isNotNull())
        parts.append(answers(asked, model, names, ["value", "after"], length))
        free_shuffles(spark)
        drop_table(level)
        if length > 1:
            drop_table(asked)
        if length < longest:
            asked, names = more, ["rest", "last"]
            level = following.withColumn("bucket", F.pmod("id", F.lit(buckets)).cast("int"))
            value = F.when(F.col("left").isNotNull(), F.col("lp") - F.col("root"))

    def put(key, own, told):
        strings, sizes, _, blobs = _chunk(own, told, buckets)
        gain, times, left = np.zeros(len(strings.at)), None, None
        for length in range(1, longest + 1):
            value, after = (np.append(x, np.nan)[strings.rank] for x in strings.told(blobs(length), 2))
            if length == 1:
                times = np.nan_to_num(value)
            else:
                state = ~np.isnan(left)
                gain[state] += left[state]
                hit = ~np.isnan(value)
                gain[hit] = value[hit]
            left = np.append(np.nan, after[:-1])                 # of the string that ends before the symbol
            left[strings.at == 0] = np.nan
            if length < longest:
                strings.longer(np.nan_to_num(strings.told(blobs(-length), 1)[0], nan=-1).astype(np.int64))
        text = np.repeat(np.arange(len(sizes)), sizes)

        def total(x):
            return np.bincount(text, weights=x, minlength=len(sizes))

        K.release_memory()
        base = total(np.log10(times + 1)) - sizes * np.log10(z)
        return pa.table({"doc_id": own["ids"].combine_chunks().flatten(), "held_out": own["held"].combine_chunks().flatten(),
                         "n_tokens": sizes, "n_known": total(times > 0).astype(np.int64),
                         "train_tokens": pa.array([n_train] * len(sizes), pa.int64()), "base_score": base,
                         "score": base + total(gain) / np.log(10), "n_in_state": total(gain != 0).astype(np.int64)})

    return own.groupBy("chunk").cogroup(reduce(DataFrame.unionByName, [*numbers, *parts]).groupBy("chunk")).applyInArrow(
        put, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_in_state long")
