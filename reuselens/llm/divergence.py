"""How the sources of a language differ in their words, over run-length columns.

Each (lang, source) group is a column of counts over its language's kept terms.
Most counts of a column are small, so the vocabulary is put into an order that
clusters equal counts: by the number of sources a term occurs in, then by its
counts, source by source. The order is cut by ranges into chunks (``CHUNK``
terms on average), each group's column of a chunk is run-length encoded, with
the probability of its count in place of it, and a pair of groups is compared
run by run: the boundaries of both are merged, and each stretch adds its
difference times its length. Sums of the chunks make up the pair's value.

Terms are counted where the texts are, per task; the counts are summed up by
key, gathered by term (one entry a source) and by group and chunk (bounded by
the chunk). Pairs are formed per chunk between blocks of ``BLOCK`` sources; the
result itself has a row for each ordered pair of sources of a language.

All arithmetic is on 64-bit integers and exact while a language's terms occur
less than 9e15 times (the division is done three digits at a time).

Defined results: null text, lang and source count as ''; a text without terms
still makes its group; a language without kept terms has pairs of value 0 and
no terms; repeated rows count as rows; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reuselens.llm.common import materialise

MIN_DOCS = 30                # documents of a kept term
UNIT = 1_000_000_000         # p is in units of 1 / UNIT
SMOOTH = 5
TOP_TERMS = 50
CHUNK = 8192                 # terms of a chunk, on average
BLOCK = 64                   # sources of a block, on average
SLICE = 1 << 22              # bytes of a text taken at once
ENTRIES = 400_000            # counts a task holds before it hands them on

#: Terms are runs of ASCII letters and all that is not ASCII, A-Z lower-cased:
#: on UTF-8 bytes, everything else is a blank.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")


# ---------------------------------------------------------------- in a task

def _terms_of(text: bytes) -> Counter:
    """Times of each term, a slice (ended between terms) at a time."""
    found, at = Counter(), 0
    while at < len(text):
        stop = _BREAK.search(text, at + SLICE) if at + SLICE < len(text) else None
        end = stop.end() if stop else len(text)
        found.update(text[at:end].translate(_TERMS).split())
        at = end
    return found


def _count(batches):
    """Rows (lang, source, text) -> (lang, source, term, n, docs), summed up
    over the task as far as ``ENTRIES`` go."""
    held: dict[tuple, dict[bytes, list[int]]] = {}
    size = 0

    def out():
        for (lang, source), terms in held.items():
            n = len(terms)
            yield pa.record_batch({
                "lang": pa.array([lang] * n, pa.string()), "source": pa.array([source] * n, pa.string()),
                "term": pa.array(list(terms), pa.binary()).cast(pa.string()),
                "n": pa.array([x[0] for x in terms.values()], pa.int64()), "docs": pa.array([x[1] for x in terms.values()], pa.int64())})

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            terms = held.setdefault((lang, source), {})
            before = len(terms)
            for term, n in _terms_of(text.as_buffer().to_pybytes()).items():
                have = terms.get(term)
                if have is None:
                    terms[term] = [n, 1]
                else:
                    have[0] += n
                    have[1] += 1
            size += len(terms) - before
            if size > ENTRIES:
                yield from out()
                held.clear()
                size = 0
    yield from out()


def share(count: np.ndarray, n: int, v: int) -> np.ndarray:
    """``1 + floor(UNIT * (count + SMOOTH) / (n + SMOOTH * v))``, exactly."""
    left, whole, p = count.astype(np.int64) + SMOOTH, n + SMOOTH * v, np.zeros(len(count), np.int64)
    for _ in range(3):                                   # UNIT is 1000 ** 3
        left = left * 1000
        p = p * 1000 + left // whole
        left = left % whole
    return p + 1


def _runs(batches):
    """One row a group and chunk: its counts ``(place, n)`` of terms that occur
    -> the ends of its runs of equal counts, and their p."""
    for batch in batches:
        ends, ps = [], []
        for i in range(batch.num_rows):
            size, n, v = (batch.column(c)[i].as_py() for c in ("size", "n", "v"))
            column = np.zeros(size, np.int64)
            cells = batch.column("cells")[i]
            if cells.is_valid and len(cells.values):
                column[cells.values.field("place").to_numpy()] = cells.values.field("n").to_numpy()
            last = np.flatnonzero(np.append(column[1:] != column[:-1], True))
            ends.append(last + 1)
            ps.append(share(column[last], n, v))
        kept = ("lang", "chunk", "source", "own")
        yield pa.record_batch({**{c: batch.column(c) for c in kept}, "ends": pa.array(ends, pa.list_(pa.int64())), "p": pa.array(ps, pa.list_(pa.int64()))})


def run_difference(ends_a, p_a, ends_b, p_b) -> int:
    """Sum of ``abs(p - q)`` over all places of two run-length columns."""
    ends = np.union1d(ends_a, ends_b)
    f = np.abs(p_a[np.searchsorted(ends_a, ends)] - p_b[np.searchsorted(ends_b, ends)])
    return int((f * np.diff(ends, prepend=0)).sum())


def _pairs(key, table):
    """The pairs of a block of sources with another (or within one)."""
    lang, _, i, j = (k.as_py() for k in key)
    sources, own = table["source"].to_pylist(), table["own"].to_pylist()
    ends = [np.asarray(x.values) for x in table["ends"]]
    p = [np.asarray(x.values) for x in table["p"]]
    left = [x for x in range(len(own)) if own[x] == i]
    right = [x for x in range(len(own)) if own[x] == j]
    made = [(sources[a], sources[b], run_difference(ends[a], p[a], ends[b], p[b]))
            for a in left for b in right if i != j or sources[a] < sources[b]]
    a, b, value = zip(*made, strict=True) if made else ((), (), ())
    return pa.table({"lang": pa.array([lang] * len(made), pa.string()), "a": pa.array(a, pa.string()),
                     "b": pa.array(b, pa.string()), "value": pa.array(value, pa.int64())})


# ------------------------------------------------------------------ in Spark

def _share(count: str, n: str, v: str):
    """``share`` of columns."""
    whole = F.expr(f"{n} + {SMOOTH} * {v}")
    left, p = F.col(count) + SMOOTH, F.lit(0).cast("long")
    for _ in range(3):
        left = left * 1000
        p = p * 1000 + F.call_function("div", left, whole)
        left = left % whole
    return p + 1


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long") \
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS, chunk: int = CHUNK) -> DataFrame:
    """``lang, term, total, cells, chunk, place``: the kept terms in clustered
    order, cut into chunks; ``cells`` are the ``(source, n)`` of a term."""
    cells = F.sort_array(F.collect_list(F.struct("source", "n")))
    kept = materialise(term_counts(docs).groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), cells.alias("cells"))
                       .where(F.col("docs") >= min_docs).select("lang", "term", "total", "cells"))
    order = ["lang", "spread", "cells", "term"]
    dealt = kept.withColumn("spread", F.size("cells")).repartitionByRange(max(1, -(-kept.count() // chunk)), *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    # places are within a task; a task may end one language and begin the next
    numbered = materialise(dealt.select("lang", "term", "total", "cells", F.spark_partition_id().alias("chunk"), place.alias("place")))
    first = numbered.groupBy("lang", "chunk").agg(F.min("place").alias("first"))
    return numbered.join(first, ["lang", "chunk"]).withColumn("place", F.col("place") - F.col("first")).drop("first")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank``: for each group the other
    sources by their difference (part ``pair``) and the ``top`` terms that it
    has more of than its language (part ``term``)."""
    terms = kept_terms(docs, min_docs, chunk)
    cells = terms.select("lang", "term", "total", "chunk", "place", F.explode("cells").alias("cell")) \
        .select("lang", "term", "total", "chunk", "place", "cell.source", "cell.n")
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    found = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = materialise(found.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("group_n", "v", "lang_n")]))

    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    blocks = -(-most // block)
    columns = cells.groupBy("lang", "chunk", "source").agg(F.collect_list(F.struct(F.col("place").cast("int").alias("place"), "n")).alias("cells"))
    every = terms.groupBy("lang", "chunk").agg(F.count("*").cast("int").alias("size")).join(groups, "lang")
    own = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")
    runs = every.join(columns, ["lang", "chunk", "source"], "left").select(
        "lang", "chunk", "source", own.alias("own"), "size", F.col("group_n").alias("n"), "v", "cells") \
        .mapInArrow(_runs, "lang string, chunk int, source string, own int, ends array<bigint>, p array<bigint>")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    met = runs.select("*", other).select("lang", "chunk", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "source", "own", "ends", "p")
    half = met.groupBy("lang", "chunk", "i", "j").applyInArrow(_pairs, "lang string, a string, b string, value long") \
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = half.select("lang", both.alias("x"), "value").select("lang", "x.source", "x.item", "value")
    wordless = groups.where(F.col("v") == 0).select("lang", "source")
    pairs = pairs.unionByName(wordless.join(wordless.withColumnRenamed("source", "item"), "lang").where(F.col("source") != F.col("item"))
                              .withColumn("value", F.lit(0).cast("long")))

    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by).alias("rank"))
    more = cells.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (
        _share("n", "group_n", "v") - _share("total", "lang_n", "v")).alias("value")).where(F.col("value") > 0)
    best = more.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    return pairs.unionByName(best.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
