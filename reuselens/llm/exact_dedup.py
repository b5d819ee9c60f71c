"""Exact duplicates by a cuckoo-filter index of live digests.

Texts are equal when they agree after every byte ``\\x20``, ``\\x09-\\x0D`` is
removed; the SHA-256 of what is left is the text's digest.  A ``DigestIndex``
holds the live digests of one partition: a cuckoo filter in front of the
digests themselves, kept in content buckets.  A negative answer of the filter
is final and the digest is inserted; a hit is verified against the bucket.
Digests can be deleted again; an insertion that finds no place, or a filter
that gets too full, makes a filter of twice the size from the stored keys.

The corpus is indexed twice over: each scan task keeps one row for each digest
it has met (so a digest that a third of all rows share arrives as one row a
task), then the rows are dealt by digest and merged by the same index.

Defined results: null text is the empty text, all empty texts are one group;
a null ``doc_id`` loses against any other and is matched by nothing else than
null; of rows with equal ``doc_id`` and length one stays; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reuselens.llm.common import fresh, materialise

SPACES = bytes([0x20, *range(0x09, 0x0E)])
SLOTS = 4
MAX_KICKS = 64
MAX_LOAD = 0.85

DIGEST_SCHEMA = "doc_id long, digest binary, n_chars long"
GROUP_SCHEMA = "digest binary, group_size long, best_chars long, keep_id long"


class DigestIndex:
    """Live 32-byte digests with a payload each.

    >>> index.upsert(digest, payload, merge); index.contains(digest)
    >>> index.delete(digest); len(index); index.items()
    """

    def __init__(self, capacity: int = 1 << 10):
        self.buckets: dict[bytes, dict[bytes, object]] = {}
        self.count = 0
        self.resizes = 0
        self._allocate(capacity)

    def _allocate(self, capacity: int):
        size = 1
        while size * SLOTS * MAX_LOAD < capacity:
            size *= 2
        self.mask = size - 1
        self.slots = [[] for _ in range(size)]

    @staticmethod
    def _mark(digest: bytes) -> tuple[int, int]:
        """Fingerprint (16 bits, not 0) and the first place, from distinct bytes."""
        return int.from_bytes(digest[:2], "big") or 1, int.from_bytes(digest[8:16], "big")

    def _other(self, place: int, mark: int) -> int:
        return (place ^ (mark * 0x5BD1E995)) & self.mask

    def _places(self, digest: bytes):
        mark, place = self._mark(digest)
        place &= self.mask
        return mark, place, self._other(place, mark)

    def maybe(self, digest: bytes) -> bool:
        """The filter's answer alone: False is certain."""
        mark, a, b = self._places(digest)
        return mark in self.slots[a] or mark in self.slots[b]

    def contains(self, digest: bytes) -> bool:
        return self.maybe(digest) and digest in self.buckets.get(digest[:2], ())

    def _place(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        for at in (a, b):
            if len(self.slots[at]) < SLOTS:
                self.slots[at].append(mark)
                return True
        at = b
        for kick in range(MAX_KICKS):
            slot = self.slots[at]
            i = kick % SLOTS
            slot[i], mark = mark, slot[i]
            at = self._other(at, mark)
            if len(self.slots[at]) < SLOTS:
                self.slots[at].append(mark)
                return True
        return False

    def _resize(self):
        self.resizes += 1
        capacity = 2 * (self.mask + 1) * SLOTS
        while True:
            self._allocate(capacity)
            if all(self._place(d) for bucket in self.buckets.values() for d in bucket):
                return
            capacity *= 2

    def upsert(self, digest: bytes, payload, merge) -> bool:
        """Insert, or merge with the payload that is there; True if it was new."""
        bucket = self.buckets.setdefault(digest[:2], {})
        if self.maybe(digest) and digest in bucket:
            bucket[digest] = merge(bucket[digest], payload)
            return False
        bucket[digest] = payload
        self.count += 1
        if self.count > MAX_LOAD * SLOTS * (self.mask + 1) or not self._place(digest):
            self._resize()
        return True

    def delete(self, digest: bytes) -> bool:
        """Forget a live digest; False if it wasn't there."""
        if not self.contains(digest):
            return False
        del self.buckets[digest[:2]][digest]
        self.count -= 1
        mark, a, b = self._places(digest)
        self.slots[a if mark in self.slots[a] else b].remove(mark)
        return True

    def __len__(self):
        return self.count

    def items(self):
        for bucket in self.buckets.values():
            yield from bucket.items()


def better(a, b):
    """Merge two groups ``(size, chars, id)``: most code points, then the
    smallest id (null last)."""
    def rank(x):
        return (-x[1], x[2] is None, x[2] or 0)
    best = min(a, b, key=rank)
    return a[0] + b[0], best[1], best[2]


def normalised(text: bytes) -> bytes:
    return text.translate(None, SPACES)


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: key, digest of the normalised text, code points."""
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n_chars", pa.int64())])

    def run(batches):
        for batch in batches:
            column = batch.column(1).fill_null("")
            made = [hashlib.sha256(t.as_buffer().to_pybytes().translate(None, SPACES)).digest()
                    for t in column]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.binary()),
                 pc.cast(pc.utf8_length(column), pa.int64())], schema=schema)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")) \
        .mapInArrow(run, DIGEST_SCHEMA)


def _emit(index: DigestIndex):
    rows = list(index.items())
    for at in range(0, len(rows), 1 << 16):
        part = rows[at:at + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in part], pa.binary()),
             pa.array([p[0] for _, p in part], pa.int64()),
             pa.array([p[1] for _, p in part], pa.int64()),
             pa.array([p[2] for _, p in part], pa.int64())],
            names=["digest", "group_size", "best_chars", "keep_id"])


#: A map task hands on its groups when it holds so many; the merge joins them.
HELD = 1 << 18


def _local_groups(batches):
    index = DigestIndex()
    for batch in batches:
        ids, marks, chars = (batch.column(i).to_pylist() for i in range(3))
        for i, d, n in zip(ids, marks, chars, strict=True):
            index.upsert(d, (1, n, i), better)
        if len(index) > HELD:
            yield from _emit(index)
            index = DigestIndex()
    yield from _emit(index)


def _merged_groups(batches):
    index = DigestIndex()
    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(4)]
        for d, n, c, i in zip(*cols, strict=True):
            index.upsert(d, (n, c, i), better)
    yield from _emit(index)


def digest_groups(rows: DataFrame) -> DataFrame:
    """The index as a table: one row per live digest with its group's size and
    the row that stays. Only one row per digest and task is shuffled."""
    local = rows.select("doc_id", "digest", "n_chars").mapInArrow(_local_groups, GROUP_SCHEMA)
    return local.repartition("digest").mapInArrow(_merged_groups, GROUP_SCHEMA)


def update_index(index: DataFrame, inserted: DataFrame, deleted: DataFrame) -> DataFrame:
    """The index after documents were deleted and added.

    ``index``: as from ``digest_groups``; ``inserted``: rows of ``digests``;
    ``deleted``: digests whose group is gone (a digest that isn't live is
    ignored). Deletions come first.
    """
    def run(batches):
        live = DigestIndex()
        later, gone = [], []
        for batch in batches:
            for d, n, c, i, op in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if op == 0:
                    live.upsert(d, (n, c, i), better)
                else:
                    (gone if op == 1 else later).append((d, (n, c, i)))
        for d, _ in gone:
            live.delete(d)
        for d, p in later:
            live.upsert(d, p, better)
        yield from _emit(live)

    none = F.lit(None).cast("long")
    added = inserted.mapInArrow(_local_groups, GROUP_SCHEMA)
    log = (index.select("digest", "group_size", "best_chars", "keep_id", F.lit(0).alias("op"))
           .unionByName(deleted.select("digest", none.alias("group_size"), none.alias("best_chars"),
                                       none.alias("keep_id"), F.lit(1).alias("op")))
           .unionByName(added.withColumn("op", F.lit(2))))
    return log.repartition("digest").mapInArrow(run, GROUP_SCHEMA)


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept,
    text_sha256``.  Rows alike in key, digest and length are counted before
    the join, so that one of them stays."""
    rows = materialise(digests(docs, key, text))
    groups = digest_groups(rows)
    each = rows.groupBy("digest", "doc_id", "n_chars").agg(F.count("*").alias("copies"))
    best = (F.col("doc_id").eqNullSafe(F.col("keep_id"))) & (F.col("n_chars") == F.col("best_chars"))
    return (each.join(groups, "digest")
            .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("doc_id", "keep_id", "group_size", (best & (F.col("nth") == 1)).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def _mark(text):
    """The digest of ``digests`` as a column."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\x0c\r", "").cast("binary"), 256))


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of each group.

    Digests are made by Spark's own functions here, so whole rows don't pass
    through Python; the groups come from the index. Rows meet the index on id
    and digest together, so a digest that many rows share is spread over all
    tasks.
    """
    at = docs.columns.index(key)
    mark, size, keep_id, keep_mark, best, number = fresh(docs, "digest", "chars", "keep_id", "keep_digest", "best", "nth")
    body = F.col(text).cast("string")
    marked = docs.select(F.col(key).cast("long").alias("doc_id"), _mark(body).alias("digest"),
                         F.length(F.coalesce(body, F.lit(""))).cast("long").alias("n_chars"))
    groups = digest_groups(marked).select(
        F.col("keep_id").alias(keep_id), F.col("digest").alias(keep_mark), F.col("best_chars").alias(best))
    rows = docs.withColumn(mark, _mark(body)).withColumn(size, F.length(F.coalesce(body, F.lit(""))).cast("long"))
    kept = rows.join(groups, F.col(docs.columns[at]).eqNullSafe(F.col(keep_id)) & (F.col(mark) == F.col(keep_mark))
                     & (F.col(size) == F.col(best)), "left_semi")
    nth = F.row_number().over(W.partitionBy(docs.columns[at], mark).orderBy(size))
    return kept.withColumn(number, nth).where(F.col(number) == 1).drop(number, mark, size)
