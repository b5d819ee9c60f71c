"""Counting of 64-bit keys over a corpus with packed shuffle rows.

A task counts its keys, deals the distinct ones to buckets by hash and sends
one row per bucket: sorted keys as differences with their counts, byte planes
compressed.  A bucket's rows are unpacked and added up in one task.  A key
arrives at most once for each ``FLUSH`` keys that were read, whatever its
frequency, and the number of buckets follows the number of keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from reuselens.llm import kernels as K

FLUSH = 1 << 22
BUCKET_KEYS = 1 << 21


def pack(columns: list[np.ndarray]) -> bytes:
    """8-byte columns of equal length, the first sorted."""
    first = columns[0].astype(np.uint64)
    first[1:] -= first[:-1].copy()
    planes = [c.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes() for c in (first, *columns[1:])]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(blob: bytes, n_columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n = len(raw) // (8 * n_columns)
    planes = raw.reshape(n_columns, 8, n)
    out = [np.ascontiguousarray(p.T).reshape(-1).view(np.uint64) for p in planes]
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def count_keys(docs: DataFrame, make, n_buckets: int, least: int = 1, local_least: int = 1, flush_at: int = FLUSH) -> DataFrame:
    """``key, n`` of the keys that ``make(batch)`` yields as arrays of unsigned
    64-bit numbers for the Arrow batches of ``docs``; keys below ``least`` in
    all are left out, and counts below ``local_least`` among ``flush_at`` keys
    aren't sent."""
    def send(held):
        keys = np.concatenate(held)
        held.clear()                           # one copy at a time
        keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.diff(np.append(first, len(keys)))
        enough = counts >= local_least
        keys, counts = keys[first[enough]], counts[enough]
        bucket = (K.mix(keys) >> np.uint64(20)) % np.uint64(n_buckets)
        order = np.argsort(bucket, kind="stable")
        at = np.searchsorted(bucket[order], np.arange(n_buckets + 1, dtype=np.uint64))
        for b in np.flatnonzero(np.diff(at)):
            own = order[at[b]:at[b + 1]]
            yield int(b), pack([keys[own], counts[own]])

    def gather(batches):
        held, n = [], 0                        # keys not sent yet

        def flush():
            rows = list(send(held))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                               pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "blob"])

        for batch in batches:
            for keys in make(batch):
                held.append(keys)
                n += len(keys)
                if n >= flush_at:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()
        K.release_memory()

    def merge(table: pa.Table) -> pa.Table:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        held, n = [], 0
        for blob in table.column("blob"):
            held.append(unpack(blob.as_py(), 2))
            n += len(held[-1][0])
            if n > 2 * len(keys) + BUCKET_KEYS:
                keys, counts = add_up(*(np.concatenate(x) for x in zip((keys, counts), *held, strict=True)))
                held, n = [], 0
        keys, counts = add_up(*(np.concatenate(x) for x in zip((keys, counts), *held, strict=True)))
        keep = counts >= least
        return pa.table({"key": keys[keep].view(np.int64), "n": counts[keep].astype(np.int64)})

    return docs.mapInArrow(gather, "bucket int, blob binary").groupBy("bucket") \
        .applyInArrow(merge, "key long, n long")
