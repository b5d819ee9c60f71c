"""Rows of a shuffle that stand for many entries: columns of equal length, packed
into one compressed binary value, and the hash of Spark's ``xxhash64`` for
strings that are inside one."""

from __future__ import annotations

import contextlib
import ctypes
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# the workers get this module's functions with the job; they need numpy and pyarrow only
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def pack(**columns) -> bytes:
    batch = pa.record_batch({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return out.getvalue().to_pybytes()


def unpack(blob) -> pa.RecordBatch:
    """``blob``: a scalar of a binary column."""
    return unpack_bytes(blob.as_buffer())


def unpack_bytes(blob) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob).read_next_batch()


def numbers(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False)


def bytes_apart(name: str, x: np.ndarray) -> dict:
    """Whole numbers as two columns, their last byte and the rest, which pack smaller."""
    return {name: (x & 255).astype(np.uint8), f"{name}_rest": (x >> 8).astype(np.int32)}


def bytes_joined(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return (numbers(batch, f"{name}_rest").astype(np.int64) << 8) | numbers(batch, name)


def smallest(x: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 on in as few bytes as the largest needs."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def handing_back(run):
    """``run`` of a group; then what its task has freed goes back to the system."""
    def done(*group):
        out = run(*group)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)
        return out

    return done


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxhash64(strings: pa.Array, seed: int = 42) -> np.ndarray:
    """Spark's ``xxhash64`` of each string, all strings of a length at once."""
    p = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]
    strings = pa.concat_arrays([strings]) if strings.offset else strings
    offsets = np.frombuffer(strings.buffers()[1], np.int32)[:len(strings) + 1].astype(np.int64) if len(strings) else np.zeros(1, np.int64)
    data = np.frombuffer(strings.buffers()[2], np.uint8) if len(strings) and strings.buffers()[2] else np.zeros(0, np.uint8)
    sizes, out = np.diff(offsets), np.zeros(len(strings), np.uint64)
    start = [np.uint64(x % (1 << 64)) for x in (seed + int(p[0]) + int(p[1]), seed + int(p[1]), seed, seed - int(p[0]))]
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        text = np.zeros((len(rows), -(-int(size) // 8) * 8), np.uint8)
        text[:, :size] = data[offsets[rows][:, None] + np.arange(size)]
        lanes, at = text.view(np.uint64), 0
        if size >= 32:
            v = [np.full(len(rows), x) for x in start]
            while at + 32 <= size:
                v = [_turned(x + lanes[:, at // 8 + i] * p[1], 31) * p[0] for i, x in enumerate(v)]
                at += 32
            h = sum(_turned(x, by) for x, by in zip(v, (1, 7, 12, 18), strict=True))
            for x in v:
                h = (h ^ (_turned(x * p[1], 31) * p[0])) * p[0] + p[3]
        else:
            h = np.full(len(rows), np.uint64(seed) + p[4])
        h = h + np.uint64(size)
        while at + 8 <= size:
            h = _turned(h ^ (_turned(lanes[:, at // 8] * p[1], 31) * p[0]), 27) * p[0] + p[3]
            at += 8
        if at + 4 <= size:
            h = _turned(h ^ (text[:, at:at + 4].copy().view(np.uint32)[:, 0].astype(np.uint64) * p[0]), 23) * p[1] + p[2]
            at += 4
        for i in range(at, int(size)):
            h = _turned(h ^ (text[:, i].astype(np.uint64) * p[4]), 11) * p[0]
        h = (h ^ (h >> np.uint64(33))) * p[1]
        h = (h ^ (h >> np.uint64(29))) * p[2]
        out[rows] = h ^ (h >> np.uint64(32))
    return out.view(np.int64)
