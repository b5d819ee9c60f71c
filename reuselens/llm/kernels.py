"""Vectorised text kernels shared by the operators of this subpackage.

They run inside Spark tasks on one Arrow batch at a time.  Texts are taken as
UTF-8 bytes; words are the maximal runs of bytes other than ``\\x20`` and
``\\x09-\\x0D``, lower-cased for ``A-Z`` only.  A string's hash is
``sum(T[byte] * B**i) * B**-start`` modulo 2**64 over a table ``T`` of random
64-bit values, mixed with the length: every substring's hash comes from two
prefix sums, so a batch needs no Python loop over words.

Nulls count as empty texts.  Memory: about 40 bytes per byte of a batch piece;
pieces hold ``PIECE`` bytes, or one text if that is longer.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

PIECE = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240607))
TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_TABLE = TABLE[LOWER]

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def release_memory():
    """Hand back to the system what a task has freed; a worker that is used
    again would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # where the C library has it
    if trim is not None:
        trim(0)


def powers(n: int):
    """``B**i`` and ``B**-i`` for i < n (kept up to a few pieces long)."""
    if len(_powers[0]) < n:
        made = []
        for base in (BASE, BASE_INV):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        if n > 4 * PIECE:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Final mixing (64-bit finaliser of a murmur hash)."""
    h = h ^ (h >> np.uint64(33))
    h = h * M1
    h ^= h >> np.uint64(33)
    h *= M2
    h ^= h >> np.uint64(33)
    return h


def utf8_pieces(column, limit: int = PIECE, rows: int = 1 << 30):
    """Cut a string column into pieces of at most ``limit`` bytes (or one text)
    and ``rows`` texts: ``(first row, bytes, offsets)`` where text i of the
    piece is ``bytes[offsets[i]:offsets[i + 1]]``."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    row = 0
    for arr in chunks:
        if len(arr) == 0:
            continue
        if arr.null_count:
            arr = arr.fill_null("")
        if not pa.types.is_large_string(arr.type):
            arr = arr.cast(pa.large_string())
        _, off, data = arr.buffers()
        off = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(arr):
            end = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
            end = min(end, len(arr), at + rows)
            yield row + at, data[off[at]:off[end]], off[at:end + 1] - off[at]
            at = end
        row += len(arr)


def prefix_hash(data: np.ndarray, table: np.ndarray = TABLE):
    """``(P, inv)``: the raw hash of ``data[s:e]`` is ``(P[e] - P[s]) * inv[s]``."""
    pw, inv = powers(len(data) + 1)
    p = np.empty(len(data) + 1, np.uint64)
    p[0] = 0
    np.cumsum(table[data] * pw[:len(data)], dtype=np.uint64, out=p[1:])
    return p, inv


def word_bounds(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of the words, and the text (row of the piece) of each."""
    solid = ~SPACE[data]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    begin[cut] = solid[cut]
    stop[cut - 1] = solid[cut - 1]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(stop) + 1
    text = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, text


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """Hash of every lower-cased word and the words per text.

    ``(hashes, bounds)``: text i has the words ``hashes[bounds[i]:bounds[i+1]]``.
    """
    starts, ends, text = word_bounds(data, offsets)
    p, inv = prefix_hash(data, LOWER_TABLE)
    h = mix((p[ends] - p[starts]) * inv[starts] + (ends - starts).astype(np.uint64))
    bounds = np.searchsorted(text, np.arange(len(offsets)))
    return h, bounds


def chain(*parts: np.ndarray) -> np.ndarray:
    """Hash of a sequence of hashes, element by element."""
    h = parts[0]
    for p in parts[1:]:
        h = mix(h * BASE + p)
    return h


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, k: int = 5):
    """Hashes of the k-word shingles of each text in order of position;
    a text of 1 to k-1 words has its whole sequence as one shingle, an empty
    text has none. Returns ``(hashes, bounds)``."""
    n = np.diff(bounds)
    if len(words) >= k:
        full = words[:len(words) - k + 1]
        for j in range(1, k):
            full = mix(full * BASE + words[j:len(words) - k + 1 + j])
    else:
        full = np.zeros(0, np.uint64)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(count)])
    rows = np.repeat(np.arange(len(n)), count)
    at = np.arange(out_bounds[-1]) - out_bounds[rows] + bounds[rows]
    short = n[rows] < k
    out = np.empty(len(rows), np.uint64)
    out[~short] = full[at[~short]]
    for i in np.flatnonzero(short):
        w = words[bounds[rows[i]]:bounds[rows[i] + 1]]
        h = w[:1]
        for j in range(1, len(w)):
            h = mix(h * BASE + w[j:j + 1])
        out[i] = mix(h ^ np.uint64(len(w)))[0]
    return out, out_bounds
