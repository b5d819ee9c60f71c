"""Best-fit packing of whole documents into token sequences, improved by
swap-based local search.

A document is its token ids and one end id; only a document longer than a
sequence is cut, into whole sequences and a shorter last piece. Pieces are
packed without being cut further:

1. ``pieces`` tokenises where the rows are and writes the pieces once, each
   with a number of its own (``uid``), so null and repeated ids do no harm.
2. Pieces as long as a sequence are one each. The others are dealt by a hash
   into groups of about ``GROUP`` pieces, and each group is packed in a task:
   best fit, longest first, then ``local_search``: an exchange between two
   underfull bins (move one, one for one, two for one, one for two) that puts
   as much as possible into the fuller bin, so the sum of squared fills rises
   with every step and the emptier bin runs empty. It ends when the free room
   is less than one sequence (no bin can be saved) or no exchange is left.
3. The bins that stay emptier than ``REOPEN`` are opened, and their pieces
   dealt anew into fewer groups, until there is one group. Where a round opens
   more than half of its pieces, they do not fit together better and stay.

A task holds one group (``GROUP`` numbers); nothing but counts reaches the
driver. The result is one row per piece; ``sequences`` gives the ids of every
sequence.

Defined results: bytes that are not UTF-8 count as U+FFFD; a null or empty text is its end id alone, one piece of length
1; rows with a repeated or null id are documents of their own, each with pieces
from 0; an empty table has no pieces. Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reuselens.llm.common import materialise
from reuselens.llm.kernels import utf8_pieces
from reuselens.llm.token_ids import word_encoder

SIZE = 4096                  # tokens of a sequence
END = 1                      # id that ends a document
GROUP = 16_384               # pieces packed together
REOPEN = 0.875               # bins below this fill are opened again
PIECE = 1 << 22              # bytes of text tokenised at once, or one text
STUCK = 16                   # bins in a row that no exchange empties, before a search ends


# ---------------------------------------------------------------- in a task

def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins (lists of positions): longest first, each into the bin with the
    least room that holds it."""
    rooms: list[list[int]] = [[] for _ in range(size + 1)]   # bins by room
    some = 0                                                 # bit r: rooms[r] is not empty
    bins: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[i])
        at = some >> s
        if at:
            room = s + (at & -at).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                some ^= 1 << room
        else:
            room, b = size, len(bins)
            bins.append([])
        bins[b].append(i)
        room -= s
        if room:
            rooms[room].append(b)
            some |= 1 << room
    return bins


def _sums(sizes: np.ndarray) -> np.ndarray:
    """Sums of two different places, in the order of ``np.triu_indices``."""
    i, j = np.triu_indices(len(sizes), 1)
    return sizes[i] + sizes[j]


def _pair(n: int, k: int) -> tuple[int, int]:
    i, j = np.triu_indices(n, 1)
    return int(i[k]), int(j[k])


def exchange(a: np.ndarray, b: np.ndarray, room: int):
    """The exchange that moves most tokens, ``room`` at most, from the bin with
    sizes ``a`` to that with ``b``: ``(tokens, places in a, places in b)``; 0
    tokens if there is none."""
    best = (0, (), ())
    bb = _sums(b)
    back = np.concatenate([[0], b, bb])
    for give, given, taken in ((a, lambda k: (k,), back), (_sums(a), lambda k: _pair(len(a), k), b)):
        if not len(give) or not len(taken):
            continue
        order = np.argsort(taken, kind="stable")
        at = np.searchsorted(taken[order], give - room)
        ok = at < len(taken)
        moved = np.where(ok, give - taken[order][np.minimum(at, len(taken) - 1)], 0)
        k = int(np.argmax(moved))
        if moved[k] > best[0]:
            t = int(order[at[k]])
            if taken is b:
                back_at = (t,)
            else:
                back_at = () if t == 0 else (t - 1,) if t <= len(b) else _pair(len(b), t - 1 - len(b))
            best = (int(moved[k]), given(k), back_at)
        if best[0] == room:
            break
    return best


def local_search(bins: list[list[int]], lengths: np.ndarray, size: int, stuck: int = STUCK) -> list[list[int]]:
    """The bins after exchanges that empty the emptiest ones (see the module)."""
    bins = [list(b) for b in bins]
    sizes = {i: lengths[b] for i, b in enumerate(bins)}
    fill = np.array([int(s.sum()) for s in sizes.values()], np.int64)
    left = int((size - fill).sum())
    tried: set[int] = set()
    failed = 0
    while left >= size and failed < stuck:
        under = np.flatnonzero((fill > 0) & (fill < size))
        source = next((int(i) for i in under[np.argsort(fill[under], kind="stable")] if i not in tried), None)
        if source is None:
            break
        changed = True
        while changed and fill[source]:
            changed = False
            others = under[(under != source) & (fill[under] < size)]
            for t in others[np.argsort(-fill[others], kind="stable")].tolist():
                if not fill[source]:
                    break
                if fill[t] < fill[source]:
                    continue
                moved, give, take = exchange(sizes[source], sizes[t], int(size - fill[t]))
                if not moved:
                    continue
                out = [bins[source][k] for k in give]
                back = [bins[t][k] for k in take]
                bins[source] = [x for k, x in enumerate(bins[source]) if k not in give] + back
                bins[t] = [x for k, x in enumerate(bins[t]) if k not in take] + out
                sizes[source], sizes[t] = lengths[np.array(bins[source], np.int64)], lengths[np.array(bins[t], np.int64)]
                fill[source] -= moved
                fill[t] += moved
                changed = True
        if fill[source]:
            tried.add(source)
            failed += 1
        else:
            left -= size
            failed = 0
    return [b for b in bins if b]


def _pack_group(size: int, level: int):
    def run(key, table):
        table = table.sort_by([("length", "descending"), ("uid", "ascending")])
        uid, lengths = table["uid"].to_numpy(), table["length"].to_numpy()
        bins = local_search(best_fit(lengths, size), lengths, size)
        at = np.concatenate([np.array(b, np.int64) for b in bins])
        n = np.array([len(b) for b in bins])
        first = np.cumsum(n) - n
        ends = np.cumsum(lengths[at])
        starts = ends - lengths[at]
        fill = np.add.reduceat(lengths[at], first)
        base = (level << 56) | (key[0].as_py() << 24)
        return pa.table({"uid": uid[at], "length": lengths[at], "sequence_id": np.repeat(base + np.arange(len(bins)), n),
                         "offset": starts - np.repeat(starts[first], n), "fill": np.repeat(fill, n)})

    return run


# ------------------------------------------------------------------ in Spark

def _cut(path: str, size: int, end: int, with_ids: bool):
    def run(batches):
        encode = word_encoder(path)
        for batch in batches:
            for row, data, off in utf8_pieces(batch.column("text"), PIECE):
                text = pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(off.tobytes()), pa.py_buffer(data.tobytes()))
                ids, bounds = encode(text)
                out = {k: [] for k in ("doc", "piece", "start", "length", "crc", "ids")}
                for i in range(len(text)):
                    own = np.append(ids[bounds[i]:bounds[i + 1]], np.uint32(end))
                    for p, s in enumerate(range(0, len(own), size)):
                        part = own[s:s + size].astype("<u4")
                        for k, v in zip(out, (row + i, p, s, len(part), zlib.crc32(part.tobytes()), part), strict=True):
                            out[k].append(v)
                made = {"doc_id": batch.column("doc_id").take(pa.array(out["doc"], pa.int64())),
                        "piece": pa.array(out["piece"], pa.int32()), "start": pa.array(out["start"], pa.int64()),
                        "length": pa.array(out["length"], pa.int64()), "ids_crc32": pa.array(out["crc"], pa.int64())}
                if with_ids:
                    made["ids"] = pa.array([x.astype(np.int32) for x in out["ids"]], pa.list_(pa.int32()))
                yield from pa.table(made).to_batches()

    return run


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = END, with_ids: bool = False) -> DataFrame:
    """``uid, doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every
    document, written once. ``tokenizer``: a file that all executors have."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    rows = docs.select("doc_id", F.make_valid_utf8(F.col("text").cast("string")).alias("text"))
    return materialise(rows.mapInArrow(_cut(tokenizer, size, end, with_ids), schema).withColumn("uid", F.monotonically_increasing_id()))


def place(items: DataFrame, size: int = SIZE, group: int = GROUP, reopen: float = REOPEN) -> DataFrame:
    """``uid, sequence_id, offset`` of items ``(uid, length)`` with lengths from
    1 to ``size``; ``uid`` differs from row to row."""
    whole = items.where(F.col("length") == size).select("uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = items.where(F.col("length") < size).select("uid", "length")
    n, level, placed = rest.count(), 0, whole
    while n:
        groups = -(-n // group)
        dealt = rest.withColumn("grp", F.pmod(F.xxhash64(F.lit(level), "uid"), F.lit(groups)))
        packed = materialise(dealt.groupBy("grp").applyInArrow(
            _pack_group(size, level), "uid long, length long, sequence_id long, offset long, fill long"))
        opened = packed.where(F.col("fill") < reopen * size)
        m = opened.count() if groups > 1 else 0
        if 2 * m > n:
            m = 0
        kept = packed.where(F.col("fill") >= reopen * size) if m else packed
        placed = placed.unionByName(kept.select("uid", "sequence_id", "offset"))
        rest, n, level = opened.select("uid", "length"), m, level + 1
    return placed


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = END, with_ids: bool = False,
         group: int = GROUP, reopen: float = REOPEN) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset`` (and ``ids``)."""
    parts = pieces(docs, tokenizer, size, end, with_ids)
    return parts.join(place(parts, size, group, reopen), "uid").drop("uid")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, doc_ids, offsets, ids`` of every sequence of a ``pack``
    with ids; a group is one sequence at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"), F.flatten("p.ids").alias("ids"))
