"""Removal of repeated passages by run-length compressed suffix indexes.

Every byte that lies in a ``LENGTH``-byte string which also starts earlier (in
a smaller document, or earlier in the same one) is removed. Texts are UTF-8
bytes and strings never cross documents.

Routing. Positions are sampled by content: a ``GRAM``-byte gram is an anchor
if its hash is the least among the grams of some ``LENGTH``-byte string. Every
such string holds an anchor at a place that depends on the string alone, so
two equal strings meet at equal anchors. The region of an anchor is all that
strings holding it can cover. Regions that are equal as a whole repeat as a
whole: all but the first are removed, at once within a task and then in order
of anchor and region. Only anchors with different regions are left.

Halves. A string that holds an anchor reaches half of what is beyond the gram
on one side at least. So each region left makes at most two rows, one a side,
whatever the size of its group: the bytes that strings of that side can cover,
under the hash of the gram with the half. Rows without another of their key
hold nothing that repeats; equal rows are marked, all but the first, by their
bytes.

Index. The distinct rows of whole keys make the text of an index: its suffix
array (ranks doubled until all suffixes differ), the run-compressed
Burrows-Wheeler transform and the suffix array sampled at run borders. There,
and only there, the match of a suffix with its neighbour is measured; from one
sample to the next in the text the matching statistics stream, one byte
shorter each step. Neighbours that match in ``LENGTH`` bytes hold the same
string; of equal strings all but the first are marked.

Large groups. An index has at most ``GROUP`` distinct rows of a key, so that a
task's memory is bounded. Of a key with more, the strings are dealt out on
their own hash, and all but the first of each are marked in order: the same
result for a group of any size.

The text is dealt by document once; both the cutting of regions and the final
removal read that same exchange.

Defined results: null text is empty; texts below ``LENGTH`` bytes lose
nothing; rows with equal ids but different texts are documents in order of a
64-bit hash of the text (``mark``, part of a document's name); repeated rows (equal id and text) are one document read
repeatedly and get the same result; a null id is the largest; hashes of grams,
regions and strings have 64 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reuselens.llm import kernels as K
from reuselens.llm.common import materialise

LENGTH = 100
GRAM = 32
GROUP = 16384                    # distinct rows of a key in one index
HELD = 1 << 20                   # anchors that a task sorts at once
INDEX_BYTES = 700_000            # text of an index, but for one whole anchor more
LAST = (1 << 63) - 1
PLACES = 44                      # bits of a place in its document


def _sliding(f, x: np.ndarray, width: int) -> np.ndarray:
    """``f`` over ``x[i:i + width]`` for each i, by doubling."""
    span = 1
    while span * 2 <= width:
        x = f(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return f(x[:-rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """``(position, text, gram hash, region start, region end, region hash)`` of
    the anchors of a piece; positions are in the piece."""
    n, width = len(data), length - gram + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2 \
            + (np.zeros(0, np.uint64),)
    p, inv = K.prefix_hash(data)
    h = K.mix((p[gram:] - p[:-gram]) * inv[:n - gram + 1])
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = text[:n - gram + 1] == text[gram - 1:]
    h[~whole] = np.uint64(0xFFFFFFFFFFFFFFFF)
    least = _sliding(np.minimum, h, width)
    least[text[:n - length + 1] != text[length - 1:]] = 0
    pad = np.zeros(width - 1, np.uint64)
    at = np.flatnonzero((_sliding(np.maximum, np.concatenate([pad, least, pad]), width) == h) & whole)
    of = text[at]
    a = np.maximum(at - (length - gram), offsets[of])
    b = np.minimum(at + length, offsets[of + 1])
    region = K.mix((p[b] - p[a]) * inv[a] + ((b - a) * 1024 + (at - a)).astype(np.uint64))
    return at, of, h[at], a, b, region


def spans_of(order: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Unions of touching spans of each document (``order``: its number);
    ``(first row of the union, start, end)``."""
    if not len(order):
        return np.zeros(0, int), starts, ends
    by = np.lexsort((starts, order))
    o, s, e = order[by], starts[by].astype(np.int64), ends[by].astype(np.int64)
    wide = np.int64(1) << np.int64(45)
    _, o = np.unique(o, return_inverse=True)
    upto = np.maximum.accumulate(e + o * wide)
    new = np.ones(len(o), bool)
    new[1:] = s[1:] + o[1:] * wide > upto[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(o)) - 1
    return by[first], s[first], upto[last] - o[last] * wide


ROWS = pa.schema([("key", pa.int64()), ("region", pa.int64()), ("doc", pa.int64()), ("mark", pa.int64()),
                  ("place", pa.int64()), ("reach", pa.int64())])
ROWS_SQL = "key long, region long, doc long, mark long, place long, reach long"


def _anchor_rows(length: int, gram: int):
    """Rows of a task: anchors (``reach`` negative: offsets of their region)
    and spans found within the task (``reach``: the span's end)."""
    def flush(held):
        doc, mark, place, key, region, left, right = (np.concatenate(x) for x in zip(*held, strict=True))
        by = np.lexsort((place, mark, doc))
        by = by[np.argsort((key ^ region)[by], kind="stable")]
        same = np.zeros(len(by), bool)
        same[1:] = (region[by][1:] == region[by][:-1]) & (key[by][1:] == key[by][:-1])
        begin = by[np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))]
        other = (doc[by] != doc[begin]) | (mark[by] != mark[begin]) | (place[by] != place[begin])   # no repeated row
        again, first = by[same & other], by[~same]
        wide = left[again] + right[again] >= length
        again = again[wide]
        docs, number = np.unique(np.stack([doc[again], mark[again]]), axis=1, return_inverse=True)
        start = place[again] - left[again]
        row, s, e = spans_of(number.reshape(-1), start, start + left[again] + right[again])
        row = again[row]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
            np.concatenate([key[first].view(np.int64), K.mix(doc[row].view(np.uint64)).view(np.int64)]),
            np.concatenate([region[first].view(np.int64), np.zeros(len(row), np.int64)]),
            np.concatenate([doc[first], doc[row]]),
            np.concatenate([mark[first], mark[row]]),
            np.concatenate([place[first], s]),
            np.concatenate([-(left[first] * 1024 + right[first]) - 1, e]))], schema=ROWS)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, data, off in K.utf8_pieces(batch.column(2)):
                at, of, key, a, b, region = anchors(data, off, length, gram)
                held.append((ids[row + of], marks[row + of], at - off[of], key, region, at - a, b - at))
                n += len(at)
                if n >= HELD:
                    yield from flush(held)
                    held, n = [], 0
        if n:
            yield from flush(held)

    return run


def _compare_regions(length: int):
    """Over rows sorted by key, region, document and place: spans for all but
    the first of equal regions, and the first ones of keys with several."""
    schema = pa.schema([("open", pa.int32()), ("key", pa.int64()), ("doc", pa.int64()), ("mark", pa.int64()),
                        ("place", pa.int64()), ("reach", pa.int64())])

    def out(kind, key, doc, mark, place, reach):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(key), kind, np.int32)), *[pa.array(x) for x in (key, doc, mark, place, reach)]], schema=schema)

    def run(batches):
        last = None                # key, region, document and place of the first row like the one before
        held = None                # a first row whose key may not have a second region
        shared = False             # whether the held row's key has been seen with another region
        for batch in batches:
            key, region, doc, mark, place, reach = (batch.column(i).to_numpy() for i in range(6))
            done = reach >= 0
            if done.any():
                yield out(0, key[done], doc[done], mark[done], place[done], reach[done])
                key, region, doc, mark, place, reach = (x[~done] for x in (key, region, doc, mark, place, reach))
            if not len(key):
                continue
            same = np.zeros(len(key), bool)
            same[1:] = (key[1:] == key[:-1]) & (region[1:] == region[:-1])
            same[0] = last is not None and last[:2] == (key[0], region[0])
            begin = np.maximum.accumulate(np.where(same, -1, np.arange(len(key))))
            own = [doc, mark, place]
            least = [x[np.maximum(begin, 0)] for x in own]
            if last is not None:
                least = [np.where(begin >= 0, x, y) for x, y in zip(least, last[2:], strict=True)]
            last = (key[-1], region[-1], *(x[-1] for x in least))
            other = np.zeros(len(key), bool)                    # no repeated row
            for x, y in zip(own, least, strict=True):
                other |= x != y
            left, right = (-reach - 1) // 1024, (-reach - 1) % 1024
            wide = same & other & (left + right >= length)
            yield out(0, key[wide], doc[wide], mark[wide], place[wide] - left[wide], place[wide] + right[wide])
            rows = [x[~same] for x in (key, doc, mark, place, reach)]
            if held is not None:
                rows = [np.concatenate([h, x]) for h, x in zip(held, rows, strict=True)]
            if not len(rows[0]):
                continue
            k = rows[0]
            several = np.zeros(len(k), bool)
            several[1:] = k[1:] == k[:-1]
            several[:-1] |= k[1:] == k[:-1]
            several[0] |= held is not None and shared
            held, shared = [x[-1:] for x in rows], bool(several[-1])
            yield out(1, *[x[:-1][several[:-1]] for x in rows])
        if held is not None and shared:
            yield out(1, *held)

    return run


def _sorted(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys (of so many bits) and their places; keys and places are
    sorted as one number where both fit, which is several times as fast."""
    n = len(keys)
    low = n.bit_length()
    if bits + low > 63:
        by = np.argsort(keys)
        return keys[by], by
    both = np.sort((keys << low) | np.arange(n))
    return both >> low, both & ((1 << low) - 1)


def suffix_ranks(text: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix array of ``text`` (symbols from 1 on, 0 a border unlike any
    other) and the ranks by the first h, 2 h, 4 h, ... symbols."""
    n = len(text)
    used = np.flatnonzero(np.bincount(text, minlength=257))
    code = np.zeros(used[-1] + 1, np.int64)
    code[used] = np.arange(len(used)) if used[0] == 0 else np.arange(1, len(used) + 1)
    bits = int(code.max()).bit_length()
    h = max(1, min(7, (63 - n.bit_length()) // bits))
    sym = np.concatenate([code[text], np.zeros(h, np.int64)])
    key, alive = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(h):
        part = sym[j:n + j] * alive
        key = (key << bits) | part
        alive &= part != 0
    key, by = _sorted(key, bits * h)
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    rank = np.empty(n, np.int64)
    rank[by] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    ended = np.flatnonzero(~alive)             # borders differ: ranked by position
    order = ended[np.argsort(rank[ended], kind="stable")]
    r = rank[order]
    first = np.ones(len(r), bool)
    first[1:] = r[1:] != r[:-1]
    rank[order] = r + np.arange(len(r)) - np.maximum.accumulate(np.where(first, np.arange(len(r)), 0))
    levels = [(h, rank)]
    alone = new & np.append(new[1:], True)
    act = by[~alone]
    act = act[alive[act]]
    while len(act):
        beyond = np.concatenate([rank, np.full(h, -1, np.int64)])[act + h] + 1
        width = n.bit_length()
        key, by = _sorted((rank[act] << width) | beyond, 2 * width)
        act, old = act[by], key >> width
        at = np.arange(len(act))
        new, group = np.ones(len(act), bool), np.ones(len(act), bool)
        new[1:] = key[1:] != key[:-1]
        group[1:] = old[1:] != old[:-1]
        begin = np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        rank = rank.copy()
        rank[act] = old + begin
        act = act[~(new & np.append(new[1:], True))]
        h *= 2
        levels.append((h, rank))
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    return array, levels


class RunIndex:
    """Run-length compressed Burrows-Wheeler transform of a text with the
    suffix array sampled at run borders, and its matching statistics."""

    def __init__(self, text: np.ndarray):
        self.text = text
        self.array, self.levels = suffix_ranks(text)
        bwt = text[self.array - 1]
        border = np.ones(len(text), bool)
        border[1:] = (bwt[1:] != bwt[:-1]) | (bwt[1:] == 0)
        self.runs = np.flatnonzero(border)                     # first row of each run
        self.begin = self.array[self.runs]                     # suffix at a run's begin
        self.end = self.array[self.runs - 1]                   # and at the end of the run before

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of suffixes a and b (unlike ones)."""
        n, out = len(self.text), np.zeros(len(a), np.int64)
        for h, rank in reversed(self.levels):
            x, y = np.minimum(a + out, n - 1), np.minimum(b + out, n - 1)
            out += np.where((rank[x] == rank[y]) & (np.maximum(a, b) + out < n), h, 0)
        for _ in range(self.levels[0][0] - 1):
            x, y = np.minimum(a + out, n - 1), np.minimum(b + out, n - 1)
            out += (self.text[x] == self.text[y]) & (self.text[x] != 0) & (np.maximum(a, b) + out < n)
        return out

    def matches(self) -> np.ndarray:
        """For each position, the length of the match with the suffix just
        before it in the order, streamed from the samples."""
        n = len(self.text)
        begin, end = self.begin[1:], self.end[1:]
        at = np.full(n, -1)
        at[begin] = begin
        length = np.zeros(n, np.int64)
        length[begin] = self.common(begin, end)
        at[self.begin[0]], length[self.begin[0]] = self.begin[0], 0
        here = np.maximum.accumulate(at)
        return np.where(here >= 0, length[here] - (np.arange(n) - here), 0)


def repeated_strings(text: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """Positions of the text whose string of ``length`` also begins at a
    position with a smaller ``place``."""
    index = RunIndex(text)
    row = index.matches()[index.array] >= length               # same string as the row before
    row[0] = False
    first = np.flatnonzero(~row)
    least = np.minimum.reduceat(place[index.array], first)
    again = row.copy()
    again[:-1] |= row[1:]
    at = np.flatnonzero(again)
    least = least[np.searchsorted(first, at, "right") - 1]
    at = index.array[at]
    return at[place[at] > least]


FOUND = pa.schema([("doc", pa.int64()), ("mark", pa.int64()), ("place", pa.int64()), ("reach", pa.int64())])
FOUND_SQL = "doc long, mark long, place long, reach long"


def side_bounds(length: int, gram: int) -> tuple[int, int]:
    """Bytes that strings of the left side have before the gram at least, and
    strings of the right side behind it at least. Every string that holds the
    gram is of one side and of one only."""
    rest = length - gram
    return rest - rest // 2, rest // 2 + 1


def _cut_regions(length: int, gram: int):
    """Of the anchors listed with a text: for each side the bytes that its
    strings can cover. ``place``: where they start; ``head``: bytes of them before
    those that all strings of the side have in common."""
    before, behind = side_bounds(length, gram)
    rest = length - gram
    schema = pa.schema([("side", pa.int32()), ("doc", pa.int64()), ("mark", pa.int64()), ("place", pa.int64()),
                        ("head", pa.int32()), ("region", pa.binary())])

    def run(batches):
        for batch in batches:
            found = batch.column(3)
            row = np.repeat(np.arange(batch.num_rows), np.diff(found.offsets.to_numpy()))
            at, reach = (x.to_numpy() for x in found.flatten().flatten())
            left, right = (-reach - 1) // 1024, (-reach - 1) % 1024
            out = [], [], [], [], []
            for side in (0, 1):
                a = at - (left if side == 0 else np.minimum(left, before - 1))
                b = at + (np.minimum(right, gram + rest - before) if side == 0 else right)
                ok = np.flatnonzero((left >= before if side == 0 else right >= gram + behind) & (b - a >= length))
                start = at[ok] - before if side == 0 else at[ok]
                for o, x in zip(out, (np.full(len(ok), side, np.int32), row[ok], a[ok], b[ok], start - a[ok]), strict=True):
                    o.append(x)
            side, row, a, b, head = (np.concatenate(x) for x in out)
            by = np.argsort(row, kind="stable")
            side, row, a, b, head = (x[by] for x in (side, row, a, b, head))
            regions, text, raw = [], -1, b""
            for i, x, y in zip(row.tolist(), a.tolist(), b.tolist(), strict=True):
                if i != text:
                    text, raw = i, memoryview(batch.column(2)[i].as_buffer())
                regions.append(bytes(raw[x:y]))
            yield pa.RecordBatch.from_arrays([
                pa.array(side), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)),
                pa.array(a), pa.array(head.astype(np.int32)), pa.array(regions, pa.binary())], schema=schema)

    return run


JUDGED = pa.schema([("dealt", pa.int32()), ("key", pa.int64()), *FOUND])
JUDGED_SQL = "dealt int, key long, " + FOUND_SQL


def _index_regions(length: int, group: int):
    """Over rows ``key, doc, mark, place, region`` sorted by key, document and
    place: the spans that rows share with earlier ones of their key, and the
    strings (``dealt = 1``, under their hash) of keys with over ``group`` distinct
    rows."""
    def judged(dealt, key, doc, mark, place, reach):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), dealt, np.int32)), pa.array(key, pa.int64()),
                                           *[pa.array(x, pa.int64()) for x in (doc, mark, place, reach)]], schema=JUDGED)

    def index(rows):
        docs, marks, places = (np.array(x, np.int64) for x in list(zip(*rows, strict=True))[:3])
        size = np.array([len(r[3]) for r in rows])
        raw = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        text = np.zeros(size.sum() + len(size), np.uint16)
        inside = np.arange(len(raw)) + np.repeat(np.arange(len(size)), size)
        text[inside] = raw.astype(np.uint16) + 1
        names, number = np.unique(np.stack([docs, marks]), axis=1, return_inverse=True)
        origin = number.reshape(-1).astype(np.int64) * (1 << PLACES) + places
        place = np.repeat(origin - begin, size + 1) + np.arange(len(text))
        hit = np.unique(place[repeated_strings(text, place, length)])
        if not len(hit):
            return
        at = hit & ((1 << PLACES) - 1)
        row, s, e = spans_of(hit >> PLACES, at, at + length)
        doc = names[:, hit[row] >> PLACES]
        yield judged(0, np.zeros(len(row), np.int64), doc[0], doc[1], s, e)

    def strings(rows):
        """All strings of some rows under their hashes."""
        size = np.array([len(r[3]) for r in rows])
        p, inv = K.prefix_hash(np.frombuffer(b"".join(r[3] for r in rows), np.uint8))
        n = size - length + 1
        of = np.repeat(np.arange(len(rows)), n)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = (np.cumsum(size) - size)[of] + inside
        doc, mark, place = (np.array(x, np.int64)[of] for x in list(zip(*rows, strict=True))[:3])
        place = place + inside
        return judged(1, K.mix((p[at + length] - p[at]) * inv[at]).view(np.int64), doc, mark, place, place + length)

    def run(batches):
        ready, n = [], 0                       # rows of whole keys for the next index, and their bytes
        key, first, dealt, again = None, {}, [], []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for k, *row in zip(*columns, strict=True):
                if k != key:
                    if dealt:
                        yield strings(dealt)
                    elif 1 < len(first) <= group:
                        ready += first.values()
                        n += sum(map(len, first))
                    if n >= INDEX_BYTES:
                        yield from index(ready)
                        ready, n = [], 0
                    key, first, dealt = k, {}, []
                like = first.get(row[3])
                if like is not None:
                    if like[:3] != row[:3]:                       # no repeated row
                        again.append((*row[:3], row[2] + len(row[3])))
                elif len(first) <= group:
                    first[row[3]] = row
                    if len(first) > group:
                        dealt = list(first.values())
                else:
                    dealt.append(row)
                if len(dealt) > group:
                    yield strings(dealt)
                    dealt = []
            if again:
                yield judged(0, np.zeros(len(again), np.int64), *zip(*again, strict=True))
                again = []
        if dealt:
            yield strings(dealt)
        elif 1 < len(first) <= group:
            ready += first.values()
        if ready:
            yield from index(ready)

    return run


def _all_but_first(length: int):
    """Over rows sorted by key, document and place."""
    def run(batches):
        last = None                # key, document and place of the first
        for batch in batches:
            key, *own = (batch.column(i).to_numpy() for i in range(4))
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            if last is not None and len(key) and last[0] == key[0]:
                new[0] = False
            first = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            least = [x[np.maximum(first, 0)] for x in own]
            if last is not None:
                least = [np.where(first >= 0, x, y) for x, y in zip(least, last[1:], strict=True)]
            again = np.zeros(len(key), bool)
            for x, y in zip(own, least, strict=True):
                again |= x != y
            if len(key):
                last = (key[-1], *(x[-1] for x in least))
            doc, mark, place = (x[again] for x in own)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc, mark, place, place + length)], schema=FOUND)

    return run


REMOVED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                     ("kept_sha256", pa.string()), ("kept", pa.binary()), ("starts", pa.list_(pa.int64())),
                     ("ends", pa.list_(pa.int64()))])


def _remove(batches):
    for batch in batches:
        out = [[] for _ in REMOVED]
        for doc, text, found in zip(*(batch.column(i) for i in range(3)), strict=True):
            raw = text.as_buffer().to_pybytes()
            found = found.as_py() or []
            s = np.array([x["place"] for x in found], np.int64)
            e = np.array([x["reach"] for x in found], np.int64)
            _, s, e = spans_of(np.zeros(len(s), int), s, e)
            at = [0, *e.tolist()]
            kept = b"".join(raw[a:b] for a, b in zip(at, [*s.tolist(), len(raw)], strict=True))
            for o, v in zip(out, (doc.as_py(), len(raw), len(raw) - len(kept), len(s),
                                  hashlib.sha256(kept).hexdigest(), kept, s.tolist(), e.tolist()), strict=True):
                o.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(o, f.type) for o, f in zip(out, REMOVED, strict=True)], schema=REMOVED)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
                   group: int = GROUP) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, starts, ends``
    of each row of ``docs``: sizes, the remaining bytes, and the removed runs."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc"),
                       F.xxhash64(whole).alias("mark"), whole.alias("text"))
    dealt = rows.mapInArrow(_anchor_rows(length, gram), ROWS_SQL).repartition("key") \
        .sortWithinPartitions("key", "region", "doc", "mark", "place")
    found = materialise(dealt.mapInArrow(_compare_regions(length),
                                         "open int, key long, doc long, mark long, place long, reach long"))
    asked = found.where("open = 1").groupBy("doc", "mark").agg(F.collect_list(F.struct("place", "reach")).alias("found"))
    before, behind = side_bounds(length, gram)
    width = F.when(F.col("side") == 0, before + gram).otherwise(gram + behind)
    judged = materialise(
        rows.join(asked.hint("shuffle_hash"), ["doc", "mark"]).select("doc", "mark", "text", "found")
        .mapInArrow(_cut_regions(length, gram), "side int, doc long, mark long, place long, head int, region binary")
        .select(F.xxhash64("side", F.substring("region", F.col("head") + 1, width)).alias("key"),
                "doc", "mark", "place", "region")
        .repartition("key").sortWithinPartitions("key", "doc", "mark", "place")
        .mapInArrow(_index_regions(length, group), JUDGED_SQL))
    strings = judged.where("dealt = 1").select("key", "doc", "mark", "place").repartition("key") \
        .sortWithinPartitions("key", "doc", "mark", "place").mapInArrow(_all_but_first(length), FOUND_SQL)
    own = ["doc", "mark", "place", "reach"]
    spans = found.where("open = 0").select(own).unionByName(judged.where("dealt = 0").select(own)).unionByName(strings)
    per = spans.groupBy("doc", "mark").agg(F.collect_list(F.struct("place", "reach")).alias("found"))
    out = rows.join(per.hint("shuffle_hash"), ["doc", "mark"], "left").select("doc", "text", "found") \
        .mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                             "kept binary, starts array<long>, ends array<long>")
    return out.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(LAST)))
