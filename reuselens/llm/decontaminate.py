"""Benchmark passages in documents by SimHash of item-sized windows.

A window of a document has as many words as an item (cut at the text's ends)
and is described by its 5-word shingles, weighted by how often each occurs.
Its SimHash has 128 bits: the signs of the weighted sums of the shingles' hash
bits, taken from running sums, so that every start is fingerprinted at the
cost of one. Only windows that hold at least one shingle of an item of their
length are fingerprinted; any other has similarity 0 with all of them.

Fingerprints meet block by block: of ``BLOCKS`` blocks, a pair within
``RADIUS`` bits has one with at most the block's own allowance (the allowances
add up to ``RADIUS - BLOCKS + 1``), so comparing blocks first loses no pair
within the radius; a window is compared with all items of its length in turn. Where no shingle repeats, fingerprints at the similarity threshold
differ in 22 bits on average (standard deviation 4.3); the radius lies four
deviations above. A shingle that repeats within the window or the item can
decide most signs, so such pairs are not held against the radius: all whose
window has enough shingles of the item, repeats counted, to reach the
threshold are candidates. Candidates are verified by the exact weighted Jaccard similarity
(sum of minima over sum of maxima) of at least ``SIMILARITY``.

The benchmark is the stated query set: it is counted and goes to the tasks in
blocks of about ``BLOCK_BYTES`` of text, one pass over the documents a block.

Defined results: null and empty items and texts match nothing; an item of
fewer than five words matches where its whole sequence occurs; items with
equal texts and repeated documents are all reported; for each document and
item the most similar window, of equals the first, is reported.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reuselens.llm import kernels as K

SHINGLE = 5
SIMILARITY = 0.75
BLOCKS = 8                       # of 16 bits
RADIUS = 40
ALLOWED = np.array([5, 4, 4, 4, 4, 4, 4, 4])
BLOCK_BYTES = 4_000_000
STARTS = 4096                    # windows fingerprinted at once


def spread_bits(shingles: np.ndarray) -> np.ndarray:
    """-1 or 1 for each of the 128 hash bits of each shingle."""
    halves = np.stack([K.mix(shingles * K.M1 + np.uint64(1)), K.mix(shingles * K.M2 + np.uint64(2))], axis=1)
    return np.unpackbits(halves.view(np.uint8).reshape(len(shingles), 16), axis=1).astype(np.int8) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """Blocks (16 bits each) of the signs of weighted sums."""
    return np.packbits(sums > 0, axis=1).view(np.uint16)


def within(windows: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Which windows and items (rows of blocks) are within the radius."""
    out = np.zeros((len(windows), len(items)), bool)
    for j in range(len(items)):
        apart = np.bitwise_count(windows ^ items[j])
        near = np.flatnonzero((apart <= ALLOWED).any(axis=1))
        out[near[apart[near].sum(axis=1, dtype=int) <= RADIUS], j] = True
    return out


def repeats(shingles: np.ndarray) -> np.ndarray:
    """For each start, where the first shingle stands that repeats one from
    there on (beyond the end: none)."""
    order = np.argsort(shingles, kind="stable")
    same = shingles[order[1:]] == shingles[order[:-1]]
    out = np.full(len(shingles) + 1, len(shingles) + 1)
    out[order[:-1][same]] = order[1:][same]
    return np.minimum.accumulate(out[::-1])[::-1]


class Items:
    """Index of a block of items: ``ids`` and ``texts``."""

    def __init__(self, ids, texts):
        column = pa.array(texts, pa.string())
        self.ids, self.words, self.sets, self.short = [], [], [], {}
        at = 0
        for _, data, off in K.utf8_pieces(column):
            words, wb = K.word_hashes(data, off)
            sh, sb = K.shingle_hashes(words, wb, SHINGLE)
            for i in range(len(off) - 1):
                own, n = sh[sb[i]:sb[i + 1]], int(wb[i + 1] - wb[i])
                if 0 < n < SHINGLE:
                    self.short.setdefault(n, {}).setdefault(int(own[0]), []).append(ids[at])
                elif n:
                    self.ids.append(ids[at])
                    self.words.append(n)
                    self.sets.append(np.unique(own, return_counts=True))
                at += 1
        self.words = np.array(self.words, int)
        self.weighted = np.array([c.max() > 1 for _, c in self.sets], bool)   # items with a repeated shingle
        self.prints = np.stack([fingerprints((spread_bits(s) * c[:, None]).sum(axis=0, dtype=np.int64)[None])[0]
                                for s, c in self.sets]) if self.sets else np.zeros((0, BLOCKS), np.uint16)
        keys = np.concatenate([s for s, _ in self.sets]) if self.sets else np.zeros(0, np.uint64)
        of = np.repeat(np.arange(len(self.sets)), [len(s) for s, _ in self.sets]).astype(int)
        order = np.argsort(keys, kind="stable")
        self.keys, first = np.unique(keys[order], return_index=True)
        self.of, self.first = of[order], np.append(first, len(keys))
        self.may = np.zeros(1 << 20, bool)
        self.may[(self.keys >> np.uint64(44)).astype(int)] = True

    def seeds(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the shingles that some item has, and which of ``keys``."""
        at = np.flatnonzero(self.may[(shingles >> np.uint64(44)).astype(np.int64)])
        if not len(at):
            return at, at
        place = np.minimum(np.searchsorted(self.keys, shingles[at]), len(self.keys) - 1)
        hit = self.keys[place] == shingles[at]
        return at[hit], place[hit]

    def similarities(self, item: int, shingles, starts, ends) -> np.ndarray:
        """Weighted Jaccard of the item and each window ``[start, end)``."""
        keys, counts = self.sets[item]
        place = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
        one = np.zeros((len(shingles) + 1, len(keys)), np.int32)
        at = np.flatnonzero(keys[place] == shingles)
        one[at + 1, place[at]] = 1
        np.cumsum(one, axis=0, out=one)
        same = np.minimum(one[ends] - one[starts], counts).sum(axis=1)
        return same / (ends - starts + counts.sum() - same)

    def matches(self, shingles: np.ndarray, at: np.ndarray, key: np.ndarray) -> list[tuple]:
        """``(item, similarity, first word, words)`` of a text with these seeds."""
        size = self.first[key + 1] - self.first[key]
        pos = np.repeat(at, size)
        item = self.of[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.first[key], size)]
        best: dict[int, tuple] = {}
        again = repeats(shingles)
        for n_words in np.unique(self.words[item]):
            own, held = pos[self.words[item] == n_words], item[self.words[item] == n_words]
            by = np.lexsort((own, held))
            seeded, cut = np.unique(held[by], return_index=True)
            places = dict(zip(seeded.tolist(), np.split(own[by], cut[1:]), strict=True))
            length = int(n_words) - SHINGLE + 1
            flag = np.zeros(len(shingles) + length + 1, int)   # windows that hold a seed, by start + length - 1
            np.add.at(flag, own, 1)
            np.add.at(flag, own + length, -1)
            start = np.flatnonzero(np.cumsum(flag) > 0) - (length - 1)
            start = start[start < len(shingles)]
            same = np.flatnonzero(self.words == n_words)
            cuts = np.flatnonzero(np.diff(start) > STARTS) + 1
            for run in np.split(start, cuts):
                for i in range(0, len(run), STARTS):
                    s = np.maximum(run[i:i + STARTS], 0)
                    e = np.minimum(run[i:i + STARTS] + length, len(shingles))
                    low = s[0]
                    region = shingles[low:e[-1]]
                    sums = np.concatenate([np.zeros((1, 128), np.int32),
                                           np.cumsum(spread_bits(region), axis=0, dtype=np.int32)])
                    near = within(fingerprints(sums[e - low] - sums[s - low]), self.prints[same])
                    repeated = again[s] < e
                    for j, x in enumerate(same.tolist()):
                        if x in places and (self.weighted[x] or repeated.any()):
                            hits = np.searchsorted(places[x], e) - np.searchsorted(places[x], s)
                            enough = hits * (1 + SIMILARITY) >= SIMILARITY * (e - s + length)
                            near[:, j] |= enough & (repeated | self.weighted[x])
                    for j in np.flatnonzero(near.any(axis=0)):
                        w = np.flatnonzero(near[:, j])
                        sim = self.similarities(int(same[j]), region, s[w] - low, e[w] - low)
                        top = int(np.argmax(sim))
                        if sim[top] >= SIMILARITY and (int(same[j]) not in best or sim[top] > best[int(same[j])][0]):
                            best[int(same[j])] = (float(sim[top]), int(s[w[top]]),
                                                  int(e[w[top]] - s[w[top]]) + SHINGLE - 1)
        return [(self.ids[i], *b) for i, b in sorted(best.items())]

    def search(self, column):
        """``(row, item, similarity, first word, words)`` of a string column."""
        for row, data, off in K.utf8_pieces(column):
            words, wb = K.word_hashes(data, off)
            sh, sb = K.shingle_hashes(words, wb, SHINGLE)
            if len(self.keys):
                at, key = self.seeds(sh)
                text = np.searchsorted(sb, at, "right") - 1
                cut = np.searchsorted(text, np.arange(len(off)))
                for i in np.flatnonzero(np.diff(cut)):
                    part = slice(cut[i], cut[i + 1])
                    for m in self.matches(sh[sb[i]:sb[i + 1]], at[part] - sb[i], key[part]):
                        yield row + int(i), *m
            for n, items in self.short.items():
                if len(words) < n:
                    continue
                h = words[:len(words) - n + 1]
                for j in range(1, n):
                    h = K.mix(h * K.BASE + words[j:len(words) - n + 1 + j])
                h = K.mix(h ^ np.uint64(n))
                at = np.flatnonzero(np.isin(h, np.array(list(items), np.uint64)))
                text = np.searchsorted(wb, at, "right") - 1
                ok = at + n <= wb[text + 1]
                seen = set()
                for i, p in zip(text[ok], at[ok], strict=True):
                    for item in items[int(h[p])]:
                        if (i, item) not in seen:
                            seen.add((i, item))
                            yield row + int(i), item, 1.0, int(p - wb[i]), n


def item_blocks(benchmark: DataFrame, key: str = "item_id", text: str = "text"):
    """The benchmark as broadcast indexes of about ``BLOCK_BYTES`` each."""
    items = benchmark.select(F.col(key).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")) \
        .where(F.col("text").isNotNull())
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).collect()[0][0]
    n = max(1, -(-size // BLOCK_BYTES))
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).orderBy("item_id", "text").collect()
        if rows:
            yield benchmark.sparkSession.sparkContext.broadcast(
                Items([r["item_id"] for r in rows], [r["text"] for r in rows]))


FOUND = "doc_id long, item_id long, similarity double, first_word long, n_words long"


def find_items(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, item_id, similarity, first_word, n_words``: a row for each
    document and benchmark item that it holds."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = None
    for block in item_blocks(benchmark):
        def run(batches, block=block):
            for batch in batches:
                found = list(block.value.search(batch.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([f[0] for f in found], pa.int64())),
                     pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.float64()),
                     pa.array([f[3] for f in found], pa.int64()), pa.array([f[4] for f in found], pa.int64())],
                    names=["doc_id", "item_id", "similarity", "first_word", "n_words"])

        part = rows.mapInArrow(run, FOUND)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else rows.sparkSession.createDataFrame([], FOUND)


def without_items(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item."""
    for block in item_blocks(benchmark):
        def run(batches, block=block, at=docs.columns.index(text)):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[f[0] for f in block.value.search(batch.column(at))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
