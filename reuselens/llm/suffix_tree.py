"""Language-model scores by a probabilistic suffix tree over words.

Symbols are lower-cased words and one end per text.  The root gives add-one
probabilities ``(c + 1) / (N + V + 1)`` over the whole training vocabulary,
one share being that of all unseen words.  A context of up to ``MAX_DEPTH``
words is a candidate when it is frequent enough, and stays in the tree when
its next-symbol distribution diverges from that of its longest suffix in the
tree: the log-likelihood ratio of its training continuations is held against
the upper end of a chi-square distribution.  Next-symbol counts are smoothed
by absolute discounting; the mass taken goes to the parent's distribution, so
each state's probabilities add up to 1.  A text is scored symbol by symbol
from the longest state that ends before the symbol.

Counting: a string counts from ``LEAST`` occurrences on, whatever the size of
the corpus.  Where no more than ``ENTRIES`` strings of a length can occur so
often (texts of 2 x ``LEAST`` x ``ENTRIES`` bytes), there is one pass over the texts per
length: a string can be frequent only if both its first and its last part are,
so a pass counts just the strings whose parts have passed, as pairs of ranks,
and the tree is sent to the tasks (16 bytes a string).  The vocabulary has no
bound and is never sent: occurrences of rarer words are joined with it by
shuffle.  Larger corpora go by ``suffix_shuffle``, which builds the same tree
and looks its strings up by shuffle.

Defined results: null and empty texts are the end alone; without training
texts ``N = V = 0`` and every symbol has probability 1; a null id is training;
repeated rows give repeated rows and count as often.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reuselens.llm import kernels as K
from reuselens.llm import suffix_shuffle
from reuselens.llm.common import materialise
from reuselens.llm.packed import BUCKET_KEYS, count_keys

MAX_DEPTH = 2
ENTRIES = 4_000_000
LEAST = 2
DISCOUNT = 0.75
END = np.uint64(0x5EED0E4D0F7E4713)
LOG10 = math.log(10)


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end after each text: ``(symbols, bounds)``."""
    words, bounds = K.word_hashes(data, offsets)
    n = len(offsets) - 1
    out = np.full(len(words) + n, END, np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(bounds))] = words
    return out, bounds + np.arange(n + 1)


def find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in the sorted table, -1 if it isn't there."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def rank_strings(tables: list[np.ndarray], syms: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """For each length, the rank of the string that ends at each symbol (-1:
    not in its table, or it would begin before the text)."""
    ranks = [find(tables[0], syms)]
    starts = np.zeros(len(syms), bool)
    starts[bounds[:-1]] = True
    for table in tables[1:]:
        key, ok = pair_keys(ranks[0], ranks[-1], starts)
        r = np.full(len(syms), -1)
        at = np.flatnonzero(ok)
        r[at] = find(table, key[at])
        ranks.append(r)
    return ranks


def pair_keys(first: np.ndarray, longest: np.ndarray, starts: np.ndarray):
    """Keys of the strings one symbol longer: rank of the string before a
    symbol and rank of the symbol; and where both parts are ranked."""
    before = np.concatenate([[-1], longest[:-1]])
    ok = (before >= 0) & (longest >= 0) & ~starts
    return (before.astype(np.uint64) << np.uint64(32)) | first.astype(np.uint64), ok


class Tree:
    """States and probabilities, from the counted strings of each length."""

    def __init__(self, tables, counts, n_tokens, n_distinct, discount=DISCOUNT):
        self.tables = tables
        z = n_tokens + n_distinct + 1
        self.log_z = math.log(z)
        self.log_p = [np.log(counts[0] + 1.0) - self.log_z]   # of the last symbol after the rest, by string
        self.log_rest = []                                    # mass left to the parent, by context; nan: no state
        suffix = [np.zeros(len(tables[0]), int)]              # rank of the string without its first symbol
        for n in range(1, len(tables)):
            context = (tables[n] >> np.uint64(32)).astype(int)
            word = (tables[n] & np.uint64(0xFFFFFFFF)).astype(int)
            if n == 1:
                shorter = word
            else:
                key = (suffix[n - 1][context].astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)
                shorter = find(tables[n - 1], key)
            suffix.append(shorter)
            c, total = counts[n].astype(float), counts[n - 1].astype(float)
            size = len(total)
            kinds = np.bincount(context, minlength=size)
            seen = np.bincount(context, weights=c, minlength=size)
            rest = np.maximum(1 - (seen - discount * kinds) / np.maximum(total, 1), 1e-12)
            parent = self.log_p[n - 1][shorter]
            p = np.log((c - discount) / total[context] + rest[context] * np.exp(parent))
            gain = np.bincount(context, weights=c * (p - parent), minlength=size) + (total - seen) * np.log(rest)
            keep = (kinds > 0) & (2 * gain > kinds + 3.1 * np.sqrt(2.0 * kinds) + 4)
            self.log_rest.append(np.where(keep, np.log(rest), np.nan))
            self.log_p.append(np.where(keep[context], p, parent))

    @property
    def states(self) -> list[int]:
        return [int((~np.isnan(x)).sum()) for x in self.log_rest]

    def gains(self, syms: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(rank, log P(symbol | state) - log P(symbol | root))`` of each symbol."""
        ranks = rank_strings(self.tables, syms, bounds)
        out = np.zeros(len(syms))
        first = ranks[0]
        root = np.where(first >= 0, self.log_p[0][np.maximum(first, 0)], 0.0) if len(self.log_p[0]) else out
        starts = np.zeros(len(syms), bool)
        starts[bounds[:-1]] = True
        for n, rest in enumerate(self.log_rest):
            if not len(rest):
                continue
            before = np.concatenate([[-1], ranks[n][:-1]])
            left = np.where((before >= 0) & ~starts, rest[np.maximum(before, 0)], np.nan)
            state = ~np.isnan(left)
            out[state] += left[state]
            hit = state & (ranks[n + 1] >= 0)
            out[hit] = self.log_p[n + 1][ranks[n + 1][hit]] - root[hit]
        return first, out


def _buckets(n_keys: int) -> int:
    return max(16, -(-n_keys // BUCKET_KEYS))


def learn(docs: DataFrame, max_depth: int = MAX_DEPTH, least: int = LEAST):
    """``(tree, counts of the ranked words, vocabulary, N, V)`` of ``docs`` (``text``),
    which must be few enough for a tree in one task. The vocabulary is a table
    ``key, n`` of all words."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).collect()[0]
    guess = size[0] // 6 + size[1]             # tokens, for the number of buckets alone

    def words(batch):
        for _, data, off in K.utf8_pieces(batch.column(0)):
            yield symbols(data, off)[0]

    vocabulary = materialise(count_keys(texts, words, _buckets(guess // 4)))
    n, v = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).collect()[0]

    def table(counted: DataFrame):
        """At most ``N / least`` rows, for their counts add up to N at most."""
        got = counted.where(F.col("n") >= least).toArrow()
        key, count = got["key"].to_numpy().view(np.uint64), got["n"].to_numpy()
        order = np.argsort(key)
        return key[order], count[order]

    key, count = table(vocabulary)
    tables, counts = [key], [count]
    for _ in range(max_depth):
        sent = docs.sparkSession.sparkContext.broadcast(tables)

        def strings(batch, sent=sent):
            for _, data, off in K.utf8_pieces(batch.column(0)):
                syms, bounds = symbols(data, off)
                ranks = rank_strings(sent.value, syms, bounds)
                starts = np.zeros(len(syms), bool)
                starts[bounds[:-1]] = True
                keys, ok = pair_keys(ranks[0], ranks[-1], starts)
                yield keys[ok]

        key, count = table(count_keys(texts, strings, _buckets(guess // 2 ** len(tables)), least))
        tables.append(key)
        counts.append(count)
    return Tree(tables, counts, n, v), counts[0], vocabulary, n, v


def score_texts(docs: DataFrame, train: Column, max_depth: int = MAX_DEPTH, entries: int = ENTRIES,
                least: int = LEAST) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    n_in_state`` of each row of ``docs`` (``doc_id, text``); ``train``: the rows
    to learn from. Scores are log10 probabilities; ``n_in_state`` counts the
    symbols scored from a context. From where more than ``entries`` strings of a
    length can occur ``least`` times, they are looked up by shuffle."""
    size, texts = docs.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0)), F.count("*")).first()
    if size // 2 + 2 * texts > least * entries:    # words and ends, at most
        return suffix_shuffle.score_texts(docs, train, symbols, size // 6 + texts, max_depth, least, DISCOUNT)
    tree, counts, vocabulary, n, v = learn(docs.where(train), max_depth, least)
    sent = docs.sparkSession.sparkContext.broadcast((tree, np.log10(counts + 1.0)))
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
                        ("n_tokens", pa.int64()), ("n_ranked", pa.int64()), ("ranked", pa.float64()),
                        ("gain", pa.float64()), ("n_in_state", pa.int64()),
                        ("rare", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])

    def run(batches):
        tree, logs = sent.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at, data, off in K.utf8_pieces(batch.column(2)):
                syms, bounds = symbols(data, off)
                first, gain = tree.gains(syms, bounds)
                known = first >= 0
                size = np.diff(bounds)
                texts = len(size)
                of = np.repeat(np.arange(texts), size)
                level = np.where(known, logs[np.maximum(first, 0)], 0.0) if len(logs) else np.zeros(len(syms))

                def total(x, of=of, texts=texts):
                    return np.bincount(of, weights=x, minlength=texts)

                rare = np.flatnonzero(~known)
                order = rare[np.lexsort((syms[rare], of[rare]))]
                s, t = syms[order], of[order]
                new = np.ones(len(s), bool)
                new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
                begin = np.flatnonzero(new)
                times = np.diff(np.append(begin, len(s)))
                lists = np.searchsorted(t[begin], np.arange(texts + 1)).astype(np.int32)
                rows = slice(at, at + texts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row + np.arange(texts)), batch.column(0)[rows], batch.column(1)[rows],
                    pa.array(size.astype(np.int64)), pa.array(total(known).astype(np.int64)), pa.array(total(level)),
                    pa.array(total(gain)), pa.array(total(gain != 0).astype(np.int64)),
                    pa.ListArray.from_arrays(lists, pa.array(s[begin].view(np.int64))),
                    pa.ListArray.from_arrays(lists, pa.array(times.astype(np.int32)))], schema=schema)
                row += texts

    rows = materialise(docs.select(F.col("doc_id").cast("long"), (~train).alias("held_out"),
                                   F.col("text").cast("string")).mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, n_ranked long, ranked double, gain double, "
             "n_in_state long, rare array<long>, times array<int>"))
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")) \
        .select("row", F.col("x.rare").alias("key"), F.col("x.times").alias("times"))
    seen = rare.join(vocabulary, "key").groupBy("row").agg(
        F.sum("times").alias("n_rare"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("rare_level"))
    base = F.col("ranked") + F.coalesce("rare_level", F.lit(0.0)) - F.col("n_tokens") * F.lit(tree.log_z / LOG10)
    return rows.join(seen, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_ranked") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"), base.alias("base_score"),
        (base + F.col("gain") / F.lit(LOG10)).alias("score"), "n_in_state")
