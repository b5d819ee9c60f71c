"""Exact Jaccard join of n-gram sets with vertical partitioning.

A text's set holds the distinct k-word shingles. Two texts link when
``100 * |intersection| >= percent * |union|``. All shingles have one global
order: those known to be frequent last, then by hash.

Candidates. Two linked sets share a shingle among the first
``n - ceil(n * percent / 100) + 1`` of each in that order, so only these are
dealt out; and the first that they share has enough shingles behind it in both
sets, which the positions tell. Texts with equal sets are one class from here
on. First each class is paired with one class that holds such shingles too
(each shingle offers one, by a hash; the one offered most is taken), the pairs
are verified and components formed. Then each is paired with the ``TAKEN``
classes offered most, of other components; now a shingle offers ``OFFERS`` of
the classes that have a link, by another hash. Last, all pairs of classes that
are still in different components are taken. A group of near copies is thus one component,
or nearly, before all pairs are taken, and costs a few pairs a member; no link
between components is missed.

Pruning. A class has a parity bitmap (one bit flip per shingle, at least four
times as many bits as shingles, folded to compare). The bitmaps of two sets differ in
at most as many bits as the sets differ in shingles, which a link bounds, so
a pair whose bitmaps differ in more is none. In the last round the join itself
compares a short bitmap of ``WORDS`` longs that travels with the shingles, so
that most chance pairs never leave it; the bound is the same. The ``BEFORE``
shingles before one of a prefix travel too: a pair that shares one of them is
left to it, so that a pair of many shared shingles leaves the join a few times.

Verification. The order is cut into ``FRAGMENTS`` ranges; each set's part in
a fragment is a segment. The segments of a pair are met fragment by fragment,
their overlaps counted on their own, and summed per pair.

Frequent shingles: those met in at least ``LOCAL`` texts of some batch of a
task and in ``max(FREQUENT, SHARE * texts)`` texts of such batches in all. Any
choice gives the same result; this one is bounded by the mean size of a set
over ``SHARE`` and is sent to all tasks.

Names. A class is named by a 64-bit hash of its set's 128-bit sum, by another
one should two classes have the same; ids only name components in the output.
A class is read by one of its rows: the smallest id, then the smallest hash of
id and text.

Shingles are 53-bit hashes. Defined results: null and empty texts have size 0,
are their own component and link with nothing; a text of fewer than k words is
one shingle; repeated rows give repeated rows of one class; rows of one id with
different texts are different documents; a null id is the largest of all, and a
component without any other has a null name; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reuselens.llm import kernels as K
from reuselens.llm.common import fresh, materialise
from reuselens.llm.components import components
from reuselens.llm.packed import count_keys

SHINGLE = 5
PERCENT = 75
FRAGMENTS = 4
BITS = 53
FREQUENT = 8
LOCAL = 2
SHARE = 4e-5
KEYS = 1 << 20                 # shingles that a counting task holds before it hands them on
OFFERS = 32
TAKEN = 8
WORDS = 8                      # longs of the short bitmap
BEFORE = 4                     # shingles of a class that travel with the next one of its prefix
ROWS = 1000                    # texts of a piece: their number fits above a shingle's bits
BROADCAST_IDS = 1_000_000      # rows (24 bytes each) that may be sent to all tasks
MASK = np.uint64((1 << BITS) - 1)
LATE = np.uint64(1 << BITS)    # marks a frequent shingle
SHIFT = np.uint64(BITS + 1)


class Frequent:
    """Membership in the sorted array of frequent shingles."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys.astype(np.uint64))
        self.may = np.zeros(1 << 23, bool)
        self.may[(self.keys & np.uint64((1 << 23) - 1)).astype(int)] = True

    def __call__(self, h: np.ndarray) -> np.ndarray:
        out = self.may[(h & np.uint64((1 << 23) - 1)).astype(np.int64)]
        at = np.flatnonzero(out)
        if len(at):
            place = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
            out[at] = self.keys[place] == h[at]
        return out


def ordered_sets(data, offsets, frequent: Frequent | None = None, k: int = SHINGLE):
    """The sets of a piece's texts in global order: ``(shingles, bounds)``;
    frequent shingles still carry their mark."""
    words, wb = K.word_hashes(data, offsets)
    h, bounds = K.shingle_hashes(words, wb, k)
    h = h >> np.uint64(64 - BITS)
    if frequent is not None and len(frequent.keys):
        h[frequent(h)] |= LATE
    n = len(offsets) - 1
    text = np.repeat(np.arange(n, dtype=np.uint64), np.diff(bounds))
    key = np.sort((text << SHIFT) | h)
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    bounds = np.searchsorted(key, np.arange(n + 1, dtype=np.uint64) << SHIFT)
    return key & ((np.uint64(1) << SHIFT) - np.uint64(1)), bounds


def prefix_sizes(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return np.where(n > 0, n - -(-n * percent // 100) + 1, 0)


def bitmap_sizes(n: np.ndarray) -> np.ndarray:
    """Bits of a bitmap: the power of two from 64 on that isn't below 4 n."""
    return 64 << np.ceil(np.log2(np.maximum(4 * n, 64) / 64)).astype(int)


def bitmaps(shingles: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    n = np.diff(bounds)
    size = bitmap_sizes(n)
    at = np.concatenate([[0], np.cumsum(size)])
    text = np.repeat(np.arange(len(n)), n)
    bit = (K.mix(shingles & MASK) & (size[text] - 1).astype(np.uint64)).astype(int)
    odd = np.bincount(at[text] + bit, minlength=at[-1]) & 1
    packed = np.packbits(odd.astype(bool))
    return [packed[a // 8:b // 8].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]


def short_bitmaps(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of ``WORDS`` longs for each set: a parity bitmap of fixed size."""
    n, bits = len(bounds) - 1, 64 * WORDS
    text = np.repeat(np.arange(n), np.diff(bounds))
    bit = (K.mix(shingles & MASK) % np.uint64(bits)).astype(int)
    odd = np.bincount(text * bits + bit, minlength=n * bits) & 1
    return np.packbits(odd.astype(bool)).view(np.int64).reshape(n, WORDS)


def differing(a: bytes, b: bytes) -> int:
    """Bits in which two bitmaps differ after the longer is folded."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def frequent_shingles(texts: DataFrame, n_texts: int, n_bytes: int, k: int = SHINGLE) -> np.ndarray:
    def sets(batch):
        for _, data, off in K.utf8_pieces(batch.column(0), rows=ROWS):
            yield ordered_sets(data, off, None, k)[0]

    counted = count_keys(texts.select("text"), sets, max(16, n_bytes // 6 // KEYS), local_least=LOCAL, flush_at=KEYS)
    return counted.where(F.col("n") >= max(FREQUENT, int(SHARE * n_texts))).toArrow()["key"].to_numpy()


SETS = "doc_id long, h long, s1 long, s2 long, n long, bitmap binary, prefix array<long>, words array<long>"


def class_rows(texts: DataFrame, frequent, k: int, percent: int) -> DataFrame:
    """A row per text: id, hash, the set's 128-bit sum, its size, and for one text of
    each set in a batch (the smallest id) its bitmap and prefix."""
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("n", pa.int64()),
                        ("bitmap", pa.binary()), ("prefix", pa.list_(pa.int64())), ("words", pa.list_(pa.int64()))])

    def run(batches):
        known = Frequent(frequent.value)
        for batch in batches:
            for at, data, off in K.utf8_pieces(batch.column(1), rows=ROWS):
                sh, bounds = ordered_sets(data, off, known, k)
                n = np.diff(bounds)
                low = sh & MASK
                sums = []
                for c in (K.M1, K.M2):
                    total = np.concatenate([[np.uint64(0)], np.cumsum(K.mix(low * c + c), dtype=np.uint64)])
                    sums.append(total[bounds[1:]] - total[bounds[:-1]])
                ids = batch.column(0)[at:at + len(n)]
                order = np.lexsort((ids.fill_null(np.iinfo(np.int64).max).to_numpy(), *sums))
                first = np.ones(len(n), bool)
                first[order[1:]] = (sums[0][order][1:] != sums[0][order][:-1]) | (sums[1][order][1:] != sums[1][order][:-1])
                size = np.where(first, prefix_sizes(n, percent), 0)
                lists = np.concatenate([[0], np.cumsum(size)])
                take = np.arange(lists[-1]) - np.repeat(lists[:-1], size) + np.repeat(bounds[:-1], size)
                maps = [m if one and c else None for m, one, c in zip(bitmaps(sh, bounds), first, n, strict=True)]
                words = short_bitmaps(sh, bounds)[first]
                yield pa.RecordBatch.from_arrays([
                    ids, batch.column(2)[at:at + len(n)], pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), pa.array(n.astype(np.int64)),
                    pa.array(maps, pa.binary()),
                    pa.ListArray.from_arrays(lists.astype(np.int32), pa.array(low[take].view(np.int64))),
                    pa.ListArray.from_arrays(np.append(0, np.cumsum(first) * WORDS).astype(np.int32),
                                             pa.array(words.ravel()))], schema=schema)
        K.release_memory()

    return texts.mapInArrow(run, SETS)


def _pruned(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of class ids, with sizes, that their bitmaps leave."""
    side = {x: classes.select(F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("bitmap").alias(f"m_{x}"))
            for x in "ab"}
    rows = pairs.join(side["a"], "a").join(side["b"], "b")

    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            na, nb = t["n_a"].to_numpy(), t["n_b"].to_numpy()
            most = (na + nb) * (100 - percent) // (100 + percent)
            keep = [differing(x.as_py(), y.as_py()) <= d for x, y, d in zip(t["m_a"], t["m_b"], most, strict=True)]
            yield from t.select(["a", "b", "n_a", "n_b"]).filter(pa.array(keep, pa.bool_())).to_batches()

    return rows.select("a", "b", "n_a", "n_b", "m_a", "m_b").mapInArrow(run, "a long, b long, n_a long, n_b long")


def segments(texts: DataFrame, ids: DataFrame, n_ids: int, k: int, fragments: int = FRAGMENTS) -> DataFrame:
    """``cid, fragment, segment`` of the rows ``ids`` (``cid, h, least``: class,
    hash and id of its row)."""
    own = texts.join(F.broadcast(ids) if n_ids <= BROADCAST_IDS else ids, "h")
    schema = pa.schema([("cid", pa.int64()), ("fragment", pa.int32()), ("segment", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            batch = batch.filter(pc.equal(batch.column(2), batch.column(3)))
            for at, data, off in K.utf8_pieces(batch.column(1), rows=ROWS):
                sh, bounds = ordered_sets(data, off, None, k)
                n = len(off) - 1
                text = np.repeat(np.arange(n), np.diff(bounds))
                part = ((sh & MASK) >> np.uint64(BITS - 16)).astype(int) * fragments >> 16
                cut = np.searchsorted(text * fragments + part, np.arange(n * fragments + 1))
                full = np.flatnonzero(np.diff(cut))
                ids = batch.column(0)[at:at + n].to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[full // fragments].astype(np.int64)), pa.array((full % fragments).astype(np.int32)),
                    pa.ListArray.from_arrays(np.append(cut[full], cut[-1]).astype(np.int32),
                                             pa.array((sh & MASK).view(np.int64)))], schema=schema)
        K.release_memory()

    return own.select("cid", "text", "doc_id", "least").mapInArrow(run, "cid long, fragment int, segment array<long>")


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` that link, with their overlap."""
    left = materialise(_pruned(pairs, classes, percent))
    ids = left.select(F.col("a").alias("cid")).unionByName(left.select(F.col("b").alias("cid"))).distinct()
    ids = materialise(classes.select("cid", "h", "least", "times").join(ids, "cid"))
    n_ids, times = ids.agg(F.count("*"), F.max("times")).collect()[0]
    seg = segments(texts, ids.drop("times"), n_ids, k)
    # rows that repeat a class's row repeat its segments
    seg = materialise(seg if (times or 1) == 1 else seg.dropDuplicates(["cid", "fragment"]))
    a = seg.select(F.col("cid").alias("a"), "fragment", F.col("segment").alias("x"))
    b = seg.select(F.col("cid").alias("b"), "fragment", F.col("segment").alias("y"))
    part = left.join(a, "a").join(b, ["b", "fragment"]).select(
        "a", "b", "fragment", "n_a", "n_b", F.size(F.array_intersect("x", "y")).alias("part"))
    both = part.groupBy("a", "b", "n_a", "n_b").agg(F.sum("part").alias("overlap"))
    return both.where(F.col("overlap") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("overlap")) * percent)


def _near(n_a, at_a, n_b, at_b, percent: int):
    """Whether sets of these sizes whose first common shingle is at these
    positions can link."""
    most = F.least(n_a - at_a, n_b - at_b)
    return (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent) \
        & (most * (100 + percent) >= (n_a + n_b) * percent)


def _open(shared: DataFrame, parts: DataFrame | None) -> DataFrame:
    """``token, cid, n, at, part, linked`` of the shingles that classes of
    several components share."""
    if parts is None:
        rows = shared.withColumn("part", F.col("cid")).withColumn("linked", F.lit(True))
    else:
        rows = shared.join(parts, "cid")
    several = rows.groupBy("token").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p < q")
    return materialise(rows.join(several.select("token"), "token"))


def _star_pairs(rows: DataFrame, seed: int, offers: int, taken: int, percent: int) -> DataFrame:
    """``x, y``: for each class, ``taken`` classes of other components that it
    may link with and that most of its shingles offer; a shingle offers the
    first of its linked classes by a hash."""
    nth = F.row_number().over(W.partitionBy("token").orderBy(F.xxhash64(F.lit(seed), "cid"), "cid"))
    hubs = rows.where("linked").withColumn("nth", nth).where(F.col("nth") <= offers) \
        .select("token", *[F.col(c).alias(f"hub_{c}") for c in ("cid", "n", "at", "part")])
    pairs = rows.join(hubs, "token").where((F.col("part") != F.col("hub_part")) & _near(
        F.col("n"), F.col("at"), F.col("hub_n"), F.col("hub_at"), percent))
    offered = pairs.groupBy(F.col("cid").alias("x"), F.col("hub_cid").alias("y")).agg(F.count("*").alias("times"))
    rank = F.row_number().over(W.partitionBy("x").orderBy(F.desc("times"), F.xxhash64(F.lit(seed), "y"), "y"))
    return offered.withColumn("rank", rank).where(F.col("rank") <= taken).select("x", "y")


def _cross_rows(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``x, y``, some more than once: all pairs of classes of different components that may link,
    by their positions and short bitmaps. A shingle leaves out the pairs that
    share one of the ``BEFORE`` shingles before it in both sets: that one makes
    the pair, at smaller positions, or leaves it to one before it in turn."""
    own = W.partitionBy("cid").orderBy("at")
    before = F.array_compact(F.array(*[F.lag("token", i).over(own) for i in range(1, BEFORE + 1)]))
    rows = rows.join(classes.select("cid", "words"), "cid").withColumn("before", before)
    side = {c: rows.select("token", F.col("cid").alias(c),
                           *[F.col(k).alias(f"{k}_{c}") for k in ("n", "at", "part", "words", "before")]) for c in "xy"}
    differ = sum((F.bit_count(F.col("words_x")[i].bitwiseXOR(F.col("words_y")[i])) for i in range(WORDS)), F.lit(0))
    may = (F.col("x") < F.col("y")) & (F.col("part_x") != F.col("part_y")) \
        & _near(F.col("n_x"), F.col("at_x"), F.col("n_y"), F.col("at_y"), percent) \
        & (differ * (100 + percent) <= (F.col("n_x") + F.col("n_y")) * (100 - percent)) \
        & ~F.arrays_overlap("before_x", "before_y")
    return side["x"].join(side["y"], "token").where(may).select("x", "y")


def _named(rows: DataFrame):
    """``(classes, name)`` of rows with shingles: the 128-bit sums with the id
    (``least``) and hash of the class's row, its ``times`` and the name
    (``cid``); and the name as a column of the sums."""
    first = rows.repartition("s1", "s2").groupBy("s1", "s2", "doc_id", "h").agg(F.count("*").alias("times")) \
        .groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "h", "times")).alias("x")) \
        .select("s1", "s2", F.col("x.doc_id").alias("least"), F.col("x.h").alias("h"), F.col("x.times").alias("times"))
    first = materialise(first)
    seed = 0
    while True:
        name = F.xxhash64(F.lit(seed), "s1", "s2")
        if first.groupBy(name.alias("cid")).agg(F.count("*").alias("m")).where("m > 1").isEmpty():
            return first.withColumn("cid", name), name
        seed += 1


def _joined(docs: DataFrame, key: str, text: str, k: int, percent: int, offers: int = OFFERS, taken: int = TAKEN):
    """``(rows, classes, parts, links)``: the rows ``doc_id, h, n, cid`` (null
    without shingles), the classes, ``cid, part`` of all classes (the part is
    named by one of its classes), and the links between classes."""
    last = F.lit((1 << 63) - 1)
    texts = docs.select(F.coalesce(F.col(key).cast("long"), last).alias("doc_id"), F.col(text).cast("string").alias("text"))
    texts = texts.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h"))
    n_texts, n_bytes = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).collect()[0]
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(texts, n_texts, n_bytes, k))
    rows = materialise(class_rows(texts, frequent, k, percent))
    full = rows.where(F.col("n") > 0)
    named, name = _named(full)
    full = full.withColumn("cid", name)
    classes = materialise(full.where(F.col("bitmap").isNotNull()).select("doc_id", "cid", "n", "bitmap", "words")
                          .join(named.select("cid", "least", "h", "times"), "cid").where("doc_id = least")
                          .drop("doc_id").dropDuplicates(["cid"]))
    # classes by shingle of their prefix; a row for each class, whatever its copies
    dealt = full.select("cid", "n", F.posexplode("prefix").alias("at", "token")).repartition("token") \
        .dropDuplicates(["token", "cid"])
    crowd = dealt.groupBy("token").agg(F.count("*").alias("m")).where("m > 1").select("token")
    shared = materialise(dealt.join(crowd, "token").select("token", "cid", "n", "at"))
    links, part_of = None, None
    for star in ((0, 1, 1), (1, offers, taken), None):
        open_ = _open(shared, part_of)
        pairs = _star_pairs(open_, *star, percent) if star else _cross_rows(open_, classes, percent)
        pairs = materialise(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        more = verified(pairs, classes, texts, k, percent).select("a", "b", "overlap")
        links = materialise(more if links is None else links.unionByName(more))
        parts = materialise(components(links))
        part_of = named.select("cid").join(parts, F.col("cid") == F.col("node"), "left").select(
            "cid", F.coalesce("component", "cid").alias("part"), F.col("component").isNotNull().alias("linked"))
    rows = rows.select("doc_id", "h", "n", F.when(F.col("n") > 0, name).alias("cid"))
    return rows, named, part_of.select("cid", "part"), links


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE,
                 percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """``(documents, links)``: ``doc_id, n_shingles, component_id`` of each row
    of ``docs``, and the verified links ``a, b, overlap`` between classes
    (given by their smallest ids); links within a component that is
    connected already may be missing."""
    rows, named, parts, links = _joined(docs, key, text, k, percent)
    real = lambda c: F.nullif(c, F.lit((1 << 63) - 1))
    ids = named.select("cid", "least")
    least = parts.join(ids, "cid").groupBy("part").agg(F.min("least").alias("component"))
    out = rows.join(parts.join(least, "part").select("cid", "component"), "cid", "left").select(
        real(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"),
        real(F.coalesce("component", "doc_id")).alias("component_id"))
    shown = links.join(ids.select(F.col("cid").alias("a"), F.col("least").alias("x")), "a") \
        .join(ids.select(F.col("cid").alias("b"), F.col("least").alias("y")), "b") \
        .select(real(F.least("x", "y")).alias("a"), real(F.greatest("x", "y")).alias("b"), "overlap")
    return out, shown


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", offers: int = 2 * OFFERS,
                taken: int = 2 * TAKEN) -> DataFrame:
    """One row, all columns, of each component of ``docs``: the smallest id,
    then the smallest hash of id and text. More offers than in the join leave
    fewer pairs to the last round; the components are the same."""
    rows, named, parts, _ = _joined(docs, key, text, SHINGLE, PERCENT, offers, taken)
    name, mark, many = fresh(docs, "stay", "mark", "many")
    last = F.lit((1 << 63) - 1)
    first = parts.join(named.select("cid", "least", "h", "times"), "cid").groupBy("part") \
        .agg(F.min(F.struct("least", "h", "times")).alias("x"))
    stay = first.select(F.col("x.least").alias(name), F.col("x.h").alias(mark), (F.col("x.times") > 1).alias(many)) \
        .unionByName(rows.where("n = 0").select(F.col("doc_id").alias(name), F.col("h").alias(mark),
                                                F.lit(False).alias(many)).distinct())
    stay = materialise(stay)
    own = F.coalesce(F.col(key).cast("long"), last)
    same = (own == F.col(name)) & (F.xxhash64(own, F.col(text).cast("string")) == F.col(mark))
    out = docs.join(stay.where(~F.col(many)), same, "left_semi")
    again = stay.where(many)
    if again.isEmpty():
        return out
    return out.unionByName(docs.join(again, same).dropDuplicates([name, mark]).select(*docs.columns))
