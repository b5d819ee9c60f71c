"""Similar pairs by MinHash banding (J2, J3): candidates without a full join.

A signature is cut into bands, and only documents with an equal band are
compared. Two signatures that agree in at least ``e`` of ``h`` positions differ
in ``h - e`` at most, so of ``h - e + 1`` bands one holds no difference: with
that many bands no pair is lost, whatever the documents are.

Equal signatures are one class (a group of copies is one row), known by its
smallest id. A bucket (band, hash) with more than ``HOT`` classes is cut into
parts by a hash, and each pair of parts is a bucket of its own, so a task holds
two parts at most and every pair still meets once. Candidates are numbers only;
their signatures are joined on to count the equal positions exactly.

Where two documents meet, ``BITS`` low bits of each position are compared first:
equal positions have equal bits, so a pair with at least ``e`` equal positions
differs in ``BITS * (h - e)`` bits at most. Others (unrelated documents differ in
about half of all bits) are left out there and never written or shuffled.

Empty documents (no shingles) are one class without a pair. A null id counts
as larger than all; equal hashes of different bands only add candidates.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reuselens.operators.minhash import NUM_HASHES, SENTINEL
from reuselens.session import cut_lineage

HOT = 2048                   # classes of a bucket that are compared as they are
BITS = 4                     # of a position, compared before the signatures are


def bands(least_equal: int, num_hashes: int = NUM_HASHES) -> list[tuple[int, int]]:
    """``(first position from 1, length)`` of bands that lose no pair with
    ``least_equal`` equal positions or more."""
    n = num_hashes - least_equal + 1
    if not 1 <= n <= num_hashes:
        raise ValueError("least_equal must be from 1 to the number of hash functions")
    ends = [num_hashes * (i + 1) // n for i in range(n)]
    return [(b + 1, e - b) for b, e in zip([0, *ends], ends, strict=False)]


def signature_classes(sigs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``cid, doc_id, n, signature``: a row for each distinct signature, its
    smallest id and its documents; written once."""
    rows = sigs.select(F.col(key).cast("long").alias("doc_id"), "signature").where(F.col("signature")[0] != SENTINEL)
    return cut_lineage(rows.groupBy("signature").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
                       .withColumn("cid", F.monotonically_increasing_id()))


def sketch(num_hashes: int = NUM_HASHES) -> list:
    """Columns with the low bits of all positions, 64 bits each."""
    per = 64 // BITS
    put = lambda acc, m: F.shiftleft(acc, BITS).bitwiseOR(m.bitwiseAND(F.lit((1 << BITS) - 1)))
    return [F.aggregate(F.slice("signature", at + 1, per), F.lit(0).cast("bigint"), put).alias(f"k{at // per}")
            for at in range(0, num_hashes, per)]


def candidates(classes: DataFrame, least_equal: int, num_hashes: int = NUM_HASHES, hot: int = HOT, compare: bool = False) -> DataFrame:
    """``a, b`` (``cid``): the pairs of classes that share a band; with
    ``compare`` without those whose bits say that too few positions are equal."""
    cut = [F.struct(F.lit(i).alias("band"), F.xxhash64(F.lit(i), F.slice("signature", at, n)).alias("h"))
           for i, (at, n) in enumerate(bands(least_equal, num_hashes))]
    words = sketch(num_hashes) if compare else []
    names = [f"k{i}" for i in range(len(words))]
    rows = classes.select("cid", *words, F.explode(F.array(*cut)).alias("x")).select("cid", *names, "x.band", "x.h")
    crowd = rows.groupBy("band", "h").agg(F.count("*").alias("m")).where("m > 1")
    parts = F.ceil(F.col("m") / F.lit(hot)).cast("int")
    shared = rows.join(crowd, ["band", "h"]).select("cid", *names, "band", "h", parts.alias("parts")) \
        .withColumn("own", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    left = shared.withColumn("j", F.explode(F.sequence("own", F.col("parts") - 1))) \
        .select("band", "h", F.col("own").alias("i"), "j", F.col("cid").alias("a"), *names)
    right = shared.withColumn("i", F.explode(F.sequence(F.lit(0), "own"))) \
        .select("band", "h", "i", F.col("own").alias("j"), F.col("cid").alias("b"), *[F.col(x).alias(f"o{x}") for x in names])
    met = left.join(right, ["band", "h", "i", "j"]).where((F.col("i") != F.col("j")) | (F.col("a") < F.col("b")))
    if names:
        apart = reduce(add, [F.bit_count(F.col(x).bitwiseXOR(F.col(f"o{x}"))) for x in names])
        met = met.where(apart <= BITS * (num_hashes - least_equal))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar_signatures(sigs: DataFrame, least_equal: int, key: str = "doc_id", num_hashes: int = NUM_HASHES,
                       hot: int = HOT) -> DataFrame:
    """``doc_id, other_id, sim, n_docs, n_others``: the pairs of classes whose
    signatures agree in at least ``least_equal`` positions, by their smallest
    ids (the smaller first), and the documents of either."""
    classes = signature_classes(sigs, key)
    side = {x: classes.select(F.col("cid").alias(x), F.col("doc_id").alias(f"d_{x}"), F.col("n").alias(f"n_{x}"), F.col("signature").alias(f"s_{x}"))
            for x in "ab"}
    equal = F.aggregate(F.zip_with("s_a", "s_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda acc, x: acc + x)
    pairs = candidates(classes, least_equal, num_hashes, hot, compare=True).join(side["a"], "a").join(side["b"], "b") \
        .withColumn("equal", equal).where(F.col("equal") >= least_equal)
    swap = F.coalesce(F.col("d_a") > F.col("d_b"), F.col("d_a").isNull())
    one = lambda x, y, name: F.when(swap, F.col(y)).otherwise(F.col(x)).alias(name)
    return pairs.select(one("d_a", "d_b", "doc_id"), one("d_b", "d_a", "other_id"),
                        (F.col("equal") / F.lit(float(num_hashes))).alias("sim"),
                        one("n_a", "n_b", "n_docs"), one("n_b", "n_a", "n_others"))
