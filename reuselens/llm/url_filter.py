"""URL filter: a blocked Bloom filter in front of an exact hash join.

The list holds canonical URLs ``host + path`` with a verdict each. An entry
fits its host and all subdomains when the page's path starts with the entry's
path; the longest fitting entry decides, then the smallest by code point.

A page's possible entries are its host's suffixes at label borders joined with
the beginnings of its path that are as long as some listed path.  The filter
has blocks of eight 64-bit words; a key sets one bit in each word of one
block, so one block row answers a key.  Keys that pass are joined with the
list itself, which removes false positives.  Blocks and list are broadcast
only when the counted list is at most ``BROADCAST_ROWS`` long; a longer list
is joined by shuffle on block and key.  Only DataFrame functions are used.

Defined results: a null URL, or one without ``://``, has an empty host and
path and no rule; nothing listed gives ``default``; a listed key that occurs
twice is blocked if one of its rows says so; repeated pages give repeated
rows; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
WORDS = 8
BROADCAST_ROWS = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _bits(key: Column, n_blocks: int) -> tuple[Column, list[Column]]:
    """The key's block and its bit in each word."""
    block = F.pmod(F.xxhash64(key), F.lit(n_blocks))
    other = F.xxhash64(key, F.lit("bits"))
    return block, [F.shiftrightunsigned(other, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def bloom_blocks(keys: DataFrame, n_blocks: int) -> DataFrame:
    """``block, w0 .. w7`` of the keys in column ``key``."""
    block, bits = _bits(F.col("key"), n_blocks)
    return keys.select(block.alias("block"), *[_bit(b).alias(f"w{i}") for i, b in enumerate(bits)]) \
        .groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def passes(rows: DataFrame, blocks: DataFrame, n_blocks: int, small: bool) -> DataFrame:
    """The rows whose ``key`` may be listed."""
    block, bits = _bits(F.col("key"), n_blocks)
    rows = rows.withColumn("block", block)
    hit = None
    for i, b in enumerate(bits):
        one = F.col(f"w{i}").bitwiseAND(_bit(b)) != 0
        hit = one if hit is None else hit & one
    return rows.join(F.broadcast(blocks) if small else blocks, "block").where(hit) \
        .drop("block", *[f"w{i}" for i in range(WORDS)])


def filter_urls(pages: DataFrame, listed: DataFrame, default: str = "allow",
                key: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages``.

    ``listed``: ``host, path, verdict``.
    """
    listed = listed.select(F.concat("host", "path").alias("key"), F.col("path").alias("l_path"),
                           F.col("host").alias("l_host"), F.col("verdict").alias("l_verdict")) \
        .where(F.col("key").isNotNull())
    listed = listed.groupBy("key", "l_host", "l_path").agg(F.max("l_verdict").alias("l_verdict"))
    n = listed.count()
    small = n <= BROADCAST_ROWS
    n_blocks = max(1, -(-n * BITS_PER_KEY // (64 * WORDS)))
    # path lengths: at most as many as a URL has characters
    lengths = [r[0] for r in listed.select(F.length("l_path")).distinct().collect()]
    pages = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("u"))
    host, path = host_and_path(F.col("u"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    if not n:
        return pages.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
                            F.lit(default).alias("verdict"))
    parts = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(parts)),
                        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    paths = F.transform(F.filter(F.array(*[F.lit(x) for x in lengths]), lambda n: n <= F.length("path")),
                        lambda n: F.substring(F.col("path"), F.lit(1), n))
    tries = (pages.select("host", "path").distinct()
             .withColumn("try_host", F.explode(hosts)).withColumn("try_path", F.explode(paths))
             .withColumn("key", F.concat("try_host", "try_path")))
    hits = passes(tries, bloom_blocks(listed.select("key"), n_blocks), n_blocks, small)
    exact = hits.join(F.broadcast(listed) if small else listed, "key") \
        .where((F.col("try_host") == F.col("l_host")) & (F.col("try_path") == F.col("l_path")))
    best = exact.groupBy("host", "path").agg(F.min(F.struct(
        (-F.length("key")).alias("n"), F.col("key").alias("rule"), F.col("l_verdict").alias("v"))).alias("best"))
    return pages.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.v", F.lit(default)).alias("verdict"))
