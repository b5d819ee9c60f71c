"""Column expressions for text cleaning, tokens, shingles and n-grams.

All of these are built-in Spark expressions (JVM side); none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reuselens.functions._cols import as_col

# The cleaning rule. Lower-case, then every run of characters
# that is neither a letter, a digit nor an underscore becomes one space, then
# the ends are trimmed. One pass of this pattern equals "punctuation to space,
# squeeze whitespace, strip".
NON_WORD_RUN = r"[^\p{L}\p{N}_]+"

def _empty_strings() -> Column:
    return F.array().cast("array<string>")


def clean_text(text) -> Column:
    """Lower case, punctuation and whitespace runs to one space, trimmed.

    NULL text is treated as '' (the reference casts to str first).
    """
    c = F.coalesce(as_col(text).cast("string"), F.lit(""))
    return F.trim(F.regexp_replace(F.lower(c), NON_WORD_RUN, " "))


def drop_invalid_utf8(text) -> Column:
    """Decode leniently and drop bytes that are not valid UTF-8. A valid
    text is taken as it is, a U+FFFD of its own included."""
    c = as_col(text)
    return F.when(F.is_valid_utf8(c), c).otherwise(F.regexp_replace(F.make_valid_utf8(c), "\ufffd", ""))


def tokens(clean) -> Column:
    """Whitespace tokens of a cleaned text; '' gives an empty array."""
    c = as_col(clean)
    return F.when(c == "", _empty_strings()).otherwise(F.split(c, " "))


def shingles(clean, k: int = 3) -> Column:
    """The set of k-word shingles (k consecutive tokens joined by ' ').

    One regex pass per text: at every word start a look-ahead captures the
    next k words, so overlapping shingles come out in order. Fewer than k
    tokens gives an empty set.
    """
    words = " ".join(["[^ ]+"] * k)
    rx = F.regexp_extract_all(as_col(clean), F.lit(f"(?:^| )(?=({words}))"), F.lit(1))
    return F.array_distinct(rx)


def hash32(s) -> Column:
    """Stable 32-bit hash of a string: the first 8 hex digits of its md5.

    The same value is available in DuckDB as
    ``('0x' || substr(md5(s), 1, 8))::BIGINT``.
    """
    return F.conv(F.substring(F.md5(as_col(s)), 1, 8), 16, 10).cast("bigint")


def word_ngrams(clean) -> Column:
    """Unigrams followed by bigrams of the >=2-character tokens.

    Bigrams are formed after single-character tokens are dropped, as in the
    usual TF-IDF analyser with ngram range (1, 2). Native regex passes only:
    single-character tokens (with one adjacent space) are removed, the rest
    is split, and bigrams are captured by a look-ahead at every token start.
    """
    long_only = F.trim(F.regexp_replace(as_col(clean), r"(?<![^ ])[^ ](?![^ ]) ?", ""))
    uni = F.when(long_only == "", _empty_strings()).otherwise(F.split(long_only, " "))
    bi = F.regexp_extract_all(long_only, F.lit("(?:^| )(?=([^ ]+ [^ ]+))"), F.lit(1))
    return F.concat(uni, bi)
