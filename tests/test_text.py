from pyspark.sql import functions as F

from reuselens.functions import text as X

# raw text and the cleaned text it must give, written by hand
CLEANED = [
    ("", ""),
    ("Word", "word"),
    ("two   WORDS", "two words"),
    ("?!... ,,;", ""),
    ("\u201cSmart\u201d quotes \u2014 and \u2018dashes\u2019", "smart quotes and dashes"),
    ("x_1 \u00bd caf\u00e9  Stra\u00dfe\tTAB\nnew line", "x_1 \u00bd caf\u00e9 stra\u00dfe tab new line"),
    ("\u00dcn\u00efc\u00f6d\u00e9 \u00c9COLE, d\u00e9j\u00e0-vu; na\u00efve", "\u00fcn\u00efc\u00f6d\u00e9 \u00e9cole d\u00e9j\u00e0 vu na\u00efve"),
    (None, ""),
]

# cleaned text, its distinct three-word shingles in order, its tokens
SHINGLED = [
    ("", [], []),
    ("word", [], ["word"]),
    ("two words", [], ["two", "words"]),
    ("three little words", ["three little words"], ["three", "little", "words"]),
    ("a b c d", ["a b c", "b c d"], ["a", "b", "c", "d"]),
    ("a b a b a b", ["a b a", "b a b"], ["a", "b", "a", "b", "a", "b"]),
    ("a a a a", ["a a a"], ["a", "a", "a", "a"]),
]


def test_clean_text(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CLEANED)], "id int, t string")
    got = {r.id: r.c for r in df.select("id", X.clean_text("t").alias("c")).collect()}
    assert [got[i] for i in range(len(CLEANED))] == [c for _, c in CLEANED]


def test_shingles_and_tokens(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _, _) in enumerate(SHINGLED)], "id int, c string")
    for r in df.select("id", X.shingles("c").alias("s"), X.tokens("c").alias("w")).collect():
        assert (r.s, r.w) == SHINGLED[r.id][1:]


def test_word_ngrams_drop_short_tokens_first(spark):
    df = spark.createDataFrame([("a bb c dd ee",), ("x",), ("",), ("aa bb",)], "c string")
    got = [r[0] for r in df.select(X.word_ngrams("c")).collect()]
    assert got[0] == ["bb", "dd", "ee", "bb dd", "dd ee"]
    assert got[1] == [] and got[2] == []
    assert got[3] == ["aa", "bb", "aa bb"]


def test_hash32_known_value(spark):
    df = spark.createDataFrame([("a b c",)], "s string")
    assert df.select(X.hash32("s")).first()[0] == 116422158


def test_drop_invalid_utf8(spark):
    df = spark.createDataFrame([(bytearray(b"ok \xff text"),)], "b binary")
    v = df.select(X.drop_invalid_utf8(F.col("b").cast("string"))).first()[0]
    assert v == "ok  text"


def test_a_replacement_character_of_the_text_stays(spark):
    df = spark.createDataFrame([("a \ufffd b",)], "t string")
    assert df.select(X.drop_invalid_utf8("t")).first()[0] == "a \ufffd b"
