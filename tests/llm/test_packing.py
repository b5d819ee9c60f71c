"""Packing: ids against the tokenizer itself, placement rules, and the search."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reuselens.llm import packing as K

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def encoder():
    from reuselens.llm.token_ids import WordEncoder
    return WordEncoder(PATH)


ODD = ["", "  \n\t ", "don't WON'T 'S a'b it's.", "x\x0by\x0cz\x1cq\x1dw", "é ́a café.", "İSTANBUL ΣΑΣ ς", "a\xa0b c",
       "<|endoftext|>x", "日本語のテキスト 123 4٠", "\x00\x01 \x85 a b", "😀👩‍👧 ﬁ", "ǅ K Å Ω", "aͅ ͅb", "A" * 3000, "end.) (x). 3.5, 7!"]


def test_ids_are_the_tokenizers(tokenizer, encoder):
    assert encoder.wordwise
    ids, bounds = encoder(pa.array([*ODD, None]))
    got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
    assert got == [e.ids for e in tokenizer.encode_batch([*ODD, ""], add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abAB'sS.,;! \t\n3é́ßΣ😀-日"), max_size=30), max_size=4))
def test_ids_of_any_text(tokenizer, encoder, texts):
    ids, bounds = encoder(pa.array(texts, pa.string()))
    got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("asStTlɏľǆª½*#$%-_~=<'`^(@ \t3é́ß̸ŀ日"), max_size=30), max_size=4))
def test_ids_with_any_punctuation(tokenizer, encoder, texts):
    ids, bounds = encoder(pa.array(texts, pa.string()))
    got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_punctuation_makes_no_new_words(tokenizer):
    """A word is tokenised once, whatever stands behind it; words of a-z go past the rules."""
    from reuselens.llm.token_ids import WordEncoder
    e = WordEncoder(PATH)
    text = "One one*** one.### one, one-- caf\xe9 caf\xe9, caf\xe9.%%% one"
    ids, _ = e(pa.array([text]))
    assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert {w for w in e.places if w[0].isalpha()} == {"one", "caf\xe9"}
    ids, size = e._of_ascii(["plagiarised", "a", "zzxqj"])
    assert ids.tolist() == tokenizer.encode("plagiarised a zzxqj", add_special_tokens=False).ids and size.sum() == len(ids)


def test_other_vocabularies_get_whole_texts():
    from tokenizers import Tokenizer

    from reuselens.llm.token_ids import WordEncoder
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    e, t = WordEncoder(path), Tokenizer.from_file(path)
    ids, bounds = e(pa.array(["one  two.", "", "Three"]))
    assert not e.wordwise and ids[:bounds[1]].tolist() == t.encode("one  two.", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=60))
def test_search_keeps_items_and_never_adds_bins(lengths):
    lengths = np.array(lengths)
    first = K.best_fit(lengths, 40)
    after = K.local_search(first, lengths, 40)
    for bins in (first, after):
        assert sorted(i for b in bins for i in b) == list(range(len(lengths))) and all(0 < lengths[b].sum() <= 40 for b in bins)
    assert -(-lengths.sum() // 40) <= len(after) <= len(first)
    square = lambda bins: sum(int(lengths[b].sum()) ** 2 for b in bins)
    assert square(after) >= square(first)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=6), st.lists(st.integers(1, 12), min_size=1, max_size=6), st.integers(1, 12))
def test_exchange_is_the_largest(a, b, room):
    """Against all moves, swaps, two for one and one for two."""
    a, b = np.array(a), np.array(b)
    moved, give, take = K.exchange(a, b, room)
    places = [(i,) for i in range(len(a))]
    two = [(i, j) for i in range(len(a)) for j in range(i)]
    back = [()] + [(i,) for i in range(len(b))]
    every = [(g, t) for g in places for t in back + [(i, j) for i in range(len(b)) for j in range(i)]] + [(g, t) for g in two for t in back[1:]]
    gains = [a[list(g)].sum() - b[list(t)].sum() for g, t in every]
    assert moved == max([0, *(x for x in gains if x <= room)])
    assert not moved or a[list(give)].sum() - b[list(take)].sum() == moved


def test_search_beats_best_fit():
    lengths = np.random.RandomState(5).randint(700, 2200, 800)
    first = K.best_fit(lengths, 4096)
    assert len(K.local_search(first, lengths, 4096)) < len(first)


def check(rows, docs, tokenizer, size):
    """Every rule of the contract on ``(doc_id, text)`` documents."""
    expected = Counter()
    for doc, text in docs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for p, s in enumerate(range(0, len(ids), size)):
            expected[(doc, p, s, len(ids[s:s + size]), zlib.crc32(ids[s:s + size].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_small_table(spark, frame, tokenizer):
    texts = [None, "", "one two three", "one two three", "word " * 300, "A-Z, 'tis!", *ODD]
    ids = [0, 1, 2, 2, None, None, *range(10, 10 + len(ODD))]
    docs = frame(texts, ids=ids)
    packed = K.pack(docs, PATH, size=64, with_ids=True)
    rows = packed.collect()
    n = check(rows, list(zip(ids, texts, strict=True)), tokenizer, 64)
    assert n <= -(-sum(r["length"] for r in rows) // 64) + 1
    # the sequences hold the ids, in place
    whole = {r["sequence_id"]: r for r in K.sequences(packed).collect()}
    for r in rows:
        s = whole[r["sequence_id"]]
        assert s["ids"][r["offset"]:r["offset"] + r["length"]] == r["ids"] and r["offset"] in s["offsets"]
    assert len(whole) == n


def test_levels_join_the_last_bins(spark):
    items = spark.range(4000).selectExpr("id AS uid", "1 + id * 7919 % 300 AS length")
    rows = K.place(items, size=1000, group=250).collect()
    length = {i: 1 + i * 7919 % 300 for i in range(4000)}
    fill = Counter()
    for r in rows:
        fill[r["sequence_id"]] += length[r["uid"]]
    assert sorted(r["uid"] for r in rows) == list(range(4000)) and max(fill.values()) <= 1000
    assert len(fill) <= -(-sum(length.values()) // 1000) + 2          # 16 groups, but at most 2 bins over
    again = K.place(items, size=1000, group=250)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_empty_table(spark, frame):
    assert K.pack(frame([]), PATH).count() == 0


def test_query_on_the_test_table(spark, tokenizer):
    from reuselens.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op11_packing"](spark, sf).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    n = check(rows, docs, tokenizer, 4096)
    assert n <= -(-sum(r["length"] for r in rows) // 4096) + 1
