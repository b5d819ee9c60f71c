"""Source divergence against plain counts in Python."""

import re
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from reuselens.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs, top):
    rows = [(t or "", lang or "", s or "") for t, lang, s in rows]
    out = []
    for lang in {r[1] for r in rows}:
        docs = [(s, Counter(TERM.findall(t.translate(LOWER)))) for t, x, s in rows if x == lang]
        df = Counter(w for _, c in docs for w in c)
        kept = [w for w in df if df[w] >= min_docs]
        groups = {s: Counter() for s, _ in docs}
        for s, c in docs:
            groups[s].update({w: n for w, n in c.items() if w in set(kept)})
        total = sum(groups.values(), Counter())
        share = lambda c: {w: 1 + floor(Fraction(10 ** 9 * (c[w] + 5), sum(c.values()) + 5 * len(kept))) for w in kept}
        p, q = {s: share(c) for s, c in groups.items()}, share(total)
        for s in groups:
            pairs = [(sum(abs(p[s][w] - p[o][w]) for w in kept), o) for o in groups if o != s]
            terms = [(p[s][w] - q[w], w) for w in kept if groups[s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(found[:most])]
    return sorted(out)


def texts():
    rnd = np.random.RandomState(11)
    words = ["the", "The", "Über", "naïve", "x_y", "a1b", "日本", "don't", "zeta", "eta", "theta", "iota"] + [f"w{chr(97 + i)}" for i in range(20)]
    out = []
    for i in range(160):
        lang, source = ["en", "de", None, "q"][i % 4 if i < 150 else 0], [None, "s1", "s2", "S3", "", "hot"][rnd.randint(6) if i % 3 else 5]
        out.append((" ".join(words[min(len(words) - 1, int(rnd.zipf(1.4)) - 1)] for _ in range(rnd.randint(0, 40))), lang, source))
    return [*out, (None, "en", "s9"), ("", None, None), ("123 ...", "q", "s8"), ("only", "rare", "a"), ("only", "rare", "b"), (None, "rare", "c")]


def test_against_plain(spark):
    rows = texts()
    df = spark.createDataFrame([(i, t, lang, s, "x", 3) for i, (t, lang, s) in enumerate(rows)],
                               "doc_id long, text string, lang string, source string, term string, n int").repartition(5)
    for min_docs, chunk, block in ((5, 8192, 64), (3, 4, 2), (30, 3, 1)):
        got = sorted(map(tuple, D.audit(df, min_docs, 7, chunk, block).collect()))
        assert got == plain(rows, min_docs, 7), (min_docs, chunk, block)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    out = D.audit(df)
    assert out.count() == 0 and out.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_hand_written(spark):
    """One term each in two documents: the shares are 2 kept terms' worth."""
    df = spark.createDataFrame([("a a b", "x", "s"), ("a b b b", "x", "t")], "text string, lang string, source string")
    rows = {(r["source"], r["part"], r["item"]): r["value"] for r in D.audit(df, min_docs=2).collect()}
    share = lambda c, n: 1 + 10 ** 9 * (c + 5) // (n + 10)
    apart = abs(share(2, 3) - share(1, 4)) + abs(share(1, 3) - share(3, 4))
    assert rows[("s", "pair", "t")] == rows[("t", "pair", "s")] == apart
    assert rows[("s", "term", "a")] == share(2, 3) - share(3, 7) and ("s", "term", "b") not in rows


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=40))
def test_runs(columns):
    a, b = (np.array(x, np.int64) for x in zip(*columns, strict=True))
    def runs(x):
        last = np.flatnonzero(np.append(x[1:] != x[:-1], True))
        return last + 1, x[last]
    assert D.run_difference(*runs(a), *runs(b)) == int(np.abs(a - b).sum())


def test_long_text_is_cut_between_terms(monkeypatch):
    monkeypatch.setattr(D, "SLICE", 5)
    text = "Alpha beta, gammadelta epsilon  z Über-straße end".encode()
    assert {k.decode(): n for k, n in D._terms_of(text).items()} == Counter(TERM.findall(text.decode().translate(LOWER)))


def test_share_is_exact_for_large_counts():
    n, v = 8_000_000_000_000_000, 12345
    counts = np.array([0, 1, 7_999_999_999_999_999, n], np.int64)
    assert D.share(counts, n, v).tolist() == [1 + 10 ** 9 * (int(c) + 5) // (n + 5 * v) for c in counts]
