import collections
import random

import pytest

from reuselens.llm import decontaminate as D
from tests.llm.conftest import words


def bag(w):
    return collections.Counter(zip(*[w[j:] for j in range(5)], strict=False))


def brute(texts, items):
    """Best window of each document and item, over all starts."""
    out = {}
    for d, t in enumerate(texts):
        w = words(t)
        sh = list(zip(*[w[j:] for j in range(5)], strict=False))
        for i, x in enumerate(items):
            q = words(x)
            if 0 < len(q) < 5:
                if any(w[s:s + len(q)] == q for s in range(len(w) - len(q) + 1)):
                    out[d, i] = 1.0
                continue
            n, c = len(q) - 4, bag(q)
            best = 0.0
            for s in range(1 - n, len(sh)) if q else ():
                own = collections.Counter(sh[max(s, 0):max(0, s + n)])
                both = sum((own & c).values())
                best = max(best, both / (sum(own.values()) + sum(c.values()) - both) if both else 0)
            if best >= D.SIMILARITY:
                out[d, i] = best
    return out


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(6)
    prose = lambda n: [rng.choice("klmnopq") + str(rng.randrange(80)) for _ in range(n)]
    items = [prose(n) for n in (5, 9, 12, 20, 20, 33, 60)] + [["x"] * 12, ["One", "two"]]
    texts = [None, "", "x " * 40, "one two", "one", "y one two z", " ".join(prose(500))]
    for q in items[:7]:
        for edits in (0, 1, 2, 4):
            w = list(q)
            for _ in range(edits):
                w[rng.randrange(len(w))] = prose(1)[0]
            texts.append(" ".join(prose(30) + w + prose(rng.randrange(30))).upper())
        texts += [" ".join(q[2:]), " ".join(prose(4) + q[:-2]), " ".join(q[:len(q) // 2] + prose(3) + q[len(q) // 2:])]
    return texts, [" ".join(q) for q in items] + ["", " "]


def test_windows_by_brute_force(spark, frame, tables):
    texts, items = tables
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(50, None), (51, items[3])],
                                  "item_id long, text string")
    expected = brute(texts, items)
    expected |= {(d, 51): s for (d, i), s in expected.items() if i == 3}
    docs = frame(texts)
    got = {(r["doc_id"], r["item_id"]): r for r in D.find_items(docs, bench).collect()}
    assert set(got) == set(expected)
    for k, r in got.items():
        assert r["similarity"] == pytest.approx(expected[k])
        w, q = words(texts[k[0]]), words(items[3] if k[1] == 51 else items[k[1]])
        own = w[r["first_word"]:r["first_word"] + r["n_words"]]
        if len(q) >= 5:
            both = sum((bag(own) & bag(q)).values())
            assert both / (sum(bag(own).values()) + sum(bag(q).values()) - both) == pytest.approx(r["similarity"])
        else:
            assert own == q
    clean = D.without_items(docs, bench)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in expected}


def test_blocks_of_items_and_empty_tables(spark, frame, tables, monkeypatch):
    texts, items = tables
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    whole = sorted(map(tuple, D.find_items(frame(texts), bench).collect()))
    monkeypatch.setattr(D, "BLOCK_BYTES", 300)
    assert sorted(map(tuple, D.find_items(frame(texts), bench).collect())) == whole
    none = bench.where("item_id < 0")
    assert D.find_items(frame(texts), none).count() == 0 and D.without_items(frame(texts), none).count() == len(texts)
    assert D.find_items(frame([]), bench).count() == 0


def test_no_pair_within_the_radius_is_lost():
    import numpy as np
    rng = np.random.default_rng(0)
    items = rng.integers(0, 1 << 16, (20, D.BLOCKS), dtype=np.uint16)
    windows = np.repeat(items, 50, axis=0)
    for w in windows:
        for bit in rng.choice(128, rng.integers(0, 60), replace=False):
            w[bit // 16] ^= np.uint16(1 << bit % 16)
    apart = np.bitwise_count(windows[:, None] ^ items[None]).sum(axis=2)
    assert (D.within(windows, items) == (apart <= D.RADIUS)).all()
    assert D.ALLOWED.sum() == D.RADIUS - D.BLOCKS + 1


def test_repeated_runs_by_brute_force(spark, frame):
    """A run of one word on one side only, in the item or in the document."""
    rng = random.Random(4)
    prose = lambda n: [rng.choice("klmnopq") + str(rng.randrange(10 ** 6)) for _ in range(n)]
    items, texts = [], []
    for i in range(12):
        common, run, rest = prose(120 + i % 3 * 10), ["x"] * 18, prose(18)
        items.append(" ".join(common + (run if i % 2 else rest)))
        texts.append(" ".join(prose(10) + common + (rest if i % 2 else run) + prose(10)))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in D.find_items(frame(texts), bench).collect()}
    assert got == pytest.approx(brute(texts, items)) and len(got) == 12
