import random

import numpy as np
import pytest

from reuselens.llm import components as C
from reuselens.llm import jaccard_join as J
from reuselens.llm.components import components
from tests.llm.conftest import shingle_set


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(300))
    prose = lambda n: [word() for _ in range(n)]
    out = [None, "", " \n", "one", "ONE", "one two", "A b C d", "a B c d", "é", "x " * 500, "x " * 900]
    common = prose(40)
    out += [" ".join(prose(20) + common + prose(20)) for _ in range(30)]        # a shared passage
    base = prose(120)
    for n in range(40):                                                         # chains of edits
        w = list(base)
        for _ in range(n // 6):
            w[rng.randrange(len(w))] = word()
        out.append(" ".join(w))
    for n in (7, 8, 9, 11, 18):                                                 # right at the border
        w = prose(60)
        out += [" ".join(w), " ".join(w[:60 - n])]
    out += [out[45], out[45].upper()]
    return out


def brute(texts):
    sets = [shingle_set(t) for t in texts]
    part = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                old, new = max(part[i], part[j]), min(part[i], part[j])
                part = [new if p == old else p for p in part]
    return {i: (len(sets[i]), part[i]) for i in range(len(texts))}


@pytest.mark.parametrize("frequent", [J.FREQUENT, 2])
def test_components_against_all_pairs(frame, texts, frequent, monkeypatch):
    monkeypatch.setattr(J, "FREQUENT", frequent)
    got = J.jaccard_join(frame(texts))[0].collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(texts)


def test_links_are_exact_and_one_of_each_stays(frame, texts):
    docs = frame(texts)
    links = J.jaccard_join(docs)[1].collect()
    for r in links:
        a, b = shingle_set(texts[r["a"]]), shingle_set(texts[r["b"]])
        assert r["overlap"] == len(a & b) and 100 * len(a & b) >= 75 * len(a | b)
    stay = J.one_of_each(docs)
    assert stay.columns == docs.columns
    assert {r["doc_id"] for r in stay.collect()} == {p for _, p in brute(texts).values()}


def test_repeated_rows_null_ids_and_empty_table(frame):
    t = "a b c d e f g h"
    got = J.jaccard_join(frame([t, t, t, t + " i", ""], [4, 4, None, 2, 1]))[0].collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=repr) == [(1, 1), (2, 2), (4, 2), (4, 2), (None, 2)]
    assert J.jaccard_join(frame([]))[0].count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    links += [(None, 1), (7, 7)]
    part = {}
    for a, b in links:
        if a is None or a == b:
            continue
        x, y = part.setdefault(a, a), part.setdefault(b, b)
        part = {k: min(x, y) if v in (x, y) else v for k, v in part.items()}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == part


def test_rows_of_one_id_are_documents_of_their_own(frame):
    rng = random.Random(3)
    prose = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    base, other, clean, late = prose(80), prose(80), prose(80), prose(80)
    near = lambda w: " ".join([*w[:-2], *prose(2)])
    rows = [(5, " ".join(base)), (None, near(base)), (None, " ".join(clean)), (None, ""), (None, None),
            (None, " ".join(other)), (None, near(other)), (None, " ".join(late)), (None, " ".join(late)),
            (9, near(base)), (9, " ".join(prose(70)))]
    docs = frame([t for _, t in rows], [i for i, _ in rows])
    found = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.jaccard_join(docs)[0].collect()), key=repr)
    assert found == sorted([(5, 76, 5), (None, 76, 5), (None, 76, None), (None, 0, None), (None, 0, None), (None, 76, None),
                            (None, 76, None), (None, 76, None), (None, 76, None), (9, 76, 5), (9, 66, 9)], key=repr)
    texts = [r["text"] for r in J.one_of_each(docs).collect()]
    assert len(texts) == 7 and len({rows[5][1], rows[6][1]} & set(texts)) == 1
    assert sorted(t for t in texts if t and t not in (rows[5][1], rows[6][1])) \
        == sorted([rows[0][1], rows[2][1], rows[7][1], rows[10][1]])


def test_unsettled_components_are_an_error(spark, monkeypatch):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    monkeypatch.setattr(C, "MAX_ROUNDS", 2)
    with pytest.raises(RuntimeError):
        components(links)


def test_short_bitmaps_bound_the_difference():
    """Two sets differ in at least as many shingles as their short bitmaps in
    bits, and sets without anything in common are told apart."""
    rng = np.random.default_rng(4)
    for shared, own in ((0, 1), (40, 3), (300, 20), (0, 200)):
        sets = [rng.integers(1, 1 << 53, shared).astype(np.uint64)] * 2
        sets = [np.concatenate([s, rng.integers(1, 1 << 53, own).astype(np.uint64)]) for s in sets]
        words = J.short_bitmaps(np.concatenate(sets), np.array([0, shared + own, 2 * (shared + own)]))
        assert words.shape == (2, J.WORDS)
        differ = int(np.bitwise_count((words[0] ^ words[1]).view(np.uint64)).sum())
        assert 0 < differ <= 2 * own
    assert J.short_bitmaps(np.zeros(0, np.uint64), np.array([0, 0])).tolist() == [[0] * J.WORDS]


def test_last_join_makes_each_pair_and_few_of_them_twice(spark):
    """Against all pairs that share a shingle at places that may link; the
    rows of the join itself stay near the number of pairs."""
    rng = random.Random(6)
    common, n = [sorted(rng.sample(range(10 ** 6), 60)) for _ in range(6)], 200
    held = [sorted({t for t in rng.choice(common) if rng.random() < 0.8} | set(rng.sample(range(10 ** 6), 6)))
            for _ in range(60)]
    rows = spark.createDataFrame([(t, c, n, at, c % 50, True) for c, h in enumerate(held) for at, t in enumerate(h)],
                                 "token long, cid long, n long, at long, part long, linked boolean")
    classes = spark.createDataFrame([(c, [0] * J.WORDS) for c in range(len(held))], "cid long, words array<long>")
    pairs, shared = set(), 0
    for x, a in enumerate(held):
        for y in range(x + 1, len(held)):
            both = [t for t in a if t in held[y] and 7 * (n - max(a.index(t), held[y].index(t))) >= 6 * n]
            if both and x % 50 != y % 50:
                pairs.add((x, y))
                shared += len(both)
    joined = J._cross_rows(rows, classes, 75)
    got = [tuple(r) for r in joined.collect()]
    assert set(got) == pairs and shared > 8 * len(pairs)
    assert len(got) < 2 * len(pairs)
