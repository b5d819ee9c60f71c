"""Learned vectors: counts, weights, factors and the two ways to embed."""

from collections import Counter

import numpy as np
import pytest

from reuselens.operators import cowords as CW


@pytest.fixture(scope="module")
def texts(spark):
    rnd = np.random.RandomState(8)
    topics = [[f"{t}{i}" for i in range(12)] for t in "abc"]
    rows = [(i, " ".join(rnd.choice(topics[i % 3], 30)) + (" the rare%d" % i)) for i in range(90)]
    return spark.createDataFrame([*rows, (900, ""), (901, "unknown words only")], "doc_id long, clean_text string")


def test_counts_and_weights(spark, texts):
    words = [w for w, _ in CW.vocabulary(texts)]
    assert set(words) == {f"{t}{i}" for t in "abc" for i in range(12)} | {"the"} and words[0] == "the"
    expected = Counter()
    for r in texts.collect():
        w = r.clean_text.split()
        for i in range(len(w)):
            for j in range(max(0, i - CW.WINDOW), min(len(w), i + CW.WINDOW + 1)):
                if i != j and w[i] in words and w[j] in words:
                    expected[w[i], w[j]] += 1
    counts = CW.cooccurrence(texts, words)
    assert {(r.a, r.b): r.n for r in counts.collect()} == expected
    total, per = sum(expected.values()), Counter()
    for (a, _), n in expected.items():
        per[a] += n
    pmi = {k: np.log(n * total / (per[k[0]] * per[k[1]])) - np.log(CW.SHIFT) for k, n in expected.items()}
    got = {(r.a, r.b): r.w for r in CW.ppmi(counts).collect()}
    assert set(got) == {k for k, v in pmi.items() if v > 0} and all(abs(got[k] - pmi[k]) < 1e-9 for k in got)


def test_pairs_are_shuffled_once_as_numbers(spark, texts):
    """One row for a pair in either order, without its words."""
    plan = CW.cooccurrence(texts, ["the", "a1"])._jdf.queryExecution().optimizedPlan().toString()
    grouped = [x for x in plan.splitlines() if "Aggregate" in x]
    assert len(grouped) == 1 and "[pair#" in grouped[0]
    got = {(r.a, r.b): r.n for r in CW.cooccurrence(spark.createDataFrame([("x x y x",)], "clean_text string"), ["y", "x"]).collect()}
    assert got == {("x", "x"): 6, ("x", "y"): 3, ("y", "x"): 3}


def test_vectors(spark, texts, tmpdir_path):
    model = CW.fit(texts, dim=4, shift=1.0)
    # the factors are those of the whole matrix
    words = model.words
    w = np.zeros((len(words), len(words)))
    for r in CW.ppmi(CW.cooccurrence(texts, words), 1.0).collect():
        w[words.index(r.a), words.index(r.b)] = r.w
    u, s, _ = np.linalg.svd(w)
    assert np.allclose(np.linalg.norm(model.vectors, axis=0) ** 2, s[:4], rtol=1e-3)
    a, b = (CW.embed_batched(texts, model).collect(), CW.embed_joined(texts, model).collect())
    a, b = ({r.doc_id: np.array(r.embedding) for r in x} for x in (a, b))
    assert set(a) == set(b) == {r.doc_id for r in texts.select("doc_id").collect()}
    assert all(np.allclose(a[k], b[k], atol=1e-9) for k in a)
    assert not a[900].any() and not a[901].any() and abs(np.linalg.norm(a[0]) - 1) < 1e-9
    # documents of a topic lie together
    assert min(a[0] @ a[3 * i] for i in range(1, 30)) > max(a[0] @ a[3 * i + 1] for i in range(30))
    path = f"{tmpdir_path}/model"
    model.save(spark, path)
    again = {r.doc_id: np.array(r.embedding) for r in CW.embed_batched(texts, CW.WordVectors.load(spark, path)).collect()}
    assert all(np.allclose(a[k], again[k], atol=1e-9) for k in a)


def test_no_vocabulary_and_large_models(spark, texts):
    model = CW.fit(texts, min_df=1000, dim=4)
    assert all(r.embedding == [0.0] * 4 for r in CW.embed_batched(texts, model).collect())
    large = CW.WordVectors(["x"], np.ones(1), np.zeros((1, CW.MODEL_BYTES // 8 + 1)))
    with pytest.raises(ValueError):
        CW.embed_batched(texts, large)
