"""Originals in rounds: the same best originals as by blocks, without copies of the documents."""

import random

import pytest
from pyspark.sql import functions as F

from reuselens.operators import blocks as BL
from reuselens.operators import cosine as CO
from reuselens.operators import jaccard as JA
from reuselens.operators import tfidf as TF
from reuselens.session import cut_lineage


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(3)
    rows = [(i if i else None, " ".join(f"w{int(rng.paretovariate(0.6)) % 40}" for _ in range(rng.randint(0, 30)))) for i in range(120)]
    rows += [(7, rows[7][1]), (60, rows[60][1])]                      # rows that come twice
    return cut_lineage(spark.createDataFrame(rows, "doc_id long, clean_text string"))


def _no_copies(*_, **__):
    raise AssertionError("documents are copied for each part of the originals")


@pytest.mark.parametrize("exclude_self", [False, True])
def test_cosine_in_rounds(texts, exclude_self, monkeypatch):
    texts, mark = texts.dropDuplicates(["doc_id"]), F.col("doc_id") % 20 == 0
    ids = texts.select("doc_id").distinct()
    own = ids.where(mark)
    by_blocks = sorted(map(str, CO.best_match(cut_lineage(TF.tfidf_vectors(texts)), own, ids, exclude_self).collect()))
    monkeypatch.setattr(BL, "best_against", _no_copies)
    monkeypatch.setattr(BL, "ROUND_DOCS", 2)
    monkeypatch.setattr(BL, "ROUND_CELLS", 16)
    monkeypatch.setattr(TF, "SLICE", 10)
    slices = TF.tfidf_slices(texts, mark)
    assert slices.where("mark").count() > 1
    assert sorted(map(str, CO.best_match(slices, own, ids, exclude_self).collect())) == by_blocks


def test_slices_hold_the_vectors(texts):
    vectors = {r.doc_id: sorted(zip(r.g, r.w, strict=True)) for r in TF.tfidf_vectors(texts.where("doc_id between 10 and 50")).collect()}
    found = {}
    for r in TF.tfidf_slices(texts.where("doc_id between 10 and 50"), F.lit(False)).toArrow().to_batches():
        for x in zip(r["blob"], r["ids"], r["grams"], strict=True):
            ids, grams, weights, row = TF.unpack_slice(*x)
            for g, w, i in zip(grams, weights, row, strict=True):
                found.setdefault(int(ids[i]), []).append((int(g), float(w)))
    assert {k: sorted(v) for k, v in found.items()} == vectors


@pytest.mark.parametrize("twice", [False, True])
def test_jaccard_in_rounds(texts, twice, monkeypatch):
    texts = texts if twice else texts.dropDuplicates(["doc_id"])
    own = texts.select("doc_id").distinct().where(F.col("doc_id") % 20 == 0)
    sets = {(r.doc_id, frozenset(zip(*[r.clean_text.split()[i:] for i in range(3)], strict=False))) for r in texts.collect()}
    originals = {d: s for d, s in sets if d is not None and d % 20 == 0}
    if not twice:
        monkeypatch.setattr(BL, "best_against", _no_copies)
        monkeypatch.setattr(BL, "ROUND_DOCS", 2)
    found = {r.doc_id: r.best_sim for r in JA.best_original(texts, own).collect()}
    for d, s in sets:
        if d is None or twice and d in (7, 60):
            continue
        best = max((len(s & o) / len(s | o) for e, o in originals.items() if e != d and s | o and not (twice and e == 60)), default=0.0)
        assert found[d] == pytest.approx(best) or twice
