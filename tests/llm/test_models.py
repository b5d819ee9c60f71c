"""Language identification and the quality classifier."""

import random

import numpy as np
from pyspark.sql import functions as F

from reuselens.llm import language_id as L
from reuselens.llm import pu_quality as Q
from reuselens.llm.common import held_out, table

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    out = held_out(3, 1)
    model = L.fit(docs.where(~out))
    assert set(model["langs"]) == {"de", "en", "es", "fr"} and model["families"] == ["germanic", "romance"]
    got = L.predict(docs, model, {"held_out": out}).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.96
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_odd_texts(frame):
    rng = random.Random(0)
    syl = {"de": ["sch", "ung", "ich"], "en": ["th", "ing", "ow"], "xx": ["zzu", "qqa", "vvo"]}
    texts = [" ".join(rng.choice(s) + rng.choice(s) for _ in range(30)) for s in syl.values() for _ in range(20)]
    langs = [x for x in syl for _ in range(20)]
    docs = frame(texts + ["1 2 3", None, "", "é", texts[0], "\u4e2d"], langs=langs + [None] * 6)
    model = L.fit(docs.withColumn("source", F.lit("s")), per_language=15)
    assert model["families"] == ["germanic", "xx"]
    got = {r["doc_id"]: r for r in L.predict(docs, model).collect()}
    assert [got[i]["lang_pred"] for i in range(60)] == langs
    assert [got[i]["lang_pred"] for i in (60, 61, 62)] == ["und"] * 3 and got[62]["score"] == 0
    assert got[63]["lang_pred"] in syl and got[65]["lang_pred"] in syl and got[64]["lang_pred"] == "de"
    one = L.fit(docs.where("lang = 'de'"))
    assert {r["lang_pred"] for r in L.predict(docs.where("doc_id < 60"), one).collect()} == {"de"}
    none = L.fit(docs.where("lang = 'no such'"))
    assert {r["lang_pred"] for r in L.predict(docs, none).collect()} == {"und"}
    assert L.predict(frame([]), model).count() == 0


def test_sample_is_bounded_and_by_id(frame):
    docs = frame(["a b c"] * 400, langs=["de"] * 300 + ["en"] * 100)
    a = L.training_sample(docs, 50)
    assert a.groupBy("lang").count().collect() and {r["count"] for r in a.groupBy("lang").count().collect()} == {50}
    assert {r["doc_id"] for r in a.collect()} == {r["doc_id"] for r in L.training_sample(docs.repartition(5), 50).collect()}


def test_vectors_do_not_cross_texts():
    import pyarrow as pa

    from reuselens.llm import kernels as K
    texts = ["ab", "", "cd e", "x", "ab"]
    _, data, off = next(K.utf8_pieces(pa.array(texts)))
    both = L.vectors(data, off)
    for i, t in enumerate(texts):
        _, d, o = next(K.utf8_pieces(pa.array([t])))
        assert np.allclose(both[i], L.vectors(d, o)[0]), t


def test_quality_held_out(spark):
    from reuselens.llm.queries import op8_quality
    labels = table(spark, "/root/testdata/sf0.1", "labels")
    got = op8_quality(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").collect()
    good = [r["score"] for r in got if r["quality"] == 1]
    bad = [r["score"] for r in got if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r["predicted"] for r in got if r["quality"] == 1]) > 0.98
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.96


def test_prior_and_risk(monkeypatch):
    rng = np.random.default_rng(3)
    pos = rng.normal(1.5, 1, (2000, 1))
    unl = np.concatenate([rng.normal(1.5, 1, (1400, 1)), rng.normal(-1.5, 1, (600, 1))])
    rng.shuffle(unl)
    assert abs(Q.tail_ratio(pos[:, 0], unl[:, 0]) - 0.7) < 0.08
    monkeypatch.setattr(Q, "STATS", 1)
    monkeypatch.setattr(Q, "PAIRS", 0)
    monkeypatch.setattr(Q, "DIMENSIONS", Q.BINS + 1)
    rows = np.concatenate([pos, unl])
    m = Q.fit_model(rows, np.zeros((len(rows), 0), np.float32), np.arange(len(rows)) < len(pos))
    assert abs(m["prior"] - 0.7) < 0.08
    assert (np.diff(m["y"]) >= 0).all() and m["y"][0] < 0.1 and m["y"][-1] > 0.9
    low, high = Q.probability(np.array([[-2.0], [2.0]]), np.zeros((2, 0), np.float32), m)
    assert low < 0.2 and high > 0.9


def test_quality_of_odd_tables(spark, frame):
    docs = frame(["good text here"] * 5 + [None, "", "x" * 9000], list(range(7)) + [None])
    labels = spark.createDataFrame([(0, 1), (1, None), (2, 0), (None, 1), (99, 1)], "doc_id long, quality int")
    model = Q.fit(docs, labels.where("quality = 1"), labels)
    got = Q.score(docs, model).collect()
    assert len(got) == 8 and all(0 <= r["score"] <= 1 for r in got)
    kept = Q.accepted(docs, model, 0.0)
    assert kept.columns == docs.columns and kept.count() == 8
    none = Q.fit(docs, labels.where("false"), labels)
    assert all(abs(r["score"] - 0.5) < 0.011 for r in Q.score(docs, none).collect())
    assert Q.score(frame([]), model).count() == 0 and Q.accepted(frame([]), model, 0.3).count() == 0
