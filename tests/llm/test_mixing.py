import random

import pytest

from reuselens.llm import mixing as M
from tests.llm.conftest import words


def shared(sizes, most=3):
    """Targets by sharing the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total >= most * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = float(most * sizes[s])
        left -= sum(target[s] for s in over)
        free -= over
    return target


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for s, n, long in (("b", 300, 30), ("a", 40, 20), ("é", 25, 5), ("B", 9, 4), (None, 30, 12), ("zero", 4, 0), ("c", 5, 400)):
        out += [(s, " ".join(["w"] * rng.randint(0, long))) for _ in range(n)]
    return out + [("a", None), ("a", "")]


def test_targets_and_taken(spark, frame, rows):
    docs = frame([t for _, t in rows], sources=[s for s, _ in rows])
    weights = spark.createDataFrame([(0, 2.0), (0, 5.0), (1, None), (2, 0.0)], "doc_id long, weight double")
    got = M.mix(docs, weights, bucket_rows=16).collect()
    assert len(got) == len(rows)
    sizes = {}
    for s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    targets = shared(sizes)
    by = {}
    for r in got:
        assert r["size"] == len(words(rows[r["doc_id"]][1])) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert r["epochs"] * r["size"] <= r["taken"] <= min(3, r["epochs"] + 1) * r["size"]
        by.setdefault(r["source"], []).append(r)
    for s, own in by.items():
        assert targets[s] - 1 < sum(r["taken"] for r in own) <= targets[s] + 1e-6
        # the fraction is a beginning of the draw order
        part = [r["taken"] - r["epochs"] * r["size"] for r in sorted(own, key=lambda r: (r["draw_key"], r["doc_id"])) if r["size"]]
        whole = [r["size"] for r in sorted(own, key=lambda r: (r["draw_key"], r["doc_id"])) if r["size"]]
        full = sum(p == w for p, w in zip(part, whole, strict=True))
        assert part[:full] == whole[:full] and not any(part[full + 1:])
    again = M.mix(docs.repartition(7), weights, bucket_rows=5).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_weights_draw_first(spark, frame):
    """A document of weight 8 is drawn before one of weight 1 in 8 of 9 cases."""
    n = 1500
    weights = spark.createDataFrame([(i, 8.0 if i % 2 else 1.0) for i in range(n)], "doc_id long, weight double")
    keys = {r["doc_id"]: r["draw_key"] for r in M.mix(frame(["w"] * n), weights).collect()}
    first = sum(keys[i + 1] < keys[i] for i in range(0, n, 2)) / (n / 2)
    assert abs(first - 8 / 9) < 0.04


def test_degenerate(frame):
    assert M.mix(frame([])).count() == 0
    got = M.mix(frame([None, ""], [None, 3])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2
    got = M.mix(frame(["a b", "a b c"], [1, 1], sources=["s", "s"])).collect()  # repeated id
    assert sorted((r["size"], r["taken"]) for r in got) == [(2, 2), (3, 3)]
