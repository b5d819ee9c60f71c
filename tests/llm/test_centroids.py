"""Centroid clustering against plain integers in Python."""

import hashlib
import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from reuselens.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string, n int"


def plain(rows, k, rounds, dims):
    kept = [(i, [math.floor(64 * v) for v in x]) for i, x in rows
            if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) for v in x)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    cents = [x for _, x in start]
    apart = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    assign = lambda: [min((apart(x, c), j) for j, c in enumerate(cents)) for _, x in kept]
    for _ in range(rounds):
        own = assign()
        for j in range(len(cents)):
            members = [x for (_, x), a in zip(kept, own, strict=True) if a[1] == j]
            if members:
                cents[j] = [sum(col) // len(members) for col in zip(*members, strict=True)]
    return sorted((repr(i), a[1], a[0]) for (i, _), a in zip(kept, assign(), strict=True)), cents


def test_against_plain(spark):
    rnd = np.random.RandomState(3)
    rows = [(int(i), [float(v) for v in rnd.normal(size=7)]) for i in range(300)]
    rows += [(5, rows[5][1]), (5, rows[9][1]), (None, rows[3][1]), (None, rows[4][1]), (900, [0.25] * 7), (901, [0.25] * 7)]
    bad = [(1000, None), (1001, []), (1002, [1.0] * 6), (1003, [1.0] * 6 + [None]), (1004, [float("nan")] * 7), (1005, [float("-inf")] + [0.0] * 6)]
    df = spark.createDataFrame([(i, x, "a", "b", 1) for i, x in rows + bad], SCHEMA).repartition(3)
    assigned, cents = C.cluster(df, k=6, dimensions=7, width=2)
    expected, plain_cents = plain(rows, 6, 3, 7)
    assert sorted((repr(r[0]), r[1], r[2]) for r in assigned.collect()) == expected
    assert cents.tolist() == plain_cents
    out = C.with_inertia(assigned, cents).collect()
    assert {r["inertia"] for r in out} == {sum(x[2] for x in expected)}
    assert all(r["cluster_inertia"] == sum(x[2] for x in expected if x[1] == r["cluster"]) for r in out)
    assert all(r["centroid_sha256"] == hashlib.sha256(",".join(map(str, plain_cents[r["cluster"]])).encode()).hexdigest() for r in out)


def test_few_and_no_vectors(spark):
    two = spark.createDataFrame([(1, [0.5, 0.5], "", "", 0), (2, [-0.5, 0.5], "", "", 0)], SCHEMA)
    assigned, cents = C.cluster(two, dimensions=2)
    assert len(cents) == 2 and sorted(r["distance"] for r in assigned.collect()) == [0, 0]
    none = C.with_inertia(*C.cluster(two.limit(0), dimensions=2))
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 9), st.integers(1, 4), st.integers(0, 1000))
def test_dictionaries_lose_nothing(n, dims, width, seed):
    rnd = np.random.RandomState(seed)
    x = rnd.randint(-3, 3, (n, dims)).astype(np.int64)
    codes, entries = C.encode(x, width)
    assert np.array_equal(np.concatenate([e[codes[:, b]] for b, e in enumerate(entries)], axis=1), x)
    assert all(len(np.unique(e, axis=0)) == len(e) for e in entries)
    cents = rnd.randint(-3, 3, (4, dims)).astype(np.int64)
    cluster, distance = C.nearest(codes, entries, cents)
    every = ((x[:, None] - cents[None]) ** 2).sum(axis=2)
    assert np.array_equal(cluster, every.argmin(axis=1)) and np.array_equal(distance, every.min(axis=1))
    assert np.array_equal(C.cluster_sums(codes, entries, cluster, 4), np.stack([x[cluster == j].sum(axis=0) for j in range(4)]))
