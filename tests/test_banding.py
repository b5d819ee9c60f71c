"""MinHash banding: nothing is lost, hot buckets are cut."""

import numpy as np
import pytest

from reuselens.operators import banding as BA
from reuselens.operators import minhash as MH


def test_a_band_without_a_difference_is_left():
    for least in (1, 35, 61, 86, 100):
        cut = BA.bands(least)
        assert len(cut) == 101 - least and all(n > 0 for _, n in cut)
        assert [p for at, n in cut for p in range(at, at + n)] == list(range(1, 101))
    with pytest.raises(ValueError):
        BA.bands(0)


def _signatures(spark):
    """Groups of signatures that differ from a base in a few positions, copies
    of some, and a crowd that shares half of its positions."""
    rnd = np.random.RandomState(4)
    rows = []
    for base in range(6):
        s = rnd.randint(0, 1000, 20)
        for _ in range(12):
            x = s.copy()
            at = rnd.choice(20, rnd.randint(0, 12), replace=False)
            x[at] = rnd.randint(0, 1000, len(at))
            rows.append(x)
    half = rnd.randint(0, 1000, 20)
    for _ in range(80):
        x = rnd.randint(0, 1000, 20)
        x[:10] = half[:10]
        rows.append(x)
    rows += rows[3:9]
    out = [(int(i) if i % 17 else None, [int(v) for v in x]) for i, x in enumerate(rows, 1)]
    out += [(900, [MH.SENTINEL] * 20), (901, [MH.SENTINEL] * 20)]
    return out, spark.createDataFrame(out, "doc_id long, signature array<long>")


@pytest.mark.parametrize("hot", [2048, 5])
@pytest.mark.parametrize("least", [8, 13, 17])
def test_against_all_pairs(spark, least, hot):
    rows, df = _signatures(spark)
    by = {}
    for i, s in rows:
        if s[0] != MH.SENTINEL:
            by.setdefault(tuple(s), []).append(i)
    last = 1 << 62
    reps = [(min((i for i in ids if i is not None), default=None), s, len(ids)) for s, ids in by.items()]
    reps.sort(key=lambda r: last if r[0] is None else r[0])
    expected = sorted(repr((a[0], b[0], sum(x == y for x, y in zip(a[1], b[1], strict=True)) / 20, *sorted((a[2], b[2]))))
                      for k, a in enumerate(reps) for b in reps[k + 1:]
                      if sum(x == y for x, y in zip(a[1], b[1], strict=True)) >= least)
    got = BA.similar_signatures(df, least, num_hashes=20, hot=hot).collect()
    assert sorted(repr((r[0], r[1], r[2], *sorted((r[3], r[4])))) for r in got) == expected and len(expected) > 20


def test_hot_buckets_meet_in_parts(spark):
    """The crowd's common bands hold 80 classes: no key group is larger than
    two parts, and the candidates stay the same."""
    classes = BA.signature_classes(_signatures(spark)[1])
    whole = {tuple(r) for r in BA.candidates(classes, 13, 20).collect()}
    assert {tuple(r) for r in BA.candidates(classes, 13, 20, hot=10).collect()} == whole and len(whole) >= 80 * 79 // 2


def test_empty(spark):
    df = spark.createDataFrame([(1, [MH.SENTINEL] * 100)], "doc_id long, signature array<long>")
    assert BA.similar_signatures(df, 61).count() == 0


def test_bits_leave_out_what_cannot_be_similar(spark):
    """The crowd shares half of its positions: its 3,160 pairs share a band, but
    few pass the bits; no pair with enough equal positions is lost."""
    rows, df = _signatures(spark)
    classes = BA.signature_classes(df)
    sig = {r.cid: r.signature for r in classes.collect()}
    kept = {tuple(r) for r in BA.candidates(classes, 17, 20, compare=True).collect()}
    whole = {tuple(r) for r in BA.candidates(classes, 17, 20).collect()}
    enough = {(a, b) for a, b in whole if sum(x == y for x, y in zip(sig[a], sig[b], strict=True)) >= 17}
    assert enough <= kept < whole and len(kept) < 0.2 * len(whole) and len(whole) > 3000
