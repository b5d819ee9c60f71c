import hashlib
import random
import re

from reuselens.llm import exact_dedup as X


def brute(rows):
    """doc_id, keep_id, group_size, kept, sha by sorting each group."""
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
    out = []
    for norm, g in groups.items():
        g = sorted(g, key=lambda x: (-len(x[1]), x[0] is None, x[0] or 0))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, g[0][0], len(g), n == 0, sha) for n, (i, _) in enumerate(g)]
    return out


TEXTS = ["a b", "ab", "a  b\n", None, "", " \t", "é", "é", "x" * 5000, "x" * 5000 + " ", "ab", "A b"]


def test_groups_ties_nulls_and_repeats(frame):
    ids = [5, 3, 9, 1, 2, 4, 8, 7, 10, 11, 3, None]
    got = [tuple(r) for r in X.exact_dedup(frame(TEXTS, ids)).collect()]
    assert sorted(got, key=repr) == sorted(brute(list(zip(ids, TEXTS, strict=True))), key=repr)
    kept = frame(TEXTS, ids)
    stay = X.without_copies(kept)
    assert stay.columns == kept.columns
    expected = sorted(((i, g) for i, g, _, k, _ in brute(list(zip(ids, TEXTS, strict=True))) if k), key=repr)
    assert sorted((r["doc_id"] for r in stay.collect()), key=repr) == sorted((i for i, _ in expected), key=repr)


def test_repeated_rows_keep_one(frame):
    docs = frame(["same", "same", "same"], [1, 1, 1])
    assert [r["kept"] for r in X.exact_dedup(docs).collect()].count(True) == 1
    assert X.without_copies(docs).count() == 1


def test_empty_table(frame):
    assert X.exact_dedup(frame([])).count() == 0 and X.without_copies(frame([])).count() == 0


def test_index_against_a_dict():
    """Insertions, deletions and overflow in random order."""
    rng = random.Random(5)
    index, plain = X.DigestIndex(4), {}
    pool = [hashlib.sha256(str(i).encode()).digest() for i in range(600)]
    pool += [p[:2] + bytes(6) + p[8:16] + bytes([i]) * 16 for i, p in enumerate(pool[:9] * 2)]  # equal marks and places
    for _ in range(6000):
        d = rng.choice(pool)
        if rng.random() < 0.4:
            assert index.delete(d) == (plain.pop(d, None) is not None)
        else:
            assert index.upsert(d, (1, 0, 0), X.better) == (d not in plain)
            plain[d] = plain.get(d, 0) + 1
        assert index.contains(d) == (d in plain)
    assert index.resizes and len(index) == len(plain)
    assert {d: p[0] for d, p in index.items()} == plain
    assert all(index.maybe(d) for d in plain)


def test_update_index(spark, frame):
    first, second = frame(["a", "b", "b"], [1, 2, 3]), frame(["b ", "c"], [4, 5])
    index = X.digest_groups(X.digests(first))
    gone = spark.createDataFrame([(bytearray(hashlib.sha256(t).digest()),) for t in (b"a", b"z")], "digest binary")
    got = {(bytes(r["digest"]), r["group_size"], r["best_chars"], r["keep_id"])
           for r in X.update_index(index, X.digests(second), gone).collect()}
    assert got == {(hashlib.sha256(b"b").digest(), 3, 2, 4), (hashlib.sha256(b"c").digest(), 1, 1, 5)}
