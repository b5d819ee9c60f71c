import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reuselens.llm import kernels as K
from reuselens.llm import suffix_tree as S
from reuselens.llm.common import held_out
from tests.llm.conftest import words


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    line = "one two three four five six seven eight nine ten".split()
    out = [None, "", "Unseen", "A a A a"]
    for i in range(300):
        w = [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 40))]
        if i % 2:
            w[len(w) // 2:len(w) // 2] = line
        out.append(" ".join(w) + (f" rare{i % 90}" if i % 3 else ""))
    return out


@pytest.mark.parametrize("entries", [S.ENTRIES, 60])
def test_base_score_by_brute_force(frame, texts, entries):
    """Also when few words reach the support and the rest is joined."""
    got = {r["doc_id"]: r for r in S.score_texts(frame(texts), ~held_out(7, 2), entries=entries).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))}
    syms = [words(t) + [None] for t in texts]
    count = collections.Counter(w for i, s in enumerate(syms) if not held[i] for w in s)
    n, v = sum(count.values()), len(count)
    for i, s in enumerate(syms):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(s), sum(count[w] > 0 for w in s), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in s))
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_states_are_distributions(frame, texts):
    """After any context, the probabilities of all symbols add up to 1."""
    tree, counts, vocabulary, n, v = S.learn(frame(texts), least=3)
    assert sum(tree.states) > 5
    known = {r["key"]: r["n"] for r in vocabulary.collect()}
    keys = np.array(list(known), np.int64).view(np.uint64)
    root = np.array([(known[k] + 1) / (n + v + 1) for k in known])
    for context in ("", "a", "one two", "six seven", "rare1", "unseen a", "three"):
        _, data, off = next(K.utf8_pieces(pa.array([context], pa.string())))
        before = S.symbols(data, off)[0][:-1]
        total = 0.0
        for k, p in zip(keys, root, strict=True):
            text = np.append(before, k)
            _, gain = tree.gains(text, np.array([0, len(text)]))
            total += p * math.exp(gain[-1])
        unseen = np.append(before, np.uint64(12345))
        _, gain = tree.gains(unseen, np.array([0, len(unseen)]))
        total += math.exp(gain[-1]) / (n + v + 1)
        assert total == pytest.approx(1, abs=1e-9)


def test_degenerate(frame):
    docs = frame(["a b", None, "a b"], [1, 1, None])
    got = S.score_texts(docs, ~held_out(7, 2)).collect()
    assert len(got) == 3 and sorted(r["n_tokens"] for r in got) == [1, 3, 3]
    assert S.score_texts(frame([]), F.lit(True)).count() == 0
    none = S.score_texts(docs, F.lit(False)).collect()
    assert all(r["score"] == r["base_score"] == 0 and r["train_tokens"] == 0 for r in none)


def test_no_string_is_dropped_in_a_large_corpus(frame, texts, monkeypatch):
    """Where the strings are too many for one task, those that occur twice are
    still states: the same scores, chunk by chunk and bucket by bucket."""
    monkeypatch.setattr(S.suffix_shuffle, "CHUNK", 500)
    monkeypatch.setattr(S.suffix_shuffle, "BUCKET", 1000)
    docs = frame([*texts, "planted words that nobody else writes", "planted words that nobody else writes", None],
                 [*range(len(texts)), 1001, 1002, None])
    small, large = ({(r["doc_id"], r["n_tokens"]): r for r in S.score_texts(docs, ~held_out(7, 2), entries=e).collect()}
                    for e in (S.ENTRIES, 60))
    assert len(small) == len(texts) + 3 and small.keys() == large.keys()
    for k, a in small.items():
        b = large[k]
        exact = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "n_in_state"]
        assert [a[c] for c in exact] == [b[c] for c in exact]
        assert (a["base_score"], a["score"]) == pytest.approx((b["base_score"], b["score"]))
    assert large[1001, 7]["n_in_state"] >= 6
