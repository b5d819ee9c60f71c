import hashlib
import random

import numpy as np
import pytest

from reuselens.llm import suffix_dedup as S


def brute(rows, length=S.LENGTH):
    out, seen = {}, set()
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - length + 1):
            s = b[j:j + length]
            if s in seen:
                gone[j:j + length] = True
            seen.add(s)
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out[i] = (len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    line, passage = prose(30), prose(60)
    out = [None, "", "short", "a" * 400, "a" * 99, "a" * 100, "ab" * 150, "\x00" * 130, passage, passage]
    out += [prose(20) + line + prose(20) for _ in range(12)]                   # a common line
    for _ in range(10):                                                        # near copies
        w = passage.split()
        w[rng.randrange(len(w))] = word()
        out.append(" ".join(w))
    out += [prose(30) + passage[50:210] + prose(10), prose(40) * 2, line + line, prose(3000)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("group", [S.GROUP, 3])
def test_against_all_strings(frame, texts, group):
    """Whole results, also when keys with over three distinct rows are dealt
    out string by string."""
    got = {r["doc_id"]: r for r in S.remove_repeats(frame(texts), group=group).collect()}
    expected = brute(list(enumerate(texts)))
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == expected
    for i, r in got.items():  # the real outputs
        raw = (texts[i] or "").encode()
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]
        assert sum(e - s for s, e in zip(r["starts"], r["ends"], strict=True)) == r["n_removed"] <= len(raw)


def test_group_beyond_one_index(frame):
    """20,000 texts around one passage that is too short to repeat by itself:
    only those whose neighbouring bytes agree as well lose anything."""
    rng = random.Random(11)
    passage = "".join(rng.choices("abcdefgh ", k=90))
    texts = [f"{rng.randrange(10 ** 9):09d}{'x' if i % 50 else 'same words, '}{passage}{rng.randrange(300):03d} {i}"
             for i in range(20000)]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in S.remove_repeats(frame(texts)).collect()}
    assert got == brute(list(enumerate(texts)))
    assert 0 < sum(r[1] > 0 for r in got.values()) < 20000


@pytest.mark.parametrize("length, gram", [(100, 32), (101, 32), (9, 4), (5, 5)])
def test_each_string_is_of_one_side(length, gram):
    before, behind = S.side_bounds(length, gram)
    for left in range(length - gram + 1):
        assert (left >= before) + (length - gram - left >= behind) == 1


def test_repeated_rows_null_ids_and_empty_table(frame):
    a = "".join(random.Random(1).choices("abcdefgh ", k=250))
    got = S.remove_repeats(frame([a, a, a, a], [2, 2, 5, None])).collect()
    assert sorted(((r["doc_id"], r["n_removed"]) for r in got), key=repr) == [(2, 0), (2, 0), (5, 250), (None, 250)]
    assert S.remove_repeats(frame([])).count() == 0


def test_index_matches():
    """Streamed matching statistics against direct comparison."""
    rng = np.random.default_rng(1)
    text = rng.integers(0, 3, 400).astype(np.uint16)
    text[-1] = 0
    index = S.RunIndex(text)
    suffix = [[(0, p) if text[p] == 0 else (int(text[p]), 0) for p in range(i, len(text))] for i in range(len(text))]
    assert index.array.tolist() == sorted(range(len(text)), key=lambda i: suffix[i])
    got = index.matches()
    for a, b in zip(index.array[:-1], index.array[1:], strict=True):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n] != 0:
            n += 1
        assert got[b] == n
    assert len(index.runs) < len(text)


def test_texts_of_one_id_whose_hashes_agree_in_16_bits(spark, frame):
    """Two such texts are two documents: what they share goes from one only,
    at its own offsets, and the other keeps all."""
    rng = random.Random(5)
    prose = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    shared, start = prose(300), prose(150)
    many = spark.createDataFrame([(f"{start[:50 + i % 90]}{i} {shared}",) for i in range(1200)], "text string")
    rows = many.selectExpr("text", "xxhash64(text) & 65535 AS low").collect()
    by: dict = {}
    for r in rows:
        by.setdefault(r["low"], []).append(r["text"])
    pair = next(x[:2] for x in by.values() if len(x) > 1)
    got = S.remove_repeats(frame(pair, [None, None])).collect()
    order = {r["text"]: r["h"] for r in many.selectExpr("text", "xxhash64(text) AS h").collect()}
    expected = brute([(order[t], t) for t in pair])
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted(expected.values())
