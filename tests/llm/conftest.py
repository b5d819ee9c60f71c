import re

import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    """Words by their definition, for brute-force checks."""
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingle_set(text, k=5):
    w = words(text)
    return set(zip(*[w[j:] for j in range(k)], strict=False)) if len(w) >= k else ({tuple(w)} if w else set())


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, score string, digest string"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from texts; the extra columns clash with names that the
    operators use themselves."""
    def make(texts, ids=None, langs=None, sources=None):
        n = len(texts)
        ids = list(range(n)) if ids is None else ids
        rows = [(ids[i], texts[i], langs[i] if langs else None, sources[i] if sources else None,
                 len(texts[i] or ""), 7, "x", "y") for i in range(n)]
        return spark.createDataFrame(rows, SCHEMA)

    return make
