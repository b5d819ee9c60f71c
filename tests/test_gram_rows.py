"""Gram rows of the SVD: whole, bounded, and dealt to as many blocks as the weights ask for."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reuselens.operators import clustering as CU
from reuselens.operators import packed as P
from reuselens.operators import tfidf as TF


@pytest.fixture(scope="module")
def weights(spark):
    rng = np.random.default_rng(5)
    rows = [(d, f"g{g:02d}", float(rng.random()) + 0.1) for d in range(60) for g in rng.choice(20, 12, replace=False)]
    return spark.createDataFrame(rows, "doc_id long, gram string, w double")


def test_blocks_of_grams_grow_with_the_weights(weights, monkeypatch):
    """Few grams with many weights each: one block held them all before."""
    monkeypatch.setattr(CU, "CELL_WEIGHTS", 100)
    cells = CU.weight_cells(weights)
    assert cells.where(F.col("gb") >= 0).select("gb").distinct().count() > 2


def test_gram_rows_are_whole_and_bounded(weights, monkeypatch):
    monkeypatch.setattr(CU, "ENTRIES", 30)
    cells = CU.weight_cells(weights)
    sizes = [tuple(r) for r in cells.where("gb < 0").select("db", "n").collect()]
    found = CU.gram_rows(cells, sizes, 2).toArrow()
    rows = [P.unpack(x) for x in found["blob"]]
    grams = [P.numbers(P.unpack(x), "hash") for x in found["hash"]]
    assert sum(x.num_rows for x in rows) == weights.count()
    assert max(x.num_rows for x in rows) < 30 + 60                     # and one gram of all documents
    assert sum(map(len, grams)) == len(np.unique(np.concatenate(grams)))  # no gram in two rows
    assert sum(P.numbers(x, "x").sum() for x in rows) == pytest.approx(weights.agg(F.sum("w")).first()[0])


def test_start_by_column():
    ids = np.array([3, -7, 11])
    assert np.array_equal(CU._start(ids, 6, 42, 2, 5), CU._start(ids, 6, 42, 0, 6)[2:5])


def test_numbers_packed_by_bytes():
    x = np.array([0, 1, 255, 256, 70_000, -1, -300])
    assert P.bytes_joined(P.unpack_bytes(P.pack(**P.bytes_apart("x", x))), "x").tolist() == x.tolist()


def test_answers_leave_no_table(spark):
    """What the weights were made with goes when they are written."""
    from reuselens.session import checkpoint_dir
    texts = spark.createDataFrame([(1, "one two three"), (2, "one two four")], "doc_id long, clean_text string")
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/tables")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    count = lambda: len(fs.listStatus(root)) if fs.exists(root) else 0
    before = count()
    TF.tfidf_cells(texts)
    assert count() == before + 1
