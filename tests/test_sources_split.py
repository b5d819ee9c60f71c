import os

import numpy as np
from pyspark.sql import functions as F

from reuselens.operators import classify as CL
from reuselens.sources import corpus as C


def test_tolerant_load_and_missing_report(spark, tmpdir_path):
    d = tmpdir_path
    meta = os.path.join(d, "file_information.csv")
    with open(meta, "w") as f:
        f.write("File,Task,Category\na.txt,a,non\nb.txt,b,cut\nc.txt,a,orig\n")
    texts = os.path.join(d, "texts", "sub")
    os.makedirs(texts)
    with open(os.path.join(texts, "a.txt"), "wb") as f:
        f.write("Hello, World!\nSecond line".encode())
    with open(os.path.join(texts, "c.txt"), "wb") as f:
        f.write(b"caf\xc3\xa9 \xff bad byte")
    df = C.load_corpus(spark, meta, os.path.join(d, "texts"))
    rows = {r.File: r for r in df.collect()}
    assert rows["a.txt"].clean_text == "hello world second line"
    assert rows["b.txt"].raw_text == "" and not rows["b.txt"].has_text
    assert rows["c.txt"].raw_text == "café  bad byte"
    assert rows["c.txt"].plag_label == -1 and rows["b.txt"].category_id == 3
    texts_df = C.read_text_files(spark, os.path.join(d, "texts"))
    miss = C.missing_report(C.read_metadata(spark, meta), texts_df, "File", "file")
    assert [r.File for r in miss.collect()] == ["b.txt"]


def test_folder_precedence(spark, tmpdir_path):
    """The text folder itself, then data, texts, files, then other folders by path."""
    d = tmpdir_path
    meta = os.path.join(d, "m.csv")
    with open(meta, "w") as f:
        f.write("File,Task,Category\n" + "".join(f"{n}.txt,a,non\n" for n in "abcde"))
    root = os.path.join(d, "in")
    for folder, names in (("", "a"), ("data", "ab"), ("texts", "abc"), ("files", "abcd"), ("aa", "abcde"), ("zz/data", "e")):
        os.makedirs(os.path.join(root, folder), exist_ok=True)
        for n in names:
            with open(os.path.join(root, folder, f"{n}.txt"), "w") as f:
                f.write(folder or "root")
    got = {r.File: r.raw_text for r in C.load_corpus(spark, meta, root).collect()}
    assert got == {"a.txt": "root", "b.txt": "data", "c.txt": "texts", "d.txt": "files", "e.txt": "aa"}
    plan = C.choose_paths(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_sinks_of_cluster_and_level_frames(spark, tmpdir_path):
    """The derived columns survive both formats."""
    df = spark.createDataFrame([("a.txt", "a", "non", 3, 0, "non-plagiarised"), ("b.txt", "b", None, 1, None, "cut / near copy")],
                               "File string, Task string, Category string, kmeans_cluster int, "
                               "kmeans_cluster_mapped_to_task int, predicted_plagiarism_level string")
    for cols in (df.columns[:5], df.columns[:3] + df.columns[5:]):
        for fmt in ("parquet", "csv"):
            p = os.path.join(tmpdir_path, f"{fmt}{len(cols)}")
            C.write_table(df.select(*cols), p, fmt)
            back = C.read_preprocessed(spark, p, fmt, schema=df.select(*cols).schema if fmt == "csv" else None)
            assert back.columns == cols and back.count() == len(df.collect())
            assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_write_read_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "line one\nline two, \"quoted\""), (2, "")], "id int, t string")
    for fmt in ("parquet", "csv"):
        p = os.path.join(tmpdir_path, fmt)
        C.write_table(df, p, fmt)
        back = C.read_preprocessed(spark, p, fmt, schema=df.schema if fmt == "csv" else None)
        got = {r.id: (r.t or "") for r in back.collect()}
        assert got == {1: "line one\nline two, \"quoted\"", 2: ""}


def test_stratified_split_exact(spark):
    rng = np.random.RandomState(0)
    rows = [(int(i), int(rng.choice([0, 1, 2], p=[0.6, 0.3, 0.1]))) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, label int")
    got = {r.id: r.is_test for r in CL.stratified_split(df, "id", "label").collect()}
    u = {r.id: r.u for r in df.select("id", CL.split_hash("id").alias("u")).collect()}
    for lab in (0, 1, 2):
        ids = sorted((u[i], i) for i, l in rows if l == lab)
        k = int(np.floor(len(ids) * 0.2 + 0.5))
        assert {i for _, i in ids[:k]} == {i for _, i in ids if got[i]}
    w = {r.label: r.weight for r in CL.class_weights(df, "label").collect()}
    n = {lab: sum(1 for _, l in rows if l == lab) for lab in (0, 1, 2)}
    for lab in (0, 1, 2):
        assert abs(w[lab] - 600 / (3 * n[lab])) < 1e-12
