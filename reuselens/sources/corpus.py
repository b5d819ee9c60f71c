"""Corpus sources: the driver's parquet tables and plain text files.

Two frames are kept apart on purpose:

* the *label frame* (``doc_id, task, category, ...``) holds only small
  columns and is joined to other tables freely;
* the *text frame* (``doc_id, raw_text, clean_text``) holds the big column
  and is never shuffled just to attach labels.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reuselens.functions import labels as L
from reuselens.functions import text as X

# Fixed convention for the driver tables: every 20th document is an
# original (5 of 100, as in the reference corpus), ``lang`` is the task and
# the (quality, toxic) pair of ``labels`` gives the category.
ORIGINAL_EVERY = 20
CATEGORY_BY_LABELS = {(1, 0): "non", (1, 1): "heavy", (0, 1): "light", (0, 0): "cut"}

METADATA_SCHEMA = T.StructType([
    T.StructField("File", T.StringType()),
    T.StructField("Task", T.StringType()),
    T.StructField("Category", T.StringType()),
])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Session setting: tasks to deal the texts to after the scan. For a file of
#: one row group, which a single task reads. Unset, texts are never shuffled.
TEXT_TASKS = "spark.reuselens.textTasks"


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The rows as read, or dealt by ``key`` where the session asks for it."""
    tasks = df.sparkSession.conf.get(TEXT_TASKS, None)
    return df.repartition(int(tasks), key) if tasks else df


def category_from_labels(doc_id="doc_id", quality="quality", toxic="toxic"):
    d, q, t = F.col(doc_id), F.col(quality), F.col(toxic)
    expr = F.when(F.pmod(d, F.lit(ORIGINAL_EVERY)) == 0, F.lit("orig"))
    for (qv, tv), name in CATEGORY_BY_LABELS.items():
        expr = expr.when((q == qv) & (t == tv), F.lit(name))
    return expr  # unlabelled -> NULL


def with_label_columns(df: DataFrame, category: str = "category") -> DataFrame:
    """P1-P3 applied to a frame with a category column."""
    return (df.withColumn("category_id", L.category_id(category))
              .withColumn("plag_label", L.plag_label(category))
              .withColumn("truth_level", L.truth_level(category)))


def corpus_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, task, category, category_id, plag_label, truth_level.

    Reads only ``doc_id, lang`` of ``documents`` (no text) and left-joins
    ``labels`` on the key, so documents without labels keep a NULL category.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("task"))
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    df = docs.join(lab, "doc_id", "left").select(
        "doc_id", "task", category_from_labels().alias("category"))
    return with_label_columns(df)


def corpus_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, raw_text, clean_text for every document (whole texts)."""
    docs = dealt(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("raw_text"),
                       X.clean_text("text").alias("clean_text"))


def is_original(doc_id="doc_id"):
    return F.pmod(F.col(doc_id), F.lit(ORIGINAL_EVERY)) == 0


def benchmark_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External originals: item_id, raw_text, clean_text."""
    b = dealt(read_table(spark, sf_dir, "benchmark").select("item_id", "text"), "item_id")
    return b.select("item_id", F.coalesce("text", F.lit("")).alias("raw_text"),
                    X.clean_text("text").alias("clean_text"))


# ---------------------------------------------------------------- files ----

def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata CSV with header ``File, Task, Category``."""
    return (spark.read.schema(METADATA_SCHEMA).option("header", True)
            .option("mode", "PERMISSIVE").csv(path))


def read_text_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """One row per file: ``file`` (base name), ``raw_text`` (UTF-8, bad
    bytes dropped). A directory is searched recursively, as in the
    reference's tolerant loader."""
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    df = reader.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_name").alias("file"),
                     F.col("_metadata.file_path").alias("path"),
                     X.drop_invalid_utf8("value").alias("raw_text"))


#: Folders under the text folder in order of precedence; files
#: elsewhere come after them, by path.
FOLDERS = ["", "data", "texts", "files"]


def choose_paths(spark: SparkSession, text_path: str) -> DataFrame:
    """``file, path``: one path for each file name, from the listing alone (no
    file is read)."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(text_path).select("path")
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text_path)
    root = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toString()
    inside = F.regexp_replace(F.expr("replace(path, '///', '/')"), F.lit("^" + re.escape(root.replace("///", "/")) + "/?"), F.lit(""))
    folder = F.regexp_extract(inside, "^(.*?)/?[^/]*$", 1)
    rank = F.lit(len(FOLDERS))
    for i, name in reversed(list(enumerate(FOLDERS))):
        rank = F.when(folder == name, F.lit(i)).otherwise(rank)
    return (listing.select(F.element_at(F.split("path", "/"), -1).alias("file"), rank.alias("rank"), "path")
            .groupBy("file").agg(F.min(F.struct("rank", "path")).alias("best"))
            .select("file", F.col("best.path").alias("path")))


def load_corpus(spark: SparkSession, metadata_path: str, text_path: str) -> DataFrame:
    """S3 + P1-P4: tolerant load of listed files.

    A listed file that is not found gets ``raw_text = ''`` (the reference's
    tolerant loader) and ``has_text = false``; use ``missing_report`` for the
    list. If a name occurs in several folders, the text folder itself and the
    usual subfolders come first (``FOLDERS``), then the first path.
    """
    meta = read_metadata(spark, metadata_path)
    paths = choose_paths(spark, text_path).join(meta.select(F.col("File").alias("file")).distinct(), "file", "left_semi")
    texts = read_text_files(spark, text_path).join(paths.select("path"), "path", "left_semi") \
        .select(F.col("file").alias("_file"), "raw_text")
    df = meta.join(texts, meta["File"] == texts["_file"], "left")
    df = df.select("File", "Task", "Category",
                   F.col("raw_text").isNotNull().alias("has_text"),
                   F.coalesce("raw_text", F.lit("")).alias("raw_text"))
    df = df.withColumn("clean_text", X.clean_text("raw_text"))
    return with_label_columns(df, "Category")


def missing_report(listing: DataFrame, store: DataFrame, key: str,
                   store_key: str | None = None) -> DataFrame:
    """Listed keys that have no row in the store (left anti join)."""
    store_key = store_key or key
    return listing.join(store.select(F.col(store_key).alias(key)), key, "left_anti")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Persist a derived table. Parquet by default; CSV with a header
    and quoted multi-line fields when asked for."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def read_preprocessed(spark: SparkSession, path: str, fmt: str = "parquet",
                      schema: T.StructType | None = None) -> DataFrame:
    """Read a table written by ``write_table``."""
    if fmt == "csv":
        r = spark.read.option("header", True).option("multiLine", True) \
            .option("quote", '"').option("escape", '"')
        r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
        return r.csv(path)
    return spark.read.format(fmt).load(path)
