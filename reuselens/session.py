"""Spark session helpers.

The library never creates its own cluster settings on top of a session that
is handed to it; ``get_spark`` is for scripts, tests and the bench.
"""

from __future__ import annotations

import contextlib
import gc
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans joins and coalesces small
# shuffle partitions at runtime, and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

LOCAL_CONF = {
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
    "spark.driver.memory": "16g",
}


def get_spark(master: str | None = None, app: str = "reuselens",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    conf = dict(DEFAULT_CONF)
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            conf.update(LOCAL_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is used as is. A
    scratch folder is made only for a local master, where one process reads
    and writes everything; any other master without the setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="reuselens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


PACKED = {"compression": "none", "parquet.block.size": 16 << 20, **{f"parquet.{x}.size.row.check.{y}": n for x in ("block", "page")
                                                                    for y, n in (("min", 1), ("max", 64))}}


def cut_lineage(df, spark: SparkSession | None = None, by: str | None = None, packed: bool = False):
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    and read it back: the lineage is cut, the data survives executor loss,
    and later branches scan a columnar file instead of recomputing.
    (Never a local checkpoint.) ``by``: an int column with a folder for each value,
    so that a filter on it reads no other. ``packed``: few large rows that are compressed
    already; pages and row groups are kept small, which readers and writers hold."""
    spark = spark or df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").options(**PACKED if packed else {}).parquet(path, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path) if by else spark.read.parquet(path)


@contextlib.contextmanager
def large_rows(spark: SparkSession, rows: int = 4):
    """While rows of some MB go to Python workers: few of them a batch. The JVM keeps
    buffers as large as the largest batch, outside its heap, for each thread."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def drop_tables(spark: SparkSession) -> None:
    """Remove the tables that ``cut_lineage`` has written in this session.
    For callers that have taken all results that read them."""
    _delete(spark, f"{checkpoint_dir(spark).rstrip('/')}/tables")


def _delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def drop_table(df) -> None:
    """Remove a table of ``cut_lineage`` that nothing reads any more."""
    for folder in {m[0] for f in df.inputFiles() if (m := re.match(r".*/tables/[0-9a-f]{32}(?=/)", f))}:
        _delete(df.sparkSession, folder)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished jobs: it does so when the
    driver's heap is collected, which a small driver's work doesn't cause."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def default_parallelism(spark: SparkSession) -> int:
    """Cores of the cluster."""
    return int(spark.sparkContext.defaultParallelism)
