"""Plan-level checks: column pruning reaches the parquet scan."""
import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_label_queries_never_read_text(spark):
    for name in ("label_ids", "answers_only", "label_counts", "encode_task", "purity"):
        plan = _plan(E.queries()[name](spark, SF))
        assert "text:string" not in plan, name
        assert "ReadSchema" in plan


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_text_queries_read_only_needed_columns(spark):
    plan = _plan(E.queries()["clean_text"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_texts_are_dealt_only_where_asked(spark):
    from reuselens.sources import corpus as C

    df = spark.range(0, 1000, 1, numPartitions=3).withColumnRenamed("id", "doc_id")
    assert C.dealt(df, "doc_id") is df
    spark.conf.set(C.TEXT_TASKS, "5")
    try:
        assert C.dealt(df, "doc_id").rdd.getNumPartitions() == 5
    finally:
        spark.conf.unset(C.TEXT_TASKS)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    """Off a local master, a missing setting is an error and no scratch folder."""
    from types import SimpleNamespace

    from reuselens import session

    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None,
                         getConf=lambda: SimpleNamespace(get=lambda *a: None))
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(fake)
