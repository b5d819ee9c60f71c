"""Registered queries against their SQL, and the pipeline against its parts."""

import re

import pytest

from tests.llm.conftest import shingle_set
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    import __spark_entry__ as E
    names = E.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names


@pytest.mark.parametrize("name", ["op4_mixing", "op7_url_filter", "op9_exact_dedup", "op12_centroids", "op13_divergence"])
def test_against_sql(spark, name):
    from reuselens.llm.queries import ORACLES, QUERIES
    r = compare(spark, duck(SF), name, QUERIES[name], ORACLES[name], SF)
    assert r["cols"] and r["rows"] and r["values"], r["diff"]


def test_nothing_else_imports_the_subpackage():
    import pathlib
    root = pathlib.Path(__file__).parents[2]
    for p in [*root.glob("reuselens/**/*.py"), *root.glob("*.py")]:
        if "llm" not in p.parts and p.name not in ("__spark_entry__.py", "corpus_pipeline.py"):
            assert not re.search(r"reuselens[.]llm|import llm|corpus_pipeline", p.read_text()), p


def test_pipeline_stages(spark, tmp_path):
    """Each stage against a plain computation on its own input."""
    import corpus_pipeline as C
    from reuselens.llm import decontaminate, pu_quality
    from reuselens.llm.common import table
    from reuselens.llm.queries import QUALITY_AT, quality_model

    docs = table(spark, SF, "documents")
    assert [n for n, _ in C.STAGES] == ["quality", "exact", "near", "benchmark", "mix"]
    for i, (name, stage) in enumerate(C.STAGES):
        before = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
        after = stage(spark, docs, SF)
        after.write.parquet(str(tmp_path / str(i)))
        after = spark.read.parquet(str(tmp_path / str(i)))
        left = {r["doc_id"] for r in after.select("doc_id").collect()}
        if name == "mix":
            assert left == set(before) and "taken" in after.columns
            rows = after.collect()
            break
        assert after.columns == docs.columns and left <= set(before)
        if name == "quality":
            model = quality_model(docs, table(spark, SF, "labels"))
            expected = {r["doc_id"] for r in pu_quality.score(docs, model).collect() if r["score"] >= QUALITY_AT}
        elif name == "exact":
            best = {}
            for d, t in sorted(before.items()):
                norm = re.sub(r"[\x20\x09-\x0D]", "", t)
                if norm not in best or len(t) > len(before[best[norm]]):
                    best[norm] = d
            expected = set(best.values())
        elif name == "near":
            sets = {d: shingle_set(t) for d, t in before.items()}
            part = {d: d for d in sets}
            for a in sorted(sets):
                for b in sorted(sets):
                    if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                        x, y = sorted((part[a], part[b]))
                        part = {d: x if p == y else p for d, p in part.items()}
            expected = {d for d, p in part.items() if p == d}
        else:
            hits = decontaminate.find_items(docs, table(spark, SF, "benchmark")).collect()
            expected = set(before) - {r["doc_id"] for r in hits}
        assert left == expected, name
        docs = after
    whole = C.run(spark, SF).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, rows))
