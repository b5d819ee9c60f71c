"""A training corpus from the table ``documents``, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``; all but the last
return the columns of ``documents``.

1. ``quality``: the positive-unlabelled classifier; rejected documents go.
2. ``exact``: one document of each group of equal texts stays.
3. ``near``: one document of each component of the n-gram Jaccard join stays.
4. ``benchmark``: documents that hold a benchmark item go.
5. ``mix``: the words that a mix of the sources takes from each document.

The classifier and the suffix indexes have no SQL, so ``ORACLE_SQL`` is None;
``tests/llm`` hold the stages against brute force.
"""

from __future__ import annotations

from reuselens.llm import decontaminate, exact_dedup, jaccard_join, mixing, pu_quality
from reuselens.llm.common import materialise, table
from reuselens.llm.queries import QUALITY_AT, quality_model, quality_weights


def quality(spark, docs, sf_dir):
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return pu_quality.accepted(docs, model, QUALITY_AT)


def exact(spark, docs, sf_dir):
    return exact_dedup.without_copies(docs)


def near(spark, docs, sf_dir):
    return jaccard_join.one_of_each(docs)


def benchmark(spark, docs, sf_dir):
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def mix(spark, docs, sf_dir):
    return mixing.mix(docs, quality_weights(spark, sf_dir)).drop("draw_key")


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("benchmark", benchmark), ("mix", mix)]

ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
