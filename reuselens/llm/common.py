"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reuselens.session import cut_lineage
from reuselens.sources.corpus import read_table

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def held_out(modulus: int, remainder: int, key: str = "doc_id") -> Column:
    """True where ``crc32(key as text) mod modulus`` is ``remainder``; a null
    key is never held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus == remainder,
                      F.lit(False))


def materialise(df: DataFrame) -> DataFrame:
    """Write to the shared checkpoint folder and read back."""
    return cut_lineage(df)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out
