"""From raw documents to packed training sequences: five stages over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as
the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rideloom.llm import decontaminate, minhash, packing, pii, quality
from rideloom.llm.queries import BYTE_BPE
from rideloom.workspace import cut_lineage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules and the isolation forest."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by five-word shingles at 0.8 or more."""
    return minhash.keep_one(docs, size=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.masked(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of sequences of 2,048 ids, with the ids of each piece."""
    return packing.pack(docs, BYTE_BPE, end_id=1, length=2048)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: The forest, the signatures and the latent space have no SQL form; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage reads what the one before it wrote."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
