"""The pipeline over ``documents``: toxic documents go, one of each group of near copies stays, documents with
benchmark passages go, personal data is masked, and what is left is packed into sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows it is given. All but the last return the columns of
``docs``. Between stages the rows are written as Parquet and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keyedload.llm import decontam, packing, pii, simhash, toxicity
from keyedload.llm.common import documents, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not call toxic. It is fitted on labels of the rows given."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of 3-word SimHash fingerprints linked at 2 bits or fewer: that with the smallest id, nulls last."""
    return simhash.one_of_each_group(docs, shingle=3, max_distance=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word window of a benchmark item."""
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every character of every document in sequences of 8192 characters."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("best-fit packing", pack_sequences),
]

# The fitted machine, the bit components and the packing have no SQL; tests hold each stage against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
