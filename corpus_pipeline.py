"""A corpus pipeline over ``documents``: toxic texts go, of near duplicates one stays,
contaminated texts go, secrets are masked, and what is left is encoded and decoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agentlake.llm.bpe_codec import encode_decode
from agentlake.llm.decontaminate import uncontaminated
from agentlake.llm.secret_scan import redact
from agentlake.llm.simhash import representatives
from agentlake.llm.toxicity import clean
from agentlake.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents predicted toxic; the labels are those of the data folder."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least doc_id of each group of near duplicates."""
    return representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks the secrets in the texts; n_chars follows where a text changed."""
    return redact(docs, size="n_chars")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded texts of what is left."""
    return encode_decode(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("encoding", encoding)]

#: Training and scoring a network, SimHash groups and BPE are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
