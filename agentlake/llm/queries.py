"""One query per operator with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agentlake.llm import oracles
from agentlake.llm.ann import search
from agentlake.llm.bpe_codec import encode_decode
from agentlake.llm.conversation import repair
from agentlake.llm.decontaminate import decontaminate
from agentlake.llm.lexical_search import ranked
from agentlake.llm.line_dedup import line_dedup
from agentlake.llm.secret_scan import scan
from agentlake.llm.simhash import near_duplicates
from agentlake.llm.substring_dedup import substring_dedup
from agentlake.llm.suffix_dedup import suffix_dedup
from agentlake.llm.token_counts import token_counts
from agentlake.llm.toxicity import toxicity
from agentlake.llm.url_filter import filter_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op1_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op5_decontaminate": oracles.DECONTAMINATE,
    "op6_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op11_lexical_search": oracles.LEXICAL,
    "op12_conversation_repair": oracles.CONVERSATION,
    "op13_line_dedup": oracles.LINE_DEDUP,
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"))


@query
def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(_table(spark, sf_dir, "documents"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(_table(spark, sf_dir, "documents"))


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"))


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents"))


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents"))


@query
def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(_table(spark, sf_dir, "conversations"))


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_table(spark, sf_dir, "documents"))
