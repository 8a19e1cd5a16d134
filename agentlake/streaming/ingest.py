"""Incremental import: delta files in, deduplicated records out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agentlake.operators.health import trusted_offset

PARTS = 64  # partitions of a merge target
STORED = "conversation_id string, uuid string, seq long, source string, batch long, part int"
DELTA = "session_id string, byte_start long, byte_end long, complete boolean, file_size long, raw string"


def ingest_stream(spark: SparkSession, landing: str, files_per_trigger: int = 1_000) -> DataFrame:
    """ST01: the landing folder holds immutable delta files of lines with their byte range, so
    a trigger reads only what was appended; the checkpoint is the cursor. A cut last line is
    left out: the producer lands it again once it is complete."""
    rows = spark.readStream.schema(DELTA).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
    return rows.filter("complete").withColumn("v", F.try_parse_json("raw"))


def reset_on_shrink(lines: DataFrame, cursors: DataFrame) -> DataFrame:
    """ST09: the lines to send given each session's stored cursor. A file that is smaller than
    its cursor was rewritten, so its cursor counts as zero and everything goes again; ST02
    absorbs what was already stored."""
    size = lines.groupBy("session_id").agg(F.max("file_size").alias("__size"))
    at = size.join(cursors, "session_id", "left").select(
        "session_id", trusted_offset(F.coalesce("offset", F.lit(0)), F.col("__size")).alias("__from")
    )
    return lines.join(at, "session_id").filter(F.col("complete") & (F.col("byte_start") >= F.col("__from"))).drop("__from")


def _stored(spark: SparkSession, target: str) -> DataFrame | None:
    """What the target holds; None before the first write."""
    try:
        return spark.read.schema(STORED).parquet(f"{target}/records")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def merge_batch(batch: DataFrame, batch_id: int, target: str, source: str = "stream", parts: int = PARTS) -> None:
    """ST02: store the rows whose (conversation, uuid) is new; rows without a uuid are dropped
    and counted.

    A batch owns the folder of its writer (``source``) and number and overwrites it, so a
    replayed batch gives the same table and no writer touches another's rows. Rows lie in
    ``parts`` partitions by the hash of their conversation; only those a batch touches are read.
    Writers of one target run one after another: two at once could both store a new row."""
    spark = batch.sparkSession
    rows = batch.filter(F.col("uuid").isNotNull()).dropDuplicates(["conversation_id", "uuid"])
    rows = rows.withColumn("part", F.pmod(F.xxhash64("conversation_id"), F.lit(parts)).cast("int"))
    stored = _stored(spark, target)
    if stored is not None:
        touched = [r.part for r in rows.select("part").distinct().collect()]  # at most ``parts`` numbers
        others = stored.filter(F.col("part").isin(touched) & ~((F.col("source") == source) & (F.col("batch") == batch_id)))
        rows = rows.join(others.select("part", "conversation_id", "uuid"), ["part", "conversation_id", "uuid"], "left_anti")
    rows.write.mode("overwrite").partitionBy("part").parquet(f"{target}/records/source={source}/batch={batch_id}")
    batch.groupBy("conversation_id").agg(
        F.count(F.lit(1)).alias("received"), F.count_if(F.col("uuid").isNull()).alias("dropped")
    ).write.mode("overwrite").parquet(f"{target}/counts/source={source}/batch={batch_id}")


def import_merge(stream: DataFrame, target: str, checkpoint: str):
    """ST02 as a streaming writer."""
    return (
        stream.writeStream.foreachBatch(lambda df, i: merge_batch(df, i, target))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def acks(spark: SparkSession, target: str) -> DataFrame:
    """ST02: per conversation the last stored uuid and how many rows are stored."""
    rows = _stored(spark, target)
    if rows is None:  # nothing was ever sent
        rows = spark.createDataFrame([], STORED)
    return rows.groupBy("conversation_id").agg(F.max_by("uuid", "seq").alias("ack_through"), F.count(F.lit(1)).alias("stored"))


def backstop(records: DataFrame, target: str, run_id: int) -> None:
    """ST10: whole sessions re-sent through the same merge, as a writer of its own."""
    merge_batch(records, run_id, target, source="backstop")


def run_to_end(stream: DataFrame, out: str, checkpoint: str, mode: str = "append", timed: bool = False) -> DataFrame:
    """Run a stream over everything available and read back what it wrote. A ``timed`` stream
    (TTL or timers on processing time) always has another trigger to run, so it takes the
    available data in one trigger and stops."""
    spark = stream.sparkSession
    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(once=True) if timed else writer.trigger(availableNow=True)
    if mode == "append":
        q = writer.outputMode("append").format("parquet").option("path", out).start()
    else:
        q = writer.outputMode(mode).foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}")).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out).select(*stream.columns)


def write_each(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]):
    """A writer that hands every trigger's rows to ``write``."""
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
