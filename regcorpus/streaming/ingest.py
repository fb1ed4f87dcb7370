"""Incremental ingest (T1) and newest state per key (T2) with Structured
Streaming.

T1 replaces "skip files already fetched": a file source with a checkpoint
remembers which landed files it has processed, so a re-run with
``trigger(availableNow=True)`` picks up only new files and stops.

T2 keeps the newest record per key across runs.  It is a streaming
aggregation — ``max(struct(order_col, ...))`` per key — whose per-key state
lives in the (distributed, checkpointed) state store; ``update`` mode emits the
keys each micro-batch changed, and ``foreachBatch`` appends them to the target
as one epoch, which readers reduce by key.  For records that are never revised
``ingest_once_per_key`` keeps one row per key with a watermark and bounded state.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regcorpus.operators.corpus import latest_by
from regcorpus.session import scratch_path


def incremental_ingest(spark: SparkSession, source_dir: str, schema: StructType, sink_dir: str,
                       checkpoint_dir: str, fmt: str = "parquet", max_files_per_trigger: int | None = None):
    """Process every landed file not processed before, then stop."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    q = (reader.load(source_dir).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint_dir).option("path", sink_dir)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def latest_per_key(stream: DataFrame, key: str, order_cols: list, value_cols: list) -> DataFrame:
    """T2 (the aggregation): newest ``value_cols`` per ``key`` by ``order_cols``."""
    packed = F.struct(*[F.col(c) for c in order_cols], *[F.col(c).alias(f"_{c}") for c in value_cols])
    return stream.groupBy(key).agg(F.max(packed).alias("_w")).select(
        key, *[F.col(f"_w.{c}").alias(c) for c in order_cols],
        *[F.col(f"_w._{c}").alias(c) for c in value_cols])


def upsert_latest(spark: SparkSession, source_dir: str, schema: StructType, key: str, order_cols: list,
                  value_cols: list, target_dir: str, checkpoint_dir: str,
                  max_files_per_trigger: int | None = None):
    """Stream landed files, keep the newest record per key in the state
    store, and append each micro-batch's changed keys to ``target_dir``.

    Micro-batch ``n`` writes the keys it changed to ``target_dir/epoch=<n>``
    and reads nothing there, so a replayed batch writes the same folder with
    the same rows.  Readers reduce by key (``read_latest``); ``compact_latest``
    rewrites the target when many epochs have gathered."""
    reader = spark.readStream.format("parquet").schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    latest = latest_per_key(reader.load(source_dir), key, order_cols, value_cols)

    def append(batch: DataFrame, epoch_id: int):
        batch.select(key, *order_cols, *value_cols).write.mode("overwrite").parquet(f"{target_dir}/epoch={epoch_id:012d}")

    q = (latest.writeStream.outputMode("update").option("checkpointLocation", checkpoint_dir)
         .foreachBatch(append).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def read_latest(spark: SparkSession, target_dir: str, key: str, order_cols: list) -> DataFrame:
    """Current state of a T2 target: per key the row with the greatest
    ``order_cols`` over all epochs (map-side combined)."""
    return latest_by(spark.read.parquet(target_dir).drop("epoch"), key, order_cols)


def compact_latest(spark: SparkSession, target_dir: str, key: str, order_cols: list, compacted_dir: str) -> None:
    """Write the current state as epoch 0 of a new target folder; streaming
    goes on there with the same checkpoint."""
    read_latest(spark, target_dir, key, order_cols).write.mode("overwrite").parquet(f"{compacted_dir}/epoch={0:012d}")


def ingest_once_per_key(spark: SparkSession, source_dir: str, schema: StructType, keys: list, event_time: str, delay: str,
                        sink_dir: str, checkpoint_dir: str, max_files_per_trigger: int | None = None):
    """T2 for append-only records: the first row of every key within the
    watermark goes to ``sink_dir``; keys older than ``delay`` behind the newest
    event time leave the state, so it stays bounded however long the stream runs.
    Rows later than that are not written (``rows_too_late`` finds them).
    ``event_time`` is a timestamp with time zone."""
    reader = spark.readStream.format("parquet").schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    kept = reader.load(source_dir).withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
    q = (kept.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir).option("path", sink_dir)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def rows_too_late(landed: DataFrame, kept: DataFrame, keys: list) -> DataFrame:
    """The landed rows of which no row with their keys was written, because
    all came after the watermark: the side table of a run."""
    return landed.join(kept.select(*keys).distinct(), keys, "left_anti")


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for one run."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
