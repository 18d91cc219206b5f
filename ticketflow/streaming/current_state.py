"""Extension: streaming bronze -> current state, and additive daily counts.

Sinks are append-only change logs on the shared filesystem, written from
``foreachBatch`` with the batch id on every row:

* current state: each micro-batch appends only its per-key latest versions; the
  current state is ``dedup_latest`` over the log, which is exact because the dedup
  merges incrementally (``dedup(a U b) == dedup(dedup(a) U b)``). A batch writes
  O(batch) data, never the whole state, and a replayed batch (same id, after a
  failure) appends rows that the read-side dedup collapses.
* windowed counts: each micro-batch writes its own partial counts to its own folder,
  replacing what an earlier attempt of the same batch left there; a read sums the batches.
  Sums do not depend on the order in which files arrive, so nothing is ever late and no
  aggregation state is kept. ``windowed_counts`` is the form with a watermark, whose state
  is bounded and which drops late rows; its run reports how many.

Checkpoints live under the shared folder, so a restarted query resumes exactly.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.operators.silver import dedup_latest

BATCH = "_batch_id"


def _append_log(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("append").parquet(path)
    return write


def run_current_state(spark: SparkSession, source_path: str, schema, log_path: str,
                      checkpoint: str, key: str = "ticket_id", order: str = "last_activity",
                      tie_breakers: Iterable[str] = (), max_files_per_trigger: int = 200) -> None:
    """Consume every file now in ``source_path`` (availableNow) into the state log."""
    ties = tuple(tie_breakers)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        _append_log(log_path)(dedup_latest(batch, key, order, ties), batch_id)

    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_path))
    q = (stream.writeStream.foreachBatch(upsert)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_current_state(spark: SparkSession, log_path: str, key: str = "ticket_id",
                       order: str = "last_activity",
                       tie_breakers: Iterable[str] = ()) -> DataFrame:
    log = spark.read.parquet(log_path)
    return dedup_latest(log, key, order, (*tie_breakers, BATCH)).drop(BATCH)


def _counts(events: DataFrame, ts: str, every: str, keys: Iterable[str]) -> DataFrame:
    return (events.groupBy(F.window(F.col(ts).cast("timestamp"), every).alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, "n"))


def run_windowed_counts(spark: SparkSession, source_path: str, schema, log_path: str,
                        checkpoint: str, ts: str = "ts", every: str = "1 day",
                        keys: Iterable[str] = ("event_type",),
                        max_files_per_trigger: int = 200) -> None:
    """Tumbling-window counts per key of every file now in ``source_path``."""
    keys = tuple(keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        # a replayed batch replaces its own folder, so it is counted once
        _counts(batch, ts, every, keys).write.mode("overwrite").parquet(
            f"{log_path.rstrip('/')}/{BATCH}={batch_id}")

    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_path))
    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_windowed_counts(spark: SparkSession, log_path: str,
                         keys: Iterable[str] = ("event_type",)) -> DataFrame:
    return (spark.read.parquet(log_path).groupBy("window_start", "window_end", *keys)
            .agg(F.sum("n").alias("n")))


def windowed_counts(events: DataFrame, ts: str, every: str, keys: Iterable[str],
                    watermark: str) -> DataFrame:
    """Tumbling-window counts per key on a stream, state bounded by the watermark: rows
    older than it are dropped, so use it only for sources that arrive in time order."""
    t = F.col(ts).cast("timestamp")
    return (events.withColumn("_event_time", t)
            .withWatermark("_event_time", watermark)
            .groupBy(F.window("_event_time", every).alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, "n"))


def run_watermarked_counts(spark: SparkSession, source_path: str, schema, log_path: str,
                           checkpoint: str, watermark: str, ts: str = "ts", every: str = "1 day",
                           keys: Iterable[str] = ("event_type",),
                           max_files_per_trigger: int = 200) -> int:
    """Counts in update mode into a log (the latest batch of a window wins); returns how many
    rows the watermark dropped."""
    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_path))
    q = (windowed_counts(stream, ts, every, tuple(keys), watermark)
         .writeStream.outputMode("update").foreachBatch(_append_log(log_path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"])


def read_watermarked_counts(spark: SparkSession, log_path: str,
                            keys: Iterable[str] = ("event_type",)) -> DataFrame:
    return dedup_latest(spark.read.parquet(log_path), ["window_start", *keys], BATCH).drop(BATCH)
