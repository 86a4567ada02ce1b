"""The event log as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from selvedge.operators import dml
from selvedge.sources.sinks import add_counts, append


def ingested(events: DataFrame, cutoff: Column, batch: Column, at: str = "event_timestamp") -> tuple[DataFrame, DataFrame]:
    """(events before the cutoff with execution_date and batch_timestamp, the others). Late events go with the next batch, under their own date."""
    moved, kept = dml.move_rows(events, F.col(at) < cutoff)
    return moved.withColumns({"execution_date": F.to_date(F.timestamp_seconds(at)), "batch_timestamp": batch.cast("long")}), kept


def read_events(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else r).parquet(path)


def run_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Everything that is there, in micro-batches in order, then ends; a second run gets only what is new."""
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_batches(path: str, at: str) -> Callable[[DataFrame, int], None]:
    """Appends each batch to the log, partitioned by event date, marked with its number."""

    def each(batch: DataFrame, number: int) -> None:
        append(batch.withColumns({"execution_date": F.to_date(at), "batch_timestamp": F.lit(number).cast("long")}), path, "execution_date")

    return each


def counting(path: str, keys: list[str], counters: dict[str, Column], compact_every: int = 20) -> Callable[[DataFrame, int], None]:
    """Adds each batch's counts to the counters at path, once (see `sinks.add_counts`; read them with `sinks.counts`).

    A batch whose number the counters have seen changes nothing, and one that failed halfway is
    simply repeated. A batch costs its own counts, not the whole table.
    """

    def each(batch: DataFrame, number: int) -> None:
        add_counts(dml.increments(batch, keys, counters), path, number, keys, compact_every)

    return each


def tumbling_counts(events: DataFrame, at: str, window: str, late: str, *keys: str) -> DataFrame:
    """window_start, keys, n per tumbling window; in a stream, windows close `late` after their end."""
    timed = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return timed.groupBy(F.window(at, window).alias("_w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("_w.start").alias("window_start"), *keys, "n")


def sliding_counts(events: DataFrame, at: str, window: str, slide: str, late: str, *keys: str) -> DataFrame:
    timed = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return timed.groupBy(F.window(at, window, slide).alias("_w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("_w.start").alias("window_start"), *keys, "n")


def sessions(events: DataFrame, at: str, gap: str, late: str, *keys: str) -> DataFrame:
    """session_start, session_end, keys, n: runs of events with no longer pause than gap."""
    timed = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return timed.groupBy(F.session_window(at, gap).alias("_w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"), *keys, "n")
