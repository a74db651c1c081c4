"""Structured Streaming operators and the same plans on static input.

The late-data rule is ours: a watermark of ten minutes unless the caller says
otherwise.  Progress feeds carry size changes only, so a session that closes
after ``timeout`` without a change is a stall (or the end of the run).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortlens.operators.artifacts import with_status
from cohortlens.operators.ordering import previous, running_total

WATERMARK = "10 minutes"


def stage_status(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Latest state and progress per stage from an append-only feed.

    ``events``: ``stage, state, ts, ok, running, failed``.  In a stream use update
    mode; state is one row per stage.  Of several events with one time, the largest state counts.
    """
    source = events.withWatermark("ts", watermark) if events.isStreaming else events
    sums = source.groupBy("stage").agg(
        F.max_by("state", F.struct("ts", "state")).alias("latest_state"), F.max("ts").alias("latest_ts"),
        F.count_if("ok").alias("completed"), F.count(F.lit(1)).alias("total"),
        F.bool_or("running").alias("_r"), F.bool_or("failed").alias("_f"),
    )
    return with_status(sums).drop("_r", "_f")


def closing_row(changes: DataFrame, run: str, ts: str, timeout_seconds: int, watermark: str = WATERMARK) -> DataFrame:
    """One late row without a run: it moves the watermark past every session, and its own session is never emitted.

    Append it to a feed that has ended, so that open sessions come out of the stream.
    """
    late = F.max(ts) + F.expr(f"INTERVAL {timeout_seconds} SECONDS") + F.expr(f"INTERVAL {watermark}") + F.expr("INTERVAL 1 HOUR")
    return changes.agg(late.alias(ts)).where(F.col(ts).isNotNull()).select(F.lit(None).cast(changes.schema[run].dataType).alias(run), ts)


def stall_sessions(changes: DataFrame, run: str, ts: str, timeout_seconds: int, watermark: str = WATERMARK) -> DataFrame:
    """Periods of activity per run: ``(run, first_change, last_change, n_changes)``.

    A stream uses ``session_window``: a stall of a feed that goes on shows when the
    watermark passes its end, so later rows are needed for it.  Static input is first cut to one row per
    run and timeout-long slot (changes in one slot always belong together), and
    slots are then chained chunk by chunk, so a run with very many changes never
    meets in one task.
    """
    if changes.isStreaming:
        return (
            changes.withWatermark(ts, watermark)
            .groupBy(F.col(run), F.session_window(ts, f"{timeout_seconds} seconds").alias("w"))
            .agg(F.min(ts).alias("first_change"), F.max(ts).alias("last_change"), F.count(F.lit(1)).alias("n_changes"))
            .drop("w")
        )
    micros = F.unix_micros(F.col(ts))
    width = timeout_seconds * 1_000_000
    slots = changes.groupBy(run, F.floor(micros / width).alias("_slot")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n")
    ).withColumn("_chunk", F.floor(F.col("_slot") / 4096))
    chained = previous(slots, [run], "_chunk", ["_slot"], "_last", "_before")
    opens = F.col("_before").isNull() | (F.unix_micros("_first") - F.unix_micros("_before") > width)
    numbered = running_total(chained, [run], "_chunk", ["_slot"], opens.cast("long"), "_session")
    return numbered.groupBy(run, "_session").agg(
        F.min("_first").alias("first_change"), F.max("_last").alias("last_change"), F.sum("_n").alias("n_changes")
    ).drop("_session")


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there and stop, writing Parquet (append mode only)."""
    return (
        stream.writeStream.format("parquet").outputMode(mode).option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def run_available_upsert(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Update-mode results, each batch written under its own number; ``latest_rows`` reads the last per key."""
    def write(batch: DataFrame, number: int) -> None:
        # Overwriting the folder of this batch makes a repeated batch harmless.
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.foreachBatch(write).outputMode("update")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def latest_rows(table: DataFrame, keys: list[str]) -> DataFrame:
    """Last version of each key over the batches of an update-mode stream."""
    columns = [c for c in table.columns if c not in (*keys, "batch")]
    newest = table.groupBy(*keys).agg(F.max_by(F.struct(*columns), "batch").alias("_r"))
    return newest.select(*keys, "_r.*")
