"""Static twins of the streaming operators, and one query that really streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.artifacts import size_changes
from cohortlens.plans import bindings as B
from cohortlens.plans.artifacts import STATUS_SQL, progress, stage_items
from cohortlens.plans.registry import query
from cohortlens.session import scratch_path
from cohortlens.streaming import status as S

Z1 = f"""SELECT stage, latest_state, epoch_us(latest_ts) AS latest_us, completed, total, {STATUS_SQL} FROM (
 SELECT user_id AS stage, arg_max(event_type || '#' || CAST(event_id AS VARCHAR), struct_pack(t := ts, s := event_type || '#' || CAST(event_id AS VARCHAR))) AS latest_state, MAX(ts) AS latest_ts,
 COUNT(*) FILTER (value > 40) AS completed, COUNT(*) AS total, bool_or(event_type = 'purchase') AS r, bool_or(event_type = 'error') AS f
 FROM events GROUP BY 1)"""

Z2 = """SELECT run, epoch_us(MIN(ts)) AS first_us, epoch_us(MAX(ts)) AS last_us, COUNT(*) AS n_changes FROM (
 SELECT *, SUM(CASE WHEN before IS NULL OR epoch_us(ts) - epoch_us(before) > 21600000000 THEN 1 ELSE 0 END)
 OVER (PARTITION BY run ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM (
 SELECT *, lag(ts) OVER (PARTITION BY run ORDER BY ts, event_id) AS before FROM changes)) GROUP BY run, session"""


def _shape(df: DataFrame) -> DataFrame:
    return df.withColumn("latest_us", F.unix_micros("latest_ts")).drop("latest_ts")


def _sessions(df: DataFrame) -> DataFrame:
    return df.select("run", F.unix_micros("first_change").alias("first_us"), F.unix_micros("last_change").alias("last_us"), "n_changes")


@query("z1_stage_status", Z1)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _shape(S.stage_status(stage_items(spark, sf)))


@query("z1b_stage_status_stream", Z1)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The same through a file stream in update mode; the last version of each stage is returned."""
    feed, out, state = (scratch_path(spark, n) for n in ("feed", "status", "state"))
    stage_items(spark, sf).write.parquet(feed)
    source = spark.readStream.schema(spark.read.parquet(feed).schema).option("maxFilesPerTrigger", 4).parquet(feed)
    S.run_available_upsert(S.stage_status(source), out, state).awaitTermination()
    return _shape(S.latest_rows(spark.read.parquet(out), ["stage"]))


@query("z2_stall_sessions", Z2, "changes")
def _(spark: SparkSession, sf: str) -> DataFrame:
    changes = size_changes(progress(spark, sf), "run", "ts", "size", "event_id")
    return _sessions(S.stall_sessions(changes, "run", "ts", 21_600))


@query("z2b_stall_sessions_stream", Z2, "changes")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The same through a file stream in append mode; a closing row at the end of the feed flushes open sessions."""
    feed, out, state = (scratch_path(spark, n) for n in ("changes", "sessions", "state"))
    changes = size_changes(progress(spark, sf), "run", "ts", "size", "event_id").select("run", "ts")
    changes.write.parquet(feed)
    S.closing_row(spark.read.parquet(feed), "run", "ts", 21_600).write.mode("append").parquet(feed)
    source = spark.readStream.schema("run long, ts timestamp").parquet(feed)
    S.run_available(S.stall_sessions(source, "run", "ts", 21_600), out, state).awaitTermination()
    return _sessions(spark.read.schema("run long, first_change timestamp, last_change timestamp, n_changes long").parquet(out))
