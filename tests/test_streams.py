from conftest import rows
from pyspark.sql import functions as F

from cohortlens.operators.artifacts import size_changes
from cohortlens.streaming import status as S

FEED = "run string, s long, size int, id int"
OBSERVED = [("a", 0, 1, 0), ("a", 50, 2, 1), ("a", 90, 2, 2), ("a", 149, 3, 3), ("a", 400, 4, 4), ("b", 10, 1, 5), ("b", 700, 2, 6), ("a", 5000, 9, 7)]


def changes(spark):
    df = spark.createDataFrame(OBSERVED, FEED).withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")))
    return size_changes(df, "run", "ts", "size", "id", chunk_seconds=60).select("run", "ts")


def test_static_sessions(spark):
    got = rows(S.stall_sessions(changes(spark), "run", "ts", 100), "run", (F.unix_seconds("last_change") - 1_700_000_000).alias("end"), "n_changes")
    assert got == [("a", 149, 3), ("a", 400, 1), ("a", 5000, 1), ("b", 10, 1), ("b", 700, 1)]


def test_stream_closes_the_same_sessions(spark, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    changes(spark).write.parquet(feed)
    source = spark.readStream.schema("run string, ts timestamp").parquet(feed)
    S.run_available(S.stall_sessions(source, "run", "ts", 100), out, str(tmp_path / "state")).awaitTermination()
    closed = set(rows(spark.read.parquet(out), "run", "first_change", "last_change", "n_changes"))
    every = set(rows(S.stall_sessions(changes(spark), "run", "ts", 100), "run", "first_change", "last_change", "n_changes"))
    # Only the last session is still open: no later event has moved the watermark past it.
    assert closed < every and len(every - closed) == 1


def test_status_stream_equals_static(spark, tmp_path):
    data = [(f"st{i % 3}", f"state{i}", 1_700_000_000 + i * 60, i % 2 == 0, i % 5 == 0, i % 7 == 0) for i in range(40)]
    items = spark.createDataFrame(data, "stage string, state string, t long, ok boolean, running boolean, failed boolean")
    items = items.withColumn("ts", F.timestamp_seconds("t")).drop("t")
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    items.repartition(5).write.parquet(feed)
    source = spark.readStream.schema(items.schema).option("maxFilesPerTrigger", 2).parquet(feed)
    S.run_available_upsert(S.stage_status(source), out, str(tmp_path / "state")).awaitTermination()
    latest = S.latest_rows(spark.read.parquet(out), ["stage"])
    static = S.stage_status(items)
    assert rows(latest.select(*static.columns)) == rows(static)
