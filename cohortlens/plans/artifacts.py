"""Queries over artifacts, journals, progress and digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import artifacts as A
from cohortlens.plans import bindings as B
from cohortlens.plans.registry import cte, query, rounded
from cohortlens.sources.sinks import content_fingerprint


def crosscheck(spark: SparkSession, sf: str) -> DataFrame:
    orders = B.table(spark, sf, "orders")
    manifest = orders.select(F.col("o_orderkey").alias("run"), F.floor(F.col("o_totalprice") / 50000).alias("spots"))
    sums = B.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.floor(F.sum("l_quantity") / 20).alias("report_reads"), F.count(F.lit(1)).alias("num_processed"))
    report = sums.select(F.col("l_orderkey").alias("run"), "report_reads")
    meta = sums.select(F.col("l_orderkey").alias("run"), "num_processed")
    return A.crosscheck_counts(manifest, report, meta, "run")


@query("j13_crosscheck_counts", """SELECT o_orderkey AS run, CAST(floor(o_totalprice / 50000) AS BIGINT) AS spots, report_reads, num_processed
 FROM orders LEFT JOIN (SELECT l_orderkey, CAST(floor(SUM(l_quantity) / 20) AS BIGINT) AS report_reads, COUNT(*) AS num_processed
 FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
 WHERE CAST(floor(o_totalprice / 50000) AS BIGINT) IS DISTINCT FROM report_reads
 OR CAST(floor(o_totalprice / 50000) AS BIGINT) IS DISTINCT FROM num_processed""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return crosscheck(spark, sf)


@query("j14_reconcile_artifacts", """SELECT c_custkey AS run, CASE WHEN NOT (src IS NOT DISTINCT FROM size) THEN 'SOURCE_MUTATED'
 WHEN fin AND e_sha IS NULL THEN 'UNVERIFIED_RESULT' WHEN fin AND (e_sha <> sha OR NOT (e_cfg IS NOT DISTINCT FROM cfg)) THEN 'PROVENANCE_CONFLICT'
 WHEN fin THEN 'VALIDATED_SKIP' WHEN wrk THEN 'INTERRUPTED' ELSE 'RUN' END AS state FROM (
 SELECT c_custkey, CAST(floor(c_acctbal) AS BIGINT) AS size, sha256(c_name) AS sha, c_mktsegment AS cfg,
 CAST(floor(c_acctbal) AS BIGINT) + CASE WHEN c_nationkey = 3 THEN 1 ELSE 0 END AS src,
 COALESCE(fin, FALSE) AS fin, COALESCE(wrk, FALSE) AS wrk, CASE WHEN urgent THEN sha256(c_name) WHEN low THEN sha256(c_name || 'x') END AS e_sha,
 CASE WHEN c_nationkey = 5 THEN 'OTHER' ELSE c_mktsegment END AS e_cfg
 FROM customer LEFT JOIN (SELECT o_custkey, bool_or(o_orderstatus = 'F') AS fin, bool_or(o_orderstatus = 'P') AS wrk,
 bool_or(o_orderpriority = '1-URGENT') AS urgent, bool_or(o_orderpriority = '5-LOW') AS low FROM orders GROUP BY 1) ON o_custkey = c_custkey)""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    c = B.table(spark, sf, "customer").withColumn("run", F.col("c_custkey"))
    size = F.floor("c_acctbal")
    seen = B.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("run")).agg(
        F.bool_or(F.col("o_orderstatus") == "F").alias("has_final"), F.bool_or(F.col("o_orderstatus") == "P").alias("has_work"),
        F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("urgent"), F.bool_or(F.col("o_orderpriority") == "5-LOW").alias("low"))
    expected = c.select("run", size.alias("size"), F.sha2("c_name", 256).alias("sha256"), F.col("c_mktsegment").alias("config"))
    source = c.select("run", (size + F.when(F.col("c_nationkey") == 3, 1).otherwise(0)).alias("source_size"))
    inventory = source.join(seen.select("run", "has_final", "has_work"), "run", "left")
    evidence = c.join(seen, "run").select(
        "run", F.when(F.col("urgent"), F.sha2("c_name", 256)).when(F.col("low"), F.sha2(F.concat("c_name", F.lit("x")), 256)).alias("e_sha256"),
        F.when(F.col("c_nationkey") == 5, "OTHER").otherwise(F.col("c_mktsegment")).alias("e_config"))
    return A.reconcile_artifacts(expected, inventory, evidence, "run")


@query("j14c_revalidated_results", """SELECT c_custkey AS run, CASE WHEN n IS NOT NULL AND c_nationkey = 7 THEN 'PROVENANCE_CONFLICT'
 WHEN n IS NOT NULL AND changed THEN 'INVALID_RESULT' WHEN n IS NOT NULL THEN 'VALIDATED_SKIP' WHEN c_nationkey = 4 THEN 'INTERRUPTED'
 WHEN c_nationkey % 5 = 3 THEN 'SOURCE_CHECKSUM_MISMATCH' ELSE 'RUN' END AS state
 FROM customer LEFT JOIN (SELECT o_custkey, COUNT(*) AS n, bool_or(o_orderpriority = '5-LOW') AS changed FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A customer's orders are its result; orders of low priority have changed since they were recorded."""
    c = B.table(spark, sf, "customer").withColumn("run", F.col("c_custkey"))
    orders = B.table(spark, sf, "orders").select(F.col("o_custkey").alias("run"), "o_orderkey", "o_totalprice", "o_orderpriority")
    price = F.col("o_totalprice") + F.when(F.col("o_orderpriority") == "5-LOW", 1).otherwise(0)
    recorded = content_fingerprint(orders.withColumn("o_totalprice", price), ["o_orderkey", "o_totalprice"], ["run"])
    done = orders.select("run").distinct()
    digest = F.sha2("c_name", 256)
    expected = c.select("run", F.lit(1).alias("size"), digest.alias("sha256"), F.col("c_mktsegment").alias("config"))
    inventory = c.join(done.withColumn("has_final", F.lit(True)), "run", "left").select(
        "run", "has_final", (F.col("c_nationkey") == 4).alias("has_work"), F.lit(1).alias("source_size"),
        F.when(F.col("c_nationkey") % 5 == 3, F.sha2(F.concat("c_name", F.lit("x")), 256)).otherwise(digest).alias("source_sha256"))
    evidence = c.join(done, "run").select(
        "run", digest.alias("e_sha256"), F.when(F.col("c_nationkey") == 7, "OTHER").otherwise(F.col("c_mktsegment")).alias("e_config"))
    valid = A.revalidate(orders, recorded, "run", ["o_orderkey", "o_totalprice"])
    return A.reconcile_artifacts(expected, inventory, evidence, "run", valid)


@query("j14b_reuse_state", """SELECT user_id, event_type, CASE WHEN NOT d AND (m OR k) THEN 'integrity_conflict' WHEN NOT d THEN 'download'
 WHEN m AND k AND pol = 'v2' AND k_ok AND m_ok THEN 'reused' WHEN m AND k AND pol = 'v2' THEN 'integrity_conflict'
 WHEN m AND k AND m_ok AND c_ok THEN 'migrated' WHEN m AND k THEN 'integrity_conflict' WHEN k THEN 'integrity_conflict'
 WHEN m AND m_ok AND c_ok THEN 'recovered' WHEN m THEN 'integrity_conflict' WHEN f AND c_ok THEN 'recovered' ELSE 'download' END AS state FROM (
 SELECT user_id, event_type, MAX(event_id) % 2 = 0 AS d, COUNT(*) % 3 > 0 AS m, MIN(event_id) % 3 > 0 AS k,
 CASE WHEN MAX(event_id) % 5 < 3 THEN 'v2' ELSE 'v1' END AS pol, MIN(event_id) % 7 > 1 AS k_ok, MAX(event_id) % 7 > 1 AS m_ok,
 MIN(event_id) % 5 > 0 AS c_ok, COUNT(*) > 8 AS f FROM events GROUP BY 1, 2)""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    lo, hi, n = F.min("event_id"), F.max("event_id"), F.count(F.lit(1))
    evidence = B.table(spark, sf, "events").groupBy("user_id", "event_type").agg(
        (hi % 2 == 0).alias("has_data"), (n % 3 > 0).alias("has_manifest"), (lo % 3 > 0).alias("has_marker"),
        F.when(hi % 5 < 3, "v2").otherwise("v1").alias("marker_policy"), (lo % 7 > 1).alias("marker_ok"),
        (hi % 7 > 1).alias("manifest_ok"), (lo % 5 > 0).alias("content_ok"), (n > 8).alias("has_files"))
    return A.reuse_state(evidence, "v2").select("user_id", "event_type", "state")


@query("j15_verify_digests", """SELECT COALESCE(a.path, b.path) AS path, CASE WHEN b.path IS NULL THEN 'missing' WHEN a.path IS NULL THEN 'extra'
 WHEN a.bytes IS DISTINCT FROM b.bytes THEN 'size_mismatch' WHEN a.h IS DISTINCT FROM b.h THEN 'digest_mismatch' ELSE 'ok' END AS state FROM
 (SELECT doc_id AS path, n_chars AS bytes, sha256(text) AS h FROM documents WHERE lang <> 'de') a FULL JOIN
 (SELECT doc_id AS path, CASE WHEN source = 'src3' THEN n_chars + 1 ELSE n_chars END AS bytes,
 sha256(CASE WHEN source = 'src5' THEN upper(text) ELSE text END) AS h FROM documents WHERE lang <> 'es') b ON a.path = b.path""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    d = B.table(spark, sf, "documents")
    expected = d.where("lang <> 'de'").select(F.col("doc_id").alias("path"), F.col("n_chars").alias("bytes"), F.sha2("text", 256).alias("sha256"))
    text = F.when(F.col("source") == "src5", F.upper("text")).otherwise(F.col("text"))
    observed = d.where("lang <> 'es'").select(
        F.col("doc_id").alias("path"), (F.col("n_chars") + F.when(F.col("source") == "src3", 1).otherwise(0)).alias("bytes"), F.sha2(text, 256).alias("sha256"))
    return A.verify_digests(expected, observed)


def stage_items(spark: SparkSession, sf: str) -> DataFrame:
    """Checklist items of the stages: one item per event, the stage is the user."""
    e = F.col("event_type")
    return B.table(spark, sf, "events").select(
        F.col("user_id").alias("stage"), "ts", F.concat_ws("#", "event_type", "event_id").alias("state"),
        (F.col("value") > 40).alias("ok"), (e == "purchase").alias("running"), (e == "error").alias("failed"))


STATUS_SQL = """CASE WHEN completed = total THEN 'done' WHEN r THEN 'running' WHEN f OR completed > 0 THEN 'attention' ELSE 'pending' END AS status"""


@query("a27_stage_progress", f"""SELECT stage, completed, total, {STATUS_SQL} FROM (
 SELECT user_id AS stage, COUNT(*) FILTER (value > 40) AS completed, COUNT(*) AS total, bool_or(event_type = 'purchase') AS r,
 bool_or(event_type = 'error') AS f FROM events GROUP BY 1)""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return A.stage_progress(stage_items(spark, sf))


@query("a28_run_report", """SELECT COUNT(*) AS requested, COUNT(*) FILTER (status <> 'failed') AS succeeded, COUNT(*) FILTER (status = 'failed') AS failed,
 CAST(SUM(attempts) AS BIGINT) AS attempts, MAX(duration_seconds) AS longest_seconds FROM journal""", "journal")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return A.run_report(B.journal(spark, sf))


@query("a28b_failed_runs", "SELECT DISTINCT accession FROM journal WHERE status = 'failed'", "journal")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return A.failed_runs(B.journal(spark, sf))


def progress(spark: SparkSession, sf: str) -> DataFrame:
    """Observed sizes per run; values are coarse, so sizes often repeat."""
    return B.table(spark, sf, "events").select(
        F.col("user_id").alias("run"), "ts", "event_id", F.floor(F.col("value") / 60).alias("size"))


cte("progress", "SELECT user_id AS run, ts, event_id, CAST(floor(value / 60) AS BIGINT) AS size FROM events")
cte("changes", """SELECT * FROM (SELECT *, lag(size) OVER (PARTITION BY run ORDER BY ts, event_id) AS prev FROM progress)
 WHERE prev IS NULL OR prev <> size""", "progress")


@query("w7_stall_gaps", """SELECT event_id, run, ROUND(epoch_us(ts) / 1e6 - grown, 3) AS idle_seconds, epoch_us(ts) / 1e6 - grown >= 21600 AS stalled FROM (
 SELECT *, MAX(CASE WHEN prev IS NULL OR prev <> size THEN epoch_us(ts) / 1e6 END) OVER (PARTITION BY run ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grown
 FROM (SELECT *, lag(size) OVER (PARTITION BY run ORDER BY ts, event_id) AS prev FROM progress))""", "progress")
def _(spark: SparkSession, sf: str) -> DataFrame:
    gaps = A.stall_gaps(progress(spark, sf), "run", "ts", "size", 21_600, "event_id")
    return rounded(gaps.select("event_id", "run", "idle_seconds", "stalled"), 3)
