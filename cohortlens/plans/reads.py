"""Queries over read-level and sensitivity diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import quant as Q
from cohortlens.operators import reads as R
from cohortlens.plans import bindings as B
from cohortlens.plans.registry import cte, query, rounded


@query("d1_stratify_by_class", """SELECT lang, COUNT(*) AS n_reads, ROUND(AVG(length(source) + n_chars % 40), 6) AS mean_quality,
 ROUND(median(n_chars), 6) AS median_length FROM documents GROUP BY 1""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    d = B.table(spark, sf, "documents").select("lang", "n_chars", (F.length("source") + F.col("n_chars") % 40).alias("q"))
    return rounded(R.stratify_by_class(d, "lang", "n_chars", "q"))


def reads(spark: SparkSession, sf: str) -> DataFrame:
    """Reads with a quality per base: vectors scaled to small integers."""
    quality = F.transform("embedding", lambda v: F.floor(v.cast("double") * 100).cast("int"))
    return B.table(spark, sf, "embeddings").select("vec_id", "label", quality.alias("quality"))


cte("bases", """SELECT vec_id, label, i + 1 AS pos, CAST(floor(CAST(v AS DOUBLE) * 100) AS INTEGER) AS q FROM (
 SELECT vec_id, label, unnest(range(len(embedding))) AS i, unnest(embedding) AS v FROM embeddings)""")
cte("clipped", """SELECT vec_id, label, COALESCE(MAX(CASE WHEN q >= 20 THEN pos END), 0) AS clipped_length FROM bases GROUP BY 1, 2""", "bases")


@query("d2_clip_tail", """SELECT label, COUNT(*) AS n_reads, COUNT(*) FILTER (clipped_length >= 58) AS n_kept, COUNT(*) FILTER (clipped_length < 58) AS n_dropped,
 COUNT(*) FILTER (clipped_length >= 58 AND vec_id % 3 = 0) AS n_mapped,
 ROUND(100.0 * COUNT(*) FILTER (clipped_length >= 58 AND vec_id % 3 = 0) / CAST(COUNT(*) AS DOUBLE), 6) AS rate_of_all,
 ROUND(100.0 * COUNT(*) FILTER (clipped_length >= 58 AND vec_id % 3 = 0) / CAST(NULLIF(COUNT(*) FILTER (clipped_length >= 58), 0) AS DOUBLE), 6) AS rate_of_kept
 FROM clipped GROUP BY 1""", "clipped")
def _(spark: SparkSession, sf: str) -> DataFrame:
    clipped = R.clip_tail(reads(spark, sf), "quality", 20, 58).withColumn("mapped", F.col("vec_id") % 3 == 0)
    return rounded(R.clip_summary(clipped, ["label"], "mapped"))


@query("d2b_clipped_lengths", "SELECT vec_id, clipped_length, clipped_length >= 58 AS kept FROM clipped", "clipped")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return R.clip_tail(reads(spark, sf), "quality", 20, 58).select("vec_id", "clipped_length", "kept")


@query("d3_systematic_sample", """SELECT event_type, event_id, rn + 1 AS ordinal FROM (
 SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS rn, COUNT(*) OVER (PARTITION BY event_type) AS n FROM events)
 WHERE rn = 0 OR (rn * 250) // n <> ((rn - 1) * 250) // n OR n <= 250""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    e = B.table(spark, sf, "events").select("event_type", "event_id", F.floor(F.col("event_id") / 2048).alias("chunk"))
    return R.systematic_sample(e, ["event_type"], "chunk", ["event_id"], 250).select("event_type", "event_id", "ordinal")


def half(spark: SparkSession, sf: str, parity: int) -> DataFrame:
    """One of two runs of each sample: the quantities of one line status."""
    status = "F" if parity == 0 else "O"
    return B.table(spark, sf, "lineitem").groupBy(
        B.sample_of("l_suppkey").alias("sample_id"), F.col("l_partkey").alias("feature_id")
    ).agg(F.sum(F.when(F.col("l_linestatus") == status, F.col("l_quantity")).otherwise(0.0)).alias("v"))


cte("halves", f"""SELECT 'S' || lpad(CAST(l_suppkey % {B.N_SAMPLES} AS VARCHAR), CAST(greatest(2, length(CAST(l_suppkey % {B.N_SAMPLES} AS VARCHAR))) AS INTEGER), '0') AS sample_id, l_partkey AS feature_id,
 SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS a, SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS b FROM lineitem GROUP BY 1, 2""")
cte("top_halves", """SELECT x.sample_id, COUNT(*) AS top_shared FROM
 (SELECT sample_id, feature_id FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY a DESC, feature_id) AS rn FROM halves) WHERE rn <= 100) x
 JOIN (SELECT sample_id, feature_id FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY b DESC, feature_id) AS rn FROM halves) WHERE rn <= 100) y
 ON x.sample_id = y.sample_id AND x.feature_id = y.feature_id GROUP BY 1""", "halves")


@query("d4_variant_stability", """SELECT h.sample_id, COUNT(*) AS n_features, COUNT(*) FILTER (abs(log2((b + 1) / (a + 1))) >= 1) AS n_two_fold,
 ROUND(corr(ln(1 + a), ln(1 + b)), 6) AS pearson_log1p, ROUND(quantile_cont(abs(log2((b + 1) / (a + 1))), 0.95), 6) AS p95_abs_log2,
 COALESCE(MAX(top_shared), 0) AS top_shared FROM halves h LEFT JOIN top_halves t ON t.sample_id = h.sample_id WHERE a >= 10 OR b >= 10 GROUP BY 1""",
       "halves", "top_halves")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(R.variant_stability(half(spark, sf, 0), half(spark, sf, 1), "feature_id", "v", ["sample_id"]))


cte("sweep", """SELECT o_orderpriority AS sample, CAST(o_custkey % 3 AS BIGINT) AS threshold, ROUND(AVG(o_totalprice), 4) AS metric FROM orders GROUP BY 1, 2""")


@query("d5_threshold_sweep", """SELECT s.sample, s.threshold, s.metric, ROUND(s.metric - d.metric, 4) AS delta FROM sweep s
 LEFT JOIN (SELECT * FROM sweep WHERE threshold = 1) d ON d.sample = s.sample""", "sweep")
def _(spark: SparkSession, sf: str) -> DataFrame:
    sweep = B.table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("sample"), (F.col("o_custkey") % 3).alias("threshold")
    ).agg(F.round(F.avg("o_totalprice"), 4).alias("metric"))
    return rounded(R.threshold_sweep(sweep, ["sample"], "threshold", "metric", 1), 4)


@query("d6_rate_contract", """SELECT sample_id, ROUND(num_mapped / CAST(num_processed AS DOUBLE), 6) AS mapped_of_all,
 ROUND(num_mapped / CAST(NULLIF(num_processed - num_decoy_fragments, 0) AS DOUBLE), 6) AS mapped_of_target, CAST(NULL AS DOUBLE) AS genome_rate FROM run_meta""", "run_meta")
def _(spark: SparkSession, sf: str) -> DataFrame:
    meta = B.run_meta(spark, sf).withColumns({
        "target": F.col("num_processed") - F.col("num_decoy_fragments"), "genome": F.lit(None).cast("long")})
    return rounded(Q.rate_contract(meta, [
        ("mapped_of_all", "num_mapped", "num_processed"), ("mapped_of_target", "num_mapped", "target"), ("genome_rate", "genome", "num_processed"),
    ], ["sample_id"]))


@query("d7_overrepresented_lookup", """SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    seqs = B.table(spark, sf, "benchmark").withColumnRenamed("text", "seq")
    return R.overrepresented_lookup(seqs, B.table(spark, sf, "documents"), "item_id", "seq", "doc_id", "text")


@query("d8_reproducibility_check", """SELECT COALESCE(a.l_partkey, b.l_partkey) AS l_partkey, a.n AS rows_a, b.n AS rows_b, a.h IS NOT DISTINCT FROM b.h AS identical FROM
 (SELECT l_partkey, COUNT(*) AS n, string_agg(k, ',' ORDER BY k) AS h FROM (SELECT l_partkey, CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS k FROM lineitem) GROUP BY 1) a
 FULL JOIN (SELECT l_partkey, COUNT(*) AS n, string_agg(k, ',' ORDER BY k) AS h FROM (
 SELECT l_partkey, CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS k FROM lineitem WHERE l_quantity > 1) GROUP BY 1) b
 ON a.l_partkey = b.l_partkey""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    a = B.table(spark, sf, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    return R.reproducibility_check(a, a.where("l_quantity > 1"), ["l_partkey"], ["l_orderkey", "l_linenumber"])


@query("d9_distinct_at_quality", """SELECT COUNT(*) AS n_reads, COUNT(q) AS n_aligned, COUNT(*) FILTER (q >= 49) AS n_good,
 ROUND(100.0 * COUNT(q) / CAST(COUNT(*) AS DOUBLE), 6) AS pct_aligned, ROUND(100.0 * COUNT(*) FILTER (q >= 49) / CAST(COUNT(*) AS DOUBLE), 6) AS pct_good FROM (
 SELECT o_orderkey, MAX(l_quantity) AS q FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    reads_ = B.table(spark, sf, "orders").select(F.col("o_orderkey").alias("read"))
    hits = B.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("read"), "l_quantity")
    return rounded(R.distinct_at_quality(reads_, hits, "read", "l_quantity", 49))
