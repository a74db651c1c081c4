"""Queries over quantification: roll-up, totals, validation, mapping rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import gates as G
from cohortlens.operators import ordering as O
from cohortlens.operators import quant as Q
from cohortlens.plans import bindings as B
from cohortlens.plans.registry import query, rounded
from cohortlens.sources.sinks import content_fingerprint


@query("j3_map_features", """SELECT sample_id, gene_id, COUNT(*) AS n_features, CAST(SUM(num_reads) AS BIGINT) AS reads
 FROM mapped GROUP BY 1, 2""", "mapped")
def _(spark: SparkSession, sf: str) -> DataFrame:
    mapped = Q.map_features(B.quant(spark, sf), B.feature_map(spark, sf))
    return mapped.groupBy("sample_id", "gene_id").agg(
        F.count(F.lit(1)).alias("n_features"), F.sum("num_reads").cast("long").alias("reads"))


# Mean lengths are small fractions, often exactly half-way at the last digit kept; both
# sides add the same tiny amount before rounding so that a last-bit difference cannot show.
OFF_TIES = "length + 1e-9D"


@query("a7_group_rollup", """SELECT gene_id, sample_id, CAST("count" AS BIGINT) AS "count", ROUND(tpm, 4) AS tpm, ROUND(length + 1e-9, 6) AS length
 FROM genes_raw""", "genes_raw")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(rounded(B.genes_raw(spark, sf).withColumn("length", F.expr(OFF_TIES)), 4, "tpm"), 6, "length").withColumn("count", F.col("count").cast("long"))


@query("a8_fill_group_length", """SELECT gene_id, sample_id, CAST("count" AS BIGINT) AS "count", ROUND(length + 1e-9, 6) AS length FROM genes""", "genes")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(B.genes(spark, sf).withColumn("length", F.expr(OFF_TIES)), 6, "length").select("gene_id", "sample_id", F.col("count").cast("long").alias("count"), "length")


@query("a9_sample_totals", """SELECT sample_id, CAST(SUM("count") AS BIGINT) AS sum_counts, ROUND(SUM(tpm), 3) AS sum_tpm,
 CAST(SUM(CASE WHEN "count" > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_nonzero_genes FROM genes_raw GROUP BY 1""", "genes_raw")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(Q.sample_totals(B.genes_raw(spark, sf)), 3, "sum_tpm").withColumn("sum_counts", F.col("sum_counts").cast("long"))


@query("a10_rollup_conservation", f"""SELECT COUNT(*) AS n_samples, MAX(abs(a - b)) AS max_abs_delta FROM
 (SELECT sample_id, SUM(num_reads) AS a FROM quant GROUP BY 1) x
 JOIN (SELECT sample_id, SUM("count") AS b FROM genes_raw GROUP BY 1) y ON x.sample_id = y.sample_id""", "quant", "genes_raw")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return Q.rollup_conservation(B.quant(spark, sf), B.genes_raw(spark, sf))


def expected(spark: SparkSession, sf: str) -> DataFrame:
    """What each sample should hold; one sample in eight expects another read count."""
    no = F.substring("sample_id", 2, 2).cast("int")
    targets = B.run_meta(spark, sf)
    return targets.select(
        "sample_id", (F.col("num_processed") + F.when(no % 8 == 3, 1).otherwise(0)).alias("reads"),
        F.lit("idx-main").alias("index_hash"), F.col("num_valid_targets").alias("n_targets"))


@query("a11_validate_quant", """SELECT sample_id, rule FROM (
 SELECT sample_id, unnest(['read_count', 'index_identity', 'library_mode', 'converged', 'tpm_sum', 'unique_ids']) AS rule,
 unnest([CAST(substr(sample_id, 2) AS INTEGER) % 8 = 3, index_seq_hash <> 'idx-main', library_type <> 'SF', NOT em_converged,
 abs(t - 1e6) > 0.5, n_rows <> n_ids]) AS broken
 FROM run_meta JOIN (SELECT sample_id AS s, SUM(tpm) AS t, COUNT(*) AS n_rows, COUNT(DISTINCT feature_id) AS n_ids FROM quant GROUP BY 1) q
 ON q.s = sample_id) WHERE broken""", "run_meta", "quant")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return Q.validate_quant(Q.quant_metrics(B.quant(spark, sf)), B.run_meta(spark, sf), expected(spark, sf))


@query("a12_mapping_summary", """SELECT COUNT(*) AS n_samples, CAST(SUM(num_processed) AS BIGINT) AS processed, CAST(SUM(num_mapped) AS BIGINT) AS mapped,
 CAST(SUM(num_decoy_fragments) AS BIGINT) AS decoy,
 CAST(SUM(num_processed) - SUM(num_mapped) - SUM(num_decoy_fragments) AS BIGINT) AS remainder,
 ROUND(100.0 * CAST(SUM(num_mapped) AS DOUBLE) / CAST(SUM(num_processed) AS DOUBLE), 6) AS weighted_pct_mapped FROM run_meta""", "run_meta")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(Q.mapping_summary(B.run_meta(spark, sf)))


@query("a12b_mapping_rates", """SELECT sample_id, ROUND(100.0 * CAST(num_mapped AS DOUBLE) / CAST(num_processed AS DOUBLE), 6) AS pct_mapped,
 ROUND(100.0 * CAST(num_decoy_fragments AS DOUBLE) / CAST(num_processed AS DOUBLE), 6) AS pct_decoy FROM run_meta""", "run_meta")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(Q.mapping_rates(B.run_meta(spark, sf))).select("sample_id", "pct_mapped", "pct_decoy")


LANE = "CAST(CAST('0x' || substr(h, {0}, 15) AS BIGINT) AS HUGEINT)"


@query("a13_content_fingerprint", """SELECT l_returnflag, COUNT(*) AS n_rows, """ + ", ".join(
    f"CAST(SUM({LANE.format(16 * i + 1)}) AS VARCHAR) AS digest_{i}" for i in range(4)
) + """ FROM (SELECT l_returnflag, sha256(CAST(l_orderkey AS VARCHAR) || chr(31) || CAST(l_partkey AS VARCHAR) || chr(31)
 || CAST(l_linenumber AS VARCHAR) || chr(31) || l_linestatus) AS h FROM lineitem) GROUP BY 1""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    df = content_fingerprint(B.table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_linenumber", "l_linestatus"], ["l_returnflag"])
    return df.select("l_returnflag", "n_rows", *[F.col(f"digest_{i}").cast("string").alias(f"digest_{i}") for i in range(4)])


@query("p9_threshold_flag", """SELECT sample_id, num_mapped * 100 < num_processed * 50 AS low_mapping FROM run_meta""", "run_meta")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return Q.threshold_flag(Q.mapping_rates(B.run_meta(spark, sf)), "pct_mapped", 50.0, "low_mapping").select("sample_id", "low_mapping")


@query("p10_quality_band", """SELECT o_orderpriority, CASE WHEN o_totalprice / 5000 < 10 THEN 'very_low' WHEN o_totalprice / 5000 < 25 THEN 'low' ELSE 'ok' END AS band,
 COUNT(*) AS n FROM orders GROUP BY 1, 2""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rates = B.table(spark, sf, "orders").withColumn("rate", F.col("o_totalprice") / 5000)
    return Q.quality_band(rates, "rate", 10.0, 25.0).groupBy("o_orderpriority", "band").agg(F.count(F.lit(1)).alias("n"))


@query("g3_check_matrix", """SELECT 'cell_value' AS rule, 'BLOCKER' AS severity, gene_id || '/' || sample_id AS key, 'length' AS detail
 FROM dense WHERE length IS NULL""", "dense")
def _(spark: SparkSession, sf: str) -> DataFrame:
    # Before the length fill, cells without abundance are the violations to find.
    raw = Q.densify(B.genes_raw(spark, sf), B.SAMPLES)
    return G.check_matrix(raw, B.feature_map(spark, sf))


@query("w8_geo_mean_by_gene", """SELECT gene_id, CASE WHEN MIN("count") > 0 THEN ROUND(exp(avg(ln(NULLIF("count", 0)))), 6) END AS geo_mean
 FROM dense GROUP BY 1""", "dense")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from cohortlens.operators.model import geo_mean_by_gene

    return rounded(geo_mean_by_gene(Q.densify(B.genes_raw(spark, sf), B.SAMPLES), "count", "geo_mean"))


@query("t2_top_k", """SELECT sample_id, feature_id, num_reads FROM quant_raw ORDER BY num_reads DESC, feature_id, sample_id LIMIT 12""", "quant_raw")
def _(spark: SparkSession, sf: str) -> DataFrame:
    q = B.quant(spark, sf).select("sample_id", "feature_id", "num_reads")
    return O.top_k(q, [F.col("num_reads").desc(), F.col("feature_id"), F.col("sample_id")], 12)


@query("t2b_top_k_per_group", """SELECT sample_id, feature_id, num_reads, rn AS position FROM (
 SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY num_reads DESC, feature_id) AS rn FROM quant_raw) WHERE rn <= 5""", "quant_raw")
def _(spark: SparkSession, sf: str) -> DataFrame:
    q = B.quant(spark, sf).select("sample_id", "feature_id", "num_reads")
    return O.top_k_per_group(q, ["sample_id"], "num_reads", "feature_id", 5)
