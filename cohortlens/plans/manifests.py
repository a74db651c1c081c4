"""Queries over the manifest: projections, run lookup, aggregates and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import compare as C
from cohortlens.operators import gates as G
from cohortlens.operators import manifest as M
from cohortlens.operators import ordering as O
from cohortlens.plans import bindings as B
from cohortlens.plans.registry import query


@query("p1_classify", "SELECT gsm, analysis_group FROM classified", "classified")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.classify(B.records(spark, sf), B.class_rules(), "analysis_group").select("gsm", "analysis_group")


@query("p1b_classify_by_table", "SELECT gsm, analysis_group FROM classified", "classified")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(B.CLASS_RULES, "diagnosis string, tissue string, analysis_group string")
    return M.classify_by_table(B.records(spark, sf), rules, ["diagnosis", "tissue"], "analysis_group").select("gsm", "analysis_group")


@query("p2_membership_group", "SELECT gsm, paper_group, paper_final_set FROM member_rows", "member_rows")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.membership_group(B.records(spark, sf), B.members(spark, sf), "title", "paper_group", "paper_final_set").select(
        "gsm", "paper_group", "paper_final_set")


@query("p3_lookup_default", """SELECT gsm, COALESCE(paper_exclusion_reason, '') AS paper_exclusion_reason
 FROM records r LEFT JOIN reasons x ON r.c_nationkey = x.c_nationkey""", "records", "reasons")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.lookup_default(B.records(spark, sf), B.exclusion_reasons(spark, sf), "c_nationkey", "paper_exclusion_reason").select(
        "gsm", "paper_exclusion_reason")


@query("p4_review_flags", """SELECT m.gsm, concat_ws('; ', CASE WHEN m.diagnosis = 'cancer' AND m.c_acctbal < 0 THEN 'negative balance with cancer' END,
 CASE WHEN m.tissue = 'normal' AND m.c_acctbal > 9000 THEN 'high balance normal' END,
 CASE WHEN l.run IS NULL THEN 'no run match' END) AS review_flag
 FROM records m LEFT JOIN last_runs l ON m.experiment = l.experiment""", "records", "last_runs")
def _(spark: SparkSession, sf: str) -> DataFrame:
    df = M.attach_runs(B.records(spark, sf), B.runs(spark, sf), "experiment", "position", ["run"])
    rules = [
        ((F.col("diagnosis") == "cancer") & (F.col("c_acctbal") < 0), "negative balance with cancer"),
        ((F.col("tissue") == "normal") & (F.col("c_acctbal") > 9000), "high balance normal"),
        (~F.col("run_found"), "no run match"),
    ]
    return M.review_flags(df, rules).select("gsm", "review_flag")


@query("p5_cohort_subset", """SELECT gsm, paper_group, 'A' AS track FROM manifest WHERE paper_final_set = 'yes'
 UNION ALL SELECT gsm, paper_group, 'B' AS track FROM manifest WHERE pair_sensitivity = 'yes'""", "manifest")
def _(spark: SparkSession, sf: str) -> DataFrame:
    m = B.manifest(spark, sf)
    return C.stack_tables({
        "A": M.cohort_subset(m, "paper_final_set").select("gsm", "paper_group"),
        "B": M.cohort_subset(m, "pair_sensitivity").select("gsm", "paper_group"),
    })


@query("p11_pattern_check", """SELECT page_id, url FROM pages WHERE NOT regexp_full_match(url, 'https?://[a-z0-9.]+/[a-z]{2}/[0-9]+')""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.pattern_violations(B.table(spark, sf, "pages"), "url", "https?://[a-z0-9.]+/[a-z]{2}/[0-9]+").select("page_id", "url")


@query("j1_attach_runs", """SELECT gsm, COALESCE(run, '') AS run, COALESCE(library_layout, '') AS library_layout, COALESCE(size_mb, '') AS size_mb,
 run IS NOT NULL AS run_found FROM records r LEFT JOIN last_runs l ON r.experiment = l.experiment""", "records", "last_runs")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.attach_runs(B.records(spark, sf), B.runs(spark, sf), "experiment", "position", ["run", "library_layout", "size_mb"]).select(
        "gsm", "run", "library_layout", "size_mb", "run_found")


@query("j2_order_as", """SELECT gsm, row_number() OVER (ORDER BY c_acctbal DESC, gsm) AS ordinal FROM records""", "records")
def _(spark: SparkSession, sf: str) -> DataFrame:
    r = B.records(spark, sf)
    # The wanted order, numbered chunk by chunk: richest first.
    keyed = O.quantile_chunks(r.select("gsm", (-F.col("c_acctbal")).cast("double").alias("_o")), "_o")
    order = O.ordinal_rank(keyed, [], "chunk", ["_o", "gsm"], "ordinal")
    return M.order_as(r, order, "gsm", "ordinal").select("gsm", "ordinal")


@query("j17_quant_manifest", """SELECT s.sample_id, input_id, reference_id, index_id, output_path, n_warnings,
 CASE WHEN excluded THEN 'excluded' WHEN validated IS NULL THEN 'not_run' WHEN NOT validated THEN 'failed'
 WHEN n_warnings > 0 THEN 'complete_with_warnings' ELSE 'complete' END AS state FROM
 (SELECT gsm AS sample_id, 'cfg' || CAST(experiment % 3 AS VARCHAR) AS config_id, diagnosis = 'other' AS excluded,
 'in/' || gsm AS input_id FROM records) s
 LEFT JOIN (SELECT 'cfg' || CAST(r_regionkey AS VARCHAR) AS config_id, 'ref-' || r_name AS reference_id, 'idx-' || r_name AS index_id FROM region) c
 ON s.config_id = c.config_id
 LEFT JOIN (SELECT 'GSM' || CAST(o_custkey + 2000000 AS VARCHAR) AS sample_id, 'out/' || CAST(MAX(o_orderkey) AS VARCHAR) AS output_path,
 bool_or(o_orderstatus = 'F') AS validated, SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS n_warnings
 FROM orders GROUP BY 1) e ON s.sample_id = e.sample_id""", "records")
def _(spark: SparkSession, sf: str) -> DataFrame:
    samples = B.records(spark, sf).select(
        F.col("gsm").alias("sample_id"), F.concat(F.lit("cfg"), (F.col("experiment") % 3).cast("string")).alias("config_id"),
        (F.col("diagnosis") == "other").alias("excluded"), F.concat(F.lit("in/"), "gsm").alias("input_id"))
    config = B.table(spark, sf, "region").select(
        F.concat(F.lit("cfg"), F.col("r_regionkey").cast("string")).alias("config_id"),
        F.concat(F.lit("ref-"), "r_name").alias("reference_id"), F.concat(F.lit("idx-"), "r_name").alias("index_id"))
    evidence = B.table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.concat(F.lit("out/"), F.max("o_orderkey").cast("string")).alias("output_path"),
        F.bool_or(F.col("o_orderstatus") == "F").alias("validated"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_warnings"),
    ).select(F.concat(F.lit("GSM"), (F.col("o_custkey") + 2_000_000).cast("string")).alias("sample_id"), "output_path", "validated", "n_warnings")
    return M.quant_manifest(samples, config, evidence).select(
        "sample_id", "input_id", "reference_id", "index_id", "output_path", "n_warnings", "state")


LEVELS = ["pca_tumor", "pca_adjacent_normal", "bph_adenoma", "bph_normal", "metastasis"]


@query("a1_group_counts", f"""SELECT COALESCE(l.analysis_group, c.analysis_group) AS analysis_group, COUNT(c.gsm) AS n FROM (VALUES {", ".join(f"('{v}')" for v in LEVELS)}) l(analysis_group)
 FULL JOIN classified c ON c.analysis_group = l.analysis_group GROUP BY 1""", "classified")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.group_counts(M.classify(B.records(spark, sf), B.class_rules(), "analysis_group"), "analysis_group", LEVELS)


@query("a2_set_per_key", """SELECT patient_id, string_agg(DISTINCT analysis_group, ',' ORDER BY analysis_group) AS groups
 FROM classified GROUP BY 1""", "classified")
def _(spark: SparkSession, sf: str) -> DataFrame:
    df = M.classify(B.records(spark, sf), B.class_rules(), "analysis_group")
    return M.set_per_key(df, "patient_id", "analysis_group", "g").select("patient_id", F.array_join("g", ",").alias("groups"))


@query("a3_pair_status", "SELECT gsm, pair_status, pair_sensitivity FROM manifest", "manifest")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return B.manifest(spark, sf).select("gsm", "pair_status", "pair_sensitivity")


@query("a4_pair_integrity", """SELECT patient_id, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b, n_rows FROM (
 SELECT patient_id, SUM(CASE WHEN analysis_group = 'pca_tumor' THEN 1 ELSE 0 END) AS n_a,
 SUM(CASE WHEN analysis_group = 'pca_adjacent_normal' THEN 1 ELSE 0 END) AS n_b, COUNT(*) AS n_rows
 FROM classified GROUP BY 1) WHERE n_a <> 1 OR n_b <> 1 OR n_rows <> 2""", "classified")
def _(spark: SparkSession, sf: str) -> DataFrame:
    df = M.classify(B.records(spark, sf), B.class_rules(), "analysis_group")
    return M.pair_integrity(df, "patient_id", "analysis_group", "pca_tumor", "pca_adjacent_normal")


@query("a5_duplicate_keys", """SELECT * FROM (
 SELECT 'o_custkey' AS "column", CAST(o_custkey AS VARCHAR) AS value, COUNT(*) AS n FROM orders GROUP BY 2
 UNION ALL SELECT 'o_orderkey', CAST(o_orderkey AS VARCHAR), COUNT(*) FROM orders GROUP BY 2) WHERE n > 1""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.duplicate_keys(B.table(spark, sf, "orders"), ["o_custkey", "o_orderkey"])


@query("a6_cohort_totals", """SELECT COUNT(*) AS n_rows, CAST(SUM(COALESCE(TRY_CAST(NULLIF(size_mb, '') AS BIGINT), 0)) AS BIGINT) AS total_size,
 CAST(SUM(CASE WHEN paper_final_set = 'yes' THEN 1 ELSE 0 END) AS BIGINT) AS n_cohort,
 CAST(SUM(CASE WHEN pair_sensitivity = 'yes' THEN 1 ELSE 0 END) AS BIGINT) AS n_paired FROM manifest""", "manifest")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.cohort_totals(B.manifest(spark, sf), "size_mb", {
        "n_cohort": F.col("paper_final_set") == "yes", "n_paired": F.col("pair_sensitivity") == "yes"})


@query("a29_exactly_one", """SELECT n.p_name, COUNT(p.p_partkey) AS n FROM (SELECT DISTINCT p_name FROM part UNION SELECT r_name FROM region) n
 LEFT JOIN part p ON p.p_name = n.p_name GROUP BY 1 HAVING COUNT(p.p_partkey) <> 1""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    part = B.table(spark, sf, "part")
    names = part.select("p_name").union(B.table(spark, sf, "region").select("r_name")).distinct()
    return M.exactly_one(names, "p_name", part, "p_name")


@query("g1_check_manifest", """SELECT rule, severity, key, detail FROM (
 SELECT 'unique_id' AS rule, 'BLOCKER' AS severity, 'run=' || run AS key, CAST(COUNT(*) AS VARCHAR) AS detail FROM manifest GROUP BY run
 HAVING COUNT(*) > 1 OR run = ''
 UNION ALL SELECT 'run_pattern', 'BLOCKER', run, run FROM manifest WHERE NOT regexp_full_match(run, 'SRR[0-9]+')
 UNION ALL SELECT 'gsm_pattern', 'BLOCKER', run, gsm FROM manifest WHERE NOT regexp_full_match(gsm, 'GSM[0-9]+')
 UNION ALL SELECT 'malformed_row', 'BLOCKER', run, gsm FROM manifest WHERE gsm IS NULL OR title IS NULL OR run IS NULL OR patient_id IS NULL
 OR analysis_group IS NULL OR paper_final_set IS NULL OR paper_group IS NULL OR paper_exclusion_reason IS NULL OR pair_sensitivity IS NULL OR library_layout IS NULL
 UNION ALL SELECT 'layout', 'BLOCKER', run, library_layout FROM manifest WHERE library_layout <> 'SINGLE'
 UNION ALL SELECT 'exclusion_provenance', 'BLOCKER', run, paper_exclusion_reason FROM manifest
 WHERE paper_final_set = 'no' AND (paper_group <> 'excluded' OR paper_exclusion_reason = '')
 UNION ALL SELECT 'pair', 'BLOCKER', patient_id, CAST(a AS VARCHAR) || '/' || CAST(b AS VARCHAR) FROM (
 SELECT patient_id, SUM(CASE WHEN analysis_group = 'pca_tumor' THEN 1 ELSE 0 END) AS a,
 SUM(CASE WHEN analysis_group = 'pca_adjacent_normal' THEN 1 ELSE 0 END) AS b, COUNT(*) AS n
 FROM manifest WHERE pair_sensitivity = 'yes' GROUP BY 1) WHERE a <> 1 OR b <> 1 OR n <> 2
 UNION ALL SELECT 'row_count', 'BLOCKER', 'row_count', CAST(n AS VARCHAR) FROM (SELECT COUNT(*) AS n FROM manifest) WHERE n <> 32
 UNION ALL SELECT 'group_size_tumor', 'BLOCKER', 'group_size_tumor', CAST(n AS VARCHAR) FROM
 (SELECT COUNT(*) AS n FROM manifest WHERE paper_final_set = 'yes' AND paper_group = 'tumor') WHERE n <> 10
 UNION ALL SELECT 'group_size_control', 'BLOCKER', 'group_size_control', CAST(n AS VARCHAR) FROM
 (SELECT COUNT(*) AS n FROM manifest WHERE paper_final_set = 'yes' AND paper_group = 'control') WHERE n <> 12
 UNION ALL SELECT 'sensitivity_count', 'BLOCKER', 'sensitivity_count', CAST(n AS VARCHAR) FROM
 (SELECT COUNT(*) AS n FROM manifest WHERE pair_sensitivity = 'yes') WHERE n <> 18
 UNION ALL SELECT 'pair_count', 'BLOCKER', 'pair_count', CAST(n AS VARCHAR) FROM
 (SELECT COUNT(DISTINCT patient_id) AS n FROM manifest WHERE pair_sensitivity = 'yes') WHERE n <> 9)""", "manifest")
def _(spark: SparkSession, sf: str) -> DataFrame:
    contract = G.ManifestContract(n_rows=32, group_sizes={"tumor": 10, "control": 12}, n_sensitivity=18, n_pairs=9)
    return G.check_manifest(B.manifest(spark, sf), contract)


@query("w6_keep_last", """SELECT l_partkey, l_orderkey AS last_order, first_order FROM (
 SELECT l_partkey, MAX(l_orderkey) AS l_orderkey, MIN(l_orderkey) AS first_order FROM lineitem GROUP BY 1)""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.table(spark, sf, "lineitem").select("l_partkey", "l_orderkey")
    last = O.keep_last(rows, ["l_partkey"], "l_orderkey").withColumnRenamed("l_orderkey", "last_order")
    first = O.keep_first(rows, ["l_partkey"], "l_orderkey").withColumnRenamed("l_orderkey", "first_order")
    return last.join(first, "l_partkey")


@query("u2_is_subset", "SELECT DISTINCT l.doc_id FROM documents l WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return C.missing_members(B.table(spark, sf, "documents"), B.table(spark, sf, "labels"), "doc_id")
