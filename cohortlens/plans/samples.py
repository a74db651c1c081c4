"""Queries over sample-level QC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import quant as Q
from cohortlens.operators import sampleqc as S
from cohortlens.plans import bindings as B
from cohortlens.plans.models import vst_values
from cohortlens.plans.registry import cte, query, rounded
from cohortlens.plans.scans import STATUS_MODULES, report_archives
from cohortlens.session import materialise
from cohortlens.sources import reports as R


@query("j16_pairwise_samples", """SELECT a.sample_id AS s1, b.sample_id AS s2, COUNT(*) AS n_shared FROM quant_raw a JOIN quant_raw b
 ON a.feature_id = b.feature_id AND a.sample_id < b.sample_id GROUP BY 1, 2""", "quant_raw")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return S.pairwise_samples(B.quant(spark, sf), "feature_id", "sample_id")


@query("a17_sample_distances", """SELECT a.sample AS s1, b.sample AS s2, ROUND(sqrt(SUM((a.value - b.value) * (a.value - b.value))), 6) AS distance
 FROM vectors a JOIN vectors b ON a.feature = b.feature AND a.sample < b.sample GROUP BY 1, 2""", "vectors")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(S.sample_distances(B.vectors(spark, sf), "feature", "sample", "value"))


@query("a17b_vst_distances", """SELECT a.sample_id AS s1, b.sample_id AS s2, ROUND(sqrt(SUM((a.vst - b.vst) * (a.vst - b.vst))), 4) AS distance
 FROM vst a JOIN vst b ON a.gene_id = b.gene_id AND a.sample_id < b.sample_id GROUP BY 1, 2""", "vst")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(S.sample_distances(vst_values(spark, sf), "gene_id", "sample_id", "vst"), 4)


cte("gram", """SELECT list(cells ORDER BY s) AS g, list(s ORDER BY s) AS names FROM (SELECT a.sample_id AS s, list(g ORDER BY b.sample_id) AS cells FROM (
 SELECT a.sample_id AS a, b.sample_id AS b, SUM(a.c * b.c) AS g FROM centred a JOIN centred b ON a.gene_id = b.gene_id GROUP BY 1, 2)
 JOIN (SELECT DISTINCT sample_id FROM vst) a ON a.sample_id = a JOIN (SELECT DISTINCT sample_id FROM vst) b ON b.sample_id = b GROUP BY 1)""", "centred", "vst")
cte("centred", "SELECT gene_id, sample_id, vst - AVG(vst) OVER (PARTITION BY gene_id) AS c FROM vst", "vst")

_TRACE = "list_sum(list_transform(range(1, len({0}) + 1), lambda i: {0}[i][i]))"
_SCALED = "list_transform({0}, lambda r: list_transform(r, lambda x: x / " + _TRACE + "))"


def _axis(source: str) -> str:
    """Leading eigenvector and value of the matrix ``g`` of ``source``: repeated squaring leaves v v'."""
    return f"""WITH RECURSIVE r(k, m) AS (SELECT 0, {_SCALED.format("g")} FROM {source} UNION ALL
 SELECT k + 1, {_SCALED.format("s")} FROM (SELECT k, list_transform(m, lambda a: list_transform(m, lambda b: list_dot_product(a, b))) AS s FROM r WHERE k < 14)),
 d AS (SELECT m, list_transform(range(1, len(m) + 1), lambda i: m[i][i]) AS diagonal FROM r WHERE k = 14),
 p AS (SELECT m, list_position(diagonal, list_max(diagonal)) AS p FROM d),
 v AS (SELECT list_transform(m[p], lambda x: x / sqrt(m[p][p])) AS v FROM p)
 SELECT g, names, v, list_dot_product(v, list_transform(g, lambda r: list_dot_product(r, v))) AS value FROM v, {source}"""


cte("axis_1", _axis("gram"), "gram")
cte("rest", """SELECT list_transform(range(1, len(v) + 1), lambda i: list_transform(range(1, len(v) + 1), lambda j: g[i][j] - value * v[i] * v[j])) AS g, names FROM axis_1""", "axis_1")
cte("axis_2", _axis("rest"), "rest")
_SIGN = "CASE WHEN list_max(v) >= -list_min(v) THEN 1 ELSE -1 END"
cte("pca", f"""SELECT a.sample_id, a.pc AS pc_1, b.pc AS pc_2, a.value / total AS var_1, b.value / total AS var_2
 FROM (SELECT unnest(names) AS sample_id, unnest(v) * sqrt(value) * {_SIGN} AS pc, value, {_TRACE.format("g")} AS total FROM axis_1) a
 JOIN (SELECT unnest(names) AS sample_id, unnest(v) * sqrt(value) * {_SIGN} AS pc, value FROM axis_2) b ON a.sample_id = b.sample_id""", "axis_1", "axis_2")


@query("a18_sample_pca", """SELECT sample_id, ROUND(pc_1, 4) AS pc_1, ROUND(pc_2, 4) AS pc_2, ROUND(var_1, 6) AS var_1, ROUND(var_2, 6) AS var_2 FROM pca""", "pca")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Axes of the variance-stabilised expression values of all genes."""
    return rounded(rounded(pca(spark, sf), 4, "pc_1", "pc_2"), 6)


def pca(spark: SparkSession, sf: str) -> DataFrame:
    return S.sample_pca(vst_values(spark, sf), "gene_id", "sample_id", "vst", 2)


@query("a18b_pca_residuals", """SELECT axis, ROUND(total, 3) AS total_variance, CAST(0 AS DOUBLE) AS residual FROM (
 SELECT SUM(c * c) AS total FROM (SELECT value - AVG(value) OVER (PARTITION BY feature) AS c FROM vectors)), (SELECT unnest([1, 2, 3]) AS axis)""", "vectors")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Total variance, and what is left of ``G v - lambda v`` relative to it, of three axes of the embeddings."""
    dots = materialise(S.gram(S.centre_by_feature(B.vectors(spark, sf), "feature", "sample", "value"), "feature", "sample", "_c"))
    values, vectors = S.leading_axes(dots, 3)
    return rounded(rounded(S.axis_residuals(dots, values, vectors), 3, "total_variance"))


def points(spark: SparkSession, sf: str) -> DataFrame:
    """The first two axes of each sample, with the group of its cohort."""
    groups = B.cohort(spark, sf).select(F.col("sample_id").alias("run"), F.col("grp").alias("track"))
    return pca(spark, sf).select(F.col("sample_id").alias("run"), "pc_1", "pc_2").join(groups, "run")


cte("points", "SELECT p.sample_id AS run, grp AS track, pc_1, pc_2 FROM pca p JOIN cohort c ON c.sample_id = p.sample_id", "pca", "cohort")


@query("w1_distance_rank", """SELECT run, track, ROUND(d, 4) AS center_distance, rank() OVER (PARTITION BY track ORDER BY d DESC) AS distance_rank FROM (
 SELECT run, p.track, sqrt((pc_1 - cx) * (pc_1 - cx) + (pc_2 - cy) * (pc_2 - cy)) AS d FROM points p
 JOIN (SELECT track, median(pc_1) AS cx, median(pc_2) AS cy FROM points GROUP BY 1) c ON c.track = p.track)""", "points")
def _(spark: SparkSession, sf: str) -> DataFrame:
    ranked = S.distance_rank(materialise(points(spark, sf)), "pc_1", "pc_2", ["track"])
    return rounded(ranked.select("run", "track", "center_distance", "distance_rank"), 4)


@query("j4_join_sample_qc", """SELECT sample_id, patient, ROUND(100.0 * CAST(num_mapped AS DOUBLE) / CAST(num_processed AS DOUBLE), 6) AS pct_mapped, CAST(reads AS BIGINT) AS sum_counts
 FROM cohort JOIN run_meta USING (sample_id) JOIN (SELECT sample_id, SUM(num_reads) AS reads FROM quant_raw GROUP BY 1) USING (sample_id)""",
       "cohort", "run_meta", "quant_raw")
def _(spark: SparkSession, sf: str) -> DataFrame:
    cohort = B.cohort(spark, sf)
    joined = S.join_sample_qc(cohort, Q.mapping_rates(B.run_meta(spark, sf)), Q.sample_totals(B.genes_raw(spark, sf)), "sample_id")
    return rounded(joined, 6, "pct_mapped").select("sample_id", "patient", "pct_mapped", F.col("sum_counts").cast("long").alias("sum_counts"))


@query("j4c_sample_qc_table", """SELECT doc_id AS run, lang AS grp, n_chars AS spots, CASE WHEN doc_id % 10 = 3 THEN NULL ELSE n_chars END AS reads,
 CASE WHEN doc_id % 10 = 3 THEN NULL ELSE source END AS read_length_range,
 CASE WHEN doc_id % 10 = 3 THEN NULL ELSE CAST(n_chars % 100 AS DOUBLE) + 0.5 END AS deduplicated_pct,
 CASE WHEN doc_id % 10 = 3 THEN 'unknown' WHEN n_chars < 1000 THEN 'FAIL' WHEN n_chars < 2500 THEN 'WARN' ELSE 'PASS' END AS per_base_sequence_quality,
 CASE WHEN doc_id % 10 = 3 THEN 'unknown' WHEN lang <> 'en' THEN 'PASS' ELSE 'unknown' END AS adapter_content,
 CASE WHEN doc_id % 10 = 3 THEN 'unknown' WHEN lang = 'de' THEN 'FAIL' ELSE 'PASS' END AS sequence_duplication_levels,
 ROUND(100.0 * (n_chars * 7 // 10) / (n_chars + CASE WHEN lang = 'fr' THEN 1 ELSE 0 END), 6) AS pct_mapped,
 ROUND(100.0 * (n_chars % 50) / (n_chars + CASE WHEN lang = 'fr' THEN 1 ELSE 0 END), 6) AS pct_decoy,
 n_chars * 7 // 10 AS num_mapped, doc_id % 10 <> 3 AND lang <> 'fr' AS counts_agree FROM documents""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as samples: every tenth without a report, French ones with another number in the run metadata."""
    d = B.table(spark, sf, "documents")
    manifest = d.select(F.col("doc_id").alias("run"), F.col("lang").alias("grp"), F.col("n_chars").alias("spots"))
    archives = report_archives(spark, sf).where(F.col("path").cast("long") % 10 != 3)
    of_run = lambda df: df.select(F.col("path").cast("long").alias("run"), *[c for c in df.columns if c != "path"])
    values = R.report_values(R.sectioned_report(R.archive_lines(archives), "data.txt"), "Basic Statistics", "Sequence Duplication Levels",
                             "Total Deduplicated Percentage")
    status = R.report_status(R.archive_lines(archives).where(F.col("member").endswith("summary.txt")), ["path"], STATUS_MODULES)
    processed = F.col("n_chars") + (F.col("lang") == "fr").cast("long")
    meta = d.select(F.col("doc_id").alias("run"), processed.alias("num_processed"), F.expr("n_chars * 7 div 10").alias("num_mapped"),
                    (F.col("n_chars") % 50).alias("num_decoy_fragments"))
    table = S.sample_qc_table(manifest, of_run(values), of_run(status), Q.mapping_rates(meta))
    return rounded(table, 6)


@query("j4b_unjoined_samples", """SELECT vec_id AS run FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels)""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    vectors = B.table(spark, sf, "embeddings").withColumnRenamed("vec_id", "run")
    labels = B.table(spark, sf, "labels").withColumnRenamed("doc_id", "run")
    joined = S.join_sample_qc(vectors, labels, B.table(spark, sf, "documents").select(F.col("doc_id").alias("run"), "lang"), "run")
    return S.unjoined_samples(vectors, joined, "run")


@query("j5_annotate_left", """SELECT p.gene_key, p.gene_name, d.gene_id, ROUND(d.lfc, 6) AS lfc, ROUND(d.padj, 6) AS padj FROM published p
 LEFT JOIN de_a d ON p.gene_key = d.gene_key""", "published", "de_a")
def _(spark: SparkSession, sf: str) -> DataFrame:
    markers = B.published(spark, sf).select("gene_key", "gene_name")
    results = B.de_a(spark, sf).select("gene_key", "gene_id", "lfc", "padj")
    return rounded(S.annotate_left(markers, results, "gene_key"))


@query("a25_outlier_cells_per_sample", """SELECT sample, COUNT(*) FILTER (value > 0.2) AS n_above FROM vectors GROUP BY 1""", "vectors")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return S.influence_counts(B.vectors(spark, sf), "sample", "value", 0.2)


_MID = "rank() OVER (PARTITION BY track ORDER BY {0}) + (COUNT(*) OVER (PARTITION BY track, {0}) - 1) / CAST(2 AS DOUBLE)"


@query("a20b_qc_correlations", "SELECT track, axis, metric, n, ROUND(r, 6) AS r FROM (" + " UNION ALL ".join(
    f"SELECT track, '{a}' AS axis, '{m}' AS metric, COUNT(*) AS n, corr(ra, rm) AS r FROM (SELECT track, {_MID.format(a)} AS ra, {_MID.format(m)} AS rm FROM qc_points) GROUP BY 1"
    for a in ("pc_1", "pc_2") for m in ("pct_mapped", "sum_counts")
) + ")", "qc_points")
def _(spark: SparkSession, sf: str) -> DataFrame:
    mapped = Q.mapping_rates(B.run_meta(spark, sf)).select(F.col("sample_id").alias("run"), "pct_mapped")
    totals = Q.sample_totals(B.genes_raw(spark, sf)).select(F.col("sample_id").alias("run"), "sum_counts")
    joined = materialise(S.join_sample_qc(points(spark, sf), mapped, totals, "run"))
    return rounded(S.qc_correlations(joined, ["pc_1", "pc_2"], ["pct_mapped", "sum_counts"], ["track"]))


cte("qc_points", """SELECT p.*, 100.0 * CAST(num_mapped AS DOUBLE) / CAST(num_processed AS DOUBLE) AS pct_mapped, reads AS sum_counts FROM points p
 JOIN run_meta m ON m.sample_id = p.run JOIN (SELECT sample_id, SUM(num_reads) AS reads FROM quant_raw GROUP BY 1) q ON q.sample_id = p.run""", "points", "run_meta", "quant_raw")
