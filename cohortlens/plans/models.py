"""Queries over the differential model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import model as M
from cohortlens.operators import quant as Q
from cohortlens.operators.ordering import exact_median
from cohortlens.plans import bindings as B
from cohortlens.plans.registry import cte, query, rounded
from cohortlens.session import materialise

FACTORS = {"patient": [f"P{i:02d}" for i in range(B.N_SAMPLES // 2)], "condition": ["normal", "tumor"]}

_WIDE = ", ".join(f"CASE WHEN patient = '{p}' THEN 1 ELSE 0 END AS \"patient_{p}\"" for p in FACTORS["patient"][1:])
cte("design_b", f"SELECT sample_id, 1 AS intercept, {_WIDE}, CASE WHEN condition = 'tumor' THEN 1 ELSE 0 END AS condition_tumor FROM cohort", "cohort")


def design_a(spark: SparkSession, sf: str) -> DataFrame:
    return M.design_matrix(B.cohort(spark, sf), "sample_id", {"grp": ["control", "tumor"]})


def design_b(spark: SparkSession, sf: str) -> DataFrame:
    return M.design_matrix(B.cohort(spark, sf), "sample_id", FACTORS)


@query("m1_design_matrix", "SELECT * FROM design_b", "design_b")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return design_b(spark, sf)


def _rank_of(design: str) -> str:
    """Samples, columns and rank: elimination on the cross products, whose diagonal entries are the pivots."""
    return f"""WITH RECURSIVE x AS (FROM (UNPIVOT {design} ON COLUMNS(* EXCLUDE (sample_id)) INTO NAME c VALUE v)),
 g AS (SELECT list(cells ORDER BY a) AS m FROM (SELECT a, list(s ORDER BY b) AS cells FROM (
  SELECT p.c AS a, q.c AS b, CAST(SUM(p.v * q.v) AS DOUBLE) AS s FROM x p JOIN x q ON p.sample_id = q.sample_id GROUP BY 1, 2) GROUP BY 1)),
 e(k, m, rank) AS (SELECT 1, m, 0 FROM g UNION ALL SELECT k + 1, CASE WHEN m[k][k] > 1e-9 THEN list_transform(range(1, len(m) + 1),
  lambda i: list_transform(range(1, len(m) + 1), lambda j: m[i][j] - m[i][k] * m[k][j] / m[k][k])) ELSE m END,
  rank + CASE WHEN m[k][k] > 1e-9 THEN 1 ELSE 0 END FROM e WHERE k <= len(m))
 SELECT (SELECT COUNT(DISTINCT sample_id) FROM x) AS n_samples, CAST(len(m) AS INTEGER) AS n_columns, rank,
  rank = len(m) AND (SELECT COUNT(DISTINCT sample_id) FROM x) > len(m) AS valid FROM e WHERE k = len(m) + 1"""


cte("rank_b", _rank_of("design_b"), "design_b")
cte("design_c", "SELECT *, 1 - condition_tumor AS condition_normal FROM design_b", "design_b")
cte("rank_c", _rank_of("design_c"), "design_c")


@query("m2_check_design", "SELECT * FROM rank_b", "rank_b")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.check_design(design_b(spark, sf), "sample_id")


@query("m2b_dependent_design", "SELECT * FROM rank_c", "rank_c")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A column for each condition beside the intercept: one column too many."""
    return M.check_design(design_b(spark, sf).withColumn("condition_normal", 1 - F.col("condition_tumor")), "sample_id")


cte("nonzero", """SELECT * FROM genes WHERE gene_id IN (SELECT gene_id FROM genes GROUP BY 1 HAVING SUM("count") > 0)""", "genes")


@query("p6_drop_all_zero", """SELECT COUNT(DISTINCT gene_id) AS n_genes, COUNT(*) AS n_cells, CAST(SUM("count") AS BIGINT) AS reads FROM dense
 WHERE gene_id IN (SELECT gene_id FROM dense GROUP BY 1 HAVING SUM("count") > 0)""", "dense")
def _(spark: SparkSession, sf: str) -> DataFrame:
    part = Q.densify(B.genes_raw(spark, sf), B.SAMPLES)
    return M.drop_all_zero(part).groupBy("gene_id").agg(F.count(F.lit(1)).alias("n"), F.sum("count").alias("c")).agg(
        F.count(F.lit(1)).alias("n_genes"), F.sum("n").alias("n_cells"), F.sum("c").cast("long").alias("reads"))


cte("geo_count", """SELECT gene_id, exp(avg(ln(NULLIF("count", 0)))) AS g FROM dense GROUP BY 1 HAVING MIN("count") > 0""", "dense")


@query("m3_size_factors", """SELECT sample_id, ROUND(exp(median(ln("count") - ln(g))), 6) AS size_factor FROM dense d JOIN geo_count g ON d.gene_id = g.gene_id
 GROUP BY 1""", "dense", "geo_count")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(M.size_factors(Q.densify(B.genes_raw(spark, sf), B.SAMPLES)))


def _factor_ctes(source: str, name: str, prefix: str) -> None:
    """The statements behind normalisation factors of the genes x samples of ``source``."""
    size, length, geo = f"{prefix}_size", f"{prefix}_len", f"{prefix}_geo"
    cte(length, f"""SELECT gene_id, sample_id, "count", length, exp(ln(length) - avg(ln(length)) OVER (PARTITION BY gene_id)) AS nl FROM {source}""", source)
    cte(geo, f"""SELECT gene_id, exp(avg(ln(NULLIF("count" / nl, 0)))) AS g FROM {length} GROUP BY 1 HAVING MIN("count") > 0""", length)
    cte(size, f"""SELECT sample_id, exp(median(ln("count" / nl) - ln(g))) AS s FROM {length} l JOIN {geo} g ON l.gene_id = g.gene_id GROUP BY 1""", length, geo)
    cte(name, f"""SELECT gene_id, sample_id, "count", length, exp(ln(nl * s) - avg(ln(nl * s)) OVER (PARTITION BY gene_id)) AS nf FROM (
 SELECT l.*, s FROM {length} l JOIN {size} z ON l.sample_id = z.sample_id)""", length, size)


_factor_ctes("genes", "factors", "nf")

#: Patients of the paired track, each with both conditions.
PAIRED = 9


def paired_cohort(spark: SparkSession, sf: str) -> DataFrame:
    return B.cohort(spark, sf).where(F.col("sample_no") < 2 * PAIRED)


def paired_factors(spark: SparkSession, sf: str, scale: float = 1.0, genes: DataFrame | None = None) -> DataFrame:
    """Factors of the paired track: its samples alone, before rounding, zero filter and normalisation."""
    genes = B.genes(spark, sf) if genes is None else genes
    return M.track_factors(genes.withColumn("count", F.col("count") * scale), paired_cohort(spark, sf), "sample_id")


cte("paired_raw", f"""SELECT gene_id, sample_id, round_even("count" * 0.005, 0) AS "count", length FROM genes
 WHERE sample_id IN (SELECT sample_id FROM cohort WHERE sample_no < {2 * PAIRED})""", "genes", "cohort")
cte("paired_genes", """SELECT * FROM paired_raw WHERE gene_id IN (SELECT gene_id FROM paired_raw GROUP BY 1 HAVING SUM("count") > 0)""", "paired_raw")
_factor_ctes("paired_genes", "paired_factors", "pf")


@query("m4c_paired_factors", 'SELECT gene_id, sample_id, CAST("count" AS BIGINT) AS "count", ROUND(nf, 6) AS nf FROM paired_factors', "paired_factors")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Quantities scaled down, so that halves are rounded and some genes are left without a read."""
    found = rounded(paired_factors(spark, sf, 0.005), 6, "nf")
    return found.select("gene_id", "sample_id", F.col("count").cast("long").alias("count"), "nf")


def factors(spark: SparkSession, sf: str, genes: DataFrame | None = None) -> DataFrame:
    return M.norm_factors(M.drop_all_zero(M.whole_counts(B.genes(spark, sf) if genes is None else genes)))


@query("m4_norm_factors", 'SELECT gene_id, sample_id, CAST("count" AS BIGINT) AS "count", ROUND(nf, 6) AS nf FROM factors', "factors")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(factors(spark, sf), 6, "nf").select("gene_id", "sample_id", F.col("count").cast("long").alias("count"), "nf")


@query("m4b_norm_factor_violations", "SELECT gene_id, sample_id FROM factors WHERE nf IS NULL OR nf <= 0 OR isnan(nf) OR isinf(nf)", "factors")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.norm_factor_violations(factors(spark, sf)).select("gene_id", "sample_id")


@query("m5_base_mean", 'SELECT gene_id, ROUND(AVG("count" / nf), 5) AS base_mean FROM factors GROUP BY 1', "factors")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(M.base_mean(factors(spark, sf)), 5)


def fitted_genes(spark: SparkSession, sf: str) -> tuple[DataFrame, M.Design]:
    design = M.local_design(design_a(spark, sf), "sample_id")
    return materialise(M.gene_dispersion(M.gene_arrays(factors(spark, sf), design), design)), design


@query("m6_gene_dispersion")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fitted_genes(spark, sf)[0].select("gene_id", "base_mean", "disp_gene"))


@query("m7_dispersion_trend")
def _(spark: SparkSession, sf: str) -> DataFrame:
    genes, _ = fitted_genes(spark, sf)
    trend = M.dispersion_trend(genes)
    return rounded(genes.select("gene_id", "base_mean", trend.column(F.col("base_mean")).alias("disp_fit")))


cte("mom", """SELECT gene_id, avg(q) AS base_mean,
 greatest(CASE WHEN avg(q) <> 0 THEN (var_samp(q) - avg(1 / nf) * avg(q)) / (avg(q) * avg(q)) END, 1e-8) AS disp_gene
 FROM (SELECT *, "count" / nf AS q FROM factors) GROUP BY 1""", "factors")


@query("m6b_moment_dispersion", "SELECT gene_id, ROUND(base_mean, 5) AS base_mean, ROUND(disp_gene, 6) AS disp_gene FROM mom", "mom")
def _(spark: SparkSession, sf: str) -> DataFrame:
    found = M.moment_dispersion(factors(spark, sf))
    return rounded(rounded(found, 5, "base_mean"), 6, "disp_gene")


# Weighted least squares step by step; (o0, o1) choose the genes of the present fit, done once two fits agree.
cte("trend", """WITH RECURSIVE f(n, o0, o1, a0, a1, done) AS (
 SELECT 0, CAST(0.1 AS DOUBLE), CAST(1 AS DOUBLE), CAST(0.1 AS DOUBLE), CAST(1 AS DOUBLE), false
 UNION ALL
 SELECT n + 1, CASE WHEN fitted THEN b0 ELSE o0 END, CASE WHEN fitted THEN b1 ELSE o1 END, b0, b1,
  fitted AND pow(ln(b0 / o0), 2) + pow(ln(greatest(b1, 1e-300) / greatest(o1, 1e-300)), 2) < 1e-6
 FROM (SELECT *, abs(b0 - a0) / (a0 + 1e-8) + abs(b1 - a1) / (a1 + 1e-8) < 1e-11 AS fitted FROM (
  SELECT n, o0, o1, a0, a1, CASE WHEN w * wxy < wx * wy THEN wy / w ELSE greatest((wxx * wy - wx * wxy) / (w * wxx - wx * wx), 1e-8) END AS b0,
   greatest((w * wxy - wx * wy) / (w * wxx - wx * wx), 0) AS b1 FROM (
   SELECT n, o0, o1, a0, a1, sum(w) AS w, sum(w * x) AS wx, sum(w * x * x) AS wxx, sum(w * y) AS wy, sum(w * x * y) AS wxy FROM (
    SELECT f.*, x, y, 1 / ((a0 + a1 * x) * (a0 + a1 * x)) AS w
    FROM f, (SELECT disp_gene AS y, 1 / base_mean AS x FROM mom WHERE disp_gene >= 1e-6 AND base_mean > 0)
    WHERE NOT done AND n < 3000 AND y / (o0 + o1 * x) > 1e-4 AND y / (o0 + o1 * x) < 15)
   GROUP BY 1, 2, 3, 4, 5)))) SELECT a0, a1 FROM f WHERE done""", "mom")


def moment_trend(spark: SparkSession, cells: DataFrame) -> DataFrame:
    """The trend of the moment dispersions, fitted without the design."""
    return M.trend_table(spark, M.dispersion_trend(materialise(M.moment_dispersion(cells))))


@query("m7b_trend_of_moments", "SELECT ROUND(a0, 6) AS a0, ROUND(a1, 6) AS a1 FROM trend", "trend")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(moment_trend(spark, factors(spark, sf)))


@query("m8_dispersion_map")
def _(spark: SparkSession, sf: str) -> DataFrame:
    genes, design = fitted_genes(spark, sf)
    trend = M.dispersion_trend(genes)
    prior = M.dispersion_prior(genes, trend, *design.x.shape)
    return rounded(M.dispersion_map(genes, design, trend, prior))


def contrast_b(spark: SparkSession, sf: str, genes: DataFrame | None = None) -> M.Contrast:
    """The paired track: its own samples, patients and factors."""
    levels = {"patient": FACTORS["patient"][:PAIRED], "condition": FACTORS["condition"]}
    design = M.local_design(M.design_matrix(paired_cohort(spark, sf), "sample_id", levels), "sample_id")
    return M.differential(paired_factors(spark, sf, genes=genes), design, "condition_tumor")


@query("m9_nb_wald_test")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Both tracks of the study in one table, each normalised on its own samples; the gene table is stored for both."""
    design = M.local_design(design_a(spark, sf), "sample_id")
    genes = materialise(B.genes(spark, sf))
    a = M.differential(factors(spark, sf, genes), design, "grp_tumor").result.withColumn("track", F.lit("A"))
    b = contrast_b(spark, sf, genes).result.withColumn("track", F.lit("B"))
    keep = ["track", "gene_id", "base_mean", "lfc", "lfc_se", "stat", "pvalue", "padj", "tested", "significant"]
    return rounded(a.unionByName(b).select(*keep))


@query("m11_cooks_distance")
def _(spark: SparkSession, sf: str) -> DataFrame:
    c = contrast_b(spark, sf)
    cut = M.review_cutoff(c.design)
    return rounded(M.cooks_long(c.fitted, c.design)).withColumn("above", F.col("cooks") > cut)


CUTS = [12.0, 20.0, 25.0, 30.0, 35.0, 40.0]


@query("m10_filter_rejections", f"""SELECT cut, COUNT(*) AS n_tests, MAX(CASE WHEN pvalue * n <= 0.1 * rn THEN rn ELSE 0 END) AS rejections FROM (
 SELECT cut, pvalue, row_number() OVER (PARTITION BY cut ORDER BY pvalue) AS rn, COUNT(*) OVER (PARTITION BY cut) AS n
 FROM de_a JOIN (SELECT unnest(range({len(CUTS)})) AS cut, unnest({CUTS}) AS c) ON base_mean >= c WHERE pvalue IS NOT NULL) GROUP BY 1""", "de_a")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.filter_rejections(B.de_a(spark, sf), CUTS, 0.1).select("cut", "n_tests", "rejections")


@query("m10b_adjust_above", """SELECT gene_id, ROUND(padj, 9) AS padj FROM (SELECT gene_id, least(1.0, MIN(q) OVER (ORDER BY rn DESC ROWS UNBOUNDED PRECEDING)) AS padj FROM (
 SELECT gene_id, row_number() OVER w AS rn, pvalue * COUNT(*) OVER () / row_number() OVER w AS q
 FROM de_a WHERE pvalue IS NOT NULL AND base_mean >= 30 WINDOW w AS (ORDER BY pvalue, gene_id)))
 UNION ALL SELECT gene_id, NULL FROM de_a WHERE pvalue IS NULL OR base_mean < 30""", "de_a")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(M.adjust_above(B.de_a(spark, sf).drop("padj"), 30.0), 9).select("gene_id", "padj")


@query("m10c_independent_filter")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(M.independent_filter(B.de_a(spark, sf).drop("padj")), 9).select("gene_id", "padj")


cte("vst", """SELECT gene_id, sample_id, log2((1 + a1 + 2 * a0 * q + 2 * sqrt(a0 * q * (1 + a1 + a0 * q))) / (4 * a0)) AS vst
 FROM (SELECT gene_id, sample_id, "count" / nf AS q FROM factors), trend""", "factors", "trend")


def vst_values(spark: SparkSession, sf: str) -> DataFrame:
    """Stabilised values of all genes and samples, with the trend fitted to them."""
    cells = materialise(factors(spark, sf))
    return M.vst(cells, moment_trend(spark, cells))


@query("m12_vst", "SELECT gene_id, sample_id, ROUND(vst, 5) AS vst FROM vst", "vst")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(vst_values(spark, sf), 5)


@query("m12b_blind_vst")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """With the trend of likelihood dispersions under an intercept alone."""
    cells = materialise(factors(spark, sf))
    trend = M.blind_trend(cells, M.local_design(design_a(spark, sf), "sample_id"))
    return rounded(M.vst(cells, M.trend_table(spark, trend)), 5)


@query("m3b_exact_median", """SELECT l_returnflag, ROUND(median(l_extendedprice), 6) AS med FROM lineitem GROUP BY 1""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(exact_median(B.table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice"), "l_extendedprice", ["l_returnflag"], "med"))
