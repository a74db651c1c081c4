"""Queries that compare significant sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import strip_version
from cohortlens.operators import compare as C
from cohortlens.operators import model as M
from cohortlens.operators import ordering as O
from cohortlens.plans import bindings as B
from cohortlens.plans.registry import cte, query, rounded, text_id

cte("ours", "SELECT gene_key, gene_id AS ours_gene_id, base_mean, lfc, pvalue, padj FROM de_a", "de_a")
cte("joined", """SELECT COALESCE(p.gene_key, o.gene_key) AS gene_key, p.gene_name, p.published_lfc, p.published_fdr, p.gene_type, o.ours_gene_id,
 o.lfc, o.pvalue, o.padj, p.gene_key IS NOT NULL AS in_published, o.gene_key IS NOT NULL AS in_ours,
 COALESCE(o.padj < 0.05, FALSE) AS ours_significant FROM published p FULL JOIN ours o ON p.gene_key = o.gene_key""", "published", "ours")
cte("compared", "SELECT *, in_published AND ours_significant AS in_both_significant FROM joined WHERE in_published OR ours_significant", "joined")


@query("j6_compare_full", """SELECT gene_key, gene_name, ROUND(published_lfc, 6) AS published_lfc, ours_gene_id, ROUND(lfc, 6) AS lfc,
 ROUND(padj, 6) AS padj, ours_significant, in_both_significant,
 CASE WHEN in_both_significant THEN published_lfc * lfc > 0 END AS direction_agrees FROM compared""", "compared")
def _(spark: SparkSession, sf: str) -> DataFrame:
    df = C.compare_full(B.published(spark, sf), B.ours_side(spark, sf))
    agrees = F.when(F.col("in_both_significant"), F.col("published_lfc") * F.col("lfc") > 0)
    return rounded(df.withColumn("direction_agrees", agrees).select(
        "gene_key", "gene_name", "published_lfc", "ours_gene_id", "lfc", "padj", "ours_significant", "in_both_significant", "direction_agrees"))


@query("j7_paired_effects", """SELECT p.gene_key, ROUND(published_lfc, 6) AS published_lfc, ROUND(lfc, 6) AS lfc FROM published p
 JOIN ours o ON p.gene_key = o.gene_key WHERE published_lfc IS NOT NULL AND lfc IS NOT NULL""", "published", "ours")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(C.paired_effects(B.published(spark, sf), B.ours_side(spark, sf), "gene_key", "published_lfc", "lfc"))


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicate pairs: consecutive parts with equal brand and type."""
    p = B.table(spark, sf, "part")
    left = p.select(F.col("p_partkey").alias("retained"), "p_brand", "p_type")
    right = p.select((F.col("p_partkey") - 3).alias("retained"), F.col("p_brand").alias("b"), F.col("p_type").alias("t"))
    same = left.join(right, "retained").where((F.col("p_type") == F.col("t")))
    return same.select("retained", (F.col("retained") + 3).alias("duplicate"))


cte("edges", """SELECT a.p_partkey AS retained, b.p_partkey AS duplicate FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 3
 WHERE a.p_type = b.p_type""")


@query("j8_cross_group_pairs", """SELECT COUNT(*) AS n_pairs, CAST(SUM(CASE WHEN m.gene_id <> n.gene_id THEN 1 ELSE 0 END) AS BIGINT) AS n_cross,
 CAST(SUM(CASE WHEN m.gene_id = n.gene_id THEN 1 ELSE 0 END) AS BIGINT) AS n_within,
 CAST(SUM(CASE WHEN m.gene_id IS NULL OR n.gene_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_unmapped
 FROM edges LEFT JOIN feature_map m ON m.feature_id = retained LEFT JOIN feature_map n ON n.feature_id = duplicate""", "edges", "feature_map")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return C.cross_group_pairs(edges(spark, sf), B.feature_map(spark, sf), "retained", "duplicate")


@query("j9_groups_without_retained", """SELECT gene_type, COUNT(*) AS n_groups FROM gene_types WHERE gene_id NOT IN (
 SELECT gene_id FROM feature_map WHERE feature_id NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50))
 GROUP BY 1""", "gene_types", "feature_map")
def _(spark: SparkSession, sf: str) -> DataFrame:
    dup = B.table(spark, sf, "lineitem").where("l_quantity >= 50").select(F.col("l_partkey").alias("feature_id")).distinct()
    return C.groups_without_retained(B.feature_map(spark, sf), dup, B.gene_types(spark, sf))


@query("j10_unmatched_keys", """SELECT COALESCE(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'left_only' ELSE 'right_only' END AS side
 FROM (SELECT DISTINCT doc_id FROM labels) a FULL JOIN (SELECT DISTINCT conv_id AS doc_id FROM conversations) b ON a.doc_id = b.doc_id
 WHERE a.doc_id IS NULL OR b.doc_id IS NULL""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    conv = B.table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"))
    return C.unmatched_keys(B.table(spark, sf, "labels"), conv, "doc_id")


@query("j11_ordered_equal", """SELECT COALESCE(a.ordinal, b.ordinal) AS ordinal, a.v AS left_value, b.v AS right_value FROM
 (SELECT row_number() OVER (ORDER BY conv_id, turn) AS ordinal, role AS v FROM conversations) a FULL JOIN
 (SELECT row_number() OVER (ORDER BY conv_id, turn) AS ordinal, CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END AS v FROM conversations) b
 ON a.ordinal = b.ordinal WHERE a.v IS DISTINCT FROM b.v""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    c = B.table(spark, sf, "conversations").withColumn("chunk", F.floor(F.col("conv_id") / 128))
    numbered = O.ordinal_rank(c.select("chunk", "conv_id", "turn", "role"), [], "chunk", ["conv_id", "turn"], "ordinal")
    planned = numbered.withColumn("role", F.when(F.col("turn") % 2 == 0, "user").otherwise("assistant"))
    return C.ordered_mismatches(numbered, planned, "ordinal", "role")


@query("j12_disjoint", "SELECT doc_id FROM good_ids INTERSECT SELECT doc_id FROM toxic_ids", "good_ids", "toxic_ids")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return C.shared_ids(B.id_set(spark, sf, "quality"), B.id_set(spark, sf, "toxic"), "doc_id")


@query("a14_overlap_metrics", """SELECT *, ROUND(overlap / CAST(union_size AS DOUBLE), 6) AS jaccard, ROUND(overlap / CAST(published AS DOUBLE), 6) AS recovery,
 ROUND(overlap / CAST(ours AS DOUBLE), 6) AS overlap_fraction FROM (SELECT
 COUNT(*) FILTER (in_published) AS published, COUNT(*) FILTER (in_published AND published_lfc > 0) AS published_up,
 COUNT(*) FILTER (in_published AND NOT published_lfc > 0) AS published_down, COUNT(*) FILTER (ours_significant) AS ours,
 COUNT(*) FILTER (in_both_significant) AS overlap, COUNT(*) AS union_size, COUNT(*) FILTER (in_published AND in_ours) AS published_in_universe,
 COUNT(*) FILTER (in_published AND NOT ours_significant) AS published_only, COUNT(*) FILTER (NOT in_published) AS ours_only FROM compared)""", "compared")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(C.overlap_metrics(B.published(spark, sf), B.ours_side(spark, sf)))


def effect_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return C.paired_effects(B.published(spark, sf), B.ours_side(spark, sf), "gene_key", "published_lfc", "lfc")


cte("pairs", "SELECT p.gene_key, published_lfc, lfc FROM published p JOIN ours o ON p.gene_key = o.gene_key", "published", "ours")


@query("a15_direction_concordance", """SELECT n_pairs, concordant, opposed, zero, ROUND(concordant / CAST(n_pairs AS DOUBLE), 6) AS agreement FROM (
 SELECT COUNT(*) AS n_pairs, COUNT(*) FILTER (published_lfc * lfc > 0) AS concordant, COUNT(*) FILTER (published_lfc * lfc < 0) AS opposed,
 COUNT(*) FILTER (published_lfc * lfc = 0) AS zero FROM pairs)""", "pairs")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(C.direction_concordance(effect_pairs(spark, sf), "published_lfc", "lfc"))


@query("a16_sign_concordance", """SELECT a.gene_key, ROUND(a.lfc, 6) AS lfc_a, ROUND(b.lfc, 6) AS lfc_b, sign(a.lfc) = sign(b.lfc) AS same_sign
 FROM de_a a JOIN de_b b ON a.gene_key = b.gene_key WHERE a.padj < 0.05 AND b.padj < 0.05""", "de_a", "de_b")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(C.sign_concordance(B.de_a(spark, sf), B.de_b(spark, sf), "gene_key", "lfc"))


@query("a19_pearson", """SELECT gene_type, COUNT(*) AS n, ROUND(corr(published_lfc, lfc), 6) AS r
 FROM published p JOIN ours o ON p.gene_key = o.gene_key GROUP BY 1""", "published", "ours")
def _(spark: SparkSession, sf: str) -> DataFrame:
    pairs = B.published(spark, sf).join(B.ours_side(spark, sf), "gene_key")
    return rounded(C.pearson(pairs, "published_lfc", "lfc", ["gene_type"]))


@query("a20_spearman", """SELECT COUNT(*) AS n, ROUND(corr(rx, ry), 6) AS r FROM (
 SELECT rank() OVER (ORDER BY l_quantity) + (COUNT(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS rx,
 rank() OVER (ORDER BY l_extendedprice) + (COUNT(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS ry FROM lineitem)""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(C.spearman(B.table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice"), "l_quantity", "l_extendedprice"))


@query("a21_type_composition", """SELECT track, gene_type, COUNT(*) AS n FROM (
 SELECT track, COALESCE(t.gene_type, 'unannotated') AS gene_type FROM (
 SELECT 'A' AS track, gene_key FROM de_a WHERE significant UNION ALL SELECT 'B', gene_key FROM de_b WHERE significant) s
 LEFT JOIN (SELECT 'ENSG' || lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(11, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') AS gene_key, p_type AS gene_type FROM part) t
 ON s.gene_key = t.gene_key) GROUP BY GROUPING SETS ((track, gene_type), (track))""", "de_a", "de_b")
def _(spark: SparkSession, sf: str) -> DataFrame:
    sets = C.stack_tables({"A": B.de_a(spark, sf).where("significant").select("gene_key"),
                           "B": B.de_b(spark, sf).where("significant").select("gene_key")})
    types = B.table(spark, sf, "part").select(text_id("ENSG", F.col("p_partkey"), 11).alias("gene_key"), F.col("p_type").alias("gene_type"))
    return C.type_composition(sets, types, "gene_key", "track")


@query("a22_type_consistency", """SELECT gene_key, COUNT(DISTINCT feature_type) AS n_types FROM (
 SELECT split_part(gene_id, '.', 1) AS gene_key, feature_type FROM feature_map) GROUP BY 1 HAVING COUNT(DISTINCT feature_type) > 1""", "feature_map")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return C.type_conflicts(B.feature_map(spark, sf).withColumn("gene_key", strip_version("gene_id")), "gene_key", "feature_type")


cte("tracks", "SELECT 'A' AS track, * FROM de_a UNION ALL SELECT 'B' AS track, * FROM de_b", "de_a", "de_b")


def tracks(spark: SparkSession, sf: str) -> DataFrame:
    return C.stack_tables({"A": B.de_a(spark, sf), "B": B.de_b(spark, sf)})


@query("a23_de_summary", """SELECT track, COUNT(*) AS n_genes, COUNT(*) FILTER (tested) AS tested, COUNT(padj) AS has_padj,
 COUNT(*) FILTER (significant) AS n_significant, COUNT(*) FILTER (significant AND lfc > 0) AS n_up, COUNT(*) FILTER (significant AND lfc < 0) AS n_down,
 COUNT(*) FILTER (pvalue IS NULL) AS pvalue_null, COUNT(*) FILTER (pvalue IS NOT NULL AND padj IS NULL) AS filtered_padj_null
 FROM tracks GROUP BY 1""", "tracks")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return C.de_summary(tracks(spark, sf), ["track"])


@query("a24_track_overlap", """SELECT a.gene_key, ROUND(a.lfc, 6) AS lfc_a, ROUND(b.lfc, 6) AS lfc_b FROM de_a a JOIN de_b b ON a.gene_key = b.gene_key
 WHERE a.padj < 0.05 AND b.padj < 0.05""", "de_a", "de_b")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(C.track_overlap(B.de_a(spark, sf), B.de_b(spark, sf), "gene_key", "lfc"))


@query("a26_marker_consistency", """SELECT m.gene_key, COUNT(track) AS n_contrasts, COUNT(*) FILTER (padj < 0.05) AS n_significant,
 bool_and(COALESCE(padj < 0.05, FALSE)) AS significant_in_all, COUNT(DISTINCT sign(lfc)) AS n_signs
 FROM (SELECT gene_key FROM published) m LEFT JOIN tracks t ON m.gene_key = t.gene_key GROUP BY 1""", "published", "tracks")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return C.marker_consistency(B.published(spark, sf).select("gene_key"), tracks(spark, sf), "gene_key", "track")


CATEGORY_SQL = """CASE WHEN o.gene_key IS NULL THEN 'absent_from_our_nonzero_gene_universe' WHEN pvalue IS NULL THEN 'our_raw_p_unavailable'
 WHEN padj IS NULL THEN 'our_BH_padj_unavailable' WHEN padj >= 0.05 AND pvalue < 0.05 THEN 'our_nominal_p_below_0.05_but_BH_not'
 WHEN padj >= 0.05 THEN 'our_not_significant_nominal' ELSE 'our_significant' END"""


@query("p8_discordance_category", f"""SELECT category, COUNT(*) AS n FROM (SELECT {CATEGORY_SQL} AS category
 FROM published p LEFT JOIN ours o ON p.gene_key = o.gene_key) GROUP BY 1""", "published", "ours")
def _(spark: SparkSession, sf: str) -> DataFrame:
    joined = B.published(spark, sf).join(B.ours_side(spark, sf), "gene_key", "left")
    return C.discordance_category(joined, F.col("ours_gene_id").isNotNull(), "pvalue", "padj").groupBy("category").agg(F.count(F.lit(1)).alias("n"))


PART_TYPES_SQL = "SELECT 'ENSG' || lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(11, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') AS gene_key, p_type FROM part"
TABLE_SQL = f"""SELECT o.gene_key, CASE WHEN in_both_significant THEN 'shared_DE' WHEN in_published THEN 'published_only' ELSE 'ours_only' END AS status,
 CASE WHEN NOT in_published THEN 'not_in_published_DE_table' WHEN NOT in_ours THEN 'absent_from_our_nonzero_gene_universe'
 ELSE {CATEGORY_SQL} END AS category, o.gene_type AS published_type, COALESCE(p_type, 'unannotated') AS ours_type,
 published_lfc * lfc > 0 AS direction_agrees FROM compared o LEFT JOIN ({PART_TYPES_SQL}) t ON t.gene_key = o.gene_key"""


def discordance_rows(spark: SparkSession, sf: str) -> DataFrame:
    types = B.table(spark, sf, "part").select(text_id("ENSG", F.col("p_partkey"), 11).alias("gene_key"), F.col("p_type").alias("type"))
    return C.discordance_table(C.compare_full(B.published(spark, sf), B.ours_side(spark, sf)), types)


@query("p8b_discordance_table", TABLE_SQL, "compared")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return discordance_rows(spark, sf)


@query("p8c_published_only_categories", f"SELECT category, COUNT(*) AS n FROM ({TABLE_SQL}) WHERE status = 'published_only' GROUP BY 1", "compared")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return discordance_rows(spark, sf).where("status = 'published_only'").groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("g8_comparator_guards", """SELECT rule, gene_key, n FROM (
 SELECT 'duplicate_id' AS rule, gene_key, COUNT(*) AS n FROM published_all GROUP BY 2 HAVING COUNT(*) > 1
 UNION ALL SELECT 'missing_fdr', gene_key, COUNT(*) FROM published_all WHERE published_fdr IS NULL GROUP BY 2
 UNION ALL SELECT 'fdr_not_significant', gene_key, COUNT(*) FROM published_all WHERE published_fdr >= 0.05 GROUP BY 2)""", "published_all")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.published_all(spark, sf).withColumn("gene_key", F.substring_index("ensemble_id", ".", 1))
    return C.comparator_violations(rows, "gene_key", "FDR")


@query("p7_de_flags", """SELECT gene_id, pvalue IS NOT NULL AS tested, COALESCE(padj < 0.05, FALSE) AS significant FROM de_b""", "de_b")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return M.de_flags(B.de_b(spark, sf).drop("tested", "significant")).select("gene_id", "tested", "significant")


@query("w2_mid_rank", """SELECT l_returnflag, l_quantity, COUNT(*) AS n, MAX(r) AS mid_rank FROM (
 SELECT l_returnflag, l_quantity, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity)
 + (COUNT(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / CAST(2 AS DOUBLE) AS r FROM lineitem) GROUP BY 1, 2""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    ranked = O.mid_rank(B.table(spark, sf, "lineitem").select("l_returnflag", "l_quantity"), "l_quantity", ["l_returnflag"], "r")
    return ranked.groupBy("l_returnflag", "l_quantity").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("mid_rank"))


@query("w3_bh_adjust", """SELECT track, gene_id, ROUND(padj, 9) AS padj FROM (SELECT track, gene_id, least(1.0, MIN(q) OVER (
 PARTITION BY track ORDER BY rn DESC ROWS UNBOUNDED PRECEDING)) AS padj FROM (SELECT track, gene_id,
 row_number() OVER w AS rn, pvalue * COUNT(*) OVER (PARTITION BY track) / row_number() OVER w AS q
 FROM tracks WHERE pvalue IS NOT NULL WINDOW w AS (PARTITION BY track ORDER BY pvalue, gene_id)))
 UNION ALL SELECT track, gene_id, NULL FROM tracks WHERE pvalue IS NULL""", "tracks")
def _(spark: SparkSession, sf: str) -> DataFrame:
    raw = tracks(spark, sf).select("track", "gene_id", "pvalue")
    return rounded(O.bh_adjust(raw, "pvalue", ["track"]), 9).select("track", "gene_id", "padj")


@query("t1_sort_nulls_last", """SELECT gene_id, ROUND(padj, 9) AS padj FROM de_a ORDER BY padj ASC NULLS LAST, gene_id""", "de_a")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(O.sort_nulls_last(B.de_a(spark, sf), "padj", "gene_id").select("gene_id", "padj"), 9)


@query("t3_top_k_overlap", """SELECT COUNT(*) AS n_shared FROM (
 SELECT gene_key FROM (SELECT gene_key FROM de_a ORDER BY base_mean DESC, gene_key LIMIT 100) INTERSECT
 SELECT gene_key FROM (SELECT gene_key FROM de_b ORDER BY lfc DESC, gene_key LIMIT 100))""", "de_a", "de_b")
def _(spark: SparkSession, sf: str) -> DataFrame:
    a = B.de_a(spark, sf).select("gene_key", F.col("base_mean").alias("v"))
    b = B.de_b(spark, sf).select("gene_key", F.col("lfc").alias("v"))
    return C.top_k_overlap(a, b, "gene_key", "v", 100)


@query("t4_sorted_export", "SELECT gene_key, ours_gene_id, in_both_significant FROM compared ORDER BY gene_key", "compared")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return C.compare_full(B.published(spark, sf), B.ours_side(spark, sf)).select("gene_key", "ours_gene_id", "in_both_significant").orderBy("gene_key")


@query("u1_set_algebra", """SELECT doc_id, 'intersect' AS part FROM (SELECT doc_id FROM good_ids INTERSECT SELECT doc_id FROM toxic_ids)
 UNION ALL SELECT doc_id, 'a_only' FROM (SELECT doc_id FROM good_ids EXCEPT SELECT doc_id FROM toxic_ids)
 UNION ALL SELECT doc_id, 'b_only' FROM (SELECT doc_id FROM toxic_ids EXCEPT SELECT doc_id FROM good_ids)
 UNION ALL SELECT doc_id, 'union' FROM (SELECT doc_id FROM good_ids UNION SELECT doc_id FROM toxic_ids)""", "good_ids", "toxic_ids")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return C.set_algebra(B.id_set(spark, sf, "quality"), B.id_set(spark, sf, "toxic"), "doc_id")


@query("u3_partition_check", """SELECT COALESCE(w.doc_id, p.doc_id) AS doc_id, COALESCE(n, 0) AS n_parts,
 CASE WHEN w.doc_id IS NULL THEN 'outside_whole' WHEN n IS NULL THEN 'not_covered' ELSE 'in_several_parts' END AS problem
 FROM documents w FULL JOIN (SELECT doc_id, COUNT(*) AS n FROM (SELECT doc_id FROM good_ids UNION ALL SELECT doc_id FROM toxic_ids) GROUP BY 1) p
 ON w.doc_id = p.doc_id WHERE w.doc_id IS NULL OR n IS NULL OR n > 1""", "good_ids", "toxic_ids")
def _(spark: SparkSession, sf: str) -> DataFrame:
    parts = B.id_set(spark, sf, "quality").unionByName(B.id_set(spark, sf, "toxic"))
    return C.partition_violations(parts, B.table(spark, sf, "documents"), "doc_id")


@query("u4_stack_tables", "SELECT track, gene_id, significant FROM tracks", "tracks")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return tracks(spark, sf).select("track", "gene_id", "significant")


@query("u5_venn_table", """SELECT good, toxic, COUNT(*) AS n, ROUND(100.0 * COUNT(*) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 6) AS pct FROM (
 SELECT doc_id IN (SELECT doc_id FROM good_ids) AS good, doc_id IN (SELECT doc_id FROM toxic_ids) AS toxic FROM documents) GROUP BY 1, 2""", "good_ids", "toxic_ids")
def _(spark: SparkSession, sf: str) -> DataFrame:
    sets = [("good", B.id_set(spark, sf, "quality")), ("toxic", B.id_set(spark, sf, "toxic"))]
    return rounded(C.venn_table(sets, B.table(spark, sf, "documents"), "doc_id"))
