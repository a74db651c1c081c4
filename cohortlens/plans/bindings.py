"""Logical tables of the analytics, derived from the driver tables in Spark and in SQL.

Each binding covers its whole source table.  Sample and gene ids are functions
of the source keys: 24 samples, and genes of five features each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import quant as Q
from cohortlens.plans.registry import cte, text_id

N_SAMPLES = 24
SAMPLES = [f"S{i:02d}" for i in range(N_SAMPLES)]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")
    if name == "events" and df.schema["ts"].dataType.typeName() == "timestamp_ntz":
        # Event times are UTC wall-clock times; make them instants whatever the session zone.
        df = df.withColumn("ts", F.convert_timezone(F.lit("UTC"), F.current_timezone(), "ts").cast("timestamp"))
    return df


# --- quantification -----------------------------------------------------------

def sample_of(suppkey: str) -> F.Column:
    return text_id("S", F.col(suppkey) % N_SAMPLES, 2)


def quant(spark: SparkSession, sf: str) -> DataFrame:
    reads = table(spark, sf, "lineitem").groupBy(
        (F.col("l_suppkey") % N_SAMPLES).alias("_s"), F.col("l_partkey").alias("feature_id")
    ).agg(F.sum("l_quantity").alias("num_reads"))
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("feature_id"), (F.col("p_size") + 20).cast("double").alias("eff_len")
    )
    lengths = reads.join(part, "feature_id").withColumn("_x", F.col("num_reads") / F.col("eff_len"))
    totals = lengths.groupBy("_s").agg(F.sum("_x").alias("_sx"))
    # One row per sample, so at most N_SAMPLES rows: a broadcast saves shuffling all features by sample.
    return lengths.join(F.broadcast(totals), "_s").select(
        text_id("S", F.col("_s"), 2).alias("sample_id"), "feature_id", "eff_len",
        (F.lit(1e6) * F.col("_x") / F.col("_sx")).alias("tpm"), "num_reads",
    )


cte("quant_raw", f"""SELECT 'S' || lpad(CAST(l_suppkey % {N_SAMPLES} AS VARCHAR), CAST(greatest(2, length(CAST(l_suppkey % {N_SAMPLES} AS VARCHAR))) AS INTEGER), '0') AS sample_id,
 l_partkey AS feature_id, SUM(l_quantity) AS num_reads FROM lineitem GROUP BY 1, 2""")
cte("quant_len", """SELECT q.*, CAST(p_size + 20 AS DOUBLE) AS eff_len, num_reads / CAST(p_size + 20 AS DOUBLE) AS x
 FROM quant_raw q JOIN part ON p_partkey = feature_id""", "quant_raw")
cte("quant_tot", "SELECT sample_id, SUM(x) AS sx FROM quant_len GROUP BY 1", "quant_len")
cte("quant", """SELECT l.sample_id, feature_id, eff_len, CAST(1e6 AS DOUBLE) * x / sx AS tpm, num_reads
 FROM quant_len l JOIN quant_tot t ON l.sample_id = t.sample_id""", "quant_len", "quant_tot")


def gene_of(partkey: str) -> F.Column:
    gene = F.floor(F.col(partkey) / 5).cast("long")
    return F.concat(text_id("G", gene, 8), F.lit("."), (gene % 3 + 1).cast("string"))


GENE_SQL = "'G' || lpad(CAST({0} // 5 AS VARCHAR), CAST(greatest(8, length(CAST({0} // 5 AS VARCHAR))) AS INTEGER), '0') || '.' || CAST(({0} // 5) % 3 + 1 AS VARCHAR)"


def feature_map(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("feature_id"), gene_of("p_partkey").alias("gene_id"), F.col("p_type").alias("feature_type")
    )


cte("feature_map", f"SELECT p_partkey AS feature_id, {GENE_SQL.format('p_partkey')} AS gene_id, p_type AS feature_type FROM part")


def gene_types(spark: SparkSession, sf: str) -> DataFrame:
    return feature_map(spark, sf).groupBy("gene_id").agg(F.min("feature_type").alias("gene_type"))


cte("gene_types", "SELECT gene_id, MIN(feature_type) AS gene_type FROM feature_map GROUP BY 1", "feature_map")


def genes_raw(spark: SparkSession, sf: str) -> DataFrame:
    return Q.group_rollup(Q.map_features(quant(spark, sf), feature_map(spark, sf)))


cte("mapped", "SELECT q.*, gene_id FROM quant q JOIN feature_map f ON q.feature_id = f.feature_id", "quant", "feature_map")
cte("genes_raw", """SELECT gene_id, sample_id, SUM(num_reads) AS "count", SUM(tpm) AS tpm,
 SUM(tpm * eff_len) / NULLIF(SUM(tpm), 0) AS length FROM mapped GROUP BY 1, 2""", "mapped")


def genes(spark: SparkSession, sf: str) -> DataFrame:
    """Dense gene x sample table with filled lengths."""
    mapped = Q.map_features(quant(spark, sf), feature_map(spark, sf))
    dense = Q.densify(Q.group_rollup(mapped), SAMPLES)
    return Q.fill_group_length(dense, Q.mean_feature_length(mapped))


cte("samples", f"SELECT 'S' || lpad(CAST(i AS VARCHAR), CAST(greatest(2, length(CAST(i AS VARCHAR))) AS INTEGER), '0') AS sample_id, CAST(i AS BIGINT) AS sample_no FROM range({N_SAMPLES}) t(i)")
cte("dense", """SELECT g.gene_id, s.sample_id, COALESCE(r."count", 0) AS "count", COALESCE(r.tpm, 0) AS tpm, r.length
 FROM (SELECT DISTINCT gene_id FROM genes_raw) g CROSS JOIN samples s
 LEFT JOIN genes_raw r ON r.gene_id = g.gene_id AND r.sample_id = s.sample_id""", "genes_raw", "samples")
cte("mean_length", """SELECT gene_id, AVG(m) AS mean_length FROM
 (SELECT gene_id, feature_id, AVG(eff_len) AS m FROM mapped GROUP BY 1, 2) GROUP BY 1""", "mapped")
cte("geo_length", "SELECT gene_id, exp(avg(ln(length))) AS geo FROM dense GROUP BY 1", "dense")
cte("genes", """SELECT d.gene_id, d.sample_id, d."count", d.tpm, COALESCE(d.length, geo, mean_length) AS length
 FROM dense d JOIN geo_length g ON d.gene_id = g.gene_id JOIN mean_length m ON d.gene_id = m.gene_id""",
    "dense", "geo_length", "mean_length")


def cohort(spark: SparkSession, sf: str) -> DataFrame:
    """Samples with their factors: two groups, and patients with one sample of each condition."""
    ids = table(spark, sf, "lineitem").select((F.col("l_suppkey") % N_SAMPLES).alias("sample_no")).distinct()
    return ids.select(
        text_id("S", F.col("sample_no"), 2).alias("sample_id"), "sample_no",
        text_id("P", F.floor(F.col("sample_no") / 2), 2).alias("patient"),
        F.when(F.col("sample_no") % 2 == 0, "tumor").otherwise("normal").alias("condition"),
        F.when(F.col("sample_no") < 11, "tumor").otherwise("control").alias("grp"),
    )


cte("cohort", """SELECT sample_id, sample_no, 'P' || lpad(CAST(sample_no // 2 AS VARCHAR), CAST(greatest(2, length(CAST(sample_no // 2 AS VARCHAR))) AS INTEGER), '0') AS patient,
 CASE WHEN sample_no % 2 = 0 THEN 'tumor' ELSE 'normal' END AS condition,
 CASE WHEN sample_no < 11 THEN 'tumor' ELSE 'control' END AS grp
 FROM samples WHERE sample_no IN (SELECT l_suppkey % 24 FROM lineitem)""", "samples")


# --- differential results and the published list ---------------------------------

def de_base(spark: SparkSession, sf: str) -> DataFrame:
    qty = F.col("l_quantity")
    part_sum = lambda cond: F.sum(F.when(cond, qty).otherwise(0.0))
    even = F.year("l_shipdate") % 2 == 0
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.sum(qty).alias("total"), F.max(qty).alias("top"),
        part_sum(F.col("l_returnflag") == "R").alias("r"), part_sum(F.col("l_returnflag") == "A").alias("a"),
        part_sum(even).alias("ev"), part_sum(~even).alias("od"),
    )


cte("de_base", """SELECT l_partkey, SUM(l_quantity) AS total, MAX(l_quantity) AS top,
 SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS r,
 SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS a,
 SUM(CASE WHEN year(l_shipdate) % 2 = 0 THEN l_quantity ELSE 0 END) AS ev,
 SUM(CASE WHEN year(l_shipdate) % 2 = 1 THEN l_quantity ELSE 0 END) AS od
 FROM lineitem GROUP BY 1""")

_LFC_A, _LFC_B = "log2((r + 1) / (a + 1))", "log2((ev + 1) / (od + 1))"


def _versioned(partkey: str, mod: int) -> F.Column:
    return F.concat(text_id("ENSG", F.col(partkey), 11), F.lit("."), (F.col(partkey) % mod + 1).cast("string"))


def _contrast(base: DataFrame, lfc: str, universe: str) -> DataFrame:
    raw = base.where(F.expr(universe)).select(
        _versioned("l_partkey", 7).alias("gene_id"), text_id("ENSG", F.col("l_partkey"), 11).alias("gene_key"),
        (F.col("total") / F.lit(float(N_SAMPLES))).alias("base_mean"), F.expr(lfc).alias("lfc"), F.lit(0.25).alias("lfc_se"),
        F.expr(f"CASE WHEN top / total > 0.1 THEN NULL ELSE exp(-4 * abs({lfc})) END").alias("pvalue"),
        F.col("total"),
    )
    padj = F.when(F.col("total") >= 600, F.least(F.lit(1.0), 2 * F.col("pvalue")))
    padj = F.when(F.col("pvalue").isNotNull(), padj)
    return raw.withColumns({"stat": F.col("lfc") / F.col("lfc_se"), "padj": padj}).withColumns({
        "tested": F.col("pvalue").isNotNull(), "significant": F.coalesce(F.col("padj") < 0.05, F.lit(False)),
    }).drop("total")


def _contrast_sql(lfc: str, universe: str) -> str:
    return f"""SELECT *, pvalue IS NOT NULL AS tested, COALESCE(padj < 0.05, FALSE) AS significant FROM (
 SELECT gene_id, gene_key, base_mean, lfc, CAST(0.25 AS DOUBLE) AS lfc_se, lfc / CAST(0.25 AS DOUBLE) AS stat, pvalue,
 CASE WHEN pvalue IS NOT NULL AND total >= 600 THEN least(1.0, 2 * pvalue) END AS padj FROM (
 SELECT 'ENSG' || lpad(CAST(l_partkey AS VARCHAR), CAST(greatest(11, length(CAST(l_partkey AS VARCHAR))) AS INTEGER), '0') || '.' || CAST(l_partkey % 7 + 1 AS VARCHAR) AS gene_id,
 'ENSG' || lpad(CAST(l_partkey AS VARCHAR), CAST(greatest(11, length(CAST(l_partkey AS VARCHAR))) AS INTEGER), '0') AS gene_key, total / {N_SAMPLES} AS base_mean, {lfc} AS lfc,
 CASE WHEN top / total > 0.1 THEN NULL ELSE exp(-4 * abs({lfc})) END AS pvalue, total
 FROM de_base WHERE {universe}))"""


#: Genes with a positive total in the samples of the track.
UNIVERSE_A, UNIVERSE_B = "r + a > 0", "ev + od > 0"


def de_a(spark: SparkSession, sf: str) -> DataFrame:
    return _contrast(de_base(spark, sf), _LFC_A, UNIVERSE_A)


def de_b(spark: SparkSession, sf: str) -> DataFrame:
    return _contrast(de_base(spark, sf), _LFC_B, UNIVERSE_B)


cte("de_a", _contrast_sql(_LFC_A, UNIVERSE_A), "de_base")
cte("de_b", _contrast_sql(_LFC_B, UNIVERSE_B), "de_base")

_LFC_P = f"0.5D * {_LFC_A} + 0.5D * {_LFC_B}"
_LFC_P_SQL = f"CAST(0.5 AS DOUBLE) * {_LFC_A} + CAST(0.5 AS DOUBLE) * {_LFC_B}"


def published_all(spark: SparkSession, sf: str) -> DataFrame:
    """All parts as rows of a comparator, significant or not."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type")
    rows = de_base(spark, sf).join(part, "l_partkey").withColumn("logFC", F.expr(_LFC_P)).withColumn(
        "PValue", F.exp(-6 * F.abs("logFC"))
    ).withColumn("FDR", F.least(F.lit(1.0), 2 * F.col("PValue")))
    return rows.select(
        F.col("p_name").alias("gene_name"), _versioned("l_partkey", 3).alias("ensemble_id"),
        "logFC", "PValue", "FDR", F.col("p_type").alias("type"),
    )


def published_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Comparator in its file layout: significant parts only, ids with another version suffix."""
    return published_all(spark, sf).where(F.col("FDR") < 0.05)


def published(spark: SparkSession, sf: str) -> DataFrame:
    raw = published_raw(spark, sf)
    return raw.select(
        F.substring_index("ensemble_id", ".", 1).alias("gene_key"), "gene_name", F.col("logFC").alias("published_lfc"),
        F.col("PValue").alias("published_p"), F.col("FDR").alias("published_fdr"), F.col("type").alias("gene_type"),
    )


cte("published_all", f"""SELECT *, least(1.0, 2 * published_p) AS published_fdr FROM (
 SELECT *, exp(-6 * abs(published_lfc)) AS published_p FROM (
 SELECT 'ENSG' || lpad(CAST(l_partkey AS VARCHAR), CAST(greatest(11, length(CAST(l_partkey AS VARCHAR))) AS INTEGER), '0') AS gene_key, p_name AS gene_name, {_LFC_P_SQL} AS published_lfc,
 p_type AS gene_type FROM de_base JOIN part ON p_partkey = l_partkey))""", "de_base")
cte("published", """SELECT gene_key, gene_name, published_lfc, published_p, published_fdr, gene_type FROM published_all
 WHERE published_fdr < 0.05""", "published_all")


def ours_side(spark: SparkSession, sf: str) -> DataFrame:
    return de_a(spark, sf).select(
        "gene_key", F.col("gene_id").alias("ours_gene_id"), "base_mean", "lfc", "pvalue", "padj"
    )


# --- manifest -----------------------------------------------------------------------

def records(spark: SparkSession, sf: str) -> DataFrame:
    """Sample records from customers: two per patient."""
    c = table(spark, sf, "customer")
    diagnosis = F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING", "FURNITURE"), "cancer").when(
        F.col("c_mktsegment") == "HOUSEHOLD", "hyperplasia").otherwise("other")
    even = F.col("c_custkey") % 2 == 0
    return c.select(
        text_id("GSM", F.col("c_custkey") + 2_000_000, 7).alias("gsm"), F.col("c_name").alias("title"),
        F.concat(F.lit("P"), F.floor(F.col("c_custkey") / 2).cast("string")).alias("patient_id"),
        diagnosis.alias("diagnosis"),
        F.when(~even, "normal").when(diagnosis == "hyperplasia", "adenoma").otherwise("tumour").alias("tissue"),
        F.col("c_custkey").alias("experiment"), "c_nationkey", "c_acctbal",
    )


cte("records", """SELECT 'GSM' || CAST(c_custkey + 2000000 AS VARCHAR) AS gsm, c_name AS title,
 'P' || CAST(c_custkey // 2 AS VARCHAR) AS patient_id, diagnosis,
 CASE WHEN c_custkey % 2 <> 0 THEN 'normal' WHEN diagnosis = 'hyperplasia' THEN 'adenoma' ELSE 'tumour' END AS tissue,
 c_custkey AS experiment, c_nationkey, c_acctbal
 FROM (SELECT *, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') THEN 'cancer'
 WHEN c_mktsegment = 'HOUSEHOLD' THEN 'hyperplasia' ELSE 'other' END AS diagnosis FROM customer)""")

CLASS_RULES = (
    ("cancer", "tumour", "pca_tumor"),
    ("cancer", "normal", "pca_adjacent_normal"),
    ("hyperplasia", "adenoma", "bph_adenoma"),
    ("hyperplasia", "normal", "bph_normal"),
)
PAIRS = (("pca_tumor", "pca_adjacent_normal"), ("bph_adenoma", "bph_normal"))


def class_rules() -> list[tuple[F.Column, str]]:
    return [((F.col("diagnosis") == d) & (F.col("tissue") == t), name) for d, t, name in CLASS_RULES]


cte("classified", "SELECT *, CASE " + " ".join(
    f"WHEN diagnosis = '{d}' AND tissue = '{t}' THEN '{name}'" for d, t, name in CLASS_RULES
) + " ELSE 'unclassified' END AS analysis_group FROM records", "records")


def members(spark: SparkSession, sf: str) -> DataFrame:
    """Final-set membership: accounts with a balance, by size."""
    return table(spark, sf, "customer").where("c_acctbal >= 1000").select(
        F.col("c_name").alias("title"), F.when(F.col("c_acctbal") >= 5000, "tumor").otherwise("control").alias("paper_group")
    )


cte("members", """SELECT c_name AS title, CASE WHEN c_acctbal >= 5000 THEN 'tumor' ELSE 'control' END AS paper_group
 FROM customer WHERE c_acctbal >= 1000""")


def exclusion_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").where("n_regionkey < 3").select(
        F.col("n_nationkey").alias("c_nationkey"), F.concat(F.lit("site excluded: "), "n_name").alias("paper_exclusion_reason")
    )


cte("reasons", "SELECT n_nationkey AS c_nationkey, 'site excluded: ' || n_name AS paper_exclusion_reason FROM nation WHERE n_regionkey < 3")


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Run table from orders: several runs per experiment, in order of their key."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("experiment"), F.col("o_orderkey").alias("position"),
        F.concat(F.lit("SRR"), F.col("o_orderkey").cast("string")).alias("run"),
        F.when(F.col("o_orderpriority") == "5-LOW", "PAIRED").otherwise("SINGLE").alias("library_layout"),
        F.floor("o_totalprice").cast("string").alias("size_mb"),
    )


cte("runs", """SELECT o_custkey AS experiment, o_orderkey AS position, 'SRR' || CAST(o_orderkey AS VARCHAR) AS run,
 CASE WHEN o_orderpriority = '5-LOW' THEN 'PAIRED' ELSE 'SINGLE' END AS library_layout,
 CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS size_mb FROM orders""")


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The complete manifest: records, class, membership, reason, run, pairing."""
    from cohortlens.operators import manifest as M

    df = M.classify(records(spark, sf), class_rules(), "analysis_group")
    df = M.membership_group(df, members(spark, sf), "title", "paper_group", "paper_final_set")
    df = M.lookup_default(df, exclusion_reasons(spark, sf), "c_nationkey", "paper_exclusion_reason")
    df = M.attach_runs(df, runs(spark, sf), "experiment", "position", ["run", "library_layout", "size_mb"])
    return M.pair_status(df, "patient_id", "analysis_group", PAIRS, 0, "paper_final_set")


cte("last_runs", """SELECT experiment, run, library_layout, size_mb FROM
 (SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY position DESC) AS rn FROM runs) WHERE rn = 1""", "runs")
cte("member_rows", """SELECT c.*, COALESCE(m.paper_group, 'excluded') AS paper_group,
 CASE WHEN m.paper_group IS NULL THEN 'no' ELSE 'yes' END AS paper_final_set
 FROM classified c LEFT JOIN members m ON c.title = m.title""", "classified", "members")
cte("manifest", """SELECT m.*, COALESCE(r.paper_exclusion_reason, '') AS paper_exclusion_reason,
 COALESCE(l.run, '') AS run, COALESCE(l.library_layout, '') AS library_layout, COALESCE(l.size_mb, '') AS size_mb,
 l.run IS NOT NULL AS run_found,
 CASE WHEN analysis_group IN ('pca_tumor', 'pca_adjacent_normal') THEN CASE WHEN pca THEN 'paired' ELSE 'unpaired' END
 WHEN analysis_group IN ('bph_adenoma', 'bph_normal') THEN CASE WHEN bph THEN 'paired' ELSE 'unpaired' END
 ELSE 'unclassified' END AS pair_status,
 CASE WHEN analysis_group IN ('pca_tumor', 'pca_adjacent_normal') AND pca AND paper_final_set = 'yes' THEN 'yes' ELSE 'no' END AS pair_sensitivity
 FROM (SELECT *,
 bool_or(analysis_group = 'pca_tumor') OVER w AND bool_or(analysis_group = 'pca_adjacent_normal') OVER w AS pca,
 bool_or(analysis_group = 'bph_adenoma') OVER w AND bool_or(analysis_group = 'bph_normal') OVER w AS bph
 FROM member_rows WINDOW w AS (PARTITION BY patient_id)) m
 LEFT JOIN reasons r ON m.c_nationkey = r.c_nationkey LEFT JOIN last_runs l ON m.experiment = l.experiment""",
    "member_rows", "reasons", "last_runs")


# --- run metadata ---------------------------------------------------------------------

def run_meta(spark: SparkSession, sf: str) -> DataFrame:
    """Run metadata per sample: read totals with mapped and decoy parts."""
    q = F.col("l_quantity")
    part_sum = lambda cond: F.sum(F.when(cond, q).otherwise(0.0)).cast("long")
    sums = table(spark, sf, "lineitem").groupBy((F.col("l_suppkey") % N_SAMPLES).alias("_s")).agg(
        F.sum(q).cast("long").alias("num_processed"), part_sum(F.col("l_linestatus") == "F").alias("num_mapped"),
        part_sum((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")).alias("num_decoy_fragments"),
        F.count_distinct("l_partkey").alias("num_valid_targets"),
    )
    return sums.select(
        text_id("S", F.col("_s"), 2).alias("sample_id"), "num_processed", "num_mapped", "num_decoy_fragments",
        "num_valid_targets", F.when(F.col("_s") % 7 == 0, "idx-other").otherwise("idx-main").alias("index_seq_hash"),
        F.when(F.col("_s") % 5 == 0, F.array(F.lit("A"))).otherwise(F.array(F.lit("SF"))).alias("library_types"),
        F.array().cast("array<string>").alias("quant_errors"), (F.col("_s") % 6 != 1).alias("em_converged"),
    )


cte("run_meta", f"""SELECT 'S' || lpad(CAST(s AS VARCHAR), CAST(greatest(2, length(CAST(s AS VARCHAR))) AS INTEGER), '0') AS sample_id, num_processed, num_mapped, num_decoy_fragments,
 num_valid_targets, CASE WHEN s % 7 = 0 THEN 'idx-other' ELSE 'idx-main' END AS index_seq_hash,
 CASE WHEN s % 5 = 0 THEN 'A' ELSE 'SF' END AS library_type, s % 6 <> 1 AS em_converged FROM (
 SELECT l_suppkey % {N_SAMPLES} AS s, CAST(SUM(l_quantity) AS BIGINT) AS num_processed,
 CAST(SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS BIGINT) AS num_mapped,
 CAST(SUM(CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS BIGINT) AS num_decoy_fragments,
 COUNT(DISTINCT l_partkey) AS num_valid_targets FROM lineitem GROUP BY 1)""")


# --- events, vectors, id sets ------------------------------------------------------------

STATUS_OF = {"purchase": "downloaded", "view": "reused", "click": "recovered", "signup": "migrated", "error": "failed"}


def journal(spark: SparkSession, sf: str) -> DataFrame:
    status = F.lit(None).cast("string")
    for event, name in STATUS_OF.items():
        status = F.when(F.col("event_type") == event, name).otherwise(status)
    return table(spark, sf, "events").select(
        F.concat(F.lit("SRR"), F.col("user_id").cast("string")).alias("accession"), status.alias("status"),
        F.get_json_object("props", "$.k").cast("long").alias("attempts"), F.floor("value").alias("duration_seconds"),
        "ts", "event_id",
    )


cte("journal", "SELECT 'SRR' || CAST(user_id AS VARCHAR) AS accession, CASE event_type " + " ".join(
    f"WHEN '{e}' THEN '{s}'" for e, s in STATUS_OF.items()
) + """ END AS status, CAST(json_extract_string(props, '$.k') AS BIGINT) AS attempts,
 CAST(floor(value) AS BIGINT) AS duration_seconds, ts, event_id FROM events""")


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Sample x feature values: dimensions are the samples, vectors the features."""
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("feature"), F.posexplode("embedding").alias("d", "v")).select(
        "feature", text_id("D", F.col("d"), 2).alias("sample"), F.col("v").cast("double").alias("value")
    )


cte("vectors", """SELECT feature, 'D' || lpad(CAST(d AS VARCHAR), CAST(greatest(2, length(CAST(d AS VARCHAR))) AS INTEGER), '0') AS sample, CAST(v AS DOUBLE) AS value FROM (
 SELECT vec_id AS feature, unnest(range(len(embedding))) AS d, unnest(embedding) AS v FROM embeddings)""")


def id_set(spark: SparkSession, sf: str, column: str) -> DataFrame:
    return table(spark, sf, "labels").where(F.col(column) == 1).select("doc_id")


cte("good_ids", "SELECT doc_id FROM labels WHERE quality = 1")
cte("toxic_ids", "SELECT doc_id FROM labels WHERE toxic = 1")
