"""Queries over the validation gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import gates as G
from cohortlens.operators import ordering as O
from cohortlens.plans import bindings as B
from cohortlens.plans.comparison import edges
from cohortlens.plans.registry import query


def named(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """Ordered names from a table, numbered chunk by chunk."""
    keyed = df.select(F.col(key), F.floor(F.col(key) / 4096).alias("chunk"))
    return O.ordinal_rank(keyed, [], "chunk", [key], "ordinal").select("ordinal", F.concat(F.lit(prefix), F.col(key).cast("string")).alias("name"))


@query("g2_check_reference", """SELECT 'map_coverage' AS rule, 'BLOCKER' AS severity, 'T' || CAST(p_partkey AS VARCHAR) AS key, 'left_only' AS detail FROM part WHERE p_size = 7
 UNION ALL SELECT 'edge_unmapped', 'BLOCKER', f, f FROM (SELECT DISTINCT 'T' || CAST(k AS VARCHAR) AS f FROM (
 SELECT retained AS k FROM edges UNION ALL SELECT duplicate FROM edges) WHERE k IN (SELECT p_partkey FROM part WHERE p_size = 7))
 UNION ALL SELECT 'combined_order', 'BLOCKER', CAST(o AS VARCHAR), 'D' || CAST(s AS VARCHAR) || 'x<>D' || CAST(s AS VARCHAR) FROM (
 SELECT s_suppkey AS s, row_number() OVER (ORDER BY s_suppkey) + (SELECT COUNT(*) FROM part) AS o, s_nationkey FROM supplier) WHERE s_nationkey = 3""", "edges")
def _(spark: SparkSession, sf: str) -> DataFrame:
    part, supplier = B.table(spark, sf, "part"), B.table(spark, sf, "supplier")
    transcripts, decoys = named(part, "p_partkey", "T"), named(supplier, "s_suppkey", "D")
    total = part.agg(F.count(F.lit(1))).scalar()
    bad = supplier.where("s_nationkey = 3").select(F.concat(F.lit("D"), F.col("s_suppkey").cast("string")).alias("name"), F.lit("x").alias("_x"))
    renamed = decoys.join(bad, "name", "left").select(
        (F.col("ordinal") + total).alias("ordinal"), F.concat("name", F.coalesce("_x", F.lit(""))).alias("name"))
    mapping = part.where("p_size <> 7").select(F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("feature_id"), B.gene_of("p_partkey").alias("gene_id"))
    pairs = edges(spark, sf).select(*[F.concat(F.lit("T"), F.col(c).cast("string")).alias(c) for c in ("retained", "duplicate")])
    return G.check_reference(transcripts, decoys, transcripts.unionByName(renamed), mapping, pairs, r"G\d+\.\d+")


@query("g4_gate_status", """SELECT stage, CASE COALESCE(r, 0) WHEN 0 THEN 'NONE' WHEN 1 THEN 'INFO' WHEN 2 THEN 'REVIEW_REQUIRED' ELSE 'BLOCKER' END AS worst,
 COALESCE(n, 0) AS n_violations, COALESCE(ok, FALSE) AS accepted, COALESCE(ok, FALSE) AND COALESCE(r, 0) <> 3 AS may_proceed FROM (
 SELECT c_custkey AS stage FROM customer) s LEFT JOIN (SELECT o_custkey, COUNT(*) AS n,
 MAX(CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 ELSE 1 END) AS r FROM orders GROUP BY 1) v ON v.o_custkey = stage
 LEFT JOIN (SELECT c_custkey, c_acctbal > 0 AS ok FROM customer) a ON a.c_custkey = stage""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    customer = B.table(spark, sf, "customer")
    severity = F.when(F.col("o_orderpriority") == "1-URGENT", "BLOCKER").when(F.col("o_orderpriority") == "2-HIGH", "REVIEW_REQUIRED").otherwise("INFO")
    violations = B.table(spark, sf, "orders").select(F.col("o_custkey").alias("stage"), severity.alias("severity"))
    acceptance = customer.select(F.col("c_custkey").alias("stage"), (F.col("c_acctbal") > 0).alias("accepted"))
    return G.gate_status(violations, acceptance, customer.select(F.col("c_custkey").alias("stage")))


@query("g5_check_result_table", """SELECT 'gene_lost' AS rule, 'BLOCKER' AS severity, gene_id AS key, gene_id AS detail FROM (
 SELECT 'ENSG' || lpad(CAST(l_partkey AS VARCHAR), CAST(greatest(11, length(CAST(l_partkey AS VARCHAR))) AS INTEGER), '0') || '.' || CAST(l_partkey % 7 + 1 AS VARCHAR) AS gene_id FROM de_base)
 WHERE gene_id NOT IN (SELECT gene_id FROM de_a)""", "de_base", "de_a")
def _(spark: SparkSession, sf: str) -> DataFrame:
    tested = B.de_base(spark, sf).select(B._versioned("l_partkey", 7).alias("gene_id"))
    return G.check_result_table(B.de_a(spark, sf), tested)


@query("g6_uniform_per_analysis", """SELECT * FROM (SELECT o_custkey, 'o_orderstatus' AS setting, COUNT(DISTINCT o_orderstatus) AS n_values FROM orders GROUP BY 1
 UNION ALL SELECT o_custkey, 'o_orderpriority', COUNT(DISTINCT o_orderpriority) FROM orders GROUP BY 1) WHERE n_values > 1""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return G.uniform_per_analysis(B.table(spark, sf, "orders"), "o_custkey", ["o_orderstatus", "o_orderpriority"])


@query("g7_compare_records", """SELECT p_partkey, unnest(['p_type', 'p_brand', 'p_size']) AS field, unnest(['equal', 'different', 'constant']) AS rule,
 unnest([a_type IS NOT DISTINCT FROM b_type, a_brand IS DISTINCT FROM b_brand, COALESCE(a_size = '7', FALSE) AND COALESCE(b_size = '9', FALSE)]) AS ok FROM (
 SELECT COALESCE(a.p_partkey, b.k) AS p_partkey, a.p_type AS a_type, b.p_type AS b_type, a.p_brand AS a_brand, b.p_brand AS b_brand,
 CAST(a.p_size AS VARCHAR) AS a_size, CAST(b.p_size AS VARCHAR) AS b_size FROM part a FULL JOIN (SELECT p_partkey + 1 AS k, * FROM part) b ON a.p_partkey = b.k)""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    a = B.table(spark, sf, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    b = a.withColumn("p_partkey", F.col("p_partkey") + 1)
    return G.compare_records(a, b, "p_partkey", {"p_type": "equal", "p_brand": "different"}, {"p_size": ("7", "9")})
