"""Queries over the column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens import functions as X
from cohortlens.plans import bindings as B
from cohortlens.plans.registry import query


@query("f1_strip_version", """SELECT p_partkey, trim(split_part(raw, '.', 1)) AS split_first, split_part(trim(raw), '.', 1) AS trim_first FROM (
 SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN ' ENSG' || CAST(p_partkey AS VARCHAR) || '.2 ' WHEN 1 THEN 'ENSG' || CAST(p_partkey AS VARCHAR) || ' .1'
 WHEN 2 THEN '' ELSE 'ENSG' || CAST(p_partkey AS VARCHAR) END AS raw FROM part)""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    key = F.concat(F.lit("ENSG"), F.col("p_partkey").cast("string"))
    kind = F.col("p_size") % 4
    raw = F.when(kind == 0, F.concat(F.lit(" "), key, F.lit(".2 "))).when(kind == 1, F.concat(key, F.lit(" .1"))).when(
        kind == 2, F.lit("")).otherwise(key)
    return B.table(spark, sf, "part").select(
        "p_partkey", X.strip_version(raw).alias("split_first"), X.strip_version(raw, trim_first=True).alias("trim_first"))


@query("f2_finite_or_null", """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL
 ELSE o_totalprice END AS v FROM orders""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("o_orderkey") % 6
    price = F.col("o_totalprice").cast("string")
    raw = F.when(kind == 0, "nan").when(kind == 1, "inf").when(kind == 2, "NA").when(kind == 3, "").when(
        kind == 4, F.concat(F.lit(" "), price, F.lit(" "))).otherwise(F.concat(price, F.lit("e0")))
    fixed = F.when(price.contains("E"), price).otherwise(raw)
    return B.table(spark, sf, "orders").select("o_orderkey", X.finite_or_null(F.when(kind < 4, raw).otherwise(fixed)).alias("v"))


@query("f3_after_first_last", """SELECT page_id, CASE WHEN instr(url, '=') > 0 THEN trim(substr(url, instr(url, '=') + 1)) ELSE '' END AS first_eq,
 trim(regexp_replace(url, '^.*=', '')) AS last_eq, trim(regexp_replace(url, '^.*/', '')) AS last_slash FROM pages""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return B.table(spark, sf, "pages").select(
        "page_id", X.after_first("url", "=").alias("first_eq"), X.after_last("url", "=").alias("last_eq"), X.after_last("url", "/").alias("last_slash"))


@query("f4_normalise", """SELECT doc_id, lower(trim(source)) || '|' || lang AS key, sha256(trim(replace(text, chr(160), ' '), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')) AS value
 FROM documents""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.concat(F.lit(" \t"), F.upper("source"), F.lit("  "))
    # The comparison works on digests, so whole texts are covered without shipping them.
    value = X.normalise_value(F.regexp_replace("text", " ", " "))
    return B.table(spark, sf, "documents").select(
        "doc_id", F.concat(X.normalise_key(padded), F.lit("|"), "lang").alias("key"), X.sha256(value).alias("value"))


@query("f5_regex_extract", r"""SELECT page_id, NULLIF(regexp_extract(html, '<title>([^<]*)', 1), '') AS title,
 COALESCE(substr(trim(list_last(regexp_extract_all(html, '<a href="[^"]*"'))), 1, 170), '') AS last_link FROM pages""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return B.table(spark, sf, "pages").select(
        "page_id", F.nullif(X.regex_first("html", "<title>([^<]*)"), F.lit("")).alias("title"),
        X.regex_last("html", '<a href="[^"]*"').alias("last_link"))


@query("f6_ratio", """SELECT l_orderkey, SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS r,
 ROUND(SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / NULLIF(SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END), 0), 6) AS ratio,
 ROUND(100.0 * SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / NULLIF(SUM(l_quantity), 0), 6) AS pct FROM lineitem GROUP BY 1""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    q = F.col("l_quantity")
    sums = B.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", q).otherwise(0.0)).alias("r"),
        F.sum(F.when(F.col("l_returnflag") == "A", q).otherwise(0.0)).alias("a"), F.sum(q).alias("t"))
    return sums.select("l_orderkey", "r", F.round(X.ratio("r", "a"), 6).alias("ratio"), F.round(X.pct("r", "t"), 6).alias("pct"))


@query("f7_math", """SELECT c_custkey, ROUND(sqrt(abs(c_acctbal)), 6) AS root, CAST(sign(c_acctbal) AS BIGINT) AS sgn, ROUND(log2(abs(c_acctbal) + 1), 6) AS l2,
 ROUND(ln(1 + abs(c_acctbal)), 6) AS l1p, ROUND(exp(c_acctbal / 10000), 6) AS ex,
 CASE WHEN c_acctbal = 0 THEN 0 ELSE ROUND(ROUND(c_acctbal * pow(10, 1 - floor(log10(abs(c_acctbal))))) / pow(10, 1 - floor(log10(abs(c_acctbal)))), 6) END AS sig2
 FROM customer""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    b = F.col("c_acctbal")
    r6 = lambda c: F.round(c, 6)
    return B.table(spark, sf, "customer").select(
        "c_custkey", r6(F.sqrt(F.abs(b))).alias("root"), F.signum(b).cast("long").alias("sgn"), r6(F.log2(F.abs(b) + 1)).alias("l2"),
        r6(F.log1p(F.abs(b))).alias("l1p"), r6(F.exp(b / 10000)).alias("ex"), r6(X.signif(b, 2)).alias("sig2"))


@query("f8_json_fields", """SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, COUNT(*) AS n,
 COUNT(*) FILTER (event_type = 'click') AS n_sf FROM events GROUP BY 1, 2""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    e = B.table(spark, sf, "events").withColumn("meta", F.from_json("props", "k long, modes array<string>"))
    modes = F.when(F.col("event_type") == "click", F.array(F.lit("SF")))
    return e.groupBy("event_type", F.col("meta.k").alias("k")).agg(
        F.count_if(X.list_empty("meta.modes")).alias("n"), F.count_if(X.list_equals(modes, ["SF"])).alias("n_sf"))


@query("f9_map_get", """SELECT event_id, COALESCE(json_extract_string(props, '$.k'), '') AS k, 'none' AS absent FROM events""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    m = F.from_json("props", "map<string,string>")
    return B.table(spark, sf, "events").select("event_id", X.map_get(m, "k").alias("k"), X.map_get(m, "missing", "none").alias("absent"))


@query("f10_analysis_id", """SELECT o_orderkey, sha256('{"cohort":"' || o_orderpriority || '","reference":' || CAST(o_custkey AS VARCHAR)
 || ',"design":"' || o_orderstatus || '"}') AS id FROM orders""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return B.table(spark, sf, "orders").select("o_orderkey", X.analysis_id(
        F.col("o_orderpriority").alias("cohort"), F.col("o_custkey").alias("reference"), F.col("o_orderstatus").alias("design")).alias("id"))


@query("f11_sha256", "SELECT doc_id, sha256(text) AS digest FROM documents")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return B.table(spark, sf, "documents").select("doc_id", X.sha256("text").alias("digest"))
