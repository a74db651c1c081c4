"""Queries over scans, sources and sinks.

Files are written to the shared folder from the given tables and then read back
with the source under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.plans import bindings as B
from cohortlens.plans.registry import query, rounded, text_id
from cohortlens.session import scratch_path
from cohortlens.sources import reports as R
from cohortlens.sources import sinks, tables
from cohortlens.sources import text as X


@query("s1_read_delimited", """SELECT l_returnflag, l_linestatus, COUNT(*) AS n, CAST(SUM(l_quantity) AS BIGINT) AS qty,
 SUM(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END) AS n_missing_tax FROM lineitem GROUP BY 1, 2""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "delimited")
    src = B.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linestatus", "l_quantity", F.nullif("l_tax", F.lit(0.0)).alias("l_tax")
    )
    src.write.options(header=True, sep="\t", nullValue="NA", compression="gzip").csv(path)
    df = tables.read_delimited(spark, path, "l_returnflag string, l_linestatus string, l_quantity double, l_tax double")
    return df.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("qty"),
        F.count_if(F.col("l_tax").isNull()).alias("n_missing_tax"),
    )


def soft_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Record-block text of all customers, one file per site (nation)."""
    r = B.records(spark, sf).withColumn("file", F.concat(F.lit("site_"), F.col("c_nationkey").cast("string")))
    lines = F.array(
        F.concat(F.lit("^SAMPLE = "), "gsm"),
        F.concat(F.lit("!Sample_title = "), "title", F.lit("  ")),
        F.concat(F.lit("!Sample_characteristics_ch1 = Diagnosis : "), "diagnosis"),
        F.concat(F.lit("!Sample_characteristics_ch1 = Tissue:"), "tissue", F.lit(" part")),
        F.concat(F.lit("!Sample_characteristics_ch1 = tissue: "), "tissue", F.lit(" section")),
        F.concat(F.lit("!Sample_relation = BioSample: http://x/biosample/SAMN"), F.col("experiment").cast("string")),
        F.concat(F.lit("!Sample_relation = SRA: http://x/sra?term=SRX"), F.col("experiment").cast("string")),
        F.lit("!Sample_characteristics_ch1 = no separator"),
    )
    numbered = r.select("file", "experiment", F.posexplode(lines).alias("i", "line"))
    return numbered.select("file", (F.col("experiment") * 8 + F.col("i")).alias("seq"), "line").withColumn(
        "chunk", F.floor(F.col("seq") / 512)
    )


SOFT_FIELDS = (
    X.FieldRule("title", "!Sample_title = "),
    X.FieldRule("biosample", "!Sample_relation = BioSample: ", "last", "/"),
    X.FieldRule("srx", "!Sample_relation = SRA: ", "last", "="),
)


@query("s2_read_record_blocks", """SELECT gsm, title, 'SAMN' || CAST(experiment AS VARCHAR) AS biosample, 'SRX' || CAST(experiment AS VARCHAR) AS srx,
 diagnosis, tissue || ' section' AS tissue, CAST(2 AS BIGINT) AS n_keys FROM records""", "records")
def _(spark: SparkSession, sf: str) -> DataFrame:
    blocks = X.record_blocks(soft_lines(spark, sf), ["file"], X.FieldRule("gsm", "^SAMPLE = "), SOFT_FIELDS,
                             "!Sample_characteristics_ch1 = ")
    ch = F.col("characteristics")
    return blocks.select("gsm", "title", "biosample", "srx", F.try_element_at(ch, F.lit("diagnosis")).alias("diagnosis"),
                         F.try_element_at(ch, F.lit("tissue")).alias("tissue"), F.size(ch).cast("long").alias("n_keys"))


@query("s3_read_quant", """SELECT sample_id, COUNT(*) AS n_rows, CAST(SUM(num_reads) AS BIGINT) AS reads, ROUND(SUM(tpm), 3) AS tpm,
 ROUND(SUM(eff_len), 3) AS len FROM quant GROUP BY 1""", "quant")
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "quant")
    files = B.quant(spark, sf).select(
        "sample_id", F.col("feature_id").cast("string").alias("Name"), F.col("eff_len").alias("Length"),
        F.col("eff_len").alias("EffectiveLength"), F.col("tpm").alias("TPM"), F.col("num_reads").alias("NumReads"),
    )
    files.write.partitionBy("sample_id").options(header=True, sep="\t").csv(path)
    df = tables.read_quant(spark, path, r"sample_id=([^/]+)/[^/]+$")
    return df.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("num_reads").cast("long").alias("reads"),
        F.round(F.sum("tpm"), 3).alias("tpm"), F.round(F.sum("eff_len"), 3).alias("len"),
    )


@query("s4_read_run_json", """SELECT sample_id, num_processed, num_mapped, num_decoy_fragments, num_valid_targets, index_seq_hash,
 library_type, em_converged, CAST(num_processed AS DOUBLE) AS loose_number FROM run_meta""", "run_meta")
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "meta")
    meta = B.run_meta(spark, sf)
    body = F.to_json(F.struct(*[c for c in meta.columns if c != "sample_id"]))
    meta.select("sample_id", body.alias("value")).write.partitionBy("sample_id").text(path)
    docs = tables.read_run_json(spark, path, sample_pattern=r"sample_id=([^/]+)/[^/]+$")
    raw = spark.read.text(path).select("sample_id", tables.first_number_after_key("value", "num_processed").alias("loose_number"))
    return docs.join(raw, "sample_id").select(
        "sample_id", "num_processed", "num_mapped", "num_decoy_fragments", "num_valid_targets", "index_seq_hash",
        F.get("library_types", F.lit(0)).alias("library_type"), "em_converged", "loose_number",
    )


STATUS_MODULES = ("Per base sequence quality", "Adapter Content", "Sequence Duplication Levels")


def report_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Two report texts per document: module status and sectioned values."""
    d = B.table(spark, sf, "documents")
    n = F.col("n_chars")
    name = F.col("doc_id").cast("string")
    status = F.when(n < 1000, "FAIL").when(n < 2500, "WARN").otherwise("PASS")
    summary = F.concat_ws(
        "\n",
        F.concat(status, F.lit("\tPer base sequence quality\t"), name),
        F.when(F.col("lang") != "en", F.concat(F.lit("PASS\tAdapter Content\t"), name)),
        F.concat(F.when(F.col("lang") == "de", "FAIL").otherwise("PASS"), F.lit("\tSequence Duplication Levels\t"), name),
    )
    data = F.concat_ws(
        "\n", F.lit("##Report\t1"), F.lit(">>Basic Statistics\tpass"), F.lit("#Measure\tValue"),
        F.concat(F.lit("Total Sequences\t"), n.cast("string")),
        F.concat(F.lit("Sequence length\t"), F.col("source")),
        F.lit(">>END_MODULE"), F.lit("Total Sequences\t-1"), F.lit(">>Sequence Duplication Levels\twarn"),
        F.concat(F.lit("#Total Deduplicated Percentage\t"), (n % 100).cast("string"), F.lit(".5")),
        F.lit("Total Sequences\t-2"), F.lit(">>END_MODULE"),
    )
    return d.select("doc_id", "text", summary.alias("summary"), data.alias("data"))


def _zip_reports(batches):
    import io
    import zipfile

    for batch in batches:
        blobs = []
        for doc, summary, data in zip(batch["doc_id"], batch["summary"], batch["data"]):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr(f"{doc}_report/summary.txt", summary)
                z.writestr(f"{doc}_report/data.txt", data)
                z.writestr(f"{doc}_report/Images/plot.png", b"\x89PNG\r\n\x1a\n\xff\xfe")
            blobs.append(buffer.getvalue())
        yield batch[["doc_id"]].assign(path=batch["doc_id"].astype(str), content=blobs)[["path", "content"]]


def report_archives(spark: SparkSession, sf: str) -> DataFrame:
    """One zip per document, in the columns of the binary-file source."""
    return report_texts(spark, sf).select("doc_id", "summary", "data").mapInPandas(_zip_reports, "path string, content binary")


@query("s5_read_sectioned_report", """SELECT CAST(doc_id AS VARCHAR) AS path, CAST(n_chars AS VARCHAR) AS total_sequences, source AS sequence_length,
 CAST(n_chars % 100 AS VARCHAR) || '.5' AS dedup FROM documents""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    lines = R.archive_lines(report_archives(spark, sf))
    values = R.report_values(R.sectioned_report(lines, "data.txt"), "Basic Statistics", "Sequence Duplication Levels",
                             "Total Deduplicated Percentage")
    pick = lambda k, out: F.max(F.when(F.col("key") == k, F.col("value"))).alias(out)
    return values.groupBy("path").agg(
        pick("Total Sequences", "total_sequences"), pick("Sequence length", "sequence_length"),
        pick("Total Deduplicated Percentage", "dedup"),
    )


@query("s6_report_status", """SELECT CAST(doc_id AS VARCHAR) AS path,
 CASE WHEN n_chars < 1000 THEN 'FAIL' WHEN n_chars < 2500 THEN 'WARN' ELSE 'PASS' END AS per_base_sequence_quality,
 CASE WHEN lang <> 'en' THEN 'PASS' ELSE 'unknown' END AS adapter_content,
 CASE WHEN lang = 'de' THEN 'FAIL' ELSE 'PASS' END AS sequence_duplication_levels FROM documents""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    lines = X.lines_of_text(report_texts(spark, sf).withColumn("path", F.col("doc_id").cast("string")), "path", "summary")
    return R.report_status(lines, ["path"], STATUS_MODULES)


@query("w4_section_fill", """SELECT doc_id, section, COUNT(*) AS n_lines FROM (
 SELECT doc_id, CASE WHEN last_mark = '' THEN NULL ELSE last_mark END AS section FROM (
 SELECT doc_id, last_value(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS last_mark FROM (
 SELECT doc_id, i, CASE WHEN starts_with(line, 'E') THEN '' WHEN starts_with(line, 'T') THEN split_part(substr(line, 2), chr(9), 1) END AS mark
 FROM (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS i, unnest(string_split(text, chr(10))) AS line FROM documents))))
 GROUP BY 1, 2""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    lines = X.lines_of_text(B.table(spark, sf, "documents"), "doc_id", "text", lines_per_chunk=64)
    filled = X.section_fill(lines, ["doc_id"], opens="T", closes="E")
    return filled.groupBy("doc_id", "section").agg(F.count(F.lit(1)).alias("n_lines"))


@query("w5_block_id", """SELECT source, block, COUNT(*) AS n_turns FROM (
 SELECT source, SUM(CASE WHEN is_start THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS block FROM (
 SELECT source, doc_id, n_chars > 4000 AS is_start FROM documents)) GROUP BY 1, 2""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from cohortlens.operators.ordering import running_total

    docs = B.table(spark, sf, "documents").select("source", "doc_id", "n_chars", F.floor(F.col("doc_id") / 256).alias("chunk"))
    blocks = running_total(docs, ["source"], "chunk", ["doc_id"], (F.col("n_chars") > 4000).cast("long"), "block")
    return blocks.groupBy("source", "block").agg(F.count(F.lit(1)).alias("n_turns"))


@query("s7_read_annotation", """SELECT 'G' || CAST(p_partkey AS VARCHAR) AS gene_id, p_name AS gene_name, p_type AS gene_type
 FROM part WHERE p_size % 3 <> 0 AND p_size % 5 <> 0""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "annotation")
    p = B.table(spark, sf, "part")
    feature = F.when(F.col("p_size") % 3 == 0, "exon").otherwise("gene")
    name = F.when(F.col("p_size") % 5 == 0, F.lit("")).otherwise(F.concat(F.lit(' gene_name "'), "p_name", F.lit('";')))
    gtf = F.concat(F.lit("chr1\tsrc\t"), feature, F.lit('\t1\t9\t.\t+\t.\tgene_id "G'), F.col("p_partkey").cast("string"),
                   F.lit('"; gene_type "'), "p_type", F.lit('";'), name)
    rows = p.select(F.explode(F.array(gtf, F.lit("# comment"), F.lit("chr1\tsrc\tgene\tshort"))).alias("value"))
    rows.write.text(path)
    return X.annotation_rows(X.read_lines(spark, path), "gene", ["gene_id", "gene_name", "gene_type"])


@query("s8_read_sequence_names", "SELECT row_number() OVER (ORDER BY p_partkey) AS ordinal, 'T' || CAST(p_partkey AS VARCHAR) || '.1' AS name FROM part")
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "fasta")
    p = B.table(spark, sf, "part").orderBy("p_partkey")
    head = F.concat(F.lit(">T"), F.col("p_partkey").cast("string"), F.lit(".1 "), "p_name")
    p.select(F.concat(head, F.lit("\nACGT\nTTGA")).alias("value")).write.text(path)
    return X.sequence_names(X.read_lines(spark, path))


ID_LINES = """SELECT o_orderkey AS seq, CASE WHEN o_orderstatus = 'P' THEN '# SRR' || CAST(o_custkey AS VARCHAR)
 WHEN o_orderpriority = '5-LOW' THEN 'bad ' || CAST(o_custkey AS VARCHAR) ELSE 'SRR' || CAST(o_custkey AS VARCHAR) END AS id FROM orders"""


@query("s9_read_id_list", f"""SELECT id, MIN(seq) AS first_line, NOT starts_with(id, 'bad') AS valid FROM ({ID_LINES})
 WHERE NOT starts_with(id, '#') GROUP BY id""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_custkey").cast("string")
    line = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("# SRR"), key)).when(
        F.col("o_orderpriority") == "5-LOW", F.concat(F.lit(" bad "), key)
    ).otherwise(F.concat(F.lit("\tSRR"), key, F.lit(" \r")))
    lines = B.table(spark, sf, "orders").select(F.col("o_orderkey").alias("seq"), line.alias("line"))
    return X.id_list(lines, r"^(SRR|ERR|DRR)\d+$")


@query("s10_read_key_value", """SELECT user_id, event_type AS key, 'v=' || CAST(event_id AS VARCHAR) AS value FROM (
 SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn = 1""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    line = F.concat("event_type", F.lit("=v="), F.col("event_id").cast("string"))
    lines = B.table(spark, sf, "events").select("user_id", F.col("event_id").alias("seq"), line.alias("line"))
    return X.key_values(lines, ["user_id"])


@query("s11_read_published", """SELECT gene_key, gene_name, ROUND(published_lfc, 6) AS published_lfc, ROUND(published_p, 6) AS published_p,
 ROUND(published_fdr, 6) AS published_fdr, gene_type FROM published""", "published")
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "published")
    blank = B.table(spark, sf, "region").select(
        F.col("r_name").alias("gene_name"), F.lit("").alias("ensemble_id"), F.lit(1.0).alias("logFC"),
        F.lit(0.1).alias("PValue"), F.lit(0.1).alias("FDR"), F.lit("x").alias("type"))
    # Two kinds of files: as expected, and with the columns turned round and one more.
    B.published_raw(spark, sf).where("logFC > 0").unionByName(blank).write.option("header", True).csv(path)
    others = B.published_raw(spark, sf).where("not coalesce(logFC > 0, false)")
    others.select(*reversed(others.columns), F.lit("n").alias("note")).write.mode("append").option("header", True).csv(path)
    return rounded(tables.read_published(spark, path))


#: Least number of folders: Spark lists 32 and fewer on the driver, one after the other.
INVENTORY_SLICES = 64


@query("s12_file_inventory", """SELECT 's_suppkey=' || CAST(s_suppkey AS VARCHAR) AS dir, CAST(strlen(s_name) + 1 AS BIGINT) AS bytes,
 sha256(s_name || chr(10)) AS sha256 FROM supplier""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """One text file for every supplier, with known bytes.

    Each task writes one folder with the suppliers of its slice, which is renamed as a whole when the job commits and
    listed by one task; Spark gives a task 32 small files at most, so the read is drawn together to as many tasks.
    """
    path = scratch_path(spark, "inventory")
    slices = max(INVENTORY_SLICES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    named = B.table(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("value")).repartition(slices, "s_suppkey")
    named.withColumn("slice", F.pmod(F.hash("s_suppkey"), F.lit(slices))).write.partitionBy("slice", "s_suppkey").text(path)
    files = sinks.file_inventory(R.read_binary(spark, path, "*.txt", recursive=True)).coalesce(slices)
    return files.select(F.regexp_extract("path", r"(s_suppkey=[^/]+)/", 1).alias("dir"), F.col("bytes").cast("long").alias("bytes"), "sha256")


@query("s13_write_table", """SELECT COUNT(*) AS n_rows, CAST(SUM(num_reads) AS BIGINT) AS reads, TRUE AS refused FROM quant""", "quant")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.errors import AnalysisException

    path = scratch_path(spark, "table")
    df = B.quant(spark, sf)
    sinks.write_table(df, path)
    try:
        sinks.write_table(df, path)
        refused = False
    except AnalysisException:
        refused = True
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("num_reads").cast("long").alias("reads")).withColumn(
        "refused", F.lit(refused))


@query("s14_write_idempotent", """SELECT step, outcome, n_rows FROM (VALUES (1, 'created'), (2, 'reused'), (3, 'refused')) v(step, outcome)
 CROSS JOIN (SELECT COUNT(*) AS n_rows FROM feature_map)""", "feature_map")
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "idempotent")
    df = B.feature_map(spark, sf)
    outcomes = [sinks.write_idempotent(df, path), sinks.write_idempotent(df, path)]
    try:
        outcomes.append(sinks.write_idempotent(df.withColumn("gene_id", F.lower("gene_id")), path))
    except ValueError:
        outcomes.append("refused")
    total = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"))
    steps = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(o).alias("outcome")) for i, o in enumerate(outcomes)])
    return total.select("n_rows", F.explode(steps).alias("s")).select("s.step", "s.outcome", "n_rows")


@query("s15_write_wide_matrix", "SELECT gene_id, " + ", ".join(
    f"CAST(MAX(CASE WHEN sample_id = '{s}' THEN \"count\" END) AS BIGINT) AS \"{s}\"" for s in B.SAMPLES
) + " FROM genes_raw GROUP BY 1", "genes_raw")
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "wide")
    wide = sinks.wide_matrix(B.genes_raw(spark, sf), "gene_id", "sample_id", "count", B.SAMPLES)
    sinks.write_table(wide, path, "csv")
    return tables.read_delimited(spark, path, "gene_id string, " + ", ".join(f"{s} double" for s in B.SAMPLES), sep=",").select(
        "gene_id", *[F.col(s).cast("long").alias(s) for s in B.SAMPLES])


@query("s16_write_summary", """SELECT n_orders, n_urgent, CAST(n_f AS BIGINT) AS n_f, CAST(n_o AS BIGINT) AS n_o, priorities FROM (
 SELECT COUNT(*) AS n_orders, SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS n_urgent,
 SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS n_f, SUM(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS n_o,
 string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities FROM orders)""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "summary")
    o = B.table(spark, sf, "orders")
    row = o.agg(
        F.count(F.lit(1)).alias("n_orders"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
        F.create_map(F.lit("F"), F.count_if(F.col("o_orderstatus") == "F"),
                     F.lit("O"), F.count_if(F.col("o_orderstatus") == "O")).alias("by_status"),
        F.array_sort(F.collect_set("o_orderpriority")).alias("priorities"),
    )
    sinks.write_summary(row, path)
    back = spark.read.schema("n_orders long, n_urgent long, by_status map<string,long>, priorities array<string>").json(path)
    return back.select("n_orders", "n_urgent", F.col("by_status.F").alias("n_f"), F.col("by_status.O").alias("n_o"),
                       F.array_join("priorities", ",").alias("priorities"))
