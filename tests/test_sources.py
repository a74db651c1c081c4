import gzip
import io
import zipfile

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cohortlens.sources import reports, sinks, tables
from cohortlens.sources import text as X

SOFT = """!Series_title = before
^SAMPLE = GSM1
!Sample_title = old
!Sample_title = A = 1
!Sample_characteristics_ch1 = PSA Level: 4:5
!Sample_characteristics_ch1 = tissue: x y
!Sample_characteristics_ch1 = Tissue : z
!Sample_characteristics_ch1 = nocolon
!Sample_relation = BioSample: https://h/biosample/SAMN1
!Sample_relation = SRA: https://h/sra?term=SRX9
^SAMPLE = GSM2
"""
FIELDS = (X.FieldRule("title", "!Sample_title = "), X.FieldRule("biosample", "!Sample_relation = BioSample: ", "last", "/"),
          X.FieldRule("srx", "!Sample_relation = SRA: ", "last", "="))


def blocks(lines, by):
    df = X.record_blocks(lines, by, X.FieldRule("gsm", "^SAMPLE = "), FIELDS, "!Sample_characteristics_ch1 = ")
    return {r["gsm"]: r for r in df.collect()}


def test_record_blocks_from_gzip(spark, tmp_path):
    path = tmp_path / "family.soft.gz"
    path.write_bytes(gzip.compress(SOFT.encode()))
    got = blocks(X.read_lines(spark, str(path)), ["file"])
    one = got["GSM1"]
    assert (one["title"], one["biosample"], one["srx"]) == ("A = 1", "SAMN1", "SRX9")
    assert one["characteristics"] == {"psa level": "4:5", "tissue": "z"}
    assert got["GSM2"]["title"] is None and got["GSM2"]["characteristics"] == {}


def test_lines_keep_order_over_splits(spark, tmp_path):
    path = tmp_path / "names.fa"
    path.write_text("".join(f">N{i} note\nACGT\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = X.read_lines(spark, str(path))
        assert lines.select("chunk").distinct().count() > 5
        got = X.sequence_names(lines).orderBy("ordinal").collect()
        # Record blocks that start in one split and end in the next stay whole.
        sized = X.record_blocks(lines, ["file"], X.FieldRule("n", ">", "last", ">"), (X.FieldRule("seq", "ACGT", "last", " "),), "!none")
        assert sized.where("seq = 'ACGT'").count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r["ordinal"], r["name"]) for r in got] == [(i + 1, f"N{i}") for i in range(3000)]


def test_section_fill_and_key_values(spark):
    text = ">>Basic\tpass\nk\t1\n>>END_MODULE\nloose\n>>Dup\twarn\n#x\t2\n>>END_MODULE"
    df = X.lines_of_text(spark.createDataFrame([("f", text)], "path string, t string"), "path", "t", lines_per_chunk=2)
    got = [(r["line"], r["section"]) for r in X.section_fill(df, ["path"]).orderBy("seq").collect()]
    assert [s for _, s in got] == ["Basic", "Basic", None, None, "Dup", "Dup", None]
    kv = spark.createDataFrame([(1, "a=1=2"), (2, "a=3"), (3, "none"), (4, "b=")], "seq int, line string")
    assert rows(X.key_values(kv, [])) == [("a", "1=2"), ("b", "")]


def test_id_list(spark):
    raw = ["SRR1\r", " ", "# note", "  SRR2 ", "SRR1", "bad id", "ERR3"]
    df = spark.createDataFrame(list(enumerate(raw, 1)), "seq int, line string")
    assert rows(X.id_list(df, r"^(SRR|ERR|DRR)\d+$")) == [("ERR3", 7, True), ("SRR1", 1, True), ("SRR2", 4, True), ("bad id", 6, False)]


def test_id_list_numbers_lines_over_splits(spark, tmp_path):
    ids = [f"SRR{i:06d}" for i in range(3000)]
    (tmp_path / "ids.txt").write_text("# head\n" + "\n".join(ids) + "\n" + ids[5] + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    try:
        lines = X.read_lines(spark, str(tmp_path / "ids.txt"))
        assert lines.rdd.getNumPartitions() > 3
        got = {r.id: r.first_line for r in X.id_list(lines, r"^SRR\d+$", by=["file"]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {x: n + 2 for n, x in enumerate(ids)}


def test_annotation(spark):
    attr = 'gene_id "G1"; gene_name "N1"; gene_type "t"; havana_gene_id "OTHER";'
    raw = ["# gene comment", f"c\ts\tgene\t1\t2\t.\t+\t.\t{attr}", f"c\ts\texon\t1\t2\t.\t+\t.\t{attr}",
           'c\ts\tgene\t1\t2\t.\t+\t.\tgene_id "G2"; gene_type "t";', "c\ts\tgene\t1"]
    df = spark.createDataFrame([(x,) for x in raw], "line string")
    assert rows(X.annotation_rows(df, "gene", ["gene_id", "gene_name", "gene_type"])) == [("G1", "N1", "t")]


def test_delimited_is_keyed_by_header(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x\ty\tz\nA\t1.5\tq\nB\tNA\tq\n")
    assert rows(tables.read_delimited(spark, str(tmp_path / "a.tsv"), "y double, x string")) == [(1.5, "A"), (None, "B")]
    with pytest.raises(ValueError, match="Missing columns"):
        tables.read_delimited(spark, str(tmp_path / "a.tsv"), "w string")
    (tmp_path / "b.tsv").write_text("x\ty\nA\t1\nB\t2\textra\nC\n")
    got = tables.read_delimited(spark, str(tmp_path / "b.tsv"), "x string, y int", corrupt="_bad")
    assert rows(got.where("_bad is not null"), "x") == [("B",), ("C",)]


def test_quant_and_json_take_sample_from_directory(spark, tmp_path):
    for s in ("R1", "R2"):
        (tmp_path / s).mkdir()
        (tmp_path / s / "quant.sf").write_text("Name\tLength\tEffectiveLength\tTPM\tNumReads\nT1\t10\t9.5\t1e6\t3\n")
        (tmp_path / s / "meta.json").write_text('{\n "num_processed": 5,\n "library_types": ["SF"], "percent_mapped": 1.5\n}')
    got = tables.read_quant(spark, [str(tmp_path / s / "quant.sf") for s in ("R1", "R2")])
    assert rows(got) == [("R1", "T1", 9.5, 1e6, 3.0), ("R2", "T1", 9.5, 1e6, 3.0)]
    meta = tables.read_run_json(spark, [str(tmp_path / s / "meta.json") for s in ("R1", "R2")])
    assert rows(meta, "sample_id", "num_processed", F.element_at("library_types", 1)) == [("R1", 5, "SF"), ("R2", 5, "SF")]


def test_published_header(spark, tmp_path):
    (tmp_path / "p.csv").write_text("gene_name,ensemble_id,logFC,PValue,FDR,type\nN,E1.2,1.5,0.01,nan,t\nM,,1,1,1,t\n")
    assert rows(tables.read_published(spark, str(tmp_path / "p.csv"))) == [("E1", "N", 1.5, 0.01, None, "t")]
    (tmp_path / "q.csv").write_text("ensemble_id,gene_name\nE1,N\n")
    with pytest.raises(ValueError, match="Unexpected header"):
        tables.read_published(spark, str(tmp_path / "q.csv"))


def test_zip_report(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("r/summary.txt", "PASS\tBasic\tf\nFAIL\tAdapter Content\tf\n")
        z.writestr("r/Images/plot.png", b"\x89PNG\r\n\x1a\n\xff\xfe\x00")
        z.writestr("r/report.html", b"<html>\xe9</html>")
        z.writestr("r/data.txt", ">>Basic\tpass\nTotal\t7\n>>END_MODULE\n>>Dup\tpass\n#Dedup\t3.5\nTotal\t9\n>>END_MODULE\n")
    (tmp_path / "r.zip").write_bytes(buffer.getvalue())
    lines = reports.archive_lines(reports.read_binary(spark, str(tmp_path), "*.zip")).cache()
    values = reports.report_values(reports.sectioned_report(lines, "data.txt"), "Basic", "Dup", "Dedup")
    assert rows(values, "key", "value") == [("Dedup", "3.5"), ("Total", "7")]
    status = reports.report_status(lines.where("member = 'summary.txt'"), ["path"], ["Adapter Content", "Quality"]).first()
    assert (status["adapter_content"], status["quality"]) == ("FAIL", "unknown")
    inventory = sinks.file_inventory(reports.read_binary(spark, str(tmp_path)), (".tmp",)).first()
    assert inventory["bytes"] == len(buffer.getvalue()) and len(inventory["sha256"]) == 64


def test_sinks_refuse_and_reuse(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    path = str(tmp_path / "t")
    assert sinks.write_idempotent(df, path) == "created"
    assert sinks.write_idempotent(df.orderBy(F.desc("k")), path) == "reused"
    with pytest.raises(ValueError, match="different content"):
        sinks.write_idempotent(df.limit(1), path)
    with pytest.raises(AnalysisException):
        sinks.write_table(df, path)
    # A null and an empty text are different content.
    assert not sinks.same_content(df, df.fillna("", ["v"]))


def test_published_files_by_their_own_headers(spark, tmp_path):
    from cohortlens.sources import tables

    (tmp_path / "a.csv").write_text("gene_name,ensemble_id,logFC,PValue,FDR,type\nA,E1.2,1.5,0.1,0.2,x\n,,,,,\n")
    (tmp_path / "b.csv").write_text("note,type,FDR,PValue,logFC,ensemble_id,gene_name\nn,y,0.4,0.3,-2,E2.1,B\n")
    got = sorted(map(tuple, tables.read_published(spark, str(tmp_path)).collect()))
    assert got == [("E1", "A", 1.5, 0.1, 0.2, "x"), ("E2", "B", -2.0, 0.3, 0.4, "y")]
    (tmp_path / "c.csv").write_text("gene_name,ensemble_id,logFC,PValue,FDR,type\nC,E3,1,0.1\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        tables.read_published(spark, str(tmp_path)).collect()
    (tmp_path / "c.csv").write_text("gene,id\nC,E3\n")
    with pytest.raises(ValueError, match="c.csv"):
        tables.read_published(spark, str(tmp_path))


def test_inventory_of_many_files_takes_few_tasks(spark, tmp_path):
    from hashlib import sha256

    from cohortlens.plans import catalog, scans

    keys = 2500
    spark.range(keys).selectExpr("id AS s_suppkey", "'Supplier ' || id AS s_name").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    found = catalog.load()[0]["s12_file_inventory"](spark, str(tmp_path))
    assert found.rdd.getNumPartitions() <= scans.INVENTORY_SLICES
    expected = {f"s_suppkey={i}": (len(f"Supplier {i}\n"), sha256(f"Supplier {i}\n".encode()).hexdigest()) for i in range(keys)}
    rows = found.collect()
    assert len(rows) == keys and {r["dir"]: (r["bytes"], r["sha256"]) for r in rows} == expected
