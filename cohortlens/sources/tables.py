"""Delimited and JSON tables with explicit schemas."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions import finite_or_null, strip_version

QUANT_SCHEMA = T.StructType([
    T.StructField("Name", T.StringType()),
    T.StructField("EffectiveLength", T.DoubleType()),
    T.StructField("TPM", T.DoubleType()),
    T.StructField("NumReads", T.DoubleType()),
])

PUBLISHED_HEADER = ("gene_name", "ensemble_id", "logFC", "PValue", "FDR", "type")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail before any job starts when a required column is absent."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    return df


def read_delimited(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str, sep: str = "\t",
                   null: str = "NA", corrupt: str | None = None) -> DataFrame:
    """Header-keyed table with given column types; plain or gzip.

    Only the named columns are returned, wherever they stand in the header.  With
    ``corrupt`` named, ragged rows are kept and their text lands in that column,
    so that they can be reported as violations; otherwise they fail the read.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {"header": True, "sep": sep, "nullValue": null}
    header = spark.read.options(**options).csv(paths).columns
    missing = sorted(set(wanted.names) - set(header))
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    types = {f.name: f.dataType for f in wanted}
    full = [T.StructField(c, types.get(c, T.StringType())) for c in header]
    reader = spark.read.options(**options)
    if corrupt:
        full.append(T.StructField(corrupt, T.StringType()))
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
        reader = reader.option("columnPruning", False)
    else:
        reader = reader.option("mode", "FAILFAST").option("enforceSchema", False)
    table = reader.schema(T.StructType(full)).csv(paths)
    return table.select(*wanted.names, *([corrupt] if corrupt else []))


def read_quant(spark: SparkSession, paths: str | Sequence[str], sample_pattern: str = r"([^/]+)/[^/]+$") -> DataFrame:
    """Per-sample feature tables as one long table; the sample id is the directory name."""
    raw = read_delimited(spark, paths, QUANT_SCHEMA)
    return raw.select(
        F.regexp_extract(F.col("_metadata.file_path"), sample_pattern, 1).alias("sample_id"),
        F.col("Name").alias("feature_id"),
        F.col("EffectiveLength").alias("eff_len"),
        F.col("TPM").alias("tpm"),
        F.col("NumReads").alias("num_reads"),
    )


RUN_META_SCHEMA = T.StructType([
    T.StructField("num_processed", T.LongType()),
    T.StructField("num_mapped", T.LongType()),
    T.StructField("num_decoy_fragments", T.LongType()),
    T.StructField("num_valid_targets", T.LongType()),
    T.StructField("percent_mapped", T.DoubleType()),
    T.StructField("index_seq_hash", T.StringType()),
    T.StructField("library_types", T.ArrayType(T.StringType())),
    T.StructField("diagnostics", T.ArrayType(T.StringType())),
    T.StructField("quant_errors", T.ArrayType(T.StringType())),
    T.StructField("em_converged", T.BooleanType()),
])


def read_run_json(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = RUN_META_SCHEMA,
                  sample_pattern: str = r"([^/]+)/[^/]+$") -> DataFrame:
    """One JSON document per sample, the sample id from the directory name."""
    docs = spark.read.schema(schema).option("multiLine", True).json(paths)
    return docs.select(
        F.regexp_extract(F.col("_metadata.file_path"), sample_pattern, 1).alias("sample_id"), *schema.names
    )


def parse_run_json(df: DataFrame, column: str, schema: T.StructType | str = RUN_META_SCHEMA, out: str = "meta") -> DataFrame:
    """The same documents held in a string column."""
    return df.withColumn(out, F.from_json(F.col(column), schema))


def first_number_after_key(c: str, key: str) -> F.Column:
    """First number behind ``"key":`` in loose JSON text; null when absent."""
    return F.regexp_extract(F.col(c), rf'"{key}"\s*:\s*([0-9.]+)', 1).try_cast("double")


def check_header(found: Sequence[str], expected: Sequence[str] = PUBLISHED_HEADER) -> None:
    if tuple(found[: len(expected)]) != tuple(expected):
        raise ValueError(f"Unexpected header: {list(found)}")


def published_rows(raw: DataFrame) -> DataFrame:
    """Comparator rows keyed by the stripped id; rows without an id are skipped."""
    check_header(raw.columns)
    key = strip_version("ensemble_id")
    return raw.where(key != "").select(
        key.alias("gene_key"),
        F.col("gene_name"),
        finite_or_null(F.col("logFC").cast("string")).alias("published_lfc"),
        finite_or_null(F.col("PValue").cast("string")).alias("published_p"),
        finite_or_null(F.col("FDR").cast("string")).alias("published_fdr"),
        F.col("type").alias("gene_type"),
    )


def read_published(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Comparator table from CSV files, each read by its own header.

    Columns may stand in any order and more of them may follow.  Files are grouped by
    header, so there is one read for each kind of file.  A file without the expected
    names, or a row with another number of cells than its header, raises.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.split("value", re.escape(sep)).alias("cells"))
    names = F.array(*[F.lit(c) for c in PUBLISHED_HEADER])
    headed = F.size(F.array_except(names, "cells")) == 0
    files = lines.groupBy("file").agg(F.max(F.when(headed, F.col("cells"))).alias("header"))
    groups = files.groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    if not groups or any(g["header"] is None for g in groups):
        raise ValueError(f"Unexpected header in {[f for g in groups for f in g['files'] if g['header'] is None]}")
    found = None
    for g in groups:
        text = T.StructType([T.StructField(c, T.StringType()) for c in g["header"]])
        # Without column pruning the reader counts the cells of every row.
        rows = spark.read.schema(text).options(header=True, sep=sep, mode="FAILFAST", columnPruning=False).csv(g["files"]).select(*PUBLISHED_HEADER)
        found = rows if found is None else found.unionByName(rows)
    return published_rows(found)
