"""Sinks that refuse to overwrite, the content fingerprint, and the file inventory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import row_digest_lanes


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Write, or fail when the path already exists."""
    writer = df.write.mode("errorifexists").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("nullValue", "NA")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def content_fingerprint(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Order-insensitive digest of a table: row count and four sums of row-digest lanes.

    Sums combine on the map side, so the table is never gathered.  Include a
    position column to make the digest order-sensitive.
    """
    columns = list(columns or df.columns)
    keyed = df.select(*by, *row_digest_lanes(columns))
    sums = [F.sum(f"lane_{i}").alias(f"digest_{i}") for i in range(4)]
    grouped = keyed.groupBy(*by) if by else keyed.groupBy()
    return grouped.agg(F.count(F.lit(1)).alias("n_rows"), *sums)


def same_content(a: DataFrame, b: DataFrame) -> bool:
    """Compare two tables by fingerprint (one job each, one row back)."""
    if sorted(a.columns) != sorted(b.columns):
        return False
    order = sorted(a.columns)
    return content_fingerprint(a, order).first() == content_fingerprint(b, order).first()


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        return True
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def write_idempotent(df: DataFrame, path: str) -> str:
    """``created``, ``reused`` for identical content, or an error for different content."""
    spark = df.sparkSession
    if path_exists(spark, path):
        if not same_content(df, spark.read.parquet(path)):
            raise ValueError(f"Refusing to overwrite different content: {path}")
        return "reused"
    write_table(df, path)
    return "created"


def wide_matrix(long: DataFrame, row: str, column: str, value: str, ids: Sequence[str]) -> DataFrame:
    """Row key by the given column ids, in their order; absent cells stay null."""
    return long.groupBy(row).pivot(column, list(ids)).agg(F.max(value))


def write_summary(row: DataFrame, path: str) -> None:
    """One-row JSON document of scalars, maps and lists."""
    row.coalesce(1).write.mode("errorifexists").json(path)


def file_inventory(files: DataFrame, excluded_suffixes: Sequence[str] = (".lock", ".tmp", ".prf"),
                   key: Column | None = None) -> DataFrame:
    """Stable files with size and SHA-256: ``(path, bytes, sha256)``.

    ``files`` comes from the binary-file source; a file is hashed where it is read.
    """
    stable = files
    for suffix in excluded_suffixes:
        stable = stable.where(~F.col("path").endswith(suffix))
    return stable.select(
        (F.col("path") if key is None else key).alias("path"),
        F.col("length").alias("bytes"),
        F.sha2(F.col("content"), 256).alias("sha256"),
    )
