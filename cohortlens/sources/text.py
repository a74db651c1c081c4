"""Line-oriented sources: splittable text with a stable line order, and its parsers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import after_first, after_last, normalise_key, normalise_value, strip
from cohortlens.operators.ordering import carry_last, keep_first, running_total

LINE_ORDER = ("chunk", "seq")


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(file, chunk, seq, line)``; (file, chunk, seq) is the order of lines on disk.

    ``chunk`` is the split (file path and byte offset) a line was read from and
    ``seq`` grows inside it, so big files stay splittable and still have an order.
    """
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")).alias("chunk"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )


def lines_of_text(df: DataFrame, key: str, text: str, lines_per_chunk: int = 4096) -> DataFrame:
    """Lines of a text column: ``(key, chunk, seq, line)``."""
    parts = df.select(F.col(key), F.posexplode(F.split(F.col(text), "\n")).alias("seq", "line"))
    return parts.withColumn("chunk", F.floor(F.col("seq") / lines_per_chunk))


@dataclass(frozen=True)
class FieldRule:
    """How a scalar field of a record block is found: line prefix and cutting rule."""

    name: str
    prefix: str
    cut: str = "first"      # text after the "first" or the "last" delimiter
    delimiter: str = "="


def record_blocks(lines: DataFrame, by: list[str], start: FieldRule, fields: Sequence[FieldRule],
                  map_prefix: str) -> DataFrame:
    """Line stream to one row per record.

    A line with the start prefix opens a record, and lines before the first one
    are ignored.  Scalar fields keep the last matching line.  ``key: value``
    lines fill ``characteristics`` with normalised keys, the last value winning.
    """
    opens = F.col("line").startswith(start.prefix)
    blocks = running_total(lines, by, "chunk", ["seq"], opens.cast("long"), "block").where(F.col("block") > 0)
    place = F.struct("chunk", "seq")

    def cut(rule: FieldRule) -> F.Column:
        found = after_first if rule.cut == "first" else after_last
        return F.when(F.col("line").startswith(rule.prefix), found(F.col("line"), rule.delimiter))

    scalars = [
        F.max_by(cut(r), F.when(F.col("line").startswith(r.prefix), place)).alias(r.name) for r in (start, *fields)
    ]
    heads = blocks.groupBy(*by, "block").agg(*scalars)

    body = after_first(F.col("line"), "=")
    pairs = blocks.where(F.col("line").startswith(map_prefix) & body.contains(":")).select(
        *by, "block", place.alias("place"),
        normalise_key(F.substring_index(body, ":", 1)).alias("key"),
        normalise_value(after_first(body, ":")).alias("value"),
    )
    last = pairs.groupBy(*by, "block", "key").agg(F.max_by("value", "place").alias("value"))
    maps = last.groupBy(*by, "block").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("characteristics")
    )
    empty = F.create_map().cast("map<string,string>")
    return heads.join(maps, [*by, "block"], "left").withColumn(
        "characteristics", F.coalesce("characteristics", empty)
    )


def section_fill(lines: DataFrame, by: list[str], opens: str = ">>", closes: str = ">>END") -> DataFrame:
    """Name the section each line lies in; null between sections."""
    line = F.col("line")
    mark = F.when(line.startswith(closes), F.lit("")).when(
        line.startswith(opens), F.element_at(F.split(F.substr(line, F.lit(len(opens) + 1)), "\t"), 1)
    )
    filled = carry_last(lines, by, "chunk", ["seq"], mark, "section")
    return filled.withColumn("section", F.when(F.col("section") != "", F.col("section")))


def id_list(lines: DataFrame, pattern: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct ids of a line list: ``(*by, id, first_line, valid)``.

    Carriage returns, blank lines and ``#`` comments are skipped; ids that break
    the pattern are kept as ``valid = false`` with their first line, so that a
    caller can reject the whole list.  Lines with a ``chunk`` (from
    :func:`read_lines`, with ``by=["file"]``) are numbered from 1 in file order;
    without it ``seq`` is the line number.
    """
    number = "seq"
    if "chunk" in lines.columns:
        number = "_line_no"
        lines = running_total(lines, list(by), "chunk", ["seq"], F.lit(1), number)
    cleaned = lines.select(*by, strip(F.col("line")).alias("id"), number)
    kept = cleaned.where((F.col("id") != "") & ~F.col("id").startswith("#"))
    return kept.groupBy(*by, "id").agg(F.min(number).alias("first_line")).withColumn("valid", F.col("id").rlike(pattern))


def key_values(lines: DataFrame, by: list[str], position: str = "seq") -> DataFrame:
    """``key=value`` lines: first match per key, the value may hold more ``=``."""
    line = F.col("line")
    cells = lines.where(line.contains("=")).select(
        *by, position,
        F.substring_index(line, "=", 1).alias("key"),
        F.substr(line, F.instr(line, "=") + F.lit(1)).alias("value"),
    )
    return keep_first(cells, [*by, "key"], position).drop(position)


def sequence_names(lines: DataFrame) -> DataFrame:
    """Names of ``>`` lines in order: ``(ordinal, name)``, ordinals from 1."""
    heads = lines.where(F.col("line").startswith(">"))
    named = heads.withColumn("name", F.regexp_extract("line", r"^>(\S+)", 1))
    return running_total(named, [], "chunk", ["seq"], F.lit(1), "ordinal").select("ordinal", "name")


def annotation_rows(lines: DataFrame, feature: str, attributes: Sequence[str]) -> DataFrame:
    """Feature rows of a 9-field tab annotation with the wanted attributes.

    Comments, rows with fewer fields, other features and rows that miss one of
    the attributes are dropped.  The cheap prefix tests run before the patterns.
    """
    rows = lines.where(~F.col("line").startswith("#") & F.col("line").contains(f"\t{feature}\t"))
    fields = rows.withColumn("_f", F.split("line", "\t", 9)).where(F.size("_f") == 9)
    kept = fields.where(F.get("_f", F.lit(2)) == feature)
    values = [F.regexp_extract(F.get("_f", F.lit(8)), rf'\b{a} "([^"]+)"', 1).alias(a) for a in attributes]
    out = kept.select(*values)
    for a in attributes:
        out = out.where(F.col(a) != "")
    return out
