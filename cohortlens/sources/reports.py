"""Report containers (zip) and their status table."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.sources.text import section_fill


def read_binary(spark: SparkSession, paths: str | Sequence[str], glob: str = "*", recursive: bool = False) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).load(paths)


LINES_PER_FRAME = 20_000
#: Text members of a QC report archive: those of the published tool, and the short names of the bound tables.
REPORT_MEMBERS = ("fastqc_data.txt", "summary.txt", "data.txt")


def _unzip(members: frozenset[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    frame = lambda rows: pd.DataFrame(rows, columns=["path", "member", "seq", "line"])

    def job(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple[str, str, int, str]] = []
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.namelist():
                        name = member.rsplit("/", 1)[-1]
                        if name not in members:
                            continue
                        with archive.open(member) as raw:
                            for seq, line in enumerate(io.TextIOWrapper(raw, "utf-8")):
                                rows.append((path, name, seq, line.rstrip("\r\n")))
                                if len(rows) >= LINES_PER_FRAME:
                                    yield frame(rows)
                                    rows = []
        yield frame(rows)

    return job


def archive_lines(files: DataFrame, members: Sequence[str] = REPORT_MEMBERS, lines_per_chunk: int = 4096) -> DataFrame:
    """Lines of the named zip members: ``(path, member, chunk, seq, line)``.

    Other members (images, pages) are not opened, and lines are streamed.

    ``files`` has the binary-file columns ``path`` and ``content``.  Only the
    decompression runs in Python; sections and values are found by Spark.
    """
    rows = files.select("path", "content").mapInPandas(_unzip(frozenset(members)), "path string, member string, seq long, line string")
    return rows.withColumn("chunk", F.floor(F.col("seq") / lines_per_chunk))


def sectioned_report(lines: DataFrame, member: str) -> DataFrame:
    """Lines of one member with their section."""
    return section_fill(lines.where(F.col("member") == member), ["path"])


def report_values(sections: DataFrame, value_section: str, metric_section: str, metric: str) -> DataFrame:
    """``(path, key, value)``: value lines of one section and one ``#metric`` header line.

    The last line of a key wins.
    """
    line, section = F.col("line"), F.col("section")
    plain = (section == value_section) & line.contains("\t") & ~line.startswith("#") & ~line.startswith(">>")
    header = (section == metric_section) & line.startswith("#" + metric)
    cells = sections.where(plain | header).select(
        "path", "chunk", "seq",
        F.when(header, F.lit(metric)).otherwise(F.substring_index(line, "\t", 1)).alias("key"),
        F.when(header, F.get(F.split(line, "\t"), F.lit(1)))
        .otherwise(F.substr(line, F.instr(line, "\t") + F.lit(1))).alias("value"),
    )
    return cells.groupBy("path", "key").agg(F.max_by("value", F.struct("chunk", "seq")).alias("value"))


def report_status(lines: DataFrame, by: list[str], modules: Sequence[str], default: str = "unknown") -> DataFrame:
    """``status <tab> module <tab> file`` lines to one column per wanted module."""
    parts = F.split("line", "\t")
    cells = lines.select(*by, F.struct("chunk", "seq").alias("place"),
                         F.get(parts, F.lit(0)).alias("status"), F.get(parts, F.lit(1)).alias("module"))
    wanted = [
        F.coalesce(
            F.max_by("status", F.when(F.col("module") == m, F.col("place"))), F.lit(default)
        ).alias(m.lower().replace(" ", "_"))
        for m in modules
    ]
    return cells.groupBy(*by).agg(*wanted)
