"""Corpus pipeline: toxicity filter, near-duplicate removal, redaction, source mixing, packing.

Every stage takes and returns documents (the last one returns packed pieces), is
written as Parquet in the shared folder and read again by the next one.  The
duplicate stage compares texts, whatever their ids, and takes those with a similarity of 0.8
and more as near copies: differing texts of one id stay unless they are, copies without an
id leave one row; nulls and texts without a word pass.  A table without usable labels rejects nothing.
Extra columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import op05_mixing, op06_toxicity, op08_minhash, op09_packing, op10_pii
from cohortlens.llm.base import Scratch, as_struct, table
from cohortlens.llm.families import Rule


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; the model is fitted on the labelled rows of ``docs``."""
    return op06_toxicity.clean(docs, op06_toxicity.learn(docs, table(spark, sf_dir, "labels")))


#: Near copies share 80 in 100 of their five-word shingles, so 51.2 +- 3.2 of 64 coordinates.
NEAR = Rule(coordinates=64, min_matches=34, numerator=80)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the smallest id, rows without an id after all others, then the smallest row.

    Texts are compared, not ids.  Equal texts are cut to one row before anything is
    joined, and each distinct text has a number of its own, fixed by storing it.
    """
    scratch = Scratch(spark, "near")
    read = docs.select(as_struct(docs).alias("doc"), "text")
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    order = F.struct(F.col("doc.doc_id").isNull().alias("none"), F.col("doc.doc_id").alias("id"), F.col("doc"))
    texts = read.where(words).groupBy(F.sha2("text", 256)).agg(F.min(order).alias("low"))
    texts = scratch.store(texts.select(F.monotonically_increasing_id().alias("n"), "low.none", "low.id", "low.doc"))
    found = op08_minhash.near_duplicates(texts.select(F.col("n").alias("doc_id"), "doc.text"), rule=NEAR)
    members = found.select(F.col("doc_id").alias("n"), "component_id").join(texts.select("n", "none", "id"), "n")
    # Rows of one id in a group: the number decides, which is fixed as well.
    first = members.groupBy("component_id").agg(F.min(F.struct("none", "id", "n")).alias("first")).select("first.n")
    result = scratch.store(texts.join(first, "n", "left_semi").select("doc.*").unionByName(read.where(~words).select("doc.*")))
    scratch.drop()
    return result


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the kind in brackets."""
    return op10_pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return op05_mixing.emit(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows; a repeated document is packed each time."""
    return op09_packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: Scores, redactions and token ids cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces of the whole documents table."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir))
        scratch.free()
    scratch.drop()
    return docs
