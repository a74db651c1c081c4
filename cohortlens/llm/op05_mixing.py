"""Mixing sources to target weights by repeating documents.

Tokens are summed per source; a source's repetition rate is its target divided by
its tokens.  A document is emitted floor(rate) times, and once more with a probability
equal to the fraction of the rate.  These Bernoulli draws share one hash-seeded offset for each
source: its documents are put in the order of their sizes (of one size, by hash), and the
n-th has the extra copy where ``offset + n * fraction`` passes a whole number.  Every document's
chance is the fraction, as with a draw of its own, but sums of sizes stay within about
one large document of the target.  Reruns and recomputed tasks agree.  Places in the order
come from prefix sums over (size, slice of the hash), so no source meets in one task.

Null or empty texts have size 0 and take nothing; a null source is a source of
its own and sorts last; rows of one id, or without an id, are told apart by their texts, and
equal rows have places of their own; very long texts are counted whole; an empty table
gives an empty mix.  A table without any word has all targets 0.  Other columns are kept
by :func:`emit` and not read by :func:`rates`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.llm.base import Scratch, as_struct, table
from cohortlens.llm.registry import query
from cohortlens.operators.ordering import running_total

WORD = r"[^\x20\x09-\x0D]+"
MOST_REPEATS = 3
SEED = "mix-1:"
#: Rows of one source and size that a task puts in order.
ROWS_PER_SLICE = 1_000_000
#: Sources whose targets are sent to all tasks; with more of them they are joined by a shuffle.
MOST_BROADCAST = 200_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def offset(source: Column, seed: str = SEED) -> Column:
    """Uniform number in [0, 1) that depends on the source and the seed only."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(source, F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def place(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Hash of a row's id and text, which orders rows of one size."""
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), digest).cast("binary"))


def targets(sizes: DataFrame, most: int = MOST_REPEATS) -> DataFrame:
    """source, source_size, target from one row per source.

    Weights 1, 2, 3 repeat over the sources by code point.  All targets sum to all
    sizes; where a share is above ``most`` times its source, the source gets that
    much and the rest is shared again.  In the order of cap / weight the capped
    sources come first, and running sums tell where they end.  The windows run over
    one row per source, not over documents.
    """
    whole = "decimal(38,0)"
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("w", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long"))
    order = Window.orderBy((F.lit(most) * F.col("source_size") / F.col("w")), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    running = weighed.select(
        "source", "source_size", "w", F.sum("source_size").over(everything).cast(whole).alias("total"),
        F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(whole).alias("before"),
        F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)).cast(whole).alias("w_left"))
    capped = (F.col("total") - most * F.col("before")) * F.col("w") >= most * F.col("source_size").cast(whole) * F.col("w_left")
    marked = running.withColumn("capped", capped)
    spent = F.sum(F.when(F.col("capped"), most * F.col("source_size")).otherwise(0)).over(everything)
    left = F.sum(F.when(~F.col("capped"), F.col("w")).otherwise(0)).over(everything)
    share = (F.col("total").cast("double") - spent.cast("double")) * F.col("w") / left
    return marked.select("source", "source_size", F.when(
        F.col("capped"), (most * F.col("source_size")).cast("double")).otherwise(share).alias("target"))


def _with_copies(sized: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds source_size, target and copies to rows with place, source, size (and others)."""
    n_rows = sized.count()
    shares = scratch.store(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))).withColumnRenamed("source", "of"))
    # Counted first; beyond the bound the rows are dealt by source for the join, and by (source, slice) after it.
    few = shares.count() <= MOST_BROADCAST
    joined = sized.join(F.broadcast(shares) if few else shares, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # A third of all rows may have one size: slices of the hash split them.
    slices = 1 + n_rows // ROWS_PER_SLICE
    part = F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * slices / F.lit(1 << 32))
    named = joined.withColumn("rate", rate).withColumn("name", F.coalesce(F.col("source"), F.lit(""))).withColumn(
        "nameless", F.col("source").isNull()).withColumn("slice", F.struct((-F.col("size")).alias("size"), part.alias("part")))
    if not few:
        named = named.repartition("nameless", "name", "slice")
    counted = running_total(named, ["nameless", "name"], "slice", ["place"], F.lit(1), "n")
    fraction, start = F.col("rate") - F.floor("rate"), offset(F.col("source"))
    extra = F.floor(start + F.col("n") * fraction) - F.floor(start + (F.col("n") - 1) * fraction)
    return counted.withColumn("copies", (F.floor("rate") + extra).cast("long"))


def rates(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies for every document."""
    scratch = scratch or Scratch(docs.sparkSession, "mixing")
    sized = scratch.store(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), place(F.col("doc_id"), F.col("text")).alias("place")))
    result = scratch.store(_with_copies(sized, scratch).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"))
    scratch.drop()
    return result


def emit(docs: DataFrame) -> DataFrame:
    """The mixed table itself: every row of ``docs`` as often as the mix takes it, columns unchanged."""
    sized = docs.select(as_struct(docs).alias("doc"), "source", n_words(F.col("text")).alias("size"), place(F.col("doc_id"), F.col("text")).alias("place"))
    # The one stored table, a row for each source, has to stay for the result.
    mixed = _with_copies(sized, Scratch(docs.sparkSession, "mixed")).where("copies > 0")
    return mixed.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")


SQL = rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size, md5(coalesce(text, '')) AS digest FROM documents),
 s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
 w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM s),
 r AS (SELECT *, sum(source_size) OVER () AS total,
   coalesce(sum(source_size) OVER (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
   sum(w) OVER (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left FROM w),
 c AS (SELECT *, (total - 3 * before) * w >= 3 * source_size * w_left AS capped FROM r),
 t AS (SELECT source, source_size, CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE) ELSE
   (CAST(total AS DOUBLE) - CAST(sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER () AS DOUBLE)) * w
   / sum(CASE WHEN capped THEN 0 ELSE w END) OVER () END AS target FROM c),
 x AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
   CAST(CAST('0x' || substr(md5('{SEED}' || coalesce(d.source, '')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296 AS u,
   row_number() OVER (PARTITION BY d.source ORDER BY size DESC, md5('{SEED}' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || digest)) AS n
   FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
 y AS (SELECT *, CAST(floor(rate) + floor(u + n * (rate - floor(rate))) - floor(u + (n - 1) * (rate - floor(rate))) AS BIGINT) AS copies FROM x)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM y
"""


@query("op5_source_mixing", SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates(table(spark, sf_dir, "documents"))
