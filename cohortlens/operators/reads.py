"""Read-level and sensitivity diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import pct, ratio
from cohortlens.operators.compare import pearson, top_k_overlap
from cohortlens.operators.ordering import exact_median, exact_quantiles, ordinal_rank
from cohortlens.sources.sinks import content_fingerprint


def stratify_by_class(reads: DataFrame, group: str, length: str, quality: str) -> DataFrame:
    """Per class: reads, exact median length and mean quality."""
    sums = reads.groupBy(group).agg(F.count(F.lit(1)).alias("n_reads"), F.avg(quality).alias("mean_quality"))
    return sums.join(exact_median(reads, length, [group], "median_length"), group)


def clip_tail(reads: DataFrame, quality: str, cutoff: int, min_length: int) -> DataFrame:
    """Length left after trimming trailing bases below the cut-off, and whether it is kept."""
    q = F.col(quality)
    last_good = F.aggregate(
        F.transform(q, lambda x, i: F.when(x >= cutoff, i + 1).otherwise(F.lit(0))),
        F.lit(0), lambda acc, x: F.greatest(acc, x),
    )
    return reads.withColumn("clipped_length", last_good).withColumn("kept", F.col("clipped_length") >= min_length)


def clip_summary(clipped: DataFrame, by: list[str], mapped: str) -> DataFrame:
    """Kept and dropped reads, and the mapped rate on both denominators."""
    return clipped.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_reads"),
        F.count_if("kept").alias("n_kept"),
        F.count_if(~F.col("kept")).alias("n_dropped"),
        F.count_if(F.col("kept") & F.col(mapped)).alias("n_mapped"),
    ).withColumns({"rate_of_all": pct("n_mapped", "n_reads"), "rate_of_kept": pct("n_mapped", "n_kept")})


def systematic_sample(df: DataFrame, by: list[str], chunk: str, position: list[str], n: int) -> DataFrame:
    """``n`` evenly spaced rows per group over its whole order (all rows of smaller groups)."""
    numbered = ordinal_rank(df, by, chunk, position, "_rn")
    totals = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_total"))
    slot = lambda r: F.floor((r * F.lit(n)) / F.col("_total"))
    rn = F.col("_rn") - 1
    picked = numbered.join(totals, by).where((rn == 0) | (slot(rn) != slot(rn - 1)) | (F.col("_total") <= n))
    return picked.withColumn("ordinal", F.col("_rn")).drop("_rn", "_total")


def variant_stability(a: DataFrame, b: DataFrame, key: str, value: str, by: list[str], floor: float = 10.0, k: int = 100) -> DataFrame:
    """Agreement of two runs of each group over features with a value of at least ``floor`` in either."""
    left = a.select(*by, key, F.col(value).alias("_a"))
    right = b.select(*by, key, F.col(value).alias("_b"))
    both = left.join(right, [*by, key], "full").withColumns(
        {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("_a", "_b")}
    )
    kept = both.where((F.col("_a") >= floor) | (F.col("_b") >= floor)).withColumns({
        "_la": F.log1p("_a"), "_lb": F.log1p("_b"),
        "_ratio": F.abs(F.log2((F.col("_b") + 1) / (F.col("_a") + 1))),
    })
    counts = kept.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_features"), F.count_if(F.col("_ratio") >= 1).alias("n_two_fold")
    )
    r = pearson(kept, "_la", "_lb", by).select(*by, F.col("r").alias("pearson_log1p"))
    p95 = exact_quantiles(kept, "_ratio", [0.95], by).select(*by, F.col("quantile").alias("p95_abs_log2"))
    shared = top_k_overlap(a, b, key, value, k, by).select(*by, F.col("n_shared").alias("top_shared"))
    return (
        counts.join(r, by).join(p95, by).join(shared, by, "left")
        .withColumn("top_shared", F.coalesce("top_shared", F.lit(0)))
    )


def threshold_sweep(results: DataFrame, by: list[str], threshold: str, metric: str, default: float) -> DataFrame:
    """Metric per threshold with its difference to the default threshold."""
    base = results.where(F.col(threshold) == default).select(*by, F.col(metric).alias("_base"))
    return results.join(base, by, "left").withColumn("delta", F.col(metric) - F.col("_base")).drop("_base")


# Tile lengths for exact substring search; a sequence uses the longest tile with 2 * tile - 1 <= length.
TILES = (16, 4)
# Shorter sequences than the last tile needs are looked up as a whole.
SHORT = 2 * TILES[-1] - 2


def overrepresented_lookup(seqs: DataFrame, panel: DataFrame, seq_id: str, seq: str, panel_id: str, text: str) -> DataFrame:
    """Which sequences occur inside which panel texts: ``(seq_id, panel_id)``.

    Panel texts are cut into adjacent tiles.  Where a text contains a sequence, all tiles
    of the sequence from one of its first offsets on are tiles of that text.  Texts
    are counted by tile, so an offset with a tile that no text has is out before any text is
    looked at, and each other one is looked up by its rarest tile; a substring test keeps the
    true candidates.  Sequences of up to ``SHORT`` characters are joined to the texts' substrings of that
    length, which needs no test.  No pair of unrelated rows is ever formed.
    """
    length = F.char_length(seq)
    tile = F.lit(None).cast("int")
    for t in reversed(TILES):
        tile = F.when(length >= 2 * t - 1, t).otherwise(tile)
    keyed = seqs.select(seq_id, seq, tile.alias("tile"), length.alias("_len")).where("_len > 0").withColumn("_key", F.xxhash64(seq))
    pieces = lambda at, size: F.struct(at.alias("at"), F.substr(F.col(seq), at, size).alias("gram"))
    every = keyed.where("tile is not null").select(seq_id, "_key", "tile", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("_len") - F.col("tile") + 1), lambda at: pieces(at, F.col("tile")))).alias("p"))
    grams = every.select(seq_id, "_key", "tile", ((F.col("p.at") - 1) % F.col("tile")).alias("_offset"), "p.gram")

    used = keyed.agg(F.collect_set("tile")).scalar()
    cut = None
    for t in TILES:
        found = panel.where(F.array_contains(used, t)).select(
            panel_id, F.lit(t).alias("tile"),
            F.explode(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{{t}}}"), F.lit(0)))).alias("gram"),
        )
        cut = found if cut is None else cut.unionByName(found)
    texts_with = cut.groupBy("tile", "gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = grams.join(texts_with, ["tile", "gram"], "left").groupBy(seq_id, "_key", "tile", "_offset").agg(
        F.min_by("gram", "_n").alias("gram"), (F.count("_n") == F.count(F.lit(1))).alias("_all")).where("_all")
    candidates = cut.join(rarest.select(seq_id, "tile", "gram").distinct(), ["tile", "gram"]).select(seq_id, panel_id).distinct()
    checked = candidates.join(seqs.select(seq_id, seq), seq_id).join(panel.select(panel_id, text), panel_id)
    long_hits = checked.where(F.contains(F.col(text), F.col(seq))).select(seq_id, panel_id)

    short = keyed.where("tile is null")
    sizes = short.agg(F.collect_set("_len")).scalar()
    grams = None
    for k in range(1, SHORT + 1):
        starts, size = F.sequence(F.lit(1), F.char_length(text) - k + 1), F.lit(k)
        found = panel.where(F.array_contains(sizes, k) & (F.char_length(text) >= k)).select(
            panel_id, F.explode(F.array_distinct(F.transform(starts, lambda at: F.substr(F.col(text), at, size)))).alias(seq))
        grams = found if grams is None else grams.unionByName(found)
    return long_hits.unionByName(short.select(seq_id, seq).join(grams, seq).select(seq_id, panel_id)).distinct()


def reproducibility_check(a: DataFrame, b: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Groups with their row counts and digests on both sides and whether they are identical."""
    left = content_fingerprint(a, columns, by)
    right = content_fingerprint(b, columns, by)
    names = [c for c in left.columns if c not in by]
    renamed = right.select(*by, *[F.col(c).alias(f"_{c}") for c in names])
    same = F.lit(True)
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    joined = left.join(renamed, by, "full")
    return joined.select(*by, F.col("n_rows").alias("rows_a"), F.col("_n_rows").alias("rows_b"), same.alias("identical"))


def distinct_at_quality(reads: DataFrame, alignments: DataFrame, read: str, quality: str, min_quality: int) -> DataFrame:
    """Reads with any alignment and with one of good quality, as counts and percentages of all reads."""
    best = alignments.groupBy(read).agg(F.max(quality).alias("_q"))
    joined = reads.select(read).distinct().join(best, read, "left")
    return joined.agg(
        F.count(F.lit(1)).alias("n_reads"),
        F.count("_q").alias("n_aligned"),
        F.count_if(F.col("_q") >= min_quality).alias("n_good"),
    ).withColumns({"pct_aligned": pct("n_aligned", "n_reads"), "pct_good": pct("n_good", "n_reads")})
