"""Feature quantification: mapping, length-aware roll-up, totals and validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions import pct, ratio


def map_features(quant: DataFrame, mapping: DataFrame) -> DataFrame:
    """Attach the group of each feature by exact id.

    No forced broadcast: the map grows with the annotation, so AQE broadcasts it
    when its measured size is small and shuffles otherwise.
    """
    return quant.join(mapping.select("feature_id", "gene_id"), "feature_id")


def group_rollup(mapped: DataFrame) -> DataFrame:
    """Per gene and sample: counts, abundance, abundance-weighted length, plain mean length.

    The length is null where the gene has no abundance in the sample.
    """
    return mapped.groupBy("gene_id", "sample_id").agg(
        F.sum("num_reads").alias("count"),
        F.sum("tpm").alias("tpm"),
        F.try_divide(F.sum(F.col("tpm") * F.col("eff_len")), F.nullif(F.sum("tpm"), F.lit(0.0))).alias("length"),
    )


def mean_feature_length(mapped: DataFrame) -> DataFrame:
    """Per gene, the mean over its features of their mean length over samples."""
    per_feature = mapped.groupBy("gene_id", "feature_id").agg(F.avg("eff_len").alias("_m"))
    return per_feature.groupBy("gene_id").agg(F.avg("_m").alias("mean_length"))


def fill_group_length(genes: DataFrame, mean_lengths: DataFrame) -> DataFrame:
    """Missing length: geometric mean of the gene's other samples, else its mean feature length.

    A gene has one row per sample of the cohort, so the window is bounded and
    reuses the partitioning by gene of ``densify``.
    """
    geo = F.exp(F.avg(F.ln("length")).over(Window.partitionBy("gene_id")))
    return (
        genes.withColumn("_geo", geo).join(mean_lengths, "gene_id", "left")
        .withColumn("length", F.coalesce("length", "_geo", "mean_length"))
        .drop("_geo", "mean_length")
    )


def densify(genes: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Every gene in every sample; absent cells get zero counts and a null length.

    One shuffle by gene: the cells of a gene (at most one per sample of the
    cohort) are looked up from a map while its sample list is unfolded.
    """
    cell = F.struct(*[F.col(c).cast("double").alias(c) for c in ("count", "tpm", "length")])
    rows = genes.groupBy("gene_id").agg(F.map_from_entries(F.collect_list(F.struct("sample_id", cell))).alias("_cells"))
    grid = rows.select("gene_id", "_cells", F.explode(F.array(*[F.lit(s) for s in samples])).alias("sample_id"))
    found = F.try_element_at("_cells", F.col("sample_id"))
    return grid.select(
        "gene_id", "sample_id",
        *[F.coalesce(found[c], F.lit(0.0)).alias(c) for c in ("count", "tpm")], found["length"].alias("length"),
    )


def sample_totals(genes: DataFrame) -> DataFrame:
    return genes.groupBy("sample_id").agg(
        F.sum("count").alias("sum_counts"),
        F.sum("tpm").alias("sum_tpm"),
        F.count_if(F.col("count") > 0).alias("n_nonzero_genes"),
    )


def rollup_conservation(quant: DataFrame, genes: DataFrame) -> DataFrame:
    """Largest absolute difference of per-sample counts before and after the roll-up."""
    before = quant.groupBy("sample_id").agg(F.sum("num_reads").alias("_a"))
    after = genes.groupBy("sample_id").agg(F.sum("count").alias("_b"))
    return before.join(after, "sample_id", "full").agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.max(F.abs(F.coalesce("_a", F.lit(0.0)) - F.coalesce("_b", F.lit(0.0)))).alias("max_abs_delta"),
    )


def quant_metrics(quant: DataFrame) -> DataFrame:
    """One pass per sample: rows, distinct ids, abundance sum, minimum, non-finite cells.

    Ids are counted per (sample, feature) first; both steps combine on the map
    side and no sample is held in one place.
    """
    bad = lambda c: F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == F.lit(float("inf")))
    cells = quant.groupBy("sample_id", "feature_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("tpm").alias("_t"),
        F.min(F.least("num_reads", "tpm", "eff_len")).alias("_min"),
        F.count_if(bad("num_reads") | bad("tpm") | bad("eff_len")).alias("_bad"),
    )
    return cells.groupBy("sample_id").agg(
        F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_ids"), F.sum("_t").alias("tpm_sum"),
        F.min("_min").alias("min_value"), F.sum("_bad").alias("n_not_finite"),
    )


def validate_quant(metrics: DataFrame, meta: DataFrame, expected: DataFrame, n_features: int | None = None) -> DataFrame:
    """Failed rules per sample: ``(sample_id, rule)``.

    ``expected`` carries ``reads, index_hash, n_targets`` per sample.
    """
    joined = expected.join(meta, "sample_id", "left").join(metrics, "sample_id", "left")
    target = F.col("n_targets") if n_features is None else F.lit(n_features)
    ok = {
        "row_count": F.col("n_rows") == target,
        "unique_ids": F.col("n_rows") == F.col("n_ids"),
        "tpm_sum": F.abs(F.col("tpm_sum") - 1_000_000) <= 0.5,
        "non_negative": F.col("min_value") >= 0,
        "finite": F.col("n_not_finite") == 0,
        "read_count": F.col("num_processed") == F.col("reads"),
        "index_identity": F.col("index_seq_hash") == F.col("index_hash"),
        "target_count": F.col("num_valid_targets") == target,
        "library_mode": F.col("library_types") == F.array(F.lit("SF")),
        "converged": F.col("em_converged") & (F.coalesce(F.size("quant_errors"), F.lit(0)) <= 0),
        "mapped": F.col("num_mapped") > 0,
    }
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in ok.items()]))
    return joined.select("sample_id", F.explode(failed).alias("rule"))


def mapping_summary(meta: DataFrame, group: str | None = None) -> DataFrame:
    """Cohort rate as a ratio of sums, with the unmapped remainder split off."""
    grouped = meta.groupBy(group) if group else meta.groupBy()
    sums = grouped.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.sum("num_processed").alias("processed"), F.sum("num_mapped").alias("mapped"),
        F.sum("num_decoy_fragments").alias("decoy"),
    )
    return sums.withColumns({
        "remainder": F.col("processed") - F.col("mapped") - F.col("decoy"),
        "weighted_pct_mapped": pct("mapped", "processed"),
    })


def mapping_rates(meta: DataFrame) -> DataFrame:
    return meta.withColumns({
        "pct_mapped": pct("num_mapped", "num_processed"),
        "pct_decoy": pct("num_decoy_fragments", "num_processed"),
    })


def threshold_flag(df: DataFrame, column: str, below: float, out: str) -> DataFrame:
    return df.withColumn(out, F.col(column) < below)


def quality_band(df: DataFrame, column: str, very_low: float, low: float, out: str = "band") -> DataFrame:
    value = F.col(column)
    return df.withColumn(out, F.when(value < very_low, "very_low").when(value < low, "low").otherwise("ok"))


def rate_contract(counts: DataFrame, rates: Sequence[tuple[str, str, str]], by: list[str]) -> DataFrame:
    """Named rates with explicit numerator and denominator; null where an input was not measured."""
    return counts.select(*by, *[ratio(a, b).alias(name) for name, a, b in rates])
