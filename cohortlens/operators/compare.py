"""Comparison of significant sets: overlap, direction, correlation, categories, set algebra."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import ratio
from cohortlens.operators.ordering import distinct_ladder, join_by_value, top_k_per_group


def significant(df: DataFrame, alpha: float = 0.05) -> DataFrame:
    return df.where(F.col("padj").isNotNull() & (F.col("padj") < alpha))


def compare_full(published: DataFrame, ours: DataFrame, alpha: float = 0.05, key: str = "gene_key") -> DataFrame:
    """Union of published ids and our significant ids with the columns of both sides.

    One full outer join: published rows keep our values also where we found no
    significance, and our rows without a published partner stay only if significant.
    """
    sig = F.col("padj").isNotNull() & (F.col("padj") < alpha)
    left = published.withColumn("in_published", F.lit(True))
    right = ours.withColumn("in_ours", F.lit(True)).withColumn("ours_significant", sig)
    joined = left.join(right, key, "full").withColumns({
        c: F.coalesce(F.col(c), F.lit(False)) for c in ("in_published", "in_ours", "ours_significant")
    })
    kept = joined.where(F.col("in_published") | F.col("ours_significant"))
    return kept.withColumn("in_both_significant", F.col("in_published") & F.col("ours_significant"))


def paired_effects(a: DataFrame, b: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Inner join on the key with both effects present."""
    return a.select(key, x).join(b.select(key, y), key).where(F.col(x).isNotNull() & F.col(y).isNotNull())


def cross_group_pairs(edges: DataFrame, mapping: DataFrame, left: str, right: str) -> DataFrame:
    """Edges whose ends map to different or equal groups, and ends without a group."""
    side = lambda name, out: mapping.select(F.col("feature_id").alias(name), F.col("gene_id").alias(out))
    joined = edges.join(side(left, "_g1"), left, "left").join(side(right, "_g2"), right, "left")
    return joined.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if(F.col("_g1") != F.col("_g2")).alias("n_cross"),
        F.count_if(F.col("_g1") == F.col("_g2")).alias("n_within"),
        F.count_if(F.col("_g1").isNull() | F.col("_g2").isNull()).alias("n_unmapped"),
    )


def groups_without_retained(mapping: DataFrame, duplicates: DataFrame, types: DataFrame) -> DataFrame:
    """Groups left without a member once duplicate features are dropped, counted by type."""
    kept = mapping.join(duplicates.select("feature_id"), "feature_id", "left_anti")
    lost = mapping.select("gene_id").distinct().join(kept.select("gene_id"), "gene_id", "left_anti")
    return lost.join(types, "gene_id", "left").groupBy("gene_type").agg(F.count(F.lit(1)).alias("n_groups"))


def unmatched_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: ``(key, side)``."""
    left = a.select(key).distinct().withColumn("_a", F.lit(True))
    right = b.select(key).distinct().withColumn("_b", F.lit(True))
    joined = left.join(right, key, "full").where(F.col("_a").isNull() | F.col("_b").isNull())
    return joined.select(key, F.when(F.col("_b").isNull(), "left_only").otherwise("right_only").alias("side"))


def ordered_mismatches(a: DataFrame, b: DataFrame, ordinal: str, value: str, offset: int = 0) -> DataFrame:
    """Positions where two ordered lists differ; ``offset`` shifts ``b`` behind other rows."""
    left = a.select(F.col(ordinal).alias("ordinal"), F.col(value).alias("left_value"))
    right = b.select((F.col(ordinal) + offset).alias("ordinal"), F.col(value).alias("right_value"))
    joined = left.join(right, "ordinal", "full")
    return joined.where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def shared_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Ids in both; two sets are disjoint when this is empty."""
    return a.select(key).distinct().join(b.select(key), key, "left_semi")


def overlap_metrics(published: DataFrame, ours: DataFrame, key: str = "gene_key", alpha: float = 0.05,
                    zero_as: str = "down") -> DataFrame:
    """Sizes, overlap, union, Jaccard, recovery and one-sided counts in a single pass."""
    table = compare_full(published, ours, alpha, key)
    up = F.col("published_lfc") > 0
    down = ~up if zero_as == "down" else F.col("published_lfc") < 0
    counts = table.agg(
        F.count_if("in_published").alias("published"),
        F.count_if(F.col("in_published") & up).alias("published_up"),
        F.count_if(F.col("in_published") & down).alias("published_down"),
        F.count_if("ours_significant").alias("ours"),
        F.count_if("in_both_significant").alias("overlap"),
        F.count(F.lit(1)).alias("union_size"),
        F.count_if(F.col("in_published") & F.col("in_ours")).alias("published_in_universe"),
        F.count_if(F.col("in_published") & ~F.col("ours_significant")).alias("published_only"),
        F.count_if(~F.col("in_published")).alias("ours_only"),
    )
    return counts.withColumns({
        "jaccard": ratio("overlap", "union_size"),
        "recovery": ratio("overlap", "published"),
        "overlap_fraction": ratio("overlap", "ours"),
    })


def direction_concordance(pairs: DataFrame, x: str, y: str, null_as_zero: bool = False) -> DataFrame:
    """Same, opposite and zero products of two effects."""
    if null_as_zero:
        product = F.coalesce(F.col(x), F.lit(0.0)) * F.coalesce(F.col(y), F.lit(0.0))
        kept = pairs
    else:
        product = F.col(x) * F.col(y)
        kept = pairs.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return kept.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if(product > 0).alias("concordant"),
        F.count_if(product < 0).alias("opposed"),
        F.count_if(product == 0).alias("zero"),
    ).withColumn("agreement", ratio("concordant", "n_pairs"))


def sign_concordance(a: DataFrame, b: DataFrame, key: str, effect: str, alpha: float = 0.05) -> DataFrame:
    """Shared significant keys with both effects and whether their signs are equal (zero equals zero)."""
    shared = track_overlap(a, b, key, effect, alpha)
    return shared.withColumn("same_sign", F.signum(f"{effect}_a") == F.signum(f"{effect}_b"))


def track_overlap(a: DataFrame, b: DataFrame, key: str, effect: str, alpha: float = 0.05) -> DataFrame:
    left = significant(a, alpha).select(key, F.col(effect).alias(f"{effect}_a"))
    right = significant(b, alpha).select(key, F.col(effect).alias(f"{effect}_b"))
    return left.join(right, key)


def pearson(pairs: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Correlation by moments about the mean; null for fewer than two pairs or a constant side.

    Two aggregates: group means first, then centred sums, which stay accurate for
    large offsets and never raise on constants.
    """
    by = by or []
    kept = pairs.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        *by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")
    )
    grouped = kept.groupBy(*by) if by else kept.groupBy()
    moments = grouped.agg(
        F.count(F.lit(1)).alias("n"),
        F.covar_pop("_x", "_y").alias("_c"), F.var_pop("_x").alias("_vx"), F.var_pop("_y").alias("_vy"),
        F.min("_x").alias("_x0"), F.max("_x").alias("_x1"), F.min("_y").alias("_y0"), F.max("_y").alias("_y1"),
    )
    usable = (F.col("n") >= 2) & (F.col("_x1") > F.col("_x0")) & (F.col("_y1") > F.col("_y0"))
    value = F.when(usable, F.try_divide(F.col("_c"), F.sqrt(F.col("_vx")) * F.sqrt(F.col("_vy"))))
    return moments.select(*by, "n", value.alias("r"))


def spearman(pairs: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Pearson correlation of mid-ranks over complete pairs."""
    by = by or []
    # Equal pairs are counted once; both rankings and the sums read these counts.
    counted = pairs.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(
        *by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).agg(F.count(F.lit(1)).alias("_w")).where(~F.isnan("_x") & ~F.isnan("_y"))
    ranked = counted
    for value, out in (("_x", "_rx"), ("_y", "_ry")):
        ladder = distinct_ladder(counted, value, by, weight="_w").withColumn(out, F.col("below") + (F.col("n") + 1) / F.lit(2.0))
        ranked = join_by_value(ranked, ladder.select(*by, value, "n", out, "total"), value, by, [out, "total"]).withColumnRenamed("total", f"_n{out}")
    # Mid-ranks of n pairs have the mean (n + 1) / 2, so one pass over centred ranks is exact enough.
    dx, dy = (F.col(r) - (F.col(f"_n{r}") + 1) / F.lit(2.0) for r in ("_rx", "_ry"))
    w = F.col("_w")
    sums = (ranked.groupBy(*by) if by else ranked.groupBy()).agg(
        F.coalesce(F.sum(w), F.lit(0)).alias("n"), F.sum(w * dx * dy).alias("_c"), F.sum(w * dx * dx).alias("_vx"), F.sum(w * dy * dy).alias("_vy"))
    usable = (F.col("n") >= 2) & (F.col("_vx") > 0) & (F.col("_vy") > 0)
    return sums.select(*by, "n", F.when(usable, F.col("_c") / (F.sqrt("_vx") * F.sqrt("_vy"))).alias("r"))


def type_composition(ids: DataFrame, types: DataFrame, key: str, group: str, missing: str = "unannotated") -> DataFrame:
    """Counts by type for each set, with the total per set in the row whose type is null."""
    typed = ids.join(types.select(key, "gene_type"), key, "left").withColumn(
        "gene_type", F.coalesce("gene_type", F.lit(missing))
    )
    per_type = typed.groupBy(group, "gene_type").agg(F.count(F.lit(1)).alias("n"))
    total = per_type.groupBy(group).agg(F.sum("n").alias("n")).withColumn("gene_type", F.lit(None).cast("string"))
    return per_type.unionByName(total)


def type_conflicts(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one distinct value."""
    distinct = df.select(key, value).distinct()
    return distinct.groupBy(key).agg(F.count(value).alias("n_types")).where(F.col("n_types") > 1)


def de_summary(result: DataFrame, by: list[str]) -> DataFrame:
    """Counts of tested, adjusted, significant, up and down rows per contrast."""
    sig = F.col("significant")
    return result.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_genes"),
        F.count_if("tested").alias("tested"),
        F.count_if(F.col("padj").isNotNull()).alias("has_padj"),
        F.count_if(sig).alias("n_significant"),
        F.count_if(sig & (F.col("lfc") > 0)).alias("n_up"),
        F.count_if(sig & (F.col("lfc") < 0)).alias("n_down"),
        F.count_if(F.col("pvalue").isNull()).alias("pvalue_null"),
        F.count_if(F.col("pvalue").isNotNull() & F.col("padj").isNull()).alias("filtered_padj_null"),
    )


def marker_consistency(markers: DataFrame, results: DataFrame, key: str, contrast: str) -> DataFrame:
    """Per marker: contrasts seen, significance in all of them, number of distinct signs."""
    joined = markers.join(results, key, "left")
    return joined.groupBy(key).agg(
        F.count(contrast).alias("n_contrasts"),
        F.count_if(F.col("padj") < 0.05).alias("n_significant"),
        F.coalesce(F.bool_and(F.coalesce(F.col("padj") < 0.05, F.lit(False))), F.lit(False)).alias("significant_in_all"),
        F.count_distinct(F.signum("lfc")).alias("n_signs"),
    )


# Category names of the discordance table, in order of precedence.
ABSENT = "absent_from_our_nonzero_gene_universe"
NO_P = "our_raw_p_unavailable"
NO_PADJ = "our_BH_padj_unavailable"
NOMINAL_ONLY = "our_nominal_p_below_0.05_but_BH_not"
NOT_NOMINAL = "our_not_significant_nominal"
SIGNIFICANT = "our_significant"


def discordance_category(df: DataFrame, present: Column, p: str, padj: str, out: str = "category") -> DataFrame:
    """Why a published id is not significant here: the first reason that applies."""
    pv, adj = F.col(p), F.col(padj)
    return df.withColumn(
        out,
        F.when(~present, ABSENT)
        .when(pv.isNull(), NO_P)
        .when(adj.isNull(), NO_PADJ)
        .when((adj >= 0.05) & (pv < 0.05), NOMINAL_ONLY)
        .when(adj >= 0.05, NOT_NOMINAL)
        .otherwise(SIGNIFICANT),
    )


def discordance_table(compared: DataFrame, types: DataFrame, key: str = "gene_key") -> DataFrame:
    """Every id of either list with its status, category, both types and direction.

    ``compared`` comes from :func:`compare_full`; ``types`` has the key and our
    ``type``.  Ids of our list only have no published category.
    """
    status = F.when(F.col("in_both_significant"), "shared_DE").when(F.col("in_published"), "published_only").otherwise("ours_only")
    named = discordance_category(compared, F.col("in_ours"), "pvalue", "padj").withColumn(
        "category", F.when(F.col("in_published"), F.col("category")).otherwise(F.lit("not_in_published_DE_table")))
    ours = types.select(key, F.col("type").alias("_ours_type"))
    product = F.col("published_lfc") * F.col("lfc")
    return named.join(ours, key, "left").select(
        key, status.alias("status"), "category", F.col("gene_type").alias("published_type"),
        F.coalesce("_ours_type", F.lit("unannotated")).alias("ours_type"),
        F.when(product.isNotNull(), product > 0).alias("direction_agrees"))


def comparator_violations(published: DataFrame, key: str, fdr: str, alpha: float = 0.05) -> DataFrame:
    """``(rule, key, n)`` for a comparator list: ids that occur twice, missing rates, rates that are not significant."""
    per_id = published.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(fdr).isNull()).alias("_missing"), F.count_if(F.col(fdr) >= alpha).alias("_above"))
    found = F.array(*[F.struct(F.lit(rule).alias("rule"), n.alias("n"), (n > most).alias("bad")) for rule, n, most in (
        ("duplicate_id", F.col("_n"), 1), ("missing_fdr", F.col("_missing"), 0), ("fdr_not_significant", F.col("_above"), 0))])
    return per_id.select(key, F.explode(found).alias("v")).where("v.bad").select(F.col("v.rule").alias("rule"), key, F.col("v.n").alias("n"))


def top_k_overlap(a: DataFrame, b: DataFrame, key: str, value: str, k: int, by: list[str] | None = None) -> DataFrame:
    """Number of members that two top-k lists share, per group."""
    by = by or []
    top_a = top_k_per_group(a, by, value, key, k).select(*by, key)
    top_b = top_k_per_group(b, by, value, key, k).select(*by, key)
    shared = top_a.join(top_b, [*by, key], "left_semi")
    grouped = shared.groupBy(*by) if by else shared.groupBy()
    return grouped.agg(F.count(F.lit(1)).alias("n_shared"))


def set_algebra(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Ids of the intersection, the differences and the union: ``(key, part)``; one aggregate reads each side once."""
    marked = a.select(key, F.lit(True).alias("_a")).unionByName(b.select(key, F.lit(False).alias("_a")))
    sides = marked.groupBy(key).agg(F.bool_or("_a").alias("_in_a"), F.bool_or(~F.col("_a")).alias("_in_b"))
    own = F.when(F.col("_in_a") & F.col("_in_b"), "intersect").when(F.col("_in_a"), "a_only").otherwise("b_only")
    return sides.select(key, F.explode(F.array(own, F.lit("union"))).alias("part"))


def missing_members(required: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Required ids that are not present; the set is a subset when this is empty."""
    return required.select(key).distinct().join(present.select(key), key, "left_anti")


def partition_violations(parts: DataFrame, whole: DataFrame, key: str) -> DataFrame:
    """Ids not covered exactly once: ``(key, n_parts, problem)``."""
    covered = parts.groupBy(key).agg(F.count(F.lit(1)).alias("n_parts"))
    joined = whole.select(key).distinct().withColumn("_w", F.lit(True)).join(covered, key, "full")
    problem = (
        F.when(F.col("_w").isNull(), "outside_whole")
        .when(F.col("n_parts").isNull(), "not_covered")
        .when(F.col("n_parts") > 1, "in_several_parts")
    )
    out = joined.select(key, F.coalesce("n_parts", F.lit(0)).alias("n_parts"), problem.alias("problem"))
    return out.where(F.col("problem").isNotNull())


def stack_tables(tables: Mapping[str, DataFrame], label: str = "track") -> DataFrame:
    """Row-bind tables with a column that names their origin."""
    out = None
    for name, df in tables.items():
        named = df.withColumn(label, F.lit(name))
        out = named if out is None else out.unionByName(named)
    return out


def venn_table(sets: Sequence[tuple[str, DataFrame]], universe: DataFrame, key: str) -> DataFrame:
    """Cross-classification of a universe by membership in each set, with percentages.

    Memberships are stacked and counted per id in one aggregate, whatever the
    number of sets.
    """
    flags = None
    for name, df in [*sets, ("_all", universe)]:
        rows = df.select(key, *[F.lit(name == other).alias(other) for other, _ in [*sets, ("_all", None)]])
        flags = rows if flags is None else flags.unionByName(rows)
    names = [name for name, _ in sets]
    per_id = flags.groupBy(key).agg(*[F.bool_or(n).alias(n) for n in [*names, "_all"]]).where("_all")
    cells = per_id.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    total = cells.agg(F.sum("n")).scalar()
    return cells.withColumn("pct", F.lit(100.0) * F.col("n") / total)
