"""Validation gates: every rule is a query that returns its violating rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import compare
from cohortlens.operators.manifest import duplicate_keys, pair_integrity, pattern_violations, violation

SEVERITIES = ("INFO", "REVIEW_REQUIRED", "BLOCKER")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class ManifestContract:
    """Cohort contract; column names are those of the manifest."""

    run_column: str = "run"
    run_pattern: str = r"SRR\d+"
    sample_pattern: str = r"GSM\d+"
    unique_columns: tuple[str, ...] = ("gsm", "title", "run")
    required: tuple[str, ...] = ("gsm", "title", "run", "patient_id", "analysis_group", "paper_final_set",
                                 "paper_group", "paper_exclusion_reason", "pair_sensitivity", "library_layout")
    layout: str = "SINGLE"
    pair_groups: tuple[str, str] = ("pca_tumor", "pca_adjacent_normal")
    n_rows: int | None = None
    group_sizes: Mapping[str, int] = field(default_factory=dict)
    n_sensitivity: int | None = None
    n_pairs: int | None = None


def check_manifest(df: DataFrame, contract: ManifestContract) -> DataFrame:
    """All broken rules of the cohort contract: ``(rule, severity, key, detail)``."""
    missing = sorted(set(contract.required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing manifest columns: {missing}")
    c = F.col
    final, sensitive = c("paper_final_set"), c("pair_sensitivity")
    text = lambda name: F.coalesce(c(name).cast("string"), F.lit(""))
    not_yes_no = lambda col: ~F.coalesce(col.isin("yes", "no"), F.lit(False))
    # All row rules in one pass over the manifest: (rule, broken, detail column).
    rules = [
        ("run_pattern", ~text(contract.run_column).rlike(f"^(?:{contract.run_pattern})$"), contract.run_column),
        ("gsm_pattern", ~text("gsm").rlike(f"^(?:{contract.sample_pattern})$"), "gsm"),
        # A ragged line leaves a required column without a value.
        ("malformed_row", reduce(lambda a, b: a | b, [c(name).isNull() for name in contract.required]), "gsm"),
        ("layout", ~c("library_layout").eqNullSafe(F.lit(contract.layout)), "library_layout"),
        ("final_set_value", not_yes_no(final), "paper_final_set"),
        ("sensitivity_value", not_yes_no(sensitive), "pair_sensitivity"),
        ("exclusion_provenance",
         (final == "no") & ((c("paper_group") != "excluded") | (text("paper_exclusion_reason") == "")), "paper_exclusion_reason"),
        ("sensitivity_within_final", (sensitive == "yes") & (final != "yes"), "paper_final_set"),
        ("patient_missing", (sensitive == "yes") & (text("patient_id") == ""), contract.run_column),
    ]
    broken = F.array_compact(F.array(*[
        F.when(F.coalesce(bad, F.lit(True)), F.struct(F.lit(rule).alias("rule"), text(detail).alias("detail")))
        for rule, bad, detail in rules
    ]))
    rows = df.select(text(contract.run_column).alias("key"), F.explode(broken).alias("v")).select(
        "v.rule", F.lit("BLOCKER").alias("severity"), "key", "v.detail")
    dup = violation(duplicate_keys(df, list(contract.unique_columns)), "unique_id", F.concat_ws("=", "column", "value"), "n")
    pairs = violation(pair_integrity(df.where(sensitive == "yes"), "patient_id", "analysis_group", *contract.pair_groups),
                      "pair", "patient_id", F.concat_ws("/", "n_a", "n_b"))
    # All size rules from one aggregate.
    sizes: list[tuple[str, F.Column, int | None]] = [
        ("row_count", F.count(F.lit(1)), contract.n_rows),
        ("sensitivity_count", F.count_if(sensitive == "yes"), contract.n_sensitivity),
        ("pair_count", F.count_distinct(F.when(sensitive == "yes", c("patient_id"))), contract.n_pairs),
        *[(f"group_size_{g}", F.count_if((final == "yes") & (c("paper_group") == g)), n) for g, n in contract.group_sizes.items()],
    ]
    wanted = [(rule, agg, n) for rule, agg, n in sizes if n is not None]
    if not wanted:
        return union_all([rows, dup, pairs])
    counted = df.agg(*[agg.alias(rule) for rule, agg, _ in wanted]).select(F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.col(rule).cast("long").alias("n"), F.lit(n).cast("long").alias("want"))
        for rule, _, n in wanted
    ])).alias("s")).select("s.*").where(F.col("n") != F.col("want"))
    return union_all([rows, dup, pairs, violation(counted, F.col("rule"), "rule", "n")])


def check_reference(transcripts: DataFrame, decoys: DataFrame, combined: DataFrame, mapping: DataFrame,
                    edges: DataFrame, id_pattern: str) -> DataFrame:
    """Reference consistency: order, disjointness, map coverage, id pattern, duplicate edges.

    Name lists have ``(ordinal, name)``; the combined list must be the transcripts
    followed by the decoys.
    """
    n = transcripts.agg(F.count(F.lit(1))).scalar()
    shifted = decoys.select((F.col("ordinal") + n).alias("ordinal"), "name")
    chained = transcripts.select("ordinal", "name").unionByName(shifted)
    names = transcripts.select(F.col("name").alias("feature_id"))
    ends = edges.select(F.explode(F.array("retained", "duplicate")).alias("feature_id")).distinct()
    return union_all([
        violation(compare.ordered_mismatches(combined, chained, "ordinal", "name"), "combined_order", "ordinal",
                  F.concat_ws("<>", "left_value", "right_value")),
        violation(compare.shared_ids(transcripts, decoys, "name"), "decoy_clash", "name", "name"),
        violation(duplicate_keys(transcripts, ["name"]), "duplicate_name", "value", "n"),
        violation(compare.unmatched_keys(names, mapping, "feature_id"), "map_coverage", "feature_id", "side"),
        violation(pattern_violations(mapping.select("gene_id").distinct(), "gene_id", id_pattern), "group_pattern", "gene_id", "gene_id"),
        violation(compare.missing_members(ends, mapping, "feature_id"), "edge_unmapped", "feature_id", "feature_id"),
    ])


def check_matrix(genes: DataFrame, mapping: DataFrame, measures: Sequence[str] = ("count", "tpm", "length")) -> DataFrame:
    """Non-finite or negative cells, genes outside the map, and map groups without a row."""
    cells = genes.select(
        F.concat_ws("/", "gene_id", "sample_id").alias("cell"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("v")) for m in measures])).alias("c"),
    ).select("cell", "c.*")
    bad = cells.where(F.col("v").isNull() | F.isnan("v") | (F.abs("v") == F.lit(float("inf"))) | (F.col("v") < 0))
    return union_all([
        violation(bad, "cell_value", "cell", "measure"),
        violation(compare.unmatched_keys(genes, mapping, "gene_id"), "gene_set", "gene_id", "side"),
    ])


def gate_status(violations: DataFrame, acceptance: DataFrame, stages: DataFrame) -> DataFrame:
    """Worst severity per stage and whether the next stage may start.

    A stage is open when it has no blocker and an explicit acceptance record.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severity"))
    worst = violations.groupBy("stage").agg(F.max(rank).alias("_r"), F.count(F.lit(1)).alias("n_violations"))
    joined = stages.join(worst, "stage", "left").join(acceptance.select("stage", "accepted"), "stage", "left")
    name = F.when(F.col("_r").isNull(), "NONE").otherwise(
        F.try_element_at(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("_r").cast("int")))
    accepted = F.coalesce("accepted", F.lit(False))
    return joined.select(
        "stage", name.alias("worst"), F.coalesce("n_violations", F.lit(0)).alias("n_violations"),
        accepted.alias("accepted"), (accepted & ~F.coalesce(F.col("_r") == 3, F.lit(False))).alias("may_proceed"),
    )


RESULT_COLUMNS = ("gene_id", "base_mean", "lfc", "lfc_se", "stat", "pvalue", "padj", "tested", "significant")


def check_result_table(result: DataFrame, tested: DataFrame, columns: Sequence[str] = RESULT_COLUMNS) -> DataFrame:
    """Required columns (checked at once), tested genes that were lost, and broken flags."""
    missing = sorted(set(columns) - set(result.columns))
    if missing:
        raise ValueError(f"Missing result columns: {missing}")
    flags = result.where(
        (F.col("tested") != F.col("pvalue").isNotNull())
        | (F.col("significant") != (F.col("padj").isNotNull() & (F.col("padj") < 0.05)))
    )
    order = result.where(F.col("padj").isNotNull() & (F.col("padj") < F.col("pvalue")))
    return union_all([
        violation(compare.missing_members(tested, result, "gene_id"), "gene_lost", "gene_id", "gene_id"),
        violation(duplicate_keys(result, ["gene_id"]), "duplicate_gene", "value", "n"),
        violation(flags, "flag", "gene_id", F.lit("tested/significant")),
        violation(order, "padj_below_p", "gene_id", "padj"),
    ])


def uniform_per_analysis(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Analyses that mix several values of a setting: ``(key, setting, n_values)``."""
    cells = df.select(key, F.explode(F.array(*[
        F.struct(F.lit(c).alias("setting"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("c")).select(key, "c.*").distinct()
    return cells.groupBy(key, "setting").agg(F.count("value").alias("n_values")).where(F.col("n_values") > 1)


def compare_records(a: DataFrame, b: DataFrame, key: str, rules: Mapping[str, str], constants: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Field-by-field check of two records per key: ``(key, field, rule, ok)``.

    ``rules`` maps a field to ``equal`` or ``different``; ``constants`` maps a
    field to the two values expected on either side.
    """
    constants = constants or {}
    fields = [*rules, *[f for f in constants if f not in rules]]

    def cells(df: DataFrame, out: str) -> DataFrame:
        return df.select(key, F.explode(F.array(*[
            F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias(out)) for f in fields
        ])).alias("c")).select(key, "c.*")

    joined = cells(a, "_a").join(cells(b, "_b"), [key, "field"], "full")
    same = F.col("_a").eqNullSafe(F.col("_b"))
    checks = [
        F.struct(F.lit(f).alias("field"), F.lit(r).alias("rule"), (same if r == "equal" else ~same).alias("ok"))
        for f, r in rules.items()
    ] + [
        F.struct(F.lit(f).alias("field"), F.lit("constant").alias("rule"),
                 (F.col("_a").eqNullSafe(F.lit(x)) & F.col("_b").eqNullSafe(F.lit(y))).alias("ok"))
        for f, (x, y) in constants.items()
    ]
    exploded = joined.withColumn("k", F.explode(F.array(*checks))).where(F.col("k.field") == F.col("field"))
    return exploded.select(key, "field", "k.rule", "k.ok")
