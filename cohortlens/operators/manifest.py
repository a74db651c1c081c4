"""Sample and cohort manifest: classification, membership, pairing, run lookup, checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.ordering import keep_last

# Violations of every check have these columns.
VIOLATION = ["rule", "severity", "key", "detail"]


def classify(df: DataFrame, rules: Sequence[tuple[Column, str]], out: str, default: str = "unclassified") -> DataFrame:
    """Label of the first rule that holds."""
    label = None
    for condition, name in rules:
        label = F.when(condition, name) if label is None else label.when(condition, name)
    return df.withColumn(out, label.otherwise(default))


def classify_by_table(df: DataFrame, rules: DataFrame, on: list[str], label: str, default: str = "unclassified") -> DataFrame:
    """The same with the rules in a table, unique on ``on``."""
    return df.join(rules, on, "left").withColumn(label, F.coalesce(F.col(label), F.lit(default)))


def membership_group(df: DataFrame, members: DataFrame, key: str, group: str, flag: str, default: str = "excluded") -> DataFrame:
    """Group of a key from a membership table ``(key, group)`` and a yes/no flag for members."""
    joined = df.join(members.select(key, group), key, "left")
    return joined.withColumn(flag, F.when(F.col(group).isNotNull(), "yes").otherwise("no")).withColumn(
        group, F.coalesce(F.col(group), F.lit(default))
    )


def lookup_default(df: DataFrame, table: DataFrame, key: str, value: str, default: str = "") -> DataFrame:
    return df.join(table.select(key, value), key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def review_flags(df: DataFrame, rules: Sequence[tuple[Column, str]], out: str = "review_flag") -> DataFrame:
    """Messages of all rules that hold, in rule order."""
    return df.withColumn(out, F.concat_ws("; ", *[F.when(condition, message) for condition, message in rules]))


def cohort_subset(manifest: DataFrame, flag: str) -> DataFrame:
    return manifest.where(F.col(flag) == "yes")


def attach_runs(records: DataFrame, runs: DataFrame, key: str, position: str, fields: Sequence[str], matched: str = "run_found") -> DataFrame:
    """Left join to the last run per key; absent text becomes ``""`` and a flag says whether a run was found."""
    last = keep_last(runs.select(key, position, *fields), [key], position).drop(position)
    joined = records.join(last.withColumn(matched, F.lit(True)), key, "left")
    texts = {f: F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields}
    return joined.withColumns({**texts, matched: F.coalesce(F.col(matched), F.lit(False))})


def order_as(df: DataFrame, order: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Rows in the order of an id list; rows outside the list are dropped."""
    return df.join(order.select(key, ordinal), key).orderBy(ordinal)


def group_counts(df: DataFrame, column: str, levels: Sequence[str] | None = None) -> DataFrame:
    """Rows per value; with a level list, absent levels count zero."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if levels is None:
        return counts
    spark = df.sparkSession
    wanted = spark.createDataFrame([(v,) for v in levels], f"{column} string")
    return wanted.join(counts, column, "full").withColumn("n", F.coalesce("n", F.lit(0)))


def set_per_key(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Sorted distinct values per key; bounded by the number of classes."""
    distinct = df.select(key, value).distinct()
    return distinct.groupBy(key).agg(F.array_sort(F.collect_list(value)).alias(out))


def pair_status(df: DataFrame, key: str, group: str, pairs: Sequence[tuple[str, str]], sensitive: int, in_final: str) -> DataFrame:
    """``pair_status`` and ``pair_sensitivity`` per row.

    ``pairs`` lists the two classes that make a pair; a key is paired when both
    occur.  Members of ``pairs[sensitive]`` that are paired and in the final set
    get ``yes``.  Presence flags are aggregated per key and joined back, so a hot
    key is combined before the shuffle.
    """
    present = df.groupBy(key).agg(*[
        (F.max((F.col(group) == a).cast("int")) + F.max((F.col(group) == b).cast("int")) == 2).alias(f"_p{i}")
        for i, (a, b) in enumerate(pairs)
    ])
    status = F.lit("unclassified")
    for i, (a, b) in enumerate(pairs):
        status = F.when(F.col(group).isin(a, b), F.when(F.col(f"_p{i}"), "paired").otherwise("unpaired")).otherwise(status)
    a, b = pairs[sensitive]
    yes = F.col(group).isin(a, b) & F.col(f"_p{sensitive}") & (F.col(in_final) == "yes")
    return (
        df.join(present, key, "left")
        .withColumn("pair_status", status)
        .withColumn("pair_sensitivity", F.when(yes, "yes").otherwise("no"))
        .drop(*[f"_p{i}" for i in range(len(pairs))])
    )


def pair_integrity(df: DataFrame, key: str, group: str, a: str, b: str) -> DataFrame:
    """Keys that do not have exactly one row of each class and nothing else."""
    return df.groupBy(key).agg(
        F.count_if(F.col(group) == a).alias("n_a"),
        F.count_if(F.col(group) == b).alias("n_b"),
        F.count(F.lit(1)).alias("n_rows"),
    ).where((F.col("n_a") != 1) | (F.col("n_b") != 1) | (F.col("n_rows") != 2))


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empty or repeated values: ``(column, value, n)`` over all the given columns."""
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("c")).select("c.*")
    counts = cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.col("n") > 1) | F.col("value").isNull() | (F.col("value") == ""))


def cohort_totals(df: DataFrame, size: str, flags: Mapping[str, Column]) -> DataFrame:
    """Row count, summed size (missing or unparsable counts 0) and rows per named condition."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.coalesce(F.col(size).try_cast("long"), F.lit(0))).alias("total_size"),
        *[F.count_if(c).alias(name) for name, c in flags.items()],
    )


def pattern_violations(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose value does not match the whole pattern."""
    return df.where(~F.coalesce(F.col(column), F.lit("")).rlike(f"^(?:{pattern})$"))


def exactly_one(names: DataFrame, name: str, df: DataFrame, key: str) -> DataFrame:
    """Requested names that match no row or several: ``(name, n)``."""
    hits = df.groupBy(F.col(key).alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return names.join(hits, name, "left").select(name, F.coalesce("n", F.lit(0)).alias("n")).where(F.col("n") != 1)


def violation(df: DataFrame, rule: str | Column, key: Column | str, detail: Column | str, severity: str = "BLOCKER") -> DataFrame:
    """Rows in the violation schema; ``rule`` is a name or a column that holds it."""
    as_text = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    return df.select((F.lit(rule) if isinstance(rule, str) else rule).alias("rule"), F.lit(severity).alias("severity"),
                     as_text(key).alias("key"), as_text(detail).alias("detail"))


def quant_manifest(samples: DataFrame, config: DataFrame, evidence: DataFrame, sample: str = "sample_id",
                   config_key: str = "config_id") -> DataFrame:
    """One row per sample with its configuration, output state, warnings and exclusion.

    ``samples`` names the configuration it uses; ``evidence`` holds
    ``output_path, validated, n_warnings`` where a quantification ran.
    """
    joined = samples.join(config, config_key, "left").join(evidence, sample, "left")
    state = (
        F.when(F.col("excluded"), "excluded")
        .when(F.col("validated").isNull(), "not_run")
        .when(~F.col("validated"), "failed")
        .when(F.col("n_warnings") > 0, "complete_with_warnings")
        .otherwise("complete")
    )
    return joined.withColumn("state", state)
