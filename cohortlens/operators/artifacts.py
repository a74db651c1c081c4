"""Artifact states, digests, journals, progress and stall rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.ordering import carry_last, previous
from cohortlens.sources.sinks import content_fingerprint


def verify_digests(expected: DataFrame, observed: DataFrame, key: str = "path") -> DataFrame:
    """``(key, state)``: ok, size_mismatch, digest_mismatch, missing or extra."""
    left = expected.select(key, F.col("bytes").alias("_eb"), F.col("sha256").alias("_es"), F.lit(True).alias("_e"))
    right = observed.select(key, F.col("bytes").alias("_ob"), F.col("sha256").alias("_os"), F.lit(True).alias("_o"))
    state = (
        F.when(F.col("_o").isNull(), "missing")
        .when(F.col("_e").isNull(), "extra")
        .when(~F.col("_eb").eqNullSafe(F.col("_ob")), "size_mismatch")
        .when(~F.col("_es").eqNullSafe(F.col("_os")), "digest_mismatch")
        .otherwise("ok")
    )
    return left.join(right, key, "full").select(key, state.alias("state"))


def revalidate(results: DataFrame, recorded: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``(key, valid)`` of each recorded result: whether its rows still have the fingerprint they had.

    ``recorded`` is what ``content_fingerprint`` gave when the results were accepted.
    """
    now = content_fingerprint(results, list(columns), [key])
    lanes = [c for c in now.columns if c != key]
    seen = now.select(key, *[F.col(c).alias(f"_now_{c}") for c in lanes])
    same = F.lit(True)
    for c in lanes:
        same = same & F.col(c).eqNullSafe(F.col(f"_now_{c}"))
    return recorded.join(seen, key, "left").select(key, same.alias("valid"))


def reconcile_artifacts(expected: DataFrame, inventory: DataFrame, evidence: DataFrame, key: str,
                        validity: DataFrame | None = None) -> DataFrame:
    """What to do with each requested run: ``(key, state)``.

    ``expected``: ``size, sha256, config``; ``inventory``: ``has_final, has_work,
    source_size`` and, where the source was read again, ``source_sha256``;
    ``evidence``: ``e_sha256, e_config``; ``validity``: ``valid`` of existing results (:func:`revalidate`).
    A result that fails there is ``INVALID_RESULT``; a source whose digest differs just before
    a run is ``SOURCE_CHECKSUM_MISMATCH``.
    """
    joined = expected.join(inventory, key, "left").join(evidence, key, "left")
    digest_differs, invalid = F.lit(False), F.lit(False)
    if "source_sha256" in inventory.columns:
        digest_differs = ~F.col("source_sha256").eqNullSafe(F.col("sha256"))
    if validity is not None:
        joined = joined.join(validity.select(key, "valid"), key, "left")
        invalid = ~F.coalesce("valid", F.lit(False))
    final = F.coalesce("has_final", F.lit(False))
    work = F.coalesce("has_work", F.lit(False))
    state = (
        F.when(~F.col("source_size").eqNullSafe(F.col("size")), "SOURCE_MUTATED")
        .when(final & F.col("e_sha256").isNull(), "UNVERIFIED_RESULT")
        .when(final & ((F.col("e_sha256") != F.col("sha256")) | ~F.col("e_config").eqNullSafe(F.col("config"))), "PROVENANCE_CONFLICT")
        .when(final & invalid, "INVALID_RESULT")
        .when(final, "VALIDATED_SKIP")
        .when(work, "INTERRUPTED")
        .when(digest_differs, "SOURCE_CHECKSUM_MISMATCH")
        .otherwise("RUN")
    )
    return joined.select(key, state.alias("state"))


def reuse_state(table: DataFrame, policy: str) -> DataFrame:
    """State of an existing download from its data, checksum and marker evidence.

    Columns: ``has_data, has_files, has_manifest, has_marker, marker_policy,
    marker_ok, manifest_ok, content_ok``.
    """
    data, manifest, marker = F.col("has_data"), F.col("has_manifest"), F.col("has_marker")
    both = manifest & marker
    current = F.col("marker_policy").eqNullSafe(F.lit(policy))
    checked = F.col("manifest_ok") & F.col("content_ok")
    state = (
        F.when(~data & (manifest | marker), "integrity_conflict")
        .when(~data, "download")
        .when(both & current & F.col("marker_ok") & F.col("manifest_ok"), "reused")
        .when(both & current, "integrity_conflict")
        .when(both & checked, "migrated")
        .when(both, "integrity_conflict")
        .when(marker, "integrity_conflict")
        .when(manifest & checked, "recovered")
        .when(manifest, "integrity_conflict")
        .when(F.col("has_files") & F.col("content_ok"), "recovered")
        .otherwise("download")
    )
    return table.withColumn("state", state)


def crosscheck_counts(manifest: DataFrame, report: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """Samples whose three read counts disagree or are incomplete."""
    joined = manifest.join(report, key, "left").join(meta, key, "left")
    agree = F.col("spots").eqNullSafe(F.col("report_reads")) & F.col("spots").eqNullSafe(F.col("num_processed"))
    return joined.where(~agree).select(key, "spots", "report_reads", "num_processed")


def stage_progress(items: DataFrame, stage: str = "stage") -> DataFrame:
    """Completed and total items with the status of each stage.

    ``items``: ``ok``, ``running`` and ``failed`` booleans per checklist item.
    """
    sums = items.groupBy(stage).agg(
        F.count_if("ok").alias("completed"), F.count(F.lit(1)).alias("total"),
        F.bool_or("running").alias("_r"), F.bool_or("failed").alias("_f"),
    )
    return with_status(sums).drop("_r", "_f")


def with_status(sums: DataFrame) -> DataFrame:
    status = (
        F.when(F.col("completed") == F.col("total"), "done")
        .when(F.col("_r"), "running")
        .when(F.col("_f") | (F.col("completed") > 0), "attention")
        .otherwise("pending")
    )
    return sums.withColumn("status", status)


FAILED_STATUSES = ("failed", "integrity_conflict", "validation_failed", "metadata_failed")


def run_report(journal: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Requested, succeeded and failed entries with attempts and duration."""
    bad = F.col("status").isin(*FAILED_STATUSES)
    grouped = journal.groupBy(*by) if by else journal.groupBy()
    return grouped.agg(
        F.count(F.lit(1)).alias("requested"),
        F.count_if(~bad).alias("succeeded"),
        F.count_if(bad).alias("failed"),
        F.sum("attempts").alias("attempts"),
        F.max("duration_seconds").alias("longest_seconds"),
    )


def failed_runs(journal: DataFrame) -> DataFrame:
    """The failed ids as rows, not as one list, so the report can be of any length."""
    return journal.where(F.col("status").isin(*FAILED_STATUSES)).select("accession").distinct()


def stall_gaps(progress: DataFrame, run: str, ts: str, size: str, timeout_seconds: int,
               tiebreak: str, chunk_seconds: int = 86_400) -> DataFrame:
    """Observations with the seconds since the size last changed and a stall flag.

    Each run is cut into time chunks, so a run with very many observations does
    not meet in one task; the last size and last change cross the borders.
    """
    seconds = F.unix_micros(F.col(ts)) / F.lit(1e6)
    rows = progress.withColumn("_chunk", F.floor(seconds / chunk_seconds)).withColumn("_s", seconds)
    seen = previous(rows, [run], "_chunk", ["_s", tiebreak], size, "_prev")
    change = F.when(F.col("_prev").isNull() | (F.col(size) != F.col("_prev")), F.col("_s"))
    grown = carry_last(seen, [run], "_chunk", ["_s", tiebreak], change, "_grown")
    return grown.withColumn("idle_seconds", F.col("_s") - F.col("_grown")).withColumn(
        "stalled", F.col("idle_seconds") >= timeout_seconds
    ).drop("_chunk", "_s", "_prev", "_grown")


def size_changes(progress: DataFrame, run: str, ts: str, size: str, tiebreak: str, chunk_seconds: int = 86_400) -> DataFrame:
    """Only the observations at which the size changed (the first one counts)."""
    seconds = F.unix_micros(F.col(ts)) / F.lit(1e6)
    rows = progress.withColumn("_chunk", F.floor(seconds / chunk_seconds))
    seen = previous(rows, [run], "_chunk", [ts, tiebreak], size, "_prev")
    return seen.where(F.col("_prev").isNull() | (F.col(size) != F.col("_prev"))).drop("_chunk", "_prev")
