"""Sample-level QC: Gram matrix, distances, PCA, distance ranks, influence counts."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.operators.compare import spearman
from cohortlens.operators.ordering import exact_median, running_total, with_ranks
from cohortlens.session import materialise

# Samples per Gram block: a task keeps one block of 2,048 x 2,048 doubles (32 MB).
SAMPLES_PER_BLOCK = 2_048
# Feature rows that a task turns into dense matrices at once.
FEATURES_PER_STEP = 1_024
# Cells that one task of a Gram product reads, counting a cell once for each block it meets.
CELLS_PER_TASK = 4_000_000


def sample_index(long: DataFrame, sample: str) -> DataFrame:
    """Dense 0-based index of the distinct samples."""
    ids = long.select(sample).distinct()
    keyed = ids.withColumn("chunk", F.substring(F.sha2(F.col(sample).cast("string"), 256), 1, 2))
    numbered = running_total(keyed, [], "chunk", [sample], F.lit(1), "_i")
    return numbered.select(sample, (F.col("_i") - 1).cast("int").alias("idx"))


def _dense(cells: pd.Series, first: int, width: int) -> np.ndarray:
    """Rows of (index, value) cells of one block of samples as a dense matrix."""
    x = np.zeros((len(cells), width))
    for row, entries in enumerate(cells):
        x[row, np.asarray(entries["idx"], dtype=int) - first] = entries["v"]
    return x


def _block_products(block: int):
    """Sums of feature-row products of each block pair; rows come sorted by pair and feature, both sides of a feature together."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair, total = None, np.zeros((0, 0))
        for batch in batches:
            for (bi, bj), rows in batch.groupby(["bi", "bj"], sort=True):
                if (bi, bj) != pair:
                    yield from _entries(pair, total, block)
                    pair, total = (bi, bj), np.zeros((block, block))
                for at in range(0, len(rows), FEATURES_PER_STEP):
                    step = rows.iloc[at:at + FEATURES_PER_STEP]
                    left = _dense(step["left"], bi * block, block)
                    total += left.T @ (left if bi == bj else _dense(step["right"], bj * block, block))
        yield from _entries(pair, total, block)

    return run


def _entries(pair: tuple[int, int] | None, total: np.ndarray, block: int) -> Iterator[pd.DataFrame]:
    if pair is None:
        return
    keep = np.triu(np.ones(total.shape, dtype=bool)) if pair[0] == pair[1] else np.ones(total.shape, dtype=bool)
    i, j = np.nonzero(keep)
    yield pd.DataFrame({"i": i + pair[0] * block, "j": j + pair[1] * block, "v": total[i, j]})


def gram(long: DataFrame, feature: str, sample: str, value: str, samples_per_block: int = SAMPLES_PER_BLOCK) -> DataFrame:
    """``sum over features of x_i * x_j`` for every sample pair ``i <= j``; absent cells count zero.

    Samples are cut into blocks, and a feature's cells of one block are one row.  With B
    blocks a row is sent to the B block pairs that its block is part of, and meets the
    other block's row of the same feature there by a join.  A task works on one pair at
    a time and keeps one matrix; the number of tasks grows with the rows that are sent, so a
    pair with many features is shared by several, whose matrices a second shuffle sums.
    A self-join of cells would instead emit every sample pair of every feature.
    """
    index = materialise(sample_index(long, sample))
    n = index.count()
    width = max(1, min(n, samples_per_block))
    blocks = max(1, -(-n // width))
    placed = long.join(index, sample).withColumn("b", F.floor(F.col("idx") / width).cast("int"))
    rows = placed.groupBy(feature, *(["b"] if blocks > 1 else [])).agg(
        F.sort_array(F.collect_list(F.struct("idx", F.col(value).cast("double").alias("v")))).alias("_c")
    )
    cells = F.struct(F.col("_c.idx").alias("idx"), F.col("_c.v").alias("v"))
    if blocks == 1:
        # One block: the rows are multiplied where the grouping left them.
        zero = F.lit(0).cast("int")
        ready = rows.select(zero.alias("bi"), zero.alias("bj"), cells.alias("left"), F.lit(None).cast("struct<idx: array<int>, v: array<double>>").alias("right"))
    else:
        rows = rows.select(feature, "b", cells.alias("cells"))
        other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        sent = rows.withColumn("other", other).select(
            feature, F.least("b", "other").alias("bi"), F.greatest("b", "other").alias("bj"), "b", "cells")
        # Both sides of (feature, pair) in one row; a feature without cells in one of the blocks adds nothing.
        joined = sent.groupBy(feature, "bi", "bj").agg(
            F.max(F.when(F.col("b") == F.col("bi"), F.col("cells"))).alias("left"),
            F.max(F.when(F.col("b") == F.col("bj"), F.col("cells"))).alias("right"),
        ).where(F.col("left").isNotNull() & F.col("right").isNotNull())
        spark = long.sparkSession
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-long.count() * blocks // CELLS_PER_TASK))
        slices = max(1, -(-tasks * 2 // (blocks * (blocks + 1))))
        ready = joined.repartition(tasks, "bi", "bj", F.pmod(F.xxhash64(feature), F.lit(slices))).sortWithinPartitions("bi", "bj").select(
            "bi", "bj", "left", "right")
    parts = ready.mapInPandas(_block_products(width), "i long, j long, v double")
    sums = parts.where((F.col("i") < n) & (F.col("j") < n)).groupBy("i", "j").agg(F.sum("v").alias("dot"))
    names = lambda side, out: index.select(F.col("idx").cast("long").alias(side), F.col(sample).alias(out))
    return sums.join(names("i", "sample_i"), "i").join(names("j", "sample_j"), "j").select(
        "sample_i", "sample_j", "dot"
    )


def centre_by_feature(long: DataFrame, feature: str, sample: str, value: str) -> DataFrame:
    """Values less their feature mean, checkpointed; a feature has one row per sample."""
    mean = F.avg(value).over(Window.partitionBy(feature))
    return materialise(long.select(feature, sample, (F.col(value) - mean).alias("_c")))


def pairwise_samples(long: DataFrame, feature: str, sample: str) -> DataFrame:
    """Number of shared features of each sample pair ``s1 < s2``."""
    present = long.select(feature, sample).distinct().withColumn("_one", F.lit(1.0))
    pairs = gram(present, feature, sample, "_one").where(F.col("sample_i") != F.col("sample_j"))
    first, second = F.least("sample_i", "sample_j"), F.greatest("sample_i", "sample_j")
    return pairs.select(first.alias("s1"), second.alias("s2"), F.round("dot").cast("long").alias("n_shared"))


def sample_distances(long: DataFrame, feature: str, sample: str, value: str) -> DataFrame:
    """Euclidean distance of each sample pair ``s1 < s2`` from the Gram matrix.

    Values are centred per feature first, which leaves distances unchanged and
    avoids cancellation.
    """
    dots = materialise(gram(centre_by_feature(long, feature, sample, value), feature, sample, "_c"))
    own = dots.where(F.col("sample_i") == F.col("sample_j"))
    norm = lambda side, out: own.select(F.col("sample_i").alias(side), F.col("dot").alias(out))
    pairs = dots.where(F.col("sample_i") != F.col("sample_j")).join(norm("sample_i", "_ni"), "sample_i").join(
        norm("sample_j", "_nj"), "sample_j"
    )
    squared = F.col("_ni") + F.col("_nj") - 2 * F.col("dot")
    return pairs.select(
        F.least("sample_i", "sample_j").alias("s1"), F.greatest("sample_i", "sample_j").alias("s2"),
        F.sqrt(F.greatest(squared, F.lit(0.0))).alias("distance"),
    )


def sample_pca(long: DataFrame, feature: str, sample: str, value: str, k: int = 2) -> DataFrame:
    """Centred, unscaled PCA of samples: ``(sample, pc_1..pc_k, var_1..var_k)``.

    One method at every size.  The Gram matrix of the samples stays a table; its
    leading eigenvectors come from :func:`leading_axes`, in which every product with it is a
    join and an aggregate.  Axes beyond the rank of the data have score and share 0.
    """
    dots = materialise(gram(centre_by_feature(long, feature, sample, value), feature, sample, "_c"))
    values, vectors = leading_axes(dots, k)
    total = dots.where(F.col("sample_i") == F.col("sample_j")).agg(F.sum("dot")).first()[0] or 0.0
    score = lambda c: F.col("_v")[c] * float(np.sqrt(max(values[c], 0.0))) if c < len(values) else F.lit(0.0)
    scores = vectors.select(F.col("_s").alias(sample), *[score(c).alias(f"pc_{c + 1}") for c in range(k)])
    # Each axis is oriented so that its largest absolute score is positive.
    ends = scores.agg(*[F.max_by(f"pc_{c + 1}", F.struct(F.abs(f"pc_{c + 1}"), F.col(sample))).alias(f"e{c}") for c in range(k)]).first()
    turn = lambda c: -1.0 if (ends[f"e{c}"] or 0.0) < 0 else 1.0
    share = lambda c: F.lit(float(values[c] / total) if c < len(values) and total > 0 else 0.0)
    return scores.select(sample, *[(F.col(f"pc_{c + 1}") * turn(c)).alias(f"pc_{c + 1}") for c in range(k)],
                         *[share(c).alias(f"var_{c + 1}") for c in range(k)])


# Columns of the basis before a restart, and products with the matrix before giving up.
LARGEST_BASIS = 96
MOST_PRODUCTS = 200


def leading_axes(dots: DataFrame, k: int, tol: float = 1e-10, extra: int = 14, most: int = MOST_PRODUCTS) -> tuple[np.ndarray, DataFrame]:
    """Largest ``k`` eigenvalues of the symmetric matrix ``(sample_i, sample_j, dot)`` (i <= j) and vectors ``(_s, _v array)``.

    Block Krylov subspaces with Rayleigh-Ritz steps: a block of vectors is multiplied by
    the matrix, made orthogonal to the basis (twice) and to itself, and joins it.  A
    direction is dropped when nothing of it is left after that (its rank is used up), so
    matrices of rank 1, or of less than ``k``, need no special care.  The basis is
    a table with one array per sample; the driver sees only its small inner products.
    When the basis is full, it is cut to the best vectors.  The method ends when the residuals
    ``|G v - lambda v|`` of all wanted axes are below ``tol`` times the largest eigenvalue, and
    raises after ``most`` products without that.
    """
    upper = dots.select(F.col("sample_i").alias("_a"), F.col("sample_j").alias("_b"), "dot")
    matrix = materialise(upper.unionByName(upper.where("_a != _b").select(F.col("_b").alias("_a"), F.col("_a").alias("_b"), "dot")))
    width = k + extra
    seed = lambda c: F.pmod(F.xxhash64(F.col("_s").cast("string"), F.lit(c)), F.lit(2_000_003)) / 1_000_001.5 - 1
    start = matrix.select(F.col("_a").alias("_s")).distinct().select("_s", F.array(*[seed(c) for c in range(width)]).alias("_y"))
    basis = start.select("_s", F.array().cast("array<double>").alias("_q"), "_y")
    scale = float(np.sqrt(matrix.agg(F.sum(F.col("dot") * F.col("dot"))).first()[0] or 0.0))
    if scale == 0.0:
        return np.zeros(0), basis.select("_s", F.col("_q").alias("_v"))
    wide, floor = width, 1.0
    projected, size, residual = np.zeros((0, 0)), 0, np.zeros(0)
    for _ in range(most):
        # Y less its part in Q, twice; the second part is tiny, so what is left of Y needs no third pass.
        used = np.zeros((size, width))
        for _again in range(2):
            inner = _inner_products(basis, size + width)
            part = inner[:size, size:]
            used += part
            basis = basis.select("_s", "_q", _less(F.col("_q"), F.col("_y"), part).alias("_y"))
        own = inner[size:, size:] - part.T @ part
        own = (own + own.T) / 2
        weight, turn = np.linalg.eigh(own)
        fresh = weight > (1e-10 * floor) ** 2
        if size:
            # Y is the matrix times the last block, so these columns of the projected matrix are known now.
            at = size - width
            projected[:, at:] = used
            projected[at:, :] = projected[:, at:].T
            values, inside = np.linalg.eigh((projected + projected.T) / 2)
            values, inside = values[::-1], inside[:, ::-1]
            residual = np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", inside[at:], own, inside[at:]), 0.0))
            top = min(k, size)
            if not fresh.any() or (size >= k and (residual[:top] <= tol * abs(values[0])).all()):
                kept = [c for c in range(top) if values[c] > 1e-12 * values[0]]
                return values[kept], materialise(basis.select("_s", _times(F.col("_q"), inside[:, kept]).alias("_v")))
            if size + width > LARGEST_BASIS:
                basis = basis.select("_s", _times(F.col("_q"), inside[:, :wide]).alias("_q"), "_y")
                projected, size = np.diag(values[:wide]), min(wide, size)
        directions = turn[:, fresh] / np.sqrt(weight[fresh])
        width, floor = directions.shape[1], scale
        grown = basis.select("_s", F.concat("_q", _times(F.col("_y"), directions)).alias("_q"))
        padded = np.zeros((size + width, size + width))
        padded[:size, :size] = projected
        projected, size = padded, size + width
        block = [F.col("_q")[size - width + c].alias(f"_x{c}") for c in range(width)]
        product = matrix.join(grown.select(F.col("_s").alias("_b"), *block), "_b").groupBy("_a").agg(
            *[F.sum(F.col("dot") * F.col(f"_x{c}")).alias(f"_x{c}") for c in range(width)])
        columns = F.array(*[F.col(f"_x{c}") for c in range(width)])
        basis = materialise(grown.join(product.select(F.col("_a").alias("_s"), columns.alias("_y")), "_s"))
    raise RuntimeError(f"Eigenvectors did not converge in {most} products; residuals {residual[:k].tolist()}")


def _inner_products(basis: DataFrame, width: int) -> np.ndarray:
    """Inner products of all columns of ``_q`` and ``_y``, summed per task first."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for batch in batches:
            if len(batch):
                x = np.stack([np.concatenate([q, y]) for q, y in zip(batch["_q"], batch["_y"], strict=True)])
                total += x.T @ x
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})

    sums = basis.select("_q", "_y").mapInPandas(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((width, width))
    for r in sums:
        out[r["i"], r["j"]] = r["v"]
    return out


def _times(row: Column, m: np.ndarray) -> Column:
    """Product of an array with a small matrix, which goes along as one literal."""
    if not m.shape[0] or not m.shape[1]:
        return F.array_repeat(F.lit(0.0), m.shape[1])
    columns = F.from_json(F.lit(json.dumps(m.T.tolist())), "array<array<double>>")
    return F.transform(columns, lambda c: F.aggregate(F.zip_with(row, c, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x))


def _less(q: Column, y: Column, part: np.ndarray) -> Column:
    """``y`` less the combination of ``q``."""
    return F.zip_with(y, _times(q, part), lambda a, b: a - b) if part.shape[0] else y


def axis_residuals(dots: DataFrame, values: np.ndarray, vectors: DataFrame) -> DataFrame:
    """axis, total_variance, residual: the length of ``G v - lambda v`` as a share of the total variance."""
    full = dots.unionByName(dots.where(F.col("sample_i") != F.col("sample_j")).select(
        F.col("sample_j").alias("sample_i"), F.col("sample_i").alias("sample_j"), "dot"))
    entries = vectors.select("_s", F.posexplode("_v").alias("_axis", "_x"))
    product = full.join(entries, F.col("sample_j") == F.col("_s")).groupBy("_axis", F.col("sample_i").alias("_s")).agg(F.sum(F.col("dot") * F.col("_x")).alias("_gx"))
    value = F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("_axis") + 1)
    off = product.join(entries, ["_axis", "_s"]).withColumn("_off", F.col("_gx") - value * F.col("_x"))
    total = dots.where(F.col("sample_i") == F.col("sample_j")).agg(F.sum("dot").alias("t")).select("t").scalar()
    return off.groupBy((F.col("_axis") + 1).alias("axis")).agg(F.sqrt(F.sum(F.col("_off") * F.col("_off"))).alias("_r")).select(
        "axis", total.alias("total_variance"), (F.col("_r") / total).alias("residual"))


def distance_rank(points: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """Distance from the median centre of the group and its descending minimum rank."""
    center = exact_median(points, x, by, "_cx").join(exact_median(points, y, by, "_cy"), by)
    spread = points.join(center, by).withColumn(
        "center_distance",
        F.sqrt((F.col(x) - F.col("_cx")) * (F.col(x) - F.col("_cx")) + (F.col(y) - F.col("_cy")) * (F.col(y) - F.col("_cy"))),
    ).drop("_cx", "_cy")
    return with_ranks(spread, "center_distance", by, low="distance_rank", descending=True)


def join_sample_qc(points: DataFrame, metrics: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    return points.join(metrics, key).join(extra, key)


#: Report measures of the sample table: key in the report, column, type.
QC_MEASURES = (("Total Sequences", "reads", "long"), ("Sequence length", "read_length_range", "string"),
               ("Total Deduplicated Percentage", "deduplicated_pct", "double"))


def sample_qc_table(manifest: DataFrame, values: DataFrame, status: DataFrame, rates: DataFrame, run: str = "run") -> DataFrame:
    """One row per sample of the manifest: its columns, report measures, module states, mapping rates.

    ``values``: ``run, key, value`` of the reports; ``status``: one column per module;
    ``rates``: ``pct_mapped, pct_decoy, num_mapped, num_processed``.  A missing report or
    run leaves nulls (module states ``unknown``); ``counts_agree`` tells whether manifest
    (``spots``), report and run metadata have one number of reads.
    """
    pick = lambda key, name, kind: F.max(F.when(F.col("key") == key, F.col("value"))).try_cast(kind).alias(name)
    measures = values.groupBy(run).agg(*[pick(*m) for m in QC_MEASURES])
    modules = [c for c in status.columns if c != run]
    rows = manifest.join(measures, run, "left").join(status, run, "left").join(
        rates.select(run, "pct_mapped", "pct_decoy", "num_mapped", "num_processed"), run, "left")
    agree = F.col("spots").eqNullSafe(F.col("reads")) & F.col("spots").eqNullSafe(F.col("num_processed"))
    return rows.withColumns({m: F.coalesce(m, F.lit("unknown")) for m in modules}).withColumn("counts_agree", agree).drop("num_processed")


def unjoined_samples(points: DataFrame, joined: DataFrame, key: str) -> DataFrame:
    """Samples that the QC joins lost; empty when the join kept every one."""
    return points.select(key).join(joined.select(key), key, "left_anti")


def annotate_left(markers: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Every marker, with its result where there is one."""
    return markers.join(results, key, "left")


def influence_counts(long: DataFrame, sample: str, value: str, cutoff: float) -> DataFrame:
    """Cells above the cut-off per sample; nulls never count."""
    return long.groupBy(sample).agg(F.count_if(F.col(value) > cutoff).alias("n_above"))


def qc_correlations(points: DataFrame, axes: Sequence[str], metrics: Sequence[str], by: list[str]) -> DataFrame:
    """Spearman correlation of every axis with every metric, in one stacked pass."""
    cells = F.array(*[
        F.struct(F.lit(a).alias("axis"), F.lit(m).alias("metric"),
                 F.col(a).cast("double").alias("x"), F.col(m).cast("double").alias("y"))
        for a in axes for m in metrics
    ])
    stacked = points.select(*by, F.explode(cells).alias("c")).select(*by, "c.*")
    return spearman(stacked, "x", "y", [*by, "axis", "metric"])
