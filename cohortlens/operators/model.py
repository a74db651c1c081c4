"""Differential testing over genes: normalisation, dispersion, Wald test, filtering, variance stabilising.

Per-gene fits are independent: a gene row holds its counts and factors as
arrays over the samples of one cohort, and Spark spreads the genes.  What is
shared between genes (size factors, trend, prior width, adjustment) is computed
by Spark aggregates; only scalars and the design matrix reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.operators import nbfit
from cohortlens.operators.ordering import bh_adjust, distinct_ladder, exact_median, exact_quantiles
from cohortlens.session import materialise


# --- design ---------------------------------------------------------------

def design_matrix(samples: DataFrame, sample: str, factors: Mapping[str, Sequence[str]]) -> DataFrame:
    """Treatment coding: an intercept and one 0/1 column per non-reference level.

    The first level of each factor is its reference.
    """
    columns = [F.lit(1).alias("intercept")]
    for factor, levels in factors.items():
        columns += [(F.col(factor) == level).cast("int").alias(f"{factor}_{level}") for level in levels[1:]]
    return samples.select(sample, *columns)


@dataclass(frozen=True)
class Design:
    """A small design on the driver: ordered sample ids, column names and the matrix."""

    samples: tuple[str, ...]
    columns: tuple[str, ...]
    matrix: tuple[tuple[float, ...], ...]

    @property
    def x(self) -> np.ndarray:
        return np.array(self.matrix, dtype=float)

    def blind(self) -> "Design":
        return Design(self.samples, ("intercept",), tuple((1.0,) for _ in self.samples))


def local_design(design: DataFrame, sample: str) -> Design:
    """Bring a design to the driver: one short row per sample of the cohort."""
    columns = [c for c in design.columns if c != sample]
    rows = design.orderBy(sample).collect()
    return Design(tuple(r[sample] for r in rows), tuple(columns), tuple(tuple(float(r[c]) for c in columns) for r in rows))


def check_design(design: DataFrame, sample: str) -> DataFrame:
    """Samples, columns and rank of a design; the cross product is summed by Spark."""
    columns = [c for c in design.columns if c != sample]
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    sums = design.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(a) * F.col(b)).alias(f"{i}") for i, (a, b) in enumerate(pairs)]).first()
    cross = np.zeros((len(columns), len(columns)))
    at = {c: i for i, c in enumerate(columns)}
    for i, (a, b) in enumerate(pairs):
        cross[at[a], at[b]] = cross[at[b], at[a]] = float(sums[f"{i}"])
    rank = int(np.linalg.matrix_rank(cross))
    n, p = int(sums["n"]), len(columns)
    row = [(n, p, rank, rank == p and p < n)]
    return design.sparkSession.createDataFrame(row, "n_samples long, n_columns int, rank int, valid boolean")


# --- normalisation ----------------------------------------------------------

def per_gene(aggregate: Column) -> Column:
    """An aggregate over the gene's rows, attached to each of them.

    A gene has one row per sample of the cohort, so these windows are bounded, and
    they share one shuffle by gene.
    """
    return aggregate.over(Window.partitionBy("gene_id"))


def whole_counts(genes: DataFrame) -> DataFrame:
    """Counts rounded half to even, as on import into the model; comes before the zero filter."""
    return genes.withColumn("count", F.rint("count"))


def drop_all_zero(genes: DataFrame) -> DataFrame:
    """Only genes with a positive total over the cohort."""
    return genes.withColumn("_t", per_gene(F.sum("count"))).where(F.col("_t") > 0).drop("_t")


def geo_mean_by_gene(long: DataFrame, value: str, out: str) -> DataFrame:
    """Geometric mean over samples; null when a sample is zero or absent."""
    positive = F.min(F.coalesce(F.col(value), F.lit(0.0))) > 0
    return long.groupBy("gene_id").agg(F.when(positive, F.exp(F.avg(F.ln(value)))).alias(out))


def size_factors(long: DataFrame, value: str = "count") -> DataFrame:
    """Per sample, the median over genes of ``value`` relative to the gene's geometric mean.

    The median is taken on the log scale over genes positive in every sample; it
    is exact and does not gather a sample in one task.
    """
    spread = long.select(
        "sample_id", (F.ln(value) - per_gene(F.avg(F.ln(value)))).alias("_r"),
        per_gene(F.min(F.coalesce(F.col(value), F.lit(0.0)))).alias("_low"),
    )
    logs = spread.where(F.col("_low") > 0).select("sample_id", "_r")
    return exact_median(logs, "_r", ["sample_id"], "_m").select("sample_id", F.exp("_m").alias("size_factor"))


def norm_factors(genes: DataFrame) -> DataFrame:
    """Gene x sample factors from lengths and size factors, geometric mean 1 per gene.

    Input needs whole counts (:func:`whole_counts`) and a positive ``length`` in every cell.  Output adds ``nf``.  The
    length-centred table is checkpointed, because the medians and the result
    both read it.
    """
    log_length = F.ln("length")
    centred = materialise(
        genes.withColumn("_n", F.exp(log_length - per_gene(F.avg(log_length))))
        .withColumn("_kn", F.col("count") / F.col("_n"))
    )
    product = centred.join(size_factors(centred, "_kn"), "sample_id").withColumn("_ns", F.ln(F.col("_n") * F.col("size_factor")))
    return product.withColumn("nf", F.exp(F.col("_ns") - per_gene(F.avg("_ns")))).drop("_n", "_kn", "_ns", "size_factor")


def track_factors(genes: DataFrame, samples: DataFrame, sample: str) -> DataFrame:
    """Factors of one track: the samples of its cohort are taken first, then whole counts, zero filter and factors."""
    chosen = genes.join(samples.select(F.col(sample).alias("sample_id")).distinct(), "sample_id", "left_semi")
    return norm_factors(drop_all_zero(whole_counts(chosen)))


def norm_factor_violations(factors: DataFrame) -> DataFrame:
    bad = F.col("nf").isNull() | F.isnan("nf") | (F.col("nf") <= 0) | (F.col("nf") == F.lit(float("inf")))
    return factors.where(bad)


def base_mean(factors: DataFrame) -> DataFrame:
    return factors.groupBy("gene_id").agg(F.avg(F.col("count") / F.col("nf")).alias("base_mean"))


# --- per-gene fits ------------------------------------------------------------

def gene_arrays(factors: DataFrame, design: Design) -> DataFrame:
    """One row per gene with counts and factors in design order.

    A row is as long as the cohort has samples; the table stays partitioned by gene.
    """
    spark = factors.sparkSession
    order = spark.createDataFrame(list(enumerate(design.samples)), "_i int, sample_id string")
    # The fits are heavy per row, so the gene partitioning keeps its full width (AQE would
    # coalesce by bytes); the aggregate reuses it.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = factors.join(order, "sample_id").repartition(width, "gene_id").groupBy("gene_id").agg(
        F.array_sort(F.collect_list(F.struct("_i", "count", "nf"))).alias("_c")
    )
    return cells.select(
        "gene_id",
        F.transform("_c", lambda c: c["count"].cast("double")).alias("counts"),
        F.transform("_c", lambda c: c["nf"].cast("double")).alias("nfs"),
    )


def _stack(column: pd.Series, n: int) -> np.ndarray:
    if len(column) == 0:
        return np.zeros((0, n))
    matrix = np.stack(column.to_numpy())
    if matrix.shape[1] != n:
        raise ValueError(f"Gene rows need {n} samples, found {matrix.shape[1]}")
    return matrix.astype(float)


def gene_dispersion(arrays: DataFrame, design: Design) -> DataFrame:
    """Gene-wise dispersion by Cox-Reid profile likelihood: adds ``base_mean, disp_gene, converged``.

    Means come from a linear fit when every design row is its own cell mean, else
    from an NB fit at the starting dispersion.
    """
    x = design.x
    cell_means = len(np.unique(x, axis=0)) == x.shape[1]

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            k, nf = _stack(batch["counts"], len(x)), _stack(batch["nfs"], len(x))
            if len(k) == 0:
                continue
            disp, mean = _gene_wise(k, nf, x, cell_means)
            yield batch.assign(base_mean=mean, disp_gene=disp)

    return arrays.mapInPandas(
        fit, "gene_id string, counts array<double>, nfs array<double>, base_mean double, disp_gene double"
    )


def _gene_wise(k: np.ndarray, nf: np.ndarray, x: np.ndarray, cell_means: bool) -> tuple[np.ndarray, np.ndarray]:
    if cell_means:
        mu = nbfit.linear_mu(k, nf, x)
    else:
        mu = nbfit.irls(k, nf, x, nbfit.moments_dispersion(k, nf, x))["mu"]
    disp = np.clip(nbfit.maximise_dispersion(k, mu, x), nbfit.MIN_DISP, max(10.0, len(x)))
    return disp, (k / nf).mean(axis=1)


@dataclass(frozen=True)
class Trend:
    """Mean-dispersion trend ``a1 / mean + a0``."""

    a0: float
    a1: float

    def column(self, mean: Column) -> Column:
        return F.lit(self.a1) / mean + F.lit(self.a0)


class NotConverged(RuntimeError):
    """A fit that has used up its steps; no half-way result is returned."""


# Lengths of a Newton step: the whole one first, the others in one more pass where it does not lower the loss.
STEP_LENGTHS = (1.0, 0.5, 0.125, 1.0 / 64)
# The trend stays above this at every mean, and does not rise with the mean.
LOWEST_TREND = 1e-8


def _gamma_sums(good: DataFrame, points: Sequence[tuple[float, float]]) -> list[dict[str, float]]:
    """Deviance, gradient and Hessian of the gamma likelihood at several coefficient pairs, in one aggregate."""
    columns = []
    for i, (a0, a1) in enumerate(points):
        y, x, mu = F.col("y"), F.col("x"), F.lit(a0) + F.lit(a1) * F.col("x")
        slope, curve, safe = (mu - y) / (mu * mu), (2 * y - mu) / (mu * mu * mu), 1 / (mu * mu)
        terms = {"loss": y / mu + F.ln(mu), "g0": slope, "g1": slope * x, "h00": curve, "h01": curve * x, "h11": curve * x * x,
                 "w": safe, "wx": safe * x, "wxx": safe * x * x}
        columns += [F.sum(term).alias(f"{name}_{i}") for name, term in terms.items()]
    row = good.agg(*columns).first().asDict()
    return [{name.rsplit("_", 1)[0]: v for name, v in row.items() if name.endswith(f"_{i}")} for i in range(len(points))]


def _newton_step(s: dict[str, float], a0: float, a1: float) -> tuple[float, float]:
    """Newton direction, or the scoring direction where the likelihood is not convex; along a bound it would leave, one-dimensional."""
    only0 = -s["g0"] / (s["h00"] if s["h00"] > 0 else s["w"]), 0.0
    only1 = 0.0, -s["g1"] / (s["h11"] if s["h11"] > 0 else s["wxx"])
    if a1 <= 0 and s["g1"] >= 0:
        return only0
    if a0 <= LOWEST_TREND and s["g0"] >= 0:
        return only1
    for h00, h01, h11 in ((s["h00"], s["h01"], s["h11"]), (s["w"], s["wx"], s["wxx"])):
        det = h00 * h11 - h01 * h01
        if h00 > 0 and det > 1e-14 * h00 * h11:
            d0, d1 = (h01 * s["g1"] - h11 * s["g0"]) / det, (h01 * s["g0"] - h00 * s["g1"]) / det
            return only1 if a0 <= LOWEST_TREND and d0 < 0 else only0 if a1 <= 0 and d1 < 0 else (d0, d1)
    return -s["g0"] / s["w"], 0.0


def gamma_fit(good: DataFrame, start: tuple[float, float], steps: int = 40, tol: float = 1e-6) -> tuple[float, float]:
    """Coefficients of ``y ~ a0 + a1 x`` with gamma errors (both kept from falling below their bounds).

    A safeguarded Newton iteration: each pass over the rows returns the likelihood and
    its derivatives after a step, and a step that does not lower the loss is shortened, in the next pass again.
    Convergence is quadratic, so a step below ``tol`` leaves an error near its square.
    Raises :class:`NotConverged` when no step is small enough after ``steps`` passes.
    """
    at, sums, reach = start, None, 1.0
    for _ in range(steps):
        if sums is None:
            sums = _gamma_sums(good, [at])[0]
            if sums["w"] is None:
                raise ValueError("No genes left for the dispersion trend")
        d0, d1 = _newton_step(sums, *at)
        tried = [(max(at[0] + reach * t * d0, LOWEST_TREND), max(at[1] + reach * t * d1, 0.0)) for t in STEP_LENGTHS]
        found = _gamma_sums(good, tried[:1])
        if found[0]["loss"] > sums["loss"]:
            found += _gamma_sums(good, tried[1:])
        best = min(range(len(found)), key=lambda i: found[i]["loss"])
        moved = sum(abs(b - a) / (abs(a) + 1e-8) for a, b in zip(at, tried[best], strict=True)) / reach
        # No length lowers the loss any more: rounding is all that is left.
        stuck = found[best]["loss"] > sums["loss"]
        if not stuck:
            at, sums = tried[best], found[best]
        reach = reach * STEP_LENGTHS[-1] if stuck else 1.0
        if moved < tol or (stuck and moved < 1e-5):
            return at
    raise NotConverged(f"Gamma fit did not converge in {steps} passes")


def dispersion_trend(genes: DataFrame, rounds: int = 10) -> Trend:
    """Gamma fit with identity link, repeated without genes far from the trend.

    ``genes`` needs ``base_mean`` and ``disp_gene``.  Each pass of :func:`gamma_fit` is one
    Spark aggregate; only sums reach the driver.  Raises :class:`NotConverged` when the
    coefficients still move after ``rounds`` fits.
    """
    usable = genes.where((F.col("disp_gene") >= 100 * nbfit.MIN_DISP) & (F.col("base_mean") > 0)).select(
        F.col("disp_gene").alias("y"), (1.0 / F.col("base_mean")).alias("x")
    )
    at = (0.1, 1.0)
    for _ in range(rounds):
        ratio = F.col("y") / (F.lit(at[0]) + F.lit(at[1]) * F.col("x"))
        found = gamma_fit(usable.where((ratio > 1e-4) & (ratio < 15)), at)
        step = sum(math.log(max(b, 1e-300) / max(a, 1e-300)) ** 2 for a, b in zip(at, found, strict=True))
        at = found
        if step < 1e-6:
            return Trend(*at)
    raise NotConverged(f"Dispersion trend did not settle in {rounds} fits")


def moment_dispersion(factors: DataFrame) -> DataFrame:
    """``gene_id, base_mean, disp_gene`` by moments over all samples, without a design."""
    q = F.col("count") / F.col("nf")
    sums = factors.groupBy("gene_id").agg(F.avg(q).alias("base_mean"), F.var_samp(q).alias("_v"), F.avg(1 / F.col("nf")).alias("_i"))
    raw = F.try_divide(F.col("_v") - F.col("_i") * F.col("base_mean"), F.col("base_mean") * F.col("base_mean"))
    return sums.select("gene_id", "base_mean", F.greatest(raw, F.lit(nbfit.MIN_DISP)).alias("disp_gene"))


@dataclass(frozen=True)
class DispersionPrior:
    residual_sd: float
    prior_var: float


def dispersion_prior(genes: DataFrame, trend: Trend, n_samples: int, n_columns: int) -> DispersionPrior:
    """Prior width from the spread of log dispersions about the trend (exact medians)."""
    logs = genes.where((F.col("disp_gene") >= 100 * nbfit.MIN_DISP) & (F.col("base_mean") > 0)).select(
        (F.ln("disp_gene") - F.ln(trend.column(F.col("base_mean")))).alias("_r")
    )
    center = exact_median(logs, "_r").first()["median"]
    mad = 1.4826 * exact_median(logs.select(F.abs(F.col("_r") - center).alias("_d")), "_d").first()["median"]
    return DispersionPrior(mad, max(mad**2 - nbfit.trigamma((n_samples - n_columns) / 2), 0.25))


FIT_SCHEMA = (
    "gene_id string, base_mean double, disp_gene double, disp_fit double, disp_map double, dispersion double, "
    "disp_outlier boolean, lfc double, lfc_se double, stat double, pvalue double, converged boolean, "
    "replaced boolean, max_cooks double, cooks array<double>"
)


def _shrink(k: np.ndarray, nf: np.ndarray, x: np.ndarray, gene: np.ndarray, fit: np.ndarray, prior: DispersionPrior,
            cell_means: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mu = nbfit.linear_mu(k, nf, x) if cell_means else nbfit.irls(k, nf, x, np.maximum(gene, nbfit.MIN_DISP))["mu"]
    shrunk = np.clip(
        nbfit.maximise_dispersion(k, mu, x, np.log(fit), prior.prior_var), nbfit.MIN_DISP, max(10.0, len(x))
    )
    outlier = np.log(gene) > np.log(fit) + 2 * prior.residual_sd
    return shrunk, outlier, np.where(outlier, gene, shrunk)


def dispersion_map(genes: DataFrame, design: Design, trend: Trend, prior: DispersionPrior) -> DataFrame:
    """Shrink towards the trend; genes far above it keep their own estimate and are flagged."""
    x = design.x
    cell_means = len(np.unique(x, axis=0)) == x.shape[1]

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            k, nf = _stack(batch["counts"], len(x)), _stack(batch["nfs"], len(x))
            if len(k) == 0:
                continue
            line = trend.a1 / batch["base_mean"].to_numpy() + trend.a0
            shrunk, outlier, final = _shrink(k, nf, x, batch["disp_gene"].to_numpy(), line, prior, cell_means)
            yield batch.drop(columns=["counts", "nfs"]).assign(
                disp_fit=line, disp_map=shrunk, dispersion=final, disp_outlier=outlier
            )

    return genes.mapInPandas(fit, "gene_id string, base_mean double, disp_gene double, disp_fit double, "
                                  "disp_map double, dispersion double, disp_outlier boolean")


def nb_wald_test(genes: DataFrame, design: Design, coefficient: str, trend: Trend, prior: DispersionPrior,
                 replace_from: int = 7) -> DataFrame:
    """Shrunken dispersion, NB fit and Wald test of one coefficient, in one pass over the genes.

    Effects are on the log2 scale.  Counts with a large influence in cells of at
    least ``replace_from`` replicates are replaced by the trimmed mean and the
    gene is fitted again; influence in smaller cells (three or more replicates)
    makes the p-value null.
    """
    x = design.x
    n, p = x.shape
    at = design.columns.index(coefficient)
    cell_means = len(np.unique(x, axis=0)) == p
    replicates = nbfit.design_cells(x)
    two_groups = p == 2 and len(np.unique(x, axis=0)) == 2
    cutoff = nbfit.f_quantile(0.99, p, n - p)
    log2 = math.log(2.0)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            k, nf = _stack(batch["counts"], n), _stack(batch["nfs"], n)
            if len(k) == 0:
                continue
            mean, gene = batch["base_mean"].to_numpy().copy(), batch["disp_gene"].to_numpy().copy()
            line = trend.a1 / mean + trend.a0
            shrunk, outlier, alpha = _shrink(k, nf, x, gene, line, prior, cell_means)
            result = nbfit.irls(k, nf, x, alpha)
            influence = nbfit.cooks(k, result, nbfit.robust_dispersion(k / nf, x), p)
            beta, se, converged = result["beta"][:, at], result["se"][:, at], result["converged"]

            # Refit genes with an influential count in a well-replicated cell.
            hit = (influence > cutoff) & (replicates >= replace_from)[None, :]
            again = np.flatnonzero(hit.any(axis=1))
            if len(again):
                kr, nr = k[again].copy(), nf[again]
                fill = np.round(nbfit.trimmed_mean(kr / nr)[:, None] * nr)
                kr = np.where(hit[again], fill, kr)
                alive = kr.sum(axis=1) > 0
                again, kr, nr = again[alive], kr[alive], nr[alive]
                if len(again):
                    g2, m2 = _gene_wise(kr, nr, x, cell_means)
                    f2 = trend.a1 / m2 + trend.a0
                    s2, o2, a2 = _shrink(kr, nr, x, g2, f2, prior, cell_means)
                    r2 = nbfit.irls(kr, nr, x, a2)
                    beta[again], se[again], converged[again] = r2["beta"][:, at], r2["se"][:, at], r2["converged"]
                    mean[again], gene[again], line[again] = m2, g2, f2
                    shrunk[again], outlier[again], alpha[again] = s2, o2, a2
            replaced = np.zeros(len(k), dtype=bool)
            replaced[again] = True

            watched = (replicates >= 3) & (replicates < replace_from)
            worst = np.where(watched[None, :], influence, -np.inf).max(axis=1)
            masked = worst > cutoff
            if two_groups and masked.any():
                place = influence.argmax(axis=1)
                higher = (k > k[np.arange(len(k)), place][:, None]).sum(axis=1)
                masked &= higher < 3
            stat = beta / np.where(se > 0, se, np.nan)
            pvalue = np.where(masked | ~np.isfinite(stat), np.nan, nbfit.two_sided_p(np.nan_to_num(stat)))
            yield pd.DataFrame({
                "gene_id": batch["gene_id"], "base_mean": mean, "disp_gene": gene, "disp_fit": line,
                "disp_map": shrunk, "dispersion": alpha, "disp_outlier": outlier,
                "lfc": beta / log2, "lfc_se": se / log2, "stat": stat, "pvalue": pvalue,
                "converged": converged, "replaced": replaced,
                "max_cooks": influence.max(axis=1), "cooks": list(influence),
            })

    fitted = genes.mapInPandas(fit, FIT_SCHEMA)
    # Missing values leave Python as NaN; tables use null.
    return fitted.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in ("stat", "pvalue", "lfc_se")})


def cooks_long(fitted: DataFrame, design: Design) -> DataFrame:
    """Influence per gene and sample."""
    names = F.array(*[F.lit(s) for s in design.samples])
    return fitted.select("gene_id", F.posexplode("cooks").alias("_i", "cooks")).select(
        "gene_id", F.get(names, F.col("_i")).alias("sample_id"), "cooks"
    )


def review_cutoff(design: Design) -> float:
    """Influence cut-off of the sample review: 0.99 quantile of F with one numerator degree of freedom."""
    n, p = design.x.shape
    return nbfit.f_quantile(0.99, 1, n - p)


# --- adjustment and filtering -----------------------------------------------------

def filter_rejections(result: DataFrame, cutoffs: Sequence[float], alpha: float) -> DataFrame:
    """Rejections at ``alpha`` for each base-mean cut: ``(cut, n_tests, rejections)``.

    Only p-values up to ``alpha`` can be rejected, so only those rows are
    repeated for the cuts they pass; the other rows are counted.
    """
    cuts = F.array(*[F.struct(F.lit(i).alias("cut"), F.lit(float(c)).alias("_c")) for i, c in enumerate(cutoffs)])
    tested = result.where(F.col("pvalue").isNotNull())
    passed = lambda df: df.withColumn("_k", F.explode(F.filter(cuts, lambda s: s["_c"] <= F.col("base_mean"))))
    band = tested.select(F.size(F.filter(cuts, lambda s: s["_c"] <= F.col("base_mean"))).alias("_b"))
    per_band = band.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    # Cuts ascend, so a row that passes b cuts passes the cuts 0 .. b-1.
    totals = per_band.withColumn("cut", F.explode(F.sequence(F.lit(0), F.lit(len(cutoffs) - 1)))).where(
        F.col("cut") < F.col("_b")
    ).groupBy("cut").agg(F.sum("_n").alias("n_tests"))
    low = passed(tested.where(F.col("pvalue") <= alpha)).select(F.col("_k.cut").alias("cut"), "pvalue")
    ladder = distinct_ladder(low, "pvalue", ["cut"])
    rank = F.col("below") + F.col("n")
    best = ladder.join(totals, "cut").where(F.col("pvalue") * F.col("n_tests") <= F.lit(alpha) * rank).groupBy("cut").agg(
        F.max(rank).alias("rejections")
    )
    return totals.join(best, "cut", "left").withColumn("rejections", F.coalesce("rejections", F.lit(0)))


def choose_cut(thetas: Sequence[float], rejections: Sequence[int]) -> int:
    """Lowest cut whose rejections exceed the smoothed maximum less the residual RMS."""
    r = np.array(rejections, dtype=float)
    if r.max() <= 10:
        return 0
    smooth = nbfit.lowess(np.array(thetas, dtype=float), r)
    used = r > 0
    rms = math.sqrt(np.mean((r[used] - smooth[used]) ** 2))
    above = np.flatnonzero(r > smooth.max() - rms)
    return int(above[0]) if len(above) else 0


def adjust_above(result: DataFrame, cut: float) -> DataFrame:
    """Adjusted p-values for genes with at least the given base mean; null below it."""
    eligible = result.withColumn("_p", F.when(F.col("base_mean") >= F.lit(cut), F.col("pvalue")))
    return bh_adjust(eligible, "_p", None, "padj").drop("_p")


def independent_filter(result: DataFrame, alpha: float = 0.05, steps: int = 50) -> DataFrame:
    """Adjusted p-values with the base-mean cut that allows the most rejections."""
    zero = result.agg(F.avg((F.col("base_mean") == 0).cast("double")).alias("z")).first()["z"] or 0.0
    thetas = np.linspace(zero, 0.95 if zero < 0.95 else 1.0, steps)
    found = {r["prob"]: r["quantile"] for r in exact_quantiles(result, "base_mean", list(thetas)).collect()}
    cutoffs = [found[float(t)] for t in thetas]
    counts = {r["cut"]: r["rejections"] for r in filter_rejections(result, cutoffs, alpha).collect()}
    best = choose_cut(thetas, [counts.get(i, 0) for i in range(steps)])
    return adjust_above(result, cutoffs[best])


def de_flags(result: DataFrame, alpha: float = 0.05) -> DataFrame:
    return result.withColumns({
        "tested": F.col("pvalue").isNotNull(),
        "significant": F.col("padj").isNotNull() & (F.col("padj") < alpha),
    })


def trend_table(spark: SparkSession, trend: Trend) -> DataFrame:
    """A fitted trend as a table of one row, ``a0, a1``."""
    return spark.createDataFrame([(trend.a0, trend.a1)], "a0 double, a1 double")


def vst(factors: DataFrame, trend: DataFrame) -> DataFrame:
    """Variance-stabilised value of each cell, on the log2 scale; ``trend`` is a fitted one (:func:`trend_table`)."""
    q, a0, a1 = F.col("count") / F.col("nf"), trend.select("a0").scalar(), trend.select("a1").scalar()
    inner = (1 + a1 + 2 * a0 * q + 2 * F.sqrt(a0 * q * (1 + a1 + a0 * q))) / (4 * a0)
    return factors.select("gene_id", "sample_id", F.log2(inner).alias("vst"))


# --- whole contrast -----------------------------------------------------------------

@dataclass(frozen=True)
class Contrast:
    """Result of one contrast with what later steps reuse."""

    result: DataFrame
    fitted: DataFrame
    design: Design
    trend: Trend
    prior: DispersionPrior


def differential(factors: DataFrame, design: Design, coefficient: str, alpha: float = 0.05) -> Contrast:
    """Dispersion, test, filtering and flags of one cohort and design.

    Two checkpoints: gene rows with their dispersion (read by the trend, the
    prior and the test) and the fitted table.
    """
    genes = materialise(gene_dispersion(gene_arrays(factors, design), design))
    trend = dispersion_trend(genes)
    prior = dispersion_prior(genes, trend, *design.x.shape)
    fitted = materialise(nb_wald_test(genes, design, coefficient, trend, prior))
    result = de_flags(independent_filter(fitted.drop("cooks"), alpha), alpha)
    return Contrast(result, fitted, design, trend, prior)


def blind_trend(factors: DataFrame, design: Design) -> Trend:
    """Trend fitted with an intercept only, for variance stabilising."""
    flat = design.blind()
    return dispersion_trend(materialise(gene_dispersion(gene_arrays(factors, flat), flat)))
