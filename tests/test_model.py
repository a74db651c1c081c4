import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import model as M
from cohortlens.operators import nbfit
from cohortlens.operators import sampleqc as S


def test_special_functions():
    x = np.array([1e-6, 0.3, 1.0, 2.5, 7.99, 8.0, 50.0, 1e8])
    np.testing.assert_allclose(nbfit.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-11, atol=1e-11)
    assert nbfit.trigamma(1.0) == pytest.approx(math.pi**2 / 6)
    assert nbfit.trigamma(0.5) == pytest.approx(math.pi**2 / 2)
    # Tabulated 0.99 quantiles of F.
    for d1, d2, want in [(1, 20, 8.096), (2, 20, 5.849), (10, 8, 5.814)]:
        assert nbfit.f_quantile(0.99, d1, d2) == pytest.approx(want, abs=1e-3)


def test_irls_matches_poisson_group_means():
    """With almost no dispersion the fit of a two-group design is the log ratio of group means."""
    x = np.column_stack([np.ones(6), [0, 0, 0, 1, 1, 1]])
    k = np.array([[10, 12, 14, 30, 33, 45.0]])
    fit = nbfit.irls(k, np.ones_like(k), x, np.array([1e-8]))
    assert fit["converged"].all()
    assert fit["beta"][0, 1] == pytest.approx(math.log(108 / 36), rel=1e-5)
    assert fit["se"][0, 1] == pytest.approx(math.sqrt(1 / 36 + 1 / 108), rel=1e-3)


def test_dispersion_maximum_matches_dense_grid():
    rng = np.random.default_rng(2)
    x = np.column_stack([np.ones(10), np.repeat([0, 1], 5)])
    k = rng.negative_binomial(5, 5 / (5 + 80.0), size=(4, 10)).astype(float)
    mu = nbfit.linear_mu(k, np.ones_like(k), x)
    got = nbfit.maximise_dispersion(k, mu, x)
    grid = np.linspace(math.log(1e-4), math.log(5), 4000)
    best = grid[np.stack([nbfit.profile(np.full(4, g), k, mu, x) for g in grid]).argmax(axis=0)]
    np.testing.assert_allclose(np.log(got), best, atol=5e-3)


@pytest.fixture(scope="module")
def study(spark):
    """Counts with a known effect (up and down in turn) on the first 60 of 400 genes, in six patients with two samples each."""
    rng = np.random.default_rng(11)
    genes, patients = 400, 6
    base = np.exp(rng.normal(5, 1, genes))
    size = np.exp(rng.normal(0, 0.3, 2 * patients))
    patient = rng.normal(0, 0.3, (genes, patients))
    effect = np.where(np.arange(genes) < 60, np.where(np.arange(genes) % 2 == 0, 1.0, -1.0) * math.log(4.0), 0.0)
    rows = []
    for s in range(2 * patients):
        p, tumor = s // 2, s % 2
        mu = base * size[s] * np.exp(patient[:, p] + effect * tumor)
        r = 1 / 0.05
        counts = rng.negative_binomial(r, r / (r + mu))
        rows += [(f"g{g:03d}", f"s{s:02d}", float(c), 1000.0) for g, c in enumerate(counts)]
    rows += [("zero", f"s{s:02d}", 0.0, 1000.0) for s in range(2 * patients)]
    genes_df = spark.createDataFrame(rows, "gene_id string, sample_id string, count double, length double")
    samples = spark.createDataFrame(
        [(f"s{s:02d}", f"p{s // 2}", "tumor" if s % 2 else "normal") for s in range(2 * patients)],
        "sample_id string, patient string, condition string")
    return genes_df, samples, size


def test_size_and_norm_factors(spark, study):
    genes, _, size = study
    got = M.size_factors(M.drop_all_zero(genes)).orderBy("sample_id").toPandas()["size_factor"].to_numpy()
    wide = genes.where("gene_id <> 'zero'").toPandas().pivot(index="gene_id", columns="sample_id", values="count").to_numpy()
    logs = np.log(wide[(wide > 0).all(axis=1)])
    np.testing.assert_allclose(got, np.exp(np.median(logs - logs.mean(axis=1, keepdims=True), axis=0)), rtol=1e-12)
    assert np.corrcoef(np.log(got), np.log(size))[0, 1] > 0.9
    nf = M.norm_factors(M.drop_all_zero(genes))
    assert M.norm_factor_violations(nf).count() == 0
    wide = nf.toPandas().pivot(index="gene_id", columns="sample_id", values="nf").to_numpy()
    np.testing.assert_allclose(np.exp(np.log(wide).mean(axis=1)), 1.0)
    # Equal lengths leave only the size factors.
    np.testing.assert_allclose(wide[0], got / np.exp(np.log(got).mean()), rtol=1e-9)


def test_counts_are_rounded_half_to_even_before_the_zero_filter(spark):
    cells = [("half", 12.5), ("half", 13.5), ("small", 0.3), ("small", 0.2), ("one", 0.5), ("one", 1.5)]
    genes = spark.createDataFrame([(g, f"s{i % 2}", c, 1000.0) for i, (g, c) in enumerate(cells)], "gene_id string, sample_id string, count double, length double")
    kept = M.drop_all_zero(M.whole_counts(genes)).collect()
    assert sorted((r.gene_id, r["count"]) for r in kept) == [("half", 12.0), ("half", 14.0), ("one", 0.0), ("one", 2.0)]


@pytest.mark.parametrize("paired", [False, True])
def test_recovery_of_known_effects(spark, study, paired):
    genes, samples, _ = study
    levels = {"patient": [f"p{i}" for i in range(6)]} if paired else {}
    design_df = M.design_matrix(samples, "sample_id", {**levels, "condition": ["normal", "tumor"]})
    checked = M.check_design(design_df, "sample_id").first()
    assert checked["valid"] and checked["rank"] == (7 if paired else 2)
    design = M.local_design(design_df, "sample_id")
    out = M.differential(M.norm_factors(M.drop_all_zero(genes)), design, "condition_tumor")
    res = out.result.toPandas().set_index("gene_id").sort_index()
    assert len(res) == 400 and "zero" not in res.index
    changed, flat = res.iloc[:60], res.iloc[60:]
    signs = np.where(np.arange(60) % 2 == 0, 1.0, -1.0)
    assert (changed["lfc"] * signs).mean() == pytest.approx(2.0, abs=0.15)
    assert (changed["padj"] < 0.05).mean() > (0.95 if paired else 0.85)
    assert (flat["padj"] < 0.05).mean() < 0.05
    inside = (np.abs(flat["lfc"]) < 1.96 * flat["lfc_se"]).mean()
    assert inside > (0.90 if paired else 0.93)
    if paired:
        assert 0.02 < out.trend.a0 < 0.1
    both = res.dropna(subset=["padj"])
    assert (both["padj"] >= both["pvalue"] - 1e-12).all()
    assert (res["tested"] == res["pvalue"].notna()).all()
    cooks = M.cooks_long(out.fitted, design)
    assert cooks.count() == 400 * 12 and cooks.where("cooks < 0").count() == 0


def test_outlier_counts_are_masked_or_replaced(spark):
    rng = np.random.default_rng(4)
    for per_group, expect in ((4, "masked"), (8, "replaced")):
        n = 2 * per_group
        k = rng.negative_binomial(20, 20 / (20 + 100.0), size=(300, n)).astype(float)
        k[0, 0] = 20000
        df = spark.createDataFrame(pd.DataFrame({"gene_id": [f"g{i:03d}" for i in range(300)], "counts": list(k), "nfs": list(np.ones_like(k))}),
                                   "gene_id string, counts array<double>, nfs array<double>")
        design = M.Design(tuple(f"s{i}" for i in range(n)), ("intercept", "t"), tuple((1.0, float(i >= per_group)) for i in range(n)))
        genes = M.gene_dispersion(df, design)
        trend, prior = M.Trend(0.05, 0.5), M.DispersionPrior(0.5, 0.5)
        row = M.nb_wald_test(genes, design, "t", trend, prior).where("gene_id = 'g000'").first()
        assert (row["pvalue"] is None) == (expect == "masked")
        assert row["replaced"] == (expect == "replaced")
        if expect == "replaced":
            assert abs(row["lfc"]) < 0.6 and row["base_mean"] < 200


def test_trend_recovers_coefficients(spark):
    rng = np.random.default_rng(9)
    mean = np.exp(rng.normal(5, 1.5, 4000))
    disp = (0.04 + 3.0 / mean) * rng.gamma(8, 1 / 8, 4000)
    disp[:40] *= 500
    df = spark.createDataFrame(pd.DataFrame({"base_mean": mean, "disp_gene": disp}))
    trend = M.dispersion_trend(df)
    assert trend.a0 == pytest.approx(0.04, rel=0.1) and trend.a1 == pytest.approx(3.0, rel=0.15)


def test_filter_counts_match_plain_bh(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"gene_id": [f"g{i}" for i in range(800)], "base_mean": np.exp(rng.normal(3, 2, 800)), "pvalue": rng.random(800) ** 2})
    pdf.loc[:20, "pvalue"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("pvalue", F.nanvl("pvalue", F.lit(None).cast("double")))
    cuts = [0.0, 5.0, 20.0, 100.0]
    got = {r["cut"]: (r["n_tests"], r["rejections"]) for r in M.filter_rejections(df, cuts, 0.1).collect()}
    for i, c in enumerate(cuts):
        p = np.sort(pdf[(pdf.base_mean >= c) & pdf.pvalue.notna()]["pvalue"])
        ok = np.flatnonzero(p * len(p) <= 0.1 * np.arange(1, len(p) + 1))
        assert got[i] == (len(p), ok.max() + 1 if len(ok) else 0)
    assert M.choose_cut([0, 0.5, 0.9], [3, 4, 2]) == 0


def test_gram_blocks_distances_and_pca(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(40, 11)) + np.outer(rng.normal(size=40) * 3, np.arange(11))
    long = spark.createDataFrame([(f, f"s{j:02d}", float(x[f, j])) for f in range(40) for j in range(11)], "f int, s string, v double").cache()
    for block in (4, 100):
        got = S.gram(long, "f", "s", "v", samples_per_block=block).toPandas()
        assert len(got) == 66
        g = x.T @ x
        for r in got.itertuples():
            assert r.dot == pytest.approx(g[int(r.sample_i[1:]), int(r.sample_j[1:])], rel=1e-9, abs=1e-9)
    d = {(r["s1"], r["s2"]): r["distance"] for r in S.sample_distances(long, "f", "s", "v").collect()}
    assert len(d) == 55 and d[("s02", "s07")] == pytest.approx(np.linalg.norm(x[:, 2] - x[:, 7]))
    c = x - x.mean(axis=1, keepdims=True)
    u, sv, vt = np.linalg.svd(c, full_matrices=False)
    out = S.sample_pca(long, "f", "s", "v", 2).toPandas().sort_values("s")
    np.testing.assert_allclose(out["var_1"], sv[0] ** 2 / (sv**2).sum(), rtol=1e-9)
    for k in (0, 1):
        np.testing.assert_allclose(np.abs(out[f"pc_{k + 1}"]), np.abs(vt[k] * sv[k]), atol=1e-8 * sv[0])
        assert out[f"pc_{k + 1}"].iloc[np.abs(out[f"pc_{k + 1}"]).argmax()] > 0


def long_of(spark, x):
    return spark.createDataFrame([(f, f"s{j:03d}", float(v)) for f, row in enumerate(x) for j, v in enumerate(row)], "f int, s string, v double")


@pytest.mark.parametrize("rank", [0, 1, 2])
def test_pca_of_low_rank(spark, rank):
    """Axes beyond the rank are 0; three are asked for."""
    rng = np.random.default_rng(rank)
    x = np.zeros((20, 12)) + rng.integers(0, 9, size=(20, 1))
    for r in range(rank):
        x += np.outer(rng.normal(size=20), rng.normal(size=12)) * 4**r
    out = S.sample_pca(long_of(spark, x), "f", "s", "v", 3).toPandas().sort_values("s")
    _, sv, vt = np.linalg.svd(x - x.mean(axis=1, keepdims=True), full_matrices=False)
    for k in range(3):
        want = np.abs(vt[k] * sv[k]) if k < rank else np.zeros(12)
        np.testing.assert_allclose(np.abs(out[f"pc_{k + 1}"]), want, atol=1e-7)
        assert out[f"var_{k + 1}"].iloc[0] == pytest.approx(sv[k] ** 2 / (sv**2).sum() if k < rank else 0.0, abs=1e-9)


def test_axes_restart_and_give_up(spark, monkeypatch):
    """A flat spectrum needs more products than the basis holds; too few of them raise."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(70, 60))
    dots = S.gram(S.centre_by_feature(long_of(spark, x), "f", "s", "v"), "f", "s", "_c")
    monkeypatch.setattr(S, "LARGEST_BASIS", 14)
    values, vectors = S.leading_axes(dots, 2, extra=3)
    sv = np.linalg.svd(x - x.mean(axis=1, keepdims=True), compute_uv=False)
    np.testing.assert_allclose(values, sv[:2] ** 2, rtol=1e-9)
    left = S.axis_residuals(dots, values, vectors).toPandas()
    assert len(left) == 2 and (left["residual"] < 1e-9).all() and left["total_variance"].iloc[0] == pytest.approx((sv**2).sum())
    with pytest.raises(RuntimeError, match="did not converge"):
        S.leading_axes(dots, 2, extra=3, most=2)


def test_trend_at_its_bounds_and_without_convergence(spark):
    rng = np.random.default_rng(1)
    mean = np.exp(rng.normal(5, 1, 500))
    rising = spark.createDataFrame(pd.DataFrame({"base_mean": mean, "disp_gene": 0.1 + mean / 1e4}))
    trend = M.dispersion_trend(rising)
    assert trend.a1 == 0.0 and trend.a0 == pytest.approx((0.1 + mean / 1e4).mean(), rel=1e-6)
    noisy = spark.createDataFrame(pd.DataFrame({"base_mean": mean, "disp_gene": (0.1 + 2 / mean) * rng.gamma(2, 0.5, 500)}))
    with pytest.raises(M.NotConverged):
        M.dispersion_trend(noisy, rounds=1)
    y = noisy.select(F.col("disp_gene").alias("y"), (1 / F.col("base_mean")).alias("x"))
    with pytest.raises(M.NotConverged):
        M.gamma_fit(y, (0.1, 1.0), steps=1)


def test_trend_without_a_constant_part(spark):
    """The best line through these has a negative constant: the fit stays at the bound and settles along it."""
    rng = np.random.default_rng(4)
    mean = rng.normal(160, 18, 400)
    y = (70 / mean - 0.13) * rng.gamma(3, 1 / 3, 400)
    trend = M.dispersion_trend(spark.createDataFrame(pd.DataFrame({"base_mean": mean, "disp_gene": y})))
    assert trend.a0 == M.LOWEST_TREND and trend.a1 == pytest.approx((y * mean).mean(), rel=1e-5)
    # Rising with 1 / mean over six decades, no constant: far from the start, and near the bound from the inside.
    mean = np.exp(rng.normal(5, 2, 400))
    y = 3 / mean * rng.gamma(1, 1, 400)
    keep = y >= 1e-6
    good = spark.createDataFrame(pd.DataFrame({"y": y[keep], "x": 1 / mean[keep]}))
    a0, a1 = M.gamma_fit(good, (0.1, 1.0))
    assert a0 < 1e-3 and a1 == pytest.approx(3, rel=0.2)


def test_fit_blocks_and_determinants(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = np.c_[np.ones(18), np.arange(18) % 2 == 0, rng.integers(0, 2, (18, 4))].astype(float)
    w = rng.uniform(0.01, 9, (50, 18))
    np.testing.assert_allclose(nbfit._log_det(x, w), np.linalg.slogdet(nbfit.information(x, w))[1], rtol=1e-9)
    assert (nbfit._log_det(np.c_[x, x[:, 1] * 0], w) == 0).all()
    k, mu = rng.negative_binomial(3, 0.02, (50, 18)).astype(float), np.full((50, 18), 147.0)
    whole = nbfit.maximise_dispersion(k, mu, x)
    monkeypatch.setattr(nbfit, "GENES_AT_ONCE", 7)
    np.testing.assert_allclose(nbfit.maximise_dispersion(k, mu, x), whole, rtol=1e-5)
    assert len(nbfit.maximise_dispersion(k[:0], mu[:0], x)) == 0


def test_both_tracks_read_one_gene_table(spark, monkeypatch):
    from types import SimpleNamespace

    from cohortlens.plans import bindings, catalog

    made, tracks = [], []
    genes = bindings.genes
    monkeypatch.setattr(bindings, "genes", lambda *a: made.append(a) or genes(*a))
    blank = "gene_id string, base_mean double, lfc double, lfc_se double, stat double, pvalue double, padj double, tested boolean, significant boolean"

    def differential(factors, design, coefficient):
        tracks.append(factors.select("sample_id").distinct().count())
        return SimpleNamespace(result=spark.createDataFrame([], blank))

    monkeypatch.setattr(M, "differential", differential)
    assert catalog.load()[0]["m9_nb_wald_test"](spark, "/root/testdata/sf0.01").count() == 0
    assert len(made) == 1 and tracks == [24, 18]
