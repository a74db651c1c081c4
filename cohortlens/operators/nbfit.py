"""Vectorised negative-binomial helpers for one Arrow batch of genes.

Arrays are genes x samples.  Formulas follow Love, Huber & Anders 2014 (Genome
Biology 15:550).  These helpers only ever see one batch; grouping, medians,
trend and adjustment are Spark jobs in ``model``.
"""

from __future__ import annotations

import math

import numpy as np

MIN_DISP = 1e-8
MIN_MU = 0.5
RIDGE = 1e-6 / math.log(2.0) ** 2


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln gamma for positive arrays: Stirling series after shifting small arguments up by 8."""
    small = x < 8.0
    z = np.where(small, x + 8.0, x)
    inv = 1.0 / z
    inv2 = inv * inv
    series = inv * (1 / 12.0 - inv2 * (1 / 360.0 - inv2 * (1 / 1260.0 - inv2 / 1680.0)))
    out = (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series
    if small.any():
        xs = x[small]
        product = np.ones_like(xs)
        for i in range(8):
            product *= xs + i
        out[small] -= np.log(product)
    return out


def trigamma(x: float) -> float:
    """Second derivative of ln gamma."""
    total = 0.0
    while x < 8.0:
        total += 1.0 / (x * x)
        x += 1.0
    i = 1.0 / (x * x)
    return total + 1.0 / x + i / 2 + i / x * (1 / 6.0 - i * (1 / 30.0 - i / 42.0))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def f_quantile(prob: float, d1: float, d2: float) -> float:
    """Quantile of the F distribution by bisection on its distribution function."""
    lo, hi = 0.0, 1.0
    for _ in range(200):
        mid = (lo + hi) / 2
        if incomplete_beta(d1 / 2, d2 / 2, mid) < prob:
            lo = mid
        else:
            hi = mid
    x = (lo + hi) / 2
    return d2 * x / (d1 * (1.0 - x))


def information(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """X'WX per gene."""
    n, p = x.shape
    return (w @ (x[:, :, None] * x[:, None, :]).reshape(n, p * p)).reshape(-1, p, p)


def _log_det(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Logarithm of the determinant of X'WX per gene by elimination over all genes at once, 0 where it is not positive."""
    n, p = x.shape
    m = ((x[:, :, None] * x[:, None, :]).reshape(n, p * p).T @ w.T).reshape(p, p, -1)
    total, valid = np.zeros(len(w)), np.ones(len(w), dtype=bool)
    for i in range(p):
        valid &= m[i, i] > 0
        pivot = np.where(valid, m[i, i], 1.0)
        total += np.log(pivot)
        m[i + 1:, i + 1:] -= m[i + 1:, i, None] * (m[i, i + 1:] / pivot)[None]
    return np.where(valid, total, 0.0)


def profile(log_alpha: np.ndarray, k: np.ndarray, mu: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cox-Reid adjusted profile log-likelihood, constants dropped."""
    a = np.exp(log_alpha)[:, None]
    r = 1.0 / a
    # ln(mu + 1/a) is ln(1 + a mu) - ln a: one logarithm a cell beside ln gamma, whose second term is the same in all cells of a gene.
    growth = np.log1p(mu * a)
    ll = log_gamma(k + r) - log_gamma(r) - k * (growth - log_alpha[:, None]) - r * growth
    return ll.sum(axis=1) - 0.5 * _log_det(x, mu / (1.0 + mu * a))


#: Genes that are maximised together, so that their arrays stay in the processor's cache.
GENES_AT_ONCE = 1024


def maximise_dispersion(k: np.ndarray, mu: np.ndarray, x: np.ndarray, prior_mean: np.ndarray | None = None,
                        prior_var: float | None = None) -> np.ndarray:
    """Dispersion at the maximum of the (optionally penalised) profile likelihood, in blocks of genes."""
    parts = [slice(i, i + GENES_AT_ONCE) for i in range(0, len(k), GENES_AT_ONCE)]
    return np.concatenate([np.zeros(0)] + [
        _maximise_block(k[at], mu[at], x, None if prior_mean is None else prior_mean[at], prior_var) for at in parts])


def _maximise_block(k: np.ndarray, mu: np.ndarray, x: np.ndarray, prior_mean: np.ndarray | None,
                    prior_var: float | None) -> np.ndarray:
    """A coarse grid brackets the maximum of each gene, golden-section steps close in on all genes at once."""
    genes = k.shape[0]
    lo, hi = math.log(MIN_DISP / 10), math.log(max(10.0, k.shape[1]))

    def objective(la: np.ndarray) -> np.ndarray:
        value = profile(la, k, mu, x)
        if prior_mean is not None:
            value = value - (la - prior_mean) ** 2 / (2.0 * prior_var)
        return value

    grid = np.linspace(lo, hi, 32)
    scores = np.stack([objective(np.full(genes, g)) for g in grid])
    best = scores.argmax(axis=0)
    a, b = grid[np.maximum(best - 1, 0)], grid[np.minimum(best + 1, len(grid) - 1)]
    g = (math.sqrt(5.0) - 1) / 2
    c, d = b - g * (b - a), a + g * (b - a)
    fc, fd = objective(c), objective(d)
    for _ in range(34):
        left = fc > fd
        b, a = np.where(left, d, b), np.where(left, a, c)
        new_c, new_d = b - g * (b - a), a + g * (b - a)
        point = np.where(left, new_c, new_d)
        f = objective(point)
        fc, fd = np.where(left, f, fd), np.where(left, fc, f)
        c, d = new_c, new_d
    return np.exp((a + b) / 2)


def linear_mu(k: np.ndarray, nf: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Least-squares fit of normalised counts, on the count scale."""
    hat = x @ np.linalg.pinv(x)
    return np.maximum((k / nf) @ hat.T * nf, MIN_MU)


def moments_dispersion(k: np.ndarray, nf: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Starting value: the smaller of the residual and the plain moment estimate."""
    m, p = x.shape
    q = k / nf
    fit = np.maximum(q @ (x @ np.linalg.pinv(x)).T, 1.0)
    rough = (((q - fit) ** 2 - fit) / fit**2).sum(axis=1) / (m - p)
    mean, var = q.mean(axis=1), q.var(axis=1, ddof=1)
    plain = (var - np.mean(1.0 / nf, axis=1) * mean) / np.maximum(mean, 1e-300) ** 2
    return np.clip(np.minimum(np.maximum(rough, 0.0), plain), MIN_DISP, max(10.0, m))


def irls(k: np.ndarray, nf: np.ndarray, x: np.ndarray, alpha: np.ndarray, rounds: int = 100) -> dict[str, np.ndarray]:
    """Negative-binomial GLM with log link, natural-log coefficients and standard errors."""
    genes, p = k.shape[0], x.shape[1]
    ridge = np.eye(p) * RIDGE
    a = alpha[:, None]
    beta = (np.log(k / nf + 0.1)) @ np.linalg.pinv(x).T
    mu = np.maximum(nf * np.exp(beta @ x.T), MIN_MU)
    deviance = np.full(genes, np.inf)
    active = np.ones(genes, dtype=bool)
    converged = np.zeros(genes, dtype=bool)
    for _ in range(rounds):
        if not active.any():
            break
        ka, na, aa, ma = k[active], nf[active], a[active], mu[active]
        w = ma / (1.0 + aa * ma)
        z = np.log(ma / na) + (ka - ma) / ma
        xtwz = np.einsum("ni,gn->gi", x, w * z)
        b = np.linalg.solve(information(x, w) + ridge, xtwz[..., None])[..., 0]
        ma = np.maximum(na * np.exp(np.clip(b @ x.T, -60, 60)), MIN_MU)
        r = 1.0 / aa
        dev = -2.0 * (ka * np.log(ma / (ma + r)) - r * np.log1p(aa * ma)).sum(axis=1)
        done = np.abs(dev - deviance[active]) / (np.abs(dev) + 0.1) < 1e-8
        beta[active], mu[active], deviance[active] = b, ma, dev
        where = np.flatnonzero(active)
        converged[where[done]] = True
        active[where[done]] = False
    w = mu / (1.0 + a * mu)
    info = information(x, w)
    inverse = np.linalg.inv(info + ridge)
    cov = inverse @ info @ inverse
    half = np.sqrt(w)[..., None] * x[None]
    leverage = np.einsum("gni,gij,gnj->gn", half, inverse, half, optimize=True)
    return {
        "beta": beta, "mu": mu, "converged": converged, "leverage": leverage,
        "se": np.sqrt(np.maximum(np.einsum("gii->gi", cov), 0.0)),
    }


def cooks(k: np.ndarray, fit: dict[str, np.ndarray], alpha: np.ndarray, p: int) -> np.ndarray:
    """Influence per cell: squared Pearson residual, scaled by leverage."""
    mu, h = fit["mu"], np.minimum(fit["leverage"], 1.0 - 1e-12)
    r2 = (k - mu) ** 2 / (mu + alpha[:, None] * mu**2)
    return r2 / p * h / (1.0 - h) ** 2


# Fixed values of the trimmed variance: (largest cell size, share trimmed at either end, factor
# that makes the trimmed mean of squares unbiased for normal data).
TRIMMED_VARIANCE = ((3, 1 / 3, 2.04), (23, 1 / 4, 1.86), (10**9, 1 / 8, 1.51))
ROBUST_MIN_DISP = 0.04


def robust_dispersion(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Moment dispersion from trimmed variances, which an outlying count cannot inflate.

    Variances are taken within design cells of three or more replicates (the
    largest one counts), or over all samples when no cell is that large.
    """
    _, cell = np.unique(x, axis=0, return_inverse=True)
    cell = np.ravel(cell)
    large = [c for c in np.unique(cell) if (cell == c).sum() >= 3]
    if large:
        variance = np.max([_trimmed_variance(q[:, cell == c]) for c in large], axis=0)
    else:
        center = trimmed_mean(q, 1 / 8)
        variance = 1.51 * trimmed_mean((q - center[:, None]) ** 2, 1 / 8)
    mean = np.maximum(q.mean(axis=1), 1e-300)
    return np.maximum((variance - mean) / mean**2, ROBUST_MIN_DISP)


def _trimmed_variance(q: np.ndarray) -> np.ndarray:
    trim, factor = next((t, f) for size, t, f in TRIMMED_VARIANCE if q.shape[1] <= size)
    center = trimmed_mean(q, trim)
    return factor * trimmed_mean((q - center[:, None]) ** 2, trim)


def design_cells(x: np.ndarray) -> np.ndarray:
    """Replicates of each sample: samples with the same design row."""
    _, inverse, counts = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    return counts[np.ravel(inverse)]


def trimmed_mean(q: np.ndarray, trim: float = 0.2) -> np.ndarray:
    cut = int(q.shape[1] * trim)
    ordered = np.sort(q, axis=1)
    return ordered[:, cut: q.shape[1] - cut].mean(axis=1)


def two_sided_p(z: np.ndarray) -> np.ndarray:
    return np.array([math.erfc(abs(v) / math.sqrt(2.0)) for v in z])


def lowess(x: np.ndarray, y: np.ndarray, span: float = 0.2, robust: int = 3) -> np.ndarray:
    """Locally weighted line with bisquare robustness, for the 50 points of the filter curve."""
    n = len(x)
    width = max(2, int(span * n + 1e-7))
    weights, fitted = np.ones(n), np.zeros(n)
    for _ in range(robust + 1):
        for i in range(n):
            distance = np.abs(x - x[i])
            h = np.sort(distance)[width - 1]
            w = np.where(distance < 0.999 * h, (1 - (distance / max(h, 1e-300)) ** 3) ** 3, 0.0)
            w = np.where(distance <= 0.001 * h, 1.0, w) * weights
            total = w.sum()
            if total <= 0:
                fitted[i] = y[i]
                continue
            xm, ym = (w * x).sum() / total, (w * y).sum() / total
            spread = (w * (x - xm) ** 2).sum()
            slope = (w * (x - xm) * y).sum() / spread if spread > 1e-12 * total else 0.0
            fitted[i] = ym + slope * (x[i] - xm)
        residual = np.abs(y - fitted)
        scale = 6.0 * np.median(residual)
        if scale < 1e-12:
            break
        weights = np.where(residual < scale, (1 - (residual / scale) ** 2) ** 2, 0.0)
    return fitted
