"""Small numerical helpers used inside grouped pandas functions (numpy only).

SciPy is not available, so the distribution tails are written out here:
regularised incomplete gamma/beta (series + continued fractions), the
chi-square tail and quantile, Student-t and normal tails, and the tail of a
weighted sum of 1-df chi-squares (Imhof's integral, Liu's moment matching as
fallback).  Model fitting: logistic IRLS and Firth-penalised logistic.
"""

from __future__ import annotations

import math

import numpy as np

_EPS = 1e-15
_FPMIN = 1e-300


# ------------------------------------------------------------------ incomplete gamma / beta
def _gammainc_series(a: float, x: float) -> float:
    ap, s, d = a, 1.0 / a, 1.0 / a
    for _ in range(1000):
        ap += 1
        d *= x / ap
        s += d
        if abs(d) < abs(s) * _EPS:
            break
    return s * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gammaincc_cf(a: float, x: float) -> float:
    b = x + 1 - a
    c = 1 / _FPMIN
    d = 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = _FPMIN if abs(d) < _FPMIN else d
        c = b + an / c
        c = _FPMIN if abs(c) < _FPMIN else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < _EPS:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def gammaincc(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    if x < a + 1:
        return max(0.0, 1.0 - _gammainc_series(a, x))
    return _gammaincc_cf(a, x)


def chi2_sf(x: float, df: float) -> float:
    return gammaincc(df / 2.0, x / 2.0) if x > 0 else 1.0


def chi2_isf(p: float, df: float) -> float:
    """x with P(chi2_df > x) = p (bisection on a bracket; monotone)."""
    if p >= 1:
        return 0.0
    lo, hi = 0.0, max(1.0, df)
    while chi2_sf(hi, df) > p:
        hi *= 2
        if hi > 1e8:
            return hi
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if chi2_sf(mid, df) > p:
            lo = mid
        else:
            hi = mid
        if hi - lo < 1e-12 * max(1.0, hi):
            break
    return 0.5 * (lo + hi)


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1, a - 1
    c, d = 1.0, 1 - qab * x / qap
    d = _FPMIN if abs(d) < _FPMIN else d
    d = 1 / d
    h = d
    for m in range(1, 1000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1 + aa * d
        d = _FPMIN if abs(d) < _FPMIN else d
        c = 1 + aa / c
        c = _FPMIN if abs(c) < _FPMIN else c
        d = 1 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1 + aa * d
        d = _FPMIN if abs(d) < _FPMIN else d
        c = 1 + aa / c
        c = _FPMIN if abs(c) < _FPMIN else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < _EPS:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def _betacf_vec(a, b, x, iters: int = 300):
    """Continued fraction of the incomplete beta for arrays (modified Lentz, fixed sweeps)."""
    qab, qap, qam = a + b, a + 1, a - 1
    c = np.ones_like(x)
    d = 1 - qab * x / qap
    d = np.where(np.abs(d) < _FPMIN, _FPMIN, d)
    d = 1 / d
    h = d.copy()
    for m in range(1, iters):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1 + aa * d
        d = np.where(np.abs(d) < _FPMIN, _FPMIN, d)
        c = 1 + aa / c
        c = np.where(np.abs(c) < _FPMIN, _FPMIN, c)
        d = 1 / d
        h = h * d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1 + aa * d
        d = np.where(np.abs(d) < _FPMIN, _FPMIN, d)
        c = 1 + aa / c
        c = np.where(np.abs(c) < _FPMIN, _FPMIN, c)
        d = 1 / d
        delta = d * c
        h = h * delta
        if np.all(np.abs(delta - 1) < _EPS):
            break
    return h


def betainc_vec(a, b, x):
    """Regularised incomplete beta I_x(a, b) for arrays (a, b, x broadcast together)."""
    a, b, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.asarray(x, float))
    out = np.full(x.shape, np.nan)
    out[x <= 0] = 0.0
    out[x >= 1] = 1.0
    mid = (x > 0) & (x < 1)
    if not mid.any():
        return out
    a, b, x = a[mid], b[mid], x[mid]
    from math import lgamma
    lg = np.vectorize(lgamma)
    lbt = lg(a + b) - lg(a) - lg(b) + a * np.log(x) + b * np.log1p(-x)
    front = x < (a + 1) / (a + b + 2)
    res = np.empty_like(x)
    if front.any():
        res[front] = np.exp(lbt[front]) * _betacf_vec(a[front], b[front], x[front]) / a[front]
    back = ~front
    if back.any():
        res[back] = 1 - np.exp(lbt[back]) * _betacf_vec(b[back], a[back], 1 - x[back]) / b[back]
    out[mid] = res
    return out


def t_two_sided_p_vec(t, df):
    """Two-sided Student-t p-values for arrays (NaN where t or df is not usable)."""
    t, df = np.broadcast_arrays(np.asarray(t, float), np.asarray(df, float))
    ok = np.isfinite(t) & (df > 0)
    out = np.full(t.shape, np.nan)
    if ok.any():
        out[ok] = betainc_vec(df[ok] / 2.0, 0.5, df[ok] / (df[ok] + t[ok] ** 2))
    return out


def chi2_cdf_vec(x, df: float, iters: int = 400):
    """Chi-square CDF for an array of x and one df (series / continued fraction, vectorised)."""
    x = np.asarray(x, float)
    a = df / 2.0
    z = x / 2.0
    out = np.zeros_like(z)
    pos = z > 0
    if not pos.any():
        return out
    zz = z[pos]
    from math import lgamma
    lga = lgamma(a)
    res = np.empty_like(zz)
    ser = zz < a + 1
    if ser.any():
        zs = zz[ser]
        ap = np.full_like(zs, a)
        s = np.full_like(zs, 1.0 / a)
        dd = s.copy()
        for _ in range(iters):
            ap = ap + 1
            dd = dd * zs / ap
            s = s + dd
            if np.all(np.abs(dd) < np.abs(s) * _EPS):
                break
        res[ser] = s * np.exp(-zs + a * np.log(zs) - lga)
    cf = ~ser
    if cf.any():
        zc = zz[cf]
        b = zc + 1 - a
        c = np.full_like(zc, 1 / _FPMIN)
        d = 1 / b
        h = d.copy()
        for i in range(1, iters):
            an = -i * (i - a)
            b = b + 2
            d = an * d + b
            d = np.where(np.abs(d) < _FPMIN, _FPMIN, d)
            c = b + an / c
            c = np.where(np.abs(c) < _FPMIN, _FPMIN, c)
            d = 1 / d
            delta = d * c
            h = h * delta
            if np.all(np.abs(delta - 1) < _EPS):
                break
        res[cf] = 1 - np.exp(-zc + a * np.log(zc) - lga) * h
    out[pos] = np.clip(res, 0.0, 1.0)
    return out


def t_two_sided_p(t: float, df: float) -> float:
    if not np.isfinite(t) or df <= 0:
        return float("nan")
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def normal_two_sided_p(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


# ------------------------------------------------------------------ mixtures of chi-squares
def liu_params(lam: np.ndarray, mod: bool = False) -> tuple[float, float, float, float, float]:
    """Moment-matching parameters (Liu, Tang & Zhang 2009): muQ, sigmaQ, muX, sigmaX, df.

    ``mod`` matches the kurtosis instead of the skewness when s1^2 <= s2.
    """
    c1, c2, c3, c4 = (float(np.sum(lam ** k)) for k in (1, 2, 3, 4))
    s1, s2 = c3 / c2 ** 1.5, c4 / c2 ** 2
    if s1 ** 2 > s2:
        a = 1 / (s1 - math.sqrt(s1 ** 2 - s2))
        delta = s1 * a ** 3 - a ** 2
        df = a ** 2 - 2 * delta
    elif mod:
        a = 1 / math.sqrt(s2)
        delta = 0.0
        df = 1 / s2
    else:
        a = 1 / s1
        delta = 0.0
        df = c2 ** 3 / c3 ** 2
    mu_x, sigma_x = df + delta, math.sqrt(2) * a
    return c1, math.sqrt(2 * c2), mu_x, sigma_x, df


def liu_sf(q: float, lam: np.ndarray) -> float:
    mu_q, sigma_q, mu_x, sigma_x, df = liu_params(lam)
    return chi2_sf((q - mu_q) / sigma_q * sigma_x + mu_x, df)


def imhof_sf(q: float, lam: np.ndarray, n: int = 4000) -> float:
    """P(sum lam_k chi2_1 > q) by Imhof's integral, u = (t/(1-t))^3, midpoint rule."""
    lam = lam[lam > 1e-12 * max(lam.max(), 1e-300)]
    if lam.size == 0:
        return 1.0 if q < 0 else 0.0
    scale = lam.max()
    lam, q = lam / scale, q / scale
    t = (np.arange(n) + 0.5) / n
    u = (t / (1 - t)) ** 3                      # cubic map: integrable ends at t=0 and t=1
    du = 3 * t ** 2 / (1 - t) ** 4 / n
    theta, log_rho = -0.5 * q * u, np.zeros(n)
    step = max(1, (1 << 20) // len(lam))         # points at a time: a million products
    for at in range(0, n, step):
        x = np.outer(u[at: at + step], lam)
        theta[at: at + step] += 0.5 * np.sum(np.arctan(x), axis=1)
        log_rho[at: at + step] = 0.25 * np.sum(np.log1p(x * x), axis=1)
    integrand = np.sin(theta) * np.exp(-log_rho) / u
    return float(0.5 + np.sum(integrand * du) / math.pi)


def saddlepoint_sf(q: float, lam: np.ndarray) -> float:
    """Saddlepoint tail (Lugannani-Rice form) of sum lam_k chi2_1; accurate in the far tail."""
    lam = lam / lam.max()
    qs = q
    mean = float(lam.sum())
    if qs <= mean:
        return float("nan")
    # K'(t) = sum lam / (1 - 2 t lam) = q, t in (0, 1/(2 max lam))
    hi = 0.5 / lam.max() * (1 - 1e-12)
    lo = 0.0
    for _ in range(200):
        t = 0.5 * (lo + hi)
        if float(np.sum(lam / (1 - 2 * t * lam))) > qs:
            hi = t
        else:
            lo = t
    t = 0.5 * (lo + hi)
    k = -0.5 * float(np.sum(np.log1p(-2 * t * lam)))
    k2 = float(np.sum(2 * lam ** 2 / (1 - 2 * t * lam) ** 2))
    w = math.sqrt(max(2 * (t * qs - k), 0.0))
    v = t * math.sqrt(k2)
    if w <= 0 or v <= 0:
        return float("nan")
    z = w + math.log(v / w) / w
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def mixture_chi2_sf(q: float, lam: np.ndarray) -> float:
    """Tail of a weighted chi-square mixture: Imhof, with Liu's method when Imhof is unreliable."""
    lam = np.asarray(lam, dtype=float)
    lam = lam[lam > 1e-10 * max(float(lam.max(initial=0.0)), 1e-300)]
    if lam.size == 0:
        return float("nan")
    if lam.size == 1:                      # a scaled chi-square: exact
        return chi2_sf(q / lam[0], 1.0)
    scale = float(lam.max())
    lam_s, q_s = lam / scale, q / scale
    p = imhof_sf(q_s, lam_s)
    if not np.isfinite(p) or p < 0.01:
        sp = saddlepoint_sf(q_s, lam_s)     # relative accuracy in the tail
        p = sp if np.isfinite(sp) else liu_sf(q_s, lam_s)
    return float(min(max(p, 0.0), 1.0))


# ------------------------------------------------------------------ regression
def full_rank(A: np.ndarray, tol: float = 1e-10) -> np.ndarray:
    """Which cross-product matrices of a batch (b, k, k) have full rank: the least eigenvalue after scaling to unit diagonal."""
    d = np.einsum("bii->bi", A)
    ok = np.isfinite(A).all(axis=(1, 2)) & (d > 0).all(axis=1)
    if ok.any():
        s = 1 / np.sqrt(d[ok])
        ok[ok] = np.linalg.eigvalsh(A[ok] * s[:, :, None] * s[:, None, :])[:, 0] > tol
    return ok


def full_rank_inverse(A: np.ndarray, tol: float = 1e-10) -> tuple[np.ndarray, np.ndarray]:
    """``full_rank`` of a batch and the inverses (zeros where the rank is not full).

    Scaled to unit diagonal, a matrix is reduced by Gauss and Jordan's steps over the whole batch at once. Its least eigenvalue is
    at least its determinant divided by e, so that only those of small determinant need their eigenvalues."""
    d = np.einsum("bii->bi", A)
    ok, inverse = np.isfinite(A).all(axis=(1, 2)) & (d > 0).all(axis=1), np.zeros(A.shape)
    every, rest = np.flatnonzero(ok), []
    for lo in range(0, len(every), 256):                   # so many stay in the cache
        at = every[lo: lo + 256]
        s = (1 / np.sqrt(d[at])).T
        m = np.ascontiguousarray(A[at].transpose(1, 2, 0)) * (s[:, None] * s[None])
        det = np.ones(len(at))
        with np.errstate(all="ignore"):
            for i in range(len(m)):
                pivot = m[i, i].copy()
                det *= np.maximum(pivot, 0.0)
                row, col = m[i] / pivot, m[:, i].copy()
                m -= col[:, None] * row[None]
                m[i], m[:, i], m[i, i] = row, -col / pivot, 1 / pivot
            m *= s[:, None] * s[None]
        sure = det > max(1e-4, 3 * tol)
        inverse[at[sure]] = m[:, :, sure].transpose(2, 0, 1)
        rest.append(at[~sure])
    rest = np.concatenate(rest) if rest else every
    ok[rest] = full_rank(A[rest], tol)
    rest = rest[ok[rest]]
    inverse[rest] = np.linalg.inv(A[rest])
    return ok, inverse


def logistic_batch(X: np.ndarray, G: np.ndarray, y: np.ndarray, max_iter: int = 25, tol: float = 1e-8):
    """``logistic_irls`` of y on [1, g, X] for every row g of G (variants x samples) at once; a NaN genotype leaves its sample out.

    Returns (beta of g, its se, converged): the design columns but g are shared, so information
    matrices and scores of all variants are a few matrix products.
    """
    b, n = G.shape
    C = np.column_stack([np.ones(n), X])                   # shared columns
    k = C.shape[1] + 1                                     # g comes last here
    pairs = np.einsum("ni,nj->nij", C, C).reshape(n, -1)
    use = ~np.isnan(G)
    g = np.where(use, G, 0.0)
    beta = np.zeros((b, k))
    out_beta, out_se, done = np.full(b, np.nan), np.full(b, np.nan), np.zeros(b, bool)
    live = np.arange(b)
    for _ in range(max_iter):
        if not len(live):
            break
        gl, ul = g[live], use[live]
        eta = np.clip(beta[live, :-1] @ C.T + beta[live, -1:] * gl, -30, 30)
        mu = 1 / (1 + np.exp(-eta))
        w = mu * (1 - mu) * ul
        r = (y - mu) * ul
        info = np.empty((len(live), k, k))
        info[:, :-1, :-1] = (w @ pairs).reshape(-1, k - 1, k - 1)
        info[:, :-1, -1] = info[:, -1, :-1] = (w * gl) @ C
        info[:, -1, -1] = (w * gl * gl).sum(axis=1)
        ok = full_rank(info)
        live, info, r, gl = live[ok], info[ok], r[ok], gl[ok]
        if not len(live):
            break
        score = np.column_stack([r @ C, (r * gl).sum(axis=1)])
        inv = np.linalg.inv(info)
        step = np.einsum("bij,bj->bi", inv, score)
        beta[live] += step
        end = np.abs(step).max(axis=1) < tol
        fine = end & (np.abs(beta[live]) < 15).all(axis=1)
        out_beta[live[fine]], out_se[live[fine]] = beta[live[fine], -1], np.sqrt(inv[fine, -1, -1])
        done[live[fine]] = True
        live = live[~end]
    return out_beta, out_se, done


def logistic_irls(X: np.ndarray, y: np.ndarray, max_iter: int = 25, tol: float = 1e-8):
    """Plain logistic regression.  Returns (beta, cov, converged)."""
    beta = np.zeros(X.shape[1])
    for _ in range(max_iter):
        eta = np.clip(X @ beta, -30, 30)
        mu = 1 / (1 + np.exp(-eta))
        w = mu * (1 - mu)
        info = X.T @ (X * w[:, None])
        try:
            step = np.linalg.solve(info, X.T @ (y - mu))
        except np.linalg.LinAlgError:
            return beta, None, False
        beta = beta + step
        if np.max(np.abs(step)) < tol:
            try:
                return beta, np.linalg.inv(info), bool(np.all(np.abs(beta) < 15))
            except np.linalg.LinAlgError:
                return beta, None, False
    return beta, None, False


def logistic_firth(X: np.ndarray, y: np.ndarray, max_iter: int = 50, tol: float = 1e-8):
    """Firth-penalised logistic regression (Jeffreys prior).  Returns (beta, cov, converged)."""
    beta = np.zeros(X.shape[1])
    for _ in range(max_iter):
        eta = np.clip(X @ beta, -30, 30)
        mu = 1 / (1 + np.exp(-eta))
        w = mu * (1 - mu)
        info = X.T @ (X * w[:, None])
        try:
            inv = np.linalg.inv(info)
        except np.linalg.LinAlgError:
            return beta, None, False
        h = np.einsum("ij,jk,ik->i", X * np.sqrt(w)[:, None], inv, X * np.sqrt(w)[:, None])
        score = X.T @ (y - mu + h * (0.5 - mu))
        step = inv @ score
        mx = np.max(np.abs(step))
        if mx > 5:
            step = step * (5 / mx)
        beta = beta + step
        if mx < tol:
            return beta, inv, True
    return beta, None, False


def linear_fit(X: np.ndarray, y: np.ndarray):
    """OLS: (beta, residuals, sigma2)."""
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    r = y - X @ beta
    df = max(len(y) - X.shape[1], 1)
    return beta, r, float(r @ r / df)
