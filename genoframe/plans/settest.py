"""Gene-level rare-variant set tests (SKAT, burden, SKAT-O) on sparse genotypes.

Plan:
  1. per (phenotype, variant) allele frequency among the phenotype's samples ->
     MAF, Beta(1, 25) weight, flip flag, MAF cut (ST-10)          [groupBy]
  2. carrier / missing rows joined to the null model (residual r, variance v,
     covariates) of their sample                                   [broadcast join]
  3. per (phenotype, set): scores S = G'r, G'VG, G'VX from the carrier rows
     only; non-carriers enter through per-phenotype totals, so hom-ref
     genotypes are never materialised; then eigenvalues and p-values in numpy
                                                                   [applyInPandas]
A group holds the carrier rows of one set (rare variants: few carriers each) as they are, never
as a table of samples by variants, and one square matrix of its variants or of its carriers,
whichever are fewer.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.operators.joins import broadcast_if_small
from genoframe.plans import numerics as nm
from genoframe.plans.resampling import SAMPLED_CARRIERS, resampled_p

# SKAT-O correlation grid (rho = 1 evaluated at 0.999).
RHO_GRID = [0.0, 0.01, 0.04, 0.09, 0.16, 0.25, 0.5, 1.0]


def beta_weight(maf, a: float = 1.0, b: float = 25.0):
    """Beta(maf; 1, 25) density weight (25 (1 - maf)^24 for the default)."""
    from math import lgamma
    import math
    c = math.exp(lgamma(a + b) - lgamma(a) - lgamma(b))
    return c * np.power(maf, a - 1) * np.power(1 - maf, b - 1)


def _kept(lam: np.ndarray) -> np.ndarray:
    return lam[lam > 1e-8 * max(lam.max(initial=0.0), 1e-300)]


def _sym_eig(a: np.ndarray) -> np.ndarray:
    return _kept(np.linalg.eigvalsh((a + a.T) / 2)) if a.size else np.zeros(0)


def interlaced(d: np.ndarray, z: np.ndarray, rho: float | None) -> np.ndarray:
    """Eigenvalues of diag(d) + rho z z', or with ``rho`` None those of diag(d) with z projected out (but its zero); d ascending.

    Each lies between two neighbours of d, where the secular function rises through zero. A block of roots is found together: the poles
    below and those above are each replaced by one pole of the same value and slope, whose quadratic gives the next point (some six
    rounds); a point outside the bracket gives way to its middle.
    """
    one = 0.0 if rho is None else 1.0
    w = z * z * (1.0 if rho is None else rho)
    lo = d[:-1] if rho is None else d
    hi = d[1:] if rho is None else np.append(d[1:], d[-1] + w.sum())
    out = np.empty(len(lo))
    close = 1e-15 * max(float(np.abs(hi).max(initial=0.0)), 1e-300)
    step = max(1, (1 << 18) // max(1, len(d)))
    for at in range(0, len(lo), step):
        # roots as distances from their lower neighbour, so that close ones keep their digits
        base = lo[at: at + step]
        to = at + len(base)
        rows = np.arange(at, to)
        gap = d[None, :] - base[:, None]
        h = hi[at: to] - base
        a, b, x = np.zeros(len(base)), h.copy(), h / 2
        below = np.tri(len(base)) * w[at:to]
        above = w[at:to] - below
        for _ in range(60):
            with np.errstate(all="ignore"):
                r = 1.0 / (gap - x[:, None])
                if not np.isfinite(r @ w).all():
                    r[~np.isfinite(r)] = 0.0
                f = r * r
                low, slope_low = (m[:, :at] @ w[:at] + np.einsum("ij,ij->i", m[:, at:to], below) for m in (r, f))
                top, slope_top = (m[:, to:] @ w[to:] + np.einsum("ij,ij->i", m[:, at:to], above) for m in (r, f))
                up = one + low + top > 0
                a, b = np.where(up, a, x), np.where(up, x, b)
                left, right = slope_low * x * x, slope_top * (h - x) ** 2
                c = one + low + slope_low * x + top - slope_top * (h - x)
                mid = c * h + left + right
                root = np.sqrt(np.maximum((c * h - left) ** 2 + right * (right + 2 * (c * h + left)), 0.0))
                new = np.where(mid > 0, 2 * left * h / (mid + root), (mid - root) / (2 * c))
            new = np.where((new >= a) & (new <= b) & (new > 0) & (new < h), new, (a + b) / 2)
            open_ = (np.abs(new - x) > close) & (b - a > close)
            x = new
            if 2 * np.count_nonzero(open_) <= len(x):
                # roots that stand leave the block
                out[rows] = base + x
                rows, base, gap, h, a, b, x, below, above = (v[open_] for v in (rows, base, gap, h, a, b, x, below, above))
                if not len(rows):
                    break
        out[rows] = base + x
    return out


def skat_pvalue(S: np.ndarray, K: np.ndarray) -> float:
    """Variance-component score test: Q = S'S against eig(K), K = W G'PG W (S already weighted)."""
    return skat_from(float(S @ S), _sym_eig(K))


def skat_from(ss: float, lam: np.ndarray) -> float:
    return nm.mixture_chi2_sf(ss, lam) if lam.size else float("nan")


def burden_pvalue(S: np.ndarray, K: np.ndarray) -> float:
    return burden_from(float(S.sum()), float(K.sum()))


def burden_from(total: float, v: float) -> float:
    return nm.chi2_sf(total ** 2 / v, 1.0) if v > 0 else float("nan")


def skato_pvalue(S: np.ndarray, K: np.ndarray, rhos: Sequence[float] = RHO_GRID) -> float:
    """``skato_from`` of the weighted scores and their covariance."""
    if len(S) == 0:
        return float("nan")
    d, U = np.linalg.eigh((K + K.T) / 2)
    d = np.maximum(d, 0.0)
    return skato_from(float(S @ S), float(S.sum()), len(S), d, np.sqrt(d) * U.sum(axis=0), rhos)


def skato_from(ss: float, total: float, m: int, d: np.ndarray, z: np.ndarray, rhos: Sequence[float] = RHO_GRID) -> float:
    """Optimal mixture of burden and SKAT (Lee, Wu & Lin 2012).

    Q_rho = (1-rho) S'S + rho (1'S)^2.  Each Q_rho gets a p-value from its own
    eigenvalues; the minimum p is turned into per-rho quantiles and the final
    p-value integrates over the burden component (chi2_1) with the remaining
    variance-component part approximated by moment matching.

    ``ss`` = S'S, ``total`` = 1'S over ``m`` variants. With K = Z'Z, ``d`` (ascending) and the coordinates ``z`` of Z1 belong
    to the eigenvectors of ZZ'; every matrix here is diag(d) changed by z alone, so one decomposition serves all.
    """
    if m == 0 or not len(d):
        return float("nan")
    rr = np.minimum(np.asarray(rhos, float), 0.999)
    qs = [(1 - r) * ss + r * total ** 2 for r in rr]
    lams = [_kept(interlaced((1 - r) * d, z, r) if r > 0 else d) for r in rr]
    ps = np.array([nm.mixture_chi2_sf(q, lam) if lam.size else np.nan for q, lam in zip(qs, lams)])
    if np.all(np.isnan(ps)):
        return float("nan")
    pmin = float(np.nanmin(ps))
    # quantile of each Q_rho at 1 - pmin (Liu moment matching)
    qmin = []
    for lam in lams:
        mu_q, sigma_q, _, _, df = nm.liu_params(lam, mod=True)
        x = nm.chi2_isf(pmin, df)
        qmin.append((x - df) / np.sqrt(2 * df) * sigma_q + mu_q)
    qmin = np.array(qmin)
    # decomposition of K into the burden direction and the remainder (all from K itself)
    norm = float(z @ z)
    zz = norm / m ** 2                                   # sum(z_mean^2)
    if zz <= 0:
        return pmin
    lam2 = _kept(interlaced(d, z, None))
    if lam2.size == 0:
        return pmin
    y = d * z / m
    off = y - z * (float(z @ y) / norm)                  # the part of K's mean column off the burden direction
    mu_q = float(lam2.sum())
    var_remain = 4 * float(off @ off) / zz
    var_q = 2 * float(np.sum(lam2 ** 2)) + var_remain
    ker_q = float(np.sum(lam2 ** 4)) / float(np.sum(lam2 ** 2)) ** 2 * 12
    df = 12 / ker_q
    tau = np.array([m * m * r * zz + (1 - r) / zz * float(d @ (z * z)) / m ** 2 for r in rr])
    # integrate P(kappa < min_rho (q_rho - tau_rho x)/(1-rho)) * dchisq(x, 1) over x = u^2
    # (the substitution removes the x^-1/2 singularity of the chi2_1 density at 0)
    us = np.linspace(0.0, np.sqrt(40.0), 2001)
    xs = us * us
    dens = 2 * np.exp(-xs / 2) / np.sqrt(2 * np.pi)      # f(u^2) * 2u
    tmin = np.min((qmin[:, None] - tau[:, None] * xs[None, :]) / (1 - rr[:, None]), axis=0)
    std = (tmin - mu_q) / np.sqrt(var_q) * np.sqrt(2 * df) + df
    cdf = nm.chi2_cdf_vec(std, df)
    integral = float(np.trapezoid(cdf * dens, us))
    p = 1 - integral
    p = min(max(p, 0.0), 1.0)
    # where the integral reaches 1 to rounding, the bound over the grid stands
    bound = min(pmin * len(rr), 1.0)
    return float(min(p, bound)) if p > 0 else float(bound)


def gram(row: np.ndarray, col: np.ndarray, x: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """sum over rows of weight x x' (n x n), for a sparse matrix given by its entries; no row is written out whole.

    Rows of few entries add their pairs, about a million at a time; if rows are full, blocks of them are multiplied.
    """
    out = np.zeros((n, n))
    o = np.argsort(row, kind="stable")
    row, col, x = row[o], col[o], x[o]
    begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
    size = np.diff(np.append(begin, len(row)))
    pairs = size.astype(np.int64) ** 2
    if pairs.sum() * 50 < len(begin) * n * n:
        turn = np.cumsum(pairs) // (1 << 20)
        for a, b in zip(*_bounds(turn)):
            k = np.repeat(size[a:b], size[a:b])                            # each entry meets the entries of its row
            first = np.repeat(np.arange(begin[a], begin[a] + len(k)), k)
            off = np.arange(len(first)) - np.repeat(np.cumsum(k) - k, k)
            second = np.repeat(np.repeat(begin[a:b], size[a:b]), k) + off
            np.add.at(out.reshape(-1), col[first] * n + col[second], x[first] * x[second] * weight[row[first]])
        return out
    number = np.repeat(np.arange(len(begin)), size)
    for a, b in zip(*_bounds(np.arange(len(begin)) // max(1, (4 << 20) // max(n, 1)))):
        lo, hi = begin[a], begin[b] if b < len(begin) else len(row)
        D = np.zeros((b - a, n))
        D[number[lo:hi] - a, col[lo:hi]] = x[lo:hi]
        out += (D * weight[row[begin[a:b]]][:, None]).T @ D
    return out


def _bounds(label: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends of the runs of equal labels."""
    at = np.flatnonzero(np.diff(label)) + 1
    return ([0, *at.tolist()], [*at.tolist(), len(label)]) if len(label) else ([], [])


def set_pvalue(ri: np.ndarray, vi: np.ndarray, x: np.ndarray, S: np.ndarray, w: np.ndarray, v: np.ndarray, X: np.ndarray,
               xx: np.ndarray, method: str) -> float:
    """Asymptotic p-value of a set from the entries of its genotypes (sample number, variant number, value).

    ``S`` are the weighted scores, ``w`` the variant weights, ``v`` and ``X`` the variances and covariates of the samples with
    entries, ``xx`` = X'VX over all samples. K = W G'PG W has the same nonzero eigenvalues as its transposed product over the
    samples, so the smaller of the two is made; burden needs neither.
    """
    c, m = len(v), len(S)
    Z = X * v[:, None]
    burden = np.bincount(ri, weights=x * w[vi], minlength=c)               # G W 1
    if method == "burden":
        zb = Z.T @ burden
        return burden_from(float(S.sum()), float(v @ burden ** 2) - float(zb @ np.linalg.solve(xx, zb)))
    if m <= c:
        zg = np.stack([np.bincount(vi, weights=x * z[ri], minlength=m) for z in Z.T], axis=1)      # G'VX
        K = gram(ri, vi, x, v, m)
        K -= zg @ np.linalg.solve(xx, zg.T)
        K *= w
        K *= w[:, None]
        if method == "SKAT":
            return skat_pvalue(S, K)
        return skato_pvalue(S, K)
    M = gram(vi, ri, x, w * w, c)
    P = np.diag(v) - Z @ np.linalg.solve(xx, Z.T)
    e, U = np.linalg.eigh((P + P.T) / 2)
    root = U * np.sqrt(np.maximum(e, 0.0))                                 # P = root root'
    T = root.T @ M @ root
    if method == "SKAT":
        return skat_from(float(S @ S), _sym_eig(T))
    d, Q = np.linalg.eigh((T + T.T) / 2)
    return skato_from(float(S @ S), float(S.sum()), m, np.maximum(d, 0.0), Q.T @ (root.T @ burden))


def set_test(genotypes: DataFrame, sets: DataFrame, null: DataFrame, covars: DataFrame,
             cov_names: Sequence[str], max_maf: float | Sequence[float] = 0.01, method: str = "SKATO",
             key: str = "sample_id", vkey: str = "v", unit: str = "unit", resample: bool = True) -> DataFrame:
    """ST-7/8/9/10: one p-value per (phenotype, set), and per MAF cut if ``max_maf`` lists several (column ``max_maf``).

    ``sets`` = (v, unit); ``null`` from ``assoc.null_model``; ``covars`` holds the
    model covariates.  N counts all variants of the set (before the MAF cut);
    single-variant sets get a NULL p-value; missing calls are imputed by 2*MAF;
    variants with allele frequency > 0.5 are flipped to the minor allele. Variants above the
    largest cut are dropped before their carriers are shuffled; a NULL unit is no set. With ``resample`` a set of a
    0/1 phenotype that few samples carry is judged by case assignments among them (``resampling``; a flipped variant makes
    all samples carriers). A phenotype whose null model failed gives one row with nulls.
    """
    cov = list(cov_names)
    cuts = [float(max_maf)] if isinstance(max_maf, (int, float)) else sorted({float(x) for x in max_maf})
    sets = sets.where(F.col(unit).isNotNull())
    # (pheno, sample, resid, var_w, covariates): n x phenotypes rows, fitted once and
    # materialised in the checkpoint folder (it feeds the totals and the per-set join)
    failed = null.where(F.col(key).isNull()).select("pheno")
    nx = null.join(covars.select(key, *cov), key).checkpoint()
    # per-phenotype totals over all samples in the model (a few numbers per phenotype)
    tot = nx.groupBy("pheno").agg(
        F.count(F.lit(1)).alias("n"), F.sum("resid").alias("sum_r"), F.sum("var_w").alias("sum_v"),
        *[F.sum(F.col("var_w") * F.col(c)).alias(f"vx_{c}") for c in cov],
        *[F.sum(F.col("var_w") * F.col(a) * F.col(b)).alias(f"xx_{a}_{b}") for a in cov for b in cov])
    totals = {r["pheno"]: r.asDict() for r in tot.collect()}

    # read twice below (frequencies, carrier rows); a variant counts once here, however many sets it is in
    g = genotypes.select(vkey, key, "dosage").join(sets.select(vkey), vkey, "left_semi").checkpoint()
    gx = g.join(broadcast_if_small(nx.select("pheno", key, "kind", "mu", "resid", "var_w", *cov)), key)
    # allele frequency among the phenotype's samples
    af = gx.groupBy("pheno", vkey).agg(F.sum("dosage").alias("_ac"),
                                       F.count(F.when(F.col("dosage").isNull(), 1)).alias("_nm"))
    af = af.join(F.broadcast(tot.select("pheno", "n")), "pheno").select(
        "pheno", vkey, (F.col("_ac") / (2.0 * (F.col("n") - F.col("_nm")))).alias("af"))
    maf_col = F.least("af", 1 - F.col("af"))
    rows = gx.join(af.where((maf_col > 0) & (maf_col <= cuts[-1])), ["pheno", vkey]).join(sets.select(vkey, unit), vkey)
    set_n = sets.groupBy(unit).agg(F.count(F.lit(1)).alias("n_set"))
    rows = rows.join(set_n, unit)
    bc = genotypes.sparkSession.sparkContext.broadcast(totals)

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        ph, u, n_set = pdf["pheno"].iloc[0], pdf[unit].iloc[0], int(pdf["n_set"].iloc[0])
        if n_set == 1:
            return pd.DataFrame({"pheno": ph, unit: u, "max_maf": cuts, "p": np.nan})
        # a (sample, variant) is one call; numbers follow the order of samples and variants
        pdf = pdf.drop_duplicates([key, vkey], keep="last")
        vi, vs = pd.factorize(pdf[vkey], sort=True)
        si, _ = pd.factorize(pdf[key], sort=True)
        af = pdf.groupby(vi)["af"].first().to_numpy(float)
        per_s = pdf.groupby(si)[["mu", "resid", "var_w", *cov]].first().astype(float)
        binary = pdf["kind"].iloc[0] == "binary"
        d = pdf["dosage"].to_numpy(float)
        seen, ps = {}, []
        for cut in cuts:
            keep = np.minimum(af, 1 - af) <= cut
            ps.append(one_cut(ph, u, cut, keep, vi, si, d, af, per_s, binary, seen) if keep.any() else np.nan)
        return pd.DataFrame({"pheno": ph, unit: u, "max_maf": cuts, "p": ps})

    def one_cut(ph, u, cut, keep, vi, si, d, af, per_s, binary, seen) -> float:
        t = bc.value[ph]
        on = keep[vi]
        vi, si, d = (np.cumsum(keep) - 1)[vi[on]], si[on], d[on]
        samp, ri = np.unique(si, return_inverse=True)
        flip = af[keep] > 0.5
        maf = np.where(flip, 1 - af[keep], af[keep])
        w = beta_weight(maf)
        m, c = len(maf), len(samp)
        r, v = per_s["resid"].to_numpy()[samp], per_s["var_w"].to_numpy()[samp]
        X = np.column_stack([np.ones(c), per_s[cov].to_numpy()[samp]])
        a = np.where(flip, 2.0, 0.0)                       # coded genotype of a non-carrier
        coded = np.where(np.isnan(d), 2 * maf[vi], np.where(flip[vi], 2.0 - d, d))     # mean imputation
        xx = np.zeros((len(cov) + 1, len(cov) + 1))        # over all samples
        xx[0, 0] = t["sum_v"]
        for i, x in enumerate(cov):
            xx[0, i + 1] = xx[i + 1, 0] = t[f"vx_{x}"]
            for j, y in enumerate(cov):
                xx[i + 1, j + 1] = t[f"xx_{x}_{y}"]
        if resample and binary and not a.any():
            some = np.unique(ri[coded != 0])
            if 0 < len(some) <= SAMPLED_CARRIERS:
                G = np.zeros((len(some), m))
                hit = coded != 0
                G[np.searchsorted(some, ri[hit]), vi[hit]] = coded[hit]
                mu = per_s["mu"].to_numpy()[samp][some]
                p = resampled_p(G, w, mu, r[some] + mu, method, RHO_GRID, seed=zlib.crc32(f"{ph}/{u}/{cut}".encode()))
                if p is not None:
                    return p
        # a value that all samples share moves no covariance (the model has an intercept), so only differences from it are held
        if keep.tobytes() not in seen:
            diff = coded - a[vi]
            S = (np.bincount(vi, weights=diff * r[ri], minlength=m) + a * t["sum_r"]) * w
            seen[keep.tobytes()] = set_pvalue(ri, vi, diff, S, w, v, X, xx, method)
        return seen[keep.tobytes()]

    tested = rows.groupBy("pheno", unit).applyInPandas(test, f"pheno string, {unit} string, max_maf double, p double")
    # every (phenotype, set, cut) is reported: sets without rare carriers get n and a NULL p
    every = set_n.select(unit, F.col("n_set").cast("bigint").alias("n"),
                         F.explode(F.lit(sorted(totals)).cast("array<string>")).alias("pheno"))
    every = every.withColumn("max_maf", F.explode(F.array(*[F.lit(c) for c in cuts])))
    out = every.join(tested, ["pheno", unit, "max_maf"], "left").unionByName(failed, allowMissingColumns=True)
    if isinstance(max_maf, (int, float)):
        return out.select("pheno", unit, "n", "p")
    return out.select("pheno", "max_maf", unit, "n", "p")
