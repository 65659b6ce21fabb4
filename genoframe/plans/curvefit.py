"""ST-11: logistic decay of ALSFRS-R totals, 48 / (1 + exp((t - D50) / Dx)), per patient.

Start values are closed form and JVM-side: for 0 < y < 48, ln((48 - y) / y) is
linear in t with slope 1/Dx and intercept -D50/Dx, so a weighted least-squares
line per patient (grouped sums) gives the start.  A deterministic grid over the
admissible box (D50 3..120 months, Dx 1..10) adds further starts; each start
is refined by Levenberg-Marquardt in a grouped pandas function (one group =
one patient's visits).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoframe.operators.filters import between

TOP = 48.0
# Admissible start box of the multistart fit.
D50_RANGE = (3.0, 120.0)
DX_RANGE = (1.0, 10.0)
# Patients by visits fitted together (each cell is met by every start of the grid).
CELLS = 1 << 17


def _model(t, d50, dx):
    return TOP / (1 + np.exp(np.clip((t - d50) / dx, -50, 50)))


def _lm(t, y, d50, dx, iters: int = 100):
    lam = 1e-3
    p = np.array([d50, dx], float)
    f = _model(t, *p)
    sse = float(((y - f) ** 2).sum())
    for _ in range(iters):
        e = np.exp(np.clip((t - p[0]) / p[1], -50, 50))
        den = (1 + e) ** 2
        j0 = TOP * e / den / p[1]                       # d f / d D50
        j1 = TOP * e * (t - p[0]) / den / p[1] ** 2     # d f / d Dx
        J = np.column_stack([j0, j1])
        r = y - f
        A = J.T @ J
        g = J.T @ r
        try:
            step = np.linalg.solve(A + lam * np.diag(np.diag(A) + 1e-12), g)
        except np.linalg.LinAlgError:
            break
        cand = p + step
        if cand[1] <= 1e-6:
            lam *= 10
            continue
        fc = _model(t, *cand)
        sc = float(((y - fc) ** 2).sum())
        if sc < sse:
            p, f, done = cand, fc, sse - sc < 1e-14 * max(sse, 1e-300)
            sse = sc
            lam = max(lam / 10, 1e-12)
            if done or np.max(np.abs(step)) < 1e-10:
                break
        else:
            lam *= 10
            if lam > 1e12:
                break
    return p, sse


def fit_one(t: np.ndarray, y: np.ndarray, start=None, grid: int = 8, refine: int = 3) -> tuple[float, float] | None:
    """Deterministic multistart: score the closed-form start and a grid over the box by
    SSE (vectorised), then refine the best few by Levenberg-Marquardt."""
    d_grid, x_grid = np.meshgrid(np.linspace(*D50_RANGE, grid), np.linspace(*DX_RANGE, max(2, grid // 2)))
    cand = np.column_stack([d_grid.ravel(), x_grid.ravel()])
    if start is not None and np.all(np.isfinite(start)) and start[1] > 0:
        cand = np.vstack([np.asarray(start, float)[None, :], cand])
    pred = TOP / (1 + np.exp(np.clip((t[None, :] - cand[:, :1]) / cand[:, 1:], -50, 50)))
    sse0 = ((y[None, :] - pred) ** 2).sum(axis=1)
    order = np.argsort(sse0)[:refine]
    best = None
    for i in order:
        p, sse = _lm(t, y, *cand[i])
        if np.all(np.isfinite(p)) and (best is None or sse < best[1] - 1e-12):
            best = (p, sse)
        if best is not None and best[1] < 1e-20:
            break
    return None if best is None else (float(best[0][0]), float(best[0][1]))


def _lm_batch(t: np.ndarray, y: np.ndarray, mask: np.ndarray, p: np.ndarray, iters: int = 60):
    """Levenberg-Marquardt on many patients at once: t, y, mask (P, T); p (P, 2) starts."""
    p = p.copy()
    lam = np.full(len(p), 1e-3)

    def sse_of(pp):
        f = TOP / (1 + np.exp(np.clip((t - pp[:, :1]) / pp[:, 1:], -50, 50)))
        return (((y - f) * mask) ** 2).sum(axis=1), f

    sse, f = sse_of(p)
    for _ in range(iters):
        e = np.exp(np.clip((t - p[:, :1]) / p[:, 1:], -50, 50))
        j0 = TOP * e / (1 + e) ** 2 / p[:, 1:] * mask
        j1 = j0 * (t - p[:, :1]) / p[:, 1:]
        r = (y - f) * mask
        a00, a01, a11 = (j0 * j0).sum(1), (j0 * j1).sum(1), (j1 * j1).sum(1)
        g0, g1 = (j0 * r).sum(1), (j1 * r).sum(1)
        d00, d11 = a00 * (1 + lam) + 1e-12, a11 * (1 + lam) + 1e-12
        det = d00 * d11 - a01 * a01
        ok = np.abs(det) > 1e-300
        det = np.where(ok, det, 1.0)
        step = np.column_stack([(d11 * g0 - a01 * g1) / det, (d00 * g1 - a01 * g0) / det])
        step[~ok] = 0
        cand = p + step
        cand[:, 1] = np.where(cand[:, 1] > 1e-6, cand[:, 1], p[:, 1])
        sse_c, f_c = sse_of(cand)
        better = sse_c < sse
        p = np.where(better[:, None], cand, p)
        f = np.where(better[:, None], f_c, f)
        sse = np.where(better, sse_c, sse)
        lam = np.where(better, np.maximum(lam / 10, 1e-12), np.minimum(lam * 10, 1e12))
    return p, sse


def fit_batch(pids: np.ndarray, t: np.ndarray, y: np.ndarray, mask: np.ndarray, start: np.ndarray,
              grid: int = 8, refine: int = 3) -> pd.DataFrame:
    """Deterministic multistart for a batch of patients: SSE of the closed-form start and
    a grid over the box, then LM from the ``refine`` best starts of each patient."""
    d_grid, x_grid = np.meshgrid(np.linspace(*D50_RANGE, grid), np.linspace(*DX_RANGE, max(2, grid // 2)))
    box = np.column_stack([d_grid.ravel(), x_grid.ravel()])
    P = len(pids)
    cands = np.repeat(box[None, :, :], P, axis=0)                           # (P, C, 2)
    okst = np.all(np.isfinite(start), axis=1) & (start[:, 1] > 0)
    st = np.where(okst[:, None], start, box[0])
    cands = np.concatenate([st[:, None, :], cands], axis=1)
    pred = TOP / (1 + np.exp(np.clip((t[:, None, :] - cands[:, :, :1]) / cands[:, :, 1:], -50, 50)))
    sse0 = (((y[:, None, :] - pred) * mask[:, None, :]) ** 2).sum(axis=2)  # (P, C)
    order = np.argsort(sse0, axis=1)[:, :refine]
    best_p = np.full((P, 2), np.nan)
    best_s = np.full(P, np.inf)
    for k in range(order.shape[1]):
        p0 = cands[np.arange(P), order[:, k]]
        p, sse = _lm_batch(t, y, mask, p0)
        take = np.isfinite(sse) & (sse < best_s - 1e-12)
        best_p[take], best_s[take] = p[take], sse[take]
    return pd.DataFrame({"pid": pids, "D50": best_p[:, 0], "Dx": best_p[:, 1]})


def _pad(pdf: pd.DataFrame, pid: str):
    pdf = pdf.sort_values([pid, "_t"])
    codes, uniq = pd.factorize(pdf[pid], sort=False)
    counts = np.bincount(codes)
    T = int(counts.max())
    pos = np.arange(len(pdf)) - np.repeat(np.cumsum(counts) - counts, counts)
    t = np.zeros((len(uniq), T))
    y = np.zeros((len(uniq), T))
    mask = np.zeros((len(uniq), T))
    t[codes, pos] = pdf["_t"].to_numpy(float)
    y[codes, pos] = pdf["_y"].to_numpy(float)
    mask[codes, pos] = 1.0
    first = pdf.groupby(codes)[["_d500", "_dx0"]].first().to_numpy(float)
    return np.asarray(uniq), t, y, mask, first


def _fit_rows(pdf: pd.DataFrame, pid: str):
    """Fits of whole patients, one frame per ``CELLS``: those of like length together, so a long one pads no others."""
    codes, uniq = pd.factorize(pdf[pid], sort=False)
    counts = np.bincount(codes)
    part = np.zeros(len(uniq), dtype=int)
    if len(uniq) * counts.max() > CELLS:
        n, k = 0, 0
        for i in np.argsort(counts, kind="stable"):
            n, k = (n + 1, k) if (n + 1) * counts[i] <= CELLS or not n else (1, k + 1)
            part[i] = k
    for k in range(part.max() + 1):
        ids, tt, yy, mm, st = _pad(pdf[part[codes] == k], pid)
        yield fit_batch(ids, tt, yy, mm, st[:, [0, 1]]).rename(columns={"pid": pid})


def fit_d50(points: DataFrame, pid: str = "pid", t: str = "t", y: str = "total",
            min_points: int = 3) -> DataFrame:
    """Per-patient (pid, D50, Dx) from (pid, t months, total) rows with 1 <= total <= 48.

    Patients are co-located by a hash shuffle on pid and fitted many at a time
    per Arrow batch (a patient split across two batches is carried over)."""
    # count and sums are set beside the patient's rows where these lie sorted, so nothing is joined back
    pts = between(points.dropna(subset=[pid, t, y]), y, 1, TOP)
    own = Window.partitionBy(pid)
    # weighted least squares of z = ln((48 - y) / y) on t, weights (y (48 - y))^2 (delta
    # method: var z ~ 1 / (y (48 - y))^2), so plateau points whose logit is imprecise count little
    ok = (F.col(y) > 0) & (F.col(y) < TOP)
    z = F.when(ok, F.log((TOP - F.col(y)) / F.col(y)))
    w = F.when(ok, F.pow(F.col(y) * (TOP - F.col(y)) / TOP, 2)).otherwise(F.lit(0.0))
    tt = F.col(t).cast("double")
    s = pts.select(pid, tt.alias("_t"), F.col(y).cast("double").alias("_y"), F.count(F.lit(1)).over(own).alias("n"),
                   *[F.sum(c).over(own).alias(n) for n, c in (("sw", w), ("st", w * tt), ("sz", w * z), ("stt", w * tt * tt), ("stz", w * tt * z))])
    den = F.col("sw") * F.col("stt") - F.col("st") * F.col("st")
    slope = (F.col("sw") * F.col("stz") - F.col("st") * F.col("sz")) / F.when(den != 0, den)
    icpt = (F.col("sz") - slope * F.col("st")) / F.when(F.col("sw") > 0, F.col("sw"))
    rows = s.where(F.col("n") >= min_points).select(
        pid, "_t", "_y", (1 / F.when(slope != 0, slope)).alias("_dx0"), (-icpt / F.when(slope != 0, slope)).alias("_d500"))

    def fit(it):
        carry = None
        for pdf in it:
            if carry is not None:
                pdf = pd.concat([carry, pdf], ignore_index=True)
            if pdf.empty:
                carry = None
                continue
            last = pdf[pid].iloc[-1]
            tail = pdf[pid].to_numpy() == last
            carry, done = pdf[tail], pdf[~tail]
            if len(done):
                yield from _fit_rows(done, pid)
        if carry is not None and len(carry):
            yield from _fit_rows(carry, pid)

    # a given number of parts, since few bytes are much work; by another hash, or the parts of the sums would be kept
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(parts, F.xxhash64(pid)).sortWithinPartitions(pid)
            .mapInPandas(fit, f"{pid} bigint, D50 double, Dx double")
            .where(F.col("D50").isNotNull() & ~F.isnan("D50")))
