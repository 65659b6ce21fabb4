"""Null models by aggregates, the score test with its saddlepoint tail, and the logistic fits in blocks."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoframe.plans import assoc, logistic, nullmodel, numerics as nm


@pytest.fixture(scope="module")
def cohort(spark):
    """40 samples, two 0/1 phenotypes (one with gaps), one continuous, one that the covariates separate, and one constant."""
    rng = np.random.default_rng(5)
    n, m = 40, 30
    X = rng.normal(size=(n, 2))
    G = rng.binomial(2, 0.25, size=(m, n)).astype(float)
    G[rng.random(G.shape) < 0.03] = np.nan
    G[0], G[1] = 0.0, 1.0                                  # constant
    y = {"A": (rng.random(n) < 0.4).astype(float), "B": np.where(rng.random(n) < 0.2, np.nan, (rng.random(n) < 0.5).astype(float)),
         "Q": rng.normal(size=n), "S": (X[:, 0] > 0).astype(float), "K": np.ones(n)}
    G[2] = np.where(y["A"] == 1, rng.random(n) < 0.5, 0.0)  # separates A
    ids = [f"S{i:03d}" for i in range(n)]
    mf = spark.createDataFrame([(p, ids[i], float(v[i]), float(X[i, 0]), float(X[i, 1])) for p, v in y.items() for i in range(n) if not np.isnan(v[i])],
                               "pheno string, sample_id string, y double, x1 double, x2 double").repartition(3)
    g = spark.createDataFrame([(v, ids[i], None if np.isnan(G[v, i]) else int(G[v, i])) for v in range(m) for i in range(n) if not G[v, i] == 0],
                              "v bigint, sample_id string, dosage int").repartition(3)
    return X, G, y, ids, mf, g


COV = ["x1", "x2"]


def test_null_fits_equal_dense_fits(cohort):
    X, _, y, _, mf, _ = cohort
    fits = nullmodel.fit_null(mf, COV)
    assert set(fits) == {"A", "B", "Q", "S"}                # the constant phenotype is left out
    for p in ("A", "B"):
        of = ~np.isnan(y[p])
        beta, _, ok = nm.logistic_irls(np.column_stack([np.ones(of.sum()), X[of]]), y[p][of])
        assert ok and fits[p].ok and not fits[p].firth and np.allclose(fits[p].beta, beta, atol=1e-7)
    C = np.column_stack([np.ones(len(X)), X])
    beta, r, s2 = nm.linear_fit(C, y["Q"])
    assert np.allclose(fits["Q"].beta, beta, atol=1e-9) and np.isclose(fits["Q"].sigma2, s2)
    want, _, ok = nm.logistic_firth(C, y["S"])
    assert ok and fits["S"].ok and fits["S"].firth and np.allclose(fits["S"].beta, want, atol=1e-6)


def test_null_frame_and_failed_models(spark, cohort):
    X, _, y, ids, mf, _ = cohort
    twin = mf.withColumn("x3", F.col("x1") * 2)             # a covariate that repeats another: no model
    rows = assoc.null_model(twin.where("pheno = 'A'"), [*COV, "x3"]).collect()
    assert [(r["pheno"], r["sample_id"], r["resid"]) for r in rows] == [("A", None, None)]
    got = {r["sample_id"]: r for r in assoc.null_model(mf.where("pheno = 'Q'"), COV).collect()}
    C = np.column_stack([np.ones(len(X)), X])
    beta, r, s2 = nm.linear_fit(C, y["Q"])
    assert np.allclose([got[i]["resid"] for i in ids], r / np.sqrt(s2)) and {x["var_w"] for x in got.values()} == {1.0}


def test_score_equations_are_zero(cohort):
    mf = cohort[4].checkpoint()
    rows = nullmodel.score_equations(mf, nullmodel.fit_null(mf, COV), COV).collect()
    assert {(r["pheno"], r["term"]) for r in rows} == set(itertools.product("ABQ", ["(intercept)", *COV]))
    assert max(abs(r["score"]) for r in rows) < 1e-6


def dense_fit(X, g, y):
    of = ~np.isnan(g) & ~np.isnan(y)
    D = np.column_stack([np.ones(of.sum()), g[of], X[of]])
    beta, cov, ok = nm.logistic_irls(D, y[of])
    if not ok:
        beta, cov, done = nm.logistic_firth(D, y[of])
        assert done
    return beta[1], np.sqrt(cov[1, 1]), not ok, int(of.sum())


def test_fits_equal_dense_fits(cohort):
    X, G, y, _, mf, g = cohort
    rows = {(r["pheno"], r["v"]): r for r in logistic.fit_blocks(g, mf.where("pheno in ('A', 'B')"), COV).collect()}
    assert not {v for _, v in rows} & {0, 1} and rows["A", 2]["firth"]
    for (p, v), r in rows.items():
        beta, se, firth, n = dense_fit(X, G[v], y[p])
        assert r["firth"] == firth and r["n"] == n
        assert np.isclose(r["beta"], beta, atol=1e-6) and np.isclose(r["se"], se, atol=1e-6)
    assert len(rows) == 2 * 28


def test_sample_blocks_do_not_change_the_fits(cohort, monkeypatch):
    _, _, _, _, mf, g = cohort
    g, mf = g.where("v BETWEEN 3 AND 8"), mf.where("pheno in ('A', 'B')")

    def run():
        return sorted((r["pheno"], r["v"], r["n"], r["firth"], round(r["beta"], 9), round(r["se"], 9)) for r in logistic.fit_blocks(g, mf, COV).collect())
    whole = run()
    monkeypatch.setattr(logistic, "SAMPLE_BLOCK", 15)
    monkeypatch.setattr(logistic, "VARIANT_BLOCK", 4)
    monkeypatch.setattr(logistic, "MOST_VARIANTS", 4)
    assert run() == whole


def test_penalised_passes_add_up_over_blocks(cohort):
    X, G, y, _, _, _ = cohort
    Y, g = y["A"][:, None], G[2][None]
    fits = logistic._Fits(np.array([2]), 1, 4)
    while fits.open().any():
        parts = [logistic._partial(fits, X[i:i + 9], Y[i:i + 9], g[:, i:i + 9]) for i in range(0, 40, 9)]
        total = parts[0]
        for p in parts[1:]:
            total = logistic._added(total, p)
        logistic._advance(fits, total)
    beta, se, firth, _ = dense_fit(X, G[2], y["A"])
    assert firth and fits.firth[0, 0] and np.allclose(fits.out[0, 0], [beta, se], atol=1e-6)


def test_score_test_equals_its_closed_form(cohort):
    X, G, y, _, mf, g = cohort
    rows = {(r["pheno"], r["v"]): r for r in logistic.score_test(g, mf, COV, spa_z=0.5).collect()}
    assert {p for p, _ in rows} == {"A", "B", "S"}
    moved = 0
    for (p, v), r in rows.items():
        if p == "S":
            continue
        of = ~np.isnan(y[p])
        C = np.column_stack([np.ones(of.sum()), X[of]])
        beta, _, _ = nm.logistic_irls(C, y[p][of])
        mu = 1 / (1 + np.exp(-C @ beta))
        gv, yv = G[v][of], y[p][of]
        use = ~np.isnan(gv)
        C, mu, gv, yv = C[use], mu[use], gv[use], yv[use]
        w = mu * (1 - mu)
        adj = gv - C @ np.linalg.solve(C.T @ (C * w[:, None]), C.T @ (w * gv))
        assert r["n"] == use.sum() and np.isclose(r["score"], adj @ (yv - mu), atol=1e-7) and np.isclose(r["variance"], (w * adj * adj).sum(), atol=1e-7)
        assert np.isclose(r["p_score"], nm.normal_two_sided_p(r["z_score"]))
        if abs(r["z_score"]) < 0.5:
            assert r["p_spa"] == r["p_score"]
        moved += r["p_spa"] != r["p_score"]
    assert moved > 10


def test_saddlepoint_tail(spark):
    """Nine carriers and rare cases: the tail equals a scalar solution of its equations and lies near the exact mid-p."""
    from math import comb, log, sqrt
    n, cases, carriers = 400, 40, 9
    y = np.array([1.0] * cases + [0.0] * (n - cases))
    g = np.zeros(n)
    g[:4], g[-5:] = 1, 1
    mf = spark.createDataFrame([("A", f"S{i:03d}", float(y[i])) for i in range(n)], "pheno string, sample_id string, y double")
    calls = spark.createDataFrame([(1, f"S{i:03d}", 1) for i in np.flatnonzero(g).tolist()], "v bigint, sample_id string, dosage int")
    r = logistic.score_test(calls, mf, [], spa_z=1.0).collect()[0]
    mu, c = cases / n, carriers / n
    own, rest = 1 - c, (n - carriers) * c * c * mu * (1 - mu)
    u = 4 * own - c * (cases - 4)

    def k(t):
        q = 1 - mu + mu * np.exp(own * t)
        s = mu * np.exp(own * t) / q
        return carriers * (log(q) - t * own * mu) + rest * t * t / 2, carriers * own * (s - mu) + rest * t, carriers * own ** 2 * s * (1 - s) + rest

    def tail(u):
        lo, hi = -1e3, 1e3
        for _ in range(200):
            t = (lo + hi) / 2
            lo, hi = (t, hi) if k(t)[1] < u else (lo, t)
        w = np.sign(t) * sqrt(2 * (t * u - k(t)[0]))
        return nm.normal_two_sided_p(abs(w + log(t * sqrt(k(t)[2]) / w) / w)) / 2
    assert np.isclose(r["score"], u) and np.isclose(r["p_spa"], tail(u) + tail(-u), rtol=1e-6)
    probability = [comb(carriers, j) * comb(n - carriers, cases - j) / comb(n, cases) for j in range(carriers + 1)]
    mid = sum(probability[4:]) - probability[4] / 2
    assert 0.7 * mid < r["p_spa"] < 1.4 * mid and r["p_score"] < 0.2 * mid      # the normal tail is far too small


def test_screened_fits(cohort):
    _, _, _, _, mf, g = cohort
    rows = logistic.screened(g, mf.where("pheno in ('A', 'B')"), COV, screen_p=0.3).collect()
    for r in rows:
        assert (r["beta"] is not None) == (r["p_spa"] <= 0.3)
    assert len(rows) == 56 and 0 < sum(r["beta"] is not None for r in rows) < 56


def test_no_binary_phenotype(cohort):
    _, _, _, _, mf, g = cohort
    assert logistic.fit_blocks(g, mf.where("pheno = 'Q'"), COV).count() == 0
    assert logistic.score_test(g, mf.where("pheno = 'Q'"), COV).count() == 0


def test_rank_and_inverse_of_a_batch():
    """The batch inverse keeps the verdicts of the eigenvalues, also next to singular, zero, non-finite and no matrices."""
    rng = np.random.default_rng(4)
    A = rng.standard_normal((700, 9, 5))
    A = np.einsum("bni,bnj->bij", A, A) * np.outer(*[10.0 ** np.arange(5)] * 2)
    A[3], A[5, 0, 0] = 0.0, np.nan
    A[4, 4], A[4, :, 4] = A[4, 3], A[4, 3]                     # a column twice
    A[6] = np.eye(5) + (1 - 1e-7) * (1 - np.eye(5))            # nearly so
    ok, inverse = nm.full_rank_inverse(A)
    assert (ok == nm.full_rank(A)).all() and not ok[[3, 4, 5]].any() and ok[6]
    s = 1 / np.sqrt(np.einsum("bii->bi", A[ok]))
    np.testing.assert_allclose(inverse[ok] / s[:, :, None] / s[:, None, :], np.linalg.inv(A[ok] * s[:, :, None] * s[:, None, :]), rtol=1e-6, atol=1e-6)
    assert nm.full_rank_inverse(A[:0])[1].shape == (0, 5, 5)


def test_a_pass_reads_open_fits_only():
    """A pass sums the open fits alone, and a held block is not prepared again."""
    rng = np.random.default_rng(8)
    X, Y, g = rng.standard_normal((60, 2)), (rng.random((60, 3)) < 0.5).astype(float), rng.integers(0, 3, (9, 60)).astype(float)
    fits, held = logistic._Fits(np.arange(9), 3, 4), {}
    fits.phase[1], fits.phase[2, 4:] = logistic._DONE, logistic._FAILED
    first = logistic._partial(fits, X, Y, g, held)
    assert first["score"].shape == (13, 4) and set(held) == {0, 2}
    columns = dict(held)
    again = logistic._partial(fits, X, Y, g, held)
    assert all(held[j] is columns[j] for j in held) and all((again[x] == first[x]).all() for x in first)


def test_score_test_of_a_small_cohort_takes_no_rounds(cohort, monkeypatch):
    """One block of samples: no rounds over the table of carriers, and what the rounds of a larger cohort give; calls may repeat, v may be null."""
    X, G, y, ids, mf, g = cohort
    g = g.where("v < 12").unionByName(g.where("v = 5")).unionByName(g.where("v = 6").withColumn("v", F.lit(None).cast("bigint")))
    mf = mf.where("pheno in ('A', 'B')")

    def rows():
        return {(r["pheno"], r["v"]): r for r in logistic.score_test(g, mf, COV, spa_z=1.0).collect()}
    with monkeypatch.context() as m:
        m.setattr(logistic, "saddlepoint", None)
        here = rows()
    monkeypatch.setattr(logistic, "SAMPLE_BLOCK", 4)
    far = rows()
    assert here.keys() == far.keys() and ("A", None) in here and any(r["p_spa"] != r["p_score"] for r in here.values())
    for at, r in here.items():
        for c in ("n", "score", "variance", "z_score", "p_score", "p_spa"):
            assert r[c] == pytest.approx(far[at][c], rel=1e-7, abs=1e-9), (at, c)
