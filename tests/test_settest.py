"""Set tests from the entries of sparse genotypes, against the dense definition."""

import numpy as np
import pytest

from genoframe.plans import numerics as nm
from genoframe.plans import settest as sk


def dense(G, w, r, v, X):
    """Weighted scores and their covariance, samples by variants written out."""
    xx = (X * v[:, None]).T @ X
    GVX = (G * v[:, None]).T @ X
    K = (G * v[:, None]).T @ G - GVX @ np.linalg.solve(xx, GVX.T)
    return (G.T @ r) * w, K * np.outer(w, w), xx


def plain_skato_parts(K, r):
    """Eigenvalues of one mixture and of the part off the burden direction, from K itself."""
    m = len(K)
    R = (1 - r) * np.eye(m) + r * np.ones((m, m))
    L = np.linalg.cholesky(R + 1e-12 * np.eye(m))
    one = np.ones(m)
    zz = float(one @ K @ one) / m ** 2
    cof = (K @ one) / m / zz
    k11 = np.outer(cof, cof) * zz
    k22 = K - np.outer(cof, K @ one / m) - np.outer(K @ one / m, cof) + k11
    return sk._sym_eig(L.T @ K @ L), sk._sym_eig(k22), float(np.sum(k11 * k22))


def case(seed, n, m, per):
    rng = np.random.default_rng(seed)
    G = (rng.random((n, m)) < per) * rng.integers(1, 3, (n, m)).astype(float)
    X = np.column_stack([np.ones(n), rng.normal(size=n)])
    v = rng.uniform(0.1, 0.25, n)
    r = rng.normal(size=n) * 0.4
    r -= X @ np.linalg.lstsq(X, r, rcond=None)[0]
    return G, rng.uniform(1, 25, m), r, v, X


@pytest.mark.parametrize("n,m,per", [(200, 9, 0.03), (40, 150, 0.05), (30, 31, 0.9), (400, 60, 0.4)])
def test_sparse_entries_equal_the_dense_definition(n, m, per):
    G, w, r, v, X = case(n, n, m, per)
    S, K, xx = dense(G, w, r, v, X)
    ri, vi = np.nonzero(G)
    on, at = np.unique(ri, return_inverse=True)
    for method, want in (("SKAT", sk.skat_pvalue(S, K)), ("burden", sk.burden_pvalue(S, K)), ("SKATO", sk.skato_pvalue(S, K))):
        got = sk.set_pvalue(at, vi, G[ri, vi], S, w, v[on], X[on], xx, method)
        assert got == pytest.approx(want, rel=1e-6) and 0 < got <= 1


@pytest.mark.parametrize("m", [1, 2, 7, 40])
def test_one_decomposition_gives_every_mixture(m):
    G, w, r, v, X = case(m, 60, m, 0.1)
    _, K, _ = dense(G, w, r, v, X)
    d, U = np.linalg.eigh(K)
    d = np.maximum(d, 0)
    z = np.sqrt(d) * U.sum(axis=0)
    for rho in (0.01, 0.5, 0.999):
        mix, rest, cross = plain_skato_parts(K, rho)
        assert np.sort(sk._kept(sk.interlaced((1 - rho) * d, z, rho))) == pytest.approx(np.sort(mix), rel=1e-6, abs=1e-9 * mix.max())
        if m > 1:
            assert np.sort(sk._kept(sk.interlaced(d, z, None))) == pytest.approx(np.sort(rest), rel=1e-6, abs=1e-9 * mix.max())
    y = d * z / m
    off = y - z * (z @ y) / (z @ z)
    assert float(off @ off) / (z @ z) * m ** 2 == pytest.approx(cross, rel=1e-6, abs=1e-9 * mix.max() ** 2)


def test_gram_of_few_and_of_full_rows():
    rng = np.random.default_rng(1)
    for per in (0.02, 0.95):
        A = (rng.random((300, 80)) < per) * rng.normal(size=(300, 80))
        weight = rng.random(300)
        i, j = np.nonzero(A)
        o = rng.permutation(len(i))
        assert sk.gram(i[o], j[o], A[i, j][o], weight, 80) == pytest.approx((A * weight[:, None]).T @ A, abs=1e-9)
    assert not sk.gram(np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros(0), 3).any()


def test_a_set_of_many_variants_and_carriers_stays_small():
    """20,000 variants on 90 samples, and 700 variants on 40,000: neither a matrix of variants nor one of samples by variants."""
    import tracemalloc
    rng = np.random.default_rng(8)
    for n, m, calls, bound in ((90, 20_000, 30_000, 150 << 20), (40_000, 700, 60_000, 150 << 20)):
        flat = np.unique(rng.integers(0, n * m, calls))
        ri, vi = flat // m, flat % m
        on, at = np.unique(ri, return_inverse=True)
        X, v = np.ones((n, 1)), np.ones(n)
        w, r = np.ones(m), rng.normal(size=n)
        S = np.bincount(vi, weights=(r - r.mean())[ri], minlength=m)
        tracemalloc.start()
        p = sk.set_pvalue(at, vi, np.ones(len(vi)), S, w, v[on], X[on], X.T @ X, "SKATO")
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert 0 < p <= 1 and peak < bound


def test_imhof_in_parts_equals_the_whole():
    lam = np.linspace(0.01, 1, 600)
    n = 4000
    t = (np.arange(n) + 0.5) / n
    u, q = (t / (1 - t)) ** 3, 330.0
    theta = 0.5 * np.sum(np.arctan(np.outer(u, lam)), axis=1) - 0.5 * q * u
    rho = 0.25 * np.sum(np.log1p(np.outer(u * u, lam * lam)), axis=1)
    want = 0.5 + np.sum(np.sin(theta) * np.exp(-rho) / u * 3 * t ** 2 / (1 - t) ** 4 / n) / np.pi
    assert nm.imhof_sf(q, lam) == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("rho", [None, 0.01, 0.999])
def test_interlaced_roots_take_few_rounds(monkeypatch, rho):
    """Against the dense matrix, with close, equal and untouched eigenvalues; looked at a few times each, not sixty."""
    rng = np.random.default_rng(3)
    d = np.sort(np.concatenate([rng.gamma(0.4, size=200), np.full(3, 0.5), 0.5 + 1e-9 * np.arange(5), np.zeros(4)]))
    z = np.sqrt(d) * rng.normal(size=len(d))
    z[::17] = 0.0
    seen, plain = [0], np.isfinite
    monkeypatch.setattr(np, "isfinite", lambda x, *a, **b: (seen.__setitem__(0, seen[0] + np.size(x)), plain(x, *a, **b))[1])
    got = sk.interlaced(d, z, rho)
    monkeypatch.undo()
    if rho is None:
        P = np.eye(len(d)) - np.outer(z, z) / (z @ z)
        want = np.linalg.eigvalsh(P @ np.diag(d) @ P)[1:]
    else:
        want = np.linalg.eigvalsh(np.diag(d) + rho * np.outer(z, z))
    assert np.sort(got) == pytest.approx(np.sort(want), abs=1e-12 * d.max() * len(d))
    assert seen[0] < 15 * len(d) ** 2
