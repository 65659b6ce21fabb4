"""Set tests of 0/1 traits by case assignments, against plain enumeration."""

import itertools

import numpy as np
import pytest

from genoframe.plans import resampling as rs
from genoframe.plans import settest as sk


def enumerated(G, w, mu, y, method):
    """The definition, state by state."""
    states = list(itertools.product([0, 1], repeat=len(mu)))
    prob = [np.prod([m if s else 1 - m for m, s in zip(mu, st)]) for st in states]

    def stats(st):
        S = [w[j] * sum(G[i][j] * (st[i] - mu[i]) for i in range(len(mu))) for j in range(len(w))]
        a, b = sum(x * x for x in S), sum(S) ** 2
        return {"SKAT": [a], "burden": [b], "SKATO": [(1 - r) * a + r * b for r in sk.RHO_GRID]}[method]
    q = [stats(st) for st in states]
    at = stats(y)

    def tail(k, v):
        return sum(p for p, x in zip(prob, q) if x[k] >= v - 1e-9 * max(1.0, abs(v)))
    if method != "SKATO":
        return tail(0, at[0])
    least = [min(tail(k, x[k]) for k in range(len(x))) for x in q]
    own = min(tail(k, at[k]) for k in range(len(at)))
    return sum(p for p, t in zip(prob, least) if t <= own * (1 + 1e-9))


@pytest.mark.parametrize("method", ["SKAT", "burden", "SKATO"])
@pytest.mark.parametrize("carriers", [1, 3, 7])
def test_equals_plain_enumeration(method, carriers):
    rng = np.random.default_rng(carriers)
    for _ in range(3):
        G = rng.integers(0, 3, (carriers, 4)).astype(float)
        w, mu = rng.uniform(1, 25, 4), rng.uniform(0.1, 0.7, carriers)
        y = (rng.random(carriers) < 0.5).astype(float)
        assert rs.resampled_p(G, w, mu, y, method, sk.RHO_GRID) == pytest.approx(enumerated(G, w, mu, y, method), abs=1e-9)


def test_twelve_carriers_are_exact_and_drawn_states_are_near():
    rng = np.random.default_rng(2)
    G, w, mu = rng.integers(0, 2, (12, 3)).astype(float), np.ones(3), rng.uniform(0.2, 0.6, 12)
    y = (rng.random(12) < 0.7).astype(float)
    exact = rs.resampled_p(G, w, mu, y, "SKATO", sk.RHO_GRID)
    assert exact == pytest.approx(enumerated(G, w, mu, y, "SKATO"), abs=1e-9)
    keep = rs.EXACT_CARRIERS
    try:
        rs.EXACT_CARRIERS = 0
        assert rs.resampled_p(G, w, mu, y, "SKATO", sk.RHO_GRID, seed=1) == pytest.approx(exact, abs=0.02)
    finally:
        rs.EXACT_CARRIERS = keep
    assert rs.resampled_p(np.ones((61, 1)), np.ones(1), np.full(61, 0.5), np.ones(61), "SKAT", sk.RHO_GRID) is None


def test_p_is_never_too_small_under_the_null():
    rng = np.random.default_rng(9)
    mu, G, w = np.full(8, 0.3), rng.integers(0, 2, (8, 3)).astype(float), np.ones(3)
    states, prob = rs.assignments(mu, 0)
    p = np.array([rs.resampled_p(G, w, mu, s, "SKATO", sk.RHO_GRID) for s in states])
    for level in (0.01, 0.05, 0.2):
        assert prob[p <= level].sum() <= level + 1e-9


def test_set_test_uses_them(spark):
    """One gene with few carriers: p of the table equals enumeration with the fitted means; a failed phenotype gives one null row."""
    from genoframe.plans import assoc
    rng = np.random.default_rng(4)
    n = 60
    x, y = rng.normal(size=n), (rng.random(n) < 0.4).astype(float)
    ids = [f"S{i:02d}" for i in range(n)]
    mf = spark.createDataFrame([(p, ids[i], float(v[i]), float(x[i]), float(k[i])) for p, v, k in (("A", y, rng.normal(size=n)), ("F", y, x * 3))
                                for i in range(n)], "pheno string, sample_id string, y double, x1 double, x2 double")
    calls = [(1, 0, 1), (1, 5, 1), (2, 5, 2), (2, 9, 1), (3, 11, 1)]
    g = spark.createDataFrame([(v, ids[i], d) for v, i, d in calls], "v bigint, sample_id string, dosage int")
    sets = spark.createDataFrame([(1, "G1"), (2, "G1"), (3, "G1"), (3, "G2")], "v bigint, unit string")
    cov = mf.where("pheno = 'A'").select("sample_id", "x1", "x2")
    null = assoc.null_model(mf, ["x1", "x2"]).unionByName(spark.createDataFrame([], "pheno string, sample_id string, kind string, mu double, resid double, var_w double"))
    rows = {(r["pheno"], r["unit"]): r for r in sk.set_test(g, sets, null, cov, ["x1", "x2"], max_maf=0.05, method="SKATO").collect()}
    assert rows["F", None]["p"] is None and rows["A", "G2"]["p"] is None and rows["A", "G2"]["n"] == 1
    mu = {r["sample_id"]: r["mu"] for r in null.where("pheno = 'A'").collect()}
    on = [0, 5, 9, 11]
    G = np.zeros((4, 3))
    for v, i, d in calls:
        G[on.index(i), v - 1] = d
    maf = G.sum(axis=0) / (2 * n)
    m = np.array([mu[ids[i]] for i in on])
    assert rows["A", "G1"]["p"] == pytest.approx(enumerated(G, sk.beta_weight(maf), m, y[on], "SKATO"), abs=1e-9)


def test_scores_of_many_variants_are_held_in_blocks():
    """A set's memory does not grow with drawn states times variants; the p-values are those of the whole product."""
    import tracemalloc
    from genoframe.plans import resampling as rs
    rng = np.random.default_rng(6)
    c, m = 20, 3000
    G, w = (rng.random((c, m)) < 0.1).astype(float), rng.random(m)
    mu, y = rng.uniform(0.2, 0.6, c), (rng.random(c) < 0.5).astype(float)
    states, prob = rs.assignments(mu, 3)
    off = np.vstack([states, y]) - mu
    skat, burden = ((off @ ((G * w ** 2) @ G.T)) * off).sum(axis=1), (off @ (G @ w)) ** 2
    prob = np.append(prob, prob[0])
    tracemalloc.start()
    got = [rs.resampled_p(G, w, mu, y, t, [0.0, 0.5, 1.0], seed=3) for t in ("SKAT", "burden")]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got, [rs._tail(q, prob)[-1] for q in (skat, burden)], atol=1e-9)
    assert peak < 100e6, peak
