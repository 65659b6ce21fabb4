"""Hard negatives against a plain search over all pairs, and the registered query against its SQL."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from genoframe.llm import hard_negatives
from genoframe.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id bigint, embedding array<double>, label int, anchor string, key double, part int, dim int"


def brute(rows, every=100, n_pos=5, n_neg=10, low=30, high=90):
    """Rows of (id, vector, label)."""
    seen = {}
    for i, v, l in rows:
        if i is None or l is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        x = [min(max(math.floor(256 * c), -(1 << 63)), (1 << 63) - 1) for c in v]
        seen[i] = min(seen.get(i, (l, x)), (l, x))
    out = []
    for a, (la, xa) in seen.items():
        if a % every:
            continue
        score = sorted((-sum(p * q for p, q in zip(x, xa)), i, l) for i, (l, x) in seen.items() if i != a and len(x) == len(xa))
        for s, p, _ in [t for t in score if t[2] == la][:n_pos]:
            hits = [(t, i) for t, i, l in score if l != la and low * -s <= 100 * -t <= high * -s][:n_neg]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(hits)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", 0.5, 1, 2) for i, v, l in rows], SCHEMA).repartition(3)


def vectors(seed, n, dim, coarse=False):
    rng = random.Random(seed)
    side = (lambda: rng.randint(-2, 3) / 4) if coarse else (lambda: rng.gauss(0.1, 0.3))
    return [(i, [side() for _ in range(dim)], rng.randint(0, 3)) for i in range(n)]


ODD = [(100, None, 1), (200, [1.0, None, 0.5, 0.1], 1), (300, [math.nan] * 4, 1), (400, [math.inf, 0.0, 0.0, 0.0], 0), (500, [0.5] * 4, None), (None, [0.5] * 4, 1),
       (600, [], 0), (700, [0.0] * 4, 1), (701, [0.0] * 4, 1), (702, [0.0] * 4, 0), (800, [0.3] * 3, 0), (801, [0.2] * 3, 0), (802, [0.1] * 3, 1), (900, [-0.5] * 4, 2),
       (-100, [0.4, 0.1, 0.2, 0.3], 0), (10, [9.0] * 4, 3), (11, [0.1] * 4, 3)]


@pytest.mark.parametrize("blocks", [(512, 4096, 1 << 20), (7, 16, 64)])
@pytest.mark.parametrize("coarse", [False, True])
def test_equals_a_search_over_all_pairs(spark, monkeypatch, blocks, coarse):
    for name, n in zip(("ANCHOR_BLOCK", "ROW_BLOCK", "PART_ROWS"), blocks):
        monkeypatch.setattr(hard_negatives, name, n)
    rows = [r for r in vectors(3, 400, 4, coarse) if r[0] not in {x[0] for x in ODD} or r[0] in (10, 11)] + ODD
    got = sorted(tuple(r) for r in hard_negatives.mine(frame(spark, rows), every=20).collect())
    assert got == brute(rows, every=20) and len(got) > 100
    if coarse:
        assert max(Counter(r[5] for r in got).values()) > 5         # many ties


def test_hot_label(spark):
    rows = [(i, v, 0 if i % 3 else l) for i, v, l in vectors(8, 600, 6)]
    assert sorted(tuple(r) for r in hard_negatives.mine(frame(spark, rows), every=50).collect()) == brute(rows, every=50)


def test_large_components_are_exact(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(0, 1e6) for _ in range(4)], i % 2) for i in range(60)]
    assert sorted(tuple(r) for r in hard_negatives.mine(frame(spark, rows), every=10).collect()) == brute(rows, every=10)


def test_repeated_rows_count_once(spark):
    rows = vectors(4, 120, 4)
    assert sorted(map(tuple, hard_negatives.mine(frame(spark, rows + rows[:60]), every=20).collect())) == brute(rows, every=20)


def test_empty(spark):
    assert hard_negatives.mine(frame(spark, [])).count() == 0
    assert hard_negatives.mine(frame(spark, [(1, [0.5], 1)])).count() == 0


def test_keys_sort_as_they_should():
    rng = np.random.default_rng(1)
    a, s, r = (rng.integers(-50, 50, 500) for _ in range(3))
    kind = rng.integers(0, 2, 500)
    col = hard_negatives._pack_keys(a, s, kind, r)
    assert [x.tolist() for x in hard_negatives._unpack_keys(col)] == [a.tolist(), s.tolist(), kind.tolist(), r.tolist()]
    order = sorted(range(500), key=lambda i: (a[i], -s[i], kind[i], r[i]))
    assert sorted(col.to_pylist()) == [col[i].as_py() for i in order]


def test_registered_query(spark, sf, con):
    from genoframe.plans.verify import duck
    for d in (sf, sf.replace("sf0.001", "sf0.01")):
        got = sorted(tuple(r) for r in QUERIES["op12_hard_negatives"](spark, d).select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
        assert got == sorted(duck(d).sql(ORACLES["op12_hard_negatives"]).fetchall()) and got
