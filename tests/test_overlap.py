"""Nested-bin overlap joins against brute force."""

import random

import pytest

from genoframe.operators import overlap as oo
from genoframe.operators.annotate import AnnotationSpec


def frames(spark, seed, n=120):
    rnd = random.Random(seed)

    def rows(k):
        out = []
        for i in range(k):
            s = rnd.choice([rnd.randrange(1, 200_000), rnd.randrange(1, 250_000_000), (1 << rnd.randrange(1, 27)) - rnd.randrange(2)])
            length = rnd.choice([1, 1, 50, 1 << rnd.randrange(0, 27), rnd.randrange(1, 60_000_000)])
            out.append((i, rnd.choice(["1", "2"]), s, s + length - 1, rnd.choice([None, "x", "y", "z", "w"])))
        return out + [(900, None, 5, 9, "n"), (901, "1", None, 9, "n"), (902, "1", 5, None, "n"), (903, "1", 9, 5, "n"), out[0]]
    schema = "id int, chrom string, start bigint, end bigint, name string"
    a, b = rows(n), rows(n)
    return a, b, spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)


def brute(a, b):
    ok = [[r for r in x if None not in r[1:4]] for x in (a, b)]
    return sorted((x[0], y[0]) for x in ok[0] for y in ok[1]
                  if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3] and x[2] <= x[3] and y[2] <= y[3])


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("broadcast", [True, False])
def test_pairs_equal_brute_force(spark, seed, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(oo, "broadcast_if_small", lambda df: df)
    a, b, da, db = frames(spark, seed)
    got = sorted((r.i, r.j) for r in oo.overlap_pairs(da, db).selectExpr("a.id i", "b.id j").collect())
    assert got == brute(a, b) and len(got) > 200


def test_points_and_empty_sides(spark):
    a, b, da, db = frames(spark, 4)
    points = da.withColumn("end", da["start"])
    want = brute([(*r[:3], r[2], r[4]) for r in a], b)
    assert sorted((r.i, r.j) for r in oo.overlap_pairs(points, db).selectExpr("a.id i", "b.id j").collect()) == want
    assert oo.overlap_pairs(da.limit(0), db).count() == 0 and oo.overlap_pairs(da, db.limit(0)).count() == 0


def test_a_long_interval_lies_in_few_bins(spark):
    rows = [(i, "1", s, s + n - 1) for i, (s, n) in enumerate([(1, 1), (16_000, 5_000), (10_000_000, 50_000_000), (7, 250_000_000)])]
    d = oo.own_bins(spark.createDataFrame(rows, "id int, chrom string, start bigint, end bigint"))
    assert max(r["count"] for r in d.groupBy("id").count().collect()) <= 2
    plan = oo.overlap_pairs(d.select("id", "chrom", "start", "end"), d.select("id", "chrom", "start", "end"))._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_spec_with_bounded_lists(spark):
    a, b, da, db = frames(spark, 6, n=60)
    da = da.where("id < 900").dropDuplicates(["id"])
    spec = AnnotationSpec(["id", "name", "name", "start", "id"], ["n", "names", "all3", "low", "one"],
                          ["count", "uniq:2", "concat:3", "min", "first"])
    got = {r.id: r for r in oo.annotate_ranges(da.select("id", "chrom", "start", "end"), db, spec, key="id").collect()}
    by = {}
    for x, y in brute([r for i, r in enumerate(a) if r[0] < 900 and r not in a[:i]], b):
        by.setdefault(x, []).append(y)
    row = {r[0]: r for r in b}
    assert set(got) == {r[0] for r in a if r[0] < 900}
    for i, r in got.items():
        hits = [row[j] for j in by.get(i, [])]
        names = sorted(h[4] for h in hits if h[4])
        assert r.n == len(hits)
        assert (r.names or "") == ",".join(sorted(set(names))[:2]) and (r.all3 or "") == ",".join(names[:3])
        if hits:
            assert r.low == min(h[2] for h in hits) and r.one == min(hits, key=lambda h: (h[1], h[2], h[3], h[0]))[0]
    with pytest.raises(ValueError):
        oo.annotate_ranges(da, db, AnnotationSpec(["name"], ["x"], ["uniq"]), key="id")


def test_annotation_makes_no_pairs(spark, monkeypatch):
    """Thousands of intervals over every variant: blocks are read, not pairs."""
    def no_pairs(*_):
        raise AssertionError("pairs are made")
    monkeypatch.setattr(oo, "overlap_pairs", no_pairs)
    iv = spark.range(0, 3000).selectExpr("id", "'1' AS chrom", "1 + id % 7 AS start", "900000 + id AS end", "concat('n', id % 11) AS name")
    v = spark.range(0, 2000).selectExpr("id", "'1' AS chrom", "id + 100 AS start", "id + 100 + id % 50 AS end")
    spec = AnnotationSpec(["id", "name", "id", "id", "start"], ["n", "names", "total", "avg", "low"], ["count", "uniq:2", "sum", "mean", "first"])
    out = oo.annotate_ranges(v, iv, spec, key="id")
    assert {tuple(r) for r in out.select("n", "names", "total", "avg", "low").collect()} == {(3000, "n0,n1", 3000 * 2999 // 2, 1499.5, 1)}


def test_repeated_and_null_keys(spark):
    """Rows that share a key are annotated together, each with the overlaps of all; a NULL key with nothing."""
    v = spark.createDataFrame([(1, "1", 10, 30), (1, "1", 20, 20), (None, "1", 10, 30), (2, "1", 40, 39), (3, "2", 5, 5), (4, "1", 26, 1 << 40)],
                              "id long, chrom string, start long, end long")
    iv = spark.createDataFrame([("1", 5, 25, "a", None), ("1", 20, 20, "a", 1.5), ("1", 31, 40, "c", 2.0), ("1", 1, 1 << 38, None, 4.0)],
                               "chrom string, start long, end long, name string, x double")
    spec = AnnotationSpec(["start", "name", "name", "x", "x"], ["n", "u", "c", "m", "hi"], ["count", "uniq:3", "concat:3", "mean", "max"])
    got = sorted(((r.id or 0), r.n, r.u, r.c, r.m, r.hi) for r in oo.annotate_ranges(v, iv, spec, key="id").collect())
    one = (1, 6, "a", "a,a,a", 2.75, 4.0)
    assert got == [(0, 0, None, None, None, None), one, one, (2, 0, None, None, None, None), (3, 0, None, None, None, None), (4, 2, "c", "c", 3.0, 4.0)]
