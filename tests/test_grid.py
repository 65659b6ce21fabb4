"""The grid that drives the run: masks against plain filters, one job against a run per combination."""

import math

from pyspark.sql import functions as F

from genoframe import fixtures as fx
from genoframe.operators import filters as ofl
from genoframe.plans import assoc as st
from genoframe.plans import grid
from genoframe.plans.q_filters import GRID_FILTERS, GRID_UNITS, annotated_cohort
from genoframe.plans.settest import set_test


def test_masks_equal_plain_filters(spark, sf):
    a = annotated_cohort(spark, sf).checkpoint()
    got = grid.grid_sets(a, GRID_FILTERS, GRID_UNITS).checkpoint()
    for f in GRID_FILTERS:
        want = ofl.variant_filter(a, f)
        for u, c in GRID_UNITS.items():
            w = sorted((r.v, r[1]) for r in want.where(F.col(c).isNotNull()).select("v", c).collect())
            assert sorted((r.v, r.set) for r in got.where((F.col("filter") == f) & (F.col("unit") == u)).collect()) == w and w


def test_one_job_equals_a_run_per_combination(spark, sf):
    a = annotated_cohort(spark, sf).where("v % 2 = 0").checkpoint()
    s = fx.cohort_samples(spark, sf).checkpoint()
    cov = st.standardize(s.select("sample_id", "c1"), ["c1"]).checkpoint()
    mf = st.model_frame_long(s.select("sample_id", F.lit("QT").alias("pheno"), F.col("QT").alias("value")), cov, ["c1"])
    null = st.null_model(mf, ["c1"]).checkpoint()
    calls = fx.cohort_calls(spark, sf).join(s.select("s", "sample_id"), "s").select("v", "sample_id", "dosage").checkpoint()
    rows = [(GRID_FILTERS[0], 0.3, "QT", "GENE", "burden"), (GRID_FILTERS[1], 0.3, "QT", "GENE", "SKAT"), (GRID_FILTERS[1], 0.4, "QT", "SYMBOL", "SKAT")]
    table = spark.createDataFrame(rows, "filter string, max_maf double, pheno string, unit string, test string")
    got = {}
    for r in grid.run_grid(calls, a, table, null, cov, ["c1"], GRID_UNITS).collect():
        got.setdefault((r.filter, r.max_maf, r.pheno, r.unit, r.test), {})[r.set] = (r.n, r.p, r.q_fdr)
    assert set(got) == set(rows)
    for f, maf, ph, unit, test in rows:
        keep = ofl.variant_filter(a, f).select("v", F.col(GRID_UNITS[unit]).alias("unit"))
        want = {r.unit: (r.n, r.p) for r in set_test(calls, keep, null, cov, ["c1"], max_maf=maf, method=test).collect()}
        mine = got[f, maf, ph, unit, test]
        assert set(mine) == set(want)
        for k, (n, p) in want.items():
            assert mine[k][0] == n and (mine[k][1] == p or math.isclose(mine[k][1], p, rel_tol=1e-6))
        assert any(p is not None for _, p in want.values())
    assert grid.run_grid(calls, a, table.limit(0), null, cov, ["c1"], GRID_UNITS).count() == 0
