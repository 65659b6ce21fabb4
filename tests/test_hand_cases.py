"""Rule tables on small literal inputs, worked by hand (NULLs included)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_sample_id_rewrites(spark):
    from genoframe.functions.ids import normalize_sample_ids
    data = [("EMADN044",), ("ELA-1912-ADN1",), ("ELA-0123-ambBED",), ("ELA-77ADN2",), ("EMADN5-ADN1",),
            ("ELA-1923-ADN1",), ("X-Y-Z",)]
    df = spark.createDataFrame(data, "raw string").select("raw", normalize_sample_ids("raw").alias("id"))
    got = dict(rows(df, "raw", "id"))
    assert got["EMADN044"] == "EM015-2"
    assert got["ELA-1912-ADN1"] == "ELA1912-2"
    assert got["ELA-0123-ambBED"] == "ELA0123"
    assert got["ELA-77ADN2"] == "ELA77"
    assert got["EMADN5-ADN1"] == "EM5"
    assert got["ELA-1923-ADN1"] == "ELA1923-2"
    assert got["X-Y-Z"] == "XYZ"


def test_mitos_three_valued(spark):
    from genoframe.functions.clinical import mitos_stage
    schema = "caminar int, vestido int, deglucion int, lenguaje int, escritura int, disnea int, insuficiencia_respiratoria int"
    data = [(0, 4, 0, 0, 0, 0, 0),        # 1+1+1+1 = 4
            (4, 4, 4, 4, 4, 4, 4),        # 0
            (None, 1, 4, 4, 4, 4, 4),     # movement TRUE via vestido -> 1
            (None, 4, 4, 4, 4, 4, 4),     # movement NULL -> NULL
            (4, 4, 4, 1, None, 4, 4)]     # communication NULL -> NULL
    got = [r[0] for r in spark.createDataFrame(data, schema).select(mitos_stage()).collect()]
    assert got == [4, 0, 1, None, None]


def test_kings_rules(spark):
    from genoframe.functions.clinical import kings_stage
    schema = ("fecha_visita date, fecha_indicacion_peg date, kings int, cortar_con_peg int, cortar_sin_peg int, "
              "disnea int, insuficiencia_respiratoria int, total_bulbar int, escritura int, caminar int")
    import datetime as dt
    d = dt.date
    data = [(d(2020, 1, 2), d(2020, 1, 1), None, 0, 4, 4, 4, 12, 4, 4),   # after PEG -> 4
            (d(2020, 1, 2), None, None, 1, 1, 4, 4, 12, 4, 4),             # both cutting > 0 -> NULL
            (d(2020, 1, 2), None, None, 0, 0, 4, 4, 12, 4, 4),             # both 0 -> NULL
            (d(2020, 1, 2), None, None, 2, 0, 4, 4, 12, 4, 4),             # gastrostomy use -> 4
            (d(2020, 1, 2), None, None, 0, 4, 0, 4, 12, 4, 4),             # dyspnoea 0 -> 4
            (d(2020, 1, 2), None, None, 0, 3, 4, 4, 11, 4, 3),             # regions 1 + 1 + 1 = 3
            (d(2020, 1, 2), None, 2, 0, 3, 4, 4, 11, 4, 3)]                # recorded wins -> 2
    got = [r[0] for r in spark.createDataFrame(data, schema).select(kings_stage()).collect()]
    assert got == [4, None, None, 4, 4, 3, 2]


def test_bh_and_rank_against_numpy(spark):
    from genoframe.operators.ordered import rank_and_bh
    rng = np.random.default_rng(1)
    p = np.round(rng.uniform(0, 1, 500), 2)          # many ties
    p[::7] = np.nan
    df = spark.createDataFrame([(i, None if np.isnan(x) else float(x)) for i, x in enumerate(p)], "i int, p double")
    out = {r["i"]: (r["rank"], r["q_fdr"]) for r in rank_and_bh(df, "p", buckets=7).collect()}
    ok = ~np.isnan(p)
    x = p[ok]
    n = len(x)
    order = np.argsort(x)
    ranks = np.empty(n)
    ranks[order] = np.arange(1, n + 1)
    avg = {v: ranks[x == v].mean() for v in np.unique(x)}
    # R's p.adjust(method = "BH")
    o = np.argsort(-x)
    q = np.minimum(1, np.minimum.accumulate(n / np.arange(n, 0, -1) * x[o]))
    qq = np.empty(n)
    qq[o] = q
    for k, i in enumerate(np.flatnonzero(ok)):
        r, qv = out[i]
        assert r == pytest.approx(avg[x[k]])
        assert qv == pytest.approx(qq[k], abs=1e-12)
        assert qv >= x[k] - 1e-15
    for i in np.flatnonzero(~ok):
        assert out[i] == (None, None)


def test_hwe_exact_matches_lgamma_form():
    from genoframe.operators.sites import hwe_exact_p_np

    def brute(a, h, b):
        n = a + h + b
        nr = h + 2 * min(a, b)
        xs = range(nr % 2, nr + 1, 2)
        lw = [x * math.log(2) - math.lgamma(x + 1) - math.lgamma((nr - x) / 2 + 1)
              - math.lgamma((2 * n - nr - x) / 2 + 1) for x in xs]
        mx = max(lw)
        w = [math.exp(v - mx) for v in lw]
        obs = lw[(h - nr % 2) // 2]
        return sum(wi for wi, li in zip(w, lw) if li <= obs + 1e-9) / sum(w)

    for t in [(50, 40, 10), (90, 0, 10), (1, 98, 1), (30, 1, 0), (0, 0, 5), (400, 100, 2), (600, 350, 50)]:
        assert hwe_exact_p_np(*t) == pytest.approx(brute(*t), rel=1e-9)


def test_merge_ids_and_clinsig(spark):
    from genoframe.functions.annotation import decode_clinsig, merge_ids
    df = spark.createDataFrame([("rs1,rs2", "rs1,rs2", "."), (".", None, "rs9"), ("", "rs3", "rs3")], "a string, b string, c string")
    got = [r[0] for r in df.select(merge_ids("a", "b", "c")).collect()]
    assert got == ["rs1;rs2", "rs9", "rs3"]
    codes = spark.createDataFrame([("5",), ("5,2",), ("5|2,3",), ("255|9",), ("9",)], "c string")
    got = [r[0] for r in codes.select(decode_clinsig("c")).collect()]
    assert got == ["pathogenic", None, "pathogenic|benign,likely-benign", "other", None]


def test_left_align(spark):
    from genoframe.operators.normalize import left_align, normalize_one
    seq = "GGGCACACACAT"          # positions 1..12
    # deletion of one CA repeat written at the right end: pos 9 'ACA' -> 'A'
    assert normalize_one(9, "ACA", "A", seq, 1) == (3, "GCA", "G")
    # insertion with extra padding on both sides
    assert normalize_one(10, "CA", "CACA", seq, 1) == (3, "G", "GCA")
    v = spark.createDataFrame([("1", 9, "ACA", "A"), ("1", 5, "A", "G")], "chrom string, pos int, ref string, alt string")
    w = spark.createDataFrame([("1", 0, seq[:6]), ("1", 1, seq[6:])], "chrom string, bin bigint, seq string")
    got = sorted(rows(left_align(v, w, 6), "pos", "ref", "alt", "changed"))
    assert got == [(3, "GCA", "G", True), (5, "A", "G", False)]


def test_decay_fit_recovers_truth():
    from genoframe.plans.curvefit import fit_one
    t = np.arange(0, 61, 6, dtype=float)
    y = 48 / (1 + np.exp((t - 33) / 5))
    d50, dx = fit_one(t, y)
    assert d50 == pytest.approx(33, abs=1e-6) and dx == pytest.approx(5, abs=1e-6)


def test_mixture_chi2_tail():
    from genoframe.plans.numerics import chi2_sf, mixture_chi2_sf
    assert mixture_chi2_sf(3.841458820694124, np.array([1.0])) == pytest.approx(0.05, rel=1e-9)
    for q in (2.0, 6.0, 12.0):   # chi2 with 4 df as 4 unit weights
        assert mixture_chi2_sf(q, np.ones(4)) == pytest.approx(chi2_sf(q, 4), rel=0.05)


def test_linear_glm_matches_dense_lstsq(spark, sf):
    """Sufficient-statistic OLS (with covariates and missing calls) equals a dense fit."""
    from genoframe.plans import assoc
    from genoframe.plans.q_stats import COVS, cohort_genotypes, model_frame
    mf = model_frame(spark, sf).where(F.col("pheno") == "QT")
    g = cohort_genotypes(spark, sf)
    res = {r["v"]: r for r in assoc.glm_linear(g, mf, COVS).collect()}
    m = mf.toPandas().set_index("sample_id")
    gp = g.toPandas()
    checked = 0
    for v, sub in gp.groupby("v"):
        if v not in res or checked >= 15 or res[v]["beta"] is None or math.isnan(res[v]["beta"]):
            continue
        gv = sub.set_index("sample_id")["dosage"]
        d = m.copy()
        d["g"] = 0.0
        d.loc[d.index.intersection(gv.index), "g"] = gv.reindex(d.index.intersection(gv.index)).to_numpy(float)
        d = d[~d["g"].isna()]
        X = np.column_stack([np.ones(len(d)), d[COVS].to_numpy(float), d["g"].to_numpy(float)])
        beta, *_ = np.linalg.lstsq(X, d["y"].to_numpy(float), rcond=None)
        assert res[v]["beta"] == pytest.approx(beta[-1], rel=1e-6, abs=1e-9)
        assert res[v]["n"] == len(d)
        checked += 1
    assert checked > 0


def test_plans_have_no_single_partition_scan(spark, sf):
    """The bucketed ordered scan must not plan a single-partition exchange over the rows."""
    from genoframe.plans.q_products import res
    from genoframe.operators.ordered import bh_adjust
    plan = bh_adjust(res(spark, sf).select("v", "p"), "p")._jdf.queryExecution().executedPlan().toString()
    # the only single-partition windows are over <= buckets rows (bucket totals)
    assert "CartesianProduct" not in plan


def test_overlap_join_is_not_cartesian(spark, sf):
    from genoframe import fixtures as fx
    from genoframe.operators.annotate import annotate_overlap
    out = annotate_overlap(fx.variants(spark, sf).select("v", "chrom", "pos"), fx.intervals(spark, sf),
                           {"n": ("sv_key", "count")})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_set_tests_calibrated_under_null():
    """SKAT / burden / SKAT-O p-values are ~uniform on null data and SKAT-O >= its best component."""
    from genoframe.plans import settest as sk
    rng = np.random.default_rng(3)
    n, m = 300, 6
    res = []
    for _ in range(150):
        G = (rng.random((n, m)) < 0.03).astype(float)
        y = rng.normal(size=n)
        r = (y - y.mean()) / y.std(ddof=1)
        P = np.eye(n) - np.ones((n, n)) / n
        w = sk.beta_weight(np.maximum(G.mean(0) / 2, 1e-4))
        S = (G.T @ r) * w
        K = (G.T @ P @ G) * np.outer(w, w)
        res.append((sk.skat_pvalue(S, K), sk.burden_pvalue(S, K), sk.skato_pvalue(S, K)))
    res = np.array(res)
    assert np.all((res[:, 2] >= np.minimum(res[:, 0], res[:, 1]) - 1e-9) | np.isnan(res[:, 2]))
    for col in range(3):
        assert 0.35 < np.nanmedian(res[:, col]) < 0.65
        assert np.mean(res[:, col] < 0.05) < 0.12


def test_ld_prune_segments_equal_chromosome_greedy(spark, sf):
    """Pruning per LD segment (cut where no above-threshold pair spans) equals one greedy pass
    per chromosome over the same pairs."""
    from genoframe import fixtures as fx
    from genoframe.plans import pca as pc
    from genoframe.plans.q_stats import _tags, cohort_genotypes
    g, tags = cohort_genotypes(spark, sf), _tags(spark, sf)
    v = fx.variants(spark, sf).join(tags.where(F.col("maf") >= 0.05).select("v"), "v", "left_semi")
    n = fx.samples(spark, sf).count()
    thr = 0.02
    kept = {r[0] for r in pc.ld_prune(g, v, tags, n, r2_max=thr).collect()}
    vidx = pc.variant_index(v.select("v", "chrom", "pos"))
    pairs, _ = pc.ld_pairs(g, vidx, n, 200, 50, thr)
    P, I = pairs.toPandas(), vidx.select("v", "_cn", "idx").toPandas()
    T = tags.select("v", "maf").toPandas()
    maf_v, idx_v, cn_v = dict(zip(T.v, T.maf)), dict(zip(I.v, I.idx)), dict(zip(I.v, I["_cn"]))
    removed = set()
    for cn in set(I["_cn"]):
        vs = list(I.v[I["_cn"] == cn])
        idx = np.array(sorted(idx_v[x] for x in vs))
        nbr = {}
        for a, b in zip(P.v_a, P.v_b):
            if cn_v[a] == cn:
                ia, ib = sorted((idx_v[a], idx_v[b]))
                nbr.setdefault(ia, set()).add(ib)
                nbr.setdefault(ib, set()).add(ia)
        rem = pc._greedy(idx, {idx_v[x]: maf_v.get(x, 0.0) for x in vs}, nbr, 200, 50, int(idx.min()), int(idx.max()))
        removed |= {x for x in vs if idx_v[x] in rem}
    assert len(P) > 0
    assert kept == set(I.v) - removed


def test_read_vcf_hand_written(spark, tmp_path):
    """Multi-sample VCF with phased, missing and partially missing calls and GT not first in FORMAT."""
    from genoframe.sources.vcf import read_vcf
    text = "\n".join([
        "##fileformat=VCFv4.2",
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB\tC",
        "1\t100\trs1\tA\tG\t50\tPASS\tAC=3;DB\tDP:GT\t9:0/1\t7:1|1\t3:0/0",
        "1\t200\t.\tC\tT\t.\tq10\t.\tGT:DP\t./.:1\t0/.:2\t1/0:5",
        "X\t300\t.\tG\tA\t12.5\tPASS\tAC=1\tGT\t0|0\t0|1\t0/0",
    ]) + "\n"
    p = tmp_path / "c.vcf"
    p.write_text(text)
    variants, genotypes = read_vcf(spark, str(p))
    v = {(r["chrom"], r["pos"]): r for r in variants.collect()}
    assert v[("1", 100)]["info"]["AC"] == "3" and v[("1", 100)]["qual"] == 50.0
    assert v[("1", 200)]["qual"] is None and v[("1", 200)]["filter"] == "q10"
    got = sorted((r["pos"], r["sample_id"], r["gt"], r["dosage"]) for r in genotypes.collect())
    assert got == [(100, "A", "0/1", 1), (100, "B", "1|1", 2), (200, "A", "./.", None),
                   (200, "B", "0/.", None), (200, "C", "1/0", 1), (300, "B", "0|1", 1)]


def test_firth_finite_under_separation():
    from genoframe.plans.numerics import logistic_firth, logistic_irls
    x = np.array([0, 0, 0, 0, 1, 1, 1, 1, 0, 1], float)
    y = np.array([0, 0, 0, 0, 1, 1, 1, 1, 0, 1], float)      # perfectly separated
    X = np.column_stack([np.ones(10), x])
    _, _, ok = logistic_irls(X, y)
    assert not ok
    beta, cov, conv = logistic_firth(X, y)
    assert conv and np.all(np.isfinite(beta)) and abs(beta[1]) < 10 and cov is not None


def test_logistic_glm_matches_direct_fit(spark, sf):
    """Sparse-to-dense densification in the logistic GLM equals a direct IRLS on dense data."""
    from genoframe.plans import assoc
    from genoframe.plans.numerics import logistic_irls
    from genoframe.plans.q_stats import COVS, cohort_genotypes, model_frame
    mf = model_frame(spark, sf).where(F.col("pheno") == "ALS")
    g = cohort_genotypes(spark, sf)
    vs = [r[0] for r in g.groupBy("v").count().where("count >= 5").orderBy("v").limit(6).collect()]
    g = g.where(F.col("v").isin(vs))
    res = {r["v"]: r for r in assoc.glm_logistic(g, mf, COVS).collect()}
    m = mf.toPandas().set_index("sample_id")
    gp = g.toPandas()
    checked = 0
    for v in vs:
        if v not in res or res[v]["firth"]:
            continue
        gv = gp[gp.v == v].set_index("sample_id")["dosage"]
        d = m.copy()
        d["g"] = 0.0
        common = d.index.intersection(gv.index)
        d.loc[common, "g"] = gv.reindex(common).to_numpy(float)
        d = d[~d["g"].isna()]
        X = np.column_stack([np.ones(len(d)), d["g"].to_numpy(float), d[COVS].to_numpy(float)])
        beta, _, ok = logistic_irls(X, d["y"].to_numpy(float))
        assert ok
        assert res[v]["beta"] == pytest.approx(beta[1], rel=1e-6, abs=1e-9)
        assert res[v]["n"] == len(d)
        checked += 1
    assert checked > 0


def test_randomized_pca_matches_dense(spark, sf):
    """The distributed GRM product equals the dense GRM times a block, and randomized
    subspace iteration with a full-rank block reproduces the dense eigenvalues."""
    from genoframe import fixtures as fx
    from genoframe.plans import pca as pc
    from genoframe.plans.q_stats import _tags, cohort_genotypes
    g, tags = cohort_genotypes(spark, sf), _tags(spark, sf)
    ids = sorted(r[0] for r in fx.samples(spark, sf).select("sample_id").collect())
    G, m = pc.grm_matrix(spark, g, tags, ids)
    sel, rows = pc._standardised_rows(g, tags, 0.05, "sample_id", "v")
    W = np.random.default_rng(1).standard_normal((len(ids), 3))
    assert np.abs(pc.grm_matvec(spark, rows, sel, ids, W, m) - G @ W).max() < 1e-10
    w, _ = pc.pca_randomized(spark, g, tags, ids, k=5, oversample=len(ids), power=1)
    wd = np.sort(np.linalg.eigvalsh(G))[::-1][:5]
    assert np.abs(w - wd).max() < 1e-8


def test_keyed_scan_hot_key_many_partitions(spark, sf):
    """With one key holding a third of the rows spread over 32 range partitions, the
    skew-safe fill-down / fill-up / row number equal the plain keyed windows."""
    from genoframe import fixtures as fx
    from genoframe.operators import windows as ow
    from genoframe.operators.scan import _scan, fill_up_scan
    v = fx.visits(spark, sf)
    hv = v.select("_row", F.when(F.col("_row") % 3 == 0, F.lit(0)).otherwise(F.col("pid")).cast("bigint").alias("pid"),
                  "day", F.when(F.col("_row") % 5 == 0, F.col("total")).alias("x"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = {r["_row"]: (r["x"], r["k"]) for r in _scan(hv, ["pid"], ["day", "_row"], ["x"], "k").collect()}
        up = {r["_row"]: r["x"] for r in fill_up_scan(hv, ["pid"], ["day", "_row"], ["x"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    ref = ow.with_row(ow.fill_down(hv, ["pid"], ["day", "_row"], ["x"]), ["day", "_row"], "k", keys=["pid"])
    want = {r["_row"]: (r["x"], r["k"]) for r in ref.collect()}
    want_up = {r["_row"]: r["x"] for r in ow.fill_up(hv, ["pid"], ["day", "_row"], ["x"]).collect()}
    assert got == want
    assert up == want_up


def test_left_align_crosses_windows_and_survives_missing_reference(spark):
    from genoframe.operators.normalize import left_align
    seq = "G" + "A" * 29                      # a homopolymer over five windows of 6
    w = spark.createDataFrame([("1", i, seq[6 * i: 6 * i + 6]) for i in range(5)], "chrom string, bin bigint, seq string")
    v = spark.createDataFrame([("1", 29, "AA", "A"), ("2", 9, "AC", "A")], "chrom string, pos int, ref string, alt string")
    got = sorted(rows(left_align(v, w, 6), "chrom", "pos", "ref", "alt", "changed"))
    assert got == [("1", 1, "GA", "G", True), ("2", 9, "AC", "A", False)]


def test_serial_dates_reject_junk(spark):
    import datetime as dt
    from genoframe.functions.dates import parse_dmy_or_serial
    df = spark.createDataFrame([("99999999999",), ("NaN",), ("44197",), ("3-2-2020",), (None,)], "x string")
    assert [r[0] for r in df.select(parse_dmy_or_serial("x")).collect()] == [None, None, dt.date(2021, 1, 1), dt.date(2020, 2, 3), None]


def test_neg_log10_of_zero_and_bh_of_nan(spark):
    from genoframe.functions.stats import neg_log10
    from genoframe.operators.ordered import bh_adjust
    df = spark.createDataFrame([(0.0,), (0.01,), (-1.0,), (None,)], "p double")
    assert [r[0] for r in df.select(neg_log10("p")).collect()] == [math.inf, 2.0, None, None]
    p = spark.createDataFrame([(1, 0.01), (2, 0.02), (3, float("nan")), (4, None)], "i int, p double")
    assert dict(rows(bh_adjust(p, "p"), "i", "q_fdr")) == {1: 0.02, 2: 0.02, 3: None, 4: None}


def test_sites_index_per_allele_fields(spark, tmp_path):
    from genoframe.sources.vcf import read_sites
    f = tmp_path / "s.vcf"
    f.write_text("##fileformat=VCFv4.2\n##INFO=<ID=AC,Number=A,Type=Integer>\n##INFO=<ID=AD,Number=R,Type=Integer>\n"
                 "##INFO=<ID=AN,Number=1,Type=Integer>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n"
                 "1\t10\t.\tA\tC,G\t.\tPASS\tAC=5,9;AN=20;AD=6,5,9\n")
    got = sorted(rows(read_sites(spark, str(f), ["AC", "AN", "AD"], ["ac", "an", "ad"]), "alt", "ac", "an", "ad"))
    assert got == [("C", "5", "20", "5"), ("G", "9", "20", "9")]


def test_sheet_export_keeps_quoted_separators(spark, tmp_path):
    from genoframe.sources.tabular import read_sheet_export
    f = tmp_path / "s.csv"
    f.write_text('title\nid,kind\n1,"ELA, bulbar"\n2,MS\n')
    assert sorted(rows(read_sheet_export(spark, str(f), skip=1), "id", "kind")) == [("1", "ELA, bulbar"), ("2", "MS")]


def test_rare_variant_hits_are_ranked_per_phenotype(spark, sf):
    from genoframe.plans.registry import load_all
    got = load_all()["e3_rare_variant_association"][0](spark, sf).collect()
    by = {}
    for r in got:
        by.setdefault((r["pheno"], r["max_maf"]), []).append(r)
    assert {cut for _, cut in by} == {0.01, 0.05} and len(by) > 12 and all(len(v) <= 20 for v in by.values())
    for v in by.values():
        assert sorted(r["ordinal"] for r in v) == list(range(1, len(v) + 1)) and len({r["name"] for r in v}) == len(v)


def test_bh_within_groups(spark):
    from genoframe.operators.ordered import bh_adjust
    rng = np.random.default_rng(5)
    data = [(g, i, None if i % 7 == 0 else float(round(rng.random(), 2))) for g in ("a", "b") for i in range(60)]
    got = {(r["g"], r["i"]): r["q_fdr"] for r in bh_adjust(spark.createDataFrame(data, "g string, i int, p double"), "p", by=["g"]).collect()}
    assert len(got) == len(data)
    for g in ("a", "b"):
        known = sorted((p, i) for k, i, p in data if k == g and p is not None)
        least = 1.0
        for at in range(len(known), 0, -1):
            least = min(least, len(known) * known[at - 1][0] / at)
            assert got[(g, known[at - 1][1])] == pytest.approx(least)
        assert all(got[(g, i)] is None for k, i, p in data if k == g and p is None)


def test_pca_pairs_are_eigenpairs(spark, sf):
    """|G v - lambda v| is about 0 for every returned component, G from the block sums."""
    from genoframe import fixtures as fx
    from genoframe.plans import pca as pc
    from genoframe.plans.q_stats import _tags, cohort_genotypes
    g, tags = cohort_genotypes(spark, sf), _tags(spark, sf)
    ids = sorted(r[0] for r in fx.samples(spark, sf).select("sample_id").collect())
    G, _ = pc.grm_matrix(spark, g, tags, ids)
    small, _ = pc.grm_pairs(spark, g, tags, ids, block=16)
    for r in small.collect():
        assert abs(G[r["i"], r["j"]] - r["grm"]) < 1e-9
    w, V = pc.pca_randomized(spark, g, tags, ids, k=10)
    assert np.linalg.norm(G @ V - V * w, axis=0).max() < 1e-6 * w[0]
    assert np.abs(w - np.sort(np.linalg.eigvalsh(G))[::-1][:10]).max() < 1e-6 * w[0]


def test_logistic_batch_equals_single_fits():
    from genoframe.plans.numerics import logistic_batch, logistic_irls
    rng = np.random.default_rng(3)
    X, y = rng.normal(size=(80, 2)), (rng.random(80) < 0.4).astype(float)
    G = rng.integers(0, 3, size=(12, 80)).astype(float)
    G[2, ::9] = np.nan
    G[3] = X[:, 0]                                         # explained by a covariate: no fit
    beta, se, ok = logistic_batch(X, G, y)
    assert not ok[3] and ok.sum() == 11
    for r in np.flatnonzero(ok):
        m = ~np.isnan(G[r])
        b, cov, done = logistic_irls(np.column_stack([np.ones(m.sum()), G[r][m], X[m]]), y[m])
        assert done and beta[r] == pytest.approx(b[1], abs=1e-7) and se[r] == pytest.approx(math.sqrt(cov[1, 1]), rel=1e-6)


def test_single_variant_flow_runs_every_phenotype(spark, sf):
    from genoframe.plans.registry import load_all
    got = load_all()["e2_single_variant_association"][0](spark, sf).toPandas()
    assert set(got.loc[got["test"] == "linear", "pheno"]) == {"QT"}
    assert len(set(got.loc[got["test"] == "logistic", "pheno"])) >= 8
    for _, part in got.groupby("pheno"):
        p = part.dropna(subset=["p"]).sort_values("p")
        raw = p["p"].to_numpy() * len(p) / np.arange(1, len(p) + 1)
        want = np.minimum(np.minimum.accumulate(raw[::-1])[::-1], 1.0)
        assert np.allclose(p["q_fdr"].to_numpy(), want)


def test_null_safe_join_spreads_the_null_key(spark):
    """Every left row with a NULL key meets every right one, in more than one task; repeats and other keys as in plain SQL."""
    from genoframe.operators.joins import left_join
    a = spark.range(300).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("k")).unionByName(
        spark.createDataFrame([(7, None), (7, None), (8, 99)], "id bigint, k bigint"))
    b = spark.range(40).select(F.when(F.col("id") % 4 > 0, F.col("id") % 7).alias("k"), F.col("id").alias("r"))
    a.createOrReplaceTempView("nsj_a")
    b.createOrReplaceTempView("nsj_b")
    want = sorted(map(tuple, spark.sql("SELECT a.id, a.k, b.r FROM nsj_a a LEFT JOIN nsj_b b ON a.k <=> b.k").collect()), key=str)
    got = left_join(a, b, "k", null_safe=True)
    assert got.columns == ["id", "k", "r"] and sorted(map(tuple, got.collect()), key=str) == want
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = left_join(a, b, "k", null_safe=True).where("k IS NULL").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks > 1
