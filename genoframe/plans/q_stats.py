"""Registered analyses: statistical operators (ST-1..11), PCA-based figure tables, UDF surface, run grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoframe import fixtures as fx
from genoframe.functions import annotation as fa
from genoframe.functions.recode import binary01
from genoframe.operators import annotate as oa
from genoframe.operators import reshape as ors
from genoframe.operators import sites as osi
from genoframe.plans import assoc as st
from genoframe.plans import curvefit as cf
from genoframe.plans import logistic as lg
from genoframe.plans import nullmodel as nl
from genoframe.plans import pca as pc
from genoframe.plans import products as pr
from genoframe.plans import settest as sk
from genoframe.plans.phenotypes import PSAM_CODES, make_psam
from genoframe.plans.q_filters import RVA_FILTER
from genoframe.plans.q_columns import PSAM_SQL, r6, zscored_pcs, SQL_PCS
from genoframe.plans.registry import register
from genoframe.session import ensure_checkpoint_dir

COVS = [f"PC{i}" for i in range(1, 7)]
# The MAF cuts of the run grid.
MAF_CUTS = [0.01, 0.05]


def cohort_genotypes(spark, d, rare: bool = False):
    g = fx.rare_genotypes(spark, d) if rare else fx.genotypes(spark, d)
    return g.withColumn("sample_id", F.format_string("S%03d", "s"))


def pheno_long(spark, d):
    """Long phenotypes: categorical traits recoded 1/2 -> 0/1, plus a continuous trait QT."""
    ps = make_psam(fx.pheno(spark, d), continuous={})
    binary = [c for c in ps.columns if c in PSAM_CODES]
    ps = ps.select("sample_id", *[binary01(c).cast("double").alias(c) for c in binary])
    qt = fx.pheno(spark, d).select("sample_id", F.round(F.col("quant") / 1000.0, 6).alias("QT"))
    wide = ps.join(qt, "sample_id")
    return wide.unpivot(["sample_id"], binary + ["QT"], "pheno", "value").where(F.col("value").isNotNull())


def model_frame(spark, d, cov=COVS):
    return st.model_frame_long(pheno_long(spark, d), zscored_pcs(spark, d), cov)


def maf_filtered(spark, d, g):
    tags = osi.fill_tags(g, fx.samples(spark, d))
    keep = osi.maf_mac(tags, 0.05, 20).select("v")
    return g.join(keep, "v", "left_semi")


# ------------------------------------------------------------------ ST-1 GRM / PCA
def _tags(spark, d):
    return osi.fill_tags(fx.genotypes(spark, d), fx.samples(spark, d))


@register("st01_grm", """
, n AS (SELECT count(*) AS n FROM samples)
, tg AS (SELECT v, sum(dosage) AS ac, 2 * (n.n - count(*) FILTER (WHERE dosage IS NULL)) AS an FROM genotypes, n GROUP BY v, n.n)
, sel AS (SELECT v, ac / CAST(an AS DOUBLE) AS p FROM tg
          WHERE least(ac / CAST(an AS DOUBLE), 1 - ac / CAST(an AS DOUBLE)) >= 0.05 AND ac > 0 AND ac < an)
, dense AS (SELECT sel.v, sa.sample_id,
              CASE WHEN g.v IS NOT NULL AND g.dosage IS NULL THEN 0.0
                   ELSE (coalesce(g.dosage, 0) - 2 * sel.p) / sqrt(2 * sel.p * (1 - sel.p)) END AS x
            FROM sel CROSS JOIN samples sa LEFT JOIN genotypes g ON g.v = sel.v AND g.s = sa.s)
, m AS (SELECT count(*) AS m FROM sel)
SELECT a.sample_id AS sample_i, b.sample_id AS sample_j, round(sum(a.x * b.x) / max(m.m), 6) AS grm
FROM dense a JOIN dense b ON a.v = b.v AND a.sample_id <= b.sample_id CROSS JOIN m
GROUP BY 1, 2""", ["samples", "genotypes"])
def st01(spark, d):
    g = cohort_genotypes(spark, d)
    t = pc.grm_table(spark, g, _tags(spark, d), fx.samples(spark, d))
    return t.select("sample_i", "sample_j", r6(F.col("grm")).alias("grm"))


def pca_result(spark, d, k: int = 10):
    return pc.pca(spark, cohort_genotypes(spark, d), _tags(spark, d), fx.samples(spark, d), k)


@register("st01b_pca")
def st01b(spark, d):
    pcs, _ = pca_result(spark, d)
    return pcs


@register("st01d_pca_residual", """
SELECT CAST(pc AS INTEGER) AS pc, 1.0::DOUBLE AS norm, 0.0::DOUBLE AS residual FROM (SELECT unnest(range(1, 11)) AS pc), (SELECT count(*) AS n FROM samples) WHERE pc <= n""", ["samples"])
def st01d(spark, d):
    """Every component has length 1 and is an eigenvector: max |G v - lambda v| against the first eigenvalue."""
    r = pc.pca_residuals(cohort_genotypes(spark, d), _tags(spark, d), fx.samples(spark, d))
    return r.select(F.col("pc").cast("int").alias("pc"), r6(F.col("norm")).alias("norm"), r6(F.col("residual")).alias("residual"))


@register("dp5b_scree_pca")
def dp5b(spark, d):
    _, eig = pca_result(spark, d)
    return pr.scree(eig)


@register("dp6_pca_pairs")
def dp6(spark, d):
    pcs, _ = pca_result(spark, d)
    return ors.pca_pairs(pcs, fx.pheno(spark, d).select("sample_id", "pheno"), n_pc=10)




# ------------------------------------------------------------------ ST-2 LD pruning
@register("st02_ld_prune")
def st02(spark, d):
    g = cohort_genotypes(spark, d)
    tags = _tags(spark, d)
    common = tags.where(F.col("maf") >= 0.05).select("v")
    v = fx.variants(spark, d).join(common, "v", "left_semi")
    return pc.ld_prune(g, v, tags, fx.samples(spark, d).count())


@register("st02b_ld_r2", """
, n AS (SELECT count(*) AS n FROM samples)
, tg AS (SELECT v, CAST(sum(dosage) AS BIGINT) AS ac, 2 * (n.n - count(*) FILTER (WHERE dosage IS NULL)) AS an FROM genotypes, n GROUP BY v, n.n)
, sel AS (SELECT tg.v, vv.chrom, row_number() OVER (PARTITION BY vv.chrom ORDER BY vv.pos, vv.v) - 1 AS idx FROM tg JOIN variants vv ON vv.v = tg.v
          WHERE least(ac / CAST(an AS DOUBLE), 1 - ac / CAST(an AS DOUBLE)) >= 0.05)
, x AS (SELECT sel.v, sel.chrom, sel.idx, sa.s, CASE WHEN g.v IS NOT NULL AND g.dosage IS NULL THEN NULL ELSE CAST(coalesce(g.dosage, 0) AS DOUBLE) END AS g
        FROM sel CROSS JOIN samples sa LEFT JOIN genotypes g ON g.v = sel.v AND g.s = sa.s)
, r AS (SELECT least(a.v, b.v) AS v_a, greatest(a.v, b.v) AS v_b, regr_r2(a.g, b.g) AS r2, regr_sxx(a.g, b.g) AS sxx, regr_syy(a.g, b.g) AS syy
        FROM x a JOIN x b ON a.chrom = b.chrom AND a.s = b.s AND a.idx < b.idx AND b.idx < a.idx - a.idx % 50 + 200 GROUP BY a.v, b.v)
SELECT v_a, v_b, round(r2, 6) AS r2 FROM r WHERE r2 > 0.05 AND sxx > 0 AND syy > 0""", ["samples", "genotypes", "variants"])
def st02b(spark, d):
    """r^2 above 0.05 of every pair that shares a pruning window."""
    tags = _tags(spark, d)
    v = fx.variants(spark, d).join(tags.where(F.col("maf") >= 0.05).select("v"), "v", "left_semi")
    pairs, _ = pc.ld_pairs(cohort_genotypes(spark, d), pc.variant_index(v.select("v", "chrom", "pos")), fx.samples(spark, d).count(), r2_min=0.05)
    return pairs.select("v_a", "v_b", r6(F.col("r2")).alias("r2"))


# ------------------------------------------------------------------ ST-3 standardize
@register("st03_standardize", SQL_PCS + """
SELECT sample_id, """ + ", ".join(f'round("PC{i}", 6) AS "PC{i}"' for i in range(1, 7)) + " FROM pcs",
          ["pheno"])
def st03(spark, d):
    z = zscored_pcs(spark, d)
    return z.select("sample_id", *[r6(F.col(c)).alias(c) for c in COVS])


# ------------------------------------------------------------------ ST-4 linear GLM
SQL_LIN_NOCOV = """
, n AS (SELECT count(*) AS n FROM samples)
, tg AS (SELECT v, CAST(sum(dosage) AS BIGINT) AS ac, 2 * (n.n - count(*) FILTER (WHERE dosage IS NULL)) AS an
         FROM genotypes, n GROUP BY v, n.n)
, sel AS (SELECT v FROM tg WHERE least(ac / CAST(an AS DOUBLE), 1 - ac / CAST(an AS DOUBLE)) >= 0.05
                             AND least(ac, an - ac) >= 20)
, yv AS (SELECT sample_id, s, round(quant / 1000.0, 6) AS y FROM pheno)
, dense AS (SELECT sel.v, yv.y, CAST(coalesce(g.dosage, 0) AS DOUBLE) AS g,
              (g.v IS NOT NULL AND g.dosage IS NULL) AS miss
            FROM sel CROSS JOIN yv LEFT JOIN genotypes g ON g.v = sel.v AND g.s = yv.s)
, fit AS (SELECT v, count(*) AS n, regr_slope(y, g) AS beta, regr_sxx(y, g) AS sxx, regr_syy(y, g) AS syy,
                 regr_sxy(y, g) AS sxy FROM dense WHERE NOT miss GROUP BY v)
SELECT 'QT' AS pheno, v, CAST(n AS BIGINT) AS n, round(beta, 6) AS beta,
       round(sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx), 6) AS se,
       round(beta / sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx), 6) AS t_stat
FROM fit"""


@register("st04_glm_linear_nocov", SQL_LIN_NOCOV, ["samples", "genotypes", "pheno"])
def st04(spark, d):
    mf = model_frame(spark, d, []).where(F.col("pheno") == "QT")
    g = maf_filtered(spark, d, cohort_genotypes(spark, d))
    r = st.glm_linear(g, mf, [])
    return r.select("pheno", "v", "n", r6(F.col("beta")).alias("beta"), r6(F.col("se")).alias("se"),
                    r6(F.col("t_stat")).alias("t_stat"))


@register("st04b_glm_linear")
def st04b(spark, d):
    mf = model_frame(spark, d).where(F.col("pheno") == "QT")
    return st.glm_linear(maf_filtered(spark, d, cohort_genotypes(spark, d)), mf, COVS)


@register("st05_glm_logistic")
def st05(spark, d):
    return st.glm_logistic(maf_filtered(spark, d, cohort_genotypes(spark, d)), model_frame(spark, d), COVS)


@register("st05c_logistic_screened")
def st05c(spark, d):
    """Score test with saddlepoint tails for every variant, full fits where its p is 0.05 or less."""
    return lg.screened(maf_filtered(spark, d, cohort_genotypes(spark, d)), model_frame(spark, d), COVS, screen_p=0.05)


# ------------------------------------------------------------------ ST-6 null model
@register("st06_null_model_intercept", """
, yv AS (SELECT sample_id, round(quant / 1000.0, 6) AS y FROM pheno)
SELECT 'QT' AS pheno, sample_id, round(y - avg(y) OVER (), 6) AS resid_raw FROM yv""", ["pheno"])
def st06(spark, d):
    mf = model_frame(spark, d, []).where(F.col("pheno") == "QT")
    nmod = st.null_model(mf, [])
    # the model is y ~ 1, so resid * sigma = y - mean(y)
    sig = mf.agg(F.stddev_samp("y")).first()[0]
    return nmod.select("pheno", "sample_id", r6(F.col("resid") * F.lit(sig)).alias("resid_raw"))


@register("st06b_null_model")
def st06b(spark, d):
    return st.null_model(model_frame(spark, d), COVS)


#: Long phenotypes as the model frame reads them (values of the traits recoded to 0/1, and QT).
LONG_SQL = """
, ps AS (""" + PSAM_SQL.strip() + """)
, long AS (""" + " UNION ALL ".join(f"SELECT sample_id, '{t}' AS pheno, CAST(\"{t}\" AS DOUBLE) - 1 AS y FROM ps WHERE \"{t}\" IN (1, 2)" for t in PSAM_CODES) + """
           UNION ALL SELECT sample_id, 'QT', round(quant / 1000.0, 6) FROM pheno)
, ok AS (SELECT pheno, count(*) AS n, sum(y) AS sum_y FROM long GROUP BY pheno HAVING count(DISTINCT y) >= 2)"""


@register("st05b_logistic_score_nocov", LONG_SQL + """
, n AS (SELECT count(*) AS n FROM samples)
, tg AS (SELECT v, CAST(sum(dosage) AS BIGINT) AS ac, 2 * (n.n - count(*) FILTER (WHERE dosage IS NULL)) AS an FROM genotypes, n GROUP BY v, n.n)
, sel AS (SELECT v FROM tg WHERE least(ac / CAST(an AS DOUBLE), 1 - ac / CAST(an AS DOUBLE)) >= 0.05 AND least(ac, an - ac) >= 20)
, mu AS (SELECT pheno, sum_y / n AS mu FROM ok WHERE pheno <> 'QT')
, d AS (SELECT l.pheno, sel.v, CAST(coalesce(g.dosage, 0) AS DOUBLE) AS g, l.y - m.mu AS r, m.mu * (1 - m.mu) AS w
        FROM sel CROSS JOIN long l JOIN mu m ON m.pheno = l.pheno JOIN samples sa ON sa.sample_id = l.sample_id
        LEFT JOIN genotypes g ON g.v = sel.v AND g.s = sa.s WHERE NOT (g.v IS NOT NULL AND g.dosage IS NULL))
, t AS (SELECT pheno, v, count(*) AS n, sum(g * r) - sum(g) / count(*) * sum(r) AS score, max(w) * (sum(g * g) - sum(g) * sum(g) / count(*)) AS variance
        FROM d GROUP BY pheno, v HAVING max(g) > min(g))
SELECT pheno, v, n, round(score, 6) + 0.0 AS score, round(variance, 6) AS variance, round(score / sqrt(variance), 6) + 0.0 AS z_score FROM t""",
          ["pheno", "samples", "genotypes"])
def st05b(spark, d):
    """The score test without covariates, which has a closed form."""
    t = lg.score_test(maf_filtered(spark, d, cohort_genotypes(spark, d)), model_frame(spark, d, []), [])
    return t.select("pheno", "v", "n", *[(r6(F.col(c)) + F.lit(0.0)).alias(c) for c in ("score", "variance", "z_score")])


@register("st06c_null_model_score", LONG_SQL + """
SELECT pheno, term, n, round(sum_y, 4) AS sum_y, round(sum_y, 4) AS sum_mu, 0.0::DOUBLE AS score
FROM ok, (SELECT unnest(['(intercept)', """ + ", ".join(f"'{c}'" for c in COVS) + """]) AS term) t""", ["pheno"])
def st06c(spark, d):
    """The score equations X'(y - mu) = 0 of every phenotype's model."""
    mf = nl.prepared(model_frame(spark, d))
    eq = nl.score_equations(mf, nl.fit_null(mf, COVS), COVS)
    return eq.select("pheno", "term", "n", F.round("sum_y", 4).alias("sum_y"), F.round("sum_mu", 4).alias("sum_mu"),
                     (F.round("score", 4) + F.lit(0.0)).alias("score"))


# ------------------------------------------------------------------ ST-7..10 set tests
def gene_sets(spark, d):
    """Variant -> gene (the annotation's SYMBOL unit) for annotated, PASS variants."""
    v = fx.variants(spark, d)
    return v.where((F.col("v") % 3 != 0) & (F.col("filter") == "PASS")).select("v", F.col("gene").alias("unit"))


def _set_test(spark, d, phenos, max_maf, method):
    mf = model_frame(spark, d)
    if phenos:
        mf = mf.where(F.col("pheno").isin(*phenos))
    nmod = st.null_model(mf, COVS)
    return sk.set_test(cohort_genotypes(spark, d, rare=True), gene_sets(spark, d), nmod,
                       zscored_pcs(spark, d), COVS, max_maf=max_maf, method=method)


register("st07_skat")(lambda spark, d: _set_test(spark, d, ["QT"], 0.05, "SKAT"))
register("st08_skato")(lambda spark, d: _set_test(spark, d, ["QT"], 0.05, "SKATO"))
register("st08b_burden")(lambda spark, d: _set_test(spark, d, ["QT"], 0.05, "burden"))
register("st09_skato_binary")(lambda spark, d: _set_test(spark, d, list(PSAM_CODES), 0.05, "SKATO"))
register("st10_skato_maf001")(lambda spark, d: _set_test(spark, d, None, 0.01, "SKATO"))


@register("st10b_maf_cut", """
, ctl AS (SELECT s FROM pheno)
, af AS (SELECT v, sum(dosage) / (2.0 * (SELECT count(*) FROM ctl)) AS af FROM rare_genotypes GROUP BY v)
SELECT v, round(least(af, 1 - af), 6) AS maf, least(af, 1 - af) <= 0.01 AS keep_001,
       least(af, 1 - af) <= 0.05 AS keep_005 FROM af""", ["pheno", "rare_genotypes"])
def st10b(spark, d):
    g = fx.rare_genotypes(spark, d)
    t = osi.fill_tags(g, fx.pheno(spark, d).select("s"))
    return t.select("v", r6(F.col("maf")).alias("maf"), (F.col("maf") <= 0.01).alias("keep_001"),
                    (F.col("maf") <= 0.05).alias("keep_005"))


# ------------------------------------------------------------------ ST-11 decay fit
@register("st11_fit_d50", """
SELECT pid, CAST(20 + pid % 80 AS DOUBLE) AS "D50", CAST(2 + pid % 7 AS DOUBLE) AS "Dx"
FROM curves WHERE total BETWEEN 1 AND 48 GROUP BY pid HAVING count(*) >= 3""", ["curves"])
def st11(spark, d):
    f = cf.fit_d50(fx.curves(spark, d))
    return f.select("pid", F.round("D50", 4).alias("D50"), F.round("Dx", 4).alias("Dx"))


@register("st11b_fit_d50_visits")
def st11b(spark, d):
    """The decay fit on the registry visits (t = months since onset)."""
    from genoframe.functions.dates import months_between_avg
    v = fx.visits(spark, d).join(fx.patients(spark, d).select("pid", "onset"), "pid")
    pts = v.select("pid", months_between_avg("day", "onset", None).alias("t"), "total")
    return cf.fit_d50(pts)


# ------------------------------------------------------------------ UDF surface
@register("udf01_post_ops", """
SELECT vv.v, coalesce(greatest(""" + ", ".join(
    f"CASE WHEN s.\"AC_{p}\" = 0 THEN 0.0 ELSE round(s.\"AC_{p}\" / nullif(CAST(s.\"AN_{p}\" AS DOUBLE), 0), 9) END"
    for p in fx.POPULATIONS) + """) > 0.01, false) AS is_common
FROM variants vv LEFT JOIN sites s USING (chrom, pos, ref, alt)""", ["variants", "sites"])
def udf01(spark, d):
    spec = oa.gnomad_spec()
    spec.post.append(("is_common", lambda m: F.coalesce(m > 0.01, F.lit(False)), ["max_aaf_all"]))
    return oa.annotate_exact(fx.variants(spark, d), fx.sites(spark, d), spec).select("v", "is_common")


@register("udf02_annotation_ops", """
SELECT vv.v, s.n_src, s.max_score, s.names
FROM variants vv LEFT JOIN (
  SELECT chrom, CAST(count(*) AS BIGINT) AS n_src, max(sv_score) AS max_score,
         string_agg(sv_name, ',' ORDER BY sv_name) AS names FROM intervals GROUP BY chrom) s USING (chrom)""",
          ["variants", "intervals"])
def udf02(spark, d):
    spec = oa.AnnotationSpec(["sv_key", "sv_score", "sv_name"], ["n_src", "max_score", "names"],
                             ["count", "max", "concat"])
    out = oa.annotate_exact(fx.variants(spark, d), fx.intervals(spark, d), spec, key=["chrom"])
    return out.select("v", F.col("n_src").cast("bigint"), "max_score", "names")


@register("udf03_across", """
SELECT s, """ + ", ".join(f"round(c{i} / 1000.0, 3) AS c{i}" for i in range(1, 7)) + " FROM pheno", ["pheno"])
def udf03(spark, d):
    from genoframe.operators.columns import across
    p = fx.pheno(spark, d).select("s", *[f"c{i}" for i in range(1, 7)])
    return across(p, "starts:c", lambda c: F.round(c / 1000.0, 3))


@register("udf04_group_map", """
SELECT pid, CAST(count(*) AS BIGINT) AS n_visits, max(total) AS best_total FROM visits
WHERE total IS NOT NULL GROUP BY pid""", ["visits"])
def udf04(spark, d):
    import pandas as pd
    from genoframe.operators.grouped import group_map

    def summary(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"pid": [pdf["pid"].iloc[0]], "n_visits": [len(pdf)],
                             "best_total": [int(pdf["total"].max())]})

    v = fx.visits(spark, d).where(F.col("total").isNotNull()).select("pid", "total")
    return group_map(v, ["pid"], summary, "pid bigint, n_visits bigint, best_total int")


@register("set11_association_grid", """
, ps AS (""" + PSAM_SQL.strip() + """)
, long AS (""" + " UNION ALL ".join(f"SELECT '{t}' AS pheno, CAST(\"{t}\" AS DOUBLE) AS value FROM ps" for t in PSAM_CODES) + """
           UNION ALL SELECT 'QT', round(quant / 1000.0, 6) FROM pheno)
, ok AS (SELECT pheno FROM long WHERE value IS NOT NULL GROUP BY pheno HAVING count(DISTINCT value) >= 2)
SELECT '""" + RVA_FILTER + """' AS filter, m.max_maf, pheno, 'SYMBOL' AS unit, 'SKATO' AS test
FROM ok, (VALUES """ + ", ".join(f"(CAST({c} AS DOUBLE))" for c in MAF_CUTS) + """) m(max_maf)""", ["pheno"])
def set11(spark, d):
    """The run grid over phenotypes that pass FLT-25, as one DataFrame (exploded, not joined)."""
    phenos = st.valid_phenotypes(model_frame(spark, d))
    return phenos.select(F.lit(RVA_FILTER).alias("filter"), F.explode(F.array(*[F.lit(c) for c in MAF_CUTS])).alias("max_maf"), "pheno",
                         F.lit("SYMBOL").alias("unit"), F.lit("SKATO").alias("test"))


# ------------------------------------------------------------------ end-to-end flows
from genoframe.plans import pipelines as pl  # noqa: E402
from genoframe.plans.q_sites import _hwe_sql  # noqa: E402


def _qc(spark, d):
    return pl.qc_cohort(fx.genotypes(spark, d), fx.variants(spark, d), fx.samples(spark, d))


@register("e2_qc_cohort", """
, nv AS (SELECT count(*) AS nv FROM variants WHERE regexp_full_match(ref, '[ACGT]') AND regexp_full_match(alt, '[ACGT]'))
, snp AS (SELECT g.* FROM genotypes g JOIN variants vv ON g.v = vv.v
          WHERE regexp_full_match(vv.ref, '[ACGT]') AND regexp_full_match(vv.alt, '[ACGT]'))
, srate AS (SELECT sa.s, coalesce(m.miss, 0) / CAST((SELECT nv FROM nv) AS DOUBLE) AS f
            FROM samples sa LEFT JOIN (SELECT s, count(*) AS miss FROM snp WHERE dosage IS NULL GROUP BY s) m ON m.s = sa.s)
, ks AS (SELECT s FROM srate WHERE f <= 0.1)
, g1 AS (SELECT * FROM snp WHERE s IN (SELECT s FROM ks))
, nk AS (SELECT count(*) AS n FROM ks)
, vrate AS (SELECT vv.v, coalesce(m.miss, 0) / CAST((SELECT n FROM nk) AS DOUBLE) AS f
            FROM variants vv LEFT JOIN (SELECT v, count(*) AS miss FROM g1 WHERE dosage IS NULL GROUP BY v) m ON m.v = vv.v
            WHERE regexp_full_match(vv.ref, '[ACGT]') AND regexp_full_match(vv.alt, '[ACGT]'))
, kv AS (SELECT v FROM vrate WHERE f <= 0.05)
, g2 AS (SELECT * FROM g1 WHERE v IN (SELECT v FROM kv))""" + _hwe_sql("g2", "(SELECT n FROM nk)") + """
SELECT kv.v FROM kv LEFT JOIN hwe ON hwe.v = kv.v WHERE hwe.p_hwe IS NULL OR hwe.p_hwe >= 1e-8""",
          ["genotypes", "variants", "samples"])
def e2_qc(spark, d):
    _, v, _ = _qc(spark, d)
    return v.select("v")


@register("e2_single_variant_association")
def e2_sva(spark, d):
    g = cohort_genotypes(spark, d)
    s = fx.samples(spark, d)
    return pl.single_variant_association(spark, g, fx.variants(spark, d), s, pheno_long(spark, d), n_pc=6)


@register("e3_rare_variant_association")
def e3_rva(spark, d):
    """All phenotypes and both MAF cuts in one job; q-values and the top 20 per (phenotype, cut)."""
    from genoframe.plans.q_filters import annotated
    nmod = st.null_model(model_frame(spark, d), COVS)
    res = pl.rare_variant_association(cohort_genotypes(spark, d, rare=True), annotated(spark, d),
                                      gene_sets(spark, d), nmod, zscored_pcs(spark, d), COVS,
                                      RVA_FILTER, max_maf=MAF_CUTS)
    ensure_checkpoint_dir(spark)
    return pr.top_hits_by(res.checkpoint(), ["pheno", "max_maf"], 20)


@register("e3b_association_grid")
def e3b(spark, d):
    """The grid drives the run over the whole cohort: three filters, two units, both cuts, every call of every customer."""
    from genoframe.plans import grid
    from genoframe.plans.q_filters import GRID_FILTERS, GRID_UNITS, annotated_cohort
    ensure_checkpoint_dir(spark)
    s = fx.cohort_samples(spark, d)
    covs = ["c1", "c2"]
    cov = st.standardize(s.select("sample_id", *covs), covs).checkpoint()
    traits = s.select("sample_id", F.col("case").alias("CASE"), "QT").unpivot(["sample_id"], ["CASE", "QT"], "pheno", "value")
    mf = st.model_frame_long(traits, cov, covs)
    settings = [F.explode(F.array(*[F.lit(x) for x in xs])).alias(n) for n, xs in
                (("filter", GRID_FILTERS), ("max_maf", MAF_CUTS), ("unit", list(GRID_UNITS)))]
    g = st.valid_phenotypes(mf)
    for c in settings:
        g = g.select("*", c)
    calls = fx.cohort_calls(spark, d).join(s.select("s", "sample_id"), "s").select("v", "sample_id", "dosage")
    return grid.run_grid(calls, annotated_cohort(spark, d), g.withColumn("test", F.lit("SKATO")), st.null_model(mf, covs), cov, covs, GRID_UNITS)


@register("st01c_pca_randomized")
def st01c(spark, d):
    """ST-1 with fewer extra columns and more steps."""
    w, vectors = pc._components(cohort_genotypes(spark, d), _tags(spark, d), fx.samples(spark, d), 10, 0.05, "sample_id", "v", oversample=6, power=12)
    return vectors.select("sample_id", *[F.col("pc")[j].alias(f"PC{j + 1}") for j in range(len(w))])
