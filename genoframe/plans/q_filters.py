"""Registered analyses: filters (FLT) and set-union filter modes (SET-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoframe import fixtures as fx
from genoframe.functions import ids as fi
from genoframe.operators import columns as oc
from genoframe.operators import filters as ofl
from genoframe.operators import sites as osi
from genoframe.plans.phenotypes import PSAM_CODES, make_psam
from genoframe.plans.q_columns import CSQ_FIELDS, SQL_NORMALIZE_IDS, r6
from genoframe.plans.registry import register

RVA_FILTER = "impact_HIGH_or_cadd_20_or_sift4g_D_or_polyphen2_D"


def annotated(spark, d):
    """Variants + rare-cohort tags (MAF) + worst-transcript predictions."""
    v = fx.variants(spark, d)
    tags = osi.fill_tags(fx.rare_genotypes(spark, d), fx.samples(spark, d), variants=v)
    c = osi.worst_consequence(oc.split_csq(fx.csq(spark, d), CSQ_FIELDS, {"CADD_phred": "double"}))
    w = F.col("worst")
    return (v.join(tags.select("v", "ac", "an", "maf"), "v", "left")
            .join(c.select("v", w["SIFT_pred"].alias("sift_pred"),
                           w["Polyphen2_HVAR_pred"].alias("polyphen2_hvar_pred"),
                           w["SIFT4G_pred"].alias("sift4g_pred"), w["SYMBOL"].alias("symbol")), "v", "left"))


SQL_ANN = """
, n AS (SELECT count(*) AS n FROM samples)
, rtags AS (SELECT v, sum(dosage) AS ac FROM rare_genotypes GROUP BY v)
, tx AS (SELECT v, unnest(string_split(csq, ',')) AS t, generate_subscripts(string_split(csq, ','), 1) AS i FROM csq)
, worst AS (SELECT v, string_split(t, '|') AS f FROM (
    SELECT v, t, row_number() OVER (PARTITION BY v ORDER BY
      coalesce(list_position(['HIGH','MODERATE','LOW','MODIFIER'], string_split(t, '|')[2]), 5), i) AS rn FROM tx)
    WHERE rn = 1)
, ann AS (
  SELECT vv.*, coalesce(rt.ac, 0) AS ac, 2 * n.n AS an,
    least(coalesce(rt.ac, 0) / (2.0 * n.n), 1 - coalesce(rt.ac, 0) / (2.0 * n.n)) AS maf,
    w.f[5] AS sift_pred, w.f[4] AS polyphen2_hvar_pred, w.f[6] AS sift4g_pred, w.f[1] AS symbol
  FROM variants vv CROSS JOIN n LEFT JOIN rtags rt ON rt.v = vv.v LEFT JOIN worst w ON w.v = vv.v)"""
ANN_NEEDS = ["variants", "samples", "rare_genotypes", "csq"]


def _ann_query(name, where_sql, pyfilter):
    register(name, SQL_ANN + f"\nSELECT v, chrom, pos FROM ann WHERE {where_sql}", ANN_NEEDS)(
        lambda spark, d: pyfilter(annotated(spark, d)).select("v", "chrom", "pos"))


register("flt01_filter_pass", "SELECT v, chrom, pos FROM variants WHERE filter = 'PASS'", ["variants"])(
    lambda spark, d: ofl.filter_pass(fx.variants(spark, d)).select("v", "chrom", "pos"))
_ann_query("flt02_maf_lt", "maf < 0.01", lambda a: ofl.maf_lt(a, 0.01))
_ann_query("flt03_maf_gt", "maf > 0.01", lambda a: ofl.maf_gt(a, 0.01))
_ann_query("flt04_impact", "regexp_matches(impact, 'HIGH')", lambda a: ofl.tag_matches(a, "impact", "HIGH"))
_ann_query("flt05_sift", "regexp_matches(sift_pred, 'D')", lambda a: ofl.tag_matches(a, "sift_pred", "D"))
_ann_query("flt06_polyphen2", "regexp_matches(polyphen2_hvar_pred, 'D')",
           lambda a: ofl.tag_matches(a, "polyphen2_hvar_pred", "D"))
_ann_query("flt07_cadd_ge", "cadd >= 20", lambda a: ofl.cadd_ge(a, 20))
_ann_query("flt08_sift4g", "regexp_matches(sift4g_pred, 'D')", lambda a: ofl.tag_matches(a, "sift4g_pred", "D"))
_ann_query("flt09_named_or_filter",
           "regexp_matches(impact, 'HIGH') OR cadd >= 20 OR regexp_matches(sift4g_pred, 'D') "
           "OR regexp_matches(polyphen2_hvar_pred, 'D')",
           lambda a: ofl.variant_filter(a, RVA_FILTER))


@register("set03_filter_concat", SQL_ANN + """
SELECT v, CAST(count(*) AS BIGINT) AS copies FROM (
  SELECT v FROM ann WHERE regexp_matches(impact, 'HIGH')
  UNION ALL SELECT v FROM ann WHERE cadd >= 20
  UNION ALL SELECT v FROM ann WHERE regexp_matches(sift4g_pred, 'D')
  UNION ALL SELECT v FROM ann WHERE regexp_matches(polyphen2_hvar_pred, 'D')) GROUP BY v""", ANN_NEEDS)
def set03(spark, d):
    cat = ofl.variant_filter(annotated(spark, d), RVA_FILTER, mode="concat")
    return cat.groupBy("v").agg(F.count(F.lit(1)).cast("bigint").alias("copies"))


@register("flt10_drop_null", "SELECT _row, total FROM visits WHERE total IS NOT NULL", ["visits"])
def flt10(spark, d):
    return ofl.drop_null(fx.visits(spark, d), ["total"]).select("_row", "total")


@register("flt11_between", "SELECT _row, total FROM visits WHERE total BETWEEN 10 AND 30", ["visits"])
def flt11(spark, d):
    return ofl.between(fx.visits(spark, d), "total", 10, 30).select("_row", "total")


@register("flt12_starts_with", f"""
SELECT c_custkey, sid FROM (SELECT c_custkey, {SQL_NORMALIZE_IDS.format(x='raw_id')} AS sid FROM raw_ids)
WHERE starts_with(sid, 'ELA')""", ["raw_ids"])
def flt12(spark, d):
    r = fx.raw_ids(spark, d).select("c_custkey", fi.normalize_sample_ids("raw_id").alias("sid"))
    return ofl.starts_with(r, "sid", "ELA")


@register("flt13_not_equal", """
SELECT _row, fv FROM (SELECT _row, nullif(fecha_visita, 'NS/NC') AS fv FROM registry_text)
WHERE fv <> '01-01-1996'""", ["registry_text"])
def flt13(spark, d):
    r = fx.registry_text(spark, d).select("_row", F.nullif("fecha_visita", F.lit("NS/NC")).alias("fv"))
    return ofl.not_equal(r, "fv", "01-01-1996")


@register("flt14_samples_by_pheno", "SELECT sample_id FROM pheno WHERE pheno = 'CONTROL'", ["pheno"])
def flt14(spark, d):
    return ofl.samples_by_pheno(fx.pheno(spark, d), "CONTROL")


@register("flt15_snps_only", """
SELECT v FROM (SELECT v, ref, CASE WHEN v % 10 = 0 THEN alt || 'T' WHEN v % 10 = 5 THEN 'N' ELSE alt END AS alt
               FROM variants)
WHERE regexp_full_match(ref, '[ACGT]') AND regexp_full_match(alt, '[ACGT]')""", ["variants"])
def flt15(spark, d):
    v = fx.variants(spark, d)
    v = v.withColumn("alt", F.when(F.col("v") % 10 == 0, F.concat("alt", F.lit("T")))
                     .when(F.col("v") % 10 == 5, F.lit("N")).otherwise(F.col("alt")))
    return ofl.snps_only(v).select("v")


@register("flt16_autosomes", """
SELECT v FROM variants WHERE chrom IN (""" + ", ".join(f"'{i}'" for i in range(1, 23)) + ")", ["variants"])
def flt16(spark, d):
    return ofl.autosomes(fx.variants(spark, d)).select("v")


SQL_COUNTS = """
, n AS (SELECT count(*) AS n FROM samples)
, cnt AS (SELECT v, count(*) FILTER (WHERE dosage = 1) AS het, count(*) FILTER (WHERE dosage = 2) AS hom_alt,
                 count(*) FILTER (WHERE dosage IS NULL) AS miss FROM genotypes GROUP BY v)
, hw AS (SELECT v, het, hom_alt, miss, n.n - het - hom_alt - miss AS hom_ref FROM cnt, n)
, hw2 AS (SELECT *, hom_ref + het + hom_alt AS nn, het + 2 * least(hom_ref, hom_alt) AS nr FROM hw)
, lw AS (SELECT *, list_transform(range(nr % 2, nr + 1, 2), lambda x:
            x * ln(2) - lgamma(x + 1) - lgamma((nr - x) / 2 + 1) - lgamma((2 * nn - nr - x) / 2 + 1)) AS lws,
          het * ln(2) - lgamma(het + 1) - lgamma((nr - het) / 2 + 1) - lgamma((2 * nn - nr - het) / 2 + 1) AS lobs
         FROM hw2)
, hwe AS (SELECT *, CASE WHEN nn > 0 THEN least(1.0,
            list_sum(list_transform(lws, lambda w: CASE WHEN w <= lobs + 1e-9 THEN exp(w - list_max(lws)) ELSE 0.0 END))
            / list_sum(list_transform(lws, lambda w: exp(w - list_max(lws))))) END AS p_hwe FROM lw)"""
QC_NEEDS = ["samples", "genotypes", "variants"]


@register("flt17_mind", """
, nv AS (SELECT count(*) AS nv FROM variants)
, m AS (SELECT s, count(*) AS miss FROM genotypes WHERE dosage IS NULL GROUP BY s)
SELECT sa.s, round(coalesce(m.miss, 0) / CAST(nv.nv AS DOUBLE), 6) AS f_miss
FROM samples sa CROSS JOIN nv LEFT JOIN m ON m.s = sa.s
WHERE coalesce(m.miss, 0) / CAST(nv.nv AS DOUBLE) <= 0.1""", QC_NEEDS)
def flt17(spark, d):
    g, v, s = fx.genotypes(spark, d), fx.variants(spark, d), fx.samples(spark, d)
    _, kept = osi.mind(g, v, s, 0.1)
    rate = osi.sample_missing_rate(g, v.count(), s)
    return kept.select("s").join(rate, "s").select("s", r6(F.col("f_miss")).alias("f_miss"))


@register("flt18_geno", """
, n AS (SELECT count(*) AS n FROM samples)
, m AS (SELECT v, count(*) AS miss FROM genotypes WHERE dosage IS NULL GROUP BY v)
SELECT vv.v, round(coalesce(m.miss, 0) / CAST(n.n AS DOUBLE), 6) AS f_miss
FROM variants vv CROSS JOIN n LEFT JOIN m ON m.v = vv.v
WHERE coalesce(m.miss, 0) / CAST(n.n AS DOUBLE) <= 0.05""", QC_NEEDS)
def flt18(spark, d):
    g, v = fx.genotypes(spark, d), fx.variants(spark, d)
    n = fx.samples(spark, d).count()
    _, kept = osi.geno(g, v, n, 0.05)
    rate = osi.variant_missing_rate(g, n, v)
    return kept.select("v").join(rate, "v").select("v", r6(F.col("f_miss")).alias("f_miss"))


@register("flt19_hwe", SQL_COUNTS + """
SELECT vv.v FROM variants vv LEFT JOIN hwe h ON h.v = vv.v WHERE h.p_hwe IS NULL OR h.p_hwe >= 1e-8""", QC_NEEDS)
def flt19(spark, d):
    g, v = fx.genotypes(spark, d), fx.variants(spark, d)
    _, kept = osi.hwe_filter(g, v, fx.samples(spark, d).count(), 1e-8)
    return kept.select("v")


SQL_TAGS = """
, n AS (SELECT count(*) AS n FROM samples)
, tg AS (SELECT v, CAST(sum(dosage) AS BIGINT) AS ac, 2 * (n.n - count(*) FILTER (WHERE dosage IS NULL)) AS an
         FROM genotypes, n GROUP BY v, n.n)
, tags AS (SELECT v, ac, an, ac / CAST(an AS DOUBLE) AS af, least(ac / CAST(an AS DOUBLE), 1 - ac / CAST(an AS DOUBLE)) AS maf FROM tg)"""


@register("flt20_maf_mac", SQL_TAGS + """
SELECT v, round(maf, 6) AS maf FROM tags WHERE maf >= 0.05 AND least(ac, an - ac) >= 20""",
          ["samples", "genotypes"])
def flt20(spark, d):
    t = osi.fill_tags(fx.genotypes(spark, d), fx.samples(spark, d))
    return osi.maf_mac(t, 0.05, 20).select("v", r6(F.col("maf")).alias("maf"))


@register("flt21_require_pheno", """
SELECT sample_id FROM pheno WHERE pheno = 'CONTROL'""", ["pheno"])
def flt21(spark, d):
    return ofl.require_pheno(make_psam(fx.pheno(spark, d)), ["ALS", "MS"]).select("sample_id")


@register("flt23_min_group", """
SELECT _row, pid FROM (SELECT _row, pid, count(*) OVER (PARTITION BY pid) AS n FROM visits
                       WHERE total IS NOT NULL AND total BETWEEN 1 AND 48) WHERE n >= 3""", ["visits"])
def flt23(spark, d):
    v = ofl.between(ofl.drop_null(fx.visits(spark, d), ["total"]), "total", 1, 48)
    return ofl.min_group(v, ["pid"], 3).select("_row", "pid")


_PSAM_TRAITS = list(PSAM_CODES) + ["ALS_ONSET"]


@register("flt25_valid_phenotypes", """
, ps AS (""" + __import__("genoframe.plans.q_columns", fromlist=["PSAM_SQL"]).PSAM_SQL.strip() + """)
SELECT pheno, n_values FROM (""" + " UNION ALL ".join(
    f"SELECT '{t}' AS pheno, CAST(count(DISTINCT \"{t}\") AS BIGINT) AS n_values FROM ps" for t in _PSAM_TRAITS) + """)
WHERE n_values >= 2""", ["pheno"])
def flt25(spark, d):
    from genoframe.plans.phenotypes import long_phenotypes
    long = long_phenotypes(make_psam(fx.pheno(spark, d)))
    return (long.groupBy("pheno").agg(F.countDistinct("value").cast("bigint").alias("n_values"))
            .where(F.col("n_values") >= 2))


# ------------------------------------------------------------------ the whole cohort: every customer, every call
GRID_FILTERS = [RVA_FILTER, "impact_HIGH", "cadd_20_or_sift4g_D"]
GRID_UNITS = {"SYMBOL": "symbol", "GENE": "gene"}


def annotated_cohort(spark, d):
    """Variants with allele statistics over all customers and worst-transcript predictions."""
    v = fx.variants(spark, d)
    tags = osi.fill_tags(fx.cohort_calls(spark, d), fx.cohort_samples(spark, d), variants=v)
    c = osi.worst_consequence(oc.split_csq(fx.csq(spark, d), CSQ_FIELDS, {"CADD_phred": "double"}))
    w = F.col("worst")
    return (v.join(tags.select("v", "ac", "an", "maf"), "v", "left")
            .join(c.select("v", w["SIFT_pred"].alias("sift_pred"), w["Polyphen2_HVAR_pred"].alias("polyphen2_hvar_pred"),
                           w["SIFT4G_pred"].alias("sift4g_pred"), w["SYMBOL"].alias("symbol")), "v", "left"))


SQL_ANN_COHORT = (SQL_ANN.replace("SELECT count(*) AS n FROM samples", "SELECT count(DISTINCT o_custkey) AS n FROM orders")
                  .replace("FROM rare_genotypes", "FROM cohort_calls"))
COHORT_NEEDS = ["variants", "cohort_calls", "csq"]

register("flt02b_maf_lt_cohort", SQL_ANN_COHORT + "\nSELECT v, round(maf, 9) AS maf FROM ann WHERE maf < 0.01", COHORT_NEEDS)(
    lambda spark, d: ofl.maf_lt(annotated_cohort(spark, d), 0.01).select("v", F.round("maf", 9).alias("maf")))
register("flt03b_maf_gt_cohort", SQL_ANN_COHORT + "\nSELECT v, round(maf, 9) AS maf FROM ann WHERE maf > 0.01", COHORT_NEEDS)(
    lambda spark, d: ofl.maf_gt(annotated_cohort(spark, d), 0.01).select("v", F.round("maf", 9).alias("maf")))

_TOKEN_SQL = {"impact_HIGH": "impact = 'HIGH'", "cadd_20": "cadd >= 20", "sift4g_D": "sift4g_pred = 'D'",
              "polyphen2_D": "polyphen2_hvar_pred = 'D'"}


@register("set11b_grid_sets", SQL_ANN_COHORT + """
, f AS (""" + " UNION ALL ".join(f"SELECT '{x}' AS filter, v, symbol, gene FROM ann WHERE "
                                  + " OR ".join(_TOKEN_SQL[t] for t in x.split("_or_")) for x in GRID_FILTERS) + """)
SELECT filter, unit, "set", CAST(count(DISTINCT v) AS BIGINT) AS n FROM (
  SELECT filter, 'SYMBOL' AS unit, symbol AS "set", v FROM f UNION ALL SELECT filter, 'GENE', gene, v FROM f)
WHERE "set" IS NOT NULL GROUP BY 1, 2, 3""", COHORT_NEEDS)
def set11b(spark, d):
    """The sets of every filter and unit of the grid from one mask per variant."""
    from genoframe.plans import grid
    return grid.grid_sets(annotated_cohort(spark, d), GRID_FILTERS, GRID_UNITS).groupBy("filter", "unit", "set").agg(F.count(F.lit(1)).alias("n"))
