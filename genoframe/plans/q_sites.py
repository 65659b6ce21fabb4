"""Registered analyses: site statistics (AG-7..10, AG-12, AG-15, AG-16, AG-18) and allele reshaping (SET-7/8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoframe import fixtures as fx
from genoframe.functions import ids as fi
from genoframe.operators import columns as oc
from genoframe.operators import consequence as oq
from genoframe.operators import filters as ofl
from genoframe.operators import reshape as ors
from genoframe.operators import sites as osi
from genoframe.plans.q_columns import CSQ_FIELDS, r6
from genoframe.plans.q_joins import SQL_VID
from genoframe.plans.registry import register


def _hwe_sql(geno: str, n_expr: str) -> str:
    return f"""
, cnt AS (SELECT v, count(*) FILTER (WHERE dosage = 1) AS het, count(*) FILTER (WHERE dosage = 2) AS hom_alt,
                 count(*) FILTER (WHERE dosage IS NULL) AS miss FROM {geno} GROUP BY v)
, hw AS (SELECT v, het, hom_alt, miss, {n_expr} - het - hom_alt - miss AS hom_ref FROM cnt)
, hw2 AS (SELECT *, hom_ref + het + hom_alt AS nn, het + 2 * least(hom_ref, hom_alt) AS nr FROM hw)
, lw AS (SELECT *, list_transform(range(nr % 2, nr + 1, 2), lambda x:
            x * ln(2) - lgamma(x + 1) - lgamma((nr - x) / 2 + 1) - lgamma((2 * nn - nr - x) / 2 + 1)) AS lws,
          het * ln(2) - lgamma(het + 1) - lgamma((nr - het) / 2 + 1) - lgamma((2 * nn - nr - het) / 2 + 1) AS lobs
         FROM hw2)
, hwe AS (SELECT *, CASE WHEN nn > 0 THEN least(1.0,
            list_sum(list_transform(lws, lambda w: CASE WHEN w <= lobs + 1e-9 THEN exp(w - list_max(lws)) ELSE 0.0 END))
            / list_sum(list_transform(lws, lambda w: exp(w - list_max(lws))))) END AS p_hwe FROM lw)"""


@register("ag07_fill_tags", """
, n AS (SELECT count(*) AS n FROM samples)
, c AS (SELECT v, count(*) FILTER (WHERE dosage = 1) AS het, count(*) FILTER (WHERE dosage = 2) AS hom_alt,
               count(*) FILTER (WHERE dosage IS NULL) AS miss FROM genotypes GROUP BY v)
SELECT v, CAST(n.n - het - hom_alt - miss AS BIGINT) AS n_hom_ref, CAST(het AS BIGINT) AS n_het,
       CAST(hom_alt AS BIGINT) AS n_hom_alt, CAST(miss AS BIGINT) AS n_missing,
       CAST(n.n - miss AS BIGINT) AS ns, CAST(2 * (n.n - miss) AS BIGINT) AS an,
       CAST(het + 2 * hom_alt AS BIGINT) AS ac,
       round((het + 2 * hom_alt) / CAST(2 * (n.n - miss) AS DOUBLE), 6) AS af,
       round(least((het + 2 * hom_alt) / CAST(2 * (n.n - miss) AS DOUBLE),
                   1 - (het + 2 * hom_alt) / CAST(2 * (n.n - miss) AS DOUBLE)), 6) AS maf,
       CAST(2 * hom_alt AS BIGINT) AS ac_hom, CAST(het AS BIGINT) AS ac_het
FROM c, n""", ["samples", "genotypes"])
def ag07(spark, d):
    t = osi.fill_tags(fx.genotypes(spark, d), fx.samples(spark, d))
    return t.withColumn("af", r6(F.col("af"))).withColumn("maf", r6(F.col("maf")))


def control_hardy(spark, d):
    """AG-8 on control samples, SNVs on autosomes only."""
    ps = fx.pheno(spark, d)
    ctrl = ps.where(F.col("pheno") == "CONTROL").select("s")
    v = ofl.autosomes(ofl.snps_only(fx.variants(spark, d))).select("v")
    g = fx.genotypes(spark, d).join(F.broadcast(ctrl), "s", "left_semi").join(v, "v", "left_semi")
    return osi.hardy(g, ctrl.count())


SQL_CTRL = """
, ctrl AS (SELECT s FROM pheno WHERE pheno = 'CONTROL')
, nc AS (SELECT count(*) AS n FROM ctrl)
, g2 AS (SELECT g.* FROM genotypes g JOIN variants vv ON g.v = vv.v
         WHERE g.s IN (SELECT s FROM ctrl) AND vv.chrom IN (""" + ", ".join(f"'{i}'" for i in range(1, 23)) + """)
           AND regexp_full_match(vv.ref, '[ACGT]') AND regexp_full_match(vv.alt, '[ACGT]'))"""


@register("ag08_hardy_controls", SQL_CTRL + _hwe_sql("g2", "(SELECT n FROM nc)") + """
SELECT v, CAST(hom_ref AS BIGINT) AS n_hom_ref, CAST(het AS BIGINT) AS n_het, CAST(hom_alt AS BIGINT) AS n_hom_alt,
       CAST(miss AS BIGINT) AS n_missing,
       round(het / nullif(CAST(nn AS DOUBLE), 0), 6) AS o_het,
       round(2 * ((het + 2 * hom_alt) / nullif(2.0 * nn, 0)) * (1 - (het + 2 * hom_alt) / nullif(2.0 * nn, 0)), 6) AS e_het,
       round(p_hwe, 6) AS p_hwe
FROM hwe""", ["pheno", "genotypes", "variants"])
def ag08(spark, d):
    h = control_hardy(spark, d)
    return h.select("v", "n_hom_ref", "n_het", "n_hom_alt", "n_missing", r6(F.col("o_het")).alias("o_het"),
                    r6(F.col("e_het")).alias("e_het"), r6(F.col("p_hwe")).alias("p_hwe"))


@register("ag09_sample_missing_rate", """
, nv AS (SELECT count(*) AS nv FROM variants)
, m AS (SELECT s, count(*) AS miss FROM genotypes WHERE dosage IS NULL GROUP BY s)
SELECT sa.s, round(coalesce(m.miss, 0) / CAST(nv.nv AS DOUBLE), 6) AS f_miss
FROM samples sa CROSS JOIN nv LEFT JOIN m ON m.s = sa.s""", ["samples", "genotypes", "variants"])
def ag09(spark, d):
    r = osi.sample_missing_rate(fx.genotypes(spark, d), fx.variants(spark, d).count(), fx.samples(spark, d))
    return r.select("s", r6(F.col("f_miss")).alias("f_miss"))


@register("ag10_variant_missing_rate", """
, n AS (SELECT count(*) AS n FROM samples)
, m AS (SELECT v, count(*) AS miss FROM genotypes WHERE dosage IS NULL GROUP BY v)
SELECT vv.v, round(coalesce(m.miss, 0) / CAST(n.n AS DOUBLE), 6) AS f_miss
FROM variants vv CROSS JOIN n LEFT JOIN m ON m.v = vv.v""", ["samples", "genotypes", "variants"])
def ag10(spark, d):
    r = osi.variant_missing_rate(fx.genotypes(spark, d), fx.samples(spark, d).count(), fx.variants(spark, d))
    return r.select("v", r6(F.col("f_miss")).alias("f_miss"))


@register("ag12_worst_consequence", """
, tx AS (SELECT v, unnest(string_split(csq, ',')) AS t, generate_subscripts(string_split(csq, ','), 1) AS i FROM csq)
SELECT v, split_part(t, '|', 1) AS symbol, split_part(t, '|', 2) AS impact,
       CAST(split_part(t, '|', 3) AS DOUBLE) AS cadd
FROM (SELECT v, t, row_number() OVER (PARTITION BY v ORDER BY
        coalesce(list_position(['HIGH','MODERATE','LOW','MODIFIER'], split_part(t, '|', 2)), 5), i) AS rn FROM tx)
WHERE rn = 1""", ["csq"])
def ag12(spark, d):
    c = osi.worst_consequence(oc.split_csq(fx.csq(spark, d), CSQ_FIELDS, {"CADD_phred": "double"}))
    w = F.col("worst")
    return c.select("v", w["SYMBOL"].alias("symbol"), w["IMPACT"].alias("impact"), w["CADD_phred"].alias("cadd"))


TERM_FIELDS = ["SYMBOL", "IMPACT", "Consequence"]
_TERMS_SQL = "[" + ", ".join(f"'{t}'" for t in oq.TERM_ORDER) + "]"
#: Transcripts with one or two terms of the published list (and one that it lacks), all of IMPACT MODERATE on every third variant.
SQL_TERM_TX = f"""
, tx AS (SELECT v, j AS i, 'G' || CAST((v + j // 2) % 50 AS VARCHAR) AS symbol,
    CASE WHEN v % 3 = 0 THEN 'MODERATE' ELSE (['HIGH','MODERATE','LOW','MODIFIER'])[(v + j) % 4 + 1] END AS impact,
    (v * 7 + j * 11) % 42 AS t1, CASE WHEN (v + j) % 2 = 0 THEN (v + j * 5) % 41 END AS t2
  FROM variants, range(0, 5) g(j) WHERE j <= v % 5)
, terms AS (SELECT v, i, symbol, impact, unnest([t1, t2]) AS t FROM tx)
, ranked AS (SELECT v, i, symbol, impact, min(t) AS t FROM terms WHERE t IS NOT NULL GROUP BY ALL)"""


def term_transcripts(spark, d):
    v = fx.variants(spark, d)
    names = fx.lit_list([*oq.TERM_ORDER, "unlisted_variant"])

    def tx(j):
        k = F.col("v") + j
        one = F.element_at(names, ((F.col("v") * 7 + j * 11) % 42 + 1).cast("int"))
        two = F.when(k % 2 == 0, F.element_at(names, ((F.col("v") + j * 5) % 41 + 1).cast("int")))
        impact = F.when(F.col("v") % 3 == 0, F.lit("MODERATE")).otherwise(
            F.element_at(fx.lit_list(osi.IMPACT_ORDER), (k % 4 + 1).cast("int")))
        gene = F.concat(F.lit("G"), ((F.col("v") + F.floor(j / 2)) % 50).cast("string"))
        return F.concat_ws("|", gene, impact, F.concat_ws("&", one, two))

    txs = F.transform(F.sequence(F.lit(0), (F.col("v") % 5).cast("int")), lambda j: tx(j))
    return oc.split_csq(v.select("v", F.array_join(txs, ",").alias("csq")), TERM_FIELDS)


@register("ag12b_worst_term", SQL_TERM_TX + f"""
SELECT v, symbol, impact, coalesce(({_TERMS_SQL})[t + 1], 'unlisted_variant') AS term, CAST(t + 1 AS INTEGER) AS severity
FROM (SELECT *, row_number() OVER (PARTITION BY v ORDER BY t, i) AS rn FROM ranked) WHERE rn = 1""", ["variants"])
def ag12b(spark, d):
    """The worst transcript by consequence terms: equal IMPACT is resolved by terms, equal terms by order."""
    w = oq.worst_by_term(term_transcripts(spark, d))
    return w.select("v", w["worst.SYMBOL"].alias("symbol"), w["worst.IMPACT"].alias("impact"), F.col("worst_term").alias("term"),
                    F.col("worst_rank").alias("severity"))


@register("ag12c_worst_term_per_gene", SQL_TERM_TX + f"""
SELECT v, symbol, impact, coalesce(({_TERMS_SQL})[t + 1], 'unlisted_variant') AS term
FROM (SELECT *, row_number() OVER (PARTITION BY v, symbol ORDER BY t, i) AS rn FROM ranked) WHERE rn = 1""", ["variants"])
def ag12c(spark, d):
    w = oq.worst_by_gene(term_transcripts(spark, d))
    return w.select("v", F.col("SYMBOL").alias("symbol"), F.col("worst")["IMPACT"].alias("impact"), F.col("worst_term").alias("term"))


@register("ag15_variant_stats", """
SELECT DISTINCT chrom, pos, ref, alt, unnest(string_split(csq, ',')) AS tx FROM csq""", ["csq"])
def ag15(spark, d):
    c = fx.csq(spark, d)
    x = ors.explode_csq(c.withColumn("transcripts", F.split("csq", ",")), "transcripts", "tx")
    return x.select("chrom", "pos", "ref", "alt", "tx").distinct().orderBy("chrom", "pos", "ref", "alt", "tx")


@register("ag16_set_sizes", f"""
SELECT unit, CAST(count(*) AS BIGINT) AS n, count(*) > 1 AS testable
FROM (SELECT {SQL_VID} AS variant_id, gene AS unit FROM variants WHERE v % 3 <> 0 AND filter = 'PASS')
GROUP BY unit""", ["variants"])
def ag16(spark, d):
    v = fx.variants(spark, d).withColumn("variant_id", fi.variant_id())
    sets = v.where((F.col("v") % 3 != 0) & (F.col("filter") == "PASS")).select("variant_id", F.col("gene").alias("unit"))
    return osi.set_sizes(sets)


SQL_TERNARY = SQL_CTRL + _hwe_sql("g2", "(SELECT n FROM nc)") + """
SELECT v, round(hom_ref / nullif(CAST(nn AS DOUBLE), 0), 6) AS aa, round(het / nullif(CAST(nn AS DOUBLE), 0), 6) AS ab,
       round(hom_alt / nullif(CAST(nn AS DOUBLE), 0), 6) AS bb,
       round(het / nullif(CAST(nn AS DOUBLE), 0) - 2 * (hom_ref / nullif(CAST(nn AS DOUBLE), 0) + het / nullif(2.0 * nn, 0))
             * (1 - (hom_ref / nullif(CAST(nn AS DOUBLE), 0) + het / nullif(2.0 * nn, 0))), 6) AS het_residual
FROM hwe"""


@register("ag18_ternary", SQL_TERNARY, ["pheno", "genotypes", "variants"])
def ag18(spark, d):
    t = osi.ternary(control_hardy(spark, d))
    return t.select("v", *[r6(F.col(c)).alias(c) for c in ("aa", "ab", "bb", "het_residual")])


def _multiallelic(spark, d):
    v = fx.variants(spark, d)
    recs = v.select(F.col("v").alias("rec"), "chrom", "pos", "ref",
                    F.when(F.col("v") % 5 == 0, F.concat("alt", F.lit(",N"))).otherwise(F.col("alt")).alias("alt"))
    g = fx.genotypes(spark, d)
    multi = F.col("v") % 5 == 0
    k = (F.col("v") + F.col("s")) % 3
    gt = (F.when(F.col("dosage").isNull(), F.lit("./."))
          .when(multi, F.when(k == 0, "0/1").when(k == 1, "1/2").otherwise("2/2"))
          .when(F.col("dosage") == 1, "0|1").otherwise("1/1"))
    return recs, g.select(F.col("v").alias("rec"), "s", gt.alias("gt"))


@register("set07_split_multiallelic", """
, recs AS (SELECT v AS rec, CASE WHEN v % 5 = 0 THEN 2 ELSE 1 END AS n_alt FROM variants)
, gts AS (SELECT v AS rec, s, CASE WHEN dosage IS NULL THEN './.'
            WHEN v % 5 = 0 THEN (CASE (v + s) % 3 WHEN 0 THEN '0/1' WHEN 1 THEN '1/2' ELSE '2/2' END)
            WHEN dosage = 1 THEN '0|1' ELSE '1/1' END AS gt FROM genotypes)
, x AS (SELECT g.rec, a.allele, CASE WHEN contains(g.gt, '.') THEN NULL ELSE
          len(list_filter(string_split(replace(g.gt, '|', '/'), '/'), lambda q: q = CAST(a.allele AS VARCHAR))) END AS dosage
        FROM gts g JOIN recs r ON g.rec = r.rec, LATERAL (SELECT unnest(range(1, r.n_alt + 1)) AS allele) a)
SELECT rec, CAST(allele AS INTEGER) AS allele, CAST(count(*) FILTER (WHERE dosage > 0) AS BIGINT) AS n_carriers,
       CAST(sum(dosage) AS BIGINT) AS ac, CAST(count(*) FILTER (WHERE dosage IS NULL) AS BIGINT) AS n_missing
FROM x GROUP BY rec, allele""", ["variants", "genotypes"])
def set07(spark, d):
    recs, g = _multiallelic(spark, d)
    _, split = ors.split_multiallelic(recs, g)
    return split.groupBy("rec", F.col("allele").cast("int").alias("allele")).agg(
        F.count(F.when(F.col("dosage") > 0, 1)).cast("bigint").alias("n_carriers"),
        F.sum("dosage").cast("bigint").alias("ac"),
        F.count(F.when(F.col("dosage").isNull(), 1)).cast("bigint").alias("n_missing"))


@register("set08_explode_csq", """
SELECT v, split_part(t, '|', 1) AS symbol, split_part(t, '|', 2) AS impact
FROM (SELECT v, unnest(string_split(csq, ',')) AS t FROM csq)""", ["csq"])
def set08(spark, d):
    c = oc.split_csq(fx.csq(spark, d), CSQ_FIELDS)
    x = ors.explode_csq(c)
    return x.select("v", F.col("tx")["SYMBOL"].alias("symbol"), F.col("tx")["IMPACT"].alias("impact"))


register("dp7_ternary", SQL_TERNARY, ["pheno", "genotypes", "variants"])(
    lambda spark, d: ag18(spark, d))
