"""Registered analyses: ordered scans (WN-10/12), figure tables (DP-1..5), AG-3/4/13/14/17, SO-1/6/7, SET-10."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoframe import fixtures as fx
from genoframe.functions.recode import chrom_ordinal
from genoframe.operators import ordered as oo
from genoframe.operators import reshape as ors
from genoframe.plans import products as pr
from genoframe.plans.q_columns import r6, zscored_pcs, SQL_PCS
from genoframe.plans.registry import register

CHROM_NUM = ("CAST(CASE chrom WHEN 'X' THEN 23 WHEN 'Y' THEN 24 WHEN 'MT' THEN 25 "
             "ELSE CAST(chrom AS INTEGER) END AS INTEGER)")


def res(spark, d):
    """Association results with an explicit input-order column."""
    return fx.results(spark, d).withColumn("_row", F.col("v"))


# Results with a strongly skewed p distribution (many ties and one hot value) to exercise the scan.
def res_skewed(spark, d):
    r = res(spark, d)
    return r.withColumn("p", F.when(F.col("v") % 3 == 0, F.lit(0.5))
                        .when(F.col("v") % 7 == 0, F.col("p") / 1000.0).otherwise(F.round(F.col("p"), 3)))


SQL_SKEW = """
, rs AS (SELECT v, CASE WHEN v % 3 = 0 THEN 0.5 WHEN v % 7 = 0 THEN p / 1000.0 ELSE round(p, 3) END AS p FROM results)"""


@register("wn12_bh_adjust", SQL_SKEW + """
, nn AS (SELECT v, p, count(p) OVER () AS n, count(p) OVER (ORDER BY p) AS cum FROM rs WHERE p IS NOT NULL)
, q AS (SELECT v, least(1.0, min(n * p / cum) OVER (ORDER BY p DESC)) AS q_fdr FROM nn)
SELECT rs.v, rs.p, round(q.q_fdr, 6) AS q_fdr FROM rs LEFT JOIN q ON rs.v = q.v""", ["results"])
def wn12(spark, d):
    r = oo.bh_adjust(res_skewed(spark, d).select("v", "p"), "p", "q_fdr")
    return r.select("v", "p", r6(F.col("q_fdr")).alias("q_fdr"))


@register("wn10_avg_rank", SQL_SKEW + """
SELECT v, p, CASE WHEN p IS NOT NULL THEN rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 END AS rank
FROM rs""", ["results"])
def wn10(spark, d):
    return oo.avg_rank(res_skewed(spark, d).select("v", "p"), "p", "rank")


SQL_HEAD_NAME = """
, r AS (SELECT v AS _row, coalesce(id, gene) AS name, p AS p_value FROM results)
, h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY _row) AS rn FROM r)
        WHERE rn = 1 AND p_value IS NOT NULL)
, k AS (SELECT *, count(*) OVER () AS n,
          rank() OVER (ORDER BY p_value) + (count(*) OVER (PARTITION BY p_value) - 1) / 2.0 AS rk,
          count(*) OVER (ORDER BY p_value) AS cum FROM h)
, qq AS (SELECT *, least(1.0, min(n * p_value / cum) OVER (ORDER BY p_value DESC)) AS q_fdr FROM k)"""


@register("dp1_qq", SQL_HEAD_NAME + """
SELECT name, round(-log10(p_value), 6) AS observed, round(-log10(rk / (n + 1)), 6) AS expected,
       round(q_fdr, 6) AS q_fdr FROM qq""", ["results"])
def dp1(spark, d):
    q = pr.qq(res(spark, d))
    return q.select("name", *[r6(F.col(c)).alias(c) for c in ("observed", "expected", "q_fdr")])


SQL_MANHATTAN = """
, h AS (SELECT * FROM (SELECT v AS _row, chrom, pos, alt, p,
          row_number() OVER (PARTITION BY chrom, pos, alt ORDER BY v) AS rn FROM results) WHERE rn = 1)
, c AS (SELECT *, """ + CHROM_NUM + """ AS chrom_num FROM h)
, acc AS (SELECT chrom_num, max(pos) AS max_pos FROM c GROUP BY 1)
, acc2 AS (SELECT chrom_num, coalesce(sum(max_pos) OVER (ORDER BY chrom_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS pos_add FROM acc)
, dd AS (SELECT c.*, c.pos + a.pos_add AS pos_acc FROM c JOIN acc2 a USING (chrom_num))
, nn AS (SELECT _row, p, count(p) OVER () AS n, count(p) OVER (ORDER BY p) AS cum FROM dd WHERE p IS NOT NULL)
, qv AS (SELECT _row, least(1.0, min(n * p / cum) OVER (ORDER BY p DESC)) AS q_fdr FROM nn)
, man AS (SELECT dd.*, qv.q_fdr FROM dd LEFT JOIN qv USING (_row))"""


def _manhattan(spark, d):
    return pr.manhattan(res(spark, d))


@register("dp2_manhattan", SQL_MANHATTAN + """
SELECT chrom, pos, alt, CAST(pos_acc AS BIGINT) AS pos_acc, round(q_fdr, 6) AS q_fdr FROM man""", ["results"])
def dp2(spark, d):
    m = _manhattan(spark, d)
    return m.select("chrom", "pos", "alt", F.col("pos_acc").cast("bigint"), r6(F.col("q_fdr")).alias("q_fdr"))


@register("ag03_max_pos_per_chrom", SQL_MANHATTAN + """
SELECT chrom_num, max_pos FROM acc""", ["results"])
def ag03(spark, d):
    r = res(spark, d).withColumn("chrom_num", chrom_ordinal("chrom").cast("int"))
    return r.groupBy("chrom_num").agg(F.max("pos").alias("max_pos"))


@register("wn08_cumulative_offset", SQL_MANHATTAN + """
SELECT chrom_num, CAST(pos_add AS BIGINT) AS pos_add FROM acc2""", ["results"])
def wn08(spark, d):
    from genoframe.operators.windows import running_sum
    r = res(spark, d).withColumn("chrom_num", chrom_ordinal("chrom").cast("int"))
    acc = r.groupBy("chrom_num").agg(F.max("pos").alias("max_pos"))
    out = running_sum(acc, "max_pos", ["chrom_num"], "pos_add", exclusive=True, default=0)
    return out.select("chrom_num", F.col("pos_add").cast("bigint"))


@register("ag04_axis_centres", SQL_MANHATTAN + """
SELECT chrom, round(avg(pos_acc), 6) AS center FROM man GROUP BY chrom""", ["results"])
def ag04(spark, d):
    a = pr.manhattan_axis(_manhattan(spark, d))
    return a.select("chrom", r6(F.col("center")).alias("center"))


@register("ag17_significance_line", SQL_MANHATTAN + """
SELECT max(p) FILTER (WHERE q_fdr <= 0.05) AS max_sig_p, CAST(count(*) FILTER (WHERE q_fdr <= 0.05) AS BIGINT) AS n_sig
FROM man""", ["results"])
def ag17(spark, d):
    m = _manhattan(spark, d)
    return m.agg(F.max(F.when(F.col("q_fdr") <= 0.05, F.col("p_value"))).alias("max_sig_p"),
                 F.count(F.when(F.col("q_fdr") <= 0.05, 1)).cast("bigint").alias("n_sig"))


@register("flt24_significant", SQL_SKEW + """
, nn AS (SELECT v, p, count(p) OVER () AS n, count(p) OVER (ORDER BY p) AS cum FROM rs WHERE p IS NOT NULL)
, q AS (SELECT v, least(1.0, min(n * p / cum) OVER (ORDER BY p DESC)) AS q_fdr FROM nn)
SELECT v FROM q WHERE q_fdr <= 0.05""", ["results"])
def flt24(spark, d):
    from genoframe.operators.filters import significant
    return significant(oo.bh_adjust(res_skewed(spark, d).select("v", "p"), "p", "q_fdr")).select("v")


@register("ag13_quantile_099", """
SELECT round(quantile_cont(log10(p), 0.99), 6) AS q99 FROM results WHERE p IS NOT NULL""", ["results"])
def ag13(spark, d):
    r = res(spark, d).where(F.col("p").isNotNull()).select(F.log10("p").alias("lp"))
    q = oo.quantile_exact(r, "lp", 0.99)
    return spark.range(1).select(F.round(F.lit(q).cast("double"), 6).alias("q99"))


@register("dp3_volcano", """
, q99 AS (SELECT quantile_cont(log10(p), 0.99) AS q FROM results WHERE p IS NOT NULL)
, r AS (SELECT v AS _row, chrom, pos, alt, beta AS effect, p AS p_value,
               least(log10(p), 1.2 * (SELECT q FROM q99)) AS log_p FROM results)
, h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chrom, pos, alt ORDER BY _row) AS rn FROM r)
        WHERE rn = 1 AND p_value IS NOT NULL AND effect IS NOT NULL)
, nn AS (SELECT *, count(*) OVER () AS n, count(*) OVER (ORDER BY p_value) AS cum FROM h)
, q AS (SELECT *, least(1.0, min(n * p_value / cum) OVER (ORDER BY p_value DESC)) AS q_fdr FROM nn)
SELECT chrom, pos, alt, round(effect, 6) AS effect, round(log_p, 6) AS log_p, round(q_fdr, 6) AS q_fdr FROM q""",
          ["results"])
def dp3(spark, d):
    v = pr.volcano(res(spark, d))
    return v.select("chrom", "pos", "alt", *[r6(F.col(c)).alias(c) for c in ("effect", "log_p", "q_fdr")])


@register("dp4_top_hits", SQL_HEAD_NAME + """
, top AS (SELECT * FROM qq ORDER BY p_value, _row LIMIT 20)
SELECT name, round(p_value, 6) AS p_value, round(-log10(p_value), 6) AS log_p, round(q_fdr, 6) AS q_fdr,
       CAST(row_number() OVER (ORDER BY -log10(p_value), name) AS INTEGER) AS ordinal FROM top""", ["results"])
def dp4(spark, d):
    t = pr.top_hits(res(spark, d), 20)
    return t.select("name", r6(F.col("p_value")).alias("p_value"), r6(F.col("log_p")).alias("log_p"),
                    r6(F.col("q_fdr")).alias("q_fdr"), F.col("ordinal").cast("int"))


def chrom_eigen(spark, d):
    """A per-component 'eigenvalue' list derived from the cohort: allele count per contig."""
    g = fx.genotypes(spark, d).join(fx.variants(spark, d).select("v", "chrom"), "v")
    g = g.withColumn("pc", chrom_ordinal("chrom").cast("int"))
    return g.groupBy("pc").agg((F.sum("dosage") / 100.0).alias("eigenval"))


SQL_EIGEN = """
, eig AS (SELECT """ + CHROM_NUM + """ AS pc, sum(g.dosage) / 100.0 AS eigenval
          FROM genotypes g JOIN variants vv ON g.v = vv.v GROUP BY 1)"""


@register("dp5_scree_shares", SQL_EIGEN + """
, sh AS (SELECT pc, eigenval, eigenval / sum(eigenval) OVER () AS explained_var FROM eig)
SELECT pc, round(explained_var, 6) AS explained_var,
       round(sum(explained_var) OVER (ORDER BY pc ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cum_var,
       sum(explained_var) OVER (ORDER BY pc ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) < 0.9 AS highlight
FROM sh""", ["genotypes", "variants"])
def dp5(spark, d):
    s = pr.scree(chrom_eigen(spark, d))
    return s.select("pc", r6(F.col("explained_var")).alias("explained_var"), r6(F.col("cum_var")).alias("cum_var"),
                    "highlight")


@register("ag14_share_of_total", SQL_EIGEN + """
SELECT pc, round(eigenval / sum(eigenval) OVER (), 6) AS share FROM eig""", ["genotypes", "variants"])
def ag14(spark, d):
    s = pr.scree(chrom_eigen(spark, d))
    return s.select("pc", r6(F.col("explained_var")).alias("share"))


@register("wn09_row_number", SQL_EIGEN + """
SELECT pc, CAST(row_number() OVER (ORDER BY eigenval DESC, pc) AS INTEGER) AS row FROM eig""", ["genotypes", "variants"])
def wn09(spark, d):
    from genoframe.operators.windows import with_row
    return with_row(chrom_eigen(spark, d), [F.col("eigenval").desc(), F.col("pc")], "row").select("pc", "row")


@register("wn11_running_threshold", SQL_EIGEN + """
SELECT pc, sum(eigenval) OVER (ORDER BY pc ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           < 0.5 * sum(eigenval) OVER () AS below_half FROM eig""", ["genotypes", "variants"])
def wn11(spark, d):
    from genoframe.operators.windows import running_sum
    from pyspark.sql import Window
    e = running_sum(chrom_eigen(spark, d), "eigenval", ["pc"], "run")      # one row per contig
    e = e.withColumn("tot", F.sum("eigenval").over(Window.partitionBy()))
    return e.select("pc", (F.col("run") < 0.5 * F.col("tot")).alias("below_half"))


@register("set10_pca_pairs", SQL_PCS + """
SELECT p.sample_id, p.pheno, CAST(g AS INTEGER) AS grp, round(ax0, 6) AS ax0, round(ax1, 6) AS ax1,
       'PC' || CAST(2 * g + 1 AS VARCHAR) || ' / PC' || CAST(2 * g + 2 AS VARCHAR) AS group_label
FROM pheno p JOIN pcs c ON p.sample_id = c.sample_id,
LATERAL (SELECT unnest([0, 1, 2]) AS g, unnest([c."PC1", c."PC3", c."PC5"]) AS ax0,
                unnest([c."PC2", c."PC4", c."PC6"]) AS ax1)""", ["pheno"])
def set10(spark, d):
    pp = ors.pca_pairs(zscored_pcs(spark, d), fx.pheno(spark, d).select("sample_id", "pheno"), n_pc=6)
    return pp.select("sample_id", "pheno", F.col("grp").cast("int"), r6(F.col("ax0")).alias("ax0"),
                     r6(F.col("ax1")).alias("ax1"), "group_label")


@register("so01_sort_variants", """
SELECT v, """ + CHROM_NUM + """ AS chrom_num, pos FROM variants""", ["variants"])
def so01(spark, d):
    from genoframe.operators.sorts import sort_variants
    return sort_variants(fx.variants(spark, d)).select("v", "chrom_num", "pos")


@register("so06_top_k", """
SELECT v, p FROM (SELECT v, p FROM results WHERE p IS NOT NULL ORDER BY p, v LIMIT 20)""", ["results"])
def so06(spark, d):
    """Top 20 smallest p, ties broken by input order (TakeOrderedAndProject, no global sort)."""
    return res(spark, d).where(F.col("p").isNotNull()).orderBy("p", "_row").limit(20).select("v", "p")


@register("so07_ordinal_by_measure", """
SELECT gene, CAST(row_number() OVER (ORDER BY avg_beta, gene) AS INTEGER) AS ordinal
FROM (SELECT gene, round(avg(beta), 6) AS avg_beta FROM results GROUP BY gene)""", ["results"])
def so07(spark, d):
    """A label's ordinal by a measure (factor reordering), on the per-gene table (bounded rows)."""
    from genoframe.operators.windows import with_row
    g = res(spark, d).groupBy("gene").agg(F.round(F.avg("beta"), 6).alias("avg_beta"))
    return with_row(g, ["avg_beta", "gene"], "ordinal").select("gene", F.col("ordinal").cast("int"))
