"""Registered analyses: the flagship slice, projections (PRJ) and scalar functions (FN)."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoframe import fixtures as fx
from genoframe.functions import annotation as fa
from genoframe.functions import clinical as fc
from genoframe.functions import dates as fd
from genoframe.functions import ids as fi
from genoframe.functions import recode as fr
from genoframe.functions import stats as fs
from genoframe.operators import columns as oc
from genoframe.operators.filters import variant_filter
from genoframe.operators.sites import fill_tags
from genoframe.plans.registry import register

R6 = 6


def r6(c):
    return F.round(c, R6)


# --------------------------------------------------------------------------- flagship
def gene_carriers(spark, d, expr: str = "impact_HIGH_or_cadd_20"):
    """Minimum slice: site tags -> named OR filter -> carriers per gene and case status."""
    v = fx.variants(spark, d)
    g = fx.genotypes(spark, d)
    tags = fill_tags(g, fx.samples(spark, d))
    sel = variant_filter(v.join(tags, "v"), expr)
    carriers = (g.where(F.col("dosage") > 0).join(sel.select("v", "gene", "af"), "v")
                .join(fx.pheno(spark, d).select("s", "status"), "s", "left"))
    return (carriers.groupBy("gene", "status").agg(
        F.countDistinct("s").cast("bigint").alias("n_carriers"),
        F.count(F.lit(1)).cast("bigint").alias("n_calls"),
        F.sum("dosage").cast("bigint").alias("allele_count"),
        r6(F.max("af")).alias("max_af"))
        .orderBy("gene", "status"))


register("flagship_gene_carriers", """
, tags AS (SELECT v, sum(dosage) AS ac, count(*) FILTER (WHERE dosage IS NULL) AS n_missing
           FROM genotypes GROUP BY v)
, n AS (SELECT count(*) AS n FROM samples)
SELECT vv.gene, p.status, CAST(count(DISTINCT g.s) AS BIGINT) AS n_carriers,
       CAST(count(*) AS BIGINT) AS n_calls, CAST(sum(g.dosage) AS BIGINT) AS allele_count,
       round(max(t.ac / (2.0 * (n.n - t.n_missing))), 6) AS max_af
FROM genotypes g JOIN variants vv ON g.v = vv.v JOIN tags t ON t.v = g.v CROSS JOIN n
LEFT JOIN pheno p ON p.s = g.s
WHERE g.dosage > 0 AND (regexp_matches(vv.impact, 'HIGH') OR vv.cadd >= 20)
GROUP BY 1, 2""", ["genotypes", "variants", "samples", "pheno"])(gene_carriers)


# --------------------------------------------------------------------------- PRJ
@register("prj01_normalize_names", """
SELECT c_custkey AS c_custkey, c_name AS nombre_cliente, c_nationkey AS nacion,
       c_acctbal AS saldo_pct, c_mktsegment AS segmento_mkt
FROM customer""")
def prj01(spark, d):
    c = fx.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    messy = c.toDF("C_CustKey", "Nombre  Cliente", "Nación #", "Saldo %", "_Segmento (Mkt)")
    return oc.normalize_names(messy)


@register("prj01b_registry_names", """
SELECT o_orderkey AS _1st_key, o_custkey AS patient_id, o_totalprice AS total_price_eur
FROM orders""")
def prj01b(spark, d):
    o = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return oc.normalize_names(o.toDF("1st Key", "Patient ID", "Total price (EUR)"), oc.registry_name)


@register("prj02_rename_select", """
SELECT pid, day AS fecha_visita, total AS alsfrs_total, i1 AS lenguaje FROM visits""", ["visits"])
def prj02(spark, d):
    v = fx.visits(spark, d).withColumnRenamed("day", "fecha_visita").withColumnRenamed("total", "alsfrs_total")
    return v.select("pid", "fecha_visita", "alsfrs_total", F.col("i1").alias("lenguaje")).drop("_row")


@register("prj04_across_parse", """
SELECT _row, pid,
  coalesce(
    CASE WHEN regexp_full_match(regexp_replace(trim(nullif(fecha_visita, 'NS/NC')), '[^0-9]+', '-', 'g'),
                                '[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}')
         THEN CAST(try_strptime(regexp_replace(trim(nullif(fecha_visita, 'NS/NC')), '[^0-9]+', '-', 'g'), '%d-%m-%Y') AS DATE) END,
    CAST(DATE '1899-12-30' + CAST(floor(try_cast(nullif(fecha_visita, 'NS/NC') AS DOUBLE)) AS INTEGER) AS DATE)
  ) AS fecha_visita,
  try_cast(nullif(peso, 'NS/NC') AS DOUBLE) AS peso,
  prioridad
FROM registry_text""", ["registry_text"])
def prj04(spark, d):
    r = oc.na_if_all(fx.registry_text(spark, d), "NS/NC")
    r = oc.across(r, "starts:fecha_", fd.parse_dmy_or_serial)
    return oc.across(r, ["peso"], fr.safe_double)


@register("prj05_na_if", """
SELECT _row, nullif(fecha_visita, 'NS/NC') AS fecha_visita, nullif(peso, 'NS/NC') AS peso
FROM registry_text""", ["registry_text"])
def prj05(spark, d):
    r = fx.registry_text(spark, d)
    return r.select("_row", fr.na_if("fecha_visita", "NS/NC").alias("fecha_visita"),
                    fr.na_if("peso", "NS/NC").alias("peso"))


@register("prj06_drop_format", """
SELECT v, s, 'DP,GT' AS format_keys, CAST(10 + (v + s) % 30 AS INTEGER) AS dp FROM genotypes""", ["genotypes"])
def prj06(spark, d):
    g = fx.genotypes(spark, d)
    gt = F.when(F.col("dosage").isNull(), "./.").when(F.col("dosage") == 1, "0/1").otherwise("1/1")
    g = g.withColumn("format", F.create_map(
        F.lit("GT"), gt, F.lit("DP"), (10 + (F.col("v") + F.col("s")) % 30).cast("string"),
        F.lit("PL"), F.lit("0,10,100")))
    g = oc.drop_format(g, "PL")
    return g.select("v", "s", F.array_join(F.array_sort(F.map_keys("format")), ",").alias("format_keys"),
                    F.col("format")["DP"].cast("int").alias("dp"))


@register("prj07_recode", """
SELECT o_orderkey,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'mid' ELSE 'low' END AS prio,
  CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' END AS status_txt
FROM orders""")
def prj07(spark, d):
    o = fx.table(spark, d, "orders")
    return o.select("o_orderkey",
                    fr.recode("o_orderpriority", {("1-URGENT", "2-HIGH"): "high", "3-MEDIUM": "mid"},
                              default="low").alias("prio"),
                    fr.recode("o_orderstatus", {"F": "final", "O": "open"}).alias("status_txt"))


@register("prj08_case_when", """
SELECT _row, CASE WHEN total < 20 THEN 'severe' WHEN total < 35 THEN 'moderate'
                  WHEN total >= 35 THEN 'mild' END AS severity
FROM visits""", ["visits"])
def prj08(spark, d):
    v = fx.visits(spark, d)
    t = F.col("total")
    return v.select("_row", fr.case_when([(t < 20, "severe"), (t < 35, "moderate"), (t >= 35, "mild")])
                    .alias("severity"))


PRIORITY_LEVELS = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]


@register("prj09_as_ordered", """
SELECT o_orderkey, CAST(list_position(['5-LOW','4-NOT SPECIFIED','3-MEDIUM','2-HIGH','1-URGENT'],
                                      o_orderpriority) AS INTEGER) AS prio_level
FROM orders
WHERE list_position(['5-LOW','4-NOT SPECIFIED','3-MEDIUM','2-HIGH','1-URGENT'], o_orderpriority) >= 4""")
def prj09(spark, d):
    o = fx.table(spark, d, "orders").select("o_orderkey", fr.as_ordered("o_orderpriority", PRIORITY_LEVELS)
                                            .alias("prio_level"))
    return o.where(F.col("prio_level") >= 4)


@register("prj10_coalesce", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END,
                            CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey AS DOUBLE) END) AS fvc
FROM orders""")
def prj10(spark, d):
    o = fx.table(spark, d, "orders")
    a = F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col("o_totalprice"))
    b = F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).otherwise(F.col("o_orderkey").cast("double"))
    return o.select("o_orderkey", F.coalesce(a, b).alias("fvc"))


@register("prj11_coalesce_any_of", """
SELECT v, coalesce(id, gene) AS name, p AS p_value FROM results""", ["results"])
def prj11(spark, d):
    r = fx.results(spark, d)
    return r.select("v", oc.coalesce_any_of(r, ["id", "gene", "unit"]).alias("name"),
                    oc.coalesce_any_of(r, ["permpvalue", "pvalue", "p"]).alias("p_value"))


@register("prj12_effect_column", """
SELECT v, round(beta, 6) AS effect_beta, round(log2(exp(beta)), 6) AS effect_or FROM results""", ["results"])
def prj12(spark, d):
    r = fx.results(spark, d)
    with_or = r.withColumn("or", F.exp("beta")).drop("beta")
    return r.select("v", r6(oc.effect_column(r)).alias("effect_beta")).join(
        with_or.select("v", r6(oc.effect_column(with_or)).alias("effect_or")), "v")


@register("prj13_variant_id", """
SELECT v, chrom || ':' || CAST(pos AS VARCHAR) || '_' || ref || '_' || alt AS variant_id FROM variants""",
          ["variants"])
def prj13(spark, d):
    return fx.variants(spark, d).select("v", fi.variant_id().alias("variant_id"))


@register("prj14_query_fields", """
SELECT chrom || ':' || CAST(pos AS VARCHAR) || '_' || ref || '_' || alt AS variant_id, gene FROM variants""",
          ["variants"])
def prj14(spark, d):
    v = fx.variants(spark, d).withColumn("variant_id", fi.variant_id())
    return oc.query_fields(v, ["gene"])


SQL_NORMALIZE_IDS = """regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  regexp_replace(regexp_replace(regexp_replace({x}, '^EMADN', 'EM'), '-ambBED$', ''), '-', '', 'g'),
  'EM044', 'EM015-2'), 'ELA1912ADN1', 'ELA1912-2'), 'ELA1923ADN1', 'ELA1923-2'),
  'ELA1924ADN1', 'ELA1924-2'), 'ADN[12]$', '')"""


@register("prj15_normalize_sample_ids", f"""
SELECT c_custkey, raw_id, {SQL_NORMALIZE_IDS.format(x='raw_id')} AS sample_id FROM raw_ids""", ["raw_ids"])
def prj15(spark, d):
    r = fx.raw_ids(spark, d)
    return r.select("c_custkey", "raw_id", fi.normalize_sample_ids("raw_id").alias("sample_id"))


@register("prj16_rename_samples", f"""
, m AS (SELECT printf('S%03d', c_custkey) AS old_id, {SQL_NORMALIZE_IDS.format(x='raw_id')} AS new_id
        FROM raw_ids)
SELECT g.v, coalesce(m.new_id, printf('S%03d', g.s)) AS sample_id, g.dosage
FROM genotypes g LEFT JOIN m ON printf('S%03d', g.s) = m.old_id""", ["raw_ids", "genotypes"])
def prj16(spark, d):
    r = fx.raw_ids(spark, d)
    mapping = r.select(F.format_string("S%03d", "c_custkey").alias("raw_id"),
                       fi.normalize_sample_ids("raw_id").alias("sample_id"))
    g = fx.genotypes(spark, d).select("v", F.format_string("S%03d", "s").alias("sample_id"), "dosage")
    return oc.rename_samples(g, mapping, old="raw_id", new="sample_id", col="sample_id")


@register("prj17_sample_order", """
SELECT sample_id, CAST(row_number() OVER (ORDER BY sample_id) AS INTEGER) AS sample_index FROM samples""",
          ["samples"])
def prj17(spark, d):
    from genoframe.operators.windows import with_row
    return with_row(fx.samples(spark, d).select("sample_id"), ["sample_id"], "sample_index")


@register("prj18_rename_contigs", """
SELECT v, chrom FROM variants""", ["variants"])
def prj18(spark, d):
    v = fx.variants(spark, d)
    ucsc = v.select("v", F.concat(F.lit("chr"), F.when(F.col("chrom") == "MT", "M")
                                   .otherwise(F.col("chrom"))).alias("chrom"))
    contigs = [str(i) for i in range(1, 23)] + ["X", "Y", "M"]
    return oc.rename_contigs(ucsc, oc.ucsc_to_ensembl(contigs))


PSAM_SQL = """
SELECT sample_id,
  CASE sex WHEN 'M' THEN 1 WHEN 'F' THEN 2 END AS "SEX",
  CASE pheno WHEN 'CONTROL' THEN 1 WHEN 'ALS' THEN 2 END AS "ALS",
  CASE pheno WHEN 'CONTROL' THEN 1 WHEN 'MS' THEN 2 END AS "MS",
  CASE pheno WHEN 'CONTROL' THEN 1 WHEN 'ALS' THEN 2 WHEN 'MS' THEN 2 END AS "ALS_MS",
  CASE als_pheno WHEN 'ALS-S' THEN 2 WHEN 'ALS-B' THEN 2 WHEN 'ALS-R' THEN 2 WHEN 'PLS' THEN 2 WHEN 'PMA' THEN 1 END AS "ALS_UMN",
  CASE als_pheno WHEN 'ALS-S' THEN 2 WHEN 'ALS-B' THEN 2 WHEN 'ALS-R' THEN 2 WHEN 'PLS' THEN 1 WHEN 'PMA' THEN 2 END AS "ALS_LMN",
  CASE als_pheno WHEN 'ALS-S' THEN 1 WHEN 'ALS-B' THEN 1 WHEN 'ALS-R' THEN 1 WHEN 'PBP' THEN 2 WHEN 'FAS' THEN 2 WHEN 'FLS' THEN 2 END AS "ALS_RESTRICTED",
  CASE dfs_pc WHEN 'SP' THEN 2 WHEN 'NP' THEN 1 WHEN 'FP' THEN 1 END AS "ALS_DFS_SP",
  CASE dfs_pc WHEN 'SP' THEN 1 WHEN 'NP' THEN 1 WHEN 'FP' THEN 2 END AS "ALS_DFS_FP",
  CASE d50_pc WHEN 'SP' THEN 2 WHEN 'NP' THEN 1 WHEN 'FP' THEN 1 END AS "ALS_D50_SP",
  CASE d50_pc WHEN 'SP' THEN 1 WHEN 'NP' THEN 1 WHEN 'FP' THEN 2 END AS "ALS_D50_FP",
  CASE ms_pheno WHEN 'RR' THEN 1 WHEN 'SP' THEN 2 WHEN 'PP' THEN 1 END AS "MS_SP",
  CASE ms_pheno WHEN 'RR' THEN 1 WHEN 'SP' THEN 1 WHEN 'PP' THEN 2 END AS "MS_PP",
  round(quant, 6) AS "ALS_ONSET"
FROM pheno"""


def psam(spark, d):
    from genoframe.plans.phenotypes import make_psam
    return make_psam(fx.pheno(spark, d))


register("prj19_make_psam", PSAM_SQL, ["pheno"])(psam)


@register("prj20_binary01", """
, ps AS (""" + PSAM_SQL.strip() + """)
SELECT sample_id, CASE "ALS" WHEN 1 THEN 0 WHEN 2 THEN 1 END AS "ALS",
       CASE "MS_SP" WHEN 1 THEN 0 WHEN 2 THEN 1 END AS "MS_SP", "ALS_ONSET"
FROM ps""", ["pheno"])
def prj20(spark, d):
    p = psam(spark, d)
    return p.select("sample_id", fr.binary01("ALS").alias("ALS"), fr.binary01("MS_SP").alias("MS_SP"),
                    "ALS_ONSET")


@register("prj21_dosage", """
SELECT v, s, CASE WHEN dosage IS NULL THEN NULL ELSE dosage END AS dosage FROM genotypes""", ["genotypes"])
def prj21(spark, d):
    g = fx.genotypes(spark, d)
    phased = (F.col("v") + F.col("s")) % 7 == 0
    gt = (F.when(F.col("dosage").isNull(), F.when(phased, "0/.").otherwise("./."))
          .when(F.col("dosage") == 1, F.when(phased, "1|0").otherwise("0/1"))
          .otherwise(F.when(phased, "1|1").otherwise("1/1")))
    return g.select("v", "s", fr.dosage(gt).alias("dosage"))


@register("prj22_sex_code", """
SELECT sample_id, CASE sex WHEN 'M' THEN 1 WHEN 'F' THEN 2 ELSE 0 END AS sex_cov,
       CASE sex WHEN 'M' THEN 1 WHEN 'F' THEN 2 END AS sex_psam
FROM pheno""", ["pheno"])
def prj22(spark, d):
    p = fx.pheno(spark, d)
    return p.select("sample_id", fr.sex_code("sex", 0).alias("sex_cov"), fr.sex_code("sex").alias("sex_psam"))


CSQ_FIELDS = ["SYMBOL", "IMPACT", "CADD_phred", "Polyphen2_HVAR_pred", "SIFT_pred", "SIFT4G_pred"]


@register("prj23_split_csq", """
SELECT v, CAST(len(string_split(csq, ',')) AS INTEGER) AS n_tx,
       split_part(split_part(csq, ',', 1), '|', 1) AS symbol1,
       split_part(split_part(csq, ',', 1), '|', 2) AS impact1,
       CAST(split_part(split_part(csq, ',', 1), '|', 3) AS DOUBLE) AS cadd1,
       split_part(split_part(csq, ',', len(string_split(csq, ','))), '|', 6) AS sift4g_last
FROM csq""", ["csq"])
def prj23(spark, d):
    c = oc.split_csq(fx.csq(spark, d), CSQ_FIELDS, {"CADD_phred": "double"})
    t = F.col("transcripts")
    return c.select("v", F.size(t).cast("int").alias("n_tx"), t[0]["SYMBOL"].alias("symbol1"),
                    t[0]["IMPACT"].alias("impact1"), t[0]["CADD_phred"].alias("cadd1"),
                    F.element_at(t, -1)["SIFT4G_pred"].alias("sift4g_last"))


def zscored_pcs(spark, d):
    from genoframe.plans.assoc import standardize
    p = fx.pheno(spark, d)
    z = standardize(p, ["c1", "c2", "c3", "c4", "c5", "c6"])
    return z.select("sample_id", *[F.col(f"c{i}").alias(f"PC{i}") for i in range(1, 7)])


SQL_PCS = """
, pcs AS (SELECT sample_id, """ + ", ".join(
    f"(c{i} - avg(c{i}) OVER ()) / stddev_samp(c{i}) OVER () AS \"PC{i}\"" for i in range(1, 7)) + """
          FROM pheno)"""


@register("prj24_covariates", SQL_PCS + """
SELECT p.sample_id AS "IID", CASE p.sex WHEN 'M' THEN 1 WHEN 'F' THEN 2 ELSE 0 END AS "SEX",
       """ + ", ".join(f'round(c."PC{i}", 6) AS "PC{i}"' for i in range(1, 7)) + """
FROM pheno p JOIN pcs c ON p.sample_id = c.sample_id""", ["pheno"])
def prj24(spark, d):
    from genoframe.plans.phenotypes import covariates
    return covariates(fx.pheno(spark, d), zscored_pcs(spark, d), n_pc=6).select(
        "IID", "SEX", *[r6(F.col(f"PC{i}")).alias(f"PC{i}") for i in range(1, 7)])


# --------------------------------------------------------------------------- FN
def _biobank_raw(spark, d):
    c = fx.table(spark, d, "customer")
    k = F.col("c_custkey")
    return c.select(k.alias("c_custkey"), F.concat(
        F.lit("ELA-"), k.cast("string"), F.lit(" "), F.col("c_nationkey").cast("string"),
        F.when(k % 3 == 0, F.concat(F.lit(" (dup "), (k % 7).cast("string"), F.lit(")"))).otherwise(F.lit(""))
    ).alias("code"))


SQL_BIOBANK = """
, bb AS (SELECT c_custkey, 'ELA-' || CAST(c_custkey AS VARCHAR) || ' ' || CAST(c_nationkey AS VARCHAR)
         || CASE WHEN c_custkey % 3 = 0 THEN ' (dup ' || CAST(c_custkey % 7 AS VARCHAR) || ')' ELSE '' END AS code
         FROM customer)"""


@register("fn01_normalize_biobank_id", "WITH " + SQL_BIOBANK.lstrip("\n, ") + """
SELECT c_custkey, regexp_replace(code, '[ -]', '', 'g') AS code_norm FROM bb""")
def fn01(spark, d):
    return _biobank_raw(spark, d).select("c_custkey", fi.normalize_biobank_id("code").alias("code_norm"))


@register("fn02_donor_id", "WITH " + SQL_BIOBANK.lstrip("\n, ") + """
SELECT c_custkey, trim(regexp_replace(code, '\\([^)]+\\)$', '')) AS donor FROM bb""")
def fn02(spark, d):
    return _biobank_raw(spark, d).select("c_custkey", fi.donor_id("code").alias("donor"))


@register("fn03_sample_id_clean", """
SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(raw_id, '-?ADN[0-9]', ''), '-ambBED', ''),
                                 '-', '', 'g') AS sample_id
FROM raw_ids""", ["raw_ids"])
def fn03(spark, d):
    return fx.raw_ids(spark, d).select("c_custkey", fi.sample_id_clean("raw_id").alias("sample_id"))


@register("fn04_text_ops", """
SELECT c_custkey, upper(c_mktsegment) AS up, lower(c_mktsegment) AS low,
       regexp_matches(c_mktsegment, 'ING$') AS ends_ing, trim('  ' || c_name || ' ') AS trimmed
FROM customer""")
def fn04(spark, d):
    c = fx.table(spark, d, "customer")
    return c.select("c_custkey", F.upper("c_mktsegment").alias("up"), F.lower("c_mktsegment").alias("low"),
                    F.col("c_mktsegment").rlike("ING$").alias("ends_ing"),
                    F.trim(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("trimmed"))


SQL_DMY = """CASE WHEN regexp_full_match(regexp_replace(trim({x}), '[^0-9]+', '-', 'g'), '[0-9]{{1,2}}-[0-9]{{1,2}}-[0-9]{{4}}')
  THEN CAST(try_strptime(regexp_replace(trim({x}), '[^0-9]+', '-', 'g'), '%d-%m-%Y') AS DATE) END"""


@register("fn05_parse_dmy", f"""
SELECT _row, {SQL_DMY.format(x='fecha_visita')} AS d1,
       {SQL_DMY.format(x="replace(fecha_visita, '-', '.')")} AS d2
FROM registry_text""", ["registry_text"])
def fn05(spark, d):
    r = fx.registry_text(spark, d)
    return r.select("_row", fd.parse_dmy("fecha_visita").alias("d1"),
                    fd.parse_dmy(F.regexp_replace("fecha_visita", "-", ".")).alias("d2"))


@register("fn06_parse_date", """
SELECT _row, CAST(try_strptime(replace(fecha_visita, '-', '/'), '%d/%m/%Y') AS DATE) AS d
FROM registry_text""", ["registry_text"])
def fn06(spark, d):
    r = fx.registry_text(spark, d)
    return r.select("_row", fd.parse_date(F.regexp_replace("fecha_visita", "-", "/"), "dd/MM/yyyy").alias("d"))


@register("fn07_dmy_or_serial", f"""
SELECT _row, coalesce({SQL_DMY.format(x='fecha_visita')},
  CAST(DATE '1899-12-30' + CAST(floor(try_cast(fecha_visita AS DOUBLE)) AS INTEGER) AS DATE)) AS d
FROM registry_text""", ["registry_text"])
def fn07(spark, d):
    r = fx.registry_text(spark, d)
    return r.select("_row", fd.parse_dmy_or_serial("fecha_visita").alias("d"))


@register("fn08_durations", """
SELECT pid, round(CAST(datediff('day', onset, diagnosis) AS DOUBLE) / 30.4375, 1) AS delay_months,
       CAST(floor(CAST(datediff('day', birth, onset) AS DOUBLE) / 365.25) AS BIGINT) AS age_onset
FROM patients""", ["patients"])
def fn08(spark, d):
    p = fx.patients(spark, d)
    return p.select("pid", fd.months_between_avg("diagnosis", "onset", 1).alias("delay_months"),
                    fd.years_floor("onset", "birth").cast("bigint").alias("age_onset"))


@register("fn09_within_months", """
SELECT v._row, CASE WHEN datediff('day', p.diagnosis, v.day) <= 12 * 30.4375 THEN v.total END AS total_12m
FROM visits v JOIN patients p ON v.pid = p.pid""", ["visits", "patients"])
def fn09(spark, d):
    v = fx.visits(spark, d).join(fx.patients(spark, d), "pid")
    return v.select("_row", fd.within_months("total", "day", "diagnosis", 12).alias("total_12m"))


@register("fn10_safe_casts", """
SELECT _row, try_cast(peso AS DOUBLE) AS peso_d, CAST(trunc(try_cast(peso AS DOUBLE)) AS INTEGER) AS peso_i,
       CAST(trunc(try_cast(fecha_visita AS DOUBLE)) AS INTEGER) AS serial_i
FROM registry_text""", ["registry_text"])
def fn10(spark, d):
    r = fx.registry_text(spark, d)
    return r.select("_row", fr.safe_double("peso").alias("peso_d"), fr.safe_int("peso").alias("peso_i"),
                    fr.safe_int("fecha_visita").alias("serial_i"))


@register("fn11_bmi_weight_loss", """
SELECT o_orderkey,
  round((o_totalprice / 5000.0) / ((150 + o_orderkey % 50) / 100.0 * (150 + o_orderkey % 50) / 100.0), 1) AS imc,
  round((o_totalprice / 5000.0 - (o_totalprice / 5000.0 + o_orderkey % 7)) / (o_totalprice / 5000.0 + o_orderkey % 7), 6) AS perdida_ponderal
FROM orders""")
def fn11(spark, d):
    o = fx.table(spark, d, "orders")
    w = F.col("o_totalprice") / 5000.0
    h = (150 + F.col("o_orderkey") % 50).cast("double")
    base = w + F.col("o_orderkey") % 7
    return o.select("o_orderkey", fc.bmi(w, h).alias("imc"), r6(fc.rel_change(w, base)).alias("perdida_ponderal"))


def alsfrs(spark, d):
    """Visits with item names, sub-totals (before the range check), checked total."""
    v = fx.visits(spark, d)
    v = v.select("_row", "pid", F.col("day").alias("fecha_visita"), "peg", F.col("kings_rec").alias("kings"),
                 *[F.col(f"i{j + 1}").alias(n) for j, n in enumerate(fc.ALSFRS_ITEMS)], "total")
    v = v.withColumns(fc.alsfrs_totals())
    return v.withColumn("total", fc.checked_total("total"))


SQL_ALSFRS = """
, alsfrs AS (
  SELECT _row, pid, day AS fecha_visita, peg, kings_rec AS kings, """ + ", ".join(
    f"i{j + 1} AS {n}" for j, n in enumerate(fc.ALSFRS_ITEMS)) + """,
    CASE WHEN total BETWEEN 0 AND 48 THEN total END AS total,
    i1 + i2 + i3 AS total_bulbar, i8 + i9 + i10 AS total_motor_grosero, i11 + i12 + i13 AS total_respiratorio,
    total - (i1 + i2 + i3) - (i8 + i9 + i10) - (i11 + i12 + i13) AS total_motor_fino
  FROM visits)"""


@register("fn12_alsfrs_totals", SQL_ALSFRS + """
SELECT _row, total, total_bulbar, total_motor_grosero, total_respiratorio, total_motor_fino FROM alsfrs""",
          ["visits"])
def fn12(spark, d):
    return alsfrs(spark, d).select("_row", "total", "total_bulbar", "total_motor_grosero",
                                   "total_respiratorio", "total_motor_fino")


@register("fn13_progression_slope", SQL_ALSFRS + """
SELECT a._row, round((48 - a.total) / nullif(CAST(datediff('day', p.onset, a.fecha_visita) AS DOUBLE) / 30.4375, 0), 1) AS delta_fs
FROM alsfrs a JOIN patients p ON a.pid = p.pid""", ["visits", "patients"])
def fn13(spark, d):
    a = alsfrs(spark, d).join(fx.patients(spark, d), "pid")
    months = fd.months_between_avg("fecha_visita", "onset", None)
    return a.select("_row", fc.progression_slope("total", months).alias("delta_fs"))


@register("fn14_mitos_stage", SQL_ALSFRS + """
SELECT _row, CAST(((caminar <= 1) OR (vestido <= 1)) AS INTEGER) + CAST((deglucion <= 1) AS INTEGER)
  + CAST(((lenguaje <= 1) AND (escritura <= 1)) AS INTEGER)
  + CAST(((disnea <= 1) OR (insuficiencia_respiratoria <= 2)) AS INTEGER) AS mitos
FROM alsfrs""", ["visits"])
def fn14(spark, d):
    return alsfrs(spark, d).select("_row", fc.mitos_stage().alias("mitos"))


SQL_KINGS = SQL_ALSFRS + """
, peg AS (SELECT pid, min(fecha_visita) AS fecha_indicacion_peg FROM alsfrs WHERE peg GROUP BY pid)
, kings AS (
  SELECT a._row, a.pid, a.fecha_visita, coalesce(
    CASE WHEN a.kings BETWEEN 0 AND 5 THEN a.kings END,
    CASE WHEN p.fecha_indicacion_peg IS NOT NULL AND a.fecha_visita >= p.fecha_indicacion_peg THEN 4
         WHEN cortar_con_peg > 0 AND cortar_sin_peg > 0 THEN NULL
         WHEN cortar_con_peg = 0 AND cortar_sin_peg = 0 THEN NULL
         WHEN cortar_con_peg > 0 AND cortar_sin_peg = 0 THEN 4
         WHEN (disnea = 0) OR (insuficiencia_respiratoria < 4) THEN 4
         ELSE CAST(total_bulbar < 12 AS INTEGER) + CAST((escritura < 4) OR (cortar_sin_peg < 4) AS INTEGER)
              + CAST(caminar < 4 AS INTEGER) END) AS kings
  FROM alsfrs a LEFT JOIN peg p ON a.pid = p.pid)"""


def kings_visits(spark, d):
    from genoframe.operators.longitudinal import first_event_date
    a = alsfrs(spark, d)
    peg = first_event_date(a, "peg", "fecha_visita", out="fecha_indicacion_peg")
    return a.join(peg, "pid", "left").withColumn("kings", fc.kings_stage())


@register("fn15_kings_stage", SQL_KINGS + """
SELECT _row, CAST(kings AS INTEGER) AS kings FROM kings""", ["visits"])
def fn15(spark, d):
    return kings_visits(spark, d).select("_row", F.col("kings").cast("int").alias("kings"))


@register("fn16_progression_category", """
SELECT _row, CASE WHEN x < 0.5 THEN 'SP' WHEN x BETWEEN 0.5 AND 1 THEN 'NP' WHEN x > 1 THEN 'FP' END AS dfs_cat,
       CASE WHEN y < 20 THEN 'FP' WHEN y BETWEEN 20 AND 50 THEN 'NP' WHEN y > 50 THEN 'SP' END AS d50_cat
FROM (SELECT _row, CAST(total AS DOUBLE) / 40.0 AS x, CAST(total AS DOUBLE) * 1.5 AS y FROM visits)""",
          ["visits"])
def fn16(spark, d):
    v = fx.visits(spark, d)
    return v.select("_row", fc.slope_category(F.col("total").cast("double") / 40.0).alias("dfs_cat"),
                    fc.d50_category(F.col("total").cast("double") * 1.5).alias("d50_cat"))


@register("fn17_log_transforms", """
SELECT v, round(-log10(p), 6) AS neg_log10_p, round(log2(exp(beta)), 6) AS log2_or,
       round(least(log10(p), -0.5), 6) AS capped
FROM results""", ["results"])
def fn17(spark, d):
    r = fx.results(spark, d)
    return r.select("v", r6(fs.neg_log10("p")).alias("neg_log10_p"), r6(fs.log2(F.exp("beta"))).alias("log2_or"),
                    r6(fs.capped(F.log10("p"), F.lit(-0.5))).alias("capped"))


@register("fn18_chrom_ordinal", """
SELECT v, CAST(CASE chrom WHEN 'X' THEN 23 WHEN 'Y' THEN 24 WHEN 'MT' THEN 25 ELSE CAST(chrom AS INTEGER) END
               AS INTEGER) AS chrom_num
FROM variants""", ["variants"])
def fn18(spark, d):
    return fx.variants(spark, d).select("v", fr.chrom_ordinal("chrom").cast("int").alias("chrom_num"))


@register("fn19_allele_freq", """
SELECT chrom, pos, ref, alt,
  CASE WHEN "AC" = 0 THEN 0.0 ELSE round("AC" / nullif(CAST("AN" AS DOUBLE), 0), 9) END AS af_all,
  CASE WHEN "AC_afr" = 0 THEN 0.0 ELSE round("AC_afr" / nullif(CAST("AN_afr" AS DOUBLE), 0), 9) END AS af_afr
FROM sites""", ["sites"])
def fn19(spark, d):
    s = fx.sites(spark, d)
    return s.select("chrom", "pos", "ref", "alt", fa.allele_freq("AC", "AN").alias("af_all"),
                    fa.allele_freq("AC_afr", "AN_afr").alias("af_afr"))


_POP_AF_SQL = ", ".join(
    f"CASE WHEN \"AC_{p}\" = 0 THEN 0.0 ELSE round(\"AC_{p}\" / nullif(CAST(\"AN_{p}\" AS DOUBLE), 0), 9) END AS af_{p}"
    for p in fx.POPULATIONS)


@register("fn20_max_pop_af", f"""
SELECT chrom, pos, ref, alt, greatest({", ".join(f"af_{p}" for p in fx.POPULATIONS)}) AS max_aaf_all
FROM (SELECT chrom, pos, ref, alt, {_POP_AF_SQL} FROM sites)""", ["sites"])
def fn20(spark, d):
    s = fx.sites(spark, d)
    afs = [fa.allele_freq(f"AC_{p}", f"AN_{p}") for p in fx.POPULATIONS]
    return s.select("chrom", "pos", "ref", "alt", fa.max_pop_af(*afs).alias("max_aaf_all"))


@register("fn22_merge_ids", """
SELECT c.chrom, c.pos, c.ref, c.alt,
  array_to_string(list_transform(list_distinct_ordered, lambda x: replace(x, ',', ';')), ';') AS merged_id
FROM (SELECT chrom, pos, ref, alt,
        list_filter([s."ID", c."RS"], lambda x: x IS NOT NULL AND x <> '.' AND x <> '') AS ids
      FROM clinvar c LEFT JOIN sites s USING (chrom, pos, ref, alt)) c,
LATERAL (SELECT CASE WHEN len(ids) = 2 AND ids[1] = ids[2] THEN [ids[1]] ELSE ids END AS list_distinct_ordered)""",
          ["clinvar", "sites"])
def fn22(spark, d):
    c = fx.clinvar(spark, d).join(fx.sites(spark, d).select("chrom", "pos", "ref", "alt", F.col("ID").alias("gno_id")),
                                  ["chrom", "pos", "ref", "alt"], "left")
    return c.select("chrom", "pos", "ref", "alt", fa.merge_ids("gno_id", "RS").alias("merged_id"))


SQL_CLINSIG_CODES = """
, codes AS (SELECT p_partkey AS k,
    CASE p_partkey % 4 WHEN 0 THEN CAST(p_partkey % 9 AS VARCHAR)
                       WHEN 1 THEN CAST(p_partkey % 6 AS VARCHAR) || ',' || CAST(p_partkey % 4 AS VARCHAR)
                       WHEN 2 THEN CAST(p_partkey % 6 AS VARCHAR) || '|' || CAST(p_partkey % 8 AS VARCHAR) || ',' || CAST(p_partkey % 3 AS VARCHAR)
                       ELSE '255|' || CAST(p_partkey % 5 AS VARCHAR) END AS code,
    CAST(pow(2, p_partkey % 11) AS BIGINT) AS origin
  FROM part)
, m AS (SELECT MAP {'0': 'uncertain', '1': 'not-provided', '2': 'benign', '3': 'likely-benign',
        '4': 'likely-pathogenic', '5': 'pathogenic', '6': 'drug-response', '7': 'histocompatibility',
        '255': 'other', '.': '.'} AS sig)"""


def _clinsig_codes(spark, d):
    k = F.col("p_partkey")
    s = lambda c: c.cast("string")
    code = (F.when(k % 4 == 0, s(k % 9))
            .when(k % 4 == 1, F.concat(s(k % 6), F.lit(","), s(k % 4)))
            .when(k % 4 == 2, F.concat(s(k % 6), F.lit("|"), s(k % 8), F.lit(","), s(k % 3)))
            .otherwise(F.concat(F.lit("255|"), s(k % 5))))
    return fx.table(spark, d, "part").select(k.alias("k"), code.alias("code"),
                                             F.pow(F.lit(2), k % 11).cast("bigint").alias("origin"))


@register("fn23_decode_clinsig", "WITH " + SQL_CLINSIG_CODES.lstrip("\n, ") + """
SELECT k, CASE WHEN NOT contains(code, '|') THEN m.sig[code]
  ELSE array_to_string(list_filter(list_transform(list_filter(string_split(code, ','), lambda y: y <> ''),
         lambda part: CASE WHEN NOT contains(part, '|') THEN m.sig[part]
                           ELSE array_to_string(list_filter(list_transform(string_split(part, '|'),
                                  lambda z: m.sig[z]), lambda z: z IS NOT NULL), '|') END),
         lambda y: y IS NOT NULL), ',') END AS clinsig
FROM codes, m""")
def fn23(spark, d):
    return _clinsig_codes(spark, d).select("k", fa.decode_clinsig("code").alias("clinsig"))


@register("fn24_decode_origin", "WITH " + SQL_CLINSIG_CODES.lstrip("\n, ") + """
SELECT k, CASE CAST(origin AS VARCHAR) WHEN '0' THEN 'unknown' WHEN '1' THEN 'germline' WHEN '2' THEN 'somatic'
  WHEN '4' THEN 'inherited' WHEN '8' THEN 'paternal' WHEN '16' THEN 'maternal' WHEN '32' THEN 'de-novo'
  WHEN '64' THEN 'biparental' WHEN '128' THEN 'uniparental' WHEN '256' THEN 'not-tested'
  WHEN '512' THEN 'tested-inconclusive' WHEN '1073741824' THEN 'other' END AS origin_label
FROM codes""")
def fn24(spark, d):
    return _clinsig_codes(spark, d).select("k", fa.decode_origin(F.col("origin").cast("string")).alias("origin_label"))


@register("fn25_misc_annotation", """
SELECT v, round((CAST(v % 10 AS DOUBLE) + (v % 7) + (v % 3)) / 3.0, 6) AS mean3,
  CASE WHEN v % 5 = 0 THEN 0.0 ELSE round(CAST(v % 5 AS DOUBLE) / ((v % 11) + (v % 5)), 9) END AS alt_ratio,
  chrom || ':' || CAST(pos AS VARCHAR) || '-' || CAST(pos + 100 AS VARCHAR) AS locus,
  CAST(len(list_filter(string_split(gene, '#'), lambda x: x <> '')) AS INTEGER) AS n_parts,
  contains(gene, '#1') AS has_1
FROM variants""", ["variants"])
def fn25(spark, d):
    v = fx.variants(spark, d)
    k = F.col("v")
    arr = F.array((k % 10).cast("double"), (k % 7).cast("double"), (k % 3).cast("double"))
    return v.select("v", r6(fa.array_mean(arr)).alias("mean3"),
                    fa.alt_ratio(k % 11, k % 5).alias("alt_ratio"),
                    fi.locus("chrom", "pos", F.col("pos") + 100).alias("locus"),
                    F.size(fa.split_nonempty("gene", "#")).cast("int").alias("n_parts"),
                    fa.contains_text("gene", "#1").alias("has_1"))


_SUBTYPE_TEXT = ["ELA Espinal", "ELA Bulbar", "ELA Respiratoria", "Atrofia Muscular Progresiva (AMP)",
                 "Esclerosis Lateral Primaria (ELP)", "Parálisis bulbar progresiva", "Flail arm", "Flail leg",
                 "Hemipléjica (Mills)", "Pseudopolineurítica", "Monomiélica"]


@register("fn26_clinical_recodes", """
, t AS (SELECT c_custkey, (['ELA Espinal','ELA Bulbar','ELA Respiratoria','Atrofia Muscular Progresiva (AMP)',
   'Esclerosis Lateral Primaria (ELP)','Parálisis bulbar progresiva','Flail arm','Flail leg',
   'Hemipléjica (Mills)','Pseudopolineurítica','Monomiélica'])[c_custkey % 11 + 1] AS fenotipo FROM customer)
SELECT c_custkey,
  CASE WHEN fenotipo IN ('ELA Espinal','ELA Bulbar','ELA Respiratoria') THEN 'ALS'
       WHEN fenotipo = 'Atrofia Muscular Progresiva (AMP)' THEN 'PMA'
       WHEN fenotipo = 'Esclerosis Lateral Primaria (ELP)' THEN 'PLS'
       WHEN fenotipo = 'Parálisis bulbar progresiva' THEN 'PBP'
       WHEN fenotipo = 'Flail arm' THEN 'Flail-Arm' WHEN fenotipo = 'Flail leg' THEN 'Flail-Leg'
       ELSE 'Other' END AS subtype,
  CASE WHEN fenotipo = 'ELA Respiratoria' THEN 'Respiratory'
       WHEN fenotipo IN ('Hemipléjica (Mills)','Pseudopolineurítica','Atrofia Muscular Progresiva (AMP)',
                         'ELA Espinal','Flail arm','Flail leg') THEN 'Spinal'
       WHEN fenotipo IN ('ELA Bulbar','Parálisis bulbar progresiva') THEN 'Bulbar' END AS onset_site,
  CASE fenotipo WHEN 'ELA Bulbar' THEN 'ALS-B' WHEN 'ELA Espinal' THEN 'ALS-S' WHEN 'Monomiélica' THEN 'ALS-S'
       WHEN 'ELA Respiratoria' THEN 'ALS-R' WHEN 'Parálisis bulbar progresiva' THEN 'PBP' WHEN 'Flail leg' THEN 'FLS'
       WHEN 'Flail arm' THEN 'FAS' WHEN 'Atrofia Muscular Progresiva (AMP)' THEN 'PMA'
       WHEN 'Esclerosis Lateral Primaria (ELP)' THEN 'PLS' END AS als_pheno
FROM t""".replace(", t AS", "WITH t AS", 1))
def fn26(spark, d):
    c = fx.table(spark, d, "customer")
    t = c.select("c_custkey", F.element_at(F.array(*[F.lit(x) for x in _SUBTYPE_TEXT]),
                                           (F.col("c_custkey") % 11 + 1).cast("int")).alias("fenotipo"))
    return t.select("c_custkey", fr.clinical_subtype("fenotipo").alias("subtype"),
                    fr.onset_site("fenotipo").alias("onset_site"),
                    fr.recode("fenotipo", fr.ALS_PHENOTYPE_CODE).alias("als_pheno"))


@register("fn28_to_bool", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN true WHEN o_orderkey % 3 = 1 THEN false END AS peg,
       CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS closed
FROM orders""")
def fn28(spark, d):
    o = fx.table(spark, d, "orders")
    txt = F.element_at(F.array(F.lit("Sí"), F.lit("No"), F.lit("NS/NC")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    flag = F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "0")
    return o.select("o_orderkey", fr.to_bool(txt).alias("peg"), fr.to_bool(flag).alias("closed"))


@register("fn29_label_if_null", """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'CONTROL' ELSE 'EM' END AS grupo,
       coalesce(CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END, 'EM') AS grupo2
FROM customer""")
def fn29(spark, d):
    c = fx.table(spark, d, "customer")
    nhc = F.when(F.col("c_custkey") % 3 == 0, F.lit(None)).otherwise(F.col("c_custkey"))
    dx = F.when(F.col("c_custkey") % 4 == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", fr.label_if_null(nhc, "CONTROL", "EM").alias("grupo"),
                    F.coalesce(dx, F.lit("EM")).alias("grupo2"))


@register("fn30_as_nominal", """
SELECT o_orderkey, CASE WHEN r IN ('Normal', 'Alterado') THEN r END AS estado_c9
FROM (SELECT o_orderkey, (['Normal','Alterado','Pendiente','NS/NC'])[o_orderkey % 4 + 1] AS r FROM orders)""")
def fn30(spark, d):
    o = fx.table(spark, d, "orders")
    r = F.element_at(F.array(*[F.lit(x) for x in ["Normal", "Alterado", "Pendiente", "NS/NC"]]),
                     (F.col("o_orderkey") % 4 + 1).cast("int"))
    return o.select("o_orderkey", fr.as_nominal(r, ["Normal", "Alterado"]).alias("estado_c9"))


@register("fn31_ms_course", """
SELECT patient_id,
  CASE WHEN code IN (1, 2) THEN 'RR' WHEN code = 3 THEN 'SP-NR' WHEN code = 4 THEN 'SP-R'
       WHEN code = 5 THEN 'PP-NR' WHEN code IN (6, 7) THEN 'PP-R' END AS disease_course,
  CASE WHEN code IN (1, 2) THEN 'RR' WHEN code IN (3, 4) THEN 'SP' WHEN code IN (5, 6, 7) THEN 'PP' END AS fenotipo,
  CASE WHEN NOT unknown_date THEN round(CAST(datediff('day', ms_onset, dss3) AS DOUBLE) / 30.4375) END AS tiempo_iedss3
FROM (SELECT patient_id, ms_onset, CAST(patient_id % 9 AS BIGINT) AS code, patient_id % 5 = 0 AS unknown_date,
             CAST(ms_onset + CAST(patient_id * 37 % 2000 AS INTEGER) AS DATE) AS dss3 FROM ms_onsets)""",
          ["ms_onsets"])
def fn31(spark, d):
    m = fx.ms_onsets(spark, d)
    code = (F.col("patient_id") % 9).cast("bigint")
    dss3 = F.date_add("ms_onset", (F.col("patient_id") * 37 % 2000).cast("int"))
    unknown = F.col("patient_id") % 5 == 0
    months = F.round(fd.months_between_avg(dss3, "ms_onset", None), 0)
    return m.select("patient_id", fr.ms_course(code).alias("disease_course"),
                    fr.ms_course_group(fr.ms_course(code)).alias("fenotipo"),
                    F.when(~unknown, months).alias("tiempo_iedss3"))


@register("fn21_common_pathogenic", """
SELECT c.chrom, c.pos, c.ref, c.alt,
  coalesce(contains(c."CLNSIG", 'pathogenic') AND greatest(""" + ", ".join(
    f"CASE WHEN s.\"AC_{p}\" = 0 THEN 0.0 ELSE round(s.\"AC_{p}\" / nullif(CAST(s.\"AN_{p}\" AS DOUBLE), 0), 9) END"
    for p in fx.POPULATIONS) + """) > 0.005, false) AS common_pathogenic,
  coalesce(contains(lower(c."CLNSIG"), 'pathogenic') AND greatest(""" + ", ".join(
    f"CASE WHEN s.\"AC_{p}\" = 0 THEN 0.0 ELSE round(s.\"AC_{p}\" / nullif(CAST(s.\"AN_{p}\" AS DOUBLE), 0), 9) END"
    for p in fx.POPULATIONS) + """) > 0.005, false) AS common_pathogenic_ci
FROM clinvar c LEFT JOIN sites s USING (chrom, pos, ref, alt)""", ["clinvar", "sites"])
def fn21(spark, d):
    s = fx.sites(spark, d)
    mx = fa.max_pop_af(*[fa.allele_freq(f"AC_{p}", f"AN_{p}") for p in fx.POPULATIONS])
    j = fx.clinvar(spark, d).join(s.select("chrom", "pos", "ref", "alt", mx.alias("max_aaf_all")),
                                  ["chrom", "pos", "ref", "alt"], "left")
    return j.select("chrom", "pos", "ref", "alt",
                    fa.common_pathogenic("CLNSIG", "max_aaf_all").alias("common_pathogenic"),
                    fa.common_pathogenic("CLNSIG", "max_aaf_all", ignore_case=True).alias("common_pathogenic_ci"))


@register("fn27_left_align")
def fn27(spark, d):
    """A deletion at every variant locus, normalised against reference windows built
    deterministically for the bins the variants fall in (and the bin before)."""
    from genoframe.operators.normalize import left_align
    width = 64
    v = fx.variants(spark, d)
    bins = v.select("chrom", F.floor((F.col("pos") - 1) / width).alias("bin"))
    bins = bins.select("chrom", F.explode(F.array(F.col("bin") - 1, "bin", F.col("bin") + 1)).alias("bin")).where("bin >= 0").distinct()
    seq = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.element_at(
        F.array(*[F.lit(b) for b in "ACGT"]), ((F.col("bin") * 7 + F.floor(i / 3)) % 4 + 1).cast("int"))), "")
    win = bins.select("chrom", F.col("bin").cast("bigint"), seq.alias("seq"))
    start = F.floor((F.col("pos") - 1) / width) * width + 1
    vb = v.withColumn("bin", F.floor((F.col("pos") - 1) / width).cast("bigint"))
    after = win.select("chrom", (F.col("bin") - 1).alias("bin"), F.col("seq").alias("next"))
    ind = (vb.join(win, ["chrom", "bin"]).join(after, ["chrom", "bin"])
           .select("chrom", "pos", F.substring(F.concat("seq", "next"), (F.col("pos") - start + 1).cast("int"), 2).alias("ref"))
           .select("chrom", "pos", "ref", F.substring("ref", 1, 1).alias("alt")))
    return left_align(ind, win, width)
