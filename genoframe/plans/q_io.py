"""Registered analyses: sources and sinks (SRC, SNK), partition pruning (FLT-22), concatenation (SET-4).

Each query writes a binding derived from the tables into a fresh folder under
the shared checkpoint folder, reads it back through the source under test and
returns a summary that the oracle computes from the tables directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from genoframe import fixtures as fx
from genoframe.functions import dates as fd
from genoframe.functions import recode as fr
from genoframe.operators import filters as ofl
from genoframe.plans.q_columns import PSAM_SQL, psam, r6
from genoframe.plans.q_joins import SQL_VID
from genoframe.plans.registry import register
from genoframe.session import scratch_dir
from genoframe.sources import sinks as sk
from genoframe.sources import tabular as tb
from genoframe.sources import vcf as vc

SQL_GENO_SUMMARY = f"""
SELECT {SQL_VID} AS variant_id, CAST(count(*) FILTER (WHERE g.dosage > 0) AS BIGINT) AS n_carriers,
       CAST(sum(g.dosage) AS BIGINT) AS ac, CAST(count(*) FILTER (WHERE g.dosage IS NULL) AS BIGINT) AS n_missing
FROM genotypes g JOIN variants vv ON g.v = vv.v WHERE vv.filter = 'PASS' GROUP BY 1"""


def _geno_summary(g):
    vid = F.concat(F.col("chrom"), F.lit(":"), F.col("pos").cast("string"), F.lit("_"), F.col("ref"), F.lit("_"),
                   F.col("alt"))
    return g.groupBy(vid.alias("variant_id")).agg(
        F.count(F.when(F.col("dosage") > 0, 1)).cast("bigint").alias("n_carriers"),
        F.sum("dosage").cast("bigint").alias("ac"),
        F.count(F.when(F.col("dosage").isNull(), 1)).cast("bigint").alias("n_missing"))


def _cohort(spark, d):
    v = fx.variants(spark, d)
    g = fx.genotypes(spark, d).withColumn("sample_id", F.format_string("S%03d", "s"))
    return v, g


@register("src01_read_vcf_per_sample", SQL_GENO_SUMMARY, ["genotypes", "variants"])
def src01(spark, d):
    """Per-sample VCFs (one folder per sample, header in each) -> PASS filter -> cohort summary."""
    v, g = _cohort(spark, d)
    path = vc.write_vcf_per_sample(v, g, scratch_dir(spark, "vcf-per-sample"))
    variants, genotypes = vc.read_vcf(spark, f"{path}/sample=*/*.txt")
    pas = ofl.filter_pass(genotypes.join(variants.select("chrom", "pos", "ref", "alt", "filter").distinct(),
                                         ["chrom", "pos", "ref", "alt"]))
    return _geno_summary(pas)


@register("src10_sample_from_path", """
SELECT printf('S%03d', s) AS sample_id, CAST(count(*) AS BIGINT) AS n_calls FROM genotypes GROUP BY 1""",
          ["genotypes"])
def src10(spark, d):
    v, g = _cohort(spark, d)
    path = vc.write_vcf_per_sample(v, g, scratch_dir(spark, "vcf-per-sample"))
    _, genotypes = vc.read_vcf(spark, f"{path}/sample=*/*.txt", sample_from_path=True)
    return genotypes.groupBy("sample_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_calls"))


@register("snk02_write_vcf", SQL_GENO_SUMMARY.replace("WHERE vv.filter = 'PASS' ", ""), ["genotypes", "variants"])
def snk02(spark, d):
    """Multi-sample VCF (header file + genome-ordered parts) round trip."""
    v, g = _cohort(spark, d)
    samples = fx.samples(spark, d)
    path = vc.write_vcf(spark, v, g, scratch_dir(spark, "vcf-cohort"), samples)
    _, genotypes = vc.read_vcf(spark, path)
    return _geno_summary(genotypes)


@register("src11_read_sites", """
SELECT chrom, pos, ref, alt, "ID" AS gno_id, CAST("AC" AS BIGINT) AS gno_ac_all, CAST("AN" AS BIGINT) AS gno_an_all
FROM sites""", ["sites"])
def src11(spark, d):
    s = fx.sites(spark, d)
    info = F.concat(F.lit("AC="), F.col("AC").cast("string"), F.lit(";AN="), F.col("AN").cast("string"), F.lit(";DB"))
    line = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.regexp_replace("ID", ",", ";"), "ref", "alt",
                       F.lit("."), "FILTER", info)
    path = scratch_dir(spark, "sites-vcf")
    spark.createDataFrame([("##fileformat=VCFv4.2",), ("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",)],
                          "value string").coalesce(1).write.text(path)
    s.select(line.alias("value")).write.mode("append").text(path)
    r = tb_sites = vc.read_sites(spark, path, ["ID", "AC", "AN"], ["gno_id", "gno_ac_all", "gno_an_all"])
    return tb_sites.select("chrom", "pos", "ref", "alt", F.regexp_replace("gno_id", ";", ",").alias("gno_id"),
                           r["gno_ac_all"].cast("bigint").alias("gno_ac_all"),
                           r["gno_an_all"].cast("bigint").alias("gno_an_all"))


@register("src02_read_tsv", """
SELECT pid, CAST(count(*) AS BIGINT) AS n, CAST(count(total) AS BIGINT) AS n_total, CAST(sum(total) AS BIGINT) AS sum_total
FROM visits GROUP BY pid""", ["visits"])
def src02(spark, d):
    path = sk.write_tsv(fx.visits(spark, d).select("_row", "pid", "day", "total"), scratch_dir(spark, "tsv"))
    t = tb.read_tsv(spark, path, schema="_row bigint, pid bigint, day date, total int")
    return t.groupBy("pid").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                F.count("total").cast("bigint").alias("n_total"),
                                F.sum("total").alias("sum_total"))


@register("src03_headerless_tsv", f"""
SELECT unit, CAST(count(*) AS BIGINT) AS n
FROM (SELECT {SQL_VID} AS id, CASE WHEN v % 4 = 0 THEN NULL ELSE gene END AS unit FROM variants) GROUP BY unit""",
          ["variants"])
def src03(spark, d):
    from genoframe.functions.ids import variant_id
    v = fx.variants(spark, d)
    sets = v.select(variant_id().alias("ID"),
                    F.when(F.col("v") % 4 == 0, F.lit(".")).otherwise(F.col("gene")).alias("UNIT"))
    path = scratch_dir(spark, "vset")
    sets.write.option("sep", "\t").option("header", False).csv(path)
    r = tb.read_tsv(spark, path, schema="ID string, UNIT string", header=False)
    r = r.withColumn("UNIT", fr.na_if("UNIT", "."))
    return r.groupBy(F.col("UNIT").alias("unit")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("src04_read_ids", """
SELECT sample_id FROM pheno WHERE pheno = 'ALS'""", ["pheno"])
def src04(spark, d):
    path = sk.write_ids(ofl.samples_by_pheno(fx.pheno(spark, d), "ALS"), scratch_dir(spark, "ids"))
    return tb.read_ids(spark, path)


register("snk04_write_ids", "SELECT sample_id FROM pheno WHERE pheno = 'CONTROL'", ["pheno"])(
    lambda spark, d: tb.read_ids(spark, sk.write_ids(ofl.samples_by_pheno(fx.pheno(spark, d), "CONTROL"),
                                                     scratch_dir(spark, "ids"))))


@register("src05_registry_utf16", """
SELECT _row AS row_id,
  coalesce(CASE WHEN regexp_full_match(regexp_replace(trim(fecha_visita), '[^0-9]+', '-', 'g'), '[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}')
    THEN CAST(try_strptime(regexp_replace(trim(fecha_visita), '[^0-9]+', '-', 'g'), '%d-%m-%Y') AS DATE) END,
    CAST(DATE '1899-12-30' + CAST(floor(try_cast(fecha_visita AS DOUBLE)) AS INTEGER) AS DATE)) AS fecha_visita,
  CASE WHEN _row % 10 IN (0, 5) THEN NULL ELSE try_cast(peso AS DOUBLE) END AS peso
FROM registry_text""", ["registry_text"])
def src05(spark, d):
    r = fx.registry_text(spark, d)
    k = F.col("_row")
    out = r.select(k.alias("Row ID"), F.col("fecha_visita").alias("Fecha Visita"),
                   F.when(k % 10 == 0, F.lit("?")).when(k % 10 == 5, F.lit("")).otherwise(F.col("peso")).alias("Peso"))
    path = scratch_dir(spark, "registry")
    out.write.option("sep", "\t").option("header", True).option("encoding", "UTF-16LE") \
        .option("emptyValue", "").csv(path)
    t = tb.read_registry_tsv(spark, path, encoding="UTF-16LE")
    return t.select(F.col("row_id").cast("bigint").alias("row_id"),
                    fd.parse_dmy_or_serial("fecha_visita").alias("fecha_visita"),
                    fr.safe_double("peso").alias("peso"))


@register("src06_read_csv_projection", """
SELECT chrom, CAST(count(*) AS BIGINT) AS n, round(sum("CADD_phred"), 6) AS cadd_sum FROM scores GROUP BY chrom""",
          ["scores"])
def src06(spark, d):
    path = scratch_dir(spark, "csv")
    fx.scores(spark, d).write.option("header", True).csv(path)
    c = tb.read_csv(spark, path, {"chrom": "chrom", "CADD_phred": "cadd"})
    return c.groupBy("chrom").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                  r6(F.sum(F.col("cadd").cast("double"))).alias("cadd_sum"))


@register("src07_read_table", """
SELECT pid, onset, diagnosis FROM patients""", ["patients"])
def src07(spark, d):
    base = scratch_dir(spark, "tables")
    fx.patients(spark, d).write.parquet(f"{base}/pacientes")
    return tb.read_table(spark, base, "pacientes").select("pid", "onset", "diagnosis")


@register("src08_sheet_export", """
SELECT c_custkey AS nhc, c_mktsegment AS tipo_caso FROM customer""")
def src08(spark, d):
    path = scratch_dir(spark, "sheet")
    c = fx.table(spark, d, "customer").select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_mktsegment")
                                              .alias("value"))
    title = spark.createDataFrame([("Muestras enviadas (export)",), ("NHC,Tipo caso",)], "value string")
    title.union(c).coalesce(1).write.text(path)
    s = tb.read_sheet_export(spark, path, skip=1)
    s = s.toDF(*["nhc", "tipo_caso", "_row"])
    return s.select(fr.safe_int("nhc").cast("bigint").alias("nhc"), "tipo_caso")


@register("src09_whitespace_table", """
SELECT CAST(c_custkey AS BIGINT) AS k, c_acctbal AS eigenval FROM customer""")
def src09(spark, d):
    path = scratch_dir(spark, "ws")
    c = fx.table(spark, d, "customer")
    c.select(F.concat(F.lit("  "), F.col("c_custkey").cast("string"), F.lit("   "),
                      F.col("c_acctbal").cast("string"), F.lit(" ")).alias("value")).write.text(path)
    w = tb.read_ws(spark, path, ["k", "eigenval"])
    return w.select(F.col("k").cast("bigint").alias("k"), F.col("eigenval").cast("double").alias("eigenval"))


@register("src12_sharded_scores", """
SELECT chrom AS chr, CAST(count(*) AS BIGINT) AS n FROM scores GROUP BY chrom""", ["scores"])
def src12(spark, d):
    base = scratch_dir(spark, "dbnsfp")
    s = fx.scores(spark, d).withColumnRenamed("chrom", "#chr")
    paths = []
    for c in ["1", "2", "X"]:
        p = f"{base}/chr{c}"
        s.where(F.col("#chr") == c).write.option("sep", "\t").option("header", True).csv(p)
        paths.append(p)
    rest = f"{base}/rest"
    s.where(~F.col("#chr").isin("1", "2", "X")).write.option("sep", "\t").option("header", True).csv(rest)
    paths.append(rest)
    t = tb.read_sharded_scores(spark, paths)
    return t.groupBy("chr").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("snk01_write_tsv", "SELECT * FROM (" + PSAM_SQL.strip() + ")", ["pheno"])
def snk01(spark, d):
    ps = psam(spark, d)
    path = sk.write_tsv(ps, scratch_dir(spark, "psam"))
    return tb.read_tsv(spark, path, schema=ps.schema)


@register("snk03_write_partitioned", """
SELECT chrom, CAST(count(*) AS BIGINT) AS n, CAST(min(pos) AS BIGINT) AS min_pos FROM variants GROUP BY chrom""",
          ["variants"])
def snk03(spark, d):
    path = sk.write_partitioned(fx.variants(spark, d), scratch_dir(spark, "by-chrom"))
    return spark.read.parquet(path).groupBy("chrom").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                                         F.min("pos").cast("bigint").alias("min_pos"))


@register("flt22_region_pruned", """
SELECT v, pos FROM variants WHERE chrom = '7'""", ["variants"])
def flt22(spark, d):
    path = sk.write_partitioned(fx.variants(spark, d), scratch_dir(spark, "by-chrom"))
    return ofl.region(spark.read.parquet(path), "7").select("v", "pos")


@register("set04_concat_parts", """
SELECT v, chrom FROM variants""", ["variants"])
def set04(spark, d):
    path = sk.write_partitioned(fx.variants(spark, d), scratch_dir(spark, "by-chrom"))
    return spark.read.parquet(path).select("v", "chrom")


@register("snk05_cached", """
SELECT pid, CAST(count(*) AS BIGINT) AS n FROM visits GROUP BY pid""", ["visits"])
def snk05(spark, d):
    path = scratch_dir(spark, "cache")
    thunk = lambda: fx.visits(spark, d).groupBy("pid").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    sk.cached(spark, path, thunk)           # computes and writes
    return sk.cached(spark, path, thunk)    # loads
