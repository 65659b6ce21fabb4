"""Registered analyses: joins (JN)."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoframe import fixtures as fx
from genoframe.functions import annotation as fa
from genoframe.functions import ids as fi
from genoframe.operators import annotate as oa
from genoframe.operators import overlap as oo
from genoframe.operators import scores as osc
from genoframe.operators import joins as oj
from genoframe.operators.sites import merge_cohort
from genoframe.plans.q_columns import SQL_NORMALIZE_IDS, r6, zscored_pcs, SQL_PCS, PSAM_SQL, psam
from genoframe.plans.registry import register
from genoframe.session import scratch_dir


def _ids(spark, d):
    r = fx.raw_ids(spark, d)
    return r.select("c_custkey", F.when(F.col("c_custkey") % 7 == 0, F.lit(None))
                    .otherwise(fi.normalize_sample_ids("raw_id")).alias("sid"))


def _lookup(spark, d):
    r = fx.raw_ids(spark, d)
    return r.select(F.when(F.col("c_custkey") % 97 == 0, F.lit(None))
                    .otherwise(fi.normalize_sample_ids("raw_id")).alias("sid"),
                    (F.col("c_custkey") * 10).alias("nhc"))


SQL_IDS = f"""
, l AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE {SQL_NORMALIZE_IDS.format(x='raw_id')} END AS sid
        FROM raw_ids)
, r AS (SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE {SQL_NORMALIZE_IDS.format(x='raw_id')} END AS sid,
               c_custkey * 10 AS nhc FROM raw_ids)"""


@register("jn01_left_join", SQL_IDS + """
SELECT l.c_custkey, l.sid, r.nhc FROM l LEFT JOIN r ON l.sid = r.sid""", ["raw_ids"])
def jn01(spark, d):
    return oj.left_join(_ids(spark, d), _lookup(spark, d), "sid").select("c_custkey", "sid", "nhc")


@register("jn02_left_join_null_safe", SQL_IDS + """
SELECT l.c_custkey, l.sid, r.nhc FROM l LEFT JOIN r ON l.sid IS NOT DISTINCT FROM r.sid""", ["raw_ids"])
def jn02(spark, d):
    return oj.left_join(_ids(spark, d), _lookup(spark, d), "sid", null_safe=True).select("c_custkey", "sid", "nhc")


@register("jn03_inner_join", SQL_PCS + """
SELECT p.sample_id, p.pheno, round(c."PC1", 6) AS "PC1" FROM pheno p JOIN pcs c ON p.sample_id = c.sample_id
WHERE p.pheno IS NOT NULL""", ["pheno"])
def jn03(spark, d):
    p = fx.pheno(spark, d).where(F.col("pheno").isNotNull()).select("sample_id", "pheno")
    return oj.inner_join(p, zscored_pcs(spark, d).select("sample_id", r6(F.col("PC1")).alias("PC1")), "sample_id")


DISCARD = ["ELA959", "ELA1912", "ELA1923", "ELA1924", "EM959", "ELA1000"]


@register("jn04_anti_join", SQL_IDS + """
SELECT c_custkey, sid FROM l WHERE sid IS NULL OR sid NOT IN (""" + ", ".join(f"'{x}'" for x in DISCARD) + ")",
          ["raw_ids"])
def jn04(spark, d):
    discard = spark.createDataFrame([(x,) for x in DISCARD], "sid string")
    return oj.anti_join(_ids(spark, d), F.broadcast(discard), "sid")


@register("jn05_exists_flag", """
SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS has_urgent
FROM customer""")
def jn05(spark, d):
    c = fx.table(spark, d, "customer").select("c_custkey")
    o = fx.table(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return oj.exists_flag(c, o, "c_custkey", "has_urgent", b_key="o_custkey")


@register("jn06_cross_scaffold", """
SELECT pid, CAST(stage AS INTEGER) AS stage FROM patients, (VALUES (1), (2), (3), (4)) t(stage)""", ["patients"])
def jn06(spark, d):
    return oj.cross_scaffold(fx.patients(spark, d).select("pid"), "stage", [1, 2, 3, 4]) \
        .withColumn("stage", F.col("stage").cast("int"))


SQL_VID = "chrom || ':' || CAST(pos AS VARCHAR) || '_' || ref || '_' || alt"


@register("jn07_variant_sets", f"""
SELECT k.variant_id, a.unit
FROM (SELECT {SQL_VID} AS variant_id, gene AS unit FROM variants WHERE v % 3 <> 0) a
RIGHT JOIN (SELECT {SQL_VID} AS variant_id FROM variants WHERE filter = 'PASS') k ON a.variant_id = k.variant_id""",
          ["variants"])
def jn07(spark, d):
    v = fx.variants(spark, d).withColumn("variant_id", fi.variant_id())
    ann = v.where(F.col("v") % 3 != 0).select("variant_id", F.col("gene").alias("unit"))
    kept = v.where(F.col("filter") == "PASS").select("variant_id")
    return oj.variant_sets(ann, kept)


def _resolve_tables(spark, d):
    r = fx.raw_ids(spark, d).select("c_custkey", fi.normalize_sample_ids("raw_id").alias("sid"))
    c = F.col("c_custkey")
    t1 = r.where(c % 3 != 0).select(F.col("sid").alias("ccn"), F.when(c % 4 != 0, c * 10).alias("nhc"),
                                    F.when(c % 5 == 0, "CONTROL").otherwise("ELA").alias("grupo"), c.alias("_row"))
    dup = r.where((c % 3 != 0) & (c % 10 == 0)).select(
        F.col("sid").alias("ccn"), F.lit(None).cast("bigint").alias("nhc"), F.lit(None).cast("string").alias("grupo"),
        (c + 1_000_000).alias("_row"))
    t1 = t1.unionByName(dup)
    t2 = r.where(c % 2 == 0).select(F.col("sid").alias("cdr"), (c * 10 + 1).alias("nhc"),
                                    F.when(c % 6 != 0, "ELA").alias("grupo"), c.alias("_row"))
    t3 = r.select(F.col("sid").alias("ccn"), (c * 10 + 2).alias("nhc"),
                  F.when(c % 7 == 0, "CONTROL").alias("grupo"), c.alias("_row"))
    return r, t1, t2, t3


@register("jn08_resolve", f"""
, r AS (SELECT c_custkey, {SQL_NORMALIZE_IDS.format(x='raw_id')} AS sid FROM raw_ids)
, t1 AS (SELECT sid AS ccn, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey * 10 END AS nhc,
                CASE WHEN c_custkey % 5 = 0 THEN 'CONTROL' ELSE 'ELA' END AS grupo FROM r WHERE c_custkey % 3 <> 0)
, t2 AS (SELECT sid AS cdr, c_custkey * 10 + 1 AS nhc, CASE WHEN c_custkey % 6 <> 0 THEN 'ELA' END AS grupo
         FROM r WHERE c_custkey % 2 = 0)
, t3 AS (SELECT sid AS ccn, c_custkey * 10 + 2 AS nhc, CASE WHEN c_custkey % 7 = 0 THEN 'CONTROL' END AS grupo FROM r)
SELECT r.c_custkey, r.sid, coalesce(t1.nhc, t2.nhc, t3.nhc) AS nhc, coalesce(t1.grupo, t2.grupo, t3.grupo) AS grupo
FROM r LEFT JOIN t1 ON r.sid = t1.ccn LEFT JOIN t2 ON r.sid = t2.cdr LEFT JOIN t3 ON r.sid = t3.ccn
WHERE starts_with(r.sid, 'ELA')""", ["raw_ids"])
def jn08(spark, d):
    r, t1, t2, t3 = _resolve_tables(spark, d)
    left = r.where(F.col("sid").startswith("ELA"))
    lk = [(oj.dedupe_lookup(t1, "ccn", ["nhc", "grupo"]), "ccn", {"nhc": "nhc_1", "grupo": "grupo_1"}),
          (oj.dedupe_lookup(t2, "cdr", ["nhc", "grupo"]), "cdr", {"nhc": "nhc_2", "grupo": "grupo_2"}),
          (oj.dedupe_lookup(t3, "ccn", ["nhc", "grupo"]), "ccn", {"nhc": "nhc_3", "grupo": "grupo_3"})]
    return oj.resolve(left, "sid", lk, {"nhc": ["nhc_1", "nhc_2", "nhc_3"],
                                        "grupo": ["grupo_1", "grupo_2", "grupo_3"]})


@register("jn09_merge_cohort", f"""
, per_sample AS (SELECT g.s, vv.chrom, vv.pos, vv.ref, vv.alt, g.dosage FROM genotypes g JOIN variants vv ON g.v = vv.v)
SELECT {SQL_VID} AS variant_id, CAST(count(*) FILTER (WHERE dosage > 0) AS BIGINT) AS n_carriers,
       CAST(count(*) FILTER (WHERE dosage IS NULL) AS BIGINT) AS n_missing
FROM per_sample GROUP BY 1""", ["genotypes", "variants"])
def jn09(spark, d):
    calls = (fx.genotypes(spark, d).join(fx.variants(spark, d).select("v", "chrom", "pos", "ref", "alt"), "v")
             .withColumn("sample_id", F.format_string("S%03d", "s")))
    loci, g = merge_cohort(calls)
    agg = g.groupBy("variant_id").agg(
        F.count(F.when(F.col("dosage") > 0, 1)).cast("bigint").alias("n_carriers"),
        F.count(F.when(F.col("dosage").isNull(), 1)).cast("bigint").alias("n_missing"))
    return loci.select("variant_id").join(agg, "variant_id", "left").select(
        "variant_id", F.coalesce("n_carriers", F.lit(0)).cast("bigint").alias("n_carriers"),
        F.coalesce("n_missing", F.lit(0)).cast("bigint").alias("n_missing"))


def annotated_sites(spark, d):
    """JN-10: frequency annotation (AF per population, max AF) then ClinVar/dbSNP with post-ops."""
    v = fx.variants(spark, d)
    a = oa.annotate_exact(v, fx.sites(spark, d), oa.gnomad_spec())
    clin = oa.AnnotationSpec(["ID", "CLNSIG", "CLNDN", "RS"],
                             ["clinvar_id", "clinvar_sig", "clinvar_disease_name", "dbsnp_id"],
                             post=[("common_pathogenic", lambda s, m: fa.common_pathogenic(s, m, 0.005),
                                    ["clinvar_sig", "max_aaf_all"]),
                                   ("ID", fa.merge_ids, ["gno_id", "dbsnp_id"])])
    return oa.annotate_exact(a, fx.clinvar(spark, d), clin)


_AF = lambda p: (f"CASE WHEN s.\"AC_{p}\" = 0 THEN 0.0 ELSE round(s.\"AC_{p}\" / "  # noqa: E731
                 f"nullif(CAST(s.\"AN_{p}\" AS DOUBLE), 0), 9) END")


@register("jn10_annotate_exact", """
SELECT vv.v, CASE WHEN s."AC" = 0 THEN 0.0 ELSE round(s."AC" / nullif(CAST(s."AN" AS DOUBLE), 0), 9) END AS gno_af_all,
  greatest(""" + ", ".join(_AF(p) for p in fx.POPULATIONS) + """) AS max_aaf_all,
  c."CLNSIG" AS clinvar_sig,
  coalesce(contains(c."CLNSIG", 'pathogenic') AND greatest(""" + ", ".join(_AF(p) for p in fx.POPULATIONS) + """) > 0.005, false)
    AS common_pathogenic,
  CASE WHEN s."ID" IS NOT NULL AND c."RS" IS NOT NULL AND c."RS" <> '.' AND s."ID" <> c."RS"
       THEN replace(s."ID", ',', ';') || ';' || c."RS"
       WHEN s."ID" IS NOT NULL THEN replace(s."ID", ',', ';')
       WHEN c."RS" IS NOT NULL AND c."RS" <> '.' THEN c."RS" ELSE '' END AS "ID"
FROM variants vv LEFT JOIN sites s USING (chrom, pos, ref, alt) LEFT JOIN clinvar c USING (chrom, pos, ref, alt)""",
          ["variants", "sites", "clinvar"])
def jn10(spark, d):
    return annotated_sites(spark, d).select("v", "gno_af_all", "max_aaf_all", "clinvar_sig",
                                            "common_pathogenic", "ID")


@register("jn11_annotate_overlap", """
SELECT vv.v, CAST(count(i.sv_key) AS BIGINT) AS n_sv,
       CASE WHEN count(i.sv_key) > 0 THEN string_agg(CAST(i.sv_key AS VARCHAR), ',' ORDER BY CAST(i.sv_key AS VARCHAR)) END AS sv_keys,
       max(i.sv_score) AS max_sv_score
FROM variants vv LEFT JOIN intervals i ON vv.chrom = i.chrom AND vv.pos BETWEEN i.start AND i."end"
GROUP BY vv.v""", ["variants", "intervals"])
def jn11(spark, d):
    v = fx.variants(spark, d).select("v", "chrom", "pos")
    out = oa.annotate_overlap(v, fx.intervals(spark, d), {
        "n_sv": ("sv_key", "count"), "sv_keys": ("sv_key", "concat"), "max_sv_score": ("sv_score", "max")},
        bin_width=50_000)
    return out.select("v", F.coalesce("n_sv", F.lit(0)).cast("bigint").alias("n_sv"),
                      F.when(F.col("sv_keys") != "", F.col("sv_keys")).alias("sv_keys"), "max_sv_score")


#: Ranges of lengths from one base to half a million: suppliers as intervals, parts as deletions.
SQL_RANGES = """
, iv AS (SELECT sv_key, chrom, start, start + CAST(pow(2, sv_key % 20) AS BIGINT) - 1 AS stop, sv_name, sv_score FROM intervals),
dels AS (SELECT v, chrom, pos AS start, pos + CASE WHEN v % 4 = 0 THEN CAST(cadd AS BIGINT) * 2000 ELSE 0 END AS stop FROM variants)"""


def ranges(spark, d):
    iv = fx.intervals(spark, d)
    iv = iv.select("sv_key", "chrom", "start", (F.col("start") + F.pow(F.lit(2.0), F.col("sv_key") % 20).cast("bigint") - 1).alias("stop"),
                   "sv_name", "sv_score")
    v = fx.variants(spark, d)
    span = F.when(F.col("v") % 4 == 0, F.col("cadd").cast("bigint") * 2000).otherwise(F.lit(0))
    return v.select("v", "chrom", F.col("pos").alias("start"), (F.col("pos") + span).alias("stop")), iv


@register("jn11b_overlap_pairs", SQL_RANGES + """
SELECT x.v, i.sv_key, CAST(least(x.stop, i.stop) - greatest(x.start, i.start) + 1 AS BIGINT) AS n_bases
FROM dels x JOIN iv i ON x.chrom = i.chrom AND x.start <= i.stop AND i.start <= x.stop""", ["variants", "intervals"])
def jn11b(spark, d):
    """Ranges against ranges of any length: nested bins, each pair once."""
    v, iv = ranges(spark, d)
    at = ("chrom", "start", "stop")
    p = oo.overlap_pairs(v, iv, at, at)
    return p.select("a.v", "b.sv_key", (F.least("a.stop", "b.stop") - F.greatest("a.start", "b.start") + 1).alias("n_bases"))


@register("udf02b_annotation_overlap", SQL_RANGES + """
SELECT x.v, CAST(count(i.sv_key) AS BIGINT) AS n_src, max(i.sv_score) AS max_score,
  array_to_string(list_slice(list_sort(list(DISTINCT i.sv_name) FILTER (WHERE i.sv_name IS NOT NULL)), 1, 3), ',') AS names,
  arg_min(i.sv_key, struct_pack(a := i.start, b := i.stop, c := i.sv_key)) AS first_key,
  max(i.sv_score) > 0 AS positive
FROM dels x LEFT JOIN iv i ON x.chrom = i.chrom AND x.start <= i.stop AND i.start <= x.stop GROUP BY x.v""",
          ["variants", "intervals"])
def udf02b(spark, d):
    """A declarative spec over the intervals that overlap, with bounded lists and a post-op."""
    v, iv = ranges(spark, d)
    at = ("chrom", "start", "stop")
    spec = oa.AnnotationSpec(["sv_key", "sv_score", "sv_name", "sv_key"], ["n_src", "max_score", "names", "first_key"],
                             ["count", "max", "uniq:3", "first"], post=[("positive", lambda c: c > 0, ["max_score"])])
    return oo.annotate_ranges(v, iv, spec, a_range=at, b_range=at).select("v", "n_src", "max_score", "names", "first_key", "positive")


@register("jn12_annotate_scores", """
SELECT vv.v, s."SIFT4G_pred", s."Polyphen2_HVAR_pred", s."CADD_phred", s."GO"
FROM variants vv LEFT JOIN scores s USING (chrom, pos, ref, alt)""", ["variants", "scores"])
def jn12(spark, d):
    return oa.annotate_scores(fx.variants(spark, d), fx.scores(spark, d),
                              ["SIFT4G_pred", "Polyphen2_HVAR_pred", "CADD_phred", "GO"]) \
        .select("v", "SIFT4G_pred", "Polyphen2_HVAR_pred", "CADD_phred", "GO")


def _packed_sql(i: int, name: str) -> str:
    """Every fourth column has one value for all transcripts, the others one a transcript; some are '.'."""
    one = f"CASE WHEN (v + {i}) % 7 = 0 THEN '.' ELSE CAST((v * {i + 3}) % 1000 AS VARCHAR) END"
    two = f"CAST((v * {i + 5}) % 1000 AS VARCHAR)"
    first = one if i % 4 == 0 else f"CASE WHEN v % 3 = 0 THEN {one} ELSE {two} END"
    return f"CASE WHEN v % 2 = 0 AND v % 3 < 2 THEN nullif({first}, '.') END AS \"{name}\""


def score_rows(spark, d):
    """Packed scores of every even part's allele; every tenth allele has a second record that sorts later."""
    v = fx.variants(spark, d).where("v % 2 = 0")
    ids = F.concat(F.lit("T"), F.col("v").cast("string"), F.lit(";T"), (F.col("v") + 1).cast("string"))

    def packed(i):
        one = F.when((F.col("v") + i) % 7 == 0, F.lit(".")).otherwise(((F.col("v") * (i + 3)) % 1000).cast("string"))
        return one if i % 4 == 0 else F.concat(one, F.lit(";"), ((F.col("v") * (i + 5)) % 1000).cast("string"))

    rows = v.select("v", *osc.ALLELE_KEY, ids.alias("Ensembl_transcriptid"), *[packed(i).alias(c) for i, c in enumerate(osc.SCORE_COLUMNS)])
    again = rows.where("v % 10 = 0").withColumn(osc.SCORE_COLUMNS[0], F.lit("~"))
    return rows.unionByName(again).drop("v")


def splice_rows(spark, d, even: bool):
    v = fx.variants(spark, d).where((F.col("v") % 3 == 1) & ((F.col("v") % 2 == 0) == F.lit(even)))
    num = lambda k: F.format_string("%.2f", ((F.col("v") * k) % 100) / 100.0)       # noqa: E731
    zero = F.lit("0.00")
    mine = F.concat_ws("|", "alt", F.lit("GA"), num(3), zero, num(7), zero, *[F.lit("1")] * 4)
    other = F.concat_ws("|", "alt", F.lit("GB"), zero, num(11), zero, zero, *[F.lit("1")] * 4)
    alien = F.concat_ws("|", F.lit("NN"), F.lit("GC"), *[F.lit("1.00")] * 4, *[F.lit("1")] * 4)
    return v.select(*osc.ALLELE_KEY, F.concat_ws(",", alien, other, mine).alias("SpliceAI"))


@register("jn12b_scores_in_full", """
SELECT v, """ + ", ".join(_packed_sql(i, c) for i, c in enumerate(osc.SCORE_COLUMNS)) + """,
  CASE WHEN v % 3 = 1 THEN CASE WHEN (v * 11) % 100 > greatest((v * 3) % 100, (v * 7) % 100) THEN 'GB' ELSE 'GA' END END AS splice_gene,
  CASE WHEN v % 3 = 1 THEN greatest((v * 3) % 100, (v * 7) % 100, (v * 11) % 100) / 100.0 END AS splice_delta, go AS "GO"
FROM variants LEFT JOIN (
  SELECT p_brand AS gene, string_agg(DISTINCT 'GO:' || CAST(p_size % 9 AS VARCHAR), '&' ORDER BY 'GO:' || CAST(p_size % 9 AS VARCHAR)) AS go
  FROM part GROUP BY 1) USING (gene)""", ["variants"])
def jn12b(spark, d):
    """Stored score tables: 44 columns by transcript, SNV and indel splice tables together, terms by gene."""
    table = osc.write_scores(score_rows(spark, d), scratch_dir(spark, "scores"), ["Ensembl_transcriptid", *osc.SCORE_COLUMNS])
    splice = osc.splice_scores(splice_rows(spark, d, True), splice_rows(spark, d, False))
    stored = osc.write_scores(splice, scratch_dir(spark, "splice"), ["splice_gene", "splice_delta"])
    part = fx.table(spark, d, "part")
    terms = part.select(F.col("p_brand").alias("gene"), F.concat(F.lit("GO:"), (F.col("p_size") % 9).cast("string")).alias("go"))
    v = fx.variants(spark, d).select("v", *osc.ALLELE_KEY, "gene",
                                     F.concat(F.lit("T"), (F.col("v") + F.col("v") % 3).cast("string")).alias("transcript"))
    got = osc.annotate_all(spark, v, table, stored, terms, gene="gene")
    return got.select("v", *[f"`{c}`" for c in osc.SCORE_COLUMNS], "splice_gene", "splice_delta", "GO")


@register("jn14_variants_to_sets", f"""
SELECT a.unit, CAST(count(*) AS BIGINT) AS n
FROM (SELECT {SQL_VID} AS variant_id FROM variants WHERE filter = 'PASS') k
LEFT JOIN (SELECT {SQL_VID} AS variant_id, gene AS unit FROM variants WHERE v % 3 <> 0) a ON a.variant_id = k.variant_id
GROUP BY a.unit""", ["variants"])
def jn14(spark, d):
    v = fx.variants(spark, d).withColumn("variant_id", fi.variant_id())
    sets = v.where(F.col("v") % 3 != 0).select("variant_id", F.col("gene").alias("unit"))
    kept = v.where(F.col("filter") == "PASS").select("variant_id")
    return kept.join(sets, "variant_id", "left").groupBy("unit").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("jn15_model_frame", SQL_PCS + """
, ps AS (""" + PSAM_SQL.strip() + """)
SELECT ps.sample_id, ps."ALS", round(pcs."PC1", 6) AS "PC1", round(pcs."PC6", 6) AS "PC6"
FROM ps LEFT JOIN pcs ON ps.sample_id = pcs.sample_id""", ["pheno"])
def jn15(spark, d):
    mf = oj.model_frame(psam(spark, d).select("sample_id", "ALS"), zscored_pcs(spark, d))
    return mf.select("sample_id", "ALS", r6(F.col("PC1")).alias("PC1"), r6(F.col("PC6")).alias("PC6"))


@register("jn16_peg_gating", """
, peg AS (SELECT pid, min(day) AS fecha_indicacion_peg FROM visits WHERE peg GROUP BY pid)
SELECT v.pid, p.fecha_indicacion_peg,
       CAST(count(*) FILTER (WHERE v.day >= p.fecha_indicacion_peg) AS BIGINT) AS n_after
FROM visits v JOIN peg p ON v.pid = p.pid GROUP BY v.pid, p.fecha_indicacion_peg""", ["visits"])
def jn16(spark, d):
    from genoframe.operators.longitudinal import first_event_date
    v = fx.visits(spark, d)
    peg = first_event_date(v, "peg", "day", out="fecha_indicacion_peg")
    j = v.join(peg, "pid")
    return j.groupBy("pid", "fecha_indicacion_peg").agg(
        F.count(F.when(F.col("day") >= F.col("fecha_indicacion_peg"), 1)).cast("bigint").alias("n_after"))
