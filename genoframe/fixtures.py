"""Genomics-shaped bindings derived from the driver's star-schema tables.

Every binding is a pure DataFrame expression over the parquet tables, so its
size grows with the scale factor and Catalyst prunes the columns it does not
use.  The same definitions are written as DuckDB SQL in ``genoframe.plans.sqlfixtures``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the bindings (must equal the SQL side).
BASES = ["A", "C", "G", "T"]
IMPACT_BY_TYPE = {"ECONOMY": "HIGH", "LARGE": "MODERATE", "MEDIUM": "MODERATE",
                  "PROMO": "LOW", "SMALL": "LOW", "STANDARD": "MODIFIER"}
POPULATIONS = ["afr", "ami", "amr", "asj", "eas", "fin", "mid", "nfe", "remaining", "sas"]
CLINSIG_TEXT = ["Pathogenic", "Likely_pathogenic", "Benign", "Uncertain_significance",
                "Pathogenic/Likely_pathogenic"]
ID_SUFFIXES = ["-ADN1", "-ambBED", "ADN2", ""]
N_SAMPLES = 100
ALS_SUBTYPES = ["ALS-S", "ALS-B", "ALS-R", "PLS", "PMA", "PBP", "FAS", "FLS"]


def lit_list(values):
    return F.array(*[F.lit(v) for v in values])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def chrom_of(cn: Column) -> Column:
    return (F.when(cn < 22, (cn + 1).cast("string"))
            .when(cn == 22, F.lit("X")).when(cn == 23, F.lit("Y")).otherwise(F.lit("MT")))


def _base(i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(b) for b in BASES]), (i + 1).cast("int"))


def _allele_cols(k: Column) -> list[Column]:
    return [chrom_of(k % 25).alias("chrom"),
            (F.lit(10000) + (k * 7919) % 1000000).alias("pos"),
            _base(k % 4).alias("ref"),
            _base((k % 4 + 1 + F.floor(k / 4) % 3) % 4).alias("alt")]


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bi-allelic SNV per part: v, chrom, pos, ref, alt, gene, cadd, impact, filter."""
    k = F.col("p_partkey")
    impact = F.create_map(*[x for kv in IMPACT_BY_TYPE.items() for x in map(F.lit, kv)])
    return table(spark, sf_dir, "part").select(
        k.alias("v"), *_allele_cols(k),
        F.col("p_brand").alias("gene"),
        F.col("p_size").cast("double").alias("cadd"),
        impact[F.col("p_type")].alias("impact"),
        F.when(k % 9 == 0, F.lit("LowQual")).otherwise(F.lit("PASS")).alias("filter"),
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse non-reference calls (v, s, dosage) before missingness is applied."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .groupBy(F.col("l_partkey").alias("v"), (F.col("o_custkey") % N_SAMPLES).alias("s"))
            .agg(F.max(F.when(F.col("l_quantity") > 25, 2).otherwise(1)).alias("dosage")))


def genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort genotypes: non-reference calls plus explicit missing calls (NULL dosage)."""
    c = calls(spark, sf_dir)
    miss = (F.col("v") * 31 + F.col("s") * 17) % 97 == 0
    return c.select("v", "s", F.when(miss, F.lit(None)).otherwise(F.col("dosage")).alias("dosage"))


def rare_genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thin subset of calls so that cohort allele frequencies are 0.5-3 %."""
    return calls(spark, sf_dir).where((F.col("v") * 13 + F.col("s")) % 41 == 0)


def cohort_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-reference calls of the whole cohort: every customer is a sample (s), so alleles are rare by themselves."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey).groupBy(F.col("l_partkey").alias("v"), F.col("o_custkey").alias("s"))
            .agg(F.max(F.when(F.col("l_quantity") > 25, 2).otherwise(1)).alias("dosage")))


def cohort_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sample per customer with orders: s, sample_id, a 0/1 trait, a measured trait and two covariates."""
    o = table(spark, sf_dir, "orders")
    s = F.col("s")
    return (o.groupBy(F.col("o_custkey").alias("s")).agg(F.avg("o_totalprice").alias("quant"), F.avg("o_orderkey").alias("c1"),
                                                         F.count(F.lit(1)).cast("double").alias("c2"))
            .select("s", F.concat(F.lit("C"), s.cast("string")).alias("sample_id"), F.when(s % 7 < 3, 1.0).otherwise(0.0).alias("case"),
                    F.round(F.col("quant") / 1000.0, 6).alias("QT"), "c1", "c2"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample dimension (s, sample_id) taken from the orders' customers."""
    s = (F.col("o_custkey") % N_SAMPLES)
    return (table(spark, sf_dir, "orders").select(s.alias("s")).distinct()
            .select("s", F.format_string("S%03d", F.col("s")).alias("sample_id")))


def pheno(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-sample phenotypes and raw covariates (before z-scoring)."""
    o = table(spark, sf_dir, "orders")
    s = F.col("o_custkey") % N_SAMPLES
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    agg = o.groupBy(s.alias("s")).agg(
        F.avg("o_totalprice").alias("quant"),
        F.avg("o_orderkey").alias("c1"),
        F.min("o_totalprice").alias("c2"),
        F.max("o_totalprice").alias("c3"),
        F.avg(day).alias("c4"),
        F.count(F.lit(1)).cast("double").alias("c5"),
        F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("c6"),
    )
    sc = F.col("s")
    return agg.select(
        "s",
        F.format_string("S%03d", sc).alias("sample_id"),
        F.when(sc % 10 == 0, F.lit(None)).otherwise(1 + sc % 2).cast("int").alias("status"),
        F.when(sc % 3 == 0, F.lit("M")).when(sc % 3 == 1, F.lit("F")).alias("sex"),
        F.when(sc % 4 == 0, F.lit("CONTROL")).when(sc % 4 == 1, F.lit("ALS"))
         .when(sc % 4 == 2, F.lit("MS")).alias("pheno"),
        F.element_at(lit_list(ALS_SUBTYPES), (sc % 8 + 1).cast("int")).alias("als_pheno"),
        F.element_at(lit_list(["SP", "NP", "FP"]), (sc % 3 + 1).cast("int")).alias("dfs_pc"),
        F.element_at(lit_list(["FP", "NP", "SP"]), (F.floor(sc / 3) % 3 + 1).cast("int")).alias("d50_pc"),
        F.element_at(lit_list(["RR", "SP", "PP"]), (F.floor(sc / 5) % 3 + 1).cast("int")).alias("ms_pheno"),
        "quant", "c1", "c2", "c3", "c4", "c5", "c6",
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ALSFRS-R-like visit series: one row per order, 13 items scored 0..4."""
    k = F.col("o_orderkey")
    items = {f"i{j}": F.floor(k / j) % 5 for j in range(1, 14)}
    total = sum(items[f"i{j}"] for j in range(1, 14) if j != 6)
    return table(spark, sf_dir, "orders").select(
        k.alias("_row"),
        F.col("o_custkey").alias("pid"),
        F.col("o_orderdate").cast("date").alias("day"),
        *[c.cast("int").alias(n) for n, c in items.items()],
        F.when(k % 13 == 0, F.lit(None)).otherwise(total).cast("int").alias("total"),
        (k % 11 == 0).alias("peg"),
        F.when(k % 17 == 0, F.floor(k / 17) % 5).cast("int").alias("kings_rec"),
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-patient dates: onset, diagnosis, birth (derived from the visit span)."""
    o = table(spark, sf_dir, "orders")
    first = o.groupBy(F.col("o_custkey").alias("pid")).agg(
        F.min(F.col("o_orderdate").cast("date")).alias("d0"),
        F.max(F.col("o_orderdate").cast("date")).alias("d1"))
    pid = F.col("pid")
    onset = F.date_sub(F.col("d0"), 200)
    return first.select(
        "pid",
        onset.alias("onset"),
        F.date_add(onset, (pid % 400).cast("int")).alias("diagnosis"),
        F.date_sub(onset, (F.lit(9000) + 17 * (pid % 900)).cast("int")).alias("birth"),
        F.when(pid % 4 == 0, F.date_add(F.col("d1"), (pid % 300).cast("int"))).alias("death"),
    )


def registry_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit dates as registry text: d-m-Y, 'NS/NC' tokens and Excel serials."""
    k = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    txt = (F.when(k % 10 == 0, F.lit("NS/NC"))
           .when(k % 10 == 1, F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string"))
           .otherwise(F.date_format(day, "dd-MM-yyyy")))
    return table(spark, sf_dir, "orders").select(
        k.alias("_row"), F.col("o_custkey").alias("pid"), txt.alias("fecha_visita"),
        F.when(k % 10 == 0, F.lit("NS/NC")).otherwise(F.col("o_totalprice").cast("string")).alias("peso"),
        F.col("o_orderpriority").alias("prioridad"))


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relapse episodes (patient, date) with a per-patient onset date."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id"), F.col("user_id").alias("patient_id"),
                    F.col("ts").cast("date").alias("date"))


def ms_onsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return (e.select(F.col("user_id").alias("patient_id")).distinct()
            .select("patient_id",
                    F.date_add(F.lit("2024-01-01").cast("date"),
                               (F.col("patient_id") % 10).cast("int")).alias("ms_onset")))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gnomAD-like site table keyed by allele, with per-population AC/AN."""
    k = F.col("p_partkey")
    size = F.col("p_size")
    cols = [
        *_allele_cols(k),
        F.concat(F.lit("rs"), k.cast("string"),
                 F.when(k % 5 == 0, F.concat(F.lit(",rs"), (k + 1).cast("string")))
                  .otherwise(F.lit(""))).alias("ID"),
        F.lit("PASS").alias("FILTER"),
        (size * (k % 4)).cast("bigint").alias("AC"),
        (100 * (k % 7)).cast("bigint").alias("AN"),
    ]
    for j, pop in enumerate(POPULATIONS, start=1):
        cols.append((size * ((k + j) % 4)).cast("bigint").alias(f"AC_{pop}"))
        cols.append((100 * ((k + j) % 7)).cast("bigint").alias(f"AN_{pop}"))
    return table(spark, sf_dir, "part").where(k % 3 != 0).select(*cols)


def clinvar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ClinVar/dbSNP-like site table keyed by allele."""
    k = F.col("p_partkey")
    sig = F.element_at(F.array(*[F.lit(x) for x in CLINSIG_TEXT]), (k % 5 + 1).cast("int"))
    return (table(spark, sf_dir, "part").where(k % 2 == 1)
            .select(*_allele_cols(k),
                    F.concat(F.lit("cv"), k.cast("string")).alias("ID"),
                    sig.alias("CLNSIG"),
                    F.concat(F.lit("disease_"), (k % 13).cast("string")).alias("CLNDN"),
                    F.when(k % 4 == 1, F.lit(".")).otherwise(
                        F.concat(F.lit("rs"), k.cast("string"))).alias("RS")))


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structural-variant-like intervals (one per supplier)."""
    k = F.col("s_suppkey")
    start = F.lit(10000) + (k * 104729) % 1000000
    return table(spark, sf_dir, "supplier").select(
        k.alias("sv_key"), chrom_of(k % 25).alias("chrom"),
        start.alias("start"), (start + 1000 * (k % 50)).alias("end"),
        F.col("s_name").alias("sv_name"), F.col("s_acctbal").alias("sv_score"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dbNSFP-like score lookup for every even part's allele."""
    k = F.col("v")
    return (variants(spark, sf_dir).where(k % 2 == 0)
            .select("chrom", "pos", "ref", "alt",
                    F.element_at(F.array(F.lit("D"), F.lit("T")), (F.floor(k % 4 / 2) + 1).cast("int"))
                     .alias("SIFT4G_pred"),
                    F.element_at(F.array(F.lit("D"), F.lit("P"), F.lit("B")), (k % 3 + 1).cast("int"))
                     .alias("Polyphen2_HVAR_pred"),
                    F.round((k % 97) / 3.0, 3).alias("CADD_phred"),
                    F.concat(F.lit("GO:"), F.format_string("%07d", k % 1000)).alias("GO")))


def csq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed per-transcript consequences 'SYMBOL|IMPACT|CADD|POLYPHEN|SIFT|SIFT4G' joined by ','."""
    imp = F.array(*[F.lit(x) for x in ["HIGH", "MODERATE", "LOW", "MODIFIER"]])
    v = variants(spark, sf_dir)

    def tx(j):
        kk = F.col("v") + j
        return F.concat_ws(
            "|", F.concat(F.lit("G"), (kk % 50).cast("string")),
            F.element_at(imp, (kk % 4 + 1).cast("int")),
            ((kk * 7) % 40).cast("string"),
            F.element_at(F.array(F.lit("D"), F.lit("P"), F.lit("B")), (kk % 3 + 1).cast("int")),
            F.element_at(F.array(F.lit("D"), F.lit("T")), ((kk + 1) % 2 + 1).cast("int")),
            F.element_at(F.array(F.lit("D"), F.lit("T")), (kk % 2 + 1).cast("int")))

    txs = F.transform(F.sequence(F.lit(0), (F.col("v") % 4).cast("int")), lambda j: tx(j))
    return v.select("v", "chrom", "pos", "ref", "alt", F.array_join(txs, ",").alias("csq"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Association-result-like table: v, chrom, pos, ref, alt, id, gene, beta, p."""
    k = F.col("p_partkey")
    pval = ((k * 7919) % 9973 + 1) / 9974.0
    return table(spark, sf_dir, "part").select(
        k.alias("v"), *_allele_cols(k), F.col("p_brand").alias("gene"),
        ((F.col("p_size") - 25) / 10.0).alias("beta"),
        F.when(k % 50 == 0, F.lit(None)).otherwise(pval).alias("p"),
    ).withColumn("id", F.concat_ws(":", "chrom", F.col("pos").cast("string")))


def raw_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unnormalised sample ids as they come out of a sequencing run."""
    c = F.col("c_custkey")
    prefix = F.when(F.floor(c / 4) % 2 == 0, F.lit("ELA-")).otherwise(F.lit("EMADN"))
    suffix = F.element_at(F.array(*[F.lit(x) for x in ID_SUFFIXES]), (c % 4 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select(
        c.alias("c_custkey"),
        F.concat(prefix, F.format_string("%03d", c), suffix).alias("raw_id"),
        F.col("c_nationkey"), F.col("c_mktsegment"), F.col("c_acctbal"))


def curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noiseless ALSFRS decay curves 48/(1+exp((t-D50)/Dx)) per customer."""
    pid = F.col("c_custkey")
    d50 = (20 + pid % 80).cast("double")
    dx = (2 + pid % 7).cast("double")
    t = F.explode(F.sequence(F.lit(0), F.lit(60), F.lit(6))).alias("t")
    base = table(spark, sf_dir, "customer").select(pid.alias("pid"), d50.alias("d50"), dx.alias("dx"), t)
    return base.select("pid", F.col("t").cast("double").alias("t"),
                       (48.0 / (1 + F.exp((F.col("t") - F.col("d50")) / F.col("dx")))).alias("total"))
