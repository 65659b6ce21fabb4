"""Per-site and per-sample statistics over the sparse genotype table.

Genotypes are long and sparse: (variant, sample, dosage) rows exist only for
non-reference calls and for missing calls (NULL dosage).  Hom-ref counts are
implied: n_samples - non-ref - missing.  Every statistic is a grouped sum with
map-side partial aggregation; nothing is densified.
"""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genoframe.functions.common import lit_array


def n_of(samples) -> int:
    """Sample count from an int or a sample DataFrame (one count action)."""
    return samples if isinstance(samples, int) else samples.count()


def genotype_counts(genotypes: DataFrame, n_samples: int, key: str = "v") -> DataFrame:
    """Per-variant counts: n_het, n_hom_alt, n_missing, n_hom_ref (implied)."""
    d = F.col("dosage")
    g = genotypes.groupBy(key).agg(
        F.sum(F.when(d == 1, 1).otherwise(0)).cast("bigint").alias("n_het"),
        F.sum(F.when(d == 2, 1).otherwise(0)).cast("bigint").alias("n_hom_alt"),
        F.sum(F.when(d.isNull(), 1).otherwise(0)).cast("bigint").alias("n_missing"))
    return g.withColumn("n_hom_ref", F.lit(n_samples) - F.col("n_het") - F.col("n_hom_alt")
                        - F.col("n_missing"))


def fill_tags(genotypes: DataFrame, samples, key: str = "v", variants: DataFrame | None = None) -> DataFrame:
    """AG-7: NS, AN, AC, AF, MAF, AC_Hom, AC_Het and genotype counts per variant.

    With ``variants`` every site gets tags (sites without calls are all hom-ref).
    """
    n = n_of(samples)
    c = genotype_counts(genotypes, n, key)
    if variants is not None:
        c = variants.select(key).join(c, key, "left").select(
            key, *[F.coalesce(F.col(x), F.lit(0)).cast("bigint").alias(x)
                   for x in ("n_het", "n_hom_alt", "n_missing")],
            F.coalesce(F.col("n_hom_ref"), F.lit(n)).cast("bigint").alias("n_hom_ref"))
    ns = F.lit(n) - F.col("n_missing")
    ac = F.col("n_het") + 2 * F.col("n_hom_alt")
    an = 2 * ns
    af = ac / F.when(an > 0, an)
    return c.select(
        key, "n_hom_ref", "n_het", "n_hom_alt", "n_missing",
        ns.cast("bigint").alias("ns"), an.cast("bigint").alias("an"), ac.cast("bigint").alias("ac"),
        af.alias("af"), F.least(af, 1 - af).alias("maf"),
        (2 * F.col("n_hom_alt")).cast("bigint").alias("ac_hom"), F.col("n_het").alias("ac_het"))


# ---------------------------------------------------------------- HWE exact test
def hwe_exact_p_np(hom1: int, het: int, hom2: int) -> float:
    """Exact Hardy-Weinberg p-value (Wigginton et al. 2005) in log space."""
    import numpy as np
    n = hom1 + het + hom2
    if n <= 0:
        return float("nan")
    nr = het + 2 * min(hom1, hom2)
    xs = np.arange(nr % 2, nr + 1, 2, dtype=np.float64)
    homr = (nr - xs[:-1]) / 2.0
    homc = (2 * n - nr - xs[:-1]) / 2.0
    steps = np.log(4.0 * homr * homc) - np.log((xs[:-1] + 2.0) * (xs[:-1] + 1.0))
    lw = np.concatenate([[0.0], np.cumsum(steps)])
    lw -= lw.max()
    w = np.exp(lw)
    obs = lw[int((het - nr % 2) // 2)]
    return float(min(1.0, w[lw <= obs + 1e-9].sum() / w.sum()))


@F.pandas_udf(T.DoubleType())
def _hwe_p(a: pd.Series, h: pd.Series, b: pd.Series) -> pd.Series:
    key = pd.DataFrame({"a": a.astype("int64"), "h": h.astype("int64"), "b": b.astype("int64")})
    uniq = key.drop_duplicates()
    uniq = uniq.assign(p=[hwe_exact_p_np(int(x), int(y), int(z))
                          for x, y, z in zip(uniq["a"], uniq["h"], uniq["b"])])
    return key.merge(uniq, on=["a", "h", "b"], how="left")["p"]


def with_hwe_exact_p(df: DataFrame, hom1: str, het: str, hom2: str, out: str = "p_hwe") -> DataFrame:
    """Exact HWE p per row from genotype counts.

    The recurrence is sequential over het counts, which Spark's interpreted
    higher-order functions run slowly, so it is an Arrow-batched pandas UDF;
    count triples repeated inside a batch are solved once.  NaN (no calls) -> NULL.
    """
    p = _hwe_p(F.col(hom1), F.col(het), F.col(hom2))
    return df.withColumn(out, F.when(~F.isnan(p), p))


def hardy(genotypes: DataFrame, samples, key: str = "v") -> DataFrame:
    """AG-8: genotype counts, observed/expected heterozygosity and exact HWE p."""
    n = n_of(samples)
    c = genotype_counts(genotypes, n, key)
    called = F.col("n_hom_ref") + F.col("n_het") + F.col("n_hom_alt")
    alt_f = (F.col("n_het") + 2 * F.col("n_hom_alt")) / F.when(called > 0, 2 * called)
    c = c.select(key, "n_hom_ref", "n_het", "n_hom_alt", "n_missing",
                 (F.col("n_het") / F.when(called > 0, called)).alias("o_het"),
                 (2 * alt_f * (1 - alt_f)).alias("e_het"))
    return with_hwe_exact_p(c, "n_hom_ref", "n_het", "n_hom_alt")


def ternary(hardy_df: DataFrame, key: str = "v") -> DataFrame:
    """AG-18 / DP-7: AA/AB/BB frequencies per site and the HWE-curve residual."""
    tot = F.col("n_hom_ref") + F.col("n_het") + F.col("n_hom_alt")
    t = F.when(tot > 0, tot)
    aa, ab, bb = F.col("n_hom_ref") / t, F.col("n_het") / t, F.col("n_hom_alt") / t
    p = aa + ab / 2
    return hardy_df.select(key, aa.alias("aa"), ab.alias("ab"), bb.alias("bb"),
                           (ab - 2 * p * (1 - p)).alias("het_residual"))


# ---------------------------------------------------------------- missingness / QC
def sample_missing_rate(genotypes: DataFrame, n_variants: int, samples: DataFrame,
                        key: str = "s") -> DataFrame:
    """AG-9: missing calls / number of variants, for every sample (0 if none missing)."""
    m = genotypes.where(F.col("dosage").isNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_miss"))
    return (samples.select(key).join(m, key, "left")
            .select(key, (F.coalesce(F.col("n_miss"), F.lit(0)) / F.lit(float(n_variants))).alias("f_miss")))


def variant_missing_rate(genotypes: DataFrame, n_samples: int, variants: DataFrame,
                         key: str = "v") -> DataFrame:
    """AG-10: missing calls / number of samples, for every variant."""
    m = genotypes.where(F.col("dosage").isNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_miss"))
    return (variants.select(key).join(m, key, "left")
            .select(key, (F.coalesce(F.col("n_miss"), F.lit(0)) / F.lit(float(n_samples))).alias("f_miss")))


def mind(genotypes: DataFrame, variants: DataFrame, samples: DataFrame, t: float = 0.1,
         skey: str = "s", vkey: str = "v") -> tuple[DataFrame, DataFrame]:
    """FLT-17: drop samples whose missing rate exceeds t; returns (genotypes, samples)."""
    rate = sample_missing_rate(genotypes, variants.count(), samples, skey)
    keep = rate.where(F.col("f_miss") <= t).select(skey)
    return genotypes.join(keep, skey, "left_semi"), samples.join(keep, skey, "left_semi")


def geno(genotypes: DataFrame, variants: DataFrame, n_samples: int, t: float = 0.05,
         vkey: str = "v") -> tuple[DataFrame, DataFrame]:
    """FLT-18: drop variants whose missing rate exceeds t; returns (genotypes, variants)."""
    rate = variant_missing_rate(genotypes, n_samples, variants, vkey)
    keep = rate.where(F.col("f_miss") <= t).select(vkey)
    return genotypes.join(keep, vkey, "left_semi"), variants.join(keep, vkey, "left_semi")


def hwe_filter(genotypes: DataFrame, variants: DataFrame, n_samples: int, t: float = 1e-8,
               vkey: str = "v") -> tuple[DataFrame, DataFrame]:
    """FLT-19: drop variants with exact HWE p < t (variants without calls have p = 1)."""
    h = hardy(genotypes, n_samples, vkey).where(F.col("p_hwe") < t).select(vkey)
    return genotypes.join(h, vkey, "left_anti"), variants.join(h, vkey, "left_anti")


def maf_mac(tags: DataFrame, maf: float = 0.05, mac: int = 20) -> DataFrame:
    """FLT-20: MAF >= maf and minor allele count >= mac."""
    minor = F.least(F.col("ac"), F.col("an") - F.col("ac"))
    return tags.where((F.col("maf") >= maf) & (minor >= mac))


# ---------------------------------------------------------------- merge / sets
def merge_cohort(calls: DataFrame, sample: str = "sample_id") -> tuple[DataFrame, DataFrame]:
    """JN-9: merge per-sample call sets on exact alleles (absent = hom-ref).

    ``calls`` = (sample, chrom, pos, ref, alt, dosage) stacked over samples.
    Returns the distinct loci with their id and the sparse cohort genotypes.
    """
    from genoframe.functions.ids import variant_id
    loci = calls.select("chrom", "pos", "ref", "alt").distinct() \
        .withColumn("variant_id", variant_id())
    g = calls.where(F.col("dosage").isNull() | (F.col("dosage") > 0)) \
        .select(variant_id().alias("variant_id"), sample, "dosage")
    return loci, g


def set_sizes(sets: DataFrame, unit: str = "unit") -> DataFrame:
    """AG-16: variants per set; single-variant sets are flagged untestable."""
    return (sets.where(F.col(unit).isNotNull()).groupBy(unit)
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("testable", F.col("n") > 1))


# IMPACT severity, most severe first (consequence ranking).
IMPACT_ORDER = ["HIGH", "MODERATE", "LOW", "MODIFIER"]


def worst_consequence(df: DataFrame, col: str = "transcripts", impact: str = "IMPACT",
                      out: str = "worst") -> DataFrame:
    """AG-12: most severe transcript per variant; ties -> first transcript (row-local)."""
    ranks = lit_array(IMPACT_ORDER)

    def key(tx, i):
        r = F.array_position(ranks, tx[impact])
        r = F.when(r > 0, r).otherwise(F.lit(len(IMPACT_ORDER) + 1))
        return F.struct((r * 1_000_000 + i).alias("k"), tx.alias("tx"))

    return df.withColumn(out, F.array_min(F.transform(F.col(col), key))["tx"])
