"""Row filters over variants, genotypes and samples."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

AUTOSOMES = [str(i) for i in range(1, 23)]


def filter_pass(variants: DataFrame, col: str = "filter") -> DataFrame:
    """FLT-1: keep FILTER = PASS."""
    return variants.where(F.col(col) == "PASS")


def maf_lt(variants: DataFrame, t: float, col: str = "maf") -> DataFrame:
    """FLT-2."""
    return variants.where(F.col(col) < t)


def maf_gt(variants: DataFrame, t: float, col: str = "maf") -> DataFrame:
    """FLT-3."""
    return variants.where(F.col(col) > t)


def tag_matches(variants: DataFrame, tag: str, rx: str) -> DataFrame:
    """FLT-4/5/6/8: tag matches a regular expression (NULL never matches)."""
    return variants.where(F.col(tag).rlike(rx))


def cadd_ge(variants: DataFrame, t: float, col: str = "cadd") -> DataFrame:
    """FLT-7."""
    return variants.where(F.col(col) >= t)


# Filter-name vocabulary -> (column, comparison).
FILTER_TOKENS = {
    "maf_lt": ("maf", "<"), "maf_gt": ("maf", ">"), "cadd": ("cadd", ">="),
    "impact": ("impact", "~"), "sift": ("sift_pred", "~"),
    "polyphen2": ("polyphen2_hvar_pred", "~"), "sift4g": ("sift4g_pred", "~"),
}


def filter_predicate(token: str, columns: dict[str, str] | None = None) -> Column:
    """One named filter ('impact_HIGH', 'cadd_20', 'maf_lt_0.01') -> predicate Column."""
    columns = columns or {}
    for name in sorted(FILTER_TOKENS, key=len, reverse=True):
        if token.startswith(name + "_"):
            col, op = FILTER_TOKENS[name]
            col = columns.get(name, col)
            arg = token[len(name) + 1:]
            c = F.col(col)
            if op == "~":
                return c.rlike(arg)
            v = float(arg)
            return {"<": c < v, ">": c > v, ">=": c >= v}[op]
    raise ValueError(f"unknown filter token: {token}")


def variant_filter(variants: DataFrame, expr: str, mode: str = "any",
                   columns: dict[str, str] | None = None) -> DataFrame:
    """FLT-9 / SET-3: 'a_or_b_or_c' over the named filters.

    mode='any'   one scan with an OR predicate (each variant at most once);
    mode='concat' one branch per filter, concatenated (a variant passing two
                 filters appears twice, as a concatenation of filter outputs does).
    """
    tokens = re.split(r"_or_", expr)
    preds = [filter_predicate(t, columns) for t in tokens]
    if mode == "any":
        cond = preds[0]
        for p in preds[1:]:
            cond = cond | p
        return variants.where(F.coalesce(cond, F.lit(False)))
    out = variants.where(preds[0])
    for p in preds[1:]:
        out = out.unionAll(variants.where(p))
    return out


def snps_only(variants: DataFrame) -> DataFrame:
    """FLT-15: single-base ref and alt, both in ACGT."""
    return variants.where(F.col("ref").rlike("^[ACGT]$") & F.col("alt").rlike("^[ACGT]$"))


def autosomes(variants: DataFrame, col: str = "chrom") -> DataFrame:
    """FLT-16: chromosomes 1-22 (a 'chr' prefix is accepted)."""
    return variants.where(F.regexp_replace(F.col(col), "^chr", "").isin(AUTOSOMES))


def region(df: DataFrame, chrom: str, start: int | None = None, end: int | None = None,
           col: str = "chrom") -> DataFrame:
    """FLT-22: one chromosome (optionally a span); partition-pruned on chrom-partitioned data."""
    cond = F.col(col) == chrom
    if start is not None:
        cond = cond & (F.col("pos") >= start)
    if end is not None:
        cond = cond & (F.col("pos") <= end)
    return df.where(cond)


def drop_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """FLT-10."""
    return df.dropna(subset=list(subset))


def between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """FLT-11: closed range."""
    return df.where(F.col(col).between(lo, hi))


def starts_with(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """FLT-12."""
    return df.where(F.col(col).startswith(prefix))


def not_equal(df: DataFrame, col: str, value) -> DataFrame:
    """FLT-13: inequality; NULL rows are dropped (3-valued logic)."""
    return df.where(F.col(col) != value)


def samples_by_pheno(samples: DataFrame, pheno: str, col: str = "pheno",
                     id_col: str = "sample_id") -> DataFrame:
    """FLT-14: ids of samples with a given phenotype label."""
    return samples.where(F.col(col) == pheno).select(id_col)


def require_pheno(samples: DataFrame, phenos: Sequence[str]) -> DataFrame:
    """FLT-21: samples whose listed phenotypes are all non-null."""
    return samples.dropna(subset=list(phenos))


def min_group(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """FLT-23: keep groups with at least k rows.

    Counts are a map-side-combined aggregate and the filter a semi join, so a hot
    key is never gathered into one task (AQE splits skewed join partitions)."""
    big = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k).select(*keys)
    return df.join(big, list(keys), "left_semi")


def significant(df: DataFrame, q: float = 0.05, col: str = "q_fdr") -> DataFrame:
    """FLT-24: keep results with q <= threshold."""
    return df.where(F.col(col) <= q)
