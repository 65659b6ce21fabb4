"""Set operations and reshaping: unions, explodes, pivots, unpivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(a: DataFrame, b: DataFrame, fill_missing: bool = True) -> DataFrame:
    """SET-1: union by name; columns missing on one side become NULL."""
    return a.unionByName(b, allowMissingColumns=fill_missing)


def alternate_keys(df: DataFrame, keys: Sequence[str], as_: str) -> DataFrame:
    """SET-2: the table once under each key column, then distinct (one scan, no union)."""
    rest = [c for c in df.columns if c not in keys]
    return (df.select(F.explode(F.array(*[F.col(k) for k in keys])).alias(as_), *rest)
            .distinct())


def union_labelled(parts: Mapping[str, DataFrame], as_: str) -> DataFrame:
    """SET-5: union of labelled tables with the label as a column."""
    out = None
    for label, df in parts.items():
        d = df.withColumn(as_, F.lit(label))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def explode_delimited(df: DataFrame, col: str, sep: str) -> DataFrame:
    """SET-6: split a delimited value into one row per element."""
    import re
    return df.withColumn(col, F.explode(F.split(F.col(col), re.escape(sep))))


def to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "name",
            value: str = "value") -> DataFrame:
    """SET-9: wide -> long."""
    return df.unpivot(list(ids), list(cols), name, value)


def pivot_wider(df: DataFrame, keys: Sequence[str], names_from: str, values_from: str,
                levels: Sequence, prefix: str = "") -> DataFrame:
    """AG-11: long -> wide with fixed levels (no extra job to discover them)."""
    wide = df.groupBy(*keys).pivot(names_from, list(levels)).agg(F.first(values_from))
    return wide.toDF(*keys, *[f"{prefix}{lv}" for lv in levels])


def split_multiallelic(variants: DataFrame, genotypes: DataFrame, key: str = "rec") -> tuple[DataFrame, DataFrame]:
    """SET-7: one row per ALT allele; genotypes recoded to the allele's dosage.

    ``variants`` has (rec, chrom, pos, ref, alt='A,B,..'); ``genotypes`` has
    (rec, sample_id, gt).  Allele i's dosage is the count of i in the call.
    """
    v = variants.select("*", F.posexplode(F.split("alt", ",")).alias("_ai", "_alt"))
    v = v.withColumn("allele", F.col("_ai") + 1).drop("alt", "_ai").withColumnRenamed("_alt", "alt")
    alleles = F.split(F.regexp_replace("gt", r"\|", "/"), "/")
    g = genotypes.join(v.select(key, "allele"), key)
    dose = F.when(F.exists(alleles, lambda a: ~a.rlike("^[0-9]+$")), F.lit(None)).otherwise(
        F.size(F.filter(alleles, lambda a: a == F.col("allele").cast("string"))))
    return v, g.withColumn("dosage", dose)


def explode_csq(df: DataFrame, col: str = "transcripts", out: str = "tx") -> DataFrame:
    """SET-8: one row per transcript annotation."""
    return df.withColumn(out, F.explode(col))


def pca_pairs(pcs: DataFrame, pheno: DataFrame, id_col: str = "sample_id",
              n_pc: int = 10) -> DataFrame:
    """SET-10 / DP-6: PC columns -> plot pairs (PC1/PC2, PC3/PC4, ...)."""
    j = pcs.join(pheno, id_col, "inner")
    pairs = F.array(*[F.struct(F.lit(g).alias("grp"),
                               F.col(f"PC{2 * g + 1}").alias("ax0"),
                               F.col(f"PC{2 * g + 2}").alias("ax1"))
                      for g in range(n_pc // 2)])
    return (j.select(id_col, "pheno", F.inline(pairs))
            .withColumn("group_label", F.format_string("PC%d / PC%d", F.col("grp") * 2 + 1,
                                                       F.col("grp") * 2 + 2)))


def association_grid(spark, filters: Sequence[str], mafs: Sequence[float], phenos: Sequence[str],
                     units: Sequence[str], tests: Sequence[str]) -> DataFrame:
    """SET-11: the run grid as one small DataFrame (a product of short lists)."""
    rows = [(f, m, p, u, t) for f in filters for m in mafs for p in phenos for u in units for t in tests]
    return spark.createDataFrame(rows, "filter string, max_maf double, pheno string, unit string, test string")
