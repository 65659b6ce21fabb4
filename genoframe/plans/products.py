"""The tables behind the usual figures (QQ, Manhattan, volcano, top hits, scree, PCA pairs, ternary).

Every global ordering (ranks, BH q-values, quantiles) goes through
``operators.ordered`` so no step moves the whole result table into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from genoframe.functions.recode import chrom_ordinal
from genoframe.functions.stats import neg_log10
from genoframe.operators.columns import coalesce_any_of, effect_column
from genoframe.operators.ordered import bh_adjust, quantile_exact, rank_and_bh
from genoframe.operators.windows import head_by

NAME_COLS = ["id", "gene", "unit"]
P_COLS = ["permpvalue", "pvalue", "p"]
FDR_THRESHOLD = 0.05


def _named(results: DataFrame) -> DataFrame:
    return results.select("*", coalesce_any_of(results, NAME_COLS).alias("name"),
                          coalesce_any_of(results, P_COLS).alias("p_value"))


def qq(results: DataFrame, row: str = "_row") -> DataFrame:
    """DP-1: name, observed -log10 p, expected -log10(rank/(n+1)), BH q (first row per name)."""
    r = head_by(_named(results), ["name"], row).where(F.col("p_value").isNotNull())
    r = rank_and_bh(r, "p_value", "rank", "q_fdr", "_n")
    return r.select("name", neg_log10("p_value").alias("observed"),
                    (-F.log10(F.col("rank") / (F.col("_n") + 1))).alias("expected"), "q_fdr")


def manhattan(results: DataFrame, row: str = "_row") -> DataFrame:
    """DP-2: cumulative genome position per variant and BH q of the raw p (first row per locus)."""
    r = head_by(results, ["chrom", "pos", "alt"], row).withColumn("chrom_num", chrom_ordinal("chrom"))
    r = r.withColumn("p_value", coalesce_any_of(r, P_COLS))
    per_chrom = r.groupBy("chrom_num").agg(F.max("pos").alias("max_pos"))          # AG-3, <= #contigs rows
    w = Window.orderBy("chrom_num").rowsBetween(Window.unboundedPreceding, -1)     # WN-8 on <= #contigs rows
    offs = per_chrom.withColumn("pos_add", F.coalesce(F.sum("max_pos").over(w), F.lit(0)))
    r = r.join(F.broadcast(offs.select("chrom_num", "pos_add")), "chrom_num")
    r = r.withColumn("pos_acc", F.col("pos") + F.col("pos_add"))
    return bh_adjust(r, "p_value", "q_fdr")


def manhattan_axis(manhattan_df: DataFrame) -> DataFrame:
    """AG-4: axis centre per chromosome = mean cumulative position."""
    return manhattan_df.groupBy("chrom").agg(F.avg("pos_acc").alias("center"))


def manhattan_cut(manhattan_df: DataFrame, q: float = FDR_THRESHOLD) -> DataFrame:
    """AG-17 / FLT-24: largest p among significant results (the dashed line)."""
    return manhattan_df.where(F.col("q_fdr") <= q).agg(F.max("p_value").alias("max_sig_p"))


def volcano(results: DataFrame, row: str = "_row") -> DataFrame:
    """DP-3: effect, capped log10 p (cap = 1.2 x 0.99 quantile over all rows), BH q."""
    r = results.select("*", coalesce_any_of(results, P_COLS).alias("p_value"),
                       effect_column(results).alias("effect"))
    q99 = quantile_exact(r.select(F.log10("p_value").alias("lp")), "lp", 0.99)
    cap = F.lit(1.2 * q99 if q99 is not None else None).cast("double")
    r = r.withColumn("log_p", F.least(F.log10("p_value"), cap))
    r = head_by(r, ["chrom", "pos", "alt"], row).dropna(subset=["p_value", "effect"])
    return bh_adjust(r, "p_value", "q_fdr")


def top_hits(results: DataFrame, k: int = 20, row: str = "_row") -> DataFrame:
    """DP-4 / SO-6 / SO-7: BH over all named results first, then the k smallest p (ties by input
    order) with an ordinal of the label by -log10 p."""
    r = head_by(_named(results), ["name"], row).where(F.col("p_value").isNotNull())
    r = bh_adjust(r.withColumn("log_p", neg_log10("p_value")), "p_value", "q_fdr")
    top = r.orderBy("p_value", row).limit(k)                       # TakeOrderedAndProject
    w = Window.orderBy("log_p", "name")                            # on k rows
    return top.withColumn("ordinal", F.row_number().over(w)).select("name", "p_value", "log_p", "q_fdr", "ordinal")


def top_hits_by(results: DataFrame, by: Sequence[str], k: int = 20) -> DataFrame:
    """DP-4 of many result sets at once: BH, the k smallest p (ties by label) and the ordinal within each group of ``by``."""
    r = _named(results).where(F.col("p_value").isNotNull())
    r = bh_adjust(r.withColumn("log_p", neg_log10("p_value")), "p_value", "q_fdr", by=by)
    first = Window.partitionBy(*by).orderBy("p_value", "name")     # WindowGroupLimit: k rows a group and task go on
    top = r.withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= k)
    w = Window.partitionBy(*by).orderBy("log_p", "name")
    return top.withColumn("ordinal", F.row_number().over(w)).select(*by, "name", "p_value", "log_p", "q_fdr", "ordinal")


def scree(eigen: DataFrame, order: str = "pc") -> DataFrame:
    """DP-5 / AG-14 / WN-9 / WN-11: share of the listed eigenvalues, running share, < 0.9 flag.

    The eigenvalue table has one row per principal component (a handful)."""
    w = Window.orderBy(order)
    tot = Window.partitionBy()
    e = eigen.withColumn("explained_var", F.col("eigenval") / F.sum("eigenval").over(tot))
    e = e.withColumn("cum_var", F.sum("explained_var").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return e.withColumn("highlight", F.col("cum_var") < 0.9)
