"""AG-12 by consequence terms: joined terms are ranked one by one, then the worst transcript is taken.

A transcript carries one term or several joined by ``&``. Its severity is that of its worst term; a variant's
worst transcript is the one of the worst severity, the first of them in the given order. Terms outside the list
rank below all of it, a transcript without terms below those. Everything is row-local: no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Consequence terms in the published order of severity, most severe first.
TERM_ORDER = [
    "transcript_ablation", "splice_acceptor_variant", "splice_donor_variant", "stop_gained", "frameshift_variant",
    "stop_lost", "start_lost", "transcript_amplification", "feature_elongation", "feature_truncation",
    "inframe_insertion", "inframe_deletion", "missense_variant", "protein_altering_variant",
    "splice_donor_5th_base_variant", "splice_region_variant", "splice_donor_region_variant",
    "splice_polypyrimidine_tract_variant", "incomplete_terminal_codon_variant", "start_retained_variant",
    "stop_retained_variant", "synonymous_variant", "coding_sequence_variant", "mature_miRNA_variant",
    "5_prime_UTR_variant", "3_prime_UTR_variant", "non_coding_transcript_exon_variant", "intron_variant",
    "NMD_transcript_variant", "non_coding_transcript_variant", "coding_transcript_variant", "upstream_gene_variant",
    "downstream_gene_variant", "TFBS_ablation", "TFBS_amplification", "TF_binding_site_variant",
    "regulatory_region_ablation", "regulatory_region_amplification", "regulatory_region_variant",
    "intergenic_variant", "sequence_variant"]


def term_rank(term: Column, order: Sequence[str] = TERM_ORDER) -> Column:
    """1 for the most severe term; len + 1 for a term that is not listed."""
    at = F.array_position(F.array(*[F.lit(t) for t in order]), term)
    return F.when(at > 0, at.cast("int")).otherwise(F.lit(len(order) + 1))


def worst_of(terms: Column, order: Sequence[str] = TERM_ORDER) -> Column:
    """(rank, term) of the worst of the ``&``-joined terms; rank len + 2 and no term where there is none."""
    known = F.filter(F.split(terms, "&"), lambda t: t != "")
    ranked = F.array_min(F.transform(known, lambda t: F.struct(term_rank(t, order).alias("rank"), t.alias("term"))))
    return F.coalesce(ranked, F.struct(F.lit(len(order) + 2).alias("rank"), F.lit(None).cast("string").alias("term")))


def worst_by_term(df: DataFrame, col: str = "transcripts", terms: str = "Consequence", out: str = "worst",
                  order: Sequence[str] = TERM_ORDER) -> DataFrame:
    """``df`` with the worst transcript (``out``), its worst term (``out``_term) and rank (``out``_rank).

    A null or empty transcript list gives NULLs. Transcripts of equal severity: the first.
    """
    def key(tx, i):
        w = worst_of(tx[terms], order)
        return F.struct(w["rank"].alias("rank"), i.alias("i"), w["term"].alias("term"))

    best = F.array_min(F.transform(F.col(col), key))
    got = df.withColumn("_best", best)
    return (got.withColumns({out: F.get(F.col(col), F.col("_best")["i"]), f"{out}_term": F.col("_best")["term"],
                             f"{out}_rank": F.col("_best")["rank"]}).drop("_best"))


def worst_by_gene(df: DataFrame, key: str = "v", col: str = "transcripts", gene: str = "SYMBOL",
                  terms: str = "Consequence", order: Sequence[str] = TERM_ORDER) -> DataFrame:
    """One row per variant and gene: that gene's worst transcript (``worst``), term and rank.

    Transcripts without a gene form one row with a NULL gene.
    """
    genes = df.select(key, F.col(col).alias("_all"),
                      F.explode(F.array_distinct(F.transform(F.col(col), lambda t: t[gene]))).alias(gene))
    own = genes.withColumn("_tx", F.filter("_all", lambda t: t[gene].eqNullSafe(F.col(gene)))).drop("_all")
    return worst_by_term(own, "_tx", terms, "worst", order).drop("_tx")
