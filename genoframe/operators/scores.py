"""JN-12: precomputed score tables, stored by allele so that annotating moves the variants only.

``write_scores`` lays a table out in buckets of the allele key, sorted inside, one record per allele.
``annotate_stored`` joins variants to it: the score side has no exchange, however large it is. Columns
with one value per transcript stay packed in storage (``a;b;c`` beside the transcript ids) and are
resolved to the variant's own transcript, or unnested, after the join.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.operators.annotate import ALLELE_KEY
from genoframe.operators.joins import broadcast_if_small

# The functional-prediction columns taken from the score table.
SCORE_COLUMNS = [
    "SIFT_score", "SIFT_converted_rankscore", "SIFT_pred", "SIFT4G_score", "SIFT4G_converted_rankscore", "SIFT4G_pred",
    "Polyphen2_HDIV_pred", "Polyphen2_HDIV_rankscore", "Polyphen2_HVAR_score", "Polyphen2_HVAR_rankscore", "Polyphen2_HVAR_pred",
    "LRT_score", "LRT_converted_rankscore", "LRT_pred", "FATHMM_score", "FATHMM_converted_rankscore", "FATHMM_pred",
    "CADD_raw", "CADD_raw_rankscore", "CADD_phred", "MutationTaster_score", "MutationTaster_converted_rankscore",
    "MutationTaster_pred", "MetaLR_score", "MetaLR_rankscore", "MetaLR_pred", "MetaSVM_score", "MetaSVM_rankscore",
    "MetaSVM_pred", "MetaRNN_score", "MetaRNN_rankscore", "MetaRNN_pred", "REVEL_score", "REVEL_rankscore", "PROVEAN_score",
    "PROVEAN_converted_rankscore", "PROVEAN_pred", "GERP++_NR", "GERP++_RS", "GERP++_RS_rankscore", "phyloP100way_vertebrate",
    "phyloP100way_vertebrate_rankscore", "phastCons100way_vertebrate", "phastCons100way_vertebrate_rankscore"]
# The packed fields of a splice score, in order.
SPLICE_FIELDS = ["allele", "symbol", "ds_ag", "ds_al", "ds_dg", "ds_dl", "dp_ag", "dp_al", "dp_dg", "dp_dl"]
SPLICE_DELTAS = ["ds_ag", "ds_al", "ds_dg", "ds_dl"]


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def one_per_allele(scores: DataFrame, cols: Sequence[str], key: Sequence[str] = ALLELE_KEY) -> DataFrame:
    """Of repeated alleles the record that sorts first over ``cols`` (NULL first): the same one on every run."""
    best = F.min(F.struct(*[_c(c).alias(f"f{i}") for i, c in enumerate(cols)])).alias("_r")
    return scores.groupBy(*key).agg(best).select(*key, *[F.col("_r")[f"f{i}"].alias(c) for i, c in enumerate(cols)])


def write_scores(scores: DataFrame, path: str, cols: Sequence[str], buckets: int | None = None,
                 name: str | None = None, key: Sequence[str] = ALLELE_KEY) -> str:
    """Store ``cols`` by allele as a bucketed, sorted table under ``path``; returns the table's name.

    One file per bucket; the number of buckets defaults to ``spark.sql.shuffle.partitions``.
    """
    spark = scores.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = name or f"scores_{uuid.uuid4().hex[:12]}"
    rows = one_per_allele(scores, cols, key).repartition(n, *key)
    (rows.write.mode("overwrite").option("path", path).bucketBy(n, *key).sortBy(*key).saveAsTable(name))
    return name


def annotate_stored(variants: DataFrame, table: str, cols: Sequence[str] | None = None,
                    key: Sequence[str] = ALLELE_KEY) -> DataFrame:
    """Left join of variants to a stored score table on the allele (null keys match nothing)."""
    s = variants.sparkSession.table(table)
    return variants.join(s.select(*key, *[_c(c) for c in cols]) if cols else s, list(key), "left")


def _packed(value: Column) -> Column:
    return F.transform(F.split(value, ";"), lambda x: F.when(~x.isin(".", ""), x))


def for_transcript(value: Column, ids: Column, transcript: Column) -> Column:
    """The value of a packed column for one transcript; a single value holds for every listed transcript."""
    parts, at = _packed(value), F.array_position(F.split(ids, ";"), transcript)
    return F.when(at > 0, F.when(F.size(parts) == 1, parts[0]).otherwise(F.get(parts, (at - 1).cast("int"))))


def unnest_transcripts(df: DataFrame, cols: Sequence[str], ids: str = "Ensembl_transcriptid", out: str = "transcript") -> DataFrame:
    """One row per listed transcript with its own value of every packed column; a row without ids stays, with a NULL one."""
    d = df.withColumn(out, F.explode_outer(F.array_distinct(F.split(_c(ids), ";"))))
    return d.withColumns({c: for_transcript(_c(c), _c(ids), F.col(out)) for c in cols})


def splice_scores(snv: DataFrame, indel: DataFrame, packed: str = "SpliceAI", key: Sequence[str] = ALLELE_KEY) -> DataFrame:
    """Union of the two splice tables: allele, the gene of the largest change (ties: first by name) and its score.

    ``packed`` holds one ``allele|gene|...`` record per gene, comma-joined; records of other alleles are left out.
    """
    both = snv.select(*key, packed).unionByName(indel.select(*key, packed))
    parts = lambda x: F.split(x, r"\|")     # noqa: E731
    at = [SPLICE_FIELDS.index(f) for f in SPLICE_DELTAS]

    def one(x):
        delta = F.greatest(*[F.get(parts(x), i).try_cast("double") for i in at])
        return F.struct((-delta).alias("_n"), F.get(parts(x), 1).alias("gene"), delta.alias("delta"))

    own = F.filter(F.split(packed, ","), lambda x: F.get(parts(x), 0) == F.col("alt"))
    scored = F.filter(F.transform(own, one), lambda r: r["delta"].isNotNull())
    best = both.select(*key, F.explode(scored).alias("_s")).groupBy(*key).agg(F.min("_s").alias("_s"))
    return best.select(*key, F.col("_s.gene").alias("splice_gene"), F.col("_s.delta").alias("splice_delta"))


def with_gene_terms(df: DataFrame, terms: DataFrame, gene: str = "SYMBOL", term: str = "go", out: str = "GO") -> DataFrame:
    """Ontology terms of the row's gene, distinct and sorted; broadcast while the gene table is small."""
    t = terms.where(F.col(term).isNotNull()).groupBy(F.col(gene).alias("_g")).agg(
        F.array_join(F.array_sort(F.collect_set(term)), "&").alias(out))
    return df.join(broadcast_if_small(t), F.col(gene) == F.col("_g"), "left").drop("_g")


def annotate_all(spark: SparkSession, variants: DataFrame, table: str, splice_table: str, terms: DataFrame,
                 transcript: str = "transcript", gene: str = "SYMBOL", ids: str = "Ensembl_transcriptid") -> DataFrame:
    """JN-12 in full: 44 score columns of the variant's transcript, splice change, ontology terms of its gene."""
    v = annotate_stored(variants, table, [ids, *SCORE_COLUMNS])
    v = v.withColumns({c: for_transcript(_c(c), F.col(ids), F.col(transcript)) for c in SCORE_COLUMNS}).drop(ids)
    v = annotate_stored(v, splice_table)
    return with_gene_terms(v, terms, gene)
