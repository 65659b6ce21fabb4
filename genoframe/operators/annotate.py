"""Variant annotation: exact-allele lookups, interval overlap, score tables.

A declarative ``AnnotationSpec`` (fields / names / ops, then post-ops in
order) mirrors an annotation config: ops are applied as aggregates when a key
matches several source rows, post-ops are any ``Column`` functions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.functions.annotation import allele_freq
from genoframe.operators.joins import broadcast_if_small

ALLELE_KEY = ["chrom", "pos", "ref", "alt"]

#: Parts that variants are spread over, at least, where each gets a list that grows with the source.
LIST_PARTS = 64
#: Ops whose values are such lists.
LIST_OPS = {"uniq", "concat"}


def _parts(df: DataFrame) -> int:
    return max(LIST_PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))

# op name -> aggregate over the source rows matching one key
_OPS: dict[str, Callable[[Column], Column]] = {
    "self": lambda c: F.first(c, ignorenulls=True),
    "first": lambda c: F.first(c, ignorenulls=True),
    "max": F.max,
    "min": F.min,
    "sum": F.sum,
    "mean": F.avg,
    "count": lambda c: F.count(c),
    "uniq": lambda c: F.array_join(F.array_sort(F.collect_set(c.cast("string"))), ","),
    "concat": lambda c: F.array_join(F.array_sort(F.collect_list(c.cast("string"))), ","),
}


@dataclass
class AnnotationSpec:
    """UDF-2: fields to take, their new names, one op per field, then post-ops.

    ``post`` is an ordered list of (name, fn, inputs): ``fn(*[col(i) for i in
    inputs])`` -> Column.  String fns 'div2' and 'max' are built in (UDF-1
    lets any Column function be passed instead).
    """
    fields: Sequence[str]
    names: Sequence[str]
    ops: Sequence[str] | None = None
    post: list[tuple[str, object, Sequence[str]]] = field(default_factory=list)


def _post_fn(fn) -> Callable[..., Column]:
    if fn == "div2":
        return lambda a, b: allele_freq(a, b)
    if fn == "max":
        return lambda *cs: F.greatest(*cs)
    return fn


def apply_post(df: DataFrame, post) -> DataFrame:
    """UDF-1: apply post-annotation functions in order (later ones may use earlier)."""
    for name, fn, inputs in post:
        df = df.withColumn(name, _post_fn(fn)(*[F.col(i) for i in inputs]))
    return df


def _project(source: DataFrame, spec: AnnotationSpec, key: Sequence[str],
             wanted: DataFrame | None = None) -> DataFrame:
    ops = list(spec.ops or ["self"] * len(spec.fields))
    src = source
    if "alt" in key and "alt" in source.columns:
        # multi-allelic site records: one row per ALT allele
        src = source.withColumn("alt", F.explode(F.split("alt", ",")))
    if wanted is not None:
        # keep only the alleles the cohort has: the semi join hash-partitions the source
        # on the key, so the de-duplication below reuses that partitioning
        src = src.join(wanted, list(key), "left_semi")
    if all(o == "self" for o in ops):
        # one record per allele in a site file: a plain projection, no aggregation
        return src.select(*key, *[F.col(f).alias(n) for f, n in zip(spec.fields, spec.names)]) \
            .dropDuplicates(list(key))
    return src.groupBy(*key).agg(*[_OPS[o](F.col(f)).alias(n)
                                   for f, n, o in zip(spec.fields, spec.names, ops)])


def annotate_exact(variants: DataFrame, source: DataFrame, spec: AnnotationSpec,
                   key: Sequence[str] = ALLELE_KEY) -> DataFrame:
    """JN-10: left join on the exact allele, renamed fields, then post-ops.

    A list over a key's source rows is the same on all variants of the key: these are brought together first (a key of many
    variants over several parts), so that a written file holds few different lists, each once in its dictionary.
    """
    ann = _project(source, spec, key, variants.select(*key).distinct())
    if LIST_OPS & set(spec.ops or ()):
        rest = [c for c in variants.columns if c not in key]
        variants = variants.repartitionByRange(_parts(variants), *key, *rest)
        ann = broadcast_if_small(ann)
    return apply_post(variants.join(ann, list(key), "left"), spec.post)


def annotate_overlap(variants: DataFrame, intervals: DataFrame, ops: dict[str, tuple[str, str]],
                     bin_width: int = 100_000, key: str = "v",
                     start: str = "start", end: str = "end") -> DataFrame:
    """JN-11: annotate each variant with aggregates over the intervals covering it.

    Intervals are exploded into fixed-width bins; a variant falls in exactly one
    bin, so the equi-join on (chrom, bin) plus the residual overlap test yields
    each (variant, interval) pair once, without a cartesian product. Variants are
    spread by ``key`` before they meet the intervals, whatever few bytes or files they
    are, so that their pairs are made and added up in place and in many tasks.
    ``ops`` maps output name -> (interval column, op).
    """
    variants = variants.repartition(_parts(variants), key)
    iv = intervals.withColumn("_bin", F.explode(F.sequence(
        F.floor(F.col(start) / bin_width).cast("bigint"),
        F.floor(F.col(end) / bin_width).cast("bigint"))))
    vb = variants.select(key, "chrom", "pos", F.floor(F.col("pos") / bin_width).cast("bigint").alias("_bin"))
    cols = sorted({c for c, _ in ops.values()})
    pairs = (vb.join(broadcast_if_small(iv.select("chrom", "_bin", start, end, *[c for c in cols if c not in (start, end)])),
                     ["chrom", "_bin"])
             .where((F.col("pos") >= F.col(start)) & (F.col("pos") <= F.col(end))))
    agg = pairs.groupBy(key).agg(*[_OPS[op](F.col(c)).alias(name) for name, (c, op) in ops.items()])
    return variants.join(agg, key, "left")


def annotate_scores(variants: DataFrame, scores: DataFrame, cols: Sequence[str],
                    key: Sequence[str] = ALLELE_KEY) -> DataFrame:
    """JN-12: precomputed per-allele scores (left join on the allele key).

    The score table is first semi-joined to the cohort's alleles, so its
    de-duplication and the final join reuse one hash partitioning on the key."""
    wanted = variants.select(*key).distinct()
    sc = scores.select(*key, *cols).join(wanted, list(key), "left_semi").dropDuplicates(list(key))
    return variants.join(sc, list(key), "left")


# Population labels of the frequency annotation.
GNOMAD_POPS = ["afr", "ami", "amr", "asj", "eas", "fin", "mid", "nfe", "remaining", "sas"]


def gnomad_spec() -> AnnotationSpec:
    """Nuclear-genome frequency annotation: ids, AC/AN per population, AF, max AF."""
    fields = ["ID", "FILTER", "AC", "AN"]
    names = ["gno_id", "gno_filter", "gno_ac_all", "gno_an_all"]
    for p in GNOMAD_POPS:
        fields += [f"AC_{p}", f"AN_{p}"]
        names += [f"gno_ac_{p}", f"gno_an_{p}"]
    post = [("gno_af_all", "div2", ["gno_ac_all", "gno_an_all"])]
    post += [(f"gno_af_{p}", "div2", [f"gno_ac_{p}", f"gno_an_{p}"]) for p in GNOMAD_POPS]
    post += [("max_aaf_all", "max", [f"gno_af_{p}" for p in GNOMAD_POPS])]
    return AnnotationSpec(fields, names, None, post)
