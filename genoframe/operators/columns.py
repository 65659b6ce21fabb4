"""Column-level DataFrame operators: names, selections, schema-driven choices."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.functions.common import lit_map


def _ascii_fold(s: str) -> str:
    return unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii")


def _joined(text: str) -> str:
    """The runs of lower-case ASCII letters and digits, joined by an underscore."""
    return "_".join(re.findall("[a-z0-9]+", text))


def normalize_name(name: str) -> str:
    """PRJ-1: letters and digits of the ASCII-folded, lower-cased name, '_' between runs; '%' reads as the word pct."""
    return _joined(_ascii_fold(name).lower().replace("%", " pct "))


def registry_name(name: str) -> str:
    """PRJ-1 (registry variant): no folding; a name that does not start with a letter starts with '_'."""
    low = name.lower()
    body = _joined(low)
    return body if not body or "a" <= low[0] <= "z" else f"_{body}"


def normalize_names(df: DataFrame, fn: Callable[[str], str] = normalize_name) -> DataFrame:
    """PRJ-1: rename every column (metadata only, no data touched)."""
    return df.toDF(*[fn(c) for c in df.columns])


def select_columns(df: DataFrame, selector) -> list[str]:
    """Resolve a column selector: prefix 'starts:x', suffix 'ends:x', range 'a:b', regex, list."""
    cols = df.columns
    if isinstance(selector, (list, tuple, set)):
        return [c for c in cols if c in set(selector)]
    if callable(selector):
        return [c for c in cols if selector(c)]
    if selector.startswith("starts:"):
        return [c for c in cols if c.startswith(selector[7:])]
    if selector.startswith("ends:"):
        return [c for c in cols if c.endswith(selector[5:])]
    if selector.startswith("range:"):
        a, b = selector[6:].split(":")
        i, j = cols.index(a), cols.index(b)
        return cols[i:j + 1]
    if selector == "*":
        return list(cols)
    return [c for c in cols if re.fullmatch(selector, c)]


def across(df: DataFrame, selector, fn: Callable[[Column], Column],
           names: Callable[[str], str] | None = None) -> DataFrame:
    """PRJ-4 / UDF-3: apply ``fn`` to each selected column (in place, or to new names)."""
    chosen = select_columns(df, selector)
    return df.withColumns({(names(c) if names else c): fn(F.col(c)) for c in chosen})


def na_if_all(df: DataFrame, token, selector="*") -> DataFrame:
    """PRJ-5: a null token becomes NULL in every selected string column."""
    strings = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    chosen = [c for c in select_columns(df, selector) if c in strings]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(token)) for c in chosen})


def coalesce_any_of(df: DataFrame, names: Iterable[str]) -> Column:
    """PRJ-11: first non-null over whichever of ``names`` exist (NULL if none)."""
    present = [F.col(n) for n in names if n in df.columns]
    if not present:
        return F.lit(None)
    return F.coalesce(*present) if len(present) > 1 else present[0]


def effect_column(df: DataFrame) -> Column:
    """PRJ-12: log2(or) when an odds-ratio column exists, else beta; else an error."""
    if "or" in df.columns:
        return F.log2(F.when(F.col("or") > 0, F.col("or")))
    if "beta" in df.columns:
        return F.col("beta")
    raise ValueError("No effect size column found")


def query_fields(variants: DataFrame, fields: list[str], id_col: str = "variant_id") -> DataFrame:
    """PRJ-14: locus id plus selected fields."""
    return variants.select(id_col, *fields)


def rename_contigs(df: DataFrame, mapping: dict[str, str], col: str = "chrom") -> DataFrame:
    """PRJ-18: rename chromosomes by a lookup (unmapped names are kept)."""
    return df.withColumn(col, F.coalesce(lit_map(mapping)[F.col(col)], F.col(col)))


def ucsc_to_ensembl(contigs: Iterable[str]) -> dict[str, str]:
    """PRJ-18: 'chrN' -> 'N' and 'chrM' -> 'MT' for the given contig names."""
    return {f"chr{c}": ("MT" if c == "M" else c) for c in contigs}


def drop_format(genotypes: DataFrame, field: str) -> DataFrame:
    """PRJ-6: remove one per-genotype FORMAT field (a column or a map key)."""
    if field in genotypes.columns:
        return genotypes.drop(field)
    if "format" in genotypes.columns:
        return genotypes.withColumn("format", F.map_filter("format", lambda k, v: k != F.lit(field)))
    return genotypes


def rename_samples(genotypes: DataFrame, mapping: DataFrame, old: str = "raw_id",
                   new: str = "sample_id", col: str = "sample_id") -> DataFrame:
    """PRJ-16: replace sample ids through an (old, new) table; unmatched ids kept.

    The mapping has one row per sample (bounded by the cohort size), so it is
    broadcast.
    """
    m = mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    return (genotypes.join(F.broadcast(m), genotypes[col] == m["_old"], "left")
            .withColumn(col, F.coalesce(F.col("_new"), F.col(col))).drop("_old", "_new"))


def split_csq(df: DataFrame, fields: list[str], types: dict[str, str] | None = None,
              col: str = "csq", out: str = "transcripts") -> DataFrame:
    """PRJ-23: packed 'a|b|c,a|b|c' -> ARRAY<STRUCT<fields...>> with typed sub-fields."""
    types = types or {}

    def one(tx: Column) -> Column:
        parts = F.split(tx, r"\|")
        return F.struct(*[
            (F.nullif(F.get(parts, i), F.lit("")).try_cast(types.get(f, "string"))).alias(f)
            for i, f in enumerate(fields)])

    return df.withColumn(out, F.transform(F.split(F.col(col), ","), one))
