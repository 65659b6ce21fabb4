"""Annotation post-operations over site fields (row-local expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from genoframe.functions.common import col_of, lit_map

# ClinVar clinical-significance codes.
CLINSIG_CODES = {
    "0": "uncertain", "1": "not-provided", "2": "benign", "3": "likely-benign",
    "4": "likely-pathogenic", "5": "pathogenic", "6": "drug-response",
    "7": "histocompatibility", "255": "other", ".": ".",
}
# ClinVar allele-origin codes.
ORIGIN_CODES = {
    "0": "unknown", "1": "germline", "2": "somatic", "4": "inherited", "8": "paternal",
    "16": "maternal", "32": "de-novo", "64": "biparental", "128": "uniparental",
    "256": "not-tested", "512": "tested-inconclusive", "1073741824": "other",
}
AF_DIGITS = 9
COMMON_AF_CUTOFF = 0.005


def allele_freq(ac, an, digits: int = AF_DIGITS) -> Column:
    """FN-19: AC/AN rounded; 0 when AC = 0; NULL when AN is 0 or NULL."""
    a, n = col_of(ac), col_of(an)
    return F.when(a == 0, F.lit(0.0)).otherwise(F.round(a / F.when(n != 0, n), digits))


def max_pop_af(*afs) -> Column:
    """FN-20: maximum over population AFs, NULLs skipped."""
    return F.greatest(*[col_of(a) for a in afs])


def common_pathogenic(sig, max_af, cutoff: float = COMMON_AF_CUTOFF,
                      ignore_case: bool = False) -> Column:
    """FN-21: significance text contains 'pathogenic' and max AF > cutoff; NULL -> false."""
    s = col_of(sig)
    s = F.lower(s) if ignore_case else s
    return F.coalesce(s.contains("pathogenic") & (col_of(max_af) > cutoff), F.lit(False))


def merge_ids(*cols) -> Column:
    """FN-22: drop '.', empty and NULL ids, dedupe keeping first, ',' -> ';', join by ';'."""
    arr = F.filter(F.array(*[col_of(c) for c in cols]),
                   lambda x: x.isNotNull() & (x != ".") & (x != ""))
    return F.array_join(F.transform(F.array_distinct(arr), lambda x: F.regexp_replace(x, ",", ";")), ";")


def decode_clinsig(c) -> Column:
    """FN-23: decode significance codes through ',' and '|' nesting; unknown codes dropped.

    A value without '|' is looked up whole (so '5,2' has no decoding).
    """
    m = lit_map(CLINSIG_CODES)
    x = col_of(c)

    def inner(part):
        codes = F.filter(F.transform(F.split(part, r"\|"), lambda y: m[y]), lambda y: y.isNotNull())
        return F.when(~part.contains("|"), m[part]).otherwise(F.array_join(codes, "|"))

    outer = F.filter(F.transform(F.filter(F.split(x, ","), lambda y: y != ""), inner),
                     lambda y: y.isNotNull())
    return F.when(~x.contains("|"), m[x]).otherwise(F.array_join(outer, ","))


def decode_origin(c) -> Column:
    """FN-24: allele-origin code -> label."""
    return lit_map(ORIGIN_CODES)[col_of(c)]


def array_mean(a) -> Column:
    """FN-25: mean of a numeric array (NULL for an empty array)."""
    arr = col_of(a)
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x) / F.when(F.size(arr) > 0, F.size(arr))


def alt_ratio(ref_count, alt_count, digits: int = AF_DIGITS) -> Column:
    """FN-25: alt / (ref + alt), 0 when alt = 0."""
    r, a = col_of(ref_count), col_of(alt_count)
    return F.when(a == 0, F.lit(0.0)).otherwise(F.round(a / F.when(r + a != 0, r + a), digits))


def split_nonempty(c, sep: str) -> Column:
    """FN-25: split on a separator dropping empty fields."""
    import re
    return F.filter(F.split(col_of(c), re.escape(sep)), lambda y: y != "")


def contains_text(c, token: str) -> Column:
    """FN-25: plain substring test."""
    return col_of(c).contains(token)
