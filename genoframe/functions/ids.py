"""Identifier expressions: sample ids, biobank ids, variant ids, loci."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from genoframe.functions.common import col_of

# The ordered sample-id rewrites of the merged call set (pattern,
# replacement, replace-all).  Order matters: dash removal precedes rules that
# add a dash back.
SAMPLE_ID_REWRITES = [
    ("^EMADN", "EM", False),
    ("-ambBED$", "", False),
    ("-", "", True),
    ("EM044", "EM015-2", False),
    ("ELA1912ADN1", "ELA1912-2", False),
    ("ELA1923ADN1", "ELA1923-2", False),
    ("ELA1924ADN1", "ELA1924-2", False),
    ("ADN[12]$", "", False),
]


def replace_first(c: Column, pattern: str, repl: str) -> Column:
    """Replace only the first regex match (Spark's regexp_replace replaces all)."""
    # (?s) lets '.' cross newlines; the lazy prefix pins the first occurrence.
    return F.regexp_replace(c, f"(?s)^(.*?){pattern}", f"$1{repl}") if not pattern.startswith("^") \
        else F.regexp_replace(c, pattern, repl)


def normalize_sample_ids(c) -> Column:
    """PRJ-15: apply the sample-id rewrites in order (sed semantics)."""
    out = col_of(c)
    for pat, repl, all_ in SAMPLE_ID_REWRITES:
        out = F.regexp_replace(out, pat, repl) if all_ else replace_first(out, pat, repl)
    return out


def normalize_biobank_id(c) -> Column:
    """FN-1: drop spaces and dashes."""
    return F.regexp_replace(col_of(c), "[ -]", "")


def donor_id(c) -> Column:
    """FN-2: drop one trailing parenthesised group, then trim."""
    return F.trim(F.regexp_replace(col_of(c), r"\([^)]+\)$", ""))


def sample_id_clean(c) -> Column:
    """FN-3: drop the first '-?ADN[0-9]', the first '-ambBED', then all dashes."""
    out = replace_first(col_of(c), "-?ADN[0-9]", "")
    out = replace_first(out, "-ambBED", "")
    return F.regexp_replace(out, "-", "")


def variant_id(chrom="chrom", pos="pos", ref="ref", alt="alt") -> Column:
    """PRJ-13: 'CHROM:POS_REF_ALT'."""
    return F.concat(col_of(chrom), F.lit(":"), col_of(pos).cast("string"), F.lit("_"),
                    col_of(ref), F.lit("_"), col_of(alt))


def locus(chrom, start, stop) -> Column:
    """FN-25: 'chrom:start-stop'."""
    return F.concat(col_of(chrom), F.lit(":"), col_of(start).cast("string"), F.lit("-"),
                    col_of(stop).cast("string"))
