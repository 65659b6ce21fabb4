"""Recodes, conditionals, factors, safe casts and small code tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from genoframe.functions.common import col_of, lit_array, lit_map


def recode(c, mapping: dict, default=None) -> Column:
    """PRJ-7: look ``c`` up in ``mapping``; unmatched -> ``default`` (NULL by default).

    Keys may be tuples (several inputs to one output).
    """
    flat = {}
    for k, v in mapping.items():
        for kk in (k if isinstance(k, tuple) else (k,)):
            flat[kk] = v
    out = lit_map(flat)[col_of(c)]
    return out if default is None else F.coalesce(out, F.lit(default))


def case_when(branches: Sequence[tuple[Column, object]], default=None) -> Column:
    """PRJ-8: ordered conditions; a NULL condition counts as false."""
    out = None
    for cond, val in branches:
        v = val if isinstance(val, Column) else F.lit(val)
        out = F.when(F.coalesce(cond, F.lit(False)), v) if out is None else \
            out.when(F.coalesce(cond, F.lit(False)), v)
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(default))
    return out


def as_ordered(c, levels: Sequence) -> Column:
    """PRJ-9: position (1-based) of ``c`` in a closed ordered level set; else NULL."""
    pos = F.array_position(lit_array(levels), col_of(c))
    return F.when(pos > 0, pos.cast("int"))


def as_nominal(c, levels: Sequence) -> Column:
    """FN-30: keep values of a closed level set; anything else -> NULL."""
    x = col_of(c)
    return F.when(x.isin(list(levels)), x)


def na_if(c, token) -> Column:
    """PRJ-5: NULL where the value equals ``token``."""
    return F.nullif(col_of(c), F.lit(token))


def safe_double(c) -> Column:
    """FN-10: text -> DOUBLE, junk -> NULL."""
    return col_of(c).try_cast("double")


def safe_int(c) -> Column:
    """FN-10: text -> INT through DOUBLE ('1.0' -> 1), junk -> NULL."""
    return col_of(c).try_cast("double").try_cast("int")


def to_bool(c, true_tokens=("Sí", "Si", "Yes", "yes", "TRUE", "True", "true", "1", "T"),
            false_tokens=("No", "no", "FALSE", "False", "false", "0", "F")) -> Column:
    """FN-28: yes/no text or 0/1 -> BOOLEAN, anything else NULL."""
    x = col_of(c).cast("string")
    return F.when(x.isin(list(true_tokens)), F.lit(True)).when(x.isin(list(false_tokens)), F.lit(False))


def label_if_null(c, when_null: str, when_present: str) -> Column:
    """FN-29: a group label from the presence of an id."""
    return F.when(col_of(c).isNull(), F.lit(when_null)).otherwise(F.lit(when_present))


def sex_code(c, unknown=None) -> Column:
    """PRJ-22: M=1, F=2, else ``unknown`` (0 for covariates, NULL for sample files)."""
    return recode(c, {"M": 1, "F": 2}, default=unknown)


def binary01(c) -> Column:
    """PRJ-20: plink case/control 1/2 -> 0/1, else NULL."""
    return recode(c, {1: 0, 2: 1})


def dosage(gt) -> Column:
    """PRJ-21: unphased or phased diploid call -> alt dosage 0/1/2; anything else NULL."""
    g = col_of(gt)
    return (F.when(g.isin("0/0", "0|0"), F.lit(0))
            .when(g.isin("0/1", "1/0", "0|1", "1|0"), F.lit(1))
            .when(g.isin("1/1", "1|1"), F.lit(2)))


def chrom_ordinal(c) -> Column:
    """FN-18: '1'..'22' -> 1..22, X=23, Y=24, MT=25 (a 'chr' prefix is ignored)."""
    x = F.regexp_replace(col_of(c), "^chr", "")
    return F.coalesce(x.try_cast("int"), recode(x, {"X": 23, "Y": 24, ("MT", "M"): 25}))


# Clinical phenotype and site-of-onset recodes of registry text.
CLINICAL_SUBTYPE = {
    ("ELA Espinal", "ELA Bulbar", "ELA Respiratoria"): "ALS",
    "Atrofia Muscular Progresiva (AMP)": "PMA",
    "Esclerosis Lateral Primaria (ELP)": "PLS",
    "Parálisis bulbar progresiva": "PBP",
    "Flail arm": "Flail-Arm",
    "Flail leg": "Flail-Leg",
}
ONSET_SITE = {
    "ELA Respiratoria": "Respiratory",
    "Hemipléjica (Mills)": "Spinal",
    "Pseudopolineurítica": "Spinal",
    "Atrofia Muscular Progresiva (AMP)": "Spinal",
    ("ELA Espinal", "Flail arm", "Flail leg"): "Spinal",
    ("ELA Bulbar", "Parálisis bulbar progresiva"): "Bulbar",
}
# Phenotype at diagnosis -> sample-file code.
ALS_PHENOTYPE_CODE = {
    "ELA Bulbar": "ALS-B", "ELA Espinal": "ALS-S", "Monomiélica": "ALS-S",
    "ELA Respiratoria": "ALS-R", "Parálisis bulbar progresiva": "PBP", "Flail leg": "FLS",
    "Flail arm": "FAS", "Atrofia Muscular Progresiva (AMP)": "PMA",
    "Esclerosis Lateral Primaria (ELP)": "PLS",
}
# MS disease-course codes and their grouping.
MS_COURSE = {(1, 2): "RR", 3: "SP-NR", 4: "SP-R", 5: "PP-NR", (6, 7): "PP-R"}
MS_COURSE_GROUP = {"RR": "RR", ("SP-R", "SP-NR"): "SP", ("PP-R", "PP-NR"): "PP"}


def clinical_subtype(c) -> Column:
    """FN-26: registry phenotype -> ALS / PMA / PLS / ... with 'Other' as default."""
    return recode(c, CLINICAL_SUBTYPE, default="Other")


def onset_site(c) -> Column:
    """FN-26: registry phenotype -> Spinal / Bulbar / Respiratory (no default)."""
    return recode(c, ONSET_SITE)


def ms_course(c) -> Column:
    """FN-31: disease-course code 1..7 -> RR / SP-NR / SP-R / PP-NR / PP-R."""
    return recode(c, MS_COURSE)


def ms_course_group(c) -> Column:
    """FN-31: course -> RR / SP / PP."""
    return recode(c, MS_COURSE_GROUP)
