"""Clinical score expressions over ALSFRS-R visits (row-local, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from genoframe.functions.common import col_of, safe_div
from genoframe.functions.recode import case_when

# The 13 recorded ALSFRS-R items, in form order.  Cutting food
# with and without a gastrostomy are alternatives, so the total uses 12.
ALSFRS_ITEMS = ["lenguaje", "salivacion", "deglucion", "escritura", "cortar_sin_peg",
                "cortar_con_peg", "vestido", "cama", "caminar", "subir_escaleras",
                "disnea", "ortopnea", "insuficiencia_respiratoria"]
ALSFRS_MAX = 48


def bmi(weight_kg, height_cm, digits: int = 1) -> Column:
    """FN-11: weight / (height in m)^2, rounded."""
    h = col_of(height_cm) / 100.0
    return F.round(safe_div(col_of(weight_kg), h * h), digits)


def rel_change(x, base) -> Column:
    """FN-11: (x - base) / base, e.g. relative weight loss."""
    return safe_div(col_of(x) - col_of(base), col_of(base))


def alsfrs_totals() -> dict[str, Column]:
    """FN-12: domain sub-totals, fine-motor remainder, then the range-checked total.

    The fine-motor remainder uses the recorded total *before* the 0..48 check,
    so callers must apply these in dict order (``withColumns`` keeps it).
    """
    c = F.col
    bulbar = c("lenguaje") + c("salivacion") + c("deglucion")
    gross = c("cama") + c("caminar") + c("subir_escaleras")
    resp = c("disnea") + c("ortopnea") + c("insuficiencia_respiratoria")
    return {
        "total_bulbar": bulbar,
        "total_motor_grosero": gross,
        "total_respiratorio": resp,
        "total_motor_fino": c("total") - bulbar - gross - resp,
    }


def checked_total(total="total") -> Column:
    """FN-12: total kept only inside 0..48."""
    t = col_of(total)
    return F.when(t.between(0, ALSFRS_MAX), t)


def progression_slope(total, months, digits: int = 1) -> Column:
    """FN-13: (48 - total) / months since onset; zero months -> NULL."""
    return F.round(safe_div(ALSFRS_MAX - col_of(total), col_of(months)), digits)


def mitos_stage() -> Column:
    """FN-14: MiToS = movement + swallowing + communication + breathing (3-valued logic)."""
    c = F.col
    movement = (c("caminar") <= 1) | (c("vestido") <= 1)
    swallowing = c("deglucion") <= 1
    communication = (c("lenguaje") <= 1) & (c("escritura") <= 1)
    breathing = (c("disnea") <= 1) | (c("insuficiencia_respiratoria") <= 2)
    return (movement.cast("int") + swallowing.cast("int") + communication.cast("int")
            + breathing.cast("int"))


def kings_stage(visit_date="fecha_visita", peg_date="fecha_indicacion_peg",
                recorded="kings") -> Column:
    """FN-15: King's stage; a recorded stage wins over the computed one."""
    c = F.col
    con, sin = c("cortar_con_peg"), c("cortar_sin_peg")
    regions = ((c("total_bulbar") < 12).cast("int")
               + ((c("escritura") < 4) | (sin < 4)).cast("int")
               + (c("caminar") < 4).cast("int"))
    computed = case_when([
        (col_of(peg_date).isNotNull() & (col_of(visit_date) >= col_of(peg_date)), F.lit(4)),
        ((con > 0) & (sin > 0), F.lit(None).cast("int")),
        ((con == 0) & (sin == 0), F.lit(None).cast("int")),
        ((con > 0) & (sin == 0), F.lit(4)),
        ((c("disnea") == 0) | (c("insuficiencia_respiratoria") < 4), F.lit(4)),
        (F.lit(True), regions),
    ])
    rec = col_of(recorded).try_cast("double").try_cast("int")
    rec = F.when(rec.between(0, 5), rec)
    return F.coalesce(rec, computed)


def cut3(x, lo: float, hi: float, below: str, middle: str, above: str) -> Column:
    """FN-16: three categories by closed middle band [lo, hi]."""
    v = col_of(x)
    return (F.when(v < lo, F.lit(below)).when(v.between(lo, hi), F.lit(middle))
            .when(v > hi, F.lit(above)))


def slope_category(x) -> Column:
    """FN-16: progression by ALSFRS slope: <0.5 SP, 0.5..1 NP, >1 FP."""
    return cut3(x, 0.5, 1, "SP", "NP", "FP")


def d50_category(x) -> Column:
    """FN-16: progression by D50 (months): <20 FP, 20..50 NP, >50 SP."""
    return cut3(x, 20, 50, "FP", "NP", "SP")
