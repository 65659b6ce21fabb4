"""Longitudinal registry operators: stage dates, baselines, durations, relapse rates.

All of them are keyed by patient: one shuffle on the patient id, then
per-patient windows or pivots.  Stage dates are a pivot with fixed levels
followed by a backward fill across the pivoted columns (reaching stage k+1
implies having passed stage k), so no per-row window is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from genoframe.functions.dates import DAYS_PER_YEAR
from genoframe.operators.windows import first_by


def stage_dates(visits: DataFrame, patients: DataFrame, stage: str, date: str,
                prefix: str, levels: Sequence[int] = (1, 2, 3, 4), pid: str = "pid") -> DataFrame:
    """AG-2: earliest date each patient reached each stage, empty stages filled upward.

    Every patient of ``patients`` gets a row (stages never seen stay NULL).
    """
    lv = list(levels)
    first = (visits.where(F.col(stage).isNotNull() & (F.col(stage) > 0) & F.col(stage).isin(lv))
             .groupBy(pid).pivot(stage, lv).agg(F.min(date)))
    first = first.toDF(pid, *[f"_d{x}" for x in lv])
    filled = {f"{prefix}{x}": F.coalesce(*[F.col(f"_d{y}") for y in lv[i:]]) for i, x in enumerate(lv)}
    return (patients.select(pid).join(first, pid, "left")
            .select(pid, *[c.alias(n) for n, c in filled.items()]))


def stage_durations(dates_wide: DataFrame, onset: DataFrame, prefix: str, out_prefix: str,
                    levels: Sequence[int] = (1, 2, 3, 4), pid: str = "pid",
                    onset_col: str = "onset") -> DataFrame:
    """WN-7: days spent in each stage = next stage date - this stage date.

    Stage 1 counts from onset; no next date or the same date as the next -> NULL.
    Stages are ordered by date (NULL last) then stage number.
    """
    lv = [str(x) for x in levels]
    long = (dates_wide.join(onset.select(pid, onset_col), pid, "left")
            .unpivot([pid, onset_col], [f"{prefix}{x}" for x in lv], "_stage", "_date")
            .withColumn("_stage", F.regexp_replace("_stage", f"^{prefix}", "")))
    w = Window.partitionBy(pid).orderBy(F.col("_date").asc_nulls_last(), F.col("_stage").cast("int"))
    nxt = F.lead("_date").over(w)
    dur = (F.when(nxt.isNull(), F.lit(None))
           .when(F.col("_date") == nxt, F.lit(None))
           .when(F.col("_stage") == "1", F.datediff(nxt, F.col(onset_col)))
           .otherwise(F.datediff(nxt, F.col("_date"))))
    long = long.withColumn("_dur", dur)
    return (long.groupBy(pid).pivot("_stage", lv).agg(F.first("_dur"))
            .toDF(pid, *[f"{out_prefix}{x}" for x in lv]))


def baseline(visits: DataFrame, measure: str, cols: dict[str, str], date: str = "fecha_visita",
             pid: str = "pid", tiebreak: Sequence[str] = ("_row",)) -> DataFrame:
    """WN-1b: first visit (by date) with a non-null ``measure``; columns renamed."""
    v = visits.where(F.col(measure).isNotNull())
    tb = [t for t in tiebreak if t in visits.columns]
    firsts = first_by(v, [pid], [date], tiebreak=tb)
    return firsts.select(pid, *[F.col(c).alias(a) for c, a in cols.items()])


def first_event_date(df: DataFrame, flag: str, date: str, pid: str = "pid", out: str = "first_date") -> DataFrame:
    """JN-16 helper: earliest flagged date per patient (ties collapse to one value)."""
    return df.where(F.col(flag)).groupBy(pid).agg(F.min(date).alias(out))


def relapse_rates(onsets: DataFrame, episodes: DataFrame, pid: str = "patient_id",
                  onset: str = "ms_onset", date: str = "date",
                  year_days: float = DAYS_PER_YEAR) -> DataFrame:
    """AG-1 / JN-13: episodes within 1 year of onset, and within 3 years / 3.

    No lower bound (episodes before onset count); patients without episodes get 0.
    """
    j = onsets.select(pid, onset).join(episodes.select(pid, date), pid, "left")
    d = F.datediff(F.col(date), F.col(onset))
    return j.groupBy(pid).agg(
        F.sum(F.when(d <= year_days, 1).otherwise(0)).cast("double").alias("arr_y1"),
        (F.sum(F.when(d <= 3 * year_days, 1).otherwise(0)) / 3.0).alias("arr_y3"))
