"""Registered analyses: longitudinal registries (AG-1/2, WN-*, SET-1/2/5/6/9, SO-2..5, AG-5/6/11, PRJ-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoframe import fixtures as fx
from genoframe.functions import clinical as fc
from genoframe.functions import dates as fd
from genoframe.operators import longitudinal as ol
from genoframe.operators import reshape as ors
from genoframe.operators import windows as ow
from genoframe.plans.phenotypes import output_schema
from genoframe.plans.q_columns import SQL_ALSFRS, SQL_KINGS, alsfrs, kings_visits, r6
from genoframe.plans.registry import register


@register("ag01_relapse_rates", """
SELECT m.patient_id,
  CAST(sum(CASE WHEN datediff('day', m.ms_onset, e.date) <= 1 THEN 1 ELSE 0 END) AS DOUBLE) AS arr_y1,
  round(sum(CASE WHEN datediff('day', m.ms_onset, e.date) <= 3 THEN 1 ELSE 0 END) / 3.0, 6) AS arr_y3
FROM ms_onsets m LEFT JOIN episodes e ON e.patient_id = m.patient_id GROUP BY m.patient_id""",
          ["ms_onsets", "episodes"])
def ag01(spark, d):
    r = ol.relapse_rates(fx.ms_onsets(spark, d), fx.episodes(spark, d), year_days=1.0)
    return r.withColumn("arr_y3", r6(F.col("arr_y3")))


def mitos_dates(spark, d):
    a = alsfrs(spark, d).withColumn("mitos", fc.mitos_stage())
    return ol.stage_dates(a, fx.patients(spark, d), "mitos", "fecha_visita", "fecha_mitos_")


def kings_dates(spark, d):
    return ol.stage_dates(kings_visits(spark, d), fx.patients(spark, d), "kings", "fecha_visita", "fecha_kings_")


def _stage_sql(src: str, stage: str, prefix: str) -> str:
    return f"""
, st AS (SELECT pid, {stage} AS stage, min(fecha_visita) AS d FROM {src}
         WHERE {stage} > 0 AND {stage} IN (1, 2, 3, 4) GROUP BY 1, 2)
, wide AS (SELECT pid, min(d) FILTER (WHERE stage = 1) AS d1, min(d) FILTER (WHERE stage = 2) AS d2,
                  min(d) FILTER (WHERE stage = 3) AS d3, min(d) FILTER (WHERE stage = 4) AS d4 FROM st GROUP BY pid)
, dates AS (SELECT p.pid, coalesce(d1, d2, d3, d4) AS {prefix}1, coalesce(d2, d3, d4) AS {prefix}2,
                   coalesce(d3, d4) AS {prefix}3, d4 AS {prefix}4
            FROM patients p LEFT JOIN wide w ON p.pid = w.pid)"""


SQL_MITOS = SQL_ALSFRS + """
, mit AS (SELECT *, CAST(((caminar <= 1) OR (vestido <= 1)) AS INTEGER) + CAST((deglucion <= 1) AS INTEGER)
  + CAST(((lenguaje <= 1) AND (escritura <= 1)) AS INTEGER)
  + CAST(((disnea <= 1) OR (insuficiencia_respiratoria <= 2)) AS INTEGER) AS mitos FROM alsfrs)"""


register("ag02_mitos_stage_dates", SQL_MITOS + _stage_sql("mit", "mitos", "fecha_mitos_") + "\nSELECT * FROM dates",
         ["visits", "patients"])(mitos_dates)
register("ag02b_kings_stage_dates", SQL_KINGS + _stage_sql("kings", "kings", "fecha_kings_") + "\nSELECT * FROM dates",
         ["visits", "patients"])(kings_dates)


@register("wn07_stage_durations", SQL_KINGS + _stage_sql("kings", "kings", "fecha_kings_") + """
, lng AS (SELECT d.pid, p.onset, x.stage, x.dt FROM dates d JOIN patients p ON d.pid = p.pid,
          LATERAL (SELECT unnest([1, 2, 3, 4]) AS stage,
                          unnest([fecha_kings_1, fecha_kings_2, fecha_kings_3, fecha_kings_4]) AS dt) x)
, ld AS (SELECT *, lead(dt) OVER (PARTITION BY pid ORDER BY dt NULLS LAST, stage) AS nxt FROM lng)
, du AS (SELECT pid, stage, CASE WHEN nxt IS NULL THEN NULL WHEN dt = nxt THEN NULL
                               WHEN stage = 1 THEN datediff('day', onset, nxt) ELSE datediff('day', dt, nxt) END AS dur
         FROM ld)
SELECT pid, CAST(max(dur) FILTER (WHERE stage = 1) AS INTEGER) AS duracion_kings_1,
       CAST(max(dur) FILTER (WHERE stage = 2) AS INTEGER) AS duracion_kings_2,
       CAST(max(dur) FILTER (WHERE stage = 3) AS INTEGER) AS duracion_kings_3,
       CAST(max(dur) FILTER (WHERE stage = 4) AS INTEGER) AS duracion_kings_4
FROM du GROUP BY pid""", ["visits", "patients"])
def wn07(spark, d):
    return ol.stage_durations(kings_dates(spark, d), fx.patients(spark, d), "fecha_kings_", "duracion_kings_")


@register("wn01_first_by", """
SELECT pid, _row, day FROM (SELECT pid, _row, day, row_number() OVER (PARTITION BY pid ORDER BY day, _row) AS rn
                            FROM visits) WHERE rn = 1""", ["visits"])
def wn01(spark, d):
    return ow.first_by(fx.visits(spark, d), ["pid"], ["day"], tiebreak=["_row"]).select("pid", "_row", "day")


SQL_SLOPE = SQL_ALSFRS + """
, sl AS (SELECT a.*, round((48 - a.total) / nullif(CAST(datediff('day', p.onset, a.fecha_visita) AS DOUBLE) / 30.4375, 0), 1)
           AS delta_fs FROM alsfrs a JOIN patients p ON a.pid = p.pid)"""


def slope_visits(spark, d):
    a = alsfrs(spark, d).join(fx.patients(spark, d).select("pid", "onset", "diagnosis"), "pid")
    return a.withColumn("delta_fs", fc.progression_slope("total", fd.months_between_avg("fecha_visita", "onset", None)))


@register("wn01b_baseline_slope", SQL_SLOPE + """
SELECT pid, fecha_visita AS fecha_deltafs, delta_fs,
  CASE WHEN delta_fs < 0.5 THEN 'SP' WHEN delta_fs BETWEEN 0.5 AND 1 THEN 'NP' WHEN delta_fs > 1 THEN 'FP' END
    AS categoria_progresion
FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY fecha_visita, _row) AS rn FROM sl
      WHERE delta_fs IS NOT NULL) WHERE rn = 1""", ["visits", "patients"])
def wn01b(spark, d):
    b = ol.baseline(slope_visits(spark, d), "delta_fs", {"fecha_visita": "fecha_deltafs", "delta_fs": "delta_fs"})
    return b.withColumn("categoria_progresion", fc.slope_category("delta_fs"))


@register("wn02_first_with_ties", """
SELECT pid, _row FROM (SELECT pid, _row, rank() OVER (PARTITION BY pid ORDER BY day) AS rk FROM visits WHERE peg)
WHERE rk = 1""", ["visits"])
def wn02(spark, d):
    v = fx.visits(spark, d).where("peg")
    return ow.first_by(v, ["pid"], ["day"], ties=True).select("pid", "_row")


@register("wn03_head_by", """
SELECT name, _row FROM (SELECT coalesce(id, gene) AS name, v AS _row,
                               row_number() OVER (PARTITION BY coalesce(id, gene) ORDER BY v) AS rn FROM results)
WHERE rn = 1""", ["results"])
def wn03(spark, d):
    r = fx.results(spark, d).select(F.coalesce("id", "gene").alias("name"), F.col("v").alias("_row"))
    return ow.head_by(r, ["name"], "_row")


SQL_NUTRI = """
, nutri AS (SELECT _row, pid, day, CASE WHEN _row % 4 = 0 THEN round(total / 3.0, 3) END AS peso_premorbido FROM visits)"""


def _nutri(spark, d):
    v = fx.visits(spark, d)
    return v.select("_row", "pid", "day", F.when(F.col("_row") % 4 == 0, F.round(F.col("total") / 3.0, 3))
                    .alias("peso_premorbido"))


@register("wn04_fill_down", SQL_NUTRI + """
SELECT _row, last_value(peso_premorbido IGNORE NULLS) OVER (PARTITION BY pid ORDER BY day, _row
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peso_premorbido FROM nutri""", ["visits"])
def wn04(spark, d):
    return ow.fill_down(_nutri(spark, d), ["pid"], ["day", "_row"], ["peso_premorbido"]).select("_row", "peso_premorbido")


@register("wn05_fill_up", SQL_NUTRI + """
SELECT _row, first_value(peso_premorbido IGNORE NULLS) OVER (PARTITION BY pid ORDER BY day, _row
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS peso_premorbido FROM nutri""", ["visits"])
def wn05(spark, d):
    return ow.fill_up(_nutri(spark, d), ["pid"], ["day", "_row"], ["peso_premorbido"]).select("_row", "peso_premorbido")


@register("wn06_fill_downup", SQL_NUTRI + """
SELECT _row, coalesce(
  last_value(peso_premorbido IGNORE NULLS) OVER (PARTITION BY pid ORDER BY day, _row ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(peso_premorbido IGNORE NULLS) OVER (PARTITION BY pid ORDER BY day, _row ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
  AS peso_premorbido FROM nutri""", ["visits"])
def wn06(spark, d):
    return ow.fill_downup(_nutri(spark, d), ["pid"], ["day", "_row"], ["peso_premorbido"]).select("_row", "peso_premorbido")


@register("wn13_group_count", """
SELECT _row, CAST(count(*) OVER (PARTITION BY pid) AS BIGINT) AS n FROM visits""", ["visits"])
def wn13(spark, d):
    return ow.group_count(fx.visits(spark, d), ["pid"]).select("_row", F.col("n").cast("bigint"))


@register("ag05_n_distinct", """
SELECT CAST(count(DISTINCT pid) AS BIGINT) AS n_patients FROM visits WHERE total BETWEEN 1 AND 48""", ["visits"])
def ag05(spark, d):
    v = fx.visits(spark, d).where(F.col("total").between(1, 48))
    return v.agg(F.countDistinct("pid").cast("bigint").alias("n_patients"))


@register("ag06_distinct", "SELECT DISTINCT pid, peg FROM visits", ["visits"])
def ag06(spark, d):
    return fx.visits(spark, d).select("pid", "peg").distinct()


@register("ag11_pivot_wider", SQL_MITOS + """
SELECT pid, """ + ", ".join(f"CAST(count(*) FILTER (WHERE mitos = {k}) AS BIGINT) AS n_mitos_{k}" for k in range(5)) + """
FROM mit GROUP BY pid""", ["visits"])
def ag11(spark, d):
    a = alsfrs(spark, d).withColumn("mitos", fc.mitos_stage())
    counts = a.groupBy("pid", "mitos").agg(F.count(F.lit(1)).alias("n"))
    w = ors.pivot_wider(counts, ["pid"], "mitos", "n", [0, 1, 2, 3, 4], prefix="n_mitos_")
    return w.select("pid", *[F.coalesce(F.col(f"n_mitos_{k}"), F.lit(0)).cast("bigint").alias(f"n_mitos_{k}")
                             for k in range(5)])


@register("set01_union_fill", """
SELECT pid, onset, NULL::DOUBLE AS arr_y1 FROM patients
UNION ALL SELECT patient_id AS pid, NULL::DATE AS onset, 1.0 AS arr_y1 FROM ms_onsets""", ["patients", "ms_onsets"])
def set01(spark, d):
    a = fx.patients(spark, d).select("pid", "onset")
    b = fx.ms_onsets(spark, d).select(F.col("patient_id").alias("pid"), F.lit(1.0).alias("arr_y1"))
    return ors.union_all(a, b)


@register("set02_alternate_keys", """
SELECT DISTINCT k AS nhc, c_mktsegment FROM customer, LATERAL (SELECT unnest([c_custkey, c_nationkey + 100000]) AS k)""")
def set02(spark, d):
    c = fx.table(spark, d, "customer").select("c_custkey", (F.col("c_nationkey") + 100000).cast("bigint").alias("alt"),
                                              "c_mktsegment")
    return ors.alternate_keys(c, ["c_custkey", "alt"], "nhc")


@register("set05_union_labelled", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'ELA' WHEN 'O' THEN 'CONTROL' ELSE 'OTRO' END AS grupo FROM orders
WHERE o_orderstatus IN ('F', 'O', 'P')""")
def set05(spark, d):
    o = fx.table(spark, d, "orders")
    parts = {"ELA": o.where(F.col("o_orderstatus") == "F").select("o_orderkey"),
             "CONTROL": o.where(F.col("o_orderstatus") == "O").select("o_orderkey"),
             "OTRO": o.where(F.col("o_orderstatus") == "P").select("o_orderkey")}
    return ors.union_labelled(parts, "grupo")


@register("set06_explode_delimited", """
SELECT c_custkey, unnest(string_split('D' || CAST(c_custkey AS VARCHAR) ||
       CASE WHEN c_custkey % 3 = 0 THEN '/D' || CAST(c_custkey + 1 AS VARCHAR) ELSE '' END, '/')) AS code
FROM customer""")
def set06(spark, d):
    c = fx.table(spark, d, "customer")
    k = F.col("c_custkey")
    code = F.concat(F.lit("D"), k.cast("string"),
                    F.when(k % 3 == 0, F.concat(F.lit("/D"), (k + 1).cast("string"))).otherwise(F.lit("")))
    return ors.explode_delimited(c.select("c_custkey", code.alias("code")), "code", "/")


@register("set09_to_long", SQL_KINGS + _stage_sql("kings", "kings", "fecha_kings_") + """
SELECT pid, 'fecha_kings_' || CAST(st AS VARCHAR) AS name, dt AS value FROM dates,
  LATERAL (SELECT unnest([1, 2, 3, 4]) AS st, unnest([fecha_kings_1, fecha_kings_2, fecha_kings_3, fecha_kings_4]) AS dt)""",
          ["visits", "patients"])
def set09(spark, d):
    w = kings_dates(spark, d)
    return ors.to_long(w, ["pid"], [f"fecha_kings_{k}" for k in range(1, 5)], "name", "value")


@register("so02_sort_by_id", """
SELECT sample_id, CAST(row_number() OVER (ORDER BY sample_id) AS INTEGER) AS ord FROM pheno""", ["pheno"])
def so02(spark, d):
    return ow.with_row(fx.pheno(spark, d).select("sample_id").orderBy("sample_id"), ["sample_id"], "ord")


@register("so03_order_by_levels", """
SELECT sample_id, CAST(row_number() OVER (ORDER BY coalesce(list_position(['ALS', 'CONTROL'], pheno), 3), sample_id)
       AS INTEGER) AS ord FROM pheno""", ["pheno"])
def so03(spark, d):
    p = fx.pheno(spark, d)
    lv = F.array_position(F.array(F.lit("ALS"), F.lit("CONTROL")), F.col("pheno"))
    key = F.when(lv > 0, lv).otherwise(F.lit(3))
    return ow.with_row(p.select("sample_id", key.alias("_k")), [F.col("_k"), F.col("sample_id")], "ord") \
        .select("sample_id", "ord")


@register("so04_sort_two_keys", """
SELECT sample_id, pheno, CAST(row_number() OVER (ORDER BY sample_id, pheno) AS INTEGER) AS ord FROM pheno""", ["pheno"])
def so04(spark, d):
    return ow.with_row(fx.pheno(spark, d).select("sample_id", "pheno"), ["sample_id", "pheno"], "ord")


@register("so05_sort_within_groups", """
SELECT _row, CAST(row_number() OVER (PARTITION BY pid ORDER BY day DESC, _row) AS INTEGER) AS visit_rank FROM visits""",
          ["visits"])
def so05(spark, d):
    return ow.with_row(fx.visits(spark, d), [F.col("day").desc(), F.col("_row")], "visit_rank", keys=["pid"]) \
        .select("_row", "visit_rank")


# ------------------------------------------------------------------ E1 patient table (PRJ-3)
def als_patient_table(spark, d):
    """Patients + ages/delays + slope baseline + King's and MiToS stage dates -> ALS_* schema."""
    p = fx.patients(spark, d)
    base = wn01b(spark, d)
    kd, md = kings_dates(spark, d), mitos_dates(spark, d)
    j = p.join(base, "pid", "left").join(kd, "pid", "left").join(md, "pid", "left")
    within = F.datediff("fecha_deltafs", "diagnosis") <= 12 * fd.DAYS_PER_MONTH
    schema = {
        "pid": "pid",
        "ALS_ONSET": fd.years_floor("onset", "birth").cast("bigint"),
        "ALS_DD": fd.months_between_avg("diagnosis", "onset", 1),
        "ALS_DFS": F.when(within, F.col("delta_fs")),
        "ALS_DFS_PC": F.when(within, F.col("categoria_progresion")),
        "ALS_SURVIVAL": fd.months_between_avg("death", "onset", 1),
    }
    for k in range(1, 5):
        schema[f"ALS_KSS{k}"] = fd.months_between_avg(f"fecha_kings_{k}", "onset", 1)
        schema[f"ALS_MITOS{k}"] = fd.months_between_avg(f"fecha_mitos_{k}", "onset", 1)
    return output_schema(j, schema)


_K = SQL_KINGS + _stage_sql("kings", "kings", "fecha_kings_").replace(", st AS", ", stk AS").replace(
    "FROM st GROUP", "FROM stk GROUP").replace(", wide AS", ", widek AS").replace("LEFT JOIN wide w", "LEFT JOIN widek w") \
    .replace(", dates AS", ", kdates AS")
_M = """
, mit AS (SELECT *, CAST(((caminar <= 1) OR (vestido <= 1)) AS INTEGER) + CAST((deglucion <= 1) AS INTEGER)
  + CAST(((lenguaje <= 1) AND (escritura <= 1)) AS INTEGER)
  + CAST(((disnea <= 1) OR (insuficiencia_respiratoria <= 2)) AS INTEGER) AS mitos FROM alsfrs)""" + \
    _stage_sql("mit", "mitos", "fecha_mitos_").replace(", st AS", ", stm AS").replace(
        "FROM st GROUP", "FROM stm GROUP").replace(", wide AS", ", widem AS").replace(
        "LEFT JOIN wide w", "LEFT JOIN widem w").replace(", dates AS", ", mdates AS")
_B = """
, sl AS (SELECT a.*, round((48 - a.total) / nullif(CAST(datediff('day', p.onset, a.fecha_visita) AS DOUBLE) / 30.4375, 0), 1)
           AS delta_fs FROM alsfrs a JOIN patients p ON a.pid = p.pid)
, base AS (SELECT pid, fecha_visita AS fecha_deltafs, delta_fs,
  CASE WHEN delta_fs < 0.5 THEN 'SP' WHEN delta_fs BETWEEN 0.5 AND 1 THEN 'NP' WHEN delta_fs > 1 THEN 'FP' END
    AS categoria_progresion
  FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY fecha_visita, _row) AS rn FROM sl
        WHERE delta_fs IS NOT NULL) WHERE rn = 1)"""


def _m(col):
    return f"round(CAST(datediff('day', p.onset, {col}) AS DOUBLE) / 30.4375, 1)"


register("prj03_als_patient_table", _K + _M + _B + """
SELECT p.pid, CAST(floor(CAST(datediff('day', p.birth, p.onset) AS DOUBLE) / 365.25) AS BIGINT) AS "ALS_ONSET",
  """ + _m("p.diagnosis") + """ AS "ALS_DD",
  CASE WHEN datediff('day', p.diagnosis, b.fecha_deltafs) <= 12 * 30.4375 THEN b.delta_fs END AS "ALS_DFS",
  CASE WHEN datediff('day', p.diagnosis, b.fecha_deltafs) <= 12 * 30.4375 THEN b.categoria_progresion END AS "ALS_DFS_PC",
  """ + _m("p.death") + """ AS "ALS_SURVIVAL",
  """ + ",\n  ".join(f'{_m(f"k.fecha_kings_{k}")} AS "ALS_KSS{k}", {_m(f"m.fecha_mitos_{k}")} AS "ALS_MITOS{k}"'
                      for k in range(1, 5)) + """
FROM patients p LEFT JOIN base b ON p.pid = b.pid LEFT JOIN kdates k ON p.pid = k.pid LEFT JOIN mdates m ON p.pid = m.pid""",
         ["visits", "patients"])(als_patient_table)


@register("jn13_left_join_summarise", """
SELECT m.patient_id, CAST(count(e.event_id) AS BIGINT) AS n_episodes, max(e.date) AS last_episode
FROM ms_onsets m LEFT JOIN episodes e ON e.patient_id = m.patient_id GROUP BY m.patient_id""",
          ["ms_onsets", "episodes"])
def jn13(spark, d):
    j = fx.ms_onsets(spark, d).join(fx.episodes(spark, d), "patient_id", "left")
    return j.groupBy("patient_id").agg(F.count("event_id").cast("bigint").alias("n_episodes"),
                                       F.max("date").alias("last_episode"))


# Skew-safe variants of the keyed scans (range-partitioned, carries between partitions).
@register("wn04s_fill_down_scan", SQL_NUTRI + """
SELECT _row, last_value(peso_premorbido IGNORE NULLS) OVER (PARTITION BY pid ORDER BY day, _row
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peso_premorbido FROM nutri""", ["visits"])
def wn04s(spark, d):
    from genoframe.operators.scan import fill_down_scan
    return fill_down_scan(_nutri(spark, d), ["pid"], ["day", "_row"], ["peso_premorbido"]) \
        .select("_row", "peso_premorbido")


@register("wn05s_fill_up_scan", SQL_NUTRI + """
SELECT _row, first_value(peso_premorbido IGNORE NULLS) OVER (PARTITION BY pid ORDER BY day, _row
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS peso_premorbido FROM nutri""", ["visits"])
def wn05s(spark, d):
    from genoframe.operators.scan import fill_up_scan
    return fill_up_scan(_nutri(spark, d), ["pid"], ["day", "_row"], ["peso_premorbido"]) \
        .select("_row", "peso_premorbido")


@register("so05s_row_number_scan", """
SELECT _row, CAST(row_number() OVER (PARTITION BY pid ORDER BY day DESC, _row DESC) AS BIGINT) AS visit_rank
FROM visits""", ["visits"])
def so05s(spark, d):
    return _rank_desc(spark, d)


def _rank_desc(spark, d):
    from genoframe.operators.scan import _scan
    return _scan(fx.visits(spark, d).select("_row", "pid", "day"), ["pid"], ["day", "_row"], [], "visit_rank",
                 descending=True).select("_row", "visit_rank")


@register("wn13s_hot_key_fill", """
, hv AS (SELECT _row, CASE WHEN _row % 3 = 0 THEN 0 ELSE pid END AS pid, day,
                CASE WHEN _row % 5 = 0 THEN total END AS x FROM visits)
SELECT _row, last_value(x IGNORE NULLS) OVER (PARTITION BY pid ORDER BY day, _row
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS x,
       CAST(row_number() OVER (PARTITION BY pid ORDER BY day, _row) AS BIGINT) AS k FROM hv""", ["visits"])
def wn13s(spark, d):
    """A third of the rows share one key: the scan spreads that key over many partitions."""
    from genoframe.operators.scan import _scan
    v = fx.visits(spark, d)
    hv = v.select("_row", F.when(F.col("_row") % 3 == 0, F.lit(0)).otherwise(F.col("pid")).cast("bigint").alias("pid"),
                  "day", F.when(F.col("_row") % 5 == 0, F.col("total")).alias("x"))
    return _scan(hv, ["pid"], ["day", "_row"], ["x"], "k").select("_row", F.col("x").cast("int").alias("x"), "k")
