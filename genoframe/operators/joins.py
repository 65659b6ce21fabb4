"""Join operators: null-aware lookups, prioritised resolution, membership flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.operators.windows import fill_downup

# Dimension tables (samples, id lists, small lookups) are broadcast only below
# this bound; above it the planner's shuffle join (with AQE) is kept.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint behind an explicit size check.

    The optimizer's size estimate (an upper bound for filters/projections over
    file scans) decides without running a job."""
    try:
        est = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:   # noqa: BLE001 - estimate unavailable
        est = None
    return F.broadcast(df) if est is not None and est <= max_bytes else df


def _on(a: DataFrame, b: DataFrame, on, null_safe: bool) -> Column:
    pairs = [(k, k) if isinstance(k, str) else k for k in ([on] if isinstance(on, (str, tuple)) else on)]
    cond = None
    for ka, kb in pairs:
        c = a[ka].eqNullSafe(b[kb]) if null_safe else a[ka] == b[kb]
        cond = c if cond is None else cond & c
    return cond


# Parts that the rows with a NULL key are spread over.
NULL_PARTS = 64


def left_join(a: DataFrame, b: DataFrame, on, null_safe: bool = False) -> DataFrame:
    """JN-1 / JN-2: left join; ``null_safe`` lets NULL keys match NULL keys.

    Right-side key columns that share a name with the left side are dropped. Rows whose only key is NULL
    all pair up and are joined apart (``_null_pairs``).
    """
    pairs = [(k, k) if isinstance(k, str) else k for k in ([on] if isinstance(on, (str, tuple)) else on)]
    if null_safe and len(pairs) == 1:
        (ka, kb), = pairs
        known = left_join(a.where(F.col(ka).isNotNull()), b.where(F.col(kb).isNotNull()), on)
        return known.unionAll(_null_pairs(a.where(F.col(ka).isNull()), b.where(F.col(kb).isNull()), ka, kb))
    cond = _on(a, b, on, null_safe)
    out = a.join(b, cond, "left")
    for _, k in pairs:
        if k in a.columns:
            out = out.drop(b[k])
    return out


def _null_pairs(a: DataFrame, b: DataFrame, ka: str, kb: str) -> DataFrame:
    """Every row of ``a`` with every row of ``b`` (NULLs without one): the left ones are spread over ``NULL_PARTS``
    tasks, however few bytes they are, and the right ones sent to each."""
    part = F.pmod(F.xxhash64(F.struct(*[a[c] for c in a.columns])), F.lit(NULL_PARTS)).cast("int")
    x = a.withColumn("_part", part).repartition(NULL_PARTS, "_part")
    y = b.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(NULL_PARTS - 1)))).repartition(NULL_PARTS, "_part").hint("merge")
    out = x.join(y, x["_part"] == y["_part"], "left").drop(x["_part"]).drop(y["_part"])
    return out.drop(y[kb]) if kb in a.columns else out


def inner_join(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """JN-3."""
    return a.join(b, on, "inner")


def anti_join(a: DataFrame, discard: DataFrame, on) -> DataFrame:
    """JN-4: drop rows whose key is in a discard list."""
    return a.join(discard, on, "left_anti")


def exists_flag(a: DataFrame, b: DataFrame, key: str, flag: str = "exists",
                b_key: str | None = None) -> DataFrame:
    """JN-5: boolean column: does ``a.key`` occur in ``b``? (no fan-out)."""
    keys = b.select(F.col(b_key or key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    return (a.join(keys.withColumn(flag, F.lit(True)), a[key] == F.col("_k"), "left")
            .drop("_k").withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def cross_scaffold(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """JN-6: every row x a small fixed list of values (explode, not a cartesian join)."""
    return df.withColumn(col, F.explode(F.array(*[F.lit(v) for v in values])))


def variant_sets(variant_field: DataFrame, kept_ids: DataFrame, id_col: str = "variant_id",
                 field: str = "unit") -> DataFrame:
    """JN-7: (variant_id, unit) for every kept id; ids without a field get NULL."""
    vf = variant_field.select(id_col, field)
    return vf.join(kept_ids.select(id_col), id_col, "right").select(id_col, field)


def dedupe_lookup(df: DataFrame, key: str, cols: Sequence[str], order: str = "_row",
                  fill: str | None = "downup") -> DataFrame:
    """Lookup table with gaps filled inside each key, then distinct rows."""
    d = df.select(key, *cols, order).where(F.col(key).isNotNull())
    if fill:
        d = fill_downup(d, [key], [order], list(cols))
    return d.select(key, *cols).distinct()


def resolve(left: DataFrame, key: str, lookups: Sequence[tuple[DataFrame, str, dict[str, str]]],
            outputs: dict[str, list[str]]) -> DataFrame:
    """JN-8: prioritised multi-source lookup.

    ``lookups`` is an ordered list of (table, table_key, {table_col: alias}); each
    table is joined on ``left.key == table.table_key`` (NULL never matches) and
    ``outputs`` names, for every resolved column, the aliases to coalesce in
    priority order.
    """
    out = left
    for i, (tbl, tkey, cols) in enumerate(lookups):
        t = tbl.select(F.col(tkey).alias(f"_k{i}"), *[F.col(c).alias(a) for c, a in cols.items()])
        out = out.join(t, out[key] == t[f"_k{i}"], "left").drop(f"_k{i}")
    res = {name: F.coalesce(*[F.col(a) for a in aliases]) for name, aliases in outputs.items()}
    used = [a for aliases in outputs.values() for a in aliases]
    return out.withColumns(res).drop(*used)


def model_frame(psam: DataFrame, covariates: DataFrame, key: str = "sample_id") -> DataFrame:
    """JN-15: phenotypes + covariates by sample id (keyed, never positional)."""
    return psam.join(covariates, key, "left")
