"""Registry of named analyses: a Spark builder plus (optionally) its DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from genoframe.plans.sqlfixtures import with_ctes

CATALOG: dict[str, tuple[Callable, str | None]] = {}


def register(name: str, sql: str | None = None, needs: Sequence[str] = ()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with oracle SQL."""
    def deco(fn):
        if name in CATALOG:
            raise ValueError(f"duplicate query name {name}")
        CATALOG[name] = (fn, with_ctes(sql, *needs) if sql is not None else None)
        return fn
    return deco


def load_all() -> dict[str, tuple[Callable, str | None]]:
    from genoframe.plans import (q_columns, q_filters, q_joins, q_sites,  # noqa: F401
                                 q_longitudinal, q_products, q_io, q_ingest, q_stats)
    return CATALOG
