"""Skew-safe keyed scans: fill-down / fill-up / row number within a key, in order.

A window partitioned by key sends every row of one key to one task, so a key
holding a third of the rows becomes a third of the job in one task.  Here rows
are range-partitioned on (key, order) instead, so a hot key is spread over many
partitions.  Pass 1 summarises each partition in one row (first key, last key,
row counts, last non-null values of the last key); the driver chains these
summaries (one row per partition, bounded by the partition count) into the
carry-in of every partition; pass 2 scans each partition with vectorised
pandas group operations seeded with its carry.  The range-partitioned table is
checkpointed so both passes see identical partitions.
"""

from __future__ import annotations

import pickle
import warnings
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _prepare(df: DataFrame, keys: Sequence[str], order: Sequence, descending: bool) -> DataFrame:
    o = [F.col(c) if isinstance(c, str) else c for c in order]
    o = [c.desc_nulls_first() if descending else c.asc_nulls_last() for c in o]
    cols = [F.col(k) for k in keys] + o
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *cols).sortWithinPartitions(*cols).checkpoint()


def _eq_key(pdf: pd.DataFrame, keys: Sequence[str], key: tuple) -> np.ndarray:
    """Null-aware equality of each row's key with ``key``."""
    m = np.ones(len(pdf), bool)
    for k, v in zip(keys, key):
        m &= pdf[k].isna().to_numpy() if v is None else (pdf[k] == v).to_numpy()
    return m


def _keytuple(row, keys):
    return tuple(None if pd.isna(row[k]) else row[k] for k in keys)


def _scan(df: DataFrame, keys: Sequence[str], order: Sequence, fill: Sequence[str], number: str | None,
          descending: bool = False) -> DataFrame:
    from pyspark import TaskContext
    keys, fill = list(keys), list(fill)
    d = _prepare(df, keys, order, descending)

    def summarize(it):
        first = last = None
        n = last_count = 0
        last_vals: dict = {}
        for pdf in it:
            if pdf.empty:
                continue
            if first is None:
                first = _keytuple(pdf.iloc[0], keys)
            tail_key = _keytuple(pdf.iloc[-1], keys)
            block = pdf[_eq_key(pdf, keys, tail_key)]
            if tail_key != last:
                last_vals, last_count = {}, 0
            last_count += len(block)
            for c in fill:
                nn = block[c].dropna()
                if len(nn):
                    last_vals[c] = nn.iloc[-1]
            last = tail_key
            n += len(pdf)
        if n:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "n": [n], "last_count": [last_count],
                                "blob": [pickle.dumps((first, last, last_vals))]})

    summ = sorted(d.mapInPandas(summarize, "part int, n bigint, last_count bigint, blob binary").collect(),
                  key=lambda r: r["part"])
    carry: dict[int, tuple] = {}
    s_key, s_vals, s_count = object(), {}, 0
    for r in summ:
        first, last, vals = pickle.loads(r["blob"])
        carry[r["part"]] = (first, dict(s_vals), s_count) if first == s_key else None
        if first == last:                               # the whole partition is one key
            if first == s_key:
                s_vals = {**s_vals, **vals}
                s_count += r["n"]
            else:
                s_key, s_vals, s_count = first, dict(vals), r["n"]
        else:
            s_key, s_vals, s_count = last, dict(vals), r["last_count"]
    bc = df.sparkSession.sparkContext.broadcast(carry)

    def apply(it):
        state = bc.value.get(TaskContext.get().partitionId())   # (key, vals, count) or None
        for pdf in it:
            if pdf.empty:
                continue
            body = pdf.reset_index(drop=True)
            if state is not None:
                k, vals, cnt = state
                head = pd.DataFrame({**{kk: [kv] for kk, kv in zip(keys, k)},
                                     **{c: [vals.get(c)] for c in fill}})
                with warnings.catch_warnings():
                    warnings.simplefilter("ignore", FutureWarning)   # all-NA carry row: dtype comes from body
                    work = pd.concat([head, body[keys + fill]], ignore_index=True)
            else:
                cnt = 0
                work = body[keys + fill].copy()
            g = work.groupby(keys, sort=False, dropna=False)
            if fill:
                work[fill] = g[fill].ffill()
            pos = g.cumcount().to_numpy()
            if state is not None:
                is_carry = (g.ngroup() == g.ngroup().iloc[0]).to_numpy()
                num = pos + 1
                num[is_carry] = pos[is_carry] + cnt
                work = work.iloc[1:]
                num = num[1:]
            else:
                num = pos + 1
            out = body.copy()
            for c in fill:
                out[c] = work[c].to_numpy()
            if number:
                out[number] = num.astype("int64")
            last = work.iloc[-1]
            state = (_keytuple(last, keys), {c: last[c] for c in fill if not pd.isna(last[c])}, int(num[-1]))
            yield out

    fields = list(d.schema.fields)
    if number:
        fields.append(T.StructField(number, T.LongType(), False))
    return d.mapInPandas(apply, T.StructType(fields))


def fill_down_scan(df: DataFrame, keys: Sequence[str], order: Sequence, cols: Sequence[str]) -> DataFrame:
    """WN-4, skew-safe: last non-null value carried forward within each key."""
    return _scan(df, keys, order, cols, None)


def fill_up_scan(df: DataFrame, keys: Sequence[str], order: Sequence, cols: Sequence[str]) -> DataFrame:
    """WN-5, skew-safe: next non-null value carried backward (a fill-down in reverse order)."""
    return _scan(df, keys, order, cols, None, descending=True)


def row_number_scan(df: DataFrame, keys: Sequence[str], order: Sequence, name: str = "row") -> DataFrame:
    """SO-5 per key, skew-safe: 1-based position within each key in order."""
    return _scan(df, keys, order, [], name)
