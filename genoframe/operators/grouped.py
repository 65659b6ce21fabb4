"""UDF-4: user functions applied per group (grouped map) and per batch."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Types that reach and leave a function in the same form whether groups travel alone or together.
_KEYS = (T.LongType, T.IntegerType, T.BooleanType)
_NUMBERS = (T.LongType, T.IntegerType, T.DoubleType, T.BooleanType)


def group_map(df: DataFrame, keys: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame],
              schema: str) -> DataFrame:
    """Apply ``fn`` to each group as a pandas DataFrame (Arrow-batched transfer).

    Use for per-patient / per-set numerical work whose group is bounded (one
    patient's visits, one gene set's carriers); everything else stays in
    Catalyst expressions. Groups of plain columns travel many to an Arrow batch and are cut
    apart beside the function, since a batch per small group costs more than its work; NULL keys are one group.
    """
    out = T._parse_datatype_string(schema)
    plain = (all(isinstance(df.schema[k].dataType, _KEYS) for k in keys) and len(inspect.signature(fn).parameters) == 1
             and all(isinstance(f.dataType, _NUMBERS) or f.dataType == T.StringType() for f in df.schema)
             and all(isinstance(f.dataType, _NUMBERS) for f in out))
    if not plain or not keys:
        return df.groupBy(*keys).applyInPandas(fn, schema)
    # a given number of parts: few bytes may be much work, so they are not put together by size
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at, names = [df.columns.index(k) for k in keys], out.names

    def run(it):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(out)

        def column(parts, i):
            """One array of the results' column; values are joined first where they are of one numpy type."""
            kinds = {s.dtype for s in parts}
            if len(kinds) == 1 and isinstance(parts[0].dtype, np.dtype):
                parts = [pd.Series(np.concatenate([s.to_numpy() for s in parts]))]
            arrays = [pa.Array.from_pandas(s, mask=s.isnull(), type=arrow.field(i).type, safe=False) for s in parts]
            return pa.concat_arrays(arrays)

        def batch(done):
            by_name = [all(isinstance(c, str) for c in res.columns) for res in done]
            cols = [[res[n] if named else res.iloc[:, i] for res, named in zip(done, by_name)] for i, n in enumerate(names)]
            return pa.RecordBatch.from_arrays([column(c, i) for i, c in enumerate(cols)], schema=arrow)

        done = []
        for group in _groups(it, at):
            res = fn(group)
            if len(res):
                done.append(res)
            if len(done) >= 1000:
                yield batch(done)
                done = []
        if done:
            yield batch(done)

    return df.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _groups(batches: Iterator, at: Sequence[int]) -> Iterator[pd.DataFrame]:
    """The groups of sorted Arrow batches, one frame each; a group may go on in later batches."""
    import pyarrow as pa
    held, key = [], None
    for b in batches:
        if not b.num_rows:
            continue
        cuts = np.zeros(b.num_rows, dtype=bool)
        for i in at:
            c = b.column(i)
            null, x = c.is_null().to_numpy(zero_copy_only=False), c.fill_null(False if pa.types.is_boolean(c.type) else 0).to_numpy(zero_copy_only=False)
            cuts[1:] |= (x[1:] != x[:-1]) | (null[1:] != null[:-1])
        begin = [0, *np.flatnonzero(cuts).tolist()]
        if held and [b.column(i)[0].as_py() for i in at] != key:
            yield pa.Table.from_batches(held).to_pandas()
            held = []
        # numbers with a NULL among them change type as a whole, so the groups of such a batch are converted one by one
        whole = None if any(b.column(i).null_count and (pa.types.is_integer(t) or pa.types.is_boolean(t)) for i, t in enumerate(b.schema.types)) else b.to_pandas()
        for lo, hi in zip(begin, [*begin[1:], b.num_rows]):
            if hi == b.num_rows or held:
                held.append(b.slice(lo, hi - lo))
                if hi < b.num_rows:
                    yield pa.Table.from_batches(held).to_pandas()
                    held = []
            elif whole is None:
                yield b.slice(lo, hi - lo).to_pandas()
            else:
                group = whole.iloc[lo:hi]
                group.index = pd.RangeIndex(hi - lo)
                yield group
        key = [b.column(i)[b.num_rows - 1].as_py() for i in at]
    if held:
        yield pa.Table.from_batches(held).to_pandas()


def batch_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply ``fn`` to Arrow batches of any partition (no grouping, no shuffle)."""
    def run(it):
        for pdf in it:
            yield fn(pdf)
    return df.mapInPandas(run, schema)
