"""Hard negatives by a secondary sort.

Pairs of an anchor and a row become 25-byte keys (anchor, descending score, positives first, id) in a shuffle by anchor that
sorts inside its partitions (``repartition`` and ``sortWithinPartitions``, the DataFrame form of
``repartitionAndSortWithinPartitions``, which sorts and spills in the JVM). One pass over the sorted stream opens a window
for each of an anchor's first positives and gives out negatives as they come, holding nothing but the open windows.

Scores are computed in blocks (rows against anchors), and a block sends only what an answer can hold: of the rows of an
anchor's label its best few, then, once the positives are known, of each window its best few negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.frames import checkpointed, shuffle_partitions

#: Anchors and rows of one block of scores, and the most rows of a part of the table (every part meets every block of anchors).
ANCHOR_BLOCK, ROW_BLOCK, PART_ROWS = 512, 4096, 1 << 20
_TOP = (1 << 63) - 1

_BLOCK_SQL = "dim int, ids array<bigint>, labels array<bigint>, data binary"
_KEY_SQL = "anchor bigint, key binary"


def _pack_keys(anchor: np.ndarray, score: np.ndarray, negative: np.ndarray, row: np.ndarray) -> pa.Array:
    """Keys whose byte order is (anchor, descending score, positives first, id)."""
    out = np.zeros((len(anchor), 25), dtype=np.uint8)
    flip = np.uint64(1 << 63)
    out[:, :8] = (anchor.astype(np.int64).view(np.uint64) ^ flip).astype(">u8").view(np.uint8).reshape(-1, 8)
    out[:, 8:16] = (~score.astype(np.int64)).view(np.uint64).__xor__(flip).astype(">u8").view(np.uint8).reshape(-1, 8)
    out[:, 16] = negative
    out[:, 17:] = (row.astype(np.int64).view(np.uint64) ^ flip).astype(">u8").view(np.uint8).reshape(-1, 8)
    at = np.arange(len(anchor) + 1, dtype=np.int32) * 25
    return pa.Array.from_buffers(pa.binary(), len(anchor), [None, pa.py_buffer(at), pa.py_buffer(out)])


def _unpack_keys(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(col.to_pylist()), dtype=np.uint8).reshape(-1, 25)
    flip = np.uint64(1 << 63)

    def number(lo: int) -> np.ndarray:
        return (np.ascontiguousarray(raw[:, lo: lo + 8]).view(">u8").ravel().astype(np.uint64) ^ flip).view(np.int64)
    return number(0), ~number(8), raw[:, 16], number(17)


def prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``id, label, x array<bigint>`` of the rows that take part, one row per id."""
    x = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), x.alias("x"))
    sound = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & sound)
    whole = rows.select("id", "label", F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("bigint")).alias("x"))
    return whole.groupBy("id").agg(F.min(F.struct("label", "x")).alias("r")).select("id", "r.label", "r.x")


def _blocks(size: int):
    """(id, label, x) rows into blocks of about ``size`` vectors of one length."""
    def run(batches):
        def pack(dim, parts):
            ids, labels, data = (np.concatenate(p) for p in zip(*parts))
            narrow = data.astype(np.int16)
            data = narrow if (narrow == data).all() else data
            return pa.RecordBatch.from_pylist([{"dim": dim, "ids": ids, "labels": labels, "data": data.tobytes()}],
                                              schema=pa.schema([("dim", pa.int32()), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("data", pa.binary())]))
        held: dict[int, list] = {}
        for rb in batches:
            ids, labels, x = np.asarray(rb.column(0)), np.asarray(rb.column(1)), rb.column(2)
            dims = np.diff(np.asarray(x.offsets))
            flat, start = np.asarray(x.flatten()), np.cumsum(dims) - dims
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                for lo in range(0, len(at), size):
                    some = at[lo: lo + size]
                    parts = held.setdefault(dim, [])
                    parts.append((ids[some], labels[some], flat[start[some][:, None] + np.arange(dim)].ravel()))
                    if sum(len(p[0]) for p in parts) >= size:
                        yield pack(dim, held.pop(dim))
        for dim, parts in held.items():
            yield pack(dim, parts)
    return run


def _numbers(col: pa.Array, i: int) -> np.ndarray:
    return col[i].values.to_numpy()


def _matrix(col: pa.Array, i: int, n: int, dim: int) -> np.ndarray:
    """The vectors of a block, which are kept as 16-bit numbers where all fit."""
    raw = col[i].as_buffer()
    return np.frombuffer(raw, dtype=np.int16 if raw.size == 2 * n * dim else np.int64).reshape(n, dim)


def inner_products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact integer inner products (modulo 2**64): by floating point wherever no sum can leave 2**53."""
    def size(m):
        return np.sqrt((m.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0))
    if size(rows) * size(anchors) < 2.0 ** 52:
        return (rows.astype(np.float64) @ anchors.astype(np.float64).T).astype(np.int64)
    with np.errstate(over="ignore"):
        return rows.astype(np.int64) @ anchors.astype(np.int64).T


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k by descending score, then id."""
    if len(score) > 4 * k:
        least = -np.partition(-score, k - 1)[k - 1]
        some = np.flatnonzero(score >= least)
    else:
        some = np.arange(len(score))
    return some[np.lexsort((ids[some], -score[some]))[:k]]


class _Best:
    """The best (score, id) entries of an anchor block, per anchor and list, while blocks of rows pass by."""

    def __init__(self, anchors: np.ndarray, k: int):
        self.anchors, self.k, self.lists = anchors, k, {}

    def add(self, anchor: int, name: int, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(score):
            return
        had = self.lists.get((anchor, name))
        if had is not None:
            score, ids = np.concatenate([had[0], score]), np.concatenate([had[1], ids])
        some = _first(score, ids, self.k)
        self.lists[anchor, name] = score[some], ids[some]

    def keys(self, negative: int) -> Iterator[pa.RecordBatch]:
        of: dict[int, list] = {}
        for (anchor, _), got in self.lists.items():
            of.setdefault(anchor, []).append(got)
        out = []
        for anchor, got in of.items():
            score, ids = (np.concatenate(x) for x in zip(*got))
            ids, at = np.unique(ids, return_index=True)         # a row may stand in several lists
            out.append((np.full(len(ids), self.anchors[anchor]), score[at], ids))
        yield from _keys(out, negative)


def _keys(got: list, negative: int) -> Iterator[pa.RecordBatch]:
    if got:
        anchor, score, row = (np.concatenate(x) for x in zip(*got))
        yield pa.RecordBatch.from_arrays([pa.array(anchor), _pack_keys(anchor, score, np.full(len(anchor), negative), row)], ["anchor", "key"])


def _by_anchor_block(k: int, negative: int, add):
    """Run ``add`` over pairs of blocks; what it keeps goes out when the next block of anchors comes."""
    def run(batches):
        best, name = None, None
        for rb in batches:
            col = {c: rb.column(c) for c in rb.schema.names}
            for i in range(rb.num_rows):
                ids, anchors = _numbers(col["ids"], i), _numbers(col["a_ids"], i)
                labels, own = _numbers(col["labels"], i), _numbers(col["a_labels"], i)
                dim = col["dim"][i].as_py()
                if name != (dim, int(anchors[0])):
                    if best is not None:
                        yield from best.keys(negative)
                    best, name = _Best(anchors.copy(), k), (dim, int(anchors[0]))
                windows = _numbers(col["windows"], i).reshape(len(anchors), -1) if "windows" in col else None
                known = _numbers(col["n_windows"], i) if "windows" in col else None
                add(best, ids, labels, _matrix(col["data"], i, len(ids), dim), anchors, own, _matrix(col["a_data"], i, len(anchors), dim), windows, known)
        if best is not None:
            yield from best.keys(negative)
    return run


def _add_positives(best, ids, labels, rows, anchors, own, a_rows, windows, known) -> None:
    for label in np.unique(own).tolist():
        at, of = np.flatnonzero(labels == label), np.flatnonzero(own == label)
        score = inner_products(rows[at], a_rows[of])
        for j, a in enumerate(of.tolist()):
            other = ids[at] != anchors[a]
            best.add(a, 0, score[other, j], ids[at][other])


def _in_window(score: np.ndarray, positive: int, low: int, high: int) -> np.ndarray:
    """low * positive <= 100 * score <= high * positive, in whole numbers."""
    least, most = -(-low * positive // 100), high * positive // 100
    if least > _TOP or most < -_TOP:
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero((score >= max(least, -_TOP)) & (score <= min(most, _TOP)))


def _add_negatives(low: int, high: int):
    def add(best, ids, labels, rows, anchors, own, a_rows, windows, known) -> None:
        score = inner_products(rows, a_rows)
        for j in range(len(anchors)):
            other = np.flatnonzero(labels != own[j])
            s = score[other, j]
            for p in set(windows[j, :known[j]].tolist()):
                inside = _in_window(s, p, low, high)
                best.add(j, p, s[inside], ids[other[inside]])
    return add


def _stream(n_positives: int, n_negatives: int, low: int, high: int, positives_only: bool):
    """One pass over keys sorted by anchor: windows open at the first positives, negatives go out in order.

    An open window is [positive id, positive score, least and greatest negative score, given out so far]; windows open by
    falling score, so one closes as soon as scores have passed its least one or it is full."""
    def run(batches):
        anchor, seen, windows = None, 0, []
        for rb in batches:
            out = []
            for a, s, negative, row in zip(*(x.tolist() for x in _unpack_keys(rb.column(1)))):
                if a != anchor:
                    anchor, seen, windows = a, 0, []
                if not negative:
                    if seen < n_positives:
                        seen += 1
                        if positives_only:
                            out.append((a, row, s))
                        else:
                            windows.append([row, s, -(-low * s // 100), high * s // 100, 0])
                elif windows:
                    windows = [w for w in windows if s >= w[2] and w[4] < n_negatives]
                    for w in windows:
                        if s <= w[3]:
                            w[4] += 1
                            out.append((a, w[0], w[4], row, w[1], s))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int32() if not positives_only and i == 2 else pa.int64())
                                              for i in range(3 if positives_only else 6)],
                                             ["anchor_id", "positive_id", "positive_score"] if positives_only else
                                             ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])
    return run


def _met(rows: DataFrame, anchors: DataFrame, parts: int) -> DataFrame:
    """Every block of rows with every block of anchors of its length: anchors are copied to each part of the table. The anchors
    are the streamed side, so that a block of them meets the blocks of a part one after the other."""
    copies = anchors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return copies.hint("merge").join(rows, ["part", "dim"])


def mine(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 100,
         n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """The first negatives of every anchor and positive whose score lies in the positive's window.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. Components become floor(scale * x);
    a score is the integer inner product with the anchor; higher scores come first, ties by smaller id. Anchors are the rows whose id
    is divisible by ``every``, positives an anchor's first ``n_positives`` other rows of its label, negatives the first
    ``n_negatives`` rows of other labels with low * positive <= 100 * negative <= high * positive (so a negative positive_score
    has none, and 0 has those of score 0).

    Rows with a null id, label or vector, an empty vector, or a null or non-finite component take no part. Rows that repeat an id count
    once: the least (label, vector). Vectors of another length than the anchor's are not compared with it. Components beyond 64 bits
    are cut to them as Spark casts do, and sums wrap around. An empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    rows = checkpointed(prepared(vectors, id_col, vector_col, label_col, scale))
    n = rows.count()
    n_blocks = max(1, -(-n // ROW_BLOCK))
    parts = max(-(-n // PART_ROWS), min(n_blocks, shuffle_partitions(spark)), 1)
    anchors = checkpointed(rows.where(F.col("id") % every == 0).coalesce(max(1, n // every // (8 * ANCHOR_BLOCK))).mapInArrow(_blocks(ANCHOR_BLOCK), _BLOCK_SQL)
                           .select("dim", F.col("ids").alias("a_ids"), F.col("labels").alias("a_labels"), F.col("data").alias("a_data")))
    packed = checkpointed(rows.mapInArrow(_blocks(ROW_BLOCK), _BLOCK_SQL)
                          .withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int")))

    def sorted_by_anchor(keys: DataFrame) -> DataFrame:
        return keys.repartition("anchor").sortWithinPartitions("key")

    best = _met(packed, anchors, parts).mapInArrow(_by_anchor_block(n_positives, 0, _add_positives), _KEY_SQL)
    positives = checkpointed(sorted_by_anchor(best).mapInArrow(_stream(n_positives, 0, low, high, True),
                                                               "anchor_id bigint, positive_id bigint, positive_score bigint"))
    # the windows of every anchor, back in the order of its block
    scores = positives.groupBy("anchor_id").agg(F.collect_list("positive_score").alias("s"))           # at most n_positives
    member = anchors.select(F.xxhash64("dim", "a_ids").alias("block"), F.posexplode("a_ids").alias("at", "anchor_id"))
    padded = F.coalesce(F.col("s"), F.array().cast("array<bigint>"))
    windows = (member.join(scores, "anchor_id", "left").groupBy("block").agg(F.sort_array(F.collect_list(F.struct(       # at most ANCHOR_BLOCK
        "at", F.size(padded).cast("bigint").alias("n"), F.slice(F.concat(padded, F.array_repeat(F.lit(0).cast("bigint"), n_positives)), 1, n_positives).alias("w")))).alias("m")))
    opened = checkpointed(anchors.withColumn("block", F.xxhash64("dim", "a_ids")).join(windows, "block")
                          .select("dim", "a_ids", "a_labels", "a_data", F.flatten("m.w").alias("windows"), F.col("m.n").alias("n_windows")))
    negatives = _met(packed, opened, parts).mapInArrow(_by_anchor_block(n_negatives, 1, _add_negatives(low, high)), _KEY_SQL)

    def positive_keys(batches):
        for rb in batches:
            a, p, s = (np.asarray(rb.column(i)) for i in range(3))
            yield from _keys([(a, s, p)] if len(a) else [], 0)

    both = negatives.unionByName(positives.mapInArrow(positive_keys, _KEY_SQL))
    return sorted_by_anchor(both).mapInArrow(_stream(n_positives, n_negatives, low, high, False),
                                             "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
