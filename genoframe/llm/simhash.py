"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint is embedded as the bit counts of its 2-bit segments, a point of a small integer
grid. The Manhattan distance of two such points never exceeds the Hamming distance of
the fingerprints. The segments are dealt into groups; points at distance d or less agree in all but d
groups, so each point is filed in one grid cell for every choice of the other groups, and the
range join meets in equal cells. Pairs within the Manhattan bound are verified on all bits.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.frames import checkpointed, id_and_text, materialised, shuffle_partitions
from genoframe.llm.graph import components
from genoframe.llm.textbuf import LOWER, NON_SPACE, chunks, mix

SEED = 42
SEGMENT_MASK = np.uint64(0x5555555555555555)


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp bigint`` (the unsigned fingerprint's bits) for every row.

    A-Z are lower-cased, words are runs without ASCII white space, shingles are ``shingle``
    words joined by a space, repeats included; fewer words make one shingle, none
    (null, empty or blank text) gives 0. A bit is 1 if set in over half of the hashes.
    """
    def run(batches):
        h64 = xxhash.xxh64_intdigest
        for part, chunk in chunks(batches):
            low = LOWER[chunk.buf]
            s, e, row = chunk.words(NON_SPACE, low)
            n, m = len(chunk), len(s)
            out = np.zeros(n, dtype=np.uint64)
            if m:
                # all words of the chunk, joined by one space: a shingle is one slice of it
                length = e - s
                end = np.cumsum(length + 1) - 1
                begin = end - length
                copy = np.full(int(end[-1]) + 1, 32, dtype=np.uint8)
                src = np.repeat(s - begin, length) + np.flatnonzero(_inside(begin, end, len(copy)))
                copy[_inside(begin, end, len(copy))] = low[src]
                joined = copy.tobytes()
                count = np.bincount(row, minlength=n)
                first = np.cumsum(count) - count
                sh_n = np.where(count > 0, np.maximum(count - shingle + 1, 1), 0)
                sh_row = np.repeat(np.arange(n), sh_n)
                at = first[sh_row] + np.arange(len(sh_row)) - (np.cumsum(sh_n) - sh_n)[sh_row]
                last = np.minimum(at + shingle, first[sh_row] + count[sh_row]) - 1
                hashes = np.fromiter((h64(joined[a:b], SEED) for a, b in zip(begin[at].tolist(), end[last].tolist())),
                                     dtype=np.uint64, count=len(at))
                lo = 0
                for r in np.flatnonzero(sh_n):
                    hi = lo + int(sh_n[r])
                    ones = np.zeros(64, dtype=np.int64)
                    for a in range(lo, hi, 65536):
                        bits = np.unpackbits(hashes[a: min(hi, a + 65536)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                        ones += bits.sum(axis=0, dtype=np.int64)
                    out[r] = np.packbits((2 * ones > hi - lo).astype(np.uint8), bitorder="little").view("<u8")[0]
                    lo = hi
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out.view(np.int64), pa.int64())], ["doc_id", "fp"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, fp bigint")


def _inside(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    flag = np.ones(n, dtype=bool)
    flag[end] = False
    return flag


def segment_counts(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments, packed two bits each."""
    return (fp & SEGMENT_MASK) + ((fp >> np.uint64(1)) & SEGMENT_MASK)


def manhattan(a, b) -> np.ndarray:
    """Manhattan distance of packed segment counts (values 0 to 2)."""
    ones = np.uint64(0x5555555555555555)
    # spread a count c to the unary code of c, whose Hamming distance is the difference
    ua = (a & ones) | (a >> np.uint64(1) & ones) | (a & ~ones)
    ub = (b & ones) | (b >> np.uint64(1) & ones) | (b & ~ones)
    return np.bitwise_count(ua ^ ub)


def cell_masks(max_bits: int, agree: int = 3) -> list[int]:
    """Bit masks of the segment groups that a cell fixes: all choices of ``agree`` of ``max_bits + agree`` groups."""
    groups = max_bits + agree
    edge = [round(32 * k / groups) for k in range(groups + 1)]
    mask = [sum(3 << (2 * s) for s in range(edge[k], edge[k + 1])) for k in range(groups)]
    return [sum(mask[k] for k in pick) for pick in combinations(range(groups), agree)]


def links_in_cell(fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the distinct fingerprints of one cell (indices).

    Grows one group at a time: each new member is compared with what no group holds yet,
    so a dense cell costs about its size, and a cell without links its square, which is small
    as cells without links hold few rows.
    """
    left = np.arange(len(fp))
    counts = segment_counts(fp)
    out = []
    while len(left) > 1:
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            a = todo.pop()
            near = manhattan(counts[left], counts[a]) <= max_bits      # lower bound
            if near.any():
                idx = np.flatnonzero(near)
                idx = idx[np.bitwise_count(fp[left[idx]] ^ fp[a]) <= max_bits]   # exact
                if len(idx):
                    found = left[idx]
                    out += [(a, int(x)) for x in found]
                    todo += found.tolist()
                    left = np.delete(left, idx)
    return out


def links(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """``a, b``: links between representatives (``rep``) of distinct fingerprints (``fp``) that
    connect all fingerprints within ``max_bits`` differing bits, and only those."""
    masks = np.array(cell_masks(max_bits), dtype=np.uint64)

    def file_in_cells(batches):
        number = np.arange(len(masks), dtype=np.uint64)
        for rb in batches:
            for at in range(0, rb.num_rows, 4096):
                part = rb.slice(at, 4096)
                fp = part.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
                rep = part.column(0).to_numpy(zero_copy_only=False)
                key = mix((segment_counts(fp)[:, None] & masks[None, :]) ^ mix(number + np.uint64(1))[None, :])
                k = len(masks)
                yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(np.repeat(fp, k).view(np.int64)),
                                                  pa.array(np.repeat(rep, k))], ["cell", "fp", "rep"])

    def join_cells(frames):
        """Rows arrive sorted by cell; the last cell of a batch may go on in the next."""
        held = None
        for f in frames:
            f = f if held is None else pd.concat([held, f], ignore_index=True)
            cell = f["cell"].to_numpy()
            cut = int(np.searchsorted(cell, cell[-1], "left")) if len(cell) else 0
            held = f.iloc[cut:]
            yield _cells(f.iloc[:cut], max_bits)
        if held is not None and len(held):
            yield _cells(held, max_bits)

    cells = distinct.select("rep", "fp").mapInArrow(file_in_cells, "cell bigint, fp bigint, rep bigint")
    n = shuffle_partitions(distinct.sparkSession)
    return (cells.repartition(n, "cell").sortWithinPartitions("cell")
            .mapInPandas(join_cells, "a bigint, b bigint").distinct())


def _cells(f: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    cell, fp, rep = f["cell"].to_numpy(), f["fp"].to_numpy().view(np.uint64), f["rep"].to_numpy()
    edge = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]])) if len(cell) else np.zeros(1, int)
    size = np.diff(edge)
    a, b = [], []
    two = edge[:-1][size == 2]
    if len(two):
        ok = manhattan(segment_counts(fp[two]), segment_counts(fp[two + 1])) <= max_bits
        two = two[ok]
        two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= max_bits]
        a.append(rep[two])
        b.append(rep[two + 1])
    for lo, n in zip(edge[:-1][size > 2].tolist(), size[size > 2].tolist()):
        pairs = links_in_cell(fp[lo: lo + n], max_bits)
        if pairs:
            p = np.array(pairs) + lo
            a.append(rep[p[:, 0]])
            b.append(rep[p[:, 1]])
    empty = np.zeros(0, dtype=np.int64)
    return pd.DataFrame({"a": np.concatenate(a or [empty]), "b": np.concatenate(b or [empty])})


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` per distinct ``(doc_id, fingerprint)``.

    Fingerprints link at ``max_bits`` or fewer differing bits; ``component_id`` is the
    smallest doc_id reachable, itself included. Equal fingerprints are one node, so a large
    group of copies is pre-aggregated to a row. Repeated equal rows give one row; a null doc_id
    stands for itself and is returned with a null component.
    """
    fps = fingerprints(docs, shingle, id_col, text_col).distinct()
    fps = checkpointed(fps)
    distinct = fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"))
    comp = components(links(distinct, max_bits))
    nodes = (distinct.join(comp, distinct["rep"] == comp["node"], "left")
             .select("fp", F.coalesce("component", "rep").alias("component")))
    return (fps.join(nodes, "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id")))


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, that of the smallest doc_id.

    All columns are kept. Rows that repeat a doc_id are one document: the least of them (by the other columns
    in order) stays. Rows without a doc_id stay whole. Only ids are gathered to decide; the texts
    of documents whose id is not repeated are not aggregated.
    """
    got = near_duplicates(docs, shingle, max_bits, id_col, text_col).where("doc_id is not null")
    gone = got.groupBy("doc_id").agg(F.bool_and(F.col("doc_id") != F.col("component_id")).alias("gone")).where("gone")
    again = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("doc_id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # written tables have a known size, so that a small one is broadcast and no text is shuffled for it
    gone = materialised(gone.select(F.col("doc_id").alias(id_col)), "simhash-gone")
    again = materialised(again.select(F.col("doc_id").alias(id_col)), "simhash-again")
    left = docs.join(gone, id_col, "left_anti").select(docs.columns)
    if not again.take(1):
        return left
    others = [c for c in docs.columns if c != id_col]
    many = (left.join(again, id_col, "left_semi").select(F.col(id_col), F.struct(*[F.col(c) for c in others]).alias("rest"))
            .groupBy(id_col).agg(F.min("rest").alias("rest")).select(id_col, "rest.*"))
    return left.join(again, id_col, "left_anti").select(docs.columns).unionByName(many.select(docs.columns))
