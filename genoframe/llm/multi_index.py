"""Embedding near-duplicates with an inverted multi-index.

Vectors are cut into two halves with a codebook each; the codebooks' product is a grid of
cells, and every vector is filed in one cell. A query visits cells in the order of the summed
half distances (the multi-sequence order) until the recall wanted of pairs at the threshold is
reached, and all members of the visited cells are verified by their exact cosine.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.frames import checkpointed, shuffle_partitions
from genoframe.llm.graph import components

#: Vectors a cell holds on average, and the largest block of a cell that one task holds.
CELL_ROWS = 64
BLOCK_ROWS = 4096
#: Vectors that codebooks and the number of visited cells are fitted on.
SAMPLE = 20_000


@dataclass
class Index:
    first: np.ndarray      # (k, d1)
    second: np.ndarray     # (k, d2)
    visits: int            # cells visited for each query

    def half_distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return _distances(x[:, :cut], self.first), _distances(x[:, cut:], self.second)

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.half_distances(x)
        return a.argmin(axis=1) * len(self.second) + b.argmin(axis=1)

    def visited(self, x: np.ndarray, visits: int | None = None) -> np.ndarray:
        """The nearest ``visits`` cells of each row, nearest first.

        The t-th cell in multi-sequence order has ranks i and j with (i + 1) (j + 1) <= t, so
        only those rank pairs are summed and sorted.
        """
        t = min(visits or self.visits, len(self.first) * len(self.second))
        a, b = self.half_distances(x)
        oa, ob = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
        pairs = np.array([(i, j) for i in range(min(t, len(self.first))) for j in range(min(t // (i + 1), len(self.second)))])
        ia, ib = oa[:, pairs[:, 0]], ob[:, pairs[:, 1]]
        total = np.take_along_axis(a, ia, axis=1) + np.take_along_axis(b, ib, axis=1)
        order = np.argsort(total, axis=1, kind="stable")[:, :t]
        return np.take_along_axis(ia * len(self.second) + ib, order, axis=1)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)


def _codebook(x: np.ndarray, k: int, rng, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), size=k, replace=False)].copy()
    for _ in range(rounds):
        own = _distances(x, centres).argmin(axis=1)
        n = np.bincount(own, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def fit(sample: np.ndarray, n_rows: int, threshold: float, recall: float, cell_rows: int = CELL_ROWS, seed: int = 11) -> Index:
    """Codebooks from a sample of unit vectors; their size follows the number of rows to index.

    The number of visited cells is the least that finds the share ``recall`` of pairs made from
    the sample with a cosine of exactly ``threshold``, the hardest that must be found.
    """
    rng = np.random.default_rng(seed)
    k = int(max(1, min(len(np.unique(sample, axis=0)), round(math.sqrt(n_rows / cell_rows)))))
    cut = sample.shape[1] // 2
    index = Index(_codebook(sample[:, :cut], k, rng), _codebook(sample[:, cut:], k, rng), 1)
    x = sample[rng.choice(len(sample), size=min(len(sample), 1000), replace=False)]
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    norm = np.linalg.norm(noise, axis=1, keepdims=True)
    y = threshold * x + math.sqrt(1 - threshold ** 2) * noise / np.where(norm > 0, norm, 1)
    limit = min(k * k, 64)
    while True:
        where = index.visited(x, limit) == index.cells(y)[:, None]
        found = np.cumsum(where.mean(axis=0))
        enough = np.flatnonzero(found >= recall)
        if len(enough) or limit == k * k:
            index.visits = int(enough[0]) + 1 if len(enough) else limit
            return index
        limit = min(k * k, limit * 4)


def _matrix(col) -> np.ndarray:
    """A list column without nulls as a float64 matrix."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, list[int]]:
    """``vec_id, v`` of the vectors that can link, and the lengths that two or more of them have."""
    v = F.col(vector_col).cast("array<double>")
    base = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v")).where("vec_id is not null and size(v) > 0")
    good = base.where(F.expr("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists(v, x -> x <> 0)"))
    dims = good.groupBy(F.size("v").alias("d")).count().where("count > 1").orderBy("d").collect()
    return good, [r["d"] for r in dims]


def _verify(batches, threshold: float):
    """Rows arrive sorted by (cell, block, role): a block's members, then its queries.

    Counts every query's links and keeps a spanning set of them: each query with its first
    member, and members joined through a query once. A member that does not visit the query's own cell
    would not find it, so the link is counted for the member here: every pair found counts for both of its ends.
    The last column holds a member's visited cells, a query's own cell.
    """
    key, members, ids, copies, seen, parent = None, [], [], [], [], {}
    matrix = None

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for rb in batches:
        if not rb.num_rows:
            continue
        cell, block, role = (rb.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        vec, mult = (rb.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
        x = _unit(_matrix(rb.column(5)))
        cells = rb.column(6)
        edge = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (block[1:] != block[:-1]) | (role[1:] != role[:-1]), [True]]))
        q_out, n_out, a_out, b_out = [], [], [], []
        for lo, hi in zip(edge[:-1], edge[1:]):
            if (cell[lo], block[lo]) != key:
                key, members, ids, copies, seen, matrix = (cell[lo], block[lo]), [], [], [], [], None
            if role[lo] == 0:
                members.append(x[lo:hi])
                seen.append(cells.slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False).reshape(hi - lo, -1))
                ids.append(vec[lo:hi])
                copies.append(mult[lo:hi])
                matrix = None
                continue
            if not members:
                continue
            if matrix is None:
                matrix, own, many = np.concatenate(members), np.concatenate(ids), np.concatenate(copies)
                visits = np.concatenate(seen)
                parent = dict(enumerate(range(len(own))))
            home = cells.slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False)
            for at in range(lo, hi, 512):
                to = min(at + 512, hi)
                more, through = np.zeros(len(own), dtype=np.int64), np.zeros(len(own), dtype=np.int64)
                near = (x[at:to] @ matrix.T >= threshold) & (vec[at:to, None] != own[None, :])
                for i in np.flatnonzero(near.any(axis=1)):
                    hit = np.flatnonzero(near[i])
                    q_out.append(vec[at + i])
                    n_out.append(int(many[hit].sum()))
                    a_out.append(vec[at + i])
                    b_out.append(own[hit[0]])
                    if home[at + i - lo] != cell[lo]:
                        unseen = hit[~(visits[hit] == home[at + i - lo]).any(axis=1)]
                        more[unseen] += mult[at + i]
                        through[unseen] = vec[at + i]
                    root = find(int(hit[0]))
                    for h in hit[1:].tolist():
                        r = find(h)
                        if r != root:
                            parent[r] = root
                            q_out.append(vec[at + i])
                            n_out.append(0)
                            a_out.append(own[hit[0]])
                            b_out.append(own[h])
                for h in np.flatnonzero(more).tolist():
                    q_out.append(own[h])
                    n_out.append(int(more[h]))
                    a_out.append(own[h])
                    b_out.append(through[h])
        yield pa.RecordBatch.from_arrays([pa.array(q_out, pa.int64()), pa.array(n_out, pa.int64()), pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())],
                                         ["vec_id", "n", "a", "b"])


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, recall: float = 0.98, id_col: str = "vec_id",
                    vector_col: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row.

    ``n_links`` counts the other vectors found with cosine >= ``threshold`` (double precision; none
    below it is linked), ``component_id`` is the smallest vec_id reachable by links, itself
    included, ``kept`` is ``vec_id = component_id``. A pair found from either end counts for both.
    Equal vectors are one node with their number. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing; vectors of different lengths are not compared, each length has
    an index of its own. vec_id must be unique (repeated equal rows count as
    copies); a null vec_id links with nothing and is not kept. A cell of many members is
    dealt over blocks of ``BLOCK_ROWS``, and queries stream past each block.
    """
    usable, lengths = _usable(vectors, id_col, vector_col)
    everyone = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"))
    alone = everyone.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"),
                            F.coalesce(F.col("vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"))
    if not lengths:
        return alone
    of_vec = None
    for d in lengths:
        part = _linked(usable.where(F.size("v") == d), threshold, recall, sample)
        of_vec = part if of_vec is None else of_vec.unionByName(part)
    return (everyone.join(of_vec, F.col("vec_id") == F.col("k"), "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def _linked(usable: DataFrame, threshold: float, recall: float, sample: int) -> DataFrame:
    """``k, links, c``: id, number of links and component of vectors of one length."""
    spark = usable.sparkSession
    # -0.0 and 0.0 are one value
    tagged = usable.select("vec_id", F.expr("transform(v, x -> x + 0.0D)").alias("v"))
    tagged = tagged.withColumn("tag", F.sha2(F.expr("array_join(transform(v, x -> cast(x as string)), ' ')"), 256))
    nodes = checkpointed(tagged.groupBy("tag").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")))
    n_nodes = nodes.count()
    share = max(1, n_nodes // sample)
    picked = nodes.where(F.pmod(F.xxhash64(F.lit(3), "rep"), F.lit(share)) == 0).select("v").limit(2 * sample).toArrow()
    if picked.num_rows < 2:
        picked = nodes.select("v").limit(2).toArrow()
    index = fit(_unit(_matrix(picked.column(0))), n_nodes, threshold, recall)

    def place(batches):
        for rb in batches:
            for at in range(0, rb.num_rows, 1024):
                part = rb.slice(at, 1024)
                cells = index.visited(_unit(_matrix(part.column(2))))
                lists = pa.ListArray.from_arrays(np.arange(0, cells.size + 1, cells.shape[1], dtype=np.int32), pa.array(cells.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(3)), lists], ["rep", "copies", "v", "visits"])

    # the nearest visited cell is a vector's own; written once, so that both roles rest on the same cells
    placed = checkpointed(nodes.select("rep", "copies", "v").mapInArrow(place, "rep bigint, copies bigint, v array<double>, visits array<bigint>"))
    filed = placed.select(F.col("visits")[0].alias("cell"), "rep", "copies", "v", F.col("visits").alias("cells"))
    asked = placed.select(F.explode("visits").alias("cell"), "rep", "copies", "v", F.array(F.col("visits")[0]).alias("cells"))
    # cells over the block size are dealt over several blocks; their queries go to each
    large = filed.groupBy("cell").count().where(F.col("count") > BLOCK_ROWS).select("cell", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks"))
    large = checkpointed(large)
    filed = filed.join(large, "cell", "left").select("cell", F.pmod(F.xxhash64("rep"), F.coalesce("blocks", F.lit(1))).cast("int").alias("block"),
                                                     F.lit(0).alias("role"), "rep", "copies", "v", "cells")
    asked = asked.join(large, "cell", "left").select("cell", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("block"),
                                                     F.lit(1).alias("role"), "rep", "copies", "v", "cells")
    n = shuffle_partitions(spark)
    met = (filed.unionByName(asked).repartition(n, "cell", "block").sortWithinPartitions("cell", "block", "role")
           .mapInArrow(lambda it: _verify(it, threshold), "vec_id bigint, n bigint, a bigint, b bigint"))
    met = checkpointed(met)
    linked = met.groupBy(F.col("vec_id").alias("r")).agg(F.sum("n").alias("n"))
    comp = components(met.select("a", "b"))
    of_node = (nodes.select("tag", "rep", "copies").join(linked, F.col("rep") == F.col("r"), "left").join(comp, F.col("rep") == F.col("node"), "left")
               .select("tag", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("c")))
    return tagged.select("vec_id", "tag").join(of_node, "tag").select(F.col("vec_id").alias("k"), "links", "c").distinct()
