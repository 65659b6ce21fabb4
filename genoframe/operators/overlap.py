"""Overlap joins of ranges of any length through nested bins, and bounded summaries of what overlaps.

Bins come in levels, each eight times as wide as the one below. A range belongs to the finest level whose
bins are at least as long as the range, so it touches at most two bins there, whatever its length. Two
ranges that overlap meet at the coarser of their two levels: the finer range is projected up to it, which
again gives at most two bins. So a pair is found by equi-joins on (contig, level, bin), and only levels
that the other side uses are projected to. Ranges are 1-based and closed; a range without a contig, a
start or an end, or whose end lies before its start, overlaps nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.operators.joins import broadcast_if_small

FINEST_BITS = 14
STEP_BITS = 3
N_LEVELS = 8        # the coarsest bins hold 2^35 bases


def level_of(start: Column, end: Column) -> Column:
    """The finest level whose bins are at least as long as the range."""
    length = end - start + 1
    out = F.lit(N_LEVELS - 1)
    for level in range(N_LEVELS - 2, -1, -1):
        out = F.when(length <= 1 << (FINEST_BITS + STEP_BITS * level), F.lit(level)).otherwise(out)
    return out


def bin_of(pos: Column, level: Column) -> Column:
    return F.floor(pos / F.pow(F.lit(2.0), FINEST_BITS + STEP_BITS * level)).cast("bigint")


def _bins(df: DataFrame, levels: Column) -> DataFrame:
    """One row per (level, bin) touched, for the levels of an array column."""
    d = df.withColumn("_level", F.explode(levels))
    touched = F.array_distinct(F.array(bin_of(F.col("_s"), F.col("_level")), bin_of(F.col("_e"), F.col("_level"))))
    return d.withColumn("_bin", F.explode(touched))


def own_bins(ranges: DataFrame, chrom: str = "chrom", start: str = "start", end: str = "end") -> DataFrame:
    """``ranges`` with _own, _level and _bin: one or two rows a range."""
    d = _prepared(ranges, chrom, start, end)
    return _bins(d, F.array("_own"))


def _prepared(df: DataFrame, chrom: str, start: str, end: str) -> DataFrame:
    c, s, e = F.col(chrom), F.col(start).cast("bigint"), F.col(end).cast("bigint")
    return (df.withColumns({"_c": c, "_s": s, "_e": e}).where("_c IS NOT NULL AND _s <= _e")
            .withColumn("_own", level_of(F.col("_s"), F.col("_e"))))


def _levels(d: DataFrame) -> list[int]:
    return sorted(r[0] for r in d.select("_own").distinct().collect())      # at most N_LEVELS rows


def overlap_pairs(a: DataFrame, b: DataFrame, a_range: Sequence[str] = ("chrom", "start", "end"),
                  b_range: Sequence[str] = ("chrom", "start", "end")) -> DataFrame:
    """Every overlapping pair once, as structs ``a`` and ``b`` of the two rows.

    Rows travel as structs, so columns of the two sides may share names. Repeated rows pair like any other.
    The side that is given as ``b`` is broadcast below a checked size; beyond it the join shuffles
    on (contig, level, bin), and AQE splits a bin that holds much more than others.
    """
    whole = [F.struct("*").alias("row")]
    l = _prepared(a.select(*whole, *[F.col(x).alias(f"_{i}") for i, x in enumerate(a_range)]), "_0", "_1", "_2")
    r = _prepared(b.select(*whole, *[F.col(x).alias(f"_{i}") for i, x in enumerate(b_range)]), "_0", "_1", "_2")
    l, r = (x.select("row", "_c", "_s", "_e", "_own") for x in (l, r))
    lev_l, lev_r = _levels(l), _levels(r)

    def up(levels, strictly):
        known = F.array(*[F.lit(x) for x in levels]) if levels else F.array().cast("array<int>")
        return F.filter(known, lambda x: x > F.col("_own") if strictly else x >= F.col("_own"))

    def meet(left, right):
        x = left.select(F.col("row").alias("a"), "_c", "_level", "_bin", F.col("_s").alias("_as"), F.col("_e").alias("_ae"))
        y = right.select(F.col("row").alias("b"), "_c", "_level", "_bin", F.col("_s").alias("_bs"), F.col("_e").alias("_be"))
        # a pair that shares two bins is taken in the bin where the overlap begins
        first = F.greatest("_as", "_bs")
        return (x.join(broadcast_if_small(y), ["_c", "_level", "_bin"])
                .where((first <= F.least("_ae", "_be")) & (bin_of(first, F.col("_level")) == F.col("_bin"))).select("a", "b"))

    out = meet(_bins(l, up(lev_r, False)), _bins(r, F.array("_own")))
    if lev_l and lev_r and lev_l[-1] > lev_r[0]:
        # pairs whose left range is of the coarser level
        out = out.unionByName(meet(_bins(l, F.array("_own")), _bins(r, up(lev_l, True))))
    return out


#: Width of the steps between the block sizes of ranges that cover a point, and of starts inside a range (bits).
COVER_BITS, START_BITS = 3, 1


def _ceil_log(length: int, bits: int) -> int:
    """The coarsest level whose blocks a range of that length may hold whole."""
    return max(0, (max(length, 1).bit_length() - 1) // bits)


def _cut(d: DataFrame, lo: str, hi: str, bits: int, top: int) -> DataFrame:
    """A row per block of the one cover of [lo, hi] by the largest aligned blocks: a few blocks a level, none twice."""
    def seq(a, b):
        return f"IF({a} < {b}, sequence({a}, {b} - 1), CAST(array() AS ARRAY<BIGINT>))"
    up = f"_w + {bits}"
    return (d.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(top)))).withColumn("_w", F.col("_level") * bits)
            .withColumns({"_l": F.expr(f"shiftright({lo} + shiftleft(1L, _w) - 1, _w)"), "_r": F.expr(f"shiftright({hi} + 1, _w)"),
                          # what the blocks of the next level hold already
                          "_pl": F.expr(f"shiftleft(shiftright({lo} + shiftleft(1L, {up}) - 1, {up}), {bits})"),
                          "_pr": F.expr(f"shiftleft(shiftright({hi} + 1, {up}), {bits})")})
            .where("_l < _r")
            .withColumn("_block", F.explode(F.expr(f"IF(_level < {top} AND _pl < _pr, concat({seq('_l', '_pl')}, {seq('_pr', '_r')}), {seq('_l', '_r')})")))
            .drop("_w", "_l", "_r", "_pl", "_pr"))


def _each_level(d: DataFrame, pos: str, bits: int, top: int) -> DataFrame:
    """The block of a position on every level."""
    return (d.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(top))))
            .withColumn("_block", F.expr(f"shiftright({pos}, _level * {bits})")))


def _longest(d: DataFrame) -> int:
    return d.agg(F.max(F.col("_e") - F.col("_s") + 1)).first()[0] or 0


def _first_per_node(nodes: DataFrame, node: Sequence[str], value: str, k: int, distinct: bool, out: str) -> DataFrame:
    """Per node the first ``k`` values in order: a ranked pick, so no task holds more than k a node."""
    from pyspark.sql import Window
    rows = nodes.select(*node, F.col(value).cast("string").alias("_x")).where("_x IS NOT NULL")
    if distinct:
        rows = rows.distinct()
    top = rows.withColumn("_i", F.row_number().over(Window.partitionBy(*node).orderBy("_x"))).where(F.col("_i") <= k)
    return top.groupBy(*node).agg(F.collect_list("_x").alias(out))


def annotate_ranges(variants: DataFrame, intervals: DataFrame, spec, key: str = "v",
                    a_range: Sequence[str] = ("chrom", "start", "end"),
                    b_range: Sequence[str] = ("chrom", "start", "end")) -> DataFrame:
    """UDF-2 over overlaps: an ``AnnotationSpec`` applied to the intervals that overlap each variant.

    Ops are those of the spec's exact form with one value per key (count, max, min, sum, mean, first: the value
    of the interval that sorts first) and the bounded lists ``uniq:k`` and ``concat:k`` (the first k values in
    order; with ``count`` beside them nothing is hidden). ``key`` identifies a variant row. Variants
    without an overlap stay, with NULLs (count: 0). Post-ops follow in order.

    No pair is made. An interval overlaps a variant if it covers the variant's start or begins after it, up to
    the variant's end. Intervals are summed up once per block of the cover that they are cut into, and once per
    block that holds their start; a variant reads the blocks around its start of the first kind and those
    its range is cut into of the second. Each overlapping interval is in just one of the blocks read, so the work grows
    with variants and intervals times the number of block sizes, however many overlap.
    """
    from genoframe.operators.annotate import apply_post
    ops = list(spec.ops or ["first"] * len(spec.fields))
    fields = list(dict.fromkeys([*b_range, *spec.fields]))
    v = variants.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(a_range)])
    v = _prepared(v, "_0", "_1", "_2").where("_key IS NOT NULL").select("_key", "_c", "_s", "_e")
    iv = intervals.select(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)])
    of = {c: F.col(f"f{i}") for i, c in enumerate(fields)}
    iv = _prepared(iv, *[f"f{fields.index(c)}" for c in b_range]).drop("_own")
    # partial values of a block, how blocks are put together, and the result
    part, merge, final, lists = {}, {}, {}, {}
    for i, (f, name, op) in enumerate(zip(spec.fields, spec.names, ops)):
        kind, _, k = op.partition(":")
        p = f"p{i}"
        if kind in ("uniq", "concat"):
            if not k.isdigit() or int(k) < 1:
                raise ValueError(f"{op}: give the number of values, as in '{kind}:5'")
            lists[p] = (f"f{fields.index(f)}", int(k), kind == "uniq")
            merge[p] = F.flatten(F.collect_list(p))
            some = F.array_distinct(p) if kind == "uniq" else F.col(p)
            final[name] = F.when(F.size(p) > 0, F.array_join(F.slice(F.array_sort(some), 1, int(k)), ","))
        elif kind in ("first", "self"):
            # the order of intervals: contig, start, end, then every field, so that ties have one result
            part["first"], merge["first"] = F.min(F.struct(*[of[c].alias(f"f{j}") for j, c in enumerate(fields)])), F.min("first")
            final[name] = F.col("first").getField(f"f{fields.index(f)}")
        elif kind == "mean":
            kept = iv.agg(F.avg(of[f]).alias("x"), F.sum(of[f]).alias("y")).schema
            summed = of[f] if kept["y"].dataType.typeName() == "decimal" else of[f].cast("double")
            part[p], part[f"n{p}"] = F.sum(summed), F.count(of[f])
            merge[p], merge[f"n{p}"] = F.sum(p), F.sum(f"n{p}")
            final[name] = F.when(F.col(f"n{p}") > 0, F.col(p) / F.col(f"n{p}")).cast(kept["x"].dataType)
        else:
            how = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.count}[kind]
            part[p], merge[p] = how(of[f]), (F.sum if kind in ("sum", "count") else how)(p)
            final[name] = F.col(p).cast(iv.agg(how(of[f]).alias("x")).schema["x"].dataType)
    top = _ceil_log(_longest(iv), COVER_BITS)
    nodes = _cut(iv, "_s", "_e", COVER_BITS, top).withColumn("_side", F.lit(0))
    asked = _each_level(v, "_s", COVER_BITS, top).withColumn("_side", F.lit(0))
    longest = _longest(v)
    if longest > 1:
        top = _ceil_log(longest - 1, START_BITS)
        nodes = nodes.unionByName(_each_level(iv, "_s", START_BITS, top).withColumn("_side", F.lit(1)))
        inside = v.where("_e > _s").withColumn("_from", F.col("_s") + 1)
        asked = asked.unionByName(_cut(inside, "_from", "_e", START_BITS, top).withColumn("_side", F.lit(1)).drop("_from"))
    node = ["_c", "_side", "_level", "_block"]
    state = nodes.groupBy(*node).agg(*[c.alias(n) for n, c in (part or {"none": F.count(F.lit(1))}).items()])
    for p, (f, k, distinct) in lists.items():
        state = state.join(_first_per_node(nodes, node, f, k, distinct, p), node, "left")
    got = (asked.select("_key", *node).join(broadcast_if_small(state), node).groupBy("_key")
           .agg(*[c.alias(n) for n, c in merge.items()]).select(F.col("_key").alias(key), *[c.alias(n) for n, c in final.items()]))
    out = variants.join(got, key, "left")
    counts = [n for n, op in zip(spec.names, ops) if op == "count"]
    return apply_post(out.fillna(0, counts) if counts else out, spec.post)
