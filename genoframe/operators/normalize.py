"""FN-27: left-align and trim indels against a reference sequence.

The reference is a table of fixed-width windows (chrom, bin, seq) with
``bin = (pos - 1) // width`` (1-based positions). Each indel is equi-joined to the window of
its last base and the one before it; an indel whose shift reaches the start of them is joined to earlier
windows in another round, until none moves on. SNVs pass through untouched, and so do
records whose reference windows are missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shift_left(pos: int, ref: str, alt: str, seq: str, seq_start: int) -> tuple[int, str, str, bool]:
    """Shift one bi-allelic record left as far as ``seq`` (from 1-based ``seq_start``) allows.

    The last value tells whether an earlier base is needed to go on; an allele may then be empty.
    """
    while True:
        if ref and alt and ref[-1] == alt[-1] and not len(ref) == len(alt) == 1:
            ref, alt = ref[:-1], alt[:-1]
        elif ref and alt:
            break
        if not ref or not alt:
            i = pos - 1 - seq_start
            if not 0 <= i < len(seq):
                return pos, ref, alt, True
            ref, alt, pos = seq[i] + ref, seq[i] + alt, pos - 1
    return pos, ref, alt, False


def trim(pos: int, ref: str, alt: str) -> tuple[int, str, str]:
    """Drop common leading bases, keeping one base of each allele."""
    k = 0
    while k < min(len(ref), len(alt)) - 1 and ref[k] == alt[k]:
        k += 1
    return pos + k, ref[k:], alt[k:]


def normalize_one(pos: int, ref: str, alt: str, seq: str, seq_start: int) -> tuple[int, str, str]:
    """Left-align and trim one record; unchanged if ``seq`` does not reach far enough."""
    p, r, a, more = shift_left(pos, ref, alt, seq, seq_start)
    return (pos, ref, alt) if more else trim(p, r, a)


def left_align(variants: DataFrame, ref_windows: DataFrame, width: int) -> DataFrame:
    """Normalise (chrom, pos, ref, alt) rows; returns the same columns plus ``changed``."""
    from genoframe.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(variants.sparkSession)
    cols = variants.columns
    short = (F.length("ref") == 1) & (F.length("alt") == 1)
    w = ref_windows.select("chrom", F.col("bin").alias("_b"), "seq")
    schema = variants.withColumns({"_p": F.col("pos"), "_r": F.col("ref"), "_a": F.col("alt"), "_more": F.lit(True)}).schema

    def run(it):
        for pdf in it:
            got = [shift_left(int(p), r, a, s, int(st)) if s else (p, r, a, None)
                   for p, r, a, s, st in zip(pdf["_p"], pdf["_r"], pdf["_a"], pdf["_seq"], pdf["_start"])]
            out = pdf[cols].copy()
            # no window at all: the record stays as it was given
            lost = [g[3] is None for g in got]
            out["_p"] = [p if x else g[0] for g, x, p in zip(got, lost, pdf["pos"])]
            out["_r"] = [r if x else g[1] for g, x, r in zip(got, lost, pdf["ref"])]
            out["_a"] = [a if x else g[2] for g, x, a in zip(got, lost, pdf["alt"])]
            out["_more"] = [bool(g[3]) for g in got]
            yield out

    todo = variants.where(~short).withColumns({"_p": F.col("pos"), "_r": F.col("ref"), "_a": F.col("alt")})
    done = variants.where(short).withColumns({"_p": F.col("pos"), "_r": F.col("ref"), "_a": F.col("alt")})
    first = True
    while True:
        # the window of the base wanted next (the base before an empty allele), and the one before it
        at = todo.withColumn("_b", F.floor((F.col("_p") - (1 if first else 2)) / width))
        cur = at.join(w, ["chrom", "_b"], "left").withColumnRenamed("seq", "_s1")
        prev = w.withColumn("_b", F.col("_b") + 1).withColumnRenamed("seq", "_s0")
        j = cur.join(prev, ["chrom", "_b"], "left")
        j = j.withColumn("_seq", F.when(F.col("_s1").isNotNull(), F.concat(F.coalesce("_s0", F.lit("")), "_s1"))) \
            .withColumn("_start", F.when(F.col("_s0").isNotNull(), (F.col("_b") - 1) * width + 1).otherwise(F.col("_b") * width + 1))
        moved = j.select(*cols, "_p", "_r", "_a", "_seq", "_start").mapInPandas(run, schema).checkpoint()
        done = done.unionByName(moved.where("not _more").drop("_more"))
        todo = moved.where("_more").drop("_more")
        first = False
        if todo.isEmpty():
            break
    k = F.expr("""aggregate(sequence(1, greatest(least(length(_r), length(_a)) - 1, 1)), 0, (k, i) ->
        IF(k = i - 1 AND i < least(length(_r), length(_a)) AND substr(_r, i, 1) = substr(_a, i, 1), i, k))""")
    out = done.withColumn("_k", k)
    new = {"pos": (F.col("_p") + F.col("_k")).cast(variants.schema["pos"].dataType), "ref": F.expr("substr(_r, _k + 1)"), "alt": F.expr("substr(_a, _k + 1)")}
    moved = (new["pos"] != F.col("pos")) | (new["ref"] != F.col("ref")) | (new["alt"] != F.col("alt"))
    return out.select(*[new.get(c, F.col(c)).alias(c) for c in cols], F.when(short, False).otherwise(moved).alias("changed"))
