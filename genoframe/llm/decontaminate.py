"""Benchmark decontamination with a broadcast hash set of n-grams; DataFrame functions only.

The benchmark's word windows are hashed by their first words into a literal hash set that
travels with the plan; every position of every document is probed against it, the few positions
that pass become window texts, and a join with the windows decides. The set and the broadcast
are used below a checked size; a larger benchmark is joined by a shuffle on the window
text, with the same result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
PREFIX = 3
#: Bounds of the literal set (distinct prefixes) and of the broadcast windows (bytes).
MAX_PREFIXES = 50_000
MAX_BROADCAST_BYTES = 32 << 20

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; texts of ASCII alone take the fast path."""
    return (F.when(F.length(text) == F.octet_length(text), F.lower(text))
            .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase)))


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text; null has none."""
    return F.array_remove(F.split(F.coalesce(lower_ascii(text), F.lit("")), SEPARATORS), "")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, m, key, prefix``: the distinct windows of each item; an item of fewer words is one window."""
    items = benchmark.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    m = F.least(F.size("w"), F.lit(window))
    at = items.select("item_id", "w", m.alias("m"), F.explode(F.sequence(F.lit(1), F.size("w") - m + 1)).alias("i"))
    return at.select("item_id", "m", F.array_join(F.slice("w", F.col("i"), F.col("m")), " ").alias("key"),
                     F.xxhash64(F.array_join(F.slice("w", F.col("i"), F.least("m", F.lit(PREFIX))), " ")).alias("prefix")).distinct()


def _candidates(w: str, m: int, prefixes: list[int] | None) -> str:
    """SQL of the array of ``(pos, m, key)`` of the positions whose prefix is in the set."""
    p = min(m, PREFIX)
    prefix = "xxhash64(concat_ws(' ', " + ", ".join(f"{w}[i + {j}]" if j else f"{w}[i]" for j in range(p)) + "))"
    where = f"sequence(0, size({w}) - {m})"
    if prefixes is not None:
        where = f"filter({where}, i -> {prefix} IN ({', '.join(f'{x}L' for x in prefixes)}))"
    found = f"transform({where}, i -> struct(i AS pos, {m} AS m, array_join(slice({w}, i + 1, {m}), ' ') AS key))"
    return f"CASE WHEN size({w}) >= {m} THEN {found} ELSE array() END"


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items array<string>, spans array<struct<lo,hi>>`` per row of ``docs``.

    ``spans`` are the merged word ranges covered by occurring windows, ``n_hit`` their words,
    ``items`` the sorted distinct item ids as strings. A null or empty text has no words.
    Repeated rows each give a row; an empty benchmark hits nothing; other columns are not read.
    """
    bench = benchmark_windows(benchmark, window, item_id_col, item_text_col)
    size = bench.agg(F.count(F.lit(1)), F.sum(F.octet_length("key") + 40), F.countDistinct("m", "prefix"), F.collect_set("m")).first()
    lengths = sorted(size[3])
    small = (size[1] or 0) <= MAX_BROADCAST_BYTES and size[2] <= MAX_PREFIXES
    by_m: dict[int, list[int]] = {}
    if small:
        for r in bench.select("m", "prefix").distinct().collect():
            by_m.setdefault(r["m"], []).append(r["prefix"])

    tokens = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("w"))
    parts = [_candidates("w", m, sorted(by_m[m]) if small else None) for m in lengths]
    none = "CAST(array() AS array<struct<pos:int,m:int,key:string>>)"
    probed = tokens.select("uid", "doc_id", F.size("w").cast("bigint").alias("n_words"),
                           F.expr(f"concat({', '.join([none, *parts])})").alias("c"))
    at = probed.select("uid", "doc_id", "n_words", F.explode_outer("c").alias("c")).select("uid", "doc_id", "n_words", "c.pos", "c.m", "c.key")
    windows = bench.select(F.col("item_id").cast("string").alias("item"), "key")
    hit = at.join(F.broadcast(windows) if small else windows, "key", "left")
    got = hit.groupBy("uid", "doc_id", "n_words").agg(
        F.array_sort(F.collect_set("item")).alias("items"),
        F.array_sort(F.collect_set(F.when(F.col("item").isNotNull(), F.struct(F.col("pos").alias("lo"), (F.col("pos") + F.col("m")).alias("hi"))))).alias("runs"))
    merged = F.expr("""aggregate(runs, CAST(array() AS array<struct<lo:int,hi:int>>), (acc, r) ->
        CASE WHEN size(acc) > 0 AND r.lo <= acc[size(acc) - 1].hi
             THEN concat(slice(acc, 1, size(acc) - 1), array(struct(acc[size(acc) - 1].lo AS lo, greatest(acc[size(acc) - 1].hi, r.hi) AS hi)))
             ELSE concat(acc, array(struct(r.lo AS lo, r.hi AS hi))) END)""")
    got = got.select("uid", "doc_id", "n_words", "items", merged.alias("spans"))
    return got.select("doc_id", "n_words", F.expr("aggregate(spans, 0L, (s, r) -> s + r.hi - r.lo)").alias("n_hit"),
                      F.size("items").cast("bigint").alias("n_items"), "items", "spans")


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                     item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has no hit, with all their columns.

    A row is known by its text: rows without an id are judged like any other, and of rows that repeat an id only
    those with a hit go. A null or empty text stays.
    """
    key = F.sha2(F.col(text_col).cast("binary"), 256).alias("k")
    hits = scan(docs.select(key, F.col(text_col).alias("t")), benchmark, window, "k", "t", item_id_col, item_text_col).where("n_hit > 0")
    # the row travels as one value, so that no column of docs can clash with a name used here
    rows = docs.select(F.struct("*").alias("row"), key)
    kept = rows.join(hits.select(F.col("doc_id").alias("k")).distinct(), "k", "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` with the hit words cut out of the text; what stands between words is kept. doc_id must be unique."""
    hits = scan(docs, benchmark, window, id_col, text_col, item_id_col, item_text_col).where("n_hit > 0")
    # the row travels as one value, so that no column of docs can clash with a name used here
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("k"), F.col(text_col).alias("t"))
    both = rows.join(hits.select(F.col("doc_id").alias("k"), "spans"), "k", "left")
    both = both.withColumn("w", F.regexp_extract_all("t", F.lit(f"({WORD_ANY_CASE})"))).withColumn("s", F.split("t", WORD_ANY_CASE))
    cut = F.expr("array_join(transform(s, (x, i) -> concat(x, CASE WHEN i >= size(w) OR exists(spans, r -> r.lo <= i AND i < r.hi) THEN '' ELSE w[i] END)), '')")
    text = F.when(F.col("spans").isNull(), F.col("t")).otherwise(cut)
    return both.select(*[text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
