"""Stupid-backoff scores of documents from n-gram count tables partitioned by hash.

Texts are dealt into chunks. A chunk's distinct n-grams (64-bit hashes) and their counts go to the
buckets of their hash range; a bucket adds up the counts of all chunks, which is its part of
the count table, and joins them back to the chunks that asked. Each chunk then
sums the scores of its documents. An n-gram travels once per chunk whatever its frequency.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.frames import buckets_for, checkpointed, id_and_text, text_bytes
from genoframe.llm.textbuf import ALNUM, LOWER, TextChunk, mix, span_hashes, string_parts

ALPHA = 0.4
CHUNK_TEXT = 4 << 20
BUCKET_TEXT = 4 << 20


def _ngrams(tab: pa.Table, order: int):
    """Per n = 1..order the hashes of all n-grams, the row of each and its last word's number."""
    buf, off = string_parts(tab.column("text"))
    low = LOWER[buf]
    chunk = TextChunk(low, off)
    s, e, row = chunk.words(ALNUM)
    h = span_hashes(low, s, e)
    del buf, low, s, e
    out, g = [(h, row, np.arange(len(h)))], h
    with np.errstate(over="ignore"):
        for n in range(2, order + 1):
            # the hash of n words from that of the first n - 1 and the last word
            last = out[-1][2] + 1
            ok = last < len(h)
            last = last[ok]
            ok[ok] = row[last] == out[-1][1][ok]
            last = (out[-1][2] + 1)[ok]
            g = mix(out[-1][0][ok] * np.uint64(0x9E3779B97F4A7C15) + h[last] + np.uint64(n))
            out.append((g, row[last], last))
    return out, len(off) - 1


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def _unpack(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _edges(n_buckets: int) -> np.ndarray:
    return np.array([(k << 64) // n_buckets for k in range(1, n_buckets)], dtype=np.uint64)


def score(docs: DataFrame, order: int = 2, alpha: float = ALPHA, leave_out: bool = True, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_backoff, log_score, mean_log_score`` per row; counts are over all texts of ``docs``.

    A-Z are lower-cased, words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A word's score is
    count(n-gram) / count(its first n - 1 words) for the longest n-gram (up to ``order``) that was
    seen, times ``alpha`` for each step down; below unigrams (count / words) stands 1 / words. With
    ``leave_out`` a document's own counts are taken off first, so that it is scored by the other
    documents. ``n_backoff`` counts words that were scored below the longest n-gram they
    could have. Null or empty texts have no words, score 0 and mean null. Repeated rows each give
    a row and count. Other columns are not read.
    """
    spark = docs.sparkSession
    base = id_and_text(docs, id_col, text_col)
    total = text_bytes(base)
    n_chunks = buckets_for(spark, total, CHUNK_TEXT)
    n_buckets = buckets_for(spark, total, BUCKET_TEXT)
    dealt = base.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(n_chunks))).select("chunk", "doc_id", "text")

    def ask(tab: pa.Table) -> pa.Table:
        chunk = tab.column("chunk")[0].as_py()
        grams, _ = _ngrams(tab, order)
        keys, counts = np.unique(np.concatenate([g[0] for g in grams]), return_counts=True)
        cut = np.concatenate([[0], np.searchsorted(keys, _edges(n_buckets)), [len(keys)]])
        rows = [(b, lo, hi) for b, (lo, hi) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())) if hi > lo]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int64()), "chunk": pa.array([chunk] * len(rows), pa.int64()),
                         "n": pa.array([r[2] - r[1] for r in rows], pa.int64()),
                         "blob": pa.array([_pack(np.diff(keys[lo:hi], prepend=np.uint64(0)), counts[lo:hi].astype(np.uint32)) for _, lo, hi in rows], pa.binary())})

    def add_up(tab: pa.Table) -> pa.Table:
        sizes = tab.column("n").to_pylist()
        keys, counts = [], []
        for n, blob in zip(sizes, tab.column("blob").to_pylist()):
            raw = _unpack(blob)
            keys.append(np.cumsum(np.frombuffer(raw, np.uint64, n), dtype=np.uint64))
            counts.append(np.frombuffer(raw, np.uint32, n, 8 * n))
        keys, which = np.unique(np.concatenate(keys), return_inverse=True)
        table = np.bincount(which, weights=np.concatenate(counts), minlength=len(keys)).astype(np.int64)
        told, at = table[which], 0
        blobs = []
        for n in sizes:
            blobs.append(_pack(told[at: at + n]))
            at += n
        return pa.table({"chunk": tab.column("chunk"), "bucket": tab.column("bucket"), "n": tab.column("n"), "blob": pa.array(blobs, pa.binary())})

    def sum_up(tab: pa.Table, told: pa.Table) -> pa.Table:
        n_rows = tab.num_rows
        if not n_rows:
            return _SCORED.empty_table()
        grams, _ = _ngrams(tab, order)
        told = sorted(zip(told.column("bucket").to_pylist(), told.column("blob").to_pylist()))
        everywhere = np.concatenate([np.frombuffer(_unpack(b), np.int64) for _, b in told] or [np.zeros(0, np.int64)])
        _, which = np.unique(np.concatenate([g[0] for g in grams]), return_inverse=True)
        edge = np.cumsum([0, *[len(g[0]) for g in grams]])
        row = grams[0][1]
        words = np.bincount(row, minlength=n_rows)
        # counts without the document's own
        left = []
        for k, (g, r, _) in enumerate(grams):
            w = which[edge[k]: edge[k + 1]]
            c = everywhere[w]
            if leave_out and len(w):
                own = w.astype(np.int64) * n_rows + r
                _, inv, cnt = np.unique(own, return_inverse=True, return_counts=True)
                c = c - cnt[inv]
            left.append(c)
        # the longest seen n-gram that ends at each word
        m = len(row)
        value, done, level = np.zeros(m), np.zeros(m, dtype=bool), np.zeros(m, dtype=np.int64)
        could = np.zeros(m, dtype=np.int64)
        by_words = np.zeros(m, dtype=bool)
        place = np.full(m, -1)
        for k in range(order - 1, -1, -1):
            at = grams[k][2]
            could[at] = np.maximum(could[at], k + 1)
            seen = (left[k] > 0) & ~done[at]
            w = at[seen]
            if k:
                # the n-gram's first words are the (n - 1)-gram that ends one word before
                place[:] = -1
                place[grams[k - 1][2]] = np.arange(len(grams[k - 1][2]))
                context = left[k - 1][place[w - 1]]
                value[w] = np.log(left[k][seen]) - np.log(context)
            else:
                value[w] = np.log(left[0][seen])
                by_words[w] = True
            level[w] = k + 1
            done[w] = True
        by_words |= ~done
        steps = could - level
        value += steps * math.log(alpha)
        return pa.table({"doc_id": tab.column("doc_id"), "n_words": pa.array(words, pa.int64()),
                         "n_backoff": pa.array(np.bincount(row, weights=steps > 0, minlength=n_rows).astype(np.int64)),
                         "part": pa.array(np.bincount(row, weights=value, minlength=n_rows)),
                         "by_words": pa.array(np.bincount(row, weights=by_words, minlength=n_rows).astype(np.int64))}, schema=_SCORED)

    asked = dealt.groupBy("chunk").applyInArrow(ask, "bucket bigint, chunk bigint, n bigint, blob binary")
    told = asked.groupBy("bucket").applyInArrow(add_up, "chunk bigint, bucket bigint, n bigint, blob binary")
    scored = checkpointed(dealt.groupBy("chunk").cogroup(told.groupBy("chunk"))
                          .applyInArrow(sum_up, "doc_id bigint, n_words bigint, n_backoff bigint, part double, by_words bigint"))
    n_all = int(scored.agg(F.sum("n_words")).first()[0] or 0)
    own = F.col("n_words") if leave_out else F.lit(0)
    log_score = F.col("part") - F.col("by_words") * F.log(F.greatest(F.lit(n_all) - own, F.lit(1)).cast("double"))
    return (scored.select("doc_id", "n_words", "n_backoff", F.when(F.col("n_words") > 0, log_score).otherwise(F.lit(0.0)).alias("log_score"))
            .withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))))


_SCORED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_backoff", pa.int64()), ("part", pa.float64()), ("by_words", pa.int64())])
