"""Exact substring removal with a logarithmic family of suffix arrays.

Byte strings of ``length`` bytes that also start in a document with a smaller doc_id are
removed. Texts are dealt into chunks. Every window of ``length`` bytes is filed under its
minimizer (the least hash of its k-byte strings), so equal windows meet; neighbouring windows with one
minimizer travel as one piece of text. First the chunks' distinct minimizers alone are
counted, and only pieces whose minimizer stands in several documents go on to the buckets. In
a bucket, documents arrive in batches in order of doc_id: a batch gets a suffix array (its sorted
distinct windows), is scanned against the existing levels and its own smaller documents, and
becomes a level; levels of equal size are merged, so there are never more than a logarithm of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.frames import buckets_for, id_and_text, text_bytes
from genoframe.llm.textbuf import chunks, mix, span_hashes, string_parts

LENGTH = 50
KMER = 24
#: Text bytes of one chunk, and of the part of it that is hashed at a time.
CHUNK_BYTES = 4 << 20
PART_BYTES = 512 << 10
#: Windows of one batch of the index family.
BATCH = 1 << 16


def _words8(buf: np.ndarray, extra: int) -> np.ndarray:
    """The 8 bytes from every position as one integer (zeros past the end)."""
    padded = np.concatenate([buf, np.zeros(extra + 8, dtype=np.uint8)])
    return np.ndarray(shape=(len(buf) + extra,), dtype="<u8", buffer=padded, strides=(1,))


def minimizers(buf: np.ndarray, length: int, demoted: np.ndarray | None = None) -> np.ndarray:
    """For every position, the least hash of the k-byte strings inside the window that starts there.

    ``demoted`` marks hash buckets of strings that stand in very many documents: they rank last, so
    that windows meet under a rarer string wherever they hold one.
    """
    w = length - KMER + 1
    x = _words8(buf, length)
    n = len(buf) + length - KMER
    with np.errstate(over="ignore"):
        h = x[:n] * np.uint64(0x9E3779B97F4A7C15)
        for at in range(8, KMER, 8):
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F) + x[at: n + at] * np.uint64(0x9E3779B97F4A7C15 + 2 * at)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h >>= np.uint64(1)
    if demoted is not None:
        h |= demoted[(h & np.uint64(0xFFFF)).astype(np.int64)].astype(np.uint64) << np.uint64(63)
    span = 1
    while span * 2 <= w:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    if w > span:
        h = np.minimum(h[: len(h) - (w - span)], h[w - span:])
    return h[: len(buf)]


def common_strings(docs: DataFrame, sample: int = 2000, share: float = 0.02) -> np.ndarray | None:
    """Hash buckets of k-byte strings that stand in over ``share`` of a bounded sample of texts.

    Only the routing of windows depends on it, never a result; the returned table has 65,536 entries.
    """
    total = docs.count()
    if not total:
        return None
    pick = docs.select("text").where(F.xxhash64(F.lit(5), "doc_id") % max(1, total // sample) == 0)

    def run(batches):
        seen, rows = np.zeros(65536, dtype=np.int64), 0
        for _, chunk in chunks(batches):
            h = minimizers(chunk.buf, KMER)
            for i in range(len(chunk)):
                own = h[chunk.off[i]: max(chunk.off[i], chunk.off[i + 1] - KMER + 1)]
                # low bits only: an entry also counts unrelated strings, about (text bytes / 65,536) of the rows
                seen[np.unique(own & np.uint64(0xFFFF)).astype(np.int64)] += 1
                rows += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(65537)), pa.array([*seen.tolist(), rows])], ["k", "n"])

    got = pick.mapInArrow(run, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(65537, dtype=np.int64)
    for r in got:
        seen[r["k"]] = r["n"]
    usual = np.median(seen[:-1])
    hot = seen[:-1] > usual + max(10, share * seen[-1])
    return hot if hot.any() else None


def _blob(arrays: list[np.ndarray], text: bytes, codec: zstandard.ZstdCompressor) -> bytes:
    head = np.array([len(a) for a in arrays], dtype=np.int64).tobytes()
    return codec.compress(head + b"".join(a.tobytes() for a in arrays) + text)


#: Per piece: bytes, 32 bits of its minimizer, its smallest document. Per place of a piece: piece, position in the document.
_KINDS = (np.uint32, np.uint32, np.int64, np.uint32, np.uint32)


def _unblob(blob: bytes):
    raw = zstandard.ZstdDecompressor().decompress(blob)
    counts = np.frombuffer(raw, dtype=np.int64, count=len(_KINDS))
    at, out = 8 * len(_KINDS), []
    for n, kind in zip(counts.tolist(), _KINDS):
        out.append(np.frombuffer(raw, dtype=kind, count=n, offset=at))
        at += n * np.dtype(kind).itemsize
    return out, np.frombuffer(raw, dtype=np.uint8, offset=at)


def _edges(n_buckets: int) -> np.ndarray:
    return np.array([(k << 64) // n_buckets for k in range(1, n_buckets)], dtype=np.uint64)


def runs_of_windows(ids: np.ndarray, buf: np.ndarray, off: np.ndarray, length: int, demoted, content: bool):
    """Runs of neighbouring windows with one minimizer: ``start, end, key, doc, position`` and, if wanted, a content hash.

    Texts are looked at in parts of about ``PART_BYTES``; ``end`` is past the last byte of the last window.
    """
    out, i = [], 0
    while i < len(off) - 1:
        j = max(int(np.searchsorted(off, off[i] + PART_BYTES, side="right")) - 1, i + 1)
        b, o = buf[off[i]: off[j]], off[i: j + 1] - off[i]
        n = len(b)
        if n >= length:
            count = np.maximum(np.diff(o) - length + 1, 0)
            step = np.zeros(n + 1, dtype=np.int8)
            np.add.at(step, o[:-1][count > 0], 1)
            np.add.at(step, (o[:-1] + count)[count > 0], -1)
            valid = np.cumsum(step, dtype=np.int8)[:-1].astype(bool)
            key = minimizers(b, length, demoted)
            same = np.zeros(n + 1, dtype=bool)
            same[1:n] = valid[1:] & valid[:-1] & (key[1:] == key[:-1])
            start = np.flatnonzero(valid & ~same[:-1])
            end = np.flatnonzero(valid & ~same[1:]) + length
            row = np.searchsorted(o, start, side="right") - 1
            out.append((start + off[i], end + off[i], mix(key[start]), ids[i + row], start - o[row],
                        span_hashes(b, start, end) if content else start))
        i = j
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none, none, none.astype(np.uint64)
    return tuple(np.concatenate(p) for p in zip(*out))


def pack_pieces(buf, start, end, key, doc, pos, content, edges: np.ndarray):
    """``(bucket, blob)`` rows of a chunk's pieces, equal ones once, and the spans that the chunk alone decides."""
    order = np.lexsort((pos, doc, content, key))
    start, end, key, content, doc, pos = (a[order] for a in (start, end, key, content, doc, pos))
    size = end - start
    new = np.ones(len(order), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1]) | (size[1:] != size[:-1])
    piece = np.cumsum(new) - 1
    least = doc[new]                                          # rows are sorted by doc inside a piece
    late = doc > least[piece]                                 # also stands in a smaller document of this chunk
    spans = (doc[late], pos[late], (pos + size)[late])
    # pieces are in order of key, so those of a bucket follow one another
    p_start, p_end, p_key = start[new], end[new], key[new]
    at = np.concatenate([[0], np.searchsorted(p_key, edges), [len(p_key)]])
    own_piece, own_pos = piece[~late], pos[~late]
    codec, out = zstandard.ZstdCompressor(level=3), []
    for b in np.flatnonzero(np.diff(at)).tolist():
        lo, hi = at[b], at[b + 1]
        x, y = np.searchsorted(own_piece, [lo, hi])
        text = b"".join([buf[i:j].tobytes() for i, j in zip(p_start[lo:hi].tolist(), p_end[lo:hi].tolist())])
        out.append((b, _blob([(p_end - p_start)[lo:hi].astype(np.uint32), (p_key[lo:hi] & np.uint64(0xFFFFFFFF)).astype(np.uint32), least[lo:hi],
                              (own_piece[x:y] - lo).astype(np.uint32), own_pos[x:y].astype(np.uint32)], text, codec)))
    return out, spans


class SuffixLevels:
    """The index family: sorted arrays of distinct windows, of geometrically growing sizes."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Which of the sorted ``keys`` stand in a level (merge scan)."""
        found = np.zeros(len(keys), dtype=bool)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level, keys), len(level) - 1)
            found |= level[at] == keys
        return found

    def add(self, keys: np.ndarray) -> None:
        """Add the suffix array of a batch; merge levels of about equal size."""
        self.levels.append(keys)
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            b, a = self.levels.pop(), self.levels.pop()
            merged = np.concatenate([a, b])
            merged.sort(kind="stable")                            # two sorted runs: one merge
            self.levels.append(merged[np.concatenate([[True], merged[1:] != merged[:-1]])])


def scan_batches(buf: np.ndarray, starts: np.ndarray, doc: np.ndarray, length: int, batch: int = BATCH) -> np.ndarray:
    """Which windows also start in a smaller document. Windows come in order of doc."""
    family, found = SuffixLevels(), np.zeros(len(starts), dtype=bool)
    take, lo = np.arange(length), 0
    while lo < len(starts):
        hi = min(lo + batch, len(starts))
        if hi < len(starts) and doc[hi - 1] == doc[hi]:
            first = int(np.searchsorted(doc, doc[hi], "left"))
            hi = first if first > lo else int(np.searchsorted(doc, doc[hi], "right"))
        rows = np.ascontiguousarray(buf[starts[lo:hi, None] + take]).view(f"S{length}").ravel()
        keys, which = np.unique(rows, return_inverse=True)        # the batch's suffix array
        least = np.full(len(keys), np.iinfo(np.int64).max)
        np.minimum.at(least, which, doc[lo:hi])
        found[lo:hi] = family.holds(keys)[which] | (doc[lo:hi] > least[which])
        family.add(keys)
        lo = hi
    return found


def bucket_spans(blobs: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``doc, start, end`` of the removed ranges that one bucket decides."""
    parts = [_unblob(b) for b in blobs]
    buf = np.concatenate([t for _, t in parts])
    size, kk, doc = (np.concatenate([p[k] for p, _ in parts]).astype(np.int64) for k in range(3))
    shift = np.cumsum([0, *[len(p[0]) for p, _ in parts]])
    place_piece = np.concatenate([p[3].astype(np.int64) + s for (p, _), s in zip(parts, shift)])
    place_pos = np.concatenate([p[4] for p, _ in parts]).astype(np.int64)
    at = np.cumsum(size) - size
    # equal pieces: all but those of the smallest document are removed whole
    content = span_hashes(buf, at, at + size)
    order = np.lexsort((doc, content, kk, size))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (content[order][1:] != content[order][:-1]) | (kk[order][1:] != kk[order][:-1]) | (size[order][1:] != size[order][:-1])
    group = np.cumsum(new) - 1
    least = doc[order][new]
    late = np.zeros(len(order), dtype=bool)
    late[order] = doc[order] > least[group]
    whole = late[place_piece]
    out = [(doc[place_piece[whole]], place_pos[whole], (place_pos + size[place_piece])[whole])]
    # a distinct piece whose minimizer stands in one document only shares no window
    rep = order[new]
    by = rep[np.lexsort((doc[rep], kk[rep]))]
    edge = np.flatnonzero(np.concatenate([[True], kk[by][1:] != kk[by][:-1], [True]])) if len(by) else np.zeros(1, int)
    several = np.repeat(doc[by][edge[1:] - 1] != doc[by][edge[:-1]], np.diff(edge)) if len(by) else np.zeros(0, bool)
    live = by[several]
    if len(live):
        live = live[np.argsort(doc[live], kind="stable")]
        n_win = size[live] - length + 1
        win_piece = np.repeat(np.arange(len(live)), n_win)
        nth = np.arange(len(win_piece)) - np.repeat(np.cumsum(n_win) - n_win, n_win)
        starts, wdoc = at[live][win_piece] + nth, doc[live][win_piece]
        # windows that share a 64-bit hash with another document go to the suffix arrays
        x = _words8(buf, 0)
        h = np.zeros(len(starts), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for o in [*range(0, length - 7, 8), length - 8]:
                h = (h ^ x[starts + o]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(31)
        o = np.argsort(h, kind="stable")                           # stays in order of doc
        hs, ds = h[o], wdoc[o]
        edge = np.flatnonzero(np.concatenate([[True], hs[1:] != hs[:-1], [True]]))
        shared = np.zeros(len(o), dtype=bool)
        shared[o] = np.repeat(ds[edge[1:] - 1] != ds[edge[:-1]], np.diff(edge))
        cand = np.flatnonzero(shared)
        if len(cand):
            hit = cand[scan_batches(buf, starts[cand], wdoc[cand], length)]
            if len(hit):
                # runs of neighbouring windows of one piece, at every place of the piece
                run = np.flatnonzero(np.concatenate([[True], (np.diff(hit) != 1) | (win_piece[hit][1:] != win_piece[hit][:-1]), [True]]))
                first, last = hit[run[:-1]], hit[run[1:] - 1]
                rp, a, b = live[win_piece[first]], nth[first], nth[last] + length
                o = np.argsort(place_piece, kind="stable")
                pl, pos = place_piece[o], place_pos[o]
                lo, hi = np.searchsorted(pl, rp, "left"), np.searchsorted(pl, rp, "right")
                k = np.repeat(np.arange(len(rp)), hi - lo)
                q = np.repeat(lo, hi - lo) + np.arange(len(k)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)
                out.append((doc[rp][k], pos[q] + a[k], pos[q] + b[k]))
    return tuple(np.concatenate([o[k] for o in out]) for k in range(3))


def _dealt(docs: DataFrame, n_chunks: int) -> DataFrame:
    return docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(n_chunks))).select("chunk", "doc_id", "text")


def repeated_spans(dealt: DataFrame, n_chunks: int, length: int = LENGTH) -> DataFrame:
    """``chunk, doc_id, span``: byte ranges ``(lo << 32) + hi`` covered by strings of ``length`` bytes that also
    start in a document with a smaller doc_id. Ranges may overlap and are not merged. ``dealt`` has
    ``chunk, doc_id, text``; rows without a doc_id take no part."""
    if length < KMER + 8:
        raise ValueError(f"length must be at least {KMER + 8}")
    n_buckets = n_chunks
    demoted = common_strings(dealt)

    def texts(tab):
        ids = tab.column("doc_id")
        if ids.null_count:
            tab = tab.filter(ids.is_valid())
        buf, off = string_parts(tab.column("text"))
        return tab.column("doc_id").to_numpy(), buf, off

    def ask(tab: pa.Table) -> pa.Table:
        """The chunk's distinct minimizers, and whether two of its documents share them."""
        chunk = tab.column("chunk")[0].as_py()
        _, _, key, doc, _, _ = runs_of_windows(*texts(tab), length, demoted, content=False)
        o = np.lexsort((doc, key))
        key, doc = key[o], doc[o]
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, int)
        many = (doc[edge[:-1]] != doc[edge[1:] - 1]) if len(key) else np.zeros(0, bool)
        key = key[edge[:-1]] if len(key) else key
        at = np.concatenate([[0], np.searchsorted(key, _edges(n_buckets)), [len(key)]])
        some = np.flatnonzero(np.diff(at)).tolist()
        codec = zstandard.ZstdCompressor(level=1)
        return pa.table({"bucket": pa.array(some, pa.int64()), "chunk": pa.array([chunk] * len(some), pa.int64()), "n": pa.array(np.diff(at)[some], pa.int64()),
                         "blob": pa.array([codec.compress(np.diff(key[at[b]: at[b + 1]], prepend=np.uint64(0)).tobytes() + many[at[b]: at[b + 1]].tobytes())
                                           for b in some], pa.binary())})

    def count(tab: pa.Table) -> pa.Table:
        """Which of the asked minimizers stand in several documents."""
        sizes, keys, many = tab.column("n").to_pylist(), [], []
        for n, blob in zip(sizes, tab.column("blob").to_pylist()):
            raw = zstandard.ZstdDecompressor().decompress(blob)
            keys.append(np.cumsum(np.frombuffer(raw, np.uint64, n), dtype=np.uint64))
            many.append(np.frombuffer(raw, bool, n, 8 * n))
        keys, many = np.concatenate(keys), np.concatenate(many)
        o = np.argsort(keys, kind="stable")
        edge = np.flatnonzero(np.concatenate([[True], keys[o][1:] != keys[o][:-1], [True]]))
        times = np.diff(edge)
        shared = np.empty(len(keys), dtype=bool)
        shared[o] = np.repeat((times > 1) | np.logical_or.reduceat(many[o], edge[:-1]), times)
        at = np.cumsum([0, *sizes])
        codec = zstandard.ZstdCompressor(level=1)
        return pa.table({"chunk": tab.column("chunk"), "bucket": tab.column("bucket"), "n": tab.column("n"),
                         "blob": pa.array([codec.compress(np.packbits(shared[x:y]).tobytes()) for x, y in zip(at[:-1], at[1:])], pa.binary())})

    def send(tab: pa.Table, told: pa.Table) -> pa.Table:
        """Pieces of the minimizers that several documents share."""
        rows = {"bucket": [], "blob": []}
        if tab.num_rows and told.num_rows:
            ids, buf, off = texts(tab)
            start, end, key, doc, pos, content = runs_of_windows(ids, buf, off, length, demoted, content=True)
            told = sorted(zip(told.column("bucket").to_pylist(), told.column("n").to_pylist(), told.column("blob").to_pylist()))
            shared = np.concatenate([np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8), count=n) for _, n, b in told]).astype(bool)
            live = shared[np.unique(key, return_inverse=True)[1]]
            pieces, spans = pack_pieces(buf, *(a[live] for a in (start, end, key, doc, pos, content)), _edges(n_buckets))
            rows["bucket"] += [b for b, _ in pieces]
            rows["blob"] += [x for _, x in pieces]
            if len(spans[0]):
                # decided here: ranges, addressed to any bucket
                rows["bucket"].append(-1 - int(spans[0][0] % n_buckets))
                rows["blob"].append(zstandard.ZstdCompressor(level=3).compress(b"".join(a.astype(np.int64).tobytes() for a in spans)))
        return pa.table({"bucket": pa.array(rows["bucket"], pa.int64()), "blob": pa.array(rows["blob"], pa.binary())})

    def decide(key, tab):
        blobs = tab.column("blob").to_pylist()
        if key[0].as_py() < 0:
            got = [np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=np.int64).reshape(3, -1) for b in blobs]
            doc, lo, hi = np.concatenate(got, axis=1)
        else:
            doc, lo, hi = bucket_spans(blobs, length)
        return pa.table({"doc_id": pa.array(doc, pa.int64()), "span": pa.array((lo << 32) + hi, pa.int64())})

    asked = dealt.groupBy("chunk").applyInArrow(ask, "bucket bigint, chunk bigint, n bigint, blob binary")
    told = asked.groupBy("bucket").applyInArrow(count, "chunk bigint, bucket bigint, n bigint, blob binary")
    pieces = dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(send, "bucket bigint, blob binary")
    spans = pieces.groupBy("bucket").applyInArrow(decide, "doc_id bigint, span bigint")
    return spans.select(F.pmod(F.xxhash64("doc_id"), F.lit(n_chunks)).alias("chunk"), "doc_id", "span")


def _merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans array<struct<lo,hi>>`` per row, and ``kept binary`` with ``keep_bytes``.

    Texts are UTF-8 bytes; ``kept`` is what remains, concatenated. A null or empty text has no
    bytes and keeps none. Strings are judged on the input, overlaps count, and matches never
    cross texts. doc_id identifies a text: rows that repeat one are one document to the rule (a string
    does not repeat itself) and each give a row, with the ranges found for that doc_id; a row
    without a doc_id is kept whole. Other columns are not read.
    """
    base = id_and_text(docs, id_col, text_col)
    n_chunks = buckets_for(docs.sparkSession, text_bytes(base), CHUNK_BYTES)
    dealt = _dealt(base, n_chunks)
    spans = repeated_spans(dealt, n_chunks, length)
    kept_type = "kept binary, " if keep_bytes else ""
    names = [n for n in _KEPT.names if keep_bytes or n != "kept"]
    schema = pa.schema([_KEPT.field(n) for n in names])

    def cut(tab: pa.Table, found: pa.Table) -> pa.Table:
        by_doc: dict[int, list[int]] = {}
        doc, span = found.column("doc_id").to_numpy(), found.column("span").to_numpy()
        o = np.argsort(doc, kind="stable")
        edge = np.flatnonzero(np.concatenate([[True], doc[o][1:] != doc[o][:-1], [True]])) if len(o) else np.zeros(1, int)
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            by_doc[int(doc[o[a]])] = np.unique(span[o[a:b]]).tolist()
        rows = {n: [] for n in names}
        for d, text in zip(tab.column("doc_id").to_pylist(), tab.column("text").to_pylist()):
            raw = (text or "").encode()
            runs = _merged((x >> 32, min(x & 0xFFFFFFFF, len(raw))) for x in by_doc.get(d, ()) if (x >> 32) < len(raw))
            kept, last = [], 0
            for lo, hi in runs:
                kept.append(raw[last:lo])
                last = hi
            kept.append(raw[last:])
            left = b"".join(kept)
            one = {"doc_id": d, "n_bytes": len(raw), "n_removed": len(raw) - len(left), "n_spans": len(runs), "kept": left,
                   "kept_sha256": hashlib.sha256(left).hexdigest(), "spans": [{"lo": a, "hi": b} for a, b in runs]}
            for n in names:
                rows[n].append(one[n])
        return pa.table(rows, schema=schema)

    return dealt.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(
        cut, f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, {kept_type}kept_sha256 string, spans array<struct<lo:bigint,hi:bigint>>")


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()),
                   ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))])
