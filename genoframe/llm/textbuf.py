"""Whole-batch text access: UTF-8 buffers of Arrow string columns as numpy arrays.

Arrow batches are walked in chunks of about ``max_bytes`` (a longer text is a chunk of
its own), so a task holds a few arrays of that size whatever the batch holds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20


def byte_class(member) -> np.ndarray:
    return np.array([bool(member(b)) for b in range(256)])


#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower-cased; every character from U+0080 is a word character.
ALNUM = byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: Bytes of ``[^\x20\x09-\x0D]+``.
NON_SPACE = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)

_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i < n, kept for the process."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1024)
        p = np.full(size, base, dtype=np.uint64)
        p[0] = 1
        with np.errstate(over="ignore"):
            have = _powers[base] = np.multiply.accumulate(p)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every ``buf[start:end]``, from prefix sums of a polynomial."""
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(buf)), out=prefix[1:])
        value = (prefix[ends] - prefix[starts]) * powers(_INV, len(buf) + 1)[starts]
        return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class TextChunk:
    """Some consecutive rows: their bytes end to end and the offsets of each row."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off = buf, off

    def __len__(self) -> int:
        return len(self.off) - 1

    def words(self, member: np.ndarray, buf: np.ndarray | None = None):
        """``(starts, ends, row)`` of the maximal runs of member bytes; a run never crosses rows."""
        b = self.buf if buf is None else buf
        inside = member[b]
        before = np.zeros(len(b) + 1, dtype=bool)
        before[1:] = inside
        before[self.off] = False
        after = np.zeros(len(b) + 1, dtype=bool)
        after[:-1] = inside
        after[self.off] = False
        starts = np.flatnonzero(inside & ~before[:-1])
        ends = np.flatnonzero(inside & ~after[1:]) + 1
        return starts, ends, np.searchsorted(self.off, starts, side="right") - 1


def string_parts(arr) -> tuple[np.ndarray, np.ndarray]:
    """Byte buffer and int64 offsets of an Arrow string column; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, "" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[arr.offset: arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def chunks(batches: Iterable[pa.RecordBatch], column: str = "text",
           max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, TextChunk]]:
    """Slices of the batches with the chunk of their text column."""
    for rb in batches:
        buf, off = string_parts(rb.column(rb.schema.get_field_index(column)))
        i = 0
        while i < rb.num_rows:
            j = max(int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1, i + 1)
            yield rb.slice(i, j - i), TextChunk(buf[off[i]: off[j]], off[i: j + 1] - off[i])
            i = j
