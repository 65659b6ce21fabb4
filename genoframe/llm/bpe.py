"""Byte-level BPE encoding and decoding with tiktoken and a local rank file."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from genoframe.llm.frames import id_and_text

#: Longer texts are encoded in parts of about this many characters.
PART_CHARS = 65_536
#: In longer texts a run of white space of this many characters is cut out as the match that it is.
LONG_SPACE = 4_096

_encodings: dict[tuple[str, str], object] = {}


def encoding(rank_path: str, pattern: str):
    """The tiktoken encoding of a rank file, built once per worker process."""
    key = (rank_path, pattern)
    if key not in _encodings:
        import tiktoken
        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _encodings[key] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[key]


def safe_parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """Cut a long text where a match of the split pattern must end.

    No match of the pattern holds an ASCII letter or digit followed by white space, and none
    looks behind, so a cut between the two changes no match. A stretch without such
    a place stays whole.
    """
    begin, n = 0, len(text)
    while n - begin > size:
        at = begin + size
        while at < n and not (text[at] in " \n" and text[at - 1].isascii() and text[at - 1].isalnum()):
            at += 1
        yield text[begin:at]
        begin = at
    yield text[begin:]


def encode_text(enc, text: str) -> list[int]:
    """Token ids of a text of any length.

    The split pattern's own search runs out of stack on about a million white-space characters, so long
    runs of them are found here: the pattern matches such a run whole at the end of the text, else all of it but
    its last character, whatever stands before it. A run of another kind is one match and no such case.
    """
    if len(text) <= PART_CHARS:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    begin = 0
    for run in regex.finditer(rf"\p{{White_Space}}{{{LONG_SPACE},}}", text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        for part in safe_parts(text[begin:run.start()]):
            ids += enc.encode_ordinary(part)
        ids += enc._encode_single_piece(text[run.start():end])
        begin = end
    for part in safe_parts(text[begin:]):
        ids += enc.encode_ordinary(part)
    return ids


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           keep_ids: bool = True) -> DataFrame:
    """Token ids of every whole text and the bytes decoded from them.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, with ``keep_ids``,
    ``ids array<int>`` and ``decoded binary``. A null or empty text has no tokens (both
    digests are those of the empty string). Repeated rows each give a row; other columns
    are not read. ``rank_path`` must exist on every executor, as the tokenizer package does.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<int>, decoded binary"

    def run(batches):
        enc = encoding(rank_path, pattern)
        number = [str(i) for i in range(enc.max_token_value + 1)]
        for rb in batches:
            # small steps keep the Python lists of ids small whatever the batch holds
            for at in range(0, rb.num_rows, 256):
                part = rb.slice(at, 256)
                out = {"n": [], "i": [], "d": [], "ids": [], "dec": []}
                for text in part.column(1).to_pylist():
                    ids = encode_text(enc, text) if text else []
                    raw = enc.decode_bytes(ids)
                    out["n"].append(len(ids))
                    out["i"].append(hashlib.sha256(" ".join([number[i] for i in ids]).encode()).hexdigest())
                    out["d"].append(hashlib.sha256(raw).hexdigest())
                    if keep_ids:
                        out["ids"].append(ids)
                        out["dec"].append(raw)
                cols = [part.column(0), pa.array(out["n"], pa.int64()), pa.array(out["i"], pa.string()), pa.array(out["d"], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    cols += [pa.array(out["ids"], pa.list_(pa.int32())), pa.array(out["dec"], pa.binary())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
