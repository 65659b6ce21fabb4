"""Byte-level BPE encoding and decoding from a tokenizer file: speculate, verify, repair.

A block's distinct words are tokenised greedily by the longest token at each place (one Aho-Corasick
scan). Such a guess is the BPE result exactly if no merge would ever cross the border of two neighbouring
tokens, which the vectorised ``compatible`` decides for every distinct pair of neighbours. Words with
an incompatible pair are merged anew, rank by rank: short ones side by side in numpy, long ones
with a heap.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from genoframe.llm.frames import id_and_text

#: A block is the texts of about this many characters; longer texts are encoded in parts of this size.
BLOCK_CHARS = 1 << 21
#: A worker process keeps the ids of so many words, and of words of so many characters, from block to block.
KEPT_WORDS, KEPT_CHARS = 400_000, 1 << 23
#: Words of more bytes are merged with a heap, shorter ones side by side.
LONG_WORD = 48
_NEVER = np.int64(1) << 62

# The byte-level alphabet shows these bytes as themselves and the others, in order, from U+0100.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: The split of byte-level tokenizers; {L}, {N} and {O} stand for letters, numbers and what is neither (nor white space).
#: Only the contractions begin with an apostrophe besides {O}, so letters and numbers may be tried first.
_SPLIT = r" ?{L}++| ?{N}++|'(?:[stmd]|re|ve|ll)| ?{O}++|\s+(?!\S)|\s+"
_LETTER, _NUMBER, _OTHER = r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]"

_loaded: dict[str, "ByteLevelBPE"] = {}


def tokenizer(path: str) -> "ByteLevelBPE":
    """The tokenizer of a file, built once per worker process."""
    if path not in _loaded:
        _loaded[path] = ByteLevelBPE(path)
    return _loaded[path]


def _alphabet() -> dict[str, int]:
    hidden = [b for b in range(256) if b not in set(_SHOWN)]
    return {chr(b): b for b in _SHOWN} | {chr(256 + i): b for i, b in enumerate(hidden)}


def gather(offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the items of lists ``which`` in a table of lists, and the offsets of the result."""
    size = (offsets[1:] - offsets[:-1])[which]
    out = np.zeros(len(which) + 1, dtype=np.int64)
    np.cumsum(size, out=out[1:])
    return np.repeat(offsets[:-1][which] - out[:-1], size) + np.arange(out[-1]), out


def _latin_pattern(end: int = 0x250) -> "re.Pattern":
    """The same split for texts of characters below ``end``, by lists of characters; about twice as fast."""
    def members(name: str) -> str:
        return "".join(f"\\u{c:04x}" for c in range(end) if regex.match(name, chr(c)))
    white, letter, number = members(r"\s"), members(_LETTER), members(_NUMBER)
    split = _SPLIT.format(L=f"[{letter}]", N=f"[{number}]", O=f"[^{white}{letter}{number}]")
    return re.compile(split.replace(r"(?!\S)", f"(?![^{white}])").replace(r"\s", f"[{white}]"))


def _split_patterns(path: str) -> tuple["regex.Pattern", "np.ndarray | None", "regex.Pattern | None"]:
    """The split pattern, a mask of the characters that it judges unlike the tokenizer library, and a slower one that judges them alike.

    The two may hold different versions of Unicode. Letters and numbers that Python does not know are shown to the library's
    own splitter; those that it takes for neither belong to the other characters."""
    from tokenizers import Tokenizer
    plain = regex.compile(_SPLIT.format(L=_LETTER, N=_NUMBER, O=_OTHER))
    named = regex.compile(r"[\p{L}\p{N}]")
    new = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) == "Cn" and named.match(c)]
    ends = {e for _, (_, e) in Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str("".join(f"!{c}\n" for c in new))}
    other = [c for i, c in enumerate(new) if 3 * i + 1 not in ends]   # "!" and c are one piece
    if not other:
        return plain, None, None
    runs = [(r[0], r[-1]) for r in ([c for _, c in g] for _, g in itertools.groupby(enumerate(other), lambda x: ord(x[1]) - x[0]))]
    ranges = "".join(f"\\U{ord(a):08X}-\\U{ord(b):08X}" for a, b in runs)
    alike = _SPLIT.format(L=f"[{_LETTER}--[{ranges}]]", N=f"[{_NUMBER}--[{ranges}]]", O=f"[{_OTHER}||[{ranges}]]")
    odd = np.zeros(sys.maxunicode + 1, dtype=bool)
    odd[[ord(c) for c in other]] = True
    return plain, odd, regex.compile("(?V1)" + alike)


class ByteLevelBPE:
    """Vocabulary, merges and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        import ahocorasick
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = (model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
                 and spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                 and (spec["decoder"] or {}).get("type") == "ByteLevel"
                 and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")))
        if not plain:
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        to_byte = _alphabet()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = {i: bytes(to_byte[c] for c in s) for s, i in model["vocab"].items()} | {i: s.encode() for s, i in self.special.items()}
        self.size = max(tokens) + 1
        table = [tokens.get(i, b"") for i in range(self.size)]
        self.length = np.array([len(t) for t in table], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        self.blob = np.frombuffer(b"".join(table), dtype=np.uint8)
        of_byte = {t: i for i, t in tokens.items() if len(t) == 1}
        self.of_byte = np.array([of_byte[bytes([b])] for b in range(256)], dtype=np.int64)
        # merges as sorted (left, right) keys with their rank and the token that they make
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        vocab = model["vocab"]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.merge_key, self.merge_rank, self.merge_made = key[order], order.astype(np.int64), made[order]
        self.merge_of = dict(zip(key.tolist(), zip(range(len(pairs)), made.tolist())))
        # how each token is made: its parts and rank; single bytes are their own
        self.left, self.right = np.arange(self.size), np.arange(self.size)
        self.rank = np.full(self.size, -1, dtype=np.int64)
        self.left[made], self.right[made], self.rank[made] = left, right, np.arange(len(pairs))
        # a token that its own bytes do not lead to, or with two makings, is never guessed
        sure = np.zeros(self.size, dtype=bool)
        learnt = np.array(sorted(vocab.values()))
        ids, off = self._merge([table[i] for i in learnt])
        sure[learnt] = (np.diff(off) == 1) & (ids[np.minimum(off[:-1], len(ids) - 1)] == learnt)
        twice, times = np.unique(made, return_counts=True)
        sure[twice[times > 1]] = False
        self.guess = ahocorasick.Automaton()
        for i in learnt[sure[learnt]].tolist():
            if b"\xff" not in table[i]:                 # 0xFF is no byte of UTF-8 and parts the words
                self.guess.add_word(table[i].decode("latin-1"), i)
        self.guess.make_automaton()
        self.plain, self.odd, self.alike = _split_patterns(path)
        self.latin = _latin_pattern()
        self._forget()
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.border = regex.compile(r"(?<=\S) ")

    # ------------------------------------------------------------ merges
    def _ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of every pair's merge (``_NEVER``: none) and its place in the merge table."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.merge_key, key), len(self.merge_key) - 1)
        return np.where(self.merge_key[at] == key, self.merge_rank[at], _NEVER), at

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge crosses the border when token b follows token a.

        While a and b are built from their bytes, a's last and b's first part take on the
        tokens along a's right and b's left edge. Two parts x and y that stand there at the same
        time merge if the pair's rank m comes before x goes into a larger part (m < its rank)
        and not after y does (at equal rank the left pair goes first). The walk goes down from the
        whole tokens, undoing the later of the two makings each time.
        """
        ok = np.ones(len(a), dtype=bool)
        at, x, y = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        into_x, into_y = np.full(len(a), _NEVER), np.full(len(a), _NEVER)
        while len(at):
            m, _ = self._ranks(x, y)
            cross = (m < into_x) & (m <= into_y) & (m < _NEVER)
            ok[at[cross]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~cross & ((rx >= 0) | (ry >= 0))
            at, x, y, into_x, into_y, rx, ry = (v[go] for v in (at, x, y, into_x, into_y, rx, ry))
            undo_x = rx >= ry
            into_x, into_y = np.where(undo_x, rx, into_x), np.where(undo_x, into_y, ry)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return ok

    def _merge(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of byte strings: ids of all and the offsets of each."""
        n = len(raws)
        size = np.array([len(r) for r in raws], dtype=np.int64)
        word = np.repeat(np.arange(n), size)
        ids = self.of_byte[np.frombuffer(b"".join(raws), dtype=np.uint8)]
        far = np.flatnonzero(size > LONG_WORD)
        short = size[word] <= LONG_WORD if len(word) else np.zeros(0, dtype=bool)
        done_word, done_ids = [], []
        w, t = word[short], ids[short]
        while len(w):
            rank, at = self._ranks(t[:-1], t[1:])
            rank[w[1:] != w[:-1]] = _NEVER
            rank = np.append(rank, _NEVER)
            first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            best = np.minimum.reduceat(rank, first)
            open_ = best < _NEVER
            count = np.diff(np.append(first, len(w)))
            still = np.repeat(open_, count)
            done_word.append(w[~still])
            done_ids.append(t[~still])
            # the leftmost place of each open word's least rank
            hit = np.flatnonzero(still & (rank == np.repeat(best, count)))
            hit = hit[np.append(True, w[hit][1:] != w[hit][:-1])[: len(hit)]] if len(hit) else hit
            t[hit] = self.merge_made[at[hit]]
            still[hit + 1] = False
            w, t = w[still], t[still]
        for k in far.tolist():
            got = self._merge_long(raws[k])
            done_word.append(np.full(len(got), k))
            done_ids.append(np.array(got, dtype=np.int64))
        of = np.concatenate(done_word) if done_word else np.zeros(0, dtype=np.int64)
        all_ids = np.concatenate(done_ids) if done_ids else np.zeros(0, dtype=np.int64)
        order = np.argsort(of, kind="stable")
        return all_ids[order], np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))])

    def _merge_long(self, raw: bytes) -> list[int]:
        ids = self.of_byte[np.frombuffer(raw, dtype=np.uint8)].tolist()
        n, size, merges = len(ids), self.size, self.merge_of
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := merges.get(ids[i] * size + ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue                                # one of the two is gone
            ids[i], ids[j] = merges[a * size + b][1], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := merges.get(ids[i] * size + ids[k]):
                    heapq.heappush(heap, (m[0], i, ids[i], ids[k]))
            h = before[i]
            if h >= 0 and (m := merges.get(ids[h] * size + ids[i])):
                heapq.heappush(heap, (m[0], h, ids[h], ids[i]))
        return [t for t in ids if t >= 0]

    # ------------------------------------------------------------ words
    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-split words: all ids and the offsets of each word."""
        n = len(words)
        raws = [w.encode() for w in words]
        size = np.array([len(r) for r in raws], dtype=np.int64)
        begin = np.concatenate([[0], np.cumsum(size + 1)])
        found = np.fromiter(itertools.chain.from_iterable(self.guess.iter_long(b"\xff".join(raws).decode("latin-1"))), dtype=np.int64).reshape(-1, 2)
        last, ids = found[:, 0], found[:, 1]
        word = np.searchsorted(begin, last, side="right") - 1
        count = np.bincount(word, minlength=n)
        whole = np.bincount(word, weights=self.length[ids], minlength=n) == size
        near = np.flatnonzero(word[1:] == word[:-1])
        pair, which = np.unique(ids[near] * self.size + ids[near + 1], return_inverse=True)
        whole[word[near[~self.compatible(pair // self.size, pair % self.size)[which]]]] = False
        bad = np.flatnonzero(~whole)
        if not len(bad):
            return ids, np.concatenate([[0], np.cumsum(count)])
        new, off = self._merge([raws[k] for k in bad.tolist()])
        keep = whole[word]
        of = np.concatenate([word[keep], np.repeat(bad, np.diff(off))])
        order = np.argsort(of, kind="stable")
        return np.concatenate([ids[keep], new])[order], np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))])

    def _segments(self, text: str, with_special: bool) -> Iterator[tuple[str, int]]:
        """(ordinary text, -1) and (special token, its id), in order."""
        at = 0
        if with_special and self.specials is not None:
            for m in self.specials.finditer(text):
                if m.start() > at:
                    yield text[at: m.start()], -1
                yield m.group(), self.special[m.group()]
                at = m.end()
        if at < len(text):
            yield text[at:], -1

    def _parts(self, text: str) -> Iterator[str]:
        """Parts of a long text, cut before a space that follows another character than white space: no match
        of the pattern holds both, and none looks behind."""
        at = 0
        while len(text) - at > BLOCK_CHARS:
            m = self.border.search(text, at + BLOCK_CHARS)
            if m is None:
                break
            yield text[at: m.start()]
            at = m.start()
        yield text[at:] if at else text

    def _forget(self) -> None:
        self.number: defaultdict = defaultdict()
        self.number.default_factory = self.number.__len__
        self.kept_chars = 0
        self.kept_ids, self.kept_off = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def _splitter(self, texts: list[str]):
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        if not len(points) or points.max() < 0x250:
            return self.latin.findall
        return (self.alike if self.odd is not None and self.odd[points].any() else self.plain).findall

    def encode_texts(self, texts: list[str], with_special: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts and their offsets; words met before are looked up."""
        known = len(self.number)
        split = self._splitter(texts)
        of, pieces = [], []
        for text in texts:
            n = 0
            for segment, token in self._segments(text, with_special):
                got = list(map(self.number.__getitem__, split(segment) if token < 0 else [token]))
                n += len(got)
                pieces.append(np.array(got, dtype=np.int64))
            of.append(n)
        new = list(itertools.islice(self.number, known, None))     # strings are words, numbers are special tokens
        if new:
            ids, off = self.encode_words([w if type(w) is str else "" for w in new])
            special = [(k, w) for k, w in enumerate(new) if type(w) is int]
            if special:
                ids = np.insert(ids, off[[k for k, _ in special]], [w for _, w in special])
                off = off + np.concatenate([[0], np.cumsum([type(w) is int for w in new])])
            self.kept_ids = np.concatenate([self.kept_ids, ids])
            self.kept_off = np.concatenate([self.kept_off, self.kept_off[-1] + off[1:]])
        which = np.concatenate(pieces) if pieces else np.zeros(0, dtype=np.int64)
        place, bounds = gather(self.kept_off, which)
        out = self.kept_ids[place], bounds[np.concatenate([[0], np.cumsum(np.array(of, dtype=np.int64))])]
        self.kept_chars += sum(len(w) for w in new if type(w) is str)
        if len(self.number) > KEPT_WORDS or self.kept_chars > KEPT_CHARS:
            self._forget()
        return out

    def encode(self, text: str, with_special: bool = True) -> np.ndarray:
        """Ids of one text of any length, part by part."""
        got = [np.array([token]) if token >= 0 else self.encode_texts([part], False)[0]
               for segment, token in self._segments(text, with_special) for part in (self._parts(segment) if token < 0 else [segment])]
        return np.concatenate(got) if got else np.zeros(0, dtype=np.int64)

    # ------------------------------------------------------------ back
    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return self.blob[gather(self.start, ids)[0]].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """The text of token ids, special tokens shown; bytes that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


def blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``BLOCK_CHARS`` characters; a longer text is a run of its own."""
    begin = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > begin and size + n > BLOCK_CHARS:
            yield begin, i
            begin, size = i, 0
        size += n
    if len(texts) > begin:
        yield begin, len(texts)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Token ids of every whole text by a byte-level BPE file, and what they decode to.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, with ``keep_ids``, ``ids array<int>`` and
    ``decoded string``. ``ids_sha256`` is of the ids as little-endian unsigned 32-bit integers,
    ``decoded_sha256`` of the decoded text in UTF-8. Strings of special tokens in a text become those tokens; no
    others are added. A null or empty text has no tokens (both digests are those of the empty string).
    A very long text is encoded in parts that end where a word must end, and a very long word is merged in
    time proportional to n log n. Repeated rows and repeated or null ids each give a row; an empty table gives none;
    other columns are not read, whatever their names. ``path`` must exist on every executor, as the tokenizer
    package does.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<int>, decoded string"

    def run(batches):
        tok = tokenizer(path)
        for rb in batches:
            texts = rb.column(1).to_pylist()
            for lo, hi in blocks(texts):
                part = [t or "" for t in texts[lo:hi]]
                if hi - lo == 1 and len(part[0]) > BLOCK_CHARS:
                    ids = tok.encode(part[0])
                    off = np.array([0, len(ids)])
                else:
                    ids, off = tok.encode_texts(part)
                packed, raw = ids.astype("<u4").tobytes(), tok.decode_bytes(ids)
                edge = np.concatenate([[0], np.cumsum(tok.length[ids])])[off].tolist()
                off = off.tolist()
                decoded = [raw[a:b].decode("utf-8", "replace") for a, b in zip(edge, edge[1:])]
                cols = [rb.column(0).slice(lo, hi - lo), pa.array(np.diff(off), pa.int64()),
                        pa.array([hashlib.sha256(packed[4 * a: 4 * b]).hexdigest() for a, b in zip(off, off[1:])], pa.string()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    cols += [pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32())), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
