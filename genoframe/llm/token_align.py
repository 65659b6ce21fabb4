"""Alignment of two tokenizers' tokens, with inverted pair bitmaps.

Documents are dealt into blocks of at most ``BLOCK_DOCS`` documents. For every id pair (a, b) that a block links,
an inverted index holds one compressed bitmap of the block's documents and, for pairs linked more than once
in a document, the bit planes of the surplus. Blocks hold different documents, so a pair's bitmaps are merged by
adding their popcounts: documents are the popcounts of the bitmaps, links those and 2**k times the popcounts of
plane k. The scores of the pairs then go back through the postings, where each block adds them up by document.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.frames import id_and_text, materialised
from genoframe.llm.spec_bpe import gather, tokenizer

#: Documents and characters of a block, characters of one step inside it.
BLOCK_DOCS, BLOCK_CHARS, STEP_CHARS = 1 << 16, 1 << 23, 1 << 20
#: A worker process keeps so many text units (and units of so many characters) from step to step.
KEPT_UNITS, KEPT_CHARS = 300_000, 1 << 23
#: Pair scores of up to so many rows (16 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_PAIRS = 1 << 21

_BORDER = re.compile(r"(?<=\S) ")
_SPARSE, _DENSE = 0, 1

_aligners: dict[tuple[str, str], "Aligner"] = {}


def aligner(path_a: str, path_b: str) -> "Aligner":
    """The aligner of two files, built once per worker process."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def _strings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])


class Aligner:
    """Aligns texts unit by unit.

    A unit begins with a space that follows another character than white space. No match of A's split pattern and no piece of B
    reaches over such a border, so tokens, groups and links of a text are those of its units in order.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        self.a = tokenizer(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"pieces of {path_b} hold a space inside")
        self.size_b = len(pieces)
        raw = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.blob_b, self.start_b = _strings(raw)
        self.length_b = np.diff(self.start_b)
        self.space_b = self.b.encode("x ")[len(self.b.encode("x")):]
        # "id," "id|" of A and "id," "id;" of B, as one table of strings
        self.shown, self.shown_at = _strings([f"{i}{c}".encode() for c, n in ((",", self.a.size), ("|", self.a.size), (",", self.size_b), (";", self.size_b))
                                              for i in range(n)])
        self._forget()

    def _forget(self) -> None:
        self.number: defaultdict = defaultdict()
        self.number.default_factory = self.number.__len__
        self.kept_chars, self.texts = 0, []
        self.counts = np.zeros((0, 4), dtype=np.int64)          # n_a, n_b, n_groups, whether the bytes are the text's
        self.links, self.links_at = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def _encode_a(self, spaced: list[str], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of units and their offsets. Units that do not end in white space may stand side by side in one text."""
        joined = np.array([not u[-1].isspace() for u in spaced], dtype=bool)
        ids, _ = self.a.encode_texts(["".join([u for u, j in zip(spaced, joined) if j])], with_special=False)
        off = np.concatenate([[0], np.searchsorted(np.cumsum(self.a.length[ids]), np.cumsum(size[joined])) + 1])
        if joined.all():
            return ids, off
        more, more_off = self.a.encode_texts([u for u, j in zip(spaced, joined) if not j], with_special=False)
        row = np.empty(len(spaced), dtype=np.int64)
        row[joined], row[~joined] = np.arange(joined.sum()), joined.sum() + np.arange((~joined).sum())
        place, out = gather(np.concatenate([off, off[-1] + more_off[1:]]), row)
        return np.concatenate([ids, more])[place], out

    def _learn(self, units: list[str]) -> None:
        """Tokens, groups and links of units (without their leading space) not met before."""
        spaced = [" " + u for u in units]
        want = [u.encode() for u in spaced]
        ids_a, off_a = self._encode_a(spaced, np.array([len(w) for w in want]))
        lists = self.b.encode(units, num_threads=1)
        lists = [self.space_b if u == "" else got for u, got in zip(units, lists)]
        off_b = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        ids_b = np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=off_b[-1])
        raw_a, raw_b = self.a.decode_bytes(ids_a), self.blob_b[gather(self.start_b, ids_b)[0]].tobytes()
        end_a = np.concatenate([[0], np.cumsum(self.a.length[ids_a])])
        end_b = np.concatenate([[0], np.cumsum(self.length_b[ids_b])])
        good = np.array([raw_a[i:j] == w and raw_b[k:m] == w for w, i, j, k, m in
                         zip(want, *(x.tolist() for x in (end_a[off_a[:-1]], end_a[off_a[1:]], end_b[off_b[:-1]], end_b[off_b[1:]])))], dtype=bool)
        # only units whose bytes are the text's are aligned; on them both tokenizers cut the same line of bytes
        size = np.where(good, np.array([len(w) for w in want]), 0)
        edge = np.concatenate([[0], np.cumsum(size)])
        ids_a, ids_b = ids_a[np.repeat(good, np.diff(off_a))], ids_b[np.repeat(good, np.diff(off_b))]
        n_a, n_b = np.where(good, np.diff(off_a), 0), np.where(good, np.diff(off_b), 0)
        end_a, end_b = np.cumsum(self.a.length[ids_a]), np.cumsum(self.length_b[ids_b])
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        n_groups = np.diff(np.searchsorted(both, edge, side="right"))
        # between two neighbouring token ends of either side lies exactly one pair of overlapping tokens
        cut = np.union1d(end_a, end_b)
        pair = ids_a[np.searchsorted(end_a, cut)] * self.size_b + ids_b[np.searchsorted(end_b, cut)]
        links_at = np.searchsorted(cut, edge, side="right")
        # the groups as text: by group, A before B, in order
        in_a, in_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        shown_a = ids_a + np.where(both[in_a] == end_a, self.a.size, 0)
        shown_b = 2 * self.a.size + ids_b + np.where(both[in_b] == end_b, self.size_b, 0)
        order = np.argsort(np.concatenate([2 * in_a, 2 * in_b + 1]), kind="stable")
        place, shown_end = gather(self.shown_at, np.concatenate([shown_a, shown_b])[order])
        text = self.shown[place].tobytes()
        token = np.concatenate([[0], np.cumsum(n_a + n_b)])
        where = shown_end[token].tolist()
        self.texts += [text[i:max(i, j - 1)] for i, j in zip(where, where[1:])]
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, n_groups, good], axis=1)])
        self.links = np.concatenate([self.links, pair])
        self.links_at = np.concatenate([self.links_at, self.links_at[-1] + links_at[1:]])

    def step(self, texts: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """Of some texts (or parts that begin behind a border): n_a, n_b, n_groups and whether all bytes agree; the groups as text; all
        linked pairs and the text of each."""
        known = len(self.number)
        units = [list(map(self.number.__getitem__, _BORDER.split(t))) for t in texts]
        new = list(islice(self.number, known, None))
        if new:
            self._learn(new)
        which = np.fromiter(chain.from_iterable(units), dtype=np.int64)
        first = np.concatenate([[0], np.cumsum([len(x) for x in units])])[:-1]
        counts = self.counts[which]
        told = np.concatenate([np.add.reduceat(counts[:, :3], first), np.minimum.reduceat(counts[:, 3:], first)], axis=1)
        groups = [b";".join([self.texts[u] for u in x]) for x in units]
        place, at = gather(self.links_at, which)
        of = np.repeat(np.repeat(np.arange(len(texts)), [len(x) for x in units]), np.diff(at))
        pairs = self.links[place]
        self.kept_chars += sum(map(len, new))
        if len(self.number) > KEPT_UNITS or self.kept_chars > KEPT_CHARS:
            self._forget()
        return told, groups, pairs, of


def _parts(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > STEP_CHARS and (m := _BORDER.search(text, at + STEP_CHARS)):
        yield text[at: m.start()]
        at = m.end()
    yield text[at:]


def _counted(key: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and how often each stands there (or the sum of its ``n``)."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    if n is None:
        return key[first], np.diff(np.append(first, len(key)))
    return key[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


# ------------------------------------------------------------------ compressed bitmaps
def pack_bitmaps(row: np.ndarray, doc: np.ndarray, n_rows: int, n_docs: int) -> pa.Array:
    """One compressed bitmap per row from entries sorted by (row, doc): a byte 0 and the documents as 16-bit
    numbers, or where that is shorter a byte 1 and the bits; nothing for no documents."""
    count = np.bincount(row, minlength=n_rows)
    wide = (n_docs + 7) // 8
    dense = 2 * count > wide
    size = np.where(count == 0, 0, 1 + np.where(dense, wide, 2 * count))
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(at[-1], dtype=np.uint8)
    start = np.concatenate([[0], np.cumsum(count)])
    few = ~dense[row]
    place = at[row[few]] + 1 + 2 * (np.flatnonzero(few) - start[row[few]])
    out[place], out[place + 1] = doc[few] & 255, doc[few] >> 8
    which = np.flatnonzero(dense)
    for lo in range(0, len(which), 512):                    # at most 512 x BLOCK_DOCS bits at a time
        some = which[lo: lo + 512]
        bits = np.zeros((len(some), 8 * wide), dtype=bool)
        for k, r in enumerate(some.tolist()):
            bits[k, doc[start[r]: start[r + 1]]] = True
        packed = np.packbits(bits, axis=1, bitorder="little")
        out[at[some]] = _DENSE
        out[(at[some] + 1)[:, None] + np.arange(wide)] = packed
    return pa.Array.from_buffers(pa.binary(), n_rows, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(out)])


def unpack_bitmaps(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, doc) entries of a column of compressed bitmaps; nulls hold nothing."""
    at = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] is not None else np.zeros(0, dtype=np.uint8)
    size = np.diff(at)
    has = np.flatnonzero((size > 1) & (~np.asarray(col.is_null())))
    dense = data[at[has]] == _DENSE
    rows, docs = [], []
    few = has[~dense]
    place, off = gather(np.stack([at[few] + 1, at[few] + size[few]], axis=1).ravel(), 2 * np.arange(len(few)))
    raw = data[place].reshape(-1, 2).astype(np.int64)
    rows.append(np.repeat(few, np.diff(off) // 2))
    docs.append(raw[:, 0] | raw[:, 1] << 8)
    for r in has[dense].tolist():
        bits = np.flatnonzero(np.unpackbits(data[at[r] + 1: at[r + 1]], bitorder="little"))
        rows.append(np.full(len(bits), r))
        docs.append(bits)
    return np.concatenate(rows), np.concatenate(docs)


_POPCOUNT = "CASE WHEN octet_length({0}) = 0 THEN 0L WHEN substr({0}, 1, 1) = X'00' THEN (octet_length({0}) - 1) div 2 ELSE bitmap_count(substr({0}, 2)) END"

_INDEX = pa.schema([("block", pa.int64()), ("pos", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()),
                    ("pair", pa.int64()), ("docs", pa.binary()), ("planes", pa.list_(pa.binary()))])
_INDEX_SQL = ("block bigint, pos int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, "
              "pair bigint, docs binary, planes array<binary>")


def _rows(n: int, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.nulls(n, f.type) if f.name not in cols else cols[f.name] if isinstance(cols[f.name], pa.Array)
                                       else pa.array(cols[f.name], f.type) for f in _INDEX], schema=_INDEX)


class _Block:
    """The documents of a block and the entries (pair, document, links) found so far."""

    def __init__(self, number: int, keep_groups: bool):
        self.number, self.keep, self.ids, self.told, self.sha, self.groups, self.entries, self.chars = number, keep_groups, [], [], [], [], [], 0

    def add(self, al: Aligner, docs: list[tuple[int | None, str]]) -> None:
        """Whole texts, or one that is longer than a step."""
        first = len(self.ids)
        self.ids += [d for d, _ in docs]
        self.chars += sum(len(t) for _, t in docs)
        self.told += [np.array([0, 0, 0, 1])] * len(docs)
        self.sha += [None] * len(docs)
        self.groups += [[] for _ in docs]
        queue = [(first + k, t) for k, (_, t) in enumerate(docs) if t]
        if len(queue) == 1:
            steps = [[(queue[0][0], p)] for p in _parts(queue[0][1])]
        else:
            steps = [queue] if queue else []
        for work in steps:
            told, groups, pairs, of = al.step([t for _, t in work])
            for (k, _), n, g in zip(work, told, groups):
                self.told[k] = np.append(self.told[k][:3] + n[:3], self.told[k][3] & n[3])
                if self.sha[k] is None:
                    self.sha[k] = hashlib.sha256()
                else:
                    self.sha[k].update(b";")
                self.sha[k].update(g)
                if self.keep:
                    self.groups[k].append(g)
            doc = np.array([k for k, _ in work], dtype=np.int64)[of]
            self.entries.append(_counted(pairs * BLOCK_DOCS + doc))

    def tables(self) -> Iterator[pa.RecordBatch]:
        n = len(self.ids)
        told = np.array(self.told).reshape(-1, 4)
        ok = (told[:, 3] > 0) & (told[:, 0] > 0)
        key, times = _counted(*(np.concatenate([e[i] for e in self.entries] or [np.zeros(0, dtype=np.int64)]) for i in (0, 1)))
        here = ok[key % BLOCK_DOCS]
        key, times = key[here], times[here]
        doc = key % BLOCK_DOCS
        told = np.where(ok[:, None], told, 0)
        n_links = np.zeros(n, dtype=np.int64)
        np.add.at(n_links, doc, times)
        shown = [s.hexdigest() if good else "" for s, good in zip(self.sha, ok)]
        text = [b";".join(g).decode() if good else "" for g, good in zip(self.groups, ok)] if self.keep else [None] * n
        yield _rows(n, block=[self.number] * n, pos=np.arange(n, dtype=np.int32), doc_id=self.ids, n_a=told[:, 0], n_b=told[:, 1], n_groups=told[:, 2],
                    n_links=n_links, groups_sha256=shown, groups=text)
        pair, row = np.unique(key // BLOCK_DOCS, return_inverse=True)
        if not len(pair):
            return
        docs = pack_bitmaps(row, doc, len(pair), n)
        # planes of the surplus over one link
        surplus = times - 1
        most = np.zeros(len(pair), dtype=np.int64)
        np.maximum.at(most, row, surplus)
        n_planes = np.ceil(np.log2(most + 1)).astype(np.int64)
        plane_at = np.concatenate([[0], np.cumsum(n_planes)])
        hits = [(plane_at[row[s]] + k, doc[s]) for k in range(int(n_planes.max())) if len(s := np.flatnonzero(surplus >> k & 1))]
        if hits:
            p, d = np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])
            order = np.lexsort((d, p))
            flat = pack_bitmaps(p[order], d[order], int(plane_at[-1]), n)
        else:
            flat = pa.array([], pa.binary())
        planes = pa.ListArray.from_arrays(pa.array(plane_at, pa.int32()), flat)
        for lo in range(0, len(pair), 10_000):
            m = min(10_000, len(pair) - lo)
            yield _rows(m, block=[self.number] * m, pair=pair[lo: lo + m], docs=docs.slice(lo, m), planes=planes.slice(lo, m))


def index(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = False) -> DataFrame:
    """The inverted index as a table in the shared folder: a row per document (``pair`` null) and per (block, pair)."""
    def run(batches):
        from pyspark import TaskContext
        al, part, number = aligner(path_a, path_b), TaskContext.get().partitionId(), 0
        block = _Block(part << 32, keep_groups)
        for rb in batches:
            step, size = [], 0
            rows = list(zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()))
            for i, (d, t) in enumerate(rows):
                if step and (size + len(t or "") > STEP_CHARS or len(block.ids) + len(step) == BLOCK_DOCS):
                    block.add(al, step)
                    step, size = [], 0
                if block.chars > BLOCK_CHARS or len(block.ids) == BLOCK_DOCS:
                    yield from block.tables()
                    number += 1
                    block = _Block((part << 32) + number, keep_groups)
                step.append((d, t or ""))
                size += len(t or "")
            block.add(al, step)
        yield from block.tables()

    return materialised(id_and_text(docs, id_col, text_col).mapInArrow(run, _INDEX_SQL), "token-pairs")


def pair_scores(postings: DataFrame, size_b: int) -> DataFrame:
    """``pair, a, b, n_docs, n_links, best``: documents and links of every id pair, and whether no other partner
    of its b has more links. Bitmaps are popcounted where they lie; only counts are shuffled."""
    n_docs = F.expr(_POPCOUNT.format("docs"))
    n_more = F.expr(f"aggregate(transform(planes, (p, k) -> shiftleft({_POPCOUNT.format('p')}, k)), 0L, (s, x) -> s + x)")
    pairs = (postings.where(F.col("pair").isNotNull()).groupBy("pair").agg(F.sum(n_docs).alias("n_docs"), F.sum(n_docs + n_more).alias("n_links"))
             .withColumn("a", F.floor(F.col("pair") / size_b)).withColumn("b", F.col("pair") % size_b))
    most = pairs.groupBy("b").agg(F.max("n_links").alias("most"))        # at most one row per id of B
    return pairs.join(F.broadcast(most), "b").select("pair", "a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def _per_document(batches):
    """Sums over a document's links from postings with scores (``block, docs, planes, n, best``)."""
    for rb in batches:
        block = rb.column(0).to_numpy()
        score, best = rb.column(3).to_numpy(), np.asarray(rb.column(4)).astype(np.int64)
        planes = rb.column(2)
        in_list = np.diff(np.asarray(planes.offsets))
        plane_row = np.repeat(np.arange(rb.num_rows), in_list)
        level = np.arange(len(plane_row)) - np.repeat(np.cumsum(in_list) - in_list, in_list)
        row, doc = unpack_bitmaps(rb.column(1))
        prow, pdoc = unpack_bitmaps(planes.flatten())
        times = np.concatenate([np.ones(len(row), dtype=np.int64), np.int64(1) << level[prow]])
        row, doc = np.concatenate([row, plane_row[prow]]), np.concatenate([doc, pdoc])
        of, where = np.unique(block, return_inverse=True)
        key, at = np.unique(where[row] * BLOCK_DOCS + doc, return_inverse=True)
        sums = np.zeros((2, len(key)), dtype=np.int64)
        np.add.at(sums[0], at, times * best[row])
        np.add.at(sums[1], at, times * score[row])
        yield pa.RecordBatch.from_arrays([pa.array(of[key // BLOCK_DOCS]), pa.array(key % BLOCK_DOCS, pa.int32()), pa.array(sums[0]), pa.array(sums[1])],
                                         ["block", "pos", "n_best", "count_sum"])


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = True) -> DataFrame:
    """How the tokens of two tokenizers meet in every text, scored by the whole table.

    A is a byte-level BPE file (a space is put before the text), B a SentencePiece model (which adds one itself); neither adds
    or reads special tokens. Returns ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` and, with
    ``keep_groups``, ``groups`` (``a1,a2|b1;a3|b2,b3``). Groups end where tokens of both end; links are the pairs of
    tokens whose bytes overlap; a pair's count is its number of links in the whole table; ``n_best`` counts links to the
    (or a) commonest partner of their B id, ``count_sum`` adds up the counts.

    Null and empty texts, and texts whose bytes either side does not give back, have no tokens: zeros and ''.
    A very long text is aligned in parts that end at unit borders. Repeated rows and repeated or null ids each give a row
    and count; an empty table gives none; other columns are not read.
    """
    import sentencepiece
    spark = docs.sparkSession
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    table = index(docs, path_a, path_b, id_col, text_col, keep_groups)
    scores = materialised(pair_scores(table, size_b).select("pair", F.col("n_links").alias("n"), "best"), "pair-scores")
    postings = table.where(F.col("pair").isNotNull()).select("block", "docs", "planes", "pair")
    small = scores.count() <= BROADCAST_PAIRS
    scored = postings.join(F.broadcast(scores) if small else scores.hint("merge"), "pair").select("block", "docs", "planes", "n", "best")
    if not small:
        scored = scored.repartition("block")                 # so that a block's documents are added up in one place
    sums = (scored.mapInArrow(_per_document, "block bigint, pos int, n_best bigint, count_sum bigint")
            .groupBy("block", "pos").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    told = table.where(F.col("pair").isNull()).drop("pair", "docs", "planes")
    out = told.join(sums, ["block", "pos"], "left").fillna(0, ["n_best", "count_sum"])
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *["groups"] * keep_groups)
