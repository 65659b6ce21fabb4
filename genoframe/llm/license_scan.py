"""Licence scan with a positional rare-token index.

Licence templates are word sequences. The index maps a word to its postings
``(template, position)``. Every occurrence in a text of a template's rarest word (highest
inverse document frequency in the corpus) proposes an alignment; the postings of the
template's other words are intersected by relative position, and a template counts only
where its mandatory key phrase stands at the aligned place.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.frames import id_and_text
from genoframe.llm.textbuf import ALNUM, LOWER, chunks, span_hashes

# The base phrases and their labels.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

# Usual licence notices (label, notice, mandatory key phrase).
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    ("mit-notice", "released under the mit license", "under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights", "waived all copyright and related rights"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "released into the public domain"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
]

#: Share of a notice's IDF weight that must match at the aligned place.
MIN_MATCH = 0.7


@dataclass
class Template:
    label: str
    words: list[str]
    key: list[str]
    base: bool
    key_at: int = field(init=False)

    def __post_init__(self):
        n = len(self.key)
        self.key_at = next(i for i in range(len(self.words) - n + 1) if self.words[i: i + n] == self.key)


def words_of(text: str) -> list[str]:
    """Reference tokenisation of a short text."""
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def default_templates() -> list[Template]:
    return ([Template(label, words_of(p), words_of(p), True) for p, label in BASE]
            + [Template(label, words_of(n), words_of(k), False) for label, n, k in NOTICES])


def hash_word(word: str) -> int:
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(span_hashes(raw, np.array([0]), np.array([len(raw)]))[0])


def document_frequency(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> tuple[dict[str, int], int]:
    """In how many texts each vocabulary word stands, over all texts, and the number of texts.

    The vocabulary is that of the templates, so the result is as small as they are.
    """
    vocab = sorted(set(vocabulary))

    def run(batches):
        keys = np.array([hash_word(w) for w in vocab], dtype=np.uint64)
        order = np.argsort(keys)
        keys, total, rows = keys[order], np.zeros(len(vocab), dtype=np.int64), 0
        for _, chunk in chunks(batches):
            rows += len(chunk)
            s, e, row = chunk.words(ALNUM, low := LOWER[chunk.buf])
            h = span_hashes(low, s, e)
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[at] == h
            pairs = np.unique(at[hit] * (len(chunk) + 1) + row[hit])
            total += np.bincount(pairs // (len(chunk) + 1), minlength=len(vocab))
        names = np.array(vocab, dtype=object)[order]
        yield pa.RecordBatch.from_arrays([pa.array([*names, None], pa.string()), pa.array([*total.tolist(), rows], pa.int64())], ["word", "n"])

    got = id_and_text(docs, id_col, text_col).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    df = {r["word"]: int(r["n"]) for r in got}
    return {w: df.get(w, 0) for w in vocab}, df.get(None, 0)


class PositionalIndex:
    """Postings of the templates' words, and each template's words from rarest to commonest."""

    def __init__(self, templates: list[Template], df: dict[str, int], n_docs: int):
        self.templates = templates
        self.idf = {w: math.log((1 + n_docs) / (1 + df.get(w, 0))) + 0.01 for t in templates for w in t.words}
        self.hash = {w: np.uint64(hash_word(w)) for w in self.idf}
        self.postings: dict[str, list[tuple[int, int]]] = {}
        self.by_rarity = []
        for k, t in enumerate(templates):
            for i, w in enumerate(t.words):
                self.postings.setdefault(w, []).append((k, i))
            # look up the rarest word of the part that must be there, then the rest by rarity
            inside = [i for i in range(len(t.words)) if t.key_at <= i < t.key_at + len(t.key)]
            anchor = max(inside, key=lambda i: (self.idf[t.words[i]], -i))
            rest = sorted((i for i in range(len(t.words)) if i != anchor), key=lambda i: (i not in inside, -self.idf[t.words[i]], i))
            self.by_rarity.append([anchor, *rest])
        anchors = sorted({t.words[o[0]] for t, o in zip(templates, self.by_rarity)})
        self.looked_up = [(w, [(k, i) for k, i in self.postings[w] if self.by_rarity[k][0] == i]) for w in anchors]

    def places(self, h: np.ndarray, row: np.ndarray, find: np.ndarray):
        """``(template, start words, matched weight)`` for each template that stands somewhere.

        ``find`` sorts ``h``. A start can lie before its text for a notice that is cut off
        on the left; only words of the same text count.
        """
        n, sorted_h = len(h), h[find]
        for word, postings in self.looked_up:
            lo, hi = np.searchsorted(sorted_h, self.hash[word], "left"), np.searchsorted(sorted_h, self.hash[word], "right")
            if lo == hi:
                continue
            occ = np.sort(find[lo:hi])
            for k, at in postings:
                t, start = self.templates[k], occ - at
                home, got, weight = row[occ], np.full(len(occ), self.idf[word]), self.idf[word]
                inside = len(t.key) - 1
                for rank, i in enumerate(self.by_rarity[k][1:]):
                    p = start + i
                    ok = (p >= 0) & (p < n)
                    q = np.where(ok, p, 0)
                    ok &= (h[q] == self.hash[t.words[i]]) & (row[q] == home)
                    weight += self.idf[t.words[i]]
                    if rank < inside:           # mandatory key phrase: drop what lacks a word of it
                        start, home, got = start[ok], home[ok], got[ok] + self.idf[t.words[i]]
                        if not len(start):
                            break
                    else:
                        got = got + np.where(ok, self.idf[t.words[i]], 0.0)
                if len(start):
                    yield k, start, home, got / weight


def scan(docs: DataFrame, templates: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text",
         min_match: float = MIN_MATCH) -> DataFrame:
    """Licences of every whole text.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    places``: ``n_base`` counts all places of base phrases, ``first_word`` / ``last_word`` are
    the least and greatest start of them (words from 0, else null), labels are distinct,
    sorted and comma-joined (empty string: none), score is the best matched share of a
    template's IDF weight, and places lists ``label, start word, matched share``. A null or
    empty text has no words. Repeated rows each give a row. Two passes over the texts (document
    frequencies, then the scan), no shuffle of texts.
    """
    templates = templates or default_templates()
    base = id_and_text(docs, id_col, text_col)
    df, n_docs = document_frequency(base, [w for t in templates for w in t.words])

    def run(batches):
        index = PositionalIndex(templates, df, n_docs)
        for part, chunk in chunks(batches):
            n = len(chunk)
            low = LOWER[chunk.buf]
            s, e, row = chunk.words(ALNUM, low)
            h = span_hashes(low, s, e)
            first_of = np.searchsorted(row, np.arange(n), "left")
            n_words = np.bincount(row, minlength=n)
            n_base = np.zeros(n, dtype=np.int64)
            spans: list[list[tuple[str, int, float]]] = [[] for _ in range(n)]
            ends: dict[int, list[int]] = {}
            base_labels, labels, score = [set() for _ in range(n)], [set() for _ in range(n)], np.zeros(n)
            for k, start, home, share in index.places(h, row, np.argsort(h, kind="stable")):
                t = templates[k]
                for p, r, v in zip(start.tolist(), home.tolist(), share.tolist()):
                    if v < min_match:
                        continue
                    here = p - int(first_of[r])
                    spans[r].append((t.label, here, min(1.0, v)))
                    labels[r].add(t.label)
                    score[r] = max(score[r], min(1.0, v))
                    if t.base:
                        n_base[r] += 1
                        base_labels[r].add(t.label)
                        ends.setdefault(r, []).append(here)
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(n_words, pa.int64()), pa.array(n_base, pa.int64()),
                pa.array([min(ends[r]) if r in ends else None for r in range(n)], pa.int64()),
                pa.array([max(ends[r]) if r in ends else None for r in range(n)], pa.int64()),
                pa.array([",".join(sorted(x)) for x in base_labels], pa.string()),
                pa.array([",".join(sorted(x)) for x in labels], pa.string()), pa.array(score, pa.float64()),
                pa.array([[{"label": a, "start": b, "share": c} for a, b, c in sorted(x, key=lambda y: (y[1], y[0]))] for x in spans], PLACES)],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"])

    return base.mapInArrow(run, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                                "base_labels string, labels string, score double, "
                                "places array<struct<label:string,start:bigint,share:double>>")


PLACES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("share", pa.float64())]))
