"""Token alignment against the two libraries and plain counting."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from genoframe.llm import token_align
from genoframe.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BITS = ["a", "b", " ", "  ", "   ", "\n", " \n ", "é", "ü", "1", "!", "<|endoftext|>", "<s>", "<0x41>", "'s", "日本", "́", " ", "\x1c", "\t", "the", "ing",
        "\U0001F600", "x,y", "ﬁ", "  \t  "]


def brute(rows):
    """The contract, text by text: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) and the links of every pair."""
    import sentencepiece
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(A)
    lib.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    hidden = [b for b in range(256) if b not in shown]
    to_byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    count, docs, of = Counter(), Counter(), []
    for i, t in rows:
        a = lib.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        ba = [bytes(to_byte[c] for c in lib.id_to_token(x)) for x in a]
        bb = [bytes([int(sp.id_to_piece(x)[3:5], 16)]) if sp.is_byte(x) else sp.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if not t or not b"".join(ba) == b"".join(bb) == (" " + t).encode():
            of.append((i, [], [], [], ""))
            continue
        ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        links, k = [], 0
        for x, e, size in zip(a, ea, map(len, ba)):
            while eb[k] <= e - size:
                k += 1
            j = k
            while j < len(b) and eb[j] - len(bb[j]) < e:
                links.append((x, b[j]))
                j += 1
        groups, last_a, last_b = [], 0, 0
        for e in sorted(set(ea) & set(eb)):
            na, nb = ea.index(e) + 1, eb.index(e) + 1
            groups.append(",".join(map(str, a[last_a:na])) + "|" + ",".join(map(str, b[last_b:nb])))
            last_a, last_b = na, nb
        count.update(links)
        docs.update(set(links))
        of.append((i, a, b, links, ";".join(groups)))
    most = {}
    for (x, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    out = [(i, len(a), len(b), g.count("|"), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), g)
           for i, a, b, links, g in of]
    return out, count, docs, most


def mixed(seed, n, longest=40):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice(BITS) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def rows_of(df):
    return sorted(((r.doc_id is not None, r.doc_id or 0, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups, r.groups_sha256)
                   for r in df.collect()))


def wanted(rows):
    return sorted((i is not None, i or 0, *rest, g, hashlib.sha256(g.encode()).hexdigest() if g else "") for i, *rest, g in brute(rows)[0])


@pytest.mark.parametrize("small", [True, False])
def test_equals_the_libraries(spark, docs, corpus, monkeypatch, small):
    if not small:                                       # many blocks, scores by a shuffle
        monkeypatch.setattr(token_align, "BROADCAST_PAIRS", 0)
    texts = mixed(1, 150) + ["a▁b", "�", "\x00", " ", "   ", "a ", "a   ", " a", "\n", "a \n b", "a\n  b", "tail ▁"]
    extra = spark.createDataFrame([(1000 + i, t, *[None] * 6) for i, t in enumerate(texts)] + [(None, "no id", *[None] * 6), (3, "again", *[None] * 6)], docs.schema)
    rows = [*corpus, *((1000 + i, t) for i, t in enumerate(texts)), (None, "no id"), (3, "again")]
    assert rows_of(token_align.align(docs.unionByName(extra).repartition(3), A, B)) == wanted(rows)


def test_blocks_and_parts_do_not_change_the_result(spark, monkeypatch):
    texts = mixed(5, 60, 60)
    al = token_align.Aligner(A, B)

    def run(docs_, chars, step, per_block):
        monkeypatch.setattr(token_align, "STEP_CHARS", step)
        out = []
        for lo in range(0, len(docs_), per_block):
            block = token_align._Block(lo, True)
            for d in docs_[lo: lo + per_block]:
                block.add(al, [d])
            tabs = list(block.tables())
            out += [(r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"], r["groups"]) for r in tabs[0].to_pylist()]
        return out
    docs_ = list(enumerate(texts))
    whole = run(docs_, 1 << 20, 1 << 20, 60)
    assert run(docs_, 1 << 20, 30, 7) == whole
    want = [(i, na, nb, ng, nl, hashlib.sha256(g.encode()).hexdigest() if g else "", g) for i, na, nb, ng, nl, _, _, g in brute(docs_)[0]]
    assert whole == want


def test_pair_scores(spark, docs, corpus):
    import sentencepiece
    size_b = sentencepiece.SentencePieceProcessor(model_file=B).get_piece_size()
    got = {(r.a, r.b): (r.n_docs, r.n_links, r.best) for r in token_align.pair_scores(token_align.index(docs, A, B), size_b).collect()}
    _, count, in_docs, most = brute(corpus)
    assert got == {p: (in_docs[p], n, n == most[p[1]]) for p, n in count.items()}
    assert max(n for _, n, _ in got.values()) > 1000            # "z z z ..." needs many planes


def test_bitmaps_round_trip():
    rng = np.random.default_rng(2)
    n_docs, rows = 300, []
    for r, n in enumerate([0, 1, 5, 300, 18, 19, 20, 150, 0, 37]):
        rows += [(r, d) for d in sorted(rng.choice(n_docs, n, replace=False).tolist())]
    row, doc = np.array(rows).T
    col = token_align.pack_bitmaps(row, doc, 10, n_docs)
    back = sorted(zip(*(x.tolist() for x in token_align.unpack_bitmaps(col))))
    assert back == rows
    assert sorted(zip(*(x.tolist() for x in token_align.unpack_bitmaps(col.slice(3, 5))))) == [(r - 3, d) for r, d in rows if 3 <= r < 8]
    assert all(len(v) <= 1 + (n_docs + 7) // 8 for v in col.to_pylist())
    assert not len(token_align.unpack_bitmaps(pa.array([], pa.binary()))[0])


def test_empty_table(spark, no_docs):
    assert token_align.align(no_docs, A, B).count() == 0


def test_registered_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op11_cross_tokenizer_alignment"](spark, sf).collect())
    assert got == sorted((*x[:-1], hashlib.sha256(x[-1].encode()).hexdigest() if x[-1] else "") for x in brute(rows)[0])
