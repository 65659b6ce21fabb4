"""The speculative BPE against the tokenizer library itself."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from genoframe.llm import spec_bpe
from genoframe.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
BITS = ["a", "b", " ", "  ", "\n", "\r\n", "é", "ü", "1", "22", "!", "...", "<|endoftext|>", "<|", "'s", "'ll", "'S", "日本", "́", " ",
        "\x85", "\x1c", "\t", "aaaa", "the", "ing", "😀", "՘", "\U000107bb", " ", "Σ", "ŋ", "\x00", "²", "½", "ⅷ", "ʰ", "�"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return spec_bpe.tokenizer(PATH)


def mixed(seed, n, longest):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_ids_and_text_equal_the_library(library, own):
    texts = mixed(1, 3000, 50)
    ids, off = own.encode_texts(texts)
    for t, a, b in zip(texts, off, off[1:]):
        want = library.encode(t, add_special_tokens=False).ids
        assert ids[a:b].tolist() == want
        assert own.decode(ids[a:b]) == library.decode(want, skip_special_tokens=False)


def test_special_strings_as_plain_text(own):
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    text = "a<|endoftext|> b"
    assert own.encode_texts([text], False)[0].tolist() == plain.encode(text, add_special_tokens=False).ids
    assert own.encode(text).tolist().count(own.special["<|endoftext|>"]) == 1


def test_compatible_pairs_equal_exact_merging(own):
    rng = np.random.default_rng(3)
    known = np.flatnonzero(own.rank >= 0)
    a, b = rng.choice(known, 20000), rng.choice(known, 20000)
    short = own.length[a] + own.length[b] <= 40
    a, b = a[short], b[short]
    ids, off = own._merge([own.decode_bytes(np.array(p)) for p in zip(a, b)])
    exact = np.array([ids[i:j].tolist() == [x, y] for i, j, x, y in zip(off, off[1:], a, b)])
    assert (own.compatible(a, b) == exact).all() and 0 < exact.sum() < len(exact)


def test_merging_side_by_side_equals_the_heap(own):
    rng = random.Random(4)
    raws = ["".join(rng.choice("aabeinthst ") for _ in range(rng.randint(1, 40))).encode() for _ in range(500)]
    ids, off = own._merge(raws)
    assert [ids[i:j].tolist() for i, j in zip(off, off[1:])] == [own._merge_long(r) for r in raws]


@pytest.mark.parametrize("piece", [" ", "x", "a b", "日", "1", "!", "\n ", "ab", "é"])
def test_very_long_texts_of_one_kind(library, own, piece):
    text = piece * (60_000 // len(piece)) + "<|endoftext|>z"
    assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert own.decode(own.encode(text)) == text


def test_two_million_characters_do_not_crash(own):
    for piece in (" ", "日", "!"):
        text = piece * 2_000_000
        assert own.decode(own.encode(text)) == text


def test_parts_do_not_change_the_ids(library, own, monkeypatch):
    texts = mixed(7, 40, 400)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(spec_bpe, "BLOCK_CHARS", 64)
    monkeypatch.setattr(spec_bpe, "KEPT_WORDS", 20)
    assert [own.encode(t).tolist() for t in texts] == want


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        spec_bpe.ByteLevelBPE(public_tokenizers.path("word_bpe_49k.json"))


def test_rows_of_a_table(spark, docs, corpus, no_docs, library):
    extra = spark.createDataFrame([(None, "a<|endoftext|>", *[None] * 6), (3, "again", *[None] * 6)], docs.schema)
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids, r.decoded)
                 for r in spec_bpe.encode(docs.unionByName(extra), PATH).collect())
    want = []
    for i, t in [*corpus, (None, "a<|endoftext|>"), (3, "again")]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i is not None, i or 0, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest(), ids, back))
    assert got == sorted(want)
    assert spec_bpe.encode(no_docs, PATH).count() == 0


def test_registered_query(spark, sf, library):
    got = {r.doc_id: r for r in QUERIES["op13_bpe_encoding"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_byte_level_long_runs_of_every_class(monkeypatch):
    import random

    import public_tokenizers
    from genoframe.llm import bpe
    enc = bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    # short forms of long runs, against the library on the whole text
    rnd = random.Random(3)
    pieces = ["x", "7", "!", "'s", "\u6f22", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\u0085", "\u001c", "\u200b", "don't"]
    monkeypatch.setattr(bpe, "PART_CHARS", 12)
    monkeypatch.setattr(bpe, "LONG_SPACE", 3)
    for _ in range(3000):
        text = "".join(rnd.choice(pieces) * rnd.choice([1, 1, 2, 9]) for _ in range(rnd.randrange(12)))
        assert bpe.encode_text(enc, text) == enc.encode_ordinary(text), text
    monkeypatch.undo()
    n = 2_000_000
    for unit in ["a", "\u6f22\u5b57", "1234567", "!?", " ", "\n \t", "\u3000", "\U0001F600"]:
        run = unit * (n // len(unit))
        for text in (run, f"see{run}end", f"see{run} x"):
            assert enc.decode_bytes(bpe.encode_text(enc, text)) == text.encode(), unit
