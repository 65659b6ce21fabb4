"""The operators against brute force on a small corpus with every odd case, and on empty tables."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash


def low(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_suffix_dedup(docs, corpus, no_docs):
    from genoframe.llm import suffix_dedup
    got = by_id(suffix_dedup.remove_repeats(docs))
    first = {}
    for d, t in corpus:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            first.setdefault(b[i: i + 50], d)
    removed = 0
    for d, t in corpus:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - 49):
            if first[b[i: i + 50]] < d:
                gone[i + 1: i + 51] = True
        kept = bytes(x for x, g in zip(b, gone[1:]) if not g)
        r = got[d]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()))
        assert bytes(r.kept) == kept and r.kept_sha256 == hashlib.sha256(kept).hexdigest()
        removed += int(gone.sum())
    assert removed > 500
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_suffix_levels_are_a_logarithmic_family():
    from genoframe.llm.suffix_dedup import SuffixLevels
    family, rng, seen = SuffixLevels(), np.random.default_rng(1), set()
    for _ in range(40):
        keys = np.unique(rng.integers(0, 50_000, 500).astype("S8"))
        assert family.holds(keys).tolist() == [k in seen for k in keys.tolist()]
        family.add(keys)
        seen.update(keys.tolist())
    sizes = [len(x) for x in family.levels]
    assert len(sizes) <= 8 and all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))


def test_compact_windows_partition_subsequences():
    from genoframe.llm.compact_windows import windows
    from genoframe.llm.textbuf import mix
    rng = np.random.default_rng(3)
    token, width = rng.integers(0, 60, 150).astype(np.uint64), 7
    first, last = np.repeat([0, 90], [90, 60]), np.repeat([89, 149], [90, 60])
    lo, c, hi = windows(token, first, last, 2, width)
    h = mix(token ^ np.uint64(0xA0761D6478BD642F * 5 & (1 << 64) - 1))
    for a, b in [(0, 90), (90, 150)]:
        for i in range(a, b):
            for j in range(i + width - 1, b):
                at = i + int(h[i: j + 1].argmin())
                assert ((lo <= i) & (c == at) & (hi >= j)).sum() == 1


def test_passages(docs, corpus, no_docs, spark):
    from genoframe.llm import compact_windows
    got = by_id(compact_windows.near_duplicate_passages(docs))
    w = {d: words(t) for d, t in corpus}
    first = {}
    for d, x in w.items():
        for i in range(len(x) - 49):
            first.setdefault(tuple(x[i: i + 50]), d)
    for d, x in w.items():
        must = {p for i in range(len(x) - 49) if first[tuple(x[i: i + 50])] < d for p in range(i, i + 50)}
        have = {p for s in got[d].spans for p in range(s.lo, s.hi)}
        assert must <= have, d
        if not must:
            assert len(have) == 0 or got[d].other_ids
    assert got[63].class_id == got[63].doc_id and got[64].class_id == 63 and got[64].other_ids == [63]
    assert got[0].n_links == 0 and got[0].class_id == 0
    cut = by_id(compact_windows.remove_passages(docs))
    assert cut[63].text == corpus[63][1] and cut[69].text is None and cut[68].text == ""
    assert words(cut[64].text) == w[64][got[64].spans[0].hi:]
    assert compact_windows.near_duplicate_passages(no_docs).count() == 0
    rng = np.random.default_rng(2)
    base = [f"w{x}" for x in rng.integers(0, 10 ** 6, 300)]
    other = list(base)
    for at in (60, 150, 240):
        other[at] = "changed"
    near = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(other))], "doc_id bigint, text string")
    assert by_id(compact_windows.near_duplicate_passages(near))[2].n_repeated >= 280


def test_passages_past_the_smallest_holder(spark):
    """Two smaller documents quote parts, under 50 words each, of a passage that two later documents share."""
    from genoframe.llm import compact_windows
    rng = np.random.default_rng(8)
    rows, want = [], {}

    def fresh(n):
        return [f"w{x}" for x in rng.integers(0, 10 ** 9, n)]
    for k in range(40):
        passage, at = fresh(60), 10 * k
        rows += [(at, " ".join(fresh(60) + passage[:40] + fresh(60))), (at + 1, " ".join(fresh(60) + passage[20:] + fresh(60))),
                 (at + 2, " ".join(fresh(60) + passage + fresh(60))), (at + 3, " ".join(fresh(30) + passage + fresh(90)))]
        want[at + 3] = (at + 2, 30, 90)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = by_id(compact_windows.near_duplicate_passages(df))
    for d, (other, lo, hi) in want.items():
        assert got[d].class_id == other and got[d].other_ids == [other], d
        assert any(s.lo <= lo and s.hi >= hi for s in got[d].spans), d
        assert got[d - 3].n_links == got[d - 2].n_links == got[d - 1].n_links == 0


def test_passages_of_several_documents(spark):
    """Different texts that share one passage are all linked, a tail past a verified passage is found, a copy has the links of its text."""
    from genoframe.llm import compact_windows
    rng = np.random.default_rng(11)

    def fresh(n):
        return [f"w{x}" for x in rng.integers(0, 10 ** 9, n)]
    rows = []
    for k in range(10):
        passage, at = fresh(120), 10 * k
        texts = [fresh(40) + passage[:90] + fresh(40), *(fresh(20) + passage + fresh(20 + i) for i in range(4))]
        rows += [(at + i, " ".join(t)) for i, t in enumerate([*texts, texts[2]])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = by_id(compact_windows.near_duplicate_passages(df))
    cut = by_id(compact_windows.remove_passages(df))
    for k in range(0, 100, 10):
        for i in range(5):
            assert got[k + i].other_ids == list(range(k, k + i)) and got[k + i].n_links == i and got[k + i].class_id == k
        for i in range(2, 5):
            assert any(s.lo <= 20 and s.hi >= 140 for s in got[k + i].spans), k + i
            assert len(words(cut[k + i].text)) <= 40 + i - 1
        assert got[k + 5].other_ids == list(range(k, k + 5)) and got[k + 5].class_id == k and cut[k + 5].text == ""


def test_near_copies_with_an_edit_near_an_edge():
    """verify() against every pair of stretches of 50 words, for each place of the edit."""
    import pyarrow as pa
    from genoframe.llm import compact_windows as cw
    from genoframe.llm.textbuf import string_parts
    rng = np.random.default_rng(9)

    def fresh(n):
        return [f"w{x}" for x in rng.integers(0, 10 ** 9, n)]
    for before, after in [(30, 30), (0, 20), (20, 0), (0, 0)]:
        for edit in range(-1, 50):
            passage = fresh(50)
            changed = [*passage[:edit], *fresh(1), *passage[edit + 1:]] if edit >= 0 else passage[:44] + fresh(6)
            a, b = fresh(before) + changed + fresh(after), fresh(after) + passage + fresh(before)
            (x, u), (y, v) = (cw._tokens_and_words(*string_parts(pa.array([" ".join(t)]))) for t in (a, b))
            must = any(cw._jaccard(x[i: i + 46], y[j: j + 46]) >= 0.8 for i in range(len(x) - 45) for j in range(len(y) - 45)
                       if abs((i - before) - (j - after)) <= 5)
            got = cw.verify(x, y, 46, 0.8, u, v)
            assert bool(got) == must and must == (edit >= 0), (before, edit)
            assert all(q - p + 1 >= 46 for p, q in got)
            if 0 < edit < 49:
                assert got == [(before, before + 45)], (before, edit)


def test_license_scan(docs, corpus, no_docs):
    from genoframe.llm import license_scan
    got = by_id(license_scan.scan(docs))
    for d, t in corpus:
        w = words(t)
        at = [(i, label) for p, label in license_scan.BASE for i in range(len(w)) if w[i: i + len(p.split())] == p.split()]
        r = got[d]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None)
        assert r.base_labels == ",".join(sorted({x for _, x in at})) and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1
    assert got[66].labels == "mit,mit-notice" and got[67].n_base == 3
    assert license_scan.scan(no_docs).count() == 0


def components_of(ids, linked):
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_simhash(docs, corpus, no_docs):
    from genoframe.llm import simhash
    got, fp = by_id(simhash.near_duplicates(docs)), {}
    for d, t in corpus:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        h = [xxhash.xxh64_intdigest(" ".join(w[i: i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
        fp[d] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    comp = components_of(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4])
    assert {d: (r.fingerprint, r.component_id) for d, r in got.items()} == {d: (f"{fp[d]:016x}", comp[d]) for d in fp}
    assert simhash.near_duplicates(no_docs).count() == 0


def test_simhash_cells_lose_no_link(spark):
    from genoframe.llm import simhash
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2 ** 63, 60).astype(np.uint64)
    fps = [int(x) for x in base]
    for x in base[:40]:
        for _ in range(6):
            bits = rng.choice(64, rng.integers(1, 6), replace=False)
            fps.append(int(x) ^ sum(1 << int(b) for b in bits))
    fps = sorted(set(fps))
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "rep bigint, fp bigint")
    edges = [(r.a, r.b) for r in simhash.links(df, 4).collect()]
    want = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    assert all((fps[a] ^ fps[b]).bit_count() <= 4 for a, b in edges)
    assert components_of(range(len(fps)), edges) == components_of(range(len(fps)), want)


def test_embeddings(spark):
    from genoframe.llm import multi_index
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 16))
    x = np.concatenate([x, x[:60] + 0.08 * rng.normal(size=(60, 16)), x[:5], x[:5], 2 * x[5:7]])
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    odd = [(1000, None, 0), (1001, [], 0), (1002, [0.0] * 16, 0), (1003, [float("nan")] * 16, 0), (1004, [1.0, 2.0], 0), (1005, [None] * 16, 1), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>, cell int")
    got = multi_index.near_duplicates(df).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    comp = components_of(range(len(x)), [(int(a), int(b)) for a, b in zip(*np.nonzero(near)) if a < b])
    have = {r.vec_id: r for r in got}
    assert len(got) == len(rows) + len(odd)
    assert sum(have[i].n_links for i in range(len(x))) >= 0.9 * near.sum() and all(have[i].n_links <= near[i].sum() for i in range(len(x)))
    assert np.mean([have[i].component_id == comp[i] for i in range(len(x))]) >= 0.95
    assert all((have[i].n_links, have[i].component_id, have[i].kept) == (0, i, True) for i in range(1000, 1006)) and not have[None].kept
    assert multi_index.near_duplicates(df.where("vec_id < 0")).count() == 0


def test_lm_scores(docs, corpus, no_docs):
    from genoframe.llm import ngram_lm
    w = {d: words(t) for d, t in corpus}
    uni, bi = Counter(x for t in w.values() for x in t), Counter(p for t in w.values() for p in zip(t, t[1:]))
    total = sum(uni.values())
    got = by_id(ngram_lm.score(docs))
    for d, t in w.items():
        u, b, n, s, back = Counter(t), Counter(zip(t, t[1:])), max(1, total - len(t)), 0.0, 0
        for i, x in enumerate(t):
            if i and bi[t[i - 1], x] > b[t[i - 1], x]:
                s += math.log((bi[t[i - 1], x] - b[t[i - 1], x]) / (uni[t[i - 1]] - u[t[i - 1]]))
                continue
            seen = uni[x] - u[x]
            back += bool(i) or not seen
            s += math.log(seen / n if seen else 1 / n) + math.log(0.4) * (bool(i) + (not seen))
        assert (got[d].n_words, got[d].n_backoff) == (len(t), back) and got[d].log_score == pytest.approx(s, abs=1e-6)
    assert ngram_lm.score(no_docs).count() == 0


def test_html(spark):
    from genoframe.llm import html_template
    box = "<div class=x>Read our house rules before you go on</div>"
    pages = [(i, f"http://Host.example/{i}", f"<nav>menu</nav>{box}<p>page {i} &amp; more</p><footer>f</footer>") for i in range(8)]
    pages += [(20, "http://other.example/", f"{box}<p>other</p>"), (21, None, f"{box}"), (22, "http://host.example/a",
              "<header><h1>Site</h1></header><article><header><h1>T</h1></header><p>One <b>two</b> <span class=ad>buy</span> three<br>four"
              "<p>Five<ul><li>a<li>b</ul><form>x</form><div class='comments'>no</div><script>1<2</script></article><aside>s</aside>"),
              (23, "http://host.example/b", None), (24, "", ""), (25, "http://host.example/c", "<p>open " + "word " * 20000), (26, "x", "<!-- cut")]
    df = spark.createDataFrame([(*p, "t") for p in pages], "page_id bigint, url string, html string, text string")
    got = by_id(html_template.extract(df.unionByName(df.where("page_id = 0"))), "page_id")
    assert all(got[i].text == f"page {i} & more" for i in range(8))
    assert got[20].text == "Read our house rules before you go on\nother" and got[21].text.startswith("Read our")
    assert got[22].text == "T\nOne two three four\nFive\na\nb"
    assert [got[i].text for i in (23, 24, 26)] == ["", "", ""] and got[25].n_chars == len("open " + "word " * 20000) - 1
    assert html_template.extract(df.where("page_id < 0")).count() == 0


def test_html_labels_of_whole_elements_and_attribute_names(spark):
    from genoframe.llm import html_template
    body = "<article><h1>T</h1><p>One two three</p></article>"
    pages = [f"<body class='{c}'>{body}</body>" for c in ("has-sidebar", "no-sidebar", "comments-open", "right-sidebar", "nav menu", "header")]
    pages += [f"<html class=cookie><body>{body}", f"<main class=related>{body}</main>", body.replace("<article>", "<article class='post share'>"),
              f"<div class='page has-sidebar comments-open'>{body}</div>", body.replace("<p>", "<p title='the hidden valley'>"),
              body.replace("<p>", "<div data-id='menu'>").replace("</p>", "</div>"), body.replace("<p>", "<p data-style='display:none' data-role=form>"),
              body.replace("two", "<a href='/hidden/gems'>two</a>"), body.replace("two", "<a href=/hidden/gems>two</a>")]
    gone = ["hidden", "HIDDEN=''", "class=ad", "class='ad-slot big'", "id=sidebar_left", "role='navigation'", "aria-hidden=true", "style='display: none'"]
    pages += [body.replace("<p>", f"<p title='a = b' {g}>") for g in gone]
    df = spark.createDataFrame([(i, None, p) for i, p in enumerate(pages)], "page_id bigint, url string, html string")
    got = by_id(html_template.extract(df), "page_id")
    n = len(pages) - len(gone)
    for i, p in enumerate(pages):
        assert got[i].text == ("T\nOne two three" if i < n else "T"), p


def test_html_copies_of_a_page_are_one_page(spark):
    from genoframe.llm import html_template
    one = "<div class=c><section><p>The only text</p></section></div>"
    pages = [(i, f"http://a.example/?utm={i}", one) for i in range(5)] + [(5, "http://a.example/", "<p>Other</p>")]
    pages += [(10 + i, "http://b.example/", f"<article>{one}</article><div>seen {i} times</div>") for i in range(6)]
    pages += [(20 + i, "http://c.example/", f"<main>{one}</main><p>{i}</p>") for i in range(6)]
    pages += [(30 + i, "http://d.example/", f"{one}<p>page {i}</p>") for i in range(6)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = by_id(html_template.extract(df), "page_id")
    for i, _, _ in pages:
        assert got[i].text == ("Other" if i == 5 else f"page {i - 30}" if i >= 30 else "The only text"), i


@pytest.mark.parametrize("small", [True, False])
def test_decontamination(spark, docs, corpus, no_docs, small, monkeypatch):
    from genoframe.llm import decontaminate
    if not small:
        monkeypatch.setattr(decontaminate, "MAX_PREFIXES", 0)
    w = {d: words(t) for d, t in corpus}
    items = [(1, " ".join(w[5][:14])), (10, " ".join(w[12])), (2, "Gnu General"), (3, None), (4, "!!"), (5, " ".join(w[5][2:20]).upper()), (2, "Gnu General")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = by_id(decontaminate.scan(docs, bench))
    for d, t in w.items():
        hit, found = set(), set()
        for i, text in items:
            x = words(text)
            m = min(10, len(x))
            for a in range(len(x) - m + 1 if m else 0):
                for p in range(len(t) - m + 1):
                    if t[p: p + m] == x[a: a + m]:
                        hit.update(range(p, p + m))
                        found.add(str(i))
        assert (got[d].n_words, got[d].n_hit, got[d].items) == (len(t), len(hit), sorted(found)), d
    assert len(got[5].items) == 2
    dirty = {d for d, r in got.items() if r.n_hit}
    assert set(by_id(decontaminate.remove_documents(docs, bench))) == set(w) - dirty
    spans = by_id(decontaminate.remove_spans(docs, bench))
    assert all(len(words(spans[d].text)) == len(w[d]) - got[d].n_hit for d in w)
    assert all(spans[d].text == t for d, t in corpus if d not in dirty)
    assert decontaminate.scan(no_docs, bench).count() == 0
    assert decontaminate.scan(docs, bench.where("item_id < 0")).where("n_hit > 0").count() == 0


def test_bpe_round_trip(docs, corpus, no_docs, monkeypatch):
    import public_tokenizers
    import tiktoken
    from genoframe.llm import bpe
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_id(bpe.encode(docs, path, public_tokenizers.PATTERN))
    for d, t in corpus:
        ids = enc.encode_ordinary(t or "")
        assert got[d].ids == ids and bytes(got[d].decoded) == (t or "").encode() and got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert bpe.encode(no_docs, path, public_tokenizers.PATTERN).count() == 0
    monkeypatch.setattr(bpe, "PART_CHARS", 40)
    for t in ["a  b\n\n c  d 'll it's  \t x" * 30, "é  ü  z1 2 3   " * 40, "y" * 500]:
        assert "".join(bpe.safe_parts(t, 40)) == t and bpe.encode_text(enc, t) == enc.encode_ordinary(t)


def test_language_id(spark, sf):
    from genoframe.llm import langid
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs)
    odd = spark.createDataFrame([(10 ** 6, None), (10 ** 6 + 1, ""), (10 ** 6 + 2, "12 %% !"), (10 ** 6 + 3, "the and of that " * 60000)], "doc_id bigint, text string")
    truth = {r.doc_id: r.lang for r in docs.collect() if r.lang}
    got = by_id(langid.predict(docs.select("doc_id", "text").unionByName(odd), model))
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2]
    assert np.mean([got[d].lang_pred == truth[d] for d in held]) >= 0.97
    assert [got[10 ** 6 + i].lang_pred for i in range(3)] == ["und"] * 3 and got[10 ** 6 + 3].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.fit(docs.limit(0)) is None and set(langid.predict(odd, None).toPandas().lang_pred) == {"und"}


def test_registered_sql(spark, sf, con):
    """The queries that SQL expresses, against it."""
    from genoframe.llm.queries import all_queries
    from genoframe.plans.verify import compare
    queries, sql = all_queries()
    assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in queries} and "pipeline" in queries
    for name, text in sql.items():
        ok, why = compare(spark, name, sf, queries[name], text, con)
        assert ok, why


def test_lm_scoring_of_order_three(spark, sf, con):
    """Two steps of back-off are registered and agree with SQL."""
    from genoframe.llm.queries import all_queries
    from genoframe.plans.verify import compare
    queries, sql = all_queries()
    name = "op6_lm_scoring_order3"
    ok, why = compare(spark, name, sf, queries[name], sql[name], con)
    assert ok, why


def cut_repeats(texts):
    """Brute force: words covered by 50 equal words in a row that also start in a smaller document go."""
    at = {d: list(re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))) for d, t in texts.items()}
    w = {d: [m[0] for m in x] for d, x in at.items()}
    first = {}
    for d in sorted(w):
        for i in range(len(w[d]) - 49):
            first.setdefault(tuple(w[d][i: i + 50]), d)
    out = {}
    for d, x in w.items():
        gone = sorted({p for i in range(len(x) - 49) if first[tuple(x[i: i + 50])] < d for p in range(i, i + 50)})
        kept, last = "", 0
        for p in gone:
            if p - 1 not in gone:
                kept += texts[d][last: at[d][p].start()]
            last = at[d][p].end()
        out[d] = kept + texts[d][last:]
    return {d: t for d, t in out.items() if t.strip(" ")}


def test_pipeline(spark, docs, corpus, tmp_path):
    """run() against a brute-force version of its five stages."""
    import corpus_pipeline as cp
    import public_tokenizers
    import tiktoken
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    bench = " ".join(words(corpus[20][1])[:12])
    spark.createDataFrame([(1, bench)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in cp.STAGES][0] == "language_id" and len(cp.STAGES) == 5
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = cp.language_id(spark, table, str(tmp_path))
    assert kept.columns == cp.COLUMNS
    want = {d: t for d, t in corpus if any(c.isalpha() for c in t or "")}
    assert {r.doc_id: r.text for r in kept.collect()} == want
    fp = {}
    for d, t in want.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        h = [xxhash.xxh64_intdigest(" ".join(w[i: i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
        fp[d] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    comp = components_of(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4])
    want = {d: t for d, t in want.items() if comp[d] == d}
    once = cp.simhash_dedup(spark, kept, str(tmp_path))
    assert once.columns == cp.COLUMNS and {r.doc_id: r.text for r in once.collect()} == want
    assert 3 in want and not {60, 61} & set(want)
    want = cut_repeats(want)
    cut = cp.substring_dedup(spark, once, str(tmp_path))
    assert cut.columns == cp.COLUMNS and {r.doc_id: (r.text, r.n_chars) for r in cut.collect()} == {d: (t, len(t)) for d, t in want.items()}
    grams = {tuple(bench.split()[i: i + 10]) for i in range(3)}
    want = {d: t for d, t in want.items() if not any(tuple(words(t)[i: i + 10]) in grams for i in range(len(words(t)) - 9))}
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = by_id(cp.run(spark, str(tmp_path)))
    assert {d: r.ids for d, r in out.items()} == {d: enc.encode_ordinary(t) for d, t in want.items()} and 20 not in out


def test_pipeline_of_no_documents(spark, no_docs, tmp_path):
    import corpus_pipeline as cp
    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_null_ids_and_repeated_rows(spark, docs, corpus):
    """Every operator on texts gives its defined result for rows that repeat and rows without an id; clashing names do not matter."""
    import corpus_pipeline as cp
    import public_tokenizers
    from genoframe.llm import bpe, compact_windows, decontaminate, langid, license_scan, ngram_lm, simhash, suffix_dedup
    n, cols = len(corpus), docs.columns
    loose = docs.where("doc_id in (5, 63, 69)").selectExpr("CAST(NULL AS bigint) AS doc_id", *cols[1:])
    odd = docs.union(docs.where("doc_id in (3, 63, 64, 69)")).union(loose)
    total = n + 7
    bench = spark.createDataFrame([(1, " ".join(words(corpus[20][1])[:12])), (None, None), (2, "")], "item_id bigint, text string")
    got = suffix_dedup.remove_repeats(odd).collect()
    assert len(got) == total and all(r.n_removed == 0 for r in got if r.doc_id is None)
    assert sorted(r.n_removed for r in got if r.doc_id == 63) == [0, 0]
    assert license_scan.scan(odd).count() == bpe.encode(odd, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == total
    assert langid.predict(odd, None).count() == ngram_lm.score(odd).count() == decontaminate.scan(odd, bench).count() == total
    passages = compact_windows.near_duplicate_passages(odd).collect()
    assert len(passages) == n + 1 and [r.class_id for r in passages if r.doc_id is None] == [None]
    marks = simhash.near_duplicates(odd).collect()
    assert len(marks) == n + 3 and all(r.component_id is None for r in marks if r.doc_id is None)
    clash = odd.withColumnsRenamed({"chunk": "_doc", "key": "may", "fp": "row", "source": "spans"})
    cut = compact_windows.remove_passages(clash)
    assert cut.columns == clash.columns and cut.count() == total
    assert decontaminate.remove_spans(docs.withColumnsRenamed({"chunk": "k", "key": "t", "fp": "row", "source": "spans"}), bench).count() == n
    left = decontaminate.remove_documents(clash, bench)
    assert left.columns == clash.columns and left.count() == total - 1
    kept = cp.simhash_dedup(spark, odd, "").collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and sum(r.doc_id is None for r in kept) == 3 and {3, 63} <= set(ids)


def test_decontamination_judges_rows_without_an_id(spark):
    from genoframe.llm import decontaminate
    ten = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([("q1", ten)], "item_id string, text string")
    rows = [(None, f"x {ten} y", 1), (None, "clean words", 2), (7, ten.upper(), 3), (7, "the same id but clean", 4),
            (8, None, 5), (9, "", 6), (None, None, 7), (None, "clean words", 8)]
    d = spark.createDataFrame(rows, "doc_id long, text string, k int")
    kept = decontaminate.remove_documents(d, bench)
    assert sorted(r.k for r in kept.collect()) == [2, 4, 5, 6, 7, 8] and kept.columns == d.columns
    assert decontaminate.remove_documents(d, bench.limit(0)).count() == len(rows)


def test_language_stage_without_labels_keeps_documents(spark):
    from genoframe.llm import langid
    rows = [(1, "some words here", None), (2, "1234", None), (3, None, None), (None, "\u6f22\u5b57", None), (5, "", "en")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.fit(d) is None
    assert sorted(r.text for r in langid.recognised(d, None, lang_col="lang").collect()) == ["some words here", "\u6f22\u5b57"]


def test_language_stage_writes_missing_languages(docs):
    from genoframe.llm import langid
    model = langid.fit(docs)
    said = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    got = langid.recognised(docs, model, lang_col="lang").collect()
    given = {r.doc_id: r.lang for r in docs.collect()}
    assert {r.doc_id for r in got} == {k for k, v in said.items() if v != "und"}
    assert all(r.lang == (given[r.doc_id] or said[r.doc_id]) for r in got)


def test_embedding_links_are_symmetric(spark, monkeypatch):
    """With a low recall many pairs are found from one end only: each must count for both ends."""
    from genoframe.llm import multi_index
    rng = np.random.default_rng(9)
    centre = rng.normal(size=(60, 8))
    x = np.concatenate([c + 0.16 * rng.normal(size=(12, 8)) for c in centre])
    x = np.concatenate([x, x[:3]])
    short = [(5000 + i, [float(v) for v in r], 1) for i, r in enumerate(np.array([[1, 0, 2], [2, 0, 4], [1, 0, 2.01], [0, 1, 0]]))]
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows + short, "vec_id bigint, embedding array<double>, cell int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    monkeypatch.setattr(multi_index, "CELL_ROWS", 4)
    full = {r.vec_id: r for r in multi_index.near_duplicates(df).collect()}
    assert sum(full[i].n_links for i in range(len(x))) >= 0.97 * near.sum()
    for recall in (0.3, 0.98):
        got = multi_index.near_duplicates(df, recall=recall).collect()
        links = sum(r.n_links for r in got if r.vec_id < 5000)
        assert links % 2 == 0 and links <= near.sum()
        size = Counter(r.component_id for r in got)
        assert all((r.n_links > 0) == (size[r.component_id] > 1) for r in got)
        assert all(r.n_links <= near[r.vec_id].sum() for r in got if r.vec_id < 5000)
        assert [full[5000 + i].n_links for i in range(4)] == [2, 2, 2, 0] and full[5001].component_id == 5000
