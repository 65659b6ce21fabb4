"""Main text of web pages by site template removal.

Every page is parsed into element subtrees; each subtree is hashed, and Spark counts on how
many pages of a host a hash stands. Subtrees that recur on many pages of their host are template
and are deleted; what is left of page furniture (menus, forms, adverts and the like, known by
element, role or class) goes as well, and the article's blocks remain.
"""

from __future__ import annotations

import html as html_lib
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.frames import checkpointed

#: A subtree is template if it stands on at least this many pages and this share of its host's pages.
MIN_PAGES = 5
MIN_SHARE = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot
    th thead title tr ul""".split())
#: Elements that end an open element of these names when they start.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "option", "caption", "body", "html", "head", "title", "legend"}
#: Open elements that an implied end does not reach past.
SCOPE = frozenset("html body article main section div td th table ul ol dl nav aside header footer form blockquote".split())

FURNITURE = frozenset("""script style noscript template head nav menu footer aside form iframe svg canvas object embed button select input
    textarea dialog title xmp noembed noframes""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog".split())
LABELS = frozenset("""ad ads adv advert adverts advertisement advertising adsense adsbox sponsor sponsored promo promotion promoted banner
    cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login
    sidebar sidebars aside widget widgets related recommended recommendations share sharing social comment comments commentlist reply
    replies respond disqus breadcrumb breadcrumbs menu menus nav navbar navigation footer masthead pagination pager toolbar skip""".split())
#: Labels and elements that are furniture outside the article only.
OUTER = frozenset(["header", "topbar"])
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th figcaption b i em strong a span code ol ul dl tbody table tr u small sub sup q cite mark".split())

TOKEN = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attr>(?:[^>"']|"[^"]*"|'[^']*')*|[^>]*)>""", re.S)
ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
#: Elements that hold the page or the article: label words on them speak of the layout.
WHOLE = frozenset("html body main article".split())
#: First and last parts of classes that tell a state (has-sidebar, comments-open); such a class counts as a whole only.
STATE_FIRST = frozenset("has no with without is not hide show".split())
STATE_LAST = frozenset("open opened closed enabled disabled active inactive visible allowed layout".split())
NO_WORDS: frozenset = frozenset()


def _labels(attr: str) -> tuple[str, set[str], bool]:
    """Class text, label words of class and id, and whether the element says it is furniture."""
    css, words, gone = "", set(), False
    for m in ATTR.finditer(attr):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            css += f" {value}"
            for token in value.split():
                parts = re.split(r"[_:-]+", token)
                state = len(parts) > 1 and (parts[0] in STATE_FIRST or parts[-1] in STATE_LAST)
                words.update([token] if state else parts)
        elif name == "role":
            gone |= value in ROLES
        elif name == "hidden":
            gone = True
        elif name == "aria-hidden":
            gone |= value == "true"
        elif name == "style":
            gone |= "display:none" in value.replace(" ", "")
    return css, words, gone


class _Node:
    __slots__ = ("tag", "css", "gone", "mute", "article", "main", "number", "parts")

    def __init__(self, tag, css, gone, mute, article, main, number):
        self.tag, self.css, self.gone, self.mute, self.article, self.main, self.number = tag, css, gone, mute, article, main, number
        self.parts: list[int] = []


class Page:
    """Text blocks of a page in order, each with its enclosing subtrees, and the subtree hashes."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, tuple[int, ...], bool, bool, bool]] = []   # text, subtrees, furniture, in article, in main
        self.hashes: list[int] = []
        self._text: list[str] = []
        self._stack = [_Node("", "", False, False, False, False, -1)]
        self._read(source)

    def _flush(self) -> None:
        if self._text:
            text = " ".join(html_lib.unescape("".join(self._text)).split())
            self._text = []
            if text:
                value = xxhash.xxh64_intdigest(text)
                around = [n for n in self._stack if n.number >= 0]
                for n in around:
                    n.parts.append(value)
                # an inline element's own state does not matter: its furniture never gets here
                top = next((n for n in reversed(self._stack) if n.tag in BLOCK), self._stack[0])
                self.blocks.append((text, tuple(n.number for n in around), top.gone, top.article, top.main))

    def _open(self, tag: str, attr: str) -> None:
        up = self._stack[-1]
        css, words, gone = _labels(attr) if attr else ("", NO_WORDS, False)
        article = up.article or (tag == "article" and not up.gone)
        main = up.main or tag == "main" or "main" in words
        gone = gone or up.gone or tag in FURNITURE or (tag not in WHOLE and bool(words & LABELS)) or (not article and tag not in WHOLE and (tag in OUTER or bool(words & OUTER)))
        if tag == "article" and gone:
            article = up.article
        # a subtree may be template unless it is the page, the article, or prose of the article
        prose = article and not gone and (tag in PROSE or tag == "article")
        number = -1
        if tag in BLOCK and tag not in ("html", "body", "main") and not prose:
            number = len(self.hashes)
            self.hashes.append(0)
        self._stack.append(_Node(tag, css, gone, up.mute or (gone and not up.gone and tag not in BLOCK), article, main, number))

    def _close(self) -> None:
        n = self._stack.pop()
        if n.number >= 0:
            self.hashes[n.number] = xxhash.xxh64_intdigest(f"{n.tag}\x01{n.css}\x01{n.parts}", 1) - (1 << 63) if n.parts else 0

    def _end(self, names, scope=frozenset()) -> None:
        for k in range(len(self._stack) - 1, 0, -1):
            if self._stack[k].tag in names:
                if self._text and any(n.tag in BLOCK for n in self._stack[k:]):
                    self._flush()
                while len(self._stack) > k:
                    self._close()
                return
            if self._stack[k].tag in scope:
                return

    def _read(self, s: str) -> None:
        at, n = 0, len(s)
        while at < n:
            m = TOKEN.search(s, at)
            if m is None:
                if not self._stack[-1].mute:
                    self._text.append(s[at:])
                break
            if m.start() > at and not self._stack[-1].mute:
                self._text.append(s[at: m.start()])
            at = m.end()
            tag = m["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if m["end"]:
                if tag in BLOCK:
                    self._flush()
                self._end({tag}, SCOPE - {tag} if tag not in SCOPE else frozenset())
                continue
            if tag in BLOCK:
                self._flush()
            if tag == "br":
                self._text.append(" ")
            if tag in VOID:
                continue
            if tag in CLOSES_P:
                self._end({"p"}, SCOPE)
            if tag in ENDS:
                self._end(ENDS[tag], SCOPE - ENDS[tag])
            if tag in RAW or tag in ("noscript", "svg", "iframe"):
                close = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(s, at)
                at = close.end() if close else n
                continue
            self._open(tag, m["attr"] or "")
        self._flush()
        while len(self._stack) > 1:
            self._close()


def main_text(blocks, template: set[int]) -> str:
    """Blocks that are neither template nor furniture: of the article, else of the main part, else of the page.

    Template does not take all of an article or main part: if it would, they stay whole.
    ``blocks`` are ``(text, subtree hashes, furniture, in article, in main)``.
    """
    own = [b for b in blocks if not b[2]]
    left = [b for b in own if not template.intersection(b[1])]
    for k in (3, 4):
        inside = [b for b in own if b[k]]
        if inside:
            left = [b for b in left if b[k]] or inside
            break
    return "\n".join(b[0] for b in left)


_BLOCK = pa.struct([("text", pa.string()), ("trees", pa.list_(pa.int64())), ("furniture", pa.bool_()), ("article", pa.bool_()), ("main", pa.bool_())])


_COLUMNS = {"blocks": ("array<struct<text:string,trees:array<bigint>,furniture:boolean,article:boolean,main:boolean>>", pa.list_(_BLOCK)),
            "trees": ("struct<content:bigint,hashes:array<bigint>>", pa.struct([("content", pa.int64()), ("hashes", pa.list_(pa.int64()))]))}


def parse(pages: DataFrame, want: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, host`` and, as wanted, ``blocks`` (text blocks with their subtrees) or ``trees`` (a hash of the
    page's content and its distinct subtree hashes)."""
    def run(batches):
        for rb in batches:
            for at in range(0, rb.num_rows, 256):
                part = rb.slice(at, 256)
                out = []
                for source in part.column(2).to_pylist():
                    page = Page(source or "")
                    if want == "blocks":
                        out.append([{"text": t, "trees": [page.hashes[i] for i in up], "furniture": g, "article": a, "main": m}
                                    for t, up, g, a, m in page.blocks])
                    else:
                        hashes = sorted({h for h in page.hashes if h})
                        content = xxhash.xxh64_intdigest(f"{[b[0] for b in page.blocks]}\x01{hashes}") - (1 << 63)
                        out.append({"content": content, "hashes": hashes})
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, _COLUMNS[want][1])], ["page_id", "url", want])

    src = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    parsed = src.mapInArrow(run, f"page_id bigint, url string, {want} {_COLUMNS[want][0]}")
    host = F.nullif(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    return parsed.withColumn("host", host)


def template_subtrees(hashed: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """``host, tree, n_pages`` of the subtrees that recur on many pages of their host; pages of one content count once."""
    once = hashed.where("host is not null").dropDuplicates(["host", "content"])
    trees = (once.select("host", F.explode("trees").alias("tree"))
             .groupBy("host", "tree").agg(F.count(F.lit(1)).alias("n_pages")).where(F.col("n_pages") >= min_pages))
    hosts = hashed.where("host is not null").select("host", "content").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n_host")).where(F.col("n_host") >= min_pages)
    return trees.join(hosts, "host").where(F.col("n_pages") >= min_share * F.col("n_host")).select("host", "tree", "n_pages")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, id_col: str = "page_id",
            url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars, n_template`` of every row of ``pages``.

    ``text`` holds the main text's blocks joined by a newline (empty if there is none),
    ``n_template`` the number of recurring subtrees found on the page. Null or empty html has no
    text; a null or malformed url has no host, so no subtree of such a page recurs. Repeated
    rows each give a row; rows of one content count as one page of their host. Other columns are not read.
    """
    parsed = parse(pages, "blocks", id_col, url_col, html_col)
    hashed = checkpointed(parse(pages, "trees", id_col, url_col, html_col)
                          .select("page_id", "host", "trees.content", F.col("trees.hashes").alias("trees")))
    template = template_subtrees(hashed, min_pages, min_share)
    on_page = (hashed.where("host is not null").select("page_id", "host", F.explode("trees").alias("tree"))
               .join(template.select("host", "tree"), ["host", "tree"])
               .groupBy(F.col("page_id").alias("k"), F.col("host").alias("h")).agg(F.collect_set("tree").alias("template")))
    both = (parsed.select("page_id", "url", "host", "blocks")
            .join(on_page, (F.col("page_id") == F.col("k")) & (F.col("host") == F.col("h")), "left")
            .select("page_id", "url", "blocks", "template"))

    def run(batches):
        for rb in batches:
            for at in range(0, rb.num_rows, 256):
                part = rb.slice(at, 256)
                text, found = [], []
                for blocks, template in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    gone = set(template or ())
                    found.append(len(gone))
                    text.append(main_text([(b["text"], b["trees"], b["furniture"], b["article"], b["main"]) for b in blocks or ()], gone))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string()),
                                                  pa.array([len(t) for t in text], pa.int64()), pa.array(found, pa.int64())],
                                                 ["page_id", "url", "text", "n_chars", "n_template"])

    return both.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint, n_template bigint")
