"""The main text of web pages, with site templates removed.

Each element outside of the marked article is a subtree with a digest. Digests
are counted per host over different pages; a subtree that recurs on MIN_PAGES pages
of its host and on MIN_SHARE of all its pages belongs to the site's template and is
deleted there (so no host of fewer pages than MIN_PAGES has one). So are the elements
whose tag, role or class says that they are no part of an article. Where a page
marks an article or a main part, the text is taken from there only, and template
removal touches nothing in an article and no paragraphs and headings in a main part:
a paragraph that many pages quote is still theirs.

Counting is by host and digest, combined before the shuffle, so a host with a
third of all pages is spread over its subtrees. What is to be deleted on a page
comes back to it by a join.

Nulls: a null html is the empty page, a null url has the host "". Rows of the
same address count as one page. Empty tables give no rows. A page without text
gives the empty text.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.tables import mapped, texts_of
from gridtally.session import written_once

#: Pages of a host on which a subtree must recur to be part of its template.
MIN_PAGES = 5
#: Part of the host's pages on which it must recur as well.
MIN_SHARE = 0.25

# Kinds of elements of HTML, and words that mark parts around an article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br img".split()
)
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
GONE = frozenset(
    "head script style noscript template nav footer aside form button select option textarea iframe object svg math "
    "canvas audio video dialog menu title noembed noframes".split()
)
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd td th figcaption".split())
CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
SCOPES = frozenset("ul ol dl table article main section div body".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr "
    "banner notice alert popup modal overlay newsletter subscribe subscription signup sidebar side widget widgets menu "
    "nav navbar navigation breadcrumb breadcrumbs header masthead footer comment comments respond replies disqus share "
    "sharing social related recommended toolbar pagination pager skip".split()
)

_TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[^a-z0-9]+")


def _marked(attributes: str) -> bool:
    """Whether class, id or role say that the element is no part of an article."""
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if name.lower() == "role":
            if value.strip() in ROLES:
                return True
        elif any(word in MARKS for word in _WORD.split(value)):
            return True
    return False


class Element:
    """An open element: tag, where its source starts, and what it is."""

    __slots__ = ("tag", "start", "gone", "main", "article", "inline", "blocks")

    def __init__(self, tag: str, start: int, gone: bool, main: bool, article: bool, blocks: int):
        self.tag, self.start, self.gone, self.main, self.article, self.blocks = tag, start, gone, main, article, blocks
        self.inline = tag in INLINE


class Page:
    """Text blocks of a page, and its subtrees outside of the article's text."""

    def __init__(self, source: str):
        self.source = source
        #: [text, whether inside an article or main part]
        self.blocks: list[list] = []
        #: (digest, first block, block after the last)
        self.subtrees: list[tuple[int, int, int]] = []
        self._stack: list[Element] = []
        self._pieces: list[str] = []
        self._read()

    def _read(self) -> None:
        source, at = self.source, 0
        find = _TOKEN.search
        while (token := find(source, at)) is not None:
            self._text(source[at : token.start()])
            at = token.end()
            closing, tag, attributes = token.groups()
            if tag is None:
                continue
            tag = tag.lower()
            if closing:
                self._close(tag, at)
                continue
            self._open(tag, attributes, token.start())
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
                stop = end.start() if end else len(source)
                self._text(source[at:stop])
                at = stop
        self._text(source[at:])
        self._break()
        while self._stack:
            self._pop(len(source))

    def _text(self, text: str) -> None:
        if text and not (self._stack and self._stack[-1].gone):
            self._pieces.append(entities.unescape(text) if "&" in text else text)

    def _break(self) -> None:
        """Ends the block at hand."""
        if self._pieces:
            text = " ".join("".join(self._pieces).split())
            if text:
                self.blocks.append([text, bool(self._stack) and self._stack[-1].main])
            self._pieces = []

    def _open(self, tag: str, attributes: str, start: int) -> None:
        if tag in VOID:
            if tag not in INLINE:
                self._break()
            elif tag == "br":
                self._text(" ")
            return
        inline = tag in INLINE
        if not inline:
            self._break()
            closes = CLOSES.get(tag)
            for depth in range(len(self._stack) - 1, -1, -1):
                other = self._stack[depth].tag
                if other == "p" or closes and other in closes:
                    while len(self._stack) > depth:
                        self._pop(start)
                    if other != "p" and tag != "tr":
                        break
                elif other in SCOPES:
                    break
        above = self._stack[-1] if self._stack else None
        main = tag in ("article", "main") or above is not None and above.main
        article = tag == "article" or above is not None and above.article
        structural = tag in ("html", "body", "article", "main")
        gone = (
            above is not None and above.gone
            or tag in GONE
            or tag == "header" and not main
            or not structural and _marked(attributes)
        )
        self._stack.append(Element(tag, start, gone, main, article, len(self.blocks)))

    def _close(self, tag: str, end: int) -> None:
        for depth in range(len(self._stack) - 1, -1, -1):
            if self._stack[depth].tag == tag:
                if tag not in INLINE:
                    self._break()
                while len(self._stack) > depth:
                    self._pop(end)
                return
            if tag in INLINE and not self._stack[depth].inline:
                return  # a stray end tag of an inline element

    def _pop(self, end: int) -> None:
        element = self._stack[-1]
        if not element.inline:
            self._break()
        self._stack.pop()
        text = element.article or element.main and element.tag in TEXT
        if element.inline or element.gone or text or element.tag in ("html", "body", "article", "main"):
            return
        if len(self.blocks) > element.blocks:
            digest = xxhash.xxh64_intdigest(" ".join(self.source[element.start : end].split()))
            self.subtrees.append((digest - (1 << 63), element.blocks, len(self.blocks)))

    def main_text(self, template: set[int] = frozenset()) -> str:
        """The blocks that no template subtree holds; those of the article if one is marked."""
        drop = set()
        for digest, first, after in self.subtrees:
            if digest in template:
                drop.update(range(first, after))
        marked = any(main for _, main in self.blocks)
        return "\n".join(text for i, (text, main) in enumerate(self.blocks) if i not in drop and main >= marked)


def host(url: Column) -> Column:
    """The host of an address in lower case, without its port."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def subtrees(keyed: DataFrame) -> DataFrame:
    """(host, page_key, address, digest) of each subtree of each page."""

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        row, digests = [], []
        for i, source in enumerate(texts_of(batch.column("html"))):
            own = {digest for digest, _, _ in Page(source).subtrees}
            row += [i] * len(own)
            digests += sorted(own)
        take = pa.array(row, pa.int64())
        yield {**{name: batch.column(name).take(take) for name in ("host", "page_key", "address")}, "digest": digests}

    return mapped(
        keyed.select("host", "page_key", "address", "html"), step, "host string, page_key long, address long, digest long"
    )


def main_texts(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    url, html = F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit(""))
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        url.alias("url"),
        html.alias("html"),
        host(url).alias("host"),
        F.xxhash64(url).alias("address"),
        F.xxhash64("page_id", url, html).alias("page_key"),
    )
    found = written_once(subtrees(keyed), "subtrees")
    once = found.select("host", "digest", "address").distinct()
    template = once.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages)
    sizes = keyed.select("host", "address").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    # On smaller hosts the share is less than the number of pages.
    large = sizes.where(F.col("host_pages") * min_share > min_pages)
    enough = F.col("host_pages").isNull() | (F.col("pages") >= F.col("host_pages") * min_share)
    template = template.join(large, "host", "left").where(enough).select("host", "digest")
    drop = (
        found.join(template, ["host", "digest"])
        .groupBy("page_key")
        .agg(F.collect_set("digest").alias("template"))
    )

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        out = [
            Page(source).main_text(frozenset(template or ()))
            for source, template in zip(texts_of(batch.column("html")), batch.column("template").to_pylist())
        ]
        yield {
            "page_id": batch.column("page_id"),
            "url": batch.column("url"),
            "text": out,
            "n_chars": [len(text) for text in out],
        }

    joined = keyed.join(drop, "page_key", "left").select("page_id", "url", "html", "template")
    return mapped(joined, step, "page_id long, url string, text string, n_chars long")


def op3_main_text(pages: DataFrame) -> DataFrame:
    """The main text of every page."""
    return main_texts(pages)
