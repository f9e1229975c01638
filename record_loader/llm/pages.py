"""Main text of web pages.

Each page is cut into blocks by its markup, and every block gets a zone: *main* inside <article> or
<main>, *chrome* inside elements that by their kind or name are menus, headers, footers, sidebars,
notices, adverts, forms or reader comments, and *open* elsewhere. An <article> or <main> wins over the
name of an open wrapper around it, and a form that holds one or the site's menu is open. Main blocks are the article and
chrome blocks are not; for open blocks, which the markup leaves undecided, the host decides:

Repeats on a host: the token streams of a host's pages outside the article are cut into windows of
``LEAD`` tokens (a shorter block is one window as a whole), told apart by 128-bit hashes. An open
block goes, as a whole, when every window of it stands in at least ``ARTICLES`` different articles
of the host and in ``SHARE`` of them; else all of it stays. So a quotation, a phrase or a passage
that a few articles share takes nothing away.

Articles are told apart by their longest main block; on pages without one by their longest open
block of ``PROSE`` tokens or more, or that is on less than ``SHARE`` of the host's pages. So copies
of an article beside another advert, date or comment are one article. Doubt keeps text: a page with
no such block is no article, and what is on fewer articles stays. Not told apart are copies, of at
least SHARE of a host's pages, of an article all of whose blocks are shorter than PROSE.

A host's streams are never brought together in one task: windows that only one content has are
dropped by a minimum and a maximum that every task reduces first, and of the rest one row per
window and article is counted, so a host with a third of all pages is spread over its windows.
Main blocks need no streams: a passage that an article shares with other pages is still its text.

Markup is read in tasks, page by page, once for the streams and once for the text: the streams are
a small part of the pages, so that stores less than keeping the parsed pages would. Pages are
shuffled only where many blocks go (a counted bound decides).

Defined cases: null html is empty and has the empty text; a page of any length or brokenness is read in
time in proportion to its length (see :class:`Markup` for quotes that are left open); unclosed elements
end with their container; character references are decoded; white space inside a block is one space; blocks are
joined by one line break in page order; copies of a page do not make its text boilerplate;
repeated rows are handled alike; null url is a host of its own; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

LEAD = 8
ARTICLES = 3
SHARE = 0.5
PROSE = 40

#: Kinds of elements.
HIDDEN = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "head", "title", "select", "button", "textarea", "audio", "video", "map"}
CHROME = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
MAIN = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q",
          "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br"}
#: Names (class, id, role) of what is not the article.
NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary",
         "contentinfo", "cookie", "cookies", "consent", "dialog", "disqus", "footer", "header", "masthead", "menu", "menubar", "nav", "navbar", "navigation",
         "newsletter", "notice", "popup", "promo", "related", "replies", "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored",
         "subscribe", "toolbar", "widget"}

RAW = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "textarea", "title", "noscript", "iframe", "template")}
#: A tag as most are written; possessive, so it never tries a place twice.
PLAIN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:\s++[^\s\"'<>/=]++(?:\s*+=\s*+(?:\"[^\"<>]*+\"|'[^'<>]*+'|[^\s\"'<>=`]++))?+)*+)\s*+(/?)>")
ATTRIBUTE = re.compile(r"([^\s=/]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s]++)))?+")
TAG_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)")
NAME = re.compile(r"[\s/]*+([^\s/>=]*+)(\s*+=\s*+)?+")
VALUE = re.compile(r"[^\s>]*+")
DISPLAY_NONE = re.compile(r"display\s*:\s*none", re.I)


class Markup:
    """The tags of a page in order, in time in proportion to its length, however broken it is.

    Quotes delimit a value only right after the equals sign, so unquoted values may hold quotes. A
    quoted value may hold angle brackets, unless it is one whose end was left out: no closing quote follows,
    what follows it is neither white space nor the tag's end, or the value would hold a tag's end
    and another tag. Such a value ends with the tag, at the next ``>``."""

    def __init__(self, page: str):
        self.page = page
        self.next: dict[str, int] = {}

    def find(self, what: str, at: int) -> int:
        """The next place of a character, or the page's end. Places only grow, so each is looked for once."""
        known = self.next.get(what, -1)
        if known < at:
            known = self.page.find(what, at)
            self.next[what] = known = len(self.page) if known < 0 else known
        return known

    def tag(self, at: int) -> tuple[int, bool, str, dict[str, str], bool] | None:
        """The tag that starts at a ``<``: where it ends, whether it closes, its name, its attributes, whether it
        is closed by itself; None if none starts there."""
        m = PLAIN.match(self.page, at)
        if m:
            said = {}
            if m[3]:
                for a in ATTRIBUTE.finditer(m[3]):
                    said.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
            return m.end(), bool(m[1]), m[2].lower(), said, bool(m[4])
        m = TAG_NAME.match(self.page, at)
        return self._broken(m) if m else None

    def _broken(self, m: re.Match) -> tuple[int, bool, str, dict[str, str], bool]:
        page, at, said = self.page, m.end(), {}
        while at < len(page):
            if page[at] == "<" and self.find(">", at) >= self.find("<", at + 1):  # the tag's end was left out
                return at, bool(m[1]), m[2].lower(), said, False
            a = NAME.match(page, at)
            name, at = a[1].lower(), a.end()
            if not a[2]:
                if at < len(page) and page[at] == ">":
                    said.setdefault(name, "")
                    return at + 1, bool(m[1]), m[2].lower(), said, page[at - 1] == "/"
                at += not name and at == a.start()  # a stray sign
                said.setdefault(name, "")
                continue
            quote = page[at:at + 1]
            if quote in ("'", '"') and quote:
                stop = self._value_end(quote, at + 1)
                if stop < 0:
                    stop = self.find(">", at)
                    said.setdefault(name, page[at + 1:stop])
                    at = stop
                else:
                    said.setdefault(name, page[at + 1:stop])
                    at = stop + 1
            else:
                v = VALUE.match(page, at)
                said.setdefault(name, v[0])
                at = v.end()
        return at, bool(m[1]), m[2].lower(), said, False

    def _value_end(self, quote: str, at: int) -> int:
        """Where the quoted value from ``at`` ends; -1 if its end was left out."""
        page, stop = self.page, self.find(quote, at)
        if stop >= len(page) or not (stop + 1 == len(page) or page[stop + 1] in " \t\n\r\f/>"):
            return -1
        end, tag = self.find(">", at), self.find("<", at)
        if end < stop and end < tag:
            tag = self.find("<", end)
            if tag < stop and (page[tag + 1:tag + 2].isalpha() or page[tag + 1:tag + 2] == "/"):
                return -1
        return stop


#: Names that an article's own title may have.
TITLE_NAMES = {"header", "masthead", "banner"}
#: Names of what holds articles of others: an <article> in it is not the page's.
OTHERS_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "comment", "comments", "disqus", "promo", "related", "replies", "sponsor", "sponsored"}
#: A name counts as a whole, as the last word of a compound that none of WITHOUT goes before, or in front of PARTS.
WITHOUT = {"with", "without", "has", "have", "no", "not", "hide", "hides"}
PARTS = {"area", "bar", "block", "box", "button", "buttons", "container", "inner", "item", "items", "links", "list", "posts", "slot", "unit", "wrap", "wrapper"}
#: Elements whose id is read inside the article; those of headings, sections and anchors are made from titles.
WITH_ID = {"div", "ul", "ol"}

OPEN, IN_MAIN, IN_CHROME, UNSEEN = 0, 1, 2, 3
#: While a page is read: inside an open wrapper that is chrome by name only, the same with a name of OTHERS_NAMES, in an
#: <article> of a named wrapper, and from FORM on the page's forms one by one.
NAMED, OTHERS, MAYBE, FORM = 4, 5, 6, 7


#: The words before a title's name that make it the article's own.
OWN_TITLE = {"post", "article", "entry", "story"}


def named(value: str, names: set[str]) -> set[str]:
    """The names that a class, id or role says."""
    found = set()
    for token in value.lower().split():
        words = [w for w in re.split(r"[_-]+", token.split("--")[0]) if w]
        if words and not WITHOUT & set(words[:-1]):
            says = names & ({words[-1], words[0]} if words[-1] in PARTS else {words[-1]})
            found |= says - TITLE_NAMES if OWN_TITLE & set(words[:-1]) else says
    return found


def zone(name: str, said: dict[str, str], outer: int) -> int:
    """Zone of an element from its own kind and attributes and the zone around it; FORM for a form that is open yet."""
    if outer in (IN_CHROME, UNSEEN) and not (outer == IN_CHROME and name in HIDDEN):
        return outer
    if name in HIDDEN:
        return UNSEEN
    inside = outer in (IN_MAIN, MAYBE)
    says: set[str] = set()
    if said:
        if "hidden" in said or said.get("aria-hidden", "").lower() == "true" or DISPLAY_NONE.search(said.get("style", "")):
            return UNSEEN
        if name not in ("html", "body", "main"):
            for kind in ("class", "id", "role"):
                if said.get(kind) and not (inside and kind == "id" and name not in WITH_ID):
                    says |= named(said[kind], NAMES - TITLE_NAMES if inside else NAMES)
    if name == "form" and not inside:
        return outer if outer in (NAMED, OTHERS) else FORM
    if name in CHROME and not (name == "header" and inside) or says and (inside or name == "article"):
        return IN_CHROME
    if says:
        return OTHERS if outer == OTHERS or says & OTHERS_NAMES else NAMED
    if name == "main":
        return outer if inside else IN_MAIN
    if name == "article" and not inside:
        return {NAMED: MAYBE, OTHERS: OTHERS}.get(outer, IN_MAIN)
    return outer


def blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of the blocks of a page in order; hidden ones are left out."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    depths: dict[str, list[int]] = {}  # where each name is open
    walls: list[int] = []              # where elements are open that are not inline
    held: list[str] = []
    page_forms: list[bool] = []  # whether a form holds an article or the site's menu, as one around a whole page does
    unsure: list[tuple[int, int]] = []  # the open forms of which that is not known yet, and their depth
    here = OPEN

    def close() -> None:
        if held:
            text = " ".join("".join(held).split())
            if text and here != UNSEEN:
                out.append((here, text))
            held.clear()

    def end(depth: int) -> None:
        nonlocal here
        while len(stack) > depth:
            depths[stack.pop()[0]].pop()
        while walls and walls[-1] >= depth:
            walls.pop()
        while unsure and unsure[-1][1] >= depth:
            unsure.pop()
        here = stack[-1][1] if stack else OPEN

    def entered(name: str, said: dict[str, str]) -> int:
        own = zone(name, said, here)
        if name in MAIN and own in (IN_MAIN, MAYBE) or name == "nav":
            while unsure:
                page_forms[unsure.pop()[0]] = True
        return own

    markup, at, shown = Markup(page), 0, 0

    def text_until(stop: int) -> None:
        if stop > shown and here != UNSEEN:
            held.append(entities.unescape(page[shown:stop]))

    while True:
        at = markup.find("<", at)
        if at >= len(page):
            text_until(len(page))
            break
        if page[at + 1:at + 2] in ("!", "?") and page[at + 1:at + 2]:
            text_until(at)
            stop = page.find("-->", at + 4) + 3 if page.startswith("<!--", at) else markup.find(">", at) + 1
            at = shown = stop if stop > 2 else len(page)
            continue
        found = markup.tag(at)
        if found is None:
            at += 1
            continue
        text_until(at)
        at, closes, name, said, closed = found
        shown = at
        if name == "br":
            held.append(" ")
            continue
        inline = name in INLINE
        if closes:
            open_at = depths.get(name)
            if open_at:
                if not inline or stack[open_at[-1]][1] != here:
                    close()
                end(open_at[-1])
            continue
        if name in VOID or closed and inline:
            if not inline:
                close()
            continue
        own = entered(name, said)
        if not inline:
            close()
            # a block ends an open paragraph, a list item the one before
            if walls and (stack[walls[-1]][0] == "p" or name == stack[walls[-1]][0] == "li"):
                end(walls[-1])
                own = entered(name, said)
            walls.append(len(stack))
        elif own != here:
            close()
        if own == FORM and name == "form":
            page_forms.append(False)
            unsure.append((len(page_forms) - 1, len(stack)))
            own = FORM + len(page_forms) - 1
        depths.setdefault(name, []).append(len(stack))
        stack.append((name, own))
        here = own
        if name in RAW:
            body_end = RAW[name].search(page, at)
            at = shown = body_end.start() if body_end else len(page)
    close()
    # an <article> in a wrapper that is chrome by name is the page's if there is none elsewhere
    settled = {NAMED: IN_CHROME, OTHERS: IN_CHROME, MAYBE: IN_CHROME if any(z == IN_MAIN for z, _ in out) else IN_MAIN}
    settled |= {FORM + k: OPEN if holds else IN_CHROME for k, holds in enumerate(page_forms)}
    return [(settled.get(z, z), text) for z, text in out]


def keyed_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, x_key, y_key, html): id is page_id as text; the keys are 128 bits that stand for the row."""
    d = pages.select(F.col(page_id).cast("string").alias("id"), F.col(url).cast("string").alias("url"), C.whole_text(html).alias("html"))
    row = (F.struct("id"), F.struct("url"), "html")  # a struct tells null from nothing
    return d.select("id", "url", F.xxhash64(F.lit("first"), *row).alias("x_key"), F.xxhash64(F.lit("second"), *row).alias("y_key"), "html")


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _streams(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The blocks outside the article, a hash of all blocks, and one of the longest main block."""
    for batch in batches:
        parsed = [blocks(h) for h in batch["html"]]
        kept = [[(k, z, t) for k, (z, t) in enumerate(b) if z != IN_MAIN] for b in parsed]
        longest = [max((t for z, t in b if z == IN_MAIN), key=lambda t: (len(t), t), default=None) for b in parsed]
        yield batch.drop(columns="html").assign(
            content=[_digest("\n".join(t for _, t in b)) for b in parsed],
            article=pd.array([None if t is None else _digest(t) for t in longest], "Int64"), block=[[k for k, _, _ in b] for b in kept],
            zone=[[z for _, z, _ in b] for b in kept], text=[[t for _, _, t in b] for b in kept])


def host_articles(streams: DataFrame, each: DataFrame) -> DataFrame:
    """(host, content, article): the article of each content that has one."""
    contents = streams.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("contents"))
    open_blocks = (each.where((F.col("zone") == OPEN) & F.col("article").isNull())
                   .select("host", "content", F.size("w").alias("size"), F.xxhash64("w").alias("b")).distinct())
    often = open_blocks.groupBy("host", "size", "b").agg(F.count("*").alias("n"))
    own = (open_blocks.join(often, ["host", "size", "b"]).join(contents, "host")
           .where((F.col("size") >= PROSE) | (F.col("n") < F.col("contents") * SHARE)))
    return (own.groupBy("host", "content").agg(F.max(F.struct("size", "b")).alias("best")).select("host", "content", F.col("best.b").alias("article"))
            .unionByName(streams.where("article IS NOT NULL").select("host", "content", "article").distinct()))


def repeated_blocks(keyed: DataFrame, lead: int = LEAD) -> DataFrame:
    """(x_key, y_key, block): open blocks whose windows all stand in many articles of the host."""
    host = F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    streams = C.cut(keyed.select("x_key", "y_key", host.alias("host"), "html").mapInPandas(
        _streams, "x_key long, y_key long, host string, content long, article long, block array<int>, zone array<int>, text array<string>"))
    each = (streams.select("x_key", "y_key", "host", "content", "article", F.explode(F.arrays_zip("block", "zone", "text")).alias("b"))
            .select("x_key", "y_key", "host", "content", "article", "b.block", "b.zone", F.split("b.text", " ").alias("w")))
    places = F.expr(f"transform(sequence(0, greatest(size(w) - {lead}, 0)), i -> struct("
                    f"xxhash64(size(w) < {lead}, slice(w, i + 1, {lead})) AS x, xxhash64('second', slice(w, i + 1, {lead})) AS y))")
    windows = (each.select("x_key", "y_key", "host", "content", "block", "zone", F.size("w").alias("size"), F.posexplode(places).alias("at", "s"))
               .select("*", "s.*").drop("s"))
    shared = C.cut(windows.groupBy("host", "x", "y").agg(F.min("content").alias("one"), F.max("content").alias("other"), F.max((F.col("zone") == OPEN).cast("int")).alias("open"))
                   .where("one != other AND open = 1").select("host", "x", "y"))
    articles = host_articles(streams, each)
    total = articles.select("host", "article").distinct().groupBy("host").agg(F.count("*").alias("articles"))
    common = (windows.select("host", "content", "x", "y").distinct().join(shared, ["host", "x", "y"]).join(articles, ["host", "content"])
              .select("host", "x", "y", "article").distinct().groupBy("host", "x", "y").agg(F.count("*").alias("n"))
              .join(total, "host").where((F.col("n") >= ARTICLES) & (F.col("n") >= F.col("articles") * SHARE)).select("host", "x", "y"))
    # repeated rows are one page, so places are counted once
    return (windows.where(F.col("zone") == OPEN).join(common, ["host", "x", "y"]).select("x_key", "y_key", "block", "size", "at").distinct()
            .groupBy("x_key", "y_key", "block", "size").agg(F.count("*").alias("n")).where(f"n = greatest(size - {lead}, 0) + 1")
            .select("x_key", "y_key", "block"))


def _main_text(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The article's blocks, and the open ones that the host does not repeat."""
    for batch in batches:
        texts = []
        for page, repeated in zip(batch["html"], batch["repeated"], strict=True):
            gone = set(repeated) if repeated is not None else ()
            texts.append("\n".join(text for k, (z, text) in enumerate(blocks(page)) if z == IN_MAIN or z == OPEN and k not in gone))
        yield pd.DataFrame({"id": batch["id"], "url": batch["url"], "text": texts})


def main_text(pages: DataFrame, lead: int = LEAD, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, text) per page; id is page_id as text."""
    keyed = keyed_pages(pages, page_id, url, html)
    found = C.cut(repeated_blocks(keyed, lead))
    repeated = found.groupBy("x_key", "y_key").agg(F.collect_set("block").alias("repeated"))
    # a block is three numbers: few are sent to every task, many meet the pages by shuffle
    repeated = F.broadcast(repeated) if found.count() <= C.BROADCAST_ROWS else repeated
    return keyed.join(repeated, ["x_key", "y_key"], "left").select("id", "url", "html", "repeated").mapInPandas(
        _main_text, "id string, url string, text string")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = C.read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text(pages).select(F.col("id").cast("long").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op5_html_extraction": op5_html_extraction}
ORACLES: dict[str, str] = {}
