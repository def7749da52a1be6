"""Main text of web pages by consensus of a host's pages.

1. Each page's containers are scored by the text of the blocks they hold (link
   text and blocks far below count less), and the page votes for the path of its best
   one.  A path is the chain of container tags with their classes; digits are cut from
   classes, so that numbered variants agree.
2. Spark counts the votes by host and path, and each host's path of most votes wins.
3. Every page is read again: the text is that of the containers at the host's path.
   A page without such a container, or where it holds under half of what the page's own
   best one holds, keeps its own best container.

Menus, headers, footers, side bars, notices, adverts, forms, scripts, styles and reader
comments are left out wherever they stand (by tag, role, and words of class and id).
Blocks come in page order, white space within one becomes a space, character references are decoded.

Votes are pre-aggregated before the shuffle.  The winners have one row per host and are staged, so
Spark knows their size: below its broadcast threshold the pages are not moved, above it they
join by host and Spark splits a hot host.

Edge cases: null or empty html gives an empty text; null urls, and those without a host,
form one host of their own; unclosed and stray tags are tolerated; repeated rows are read
one by one; ties of votes go to the first path in string order; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import stage

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|textarea|iframe|object|math)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|<[!?/][^>]*>", re.S | re.I)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

#: elements that hold blocks and can be the main container
CONTAINERS = frozenset("html body main article section div td center".split())
#: elements that end the block before them (with the containers)
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre blockquote table thead tbody tfoot tr th caption figure figcaption hr address details "
    "summary header hgroup footer nav aside form fieldset menu dialog head title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements whose content is never article text
LEFT_OUT = frozenset("head title nav footer aside form menu dialog button select option label input fieldset".split())
#: words of class, id or role that mark what is not the article
LEFT_OUT_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside side footer foot header masthead topbar toolbar banner "
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "comment comments commentlist disqus replies respond widget skip pagination pager copyright complementary contentinfo search hidden".split())
#: a wrapper with one of these words is kept whatever its other words say
MAIN_WORDS = frozenset("article content main post entry story body text".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",)}


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)}


def _words(value: str) -> list[str]:
    return [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()) if w]


def _is_left_out(tag: str, attrs: dict[str, str], inside_main: bool) -> bool:
    if tag in LEFT_OUT or (tag == "header" and not inside_main):
        return True
    if not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
        return True
    if tag in ("html", "body", "main", "article"):
        return bool({"comment", "comments", "ad", "advert", "related", "promo", "sponsored"} & set(_words(attrs.get("class", "") + " " + attrs.get("id", ""))))
    words = set(_words(attrs.get("class", "") + " " + attrs.get("id", "") + " " + attrs.get("role", "")))
    bad = words & LEFT_OUT_WORDS
    return bool(bad) and not (words & MAIN_WORDS and not bad & {"comment", "comments", "ad", "ads", "advert", "sidebar", "footer", "nav", "menu"})


class Page:
    """Blocks of a page, each with the chain of its containers."""

    def __init__(self, source: str):
        self.blocks: list[tuple[tuple[int, ...], str, int]] = []  # containers, text, characters of links
        self.paths: list[str] = []  # of each container
        self._read(source)

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int | None, bool]] = []  # tag, container number, left out
        chain: tuple[int, ...] = ()
        out = main = links = 0
        text: list[str] = []
        linked = 0
        at = 0

        def end_block() -> None:
            nonlocal linked
            if text:
                t = " ".join("".join(text).split())
                if t:
                    self.blocks.append((chain, t, linked))
                text.clear()
            linked = 0

        def pop() -> None:
            nonlocal chain, out, main, links
            tag, number, skipped = stack.pop()
            if number is not None:
                chain = chain[:-1]
            out -= skipped
            main -= tag in ("main", "article")
            links -= tag == "a"

        for m in TOKEN.finditer(source):
            if m.start() > at and not out:
                piece = source[at:m.start()]
                piece = html.unescape(piece) if "&" in piece else piece
                text.append(piece)
                if links:
                    linked += len(piece)
            at = m.end()
            tag = (m[3] or m[6] or "").lower()
            if not tag:
                continue
            if m[2] or m[5]:
                if tag in BLOCKS:
                    end_block()
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        while len(stack) > k:
                            if stack[-1][0] in BLOCKS:
                                end_block()
                            pop()
                        break
                    if stack[k][0] in CONTAINERS and tag not in CONTAINERS and tag not in BLOCKS:
                        break
                continue
            raw = m[4] or m[7] or ""
            if tag == "br":
                text.append(" ")
            if tag in VOID:
                if tag in BLOCKS:
                    end_block()
                continue
            if tag in BLOCKS:
                end_block()
                for k in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph
                    if stack[k][0] in CONTAINERS or stack[k][0] in ("table", "ul", "ol", "dl"):
                        break
                    if stack[k][0] == "p" or stack[k][0] in CLOSES.get(tag, ()):
                        while len(stack) > k:
                            pop()
                if tag in CLOSES:
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0] in CLOSES[tag]:
                            while len(stack) > k:
                                pop()
                            break
                        if stack[k][0] in ("table", "ul", "ol", "dl", "body", "article", "main", "div", "section"):
                            break
                if stack and stack[-1][0] == "head" and tag not in ("title",):
                    pop()
            attrs = _attributes(raw) if raw and raw.strip(" /") else {}
            skipped = _is_left_out(tag, attrs, main > 0)
            number = None
            if tag in CONTAINERS:
                classes = sorted({c for c in re.split(r"\s+", re.sub(r"[\d_-]+", "", attrs.get("class", ""))) if c})
                number = len(self.paths)
                self.paths.append((self.paths[chain[-1]] if chain else "") + "/" + ".".join([tag, *classes]))
                chain = (*chain, number)
            if raw.endswith("/") and tag not in CONTAINERS:
                continue
            stack.append((tag, number, skipped))
            out += skipped
            main += tag in ("main", "article")
            links += tag == "a"
        if at < len(source) and not out:
            text.append(html.unescape(source[at:]))
        end_block()

    def scores(self) -> dict[str, float]:
        """Score of each path: its blocks' text without links, halved per container between, with a share
        taken off for link text; article and main count a half more."""
        total: dict[str, float] = {}
        for chain, text, linked in self.blocks:
            worth = max(len(text) - 2 * linked, -len(text)) * (1.0 if len(text) >= 25 else 0.3)
            for depth, number in enumerate(reversed(chain[-4:])):
                path = self.paths[number]
                tag = path.rsplit("/", 1)[-1].split(".")[0]
                total[path] = total.get(path, 0.0) + worth * 0.7 ** depth * (1.5 if tag in ("article", "main") else 1.0)
        return total

    def best(self) -> str | None:
        total = self.scores()
        return min(total, key=lambda p: (-total[p], p)) if total else None

    def text(self, path: str | None) -> str:
        if path is None:
            return "\n".join(t for _, t, _ in self.blocks)
        keep = {k for k, p in enumerate(self.paths) if p == path}
        return "\n".join(t for chain, t, _ in self.blocks if keep.intersection(chain))


def page_text(source: str | None, path: str | None) -> str:
    """Main text of a page whose host's winning path is ``path`` (None: none)."""
    if not source:
        return ""
    page = Page(source)
    own = page.best()
    if own is None:
        return page.text(None)
    mine = page.text(own)
    if path is None or path == own:
        return mine
    theirs = page.text(path)
    return theirs if 2 * len(theirs) >= len(mine) else mine


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def winning_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per host: the path with most votes, and the votes."""
    kept = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))

    def vote(batches):
        for batch in batches:
            best = [Page(h).best() if h else None for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.string())], names=["host", "path"])

    votes = kept.mapInArrow(vote, "host string, path string").where("path IS NOT NULL").groupBy("host", "path").agg(F.count("*").alias("votes"))
    top = F.min(F.struct((-F.col("votes")).alias("v"), F.col("path").alias("path"))).alias("top")
    return votes.groupBy("host").agg(top).select("host", F.col("top.path").alias("path"), (-F.col("top.v")).alias("votes"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, main text and its number of code points."""
    winners = stage(winning_paths(pages, url_col, html_col).select("host", "path"), "host-paths")  # its size is then known
    kept = pages.select(F.col(id_col).alias(id_col), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    joined = kept.join(winners, "host", "left").select(id_col, "url", "html", "path")

    def extract(batches):
        for batch in batches:
            text = [page_text(h, p) for h, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string())], names=[id_col, "url", "text"])

    kind = kept.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(extract, f"{id_col} {kind}, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
