"""Main text of web pages by consensus of each host's container paths.

Three steps. Every page scores its containers by the text that stands in them directly (link text counts against it) and
votes for generalised paths, such as ``body>div.post>article`` with digits and extra classes taken off. Spark adds the votes up
per host; paths with a tenth of a host's votes win, so there are at most ten. Every page is then read again through the
best winning path it has; a page without any, or without host, uses its own best container.

Menus, headers, footers, side columns, notices, adverts, forms and reader comments are left out wherever they stand, by
element, role, or words in class and id.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.base import query, stored, table

# Element names of the HTML standard by what they do to text, and words of class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr br img".split())
OUTSIDE = frozenset("head nav header footer aside form button select dialog menu object audio video canvas map fieldset".split())
CONTAINERS = frozenset("body article main section div td center blockquote details".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|nav|navbar|navigation|menu|breadcrumbs?|"
    r"header|masthead|footer|sidebar|side|aside|widget|related|recommended|share|sharing|social|newsletter|subscribe|signup|login|search|pagination|pager|"
    r"comments?|commentlist|disqus|respond|replies|reply|discussion)(?:$|[\s_\d-])", re.I)
CLOSED_BY = {  # an open element ends when one of these begins beside it
    "p": frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "option": frozenset(["option", "optgroup"]), "head": frozenset(["body"]),
}
SCOPES = frozenset("ul ol dl table td th article section div body main aside nav header footer form blockquote figure".split())

MARKUP = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
ENDS = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for t in RAW}
DEPTH = 32  # elements that a path tells apart
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


class Page:
    """Blocks of a page: text, link characters and the open elements around each, without what is left out."""

    def __init__(self, source: str) -> None:
        self.path: list[str] = [""]  # generalised path of each element
        self.parent, self.tag, self.outside, self.link = [-1], ["#"], [False], [False]
        self._opened: dict[str, int] = defaultdict(int)
        self.blocks: list[tuple[str, int, int]] = []  # text, link characters, element
        self._text: list[str] = []
        self._links = self._at = self._block = 0
        self._read(source)
        self._flush()

    def _flush(self) -> None:
        text = " ".join(html.unescape("".join(self._text)).split())
        if text:
            self.blocks.append((text, min(self._links, len(text)), self._block))
        self._text, self._links = [], 0

    def _say(self, text: str) -> None:
        if text and not self.outside[self._at]:
            if not self._text:
                self._block = self._at
            self._text.append(text)
            if self.link[self._at]:
                self._links += len(text)

    def _open(self, tag: str, attributes: str) -> None:
        n = self._at
        for _ in range(DEPTH):  # implied ends, up to the nearest scope
            if n <= 0:
                break
            if tag in CLOSED_BY.get(self.tag[n], ()):
                self._leave(n)
                break
            if self.tag[n] in SCOPES and self.tag[n] not in CLOSED_BY:
                break
            n = self.parent[n]
        values = {m[1].lower(): (m[2] or "").strip("\"'") for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
        if tag == "br" or tag == "wbr":
            self._say(" " if tag == "br" else "")
            return
        if tag not in INLINE:
            self._flush()
        if tag in VOID:
            return
        names = f"{values.get('class', '')} {values.get('id', '')}".strip()
        out = self.outside[self._at] or tag in OUTSIDE or "hidden" in values or values.get("aria-hidden") == "true" or values.get("role", "").lower() in ROLES
        if not out and names and tag not in ("html", "body", "article", "main"):
            out = bool(WORDS.search(names))
        kinds = sorted({k for k in re.sub(r"\d+", "", values.get("class", "")).lower().split() if k.strip("-_")})[:2]
        path = self.path[self._at]
        if tag not in INLINE:
            path = ">".join([*path.split(">")[-DEPTH:], ".".join([tag, *kinds])])
        self.path.append(path)
        self.link.append(tag == "a" or tag in INLINE and self.link[self._at])
        self._opened[tag] += 1
        self.parent.append(self._at)
        self.tag.append(tag)
        self.outside.append(out)
        self._at = len(self.tag) - 1

    def _leave(self, n: int) -> None:
        m, end = self._at, self.parent[n]
        while m != end:
            if self.tag[m] not in INLINE:
                self._flush()
            self._opened[self.tag[m]] -= 1
            m = self.parent[m]
        self._at = end

    def _close(self, tag: str) -> None:
        if tag == "p" or tag == "br":
            self._flush() if tag == "p" else self._say(" ")
        if not self._opened[tag]:
            return
        n = self._at
        while n > 0 and self.tag[n] != tag:
            if tag in INLINE and self.tag[n] not in INLINE:
                return  # an inline end tag does not end a block
            n = self.parent[n]
        if n > 0:
            self._leave(n)

    def _read(self, source: str) -> None:
        at = 0
        while m := MARKUP.search(source, at):
            self._say(source[at : m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                self._close(tag)
                continue
            attributes = m[3] or m[6] or ""
            if tag in RAW:
                if attributes.endswith("/") and tag in ("svg", "math"):
                    continue
                end = ENDS[tag].search(source, at)
                if not end and tag in ("svg", "math"):
                    continue  # never closed: a page's text goes on behind the start tag
                if not end:
                    return
                at = end.end()
                continue
            self._open(tag, attributes)
        self._say(source[at:])

    def scores(self) -> dict[int, float]:
        """By element: text of its blocks, half that of its inner elements' blocks, link text counted against both."""
        out: dict[int, float] = defaultdict(float)
        for text, links, n in self.blocks:
            gain, share = (len(text) - 2.0 * links) * (1.5 if text.count(".") + text.count(",") > 1 else 1.0), 1.0
            while n > 0 and share > 0.2:
                if self.tag[n] in CONTAINERS:
                    out[n] += gain * share
                    share /= 2
                n = self.parent[n]
        return out

    def votes(self) -> list[tuple[str, float]]:
        """Paths with at least half of the best path's score, as shares of it; containers of one path count together."""
        total: dict[str, float] = defaultdict(float)
        for n, s in self.scores().items():
            total[self.path[n]] += s
        best = max(total.values(), default=0.0)
        return sorted((p, s / best) for p, s in total.items() if s >= best / 2) if best > 0 else []

    def text(self, paths: list[str]) -> str:
        """Blocks below the first of ``paths`` that the page has, or below its own best one."""
        here = {self.path[n] for n in range(1, len(self.tag)) if not self.outside[n] and self.tag[n] in CONTAINERS}
        chosen = next((p for p in paths if p in here), None)
        if chosen is None:
            votes = self.votes()
            chosen = max(votes, key=lambda v: (v[1], v[0]))[0] if votes else ""
        inside = [False] * len(self.tag)
        for n in range(1, len(self.tag)):
            inside[n] = inside[self.parent[n]] or (self.path[n] == chosen and self.tag[n] in CONTAINERS)
        return "\n\n".join(t for t, _, n in self.blocks if inside[n] or not chosen)


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), F.nullif(host, F.lit("")).alias("host"))


def host_paths(pages: DataFrame, least: float = 0.1) -> DataFrame:
    """``host``, ``paths``: paths with at least ``least`` of the host's votes, most votes first."""
    def vote(parts):
        for pdf in parts:
            rows = [(h, p, v) for h, t in zip(pdf.host, pdf.html, strict=True) for p, v in Page(t).votes()]
            if rows:
                yield pd.DataFrame(rows, columns=["host", "path", "vote"])

    votes = with_host(pages).filter("host IS NOT NULL").select("host", "html").mapInPandas(vote, "host string, path string, vote double")
    added = stored(votes.groupBy("host", "path").agg(F.sum(F.round(F.col("vote") * 1000).cast("long")).alias("votes")), "votes")
    total = added.groupBy("host").agg(F.sum("votes").alias("total"))
    won = added.join(total, "host").filter(F.col("votes") >= least * F.col("total"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), (-F.length("path")).alias("n"), "path")))
    return won.groupBy("host").agg(F.transform(ranked, lambda s: s["path"]).alias("paths"))


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every row of ``pages`` (``page_id``, ``url``, ``html``).

    NULL or empty pages have an empty text. Hosts are joined after their votes are stored, so a host with most pages
    is split like any large key; Spark sends the host table along with the pages only where it is small.
    """
    def read(parts):
        for pdf in parts:
            texts = [Page(t).text([] if p is None else list(p)) for t, p in zip(pdf.html, pdf.paths, strict=True)]
            if texts:
                yield pdf[["page_id", "url"]].assign(text=texts, n_chars=np.array([len(t) for t in texts], np.int64))

    hosts = stored(host_paths(pages), "host-paths")
    kind = dict(pages.dtypes)["url"]
    joined = with_host(pages).join(hosts, "host", "left").select("page_id", "url", "html", "paths")
    return joined.mapInPandas(read, f"page_id long, url {kind}, text string, n_chars long")


@query("op1_html_extraction")
def op1(spark, folder):
    return extracted(table(spark, folder, "pages"))
