"""Main text of web pages by the container paths that the pages of a host agree on."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import field, slices
from riskloom.session import materialize, ship_package

# Most hosts whose winning paths are broadcast (a row is under 1 kB); beyond, they are joined by shuffle.
BROADCAST_HOSTS = 20_000
# Text of an element under an ambiguous name that counts as little: letters, and one part in so many of the page.
LITTLE = 200
LITTLE_PART = 10
_PATH_STEPS = 8

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe template svg select object video audio canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math mfrac mi mn mo mrow ms "
    "msqrt msub msubsup msup mtext q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
JUNK_TAGS = frozenset("nav footer aside button menu dialog head datalist".split())
# Junk unless they hold the page.
FORM_TAGS = frozenset("form fieldset".split())
CONTAINERS = frozenset("article main section div td body".split())
JUNK_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar sidebars "
    "menu nav navbar navigation breadcrumb breadcrumbs masthead footer comment comments disqus replies cookie cookies "
    "consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing "
    "social related recommended recommendations widget widgets toolbar pagination pager skip hidden alert".split()
)
JUNK_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split()
)
# Parts of a name that say nothing of their own beside a word of junk.
PLAIN_WORDS = frozenset(
    "area bar block box button buttons container content form header inner item items left line link links list main outer "
    "page panel post posts right row section site slot text thread title top bottom unit wrap wrapper".split()
)
GOOD_WORDS = frozenset("article content post entry story main text body".split())
# Elements that end an open element of the same set when they begin.
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
# How far back an end that is left out may reach.
SCOPE = frozenset("ul ol dl table body article section div main td th html".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME_PARTS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _attributes(source: str) -> dict[str, str]:
    if not source or source == "/":
        return {}
    return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")).lower() for m in _ATTRIBUTE.finditer(source)}


# What tag, role and names say of an element: nothing, that it is junk, or that it is unless its text says otherwise.
CLEAN, JUNK, FORM, DOUBTFUL, FALLBACK = range(5)


def _verdict(tag: str, attributes: dict[str, str], in_article: bool) -> int:
    if tag in JUNK_TAGS or (tag == "header" and not in_article):
        return JUNK
    if tag == "noscript":
        return CLEAN if in_article else FALLBACK
    if attributes and tag not in ("html", "body", "article", "main"):
        if attributes.get("role") in JUNK_ROLES - {"form"} or "hidden" in attributes or attributes.get("aria-hidden") == "true":
            return JUNK
        if _HIDDEN.search(attributes.get("style", "")):
            return JUNK
        found = max((_named(n, tag, in_article) for n in f"{attributes.get('class', '')} {attributes.get('id', '')}".split()), default=0)
        if found:
            return JUNK if found == 2 else DOUBTFUL
    return FORM if tag in FORM_TAGS or attributes.get("role") == "form" else CLEAN


def _named(name: str, tag: str, in_article: bool) -> int:
    """2 if a class name or id stands for junk alone, 1 if a part of it does, 0 if none."""
    parts = _NAME_PARTS.findall(name)
    if not parts or {"with", "has", "no", "without"} & set(parts):
        return 0
    if parts[0] in JUNK_WORDS or parts[-1] in JUNK_WORDS:
        return 2 if all(p in JUNK_WORDS or p in PLAIN_WORDS or len(p) == 1 for p in parts) else 1
    if tag not in INLINE and "header" in parts and not in_article and not GOOD_WORDS & set(parts):
        return 2
    return 0


def _step(tag: str, attributes: dict[str, str]) -> str:
    """The element in a generalised path: tag and class names, digits made alike."""
    names = sorted({_DIGITS.sub("#", n)[:30] for n in attributes.get("class", "").split()})[:3]
    return ".".join([tag, *names])


class Page:
    """The elements of a page and its clean text, block by block. Reading takes time in proportion to the page."""

    def __init__(self, source: str):
        self.parents, self.tags, self.steps = [-1], ["#page"], [""]
        self.verdicts, self.in_article = [CLEAN], [False]
        # One entry per stretch of text: element, block, text, inside a link.
        self.texts: list[tuple[int, int, str, bool]] = []
        self.block = 0
        self._read(source)
        self.junk = self._judged()

    def _open(self, tag: str, attributes: dict[str, str], parent: int) -> int:
        self.parents.append(parent)
        self.tags.append(tag)
        self.steps.append(_step(tag, attributes))
        self.verdicts.append(_verdict(tag, attributes, self.in_article[parent]))
        self.in_article.append(self.in_article[parent] or tag in ("article", "main"))
        return len(self.tags) - 1

    def _line(self, element: int) -> Iterator[int]:
        while element >= 0:
            yield element
            element = self.parents[element]

    def _judged(self) -> list[bool]:
        """Whether each element is junk or lies in junk.

        What holds the page's article is never junk by its name. An ambiguous name needs a
        second sign: mostly links, or little text. A form is junk unless it holds most
        of what is left of the page.
        """
        count = len(self.tags)
        letters, linked, article = [0] * count, [0] * count, [t in ("article", "main") for t in self.tags]
        for element, _, text, link in self.texts:
            size = len(text) - text.count(" ")
            letters[element] += size
            linked[element] += size * link
        for e in range(count - 1, 0, -1):
            letters[self.parents[e]] += letters[e]
            linked[self.parents[e]] += linked[e]
            article[self.parents[e]] |= article[e]

        def sure(e: int) -> bool:
            kind = self.verdicts[e]
            if kind == JUNK:
                return self.tags[e] in JUNK_TAGS or not article[e]
            if kind == DOUBTFUL:
                little = letters[e] < LITTLE and letters[e] * LITTLE_PART < letters[0]
                return not article[e] and (little or 2 * linked[e] >= letters[e] > 0)
            return False

        junk = [False] * count
        for e in range(1, count):
            junk[e] = junk[self.parents[e]] or sure(e)
        left = [0] * count
        for element, _, text, _ in self.texts:
            left[element] += 0 if junk[element] else len(text) - text.count(" ")
        for e in range(count - 1, 0, -1):
            left[self.parents[e]] += left[e]
        for e in range(1, count):
            held = article[e] or 2 * left[e] > left[0]
            unless = self.verdicts[e] in (FORM, FALLBACK) and not held
            junk[e] = junk[e] or junk[self.parents[e]] or unless
        return junk

    def _read(self, source: str) -> None:
        stack, links, at = [0], 0, 0
        size = len(source)
        depths: dict[str, list[int]] = defaultdict(list)  # where the open elements of each name stand

        def text(till: int) -> None:
            if till > at:
                self.texts.append((stack[-1], self.block, source[at:till], links > 0))

        def close(depth: int) -> None:
            nonlocal links
            while len(stack) > depth:
                name = self.tags[stack.pop()]
                depths[name].pop()
                links -= name == "a"

        def last(names: Iterable[str]) -> int:
            return max((depths[n][-1] for n in names if depths.get(n)), default=0)

        while at < size:
            token = _TOKEN.search(source, at)
            if token is None:
                text(size)
                break
            text(token.start())
            at = token.end()
            tag = (token[2] or token[5] or "").lower()
            if not tag:
                continue
            if tag not in INLINE and tag not in RAW:
                self.block += 1
            if token[1] or token[4]:
                if depth := last((tag,)):
                    close(depth)
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                at = end.end() if end else size
                continue
            if tag in VOID:
                if tag == "br":
                    self.texts.append((stack[-1], self.block, " ", links > 0))
                continue
            if tag not in INLINE:
                # A block ends an open paragraph; some elements end their like, as far back as the next enclosing one.
                ends = ("p", *CLOSES.get(tag, ()))
                barrier = last(SCOPE.difference(ends))
                while (depth := last(ends)) > barrier:
                    name = self.tags[stack[depth]]
                    close(depth)
                    if name == "p" and tag not in CLOSES:
                        break
            depths[tag].append(len(stack))
            stack.append(self._open(tag, _attributes(token[3] or token[6] or ""), stack[-1]))
            links += tag == "a"

    def path(self, element: int) -> str:
        """The last steps down to an element."""
        steps = [self.steps[e] for e in islice(self._line(element), _PATH_STEPS) if e]
        return ">".join(steps[::-1])

    def _inside(self, roots: Iterable[int]) -> list[bool]:
        inside = [False] * len(self.tags)
        for e in roots:
            inside[e] = True
        for e in range(1, len(self.tags)):
            inside[e] = inside[e] or inside[self.parents[e]]
        return inside

    def outermost(self, elements: Iterable[int]) -> set[int]:
        """Those that lie in none of the others."""
        inside = self._inside(elements)
        return {e for e in elements if e == 0 or not inside[self.parents[e]]}

    def scores(self) -> list[tuple[int, int, int]]:
        """Containers with their score (0 to 1000) and number of clean letters outside links, best first.

        The score is the share of the page's clean text that the container holds. The best is the
        page's one article, or its main element, if that holds at least half of the clean text; else the
        smallest container that holds all of it. Junk inside does not count, as it goes anyway.
        """
        clean = [0] * len(self.tags)
        for element, _, text, linked in self.texts:
            clean[element] += 0 if linked or self.junk[element] else len(text) - text.count(" ")
        for e in range(len(self.tags) - 1, 0, -1):
            clean[self.parents[e]] += clean[e]
        total = clean[0]
        held = [e for e in range(len(self.tags)) if total and clean[e] and not self.junk[e]]
        found = [(e, 1000 * clean[e] // total, clean[e]) for e in held if e == 0 or self.tags[e] in CONTAINERS]
        declared = -1
        for tag in ("article", "main"):
            ones = self.outermost([e for e in held if self.tags[e] == tag]) if declared < 0 else ()
            if len(ones) == 1 and 2 * clean[min(ones)] >= total:
                declared = min(ones)
        # Then those with all text, the innermost first; then by size.
        return sorted(found, key=lambda x: (x[0] != declared, -x[2], -x[0]))

    def text(self, roots: set[int]) -> str:
        """Clean text inside the roots: a block's white space is one space, blocks are lines."""
        inside = self._inside(roots)
        blocks: dict[int, list[str]] = {}
        for element, block, text, _ in self.texts:
            if inside[element] and not self.junk[element]:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks.values())
        return "\n".join(line for line in lines if line)


def vote(source: str) -> tuple[str, int] | None:
    """Generalised path and score of a page's best container; None for a page without clean text."""
    page = Page(source)
    ranked = page.scores()
    return (page.path(ranked[0][0]), ranked[0][1]) if ranked else None


def main_text(source: str, path: str | None) -> str:
    """Text of the containers on the host's path where that loses nothing of the page's own best one, else of the latter."""
    page = Page(source)
    ranked = page.scores()
    if not ranked:
        return ""
    best = ranked[0][0]
    roots = page.outermost([e for e, _, _ in ranked if path is not None and page.path(e) == path])
    if not any(e in roots for e in page._line(best)):
        roots = {best}
    return page.text(roots)


def host(url_col: str):
    """Lower-case host of a URL; empty for null or anything else."""
    pattern = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
    return F.lower(F.coalesce(F.regexp_extract(F.col(url_col), pattern, 1), F.lit("")))


def winning_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`host`, `path`: the container path that most pages of the host vote for.

    A page votes for its best container. Votes are added up per task before they are
    exchanged, so a host with a third of the pages sends no more than any other. Ties go
    to the larger sum of scores, the longer path, the later in order.
    """
    ship_package(pages.sparkSession)
    rows = pages.select(host(url_col).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sums: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0])
            for where, source in zip(batch.column(0), batch.column(1)):
                if found := vote(source.as_py()):
                    counted = sums[where.as_py(), found[0]]
                    counted[0] += 1
                    counted[1] += found[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in sums], pa.string()),
                    pa.array([k[1] for k in sums], pa.string()),
                    pa.array([v[0] for v in sums.values()], pa.int64()),
                    pa.array([v[1] for v in sums.values()], pa.int64()),
                ],
                names=["host", "path", "votes", "score"],
            )

    counted = rows.mapInArrow(run, "host string, path string, votes long, score long").groupBy("host", "path")
    ranked = counted.agg(F.sum("votes").alias("votes"), F.sum("score").alias("score"))
    best = F.max(F.struct("votes", "score", F.length("path").alias("n"), "path")).alias("best")
    return ranked.groupBy("host").agg(best).select("host", F.col("best.path").alias("path"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`id_col`, `url_col`, `text` for every page: the main text of the whole page.

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
    comments go by tag, role and name, an ambiguous name only with a second sign; what is left of the agreed container is
    kept whole, and a page never loses text of its own best container to the host's path. A null or empty page has an empty text; a null or odd URL belongs to the
    nameless host; repeated rows stay; an empty table gives an empty result; other
    columns are ignored.
    """
    paths = materialize(winning_paths(pages, url_col, html_col), "host-paths")
    small = paths.count() <= BROADCAST_HOSTS
    rows = pages.select(
        F.col(id_col), F.col(url_col), F.coalesce(F.col(html_col), F.lit("")).alias("html"), host(url_col).alias("host")
    )
    joined = rows.join(F.broadcast(paths) if small else paths, "host", "left").select(id_col, url_col, "html", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(h.as_py(), p.as_py()) for h, p in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=[id_col, url_col, "text"]
            )

    schema = T.StructType([field(joined, id_col), field(joined, url_col), T.StructField("text", T.StringType())])
    return joined.mapInArrow(run, schema)
