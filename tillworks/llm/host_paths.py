"""Main text of pages by the consensus of their host.

Pages of one host are made from few templates. Each page scores its containers by the text that
stands in them outside links and boilerplate and proposes the best ones by path: the tags and
classes from the root down, numbers generalised. Spark adds up the proposals of a host; its
winning path is then applied to all its pages, also to those whose own text is too thin to tell.
A page that lacks the winning path uses its own best container. Templates of a host are told apart by the classes of
body; one with ``TEMPLATE_PAGES`` pages or more has votes of its own.

Sections and cells of an article are no containers of their own. From the best path the way leads up to
the outermost container that adds mostly text outside links: an article or main, or a container in which most
of the added text stands directly or in sections and cells, like a heading and a lead before a list of sections.

A noise word in a name hides an element, unless that element holds the page's only main or article, or most of
its text outside links and isn't for comments, consent or adverts; pieces after "has", "with" or "no" don't
count. If names hide everything, they hide nothing.

Cases: a null or empty page, or one without text outside boilerplate elements, has an empty text. A page
without host votes with all other such pages. Broken markup is read as browsers do: unclosed
paragraphs end at the next block, stray end tags are ignored. Extra columns are ignored; equal rows get equal texts. Ties go
to the smaller path.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import batch, short_batches, stored

TAG_START = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
TAG_STOP = re.compile(r"[>\"']")
CLASSES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
SPACE = re.compile(r"\s+")

#: Elements whose content is not markup.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object"}
#: Elements that are never part of the main text.
APART = RAW | {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "head"}
VOID = {"br", "hr", "img", "input", "link", "meta", "area", "base", "col", "embed", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
#: Elements that pages may leave out; they are no part of a path.
ROOTS = {"html", "body"}
CONTAINERS = {"main", "article", "section", "div", "td", "center"}
#: Containers that divide a text.
PARTS = {"section", "td"}
#: An element that begins ends an open one of these, up to the nearest container.
ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
        "th": {"td", "th", "p"}, "option": {"option"}}
LISTS = {"ul", "ol", "dl", "table"}
#: Words in a class, id or role that mark menus, notices, adverts, comments and the like.
NOISE = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "pager", "popup", "promo", "promotion",
    "related", "replies", "respond", "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe",
    "toolbar", "widget",
}
#: Noise that is made of links; inside a main or article a block named so is text unless most of it is linked.
LINKED = {
    "breadcrumb", "breadcrumbs", "complementary", "header", "masthead", "menu", "nav", "navbar", "navigation", "pager", "pagination", "related",
    "search", "share", "sharing", "sidebar", "social", "toolbar", "widget",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Noise that stays noise when it has most of a page's text.
SURE = {
    "ad", "ads", "advert", "adverts", "advertisement", "comment", "comments", "consent", "cookie", "cookies", "disqus", "gdpr",
    "newsletter", "promo", "promotion", "related", "replies", "respond", "sponsor", "sponsored", "subscribe",
}
#: What comes after these in a name is said of something else.
SAID = {"has", "with", "no", "without"}
#: Containers that a page proposes.
PROPOSED = 3
#: Winning paths that are handed to every task; with more, pages are joined to them in this many parts of each host.
MOST_PATHS, SALTS = 200_000, 64
#: Pages from which a template of a host has its own votes.
TEMPLATE_PAGES = 5


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def template(html: Column) -> Column:
    """The classes of body, numbers generalised."""
    classes = F.regexp_extract(html, r"(?i)<body\b[^>]*?\bclass\s*=\s*[\"']?([^\"'>]*)", 1)
    return F.regexp_replace(F.lower(classes), r"\d+", "#")


def _tag(path: str) -> str:
    return path[path.rfind(">") + 1:].partition(".")[0]


@lru_cache(20_000)
def _inside(path: str) -> bool:
    """Whether a main or article is in the path."""
    return any(part.partition(".")[0] in ("main", "article") for part in path.split(">"))


@lru_cache(20_000)
def _candidate(path: str) -> bool:
    """Sections and cells inside a main or article are parts of it."""
    return _tag(path) not in PARTS or not _inside(path)


def _climbs(above: str, added: float, unlinked: float, direct: float) -> bool:
    """Whether a container above the path belongs to the text, by the characters it adds."""
    if 2 * unlinked < added or not unlinked:
        return False
    return _tag(above) in ("main", "article") or 2 * direct >= added


def _noise(word: str) -> set[str]:
    """The noise words in a name."""
    pieces = re.split(r"[-_\d]+", word)
    return {p for i, p in enumerate(pieces) if p in NOISE and not SAID & set(pieces[:i])}


def _label(tag: str, attributes: str) -> tuple[str, set[str]]:
    """The element's part of a path, and the noise words in its names."""
    if "=" not in attributes:
        return tag, set()
    names, noise = [], set()
    for kind, a, b, c in CLASSES.findall(attributes):
        words = (a or b or c).lower().split()
        noise = noise.union(*map(_noise, words))
        if kind.lower() == "class":
            names += [re.sub(r"\d+", "#", w) for w in words]
    return ".".join([tag, *sorted(set(names))]), noise


def tokens(html: str) -> Iterator[tuple[int, int, str | None, str | None, str]]:
    """(start, end, slash, tag, attributes) of the tags of a page; comments and declarations have no tag.

    An end sign inside quotes doesn't end a tag. Where quotes don't close before the page does, they mean
    nothing from there on, so every character is passed a few times at most.
    """
    at, quotes, last = 0, True, html.rfind(">")
    while (m := TAG_START.search(html, at)) is not None:
        start, at = m.span()
        if m[2] is None:
            if m[0] != "<!--" and at > last:
                continue
            end = html.find("-->" if m[0] == "<!--" else ">", at)
            at = len(html) if end < 0 else end + (3 if m[0] == "<!--" else 1)
            yield start, at, None, None, ""
            continue
        if at > last:
            return
        end = at
        while quotes and (stop := TAG_STOP.search(html, end)) is not None and stop[0] != ">":
            close = html.find(stop[0], stop.end())
            if close < 0:
                quotes = False
            end = close + 1
        if quotes:
            end = -1 if stop is None else stop.start()
            quotes = stop is not None
        if not quotes:
            end = html.find(">", at)
        if end < 0:
            return
        tag, attributes, at = m[2].lower(), html[at:end], end + 1
        if not m[1] and tag in RAW and not attributes.endswith("/"):
            # What such an element holds isn't markup.
            yield start, at, m[1], tag, attributes
            close = _closing(tag).search(html, at)
            begun, at = (close.start(), close.end()) if close else (len(html), len(html))
            yield begun, at, "/", tag, ""
        else:
            yield start, at, m[1], tag, attributes


@lru_cache(None)
def _closing(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.IGNORECASE)


class Page:
    """The blocks of a page with the paths they stand in."""

    def __init__(self, html: str) -> None:
        #: (text, characters in links, container paths from the outermost in)
        self.blocks: list[tuple[str, int, tuple[str, ...]]] = []
        # (text, is in a link, elements named as noise that it stands in) of the open block, and (parts, paths) of all blocks.
        self._parts: list[tuple[str, bool, tuple[int, ...]]] = []
        self._all: list[tuple[list[tuple[str, bool, tuple[int, ...]]], tuple[str, ...]]] = []
        # Open elements: tag, container path or None, is never text, is named as noise.
        self._open: list[tuple[str, str | None, bool, bool]] = []
        self._apart = self._links = 0
        # Elements named as noise: those open, by number; of each whether it stays noise, and whether it holds a main or article.
        self._named: tuple[int, ...] = ()
        self._sure: list[bool] = []
        self._holds: list[bool] = []
        #: Whether it stands in a main or article and is named as something made of links only.
        self._inner: list[bool] = []
        #: Whether a main or article stands outside of them.
        self._shown = False
        self._paths: tuple[str, ...] = ("",)
        #: How many of each tag are open, and the paths of articles and mains that aren't comments or the like.
        self._tags: dict[str, int] = defaultdict(int)
        self._whole: dict[str, list[str]] = {"article": [], "main": []}
        at = 0
        for start, end, slash, tag, attributes in tokens(html):
            self._text(html[at:start])
            at = end
            if tag is None:
                continue
            if slash:
                self._end(tag)
            else:
                self._begin(tag, attributes)
        self._text(html[at:])
        self._close_block()
        self._show(self._hidden())
        if not self.blocks and self._all:
            self._show(set())

    def _text(self, text: str) -> None:
        if text and not self._apart:
            text = unescape(text) if "&" in text else text
            self._parts.append((text, self._links > 0, self._named))

    def _close_block(self) -> None:
        if self._parts:
            self._all.append((self._parts, self._paths))
            self._parts = []

    def _hidden(self) -> set[int]:
        """The elements named as noise that are taken for noise."""
        hidden = set(range(len(self._sure)))
        if not hidden:
            return hidden
        worth, in_links, total = [0] * len(hidden), [0] * len(hidden), 0
        for parts, _ in self._all:
            for text, linked, named in parts:
                n = len(SPACE.sub(" ", text).strip())
                total += 0 if linked else n
                for k in named:
                    if linked:
                        in_links[k] += n
                    else:
                        worth[k] += n
        return {k for k in hidden if not (
            self._holds[k] and not self._shown or 2 * worth[k] > total and not self._sure[k] or self._inner[k] and worth[k] > in_links[k])}

    def _show(self, hidden: set[int]) -> None:
        """Make blocks of what doesn't stand in these elements."""
        for parts, paths in self._all:
            shown = [p for p in parts if not p[2] or hidden.isdisjoint(p[2])]
            if text := SPACE.sub(" ", "".join([p[0] for p in shown])).strip():
                self.blocks.append((text, sum(len(p[0]) for p in shown if p[1]), paths))

    def _begin(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag == "hr":
                self._close_block()
            elif tag == "br":
                self._text(" ")
            return
        label, noise = _label(tag, attributes)
        inside = self._tags["article"] > 0 or self._tags["main"] > 0
        # The header of an article has its title; headings and words in a line aren't furniture there.
        apart = tag in APART and not (tag == "header" and inside)
        named = bool(noise) and tag not in ROOTS and not apart and not (inside and (tag in HEADINGS or tag in INLINE and tag != "a"))
        if tag not in INLINE:
            self._close_block()
            self._imply_ends(ENDS.get(tag, {"p"}))
        if attributes.endswith("/") and tag not in INLINE | CONTAINERS:
            return
        path = f"{self._paths[-1]}>{label}" if tag in CONTAINERS else None
        self._push(tag, path, apart, named)
        if named:
            self._named = (*self._named, len(self._sure))
            self._sure.append(not noise.isdisjoint(SURE))
            self._holds.append(False)
            self._inner.append(inside and noise <= LINKED)
        if tag in self._whole and not self._apart and not (self._named and self._sure[self._named[-1]]):
            self._whole[tag].append(path)
        if tag in ("main", "article") and not self._apart:
            # One that is named as noise for certain is a comment or the like.
            if not self._named:
                self._shown = True
            elif not any(self._sure[k] for k in self._named[-1:] if named):
                for k in self._named:
                    self._holds[k] = True

    def _push(self, tag: str, path: str | None, apart: bool, named: bool) -> None:
        self._open.append((tag, path, apart, named))
        self._tags[tag] += 1
        self._apart += apart
        self._links += tag == "a"
        if path is not None:
            self._paths = (*self._paths, path)

    def _pop(self) -> None:
        tag, path, apart, named = self._open.pop()
        self._tags[tag] -= 1
        self._apart -= apart
        if named:
            self._named = self._named[:-1]
        self._links -= tag == "a"
        if path is not None:
            self._paths = self._paths[:-1]

    def _imply_ends(self, tags: set[str]) -> None:
        for i in range(len(self._open) - 1, -1, -1):
            tag = self._open[i][0]
            if tag in CONTAINERS | ROOTS | APART | LISTS:
                return
            if tag in tags:
                while len(self._open) > i:
                    self._pop()
                return

    def _end(self, tag: str) -> None:
        inline = tag in INLINE
        if not inline:
            self._close_block()
        if not self._tags[tag]:
            return
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == tag:
                while len(self._open) > i:
                    self._pop()
                return
            if inline and self._open[i][0] in CONTAINERS:
                return

    def scores(self) -> dict[str, float]:
        """Text outside links; a container gets all of what stands in it directly, half of what
        stands one container deeper, and so on."""
        found: dict[str, float] = defaultdict(float)
        for text, linked, paths in self.blocks:
            worth = float(max(0, len(text) - 2 * linked))
            for path in filter(_candidate, reversed(paths)):
                found[path] += worth
                worth /= 2
        return found

    def above(self, path: str) -> dict[str, tuple[float, float, float]]:
        """(characters, those outside links, those of them that stand there directly or in its sections and cells) that each
        container above the path adds; from the outermost main or article down if it has one."""
        found: dict[str, list[float]] = {}
        for text, linked, paths in self.blocks:
            if path in paths:
                continue
            inner = next(p for p in reversed(paths) if _tag(p) not in PARTS)
            for above in paths[1:]:
                if path.startswith(above + ">") and _candidate(above) and not (_inside(path) and not _inside(above)):
                    sums = found.setdefault(above, [0.0, 0.0, 0.0])
                    sums[0] += len(text)
                    sums[1] += len(text) - linked
                    sums[2] += (len(text) - linked) * (above == inner)
        return {k: tuple(v) for k, v in found.items()}

    def own(self) -> str:
        """The page's own best path, and as far up as it goes."""
        best = self.best()
        if not best:
            return ""
        up = [a for a, sums in self.above(best[0][0]).items() if _climbs(a, *sums)]
        return min(up, key=len, default=best[0][0])

    def lone(self) -> str | None:
        """The path of the only article, or else of the only main, if it has text."""
        for paths in self._whole.values():
            if len(paths) == 1 and self.has(paths[0]):
                return paths[0]
        return None

    def best(self) -> list[tuple[str, float]]:
        """The ``PROPOSED`` containers that get votes, best first; a lone article or main wins over what stands outside it."""
        found, lone = self.scores(), self.lone()
        if lone is not None:
            found = {p: s for p, s in found.items() if p == lone or p.startswith(lone + ">")}
            found[lone] = max(found.get(lone, 0.0), 1.0)
        return sorted(((p, s) for p, s in found.items() if s > 0), key=lambda x: (-x[1], x[0]))[:PROPOSED]

    def text(self, path: str) -> str:
        return "\n".join([text for text, _, paths in self.blocks if path in paths])

    def has(self, path: str) -> bool:
        return any(path in paths for _, _, paths in self.blocks)


#: Votes have no ``above``; rows that count pages have no path; others say what a container above a page's best path adds.
VOTES = pa.schema([
    ("host", pa.string()), ("template", pa.string()), ("path", pa.string()), ("above", pa.string()), ("score", pa.float64()),
    ("added", pa.float64()), ("unlinked", pa.float64()), ("direct", pa.float64())])
VOTES_DDL = "host string, template string, path string, above string, score double, added double, unlinked double, direct double"


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        total: dict[tuple, list[float]] = defaultdict(lambda: [0.0] * 4)
        for name, kind, html in zip(*(rows.column(k).to_pylist() for k in range(3))):
            page = Page(html)
            best = page.best()
            total[name, kind, None, None][0] += 1
            for path, score in best:  # every page has one vote, shared by how good its containers are
                total[name, kind, path, None][0] += round(score / best[0][1], 3)
            for above, sums in page.above(best[0][0]).items() if best else ():
                of = total[name, kind, best[0][0], above]
                of[1:] = [a + b for a, b in zip(of[1:], sums)]
        yield batch(VOTES, *map(list, zip(*[(*k, *v) for k, v in total.items()])))


TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        texts = []
        for html, path in zip(rows.column(2).to_pylist(), rows.column(3).to_pylist()):
            page = Page(html)
            if path is None or not page.has(path):
                path = page.own()
            texts.append(page.text(path))
        yield batch(TEXTS, rows.column(0), rows.column(1), texts)


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, template, path): the path with most votes of each template that has pages enough, and of
    all pages of the host for other templates, led up as far as it goes."""
    sums = ["score", "added", "unlinked", "direct"]
    votes = pages.select("host", "template", "html").mapInArrow(_propose, VOTES_DDL)
    votes = stored(votes.groupBy("host", "template", "path", "above").agg(*[F.round(F.sum(c), 3).alias(c) for c in sums]), "votes")
    # Templates with few pages go together with all others of the host: their level is null.
    counts = votes.where("path IS NULL").select("host", "template", F.when(F.col("score") >= TEMPLATE_PAGES, F.col("template")).alias("level"))
    all_pages = votes.groupBy("host", "path", "above").agg(*[F.round(F.sum(c), 3).alias(c) for c in sums])
    levels = votes.withColumnRenamed("template", "level").unionByName(all_pages.withColumn("level", F.lit(None).cast("string"))).where("path IS NOT NULL")
    # The smaller path on ties: the negated score comes first.
    best = levels.where("above IS NULL").groupBy("host", "level").agg(F.min(F.struct((-F.col("score")).alias("s"), "path"))["path"].alias("best"))
    # As _climbs().
    whole = F.regexp_extract("above", ">([^>.]*)[^>]*$", 1).isin("main", "article")
    up = levels.where("above IS NOT NULL AND unlinked > 0 AND 2 * unlinked >= added").where(whole | (2 * F.col("direct") >= F.col("added")))
    up = up.groupBy("host", "level", F.col("path").alias("best")).agg(F.min(F.struct(F.length("above").alias("n"), "above"))["above"].alias("above"))

    def same(a, b):
        return a["host"].eqNullSafe(b["host"]) & a["level"].eqNullSafe(b["level"])

    paths = best.join(up, same(best, up) & (best["best"] == up["best"]), "left").select(
        best["host"], best["level"], F.coalesce(up["above"], best["best"]).alias("path"))
    return counts.join(paths, same(counts, paths)).select(counts["host"], "template", "path")


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    short_batches(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), host(F.col("url")).alias("host"))
    rows = rows.withColumn("template", template(F.col("html")))
    paths, on = stored(winning_paths(rows), "paths"), ["host", "template"]
    if paths.count() <= MOST_PATHS:  # a row for each host and template: pages stay where they are
        paths = F.broadcast(paths)
    else:
        # A hot host lies in many tasks.
        paths = paths.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows, on = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "html"), F.lit(SALTS)).cast("int")), [*on, "salt"]
    return rows.join(paths, on, "left").select("page_id", "url", "html", "path").mapInArrow(
        _extract, "page_id long, url string, text string")
