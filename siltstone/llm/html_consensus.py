"""Main-text extraction by consensus paths of a host.

Each page's containers are scored by the text of all blocks below them, blocks of links not counted.
The page votes for the generalised path (tags and classes, digits removed) of the lowest containers
that hold nearly all of it, and from there up to the wrapper below the body that misses none of
what such wrappers hold; up to the body only for a heading. Votes are summed per host in Spark, and
every page is extracted again through the winning paths of its host: all containers with the most
voted path that the page has, or its own best one if it has none.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are
left out wherever they stand; a container is one of them by its element, role or a whole class or id,
and by class or id, or as a form, fieldset, dialog or aside, only if it does not hold nearly all text of the page. NULL and empty html give an empty text; pages without a host vote
together. Rows that repeat vote and are extracted one by one; empty tables give empty results;
other columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WINNERS = 5
NEARLY_ALL = 0.9
# A form that holds the page holds a paragraph of this many code points; the labels of a login do not.
PARAGRAPH = 100

# Element names of the HTML standard, and words that name what is not an article.
_SILENT = frozenset("head title script style noscript template svg math textarea select button iframe object canvas audio video datalist".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CONTAINERS = frozenset(
    "html body main article section div td table tbody tr ul ol dl nav header footer aside form figure blockquote details center dialog fieldset menu search".split()
)
_BLOCKS = _CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre th thead tfoot caption figcaption hr address hgroup legend summary option".split())
_OUTSIDE = frozenset("nav header footer menu search".split())
# left out as well, but for one around the whole page, as server pages put it
_WRAPPERS = frozenset("aside form dialog fieldset".split())
_OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_OUTSIDE_WORD = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|comments?|commentlist|"
    r"disqus|replies|respond|sidebar|widgets?|share|sharing|social|related|recommend\w*|newsletter|subscribe|subscription|menu|nav|"
    r"navbar|navigation|breadcrumbs?|footer|masthead|toolbar|login|signup|pagination|pager"
)
_COMMENT_WORD = re.compile(r"comments?|commentlist")
# words that may stand beside one of those in a class without another meaning
_PLACE_WORDS = frozenset(
    "site main page post posts entry blog article articles top bottom left right side primary secondary global mobile desktop header area "
    "box bar list links link block container wrapper wrap inner outer section items item buttons button icons icon media title body text form row col".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BLANK = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_RAW = frozenset({"script", "style"})


def _says_outside(names: str, word: re.Pattern[str] = _OUTSIDE_WORD) -> bool:
    """Whether a whole class or id names what is not an article: 'site-footer' does, 'has-sidebar' does not."""
    for name in names.split():
        parts = [x for x in re.split("[^a-z]+", name.replace("side-bar", "sidebar")) if x]
        if any(map(word.fullmatch, parts)) and all(x in _PLACE_WORDS or _OUTSIDE_WORD.fullmatch(x) for x in parts):
            return True
    return False


class _Page(HTMLParser):
    """Blocks of text, each with the container it stands in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.paths, self.parents, self.outside, self.tags = [""], [-1], [False], [""]
        self.by_name = [False]  # left out for a class or id
        self.wrapper = [False]
        self.heading = False
        self.open = [0]
        self.silent: list[str] = []
        self.links = 0
        self.parts: list[str] = []
        self.link_chars = 0
        self.blocks: list[tuple[int, str, int]] = []
        self.headings: list[bool] = []  # of the blocks

    def flush(self) -> None:
        if self.parts:
            text = _BLANK.sub(" ", "".join(self.parts)).strip()
            if text and not self.outside[self.open[-1]]:
                self.blocks.append((self.open[-1], text, self.link_chars))
                self.headings.append(self.heading)
            self.parts, self.link_chars = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _SILENT:
            if not self.silent or tag != "head":
                self.flush()
                self.silent.append(tag)
            return
        if self.silent == ["head"] and tag in _BLOCKS:  # a head that was never closed ends at the body
            self.silent.clear()
        if self.silent:
            return
        if tag == "br":
            self.parts.append(" ")
        if tag not in _BLOCKS:
            self.links += tag == "a"
            return
        self.flush()
        self.links = 0
        self.heading = tag in _HEADINGS
        if tag in _CONTAINERS:
            given = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "hidden")}
            names = f"{given.get('class', '')} {given.get('id', '')}".lower()
            parent = self.open[-1]
            kind = "".join(f".{_DIGITS.sub('#', c)}" for c in sorted(set(given.get("class", "").lower().split())))
            self.paths.append(f"{self.paths[parent]}/{tag}{kind}")
            self.parents.append(parent)
            self.tags.append(tag)
            self.outside.append(
                self.outside[parent] or tag in _OUTSIDE or given.get("role", "").lower() in _OUTSIDE_ROLES or "hidden" in given
            )
            self.by_name.append(
                (tag not in ("html", "body", "main", "article") and _says_outside(names)) or (tag == "article" and _says_outside(names, _COMMENT_WORD))
            )
            self.wrapper.append(tag in _WRAPPERS)
            self.open.append(len(self.paths) - 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in _SILENT or tag in _CONTAINERS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in _SILENT:
            if tag in self.silent:
                del self.silent[len(self.silent) - 1 - self.silent[::-1].index(tag) :]
            return
        if self.silent:
            return
        if tag == "a":
            self.links = max(self.links - 1, 0)
        elif tag in _BLOCKS:
            self.flush()
            self.heading = False
            if tag in _CONTAINERS:
                for at in range(len(self.open) - 1, 0, -1):
                    if self.tags[self.open[at]] == tag:
                        del self.open[at:]
                        break

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.parts.append(data)
            if self.links:
                self.link_chars += len(data)

    def _held(self) -> tuple[list[int], list[int]]:
        """Of each container the characters below it, and those of its longest block but for links."""
        held, longest = [0] * len(self.paths), [0] * len(self.paths)
        for at, text, link_chars in self.blocks:
            held[at] += len(text)
            longest[at] = max(longest[at], len(text) - link_chars)
        for at in range(len(held) - 1, 0, -1):
            parent = self.parents[at]
            held[parent] += held[at]
            longest[parent] = max(longest[parent], longest[at])
        return held, longest

    def _leave_out(self, lost: list[bool]) -> None:
        for at in range(1, len(lost)):
            self.outside[at] |= self.outside[self.parents[at]] or lost[at]
        kept = [i for i, (at, _, _) in enumerate(self.blocks) if not self.outside[at]]
        self.blocks, self.headings = [self.blocks[i] for i in kept], [self.headings[i] for i in kept]

    def leave_out_parts(self) -> None:
        """Drop the blocks of forms and the like, then of containers named by class or id, but for those that hold nearly all text."""
        held, longest = self._held()
        whole = [n >= NEARLY_ALL * held[0] and most >= PARAGRAPH for n, most in zip(held, longest, strict=True)]
        self._leave_out([wrapper and not own for wrapper, own in zip(self.wrapper, whole, strict=True)])
        held, _ = self._held()
        self._leave_out([named and n < NEARLY_ALL * held[0] for named, n in zip(self.by_name, held, strict=True)])


def parse(html: str) -> _Page:
    page = _Page()
    page.feed(html)
    page.close()
    page.flush()
    page.leave_out_parts()
    return page


def path_scores(page: _Page) -> tuple[dict[str, float], dict[str, int], dict[str, str], set[str]]:
    """Of each path: the text of all blocks below it, less twice their links' text, if that is positive, and the number
    of headings; its depth first, so that the lowest comes last; its parent path; the paths of html and body."""
    value, heads = [0.0] * len(page.paths), [0] * len(page.paths)
    for (at, text, link_chars), heading in zip(page.blocks, page.headings, strict=True):
        value[at] += max(len(text) - 2.0 * link_chars, 0.0)
        heads[at] += heading
    if not any(value):  # a page of links only
        for at, text, _ in page.blocks:
            value[at] += len(text)
    for at in range(len(value) - 1, 0, -1):
        value[page.parents[at]] += value[at]
        heads[page.parents[at]] += heads[at]
    scores: dict[str, float] = {}
    headings: dict[str, int] = {}
    above: dict[str, str] = {}
    top = {""}
    for at, path in enumerate(page.paths):  # a path is longer than its parent's: containers of one path are never nested
        if not page.outside[at]:
            scores[path] = scores.get(path, 0.0) + value[at]
            headings[path] = headings.get(path, 0) + heads[at]
            above[path] = page.paths[page.parents[at]] if at else ""
            if page.tags[at] in ("html", "body"):
                top.add(path)
    return scores, headings, above, top


def best_path(page: _Page) -> tuple[str, float] | None:
    """The path to vote for and its score, where containers of one path count together."""
    if not page.blocks:
        return None
    scores, headings, above, top = path_scores(page)
    path = max((x for x, n in scores.items() if n >= NEARLY_ALL * scores[""]), key=lambda x: (x.count("/"), scores[x], x))
    up, wrapper = path, path
    while up not in top:  # the lowest wrapper that holds what the highest one holds
        if scores[up] > scores[wrapper] or headings[up] > headings[wrapper]:
            wrapper = up
        up = above[up]
    while up:  # html or body
        if headings[up] > headings[wrapper]:
            wrapper = up
        up = above[up]
    return wrapper, scores[wrapper]


def extract(html: str, winners: list[str]) -> str:
    """The main text through the first of the paths that the page has, else through its own best one."""
    if not html:
        return ""
    page = parse(html)
    own = best_path(page)
    if own is None:
        return ""
    held = {page.paths[at] for at, _, _ in page.blocks}
    for at in range(len(page.paths) - 1, 0, -1):  # a container holds what its children hold
        if page.paths[at] in held:
            held.add(page.paths[page.parents[at]])
    path = next((p for p in winners if p in held), own[0])
    inside = [False] * len(page.paths)
    for at in range(1, len(page.paths)):
        inside[at] = page.paths[at] == path or inside[page.parents[at]]
    if path == "":
        inside = [True] * len(page.paths)
    return "\n".join(text for at, text, _ in page.blocks if inside[at])


def host_of(url: str | None) -> str:
    """Lower-case host name, empty if there is none."""
    found = re.match(r"\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", url or "", re.IGNORECASE)
    return found[1].rpartition("@")[2].partition(":")[0].lower() if found else ""


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, pages, score) from (url, html): counted per batch first, so a hot host sends few rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            count: Counter[tuple[str, str]] = Counter()
            score: Counter[tuple[str, str]] = Counter()
            for url, html in zip(frame["url"], frame["html"], strict=True):
                if html and (best := best_path(parse(html))):
                    count[host_of(url), best[0]] += 1
                    score[host_of(url), best[0]] += max(best[1], 0.0)
            yield pd.DataFrame([(h, p, n, score[h, p]) for (h, p), n in count.items()], columns=["host", "path", "pages", "score"])

    one = pages.mapInPandas(run, "host string, path string, pages long, score double")
    return one.groupBy("host", "path").agg(F.sum("pages").alias("pages"), F.sum("score").alias("score"))


def winning_paths(counted: DataFrame, most: int = WINNERS) -> DataFrame:
    """(host, paths): the most voted paths of each host, best first."""
    order = [F.col("pages").desc(), F.col("score").desc(), F.col("path")]
    ranked = counted.withColumn("rank", F.row_number().over(W.partitionBy("host").orderBy(*order))).where(F.col("rank") <= most)
    sorted_paths = F.array_sort(F.collect_list(F.struct("rank", "path")))
    return ranked.groupBy("host").agg(F.transform(sorted_paths, lambda x: x["path"]).alias("paths"))


def extract_pages(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``df``: page_id, url, text."""
    pages = df.select(df[key].alias("page_id"), df[url].cast("string").alias("url"), F.coalesce(df[html].cast("string"), F.lit("")).alias("html"))

    @F.pandas_udf("string")
    def host(urls: pd.Series) -> pd.Series:
        return urls.map(host_of)

    @F.pandas_udf("string")
    def main_text(pages: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([extract(h, [] if p is None else list(p)) for h, p in zip(pages, paths, strict=True)], dtype=object)

    winners = winning_paths(votes(pages.select("url", "html")))
    joined = pages.withColumn("host", host("url")).join(winners, "host", "left")
    return joined.select("page_id", "url", main_text("html", "paths").alias("text"))
