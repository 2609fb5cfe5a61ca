"""Main text of web pages by consensus paths of their hosts.

First pass: in each page, every container (article, main, section, div, cell, body) is
scored by the prose that it holds, and the best one votes, with its generalised path of tags
and classes (digits become #), for its host. Spark sums votes by host and path; all paths
with a tenth of the leading one's votes and a hundredth of all win: stated parameters of
``host_paths``, by which a host of many templates keeps at most 100. Second pass: a page's text
is taken again from the elements on the deepest winning path that hold most of its best
container's score; a page with none falls back on its own best one.

Elements are judged by their tags, roles, and the words in class and id, of which the last
names the thing: ``main-nav`` is a nav, ``nav-content`` is content. A header inside an article, or inside
a container that is named like one, is part of it. What is hidden is no text.

Winning paths are a few short strings per host. Their bytes are counted: up to
``BROADCAST_BYTES`` they are broadcast; beyond, they are joined to pages by host, where
adaptive execution splits a hot host. Html is parsed twice and, up to that size, not moved.
Parsing takes time and memory in proportion to the page, however broken: no part is read
again, omitted end tags of cells, rows and list items are supplied, and a path longer than
``LONGEST_PATH`` goes by its hash and depth.

A null html gives an empty text; a null url has host "". Rows are returned one for one, those
that repeat a page_id too; all vote. Of equally good containers the later one counts, of paths
with equal votes the first in order of text.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch

BROADCAST_BYTES = 32 << 20
LONGEST_PATH = 1000
NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)")
SIMPLE = re.compile(r"((?:\s++[^\s\"'>/=]++(?:=(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?)*+)\s*+/?>")
PIECE = re.compile(r"[\s/]*+(?:(>)|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?)?)")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*+(?:=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))?)?")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
DIGITS = re.compile("[0-9]+")
# Roles of elements and of words in class and id.
CONTAINERS = {"html", "body", "main", "article", "section", "div", "td", "center"}
NESTED = CONTAINERS | {"table", "ul", "ol", "dl", "blockquote", "figure", "a", "th", "tr"}
BLOCKS = CONTAINERS | set("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd tr th table thead tbody pre blockquote figure figcaption hr address details summary".split())
RAW = {"script", "style", "noscript", "textarea", "iframe", "title", "xmp", "noembed", "noframes"}
DROPPED = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", "template", "svg", "object", "video", "audio", "canvas", "annotation", "annotation-xml", "fieldset"}
BREAKS = BLOCKS | {"nav", "header", "footer", "aside", "form", "menu", "dialog", "head", "fieldset", "legend", "label"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
# Elements whose end tag may be missing: which open ones a new one ends, and where the search stops.
ENDS = {
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"td", "th", "tr"}, {"table"}),
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
}
NEVER = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo comment comments commentlist reply replies respond disqus cookie cookies consent gdpr notice notices popup modal newsletter subscribe signup login paywall outbrain taboola notification notifications announcement announcements disclaimer".split())
SELDOM = set("nav navbar navigation menu header masthead footer sidebar aside breadcrumb breadcrumbs share sharing social related toolbar topbar bottombar pagination pager banner widget widgets alert recommended recommendations trending popular teaser teasers cart basket search skip discussion discussions tags".split())
PAIRS = {("most", "read"), ("read", "next"), ("up", "next"), ("more", "stories"), ("more", "from"), ("tag", "list"), ("see", "also"), ("also", "like")}
HIDDEN = {"hidden", "sr-only", "visually-hidden", "visuallyhidden", "screen-reader-text", "d-none", "invisible"}
POSTS = {"post", "entry", "hentry", "article", "story"}
PROSE = set("content article post entry main story text body".split())
FRAMES = set("wrap wrapper container inner outer layout page grid row".split())
STATES = {"has", "with", "no", "without", "is", "not"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
WEIGHTS = {"article": 2.0, "main": 1.6, "body": 0.6, "html": 0.5, "": 0.5}


def words_in(name: str) -> list[str]:
    return [w for w in re.split("[_-]+", CAMEL.sub("-", name).lower()) if w]


def boilerplate_name(name: str) -> bool:
    """Whether a class or id names something beside the main text."""
    words = words_in(name)
    if not words or words[0] in STATES:
        return False
    if NEVER.intersection(words) or PAIRS.intersection(zip(words, words[1:])):
        return True
    head, rest = words[-1], set(words[:-1])
    if head in SELDOM:
        return not (head in ("header", "masthead") and rest & PROSE)
    return bool(rest & SELDOM) and head not in PROSE | FRAMES


class Page:
    """Blocks of prose of a page, and its containers with their paths."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, int, int]] = []  # text, characters in links, container
        self.parents: list[int] = [-1]
        self.tags: list[str] = [""]
        self.steps: list[str] = [""]
        self.depths: list[int] = [0]
        self.hashes: list[int] = [0]
        self._parts: list[str] = []
        self._linked = 0
        self._read(source)

    def _end_block(self, node: int) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                self.blocks.append((text, self._linked, node))
            self._parts, self._linked = [], 0

    def _read(self, source: str) -> None:
        self._stack: list[tuple[str, bool, int, bool]] = []  # tag, dropped, container before it, whether it is an article
        self._count: Counter[str] = Counter()  # open elements by tag
        self._node = self._dropped = self._posts = at = 0
        unclosed: set[str] = set()  # raw elements that have no end tag from here on
        while at < len(source):
            start = source.find("<", at)
            upto = start if start >= 0 else len(source)
            m = NAME.match(source, start + 1) if start >= 0 else None
            mark = m or start >= 0 and source[start + 1 : start + 2] in ("!", "?", "/")
            if start >= 0 and not mark:
                upto = start + 1  # a sign, not a tag
            if upto > at and not self._dropped:
                text = entities.unescape(source[at:upto])
                self._parts.append(text)
                self._linked += len(text) * (self._count["a"] > 0)
            if not mark:
                at = upto
                continue
            if not m:
                opener = ("-->", start + 4) if source.startswith("<!--", start) else (">", start + 2)
                end = source.find(*opener)
                at = end + len(opener[0]) if end >= 0 else len(source)
                continue
            at, attrs = self._attributes(source, m.end())
            tag = m.group(2).lower()
            if m.group(1):
                self._close(tag)
            elif tag in RAW:
                end = None if tag in unclosed else re.compile(f"</{re.escape(tag)}[^>]*+>", re.I).search(source, at)
                if end:
                    at = end.end()
                else:
                    unclosed.add(tag)
                    at = len(source) if tag in ("script", "style") else at
            else:
                self._begin(tag, attrs)
        self._end_block(self._node)

    @staticmethod
    def _attributes(source: str, at: int) -> tuple[int, str]:
        """Where the tag ends, and its attributes; a tag that never ends takes the rest."""
        m = SIMPLE.match(source, at)
        if m:
            return m.end(), m.group(1)
        k = at
        while m := PIECE.match(source, k):
            if m.group(1):
                return m.end(), source[at : m.end() - 1]
            k = m.end()
        return len(source), source[at:]

    def _pop(self, upto: int) -> None:
        while len(self._stack) > upto:
            tag, dropped, self._node, post = self._stack.pop()
            self._dropped -= dropped
            self._posts -= post
            self._count[tag] -= 1

    def _close(self, tag: str) -> None:
        if tag in BREAKS and not self._dropped:
            self._end_block(self._node)
        if self._count[tag]:
            self._pop(next(k for k in range(len(self._stack) - 1, -1, -1) if self._stack[k][0] == tag))

    def _begin(self, tag: str, attrs: str) -> None:
        if tag in BREAKS and not self._dropped:
            self._end_block(self._node)
        if tag == "br" and not self._dropped:
            self._parts.append(" ")
        if tag in VOID:
            return
        while self._stack and self._stack[-1][0] == "p" and tag in BLOCKS:
            self._pop(len(self._stack) - 1)
        if tag in ENDS and any(map(self._count.__getitem__, ENDS[tag][0])):
            ended, stops = ENDS[tag]
            last = len(self._stack)
            for k in range(last - 1, -1, -1):
                own = self._stack[k][0]
                if own in ended:
                    last = k
                    if own == tag or tag != "tr" or not self._count["tr"]:
                        break
                elif own in stops:
                    break
            self._pop(last)
        names = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attrs)} if attrs.strip() else {}
        bad = tag in DROPPED and not (tag == "header" and self._posts) or self._boilerplate(tag, names)
        if bad or tag in NESTED:
            post = not bad and tag in CONTAINERS and self._post(tag, names)
            self._stack.append((tag, bad, self._node, post))
            self._posts += post
            self._count[tag] += 1
            self._dropped += bad
            if tag in CONTAINERS and not self._dropped:
                self._node = self._open(tag, names, self._node)

    def _open(self, tag: str, names: dict[str, str], node: int) -> int:
        marks = sorted({DIGITS.sub("#", c).replace(">", "_") for c in names.get("class", "").split()})
        step = f">{tag}" + "".join(f".{c}" for c in marks)
        self.parents.append(node)
        self.tags.append(tag)
        self.steps.append(step)
        self.depths.append(self.depths[node] + 1)
        self.hashes.append(xxhash.xxh3_64_intdigest(step.encode("utf-8", "surrogatepass"), seed=self.hashes[node]))
        return len(self.parents) - 1

    def path(self, node: int) -> str:
        """A container's path from the root; a long one's hash and depth."""
        name, depth, steps, size = self.hashes[node], self.depths[node], [], 0
        while node > 0 and size <= LONGEST_PATH:
            steps.append(self.steps[node])
            size += len(steps[-1])
            node = self.parents[node]
        return "".join(reversed(steps)) if size <= LONGEST_PATH else f"#{name:016x}" + ">" * min(depth, LONGEST_PATH)

    @staticmethod
    def _post(tag: str, names: dict[str, str]) -> bool:
        """Whether a container is an article, so that a header inside is part of it."""
        marks = [*names.get("class", "").split(), *names.get("id", "").split()]
        return tag in ("article", "main") or tag not in ("html", "body") and any(w and w[-1] in POSTS for w in map(words_in, marks))

    @staticmethod
    def _boilerplate(tag: str, names: dict[str, str]) -> bool:
        if not names:
            return False
        if "hidden" in names or names.get("aria-hidden") == "true" or re.search(r"display\s*+:\s*+none|visibility\s*+:\s*+hidden", names.get("style", ""), re.I):
            return True
        if tag in ("html", "body", "article", "main"):
            return False
        if ROLES.intersection(names.get("role", "").lower().split()):
            return True
        marks = [*names.get("class", "").split(), *names.get("id", "").split()]
        if HIDDEN.intersection(marks):
            return True
        bad = [m for m in marks if boilerplate_name(m)]
        if not bad:
            return False
        never = any(NEVER.intersection(words_in(m)) for m in bad)
        return never or not any(PROSE.issuperset(words_in(m)) for m in marks)

    def scores(self) -> dict[int, float]:
        """Of each container: its prose and, less with each level, that of containers inside."""
        out: dict[int, float] = defaultdict(float)
        for text, linked, node in self.blocks:
            value = max(0.0, len(text) - 2.0 * linked) * (1.0 if len(text) >= 40 else 0.5)
            while node >= 0 and value > 0.01:  # so some tens of levels up, however deep
                out[node] += value
                value *= 0.8
                node = self.parents[node]
        for node in out:
            words = set(re.split(r"[._-]", self.steps[node]))
            out[node] *= WEIGHTS.get(self.tags[node], 1.3 if words & PROSE else 1.0)
        return out

    def best(self, scores: dict[int, float]) -> int:
        return max(scores, key=lambda k: (scores[k], k), default=0)

    def text(self, paths: list[str]) -> tuple[str, str]:
        """The text on the deepest of ``paths`` that holds most of the page's prose, else in the
        best container; and the path. Of equally deep ones, the first counts."""
        scores = self.scores()
        best = self.best(scores)
        if len(paths):
            on, levels = defaultdict(list), {p.count(">") for p in paths}
            for k, score in scores.items():
                if score > 0 and min(self.depths[k], LONGEST_PATH) in levels:
                    on[self.path(k)].append(k)
            for path in sorted(paths, key=lambda p: -p.count(">")):
                roots = set(on.get(path, ()))
                if 2 * sum(scores[k] for k in roots) > scores.get(best, 0.0) and (found := self._inside(roots)):
                    return found, path
        return self._inside({best}), self.path(best)

    def _inside(self, roots: set[int]) -> str:
        under = [False] * len(self.parents)
        for k, parent in enumerate(self.parents):
            under[k] = k in roots or parent >= 0 and under[parent]
        return "\n".join(text for text, _, node in self.blocks if under[node])


def votes(source: str | None) -> list[tuple[str, float]]:
    """The path of the page's best container, with one vote."""
    if not source:
        return []
    page = Page(source)
    scores = page.scores()
    best = page.best(scores)
    return [(page.path(best), 1.0)] if scores.get(best, 0.0) > 0 else []


def host():
    return F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def host_paths(pages: DataFrame, least_share: float = 0.1, least_of_all: float = 0.01) -> DataFrame:
    """(host, path, place): the leading paths of each host, by votes: those with a share of the first one's and of all."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums: dict[tuple[str, str], float] = defaultdict(float)
            for h, source in zip(batch["host"], batch["html"], strict=True):
                for path, share in votes(source):
                    sums[h, path] += share
            yield pd.DataFrame([(h, p, round(v * 1e6)) for (h, p), v in sums.items()], columns=["host", "path", "votes"])

    cast = pages.select(host().alias("host"), F.col("html").cast("string").alias("html")).mapInPandas(count, "host string, path string, votes long")
    summed = cast.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    ranked = summed.withColumn("place", F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path")))
    most = F.max("votes").over(Window.partitionBy("host"))
    total = F.sum("votes").over(Window.partitionBy("host"))
    ranked = ranked.where("votes > 0").withColumns({"most": most, "total": total}).where(F.col("votes") >= F.col("total") * least_of_all)  # at most 1 / least_of_all paths
    return ranked.where(F.col("votes") >= F.col("most") * least_share).select("host", "path", "place")


def extract(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """page_id, url, text, n_chars and path of each page."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "html")
    winners = host_paths(pages).groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "path"))), lambda s: s["path"]).alias("paths"))
    winners = scratch.write(winners, "winners")
    size = winners.agg(F.sum(F.length("host") + F.length(F.array_join("paths", " "))).alias("n")).first()["n"] or 0
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host().alias("host"), F.col("html").cast("string").alias("html"))
    shared = None
    if size <= broadcast_bytes:
        shared = spark.sparkContext.broadcast({r["host"]: r["paths"] for r in winners.toLocalIterator()})
    else:
        rows = rows.join(winners, "host", "left")

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = map(shared.value.get, batch["host"]) if shared else batch["paths"]
            found = [Page(s).text([*(p if p is not None else [])]) if s else ("", "") for s, p in zip(batch["html"], known, strict=True)]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": [t for t, _ in found], "n_chars": [len(t) for t, _ in found], "path": [p for _, p in found]})

    return rows.mapInPandas(take, "page_id long, url string, text string, n_chars long, path string")
