"""Main text of web pages by consensus host paths (operator 4).

Every page scores its containers by the text of the blocks under them (link text counts
against them).  From the best one it climbs to the article or main element around it, or, where there
is none, to the ancestor that holds text of its own (a title, a lead) or sections alike beside it, and votes
for that container's generalised path: tags with classes, numbers blanked.  Spark counts the votes
per host, and the page is extracted again from the containers on a winning path of its host, the one
that holds most text on the page.  A page keeps its own container where that encloses the
winning ones, where it is an article or main element that no winning path touches, and where no winning
path is on it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import spread_join, stored, trimmed

#: a path needs this many votes, and this share of its host's pages, to win
MIN_VOTES = 2
MIN_SHARE = 0.01

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    # never text; without an end tag the first kind runs to the end of the page, the second is a mere tag
    r"|<(?P<raw>script|style|textarea|iframe|title)(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<svg(?=[\s/>])(?:[^\"'>]|\"[^\"]*+\"|'[^']*+')*?/>"
    r"|<(?P<odd>noscript|template|svg|select|object)(?=[\s/>])[^>]*+>.*?</(?P=odd)\s*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs2>[^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*\Z", re.S | re.I)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_DIGITS = re.compile(r"\d+")

# fixed values: element kinds
_SCORED = frozenset("body div article section main td center".split())
_HELD = _SCORED | frozenset("html head nav header footer aside form ul ol table dl figure button menu dialog blockquote".split())
_DROPPED = frozenset("head nav footer aside form button menu dialog".split())
_BLOCK = _HELD | frozenset("p br hr h1 h2 h3 h4 h5 h6 li dt dd pre tr th address figcaption details summary caption".split())
# fixed values: words of class names, ids and roles that mark what is not the article, and words that
# may stand beside them; a name marks a container only if all its words are of these lists
_SIDE = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments commentlist complementary consent contentinfo "
    "cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination "
    "popup promo promoted related replies respond search share sharing sidebar social sponsor sponsored subscribe subscription toolbar".split())
_BESIDE = frozenset(
    "area articles bar block bottom box buttons column container content form global group header inner left link links list main outer page "
    "panel posts primary right row secondary section site sticky sub thread top widget widgets wrap wrapper".split())
_WORDS = re.compile(r"[^a-z]+")


def is_side(names: str) -> bool:
    """Whether one of the names (class tokens, an id, a role) says that a container is no article."""
    for name in names.lower().split():
        words = [w for w in _WORDS.split(name) if w]
        if any(w in _SIDE for w in words) and all(w in _SIDE or w in _BESIDE for w in words):
            return True
    return False


@dataclass
class Page:
    """Containers in page order (tag, generalised path, parent, what drops them) and blocks
    (container, parts, gain: characters less twice those of links)."""

    tags: list[str] = field(default_factory=lambda: [""])
    paths: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [-1])
    dropped: list[bool] = field(default_factory=lambda: [False])
    aside: list[bool] = field(default_factory=lambda: [False])
    blocks: list[tuple[int, list[str], float]] = field(default_factory=list)

    def settle(self) -> Page:
        """Drop the blocks of side containers, unless that leaves no text at all."""
        kept = [b for b in self.blocks if not self.aside[b[0]]]
        if kept or not self.blocks:
            self.blocks = kept
            self.dropped = [a or b for a, b in zip(self.dropped, self.aside)]
        return self

    def gains(self) -> tuple[list[float], list[float]]:
        """Gain of each container's own blocks, and of all blocks under it."""
        own = [0.0] * len(self.tags)
        for at, _, gain in self.blocks:
            own[at] += gain
        under = list(own)
        for i in range(len(under) - 1, 0, -1):
            under[self.parents[i]] += under[i]
        return own, under

    def best(self) -> int:
        """The container with the highest score, the first of equals; -1 if no block is kept.
        A block counts whole for its own container and by half less for each one around it."""
        scores = [0.0] * len(self.tags)
        for at, _, gain in self.blocks:
            i, weight = at, 1.0
            while i >= 0 and weight > 0.2:
                if self.tags[i] in _SCORED and not self.dropped[i]:
                    scores[i] += weight * gain
                    weight *= 0.5
                i = self.parents[i]
        at = max(range(len(scores)), key=lambda i: (scores[i], -i))
        return at if scores[at] > 0 else -1

    def main(self) -> int:
        """The container of the article: around the best one; -1 if no block is kept."""
        best = self.best()
        if best <= 0:
            return best
        line = [best]
        while self.parents[line[-1]] >= 0:
            line.append(self.parents[line[-1]])
        own, under = self.gains()
        for kind in ("article", "main"):
            outer = [i for i in line if self.tags[i] == kind]
            if outer:
                at = outer[-1]
                alike = [i for i, p in enumerate(self.parents) if p == self.parents[at] and self.tags[i] == kind and not self.dropped[i]]
                # a page of several articles, none of which is most of it
                return at if 2 * under[at] >= sum(max(under[i], 0) for i in alike) else self.parents[at]
        beside: dict[int, list[int]] = {}
        for i, p in enumerate(self.parents):
            if not self.dropped[i]:
                beside.setdefault(p, []).append(i)
        chosen = best
        for c, p in zip(line, line[1:]):
            if self.tags[p] == "html":
                break
            others = [i for i in beside.get(p, ()) if i != c and under[i] > 0]
            alike = [i for i in others if self.tags[i] == "section" or self.paths[i] == self.paths[c] or self.paths[i].endswith("/" + self.tags[i])]
            if (own[p] > 0 or alike) and (p > 0 and self.tags[p] != "body" or len(alike) == len(others)):
                chosen = p
            elif len(alike) < len(others):
                break
        return chosen

    def inside(self, chosen: set[int]) -> list[bool]:
        """Whether each container is a chosen one or under one."""
        out = [0 in chosen] * len(self.tags)
        for i in range(1, len(out)):
            out[i] = i in chosen or out[self.parents[i]]
        return out

    def text(self, chosen: set[int]) -> str:
        """Cleaned blocks under the chosen containers, in page order."""
        inside, lines = self.inside(chosen), []
        for at, parts, _ in self.blocks:
            if inside[at]:
                line = " ".join(html.unescape("".join(parts)).split())
                if line:
                    lines.append(line)
        return "\n".join(lines)


def _attribute(found: re.Match) -> str:
    return found[1] or found[2] or found[3] or ""


def parse(source: str) -> Page:
    page = Page()
    stack: list[tuple[str, int]] = [("", 0)]
    here, parts, linked, links = 0, [], 0, 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            size = sum(map(len, parts))
            if not page.dropped[here] and any(not p.isspace() for p in parts):
                page.blocks.append((here, parts, size - 2.0 * linked))
            parts = []
        linked = 0

    at = 0
    for m in _TOKEN.finditer(source):
        if m.start() > at:
            chunk = source[at:m.start()]
            parts.append(chunk)
            if links:
                linked += len(chunk)
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        end = m["end"] or m["end2"]
        if tag == "a":
            links = max(0, links + (-1 if end else 1))
            continue
        if tag not in _BLOCK:
            continue
        flush()
        if tag not in _HELD:
            if tag == "p":
                links = 0
            continue
        if end:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    here = stack[-1][1]
                    break
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if attrs.rstrip().endswith("/") and tag not in ("body", "html"):
            continue
        side, name = False, tag
        if attrs.strip():
            side = tag not in ("html", "body", "article", "main") and any(is_side(_attribute(x)) for x in _NAMED.finditer(attrs))
            found = _CLASS.search(attrs)
            if found and tag not in ("html", "body"):
                name = ".".join([tag, *_DIGITS.sub("#", _attribute(found)).lower().split()])
        in_article = any(t in ("article", "main") for t, _ in stack)
        page.tags.append(tag)
        page.paths.append(f"{page.paths[here]}/{name}")
        page.parents.append(here)
        page.dropped.append(page.dropped[here] or tag in _DROPPED or (tag == "header" and not in_article))
        page.aside.append(page.aside[here] or side)
        here = len(page.paths) - 1
        stack.append((tag, here))
    if at < len(source):
        parts.append(source[at:])
    flush()
    return page.settle()


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths = [], []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if host and (source := source.as_py()):
                page = parse(source)
                at = page.main()
                if at > 0:
                    hosts.append(host)
                    paths.append(page.paths[at])
        yield pa.record_batch([pa.array(hosts, pa.string()), pa.array(paths, pa.string())], names=["host", "path"])


def extract(source: str | None, winners: list[str] | None) -> str:
    """Main text of one page, given its host's winning paths, best first."""
    if not source:
        return ""
    page = parse(source)
    own = page.main()
    if own < 0:
        return page.text({0})
    places: dict[str, list[int]] = {}
    for i, path in enumerate(page.paths):
        if not page.dropped[i]:
            places.setdefault(path, []).append(i)
    most, chosen = 0, set()
    for path in winners or ():
        on = set(places.get(path, ()))
        if on:
            inside = page.inside(on)
            size = sum(len(p) for at, parts, _ in page.blocks if inside[at] for p in parts)
            if size > most:
                most, chosen = size, on
    if not chosen:
        return page.text({own})
    under = page.inside({own})
    if all(under[i] for i in chosen):
        return page.text({own})
    if page.tags[own] in ("article", "main") and not any(under[i] for i in chosen) and not page.inside(chosen)[own]:
        return page.text({own})
    return page.text(chosen)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(s.as_py(), w.as_py()) for s, w in zip(batch.column(2), batch.column(3), strict=True)]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                               pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def _host(url_col: str) -> Column:
    return F.lower(F.try_parse_url(F.col(url_col), F.lit("HOST")))


def winning_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, winners): paths with enough votes, the most voted first.

    Votes are counted with partial aggregation, so a host with most of the pages
    is a few rows per task; a host has at most 1 / MIN_SHARE winners.
    """
    votes = (pages.select(F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"))
             .select(_host("url").alias("host"), "html")
             .mapInArrow(trimmed(_vote), "host string, path string").groupBy("host", "path").agg(F.count("*").alias("n")))
    votes = stored(votes)
    total = votes.groupBy("host").agg(F.sum("n").alias("total"))
    return (votes.join(total, "host").where((F.col("n") >= MIN_VOTES) & (F.col("n") >= MIN_SHARE * F.col("total")))
            .groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "path"))).alias("w"))
            .select("host", F.col("w.path").alias("winners")))


#: a table of winners of up to this many characters is broadcast, a larger one is joined
BROADCAST_CHARS = 16 << 20


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    A null or empty page has the empty text; a null or odd url takes part in no
    vote and is extracted alone; ids may be null or repeat; other columns aren't
    read; an empty table gives no rows.  Malformed markup never fails: unknown
    or unclosed elements are closed by what encloses them.  Equal containers: the first one;
    equally voted paths: alphabetical order.

    The winners, whose size is counted, meet the pages by a broadcast, so pages aren't shuffled; beyond
    ``BROADCAST_CHARS`` frequent hosts still do, and only pages of the others are shuffled by host.
    """
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html"))
    winners = stored(winning_paths(rows))
    rows = rows.withColumn("host", _host("url"))
    size = winners.agg(F.sum(F.expr("length(host) + aggregate(winners, 0, (n, w) -> n + length(w))"))).first()[0] or 0
    if size <= BROADCAST_CHARS:
        met = rows.join(F.broadcast(winners), "host", "left")
    else:
        met = (spread_join(rows.where("host is not null"), winners, ["host"], "left")
               .unionByName(rows.where("host is null").withColumn("winners", F.lit(None).cast("array<string>"))))
    return (met.select("page_id", "url", "html", "winners")
            .mapInArrow(trimmed(_extract), "page_id long, url string, text string, n_chars long"))
