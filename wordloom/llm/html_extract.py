"""Main text of web pages by consensus host paths.

1. Each page's containers are scored by the text they hold, links and
   boilerplate apart, and the page votes for the generalised path (tags and
   classes from the root, numbers replaced) of its best one.
2. Votes are added up per host and path in Spark, one row per task first, and
   each host's winning path is the one with most votes.
3. Each page is read again: its text is that of the containers on the host's
   path, or of its own best container where those on that path hold less than
   half of its score.

Blocks inside boilerplate (menus, headers, footers, sidebars, notices, adverts,
forms, reader comments) are never part of the text. A form, or an element whose
name says so, is a layout wrapper instead if it holds the page's article or most
of its text; that is known once the page has been read.

What stands before the container, up to the article or the body, is part of the
text whatever its length, unless it mostly is links: anything inside the
article, and beside the container's ancestors or one container deeper elsewhere.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm import common as C

_TOKEN = re.compile(
    r"""<(?:!--(?:.*?-->|.*\Z)|(/?)([a-zA-Z][^\s/>]*)([^>"']*+(?:(?:"[^"]*"|'[^']*')[^>"']*+)*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[!?/][^>]*>)""",
    re.S,
)
_ATTR = re.compile(r"""([^\s=>"'/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "object", "xmp", "noembed", "noframes"}
_RAW_END = {t: re.compile(rf"</{t}\s*[^>]*>", re.I) for t in _RAW}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_SPACE = {"br", "td", "th", "wbr", "img", "option"}
_BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul head caption".split())
_CONTAINER = set("body article section main div table tbody ul ol dl figure blockquote center details aside form header footer nav".split())
_BOILER_TAG = {"nav", "header", "footer", "aside", "menu", "head", "button", "select", "dialog", "datalist"}
_BOILER_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert", "alertdialog"}
_BOILER_NAME = set(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs
    header masthead footer sidebar aside widget widgets cookie cookies consent gdpr notice notices disclaimer newsletter subscribe subscription popup modal overlay
    share sharing social related recommended recommendations comment comments disqus respond replies login signup search pagination pager toolbar""".split()
)
#: names that no wrapper has, and prefixes of classes that tell of a page's layout and do not name the element
_READERS = {"comment", "comments", "disqus", "respond", "replies"}
_FLAG = re.compile(r"(?:^|(?<=\s))(?:no|not|has|with|without)[-_]\S*", re.I)
_SHARE = 0.5  # of the best container's score that the containers on the host's path must hold
#: An opening tag closes an open element of these kinds, up to the nearest of the barrier.
_CLOSES = {"li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}), "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"table", "tr"}), "th": ({"td", "th", "p"}, {"table", "tr"}), "option": ({"option"}, {"select"})}
_DECAY = 0.95
_MAIN = 1.5


def _names(value: str) -> set[str]:
    return set(re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower()))


def _segment(tag: str, attrs: dict[str, str]) -> str:
    """Generalised name of an element: its tag and its classes, numbers replaced."""
    classes = sorted({re.sub(r"\d+", "#", c) for c in attrs.get("class", "").lower().split()})
    return ".".join([tag, *classes])


class Page:
    """Containers and text blocks of one page. ``nodes``: (parent, segment of the path, is main); ``blocks``: (text, link characters, node)."""

    def __init__(self, source: str) -> None:
        self.nodes: list[tuple[int, str, bool]] = [(-1, "", False)]
        self.blocks: list[tuple[str, int, int]] = []
        self._parts: list[tuple[str, bool, int]] = []  # text, inside a link, region
        self._raw: list[tuple[list[tuple[str, bool, int]], int]] = []  # parts, node
        #: elements that are boilerplate unless they turn out to be wrappers: (outer region, inside an article)
        self._regions: list[tuple[int, bool]] = [(-1, False)]
        self._holds: set[int] = set()  # regions that hold an article or main
        #: open elements: tag, node, region (-1 inside boilerplate for certain), inside a link
        self._open: list[tuple[str, int, int, bool]] = [("", 0, 0, False)]
        at = 0
        while m := _TOKEN.search(source, at):
            self._text(source[at : m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                self._end(tag)
                continue
            text = m[3] if m[2] else m[6]
            if tag in _RAW:
                if not text.rstrip().endswith("/"):
                    close = _RAW_END[tag].search(source, at)
                    at = close.end() if close else len(source)
                continue
            self._start(tag, text)
        self._text(source[at:])
        self._flush()
        self._settle()

    def _text(self, s: str) -> None:
        if s:
            _, _, region, link = self._open[-1]
            if region >= 0:
                self._parts.append((s, link, region))

    def _flush(self) -> None:
        if self._parts:
            self._raw.append((self._parts, self._open[-1][1]))
            self._parts = []

    def _settle(self) -> None:
        """Tell wrappers from boilerplate, outer ones first, and make the blocks of what is left."""
        inside: list[bool] = []  # an article or main
        for parent, _, main in self.nodes:
            inside.append(main or (parent >= 0 and inside[parent]))
        held, mains = [0] * len(self._regions), [0] * len(self._regions)
        if len(held) > 1:
            for parts, node in self._raw:
                for text, link, region in parts:
                    if not link:
                        n = len(text.strip())
                        held[region] += n
                        mains[region] += n * inside[node]
            for r in range(len(held) - 1, 0, -1):
                held[self._regions[r][0]] += held[r]
        live, direct = [True], mains[0]  # text of articles and main outside what may be boilerplate
        for r, (outer, in_article) in enumerate(self._regions[1:], 1):
            whole = r in self._holds and not in_article and held[r] > direct
            live.append(live[outer] and (whole or (2 * held[r] > held[0] and held[r] > 4 * direct)))
            direct += mains[r] if live[r] else 0
        for parts, node in self._raw:
            parts = [p for p in parts if live[p[2]]]
            if text := " ".join(_html.unescape("".join(p[0] for p in parts)).split()):
                self.blocks.append((text, sum(len(p[0]) for p in parts if p[1]), node))
        self._raw = []

    def _start(self, tag: str, text: str) -> None:
        if tag in _BLOCK:
            self._flush()
            self._close({"p"}, _CONTAINER | {"button", "td", "th"})
        elif tag in _SPACE:
            self._text(" ")
        if tag in _CLOSES:
            self._close(*_CLOSES[tag])
        if tag in _VOID:
            return
        _, node, region, link = self._open[-1]
        if tag in _CONTAINER or "=" in text:
            attrs = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(text)}
        else:
            attrs = {}
        if region >= 0:
            maybe = tag == "form"
            if tag in _BOILER_TAG or attrs.get("role", "").lower() in _BOILER_ROLE or attrs.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", attrs.get("style", ""))):
                region = -1
            elif tag not in ("body", "html", "article", "main") and ("class" in attrs or "id" in attrs):
                names = _names(_FLAG.sub("", attrs.get("class", "")) + " " + attrs.get("id", "")) & _BOILER_NAME
                region = region if names.isdisjoint(_READERS) else -1
                maybe = maybe or bool(names)
            if maybe and region >= 0:
                self._regions.append((region, any(x[0] == "article" for x in self._open)))
                region = len(self._regions) - 1
        if tag in _CONTAINER:
            main = tag in ("article", "main") or attrs.get("role") == "main" or "articlebody" in attrs.get("itemprop", "").lower()
            self.nodes.append((node, _segment(tag, attrs), main))
            node = len(self.nodes) - 1
            at = region if main else 0
            while at > 0 and at not in self._holds:
                self._holds.add(at)
                at = self._regions[at][0]
        self._open.append((tag, node, region, link or tag == "a"))

    def _end(self, tag: str) -> None:
        if tag in _BLOCK:
            self._flush()
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i][0] == tag:
                del self._open[i:]
                return
            if self._open[i][0] in _CONTAINER and tag not in _CONTAINER:
                return

    def _close(self, tags: set[str], barrier: set[str]) -> None:
        """Close the outermost open element of ``tags`` that is inside the nearest of ``barrier``."""
        cut = None
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i][0] in tags:
                cut = i
            elif self._open[i][0] in barrier:
                break
        if cut is not None:
            del self._open[cut:]

    def path(self, node: int) -> str:
        """Segments from the root down to a node."""
        out = []
        while node > 0:
            out.append(self.nodes[node][1])
            node = self.nodes[node][0]
        return "".join(f">{x}" for x in reversed(out))

    def on(self, path: str | None) -> set[int]:
        """The nodes whose path this is."""
        want = (path or "").split(">")[1:]
        found, depth = set(), [0]  # depth of nodes whose path the wanted one begins with, else -1
        for i, (parent, segment, _) in enumerate(self.nodes[1:], 1):
            d = depth[parent]
            depth.append(d + 1 if 0 <= d < len(want) and want[d] == segment else -1)
            if depth[i] == len(want) and want:
                found.add(i)
        return found

    def scores(self) -> list[float]:
        """Characters outside links of each container's blocks, less by ``_DECAY`` for each container between."""
        out = [0.0] * len(self.nodes)
        for text, links, node in self.blocks:
            out[node] += max(0.0, len(text) - 2.0 * links)
        for i in range(len(out) - 1, 0, -1):  # a container comes after the one around it
            out[self.nodes[i][0]] += _DECAY * out[i]
        return [s * (_MAIN if main else 1.0) for s, (_, _, main) in zip(out, self.nodes)]

    def best(self) -> int:
        """The container with the highest score (the first of equals), or -1."""
        s = self.scores()
        at = max(range(len(s)), key=s.__getitem__)
        return at if s[at] > 0 else -1

    def text(self, wanted: set[int]) -> str:
        """The blocks inside the wanted containers, and what belongs to the article before them, in page order."""
        inside: list[bool] = []
        for i, (parent, _, _) in enumerate(self.nodes):
            inside.append(i in wanted or (parent >= 0 and inside[parent]))
        keep = [inside[node] for _, _, node in self.blocks]
        if True not in keep:
            return ""
        first = keep.index(True)
        if first:
            at, around = self.blocks[first][2], set()  # the containers around the wanted one, up to the article or the body
            while at not in wanted:
                at = self.nodes[at][0]
            while not self.nodes[at][2] and self.nodes[at][0] >= 0 and not self.nodes[at][1].startswith("body"):
                at = self.nodes[at][0]
                around.add(at)
            within: list[bool] = []  # the article that the wanted one is in
            for i, (parent, _, main) in enumerate(self.nodes):
                within.append((i == at and main) or (parent >= 0 and within[parent]))
            for i, (text, links, node) in enumerate(self.blocks[:first]):
                keep[i] = (within[node] or node in around or self.nodes[node][0] in around) and 2 * links <= len(text)
        return "\n".join(t for (t, _, _), k in zip(self.blocks, keep) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, text, path (the path used) of every row.

    Null or empty html gives an empty text; a null url or one without a host is a host of its own; of paths with equal
    votes the one with more text wins, then the one that sorts first. Null and repeated ids keep a row each.
    """
    spark = pages.sparkSession
    C.ship(spark)
    scratch = C.Scratch(spark, "html")
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), F.col(html_col).alias("html"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, scores = [], [], []
            for h, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                page = Page(source or "")
                if (at := page.best()) >= 0:
                    hosts.append(h)
                    paths.append(page.path(at))
                    scores.append(page.scores()[at])
            yield pa.record_batch([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.float64())], ["host", "path", "score"])

    votes = rows.select("host", "html").mapInArrow(vote, "host string, path string, score double")
    sums = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("s"))
    # the order of a maximum over (votes, score) with the first path on a tie
    winner = F.min(F.struct((-F.col("n")).alias("n"), (-F.round("s")).alias("s"), "path"))
    winners = scratch.table(sums.groupBy("host").agg(winner["path"].alias("winner")), "winners")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, paths = [], []
            for source, path in zip(batch.column("html").to_pylist(), batch.column("winner").to_pylist()):
                page = Page(source or "")
                wanted, own = page.on(path), page.best()
                score = page.scores()
                if own >= 0 and sum(score[i] for i in wanted) < _SHARE * score[own]:
                    path, wanted = page.path(own), {own}
                text = page.text(wanted)
                texts.append(text)
                paths.append(path if text else None)
            yield pa.record_batch([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(paths, pa.string())], ["id", "url", "text", "path"])

    both = rows.join(winners, "host", "left").select("id", "url", "html", "winner")
    out = both.mapInArrow(again, f"id {rows.schema['id'].dataType.simpleString()}, url {rows.schema['url'].dataType.simpleString()}, text string, path string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "path")
