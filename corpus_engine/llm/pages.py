"""Main text of web pages by consensus paths of their hosts.

Each page's containers are scored by how much of its running text they hold and how little of what
surrounds it. Pages vote for the generalised tag-class paths of their best containers; Spark adds
the votes up per host. Every page is then read again with the paths that won on its host.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.llm.base import slices
from corpus_engine.session import settled

PATHS_PER_HOST = 8
NEAR_BEST = 0.8  # containers with this share of a page's best score get its vote
LEAST_SHARE = 0.95  # of the unlinked text of the page's own best container, for a host path to be used
LINE = 80  # a host path must not leave out a block of the best container as long as this

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
DIGITS = re.compile(r"[0-9]+")

BLOCKS = frozenset(
    "html head body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr blockquote "
    "pre figure figcaption address nav header footer aside form fieldset details summary dialog center hr menu".split()
)
# Elements within a line whose content is not text of the page; what math and object hold is.
INSERTS = frozenset("svg button select iframe noscript template annotation annotation-xml".split())
NESTED = frozenset(["svg", "template"])  # may hold their own kind
INSERT = re.compile(r"<(?:svg|button|select|iframe|noscript|template|annotation)\b", re.IGNORECASE)
SPACED = frozenset(["br", "td", "th", "wbr"])
CLOSES = {  # an opening tag ends open elements of these kinds
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "p"),
}
SCOPE = frozenset(["ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "html", "blockquote"])
AROUND_TAGS = frozenset("head nav footer aside form dialog menu fieldset".split())
AROUND_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
AROUND_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer masthead banner cookie cookies consent gdpr "
    "notice notices alert ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo "
    "promotion popup modal overlay newsletter subscribe subscription signup signin login register share sharing social "
    "comment comments commentlist respond reply replies disqus discussion related recommended recommendations widget "
    "widgets toolbar pagination pager form search legal copyright disclaimer hidden".split()
)
MAIN_WORDS = frozenset("article content main post body entry story text".split())
SHAPE_WORDS = frozenset(  # say where or how large a part is, not what it holds
    "area bar block bottom box button buttons col column container group header inner item items left link links "
    "list outer page panel primary right row secondary section site slot top wrap wrapper".split()
)
MARKED_SHARE = 1 / 3  # of a container's text: so much marked main text outside lets its word stand


def _attributes(written: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(written)}


def _step(tag: str, found: dict[str, str]) -> str:
    """Tag and classes (or id), digits as 0, so that pages of one template share their paths."""
    names = sorted(found.get("class", "").split())[:3] or ([f"#{found['id']}"] if found.get("id") else [])
    return ".".join([tag, *(DIGITS.sub("0", n) for n in names)])


def _inserts(html: str) -> dict[int, int]:
    """Start and end of the inserts that have an end tag within the element that holds them."""
    found: dict[int, int] = {}
    if not INSERT.search(html):
        return found
    opened: list[tuple[str, int, dict[str, int]]] = []  # kind, start, open blocks inside
    for m in TAG.finditer(html):
        tag = m[3] and m[3].lower()
        if tag in INSERTS:
            last = next((k for k in range(len(opened) - 1, -1, -1) if opened[k][0] == tag), None)
            if m[2] and last is not None:
                found[opened[last][1]] = m.end()
            if last is not None and (m[2] or tag not in NESTED):
                del opened[last:]
            if not m[2] and not _complete(tag, m[4]):
                opened.append((tag, m.start(), {}))
        elif opened and tag in BLOCKS:
            if not m[2]:
                inside = opened[-1][2]
                inside[tag] = inside.get(tag, 0) + 1
                continue
            while opened:
                inside = opened[-1][2]
                if inside.get(tag):
                    inside[tag] -= 1
                    break
                opened.pop()
    return found


def _complete(tag: str, written: str) -> bool:
    return tag == "svg" and written.endswith("/")


def _names(found: dict[str, str]) -> list[set[str]]:
    """The words of each whole class or id."""
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    return [{w.lower() for w in WORD.findall(n)} for n in names]


def _around(tag: str, found: dict[str, str], within: bool) -> bool:
    """Whether an element holds what stands around a text and not the text, whatever its classes are."""
    if tag in AROUND_TAGS or found.get("role", "").lower() in AROUND_ROLES or "hidden" in found:
        return True
    if found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        return True
    return tag == "header" and not (within or any(words & MAIN_WORDS for words in _names(found)))


def _main(tag: str, found: dict[str, str]) -> bool:
    """Whether an element is marked as the text: by its tag, or a class of such words alone."""
    if tag in ("article", "main"):
        return True
    return tag not in ("html", "body") and any(w & MAIN_WORDS and w <= MAIN_WORDS | SHAPE_WORDS for w in _names(found))


def _named_around(tag: str, found: dict[str, str], within: bool) -> bool:
    """Whether a class names what stands around a text. All words of the class must fit, as in
    ``cookie-notice`` or ``sidebar-left``; ``has-sidebar`` or ``comments-open`` tell of other elements."""
    if tag in ("html", "body") or _main(tag, found):
        return False
    for words in _names(found):
        if words & AROUND_WORDS and words <= AROUND_WORDS | SHAPE_WORDS | MAIN_WORDS:
            return True
        if "header" in words and words <= SHAPE_WORDS and not within:
            return True
    return False


class Page:
    """Containers of a page (``parent, path, around``) and its text blocks (``container, text``)."""

    def __init__(self, html: str | None):
        self.parent, self.path, self.around, self.tag = [-1], [""], [False], [""]
        self.main = [False]  # inside an article or main element
        self.named, self.marked = [False], [False]  # a class names surroundings; inside what is marked as the text
        self.blocks: list[tuple[int, str]] = []
        self.linked: list[bool] = []  # of each block
        self.good, self.bad = [0], [0]
        if html:
            self._read(html)
        self._weigh()
        for (at, text), linked in zip(self.blocks, self.linked, strict=True):
            if self.around[at] or linked:
                self.bad[at] += len(text)
            else:
                self.good[at] += len(text)
        for at in range(len(self.parent) - 1, 0, -1):
            self.good[self.parent[at]] += self.good[at]
            self.bad[self.parent[at]] += self.bad[at]

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int]] = [("", 0)]
        parts: list[str] = []
        linked, link, at = 0, False, 0
        inserts = _inserts(html)
        until, open_ended = 0, False  # end of an insert; inside one without an end tag
        for m in TAG.finditer(html):
            if m.start() < until:
                at = until
                continue
            if m.start() > at and not open_ended:
                parts.append(html[at : m.start()])
                linked += (m.start() - at) * link
            at = m.end()
            tag = m[3]
            if tag is None:
                continue
            tag = tag.lower()
            if tag in INSERTS:
                if m.start() in inserts:
                    until = at = inserts[m.start()]
                elif not m[2] and not m[4].endswith("/"):
                    open_ended = True
                continue
            if tag == "a":
                link = not m[2]
                continue
            if tag not in BLOCKS:
                if tag in SPACED:
                    parts.append(" ")
                continue
            if parts:
                self._flush(parts, linked, stack[-1][1])
                parts = []
            linked, link, open_ended = 0, False, False
            if m[2]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
            elif tag != "hr":
                closed = CLOSES.get(tag, ("p",))
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in closed:
                        del stack[k:]
                        break
                    if stack[k][0] in SCOPE:
                        break
                self._open(tag, m[4], stack)
        if at < len(html) and not open_ended:
            parts.append(html[at:])
        if parts:
            self._flush(parts, linked, stack[-1][1])

    def _open(self, tag: str, written: str, stack: list[tuple[str, int]]) -> None:
        above = stack[-1][1]
        found = _attributes(written) if written and not written.isspace() else {}
        self.parent.append(above)
        self.path.append(f"{self.path[above]}/{_step(tag, found)}")
        self.around.append(self.around[above] or _around(tag, found, self.main[above]))
        self.named.append(bool(found) and _named_around(tag, found, self.main[above]))
        self.marked.append(self.marked[above] or _main(tag, found))
        self.main.append(self.main[above] or tag in ("article", "main"))
        self.tag.append(tag)
        self.good.append(0)
        self.bad.append(0)
        stack.append((tag, len(self.parent) - 1))

    def _flush(self, parts: list[str], linked: int, at: int) -> None:
        raw = "".join(parts)
        text = " ".join((unescape(raw) if "&" in raw else raw).split())
        if not text:
            return
        self.blocks.append((at, text))
        self.linked.append(2 * linked > len(raw))

    def _weigh(self) -> None:
        """Take containers named as surroundings for such, but not for that name alone one with most
        of the page's unlinked text: there must be a fair amount of text marked as main outside it."""
        if not any(self.named):
            return
        size = len(self.parent)
        free = [0] * size
        for (at, text), linked in zip(self.blocks, self.linked, strict=True):
            if not (self.around[at] or linked):
                free[at] += len(text)
        own = list(free)
        for at in range(size - 1, 0, -1):
            free[self.parent[at]] += free[at]
        large = [self.named[at] and 2 * free[at] > free[0] for at in range(size)]
        small = [False] * size  # inside a named container without most of the text
        marked = [0] * size
        for at in range(1, size):
            small[at] = small[self.parent[at]] or (self.named[at] and not large[at])
            marked[at] = own[at] if self.marked[at] and not small[at] else 0
        for at in range(size - 1, 0, -1):
            marked[self.parent[at]] += marked[at]
        for at in range(1, size):
            stands = self.named[at] and not (large[at] and marked[0] - marked[at] < MARKED_SHARE * free[at])
            self.around[at] = self.around[at] or self.around[self.parent[at]] or stands

    def scores(self) -> dict[str, float]:
        """Score of each container path that is not around the text and holds some of it."""
        out: dict[str, float] = {}
        for at in range(1, len(self.parent)):
            good = self.good[at]
            if good and not self.around[at]:
                own = good / self.good[0] * good / (good + self.bad[at])
                out[self.path[at]] = out.get(self.path[at], 0.0) + own * (1.1 if self.tag[at] in ("article", "main") else 1.0)
        return out

    def text(self, paths: list[str]) -> str:
        """Blocks of the first path that keeps nearly all unlinked text of the page's best container
        and leaves out short lines at most; of the best container if there is none."""
        own = self.scores()
        if not own:
            chosen = ""
        else:
            best = max(own, key=lambda p: (own[p], len(p), p))
            running = [(at, len(t)) for (at, t), linked in zip(self.blocks, self.linked, strict=True) if not linked]
            within = self._inside(best)
            running = [(at, size) for at, size in running if within[at]]
            known = set(self.path)
            chosen = next((p for p in paths if p in known and self._keeps(p, running)), best)
        inside = self._inside(chosen)
        return "\n\n".join(t for at, t in self.blocks if inside[at])

    def _inside(self, path: str) -> list[bool]:
        """Which containers are in one of this path and not around the text."""
        inside = [path == ""] * len(self.parent)
        for at in range(1, len(self.parent)):
            inside[at] = inside[self.parent[at]] or self.path[at] == path
        return [i and not a for i, a in zip(inside, self.around, strict=True)]

    def _keeps(self, path: str, running: list[tuple[int, int]]) -> bool:
        inside = self._inside(path)
        out = [size for at, size in running if not inside[at]]
        return max(out, default=0) < LINE and sum(out) <= (1 - LEAST_SHARE) * sum(size for _, size in running)


def _host(url) -> F.Column:
    host = F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(host, F.lit(""))


def votes(pages: DataFrame) -> DataFrame:
    """``host, path, vote``: each page's scores of its best containers, added up per host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 4_000_000):
            total: dict[tuple[str, str], float] = {}
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                scores = Page(html).scores()
                best = max(scores.values(), default=0.0)
                for path, score in scores.items():
                    if score >= NEAR_BEST * best:
                        total[host, path] = total.get((host, path), 0.0) + round(score, 6)
            keys = list(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array(list(total.values()), pa.float64())],
                ["host", "path", "vote"],
            )

    scored = pages.select(_host("url").alias("host"), F.col("html").cast("string").alias("html"))
    cast = scored.mapInArrow(run, "host string, path string, vote double")
    return cast.groupBy("host", "path").agg(F.sum(F.col("vote").cast("decimal(28,6)")).alias("vote"))


def winners(pages: DataFrame) -> DataFrame:
    """``host, paths``: the paths with most votes on each host, best first; ties to the longer path."""
    order = Window.partitionBy("host").orderBy(F.desc("vote"), F.desc(F.length("path")), "path")
    ranked = votes(pages).withColumn("at", F.row_number().over(order)).where(F.col("at") <= PATHS_PER_HOST)
    paths = F.transform(F.array_sort(F.collect_list(F.struct("at", "path"))), lambda s: s["path"])
    return settled(ranked.groupBy("host").agg(paths.alias("paths")), "page-paths")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of every row of ``pages`` (``page_id, url, html``).

    Character references are decoded, white space inside a block is one space, blocks are joined in
    page order by an empty line. A null or empty html, or one without running text, gives an empty
    text. Pages without a host vote together. Repeated rows stay apart; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 4_000_000):
            rows = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            texts = [Page(html).text(paths or []) for html, paths in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    won = winners(pages)
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"), _host("url").alias("host")
    )
    return rows.join(won, "host", "left").select("page_id", "url", "html", "paths").mapInArrow(
        run, "page_id long, url string, text string"
    )
