"""Main text of web pages by the consensus of their host.

Every page is scanned once for tags. Containers (articles, sections, divisions, cells,
the body) are scored by the text they hold outside links and outside parts that are
no article by tag, role or class. Each page votes for the generalised tag-class paths
of its containers; votes are summed per host in Spark; each host's winning path is
then joined to its pages, which are extracted again with it.

An element whose class or id only sounds like something else than the article is not
dropped but set apart: its text counts for the containers inside it alone, with a lower
score, so a page whose article lies in "content-sidebar-wrap" is still found and a real
sidebar stays out of the text around it.

One host may have several layouts. Where more text stands outside the winning path
than in it - in one container beside it, or directly in one around it - that text is
added, and where the path holds next to nothing of the container around it, that
container is the result. What the page's own best container holds beside the winner
is never exchanged for less.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import by_batch

# Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "script style noscript template iframe svg canvas object audio video head title nav footer aside form button select "
    "textarea option dialog menu datalist".split()
)
RAW = frozenset(("script", "style", "textarea", "title", "iframe", "noscript", "template"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
CONTAINERS = frozenset(("article", "main", "section", "div", "td", "body"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: A start tag of these ends an open element of the listed kinds.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr",), "tbody": ("tr", "thead"),
}
SCOPES = frozenset(("table", "ul", "ol", "dl", "article", "section", "main", "div", "body", "td", "blockquote", "aside", "form"))
CLOSE_SCOPES = {name: SCOPES - {name, *ended} for name, ended in CLOSES.items()}
ENDS_PARAGRAPH = frozenset(
    "p div article section main ul ol dl table h1 h2 h3 h4 h5 h6 blockquote pre form header footer nav aside figure hr address "
    "fieldset details".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
DROPPED_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent|gdpr|notice\w*|alert\w*|popup|modal|overlay|"
    r"sidebar\w*|side|widget\w*|comments?|commentlist|disqus\w*|respond|repl(?:y|ies)|share\w*|sharing|social\w*|related\w*|"
    r"recommend\w*|newsletter\w*|subscribe\w*|subscription|signup|login|menu\w*|nav\w*|breadcrumbs?|footer\w*|masthead|toolbar|"
    r"pagination|pager|skip-link|search\w*|outbrain|taboola)(?:$|[\s_-])"
)
#: Names that tell of a neighbour or a state ("has-sidebar", "comments-open"), not of the element.
STATES = re.compile(r"(?:^|(?<=\s))(?:(?:has|with|no|without|hide|show)[_-]\S+|\S+[_-](?:open|closed|enabled|disabled|on|off))(?=\s|$)")
TALK = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus\w*|respond|repl(?:y|ies))(?:$|[\s_-])")
GOOD_NAMES = re.compile(r"(?:article|post|entry|story|content|main|body|text)")

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
DIGITS = re.compile(r"\d+")
NEAR = 4
LITTLE = 0.25
#: What containers set apart by a name count, and those of readers' talk.
APART, TALKED = 0.25, 0.02


@dataclass
class Node:
    name: str
    step: str
    dropped: bool
    link: bool
    heads: bool
    container: int  # index into the containers, or -1
    part: int  # index into the parts: 0 is the page, others are elements set apart by name
    around: tuple[list[str], list[int]] | None = None  # the open block that an inline element set apart interrupts


@dataclass
class Container:
    path: str
    worth: float
    start: int  # first block
    end: int = -1
    chars: int = 0
    linked: int = 0
    part: int = 0
    article: bool = False


@dataclass
class Page:
    blocks: list[str] = field(default_factory=list)
    parts: list[int] = field(default_factory=list)  # the part of each block
    sizes: list[tuple[int, int]] = field(default_factory=list)  # its characters, and those in links
    owners: list[int] = field(default_factory=list)  # its innermost container
    containers: list[Container] = field(default_factory=list)

    def held(self, c: Container) -> list[int]:
        """The blocks of a container."""
        return [i for i in range(c.start, c.end) if self.parts[i] == c.part]

    def measure(self) -> None:
        """Count the characters of every container: those of the blocks between its ends that are of its part."""
        sums: dict[int, tuple[list[int], list[int], list[int]]] = {}
        for at, (part, (chars, linked)) in enumerate(zip(self.parts, self.sizes)):
            places, a, b = sums.setdefault(part, ([], [0], [0]))
            places.append(at)
            a.append(a[-1] + chars)
            b.append(b[-1] + linked)
        for c in self.containers:
            if c.part in sums:
                places, a, b = sums[c.part]
                first, last = bisect_left(places, c.start), bisect_left(places, c.end)
                c.chars, c.linked = a[last] - a[first], b[last] - b[first]


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def parse(source: str) -> Page:
    """Blocks of text and containers of a page, in page order."""
    page = Page()
    root = Container("", 0.5, 0)
    page.containers.append(root)
    stack = [Node("", "", False, False, False, 0, 0)]
    places: dict[str, list[int]] = {}  # where open elements stand in the stack, by name
    inner = [0]  # the open containers
    marks = [1.0]  # what each part counts
    words: list[str] = []  # text of the open block
    held = [0, 0]  # its characters, and those in links

    def flush() -> None:
        if words:
            block = " ".join("".join(words).split())
            words.clear()
            if block:
                page.blocks.append(block)
                page.parts.append(stack[-1].part)
                page.sizes.append((held[0], held[1]))
                page.owners.append(inner[-1])
            held[0] = held[1] = 0

    def add(text: str) -> None:
        top = stack[-1]
        if top.dropped or not text:
            return
        text = html.unescape(text) if "&" in text else text
        words.append(text)
        n = len(text.strip())
        held[0] += n
        if top.link:
            held[1] += n

    def pop() -> None:
        node = stack[-1]
        if node.name not in INLINE or node.around:
            flush()
        if node.around:
            words[:], held[:] = node.around
        stack.pop()
        places[node.name].pop()
        if node.container >= 0:
            page.containers[node.container].end = len(page.blocks)
            inner.pop()

    def close(names: tuple[str, ...], scopes: frozenset[str]) -> None:
        """End the nearest open element of these names, unless a scope is in between."""
        at = max([places[x][-1] for x in names if places.get(x)], default=0)
        if at and not any(places.get(x) and places[x][-1] > at for x in scopes):
            while len(stack) > at:
                pop()

    at, n = 0, len(source)
    while at < n:
        m = TAG.search(source, at)
        if m is None:
            add(source[at:])
            break
        if m.start() > at:
            add(source[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:  # an end tag
            if name == "br" or name == "p" and not places.get("p"):
                flush()
            else:
                close((name,), frozenset() if name not in INLINE else ENDS_PARAGRAPH)
            continue
        if name in ENDS_PARAGRAPH:
            close(("p",), SCOPES)
            if name in HEADINGS:
                close(tuple(HEADINGS), SCOPES)
        if name in CLOSES:
            close(CLOSES[name], CLOSE_SCOPES[name])
        if name not in INLINE:
            flush()
        if name in VOID:
            continue
        top = stack[-1]
        raw = m[3] if m[2] else m[6]
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else n
            continue
        attrs = attributes(raw) if raw and not raw.isspace() else {}
        names = f"{attrs.get('class', '')} {attrs.get('id', '')}".strip().lower()
        dropped = top.dropped or name in DROPPED or "hidden" in attrs or attrs.get("aria-hidden") == "true"
        if attrs and not dropped:
            dropped = attrs.get("role", "").lower() in DROPPED_ROLES or bool(HIDDEN.search(attrs.get("style", "")))
        part = top.part
        if names and not dropped and name not in ("html", "body", "main") and DROPPED_NAMES.search(told := STATES.sub("", names)):
            part = len(marks)
            marks.append(marks[top.part] * (TALKED if TALK.search(told) else APART))
        if name == "header" and not places.get("article") and not places.get("main"):
            dropped = True
        step = name
        if "class" in attrs and (first := DIGITS.sub("", (attrs["class"].split() or [""])[0].lower())):
            step = f"{name}.{first}"
        container = -1
        if not dropped and (name in CONTAINERS or attrs.get("role") == "main" or part != top.part):
            worth = 1.3 if name == "article" or attrs.get("itemprop") == "articleBody" else 1.15 if name == "main" else 1.0
            if name in ("body", "td"):
                worth = 0.8
            elif names and GOOD_NAMES.search(names):
                worth += 0.1
            path = ">".join([*[x.step for x in stack[max(1, len(stack) - NEAR) :]], step])
            if part:
                path = "~" + path  # never the path of a container that is not set apart
            container = len(page.containers)
            article = name in ("article", "main") or attrs.get("role") == "main" or attrs.get("itemprop") == "articleBody"
            page.containers.append(Container(path, worth, len(page.blocks), part=part, article=article))
            inner.append(container)
        places.setdefault(name, []).append(len(stack))
        stack.append(Node(name, step, dropped, top.link or name == "a", top.heads or name in HEADINGS, container, part))
        if part != top.part:
            stack[-1].around = (words[:], held[:])
            words.clear()
            held[:] = 0, 0
    while len(stack) > 1:
        pop()
    flush()
    root.end = len(page.blocks)
    page.measure()
    if len(marks) > 1:
        # without an article elsewhere, articles that lie in a part set apart count in full, but for readers' talk
        alone = not any(c.article and c.chars > c.linked and not c.part for c in page.containers)
        for c in page.containers:
            mark = marks[c.part]
            c.worth *= 1.0 if alone and c.article and mark >= APART else mark
    return page


def score(c: Container) -> float:
    return max(0, c.chars - c.linked) * c.worth * (1 - c.linked / c.chars) if c.chars else 0.0


def votes(page: Page) -> list[tuple[str, float]]:
    """The paths of a page's containers, with their scores as a share of the best."""
    best: dict[str, float] = {}
    for c in page.containers:
        best[c.path] = best.get(c.path, 0.0) + score(c)
    top = max(best.values(), default=0.0)
    return [(p, s / top) for p, s in best.items() if s >= 0.2 * top] if top > 0 else []


def outermost(found: list[Container]) -> list[Container]:
    out: list[Container] = []
    for c in found:
        if not out or c.start >= out[-1].end:
            out.append(c)
    return out


def outside(page: Page, chosen: list[Container]) -> tuple[float, list[int]]:
    """The greatest score of a text outside ``chosen``, and its blocks.

    A text is a container that shares no block with them, or what stands in a
    container around them and in no other container.
    """
    starts, ends = [c.start for c in chosen], [c.end for c in chosen]
    own: dict[int, list[int]] = {}
    for at, c in enumerate(page.owners):
        own.setdefault(c, []).append(at)
    best, blocks = 0.0, []
    for i, c in enumerate(page.containers):
        if bisect_right(ends, c.start) == bisect_left(starts, c.end):  # no chosen one in reach
            worth, mine = score(c), None
        elif i in own and c.chars and c not in chosen and c.start <= starts[0] and c.end >= ends[-1]:
            mine = [b for b in own[i] if page.parts[b] == c.part]
            chars, linked = (sum(page.sizes[b][k] for b in mine) for k in (0, 1))
            worth = score(Container(c.path, c.worth, 0, chars=chars, linked=linked))
        else:
            continue
        if worth > best:
            best, blocks = worth, page.held(c) if mine is None else mine
    return best, blocks


def extract(page: Page, winner: str | None) -> str:
    """Text of the containers on the host's path, and of what outweighs them outside."""
    own = max(page.containers, key=score)
    chosen = outermost([c for c in page.containers if c.path == winner and c.chars]) if winner is not None else []
    held = sum(map(score, chosen))
    if held <= 0 or not any(c is own for c in chosen) and held < LITTLE * score(own) and own.start <= chosen[0].start and own.end >= chosen[-1].end:
        chosen = [own] if own.chars else []
    blocks = {b for c in chosen for b in page.held(c)}
    if chosen and chosen != [own]:
        more, beside = outside(page, chosen)
        if more > held:
            blocks.update(beside)
    return " ".join(page.blocks[b] for b in sorted(blocks))


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with most votes of each host; ties go to the shorter, then the smaller."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hosts, paths, shares = [], [], []
        for h, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            for path, share in votes(parse(source or "")):
                hosts.append(h)
                paths.append(path)
                shares.append(int(1000 * share))  # whole numbers: sums do not depend on their order
        return pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(shares, pa.int64())], ["host", "path", "share"]
        )

    rows = by_batch(pages.select(host(F.col("url")).alias("host"), "html"), work, "host string, path string, share long")
    sums = rows.groupBy("host", "path").agg(F.sum("share").alias("votes"))
    return sums.groupBy("host").agg(F.max_by("path", F.struct("votes", -F.length("path"), "path")).alias("path"))


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every whole page.

    A null or empty page has an empty text; a page without a url votes with the
    others that have none. White space inside a block becomes one space, blocks are
    joined in page order by one space. Repeated rows vote and are returned each.
    """
    winners = cut_lineage(host_paths(pages))
    # read as a written table its size is known: beyond the limit it is shuffled, and AQE splits a hot host
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host")).join(winners, "host", "left")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [extract(parse(h or ""), p) for h, p in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )

    kind = dict(pages.dtypes)["page_id"]
    return by_batch(rows.select("page_id", "url", "html", "path"), work, f"page_id {kind}, url string, text string, n_chars long")
