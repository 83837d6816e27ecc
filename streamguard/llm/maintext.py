"""Main text of HTML pages by minimum-cut labelling (operator 8).

A page becomes a row of text blocks with what the tree says of each.  A
linear classifier (weights below, in hundredths of log odds) gives each block
a cost for either label: the capacity to the source or to the sink.
Neighbouring blocks, and consecutive blocks of one parent, are tied by edges
that weaken with their distance in the tree.  The minimum cut between source
and sink is the cheapest labelling; blocks on the source's side are the text.

Before the flow, blocks whose own cost outweighs all their edges are fixed
and folded into their neighbours; this never changes the minimum, and few
blocks of a normal page are left for augmenting paths.

Defined results: a null or empty html, and a page without content blocks,
give an empty text; repeated rows are extracted each; unclosed tags end with
their parent; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

# HTML element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup: it goes up to the end tag, or to the end of the page.
RAW = frozenset("script style textarea title".split())
#: Elements whose text the page does not show as text; they end with their parent, and one that no end tag follows is empty (a foreign one ends at the next block).
SKIPPED = frozenset("noscript template iframe object svg annotation annotation-xml select button canvas audio video".split())
#: Elements of other languages, in which a tag may close itself; a block ends them unless it stands in one of INSETS.
FOREIGN = frozenset(("svg", "math"))
INSETS = frozenset("foreignobject desc annotation-xml".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"html", "head", "body", "td", "th", "tr", "tbody", "thead", "tfoot"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
FRAME_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
#: Words of class and id attributes that mark what is not the article.
FRAME_WORDS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo related replies reply share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
TEXT_WORDS = frozenset("article articlebody content entry main post story text".split())

# The classifier, in hundredths of log odds for content.
IN_ARTICLE, IN_FRAME, TEXT_CLASS = 600, -1200, 250
LINKED, PUNCTUATED, HEADING, COPYRIGHT, BIAS = -350, 60, 60, -250, -60
LENGTHS = ((40, 60), (120, 120), (240, 120))
#: Edge weight of blocks of one parent; halves with every step in the tree between two blocks.
TIE, SIBLING = 200, 60

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPEAKING = frozenset(("class", "id", "hidden", "aria-hidden", "style", "role"))
_SELF_CLOSED = re.compile(r"""(?:^|[\s"']|(?:^|\s)[^\s"'=]+)/\Z""")
_WORDS = re.compile(r"[a-z]+")
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


class _Element:
    __slots__ = ("tag", "parent", "depth", "mark", "link", "skipped", "foreign")

    def __init__(self, tag: str, parent, attributes: str = ""):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.link = tag == "a" or bool(parent and parent.link)
        self.skipped = tag in SKIPPED or bool(parent and parent.skipped)
        self.foreign = tag in FOREIGN or bool(parent and parent.foreign and tag not in INSETS)
        self.mark = self._marked(attributes)

    def _marked(self, attributes: str) -> int:
        """What this element and those above say: IN_FRAME, IN_ARTICLE, TEXT_CLASS or 0."""
        above = self.parent.mark if self.parent else 0
        words, hidden = set(), False
        if attributes:
            for name, value in _ATTR.findall(attributes):
                name, value = name.lower(), value.strip("\"'").lower()
                if name not in _SPEAKING:
                    continue
                if name in ("class", "id", "role"):
                    words.update(_WORDS.findall(value))
                elif name == "style":
                    hidden |= "display:none" in value.replace(" ", "") or "visibility:hidden" in value.replace(" ", "")
                else:
                    hidden |= name == "hidden" or value == "true"
        if hidden or self.tag == "head" or self.tag in FRAME_TAGS:
            return 2 * IN_FRAME  # no element inside takes this back
        if above == 2 * IN_FRAME:
            return above
        if self.tag in ("article", "main"):
            return IN_FRAME if words & FRAME_WORDS - TEXT_WORDS else IN_ARTICLE
        if words & FRAME_WORDS and not (words & TEXT_WORDS and self.tag == "body"):
            return IN_FRAME
        if self.tag == "header" and above != IN_ARTICLE:
            return IN_FRAME
        return above or (TEXT_CLASS if words & TEXT_WORDS else 0)


class Block:
    """Text between two block boundaries, with its element."""

    __slots__ = ("text", "at", "linked")

    def __init__(self, text: str, at: _Element, linked: int):
        self.text, self.at, self.linked = text, at, linked


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order; scripts, styles and other skipped elements have none."""
    root = _Element("html", None)
    here, out, pieces, linked, pos = root, [], [], 0, 0

    def close() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                at = here
                while at.tag not in BLOCK and at.parent:
                    at = at.parent
                out.append(Block(text, at, linked))
            pieces.clear()
            linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not here.skipped:
            pieces.append(text)
            if here.link:
                linked += len(text)

    end = len(page)
    last: dict[str, int] = {}

    def ends_after(name: str, at: int) -> bool:
        """Whether an end tag of this name follows (the last one of each name is looked up once)."""
        if name not in last:
            last[name] = max((m.start() for m in re.finditer(rf"</{re.escape(name)}(?=[\s/>])", page, re.I)), default=-1)
        return last[name] >= at

    while pos < end:
        found = _TAG.search(page, pos)
        if not found:
            add(page[pos:])
            break
        add(page[pos:found.start()])
        pos = found.end()
        name = found.group(2)
        if name is None:
            if found.group().startswith("<![CDATA["):
                add(entities.escape(found.group()[9:].removesuffix("]]>")))
            continue
        name = name.lower()
        if found.group(1):  # an end tag closes up to its start tag, if that is open
            if name in BLOCK:
                close()
            up = here
            while up and up.tag != name:
                up = up.parent
            if up and up.parent:
                here = up.parent
            continue
        if (name in FOREIGN or here.foreign) and _SELF_CLOSED.search(found.group(3)):
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, pos)
            pos = stop.end() if stop else end
            continue
        if name in VOID:
            if name == "hr":
                close()
            elif name in ("br", "wbr"):
                pieces.append(" " if name == "br" else "")
            continue
        if name in SKIPPED - FOREIGN and not ends_after(name, pos):
            continue
        if name == "button":  # buttons do not nest
            up = here
            while up.parent and up.tag != "button" and up.tag not in BLOCK:
                up = up.parent
            here = up.parent if up.tag == "button" else here
        if name in BLOCK:
            while here.foreign:
                here = here.parent
            close()
            ends = ({"p"} if name in CLOSES_P else set()) | SAME.get(name, set())
            up = here
            while ends and up.parent and up.tag not in SKIPPED and (up.tag not in BLOCK or up.tag in ends):
                if up.tag in ends:
                    here = up.parent
                up = up.parent
        if name not in ("html",):
            here = _Element(name, here, found.group(3))
    close()
    return out


def odds(b: Block) -> int:
    """The classifier: hundredths of log odds that a block is content."""
    n = len(b.text)
    out = BIAS + b.at.mark
    out += sum(w for least, w in LENGTHS if n >= least)
    out += LINKED if 2 * b.linked > n else 0
    out += PUNCTUATED if b.text[-1] in ".!?…。:;\"»”" else 0
    out += HEADING if b.at.tag in _HEADINGS else 0
    return out + (COPYRIGHT if b.text[0] == "©" else 0)


def _steps(a: _Element, b: _Element) -> int:
    """Steps in the tree between two blocks' elements (1 for siblings)."""
    n = 0
    while a is not b:
        if a.depth >= b.depth and a.parent:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return max(1, n - 1)


def edges(found: list[Block]) -> dict[tuple[int, int], int]:
    """Smoothness: neighbours on the page, and consecutive blocks of one parent."""
    out: dict[tuple[int, int], int] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            weight = TIE >> min(12, _steps(found[i - 1].at, b.at) - 1)
            if weight:
                out[i - 1, i] = weight
        parent = id(b.at.parent)
        if parent in last:
            out[last[parent], i] = out.get((last[parent], i), 0) + SIBLING
        last[parent] = i
    return out


def cut(unary: list[int], ties: dict[tuple[int, int], int]) -> list[bool]:
    """Minimum cut: True for blocks on the content side."""
    near: list[dict[int, int]] = [{} for _ in unary]
    for (a, b), w in ties.items():
        near[a][b] = near[a].get(b, 0) + w
        near[b][a] = near[b].get(a, 0) + w
    score, label = list(unary), [None] * len(unary)
    queue = deque(range(len(unary)))
    while queue:  # a block whose own cost outweighs its edges is decided
        v = queue.popleft()
        if label[v] is not None or abs(score[v]) < sum(near[v].values()):
            continue
        label[v] = score[v] > 0
        for w, weight in near[v].items():
            score[w] += weight if label[v] else -weight
            del near[w][v]
            queue.append(w)
        near[v] = {}
    rest = [v for v, x in enumerate(label) if x is None]
    if rest:
        inside = _flow(rest, score, near)
        for v in rest:
            label[v] = v in inside
    return label


def _flow(rest: list[int], score: list[int], near: list[dict[int, int]]) -> set[int]:
    """Shortest augmenting paths; returns what the source still reaches."""
    source, sink = -1, -2
    left: dict[int, dict[int, int]] = {v: dict(near[v]) for v in rest}
    left[source] = {v: score[v] for v in rest if score[v] > 0}
    left[sink] = {}
    for v in rest:
        left[v][source] = 0
        left[v][sink] = max(0, -score[v])
        left[sink][v] = 0
    while True:
        came, queue = {source: source}, deque([source])
        while queue and sink not in came:
            v = queue.popleft()
            for w, c in left[v].items():
                if c > 0 and w not in came:
                    came[w] = v
                    queue.append(w)
        if sink not in came:
            return set(came) - {source}
        path, v = [], sink
        while v != source:
            path.append((came[v], v))
            v = came[v]
        push = min(left[a][b] for a, b in path)
        for a, b in path:
            left[a][b] -= push
            left[b][a] = left[b].get(a, 0) + push


def main_text(page: str) -> str:
    """The content blocks of one page, joined by line feeds."""
    found = blocks(page)
    keep = cut([odds(b) for b in found], edges(found))
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of (page_id, url, html)."""
    def run(table: pa.Table):
        texts = [main_text(h or "") for h in table.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([common.column(table, "page_id"), common.column(table, "url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return common.map_chunks(common.plain_ids(pages, "page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long", text="html")
