"""Main text of web pages by tree scoring.

Paragraphs give points for length and commas to their parent, half to the next ancestor
and a third to the one above; a container's points shrink with its share of link text.
The best container is kept with the siblings that hold article text, without the parts
that are menus, adverts, forms, comments and the like.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from drover.llm.base import extended, schema_of, text_column

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes xmp template svg math object select".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
# An open element of the key's set ends when the key begins, up to a border.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements that are never part of an article, and those that are not when they stand outside of one.
NEVER = frozenset("nav footer aside form fieldset button dialog menu head".split())
OUTSIDE = frozenset(["header"])
#: Words in class, id or role that mark such a part.
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adslot|adbox|adsense|adsbygoogle|adverts?|advertisements?|advertising|sponsor(?:ed)?|promo(?:tion)?s?|banners?|"
    r"sidebars?|comment\w*|disqus\w*|replies|respond|cookie\w*|consent|gdpr|notices?|newsletter|subscribe|subscription|signup|popup|modal|"
    r"overlay|menu\w*|nav|navbar|navigation|topnav|breadcrumbs?|masthead|footer|footnav|related|recommended|share|sharing|social|toolbar|"
    r"pagination|pager|widgets?|skip|login|paywall|outbrain|taboola|complementary|contentinfo|search|alert|hidden)(?:$|[\s_-])", re.I,
)
#: A marked element that also bears one of these words and holds most of the page's text is its main
#: part after all ("content with-sidebar"), unless the mark is that of reader comments.
SAFE = re.compile(r"(?:^|[\s_-])(?:article|main|content|post|story|entry|body|text)(?:$|[\s_-])", re.I)
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comment\w*|disqus\w*|replies|respond)(?:$|[\s_-])", re.I)
PARAGRAPH = frozenset("p pre td blockquote dd li div section article h2 h3 h4".split())
SEMANTIC = frozenset(("article", "main"))

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+(?:>|\Z)|[^>]*(?:>|\Z))", re.S,
)
ATTR = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Open:
    """Open elements, outermost first, with the depths at which each name and any block stands, so
    that no end tag has to walk through them."""

    def __init__(self):
        self.elements, self.names = [0], ["#root"]
        self.depths: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.semantic = 0

    def last(self, name: str) -> int:
        """Depth of the innermost open element of a name, or 0."""
        found = self.depths.get(name)
        return found[-1] if found else 0

    def first_below(self, name: str, depth: int) -> int | None:
        """The least depth beyond ``depth`` at which the name stands."""
        found = self.depths.get(name, ())
        k = bisect_right(found, depth)
        return found[k] if k < len(found) else None

    @property
    def last_block(self) -> int:
        return self.blocks[-1] if self.blocks else 0

    def push(self, element: int, name: str) -> None:
        self.depths.setdefault(name, []).append(len(self.elements))
        if name in BLOCK:
            self.blocks.append(len(self.elements))
        self.semantic += name in SEMANTIC
        self.elements.append(element)
        self.names.append(name)

    def cut(self, depth: int) -> None:
        """Close the element at ``depth`` and all inside it."""
        while len(self.elements) > depth:
            self.elements.pop()
            name = self.names.pop()
            self.depths[name].pop()
            if name in BLOCK:
                self.blocks.pop()
            self.semantic -= name in SEMANTIC


class Page:
    """A page as parallel lists over elements, in page order, and its pieces of text."""

    def __init__(self, html: str):
        self.tag, self.parent, self.out = ["#root"], [0], [False]
        self.pieces: list[tuple[int, int, str]] = []  # (element, block, text)
        self.doubtful: set[int] = set()
        self.block = 0
        open_ = _Open()
        at = 0
        while True:
            m = TAG.search(html, at)
            text = html[at : m.start()] if m else html[at:]
            if text:
                self.pieces.append((open_.elements[-1], self.block, unescape(text)))
            if not m:
                break
            at = m.end()
            if not m["name"]:
                continue
            if m.end() == len(html) and html[-1] != ">":
                break  # the page ends inside a tag
            name = m["name"].lower()
            if m["close"]:
                self._end(open_, name)
                continue
            self._begin(open_, name, m["attrs"])
            if name in RAW:
                # What these hold is no text of the page.
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
            elif name == "br":
                self.pieces.append((open_.elements[-1], self.block, " "))

    def _begin(self, open_: _Open, name: str, attrs: str) -> None:
        if name in CLOSES_P and (p := open_.last("p")) and p >= open_.last_block:
            open_.cut(p)
        if name in ENDS:
            ended, border = ENDS[name]
            outer = max((open_.last(x) for x in border), default=0)
            inner = [d for x in ended if x not in border and (d := open_.first_below(x, outer))]
            if inner:
                open_.cut(min(inner))
        if name in BLOCK:
            self.block += 1
        if name in VOID or name in RAW:
            return
        self.tag.append(name)
        self.parent.append(open_.elements[-1])
        self.out.append(self._boilerplate(name, attrs, open_))
        if not attrs.rstrip(">").endswith("/") or name in BLOCK:
            open_.push(len(self.tag) - 1, name)

    def _boilerplate(self, name: str, attrs: str, open_: _Open) -> bool:
        if name in NEVER:
            return True
        if name in OUTSIDE:
            return not open_.semantic
        if name in ("html", "body", "article", "main") or "=" not in attrs and "hidden" not in attrs.lower():
            return False
        marks = []
        for m in ATTR.finditer(attrs):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and INVISIBLE.search(value):
                return True
            if key in ("class", "id", "role"):
                marks.append(value)
        if any(MARKED.search(v) for v in marks):
            if any(SAFE.search(v) for v in marks) and not any(COMMENTS.search(v) for v in marks):
                self.doubtful.add(len(self.tag) - 1)
            return True
        return False

    def _end(self, open_: _Open, name: str) -> None:
        if name in BLOCK:
            self.block += 1
        depth = open_.last(name)
        # An inline end tag does not close a block.
        if depth and (name in BLOCK or depth > open_.last_block):
            open_.cut(depth)

    def _settle(self) -> None:
        """Take back the marks of doubtful elements that hold more than half of the text."""
        n = len(self.tag)
        size = [0] * n
        sure = [False] * n
        for i in range(1, n):
            sure[i] = self.out[i] and i not in self.doubtful or sure[self.parent[i]]
        for i, _, piece in self.pieces:
            size[i] += 0 if sure[i] else sum(map(len, piece.split()))
        for i in range(n - 1, 0, -1):
            size[self.parent[i]] += size[i]
        for i in self.doubtful:
            self.out[i] = 2 * size[i] <= size[0]

    def text(self) -> str:
        n = len(self.tag)
        if self.doubtful:
            self._settle()
        gone = [False] * n
        for i in range(1, n):
            gone[i] = self.out[i] or gone[self.parent[i]]
        links = [False] * n
        for i in range(1, n):
            links[i] = self.tag[i] == "a" or links[self.parent[i]]
        # Paragraph text goes to the nearest block around it; totals go to all ancestors.
        size, linked, own, commas, anchors = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
        for i, _, piece in self.pieces:
            if gone[i]:
                continue
            length = sum(map(len, piece.split())) + piece.count(" ")
            size[i] += length
            linked[i] += length * links[i]
            b = i
            while b and self.tag[b] not in PARAGRAPH:
                b = self.parent[b]
            own[b] += length
            commas[b] += sum(map(piece.count, ",،、，"))
        for i in range(n - 1, 0, -1):
            size[self.parent[i]] += size[i]
            linked[self.parent[i]] += linked[i]
            anchors[self.parent[i]] += anchors[i] + (self.tag[i] == "a")
        density = [linked[i] / size[i] if size[i] else 0.0 for i in range(n)]
        # Lists and groups that are mostly links are menus, wherever they stand.
        for i in range(1, n):
            menu = self.tag[i] in ("ul", "ol", "div", "section", "table", "dl") and anchors[i] > 1 and density[i] > 0.6
            gone[i] = gone[i] or menu or gone[self.parent[i]]
        points = [0.0] * n
        for i in range(1, n):
            if gone[i] or own[i] < 25 or density[i] > 0.6:
                continue
            worth, up = 1 + commas[i] + min(own[i] / 100, 3), self.parent[i]
            if self.tag[i] not in ("p", "pre", "td", "blockquote", "li", "h2", "h3", "h4", "dd"):
                points[i] += worth  # text that stands in a container itself
            for share in (1, 1 / 2, 1 / 3):
                points[up] += worth * share
                if not up:
                    break
                up = self.parent[up]
        score = [points[i] * (1 - density[i]) for i in range(n)]
        best = max((i for i in range(n) if not gone[i]), key=lambda i: (score[i], -i), default=0)
        kept = self._kept(best, score, size, density, gone) if score[best] > 0 else self._fallback(size, gone)
        inside = [False] * n
        for i in range(n):
            inside[i] = i in kept or (i > 0 and inside[self.parent[i]])
        blocks: dict[int, list[str]] = {}
        for i, block, piece in self.pieces:
            if inside[i] and not gone[i]:
                blocks.setdefault(block, []).append(piece)
        joined = (" ".join("".join(b).split()) for b in blocks.values())
        return "\n".join(b for b in joined if b)

    def _kept(self, best: int, score, size, density, gone) -> set[int]:
        up = best
        while up:
            if self.tag[up] in SEMANTIC:
                return {up}
            up = self.parent[up]
        kept = {best}
        for i in range(1, len(self.tag)):
            if best and self.parent[i] == self.parent[best] and i != best and not gone[i]:
                text = self.tag[i] in ("p", "pre", "blockquote") and (density[i] < 0.25 and size[i] >= 80 or not density[i] and size[i] > 0)
                title = self.tag[i] in ("h1", "h2", "h3") and density[i] < 0.5
                if text or title or score[i] >= max(10, 0.2 * score[best]):
                    kept.add(i)
        return kept

    def _fallback(self, size, gone) -> set[int]:
        """No paragraph scores: the semantic container with most text, else the whole page."""
        found = [i for i in range(1, len(self.tag)) if self.tag[i] in SEMANTIC and not gone[i] and size[i]]
        return {max(found, key=lambda i: (size[i], -i))} if found else {0}


def main_text(html: str | None) -> str:
    return Page(html).text() if html else ""


def extract(df: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """``keep`` columns with ``text``, the main text, and ``n_chars``, its code points.

    A null or empty page, and one without text, gives an empty text. Pages are parsed one
    by one without a shuffle; time and memory grow with the page. Rows that repeat give
    equal results."""
    read, thin = text_column(df, keep, html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py()) for v in batch.column(read)]
            yield extended(batch, keep, text=pa.array(texts, pa.string()), n_chars=pa.array([len(t) for t in texts], pa.int64()))

    return thin.mapInArrow(run, schema_of(thin, keep, "text string, n_chars long"))
