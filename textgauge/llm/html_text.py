"""Main text of web pages by tag-path ratios.

Method: a page is cut into blocks of text, each with its root-to-leaf path of
block tags (with classes). Per path, text length and punctuation are added up
over its blocks: their means are the path's ratios. The series of text ratios
in page order is smoothed, and the three are fused into one value per path.

The values choose the content's root, and all blocks in it stay but those of
paths that hold links only: of the elements that the page marks as articles
(``article``, ``main``), those with a share of the largest sum of values;
without one, the innermost container of all paths at a share or more of the
best.

Elements whose tag, class, id or role says that they are no article (menus,
headers, footers, sidebars, notices, adverts, forms, comments) are left out,
unless the page says otherwise: such a word counts for nothing on an element
that contains a marked article, and a class, an id or a form counts for nothing
where the values put more than half of the article, or of a page without one,
inside. Reader comments are left out whatever their length. Hidden elements are
left out.

Every page is parsed whole, in one pass, in Arrow batches; nothing is shuffled.

Defined results: null or empty html, or no content, gives an empty text. Text
outside of any tag is content. Unclosed and misnested tags are repaired as
browsers do for paragraphs, list items and table cells. Repeated rows give
repeated rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.llm.common import bounded_batches

#: Share of the best path's value from which a path has a say in where the content's root is.
SHARE = 0.2
#: Share of the best article's sum of values from which another marked article is content too.
ARTICLE_SHARE = 0.5

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img input math mi mn mo ms mtext mrow msup msub mfrac msqrt semantics annotation".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg object select button canvas audio video".split())
BOILERPLATE = frozenset("head nav footer aside menu dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLES = frozenset("article main".split())
#: Parts of a content, never its root.
PARTS = HEADINGS | frozenset("p ul ol li dl dt dd table caption colgroup thead tbody tfoot tr td th pre blockquote figure figcaption section details summary address center hgroup".split())
#: Words of a class, id or role that mark an element as no part of the article.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted "
    "nav navbar navigation menu breadcrumb breadcrumbs toc pager pagination skip toolbar "
    "header masthead topbar footer copyright legal colophon "
    "sidebar side aside complementary rail widget widgets related recommended recommendations trending "
    "notice notices alert cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login paywall "
    "comment comments disqus reply replies respond responses discussion "
    "share sharing social follow form search contentinfo".split()
)
#: Reader comments, which values do not bring back.
COMMENTS = frozenset("comment comments disqus reply replies respond responses discussion".split())
#: A class that begins so speaks of something else on the page.
ABOUT = frozenset("has no not with without is".split())
#: What speaks against an element: a word or form, comments, its tag.
WORD, COMMENT, TAG = 1, 2, 3
#: An open element of the key is closed by a start tag of the values.
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "thead", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "thead", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
    "head": frozenset(["body"]),
}
CLOSES = {tag: [name for name, by in CLOSED_BY.items() if tag in by] for tag in frozenset().union(*CLOSED_BY.values())}
#: A search for an element to close goes no further than these.
SCOPE = frozenset("table ul ol dl td th article main section div".split())

_NAME = re.compile(r"/?([A-Za-z][^\s/>]*)")
_OPENS = re.compile(r"""=\s*(["'])""")
#: An attribute's value may hold ">" if it is no longer than this.
_LONG_VALUE = 4096
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_CLASS = re.compile(r"""\bclass\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_END = {tag: re.compile(rf"</{tag}\b[^>]*>?", re.I) for tag in RAW}
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")


class Block:
    __slots__ = ("text", "path", "heading", "linked", "article", "doubt")

    def __init__(self, text: str, path: int, heading: bool, linked: int, article: int | None, doubt: int | None):
        self.text, self.path, self.heading, self.linked, self.article, self.doubt = text, path, heading, linked, article, doubt


class Doubt:
    """An element that may be no part of the article, and what it contains."""

    __slots__ = ("kind", "above", "article", "articles", "mains")

    def __init__(self, kind: int, above: int | None, article: int | None):
        self.kind, self.above, self.article, self.articles, self.mains = kind, above, article, 0, 0


def attributes_of(raw: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTRIBUTE.finditer(raw)}


def hint(attributes: dict[str, str]) -> int:
    """What class, id or role say against an element: 0 for nothing."""
    names = [*attributes.get("class", "").split(), attributes.get("id", ""), attributes.get("role", "")]
    found = 0
    for name in names:
        parts = _PARTS.findall(_CAMEL.sub("-", name).lower())
        if parts and parts[0] not in ABOUT:
            if not COMMENTS.isdisjoint(parts):
                return COMMENT
            if not HINTS.isdisjoint(parts):
                found = WORD
    return found


def hidden(attributes: dict[str, str]) -> bool:
    return "hidden" in attributes or bool(_NOT_SHOWN.search(attributes.get("style", "")))


class _Walk:
    """Blocks of a page in page order; each step costs the same however deep the page."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.open: list[tuple[str, int, bool, int | None, int | None]] = []  # tag, path, hidden, article, doubt
        self.doubts: list[Doubt] = []
        self.count: Counter[str] = Counter()
        self.paths: dict[tuple[int, str], int] = {}
        self.parts: list[str] = []
        self.linked, self.link_depth, self.articles = 0, None, 0

    def text(self, raw: str) -> None:
        if self.open and self.open[-1][2]:
            return
        plain = unescape(raw) if "&" in raw else raw
        self.parts.append(plain)
        if self.link_depth is not None:
            self.linked += len(plain)

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                tag, path, _, article, doubt = self.open[-1] if self.open else ("", 0, False, None, None)
                self.blocks.append(Block(text, path, tag in HEADINGS, self.linked, article, doubt))
            self.parts, self.linked = [], 0

    def pop(self, to: int) -> None:
        self.flush()
        for tag, *_ in self.open[to:]:
            self.count[tag] -= 1
        del self.open[to:]
        if self.link_depth is not None and self.link_depth > to:
            self.link_depth = None

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.parts.append(" ")
        if tag == "a":
            self.link_depth = len(self.open)
        named = attributes_of(attributes) if attributes and not attributes.isspace() and tag not in VOID else {}
        if tag in INLINE and (tag in VOID or not named or not (hint(named) or hidden(named))):
            return
        self.flush()
        if any(self.count[name] for name in CLOSES.get(tag, ())):
            for at in range(len(self.open) - 1, -1, -1):
                name = self.open[at][0]
                if tag in CLOSED_BY.get(name, ()):
                    self.pop(at)
                    break
                if name in SCOPE:
                    break
        if tag in VOID:
            return
        _, above, unseen, article, doubt = self.open[-1] if self.open else ("", 0, False, None, None)
        inside = article is not None
        unseen = unseen or bool(named) and hidden(named)
        kind = TAG if tag in BOILERPLATE or (tag == "header" and not inside) else WORD if tag == "form" else 0
        if not kind and named and tag not in ("html", "body") and tag not in HEADINGS and (tag not in ARTICLES or inside):
            kind = hint(named)
        if kind and not unseen:
            self.doubts.append(Doubt(kind, doubt, article))
            doubt = len(self.doubts) - 1
        if tag in ARTICLES and not unseen and not inside and (tag == "main" or not self.commenting(doubt)):
            self.articles += 1
            article = self.articles
            at = doubt
            while at is not None:
                self.doubts[at].articles += 1
                self.doubts[at].mains += tag == "main"
                at = self.doubts[at].above
        name = _CLASS.search(attributes) if attributes else None
        label = f"{tag}.{name[1].strip(chr(34) + chr(39))}" if name else tag
        self.open.append((tag, self.paths.setdefault((above, label), len(self.paths) + 1), unseen, article, doubt))
        self.count[tag] += 1

    def commenting(self, doubt: int | None) -> bool:
        while doubt is not None and self.doubts[doubt].kind != COMMENT:
            doubt = self.doubts[doubt].above
        return doubt is not None

    def end(self, tag: str) -> None:
        if tag == "a":
            self.link_depth = None
        if self.count[tag]:
            at = next(k for k in range(len(self.open) - 1, -1, -1) if self.open[k][0] == tag)
            self.pop(at)
        elif tag == "p":
            self.flush()


def _tag_end(html: str, at: int) -> int:
    """Place of the ">" that ends a tag; one in a quoted value does not. -1: none."""
    while True:
        end = html.find(">", at)
        quote = _OPENS.search(html, at, end) if end >= 0 else None
        if not quote:
            return end
        close = html.find(quote[1], quote.end(), quote.end() + _LONG_VALUE)
        if close < 0:
            return end
        at = close + 1
        if at > end and html.find(">", at) < 0:
            return end


def blocks(html: str) -> list[Block]:
    return walked(html).blocks


def walked(html: str) -> _Walk:
    walk, at, size = _Walk(), 0, len(html)
    while at < size:
        begin = html.find("<", at)
        if begin < 0:
            break
        if begin > at:
            walk.text(html[at:begin])
        at = begin
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            at = end + 3 if end >= 0 else size
        elif html.startswith("<![CDATA[", at) and (end := html.find("]]>", at)) >= 0:
            walk.text(html[at + 9 : end].replace("&", "&amp;"))
            at = end + 3
        elif name := _NAME.match(html, at + 1):
            end = _tag_end(html, name.end())
            if end < 0:
                break
            tag, attributes = name[1].lower(), html[name.end() : end]
            at = end + 1
            if name[0][0] == "/":
                walk.end(tag)
            elif tag in RAW:
                if not attributes.endswith("/"):
                    close = _END[tag].search(html, at)
                    at = close.end() if close else size
                walk.parts.append(" ")
            else:
                walk.start(tag, attributes)
        elif html[at + 1 : at + 2] in ("!", "?"):
            end = html.find(">", at)
            at = end + 1 if end >= 0 else size
        else:
            walk.text("<")
            at += 1
    if at < size:
        walk.text(html[at:])
    walk.flush()
    return walk


def path_values(found: list[Block]) -> dict[int, float]:
    """The fused ratio of each path."""
    text, points, count = Counter(), Counter(), Counter()
    for b in found:
        own = len(b.text) if b.heading else max(0, len(b.text) - b.linked)
        text[b.path] += own
        points[b.path] += len(_PUNCTUATION.findall(b.text)) if own else 0
        count[b.path] += 1
    ratio = {p: text[p] / count[p] for p in count}
    series = [ratio[b.path] for b in found]
    smooth: dict[int, float] = {}
    for k, b in enumerate(found):
        near = series[max(0, k - 1) : k + 2]
        smooth[b.path] = max(smooth.get(b.path, 0.0), (sum(near) + series[k]) / (len(near) + 1))
    return {p: (ratio[p] * smooth[p]) ** 0.5 * (1 + points[p] / count[p]) ** 0.5 for p in ratio}


def _undoubted(walk: _Walk) -> list[Block]:
    """The blocks outside of elements that are rightly taken for no part of the article."""
    if not walk.doubts:
        return walk.blocks
    value, whole = path_values(walk.blocks), Counter()
    inside = [0.0] * len(walk.doubts)
    for b in walk.blocks:
        whole[b.article] += value[b.path]
        if b.doubt is not None:
            inside[b.doubt] += value[b.path]
    page = sum(whole.values())
    for k in range(len(inside) - 1, -1, -1):  # an element comes after the one around it
        if (above := walk.doubts[k].above) is not None:
            inside[above] += inside[k]
    left_out = []
    for k, d in enumerate(walk.doubts):
        most = inside[k] > (whole[d.article] if d.article is not None else page) / 2
        right = d.mains > 0 if d.kind == COMMENT else d.articles > 0 or (d.kind == WORD and most)
        left_out.append(not right or (d.above is not None and left_out[d.above]))
    return [b for b in walk.blocks if b.doubt is None or not left_out[b.doubt]]


def _in_root(walk: _Walk, found: list[Block]) -> set[int]:
    """The paths in the innermost container of all paths with a share of the best value."""
    above = {path: key[0] for key, path in walk.paths.items()}
    tags = {path: key[1].split(".", 1)[0] for key, path in walk.paths.items()}
    value = path_values(found)
    least = SHARE * max(value.values(), default=0.0)
    root: int | None = None
    for path, v in value.items():
        if v <= 0 or v < least:
            continue
        at = path
        if tags.get(above.get(at, 0)) not in (None, "body", "html") or tags.get(at) in PARTS:
            at = above.get(at, 0)  # the block's own element holds no others
        while tags.get(at) in PARTS:
            at = above[at]
        root = at if root is None else _meeting(root, at, above)
    inside = {root}
    for path in sorted(above):  # a path's number is larger than that of the one above
        if above[path] in inside:
            inside.add(path)
    return inside


def _meeting(a: int, b: int, above: dict[int, int]) -> int:
    while a != b:
        if a > b:
            a = above[a]
        else:
            b = above[b]
    return a


def main_text(html: str | None) -> str:
    """The article's blocks, joined by an empty line."""
    if not html:
        return ""
    walk = walked(html)
    found, sizes = _undoubted(walk), Counter()
    value = path_values(found)
    for b in found:
        if b.article is not None:
            sizes[b.article] += value[b.path]
    if sizes:
        least = ARTICLE_SHARE * max(sizes.values())
        found = [b for b in found if b.article is not None and sizes[b.article] >= least]
        value, inside = path_values(found), {b.path for b in found}
    else:
        inside = _in_root(walk, found)
    kept, below = [], False
    for b in reversed(found):
        own = value[b.path] > 0 and b.path in inside
        keep = own or (b.heading and below)  # a heading goes with the text under it
        below = keep
        if keep:
            kept.append(b.text)
    return "\n\n".join(reversed(kept))


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns and ``text`` of every page."""
    bounded_batches(pages.sparkSession)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h) for h in batch.column(len(keep)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], texts], names=[*keep, "text"])

    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return pages.select(*keep, F.col(html_col).alias("_html")).mapInArrow(extracted, f"{schema}, text string")
