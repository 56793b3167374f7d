"""Main text of web pages by line-block distribution.

Markup is stripped to one line per block element. What a line weighs is its text outside links, and nothing if it stands in an element
that is never article text (by tag, role, or class and id words). Sums of those weights over ``WINDOW`` lines rise at a
surge point and fall to nothing at a dive point; the lines between are the text, if the sums there reach a share of the page's highest.
Where the page marks an article or a main part that holds a fair share of all text, only its lines weigh anything.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faultline.session import ship_package

WINDOW = 3
PEAK_SHARE = 0.25
MARKED_SHARE = 0.25

#: Element names of HTML, by what they mean here.
RAW = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video", "textarea", "title", "xmp", "noembed", "noframes"}
ASIDE = {"nav", "footer", "aside", "form", "select", "button", "dialog", "menu", "head", "label", "fieldset", "datalist", "map", "applet"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "nobr", "q", "rp", "rt",
    "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "form", "toolbar"}
#: Words in class and id attributes of what is never article text.
WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "adbox", "banner", "billboard", "bottombar", "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist",
    "consent", "cookie", "cookies", "copyright", "disqus", "footer", "form", "gdpr", "login", "masthead", "menu", "menus", "modal", "nav", "navbar", "navigation", "navi", "newsletter", "notice", "notices", "pager",
    "pagination", "paywall", "popup", "promo", "promoted", "promotion", "recommended", "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signin", "signup", "skip", "social", "sponsor",
    "sponsored", "subscribe", "subscription", "teaser", "toolbar", "topbar", "trending", "widget", "widgets",
}
WORDS_OF_HEADERS = {"header", "siteheader", "pageheader"}

_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^'">]++|"[^"]*"|'[^']*')*+)>""")
_TELLING = re.compile(r"class|\bid\b|role|hidden|style", re.I)
_PAIR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|"[^"]*"|'[^']*'""")
_CAMEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_CLOSES_P = re.compile(r"p|div|ul|ol|dl|table|h[1-6]|section|article|aside|header|footer|nav|main|form|pre|blockquote|hr|figure|address|fieldset|details")
#: A new element of these kinds ends an open one of the same kind in the same list or table.
_SAME_ENDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}


#: Parts of a class word that say what an element has or lacks, not what it is.
QUALIFIERS = {"has", "have", "no", "not", "non", "with", "without", "free", "hide", "show"}
#: Elements that are blocks of a container, never the container.
PIECES = HEADINGS | INLINE | {"p", "li", "ul", "ol", "dl", "dt", "dd", "tr", "td", "th", "tbody", "thead", "table", "pre", "blockquote", "figure", "figcaption"}


class Element:
    """``aside``: by tag, role or hiding; ``named``: this or the nearest element around it that class or id words call aside."""

    __slots__ = ("name", "parent", "depth", "aside", "named", "article", "main", "link", "header")

    def __init__(self, name: str, parent: Element | None, attributes: str):
        self.name, self.parent, self.depth = name, parent, parent.depth + 1 if parent else 0
        pairs = _pairs(attributes) if attributes and _TELLING.search(attributes) else {}
        self.aside = parent is not None and parent.aside or name in ASIDE or _aside_by_role(pairs, name)
        self.named = self if pairs and _aside_by_name(pairs, name) else parent.named if parent else None
        self.article = parent.article if parent and parent.article else self if name == "article" else None
        self.main = parent.main if parent and parent.main else self if name == "main" or pairs.get("role", "").strip().lower() == "main" else None
        self.header = parent is not None and parent.header or name == "header" or bool(pairs) and _header_by_name(pairs)
        self.link = parent is not None and parent.link or name == "a"


def _pairs(attributes: str) -> dict[str, str]:
    """Names and values; of a repeated name the first counts."""
    found: dict[str, str] = {}
    for key, *values in _PAIR.findall(attributes):
        if key:
            found.setdefault(key.lower(), html.unescape(next((v for v in values if v), "")))
    return found


def _words(value: str) -> set[str]:
    words: set[str] = set()
    for token in value.split():
        parts = {w.lower() for part in re.split(r"[_:/.-]+", token) for w in (part, *_CAMEL.findall(part))}
        if not parts & QUALIFIERS:
            words |= parts
    return words


def _aside_by_role(pairs: dict[str, str], name: str) -> bool:
    if pairs.get("role", "").strip().lower() in ROLES and name != "body":
        return True
    hidden = "hidden" in pairs or pairs.get("aria-hidden") == "true"
    return hidden or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", pairs.get("style", ""), re.I) is not None


def _aside_by_name(pairs: dict[str, str], name: str) -> bool:
    if name in ("html", "body", "main"):
        return False
    names = WORDS & {"comment", "comments", "related", "teaser", "ad", "promo"} if name == "article" else WORDS
    return any(names & _words(pairs.get(key, "")) for key in ("class", "id"))


def _header_by_name(pairs: dict[str, str]) -> bool:
    return any(WORDS_OF_HEADERS & _words(pairs.get(key, "")) for key in ("class", "id"))


class Line:
    """One block's text, what of it is outside links, and where it stands."""

    __slots__ = ("text", "plain", "at", "aside", "article", "main")

    def __init__(self, text: str, plain: int, at: Element):
        self.text, self.plain, self.at = text, plain, at
        self.aside = at.aside or at.header and not (at.article and at.name in HEADINGS)
        self.article, self.main = at.article is not None, at.main is not None


def _settle_named(lines: list[Line]) -> None:
    """Lines in elements that are aside by name are so, unless the element wraps the marked part or most of the page's text."""
    held: dict[Element, int] = {}
    wrapping: set[Element] = set()
    total, elsewhere = 0, False
    for line in lines:
        own = line.at.named
        around = own
        while around is not None and around not in held:
            held[around] = 0
            around = around.parent.named
        if line.aside:
            continue
        total += line.plain
        marked = any(part and line.plain and own is part.named and own is not part for part in (line.at.article, line.at.main))
        elsewhere |= marked and own is None
        if own is not None:
            held[own] += line.plain
            if marked:
                wrapping.add(own)
    inner_last = sorted(held, key=lambda e: e.depth)
    for element in reversed(inner_last):
        above = element.parent.named
        if above is not None:
            held[above] += held[element]
            if element in wrapping:
                wrapping.add(above)
    out: dict[Element | None, bool] = {None: False}
    for element in inner_last:
        wraps = not elsewhere and element in wrapping or 2 * held[element] > total and not (element.parent.article or element.parent.main)
        out[element] = out[element.parent.named] or not wraps
    for line in lines:
        line.aside = line.aside or out[line.at.named]


def lines_of(page: str) -> list[Line]:
    """The page's blocks in order. Markup errors are borne: unknown ends are skipped and open elements end with the page."""
    lines: list[Line] = []
    stack: list[Element] = [Element("", None, "")]
    parts: list[tuple[str, bool]] = []
    block = stack[0]

    def flush() -> None:
        if parts:
            words = " ".join("".join([text for text, _ in parts]).split())
            if words:
                linked = sum(len(text.strip()) for text, link in parts if link)
                lines.append(Line(words, max(0, len(words) - linked), block))
            parts.clear()

    at, no_comment_end = 0, False
    while at < len(page):
        opening = page.find("<", at)
        if opening < 0:
            opening = len(page)
        if opening > at:
            parts.append((html.unescape(page[at:opening]), stack[-1].link))
        if opening == len(page):
            break
        if page.startswith("<!--", opening):
            end = -1 if no_comment_end else page.find("-->", opening + 4)
            no_comment_end |= end < 0
            at = end + 3 if end >= 0 else len(page)
            continue
        tag = _TAG.match(page, opening)
        if tag is None:
            if page[opening + 1 : opening + 2] in ("!", "?"):
                end = page.find(">", opening)
                at = end + 1 if end >= 0 else len(page)
            elif re.match(r"</?[a-zA-Z]", page[opening : opening + 3]):
                end = page.find(">", opening)  # quotes that do not match, or a tag cut off by the page's end
                at = end + 1 if end >= 0 else len(page)
            else:
                parts.append(("<", stack[-1].link))
                at = opening + 1
            continue
        at, name, attributes = tag.end(), tag[2].lower(), tag[3]
        if tag[1]:
            if name not in INLINE:
                flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    break
                if name in INLINE and stack[depth].name not in INLINE:
                    break
            block = _block(stack)
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            if not attributes.rstrip().endswith("/") or name in ("script", "style", "title", "textarea"):
                at = close.end() if close else len(page)
            continue
        if name in VOID:
            if name in ("br", "hr"):
                parts.append((" ", stack[-1].link))
            if name == "hr":
                flush()
            continue
        if name not in INLINE:
            flush()
            if _CLOSES_P.fullmatch(name):
                _end(stack, "p", {"td", "th", "div", "article", "section", "main", "li", "body", "aside", "blockquote"})
            if name in _SAME_ENDS:
                _end(stack, name, _SAME_ENDS[name])
                if name in ("dt", "dd"):
                    _end(stack, "dd" if name == "dt" else "dt", {"dl"})
        if not attributes.endswith("/") or name in INLINE:
            stack.append(Element(name, stack[-1], attributes))
        block = _block(stack)
    flush()
    _settle_named(lines)
    return lines


def _end(stack: list[Element], name: str, within: set[str]) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].name == name:
            del stack[depth:]
            return
        if stack[depth].name in within:
            return


def _block(stack: list[Element]) -> Element:
    """The innermost element that is not inline."""
    return next((e for e in reversed(stack) if e.name not in INLINE), stack[0])


def weights(lines: list[Line]) -> list[int]:
    """What each line adds to the distribution."""
    sizes = [0 if line.aside else line.plain for line in lines]
    total = sum(sizes)
    for part in ("article", "main"):
        marked = [size if getattr(line, part) else 0 for size, line in zip(sizes, lines)]
        if sum(marked) and sum(marked) >= MARKED_SHARE * total:
            return marked
    return sizes


def _container(found: list[Element]) -> Element | None:
    """The innermost element around all of these that is more than a block of text."""
    held: dict[Element, int] = {}
    for at in found:
        around: Element | None = at
        while around is not None and around not in held:
            held[around] = 0
            around = around.parent
        held[at] += 1
    for element in sorted(held, key=lambda e: -e.depth):
        if held[element] == len(found) and element.name not in PIECES:
            return element
        if element.parent is not None:
            held[element.parent] += held[element]
    return None


def _inside(lines: list[Line], container: Element) -> list[Line]:
    """The container's lines that are not aside."""
    known: dict[Element | None, bool] = {None: False, container: True}
    for line in lines:
        path, at = [], line.at
        while at not in known:
            path.append(at)
            at = at.parent
        known.update(dict.fromkeys(path, known[at]))
    return [line for line in lines if not line.aside and known[line.at]]


def main_text(page: str | None) -> str:
    """The main container's blocks that are not aside, from its first to its last with text of its own, joined by one space.

    The container is the marked part, or what holds all runs between surge and dive points that reach the share of the peak.
    """
    lines = lines_of(page or "")
    sizes = weights(lines)
    if any(size and (line.article or line.main) for size, line in zip(sizes, lines)):
        part = "article" if any(size and line.article for size, line in zip(sizes, lines)) else "main"
        at = [i for i, line in enumerate(lines) if getattr(line, part) and not line.aside]
        return " ".join(line.text for line in lines[at[0] : at[-1] + 1] if not line.aside and (line.article or line.main))
    sums = [sum(sizes[i : i + WINDOW]) for i in range(len(sizes))]
    least = PEAK_SHARE * max(sums, default=0)
    found: list[Element] = []
    start = 0
    while start < len(sums):
        if not sums[start]:
            start += 1
            continue
        dive = next((i for i in range(start, len(sums)) if not sums[i]), len(sums))
        if max(sums[start:dive]) >= least:
            found += [line.at for line, size in zip(lines[start:dive], sizes[start:dive]) if size]
        start = dive
    container = _container(found)
    if container is None:
        return ""
    inside = _inside(lines, container)
    own = [i for i, line in enumerate(inside) if line.plain]
    return " ".join(line.text for line in inside[own[0] : own[-1] + 1])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    A null or empty page, or one without main text, has an empty text; repeated rows stay repeated and other columns are ignored.
    """
    ship_package(pages.sparkSession)
    columns = [F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")]
    texts = pages.select(*columns).mapInArrow(_extract, "page_id bigint, url string, text string")
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
