"""A small reader for stored pages: element tree and the few lookups needed.

Only nested markup needs it; anchors are harvested with built-in expressions.
"""

from __future__ import annotations

import re
from html import unescape
from urllib.parse import urljoin

# Elements without content, and elements whose start ends an
# open paragraph or an open sibling.
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_ENDS_PARAGRAPH = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main nav ol p pre section table ul".split()
)
_ENDS_SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_ENDS_SIBLING |= {"tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPE = {"table", "td", "th", "button", "caption", "ul", "ol", "dl", "select"}


_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)\b(?P<raw_attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>(?P<code>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?][^>]*>",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")


class Element:
    __slots__ = ("tag", "source", "children", "_attrs")

    def __init__(self, tag, source):
        self.tag = tag
        self.source = source
        self.children = []
        self._attrs = None

    @property
    def attrs(self):
        """Attributes by lower-case name; read from the tag when first needed."""
        if self._attrs is None:
            self._attrs = {}
            for name, *values in _ATTRIBUTE.findall(self.source):
                self._attrs.setdefault(name.lower(), unescape("".join(values)))
        return self._attrs

    @property
    def css_class(self):
        return self.attrs.get("class", "") if self.source else ""

    def elements(self):
        """Descendant elements in document order."""
        pending = [c for c in reversed(self.children) if isinstance(c, Element)]
        while pending:
            element = pending.pop()
            yield element
            pending.extend(c for c in reversed(element.children) if isinstance(c, Element))

    def text(self):
        parts, pending = [], list(reversed(self.children))
        while pending:
            item = pending.pop()
            if isinstance(item, str):
                parts.append(item)
            else:
                pending.extend(reversed(item.children))
        return "".join(parts).strip()

    def first(self, test):
        return next((e for e in self.elements() if test(e)), None)


def _close(stack, tags, scope):
    """Drop the innermost open element with one of the tags, within the scope."""
    for depth in range(len(stack) - 1, 0, -1):
        tag = stack[depth].tag
        if tag in tags:
            del stack[depth:]
            return
        if tag in scope:
            return


def parse(html: str | None) -> Element:
    """The element tree of a page; a missing end tag is taken as browsers do."""
    root = Element("", "")
    stack, text_from = [root], 0
    html = html or ""
    for token in _TAG.finditer(html):
        if token.start() > text_from:
            stack[-1].children.append(unescape(html[text_from : token.start()]))
        text_from = token.end()
        if token["raw"]:
            element = Element(token["raw"].lower(), token["raw_attrs"])
            element.children.append(token["code"])
            stack[-1].children.append(element)
        elif token["tag"]:
            tag = token["tag"].lower()
            if token["end"]:
                _close(stack, (tag,), ())
                continue
            if tag in _ENDS_PARAGRAPH:
                _close(stack, ("p",), _SCOPE)
            if tag in _ENDS_SIBLING:
                _close(stack, _ENDS_SIBLING[tag], _SCOPE)
            element = Element(tag, token["attrs"])
            stack[-1].children.append(element)
            if tag not in _VOID:
                stack.append(element)
    if text_from < len(html):
        stack[-1].children.append(unescape(html[text_from:]))
    return root


def _resolve(base, href):
    if not href:
        return ""
    return href if "://" in href else urljoin(base or "", href)


def cards(html, base, card_class, price_class):
    """``(href, title, price)`` of every product card, in page order."""
    found = []
    for card in parse(html).elements():
        if card_class not in card.css_class:
            continue
        link = card.first(lambda e: e.tag == "a")
        title = card.first(lambda e: e.tag == "h3")
        price = card.first(lambda e: price_class in e.css_class)
        href = link.attrs.get("href") if link else None
        found.append(
            (
                _resolve(base, href),
                title.text() if title else "",
                price.text() if price else "",
            )
        )
    return found


_PRICE_SPAN = re.compile(r"USD\s+[\d,]+")


def label_detail(html, block_class, report_class):
    """``(price text, specification lines, report text)`` of a detail page."""
    root = parse(html)
    price = root.first(lambda e: e.tag == "span" and _PRICE_SPAN.fullmatch(e.text()))
    block = root.first(lambda e: block_class in e.css_class.split())
    lines = [e.text() for e in block.elements() if e.tag == "p"] if block else []
    report = root.first(
        lambda e: report_class in e.css_class and "report type" in e.text().lower()
    )
    return (price.text() if price else "", lines, report.text() if report else "")


def table_detail(html, rows_class):
    """Specification lines of a detail page: the rows of its information table."""
    container = parse(html).first(lambda e: rows_class in e.css_class)
    if container is None:
        return []
    return [c.text() for c in container.children if isinstance(c, Element)]


def tag_texts(html, tag):
    return [e.text() for e in parse(html).elements() if e.tag == tag]
