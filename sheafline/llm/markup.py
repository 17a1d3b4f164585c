"""HTML pages as trees of elements and texts, in one scan over the tags."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*>?|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>)", re.S)
_LOOSE = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*>?|(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z))", re.S)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "math", "select", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark",
          "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "img", "label"}
#: An open element that a new one of the second kind ends.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "thead", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "thead", "tfoot"}, "th": {"td", "th", "tr", "tbody", "thead", "tfoot"}, "option": {"option", "optgroup"},
}
SCOPES = {"ul", "ol", "dl", "table", "body", "html", "article", "section", "div", "main", "nav", "aside", "header", "footer", "form"}


@dataclass
class Element:
    tag: str
    names: tuple[str, ...] = ()  # words of class, id and role
    children: list = field(default_factory=list)  # Element or str

    @property
    def label(self) -> str:
        """Tag and first name: what a template keeps from page to page."""
        return f"{self.tag}.{self.names[0]}" if self.names else self.tag


def _names(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    found = [a or b or c for _, a, b, c in _NAMES.findall(attributes)]
    return tuple(w for w in re.split(r"[\W\d_]+", " ".join(found).lower()) if w)


def parse(page: str) -> Element:
    """The tree below a root without a tag. Ends without a start are ignored; elements without an end go on to the next
    element that ends them. Contents of scripts and the like, and comments, are left out."""
    root = Element("")
    stack, at, pattern = [root], 0, _TAG
    while True:
        cut = page.find("<", at)
        if cut < 0:
            break
        found = pattern.match(page, cut)
        if not found and pattern is _TAG and cut + 1 < len(page) and (page[cut + 1].isalpha() or page[cut + 1] == "/"):
            pattern = _LOOSE  # a quote that never closes: from here on, tags end at the next >
            found = pattern.match(page, cut)
        if not found:
            stack[-1].children.append(page[at:cut + 1])
            at = cut + 1
            continue
        if cut > at:
            stack[-1].children.append(page[at:cut])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if tag in INLINE and stack[i].tag not in INLINE:
                    break  # an inline end does not close blocks
            continue
        if tag not in INLINE and tag not in RAW:
            for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph, with the inline elements in it
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag not in INLINE:
                    break
        if any(tag in CLOSED_BY.get(e.tag, ()) for e in stack[-8:]):
            for i in range(len(stack) - 1, 0, -1):
                if tag in CLOSED_BY.get(stack[i].tag, ()):
                    del stack[i:]
                    break
                if stack[i].tag in SCOPES:
                    break
        element = Element(tag, _names(found[3]))
        stack[-1].children.append(element)
        if tag in VOID or found[3].endswith("/") and tag in ("svg", "math", "path"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append(element)
    if at < len(page):
        stack[-1].children.append(page[at:])
    return root


def decoded(text: str) -> str:
    """Character references decoded, runs of white space one space, trimmed."""
    return " ".join((html.unescape(text) if "&" in text else text).split())
