"""A tolerant reader of HTML: block elements and the text pieces in them."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

#: Elements that start and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose content is not shown as text of the page.
HIDDEN = frozenset(
    "script style noscript template iframe object svg math canvas audio video select option "
    "datalist button textarea title".split()
)
#: Of these, those whose content is not markup.
_RAW = frozenset("script style textarea title iframe noscript".split())
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_BREAKS = frozenset("br wbr hr img".split())
#: An element of the key's kind ends at the start of one of these.
_ENDS = {
    "p": BLOCKS - {"html", "head", "body"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot", "thead"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "head": frozenset({"body"}),
}
#: Elements that an implied end does not reach beyond.
_WALLS = frozenset("ul ol dl table td th div article section main body blockquote".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NUMBER = re.compile(r"\d+")


@dataclass
class Element:
    """name; sign: name and class without numbers, by which elements are aligned;
    attributes: in lower case."""

    name: str
    sign: str
    parent: int
    attributes: dict[str, str] = field(default_factory=dict)


@dataclass
class Page:
    """Elements in order, the root first, and (element, block, in a link, text)."""

    elements: list[Element]
    pieces: list[tuple[int, int, bool, str]]


def _attributes(raw: str) -> dict[str, str]:
    found = {}
    for name, *values in _ATTRIBUTE.findall(raw):
        if name.lower() in ("class", "id", "role", "style", "hidden", "aria-hidden"):
            found.setdefault(name.lower(), "".join(values).lower())
    return found


def read(html: str) -> Page:
    """Elements and text of a page; never fails, whatever the markup."""
    elements, pieces = [Element("", "", -1)], []
    stack, block, links, hidden, at = [0], 0, 0, 0, 0
    size = len(html)
    while at < size:
        opened = html.find("<", at)
        token = _TOKEN.match(html, opened) if opened >= 0 else None
        # A "<" that starts no tag is text.
        stop = size if opened < 0 else opened if token else opened + 1
        if stop > at and not hidden:
            text = html[at:stop]
            if text.strip():
                pieces.append((stack[-1], block, links > 0, unescape(text)))
            elif pieces and pieces[-1][1] == block:
                pieces.append((stack[-1], block, False, " "))
        at = stop
        if token is None:
            continue
        at = token.end()
        name = (token[2] or token[5] or "").lower()
        if not name:
            continue
        closing = bool(token[1] or token[4])
        if name in HIDDEN:
            if closing:
                hidden = max(hidden - 1, 0)
            elif name in _RAW:
                end = re.compile(f"</{re.escape(name)}[^>]*>", re.I).search(html, at)
                at = end.end() if end else size
            elif not (token[3] or token[6] or "").endswith("/"):
                hidden += 1
            continue
        if name in _BREAKS and not hidden:
            pieces.append((stack[-1], block, False, " "))
        if name == "a":
            links = max(links + (-1 if closing else 1), 0)
        if name not in BLOCKS or name in _VOID:
            continue
        block += 1
        links = hidden = 0
        if closing:
            depth = next(
                (i for i in range(len(stack) - 1, 0, -1) if elements[stack[i]].name == name), 0
            )
            if depth:
                del stack[depth:]
            continue
        for i in range(len(stack) - 1, 0, -1):
            above = elements[stack[i]].name
            if name in _ENDS.get(above, ()):
                del stack[i:]
            if above in _WALLS:
                break
        attributes = _attributes(token[3] or token[6] or "")
        kind = _NUMBER.sub("", attributes.get("class") or attributes.get("id") or "")
        sign = f"{name}.{kind}" if kind else name
        elements.append(Element(name, sign, stack[-1], attributes))
        stack.append(len(elements) - 1)
    return Page(elements, pieces)
