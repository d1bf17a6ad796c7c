"""Reading elements out of HTML text: a tolerant element tree and a small selector matcher.

This is the one place where rows are handled in Python: HTML is not regular enough for the JVM
expressions. It only finds elements and their text; every rule on that text (patterns, prefixes,
defaults, filters) is a column expression in :mod:`stepmill.operators.html`.
"""

from __future__ import annotations

import re
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

# Elements that never have content.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)
# Elements whose text is not part of the text around them.
SEPARATE_TEXT = frozenset("script style template rt rp".split())
# Elements whose blank text is kept as it is.
PREFORMATTED = frozenset(("pre", "textarea"))
SPECIAL = SEPARATE_TEXT | PREFORMATTED


class Element:
    """A tag with its attributes; children are elements and (text, separate container) pairs."""

    __slots__ = ("tag", "attrs", "classes", "parent", "children")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None) -> None:
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []
        self.classes = attrs["class"].split() if "class" in attrs else ()

    def descendants(self) -> list[Element]:
        """All elements below this one, in document order."""
        found, stack = [], [e for e in reversed(self.children) if type(e) is Element]
        while stack:
            element = stack.pop()
            found.append(element)
            if element.children:
                stack += [e for e in reversed(element.children) if type(e) is Element]
        return found

    def text(self, separator: str = " ", strip: bool = True) -> str:
        """The text pieces below this element, stripped and joined."""
        wanted = self.tag if self.tag in SEPARATE_TEXT else None
        pieces = []
        stack = [iter(self.children)]
        while stack:
            child = next(stack[-1], None)
            if child is None:
                stack.pop()
            elif isinstance(child, Element):
                stack.append(iter(child.children))
            elif child[1] == wanted:
                pieces.append(child[0].strip() if strip else child[0])
        return separator.join(p for p in pieces if p) if strip else separator.join(pieces)


class _Builder(HTMLParser):
    """Elements stay open until their end tag, or that of an element around them, comes."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.root = Element("", {}, None)
        self.open = [self.root]
        self.special: list[str] = []  # open elements that change how text is kept
        self.buffer: list[str] = []

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def flush(self) -> None:
        if not self.buffer:
            return
        piece = "".join(self.buffer)
        self.buffer.clear()
        if not piece.strip(" \t\n\r\f") and not PREFORMATTED.intersection(self.special):
            piece = "\n" if "\n" in piece else " "
        container = next((tag for tag in reversed(self.special) if tag in SEPARATE_TEXT), None)
        self.open[-1].children.append((piece, container))

    def _add(self, tag: str, attrs) -> Element:
        self.flush()
        element = Element(tag, {k: v or "" for k, v in attrs}, self.open[-1])
        self.open[-1].children.append(element)
        return element

    def handle_starttag(self, tag, attrs):
        element = self._add(tag, attrs)
        if tag not in VOID:
            self.open.append(element)
            if tag in SPECIAL:
                self.special.append(tag)

    def handle_startendtag(self, tag, attrs):
        self._add(tag, attrs)

    def handle_endtag(self, tag):
        self.flush()
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                closed = sum(e.tag in SPECIAL for e in self.open[depth:])
                del self.special[len(self.special) - closed :]
                del self.open[depth:]
                return

    def handle_data(self, data):
        self.buffer.append(data)

    def handle_entityref(self, name):
        self.buffer.append(html5.get(f"{name};", f"&{name}"))

    def handle_charref(self, name):
        self.buffer.append(unescape(f"&#{name};") or "�")

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self.flush()
        if data.upper().startswith("CDATA["):
            self.buffer.append(data[6:])
            self.flush()


# Markup that is read by one pattern per token. Anything else on a page (bare ampersands, odd
# attributes, sections) sends the whole page through the tolerant parser instead.
_TOKEN = re.compile(
    r"""(?P<text>[^<&]+)
    |<(?P<start>[A-Za-z][A-Za-z0-9]*)(?P<attrs>(?:\s+[A-Za-z][\w-]*(?:="[^"<>&]*"|='[^'<>&]*'|=[\w.:-]+)?)*)\s*(?P<slash>/?)>
    |</(?P<end>[A-Za-z][A-Za-z0-9]*)>
    |&(?P<name>[A-Za-z][A-Za-z0-9]*);
    |&\#(?P<number>[0-9]+|[xX][0-9A-Fa-f]+);
    |<!--(?P<comment>[^<>-][^<>-]*)-->
    |<!(?P<doctype>(?i:doctype)\s[\w\s]*)>""",
    re.VERBOSE | re.ASCII,
)
_ATTRIBUTE = re.compile(r"""([A-Za-z][\w-]*)(?:="([^"]*)"|='([^']*)'|=([\w.:-]+))?""", re.ASCII)
# Elements whose content is not markup. Only the first two are read by pattern.
_RAW = ("script", "style", "title", "textarea", "iframe", "noembed", "noframes", "noscript", "plaintext", "xmp")


def _read_regular(html: str, builder: _Builder) -> bool:
    """Build the tree of a page made of regular tokens only; False if it is not."""
    at, end, match = 0, len(html), _TOKEN.match
    while at < end:
        m = match(html, at)
        if m is None:
            return False
        at, kind = m.end(), m.lastgroup
        if kind == "text":
            builder.buffer.append(m["text"])
        elif kind == "end":
            builder.handle_endtag(m["end"].lower())
        elif kind == "slash":
            tag, attrs = m["start"].lower(), m["attrs"]
            pairs = [(a.lower(), b or c or d) for a, b, c, d in _ATTRIBUTE.findall(attrs)] if attrs else ()
            if tag in _RAW:
                stop = html.find(f"</{tag}>", at)
                content = html[at:stop]
                plain = "<" not in content and "&" not in content
                script = tag in _RAW[:2] and f"</{tag}" not in content.lower() and "<!--" not in content
                if stop < 0 or m["slash"] or not (plain or script):
                    return False
                builder.handle_starttag(tag, pairs)
                if content:
                    builder.buffer.append(content)
                at = stop
            elif m["slash"]:
                builder.handle_startendtag(tag, pairs)
            else:
                builder.handle_starttag(tag, pairs)
        elif kind == "name":
            if f"{m['name']};" not in html5:
                return False
            builder.handle_entityref(m["name"])
        elif kind == "number":
            builder.handle_charref(m["number"])
        else:
            builder.flush()
    return True


def parse_html(html: str) -> Element:
    """The element tree of a page; the returned root stands above all of it."""
    builder = _Builder()
    if not _read_regular(html, builder):
        builder = _Builder()
        builder.feed(html)
        builder.close()
    builder.flush()
    return builder.root


_PART = re.compile(
    r"""\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)|(?P<tag>\*|[A-Za-z][\w-]*)
    |\[\s*(?P<attr>[\w-]+)\s*(?:=\s*(?P<value>"[^"]*"|'[^']*'|[\w-]+)\s*)?\]""",
    re.VERBOSE,
)


def compile_selector(selector: str) -> list[list]:
    """``tag``, ``.class``, ``#id``, ``[attr]``, ``[attr=value]``, descendants, ``>``, comma lists.

    The result is one chain per alternative, from the element itself outwards; each link is
    (tests, whether the next link must be the direct parent).
    """
    alternatives = []
    for alternative in re.split(r",(?![^\[]*\])", selector):
        chain, compound, child, position = [], [], False, 0
        source = re.sub(r"\s*>\s*", ">", alternative.strip())
        while position < len(source):
            match = _PART.match(source, position)
            if match:
                compound.append(_test(match))
                position = match.end()
            elif compound and source[position] in " \t\n\r\f>":
                chain.append((compound, child))
                child = source[position] == ">"
                compound = []
                position += len(re.match(r"[ \t\n\r\f]+|>", source[position:]).group())
            else:
                break
        if not compound or position < len(source):
            raise ValueError(f"selector {selector!r} is empty or not supported")
        chain.append((compound, child))
        alternatives.append(chain[::-1])
    return alternatives


def _test(match: re.Match) -> tuple[str, str | None, str | None]:
    kind = match.lastgroup if match.lastgroup != "value" else "attr"
    if kind == "attr":
        value = match["value"]
        if value is not None and value[0] in "\"'":
            value = value[1:-1]
        return "attr", match["attr"].lower(), value
    return kind, match[kind].lower() if kind == "tag" else match[kind], None


def _passes(element: Element, compound: list) -> bool:
    for kind, name, value in compound:
        if kind == "tag":
            ok = name == "*" or element.tag == name
        elif kind == "cls":
            ok = name in element.classes
        elif kind == "id":
            ok = element.attrs.get("id") == name
        else:
            ok = name in element.attrs and (value is None or element.attrs[name] == value)
        if not ok:
            return False
    return True


def _matches(element: Element, chain: list, at: int = 0) -> bool:
    compound, child = chain[at]
    if not _passes(element, compound):
        return False
    if at + 1 == len(chain):
        return True
    outer = element.parent
    while outer is not None and outer.parent is not None:
        if _matches(outer, chain, at + 1):
            return True
        if child:
            return False
        outer = outer.parent
    return False


def matches(element: Element, compiled: list[list]) -> bool:
    return any(_matches(element, chain) for chain in compiled)


def select_all(elements: list[Element], selectors: list) -> list[Element]:
    """All elements that match the first selector that matches any."""
    for compiled in selectors:
        found = [e for e in elements if matches(e, compiled)]
        if found:
            return found
    return []


def select_one(elements: list[Element], selectors: list) -> Element | None:
    """The first element that matches the first selector that matches any."""
    for compiled in selectors:
        for element in elements:
            if matches(element, compiled):
                return element
    return None
