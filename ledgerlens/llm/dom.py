"""A forgiving reader of web pages: a page becomes a flat tree of blocks and their texts.

Nodes are block elements and, as leaves, the runs of text between block boundaries. Inline
elements leave no node; what they hold belongs to the run around them. Scripts, styles and
other markup that is never shown is left out. Reading takes time in proportion to the page,
whatever is unclosed or nested in it.
"""

from __future__ import annotations

import re
from html import unescape

# Names of HTML elements by what they do.
KINDS = {
    "article": "article",
    "main": "main",
    "nav": "nav",
    "header": "header",
    "footer": "footer",
    "aside": "aside",
    "form": "form",
    "section": "section",
    "p": "p",
    "h1 h2 h3 h4 h5 h6 hgroup": "heading",
    "ul ol menu dir dl": "list",
    "li dt dd": "item",
    "td th": "cell",
    "table tbody thead tfoot tr caption": "table",
    "div center body": "div",
    "blockquote": "quote",
    "pre": "pre",
    "figure figcaption": "figure",
    "details summary dialog": "details",
    "address": "address",
    "fieldset legend": "fields",
}
RAW = ("script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp")
#: Left out as a whole if closed; the tag alone is ignored otherwise.
WITHHELD = ("noscript", "template")
#: Controls and drawings: left out up to their end or the next block.
CONTROLS = {"select", "button", "option", "optgroup", "datalist", "svg", "math", "canvas", "object", "audio", "video"}
#: Words in class, id and role by what they hint at.
HINTS = {
    "navigation": "nav navbar navigation menu menubar breadcrumb breadcrumbs topbar toc pager pagination skip tabs",
    "advert": "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion dfp",
    "comment": "comment comments commentlist reply replies respond disqus discussion responses reader readers feedback",
    "side": "sidebar side aside rail widget widgets complementary secondary",
    "foot": "footer foot copyright legal colophon contentinfo imprint",
    "head": "header masthead banner topline logo brand tagline",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription privacy",
    "share": "share sharing social follow like",
    "related": "related recommended recommendations more popular trending teaser teasers also latest next",
    "form": "search login signin signup register form",
    "content": "article content main post entry story body text news blog prose hentry",
    "hidden": "hidden invisible sr screenreader",
}

KIND_NAMES = ("leaf", *KINDS.values())
HINT_NAMES = tuple(HINTS)
_KIND = {tag: code for code, tags in enumerate(KINDS, 1) for tag in tags.split()}
_HINT = {}
for _place, _words in enumerate(HINTS.values()):
    for _word in _words.split():
        _HINT[_word] = _HINT.get(_word, 0) | 1 << _place
_HIDDEN = 1 << HINT_NAMES.index("hidden")

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])))*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
_RAW_END = {name: re.compile(rf"</{name}[\s/>]", re.I) for name in (*RAW, *WITHHELD)}
_ATTRIBUTE = re.compile(
    r"""(?<![\w-])(class|id|role|itemprop|style|hidden|aria-hidden)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]*+))?""", re.I
)
_TOKEN = re.compile("[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = ".,;:!?"
_CLOSES = {  # tag -> open tags it ends, and the ones it does not reach beyond
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
}
_CLOSES["tfoot"] = _CLOSES["thead"] = _CLOSES["tbody"]
_REMEMBERED = 20_000


def _hints(attributes: str) -> int:
    found = 0
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and "true" in value):
            found |= _HIDDEN
        elif name == "style":
            if "none" in value and re.search(r"display\s*:\s*none", value):
                found |= _HIDDEN
        else:
            for token in _TOKEN.findall(value):
                found |= _HINT.get(token.lower(), 0)
    return found


class Page:
    """Nodes in page order, as parallel lists.

    ``parent`` (the first node, the page itself, is its own), ``end`` (one past the last
    descendant), ``kind``, ``hints`` and, of leaves, ``text`` and its measures."""

    def __init__(self):
        self.parent, self.end, self.kind, self.hints = [0], [0], [_KIND["div"]], [0]
        self.text: list[str | None] = [None]
        self.links, self.punctuation, self.digits = [0], [0], [0]

    def _add(self, parent: int, kind: int, hints: int) -> int:
        node = len(self.parent)
        self.parent.append(parent)
        self.end.append(node + 1)
        self.kind.append(kind)
        self.hints.append(hints)
        self.text.append(None)
        self.links.append(0)
        self.punctuation.append(0)
        self.digits.append(0)
        return node

    def _leaf(self, parent: int, text: str, links: int) -> None:
        node = self._add(parent, 0, 0)
        self.text[node] = text
        self.links[node] = min(links, len(text))
        self.punctuation[node] = sum(map(text.count, _PUNCTUATION))
        self.digits[node] = sum(map(text.count, "0123456789"))


def read_page(html: str | None, memory: dict[str, int] | None = None) -> Page:
    """``memory`` keeps the hints of attribute texts between pages."""
    page = Page()
    html = html or ""
    memory = {} if memory is None else memory
    stack: list[tuple[str, int]] = [("", 0)]
    opened: dict[str, int] = {}
    buffer: list[str] = []
    link_chars, link_at, control = 0, 0, ""  # link_at: height of the stack where a link began
    tag_of, at, size = _TAG, 0, len(html)
    never_closed: set[str] = set()

    def flush():
        nonlocal link_chars
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                page._leaf(stack[-1][1], text, link_chars)
            buffer.clear()
        link_chars = 0

    def pop(height: int):
        nonlocal link_at
        past = len(page.parent)
        while len(stack) > height:
            name, node = stack.pop()
            opened[name] -= 1
            page.end[node] = past
        if link_at > height:
            link_at = 0

    def say(text: str):
        nonlocal link_chars
        if not control and text:
            if "&" in text:
                text = unescape(text)
            buffer.append(text)
            if link_at:
                link_chars += len(text)

    while at < size:
        sign = html.find("<", at)
        if sign < 0:
            say(html[at:])
            break
        say(html[at:sign])
        if html.startswith(("<!", "<?"), sign):
            mark = "-->" if html.startswith("<!--", sign) else ">"
            past = html.find(mark, sign + 2)
            if past < 0:
                break  # an unclosed comment reaches to the end
            at = past + len(mark)
            continue
        found = tag_of.match(html, sign)
        if not found:
            letter = html[sign + 1 : sign + 2]
            if letter == "/" and not html[sign + 2 : sign + 3].isalpha():
                past = html.find(">", sign)  # a broken end tag counts as a comment
                if past < 0:
                    break
                at = past + 1
            elif letter != "/" and not (letter.isascii() and letter.isalpha()):
                say("<")
                at = sign + 1
            elif tag_of is _TAG:
                tag_of, at = _LOOSE_TAG, sign  # a quote that never ends: quotes no longer count
            else:
                break  # the page ends within a tag
            continue
        at = found.end()
        closing, name, attributes = found.groups()
        name = name.lower()
        if name in _RAW_END and not closing:
            past = None if name in never_closed else _RAW_END[name].search(html, at)
            if past:
                at = html.find(">", past.start()) + 1 or size
            elif name in RAW:
                break
            else:
                never_closed.add(name)
            continue
        if name in CONTROLS:
            if closing:
                control = "" if name == control else control
            elif not control and not attributes.endswith("/"):
                control = name
            continue
        kind = _KIND.get(name)
        if kind is None:
            if name == "br":
                say(" ")
            elif name == "hr":
                flush()
            elif name == "a":
                link_at = 0 if closing else len(stack)
            continue
        if closing:
            if name == "body" or not opened.get(name):
                continue
            flush()
            height = len(stack) - 1
            while stack[height][0] != name:
                height -= 1
            pop(height)
            continue
        control = ""
        flush()
        if stack[-1][0] == "p" or kind == _KIND["h1"] == _KIND.get(stack[-1][0]):
            pop(len(stack) - 1)
        if name in _CLOSES:
            ends, limits = _CLOSES[name]
            if any(opened.get(n) for n in ends):
                height, down = len(stack) - 1, 0
                while height > 0 and stack[height][0] not in limits:
                    if stack[height][0] in ends:
                        down = height
                    height -= 1
                if down:
                    pop(down)
        hints = 0
        if attributes:
            hints = memory.get(attributes, -1)
            if hints < 0:
                hints = _hints(attributes)
                if len(attributes) < 500:
                    if len(memory) >= _REMEMBERED:
                        memory.clear()
                    memory[attributes] = hints
        if name == "body":
            page.hints[0] |= hints
            continue
        node = page._add(stack[-1][1], kind, hints)
        stack.append((name, node))
        opened[name] = opened.get(name, 0) + 1
    flush()
    pop(1)
    page.end[0] = len(page.parent)
    return page
