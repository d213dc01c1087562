"""Leaf blocks of web pages: texts between block-level tags, with the path of tags above them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Elements inside a line of text.
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr",
    "annotation", "annotation-xml", "maction", "math", "menclose", "merror", "mfrac", "mi", "mmultiscripts", "mn", "mo",
    "mover", "mpadded", "mphantom", "mprescripts", "mroot", "mrow", "ms", "mspace", "msqrt", "mstyle", "msub", "msubsup",
    "msup", "mtable", "mtd", "mtext", "mtr", "munder", "munderover", "semantics",
}
# Elements that part blocks. All others, custom ones too, stand inside a line, as browsers take them.
PARTING = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "col", "colgroup", "datalist", "dd", "details",
    "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "frame", "frameset", "h1", "h2", "h3", "h4",
    "h5", "h6", "head", "header", "hgroup", "hr", "html", "input", "legend", "li", "link", "listing", "main", "marquee", "menu", "menuitem",
    "meta", "nav", "ol", "optgroup", "option", "p", "plaintext", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul", "xmp",
}
# Elements without content, and those whose content is no text of the page.
EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
HIDDEN = "script|style|title|template|iframe|noscript|textarea|select"
# The same, but without an end tag only the start tag is dropped.
EMBEDDED = "svg|object|canvas|audio|video"
# Elements that end an open element of the second set when they begin.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({HIDDEN})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    # a quote opens a value only right behind the sign; elsewhere it is a character like others
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*+(?:\"[^\"]*\"|'[^']*')|[^>])*+)>"
    r"|</?[a-zA-Z]([^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in EMBEDDED.split("|")}
_NAMES = re.compile(r"(?:\s|^)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z0-9]+")


@dataclass
class Leaf:
    path: tuple[str, ...]  # tags and the words of their class, id and role, outermost first
    text: str
    linked: int  # characters inside links


def leaves(page: str) -> list[Leaf]:
    """Non-empty blocks in page order. References are decoded and runs of white space are one space.

    Missing end tags are inferred as browsers do for paragraphs, list items and table cells; a tag
    that the page ends in is dropped, and so are comments and what :data:`HIDDEN` and closed
    :data:`EMBEDDED` elements contain. A custom element stands inside a line, but its names are in
    the path of the blocks within it. As in browsers, a :data:`HIDDEN` element without an end tag
    hides the rest of the page.
    """
    out: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    path: tuple[str, ...] = ()
    linked = 0
    in_link = False
    at = 0
    unclosed: set[str] = set()  # embedded elements that have no further end tag

    def finish() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            out.append(Leaf(path, text, linked))
        pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            pieces.append(text)
            if in_link:
                linked += len(text)

    while token := _TOKEN.search(page, at):
        add(page[at : token.start()])
        at = token.end()
        name = token[3]
        if name is None:
            continue
        name = name.lower()
        if name in _END:
            if not token[2] and name not in unclosed and not (name == "svg" and token[4].endswith("/")):
                if end := _END[name].search(page, at):
                    at = end.end()
                else:
                    unclosed.add(name)
            continue
        if name in INLINE or name not in PARTING and "-" not in name:
            if name == "br":
                pieces.append("\n")
            elif name == "mtd":
                pieces.append(" ")
            elif name == "a":
                in_link = not token[2]
            continue
        if name in PARTING:
            finish()
        if token[2]:
            places = [k for k, (tag, _) in enumerate(stack) if tag == name]
            if places:
                del stack[places[-1] :]
        elif name not in EMPTY:
            if name in PARTING and stack and stack[-1][0] == "p":
                stack.pop()
            ended = ENDED_BY.get(name, ())
            while ended and stack and stack[-1][0] in ended:
                stack.pop()
            names = " ".join(a or b or c for a, b, c in _NAMES.findall(token[4])).lower() if token[4] else ""
            stack.append((name, (name, *_PART.findall(names))))
        path = tuple(part for _, parts in stack for part in parts)
    add(page[at:])
    finish()
    return out
