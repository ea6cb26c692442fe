"""The leaf blocks of an HTML page: text between block tags, with its path of open tags."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

# Elements within a line of text; every other tag ends a block. Fixed values of HTML.
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br".split()
)
# Formulas are read within their line.
MATH = frozenset(
    "math maction merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms "
    "mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
INLINE |= MATH
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# What holds no text for readers, up to its end tag.
UNREAD = frozenset("script style noscript template iframe".split())
# The same; without an end tag before the next of their kind, the tag alone.
DRAWN = frozenset("svg object annotation-xml annotation".split())

_OPENS = re.compile(r"(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)")
_COMMENT_END = re.compile(r"--!?>")
# An attribute, and what stands before it. A quote only counts where a value begins.
_PAIR = re.compile(r"""[\s/]*(?:[^\s/>][^\s/>=]*(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)?)?)?""")
_NEXT: dict[str, re.Pattern] = {
    tag: re.compile(rf"<(?P<close>/?){tag}(?=[\s/>])(?P<rest>[^>]*>)?", re.I) for tag in DRAWN
}
_END: dict[str, re.Pattern] = {
    tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in UNREAD
}

_ATTRIBUTE = re.compile(
    r"\b(?P<name>class|id|role|itemprop|hidden|style)\b(?:\s*=\s*(?:\"(?P<a>[^\"]*)\"|'(?P<b>[^']*)'|(?P<c>[^\s>]+)))?",
    re.I,
)
_NAME = re.compile(r"[a-z]+|[0-9]+")
_CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
    "nav ol p pre section table ul".split()
)
_CLOSES_ALIKE = frozenset("li dt dd tr td th option".split())


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # tags and names of their class, id and role, outermost first
    linked: int = 0  # characters inside links
    depth: int = 0
    items: list[str] = field(default_factory=list)


def names(attributes: str) -> list[str]:
    out = []
    for m in _ATTRIBUTE.finditer(attributes):
        kind = m["name"].lower()
        value = (m["a"] or m["b"] or m["c"] or "").lower()
        if kind == "hidden" or kind == "style" and "none" in value.replace("display:", "display: ").split():
            out.append("@hidden")
        elif kind != "style":
            out += ["@" + x for x in _NAME.findall(value)]
    return out


def _tag_end(page: str, at: int) -> int:
    """Past the ">" of the tag whose name ends at ``at``; -1 if the page ends before."""
    while at < len(page):
        if page[at] == ">":
            return at + 1
        past = _PAIR.match(page, at).end()
        if past == at:
            return -1
        at = past
    return -1


def _tokens(page: str) -> Iterator[tuple[str | None, bool, str, str]]:
    """(text, False, "", "") or (None, is an end tag, its name, its attributes), in page order.

    One walk from left to right: no character is looked at for every "<" before it. A tag that
    the page cuts off ends at the next "<".
    """
    at, size = 0, len(page)
    last_end = page.rfind(">")
    walked_out = False  # a tag's quotes have swallowed the page's end: others are read without
    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at:
            yield page[at:start], False, "", ""
            at = start
            continue
        if page.startswith("<!--", at):
            end = _COMMENT_END.search(page, at + 2)
            at = end.end() if end else size
            continue
        if page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            at = end + 1 if end >= 0 else size
            continue
        opened = _OPENS.match(page, at + 1)
        if not opened:
            yield "<", False, "", ""
            at += 1
            continue
        end = -1
        if at < last_end and not walked_out:
            end = _tag_end(page, opened.end())
            walked_out = end < 0
        if end < 0:
            following = page.find("<", opened.end())
            following = size if following < 0 else following
            plain = page.find(">", opened.end(), following)
            if plain < 0:
                at = following
                continue
            end = plain + 1
        tag, close = opened["tag"].lower(), bool(opened["close"])
        attributes = page[opened.end():end - 1]
        at = end
        if tag in DRAWN:
            if not close and not attributes.endswith("/"):
                other = _NEXT[tag].search(page, at)
                if other and other["close"] and other["rest"]:
                    at = other.end()
            continue
        if tag in UNREAD and not close:
            end_tag = _END[tag].search(page, at)
            at = end_tag.end() if end_tag else size
            continue
        yield None, close, tag, attributes


def blocks(page: str | None) -> list[Block]:
    """The blocks with text, in page order; character references decoded, runs of white
    space one space. Unclosed and stray tags are borne; an empty page has no block."""
    out: list[Block] = []
    stack: list[tuple[str, list[str]]] = []
    parts: list[str] = []
    path: tuple[str, ...] = ()
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, path, min(linked, len(text)), len(stack)))
            parts.clear()
        linked = 0

    for text, close, tag, attributes in _tokens(page or ""):
        if text is not None:
            if not parts or not path:
                path = tuple(x for tag, extra in stack for x in (tag, *extra))
            parts.append(text)
            if links:
                linked += len(text)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if close:
            if tag == "a":
                links = max(0, links - 1)
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == tag:
                    # An inline end tag doesn't close the blocks around it.
                    if tag in INLINE and any(t not in INLINE for t, _ in stack[at + 1:]):
                        del stack[at]
                    else:
                        del stack[at:]
                    break
            continue
        if tag in VOID or tag in MATH and attributes.endswith("/"):
            continue
        if tag in _CLOSES_PARAGRAPH:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == "p":
                    del stack[at:]
                    break
                if stack[at][0] not in INLINE:
                    break
        elif tag in _CLOSES_ALIKE and stack and stack[-1][0] == tag:
            stack.pop()
        if tag == "a":
            links += 1
        stack.append((tag, names(attributes) if "=" in attributes or "hidden" in attributes.lower() else []))
    flush()
    return out
