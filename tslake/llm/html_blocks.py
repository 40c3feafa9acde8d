"""Leaf blocks of a web page: their text and the path of tags above them.

A block is the text between two block-level tags. White space inside it (a
``br`` counts as some) becomes one space, character references are decoded,
the ends are trimmed; blocks without text vanish. What is never text of the page
(scripts, styles, forms' controls, titles, comments) is left out here. A head
needs no end: what may stand in it has no text, all else is the body's.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table
    tbody td tfoot th thead tr ul""".split()
)
VOID = frozenset("area base basefont bgsound br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SILENT = frozenset("button canvas datalist iframe noframes noscript object option script select style svg template textarea title".split())
#: Among them, elements whose content is not markup.
RAW = frozenset("iframe noframes noscript script style textarea title".split())
#: Among them, elements that do not hold one of their own kind.
_FLAT = frozenset("button option select".split())
#: Elements that cannot stand in svg and end it.
_NOT_SVG = frozenset(
    """b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 hr i img li menu meta ol p pre ruby s
    small span strong strike sub sup table tt u ul var""".split()
)
#: Elements of svg that hold markup of pages.
_IN_SVG = frozenset("desc foreignobject title".split())
#: Open elements that the start of another one ends.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
#: Elements that such an end does not cross.
_FENCE = frozenset("article aside body div footer form header main nav ol section table ul dl blockquote".split())

# a quote counts right after '=' alone, and where another one ends it
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]*+))?+)*+)>", re.S)
_CLASS = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile("[a-z]+").findall
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # tags and ".word" of class, id and role, from the root
    tag: str
    linked: int  # characters inside links


def blocks(page: str) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    inner: list[str] = []  # open elements inside the silent one
    linked, links, silent, at, n = 0, 0, "", 0, len(page)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            if "&" in text:
                text = html.unescape(text)
            text = _SPACE.sub(" ", text).strip()
            if text:
                tag = next((t for t, _ in reversed(stack) if t in BLOCK), "body")
                out.append(Block(text, stack[-1][1] if stack else (), tag, min(linked, len(text))))
            parts.clear()
        linked = 0

    def close(index: int) -> None:
        nonlocal links
        if any(t in BLOCK for t, _ in stack[index:]):
            flush()
        links -= sum(t == "a" for t, _ in stack[index:])
        del stack[index:]

    def ends_parent(name: str) -> bool:
        """Whether the start of an element ends the block that a silent one stands in."""
        ends = _ENDS.get(name, ())
        if name not in BLOCK or not ends or not _FENCE.isdisjoint(inner):
            return False
        open_ = next((t for t, _ in reversed(stack) if t in ends or t in _FENCE), "")
        return open_ in ends

    while at < n:
        found = _TOKEN.search(page, at)
        text = page[at : found.start() if found else n]
        if text and not silent:
            parts.append(text)
            if links:
                linked += len(text.strip())
        if not found:
            break
        at = found.end()
        ending, name, attributes = found.groups()
        if not name:
            continue
        name = name.lower()
        if ending:
            if silent:
                if name in inner:
                    del inner[len(inner) - 1 - inner[::-1].index(name) :]
                    continue
                if name == silent:
                    silent = ""
                    continue
                if name not in BLOCK or all(t != name for t, _ in stack):
                    continue
                silent = ""  # never closed: it ends with the block it stands in
            index = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), -1)
            if index >= 0:
                close(index)
            elif name in BLOCK:
                flush()
            continue
        if silent:
            breaks_out = silent == "svg" and name in _NOT_SVG and _IN_SVG.isdisjoint(inner)
            if not breaks_out and not ends_parent(name):
                if name in RAW and not attributes.endswith("/"):
                    end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                    at = end.end() if end else at
                elif name not in VOID and not attributes.endswith("/") and not (name == silent and name in _FLAT):
                    inner.append(name)
                continue
            silent = ""
        if name == "head":
            continue
        if name in SILENT:
            if name in RAW:
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else n
            elif not attributes.endswith("/"):
                silent = name
                inner.clear()
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCK:
            ends = _ENDS.get(name, ())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or stack[i][0] in ends:
                    close(i)
                    if not ends:
                        break
                elif stack[i][0] in _FENCE:
                    break
            flush()
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            continue
        own = (name,)
        if attributes:
            own += tuple("." + w for groups in _CLASS.findall(attributes) for g in groups if g for w in _WORDS(g.lower()))
        stack.append((name, (stack[-1][1] if stack else ()) + own))
        links += name == "a"
    flush()
    return out
