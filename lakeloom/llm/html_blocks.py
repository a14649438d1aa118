"""HTML to a sequence of leaf blocks: text runs between block-level tags, each with its tag path."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

TOKEN = re.compile(r"""<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)(?:>|[^>]*(?:>|\Z))|<[!?/][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|aria-label|data-role|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
PART = re.compile(r"[a-z]+|\d+")
#: Drawings and formulas, which may stand within a line; their tags may close themselves.
FOREIGN = frozenset("""canvas svg g defs desc path circle ellipse line polygon polyline rect use symbol image text tspan textpath clippath mask pattern marker filter stop lineargradient
radialgradient foreignobject math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover munderover mmultiscripts menclose
mtable mtr mlabeledtr mtd semantics annotation annotation-xml""".split())
#: Tags that do not end a block.
INLINE = FOREIGN | frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Tags without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no tags and whose content is never text of the page. All others are read as blocks, for the labeller to judge.
RAW = frozenset("script style textarea".split())
#: An opening tag that ends an open element of these names before it.
ENDS = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
#: Closing them all with an open paragraph: block-level tags.
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}


@dataclass(slots=True)
class Block:
    text: str
    path: tuple[str, ...]  # of every open element, outermost first: its name and the words of its class, id and role
    depth: int
    linked: int  # characters inside links
    at: int  # where its text begins in the source


def path_words(name: str, attributes: str) -> tuple[str, ...]:
    out = [name]
    if attributes:
        for key, a, b, c in ATTRIBUTE.findall(attributes):
            if key.lower() == "hidden":
                out.append("+hidden")
            out += ["." + w for w in PART.findall((a or b or c).lower())[:12]]
    return tuple(out)


def blocks(source: str) -> list[Block]:
    """The page's blocks in order. Character references are decoded, white space is one space, ends are trimmed; blocks without text are left out. Any input is read as far as it goes; unclosed elements end where the page does."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, links, at, n, begin = 0, 0, 0, len(source), 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, tuple(w for _, ws in stack for w in ws), len(stack), linked, begin))
            parts.clear()
        linked = 0

    while at < n:
        m = TOKEN.search(source, at)
        if m is None:
            begin = begin if parts else at
            parts.append(source[at:])
            linked += (n - at) * (links > 0)
            break
        if m.start() > at:
            begin = begin if parts else at
            parts.append(source[at : m.start()])
            linked += (m.start() - at) * (links > 0)
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if name not in INLINE:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    links -= sum(x[0] == "a" for x in stack[k:])
                    del stack[k:]
                    break
            continue
        if name == "br":
            parts.append("\n")
            continue
        if name in RAW:
            if not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(source, at)
                at = end.end() if end else n
            flush()
            continue
        if name in VOID:
            if name not in INLINE:
                flush()
            continue
        if name not in INLINE:
            flush()
            closes, stops = ENDS.get(name, {"p"}), STOPS.get(name, ())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in stops:
                    break
                if stack[k][0] in closes:
                    links -= sum(x[0] == "a" for x in stack[k:])
                    del stack[k:]
                    if name != "li":
                        break
                elif stack[k][0] not in INLINE and stack[k][0] not in ENDS:
                    break
        if m[3].rstrip().endswith("/") and (name not in INLINE or name in FOREIGN):
            continue
        stack.append((name, path_words(name, m[3])))
        links += name == "a"
        if name == "title":  # holds no tags
            end = re.compile(r"</title\b[^>]*>?", re.I).search(source, at)
            begin = at
            parts.append(source[at : end.start() if end else n])
            flush()
            stack.pop()
            at = end.end() if end else n
    flush()
    return out
