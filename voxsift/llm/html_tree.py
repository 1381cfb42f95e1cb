"""The elements of an HTML page as a tree, with the blocks of text that stand in them."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from typing import NamedTuple

# A tag whose quotes are closed may hold ">" in them; otherwise it ends at the first ">".
# Of the elements whose content is left out, svg alone may close itself.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg(?=[\s/>])(?:[^<>\"']*(?:\"[^\"]*\"|'[^']*'))*[^<>\"']*/>"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|title)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:[^<>\"']*(?:\"[^\"]*\"|'[^']*'))*[^<>\"']*|[^>]*)>"
    r"|<[!?/][^>]*>",
    re.IGNORECASE | re.DOTALL,
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+|[0-9]+")

# Elements that begin and end a block of text (fixed value). All others stand within a line, unknown ones too.
BLOCK = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup html legend li listing main menu nav noframes ol p plaintext"
    " pre search section summary table tbody td tfoot th thead tr ul xmp".split()
)
# Marks within a line that say nothing about what they stand in (fixed value). Other elements within a line are nodes.
MARKS = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label map mark meter nobr output picture progress q rb rp rt"
    " rtc ruby s samp slot small span strike strong sub sup time tt u var".split()
)
# Controls and media whose content is no text of the page (fixed value): left out without a break.
DROPPED = frozenset("applet audio button canvas datalist object option optgroup select textarea video".split())
# Elements without an end tag (fixed value).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that an opening tag of the same group closes (fixed value).
_CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_LISTS = frozenset(("ul", "ol", "dl", "table"))


class Node(NamedTuple):
    parent: int
    tag: str
    words: tuple[str, ...]


class Page(NamedTuple):
    nodes: list[Node]
    blocks: list[tuple[int, str, int]]  # node, text, characters of it inside links


class _Open:
    """The open elements, with how many of each name are open, also since the last list or table."""

    def __init__(self) -> None:
        self.path, self.tags = [0], ["page"]
        self.count: Counter[str] = Counter()
        self.scopes: list[Counter[str]] = [Counter()]

    def push(self, node: int, tag: str) -> None:
        self.path.append(node)
        self.tags.append(tag)
        self.count[tag] += 1
        self.scopes[-1][tag] += 1
        if tag in _LISTS:
            self.scopes.append(Counter())

    def pop(self) -> str:
        self.path.pop()
        tag = self.tags.pop()
        if tag in _LISTS:
            self.scopes.pop()
        self.count[tag] -= 1
        self.scopes[-1][tag] -= 1
        return tag


def parse(source: str) -> Page:
    """All nodes in page order, the first one standing for the page, and the blocks of text.

    A block belongs to the innermost node that holds all its text. Elements
    within a line do not break it, whether they are nodes or not. Every token is
    looked at once, and an end tag or an opening one that closes others looks only
    at elements it closes, so the work grows with the page, however deep it is.
    """
    nodes, blocks = [Node(-1, "page", ())], []
    opened, pieces, linked, in_link, dropped = _Open(), [], 0, False, ""
    depth = owner = lowest = 0  # of the text so far: length of its node's path, its node, shortest path since the last piece

    def flush() -> None:
        nonlocal linked, dropped, depth
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                blocks.append((owner, text, linked))
            pieces.clear()
        linked, dropped, depth = 0, "", 0

    def put(piece: str) -> None:
        nonlocal linked, depth, owner, lowest
        if not piece or dropped:
            return
        piece = html.unescape(piece) if "&" in piece else piece
        pieces.append(piece)
        if in_link:
            linked += len(piece)
        if not piece.isspace():
            if depth == 0 or lowest < depth:
                depth = len(opened.path) if depth == 0 else lowest
                owner = opened.path[depth - 1]
            lowest = len(opened.path)

    def close(tags: tuple[str, ...]) -> None:
        """Close the innermost element of one of these names and all within it."""
        nonlocal lowest
        while True:
            if opened.tags[-1] in BLOCK:
                flush()
            tag = opened.pop()
            lowest = min(lowest, len(opened.path))
            if tag in tags:
                return

    def names_in(rest: str) -> tuple[str, ...]:
        if "=" not in rest:
            return ()
        return tuple(dict.fromkeys(w for m in _NAMED.findall(rest) for w in _WORD.findall("".join(m).lower())))

    at = 0
    waiting: list[tuple[str, tuple[str, ...]]] = []  # open controls that no block stands in yet
    waits: Counter[str] = Counter()
    for token in _TOKEN.finditer(source):
        put(source[at:token.start()])
        at, tag = token.end(), token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in DROPPED:  # a node only if blocks stand in it
            if token["end"]:
                dropped = "" if tag == dropped else dropped
                while waits[tag]:
                    waits[waiting[-1][0]] -= 1
                    if waiting.pop()[0] == tag:
                        break
                else:
                    if opened.count[tag]:
                        close((tag,))
            elif not token["rest"].endswith("/"):
                dropped = dropped or tag
                waiting.append((tag, names_in(token["rest"])))
                waits[tag] += 1
            continue
        if tag in MARKS:
            if tag == "a":
                in_link = not token["end"]
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                pieces.append(" ")
            continue
        if tag in BLOCK:
            flush()
        if token["end"]:
            if opened.count[tag]:
                close((tag,))
            continue
        if tag in BLOCK:
            in_link = False
            if opened.tags[-1] == "p":
                close(("p",))
            closing = _CLOSED_BY.get(tag)
            if closing and any(opened.scopes[-1][name] for name in closing):
                close(closing)
            for name, words in waiting:
                nodes.append(Node(opened.path[-1], name, words))
                opened.push(len(nodes) - 1, name)
            waiting.clear()
            waits.clear()
        nodes.append(Node(opened.path[-1], tag, names_in(token["rest"])))
        if not (tag not in BLOCK and token["rest"].endswith("/")):
            opened.push(len(nodes) - 1, tag)
    put(source[at:])
    flush()
    return Page(nodes, blocks)


def features(page: Page) -> list[list[tuple[str, float]]]:
    """Per node: its tag, the words of its class, id and role, and what its own text is like."""
    length, linked, stops = [0] * len(page.nodes), [0] * len(page.nodes), [0] * len(page.nodes)
    for node, text, inside in page.blocks:
        length[node] += len(text)
        linked[node] += inside
        stops[node] += text.count(". ") + text.count(", ") + text.endswith((".", "!", "?"))
    told = []
    for n, node in enumerate(page.nodes):
        own = [("bias", 1.0), ("tag " + node.tag, 1.0), *(("word " + word, 1.0) for word in node.words)]
        if length[n]:
            own += [
                ("log length", math.log1p(length[n]) / 5), ("link share", linked[n] / length[n]),
                ("stops", min(4.0, stops[n]) / 4),
            ]
        told.append(own)
    return told
