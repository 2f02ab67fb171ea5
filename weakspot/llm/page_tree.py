"""Pages as trees: block elements and the runs of text in them, with hashed features.

A small forgiving reader of markup.  Elements that break lines become nodes, each run
of text between two breaks becomes a leaf; inline elements belong to their run and
are no nodes.  Elements whose text isn't part of what one reads (scripts, styles,
heads, controls of forms) are left out with all that they hold.  End tags that were
left out are implied as far as it matters here: paragraphs, list items, cells.
Unclosed comments and tags reach to the end of the page.
"""

from __future__ import annotations

import html as references
import re
import zlib
from collections import Counter
from functools import lru_cache

DIM = 1 << 14

# fixed values: elements of HTML by how they are laid out
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
UNREAD = frozenset(
    "audio button canvas datalist head iframe noembed noframes noscript object script select style svg template textarea "
    "title video xmp".split()
)
VERBATIM = frozenset("iframe noembed noframes script style textarea title xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD_ONLY = frozenset("base link meta noscript script style template title".split())
KEEP_PARAGRAPH = frozenset("body caption html legend tbody td tfoot th thead tr".split())
CELLS = frozenset("caption table tbody td tfoot th thead tr".split())
#: an opening element ends the nearest open one of these, unless one of those stands between
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"}), "thead": ({"tbody"}, {"table"}),
}
EDGES = {name: k for k, name in enumerate(["#text", "#other", *sorted(BLOCKS)])}

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)>"""
    r"|<(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*\Z",
    re.S,
)
NAMES = re.compile(r"""(?i)(?:^|[\s"'])(class|id|role|data-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
HIDDEN = re.compile(r"""(?i)\bdisplay\s*:\s*none|(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true""")
PIECE = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+|[^\W\d_a-zA-Z]+")


@lru_cache(maxsize=1 << 16)
def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % DIM


@lru_cache(maxsize=1 << 14)
def named(attributes: str) -> tuple[tuple[str, ...], int | None]:
    """Features of what an element is called, and the label that a page for training gives it."""
    found, label = set(), None
    for kind, *values in NAMES.findall(attributes):
        value = "".join(values)
        if kind.lower() == "data-label":
            label = int(value)
            continue
        for word in PIECE.findall(value):
            word = word.lower()
            found |= {f"name={word}", f"stem={word[:4]}"}
    if HIDDEN.search(attributes):
        found.add("hidden")
    return tuple(sorted(found)), label


class Page:
    """Nodes of one page, parents before their children.

    Per node: parent (-1 for the first), tag ("#text" for a leaf), names (features of
    class, id and role), text and characters within links (of leaves), label or None.
    """

    def __init__(self, source: str | None):
        self.parent: list[int] = [-1]
        self.tag: list[str] = ["#page"]
        self.names: list[tuple[str, ...]] = [()]
        self.text: list[str] = [""]
        self.linked: list[int] = [0]
        self.label: list[int | None] = [None]
        self.open: list[tuple[str, int | None]] = []  # node, or None for inline elements
        self.counts: Counter = Counter()
        self.pieces: list[tuple[str, bool]] = []
        self.inline: set[str] = set()
        self.node = 0
        self.read(source or "")
        self.flush()

    def flush(self) -> None:
        """What was gathered since the last break is one run of text."""
        if self.pieces:
            text = " ".join("".join(piece for piece, _ in self.pieces).split())
            if text:
                linked = sum(len("".join(piece.split())) for piece, link in self.pieces if link)
                self.add("#text", tuple(sorted(self.inline)), None, text, linked)
            self.pieces, self.inline = [], set()

    def add(self, tag: str, names: tuple[str, ...], label: int | None, text: str = "", linked: int = 0) -> int:
        self.parent.append(self.node)
        self.tag.append(tag)
        self.names.append(names)
        self.text.append(text)
        self.linked.append(linked)
        self.label.append(label)
        return len(self.parent) - 1

    def read(self, source: str) -> None:
        at = 0
        while at < len(source):
            match = TOKEN.search(source, at)
            end = match.start() if match else len(source)
            if end > at:
                self.characters(source[at:end])
            if not match:
                return
            at, name = match.end(), match[2]
            if name is None:
                continue
            name = name.lower()
            if match[1]:
                self.end(name)
            elif name in VERBATIM:
                closing = re.compile(rf"(?i)</{name}(?=[\s/>])[^>]*(?:>|\Z)").search(source, at)
                at = closing.end() if closing else len(source)
            else:
                self.start(name, match[3])

    def characters(self, text: str) -> None:
        if self.counts["head"] and text.strip():
            self.close(self.last("head"))
        if any(self.counts[name] for name in self.unread):
            return
        self.pieces.append((references.unescape(text) if "&" in text else text, self.counts["a"] > 0))

    @property
    def unread(self) -> list[str]:
        return [name for name in self.counts if name in UNREAD]

    def last(self, *names: str) -> int:
        return max(k for k, (name, _) in enumerate(self.open) if name in names)

    def close(self, depth: int) -> None:
        """Close the open elements from that depth on."""
        for name, node in reversed(self.open[depth:]):
            self.counts[name] -= 1
            if not self.counts[name]:
                del self.counts[name]
            if node is not None:
                self.flush()
                self.node = self.parent[node]
        del self.open[depth:]

    def start(self, name: str, attributes: str) -> None:
        if self.counts["head"] and name not in HEAD_ONLY and name != "head":
            self.close(self.last("head"))
        if name in BLOCKS:
            self.flush()
            if self.counts["p"] and name not in KEEP_PARAGRAPH:
                self.close_nearest({"p"}, {"table", "td", "th", "caption"})
            if name in ENDS:
                self.close_nearest(*ENDS[name])
            names, label = named(attributes)
            node = self.add(name, names, label)
            if name not in VOID:
                self.push(name, node)
                self.node = node
        elif name == "br":
            self.pieces.append((" ", False))
        elif name not in VOID:
            self.push(name, None)
            self.inline.update(named(attributes)[0])

    def push(self, name: str, node: int | None) -> None:
        self.open.append((name, node))
        self.counts[name] += 1

    def close_nearest(self, wanted: set[str], barriers: set[str]) -> None:
        if not any(self.counts[name] for name in wanted):
            return
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.open[depth][0]
            if name in wanted:
                return self.close(depth)
            if name in barriers:
                return

    def end(self, name: str) -> None:
        if not self.counts[name]:
            if name in BLOCKS:
                self.flush()
            return
        if name in BLOCKS or name in UNREAD:
            barriers = set() if name in CELLS or name in UNREAD else {"table", "td", "th", "caption"}
            return self.close_nearest({name}, barriers)
        # an inline element ends within its block
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][1] is not None:
                return
            if self.open[depth][0] == name:
                return self.close(depth)

    def edges(self) -> list[int]:
        """Kind of the edge from each node's parent to it."""
        return [EDGES.get(tag, EDGES["#other"]) for tag in self.tag]

    def features(self) -> list[list[int]]:
        """Hashed features of each node."""
        n = len(self.parent)
        chars, linked, leaves, stops = [len(t) for t in self.text], list(self.linked), [t > "" for t in self.text], [0] * n
        for k in range(n):
            stops[k] = sum(map(self.text[k].count, ".,;:!?"))
        for k in range(n - 1, 0, -1):
            up = self.parent[k]
            chars[up] += chars[k]
            linked[up] += linked[k]
            leaves[up] += leaves[k]
            stops[up] += stops[k]
        whole, result = max(1, chars[0]), []
        for k, tag in enumerate(self.tag):
            up = self.tag[self.parent[k]] if k else ""
            length, share = chars[k].bit_length(), 0 if not chars[k] else -(-4 * min(linked[k], chars[k]) // chars[k])
            kind = "leaf" if tag == "#text" else "block"
            of_page, prose = 4 * chars[k] // whole, min(4, 40 * stops[k] // max(1, chars[k]))
            found = [
                "bias", f"{kind}", f"tag={tag}", f"up={up}/{tag}", f"{kind} length={length}", f"{kind} links={share}",
                f"{kind} length, links={min(length, 8)},{share}", f"{kind} of page={of_page}", f"{kind} prose={prose}",
                f"{kind} leaves={leaves[k].bit_length()}",
            ]
            if kind == "leaf":
                text = self.text[k]
                found.append(f"ends={text[-1] in '.!?:;…»”\"'}")
                if "©" in text or "copyright" in text.lower():
                    found.append("rights")
            found.extend(f"{kind} {name}" for name in self.names[k])
            result.append([bucket(f) for f in found])
        return result
