"""A forgiving reader of HTML: a tree of elements, and features of its nodes.

Tags are cut by one pattern; end tags that HTML lets authors leave out are supplied. Text belongs to the nearest
element that is a node: every element but inline ones without telling attributes.
"""

from __future__ import annotations

import html
import re

import numpy as np

# Element groups of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("script style noscript template head title iframe object svg math canvas audio video select textarea button option datalist".split())
RAW = set("script style textarea title iframe noscript template".split())
IN_HEAD = set("base basefont bgsound head html link meta noframes noscript script style template title".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label map mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
# Element: (elements that its start closes, elements beyond which it doesn't look).
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
P_BOUNDS = {"td", "th", "caption", "table", "body", "html"}
# Searches for an open element: what is sought, and beyond what not. Each tag with the searches it counts for.
_SEARCHES = {"p": ({"p"}, P_BOUNDS), **CLOSES}
_COUNTS_FOR = {
    tag: [(name, tag in bounds) for name, (sought, bounds) in _SEARCHES.items() if tag in sought or tag in bounds]
    for sought, bounds in _SEARCHES.values()
    for tag in sought | bounds
}

# Words in class, id and role attributes, by what they tell.
HINTS = {
    "content": "article articlebody body content copy entry hentry main maincontent page post postbody prose richtext story text".split(),
    "menu": "breadcrumb breadcrumbs crumb links menu nav navbar navigation pager pagination tabs toc toolbar".split(),
    "header": "banner brand head header hero logo masthead top topbar".split(),
    "footer": "bottom colophon copyright credits foot footer imprint legal".split(),
    "side": "aside complementary more popular recommended recommendations related rail sidebar side teaser teasers trending widget widgets".split(),
    "advert": "ad ads adslot advert advertisement advertising adsense banner dfp promo promoted promotion sponsor sponsored".split(),
    "notice": "alert consent cookie cookies gdpr modal newsletter notice notification overlay popup privacy signup subscribe subscription toast warning".split(),
    "comments": "comment commentlist comments discussion disqus feedback replies reply respond responses reviews thread".split(),
    "share": "byline facebook follow icons like meta share sharing social tags tools twitter".split(),
    "form": "contact field form input login password register search searchbox".split(),
}
HINT_NAMES = list(HINTS)
_ADVERT = HINT_NAMES.index("advert")
_HINT_OF = {word: [i for i, n in enumerate(HINT_NAMES) if word in HINTS[n]] for words in HINTS.values() for word in words}
TAG_GROUPS = [
    {"nav", "menu"}, {"header", "hgroup"}, {"footer"}, {"aside"}, {"form", "fieldset"}, {"article"}, {"main"}, {"section"}, {"div", "center"},
    {"p", "blockquote", "pre"}, {"ul", "ol", "dl"}, {"li", "dt", "dd"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"table", "tbody", "tr", "td", "th"}, {"figure", "figcaption"},
    {"body", "html"}, {"address"}, {"h1"},
]
_TAG_GROUP = {tag: [i for i, g in enumerate(TAG_GROUPS) if tag in g] for group in TAG_GROUPS for tag in group}

# Possessive, so that what doesn't match is seen in one pass.
_TOKEN = re.compile(r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)([^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+)>", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>?")
_ATTRIBUTE = re.compile(r"""(?<![-\w:.])([a-zA-Z_:][-\w:.]*+)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Node:
    __slots__ = ("tag", "parent", "children", "depth", "hints", "hidden", "label", "chars", "link_chars", "words", "stops", "marks", "counts", "blocks", "start")

    def __init__(self, tag: str, parent: Node | None, hints: set[int], hidden: bool, label: int):
        self.tag, self.parent, self.hints, self.hidden, self.label = tag, parent, hints, hidden, label
        self.children: list[Node] = []
        self.depth = parent.depth + 1 if parent else 0
        self.chars = self.link_chars = self.words = self.stops = self.marks = self.blocks = 0
        self.counts = [0] * len(COUNTED)


COUNTED = [{"p"}, {"li"}, {"a"}, {"input", "button", "select", "textarea", "label"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"img", "iframe", "video", "figure"}, {"br"}, {"time"}]
_COUNTED = {tag: i for i, group in enumerate(COUNTED) for tag in group}


def _attributes(raw: str, labelled: bool) -> tuple[set[int], bool, int]:
    """(hints, whether hidden, label); only training pages carry labels."""
    hints, hidden, label = set(), False, -1
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        value, name = a or b or c, name.lower()
        if name in ("class", "id", "role", "itemprop"):
            for word in _WORDS.findall(value):
                hints.update(_HINT_OF.get(word.lower(), ()))
        elif name == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif name == "aria-hidden":
            hidden |= value.lower() == "true"
        elif labelled and name == "data-truth":
            label = int(value)
    return hints, hidden or bool(re.search(r"(?:^|\s)hidden(?=\s|=|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", raw), re.I)), label


class Page:
    """The nodes of a page in order, and its blocks: (node, text) of runs of text between block boundaries.

    An inline element with telling attributes is a node, for features, but ends no block: its text belongs to the block it
    stands in, unless it is hidden or an advert there. ``labelled``: read the marks of training pages.
    """

    def __init__(self, source: str, labelled: bool = False):
        self.labelled = labelled
        self.nodes = [Node("html", None, set(), False, 1)]
        self.blocks: list[tuple[int, str]] = []
        self.numbers = {id(self.nodes[0]): 0}
        self._run: list[tuple[Node, str]] = []
        self._read(source)

    def _flush(self) -> None:
        """Ends a block."""
        run, self._run = self._run, []
        i, inside = 0, []
        while i < len(run):
            k = i
            while k < len(run) and run[k][0] is run[i][0]:
                k += 1
            raw = "".join(x[1] for x in run[i:k])
            inside.append((run[i][0], raw))
            text = " ".join(raw.split())
            if text:
                node = run[i][0]
                node.blocks += 1
                node.chars += len(text)
                node.words += text.count(" ") + 1
                node.stops += text.count(". ") + text.endswith((".", "!", "?", "…"))
                node.marks += text.count(",") + text.count("©") + text.count("|")
            i = k
        owners = {id(node): node for node, raw in inside if not raw.isspace()}
        if len(owners) > 1:
            block = inside[0][0]
            while block.tag in INLINE and block.parent:
                block = block.parent
            inside = [(node, raw) for node, raw in inside if node is block or not self._left_out(node, block)]
        elif owners:
            (block,) = owners.values()
        text = " ".join("".join(raw for _, raw in inside).split())
        if text:
            self.blocks.append((self.numbers[id(block)], text))

    @staticmethod
    def _left_out(node: Node, block: Node) -> bool:
        while node is not block and node.parent:
            if node.hidden or (node.tag in INLINE and _ADVERT in node.hints):
                return True
            node = node.parent
        return False

    def _read(self, source: str) -> None:
        # The stack holds (tag, node that text goes to).
        stack: list[tuple[str, Node]] = [("html", self.nodes[0])]
        at, size, links, unseen = 0, len(source), 0, 0
        # Open elements by tag, and those each search could find before its bound: no walk over the stack finds nothing.
        opened: dict[str, int] = {}
        findable = {name: [0] for name in _SEARCHES}
        heads: list[int] = []

        def close(to: int) -> None:
            nonlocal links, unseen
            for tag, _ in reversed(stack[to:]):
                links -= tag == "a"
                unseen -= tag in UNSEEN
                opened[tag] -= 1
                if tag == "head":
                    heads.pop()
                for name, bounds in _COUNTS_FOR.get(tag, ()):
                    if bounds:
                        findable[name].pop()
                    else:
                        findable[name][-1] -= 1
                if tag not in INLINE:
                    self._flush()
            del stack[to:]

        def push(tag: str, node: Node) -> None:
            stack.append((tag, node))
            opened[tag] = opened.get(tag, 0) + 1
            if tag == "head":
                heads.append(len(stack) - 1)
            for name, bounds in _COUNTS_FOR.get(tag, ()):
                if bounds:
                    findable[name].append(0)
                else:
                    findable[name][-1] += 1

        def text(raw: str) -> None:
            if stack[-1][0] == "head" and not raw.isspace() and raw:
                close(len(stack) - 1)
            if unseen or not raw:
                return
            value = html.unescape(raw) if "&" in raw else raw
            node = stack[-1][1]
            self._run.append((node, value))
            if links:
                node.link_chars += len(value.strip())

        while at < size:
            open_at = source.find("<", at)
            if open_at < 0:
                text(source[at:])
                break
            found = _TOKEN.match(source, open_at) or _LOOSE.match(source, open_at)
            if not found:
                text(source[at : open_at + 1])
                at = open_at + 1
                continue
            text(source[at:open_at])
            at = found.end()
            if not found.group(0)[1:2].isalpha() and found.group(0)[1:2] != "/":
                continue
            tag, raw = found[2].lower(), found[3]
            if found[1]:
                if opened.get(tag):
                    close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag))
                continue
            # The end of a head may be left out: at <body>, text, or a tag that can't stand in a head.
            if tag not in IN_HEAD and heads and (tag == "body" or stack[-1][0] == "head"):
                close(heads[0])
            if tag in ("html", "body"):
                hints, hidden, label = _attributes(raw, self.labelled)
                stack[0][1].hints |= hints
                continue
            search = "p" if tag in CLOSES_P else tag if tag in CLOSES else None
            if search and findable[search][-1]:
                sought, bounds = _SEARCHES[search]
                lowest, i = None, len(stack) - 1
                left = 1 if search == "p" else findable[search][-1]
                while left:
                    if stack[i][0] in sought:
                        lowest, left = i, left - 1
                    i -= 1
                close(lowest)
            here = stack[-1][1]
            if tag in _COUNTED and not unseen:
                here.counts[_COUNTED[tag]] += 1
            if tag == "br":
                text(" ")
            if tag not in INLINE and not unseen:
                self._flush()
            if tag in VOID:
                continue
            node = here
            if not unseen and tag not in UNSEEN:
                hints, hidden, label = _attributes(raw, self.labelled) if raw.strip(" /") else (set(), False, -1)
                if tag not in INLINE or hidden or (hints and tag != "a" and min(hints) > 0):
                    node = Node(tag, here, hints, hidden, label)
                    here.children.append(node)
                    self.numbers[id(node)] = len(self.nodes)
                    self.nodes.append(node)
            push(tag, node)
            links += tag == "a"
            unseen += tag in UNSEEN
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
                at = end.start() if end else size
        close(1)
        self._flush()


#: Groups of elements that also tell of what is inside them: up to main, then lists and tables.
ABOVE = [0, 1, 2, 3, 4, 5, 6, 10, 13]
N_FEATURES = 17 + len(COUNTED) + len(TAG_GROUPS) + len(ABOVE) + 3 * len(HINT_NAMES) + 1


def features(page: Page) -> np.ndarray:
    """A row for each node: what its subtree holds, its tag, its attributes' words and its ancestors', its siblings."""
    nodes = page.nodes
    own = np.array([[n.chars, n.link_chars, n.words, n.stops, n.marks, n.blocks, 1, *n.counts] for n in nodes], float)
    total = own.copy()
    parents = np.array([page.numbers[id(n.parent)] if n.parent else 0 for n in nodes])
    for i in range(len(nodes) - 1, 0, -1):  # children come after their parents
        total[parents[i]] += total[i]
    chars, links, words, stops, marks, blocks, size = total[:, :7].T
    out = np.zeros((len(nodes), N_FEATURES))
    up = np.zeros((len(nodes), len(HINT_NAMES)))
    mine = np.zeros((len(nodes), len(HINT_NAMES)))
    hidden = np.zeros(len(nodes))
    position, many, alike, before = (np.zeros(len(nodes)) for _ in range(4))
    for i, n in enumerate(nodes):
        mine[i, list(n.hints)] = 1
        hidden[i] = n.hidden
        if i:
            up[i] = np.maximum(up[parents[i]], mine[parents[i]])
            hidden[i] = max(hidden[i], hidden[parents[i]])
        kids = n.children
        if kids:
            same: dict[str, int] = {}
            for k in kids:
                same[k.tag] = same.get(k.tag, 0) + 1
            for j, k in enumerate(kids):
                c = page.numbers[id(k)]
                position[c], many[c], alike[c] = j / len(kids), len(kids), same[k.tag] / len(kids)
                before[c] = total[page.numbers[id(kids[j - 1])], 0] if j else 0
    whole = max(chars[0], 1.0)
    at_parent = np.maximum(chars[parents], 1.0)
    columns = [
        np.log1p(chars), np.log1p(words), links / np.maximum(chars, 1), chars / size, words / np.maximum(blocks, 1), stops / np.maximum(blocks, 1),
        marks / np.maximum(words, 1), np.log1p(blocks), np.log1p(size), np.array([n.depth for n in nodes], float), chars / whole, chars / at_parent,
        position, np.log1p(many), alike, np.log1p(before), np.log1p(own[:, 0]),
    ]
    out[:, : len(columns)] = np.stack(columns, 1)
    at = len(columns)
    out[:, at : at + len(COUNTED)] = total[:, 7:] / np.maximum(blocks, 1)[:, None]
    at += len(COUNTED)
    for i, n in enumerate(nodes):
        for g in _TAG_GROUP.get(n.tag, ()):
            out[i, at + g] = 1
    tags = out[:, at : at + len(TAG_GROUPS)][:, ABOVE]
    at += len(TAG_GROUPS)
    above = out[:, at : at + len(ABOVE)]
    for i in range(1, len(nodes)):
        above[i] = np.maximum(above[parents[i]], tags[parents[i]])
    at += len(ABOVE)
    out[:, at : at + len(HINT_NAMES)] = mine
    out[:, at + len(HINT_NAMES) : at + 2 * len(HINT_NAMES)] = up
    below = mine.copy()
    for i in range(len(nodes) - 1, 0, -1):
        below[parents[i]] = np.maximum(below[parents[i]], below[i])
    out[:, at + 2 * len(HINT_NAMES) : at + 3 * len(HINT_NAMES)] = below
    out[:, -1] = hidden
    return out


def decode(page: Page, odds: np.ndarray) -> np.ndarray:
    """Which nodes are content, so that one is only if its parent is, with the largest sum of log odds.

    A node counts as often as blocks stand in its subtree, so what is known of a container weighs as much as what is
    known of all in it.
    """
    nodes = page.nodes
    parents = [page.numbers[id(n.parent)] if n.parent else 0 for n in nodes]
    blocks = np.array([n.blocks for n in nodes], float)
    for i in range(len(nodes) - 1, 0, -1):
        blocks[parents[i]] += blocks[i]
    gain = odds * blocks
    for i in range(len(nodes) - 1, 0, -1):
        gain[parents[i]] += max(gain[i], 0.0)
    content = np.zeros(len(nodes), bool)
    content[0] = True
    for i in range(1, len(nodes)):
        content[i] = content[parents[i]] and gain[i] > 0
    return content
