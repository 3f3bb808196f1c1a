"""Main text of web pages by a minimum cut.

A page becomes a row of text blocks. Costs from markup, length, links and punctuation say how much a
block looks like content or like boilerplate; they are the capacities to the two terminals. Blocks that
follow each other, or that stand under one parent, are tied by edges that are the stronger the
nearer they are in the tree. The minimum cut is the cheapest labelling of all blocks together.
"""

from __future__ import annotations

import html
import re
from collections import deque
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import map_texts

# A tag whose quoted values may hold ">"; one that ends at the next ">" whatever the quotes; what is no element.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>", re.S)
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_COMMENT_END = re.compile(r"--!?>")
# So many tags may run to the end of the page without finding theirs before quotes are not looked at any more.
_QUOTE_FAILURES = 4
# One attribute after the other; a quoted value is taken whole, one without an end up to the end.
_ATTR = re.compile(r"""([^\s=/]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']\S*)|["'].*))?""", re.S)

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
RAW = frozenset("script style textarea title xmp noscript iframe noframes".split())
UNSEEN = frozenset("head template svg math object canvas audio video select datalist button script style "
                   "textarea title xmp noscript iframe noframes".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre "
                   "section summary table tbody td tfoot th thead tr ul".split())
ENDS = {  # an opening tag ends these if they are open, up to the fences
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
}
FENCES = frozenset("ul ol menu dl table article section main aside nav header footer form body div".split())
BAD_TAGS = frozenset("nav footer aside form menu dialog".split())
GOOD_TAGS = frozenset(["article", "main"])
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
BAD_NAME = re.compile(
    r"(?:^|[-_])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner|sidebar|side|rail|widget\w*|menu\w*|nav|navbar|navigation|"
    r"breadcrumbs?|footer|footnav|masthead|comments?|commentlist|disqus|respond|repl(?:y|ies)|discussion|reactions?|"
    r"cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|newsletter|subscri\w*|sign-?up|login|"
    r"shar(?:e|ing)|social|related|recommend\w*|pagination|pager|toolbar|copyright|legal|skip)(?:$|[-_])")
COMMENT_NAME = re.compile(r"^(?:comments?|commentlist|repl(?:y|ies)|reactions?)(?:$|[-_](?:\d|body|item|content|text|list|thread|entry))")
HEADER_NAME = re.compile(r"(?:^|[-_])(?:site-?header|page-?header|top-?bar|header)(?:$|[-_])")
GOOD_NAME = re.compile(r"(?:^|[-_])(?:article|articlebody|post|entry|story|content|main)(?:$|[-_])")
# Names that say what a box has, lacks, holds or is filed under, not what it is.
OTHER_NAME = re.compile(
    r"^(?:has|no|not|with|without|category|cat|tag|tags|type|format|status|js|is|u)[-_]"
    r"|[-_](?:open|opened|closed|enabled|disabled|wrap|wrapper|wrapping|container|layout|holder|outer|inner|grid|row)$")
HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
COMMENTS_TITLE = re.compile(
    r"(?:\d+\s+)?(?:reader |user )?(?:comments?|responses?|replies|discussion|leave a (?:reply|comment)|join the discussion)"
    r"(?:\s*\(\d+\))?\s*[:.]?", re.I)

# What a box that is named for boilerplate costs the blocks in it; every step down to the block lessens it.
STRONG = 12.0
FADING = 0.95
# Steps in the tree that count between neighbours.
FAR = 64


class Node:
    __slots__ = ("tag", "parent", "box", "depth", "bad", "named", "header", "good", "cost", "unseen", "held", "holds")

    def __init__(self, tag: str, parent: "Node | None", attrs: str):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.box = self if parent is None or tag in BLOCKS else parent.box
        # of its own; what is handed down is settled at the end of the page
        self.good = tag in GOOD_TAGS
        self.bad = tag in BAD_TAGS
        self.named = tag == "form"  # bad by name or as a form: not where it is the frame of the page
        self.header = tag == "header"
        self.cost = 0.0
        self.unseen = bool(parent and parent.unseen) or tag in UNSEEN
        self.held, self.holds = 0, set()  # characters in it; whether it has an article or a main part
        if attrs and not self.unseen:
            seen = set()
            for name, *values in _ATTR.findall(attrs):
                name = name.lower()
                if name not in seen:  # of equal names the first counts
                    seen.add(name)
                    self._mark(name, "".join(values).lower())

    def _mark(self, name: str, value: str) -> None:
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and HIDING.search(value)):
            self.unseen = True
        elif name == "role":
            self.bad |= value in BAD_ROLES
            self.good |= value in ("main", "article")
        elif name == "itemprop":
            self.good |= value == "articlebody"
            self.bad |= value == "comment"
        elif name in ("class", "id") and self.tag not in ("html", "body"):
            for said in value.split():
                if OTHER_NAME.search(said):
                    continue
                if self.tag in GOOD_TAGS:
                    self.bad |= COMMENT_NAME.search(said) is not None
                elif BAD_NAME.search(said):
                    self.named = self.named or not self.bad
                    self.bad = True
                elif HEADER_NAME.search(said):
                    self.header = True
                elif GOOD_NAME.search(said):
                    self.good = True


@dataclass
class Block:
    node: Node
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def blocks(page: str) -> list[Block]:
    """Text blocks in page order, without unseen elements; unclosed and stray tags are put up with.

    The time grows with the length of the page, also for broken markup: what was looked for to the end of the
    page in vain is not looked for again.
    """
    root = Node("#", None, "")
    nodes, here, links, found, now, at, end = [root], root, 0, [], None, 0, len(page)
    last_end, data_ends, failures = page.rfind(">"), True, 0
    opened: dict[str, int] = {}

    def say(raw: str) -> None:
        nonlocal now
        if here.unseen or not raw:
            return
        if now is None:
            now = Block(here.box)
            found.append(now)
        said = html.unescape(raw) if "&" in raw else raw
        now.parts.append(said)
        if links:
            now.linked += len(said.strip())

    def close(names) -> None:
        """Ends the nearest open element of these names, and what is open inside it."""
        nonlocal here, links
        if not any(map(opened.get, names)):
            return
        node = here
        while node.tag not in names:
            node = node.parent
        while here is not node.parent:
            links -= here.tag == "a"
            opened[here.tag] -= 1
            here = here.parent

    def open_inside(names) -> bool:
        if not any(map(opened.get, names)):
            return False
        node = here
        while node.parent and node.tag not in FENCES:
            if node.tag in names:
                return True
            node = node.parent
        return False

    while at < end:
        start = page.find("<", at)
        if start < 0:
            say(page[at:])
            break
        say(page[at:start])
        sign = page[start + 1:start + 2]
        if sign == "!" or sign == "?":
            if page.startswith("<!--", start):
                stop = _COMMENT_END.search(page, start + 2)
                at = stop.end() if stop else end
                continue
            if data_ends and page.startswith("<![CDATA[", start):
                stop = page.find("]]>", start)
                data_ends = stop >= 0
                if data_ends:
                    at = stop + 3
                    continue
            if start < last_end:
                at = page.find(">", start) + 1
                continue
        token = None
        if start < last_end and (sign.isalpha() or sign == "/"):
            token = _TAG.match(page, start) if failures < _QUOTE_FAILURES else None
            if token is None:
                token = _LOOSE_TAG.match(page, start)
                failures += token is not None
        if token is None:  # a bare "<"
            say("<")
            at = start + 1
            continue
        at = token.end()
        closes, tag, attrs = token[1], token[2].lower(), token[3]
        if tag in BLOCKS:
            now = None
        if closes:
            close((tag,))
            continue
        if tag == "br":
            say(" ")
        if tag in VOID:
            continue
        if tag in BLOCKS and open_inside(("p",)):
            close(("p",))
        if tag in ENDS and open_inside(ENDS[tag]):
            close(ENDS[tag])
        if tag in RAW:
            stop = re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
            at = stop.start() if stop else end
        if tag == "body":  # ends a head that was left open
            close(("head",))
        if attrs.rstrip().endswith("/") and tag in ("svg", "path"):
            continue
        here = Node(tag, here, attrs)
        nodes.append(here)
        opened[tag] = opened.get(tag, 0) + 1
        links += tag == "a"
    for b in found:
        b.text = " ".join("".join(b.parts).split())
    found = [b for b in found if b.text]
    _settle(nodes, found)
    return found


def _settle(nodes: list[Node], found: list[Block]) -> None:
    """What is known only at the end of the page: which boxes frame the content, and which hold reader comments.

    A box that is bad by its name, or a form, is no boilerplate if it holds the main part, or an article and over
    half of the page's text. A box whose first words are a title for comments is bad.
    """
    titled = set()
    for b in found:
        b.node.held += len(b.text)
        parent = b.node.parent
        if parent is not None and parent not in titled:
            titled.add(parent)
            if b.node.tag in HEADINGS and parent.tag in ("section", "div") and COMMENTS_TITLE.fullmatch(b.text):
                parent.bad, parent.named = True, False
    for node in reversed(nodes):
        if node.tag in GOOD_TAGS:
            node.holds.add(node.tag)
        if node.parent is not None:
            node.parent.held += node.held
            node.parent.holds |= node.holds
    for node in nodes[1:]:  # parents come before what is in them
        frame = "main" in node.holds or ("article" in node.holds and 2 * node.held > nodes[0].held)
        if node.named and frame:
            node.bad = False
        # an article or main part has a header of its own
        if node.header and not (node.good or node.parent.good or frame):
            node.bad = True
        node.good = (node.good or node.parent.good) and not node.bad
        node.cost = max(STRONG if node.bad else 0.0, FADING * node.parent.cost)


def leaning(block: Block) -> float:
    """Above 0 for content, below for boilerplate."""
    node, text = block.node, block.text
    score = -1.0 + min(text.count(" ") / 10, 3.0) + min(sum(map(text.count, ".!?,;")) * 0.3, 1.5)
    score += {"p": 1.0, "pre": 1.0, "blockquote": 1.0, "li": -0.3, "td": -0.3}.get(node.tag, 0.0)
    score -= 4.0 * min(1.0, block.linked / len(text))
    if node.good:
        score += 4.0
    return score - node.cost


def distance(a: Node, b: Node) -> int:
    """Steps between two nodes of the tree, no more than FAR."""
    steps = 0
    while a is not b and steps < FAR:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def ties(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between blocks that follow each other, and between the nearest ones under one parent."""
    edges, last = [], {}
    for i, block in enumerate(found):
        parent = block.node.parent or block.node
        if i:
            edges.append((i - 1, i, 1.0 / (1 + distance(found[i - 1].node, block.node))))
        before = last.get(parent)
        if before is not None and before < i - 1:
            edges.append((before, i, 0.25))
        last[parent] = i
    return edges


def cut(leanings: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """For each block whether it is on the content side of the minimum cut, by maximum flow in levels."""
    n = len(leanings)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, forth: float, back: float) -> None:
        heads[a].append(len(to))
        to.append(b)
        room.append(forth)
        heads[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, x in enumerate(leanings):
        if x > 0:
            join(source, i, x, 0.0)
        elif x < 0:
            join(i, sink, -x, 0.0)
    for a, b, w in edges:
        join(a, b, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in heads[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        following, path, a = [0] * (n + 2), [], source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                full = next(i for i, e in enumerate(path) if room[e] <= tiny)
                a = to[path[full] ^ 1]
                del path[full:]
                continue
            while following[a] < len(heads[a]):
                e = heads[a][following[a]]
                if room[e] > tiny and level[to[e]] == level[a] + 1:
                    path.append(e)
                    a = to[e]
                    break
                following[a] += 1
            else:
                if not path:
                    break
                level[a] = -1
                a = to[path.pop() ^ 1]
                following[a] += 1


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    inside = cut([leaning(b) for b in found], ties(found))
    return "\n".join(b.text for b, yes in zip(found, inside) if yes)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row: the main text of the whole page.

    Character references are decoded, white space in a block becomes one space, blocks are joined by a
    line feed. A null or empty page, and one without content, has an empty text. Repeated rows each get
    a row; other columns are not read.
    """
    rows = pages.select(F.struct(F.col(page_id).alias("page_id"), F.col(url).alias("url")).alias("row"),
                        F.col(page).alias("html"))
    texts = map_texts(rows, "row", "html", lambda got: [[main_text(x) for x in got]], "text string")
    return texts.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))
