"""The main text of a page by tree scoring.

Every paragraph passes points, one and more for length and commas, to its ancestors: all to its parent, half to the next,
a third to the one after, and so on, each less the share of its text that is link text. The container with most points is
kept, with those siblings that hold enough points of their own, and headings and paragraphs beside these. Parts that are no
running text by their tag (menus, scripts, footers) are left out everywhere. A form, or a part whose class says that it is
no article, is left out unless the page's article is in it: it then holds nearly all the points there are.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filefeatures.llm.arrow import slices

SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
PARAGRAPHS = frozenset("p pre td blockquote li dd div section article figcaption".split())
# Elements whose start ends an open one of these, as far as the given border.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
}
REACH = 32  # ancestors that a paragraph passes points to
HOLDERS = frozenset("td th table button caption object html".split())  # a paragraph is not ended from inside of these
NOT_TEXT = RAW | frozenset("head nav footer aside button select option datalist template noscript svg math canvas object audio video dialog menu".split())
# Words in class, id or role that tell a part which is not the article.
NOT_TEXT_WORDS = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments "
    "commentlist disqus replies respond toolbar pager pagination widget search complementary contentinfo".split()
)
# Those that say it of a single paragraph too.
ADVERT_WORDS = frozenset("ad ads adbox adsense advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr".split())
# The share of the points of its article, or of the page, from which on a part holds the article itself.
FORM_HOLDS, PART_HOLDS = 0.5, 0.8
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
TEXT_WORDS = frozenset("article articlebody content main post entry story text body".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies respond".split())

# Attribute values may hold ">"; where quotes do not match, the tag ends at the next ">".
TAG = re.compile(
    r"""<(?:!--(?:>|->|.*?(?:--!?>|\Z))|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*+(?:>|\Z))|[!?/][^>]*+(?:>|\Z))""", re.S
)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORD = re.compile(r"[a-z]+")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}


class Node:
    __slots__ = ("tag", "parent", "children", "words", "points", "total", "length", "linked", "block", "in_link", "paragraph", "out")

    def __init__(self, tag: str, parent: Node | None, words: frozenset = frozenset()):
        self.tag, self.parent, self.words = tag, parent, words
        self.children: list[Node | str] = []
        is_block = tag in BLOCKS or parent is None
        self.block: Node = self if is_block else parent.block  # the block that its text belongs to
        self.in_link: bool = not is_block and (tag == "a" or parent.in_link)
        # The innermost open paragraph that a block's start would end.
        self.paragraph: Node | None = self if tag == "p" else None if parent is None or tag in HOLDERS else parent.paragraph
        self.out = False
        self.points = self.total = 0.0  # points passed to it; points of the paragraphs below
        self.length = self.linked = 0  # code points of text below, and of that in links

    def is_text(self) -> bool:
        if self.out or self.tag in NOT_TEXT:
            return False
        if self.tag == "header":
            node = self.parent
            while node is not None and node.tag not in ("article", "main"):
                node = node.parent
            return node is not None
        if self.tag in ("html", "body", "main"):
            return True
        return not self.words & COMMENT_WORDS

    def is_doubtful(self) -> bool:
        if self.tag == "form":
            return True
        if self.tag in ("html", "body", "main", "article", "header") or self.words & TEXT_WORDS:
            return False
        return bool(self.words & (ADVERT_WORDS if self.tag == "p" else NOT_TEXT_WORDS))


def _words(attributes: str) -> frozenset:
    if "=" not in attributes:
        return frozenset()
    values = " ".join(a or b or c for _, a, b, c in ATTRIBUTE.findall(attributes))
    return frozenset(WORD.findall(values.lower()))


def decode(text: str) -> str:
    count = text.count("&")
    if not count:
        return text
    return text.replace("&amp;", "&") if text.count("&amp;") == count else html.unescape(text)


def parse(page: str) -> Node:
    """The tree of a page, with the ends that HTML lets out; never fails."""
    root = top = Node("#root", None)
    open_: Counter[str] = Counter()  # by tag, so that a stray end tag costs no search

    def go_up(to: Node) -> Node:
        node = top
        while node is not to:
            open_[node.tag] -= 1
            node = node.parent
        return to

    at = 0
    while True:
        found = TAG.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if text:
            top.children.append(decode(text))
        if not found:
            return root
        at = found.end()
        name = found[2]
        if not name:
            continue
        name = name.lower()
        if found[1]:
            if open_[name]:
                node = top
                while node.tag != name and (name in BLOCKS or node.tag not in BLOCKS):
                    node = node.parent
                if node.tag == name:
                    top = go_up(node.parent)
            continue
        if name in BLOCKS and top.paragraph is not None:
            top = go_up(top.paragraph.parent)
        if name in ENDS:
            tags, borders = ENDS[name]
            if any(open_[tag] for tag in tags):
                node = top
                while node.parent is not None and node.tag not in borders and node.tag not in tags:
                    node = node.parent
                if node.tag in tags:
                    top = go_up(node.parent)
        node = Node(name, top, _words(found[3]))
        top.children.append(node)
        if name in RAW:
            end = RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
        elif name not in VOID and not found[3].endswith("/>"):
            top = node
            open_[name] += 1


def _in_order(root: Node) -> list[Node]:
    """Elements in page order, parts that are no text left out. No recursion: pages may nest deeply."""
    found, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if node.parent is None or node.is_text():
            found.append(node)
            waiting += [c for c in reversed(node.children) if isinstance(c, Node)]
    return found


def _leave_out(nodes: list[Node]) -> bool:
    """Mark the doubtful parts that do not hold an article; whether there are any."""
    doubtful = [node for node in nodes if node.is_doubtful()]
    if not doubtful:
        return False
    articles = [node for node in nodes if node.tag in ("article", "main") and node.total]
    holds, within = set(), {}
    for node in articles:
        up = node.parent
        while up is not None and id(up) not in holds:
            holds.add(id(up))
            up = up.parent
    for node in nodes:  # the innermost article that it lies in
        within[id(node)] = node if node.tag in ("article", "main") and node.total else within.get(id(node.parent)) if node.parent else None
    for node in doubtful:
        if id(node) in holds:
            continue
        scope = within[id(node)] or (None if articles else nodes[0])
        share = FORM_HOLDS if node.tag == "form" else PART_HOLDS
        node.out = scope is None or not node.total or node.total <= share * scope.total
    return any(node.out for node in doubtful)


def _score(nodes: list[Node]) -> None:
    for node in nodes:
        node.points = node.total = 0.0
        node.length = node.linked = 0
    own: dict[int, list[int]] = {}
    for node in nodes:  # text that belongs to this element rather than to a block in it
        total = own.setdefault(id(node.block), [0, 0, 0])
        linked = node.in_link
        for child in node.children:
            if isinstance(child, str):
                length = len(child.strip())
                node.length += length
                node.linked += length * linked
                total[0] += length
                total[1] += length * linked
                total[2] += child.count(",") + child.count("、") + child.count("，")
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.length += node.length
            node.parent.linked += node.linked
    for node in nodes:
        length, linked, commas = own.get(id(node), (0, 0, 0))
        if length and node.tag in PARAGRAPHS:
            points = (1 + commas + min(length / 100, 3)) * (1 - linked / length)
            node.total += points
            up, share = node.parent, 1
            if node.tag not in ("p", "pre", "td", "blockquote", "li", "dd", "figcaption"):
                up = node  # a container with text of its own is its own paragraph
            while up is not None and share <= REACH:
                up.points += points / share
                up, share = up.parent, share + 1
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.total += node.total


def _best(nodes: list[Node]) -> Node:
    def worth(node: Node) -> float:
        return node.points * (1 - node.linked / node.length) if node.length else 0.0

    candidates = [n for n in nodes if n.tag in BLOCKS and n.tag not in ("p", "li", "html")]
    marked = [n for n in candidates if n.tag in ("article", "main") and n.length]
    best = max(candidates, key=worth, default=nodes[0])
    # An article that holds the best part, or more than any part when the page has next to no paragraphs, is whole.
    node = best
    while node is not None:
        if node.tag in ("article", "main"):
            best = node
        node = node.parent
    if best.tag in ("body", "#root") or not worth(best):
        best = max(marked, key=lambda n: (worth(n), n.length), default=best if worth(best) else next((n for n in nodes if n.tag == "body"), nodes[0]))
    return best


def _kept(best: Node, nodes: list[Node]) -> list[Node]:
    """The best container and the siblings that are worth it, in page order; with headings and paragraphs between them, and
    right before and after. Beside an article, which is whole by itself, only a heading is kept, if it has none."""
    if best.parent is None or best.tag in ("body", "html"):
        return [best]
    alive = set(map(id, nodes))
    enough = max(10.0, 0.2 * best.points)
    whole = best.tag in ("article", "main")
    siblings = [node for node in best.parent.children if node is best or (isinstance(node, Node) and id(node) in alive and node.tag in BLOCKS and node.length)]
    density = [node.linked / node.length if node.length else 0.0 for node in siblings]
    kept = [node is best or (node.points * (1 - d) >= enough and d < 0.5) for node, d in zip(siblings, density, strict=True)]
    heading = [node.tag in HEADINGS and d < 0.5 for node, d in zip(siblings, density, strict=True)]
    short = [node.tag in ("p", "pre", "blockquote") and d < 0.25 and not whole for node, d in zip(siblings, density, strict=True)]
    long = [s and node.length > 80 for s, node in zip(short, siblings, strict=True)]
    kept = [k or p for k, p in zip(kept, long, strict=True)]
    first, last = kept.index(True), len(kept) - 1 - kept[::-1].index(True)
    titled = any(node.tag in HEADINGS for node in _below(siblings[first]))
    while first and ((heading[first - 1] and not titled) or short[first - 1]):
        first -= 1
    while last + 1 < len(kept) and short[last + 1]:
        last += 1
    return [node for i, node in enumerate(siblings) if kept[i] or (first <= i <= last and (heading[i] or short[i]))]


def _below(node: Node) -> Iterator[Node]:
    waiting = [node]
    while waiting:
        node = waiting.pop()
        yield node
        waiting += [c for c in node.children if isinstance(c, Node) and c.is_text()]


def _is_menu(node: Node) -> bool:
    return node.tag in ("ul", "ol", "dl", "table", "div", "section") and node.length > 0 and node.linked >= 0.8 * node.length and _links(node) > 1


def _links(node: Node) -> int:
    count, waiting = 0, [node]
    while waiting:
        node = waiting.pop()
        count += node.tag == "a"
        waiting += [c for c in node.children if isinstance(c, Node)]
    return count


def _texts(root: Node) -> Iterator[str]:
    """The blocks below, each with white space made one blank. Where no container stands out, lists of links are menus."""
    menus = root.tag in ("body", "html", "#root")
    pieces: list[str] = []
    waiting: list[tuple[Node, int]] = [(root, 0)]
    while waiting:
        node, at = waiting.pop()
        if at == 0 and node.tag in BLOCKS:
            yield " ".join("".join(pieces).split())
            pieces = []
        while at < len(node.children):
            child = node.children[at]
            at += 1
            if isinstance(child, str):
                pieces.append(child)
            elif child.tag == "br":
                pieces.append(" ")
            elif child.is_text() and not (menus and _is_menu(child)):
                waiting += [(node, at), (child, 0)]
                break
        else:
            if node.tag in BLOCKS:
                yield " ".join("".join(pieces).split())
                pieces = []
    yield " ".join("".join(pieces).split())


def extract(page: str) -> str:
    """The main text: blocks in page order, one per line. Empty if there is none."""
    root = parse(page)
    nodes = _in_order(root)
    _score(nodes)
    if _leave_out(nodes):
        nodes = _in_order(root)
        _score(nodes)
    return "\n".join(text for node in _kept(_best(nodes), nodes) for text in _texts(node) if text)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars. NULL html gives an empty text, as does a page without any; page_id and url
    are carried along, NULL or repeated as they are. An empty table gives no rows. Other columns are not read."""

    def run(batches):
        for part in slices(batches, "html"):
            texts = [extract(page) for page in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=SCHEMA.names
            )

    columns = [pages["page_id"].cast("long"), pages["url"].cast("string"), F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html")]
    return pages.select(columns).mapInArrow(run, SCHEMA)
