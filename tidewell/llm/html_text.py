"""Main text of web pages by composite text density.

Each page becomes a tree. A node's density is its characters per tag, lowered as the share of characters and tags inside
links grows; its density sum adds the densities of its children. Over the tree of all that is shown, but for forms and reader
comments, the subtree with the largest density sum holds the article; if that is a mere frame, whose blocks are no prose of
their own, the part with most of its sum does, and so on down. The smallest density on the path from there to the body is the
threshold: other nodes that reach it, and whose density sum is SHARE of the article's or more, or that are elements of prose,
belong to it too.

What is given is the smallest region that holds all these: the outermost <article> or <main> around the article (with the
other ones that hold prose), or the smallest ancestor of them all, of which blocks of links beside the path to the article stay
out. A region without an h1 takes the headings that stand before it. What density cannot tell is then left out of it by
tag, role, class and id: menus, headers, footers, sidebars, notices, adverts. A header that holds a heading of an article
stays.

Labels by class or id, and forms, are judged by what they would take. A class counts if all its words are among those of such
parts or mere layout words (share-price does not), and words after has-, no-, with- and the like do not. Names of
WEAK_WORDS take nothing that holds a paragraph of LEAST characters. A name that takes over half of the page's text
outside links (of the text of its only <main> or <article>, if that stands outside all names) takes nothing on that page,
and no name takes what holds a <main>, or the page's only <article>. Reader comments are left out of that half, unless the
page has less than LEAST characters besides.

Defined results: a null or empty page, or one without text, has an empty text; tags that never close end with the page; end
tags without a start are nothing; an unclosed comment, script or tag runs to the end; text in no tag belongs to the body; rows
that repeat are extracted each; an empty table gives an empty result. The time grows in proportion to the page. Extra
columns pass through.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

SHARE = 0.2
# Elements that are not shown or take input, that frame an article, that stand alone, and that break a line of text.
CUT_TAGS = frozenset("script style noscript template iframe object embed svg canvas button select option textarea input label fieldset dialog title head".split())
FRAME_TAGS = frozenset("nav header footer aside menu".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK_TAGS = frozenset("address article blockquote body br dd div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre section table tbody td tfoot th thead tr ul details summary center".split())
CUT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal newsletter subscribe signup nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget related share sharing social comment comments disqus respond reply replies pagination pager toolbar login search skip".split())
WEAK_WORDS = frozenset("search header widget toolbar login skip related".split())
LAYOUT_WORDS = frozenset("site page main post posts top bottom left right box bar block wrap wrapper container inner outer list links link item items icon icons btn button buttons area section column col row primary secondary global mobile desktop sticky fixed text image images slot unit large small".split())
READER_WORDS = frozenset("comment comments disqus respond reply replies".split())
NEGATING = frozenset("has no not non with without".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = frozenset("article section p blockquote pre table ul ol dl figure".split())
LEAST = 80
RAW_TAGS = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg")

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?][^>]*\Z|</?\Z", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW_TAGS}


class Node:
    """cut: no part of the tree that is measured; out: no part of the text that is given."""

    __slots__ = ("tag", "kids", "cut", "out", "names", "chars", "link_chars", "head_chars", "tags", "link_tags", "density", "total")

    def __init__(self, tag: str, cut: bool, out: bool = False, names: frozenset[str] = frozenset()):
        self.tag, self.cut, self.out, self.names = tag, cut, out, names
        self.kids: list = []


def _labels(tag: str, attributes: str) -> tuple[bool, bool, frozenset[str]]:
    """Whether the element is cut and left out whatever it holds, and the words by which it may be."""
    names = {"form"} if tag == "form" else set()
    if tag in CUT_TAGS:
        return True, True, frozenset()
    out = tag in FRAME_TAGS
    for name, a, b, c in ATTRIBUTE.findall(attributes) if attributes else ():
        value, name = (a or b or c).lower(), name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True, True, frozenset()
        if name == "role" and value in CUT_ROLES:
            out = True
        if name in ("class", "id") and tag not in ("body", "html", "article", "main"):
            for one in value.split():
                pieces = [x for x in re.split(r"[^a-z0-9]+", one) if x]
                for i, piece in enumerate(pieces):
                    if piece in NEGATING:
                        del pieces[i:]
                        break
                if all(x in CUT_WORDS or x in LAYOUT_WORDS for x in pieces):
                    names.update(x for x in pieces if x in CUT_WORDS)
    return False, out, frozenset(names)


def _judge_names(root: Node) -> None:
    """Leave out the elements with names, but for those that would take the article with them; cut forms and reader comments."""
    shares: Counter = Counter()  # characters outside links, by the names of all elements around them
    within: dict[int, Counter] = {}  # the same of each outermost article and main
    named, homes, todo = [], [], [(root, frozenset(), None, False, False, None)]
    while todo:
        n, above, up, linked, inside, home = todo.pop()
        if n.names:
            above, up = above | {n.names}, (n, up)
            named.append(n)
        elif n.tag == "main" or n.tag == "article" and not inside:
            homes.append((n, up))
        if n.tag in ("article", "main") and home is None:
            home = within.setdefault(id(n), Counter())
        for k in n.kids:
            if not isinstance(k, str):
                if not k.cut:
                    todo.append((k, above, up, linked or k.tag == "a", inside or n.tag == "article", home))
            elif not linked and (size := len(" ".join(k.split()))):
                shares[above] += size
                if home is not None:
                    home[above] += size
    if not named:
        return
    alone = [x for x in homes if x[0].tag == "main"] or homes
    if len(alone) == 1 and alone[0][1] is None and (its := within.get(id(alone[0][0]))):
        shares = its
    own = Counter({above: size for above, size in shares.items() if not any(READER_WORDS & x for x in above)})
    if own.total() < LEAST:
        own = shares
    taken: Counter = Counter()
    for above, size in own.items():
        for names in above:
            taken[names] += size
    for n in named:
        n.out = 2 * taken[n.names] <= own.total() and not (n.names <= WEAK_WORDS and _holds_prose(n))

    def around(up: tuple | None) -> list[Node]:
        found = []
        while up:
            n, up = up
            if n.out:
                found.append(n)
        return found

    articles = [around(up) for n, up in homes if n.tag == "article"]
    articles = [cuts for cuts in articles if not any(READER_WORDS & x.names for x in cuts)]
    keep = [x for n, up in homes if n.tag == "main" for x in around(up)]
    if len(articles) == 1:
        keep += articles[0]
    for n in keep:
        n.out = False
    for n in named:
        n.cut = n.out and bool(n.names & (READER_WORDS | {"form"}))


def _holds_prose(node: Node) -> bool:
    """Whether a paragraph of LEAST characters outside links is in it."""
    todo = [node]
    while todo:
        n = todo.pop()
        if n.tag == "p" and sum(len(" ".join(k.split())) for k in n.kids if isinstance(k, str)) >= LEAST:
            return True
        todo += [k for k in n.kids if not isinstance(k, str) and not k.cut and k.tag != "a"]
    return False


def tree(page: str) -> Node:
    """The page's tree below its body. A block closes an open paragraph, an item an open item."""
    root = Node("body", False)
    stack, at, end = [root], 0, len(page)
    open_: dict[str, list[int]] = {}  # where in the stack each tag is open
    blocks: list[int] = []

    def close(i: int) -> None:
        for n in reversed(stack[i:]):
            open_[n.tag].pop()
            if n.tag in BLOCK_TAGS:
                blocks.pop()
        del stack[i:]

    while at < end:
        m = TOKEN.search(page, at)
        if text := page[at : m.start() if m else end]:
            stack[-1].kids.append(html.unescape(text))
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag or tag in ("html", "body"):
            continue
        if m[1]:
            if open_.get(tag):
                close(open_[tag][-1])
            continue
        if tag in BLOCK_TAGS and tag != "br" and blocks and (stack[blocks[-1]].tag == "p" or stack[blocks[-1]].tag == tag == "li"):
            close(blocks[-1])
        node = Node(tag, *_labels(tag, m[3] or ""))
        stack[-1].kids.append(node)
        if tag in RAW_END:
            stop = RAW_END[tag].search(page, at)
            at = stop.end() if stop else end
        elif tag not in VOID_TAGS and not (m[3] or "").endswith("/"):
            open_.setdefault(tag, []).append(len(stack))
            if tag in BLOCK_TAGS:
                blocks.append(len(stack))
            stack.append(node)
    _judge_names(root)
    return root


def _below(root: Node) -> list[Node]:
    """Nodes that stay, parents first."""
    out = [root]
    for node in out:
        out += [k for k in node.kids if not isinstance(k, str) and not k.cut]
    return out


def measure(root: Node) -> list[Node]:
    nodes = _below(root)
    for n in reversed(nodes):
        kids = [k for k in n.kids if not isinstance(k, str) and not k.cut]
        n.chars = sum(len(" ".join(k.split())) for k in n.kids if isinstance(k, str)) + sum(k.chars for k in kids)
        n.head_chars = n.chars if n.tag in HEADINGS else sum(k.head_chars for k in kids)
        n.tags = len(kids) + sum(k.tags for k in kids)
        n.link_chars = n.chars if n.tag == "a" else sum(k.link_chars for k in kids)
        n.link_tags = n.tags + 1 if n.tag == "a" else sum(k.link_tags for k in kids)
    body_links, body_chars = root.link_chars, max(root.chars, 1)
    for n in reversed(nodes):
        c, lc, t, lt = n.chars, max(n.link_chars, 1), max(n.tags, 1), max(n.link_tags, 1)
        base = math.log(c / max(c - n.link_chars, 1) * lc + body_links / body_chars * c + math.e)
        n.density = c / t * math.log(max(c / lc * t / lt, 1) + 1) / base if c else 0.0
        kids = [k for k in n.kids if not isinstance(k, str) and not k.cut]
        n.total = sum(k.density for k in kids if k.tag in BLOCK_TAGS)  # not of inline marks, which repeat their block
    return nodes


def _text(node: Node, skip: set[int] = frozenset()) -> str:
    blocks, line = [], []

    def close() -> None:
        if text := " ".join("".join(line).split()):
            blocks.append(text)
        line.clear()

    todo: list = [(node, False)]
    while todo:
        x, in_article = todo.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            line.append(x)
        elif not x.cut and id(x) not in skip and (not x.out or in_article and x.tag == "header" and not x.names and x.head_chars):
            if x.tag in BLOCK_TAGS:
                close()
                todo.append((None, False))
            inside = in_article or x.tag in ("article", "main")
            todo += [(k, inside) for k in reversed(x.kids)]
    close()
    return "\n".join(blocks)


def _linked(n: Node) -> bool:
    return 2 * n.link_chars >= n.chars


def _blocks(n: Node) -> list[Node]:
    return [k for k in n.kids if not isinstance(k, str) and not k.cut and not k.out and k.tag in BLOCK_TAGS]


def _article(nodes: list[Node], parents: dict[int, Node]) -> Node:
    """The node that holds the article, by density sums."""
    labelled = set()
    for n in nodes:
        up = parents.get(id(n))
        if n.out or up is not None and id(up) in labelled:
            labelled.add(id(n))
    best = max((n for n in nodes if id(n) not in labelled and n.tag in BLOCK_TAGS), key=lambda n: n.total, default=nodes[0])
    while True:  # a frame of other blocks than prose: down to the part with most of the sum
        parts = _blocks(best)
        if not parts or any((k.tag in PROSE or k.tag in HEADINGS) and not _linked(k) for k in parts):
            return best
        most = max(parts, key=lambda k: k.total)
        if 2 * most.total <= sum(k.total for k in parts):
            return best
        best = most


def _region(nodes: list[Node], parents: dict[int, Node], best: Node, threshold: float) -> tuple[set[int], set[int]]:
    """Ids of the nodes whose text is given, and of the blocks of links in them that are not."""
    dense = {id(best)}
    for n in nodes:
        if not n.out and not _linked(n) and n.tag in BLOCK_TAGS and (n.tag in PROSE or n.density >= threshold and n.total >= SHARE * best.total > 0):
            dense.add(id(n))
    for n in reversed(nodes):
        if id(n) in dense and not n.out and (p := parents.get(id(n))) is not None:
            dense.add(id(p))
    home, n = None, best
    while n is not None:
        home, n = n if n.tag in ("article", "main") else home, parents.get(id(n))
    region, skip, beside, n = home or best, set(), set(), home or best
    while not home and (p := parents.get(id(n))) is not None:
        others = [k for k in p.kids if k is not n and (isinstance(k, str) or not k.cut and not k.out)]
        beside |= {id(k) for k in others if not isinstance(k, str) and k.tag in BLOCK_TAGS and _linked(k) and id(k) not in dense}
        if any(len(" ".join(k.split())) >= LEAST if isinstance(k, str) else id(k) in dense for k in others):
            region, skip = p, skip | beside
        n = p
    keep = {id(region)}
    if home:
        keep |= {id(x) for x in nodes if x.tag in ("article", "main") and id(x) in dense}
    if not any(x.tag == "h1" for x in _below(region)):
        n = region
        while (p := parents.get(id(n))) is not None:
            for k in p.kids:
                if k is n:
                    break
                if not isinstance(k, str) and not k.cut and not k.out and k.chars and k.head_chars == k.chars and not _linked(k):
                    keep.add(id(k))
            n = p
    return keep, skip


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = tree(page)
    nodes = measure(root)
    if not root.chars:
        return ""
    parents = {id(k): n for n in nodes for k in n.kids if not isinstance(k, str)}
    best = _article(nodes, parents)
    threshold, n = best.density, best
    while (n := parents.get(id(n))) is not None:
        threshold = min(threshold, n.density)
    keep, skip = _region(nodes, parents, best, threshold)
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        if id(x) in keep:
            out.append(_text(x, skip))
        else:
            todo += [k for k in reversed(x.kids) if not isinstance(k, str) and not k.cut and not k.out]
    return "\n".join(t for t in out if t)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """The columns of pages but html, and text and n_chars (a column of pages with one of these names is replaced)."""
    keep = [c for c in pages.columns if c not in (column, "text", "n_chars")]
    rows = pages.select(*keep, column)
    schema = rows.selectExpr(*[f"`{c}`" for c in keep], "'' as text", "0L as n_chars").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                texts = [main_text(p) for p in b.column(b.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*keep, "text", "n_chars"])

    return rows.mapInArrow(run, schema)
