"""Main text of web pages by scoring the element tree.

Paragraphs pass points for their length and commas to their ancestors, less with
each level; an element's points are discounted by its link density. The best
container, widened to the article or main element around it, and those siblings
that score well are kept; without such an element, also what scores well or holds
a paragraph below the ancestor that the well-scoring containers share. Menus,
adverts, forms, notices, comments and the like are cut from the tree first, however
long: by their elements, by words of classes and identifiers, also at the front of
longer words, and comments by their structure too, as three like-shaped elements or
more after some of the page's text, nearly all of which name somebody and have a
date or a way to reply. Inline elements that say they are for sharing and the like
stay if they hold prose. Notices and related articles go wherever they are.

Defined results: null and empty pages have an empty text; markup that is broken
or cut short is read as far as it goes; whole pages are read; repeated rows are
repeated.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from junctura.llm.common import small_batches

# Element names of the HTML standard by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
GONE = frozenset("script style noscript template head title nav aside form button select option textarea input iframe object svg canvas audio video dialog menu".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FENCE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
# Words of classes and identifiers that mark what is no article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "popup modal overlay newsletter subscribe signup paywall sidebar widget menu nav navbar navigation breadcrumb breadcrumbs pagination pager "
    "footer header masthead comment comments disqus respond reply replies discussion discussions reviews feedback guestbook share sharing social related recommended recommendations toolbar login search".split()
)
# Words that also mark as the front or the end of a longer word; those of inline elements that may hold prose; those of what readers wrote.
COMPOUND = tuple("comment cookie consent advert sponsor newsletter sidebar breadcrumb paginat subscri disqus recommend masthead discussion".split())
SOFT = frozenset("share sharing social related recommended recommendations notice promo promotion login search signup subscribe".split())
NAMES = frozenset("author user username avatar commenter poster reviewer nick nickname says by vcard".split())
DATES = re.compile(r"\b(?:\d{4}-\d\d?-\d\d?|\d{1,2}[./]\d{1,2}[./]\d{2,4}|\d{1,2}:\d\d|(?:minutes?|hours?|days?|weeks?|months?|years?) ago|vor \d+|hace \d+|il y a \d+)\b", re.I)
REPLY = re.compile(r"\b(?:reply|respond|antworten|responder|répondre|likes?|upvote)\b", re.I)
ALIKE = 3  # elements of one shape that make a thread
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+|[^>]*)>""", re.S)
CUT = re.compile(r"</?[A-Za-z][^<>]*\Z")
ATTRIBUTE = re.compile(r"""([A-Za-z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


class Node:
    __slots__ = ("tag", "attributes", "parent", "children", "score", "size", "links")

    def __init__(self, tag: str, attributes: str, parent: Node | None) -> None:
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []
        self.score, self.size, self.links = 0.0, 0, 0

    def named(self) -> dict[str, str]:
        return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(self.attributes)} if self.attributes.strip(" /") else {}


def parse(page: str) -> Node:
    root = node = Node("#root", "", None)
    at, lowered = 0, None
    while True:
        m = TOKEN.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if not m:
            text = CUT.sub("", text)
        if text:
            node.children.append(unescape(text) if "&" in text else text)
        if not m:
            return root
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            up = node
            while up is not root and up.tag != tag:
                # An inline end tag doesn't reach past a block.
                up = root if tag not in BLOCK and up.tag in BLOCK else up.parent
            if up is not root:
                node = up.parent
            continue
        if tag in ENDS_P:
            up = node
            while up is not root and up.tag not in BLOCK:
                up = up.parent
            if up.tag == "p":
                node = up.parent
        if tag in SAME:
            up = node
            while up is not root and up.tag not in SAME[tag] and up.tag not in FENCE[tag]:
                up = up.parent
            if up.tag in SAME[tag]:
                node = up.parent
        child = Node(tag, m[3] or "", node)
        node.children.append(child)
        if tag in VOID or (m[3] or "").endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            lowered = lowered or page.lower()
            lowered = lowered if len(lowered) == len(page) else "".join(c.lower() if c.isascii() else c for c in page)
            end = lowered.find(f"</{tag}", at)
            at = len(page) if end < 0 else end
            if end >= 0:
                close = page.find(">", end)
                at = len(page) if close < 0 else close + 1
            continue
        node = child


def _measure(node: Node) -> None:
    """Text size and size of links of every element, bottom up."""
    order, todo = [], [node]
    while todo:
        order.append(n := todo.pop())
        todo += [c for c in n.children if isinstance(c, Node)]
    for n in reversed(order):
        n.size = n.links = 0
        for c in n.children:
            if isinstance(c, str):
                n.size += sum(map(len, c.split()))
            else:
                n.size += c.size
                n.links += c.size if c.tag == "a" else c.links


def _within(node: Node, tags: frozenset[str]) -> bool:
    above = node.parent
    while above is not None and above.tag not in tags:
        above = above.parent
    return above is not None


MAIN = frozenset(("article", "main"))


READERS = frozenset("comment comments disqus respond reply replies discussion discussions reviews feedback guestbook".split())
EDGES = frozenset(("footer", "header"))
LEAST = 40  # characters of a block that count as a paragraph


def _marks(node: Node) -> frozenset[str] | None:
    """Words that mark an element as no article; None if it goes whatever it holds."""
    if node.tag in GONE:
        return None
    if node.tag in ("html", "body", "main"):
        return frozenset()
    if node.tag == "footer" or node.tag == "header" and not _within(node, MAIN):
        return EDGES
    named = node.named()
    if not named:
        return frozenset()
    hidden = "hidden" in named or named.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", named.get("style", ""))
    if hidden or named.get("role", "").lower() in ROLES:
        return None
    words = _words(named)
    words |= {"comment" if c in ("comment", "disqus", "discussion") else "ad" for w in words - MARKS for c in COMPOUND if w.startswith(c) or w.endswith((c, c + "s"))}
    if node.tag == "header" or re.fullmatch(r"h[1-6]", node.tag):
        words -= {"header"}
    return frozenset(words & MARKS)


def _words(named: dict[str, str]) -> set[str]:
    """Words of an element's class and identifier."""
    return set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{named.get('class', '')} {named.get('id', '')}").lower()))


def _said(node: Node) -> bool:
    """Whether an element looks like what one reader wrote: somebody is named, and there is a date or a way to reply."""
    name, when, todo, seen = False, False, [node], 0
    while todo and seen < 60:
        n = todo.pop()
        seen += 1
        if isinstance(n, str):
            when = when or bool(DATES.search(n[:200]) or len(n) < 40 and REPLY.search(n))
            continue
        words = _words(n.named())
        name = name or bool(words & NAMES) or n.tag == "cite"
        when = when or n.tag == "time" or bool(words & {"date", "time", "timestamp", "posted", "ago"})
        todo += reversed(n.children)
    return name and when


def _thread(node: Node, before: bool) -> bool:
    """Whether an element's children are a thread of comments that follows some text."""
    own = [c for c in node.children if isinstance(c, Node)]
    if not before or len(own) < ALIKE or node.tag in ("html", "body", "#root"):
        return False
    shapes: dict[tuple, list[Node]] = {}
    for c in own:
        shapes.setdefault((c.tag, c.named().get("class", "").split(" ")[0]), []).append(c)
    alike = max(shapes.values(), key=len)
    if len(alike) < ALIKE or 5 * len(alike) < 4 * len(own) or sum(c.size for c in alike) < 2 * (node.size - sum(c.size for c in alike)):
        return False
    return 5 * sum(map(_said, alike)) >= 4 * len(alike)


class Held(NamedTuple):
    """What an element holds outside of marked elements: an article (2) or a main element (1) with text, characters of paragraphs, a first heading."""

    level: int = 0
    points: int = 0
    head: bool = False


def _stays(marks: frozenset[str], inner: Held, beside: Held) -> bool:
    """Whether a marked element is the layout around the page's content: what it holds against what is beside it."""
    if marks & READERS:
        return not beside.level and not beside.points and (inner.level > 0 or inner.head)
    if beside.level:
        return beside.level == 1 and inner.level == 2 and inner.points > beside.points
    if inner.level or marks is EDGES:
        return inner.level > 0
    return inner.points > beside.points and not (beside.head and beside.points)


def _prune(root: Node) -> None:
    """Cut marked elements, whatever their share of the page's text.

    Of the marked elements side by side one may stay, if it holds the content
    that is missing beside them; what is marked in it is judged anew.
    """
    marks: dict[int, frozenset[str]] = {}
    order, todo, before = [], [root], 0
    while todo:
        order.append(n := todo.pop())
        found = {id(c): _marks(c) for c in n.children if isinstance(c, Node)}
        n.children = [c for c in n.children if isinstance(c, str) or found[id(c)] is not None]
        for c in n.children:
            if isinstance(c, Node) and c.tag not in BLOCK and found[id(c)] and found[id(c)] <= SOFT and c.size - c.links >= LEAST and 2 * c.links < c.size:
                found[id(c)] = frozenset()
        if not marks.get(id(n)) and _thread(n, before >= LEAST):
            marks[id(n)] = frozenset(("comments",))
        marks |= {k: m for k, m in found.items() if m}
        # Nodes come in page order, so this is the text before the next one.
        before += sum(len(c) for c in n.children if isinstance(c, str) and not c.isspace()) if n.tag != "a" else 0
        todo += [c for c in reversed(n.children) if isinstance(c, Node)]
    # held: outside of marked elements; best: there or in a marked element below that isn't the readers'.
    held: dict[int, Held] = {}
    best: dict[int, Held] = {}
    text: dict[int, tuple[int, int, int]] = {}  # characters, of them in links; those in no block of its own
    for n in reversed(order):
        size = links = own = points = level = 0
        head, below = n.tag == "h1", []
        for c in n.children:
            if isinstance(c, str):
                k = sum(map(len, c.split()))
                size, own = size + k, own + k
                continue
            below += [best[id(c)]] if not marks.get(id(c), frozenset()) & READERS else []
            if id(c) in marks:
                continue
            mine, (k, linked, inline) = held[id(c)], text[id(c)]
            size, links, own = size + k, links + (k if c.tag == "a" else linked), own + (inline if c.tag not in BLOCK else 0)
            level, points, head = max(level, mine.level), points + mine.points, head or mine.head
        if n.tag in BLOCK:
            points += own if own >= LEAST and 2 * links < size else 0
            level = max(level, 2 if n.tag == "article" and size else 1 if n.tag == "main" and points else 0)
            own = 0
        text[id(n)] = size, links, own
        held[id(n)] = Held(level, points, head)
        best[id(n)] = max([held[id(n)], *below])
    scopes = [root]
    while scopes:
        scope = scopes.pop()
        marked, todo = [], [scope]
        while todo:
            n = todo.pop()
            marked += [c for c in n.children if isinstance(c, Node) and id(c) in marks]
            todo += [c for c in n.children if isinstance(c, Node) and id(c) not in marks]
        if not marked:
            continue
        first = max(marked, key=lambda c: (not marks[id(c)] & READERS, best[id(c)]))
        if _stays(marks[id(first)], best[id(first)], held[id(scope)]):
            scopes.append(first)
        else:
            first = None
        cut = {id(c) for c in marked if c is not first}
        for parent in {id(c.parent): c.parent for c in marked}.values():
            parent.children = [x for x in parent.children if id(x) not in cut]


def _blocks(nodes: list[Node]) -> Iterator[tuple[Node, str]]:
    """(element, text) of each block of text in page order."""
    for top in nodes:
        parts: list[str] = []
        todo: list = [(top, None)]
        holder = top
        while todo:
            item, owner = todo.pop()
            if item is None or isinstance(item, Node) and item.tag in BLOCK:
                if text := " ".join("".join(parts).split()):
                    yield holder, text
                parts = []
            if item is None:
                holder = owner
            elif isinstance(item, str):
                parts.append(item)
            elif item.tag == "br":
                parts.append(" ")
            else:
                if item.tag in BLOCK or item is top:
                    outer = holder
                    holder = item
                    todo.append((None, outer))
                todo += [(c, None) for c in reversed(item.children)]
        if text := " ".join("".join(parts).split()):
            yield holder, text


def _density(node: Node) -> float:
    return node.links / node.size if node.size else 0.0


def _around(best: Node, scored: Iterable[Node], rank: Callable[[Node], float], least: float) -> list[Node]:
    """The best container, and what belongs to it below the ancestor that all well-scoring containers share."""
    path, n = {}, best
    while n is not None:
        path[id(n)] = len(path)
        n = n.parent
    chain, met = [best], 1
    while chain[-1].parent is not None:
        chain.append(chain[-1].parent)
    seen: dict[int, int] = {}  # where the way up from a node meets the path
    for node in scored:
        if id(node) in path or node.tag not in BLOCK or rank(node) < least or _density(node) >= 0.5:
            continue
        way, n = [], node
        while id(n) not in path and id(n) not in seen:
            way.append(n)
            n = n.parent
        at = path[id(n)] if id(n) in path else seen[id(n)]
        seen |= {id(w): at for w in way}
        met = max(met, at)

    # Blocks with a paragraph of text in them, judged once for all below the ancestor.
    scope = chain[min(met, len(chain) - 1)]
    spoken = set()
    for holder, text in _blocks([scope]):
        if holder.tag in ("p", "blockquote", "pre") or len(text) >= LEAST and re.search("[.!?…。]", text):
            n = holder
            while n is not None and id(n) not in path and id(n) not in spoken:
                spoken.add(id(n))
                n = n.parent

    kept, todo = [], [scope]
    while todo:
        n = todo.pop()
        if n is best or id(n) not in path:
            kept.append(n)
            continue
        own, loose = [], Node("p", "", None)
        for c in [*n.children, None]:
            if c is not None and (isinstance(c, str) or c.tag not in BLOCK and id(c) not in path):
                loose.children.append(c)
                continue
            # Text in no block of its own, beside the container: prose is kept, as a block.
            if loose.children:
                _measure(loose)
                if loose.size >= LEAST and 4 * loose.links < loose.size:
                    own.append(loose)
                loose = Node("p", "", None)
            if c is None:
                break
            if id(c) in path:
                own.append(c)
            elif c.tag in BLOCK:
                alone = (re.fullmatch(r"h[1-3]", c.tag) or id(c) in spoken) and _density(c) < 0.25 and c.size > 0
                if alone or c.score and rank(c) >= least and _density(c) < 0.5:
                    own.append(c)
        todo += reversed(own)
    return kept


def extract(page: str | None) -> str:
    """Main text of a page; blocks are joined by one space."""
    if not page:
        return ""
    root = parse(page)
    _measure(root)
    _prune(root)
    _measure(root)
    scored: dict[int, Node] = {}
    for holder, text in _blocks([root]):
        points = 1 + text.count(",") + len(text) / 100
        node, level = holder.parent if holder.tag in ENDS_P - {"div", "section", "article", "main"} else holder, 1
        # Beyond forty levels less than a billionth of the points is left.
        while node is not None and node.tag != "#root" and level < 1 << 40:
            node.score += points / level
            scored[id(node)] = node
            node, level = node.parent, level * 2 if level > 1 else 2
    if not scored:
        return " ".join(text for _, text in _blocks([root]))
    rank = lambda n: n.score * (1 - _density(n))
    best = max(scored.values(), key=rank)
    top = best
    while top is not None:
        if top.tag in MAIN:
            best = top
        top = top.parent
    least = 0.2 * rank(best)
    if best.tag in MAIN:
        kept = []
        for c in best.parent.children:
            if c is best or isinstance(c, Node) and c.tag in BLOCK and c.score and rank(c) >= least and _density(c) < 0.5:
                kept.append(c)
    else:
        kept = _around(best, scored.values(), rank, least)
    return " ".join(text for _, text in _blocks(kept))


def main_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, text (empty if none) and n_chars of every page."""
    small_batches(pages.sparkSession, 500)
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html_col}`").alias("__html"))
    schema = rows.drop("__html").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [extract(t) for t in batch.column(len(keep)).to_pylist()]
            columns = [*batch.columns[: len(keep)], pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema)
