"""Main text of web pages by tree scoring.

Each block of text gives points for its length and its commas to the elements above it, the nearer
the more; an element's points are discounted by the share of its text that is in links. The element
with most points, or the article around it, or the articles in it that hold most of its text, is the
container. It is kept with those siblings that have a fair share of its points or are plain paragraphs, all that
stands between them, and the headings, paragraphs, lists, quotes, tables and sections that follow on
either side; an article is kept alone, or with other articles. Menus, footers, asides, scripts, styles and
input fields take no part and are cut out wherever they are.

Forms, fieldsets and elements whose class, id or role has a word for a part beside the article are
doubtful. They are judged when the page is read, outermost first, by their text outside links, and
stay if they hold a longer article than there is outside of them, or most of the text (of the page, or
of the article around them) alone or with those of the same word; of words that content has too
(`OFTEN_CONTENT`), also if they hold much text of its own. With mostly links or fields they go. What readers
wrote, and teasers (`NOT_THE_PAGE`), articles among them, stay only if there is no other text to speak of.

Defined cases: a null or empty page, and one without any text, gives ''; rows are independent, so
null ids, repeated rows and other columns play no part; a very long page is read whole; broken markup is read leniently: a block
ends an open paragraph, an end tag without a start is ignored, all is closed at the end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from couchlog.llm.common import boxed, schema, unboxed

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead"
    " tr ul".split()
)
DROPPED = frozenset(
    "head script style noscript template iframe object embed svg math canvas audio video button select textarea"
    " input label nav menu footer aside dialog".split()
)
# Words in class, id or role that name a part beside the article.
BESIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs comment comments"
    " commentlist complementary consent contentinfo cookie cookies disqus disclaimer dropdown footer gdpr login menu modal"
    " nav navbar navigation newsletter notice notices notification paywall popup promo promotion promoted related"
    " recommended replies search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar"
    " widget alert responses respond masthead topbar form".split()
)
# Words of those that names of content have as a part, too.
OFTEN_CONTENT = frozenset("alert fieldset form notice notices related replies responses search share sharing social widget".split())
# Words that name readers' comments and teasers of other pages, of articles too.
NOT_THE_PAGE = frozenset(
    "comment comments commentlist disqus related recommended replies reply respond responses teaser teasers promo promoted sponsored".split()
)
# Elements that belong to the text they stand next to.
WITH_TEXT = frozenset("h1 h2 h3 h4 h5 h6 hgroup p ul ol dl blockquote pre table figure section address details".split())
FIELDS = frozenset("input label button select textarea".split())
# Characters and share of the text that are much; characters for each field that are few; share in links that is mostly links.
MUCH, MUCH_SHARE, FIELD_CHARS, LINKS = 200, 0.2, 40, 0.5
# Elements that an element of the same kind ends, and where the search for them stops.
ENDS_ITSELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_CELLS = frozenset(("td", "th", "table", "html"))


class _Node:
    __slots__ = ("tag", "parent", "items", "points", "chars", "linked", "doubts", "fields", "plain", "links", "article")

    def __init__(self, tag: str, parent: _Node | None, doubts: frozenset[str] | set[str] = frozenset()):
        self.tag, self.parent, self.items = tag, parent, []
        self.points, self.chars, self.linked = 0.0, 0, 0
        # words that make it doubtful; of all that is in it: fields, characters outside and in links, longest article
        self.doubts, self.fields, self.plain, self.links, self.article = doubts, 0, 0, 0, 0


def _dropped(tag: str, in_article: bool) -> bool:
    return tag in DROPPED or (tag == "header" and not in_article)


def _doubts(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> set[str]:
    """Words that make an element doubtful."""
    if tag in ("header", "html", "body", "main"):
        return set()
    found = {tag} if tag in ("form", "fieldset") else set()
    for name, value in attrs:
        if name in ("class", "id", "role") and value:
            words = {w.lower() for w in _WORDS.findall(value)}
            found |= words & (NOT_THE_PAGE if tag == "article" else BESIDE)
            if tag == "article":
                continue
            if "header" in words and not in_article:
                found.add("header")
    return found


class _Tree(HTMLParser):
    """Elements and text outside the dropped parts, with doubtful elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", None)
        self.open: list[tuple[str, _Node | None]] = [("#root", self.root)]
        self.articles = 0
        self.doubtful = False

    def _close(self, depth: int) -> None:
        for tag, _ in self.open[depth:]:
            self.articles -= tag in ("article", "main")
        del self.open[depth:]

    def _find(self, tags: tuple[str, ...], stop: frozenset[str] | tuple[str, ...]) -> int:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth][0] in tags:
                return depth
            if self.open[depth][0] in stop:
                return 0
        return 0

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            head = self._find(("head",), ())
            if head:
                self._close(head)
        if tag in BLOCK:
            depth = self._find(("p",), _CELLS)
            if depth:
                self._close(depth)
        if tag in ENDS_ITSELF:
            depth = self._find(("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,), ENDS_ITSELF[tag])
            if depth:
                self._close(depth)
        above = self.open[-1][1]
        if above is not None and tag in FIELDS:
            above.fields += 1
        if tag in VOID:
            if above is not None and tag in ("br", "hr", "wbr"):
                above.items.append(" " if tag == "br" else "" if tag == "wbr" else _Node("hr", above))
            return
        node = None
        if above is not None and not _dropped(tag, self.articles > 0):
            node = _Node(tag, above, _doubts(tag, attrs, self.articles > 0))
            self.doubtful |= bool(node.doubts)
            above.items.append(node)
        elif above is not None and tag in BLOCK:
            above.items.append(_Node("hr", above))  # text on both sides is not one block
        self.open.append((tag, node))
        self.articles += tag in ("article", "main")

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK and tag not in ("script", "style", "textarea", "title"):
            self._close(len(self.open) - 1)

    def handle_endtag(self, tag):
        depth = self._find((tag,), _CELLS - {tag} if tag in BLOCK else BLOCK)
        if not depth and tag in BLOCK and tag not in ("td", "th", "tr"):
            depth = self._find((tag,), ("table",) if tag != "table" else ())
        if depth:
            self._close(depth)

    def handle_data(self, data):
        above = self.open[-1][1]
        if above is not None:
            above.items.append(data)


def _measure(root: _Node) -> None:
    """Fields, characters and longest article of each element."""
    stack = [(root, iter(root.items), False)]
    while stack:
        node, items, in_link = stack[-1]
        for item in items:
            if isinstance(item, _Node):
                stack.append((item, iter(item.items), in_link or item.tag == "a"))
                break
            size = sum(map(len, item.split()))
            node.plain, node.links = node.plain + size * (not in_link), node.links + size * in_link
        else:
            stack.pop()
            if node.tag in ("article", "main"):
                node.article = max(node.article, node.plain)
            if above := node.parent:
                above.plain, above.links, above.fields = above.plain + node.plain, above.links + node.links, above.fields + node.fields
                above.article = max(above.article, node.article)


def _judge(root: _Node) -> None:
    """Cut the doubtful elements that are beside the main text."""
    _measure(root)
    scopes = [root]
    while scopes:
        scope = scopes.pop()
        # outermost doubtful elements of the scope, and the longest article outside of them
        outer, outside, stack = [], 0, [(scope, False, False)]
        certain: dict[int, int] = {}  # text outside doubtful elements, of each article around
        above: list[_Node] = []
        while stack:
            node, in_link, left = stack.pop()
            if left:
                above.pop()
                outside = max(outside, certain[id(node)])
                if above:
                    certain[id(above[-1])] += certain[id(node)]
                continue
            if node.doubts and node is not scope:
                outer.append(node)
                continue
            if node.tag in ("article", "main"):
                above.append(node)
                certain[id(node)] = 0
                stack.append((node, False, True))
            in_link = in_link or node.tag == "a"
            if above and not in_link:
                certain[id(above[-1])] += sum(sum(map(len, x.split())) for x in node.items if isinstance(x, str))
            stack += [(x, in_link, False) for x in reversed(node.items) if isinstance(x, _Node)]
        few = lambda n: n.links > LINKS * (n.plain + n.links) or n.fields * FIELD_CHARS > n.plain
        around: dict[int, _Node] = {}
        together: dict[tuple[int, str], int] = {}
        for n in outer:
            place = n.parent
            while place is not scope and place.tag not in ("article", "main"):
                place = place.parent
            around[id(n)] = place
            for word in n.doubts if not few(n) else ():
                together[id(place), word] = together.get((id(place), word), 0) + n.plain
        cut: dict[int, _Node] = {}
        held: dict[int, int] = {}  # text of each place that no doubtful element holds
        for place in around.values():
            held[id(place)] = place.plain - sum(n.plain for n in outer if around[id(n)] is place) if id(place) not in held else held[id(place)]
        for n in outer:
            place = around[id(n)]
            in_article = place.tag in ("article", "main")
            content = n.doubts <= OFTEN_CONTENT
            rival = 0 if in_article else outside
            most = any(2 * together.get((id(place), word), 0) > place.plain for word in n.doubts)
            keep = n.article > outside or 2 * n.plain > place.plain and (not rival or content and n.plain > rival)
            if not keep and not few(n):
                keep = most and (not rival or content and n.plain > rival)
                keep = keep or content and n.plain >= MUCH and n.plain >= MUCH_SHARE * place.plain and (in_article or not rival)
            if n.doubts & NOT_THE_PAGE:
                keep = keep and held[id(place)] < MUCH and not (outside and not in_article)
            if keep:
                scopes.append(n)
            else:
                cut[id(n)] = n
        for above_cut in {id(n.parent): n.parent for n in cut.values()}.values():
            # text on both sides of a block is not one block
            above_cut.items = [x if id(x) not in cut else _Node("hr", above_cut) if x.tag in BLOCK else "" for x in above_cut.items]


def _blocks(top: _Node) -> Iterator[tuple[_Node, str, int]]:
    """Text blocks below an element in page order: element, text, characters of it in links."""
    text: list[str] = []
    linked, owner = 0, top
    # (node, iterator over its items, inside a link)
    stack = [(top, iter(top.items), False)]
    while stack:
        node, items, in_link = stack[-1]
        for item in items:
            if isinstance(item, str):
                text.append(item)
                linked += len(item) if in_link else 0
                continue
            if item.tag in BLOCK:
                if block := " ".join("".join(text).split()):
                    yield owner, block, linked
                text, linked, owner = [], 0, item
            stack.append((item, iter(item.items), in_link or item.tag == "a"))
            break
        else:
            stack.pop()
            if node.tag in BLOCK or not stack:
                if block := " ".join("".join(text).split()):
                    yield owner, block, linked
                text, linked = [], 0
                owner = next((n for n, _, _ in reversed(stack) if n.tag in BLOCK), top)


def _container(root: _Node) -> _Node:
    nodes: dict[int, _Node] = {}
    for owner, block, linked in _blocks(root):
        points = 1 + block.count(",") + min(len(block) / 100, 3)
        node, level = owner.parent or owner, 0
        owner.chars, owner.linked = owner.chars + len(block), owner.linked + linked
        if owner.tag not in ("p", "pre", "li", "h1", "h2", "h3", "h4", "h5", "h6", "dd", "dt"):
            node = owner  # text that stands in a container itself
        while node is not None:
            nodes[id(node)] = node
            node.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            if node is not owner:
                node.chars, node.linked = node.chars + len(block), node.linked + linked
            node, level = node.parent, level + 1
    if not nodes:
        return root
    best = max(nodes.values(), key=_score)  # the first of equals
    if best.tag in ("#root", "html", "body"):
        articles = [n for n in nodes.values() if n.tag in ("article", "main")]
        if 2 * sum(n.chars for n in articles if not _inside_article(n)) >= best.chars:
            best = max(articles, key=_score)
    node = best
    while node is not None:
        if node.tag in ("article", "main"):
            best = node
        node = node.parent
    return best


def _inside_article(node: _Node) -> bool:
    above = node.parent
    while above is not None:
        if above.tag in ("article", "main"):
            return True
        above = above.parent
    return False


def _score(node: _Node) -> float:
    return node.points * (1 - node.linked / max(node.chars, 1))


def main_text(html: str) -> str:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    if tree.doubtful:
        _judge(tree.root)
    best = _container(tree.root)
    if best.tag in ("#root", "html", "body") or best.parent is None:
        kept = [best]
        body = next((n for n in _children(best) if n.tag == "body"), best)
        links = {id(n) for n in _children(body) if n.tag in BLOCK and n.chars and n.linked >= LINKS * n.chars}
        if links and body.linked < LINKS * body.chars:  # lists of links around the text
            body.items = [x if id(x) not in links else _Node("hr", body) for x in body.items]
    else:
        least = max(10.0, 0.2 * _score(best))
        plain = lambda n: n.tag == "p" and n.chars > 80 and n.linked < 0.25 * n.chars
        beside = [n for n in best.parent.items if isinstance(n, _Node)]
        kept = [n for n in beside if n is best or n.tag == best.tag == "article" or _score(n) >= least or plain(n)]
        if best.tag not in ("article", "main"):
            kept = _with_neighbours([n for n in beside if n.chars], kept)
    return " ".join(block for node in kept for _, block, _ in _blocks(node))


def _children(node: _Node) -> Iterator[_Node]:
    """The elements in a node, and in the `html` element in it."""
    for item in node.items:
        if isinstance(item, _Node):
            yield item
            if item.tag == "html":
                yield from (x for x in item.items if isinstance(x, _Node))


def _with_neighbours(beside: list[_Node], kept: list[_Node]) -> list[_Node]:
    """The kept siblings, those between them, and text elements that go on from them; none that is mostly links."""
    wanted = {id(n) for n in kept}
    places = [k for k, n in enumerate(beside) if id(n) in wanted]
    first, last = min(places), max(places)
    text = lambda n: n.linked < LINKS * n.chars
    while first > 0 and beside[first - 1].tag in WITH_TEXT and text(beside[first - 1]):
        first -= 1
    while last + 1 < len(beside) and beside[last + 1].tag in WITH_TEXT and text(beside[last + 1]):
        last += 1
    return [n for n in beside[first : last + 1] if id(n) in wanted or text(n)]


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All rows and columns of `pages` but the html, with `text` (a column of that name is replaced)."""
    rest = [c for c in pages.columns if c not in (html_col, "text")]
    rows = pages.select(boxed(pages, (html_col, "text")).alias("row"), F.col(html_col).cast("string").alias("html"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "") for page in batch.column("html")]
            yield pa.record_batch([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    found = rows.mapInArrow(extract, schema(f"row {rows.schema['row'].dataType.simpleString()}, text string"))
    return unboxed(found, [*rest, "text"], text=F.col("text"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
