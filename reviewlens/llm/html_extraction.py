"""Main text of web pages by removal of site templates.

Pages are parsed to element trees. Each subtree gets a hash of its tags and text, and Spark counts on how many
different pages of its host it occurs: what recurs on many of them is the site's template and is deleted, whatever it
is called. What recurs on a smaller part of a host's pages, such as the menu of one section, is deleted where it is not
most of a page's text. In an ``article`` element, blocks are counted by the different articles around them, so that
copied articles stay. What a page says about itself (navigation, forms, notices, comments and so on, by element,
role and class) is deleted too, as such parts often differ from page to page; but never what holds the article,
the main element or most of the page's text, and a class word never condemns a paragraph or heading.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import host_of, map_batches, stored

#: A subtree is template if it is on at least so many different pages of its host, and on more than this share of them.
LEAST_PAGES = 10
LEAST_SHARE = 0.5
#: From this share on it is template of a part of the host: deleted where it holds less than half of a page's text.
PART_SHARE = 0.05

#: Elements of the markup standard, by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("html body td th tr tbody thead tfoot option optgroup".split())
DROPPED = frozenset(
    "nav footer aside form script style noscript template iframe textarea title head svg math canvas button select input "
    "object embed audio video dialog menu map datalist xmp noembed noframes".split()
)
#: Elements whose own words make up a text; their class or id says what it is about, not that it is none.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th em strong b i span a code q cite label".split())
#: Words that say that an element holds what readers have written.
OF_READERS = frozenset("comment comments commentlist discussion disqus reply replies respond".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar tooltip status".split())
#: Words of a class or id that mark a part as not the article.
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices notification alert sidebar side aside nav navbar navigation menu menus breadcrumb breadcrumbs footer "
    "masthead topbar comment comments commentlist discussion disqus reply replies respond newsletter subscribe subscription "
    "signup login register share sharing social related recommended recommendation recommendations popup modal overlay widget "
    "widgets toolbar pagination pager paging copyright legal disclaimer search skip".split()
)
ENDS_WITH_SAME = {
    "li": ("li", "ul ol menu dir"),
    "dd": ("dd dt", "dl"),
    "dt": ("dd dt", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "option": ("option", "select datalist"),
}
ENDS_WITH_SAME = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS_WITH_SAME.items()}

P_STOPS = ("td", "th", "table", "button", "object", "caption")

_markup = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|</[a-zA-Z][^>]*>"""
    r"""|<[a-zA-Z](?:[^>"']|"[^"]*"|'[^']*')*>|<[a-zA-Z][^>]*>""",
    re.S,
)
_unfinished = re.compile(r"<!--.*\Z|<!\[CDATA\[.*\Z", re.S)
_raw_ends = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW}
_name = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_attribute = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_split_words = re.compile(r"[^a-z0-9]+")
_camel = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


class Node:
    """An element: its children are texts and elements, in order."""

    __slots__ = ("tag", "attributes", "children", "hash", "dropped", "size")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []
        self.hash, self.dropped, self.size = 0, False, 0


class _Open:
    """The open elements, and where the open ones of each tag lie, so that no end has to look for its start."""

    def __init__(self, root: Node):
        self.stack, self.places = [root], {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def last(self, tags: Iterable[str]) -> int:
        """Depth of the innermost open element with one of the tags, 0 for none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def cut(self, depth: int) -> None:
        for node in self.stack[depth:]:
            self.places[node.tag].pop()
        del self.stack[depth:]

    def close(self, tags: Iterable[str], stops: Iterable[str] = ()) -> None:
        depth = self.last(tags)
        if depth > self.last(stops):
            self.cut(depth)


def parse(html: str | None) -> Node:
    """The element tree of a page, however broken: unknown ends are ignored, missing ones are put in."""
    root, at, text = Node("html"), 0, html or ""
    held, n, last = _Open(root), len(text), text.rfind(">")
    while at < n:
        # Behind the last ">" nothing but an unfinished comment is markup.
        found = _markup.search(text, at) if at <= last or "<!--" in text[at : at + 4] else _unfinished.search(text, at)
        if not found:
            held.stack[-1].children.append(text[at:])
            break
        if found.start() > at:
            held.stack[-1].children.append(text[at : found.start()])
        at, token = found.end(), found.group()
        if token[1] in "!?":
            continue
        tag = _name.match(token)[1].lower()
        if token[1] == "/":
            held.close((tag,))
            continue
        if tag in CLOSES_P:
            held.close(("p",), P_STOPS)
        if tag in ENDS_WITH_SAME:
            held.close(*ENDS_WITH_SAME[tag])
        node = Node(tag, token[1 + len(tag) : -1])
        held.stack[-1].children.append(node)
        if tag in RAW:
            end = _raw_ends[tag].search(text, at)
            at = end.end() if end else n
        elif tag not in VOID and not token.endswith("/>"):
            held.push(node)
    return root


def _walk(root: Node) -> Iterator[Node]:
    """Every element, in page order."""
    todo = [root]
    while todo:
        node = todo.pop()
        yield node
        todo += [child for child in reversed(node.children) if isinstance(child, Node)]


def _marked(node: Node, inside_article: bool) -> bool:
    """Whether the page itself says that this part is not the article."""
    if node.tag in DROPPED or (node.tag == "header" and not inside_article):
        return True
    if not node.attributes or node.tag in ("html", "body"):
        return False
    for name, a, b, c in _attribute.findall(node.attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if name == "role" and value.lower() in DROPPED_ROLES:
            return True
        if name in ("class", "id") and node.tag not in PROSE:
            words = _words(value)
            if words & DROPPED_WORDS and not (node.tag in ("article", "main") and not words & OF_READERS):
                return True
    return False


def _words(value: str) -> set[str]:
    return {w for part in _camel.sub(" ", value).split() for w in _split_words.split(part.lower())}


def _of_readers(node: Node) -> bool:
    return "comment" in node.attributes.lower() and any(
        bool(_words(a or b or c) & OF_READERS) for name, a, b, c in _attribute.findall(node.attributes) if name.lower() in ("class", "id")
    )


#: What is never text, whatever it holds.
NO_TEXT = frozenset("script style noscript template iframe textarea title head svg canvas select audio video map datalist xmp noembed noframes".split())


def _protected(root: Node) -> tuple[set[int], set[int]]:
    """The way down to the largest article and to main elements, which nothing drops, and what holds at least half of
    the page's text, which no class word, role or form drops. Also sets how much text is in each element."""
    order = list(_walk(root))
    parent = {id(child): node for node in order for child in node.children if isinstance(child, Node)}
    for node in reversed(order):
        node.size = 0 if node.tag in NO_TEXT else sum(c.size if isinstance(c, Node) else len(c.split()) for c in node.children)
    most = {id(node) for node in order if root.size and 2 * node.size >= root.size}
    articles = [node for node in order if node.tag == "article" and not _of_readers(node)]
    largest, way = max(articles, key=lambda node: node.size, default=None), set()
    for node in [largest, *(node for node in order if _is_main(node))]:
        while node is not None and id(node) not in way:
            way.add(id(node))
            node = parent.get(id(node))
    return way, most


def _is_main(node: Node) -> bool:
    return node.tag == "main" or bool(re.search(r"""role\s*=\s*["']?main\b|itemprop\s*=\s*["']?articleBody""", node.attributes, re.I))


def _prepare(root: Node) -> tuple[list[Node], list[Node]]:
    """Marks what is dropped, and gives the articles and the main elements that are not inside an article."""
    articles, mains, (way, most) = [], [], _protected(root)
    todo: list[tuple[Node, bool]] = [(root, False)]
    while todo:
        node, inside = todo.pop()
        by_name = node.tag in DROPPED and node.tag != "form"
        node.dropped = node.tag in NO_TEXT or (
            id(node) not in way and (by_name or id(node) not in most) and _marked(node, inside)
        )
        if node.dropped:
            continue
        if not inside and node.tag == "article":
            articles.append(node)
            inside = True
        elif not inside and _is_main(node):
            mains.append(node)
        todo += [(child, inside) for child in reversed(node.children) if isinstance(child, Node)]
    return articles, mains


def _hash_all(root: Node) -> None:
    """Hashes of all subtrees, from the leaves up: tags and white-space-normal text."""
    for node in reversed(list(_walk(root))):
        parts = [node.tag.encode()]
        for child in node.children:
            if isinstance(child, Node):
                parts.append(child.hash.to_bytes(8, "little", signed=True))
            elif words := child.split():
                parts.append(" ".join(words).encode("utf-8", "surrogatepass"))
        node.hash = int.from_bytes(hashlib.blake2b(b"\0".join(parts), digest_size=8).digest(), "little", signed=True)


def subtrees(html: str | None) -> set[tuple[int | None, bool, int]]:
    """(hash, inside, around) of the page's subtrees that are not dropped anyway: outside articles all but those that
    hold the article, around them the page; inside an ``article`` its blocks, around them that article.

    Rows without a hash count the page itself and its articles.
    """
    root = parse(html)
    articles, mains = _prepare(root)
    holders = set(map(id, articles or mains or [root]))
    starts = set(map(id, articles))
    _hash_all(root)
    found: set[tuple[int | None, bool, int]] = {(None, False, root.hash)}
    todo: list[tuple[Node, Node]] = [(root, root)]
    while todo:
        node, around = todo.pop()
        if node.dropped:
            continue
        inside = around is not root
        if id(node) in starts:
            around = node
            found.add((None, True, node.hash))
        elif inside and node.tag in BLOCKS and node.children:
            found.add((node.hash, True, around.hash))
        elif not inside and id(node) not in holders and node.tag not in ("html", "body") and node.children:
            found.add((node.hash, False, root.hash))
        todo += [(c, around) for c in node.children if isinstance(c, Node)]
    return found


Hashes = frozenset[int] | set[int]


def main_text(html: str | None, template: Hashes = frozenset(), inner: Hashes = frozenset(), part: Hashes = frozenset()) -> str:
    """Text of the article: blocks in page order, one per line, without dropped parts and template subtrees.

    ``template`` is removed outside ``article`` elements, ``inner`` inside them, and ``part`` outside them from where it
    is less than half of the page's text. Articles, or else the main element, are the text if they have at least half
    of what is then left of the page.
    """
    root = parse(html)
    articles, mains = _prepare(root)
    if template or inner or part:
        _hash_all(root)
        if part:
            template = {node.hash for node in _walk(root) if node.hash in template or (node.hash in part and 2 * node.size < root.size)}
    starts = set(map(id, articles))
    whole = _text([root], starts, template, inner)
    for holders in (articles, mains):
        if holders and holders != [root]:
            text = _text(holders, starts, template, inner)
            if 2 * len(text) >= len(whole):
                return text
    return whole


def _text(holders: list[Node], starts: set[int], template: frozenset[int] | set[int], inner: frozenset[int] | set[int]) -> str:
    blocks: list[str] = []
    current: list[str] = []

    def flush() -> None:
        words = unescape("".join(current)).split()
        if words:
            blocks.append(" ".join(words))
        current.clear()

    for holder in holders:
        inside = False
        todo: list[Node | str | None | bool] = [holder]
        while todo:
            item = todo.pop()
            if item is None:
                flush()
            elif item is False:
                inside = False
            elif isinstance(item, str):
                current.append(item)
            elif item.tag == "br":
                current.append(" ")
            elif not item.dropped:
                start = id(item) in starts
                if item is not holder and not start and (item.hash in inner and item.tag in BLOCKS if inside else item.hash in template):
                    continue
                if start:
                    inside = True
                    todo.append(False)
                if item.tag in BLOCKS:
                    flush()
                    todo.append(None)
                todo += reversed(item.children)
        flush()
    return "\n".join(blocks)


def templates(
    pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE, part_share: float = PART_SHARE
) -> DataFrame:
    """(host, hashes, inner, part): the template subtrees of each host that has some, outside and inside articles, and
    those of a part of the host.

    A host has at most its mean number of subtrees a page, over the share that is asked for.
    """

    def run(batch: pa.RecordBatch) -> dict:
        hosts, rows = [], []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = subtrees(html)
            hosts += [host] * len(found)
            rows += found
        hashes, inside, around = zip(*rows, strict=True) if rows else ((), (), ())
        return {
            "host": pa.array(hosts, pa.string()),
            "hash": pa.array(hashes, pa.int64()),
            "inside": pa.array(inside, pa.bool_()),
            "around": pa.array(around, pa.int64()),
        }

    source = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string"))
    rows = map_batches(source, run, "host string, hash long, inside boolean, around long")
    # Copies of a page or article count once: what counts are the different surroundings of a subtree.
    each = rows.groupBy("host", "hash", "inside", "around").agg(F.count("*").alias("rows"))
    counted = stored(
        each.groupBy("host", "hash", "inside").agg(F.count("*").alias("n")).where(F.col("hash").isNull() | (F.col("n") >= least_pages)), "subtree-counts"
    )
    total = stored(counted.where("hash is null").select("host", "inside", F.col("n").alias("of")), "host-pages")
    met = counted.where("hash is not null").join(total, ["host", "inside"])
    most = F.col("n") > F.col("of") * least_share
    often = met.where(most | (~F.col("inside") & (F.col("n") > F.col("of") * part_share)))
    listed = lambda which: F.collect_list(F.when(which, F.col("hash")))
    return often.groupBy("host").agg(
        listed(~F.col("inside") & most).alias("hashes"), listed(F.col("inside")).alias("inner"), listed(~F.col("inside") & ~most).alias("part")
    )


def extract(
    pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE, part_share: float = PART_SHARE
) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``.

    Null and empty html, and pages that are nothing but template, have empty text. Pages without a host, also
    those with a null url, count as one site. Repeated rows are pages of their own, and count once for
    their host; other columns are not read. An empty table gives no rows.
    """
    site = stored(templates(pages, least_pages, least_share, part_share), "templates")
    own = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    joined = own.join(site, "host", "left").select("page_id", "url", "html", F.when(F.col("hashes").isNotNull(), F.struct("hashes", "inner", "part")).alias("template"))
    kind = own.schema

    def run(batch: pa.RecordBatch) -> dict:
        texts, last, held = [], None, ()
        for i, html in enumerate(batch.column(2).to_pylist()):
            hashes = batch.column(3)[i]
            if hashes.is_valid:
                if hashes != last:
                    last, held = hashes, tuple(map(frozenset, hashes.as_py().values()))
                texts.append(main_text(html, *held))
            else:
                texts.append(main_text(html))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        return {"page_id": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()), "n_chars": sizes}

    columns = f"page_id {kind['page_id'].dataType.simpleString()}, url {kind['url'].dataType.simpleString()}, text string, n_chars long"
    return map_batches(joined, run, columns)
