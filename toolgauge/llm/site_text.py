"""Main text of web pages: subtrees that a site repeats are its template and go.

Every page is read into its element tree once. Element subtrees get a hash of their tags and
words; Spark counts for each host in how many pages a hash occurs, and what occurs in MIN_PAGES
or more is taken out of all of them. Pages with one and the same article count once, so copies
of an article do not make it a template. A host with few pages has no counts to go by, so what
is left of menus, headers, footers, sidebars, notices, adverts, forms, comments and the like is
known by tags, roles and names.

The main text is that of the articles of a page, or else of `main`, or else of the body. In an
article or main, paragraphs, headings and other prose stay even if many pages share them (a
passage may be quoted widely); only boxes (div, section, list, table, figure and so on) can be
template there. In a body all blocks can, and lists of links go. A subtree with more than half
of a page's words is never template.

Defined results: null html is empty html, its text empty. A null url, or one without a host,
belongs to the host ''. Rows that repeat or share a page_id each give a row. `<br>` is white
space; white space is what Unicode says. An element left open ends where HTML says, or with the
page; an open comment, script or style takes the rest; a tag that the page's end cuts off is no
text. Memory for a very long page is in proportion to it, and nothing of it is left out. Empty
tables give an empty result. Columns besides page_id, url and html are not looked at. Hashes
have 64 bits and are compared within a host: among a million subtrees of a host, two different
ones agree with odds of 3e-8.
"""

from __future__ import annotations

import re
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from toolgauge.llm import rows
from toolgauge.session import settle

# A subtree on so many pages of a host, around different articles, is template.
MIN_PAGES = 8
# A frequent subtree is looked up in so many parts.
SALT = 16

# Fixed values of HTML: elements without content, with text only, that are blocks, and which
# open elements a start tag ends (unless one of the second set lies between).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search"
    " section summary table tbody td tfoot th thead tr ul".split()
)
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}

# What is no main text, by tag, by role, and by the first or last word of a class or id.
NO_TEXT_TAGS = frozenset(
    "aside audio button canvas dialog embed footer form head header iframe input menu nav noembed noframes noscript"
    " object script search select style svg template textarea title video xmp".split()
)
NO_TEXT_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
NO_TEXT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent"
    " cookie cookies copyright disclaimer footer gdpr header masthead menu modal nav navbar navigation newsletter"
    " notice notices pager pagination popup promo promotion related replies share sharing sidebar skip social"
    " sponsor sponsored subscribe toolbar widget".split()
)
# Names that make an article a reader's or an advert instead of the page's.
NO_ARTICLE_NAMES = frozenset("ad advert comment comments promo replies reply sponsored".split())
# Text blocks of an article, which stay however many pages share them.
PROSE = frozenset("blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre summary td th".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[A-Za-z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)"
    r"|[^<]+|<",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HOST = re.compile(r"\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", re.I)


class Node:
    """An element: texts (as words) and elements in it, how many words, and a hash of it all."""

    __slots__ = ("tag", "attributes", "parts", "words", "hash", "furniture")

    def __init__(self, tag: str, attributes: dict):
        self.tag, self.attributes, self.parts = tag, attributes, []
        self.words = self.hash = 0
        self.furniture = is_furniture(tag, attributes)

    def elements(self) -> list[Node]:
        return [part for part in self.parts if type(part) is Node]


def is_furniture(tag: str, attributes: dict) -> bool:
    """Do tag, role or names say that an element is no main text?"""
    if tag in NO_TEXT_TAGS:
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    if "hidden" in attributes or attributes.get("role", "").strip().lower() in NO_TEXT_ROLES:
        return True
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [word.lower() for word in NAME_WORDS.findall(name)]
        if tag == "article":
            if words and words[0] in NO_ARTICLE_NAMES:
                return True
        elif words and (words[0] in NO_TEXT_NAMES or words[-1] in NO_TEXT_NAMES):
            return True
    return False


def _attributes(rest: str) -> dict:
    found = {}
    if "=" in rest or "hidden" in rest:
        for name, value in ATTRIBUTE.findall(rest):
            found.setdefault(name.lower(), unescape(value.strip("\"'")))
    return found


def _close(stack: list, names, bounds) -> None:
    """End the innermost open element of these names, and all in it, if no bound is in between."""
    for k in range(len(stack) - 1, 0, -1):
        tag = stack[k].tag
        if tag in names:
            del stack[k:]
            return
        if tag in bounds or tag in ("article", "main", "body"):
            return


def tree(page: str) -> Node:
    """The element tree of a page, the hashes of its subtrees not yet taken."""
    root = Node("html", {})
    stack, at = [root], 0
    while at < len(page):
        token = TOKEN.match(page, at)
        at = token.end()
        tag = (token["tag"] or token["tag2"] or "").lower()
        if not tag:
            if not token[0].startswith(("<!", "<?")):
                stack[-1].parts.append(token[0])
        elif token["end"] or token["end2"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                # The end of an inline element does not reach beyond the block it is in.
                if tag not in BLOCK and stack[k].tag in BLOCK:
                    break
        elif token[0][-1] != ">":
            break
        elif tag not in ("html", "body") or all(node.tag != tag for node in stack[1:]):
            if tag in ENDS:
                _close(stack, *ENDS[tag])
            if tag in BLOCK:
                # Blocks end an open paragraph, and whatever follows the head ends it.
                _close(stack, ("p", "head"), BLOCK - {"p", "head"})
            node = Node(tag, _attributes(token["rest"] or token["rest2"] or ""))
            stack[-1].parts.append(node)
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else len(page)
            elif tag not in VOID:
                stack.append(node)
    return root


def _measured(root: Node) -> list[Node]:
    """All elements in page order, with words counted and hashes taken."""
    nodes, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        nodes.append(node)
        waiting.extend(reversed(node.elements()))
    for node in reversed(nodes):
        said = blake2b(node.tag.encode("utf-8", "replace"), digest_size=8)
        for part in node.parts:
            if type(part) is Node:
                said.update(b"\0" + part.hash.to_bytes(8, "little", signed=True))
                node.words += part.words
            else:
                words = unescape(part).split()
                said.update(b"\1" + " ".join(words).encode("utf-8", "replace"))
                node.words += len(words)
        node.hash = int.from_bytes(said.digest(), "little", signed=True)
    return nodes


def _topmost(root: Node, wanted, enter=lambda node: True) -> list[Node]:
    """Wanted elements that are in no other wanted one, in page order."""
    found, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if wanted(node):
            found.append(node)
        elif enter(node):
            waiting.extend(reversed(node.elements()))
    return found


def main_elements(root: Node) -> list[Node]:
    """The articles of a page; else `main`; else articles in places for furniture; else all."""

    def article(node):
        return node.tag == "article" and not node.furniture

    def main(node):
        return node.tag == "main" or node.attributes.get("role") == "main"

    def plain(node):
        return not node.furniture

    return _topmost(root, article, plain) or _topmost(root, main) or _topmost(root, article) or [root]


def _is_menu(node: Node) -> bool:
    """A list most of whose words are links."""
    if node.tag not in ("ul", "ol", "dl"):
        return False
    return 10 * sum(link.words for link in _topmost(node, lambda inner: inner.tag == "a")) >= 8 * node.words


class Page:
    """Blocks of main text, and the subtrees that may turn out to be template.

    hashes: of those subtrees. blocks: (text, numbers of the hashes it lies in). digest: a
    hash of all blocks.
    """

    def __init__(self, page: str):
        self.hashes: list[int] = []
        self.blocks: list[tuple[str, list[int]]] = []
        root = tree(page)
        nodes = _measured(root)
        self.mains = {id(node) for node in main_elements(root)}
        self.body_only = id(root) in self.mains
        # Elements around a main one; children come after the element they are in.
        self.around = set(self.mains)
        for node in reversed(nodes):
            if any(id(part) in self.around for part in node.elements()):
                self.around.add(id(node))
        self.most = root.words / 2
        self._walk(root)
        said = "\n".join(text for text, _ in self.blocks).encode("utf-8", "replace")
        self.digest = int.from_bytes(blake2b(said, digest_size=8).digest(), "little", signed=True)

    def _walk(self, root: Node) -> None:
        inline: list[str] = []

        def end_block(under):
            text = " ".join(unescape("".join(inline)).split())
            inline.clear()
            if text:
                self.blocks.append((text, list(under)))

        # (element or text, in the main text, hashes it lies in); no element ends a block.
        waiting: list[tuple] = [(root, False, ())]
        while waiting:
            part, inside, under = waiting.pop()
            if type(part) is str:
                if inside:
                    inline.append(part)
                continue
            block = part is None or part.tag in BLOCK
            if inside and block:
                end_block(under)
            if part is None:
                continue
            within = inside or id(part) in self.mains
            gone = inside and self._is_gone(part)
            if self._is_counted(part, inside):
                self.hashes.append(part.hash)
                inner = (*under, len(self.hashes) - 1)
            else:
                inner = under
            if part.tag == "br" and inside:
                inline.append(" ")
            elif not gone and (within or id(part) in self.around):
                if within and block:
                    waiting.append((None, True, inner))
                waiting.extend((child, within, inner) for child in reversed(part.parts))
        end_block(())

    def _is_counted(self, node: Node, inside: bool) -> bool:
        if node.tag not in BLOCK or not 0 < node.words <= self.most or node.tag in ("html", "body", "head"):
            return False
        if id(node) in self.around:
            return False
        return self.body_only or not inside or node.furniture or node.tag not in PROSE

    def _is_gone(self, node: Node) -> bool:
        if node.tag == "header" and not self.body_only:
            # An article's own header holds its title.
            return not _topmost(node, lambda inner: inner.tag in ("h1", "h2"))
        return node.furniture or (self.body_only and _is_menu(node))


def parse(pages: DataFrame) -> DataFrame:
    """page_id, url, html -> page_id, url, host, digest, hashes, blocks; one row per row."""

    def run(batches):
        for batch in rows.parts(batches, "html"):
            urls = batch.column("url").to_pylist()
            found = [Page(text) for text in batch.column("html").to_pylist()]
            hosts = [match[1].lower() if (match := HOST.match(url or "")) else "" for url in urls]
            blocks = [[{"text": text, "under": under} for text, under in page.blocks] for page in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(hosts, pa.string()),
                    pa.array([page.digest for page in found], pa.int64()),
                    pa.array([page.hashes for page in found], pa.list_(pa.int64())),
                    pa.array(blocks, pa.list_(pa.struct([("text", pa.string()), ("under", pa.list_(pa.int32()))]))),
                ],
                names=["page_id", "url", "host", "digest", "hashes", "blocks"],
            )

    given = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    return given.mapInArrow(
        run,
        "page_id long, url string, host string, digest long, hashes array<long>,"
        " blocks array<struct<text: string, under: array<int>>>",
    )


def templates(parsed: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """host, hash, pages: subtrees that recur around different main texts of a host."""
    seen = parsed.select("host", "digest", F.explode("hashes").alias("hash")).distinct()
    return seen.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= min_pages)


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, html -> page_id, url, text, n_chars: one row per row."""
    parsed = settle(parse(pages).withColumn("place", F.monotonically_increasing_id()))
    # Only blocks that lie in a counted subtree depend on the counts.
    open_ = F.exists("blocks", lambda block: F.size(block["under"]) > 0)
    settled = parsed.filter(~open_).select("page_id", "url", "blocks", F.array().cast("array<long>").alias("gone"))
    waiting = parsed.filter(open_)
    numbers = F.array_distinct(F.flatten(F.transform("blocks", lambda block: block["under"])))
    asked = waiting.select("place", "host", F.explode(numbers).alias("number"), "hashes").select(
        "place", "host", F.col("hashes")[F.col("number")].alias("hash"), (F.col("place") % SALT).cast("int").alias("salt")
    )
    salts = F.explode(F.array(*map(F.lit, range(SALT)))).alias("salt")
    known = templates(parsed, min_pages).select("host", "hash", salts)
    gone = asked.join(known, ["host", "hash", "salt"]).groupBy("place").agg(F.collect_set("hash").alias("gone"))
    looked = waiting.join(gone, "place", "left").select(
        "page_id",
        "url",
        F.filter(
            "blocks",
            lambda block: ~F.exists(
                block["under"], lambda i: F.coalesce(F.array_contains("gone", F.col("hashes")[i]), F.lit(False))
            ),
        ).alias("blocks"),
        F.coalesce("gone", F.array().cast("array<long>")).alias("gone"),
    )
    text = F.array_join(F.transform("blocks", lambda block: block["text"]), "\n")
    return (
        settled.unionByName(looked)
        .select("page_id", "url", text.alias("text"))
        .withColumn("n_chars", F.length("text").cast("long"))
    )
