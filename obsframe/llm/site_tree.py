"""Main text of web pages by site style trees: what a site repeats from page to page carries no content.

The DOMs of a host are merged: elements with the same path of tags and names are one node. A node's presentation
importance is the entropy of the child sequences it occurs with, its content importance falls with the entropy of each
of its texts and links over pages. Where a host has few pages, a tree of all hosts, merged by the same paths, fills in.
"""

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import blocks, schema_with
from obsframe.operators.lookup import lookup_join
from obsframe.workspace import materialize

BLOCK_BYTES = 4 << 20
# Elements nested deeper only part blocks.
DEEPEST = 200
# Pages that the next wider tree, and for that the element's role, counts as.
PRIOR = 10
# Share that each further child takes from the children's importance and gives to the order they come in.
DAMPING = 0.9
# A branch below this importance, weighted by its role, goes.
LEAST = 0.3
WEIGHTS = {"content": 1.0, "inner": 1.0, "neutral": 0.6, "outside": 0.25, "noise": 0.25}
PRIORS = {"content": 1.0, "inner": 1.0, "neutral": 1.0, "outside": 0.5, "noise": 0.0}

# Names of elements, as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = "script|style|template|noscript|iframe|object|svg|math|textarea|select|title|audio|video|canvas|xmp|noembed|noframes"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
}
SCOPES = frozenset("html body table td th caption button".split())
# Elements and words of names that mark what is not the text of a page.
NOISE_TAGS = frozenset("nav aside footer form button dialog menu fieldset input".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs colophon comment comments consent "
    "contentinfo cookie cookies copyright disclaimer discussion disqus footer gdpr legal login menu modal nav navbar navigation "
    "newsletter notice notices notification pager pagination popup promo promoted promotion recommended related replies respond "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({UNREAD})(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """An element of a page: ``path`` names it in the tree; ``parts`` are texts of its own and elements, in order."""

    __slots__ = ("tag", "path", "role", "parts", "links", "inside", "parent", "depth")

    def __init__(self, tag: str, path: int, role: str, inside: bool, parent: "Node | None") -> None:
        self.tag, self.path, self.role, self.inside, self.parent = tag, path, role, inside, parent
        self.depth = parent.depth + 1 if parent else 0
        self.parts: list = []
        self.links: list[str] = []


class Paths:
    """Number of a node by its parent's and its own names; digits in names count as one, so numbered ids agree."""

    def __init__(self) -> None:
        self.known: dict[tuple[int, str], int] = {}

    def of(self, parent: int, name: str) -> int:
        key = (parent, name)
        if key not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[key] = number(f"{parent} {name}")
        return self.known[key]


def number(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def names_of(attributes: str) -> tuple[str, set[str], dict[str, str]]:
    """The class and id as part of a path, their words, and all attributes."""
    found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)} if attributes.strip(" /") else {}
    named = " ".join(found.get(k, "") for k in ("class", "id", "role"))
    words = {w.lower() for w in WORDS.findall(named)} if named.strip() else set()
    return re.sub(r"\d+", "0", named).strip(), words, found


def role_of(tag: str, words: set[str], found: dict[str, str], parent: Node) -> str:
    if parent.role == "noise":
        return "noise"
    if tag in ("html", "body"):
        return "neutral"
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    if hidden:
        return "noise"
    if tag in ("article", "main") or "main" in words and "role" in found:
        return "content"
    if tag in NOISE_TAGS or words & NOISE_WORDS or not parent.inside and (tag == "header" or "header" in words):
        return "noise"
    if parent.inside and re.fullmatch("p|h[1-6]|header|hgroup|blockquote|pre|li|ul|ol|dl|dd|dt|table|tbody|thead|tfoot|tr|td|th|figure|figcaption|caption|section|summary|details|address", tag):
        return "content" if parent.role == "content" else parent.role
    return "neutral"


def parse(html: str, paths: Paths) -> Node:
    """The page as a tree of block elements; inline elements leave only their text. Elements that end without a tag,
    tags that close nothing and scripts are handled as HTML says; a tag cut off by the end of the page is no text."""
    root = Node("", 0, "neutral", False, None)
    here, at = root, 0
    for token in TOKEN.finditer(html):
        if token.start() > at:
            here.parts.append(html[at : token.start()])
        at = token.end()
        closing, tag = token[2], token[3]
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            if tag not in INLINE:
                here = _closed(here, tag)
            continue
        if tag in INLINE:
            if tag == "br":
                here.parts.append(" ")
            elif tag in ("a", "img"):
                found = names_of(token[4])[2]
                here.links.append(found.get("href") or found.get("src") or "")
            continue
        if tag in CLOSES_P:
            here = _closed(here, "p")
        if tag in IMPLIED:
            ended, within = IMPLIED[tag]
            up = here
            while up.parent is not None and up.tag not in within:
                if up.tag in ended:
                    here = up.parent
                up = up.parent
        if tag in ("html", "body", "head") and any(n.tag == tag for n in _above(here)):
            continue
        if tag == "body":
            here = _closed(here, "head")
        named, words, found = names_of(token[4])
        role = role_of(tag, words, found, here)
        node = Node(tag, paths.of(here.path, f"{tag} {named}"), role, here.inside or role == "content" and tag not in ("html", "body"), here)
        here.parts.append(node)
        if tag not in VOID and node.depth < DEEPEST:
            here = node
    if at < len(html):
        here.parts.append(html[at:])
    return root


def _above(node: Node) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def _closed(here: Node, tag: str) -> Node:
    """Where reading goes on after the end of ``tag``; an end of nothing that is open changes nothing. A paragraph is
    not ended from within a table cell or a button."""
    for node in _above(here):
        if node.tag == tag and node.parent is not None:
            return node.parent
        if tag == "p" and node.tag in SCOPES:
            break
    return here


def texts_of(node: Node) -> Iterator[tuple[int, str]]:
    """(index in ``parts``, text) of the node's own blocks: what stands between its elements."""
    held, begin = [], 0
    for at, part in enumerate([*node.parts, None]):
        if isinstance(part, str):
            if not held:
                begin = at
            held.append(part)
        elif held:
            text = " ".join(unescape("".join(held)).split())
            if text:
                yield begin, text
            held = []


def visible(node: Node) -> Iterator[Node]:
    yield node
    for part in node.parts:
        if isinstance(part, Node) and part.tag != "head":
            yield from visible(part)


def evidence(page: Node, host: str) -> set[tuple[int, int, int]]:
    """(node, kind, feature) that a page adds to its host's tree: that the node is there (0), the sequence of its
    elements (1), and each text and link of its own (2). The host's name counts as a word of all hosts."""
    found = set()
    for node in visible(page):
        found.add((node.path, 0, 0))
        children = " ".join(part.tag for part in node.parts if isinstance(part, Node))
        found.add((node.path, 1, number(children)))
        for _, text in texts_of(node):
            found.add((node.path, 2, number(text.replace(host, "\x00") if host else text)))
        for link in node.links:
            found.add((node.path, 2, number("\x01" + (link.replace(host, "\x00") if host else link))))
    return found


def article_of(page: Node) -> tuple[int, set[int]]:
    """A number of all text of the page's article, equal for its copies, and the nodes that no name settles in it."""
    inside = [node for node in visible(page) if node.inside and node.role != "noise"]
    inner = {node.path for node in inside if node.role == "neutral"}
    return number("\x00".join(text for node in inside for _, text in texts_of(node))) if inner else 0, inner


def host_of(url: str) -> Column:
    """Lower-cased host of a URL, without port and account; empty where there is none."""
    host = F.lower(F.regexp_extract(F.col(url), r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.coalesce(host, F.lit(""))


def importance(pages: Column, features: Column, logs: Column) -> Column:
    """1 less the mean entropy of features over pages: one that stands on c of m pages has log c by log m."""
    return F.when((pages < 2) | (features < 1), 1.0).otherwise(1 - logs / (features * F.log(pages)))


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, nodes): of every host of ``pages`` (host, html) its nodes with ``content`` and ``presentation``
    importance, as (node, content, presentation) structs.

    Pages are read where they are; features are counted within blocks of pages before they are shuffled, first by host
    and from there over all hosts. Copies of an article count as one page for what no name settles in it: they repeat the
    article, not the site. A node's importance on its host is drawn to the one on all hosts by as much as
    PRIOR pages; the latter is settled by roles when pages are read (:func:`extract`), so its count comes along.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = Paths()
        for block in blocks(batches, "html", BLOCK_BYTES):
            found: Counter = Counter()
            for host, html in zip(block.column("host").to_pylist(), block.column("html").to_pylist()):
                page = parse(html or "", paths)
                article, inner = article_of(page)
                found.update((host, *e, article if e[0] in inner else 0) for e in evidence(page, host))
            rows = list(found)
            columns = [pa.array([r[n] for r in rows], kind) for n, kind in enumerate((pa.string(), pa.int64(), pa.int8(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found.values(), pa.int64())], names=[*FEATURE, "pages"])

    seen = pages.select("host", "html").mapInArrow(count, "host string, node bigint, kind byte, feature bigint, article bigint, pages bigint")
    seen = materialize(seen.groupBy(*FEATURE).agg(F.sum("pages").alias("pages")), "page-features")
    own = _importances(_counted(seen, ["host", "node", "kind", "feature"]), ["host", "node"])
    everywhere = seen.groupBy("node", "kind", "feature", "article").agg(F.sum("pages").alias("pages"))
    everywhere = materialize(_importances(_counted(everywhere, ["node", "kind", "feature"]), ["node"]).select("node", *[F.col(c).alias(f"all_{c}") for c in NODE]), "all-hosts")
    # A row per node of a host meets one row.
    joined = lookup_join(materialize(own, "host-nodes"), everywhere, ["node"], stored=True)
    node = F.struct("node", *NODE, *[f"all_{c}" for c in NODE])
    return joined.groupBy("host").agg(F.sort_array(F.collect_list(node)).alias("nodes"))


NODE = ("pages", "content", "presentation")
FEATURE = ("host", "node", "kind", "feature", "article")


def _counted(seen: DataFrame, by: list[str]) -> DataFrame:
    """Pages by feature; those with the same article are one."""
    return seen.groupBy(*by).agg(F.sum(F.when(F.col("article") == 0, F.col("pages")).otherwise(1)).alias("pages"))


def _importances(seen: DataFrame, by: list[str]) -> DataFrame:
    style, feature = F.col("kind") == 1, F.col("kind") == 2
    count = F.col("pages")
    sums = seen.groupBy(*by).agg(
        F.max(F.when(F.col("kind") == 0, count)).alias("m"),
        F.count_if(feature).alias("features"), F.sum(F.when(feature, F.log(count))).alias("logs"),
        F.sum(F.when(style, count * F.log(count))).alias("styled"),
    )
    m = F.col("m")
    return sums.select(
        *by, m.alias("pages"), importance(m, F.col("features"), F.col("logs")).alias("content"),
        F.when(m < 2, 1.0).otherwise(1 - F.col("styled") / (m * F.log(m))).alias("presentation"),
    )


class Tree:
    """Importances of a host's nodes, by role."""

    def __init__(self, nodes: list[dict]) -> None:
        self.nodes = {n["node"]: n for n in nodes}

    def of(self, path: int, kind: str, role: str) -> float:
        n = self.nodes.get(path)
        if n is None:  # a page that the tree was not made from
            return PRIORS[role]
        over_all = (n["all_pages"] * n[f"all_{kind}"] + PRIOR * PRIORS[role]) / (n["all_pages"] + PRIOR)
        on_host = (n["pages"] * n[kind] + PRIOR * over_all) / (n["pages"] + PRIOR)
        # Text of an article may be repeated, by copies or quotes, on a host or everywhere: it counts half at least.
        return 0.5 + 0.5 * max(over_all, on_host) if role == "content" else on_host


def main_text(page: Node, tree: Tree) -> list[str]:
    """The texts that matter, in order: an element's own texts go if their weighted importance is below LEAST; in an
    article they also stay if that of the element is not. Whatever else stands in an element takes no text of its own
    away. An article without any text frames nothing.

    Importance of an element is that of its elements with text and its texts, on average, less DAMPING for each, and for
    the rest that of the sequences it comes with."""
    texts = {id(node): dict(texts_of(node)) for node in visible(page)}
    framed = any(node.inside and node.role != "noise" and texts[id(node)] for node in visible(page))
    kept: list[str] = []
    spoken: set[int] = set()

    def weigh(node: Node) -> float | None:
        role = node.role
        if role == "neutral" and (framed or node.inside):
            role = "inner" if node.inside else "outside"
        text = tree.of(node.path, "content", role)
        below = [w for part in node.parts if isinstance(part, Node) and part.tag != "head" and (w := weigh(part)) is not None]
        own = [text] * len(texts[id(node)])
        n = len(below) + len(own)
        if not n:
            return None
        share = DAMPING**n
        worth = (1 - share) * tree.of(node.path, "presentation", role) + share * sum(below + own) / n if below else text
        if max(text, worth if node.inside else 0.0) * WEIGHTS[role] >= LEAST:
            spoken.add(id(node))
        return worth

    def gather(node: Node) -> None:
        own = texts[id(node)] if id(node) in spoken else {}
        for at, part in enumerate(node.parts):
            if at in own:
                kept.append(own[at])
            if isinstance(part, Node) and part.tag != "head":
                gather(part)

    weigh(page)
    gather(page)
    return kept


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text) per page: its main text, blocks joined by one blank.

    An element's role weighs its importance: text in an article or main element counts in full, elements and names
    that mark menus, headers, footers, sidebars, notices, adverts, forms and comments count little, and so does what
    stands beside an article; all else stays or goes by entropy alone. Scripts, styles, hidden elements and markup are
    no text; character references are decoded, white space in a block becomes one blank. A NULL or empty page has an
    empty text; pages without a host share a tree; rows that repeat each get their row. Other columns are not looked
    at. Trees of hosts are broadcast only if small, else pages and trees meet by host, hot hosts apart.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"), host_of(url).alias("host"))
    trees = materialize(style_tree(rows), "style-trees")
    joined = lookup_join(rows, trees, ["host"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, host, tree = Paths(), None, None
        for block in blocks(batches, "html", BLOCK_BYTES):
            texts = []
            hosts, nodes = block.column("host"), block.column("nodes")
            for at, page in enumerate(block.column("html").to_pylist()):
                if hosts[at].as_py() != host or tree is None:
                    host, tree = hosts[at].as_py(), Tree(nodes[at].as_py() or [])
                texts.append(" ".join(main_text(parse(page or "", paths), tree)))
            yield pa.RecordBatch.from_arrays([block.column("key"), block.column("url"), pa.array(texts, pa.string())], names=["key", "url", "text"])

    out = schema_with(rows.select("key", "url"), {"text": "string"})
    return joined.select("key", "url", "html", "host", "nodes").mapInArrow(run, out).withColumnRenamed("key", key)
