"""HTML extraction with site style trees.

Pages of one host are merged into one tree: an element node is a path of tags (with the first class), and holds how many
pages have it, the styles of its children (their sequence of tags, runs counted once) and the contents of its blocks.
A node's importance is, as in site style trees, the entropy of its styles over the pages that have it (base: their
number) for presentation, and one minus the entropy of its contents for content; an element passes on the importance of
its children with the factor ``GAMMA``, so that beyond ``REACH`` levels nothing that counts is left. A branch with an
importance below ``LEAST`` on a host with at least ``PAGES`` pages is the site's, not the page's, and goes.

Entropy alone cannot tell an advert that differs on every page from an article, so outside articles what a branch is
called decides first: elements that by element, class or role hold menus, headers, footers, sidebars, notices, adverts,
forms or comments go, and the tree decides the rest. Where a page has an article (or a main element), that is its text.
Inside it only adverts and comments go by class alone; other names count where the tree calls the branch unimportant as
well. Names never count on an article, and above it only where the page has another article, or text and the article is a
comment. Names are whole classes or roles; an id is an anchor and names nothing.

A block is made of runs of text, each of which belongs to the element it stands in: what goes with an inline element
leaves the rest of its block whole.

Counting is a shuffle of (host, node, feature) with counts; a page gets its host's unimportant nodes by a join that
broadcasts those of hosts with very many pages, so no host needs a task of its own. Paths are 64-bit hashes, each made of
the one above, so an element costs the same however deep it stands; a page is read in time proportional to its length.

Null and empty pages have the empty text. A page without a host is a host of its own with all such pages. Unclosed
elements end where their parent does; text outside any block is a block; a bracket that no tag ends is text.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.llm.shared import joined_to_groups, on_own_columns, written
from tickbars.llm.words import slices

GAMMA = 0.9
LEAST = 0.2
PAGES = 4
#: GAMMA to the power of REACH is below LEAST: an element's importance never saves a branch so many levels above.
REACH = 16

#: Elements of HTML by what they do here.
SILENT = frozenset("script style head title noscript template svg iframe object canvas video audio map select "
                   "textarea button option datalist".split())  # fmt: skip
RAW = frozenset("script style title textarea noscript iframe template svg".split())
CHROME = frozenset("nav footer aside form menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: An element that begins ends open elements of these kinds, up to the nearest container.
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
CONTAINERS = frozenset("table ul ol dl div section article main body html".split())
#: Classes and roles that name adverts, comments, and whatever else is not the article.
ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored sponsors".split())
COMMENTS = frozenset("comment comments commentlist respond disqus".split())
REPLIES = COMMENTS | frozenset("reply replies discussion".split())
CHROME_WORDS = ADVERTS | REPLIES | frozenset(
    "promo promotion banner banners nav "
    "navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer foot bottombar sidebar sidebars "
    "aside rail widget widgets related recommended notice notices cookie cookies consent gdpr alert popup modal overlay "
    "newsletter subscribe subscription signup login search share sharing social toolbar pagination pager form "
    "contentinfo complementary skip".split()
)

_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
#: What ends a tag, or begins a quoted value.
_STOP = re.compile(r">|=\s*[\"']")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
#: One attribute with its value, so that nothing inside a value is taken for a name.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_SPACE = re.compile(r"[\s​]+")


def _named(attributes: str) -> tuple[str, bool, frozenset[str]]:
    """The first class, whether the element is hidden, and its classes and roles that name what is not the article."""
    first, hidden, names = "", False, set()
    for name, value in _ATTRIBUTE.findall(attributes):
        value, name = value.strip("\"'").lower(), name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            hidden = True
        elif name in ("class", "role"):
            names.update(value.split())
            if name == "class" and not first:
                first = value.split()[0] if value.split() else ""
    return first, hidden, CHROME_WORDS & names


def _hash(above: int, step: str) -> int:
    """The path of an element from the path above it, as a signed 64-bit number."""
    data = above.to_bytes(8, "little", signed=True) + step.encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def path_of(path: str) -> int:
    """The hash of a path written out, such as ``>body>div.menu``."""
    found = 0
    for step in path.split(">")[1:]:
        found = _hash(found, step)
    return found


class Node:
    """An open or closed element: its tag, its node in the style tree, and flags handed down.

    ``outer`` is 1 below a name outside articles and 2 below one of comments; ``named`` tells that the element itself is
    named, inside an article.
    """

    __slots__ = ("tag", "path", "parent", "chrome", "inside", "outer", "named", "children")

    def __init__(self, tag: str, path: int, parent: Node | None, chrome: bool, inside: bool, outer: int = 0, named: bool = False):
        self.tag, self.path, self.parent, self.chrome, self.inside = tag, path, parent, chrome, inside
        self.outer, self.named = outer, named
        self.children: list[str] = []


class _Tokens:
    """Comments, tags and text of a page, one after the other, none of it read twice."""

    def __init__(self, page: str):
        self.page, self.at = page, 0
        #: Whether quotes count: not any more after a quoted value that runs over the end of the last tag.
        self.quotes = True
        #: Characters that do not occur from here on.
        self.gone: set[str] = set()

    def _find(self, what: str, start: int) -> int:
        if what in self.gone:
            return -1
        found = self.page.find(what, start)
        if found < 0:
            self.gone.add(what)
        return found

    def _tag_end(self, start: int) -> int:
        """Where the tag ends whose attributes start here, or -1."""
        if not self.quotes:
            return self._find(">", start)
        while True:
            stop = _STOP.search(self.page, start)
            if not stop:
                self.quotes = False
                return -1
            if stop[0] == ">":
                return stop.start()
            closed = self._find(stop[0][-1], stop.end())
            # A quote that nothing closes is a character like others.
            start = stop.end() if closed < 0 else closed + 1

    def __iter__(self):
        page = self.page
        while self.at < len(page):
            at = self.at
            if page[at] != "<":
                end = self._find("<", at)
                self.at = end if end >= 0 else len(page)
                yield None, page[at : self.at]
                continue
            if page.startswith("<!--", at):
                end = self._find("-->", at + 4)
                self.at = end + 3 if end >= 0 else len(page)
                continue
            name = _NAME.match(page, at + 1)
            if name and self._find(">", at) >= 0:
                end = self._tag_end(name.end())
                if end >= 0:
                    self.at = end + 1
                    yield name[0], page[name.end() : end]
                    continue
            elif not name and page[at + 1 : at + 2] in ("!", "?"):
                end = self._find(">", at)
                if end >= 0:
                    self.at = end + 1
                    continue
            self.at = at + 1
            yield None, "<"

    def skip_raw(self, tag: str) -> None:
        """Go behind the end of an element whose inside is no markup."""
        end = None if tag in self.gone else _RAW_END[tag].search(self.page, self.at)
        if end is None:
            self.gone.add(tag)
        self.at = end.end() if end else len(self.page)


Block = list[tuple[Node, str]]


def parsed(page: str) -> tuple[list[Block], list[Node]]:
    """The blocks of a page in order, as runs of text with the element each stands in; and all elements."""
    root = Node("", 0, None, False, False)
    stack, nodes, blocks, held = [root], [], [], []
    is_open: Counter[str] = Counter()

    def flush():
        if any(not text.isspace() for _, text in held):
            blocks.append(held.copy())
        held.clear()

    def pop() -> str:
        tag = stack.pop().tag
        is_open[tag] -= 1
        return tag

    tokens = _Tokens(page)
    for name, text in tokens:
        if name is None:
            held.append((stack[-1], text))
            continue
        tag, attributes = name.lower(), text
        if tag[0] == "/":
            tag = tag[1:]
            if is_open[tag] > 0:
                if tag in BLOCKS:
                    flush()
                # Inline elements left open end silently with the block.
                while pop() != tag:
                    pass
            continue
        if tag in RAW:
            # Nothing inside is markup or text of the page.
            if not attributes.rstrip().endswith("/"):
                tokens.skip_raw(tag)
            continue
        if tag == "br":
            held.append((stack[-1], " "))
            continue
        if tag in BLOCKS:
            flush()
            if tag not in ("li", "td", "th", "tr", "dt", "dd") and is_open["p"] > 0:
                _close(stack, pop, {"p"}, CONTAINERS | {"li", "td", "th", "blockquote"})
            if any(is_open[x] > 0 for x in CLOSES.get(tag, ())):
                _close(stack, pop, CLOSES[tag], CONTAINERS - ({"div"} if tag in ("li", "dt", "dd") else set()))
        if tag in VOID:
            continue
        above = stack[-1]
        first, hidden, names = _named(attributes) if attributes.strip() else ("", False, frozenset())
        chrome = hidden and tag not in ("html", "body", "main")
        step = f"{tag}.{first}" if first else tag
        outer, named = above.outer, False
        if names and tag not in ("html", "body", "main", "article"):
            if not above.inside:
                outer = max(outer, 2 if names & REPLIES else 1)
            elif names & (ADVERTS | COMMENTS):
                chrome = True
            else:
                named = True
        page_header = tag == "header" and not above.inside
        node = Node(
            tag,
            _hash(above.path, step),
            above,
            above.chrome or chrome or tag in CHROME or tag in SILENT or page_header,
            above.inside or tag in ("article", "main"),
            outer,
            named,
        )
        above.children.append(step)
        nodes.append(node)
        if attributes.rstrip().endswith("/") and tag not in BLOCKS:
            continue
        stack.append(node)
        is_open[tag] += 1
    flush()
    return blocks, nodes


def _close(stack: list[Node], pop, tags: set[str], until: frozenset[str]) -> None:
    """End the nearest open element of some tags, unless a container comes first."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            while len(stack) > i:
                pop()
            return
        if stack[i].tag in until:
            return


def _text(runs: Block) -> str:
    return _SPACE.sub(" ", entities.unescape("".join(text for _, text in runs))).strip()


def main_text(page: str | None, unimportant: frozenset[int | str] = frozenset()) -> str:
    """The article's blocks, joined by line ends; ``unimportant`` has the paths of the host's own branches."""
    blocks, nodes = parsed(page or "")
    low = {path_of(path) if isinstance(path, str) else path for path in unimportant}
    # Below a named branch that is unimportant, handed down in the order of the elements.
    doubted = set()
    for node in nodes:
        if node.parent in doubted or node.named and node.path in low:
            doubted.add(node)

    def kept(fits) -> list[str]:
        texts = (_text([run for run in block if not run[0].chrome and fits(run[0])]) for block in blocks)
        return [text for text in texts if text]

    for outer in (0, 1):
        texts = kept(lambda node: node.inside and node not in doubted and node.outer <= outer)  # noqa: B023
        if texts:
            return "\n".join(texts)
    # What is important by itself stays, however far below a branch that it cannot make important any more.
    rest = kept(lambda node: not node.inside and not node.outer and node.path not in low)
    return "\n".join(rest or kept(lambda node: node.inside and node not in doubted))


def _features(page: str | None) -> tuple[set[tuple[int, str, str]], list[Node]]:
    """(path, kind, feature) of a page, its elements' child styles and its blocks' contents; and its elements."""
    blocks, nodes = parsed(page or "")
    found = set()
    for node in nodes:
        style = [tag for i, tag in enumerate(node.children) if i == 0 or tag != node.children[i - 1]]
        found.add((node.path, "style", " ".join(style)))
    for block in blocks:
        if text := _text(block):
            found.add((block[0][0].path, "content", text))
    return found, nodes


def _lineage(node: Node) -> list[int]:
    """The element's path and those above it, as far as its importance reaches."""
    found = []
    while node.parent is not None and len(found) < REACH:
        found.append(node.path)
        node = node.parent
    return found


def host(url: Column) -> Column:
    """The host of a URL, lower-cased, or an empty text."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))


def _tree(pages: DataFrame) -> DataFrame:
    """Rows (host, path, lineage, own importance): the merged trees of all hosts, from a frame (host, html)."""

    def counted(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                counts: Counter[tuple] = Counter()
                lineages: dict[int, list[int]] = {0: []}
                hosts = part.column("host").to_pylist()
                for name, page in zip(hosts, part.column("html").to_pylist(), strict=True):
                    found, nodes = _features(page)
                    lineages |= {node.path: _lineage(node) for node in nodes if node.path not in lineages}
                    # Only equality of features matters, so a hash of them travels.
                    counts.update((name, path, kind == "style", hash_of(feature)) for path, kind, feature in found)
                names, paths, styles, features = zip(*counts, strict=True) if counts else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.string()),
                        pa.array(paths, pa.int64()),
                        pa.array([lineages[path] for path in paths], pa.list_(pa.int64())),
                        pa.array(styles, pa.bool_()),
                        pa.array(features, pa.int64()),
                        pa.array(counts.values(), pa.int64()),
                    ],
                    ["host", "path", "lineage", "is_style", "feature", "n"],
                )

    schema = "host string, path long, lineage array<long>, is_style boolean, feature long, n long"
    # A path names its lineage, so that is part of the key.
    counts = pages.mapInArrow(counted, schema).groupBy("host", "path", "lineage", "is_style", "feature").agg(F.sum("n").alias("n"))
    # Entropy to the base of the number of pages m: H = log m - sum(n log n) / m, over log m.
    sums = counts.groupBy("host", "path", "lineage", "is_style").agg(
        F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("nlogn")
    )
    entropy = F.when(F.col("m") > 1, 1 - F.col("nlogn") / F.col("m") / F.log("m")).otherwise(1.0)
    return sums.groupBy("host", "path", "lineage").agg(
        F.max("m").alias("pages"),
        F.coalesce(F.max(F.when(F.col("is_style"), entropy)), F.lit(0.0)).alias("presentation"),
        # Contents that differ from page to page are the pages' own: the entropy over pages is high.
        F.max(F.when(~F.col("is_style"), entropy)).alias("content"),
    )


def hash_of(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def unimportant_branches(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Rows (host, paths): per host the branches that are the site's own."""
    tree = _tree(pages.select(host(F.col(url)).alias("host"), F.col(html).alias("html")))
    own = F.greatest("presentation", F.coalesce("content", F.lit(0.0)))
    # A branch is as important as the most important node in it, less GAMMA for every level in between.
    spread = tree.select("host", "pages", own.alias("own"), F.posexplode("lineage").alias("levels", "path"))
    branches = spread.groupBy("host", "path").agg(
        F.max(F.col("own") * F.pow(F.lit(GAMMA), F.col("levels"))).alias("importance"),
        F.max(F.when(F.col("levels") == 0, F.col("pages"))).alias("pages"),
    )
    low = branches.where((F.col("importance") < LEAST) & (F.col("pages") >= PAGES))
    return low.groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("paths"))


def extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The rows with their main text, in column main_text (another one of that name is replaced)."""
    return on_own_columns(pages, [url, html], ["main_text"], lambda rows: _extracted(rows, url, html))


def _extracted(pages: DataFrame, url: str, html: str) -> DataFrame:
    hosted = pages.withColumn("__host", host(F.col(url)))
    low = unimportant_branches(pages, url, html)
    sizes = hosted.groupBy("__host").agg(F.count(F.lit(1)).alias("__n"))
    none = F.array().cast("array<long>")
    hosts = written(
        sizes.join(low, F.col("__host") == F.col("host"), "left").select(
            "__host", "__n", F.coalesce("paths", none).alias("__paths")
        ),
        "hosts",
    )
    total = hosts.agg(F.sum("__n").alias("n")).first().n or 0

    def texts(batches):
        for batch in batches:
            for part in slices(batch, html):
                names = [n for n in part.schema.names if n != "__paths"]
                own = [
                    main_text(page, frozenset(paths))
                    for page, paths in zip(
                        part.column(html).to_pylist(), part.column("__paths").to_pylist(), strict=True
                    )
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(own, pa.string())], [*names, "main_text"]
                )

    rows = joined_to_groups(hosted, hosts, ["__host"], "__n", total).select(*pages.columns, "__paths")
    return rows.mapInArrow(texts, T.StructType([*pages.schema.fields, T.StructField("main_text", T.StringType())]))
