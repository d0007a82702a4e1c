"""Main text of web pages by a site style tree.

Each page is read into blocks of text with their style paths: the block elements around
them, named by tag and class. All blocks but scripts and styles enter the tree: the pages
of one host are merged over these paths. A node's importance has two sides.

Content: 1 minus the mean entropy of the texts below the node over the host's pages; a
text on one page has entropy 0, one on every page 1. Few pages tell little, so a node's
content importance is shrunk towards that of the same path over all hosts, by the weight
of ``SHRINK`` pages; no size of a host switches anything.

Presentation: a prior between 0 and 1 from what elements say they are. Menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and comments have 0. A class,
id or role says so if all its parts do or are common parts of layout names: ``nav-bar``
does, ``market-share`` doesn't. An element that swallowed the page doesn't count: a form
around the main text, or an element that is never closed and has the article inside.
Beside an ``article`` or ``main`` other branches have the less prior the greater its share
of the page's text is, none from ``ENOUGH`` on.

A block's importance is the least of its prior and the content importance of the nodes
around it; it stays if that is ``LEAST`` or more. A page that would lose all its text keeps what its elements
say is content.

A null or empty page, or one without text, gives an empty text. A null URL, or one without
a host, belongs to the host of no name. A page that appears twice counts once in the tree.
Equal pages of one host get equal texts. Columns of the input named like added ones are
replaced.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, stored

LEAST = 0.3
SHRINK = 2
ENOUGH = 0.25
WRAPS = 0.9  # share of the text from which a form is the page rather than a part of it
DEPTH = 32  # names in a path; nodes further down are named by a hash of those above
MOST_BROADCAST = 32 << 20  # bytes of removed nodes of all hosts

# Fixed values of HTML and of usual class names, in alphabetical order.
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_NOISE = set(
    "aside audio button canvas dialog fieldset footer form frameset head header iframe "
    "input label math menu nav noframes noscript object option select svg template video".split()
)
_NOISE_NAMES = set(
    "ad ads advert advertisement alert aside banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies dialog disqus footer gdpr header masthead "
    "menu modal nav navbar navigation newsletter notice overlay pager pagination popup promo "
    "recommended related respond search share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar widget".split()
)
_LAYOUT_NAMES = set(
    "a also area article articles b bar bars block body bottom box boxes btn bottom button "
    "buttons by col column columns container content contents count danger desktop drop "
    "dropdown entry feed first fixed floating follow for global google group here icon icons "
    "info inner item items js last left lg line link links list lists local main md me media "
    "message messages mobile more network now our outer page panel panels post posts primary "
    "reader readers right row secondary section site slot sm sticky stories story success "
    "text the thread title toggle top trail trigger unit units us user users warning wrap "
    "wrapper xs your zone".split()
)
_MAIN = {"article", "main"}
_CARDS = {"card", "excerpt", "preview", "teaser", "tile"}  # articles about other pages
_UNNAMED = {"html", "body", "main"}  # their classes describe the page, not them
#: What an opening tag closes, and within what.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|xmp)(?=[\s/>]).*?(?:</\1[^>]*(?:>|\Z)|\Z)"
    r"""|<(/?)([a-z][a-z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)"""
    r"|<[a-z/!?][^>]*(?:>|\Z)",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(
    r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s"'>]+)))?|["'=/]"""
)
_NAME = re.compile(r"[a-z]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _names(attributes: str) -> tuple[str, set[str], set[str]]:
    """The class as part of a style name, the names in class, id and role that stand for
    noise, and all parts of these."""
    style, noise, words = "", set(), set()
    for m in _ATTRIBUTE.finditer(attributes):
        kind = (m[1] or "").lower()
        if kind == "hidden":
            noise.add("hidden")
        if kind not in ("class", "id", "role"):
            continue
        value = m[2] or m[3] or m[4] or ""
        for token in value.split():
            parts = _NAME.findall(_HUMP.sub("-", token).lower())
            words.update(parts)
            known = {x for x in parts if x in _NOISE_NAMES}
            if known and all(x in known or x in _LAYOUT_NAMES or len(x) == 1 for x in parts):
                noise.update(known)
        found = _NAME.findall(value.lower())
        if kind == "class" and found:
            style = "." + ".".join(found)
    return style, noise, words


class _Element:
    """An open or closed block element."""

    __slots__ = ("tag", "path", "main", "noise", "above", "holds", "closed")

    def __init__(self, tag, path, main, noise, above):
        self.tag, self.path, self.main = tag, path, main
        self.noise, self.above = noise, above  # "", "tag" or "name"; the noise around it
        self.holds, self.closed = False, False  # whether the article lies in it


def _below(path: str, name: str) -> str:
    if path.count("/") >= DEPTH:
        path = "/#" + xxhash.xxh3_64_hexdigest(path)
    return f"{path}/{name}"


def blocks(html: str) -> list[tuple[str, str, float]]:
    """The page's blocks as (style path, text, prior), in page order."""
    out: list[tuple[_Element, str]] = []
    stack = [_Element("", "", False, "", None)]
    pieces: list[str] = []

    def end_block() -> None:
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                out.append((stack[-1], text))

    def close(tag: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == tag:
                stack[k].closed = True
                del stack[k:]
                return

    at = 0
    for m in _MARKUP.finditer(html):
        if m.start() > at:
            pieces.append(html[at : m.start()])
        at = m.end()
        if not m[3]:
            continue
        tag = m[3].lower()
        if tag in _INLINE:
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in _VOID and tag != "hr":
            continue
        end_block()
        if m[2]:
            close(tag)
            continue
        if tag == "hr":
            continue
        if stack[-1].tag == "p":
            stack.pop()
        if tag in _CLOSES:
            shut, within = _CLOSES[tag]
            k = len(stack) - 1
            while k > 0 and stack[k].tag not in within:
                if stack[k].tag in shut:
                    del stack[k:]
                k -= 1
        top = stack[-1]
        style, bad, words = _names(m[4]) if m[4] else ("", set(), set())
        if tag in _UNNAMED:
            style, bad, words = "", set(), set()
        if top.main:
            bad.discard("header")  # an article's own heading
        named = tag in _NOISE and not (top.main and tag == "header")
        main = tag in _MAIN and not words & _CARDS
        if main or tag == "h1":
            above = top if top.noise else top.above
            while above:
                above.holds = above.holds or main or above.tag == "form"
                above = above.above
        stack.append(
            _Element(
                tag,
                _below(top.path, tag + style),
                top.main or main,
                "name" if bad else "tag" if named else "",
                top if top.noise else top.above,
            )
        )
    if at < len(html):
        pieces.append(html[at:])
    end_block()
    return _with_priors(out)


def _with_priors(found: list[tuple[_Element, str]]) -> list[tuple[str, str, float]]:
    def around(element: _Element) -> set[_Element]:
        """The noise elements around a block that haven't just swallowed the page."""
        noise = set()
        one = element if element.noise else element.above
        while one:
            swallowed = one.holds and (one.tag == "form" or not one.closed)
            if one.noise == "name" or not swallowed:
                noise.add(one)
            one = one.above
        return noise

    noise: dict[_Element, set[_Element]] = {}
    for element, _ in found:
        if element not in noise:
            noise[element] = around(element)
    # A form around nearly all text that is in no other noise is the page.
    free, within = 0, {}
    for element, text in found:
        own = noise[element]
        if len(own) == 1 and (form := next(iter(own))).tag == "form" and form.noise == "tag":
            within[form] = within.get(form, 0) + len(text)
        free += len(text) if not own or own & within.keys() else 0
    for form, size in within.items():
        if size >= WRAPS * free and size >= 400:
            for own in noise.values():
                own.discard(form)
    sizes = {True: 0, False: 0}
    for element, text in found:
        if not noise[element]:
            sizes[element.main] += len(text)
    share = sizes[True] / max(1, sizes[True] + sizes[False])
    beside = max(0.0, 1 - share / ENOUGH)
    return [
        (e.path, text, 0.0 if noise[e] else 1.0 if e.main else beside) for e, text in found
    ]


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; empty if there is none."""
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
    return F.lower(F.coalesce(F.regexp_extract(url, pattern, 1), F.lit("")))


def _style_blocks(pages: pa.Array) -> pa.Array:
    """Of each page the distinct (path, hash of the text) of its blocks."""
    rows = []
    for html in pages.to_pylist():
        found = {f"{path}\t{text}" for path, text, _ in blocks(html or "")}
        rows.append(sorted(found))
    return pa.array(rows, pa.list_(pa.string()))


def style_tree(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """The merged tree: host, node and its content importance."""
    listed = F.arrow_udf(_style_blocks, T.ArrayType(T.StringType()))
    each = pages.select(
        host_of(F.col(url)).alias("host"),
        F.xxhash64(html).alias("page"),
        F.explode(listed(html)).alias("block"),
    ).select(
        "host",
        "page",
        F.substring_index("block", "\t", 1).alias("path"),
        F.xxhash64("block").alias("content"),
    )
    # A page counts once, however often it appears.
    counts = stored(
        each.distinct()
        .groupBy("host", "path", "content")
        .agg(F.count("*").alias("n"))
    )
    sites = pages.select(host_of(F.col(url)).alias("host"), F.xxhash64(html).alias("page"))
    sites = stored(sites.distinct().groupBy("host").agg(F.count("*").alias("pages")))
    everywhere = sites.agg(F.sum("pages").alias("pages"))
    merged = counts.groupBy("path", "content").agg(F.sum("n").alias("n"))
    merged = merged.select(F.lit(None).cast("string").alias("host"), "path", "content", "n")
    everywhere = everywhere.withColumn("host", F.lit(None).cast("string"))
    leaves = counts.union(merged).join(
        sites.unionByName(everywhere).withColumnRenamed("host", "site"),
        F.col("host").eqNullSafe(F.col("site")),
    )
    entropy = F.when(F.col("pages") > 1, F.log("n") / F.log("pages")).otherwise(F.lit(0.0))
    leaves = leaves.groupBy("host", "path").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.least(entropy, F.lit(1.0))).alias("e"),
        F.max("pages").alias("pages"),
    )
    steps = F.split("path", "/")
    above = F.transform(
        F.sequence(F.lit(2), F.size(steps)),
        lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"),
    )
    above = F.when(F.col("path") != "", above).otherwise(F.array(F.lit("")))
    nodes = stored(
        leaves.withColumn("node", F.explode(above))
        .groupBy("host", "node")
        .agg(
            (1 - F.sum("e") / F.sum("n")).alias("own"), F.max("pages").alias("pages")
        )
    )
    shared = nodes.filter(F.col("host").isNull()).select("node", F.col("own").alias("all"))
    weight = F.col("pages") / (F.col("pages") + SHRINK)
    return (
        nodes.filter(F.col("host").isNotNull())
        .join(shared, "node")
        .select(
            "host", "node", (weight * F.col("own") + (1 - weight) * F.col("all")).alias("importance")
        )
    )


def _removed(tree: DataFrame) -> DataFrame:
    """Of each host its own nodes without content importance."""
    low = tree.filter(F.col("importance") < LEAST)
    return low.groupBy(F.col("host").alias("_host")).agg(F.collect_set("node").alias("removed"))


def _texts(pages: pa.Array, removed: pa.Array) -> pa.Array:
    rows = []
    for html, gone in zip(pages.to_pylist(), removed.to_pylist()):
        found = [b for b in blocks(html or "") if b[2] >= LEAST]
        if gone:
            low = set(gone)
            kept = [b for b in found if not _within(b[0], low)]
            found = kept or found
        rows.append("\n".join(text for _, text, _ in found))
    return pa.array(rows, pa.string())


def _within(path: str, nodes: set[str]) -> bool:
    """Whether one of the nodes is on the path."""
    at = path.find("/", 1)
    while at > 0:
        if path[:at] in nodes:
            return True
        at = path.find("/", at + 1)
    return path in nodes


def extract(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """The pages with ``text``: the blocks left by the tree, one a line."""
    removed = stored(_removed(style_tree(pages, html, url)))
    size = F.octet_length("_host") + F.octet_length(F.array_join("removed", "")) + 64
    if (removed.agg(F.sum(size)).first()[0] or 0) <= MOST_BROADCAST:
        removed = F.broadcast(removed)  # else Spark joins by host and splits hot ones
    text = F.arrow_udf(_texts, T.StringType())
    out = fresh(pages, "text", "_host", "removed").withColumn("_host", host_of(F.col(url)))
    kept = [c for c in out.columns if c != "_host"]
    joined = out.join(removed, "_host", "left")
    return joined.withColumn("text", text.asNondeterministic()(html, "removed")).select(
        *kept, "text"
    )
