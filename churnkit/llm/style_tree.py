"""Main-text extraction by a site style tree.

The DOMs of all pages of a host are merged: elements with the same path (tags,
class names and ids without digits, inline tags left out) are one node.  Two
kinds of entropy give a node its importance, after the number m of pages it is on
(equal pages of a host count once):

* presentation: the entropy (base m) of the child sequences it shows; a menu
  that always looks alike has none;
* content, for nodes with text: one minus the mean entropy (base m) of how each
  distinct block text spreads over the pages; text met on every page counts 0,
  text met once counts 1.

An inner node's importance mixes its presentation and its children's, a node with
l children weighing presentation by 1 - gamma**l.  A branch on at least
``least_pages`` pages of which no node reaches ``threshold`` is noise, and every
page of the host loses it.  Elements that the markup itself declares to be no
content (nav, footer, form, script, role "navigation" ...) are noise on any host,
also one with a single page.  Names ("ad", "sidebar" ...) and the article element
only decide about what the tree has left: a branch with such a class or id goes if
it holds at most half of that text and no article or main (and some text stays);
blocks outside article and main go where these hold at least a third of the text.

Statistics are aggregated before and after the shuffle by node; a host's list of
noise nodes grows with its templates, not with its pages.

Defined cases: null or empty html gives an empty text; a null url, or one without
a host, is the host ""; broken markup is closed as browsers do; text outside any
element is a block of the root; repeated rows are extracted each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.common import stored

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
                     "hr main menu nav ol p pre section table ul".split())
#: A start tag ends an open element of these, up to the given containers.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "option": ({"option"}, {"select"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
            "th": ({"td", "th"}, {"tr", "table"})}
# What markup declares to be no part of an article.
NO_CONTENT = frozenset("nav footer header aside form script style noscript template svg math canvas button select textarea iframe "
                       "object dialog menu head title".split())
NO_CONTENT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
NO_CONTENT_NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
                             "consent gdpr notice notices notification popup modal overlay sidebar menu nav navbar navigation "
                             "breadcrumb breadcrumbs footer header masthead comment comments disqus share sharing social related "
                             "recommended newsletter subscribe subscription login signup search widget pagination pager".split())

#: Blocks outside article and main go where these hold one part in so many of the text.
ARTICLE_SHARE = 3

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _long(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class _Branch:
    """An element whose class or id has one of ``NO_CONTENT_NAMES``; ``outer`` is the next such element around it."""

    __slots__ = ("outer", "article", "size")

    def __init__(self, outer: _Branch | None):
        self.outer, self.article, self.size = outer, False, 0

    def around(self) -> Iterator[_Branch]:
        b = self
        while b:
            yield b
            b = b.outer


class _Element:
    __slots__ = ("tag", "path", "dead", "main", "children", "inline", "named")

    def __init__(self, tag: str, path: str, dead: bool, main: bool, inline: bool = False, named: _Branch | None = None):
        self.tag, self.path, self.dead, self.main, self.children, self.inline, self.named = tag, path, dead, main, [], inline, named


def _open(parent: _Element, tag: str, rest: str) -> _Element:
    label, dead, suspect = tag, tag in NO_CONTENT, False
    if rest:
        names = []
        for key, *values in _ATTRIBUTE.findall(rest):
            key, value = key.lower(), next((v for v in values if v), "")
            if key in ("class", "id"):
                names += value.split()
            elif key == "role":
                dead |= value.strip().lower() in NO_CONTENT_ROLES
            elif key == "hidden" or (key == "aria-hidden" and value == "true") or (
                    key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
                dead = True
        if names:
            parts = {x.lower() for n in names for x in _NAME.findall(n)}
            suspect = bool(parts & NO_CONTENT_NAMES) and tag not in ("html", "body", "main", "article")
            suspect |= tag == "article" and not parts.isdisjoint(("comment", "comments"))
            label += "." + ".".join(sorted({re.sub(r"\d+", "", n.lower()) for n in names}))
    named = _Branch(parent.named) if suspect else parent.named
    if tag in INLINE:  # one that declares itself no content ends the block around it, and its own text is no content
        return _Element(tag, parent.path, parent.dead or dead, parent.main, parent.dead or not (dead or suspect), named)
    main = tag in ("article", "main") and not suspect
    if main and named and not (parent.dead or dead):
        for b in named.around():
            b.article = True
    return _Element(tag, f"{parent.path}/{label}", parent.dead or dead, parent.main or main, named=named)


def parse(page: str | None) -> tuple[list[tuple[str, str, bool, bool, _Branch | None]], list[tuple[str, tuple[str, ...]]]]:
    """(blocks: path, text, declared no content, in main, innermost suspect branch), (elements: path, tags of its children)."""
    text = page or ""
    root = _Element("", "", False, False)
    stack, blocks, elements, pending = [root], [], [], []

    def flush() -> None:
        if pending:
            own = " ".join("".join(pending).split())
            pending.clear()
            if own:
                e = stack[-1]
                blocks.append((e.path, own, e.dead, e.main, e.named))

    def close(count: int) -> None:
        for _ in range(count):
            e = stack[-1]
            if not e.inline:
                flush()
                if e.tag not in INLINE:
                    elements.append((e.path, tuple(e.children)))
            stack.pop()

    at, n = 0, len(text)
    while at < n:
        m = _TOKEN.search(text, at)
        if not m:
            pending.append(entities.unescape(text[at:]))
            break
        if m.start() > at:
            pending.append(entities.unescape(text[at: m.start()]))
        at = m.end()
        end, tag, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if depth:
                if tag not in INLINE or all(e.tag in INLINE for e in stack[depth:]):
                    close(len(stack) - depth)
            continue
        if tag in CLOSES_P:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag not in INLINE), 0)
            if depth and stack[depth].tag == "p":
                close(len(stack) - depth)
        if tag in SIBLINGS:
            ends, stops = SIBLINGS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends:
                    close(len(stack) - k)
                    break
                if stack[k].tag in stops:
                    break
        if tag not in INLINE:
            flush()
            stack[-1].children.append(tag)
        elif tag == "br":
            pending.append(" ")
        if tag in VOID:
            continue
        element = _open(stack[-1], tag, rest)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(text, at)
            at = stop.end() if stop else n
            continue
        if rest.endswith("/") and tag in ("svg", "math", "path"):
            continue
        if not element.inline:
            flush()
        stack.append(element)
    close(len(stack) - 1)
    flush()
    return blocks, elements


def host(url: str = "url") -> Column:
    """Lower-case host of a url, "" for none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page, node and distinct feature: (host, page, node, feature, c, c ln c, 1 on the page's first row of the node).

    ``page`` is a digest of the html: equal pages have equal rows.

    Features of text are even, child sequences odd; a node's parent is sent with its first row.
    """
    for batch in batches:
        rows = []
        for site, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            blocks, elements = parse(page)
            digest = _long(page or "")
            count = Counter((p, _long(t) & ~1) for p, t, *_ in blocks)
            count.update((p, _long(">".join(c)) | 1) for p, c in elements)
            seen = set()
            for (path, feature), c in count.items():
                rows.append((site, digest, _long(path), _long(path.rpartition("/")[0]), feature, c, c * math.log(c), int(path not in seen)))
                seen.add(path)
        cols = list(zip(*rows, strict=True)) or [[]] * 8
        types = [pa.string(), *[pa.int64()] * 5, pa.float64(), pa.int64()]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                              ["host", "page", "node", "parent", "feature", "c", "clnc", "first"])


def _noise(gamma: float, threshold: float):
    def work(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
        rows = {r.node: r for r in nodes.itertuples()}
        children: dict[int, list[int]] = {}
        for r in rows.values():
            if r.parent in rows and r.parent != r.node:
                children.setdefault(r.parent, []).append(r.node)
        importance: dict[int, float] = {}
        noise: set[int] = set()
        order, todo = [], [n for n, r in rows.items() if r.parent not in rows or r.parent == n]
        while todo:
            n = todo.pop()
            order.append(n)
            todo += children.get(n, [])
        for n in reversed(order):  # children first
            r, below = rows[n], children.get(n, [])
            parts = [(importance[c], rows[c].pages) for c in below]
            if r.content == r.content:  # not NaN: the node has text of its own
                parts.append((r.content, r.pages))
            if not parts:
                importance[n] = 0.0
            else:
                mean = sum(i * w for i, w in parts) / sum(w for _, w in parts)
                share = gamma ** len(below)
                importance[n] = (1 - share) * r.presentation + share * mean
            own = r.content if r.content == r.content else 0.0
            if importance[n] < threshold and own < threshold and all(c in noise for c in below):
                noise.add(n)
        return pd.DataFrame({"host": [key[0]], "noise": [sorted(noise)]})

    return work


def noise_nodes(spark: SparkSession, pages: DataFrame, *, least_pages: int = 5, gamma: float = 0.9, threshold: float = 0.4) -> DataFrame:
    """host, noise: the nodes of each host's tree that its pages lose."""
    rows = pages.select(host().alias("host"), "html").mapInArrow(
        _statistics, "host string, page long, node long, parent long, feature long, c long, clnc double, first long")
    # A page counts once however often a host has copies of it.
    rows = rows.groupBy("host", "page", "node", "feature").agg(F.max("c").alias("c"), F.max("clnc").alias("clnc"), F.max("first").alias("first"),
                                                               F.min("parent").alias("parent"))
    features = rows.groupBy("host", "node", "feature").agg(F.sum("c").alias("c"), F.sum("clnc").alias("clnc"), F.sum("first").alias("first"),
                                                           F.min("parent").alias("parent"))
    text = F.pmod("feature", F.lit(2)) == 0
    spread = F.log("c") - F.col("clnc") / F.col("c")  # entropy over pages, in nats
    nodes = (features.groupBy("host", "node").agg(
        F.sum("first").alias("pages"), F.min("parent").alias("parent"), F.avg(F.when(text, spread)).alias("mean"),
        F.sum(F.when(~text, F.col("c"))).alias("shown"), F.sum(F.when(~text, F.col("c") * F.log("c"))).alias("shown_ln"))
        .where(F.col("pages") >= least_pages))
    base = F.log("pages")
    nodes = nodes.select(
        "host", "node", "parent", "pages", (1 - F.least(F.lit(1.0), F.col("mean") / base)).alias("content"),
        F.coalesce(F.least(F.lit(1.0), (F.log("shown") - F.col("shown_ln") / F.col("shown")) / base), F.lit(0.0)).alias("presentation"))
    return nodes.groupBy("host").applyInPandas(_noise(gamma, threshold), "host string, noise array<long>").where(F.size("noise") > 0)


def main_text(page: str | None, noise: set[int]) -> str:
    blocks, _ = parse(page)
    branches: dict[str, bool] = {"": _long("") in noise}

    def lost(path: str) -> bool:
        below = []
        while path not in branches:
            below.append(path)
            path = path.rpartition("/")[0]
        gone = branches[path]
        for p in reversed(below):
            gone = branches[p] = gone or _long(p) in noise
        return gone

    kept = [(t, main, named) for p, t, dead, main, named in blocks if not dead and not (noise and lost(p))]
    whole = sum(len(t) for t, _, _ in kept)
    for t, _, named in kept:
        for b in named.around() if named else ():
            b.size += len(t)
    # Names take a branch away only if it is a minor part of what the tree left, without an article, and something stays.
    minor = [x for x in kept if not (x[2] and any(not b.article and 2 * b.size <= whole for b in x[2].around()))]
    kept = minor or kept
    if ARTICLE_SHARE * sum(len(t) for t, main, _ in kept if main) >= sum(len(t) for t, _, _ in kept):
        kept = [x for x in kept if x[1]] or kept
    return "\n\n".join(t for t, _, _ in kept)


def extract(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    noise = stored(spark, noise_nodes(spark, pages, **options), "style-noise")
    # A host's list follows its templates; Spark broadcasts the table below its size threshold and else splits a hot host.
    rows = (pages.select("page_id", "url", "html", host().alias("host")).join(noise, "host", "left")
            .select("page_id", "url", "html", "noise"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, set(x or ())) for h, x in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                  ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(work, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string, n_chars long")
