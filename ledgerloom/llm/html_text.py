"""Main text of web pages by tag-path ratios.

Every text node hangs on a path of tags from the root.  For each path the text
length and the punctuation are summed and divided by the number of its nodes;
both ratios are smoothed over neighbouring paths (in page order), fused by
their product, and paths of at least half the standard deviation are content.
Blocks with content text are kept.  Headings, short paragraphs and lone links
on other paths are kept beside them, in the same container or in an article;
runs of links are not.  Names and tags of navigation, adverts, comments and the
like only exclude further, and not where they enclose the article: half of the
content of all articles, or of the page if it has none and they hold several
paragraphs.  Inside an article a name counts only as a whole.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import read_table

# Element names of HTML, and words in class, id and role that mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg select".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption br".split())
CLOSES_P = BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "head"}
CONTAINER = frozenset("html body article main section div td center form details".split())
DROP_TAG = frozenset("head nav aside footer button dialog object canvas menu audio video".split()) | RAW
DROP_UNLESS_CONTENT = frozenset(["form", "fieldset"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
JOINS = frozenset(["", "html", "body", "article", "main", "section", "div", "form", "details"])
DROP_WORD = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar sidebar side cookie cookies consent gdpr notice notices alert "
    "comment comments disqus reply replies respond share sharing social breadcrumb breadcrumbs footer related recommended popup modal overlay widget newsletter subscribe subscription login signup "
    "search pagination pager toolbar copyright complementary contentinfo form".split()
)
# Of these, words that name much else too: inside an article they exclude only what has no content paths.
WEAK_WORD = frozenset("side form reply respond search alert related widget overlay share sharing social promotion subscription menu banner".split())

# Words that say nothing in a name: inside an article, a name excludes only if it is one of the above, alone or with these.
PLAIN_WORD = frozenset(
    "list box container wrapper wrap block section area bar item items link links post posts article articles slot unit inner outer content header title body button buttons icon icons top bottom left right "
    "main thread meta text panel group row col column grid page site".split()
)

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_NAME = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PUNCT = re.compile(r"[.,;:!?…。、]")

# What a start tag closes: an open element of these names, up to the nearest of those that stop.
_CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}}
_STOPS = {"ul", "ol", "dl", "table", "tbody", "thead", "div", "section", "article", "main", "body", "blockquote", ""}
_ANCHORS = _STOPS | {"p", *_CLOSES}


class _Node:
    """An element.  ``path`` numbers its root-to-leaf tag path, ``home`` is the nearest element that text blocks join in, ``anchor`` the nearest that matters to implied ends."""

    __slots__ = ("tag", "parent", "doubt", "drop", "path", "children", "score", "link", "within", "home", "anchor", "weak")

    def __init__(self, tag: str, name: str, parent, paths: dict):
        self.tag, self.parent, self.children, self.score = tag, parent, [], 0.0
        words = set(re.split(r"[^a-z]+", name)) if name else set()
        inside = parent is not None and parent.within
        self.drop = (parent is not None and parent.drop) or tag in DROP_TAG
        if inside:  # "ad-hoc" is no advert, "comment-list" is a list of comments
            names = [set(re.split(r"[^a-z]+", n)) - {""} for n in name.split()]
            dropped = set().union(*(DROP_WORD & n for n in names if n <= DROP_WORD | PLAIN_WORD))
        else:
            dropped = DROP_WORD & words
        self.weak = inside and not dropped - WEAK_WORD and tag not in DROP_UNLESS_CONTENT
        self.doubt = tag in DROP_UNLESS_CONTENT or bool(dropped) and tag not in ("html", "body", "article", "main")
        self.doubt |= (tag == "header" or "header" in words and not words & {"article", "post", "entry", "title"} or "masthead" in words) and not inside
        self.link = tag == "a" or parent is not None and parent.link
        self.within = inside or tag in ("article", "main")
        self.path = paths.setdefault((parent.path if parent else -1, tag, name), len(paths))
        self.home = self if tag in JOINS else parent.home
        self.anchor = self if tag in _ANCHORS else parent.anchor
        if parent is not None:
            parent.children.append(self)


class _Scanner:
    """Ends of tags and comments, found without looking at any stretch of the page more than a few times."""

    def __init__(self, page: str):
        self.page = page
        self.ends = [m.start() for m in re.finditer(">", page)]
        self.quotes = [m.start() for m in re.finditer("[\"']", page)]
        self.outside = self._outside()
        self.none: set[str] = set()

    def _outside(self) -> list[int]:
        """For each quote, if it opens a value: the first ``>`` outside values from there on, or -1."""
        out, ahead = [-1] * len(self.quotes), {'"': -1, "'": -1}
        for k in range(len(self.quotes) - 1, -1, -1):
            mark = self.page[self.quotes[k]]
            shut = ahead[mark]
            if shut >= 0:
                out[k] = self._first(self.quotes[shut] + 1, shut + 1, out)
            ahead[mark] = k
        return out

    def _first(self, at: int, quote: int, known: list[int]) -> int:
        """The first ``>`` from ``at`` on outside values, ``quote`` being the number of the next quote."""
        k = bisect_left(self.ends, at)
        if k == len(self.ends):
            return -1
        return self.ends[k] if quote == len(self.quotes) or self.ends[k] < self.quotes[quote] else known[quote]

    def past(self, mark: str, at: int) -> int:
        """Place behind the next ``mark``, or -1."""
        if mark in self.none:
            return -1
        k = self.page.find(mark, at)
        if k < 0:
            self.none.add(mark)
        return k + len(mark) if k >= 0 else -1

    def tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag, outside quoted values; the first one if quotes do not close; -1 without any."""
        k = bisect_left(self.ends, at)
        if k == len(self.ends):
            return -1
        end = self._first(at, bisect_left(self.quotes, at), self.outside)
        return end if end >= 0 else self.ends[k]


def _parse(page: str):
    """The elements, parents before children, and the text nodes in page order as (node, text, block number)."""
    paths: dict[tuple, int] = {}
    node = _Node("", "", None, paths)
    nodes, texts, block, at, scan = [node], [], 0, 0, _Scanner(page)
    open_: Counter[str] = Counter()
    low = None

    def close_to(up):
        """Make ``up`` the innermost open element."""
        nonlocal node
        while node is not up:
            open_[node.tag] -= 1
            node = node.parent

    text_from = 0
    while (begin := page.find("<", at)) >= 0:
        m = _TAG.match(page, begin)
        if m:
            end = scan.tag_end(m.end())
            after = end + 1
        else:
            end = begin
            after = scan.past("-->", begin + 4) if page.startswith("<!--", begin) else scan.past("]]>", begin) if page.startswith("<![CDATA[", begin) else -1
            if after < 0 and page.startswith("<!--", begin):
                after = len(page)
            elif after < 0 and page[begin + 1 : begin + 2] in ("!", "?"):
                after = scan.past(">", begin)
            if after < 0:
                end = -1
        if end < 0:  # a lone bracket is text
            at = begin + 1
            continue
        if begin > text_from:
            texts.append((node, html.unescape(page[text_from:begin]), block))
        at = text_from = after
        if not m:
            continue
        tag, rest = m[2].lower(), page[m.end() : end]
        if tag in BLOCK:
            block += 1
        if m[1]:
            if open_[tag] > 0:
                up = node
                while up.tag != tag:
                    up = up.parent
                close_to(up.parent)
            continue
        if tag in RAW:
            low = low if low is not None else page.lower()
            if not rest.rstrip().endswith("/"):
                stop = low.find(f"</{tag}", at)
                at = len(page) if stop < 0 else stop
                after = page.find(">", at)
                at = text_from = len(page) if after < 0 else after + 1
            continue
        if tag in VOID:
            continue
        same = _CLOSES.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
        if any(open_[t] > 0 for t in same):
            up, found = node.anchor, None
            while up.tag not in _STOPS:
                if up.tag in same:
                    found = up
                up = up.parent.anchor
            if found is not None:
                close_to(found.parent)
        name = " ".join(a or b or c for a, b, c in _NAME.findall(rest)).lower() if rest else ""
        child = _Node(tag, name, node, paths)
        nodes.append(child)
        if not rest.rstrip().endswith("/") or tag not in ("br", "hr", "img"):
            node = child
            open_[tag] += 1
    if text_from < len(page):
        texts.append((node, html.unescape(page[text_from:]), block))
    return nodes, texts


def _content_paths(texts) -> set[int]:
    sums: dict[int, list[float]] = {}
    for node, text, _ in texts:
        if not node.drop and (n := len(text.strip())):
            s = sums.setdefault(node.path, [0, 0, 0])
            s[0] += n
            s[1] += len(_PUNCT.findall(text))
            s[2] += 1
    if not sums:
        return set()
    a = np.array(list(sums.values()), float)

    def smooth(x):
        p = np.concatenate([x[:1], x, x[-1:]])
        return 0.25 * p[:-2] + 0.5 * p[1:-1] + 0.25 * p[2:]

    fused = smooth(a[:, 0] / a[:, 2]) * (1 + smooth(a[:, 1] / a[:, 2]))
    return {k for k, f in zip(sums, fused, strict=True) if f >= fused.std() / 2}


def _weigh(nodes, texts, chosen: set[int], counts) -> None:
    """Content characters under each node, of the text nodes that count."""
    for node, text, _ in texts:
        if not node.drop and node.path in chosen and counts(node):
            node.score += len(text.strip())
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.score += node.score


def _above_several(nodes, some: set[int]) -> set[int]:
    """Nodes with at least two of ``some`` under them."""
    below: Counter[int] = Counter()
    for node in reversed(nodes):
        if n := below[id(node)] + (id(node) in some):
            below[id(node)] = n
            if node.parent is not None:
                below[id(node.parent)] += n
    return {k for k, n in below.items() if n > 1}


def _exclude(nodes, texts) -> None:
    """Drop what lies under a doubtful element, unless that encloses the article: half the content of all articles, or else of the page, and then several paragraphs."""
    chosen, root = _content_paths(texts), nodes[0]
    _weigh(nodes, texts, chosen, lambda node: node.within)
    articles = root.score > 0
    several = set()
    if not articles:
        _weigh(nodes, texts, chosen, lambda node: not node.link)
        several = _above_several(nodes, {id(node) for node, text, _ in texts if node.tag in ("p", "li", "td", "blockquote", "pre") and node.path in chosen and text.strip()})
    half = root.score / 2
    for node in nodes:
        keeps = node.score and (node.weak or node.score >= half and (articles or id(node) in several))
        node.drop |= node.parent is not None and node.parent.drop or node.doubt and not keeps
        node.score = 0.0


def _joined(blocks, chosen: set[int]) -> list[bool]:
    """Which blocks (lists of text nodes) are kept."""
    content, links, homes = [], [], []
    for block in blocks:
        sizes = [(node, len(text.strip())) for node, text in block]
        content.append(any(n and node.path in chosen for node, n in sizes))
        links.append(2 * sum(n for node, n in sizes if node.link) > sum(n for _, n in sizes))
        homes.append(next(node for node, n in sizes if n).home)
    keep = list(content)
    for order in (range(len(blocks)), range(len(blocks) - 1, -1, -1)):
        before, near = None, False
        for k in order:
            many = links[k] and any(links[j] and not content[j] for j in (k - 1, k + 1) if 0 <= j < len(blocks))
            if not keep[k] and near and not many and (homes[k].within or homes[k] is before or blocks[k][0][0].tag in HEADINGS):
                keep[k] = True
            if keep[k]:
                before, near = homes[k], True
            elif not homes[k].within:
                near = False
    return keep


def extract(page: str | None) -> str:
    """The article's text: white space inside a block is one space, blocks are joined by one space; empty if there is none."""
    if not page:
        return ""
    nodes, texts = _parse(page)
    _exclude(nodes, texts)
    chosen, root = _content_paths(texts), nodes[0]
    _weigh(nodes, texts, chosen, lambda node: True)
    if not root.score:
        return ""
    article = root
    while article.tag not in ("article", "main"):
        inner = [c for c in article.children if not c.drop and c.tag in CONTAINER and (c.score >= root.score or c.tag in ("article", "main") and c.score >= 0.7 * root.score)]
        if not inner:
            break
        article = inner[0]
    under = {id(root)} if article is root else set()
    for node in nodes[1:]:
        if node is article or id(node.parent) in under:
            under.add(id(node))
    blocks: dict[int, list[tuple]] = {}
    for node, text, block in texts:
        if not node.drop and id(node) in under:
            blocks.setdefault(block, []).append((node, text))
    some = [b for b in blocks.values() if any(text.strip() for _, text in b)]
    return " ".join(" ".join("".join(text for _, text in b).split()) for b, keep in zip(some, _joined(some, chosen), strict=True) if keep)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page (null html: empty text); one row in, one row out."""

    def run(batches):
        for batch in batches:
            texts = [extract(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    cols = [F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")]
    return pages.select(*cols).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read_table(spark, sf_dir, "pages"))
