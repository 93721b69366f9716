"""Main text of web pages; site templates found by counting element subtrees per host.

1. Every page is parsed into a tree (leniently: implied ends, unclosed tags).
2. Site templates: every element subtree outside the page's main element is hashed (tags and text) and
   emitted once a page; Spark counts the pages by (host, hash) after partial sums.
3. Subtrees on at least ``share`` of a host's pages, and on ``least_pages`` pages, are that host's template.
   A page has a bounded number of subtrees, so a host has at most (subtrees a page / share) of them:
   the list that comes back to the pages is bounded by the size of a page, not by the host.
4. Blocks inside the main element (``INNER``: sections, paragraphs, lists, not their items) are hashed and
   counted likewise, but once for each distinct rest of the main element they stand in, and against the
   host's distinct main elements: copies of an article are no template. A rest is told by the smallest hash
   of its 5-word runs, by ``KEYS`` hash functions that must all count enough, so near copies count as one.
5. Each page is read once more without its host's template, and its blocks are joined.
6. What counting cannot see, as it differs from page to page or stands on too few of them, goes by fixed
   rules: elements that are furniture by their tag, role, class or id (menus, notices, reader comments).

The main element is the outermost <article>, else <main>, else the body; it itself is never dropped.
A body that is the main element has all of its subtrees counted by step 2.

Defined cases: null or empty html gives the empty text; a null or relative url has the empty host;
repeated rows are pages of their own; tags that are never closed end with their parent; a tag or comment
without its end takes the rest of the page; pages of any length are read whole; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from html import unescape
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustloom.llm.common import checked, discard, materialize
from trustloom.llm.markup import attributes, tokens

LEAST_PAGES = 4
SHARE = 0.3
#: Words of a run and hash functions that tell what a block inside the main element stands in.
RUN = 5
KEYS = 4

#: Fixed values of HTML: elements without content, raw text elements, block elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas audio video select".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: A start tag ends an open element of these kinds (implied end tags).
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table article aside body div footer header main nav section form html td th blockquote".split())
INLINE = frozenset("a abbr b big cite code del em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())

#: Blocks that can be template inside the main element. Headings, items and cells recur as parts of contents.
INNER = frozenset("address article aside blockquote center details div dl fieldset figure footer header hgroup main ol p pre section table ul".split())

FURNITURE_TAGS = frozenset("nav footer aside form button dialog menu".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "newsletter subscribe subscription signup signin login sidebar widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager footer "
    "masthead topbar toolbar comment comments disqus replies reply respond related recommended share sharing social popup modal overlay lightbox skip".split()
)
#: Elements nested deeper hang on the last one allowed, as in browsers.
MAX_DEPTH = 512
_WORD = re.compile(r"[a-z]+")
_ZERO_WIDTH = str.maketrans({"\u200b": " ", "\ufeff": " "})


def squeezed(text: str) -> str:
    """White space, zero-width spaces among it, as single blanks; none at the ends."""
    if "\u200b" in text or "\ufeff" in text:
        text = text.translate(_ZERO_WIDTH)
    return " ".join(text.split())


class Node:
    __slots__ = ("children", "furniture", "hash", "tag")

    def __init__(self, tag: str, furniture: bool = False):
        self.tag, self.furniture, self.children, self.hash = tag, furniture, [], None


def _is_furniture(tag: str, attrs: str, in_main: bool) -> bool:
    if tag in FURNITURE_TAGS or (tag == "header" and not in_main):
        return True
    if not attrs or tag in ("html", "body", "article", "main") and "comment" not in attrs.lower():
        return False
    for name, value in attributes(attrs):
        value = value.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in FURNITURE_ROLES):
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name in ("class", "id") and not FURNITURE_WORDS.isdisjoint(_WORD.findall(value)):
            return True
    return False


def parse(html: str) -> Node:
    """The page's tree; text is str among the children. Linear in the page's length, as depth is bounded."""
    root = Node("#root")
    stack, mains = [root], 0

    def close(i: int) -> None:
        nonlocal mains
        mains -= sum(x.tag in ("article", "main") for x in stack[i:])
        del stack[i:]

    for token in tokens(html, RAW):
        if type(token) is str:
            stack[-1].children.append(token)
            continue
        closing, tag, attrs, raw = token
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag in INLINE and stack[i].tag not in INLINE:
                    break  # a stray inline end does not close blocks
            continue
        ends = ENDS.get(tag) or ({"p"} if tag in ENDS_P else None)
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                t = stack[i].tag
                if t in ends:
                    close(i)
                    if tag != "tr":
                        break
                elif t in SCOPE and not (tag == "tr" and t in ("td", "th")):
                    break
        if raw is not None:
            continue
        node = Node(tag, _is_furniture(tag, attrs, mains > 0))
        stack[-1].children.append(node)
        if tag not in VOID and not attrs.rstrip().endswith("/") and len(stack) < MAX_DEPTH:
            stack.append(node)
            mains += tag in ("article", "main")
    return root


def main_nodes(root: Node) -> list[Node]:
    """Outermost articles, else main elements, else the root; none inside furniture."""

    def outermost(node: Node, tag: str, out: list[Node]) -> list[Node]:
        todo = [node]
        while todo:
            x = todo.pop()
            if x.furniture:
                continue
            if x.tag == tag:
                out.append(x)
            else:
                todo += [c for c in reversed(x.children) if type(c) is Node]
        return out

    return outermost(root, "article", []) or outermost(root, "main", []) or [root]


def hash_subtrees(root: Node, skip: list[Node]) -> set[int]:
    """Sets ``hash`` of every element outside ``skip`` that holds text; returns the hashes."""
    seen: set[int] = set()
    stop = {id(x) for x in skip if x is not root}
    todo: list[tuple[Node, bool]] = [(root, False)]
    while todo:
        node, done = todo.pop()
        if id(node) in stop:
            continue
        if not done:
            todo.append((node, True))
            todo += [(c, False) for c in node.children if type(c) is Node]
            continue
        parts, blank = [node.tag], True
        for c in node.children:
            if type(c) is str:
                if s := squeezed(c):
                    parts.append(s)
                    blank = False
            elif id(c) in stop:
                parts.append("*")
            elif c.hash is not None:
                parts.append(str(c.hash))
                blank = False
        if not blank and node is not root:
            node.hash = int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
            if node.tag not in ("html", "body"):
                seen.add(node.hash)
    return seen


def _digest(parts: list[str]) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def hash_main(nodes: list[Node]) -> tuple[list[tuple[int, int, int]], list[str], int]:
    """Sets ``hash`` of the elements inside ``nodes``, less furniture.

    Returns (hash, first word, end) of the ``INNER`` ones, the words of all nodes, and a hash of all.
    """
    found: dict[int, tuple[int, int, int]] = {}  # the first of equal ones
    words: list[str] = []
    tops: list[str] = []
    for top in nodes:
        todo: list = [(top, -1)]
        while todo:
            node, start = todo.pop()
            if type(node) is str:
                words += squeezed(node).split()
            elif start < 0:
                todo.append((node, len(words)))
                todo += [(c, -1) for c in reversed(node.children) if type(c) is str or not c.furniture]
            elif len(words) > start:
                parts = ["main", node.tag]  # not the hash that the same subtree has outside
                for c in node.children:
                    if type(c) is str:
                        if s := squeezed(c):
                            parts.append(s)
                    elif c.hash is not None:
                        parts.append(str(c.hash))
                h = _digest(parts)
                if node is top:
                    tops.append(str(h))
                else:
                    node.hash = h
                    if node.tag in INNER:
                        found.setdefault(h, (h, start, len(words)))
    return list(found.values()), words, _digest(tops)


_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """One row of well-spread 64-bit values for each of the ``KEYS`` hash functions."""
    x = x[None, :] ^ (np.arange(1, KEYS + 1, dtype=np.uint64) * _ODD[0])[:, None]
    for m in _ODD[1:3]:
        x = (x ^ (x >> np.uint64(31))) * m
    return x ^ (x >> np.uint64(29))


def rest_keys(words: list[str], spans: list[tuple[int, int]]) -> np.ndarray:
    """``KEYS`` values a span: smallest hashes of the runs of words before and after it, 0 if there are none."""
    n, none = len(words), np.iinfo(np.uint64).max
    crc = np.fromiter((crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, n)
    before = after = np.full((KEYS, 0), none)
    if n >= RUN:
        runs = np.zeros(n - RUN + 1, np.uint64)
        for i in range(RUN):
            runs += crc[i : n - RUN + 1 + i] * _ODD[i]
        runs = _mixed(runs)
        before = np.minimum.accumulate(runs, axis=1)
        after = np.minimum.accumulate(runs[:, ::-1], axis=1)[:, ::-1]
    out = np.full((KEYS, len(spans)), none)
    for k, (a, b) in enumerate(spans):
        for side, at, x, y in ((before, a - RUN, 0, a), (after, b, b, n)):
            if y - x >= RUN:
                out[:, k] = np.minimum(out[:, k], side[:, at])
            elif y > x:  # a side of a few words is a run of its own
                short = _mixed((crc[x:y] * _ODD[: y - x]).sum(keepdims=True, dtype=np.uint64))
                out[:, k] = np.minimum(out[:, k], short[:, 0])
    return np.where(out == none, 0, out).astype(np.int64)


def text_of(nodes: list[Node], template: set[int]) -> str:
    """Text of the nodes without template and furniture, blocks joined by one space."""
    out: list[str] = []
    todo: list = list(reversed(nodes))
    while todo:
        x = todo.pop()
        if type(x) is str:
            out.append(x)
            continue
        if x.furniture or (x.hash is not None and x.hash in template):
            continue
        if x.tag in BLOCK:
            out.append(" ")
            todo.append(" ")
        todo += reversed(x.children)
    return squeezed(unescape("".join(out)))


def dropped(root: Node, template: set[int]) -> int:
    """Outermost subtrees of the page that are template."""
    n, todo = 0, [root]
    while todo:
        x = todo.pop()
        if x.hash is not None and x.hash in template:
            n += 1
        else:
            todo += [c for c in x.children if type(c) is Node]
    return n


def host_of(url) -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def extract_main(pages: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars, n_template.

    ``n_template`` counts the page's outermost subtrees that recur on its host. A ``share`` above 1 turns
    counting off: only the fixed rules for furniture are left.
    """
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).withColumn("host", host_of(F.col("url")))

    def subtrees(batches):
        """(host, hash, kind, key); kinds: -1 outside the main element, 0 to KEYS - 1 inside by hash function, KEYS the main element."""
        for batch in batches:
            hosts, rows, hashes, kinds, keys = batch.column(0), [], [], [], []
            for i, html in enumerate(batch.column(1).to_pylist()):
                if not html:
                    continue
                root = parse(html)
                nodes = main_nodes(root)
                found = hash_subtrees(root, nodes)
                rows += [i] * len(found)
                hashes += found
                kinds += [-1] * len(found)
                keys += [0] * len(found)
                if nodes != [root]:
                    inner, words, whole = hash_main(nodes)
                    of_rest = rest_keys(words, [(x, y) for _, x, y in inner])
                    rows += [i] * (KEYS * len(inner) + 1)
                    for k in range(KEYS):
                        hashes += [h for h, _, _ in inner]
                        kinds += [k] * len(inner)
                        keys += of_rest[k].tolist()
                    hashes.append(0)
                    kinds.append(KEYS)
                    keys.append(whole)
            yield pa.RecordBatch.from_arrays(
                [hosts.take(pa.array(rows, pa.int64())), pa.array(hashes, pa.int64()), pa.array(kinds, pa.int8()), pa.array(keys, pa.int64())], ["host", "hash", "kind", "key"]
            )

    emitted = pages.select("host", "html").mapInArrow(subtrees, "host string, hash bigint, kind tinyint, key bigint")
    counted = emitted.groupBy("host", "hash", "kind", "key").agg(F.count(F.lit(1)).alias("pages")).groupBy("host", "hash", "kind").agg(F.sum("pages").alias("pages"), F.count(F.lit(1)).alias("mains"))
    n = F.when(F.col("kind") < 0, F.col("pages")).otherwise(F.col("mains"))
    counted = counted.select("host", "hash", "kind", n.alias("n")).where((F.col("n") >= least_pages) | (F.col("kind") == KEYS))
    counts, counts_path = materialize(counted, "subtrees")
    of_host = pages.groupBy("host").agg(F.count(F.lit(1)).alias("all")).withColumn("outside", F.lit(True))
    of_host = of_host.unionByName(counts.where(F.col("kind") == KEYS).select("host", F.col("n").alias("all"), F.lit(False).alias("outside")))
    of_host = materialize(of_host, "hosts")  # without it a large host's subtrees would be one key of the join
    often = counts.where(F.col("kind") < KEYS).withColumn("outside", F.col("kind") < 0).join(checked(of_host), ["host", "outside"]).where(F.col("n") >= F.lit(share) * F.col("all"))
    often = often.groupBy("host", "hash", "outside").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("outside") | (F.col("kinds") == KEYS))
    templates = materialize(often.groupBy("host").agg(F.collect_set("hash").alias("template")), "templates")
    discard(pages.sparkSession, counts_path, of_host[1])
    # a host above the broadcast limit is split by Spark's skew handling, which copies its one row of templates
    joined = pages.join(checked(templates), "host", "left").select("page_id", "url", "html", "template")
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts, removed = [], []
            for html, template in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if not html:
                    texts.append("")
                    removed.append(0)
                    continue
                root = parse(html)
                nodes, known = main_nodes(root), set(template or ())
                if known:
                    hash_subtrees(root, nodes)
                    if nodes != [root]:
                        hash_main(nodes)
                texts.append(text_of(nodes, known))
                removed.append(dropped(root, known) if known else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int64())],
                ["page_id", "url", "text", "n_chars", "n_template"],
            )

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint, n_template bigint")
