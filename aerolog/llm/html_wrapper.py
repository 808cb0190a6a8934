"""Main text of web pages by wrapper induction: pages of one host are aligned, what stays is template.

Pages of a host have the same layout if their trees have the same label paths down to elements that hold others. Each
of the ``LAYOUTS`` layouts of a host with the most pages has a reference page (the one whose id has the smallest hash);
pages without any text are none. The DOM tree of every page is aligned with the reference of its layout, or else with
the one that it has most nodes in common with, by simple tree matching: roots must have the same label, and of two child lists the
heaviest order-keeping matching is taken. A text of the reference is constant if at least ``CONSTANT`` of
the pages that have its node, ``WITNESSES`` of them or more, have the same text there; the reference and its
copies (pages that share ``COPY`` of their text with it) count as one page, so that an article which many pages
repeat stays. Those nodes are the
template, the other ones are slots. From a page, the texts in slots (and in nodes that the
reference lacks) are content, unless they stand in an element that is never part of an article by its
name, class, id or role (menus, headers, footers, asides, forms, scripts, adverts, notices, comments).
If a page has articles, only they count, or else its main element, or else its body.

Blocks are the texts between block elements: character references are decoded, white space becomes one
space, blocks are trimmed and joined by an empty line in page order.

Counts are sums over all pages of a host; a page of a reference travels to the pages of its host by a
join on the host, where the references' side has one row for each host.

A null or empty page has an empty text, and so has one without content. A null address belongs to a
host without name. Repeated pages each get their text; copies of the reference count once, others as often as they occur. A page whose
article would be all template keeps it. Without peers there is no template. Other columns of the input don't matter;
an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolog.llm.common import BATCH_ROWS, ready_for_python, small_batches
from aerolog.session import materialized

CONSTANT, WITNESSES = 0.8, 8
#: References of a host at most, which bounds the rows that pages are joined with.
LAYOUTS = 4
#: A page is a copy of another if so much of its text, in characters, is that page's.
COPY = 0.75

#: Quotes count only behind an equals sign; the possessive loop never goes back.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z/][^>]*\Z", re.S)
MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
PART = re.compile(r"[a-z]+")
#: Fixed values of HTML: elements whose content is no markup, that have no content, and that are inline.
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "object", "noframes", "xmp"}
#: Those that run to the end of the page if nothing ends them; others without an end are taken for empty.
ENDLESS = {"script", "style", "textarea", "title", "xmp"}
#: What a formula says again in other words.
ANNOTATION = re.compile(r"<annotation.*?(?:</annotation[^>]*>|\Z)", re.S | re.I)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
          "ins", "kbd", "label", "mark", "meter", "output", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: Elements that end an open one of the same kind, and the ones they look for no further than.
ENDS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Never part of an article, by the element's name or by a word of its class, id or role.
OUTSIDE = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", *RAW}
OUTSIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "banner", "cookie", "cookies",
                 "consent", "notice", "alert", "popup", "modal", "newsletter", "subscribe", "nav", "navbar", "navigation", "menu",
                 "breadcrumb", "breadcrumbs", "sidebar", "widget", "footer", "header", "masthead", "topbar", "toolbar", "comment",
                 "comments", "disqus", "replies", "share", "sharing", "social", "related", "recommended", "pagination", "pager",
                 "login", "search", "complementary", "contentinfo"}


class Node:
    """An element with its block children and texts, or a text (label ``#``). Inline elements are part of texts."""

    __slots__ = ("label", "tag", "out", "children", "text", "shape", "size", "chars", "holds")

    def __init__(self, label: str, tag: str = "", out: int = 0, text: str = ""):
        self.label, self.tag, self.out, self.text = label, tag, out, text
        self.children: list[Node] = []


_shapes: dict[tuple, int] = {}
_marked: dict[str, tuple[str, int]] = {}
#: Why a node stands outside of articles: its element or a whole word of its marks, or a part of a word alone.
BY_NAME, BY_PART = 2, 1
#: An article of less than this share of the page's text is a teaser.
TEASER = 0.25


def labelled(tag: str, rest: str) -> tuple[str, int]:
    """An element's label (name, class, id, role) and why it stands outside of articles, or 0."""
    if "=" not in rest:
        return tag, BY_NAME if tag in OUTSIDE else 0
    key = f"{tag} {rest}"
    if (known := _marked.get(key)) is None:
        marks = [next(filter(None, m), "").lower() for m in MARKS.findall(rest)]
        # an article that is marked is an article still
        outside = BY_NAME if tag in OUTSIDE else 0
        if not outside and tag not in ("article", "main", "body", "html"):
            words = [w for m in marks for w in m.split()]
            outside = BY_NAME if OUTSIDE_WORDS & {*words} else BY_PART if any(w in OUTSIDE_WORDS for m in words for w in PART.findall(m)) else 0
        known = (tag if not marks else f"{tag} {' '.join(marks)}", outside)
        if len(_marked) < 20_000:
            _marked[key] = known
    return known


def parsed(page: str) -> Node:
    """The block tree of a page. Open elements end where HTML lets them; unknown ends are ignored."""
    root = Node("page", "page")
    open_ = [root]
    run: list[str] = []
    outside_inline: list[str] = []  # inline elements that stand outside, now open

    def flush() -> None:
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if text:
                open_[-1].children.append(Node("#", text=text))

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        if m is None:
            if not outside_inline:
                run.append(page[at:])
            break
        if m.start() > at and not outside_inline:
            run.append(page[at:m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        tag = name.lower()
        if m[1]:  # an end
            if tag in INLINE:
                if outside_inline and outside_inline[-1] == tag:
                    outside_inline.pop()
                continue
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    flush()
                    del open_[k:]
                    outside_inline.clear()
                    break
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(page, at) if not m[3].endswith("/") else None
            at = end.end() if end else n if tag in ENDLESS and not m[3].endswith("/") else at
            if tag != "svg":
                flush()
            continue
        if tag == "math":  # a formula is a part of its sentence
            end = re.compile("</math[^>]*>", re.I).search(page, at)
            if end and not m[3].endswith("/"):
                if not outside_inline:
                    run.append(TAG.sub("", ANNOTATION.sub("", page[at:end.start()])))
                at = end.end()
            continue
        if tag in INLINE:
            if tag in ("br", "img", "wbr"):
                if tag == "br" and not outside_inline:
                    run.append(" ")
            elif outside_inline:
                outside_inline.append(tag)
            elif "=" in m[3] and labelled(tag, m[3])[1] and not m[3].endswith("/"):
                outside_inline.append(tag)
            continue
        flush()
        outside_inline.clear()
        if tag in VOID:
            continue
        for k in range(len(open_) - 1, 0, -1):  # a block ends an open paragraph
            if open_[k].tag == "p":
                del open_[k:]
                break
            if open_[k].tag in ("table", "td", "th", "button", "object", "article", "body"):
                break
        if tag in ENDS:
            same, stop = ENDS[tag]
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag in same:
                    del open_[k:]
                    break
                if open_[k].tag in stop:
                    break
        if tag == "body" and len(open_) > 1:  # ends the head
            open_[:] = [o for o in open_ if o.tag != "head"]
        label, out = labelled(tag, m[3])
        node = Node(label, tag, out)
        open_[-1].children.append(node)
        if not m[3].endswith("/"):
            open_.append(node)
    flush()
    measured(root)
    return root


def measured(root: Node) -> None:
    """Number of nodes and a number for the shape of every subtree; equal shapes share it. Also settles what stands outside.

    A node that holds an article (or ``main``) does not stand outside of it, whatever it is called, and a part of a word is
    not enough for a node that holds most of the page's text.
    """
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += node.children
    if len(_shapes) > 200_000:
        _shapes.clear()
    for node in reversed(order):
        node.size = 1 + sum(c.size for c in node.children)
        node.chars = len(node.text) + sum(c.chars for c in node.children)
        node.holds = node.tag in ("article", "main") or any(c.holds for c in node.children)
        key = (node.label, *(c.shape for c in node.children))
        node.shape = _shapes.setdefault(key, len(_shapes))
    for node in order:
        if node.out and (node.holds and node.tag not in RAW or node.out == BY_PART and 2 * node.chars > root.chars):
            node.out = 0


def middle(a: list[Node], b: list[Node]) -> tuple[int, list[Node], list[Node]]:
    """How many children at the front have equal shapes, and what is left of both lists without those at either end.

    Equal shapes at both ends are paired at once, which no matching can better.
    """
    lead, most = 0, min(len(a), len(b))
    while lead < most and a[lead].shape == b[lead].shape:
        lead += 1
    trail = 0
    while trail < most - lead and a[-1 - trail].shape == b[-1 - trail].shape:
        trail += 1
    return lead, a[lead:len(a) - trail], b[lead:len(b) - trail]


def known(a: Node, b: Node, memo: dict) -> int | None:
    """The weight of two nodes, if it is known without more work."""
    if a.label != b.label:
        return 0
    return a.size if a.shape == b.shape else memo.get((a.shape, b.shape))


def weight(a: Node, b: Node, memo: dict) -> int:
    """Simple tree matching: the most nodes that an order-keeping matching from the roots down can pair.

    Children come before their parents on a stack of pairs, so a page may be nested as deeply as it likes.
    """
    stack = [(a, b)]
    while stack:
        p, q = stack[-1]
        if known(p, q, memo) is not None:
            stack.pop()
            continue
        _, x, y = middle(p.children, q.children)
        open_ = [(c, d) for c in x for d in y if known(c, d, memo) is None]
        if open_:
            stack += open_
        else:
            memo[p.shape, q.shape] = 1 + sum(known(c, d, memo) for c, d in matching(p.children, q.children, memo))
            stack.pop()
    return known(a, b, memo)


def matching(a: list[Node], b: list[Node], memo: dict) -> list[tuple[Node, Node]]:
    """The heaviest order-keeping matching of two child lists whose weights are known."""
    lead, x, y = middle(a, b)
    pairs = list(zip(a[:lead], b[:lead]))
    if x and y:
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, p in enumerate(x):
            above, row = best[i], best[i + 1]
            for j, q in enumerate(y):
                row[j + 1] = max(above[j + 1], row[j], above[j] + known(p, q, memo))
        i, j, chosen = len(x), len(y), []
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                chosen.append((x[i], y[j]))
        pairs += reversed(chosen)
    return pairs + list(zip(a[lead + len(x):], b[lead + len(y):]))


def aligned(reference: Node, page: Node) -> list[tuple[Node, Node]]:
    """The texts of the reference with the texts of the page in the same places."""
    out, memo = [], {}
    weight(reference, page, memo)
    stack = [(reference, page)] if reference.label == page.label else []
    while stack:
        a, b = stack.pop()
        if a.label == "#":
            out.append((a, b))
        elif a.children and b.children:
            stack += [(x, y) for x, y in matching(a.children, b.children, memo) if x.label == y.label]
    return out


@lru_cache(maxsize=256)
def reference_tree(page: str) -> tuple[Node, dict[int, int]]:
    """A reference page's tree and the number of each of its texts in page order."""
    root = parsed(page)
    number: dict[int, int] = {}
    stack = [root]
    while stack:
        node = stack.pop()
        if node.label == "#":
            number[id(node)] = len(number)
        stack += reversed(node.children)
    return root, number


def eligible(tree: Node) -> list[Node]:
    """The texts that can be content, in page order: those of the articles, unless they hold little of what ``main`` or the page holds."""
    whole = [t for r in outermost(tree, "body") or [tree] for t in texts(r)]
    for tag in ("article", "main"):
        own = [t for r in outermost(tree, tag) for t in texts(r)]
        if own and sum(len(t.text) for t in own) >= TEASER * sum(len(t.text) for t in whole):
            return own
    return whole


def layout_of(root: Node) -> int | None:
    """A number for the label paths down to the elements that hold others, however often; None without any text."""
    paths, stack, empty = set(), [(root, "")], True
    while stack:
        node, above = stack.pop()
        own = f"{above}/{node.label}"
        for c in node.children:
            if c.label == "#":
                empty = False
            else:
                paths.add(own)
                stack.append((c, own))
    return None if empty else crc32("\n".join(sorted(paths)).encode())


def best(tree: Node, references: list[dict] | None) -> int | None:
    """The place of the reference of a tree's layout, or else of the one with the most nodes in common."""
    if not references:
        return None
    own = layout_of(tree)
    same = next((k for k, r in enumerate(references) if r["layout"] == own), None)
    if same is not None or len(references) == 1:
        return same or 0
    return max(range(len(references)), key=lambda k: (weight(reference_tree(references[k]["page"])[0], tree, {}), -k))


def agreement(page: str | None, references: list[dict] | None) -> list[int]:
    """For every text of the page's reference that the page has: twice its code, plus 1 if it reads the same.

    A copy of the reference, near ones included, has no vote: what it shares may be the article.
    """
    tree = parsed(page or "")
    k = best(tree, references)
    if k is None:
        return []
    root, number = reference_tree(references[k]["page"])
    pairs = aligned(root, tree)
    same = {id(b) for a, b in pairs if a.text == b.text}
    own = eligible(tree)
    shared, size = (sum(len(t.text) for t in some) for some in ([t for t in own if id(t) in same], own))
    if shared >= COPY * size:
        return []
    return [2 * (number[id(a)] * LAYOUTS + k) + (id(b) in same) for a, b in pairs]


def content(page: str | None, references: list[dict] | None, template: list[int] | None) -> str:
    """The blocks of a page that stand in slots, inside of its articles."""
    tree = parsed(page or "")
    fixed: set[int] = set()
    if template:
        k = best(tree, references)
        root, number = reference_tree(references[k]["page"])
        constant = set(template)
        fixed = {id(b) for a, b in aligned(root, tree) if number[id(a)] * LAYOUTS + k in constant and a.text == b.text}
    blocks = eligible(tree)
    return "\n\n".join([t.text for t in blocks if id(t) not in fixed] or [t.text for t in blocks])


def outermost(root: Node, tag: str) -> list[Node]:
    """The elements of a name that stand in no other of it and in nothing outside of articles, in page order."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag == tag:
            found.append(node)
        elif not node.out:
            stack += reversed(node.children)
    return found


def texts(root: Node) -> list[Node]:
    """The texts below a node that no element outside of articles holds, in page order."""
    found, stack = [], list(reversed(root.children))
    while stack:
        node = stack.pop()
        if node.label == "#":
            found.append(node)
        elif not node.out:
            stack += reversed(node.children)
    return found


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Key, address and main text of every page."""
    spark = pages.sparkSession
    ready_for_python(spark)
    own = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url"), F.col(page).alias("_html"), host(F.col(url)).alias("_host"))

    @F.arrow_udf("bigint")
    def layouts(htmls: pa.Array) -> pa.Array:
        return pa.array([layout_of(parsed(h)) if h else None for h in htmls.to_pylist()], pa.int64())

    common = Window.partitionBy("_host").orderBy(F.desc("_pages"), F.xxhash64("_chosen"), "_layout")
    # written, so that its size is known when the pages are joined with it
    ranked = (own.select("_host", "_key", layouts("_html").alias("_layout")).where("_layout is not null")
              .groupBy("_host", "_layout").agg(F.min_by("_key", F.xxhash64("_key")).alias("_chosen"), F.count("*").alias("_pages"))
              .withColumn("_rank", F.row_number().over(common)).where(F.col("_rank") <= LAYOUTS))
    with small_batches(spark):
        chosen = materialized(ranked)
    found = (own.withColumnRenamed("_host", "_on").join(chosen, F.col("_on").eqNullSafe(F.col("_host")) & F.col("_key").eqNullSafe(F.col("_chosen")))
             .where(layouts("_html") == F.col("_layout")).dropDuplicates(["_host", "_rank"]))
    packed = found.groupBy("_host").agg(F.sort_array(F.collect_list(F.struct(
        F.col("_rank").alias("rank"), F.col("_layout").alias("layout"), F.col("_html").alias("page")))).alias("_references"))
    with small_batches(spark):
        references = materialized(packed)

    @F.arrow_udf("array<int>")
    def agreements(htmls: pa.Array, refs: pa.Array) -> pa.Array:
        return pa.array([agreement(h, r) for h, r in zip(htmls.to_pylist(), refs.to_pylist())], pa.list_(pa.int32()))

    seen = (own.join(references, "_host").select("_host", F.explode(agreements("_html", "_references")).alias("_code"))
            .groupBy("_host", F.shiftright("_code", 1).alias("_text")).agg(
                F.count("*").alias("_n"), F.sum(F.col("_code").bitwiseAND(1)).alias("_same")))
    # the reference and its copies have one vote together
    constant = seen.where((F.col("_n") + 1 >= WITNESSES) & (F.col("_same") + 1 >= CONSTANT * (F.col("_n") + 1)))
    induced = references.join(constant.groupBy("_host").agg(F.collect_list("_text").alias("_template")), "_host", "left")
    with small_batches(spark):
        wrappers = materialized(induced)

    @F.arrow_udf("string")
    def contents(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in batches:
            for k in range(0, max(len(columns[0]), 1), BATCH_ROWS):
                rows = zip(*(c.slice(k, BATCH_ROWS).to_pylist() for c in columns))
                yield pa.array([content(*row) for row in rows], pa.string())

    return own.join(wrappers, "_host", "left").select(
        F.col("_key").alias(key), F.col("_url").alias(url), contents("_html", "_references", "_template").alias("text"))
