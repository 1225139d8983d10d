"""Main text of web pages by wrapper induction.

Every page is parsed into a tree of its containers. Runs of text blocks
(headings, paragraphs, lists, tables ...) fold into one slot and equal
neighbours into one node, so pages of one template share a *layout* however
long they are. Per host, the distinct layouts are aligned by simple tree
matching (the largest number of matched node pairs under a common root) into a
wrapper; the texts of aligned slots are compared over all of the host's pages.
A slot whose text is the same on all of at least ``MIN_PAGES`` different pages
is template, a varying slot is content. The page's text is its content slots,
without elements that are furniture by tag or role (menus, site headers,
footers, asides, forms, scripts, styles).

Where pages of a layout have an article or main element, what varies decides
whether it holds the story: it does unless a varying slot outside of it holds
more text, over all pages of the layout, than all varying slots within. Then the
content slots outside are the page's text and the element is a teaser. Without
enough pages to tell, the element is the page's text.

A class or id that is as a whole the name of furniture (sidebar, notice, advert,
reader comments) only weighs: its text is aligned like any other, in slots of
its own, and gives way to text that is not so named. Text so named is the
page's text if there is no other, or if the page's only article or main element
is within. An article or main element is never furniture by its own name, nor
is a header in one.

Slots are compared by partial aggregation on (host, layout, slot), so a host
with a third of all pages costs no single task more; one task merges a host's
distinct layouts, whose number depends on its templates, not on its pages.

Blocks keep page order; character references are decoded, white space inside
a block (line breaks too) becomes one space. Defined results: null or empty
html gives the empty text; html without tags is one block; pages without a
host are wrapped together as one host; repeated pages count as one page in the
comparison and are answered row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import sys
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.llm.common import map_batches, staged, table, texts

MIN_PAGES = 3

# fixed values: element kinds of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd "
                   "label mark q rp rt ruby s samp small span strike strong sub sup time tt u var "
                   "wbr".split())
# block elements that hold text; everything else that is no inline is a container
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table caption thead "
                        "tbody tfoot tr td th figure figcaption address hr center summary details"
                        .split())
HIDDEN = frozenset("script style noscript template iframe object svg math canvas audio video head "
                   "title form button select option textarea input fieldset nav footer aside "
                   "menu dialog".split())
MAIN = frozenset("article main".split())
CLOSES_P = TEXT_BLOCKS | frozenset("div section article main nav header footer aside form fieldset "
                                   "body".split())
# classes and ids, as a whole, that mark page furniture
FURNITURE = frozenset(
    "ad ads ad-box adbox ad-slot ad-banner ad-container advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "menu nav navbar navigation breadcrumb breadcrumbs sidebar side widget footer masthead header "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "signup login share sharing social related recommended comment comments reply replies respond "
    "comment-list commentlist comments-area comments-section share-buttons social-links "
    "social-share related-posts related-articles cookie-banner cookie-notice site-header "
    "site-footer page-header page-footer main-nav site-nav left-sidebar right-sidebar "
    "discussion disqus pagination pager toolbar search copyright disclaimer".split())
HEADERS = frozenset("header masthead page-header site-header".split())
_SPACE = re.compile(r"\s+")


def is_furniture(tag: str, attrs: dict[str, str | None]) -> bool:
    if tag in HIDDEN:
        return True
    if "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    return attrs.get("role") in ("navigation", "banner", "contentinfo", "complementary", "search",
                                 "form", "dialog", "alert", "menu", "menubar")


def is_named(tag: str, attrs: dict[str, str | None], main: bool) -> bool:
    """Whether a class or id is the name of furniture; ``main``: within an
    article or main element."""
    if tag in MAIN or tag in ("html", "body") or attrs.get("role") == "main" or (main and tag == "header"):
        return False
    names = set(f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split())
    return not FURNITURE.isdisjoint(names - HEADERS if main else names)


class Page(HTMLParser):
    """Layout tree and text blocks of one page.

    A layout node is [signature, children]; a slot is the node "#". ``blocks``:
    (node that holds the block, text, inside an article or main element, named
    as furniture). Text so named hangs on the node "!", before its neighbours.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = ["root", []]
        # tag, node, furniture, main, named
        self.stack = [("root", self.root, False, False, False)]
        self.held: list[tuple[str, bool]] = []              # text, named
        self.blocks: list[tuple[list, str, bool, bool]] = []
        self.feed(html)
        self.close()
        self.flush()

    def flush(self) -> None:
        if self.held:
            held, self.held = self.held, []
            _, node, furniture, main, named = self.stack[-1]
            plain = _SPACE.sub(" ", "".join(t for t, n in held if not n)).strip()
            text = plain or _SPACE.sub(" ", "".join(t for t, _ in held)).strip()
            if text and not furniture:
                if not plain and not named:
                    node = self.aside(node)
                if not node[1] or node[1][-1][0] != "#":
                    node[1].append(["#", []])
                self.blocks.append((node[1][-1], text, main, not plain))

    @staticmethod
    def aside(node: list) -> list:
        """The node's child for text named as furniture."""
        if not node[1] or node[1][0][0] != "!":
            node[1].insert(0, ["!", []])
        return node[1][0]

    def handle_data(self, data: str) -> None:
        _, _, furniture, _, named = self.stack[-1]
        if not furniture:
            self.held.append((data, named))

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "br":
            self.held.append((" ", self.stack[-1][4]))
            return
        if tag in VOID:
            return
        if tag in INLINE:
            if is_furniture(tag, dict(attrs)) or is_named(tag, dict(attrs), self.stack[-1][3]):
                self.open(tag, dict(attrs), None)
            return
        self.flush()
        if tag in CLOSES_P:
            self.shut("p", TEXT_BLOCKS | INLINE)
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            self.shut(tag, INLINE | {"p", tag})
        self.open(tag, dict(attrs), tag)

    def open(self, tag: str, attrs: dict, block: str | None) -> None:
        _, node, furniture, main, named = self.stack[-1]
        # an article's own header holds its title
        own_header = tag == "header" and main
        furniture = furniture or is_furniture(tag, attrs) or (tag == "header" and not main)
        if not named and is_named(tag, attrs, main):
            named = True
            if block and not furniture:
                node = self.aside(node)
        elif block and block not in TEXT_BLOCKS and not furniture and not own_header:
            names = sorted((attrs.get("class") or "").split())[:3]
            new = [".".join([tag, *names]), []]
            node[1].append(new)
            node = new
        main = main or tag in MAIN or attrs.get("role") == "main"
        self.stack.append((tag, node, furniture, main, named))

    def shut(self, tag: str, through: frozenset) -> None:
        """Close an open ``tag`` if only elements of ``through`` stand above it."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return
            if self.stack[i][0] not in through:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID or tag in INLINE and not any(t == tag for t, *_ in self.stack[-3:]):
            return
        if tag not in INLINE:
            self.flush()
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return


def fold(node: list) -> tuple[list, dict[int, int]]:
    """The tree with equal neighbours as one node and its slots numbered in
    order; the slot number of each original slot node (by id).

    Equal shapes have equal numbers (0: no text below), so telling two nodes
    apart takes the same time at any depth.
    """
    number: dict[int, int] = {}
    shapes: dict[tuple, int] = {("#",): 1}
    count = 0
    order = [node]
    for n in order:                             # parents before children
        order.extend(n[1])
    for n in reversed(order):
        inner = tuple(c[2] for c in n[1] if c[2])
        key = ("#",) if n[0] == "#" else (n[0], *inner)
        n.append(0 if n[0] != "#" and not inner else shapes.setdefault(key, len(shapes) + 1))

    folded: list = [node[0], []]
    todo = [([node], folded)] if node[2] else []
    while todo:                                 # slots are met in page order
        group, out = todo.pop()
        if out[0] == "#":
            for n in group:
                number[id(n)] = count
            count += 1
            continue
        runs: list[list[list]] = []             # per child place: nodes of all group members
        for n in group:
            places, last = -1, None
            for c in n[1]:
                if not c[2]:
                    continue                    # no text below
                if c[2] != last:
                    places, last = places + 1, c[2]
                    if places == len(runs):
                        runs.append([])
                runs[places].append(c)
        out[1] = [[r[0][0], []] for r in runs]
        todo.extend(reversed(list(zip(runs, out[1]))))
    return folded, number


def flat(tree: list) -> str:
    """A tree as JSON of depth one: signature and number of children, in order."""
    out, todo = [], [tree]
    while todo:
        n = todo.pop()
        out += [n[0], len(n[1])]
        todo.extend(reversed(n[1]))
    return json.dumps(out)


def unflat(layout: str) -> tuple[list, int]:
    """The tree of ``flat`` and its depth."""
    items = json.loads(layout)
    root: list = [items[0], []]
    open_, deepest = [(root, items[1])], 1
    for at in range(2, len(items), 2):
        while not open_[-1][1]:
            open_.pop()
        parent, left = open_.pop()
        n = [items[at], []]
        parent[1].append(n)
        open_ += [(parent, left - 1), (n, items[at + 1])]
        deepest = max(deepest, len(open_))
    return root, deepest


def layout_of(html: str) -> tuple[str, list[tuple[int, str, bool, bool]]]:
    """Layout (``flat``) and (slot, text, in main, named as furniture) per block."""
    page = Page(html)
    tree, number = fold(page.root)
    return flat(tree), [(number[id(n)], t, m, f) for n, t, m, f in page.blocks]


def tree_matching(a: list, b: list) -> tuple[int, list[tuple[list, list]]]:
    """Simple tree matching: matched pairs of nodes under equal roots, order kept."""
    if a[0] != b[0]:
        return 0, []
    m, n = len(a[1]), len(b[1])
    best = [[0] * (n + 1) for _ in range(m + 1)]
    sub = {}
    for i in range(m):
        for j in range(n):
            sub[i, j] = tree_matching(a[1][i], b[1][j])
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + sub[i, j][0])
    pairs, i, j = [(a, b)], m, n
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs += sub[i, j][1]
    return best[m][n] + 1, pairs


class Wrapper:
    """A host's layouts merged into one tree; each slot knows the layouts'
    slots that were aligned with it."""

    def __init__(self):
        self.tree: list | None = None

    def add(self, layout: int, tree: list) -> None:
        new: list = [tree[0], [], []]       # [signature, children, aligned (layout, slot) pairs]
        todo, slot = [(tree, new)], 0
        while todo:
            node, copy = todo.pop()
            if node[0] == "#":
                copy[2].append((layout, slot))
                slot += 1
            copy[1] = [[c[0], [], []] for c in node[1]]
            todo.extend(reversed(list(zip(node[1], copy[1]))))
        if self.tree is None:
            self.tree = new
            return
        _, pairs = tree_matching(self.tree, new)
        partner = {id(b): a for a, b in pairs}
        self._merge(self.tree, new, partner)

    def _merge(self, mine: list, new: list, partner: dict) -> None:
        mine[2] += new[2]
        at = 0
        for c in new[1]:
            twin = partner.get(id(c))
            if twin is None:
                mine[1].insert(at, c)
                at += 1
            else:
                at = next(i for i, x in enumerate(mine[1]) if x is twin) + 1
                self._merge(twin, c, partner)

    def slots(self):
        out, todo = [], [self.tree] if self.tree else []
        while todo:
            n = todo.pop()
            if n[0] == "#":
                out.append(n[2])
            todo.extend(reversed(n[1]))
        return out


def slot_kinds(layouts: list[str], stats: dict[tuple[int, int], tuple[int, int, int]],
               min_pages: int = MIN_PAGES) -> tuple[set[tuple[int, int]], set[tuple[int, int]]]:
    """Slots (layout, slot) that are template, and those that vary. ``stats``:
    least and greatest text hash and number of different pages of a slot."""
    wrapper = Wrapper()
    for k in sorted(range(len(layouts)), key=layouts.__getitem__):
        tree, depth = unflat(layouts[k])
        # frames of Python functions lie on the heap: a deep page needs a higher
        # limit, not a larger stack
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * depth + 2_000))
        wrapper.add(k, tree)
    template, varying = set(), set()
    for aligned in wrapper.slots():
        seen = [stats[x] for x in aligned if x in stats]
        if seen and sum(n for *_, n in seen) >= min_pages:
            same = len({h for lo, hi, _ in seen for h in (lo, hi)}) == 1
            (template if same else varying).update(aligned)
    return template, varying


def is_teaser(slots: list[tuple[int, bool]]) -> bool:
    """Whether a varying slot outside holds more text than all within an article
    or main element together. ``slots``: length and whether within, of varying
    slots not named as furniture."""
    return max((n for n, main in slots if not main), default=0) > sum(n for n, main in slots if main)


def _parsed(pages: DataFrame, key: str) -> DataFrame:
    """host, layout, page digest, and per slot the hash of its text, the length of
    what is not named as furniture and whether it is within an article; the blocks."""
    kind = pages.schema[key].dataType.simpleString()

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            from xxhash import xxh3_64_intdigest
            signed = lambda t: xxh3_64_intdigest(t) - (1 << 63)
            out = {k: [] for k in ("layout", "page", "facts", "slots", "blocks", "mains", "named")}
            for html in texts(batch.column(2)):
                layout, blocks = layout_of(html)
                held: dict[int, list[str]] = {}
                main: dict[int, bool] = {}
                plain: dict[int, int] = {}
                for slot, t, m, f in blocks:
                    held.setdefault(slot, []).append(t)
                    main[slot] = main.get(slot, False) or m
                    plain[slot] = plain.get(slot, 0) + (0 if f else len(t))
                out["layout"].append(layout)
                out["page"].append(signed("\n".join(t for _, t, *_ in blocks)))
                out["facts"].append([{"hash": signed("\n".join(held[s])), "chars": plain[s], "main": main[s]}
                                     for s in sorted(held)])
                out["slots"].append([s for s, *_ in blocks])
                out["blocks"].append([t for _, t, *_ in blocks])
                out["mains"].append([m for _, _, m, _ in blocks])
                out["named"].append([f for *_, f in blocks])
            return out | {"key": batch.column(0), "url": batch.column(1)}
        return run

    parsed = map_batches(pages.select(key, "url", "html"), make,
                         f"key {kind}, url string, layout string, page long, "
                         "facts array<struct<hash:long,chars:long,main:boolean>>, "
                         "slots array<int>, blocks array<string>, mains array<boolean>, "
                         "named array<boolean>")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")),
                                    r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    return parsed.withColumns({"host": host, "layout_id": F.md5(F.col("layout").cast("binary"))})


def _templates(parsed: DataFrame, min_pages: int) -> DataFrame:
    """host, layout_id, its template slots and whether its article is a teaser
    (only layouts that have either).

    A layout's tree travels with its first slot only: the rows of a page grow with
    its slots, not with slots times depth."""
    layout = ["host", "layout_id"]
    # every page of a layout has all of its slots
    pages = parsed.groupBy(*layout).agg(F.count_distinct("page").alias("n"))
    slots = (parsed.select(*layout, "layout", F.posexplode("facts").alias("slot", "fact"))
             .withColumn("layout", F.when(F.col("slot") == 0, F.col("layout")))
             .groupBy(*layout, "slot")
             .agg(F.max("layout").alias("layout"), F.min("fact.hash").alias("lo"), F.max("fact.hash").alias("hi"),
                  F.sum("fact.chars").alias("chars"), F.max("fact.main").alias("main"))
             .join(pages, layout))

    def merge(rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        trees = sorted((r["layout"], r["layout_id"]) for r in rows if r["slot"] == 0)
        names = [name for _, name in trees]
        at = {n: k for k, n in enumerate(names)}
        stats = {(at[r["layout_id"]], r["slot"]): (r["lo"], r["hi"], r["n"]) for r in rows}
        template, varying = slot_kinds([t for t, _ in trees], stats, min_pages)
        found: dict[int, list[int]] = {}
        for k, s in sorted(template):
            found.setdefault(k, []).append(s)
        told: dict[int, list[tuple[int, bool]]] = {}
        for r in rows:
            k = at[r["layout_id"]]
            if (k, r["slot"]) in varying:
                told.setdefault(k, []).append((r["chars"], r["main"]))
        teasers = {k for k, slots in told.items() if is_teaser(slots)}
        some = sorted(found.keys() | teasers)
        return pa.table([pa.array([rows[0]["host"]] * len(some), pa.string()),
                         pa.array([names[k] for k in some], pa.string()),
                         pa.array([found.get(k, []) for k in some], pa.list_(pa.int32())),
                         pa.array([k in teasers for k in some], pa.bool_())],
                        names=["host", "layout_id", "template", "teaser"])

    return slots.groupBy("host").applyInArrow(
        merge, "host string, layout_id string, template array<int>, teaser boolean")


def extract(pages: DataFrame, key: str = "page_id", min_pages: int = MIN_PAGES) -> DataFrame:
    """``key``, url and the main text of every page row."""
    parsed = staged(_parsed(pages, key), "wrapper-pages")
    found = staged(_templates(parsed, min_pages), "wrapper-templates")
    b = parsed.join(found, ["host", "layout_id"], "left")
    block = F.arrays_zip("slots", "blocks", "mains", "named")
    b = b.withColumn("all", block)
    kept = F.filter("all", lambda x: ~F.coalesce(
        F.array_contains("template", x["slots"]), F.lit(False)))
    # a page with a main element is that element alone unless it is a teaser; names
    # of furniture give way to other text
    rules = (lambda x: ~x["mains"] & ~x["named"] & F.coalesce("teaser", F.lit(False)),
             lambda x: x["mains"] & ~x["named"], lambda x: x["mains"], lambda x: ~x["named"],
             lambda x: F.lit(True))
    chosen = F.coalesce(*[F.when(F.exists("all", r), F.filter(kept, r)) for r in rules],
                        F.array().cast(b.schema["all"].dataType))
    return b.select(F.col("key").alias(key), "url",
                    F.array_join(F.transform(chosen, lambda x: x["blocks"]), "\n").alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("long"))
