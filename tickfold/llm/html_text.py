"""Main text of web pages by wrapper induction (operator 4).

Each page is cut into slots: an element, or a run of like neighbours such as
the items of a list.  A slot's value is a hash of all structure and text under it.

1. Pages of a host that are cut alike (and, where neighbours are cut alike, have
   the same there) share a layout.  The most frequent layouts of
   a host are aligned by simple tree matching and folded into one wrapper tree;
   every layout, frequent or not, is then aligned to its host's wrapper, which
   gives its slots their place.  What a layout has beside the wrapper gets its
   place from the path below the last aligned slot.
2. Below each place pages are counted for each value, pages of equal content once.  A
   value that a large share of the host's pages has is constant: template,
   whatever the slot holds on other pages.  Slots that vary are content.
3. Pages are read block by block without their topmost constant slots; the article
   is what is left under <main> or <article>, or else in the body.

Class names decide nothing alone, see ``judge``.  Counts are rows summed by
groupBy, combined in the tasks; what meets in one task of a host are its LAYOUTS
most frequent layouts, with one page each.  By arithmetic a host has fewer
constant values than a few pages have slots, and a page is sent those of its own
layout only.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickfold.llm.common import stored

#: Distinct pages that must have a value for it to count as template, and one in
#: how many of the host's distinct pages.
SUPPORT = 8
ONE_IN = 5
#: Deeper elements hang on the one at this depth.
DEPTH = 150
#: Layouts of a host that its wrapper is folded from, the most frequent first.
LAYOUTS = 40
#: Layouts that are aligned to a wrapper in one task, at most about.
PART = 500
#: Pairs of neighbours beyond which equal keys are paired by their number, not by tree matching.
PAIRS = 10_000
#: Characters of layouts that a task holds before it hands them on.
HELD_CHARS = 16_000_000

# Element kinds of HTML, and words that mark what is not the article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe noembed noframes template svg math".split())
DROPPED = RAW | set("head nav footer aside form button select option dialog menu object canvas "
                    "audio video map datalist input label legend fieldset".split())
BLOCKS = set("address article blockquote body caption center dd details div dl dt figcaption figure "
             "h1 h2 h3 h4 h5 h6 header hgroup hr html li main ol p pre section summary table tbody td "
             "tfoot th thead tr ul head nav footer aside form dialog menu fieldset legend".split())
CONTAINERS = set("address article aside details div dl figure ol p section table ul".split())
REPEATED = set("p li tr td th dt dd h2 h3 h4 br a span b i em strong img hr blockquote pre".split())
TEXTS = set("p li td th dt dd h1 h2 h3 h4 h5 h6 pre blockquote figcaption caption summary address".split())
LANDMARKS = {"html", "body", "main", "article"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
          "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
CLOSE_STOPS = {"ul", "ol", "dl", "table", "select", "body", "article", "main", "section", "div"}
MARKS = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
            "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
            "subscription signup nav navbar navigation menu menus breadcrumb breadcrumbs header masthead "
            "footer sidebar aside widget widgets related recommended recommendations share sharing social "
            "pagination pager login search toolbar skip hidden".split())
COMMENTS = set("comment comments discussion disqus reply replies respond".split())
FILLERS = set("area bar block box btn buttons column container content inner items left links list main outer "
              "page panel post posts primary right secondary section site slot top unit wrap wrapper".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu "
            "menubar".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"
                   r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
WORD = re.compile(r"[a-z]+")
#: Attributes that end in the slash of a self-closed element, not in an unquoted value.
SELF_CLOSED = re.compile(r"(?:^|[\s\"'])[^\s=\"'/>]*/\s*$")


#: What the names of an element say of it.
NOTHING, HINTED, NAMED, COMMENT, FORM = range(5)


class Node:
    __slots__ = ("children", "hint", "key", "marked", "tag")

    def __init__(self, tag: str, key: str, marked: bool, hint: int = NOTHING):
        self.tag, self.key, self.marked, self.hint, self.children = tag, key, marked, hint, []


def hint_of(tag: str, names: str) -> int:
    """What class and id say: NAMED if one is made of marking words alone."""
    hint = NOTHING
    for name in names.lower().split():
        words = set(WORD.findall(name))
        if words & COMMENTS:
            return COMMENT
        if words & MARKS:
            hint = max(hint, NAMED if words <= MARKS | FILLERS else HINTED)
    return hint


def _element(tag: str, attributes: str) -> Node:
    dropped, hint = tag in DROPPED and tag != "form", FORM if tag == "form" else NOTHING
    if not attributes or attributes.isspace():
        return Node(tag, tag, dropped, hint)
    found = {k.lower(): entities.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(attributes)}
    marked = dropped or "hidden" in found or found.get("aria-hidden") == "true" \
        or found.get("role", "").lower() in ROLES \
        or re.search(r"display\s*:\s*none", found.get("style", "")) is not None
    if tag in CONTAINERS and not marked:
        hint = hint_of(tag, f"{found.get('class', '')} {found.get('id', '')}")
    classes = ".".join(sorted(set(re.sub(r"\d+", "0", found.get("class", "").lower()).split()))[:4])
    return Node(tag, f"{tag}.{classes}" if classes else tag, marked, hint)


def judge(page: Node) -> None:
    """Mark the elements that their names hint at and the page confirms.

    No element that holds a <main>, an <h1> or the page's largest <article> is marked,
    and none but comments and forms that holds most of the page's text.  Forms
    and comments go; what is named by marking words alone goes; what has but a
    part of a name in common with them goes if most of its text is links, or if
    the page has no <main> or <article> to tell what is inside.
    """
    sizes: dict[int, tuple[int, int]] = {}  # characters, and those in links
    above: dict[int, Node] = {}
    keep: list[Node] = []
    articles: list[Node] = []

    def measure(node: Node, in_link: bool, in_comments: bool):
        chars = links = 0
        for x in node.children:
            if type(x) is str:
                n = len(x) - x.count(" ")
                chars += n
                links += n if in_link else 0
            elif not x.marked:
                above[id(x)] = node
                within = in_comments or x.hint == COMMENT
                measure(x, in_link or x.tag == "a", within)
                chars, links = chars + sizes[id(x)][0], links + sizes[id(x)][1]
                if x.tag in ("main", "h1"):
                    keep.append(x)
                elif x.tag == "article" and not within:
                    articles.append(x)
        sizes[id(node)] = chars, links

    measure(page, False, False)
    total = sizes[id(page)][0]
    landmarks = bool(articles) or any(x.tag == "main" for x in keep)
    if articles:
        keep.append(max(articles, key=lambda x: sizes[id(x)][0]))
    holds: set[int] = set()
    for x in keep:
        while x is not page and id(x) not in holds:
            holds.add(id(x))
            x = above[id(x)]

    def verdict(node: Node):
        for x in node.children:
            if type(x) is str or x.marked:
                continue
            chars, links = sizes[id(x)]
            x.marked = x.hint != NOTHING and id(x) not in holds and (
                x.hint in (COMMENT, FORM) or (2 * chars <= total and (
                    x.hint == NAMED or 2 * links > chars or not landmarks)))
            if not x.marked:
                verdict(x)

    verdict(page)


def parse(html: str) -> Node:
    """The DOM tree; texts are str children, references not decoded yet."""
    root = Node("#page", "#page", False)
    stack, at, end, hinted = [root], 0, len(html), False
    while at < end:
        token = TOKEN.search(html, at)
        if token is None:
            stack[-1].children.append(html[at:])
            break
        if token.start() > at:
            stack[-1].children.append(html[at:token.start()])
        at = token.end()
        name = token.group(2)
        if name is None:
            if token.group().startswith("<![CDATA["):
                stack[-1].children.append(entities.escape(token.group()[9:].removesuffix("]]>")))
            continue
        tag = name.lower()
        if token.group(1):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in BLOCKS and any(x.tag == "p" for x in stack[-8:]):
            for k in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in CLOSE_STOPS:
                    break
        for k in range(len(stack) - 1, 0, -1) if tag in CLOSES else ():
            if stack[k].tag in CLOSES[tag]:
                del stack[k:]
            elif stack[k].tag in CLOSE_STOPS:
                break
        node = _element(tag, token.group(3))
        stack[-1].children.append(node)
        hinted |= node.hint != NOTHING
        if tag in ("svg", "math") and SELF_CLOSED.search(token.group(3)):
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = close.end() if close else end
        elif tag not in VOID and not token.group(3).rstrip().endswith("/") and len(stack) < DEPTH:
            stack.append(node)
    if hinted:
        judge(root)
    return root


def clean(text: str) -> str:
    return " ".join(entities.unescape(text).split())


class Slot:
    """A slot of a page or a wrapper: the hash of all that is under it (-1 in a
    wrapper where layouts differ) and of its cut, the characters under it, the
    slots below, its nodes; in a wrapper the values seen and its place."""

    __slots__ = ("below", "chars", "cut", "key", "nodes", "pages", "place", "seen", "text")

    def __init__(self, key, pages, text, chars, below, nodes=(), seen=None):
        self.key, self.pages, self.text, self.chars, self.below = key, pages, text, chars, below
        self.nodes, self.seen, self.place, self.cut = nodes, seen or {text}, 0, 0


def _hash(*parts: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b"\0".join(parts), digest_size=8).digest(), "little", signed=True)


def _raw(value: int) -> bytes:
    return value.to_bytes(8, "little", signed=True)


def slots(nodes: list[Node]) -> Slot:
    """The slot tree of one page; neighbours of a kind that repeats share a slot.

    Marked elements are never content and not part of any value; headings in a
    <header> may be.
    """
    content: list[str] = []
    chars = 0
    runs: list[list[Node]] = []
    for n in nodes:
        content.append("<>")
        last = None
        for x in n.children:
            if type(x) is str:
                text = " ".join(x.split())
                if text:
                    content.append(text)
                    chars += len(text)
                    last = None
            elif not x.marked or x.tag == "header":
                content.append("<" + x.key)
                if last and last[0].key == x.key and x.tag in REPEATED:
                    last.append(x)
                else:
                    last = [x]
                    runs.append(last)
    below = [slots(r) for r in runs]
    key = nodes[0].key.encode(errors="surrogatepass")
    own = _hash(key, "\n".join(content).encode(errors="surrogatepass"), b"".join(_raw(x.text) for x in below))
    slot = Slot(nodes[0].key, 1, own, chars + sum(x.chars for x in below), below, nodes)
    # Like neighbours may have changed places: only their values tell which is which.
    like = Counter(x.cut for x in below if x.nodes[0].tag not in REPEATED)
    slot.cut = _hash(key, b"".join(_raw(x.cut) + (_raw(x.text) if like[x.cut] > 1 else b"") for x in below))
    return slot


def preorder(slot: Slot) -> list[Slot]:
    out, todo = [], [slot]
    while todo:
        out.append(todo.pop())
        todo.extend(reversed(out[-1].below))
    return out


def has_landmark(slot: Slot) -> bool:
    return slot.nodes[0].tag in LANDMARKS or any(map(has_landmark, slot.below))


# Simple tree matching.

def matching(a: Slot, b: Slot, known: dict | None = None) -> int:
    """Nodes in the largest match that keeps order and parents; those with a value
    in common count threefold, so that like neighbours are told apart by them."""
    if a.key != b.key:
        return 0
    known = {} if known is None else known
    at = id(a), id(b)
    if at not in known:
        known[at] = (1 if a.seen.isdisjoint(b.seen) else 3) + sum(matching(x, y, known) for x, y in aligned(a.below, b.below, known))
    return known[at]


def aligned(a: list[Slot], b: list[Slot], known: dict | None = None) -> list[tuple[Slot, Slot]]:
    """The pairs of the largest match."""
    known = {} if known is None else known
    keys = {x.key for x in a}
    if len(keys) == len(a) == len(b) and all(x.key == y.key for x, y in zip(a, b, strict=True)):
        return list(zip(a, b, strict=True))
    both = keys & {y.key for y in b}  # others have no partner
    a, b = [x for x in a if x.key in both], [y for y in b if y.key in both]
    if len(a) * len(b) > PAIRS:
        return _in_order(a, b)
    score = {(i, j): matching(x, y, known)
             for i, x in enumerate(a) for j, y in enumerate(b) if x.key == y.key}
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + score.get((i, j), 0))
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if (i, j) in score and best[i][j] == best[i + 1][j + 1] + score[i, j]:
            out.append((a[i], b[j]))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return out


def _in_order(a: list[Slot], b: list[Slot]) -> list[tuple[Slot, Slot]]:
    """For long rows of neighbours: the n-th of a key to the n-th, the longest part that keeps order."""
    def numbered(row):
        seen: Counter[str] = Counter()
        for k, x in enumerate(row):
            seen[x.key] += 1
            yield (x.key, seen[x.key]), k

    there = dict(numbered(b))
    pairs = [(i, there[name]) for name, i in numbered(a) if name in there]
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for at, (_, j) in enumerate(pairs):
        k = bisect_left(ends, j)
        before.append(last[k - 1] if k else -1)
        ends[k:k + 1], last[k:k + 1] = [j], [at]
    out, at = [], last[-1] if last else -1
    while at >= 0:
        out.append((a[pairs[at][0]], b[pairs[at][1]]))
        at = before[at]
    return out[::-1]


def fold(a: Slot, b: Slot, known: dict | None = None) -> Slot:
    """The wrapper of both, which have the same key."""
    known = {} if known is None else known
    pairs = {id(x): y for x, y in aligned(a.below, b.below, known)}
    matched = {id(y) for y in pairs.values()}
    below, rest = [], iter(b.below)
    for x in a.below:
        if id(x) in pairs:
            for y in rest:
                if y is pairs[id(x)]:
                    break
                if id(y) not in matched:
                    below.append(y)
            below.append(fold(x, pairs[id(x)], known))
        else:
            below.append(x)
    below.extend(rest)
    return Slot(a.key, a.pages + b.pages, a.text if a.text == b.text else -1, a.chars + b.chars, below,
                seen=a.seen | b.seen)


def dump(slot: Slot) -> str:
    def plain(x):
        return [x.key, sorted(x.seen), [plain(y) for y in x.below]]
    return json.dumps(plain(slot), separators=(",", ":"))


def load(text: str) -> Slot:
    def slot(x):
        return Slot(x[0], 1, x[1][0], 0, [slot(y) for y in x[2]], seen=set(x[1]))
    return slot(json.loads(text))


def places(layout: Slot, wrapper: Slot) -> list[int]:
    """For each slot of ``layout`` in preorder the place of the slot above it.

    The places of the wrapper are its preorder numbers.  A value counts below one
    aligned slot, so that neighbours that change their order stay what they are.
    """
    for number, x in enumerate(preorder(wrapper)):
        x.place = number
    out: list[int] = []
    known: dict = {}

    def go(x: Slot, partner: Slot | None, place: int, parent: int):
        out.append(parent)
        pairs = {id(c): y for c, y in aligned(x.below, partner.below, known)} if partner else {}
        for c in x.below:
            y = pairs.get(id(c))
            # Negative, so that it is no number of the wrapper.
            go(c, y, y.place if y else _hash(_raw(place), c.key.encode(errors="surrogatepass")) | -1 << 63, place)

    go(layout, wrapper, wrapper.place, -1)
    return out


def text_of(html: str | None, template: set[tuple[int, int]] | None) -> str:
    """The article's blocks of one page, joined by line breaks.

    ``template`` holds (preorder number of the slot, value) of constant slots.
    """
    if not html:
        return ""
    page = parse(html)
    constant: set[int] = set()  # page nodes that the host's template holds
    if template:
        root = slots([page])
        numbers = {id(x): i for i, x in enumerate(preorder(root))}

        def compare(own: Slot):
            for x in own.below:
                if (numbers[id(x)], x.text) not in template:
                    compare(x)
                elif not has_landmark(x):  # an article that pages share is no template, nor are its parts
                    constant.update(map(id, x.nodes))

        compare(root)

    def in_text(node: Node) -> bool:
        """Whether inline elements of ``node`` are parts of a running text."""
        return node.tag in TEXTS or (node.tag not in BLOCKS and node.tag != "#page") or any(
            not x.isspace() if type(x) is str else
            not (x.marked or x.tag in BLOCKS or x.tag in VOID or id(x) in constant) for x in node.children)

    found: list[Node] = []

    def landmarks(node: Node):
        for x in node.children:
            if type(x) is Node and not x.marked:
                found.append(x) if x.tag in ("article", "main") else landmarks(x)

    landmarks(page)
    found = [x for x in found if x.tag == "main"] or found
    blocks: list[str] = []
    line: list[str] = []

    def close():
        text = clean("".join(line))
        if text:
            blocks.append(text)
        line.clear()

    def read(node: Node, headings_only: bool):
        for x in node.children:
            if type(x) is str:
                if not headings_only:
                    line.append(x)
                continue
            if x.tag == "br":
                line.append(" ")
                continue
            heading = x.tag in ("h1", "h2", "h3", "h4", "h5", "h6")
            is_header = x.tag == "header"
            if (x.marked and not is_header) or (
                    id(x) in constant and (x.tag in BLOCKS or not in_text(node))):
                if x.tag in BLOCKS:
                    close()
                continue
            if is_header and not found:
                close()
                continue
            block = x.tag in BLOCKS
            if block:
                close()
            read(x, (headings_only or is_header) and not heading)
            if block:
                close()

    for root in found or [page]:
        read(root, False)
        close()
    return "\n".join(blocks)


def host_of(url: str):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


CUT = "page_id bigint, url string, html string, host string, layout bigint, found array<bigint>, tree string"


def cut(pages: DataFrame) -> DataFrame:
    """CUT: each page (page_id, url, html, host) with its layout and the values of its
    slots in preorder; tree: the layout itself, on some of its pages."""
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.string()]
    names = [x.split()[0] for x in CUT.split(", ")]

    def run(batches):
        given: set[tuple[str, int]] = set()
        held = 0
        for batch in batches:
            rows: list[tuple] = []
            for html, host in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
                html = html.as_py()
                if not html:
                    rows.append((None, None, None))
                    continue
                root = slots([parse(html)])
                tree = None
                if (host, root.cut) not in given:
                    tree = dump(root)
                    held += len(tree)
                    given.add((host, root.cut))
                    if held > HELD_CHARS:
                        given.clear()
                        held = 0
                rows.append((root.cut, [x.text for x in preorder(root)], tree))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=names)

    return pages.select("page_id", "url", "html", "host").mapInArrow(run, CUT)


def _wrapper(key, table):
    """One host's layouts, in their order, folded into its wrapper."""
    trees = table.sort_by("rank")["tree"].to_pylist()
    wrapper = load(trees[0])
    for tree in trees[1:]:
        wrapper = fold(wrapper, load(tree))
    return pa.table({"host": [key[0].as_py()], "wrapper": [dump(wrapper)]})


def _places(layouts, wrappers):
    found = [places(load(x), load(wrappers["wrapper"][0].as_py())) for x in layouts["tree"].to_pylist()]
    return pa.table({"host": layouts["host"], "layout": layouts["layout"],
                     "places": pa.array(found, pa.list_(pa.int64()))})


def placed_layouts(pages: DataFrame) -> DataFrame:
    """(host, layout, places) of all layouts of ``pages`` (host, layout, tree)."""
    layouts = pages.filter("tree IS NOT NULL").groupBy("host", "layout").agg(F.min("tree").alias("tree"))
    sizes = pages.filter("layout IS NOT NULL").groupBy("host", "layout").agg(F.count(F.lit(1)).alias("n"))
    layouts = stored(layouts.join(sizes, ["host", "layout"]), "html-layouts")
    order = Window.partitionBy("host").orderBy(F.desc("n"), "layout")
    frequent = layouts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= LAYOUTS)
    wrappers = stored(frequent.select("host", "tree", "rank").groupBy("host").applyInArrow(
        _wrapper, "host string, wrapper string"), "html-wrappers")
    # A host of many layouts is dealt to parts, each with a copy of its wrapper.
    parts = layouts.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"))
    copies = wrappers.join(parts, "host").withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)")))
    own = layouts.join(parts, "host").withColumn("part", F.expr("pmod(layout, parts)"))
    return own.select("host", "layout", "tree", "part").groupBy("host", "part").cogroup(
        copies.select("host", "part", "wrapper").groupBy("host", "part")).applyInArrow(
        _places, "host string, layout bigint, places array<bigint>")


def templates(pages: DataFrame) -> DataFrame:
    """(host, layout, template): the constant slots (number, value) of each layout
    that has any, of ``pages`` as ``cut`` gives them."""
    layouts = stored(placed_layouts(pages), "html-places")
    part = pages.filter("layout IS NOT NULL").select("host", "layout", "found")
    # Equal values of all slots are equal content.
    part = part.withColumn("content", F.element_at("found", 1)).groupBy("host", "content").agg(
        F.first("layout").alias("layout"), F.first("found").alias("found"))
    whole = part.groupBy("host").agg(F.count(F.lit(1)).alias("whole"))
    rows = part.join(layouts, ["host", "layout"]).select(
        "host", F.explode(F.array_distinct(F.arrays_zip("places", F.col("found").alias("values")))).alias("x"))
    counts = rows.groupBy("host", F.col("x.places").alias("place"), F.col("x.values").alias("value")).agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= SUPPORT)
    constant = stored(counts.join(whole, "host").filter(F.col("n") * ONE_IN >= F.col("whole")).select(
        "host", "place", "value"), "html-constant")
    slot = layouts.select("host", "layout", F.posexplode("places").alias("number", "place"))
    return slot.join(constant, ["host", "place"]).groupBy("host", "layout").agg(
        F.sort_array(F.collect_list(F.struct(F.col("number").cast("bigint").alias("number"), "value"))).alias("template"))


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (its code points).

    A null or empty html has no text; a null url belongs to the host of no
    name; rows that repeat are read each; an empty table gives no rows; other
    columns are not looked at.
    """
    pages = stored(cut(pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                                    "html", host_of("url").alias("host"))), "html-cut")
    found = stored(templates(pages), "html-templates")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()),
                        ("n_chars", pa.int64())])

    def run(batches):
        for batch in batches:
            texts = [text_of(html.as_py(), {(x["number"], x["value"]) for x in held.as_py() or ()})
                     for html, held in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(x) for x in texts], pa.int64())], schema=schema)

    return pages.select("page_id", "url", "html", "host", "layout").join(found, ["host", "layout"], "left").select(
        "page_id", "url", "html", "template").mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint")
