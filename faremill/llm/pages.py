"""Main text of web pages by wrapper induction.

Pages of one host come from one template. One page of the host is the seed of its wrapper,
and every page is aligned with the seed by simple tree matching, in which equal texts weigh
more than unlike ones; what has no partner is put into the wrapper below the place of its
element. What a share of the host's unlike articles have alike in one place of the wrapper
is template, what varies is a slot. The text of a page is what lies in the slots of the
article, or of the region with most varying text if no element is marked as the article.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.storage import written
from faremill.llm.words import slices


@dataclass(frozen=True)
class Wrapper:
    """share: part of a host's unlike articles that have a text of the template, two at
    least; most: part of a page's varying text from which on an element is no boilerplate
    for a part of its name; parts: groups that a host's pages are dealt to; cells: largest
    table of children that matched() holds, larger ones are halved, with the same score."""

    share: float = 0.5
    most: float = 0.5
    parts: int = 16
    cells: int = 1 << 20


# Fixed names: elements and words of class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol "
    "option p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "script style noscript template iframe object svg math head title nav footer aside form button "
    "select textarea input menu dialog canvas audio video".split()
)
CLOSES = {  # an opening tag that ends an open one of these, up to one of the limits
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "option": (("option",), ("select",)),
}
ENDS_P = BLOCKS - frozenset("body caption dd dt html legend li option summary tbody td tfoot th thead tr".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted banner sidebar "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs footer masthead cookie cookies consent "
    "gdpr notice notices alert popup modal overlay comment comments commentlist respond disqus reply "
    "replies share sharing social related recommended newsletter subscribe subscription signup login "
    "pagination pager widget skip toolbar complementary contentinfo search".split()
)
COMMENTS = frozenset("comment comments commentlist respond disqus reply replies".split())
MAIN_TAGS = ("article", "main")
MAIN_NAMES = frozenset("article main content post entry story articlebody".split())
_SPLIT = re.compile(r"[^a-z0-9]+")
_CUT_TAG = re.compile(r"<(?:[a-zA-Z/!?][^<>]*)?\Z")


@dataclass(slots=True, eq=False)
class Node:
    """names: words of class, id and role; pieces: what hyphens and the like part in them.

    Set by shaped(): value, a hash of the own text with its tags and times, None without
    text; inner: the child nodes; order, values: of a root, all nodes, parents before
    children, and their values. Set by matched(): form, equal for equal trees of tags and of values that both pages have;
    weight: of the tree matched with an equal one."""

    tag: str
    names: frozenset = frozenset()
    pieces: frozenset = frozenset()
    parts: list = field(default_factory=list)  # text and nodes in order
    value: int | None = None
    inner: list = field(default_factory=list)
    order: list = field(default_factory=list)
    values: frozenset = frozenset()
    form: int = 0
    weight: int = 0

    def children(self) -> list[Node]:
        return [x for x in self.parts if not isinstance(x, str)]

    def own_text(self) -> str:
        return " ".join(" ".join([x for x in self.parts if isinstance(x, str)]).split())


def names_of(attrs) -> tuple[frozenset, frozenset]:
    words = [v.lower() for k, v in attrs if v and k in ("class", "id", "role", "itemprop")]
    names = frozenset([part for v in words for part in v.split()])
    pieces = frozenset([w for name in names for w in _SPLIT.split(name) if w])
    hidden = any([k in ("hidden", "aria-hidden") and v != "false" for k, v in attrs])
    return (names | {"#hidden"} if hidden else names), pieces


class Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_P:
            self.end_open(("p",), ("button", "table", "td", "th", "li", "article", "section", "div"))
        if tag in CLOSES:
            self.end_open(*CLOSES[tag])
        node = Node(tag, *names_of(attrs)) if attrs else Node(tag)
        self.open[-1].parts.append(node)
        if tag not in VOID:
            self.open.append(node)

    def updatepos(self, i, j):
        return j  # nobody asks for lines

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.end_open((tag,), ())

    def end_open(self, tags, limits):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return
            if self.open[i].tag in limits:
                return

    def handle_data(self, data):
        self.open[-1].parts.append(data)


def parse(html: str) -> Node:
    builder = Builder()
    builder.feed(_CUT_TAG.sub("", html))
    builder.close()
    return builder.root


def formed(root: Node, common: set[int], forms: dict) -> None:
    """Numbers equal trees alike. A value that one of the pages lacks equals none."""
    for node in reversed(root.order):  # children before their parents
        own = node.value if node.value in common else None
        weight, inner = 1 if own is None else 2, node.inner
        if inner:
            key = (node.tag, own, *[x.form for x in inner])
            weight += sum([x.weight for x in inner])
        else:
            key = (node.tag, own)
        node.form = forms.setdefault(key, len(forms))
        node.weight = weight


def trimmed(left: list[Node], right: list[Node]) -> tuple[int, int]:
    """Equal trees at the front and, of the rest, at the end. To match them costs nothing:
    neither could weigh more elsewhere, and what is matched with one of them is free."""
    n, front, end = min(len(left), len(right)), 0, 0
    while front < n and left[front].form == right[front].form:
        front += 1
    while end < n - front and left[-1 - end].form == right[-1 - end].form:
        end += 1
    return front, end


def middle(x: Node, y: Node) -> tuple[list[Node], list[Node], int]:
    """Children of both that trimmed() leaves, and the weight of the others."""
    front, end = trimmed(x.inner, y.inner)
    left, right = x.inner[front : len(x.inner) - end], y.inner[front : len(y.inner) - end]
    return left, right, sum(c.weight for c in x.inner) - sum(c.weight for c in left)


def pair_weight(x: Node, y: Node, memo: dict) -> int:
    if x.tag != y.tag:
        return 0
    if x.form == y.form:
        return x.weight
    if x.inner and y.inner:
        return memo[x.form, y.form]
    return 1 + (x.value is not None and x.value == y.value)


def weights(left: list[Node], right: list[Node], memo: dict):
    """For each node of the left, the weights of its tree matched with those of the right."""
    tags = np.array([hash(y.tag) for y in right])
    values = np.array([y.value or 0 for y in right])
    deep = [(j, y) for j, y in enumerate(right) if y.inner]
    for x in left:
        row = (tags == hash(x.tag)).astype(np.int64)
        if x.value is not None:
            row += row * (values == x.value)
        if x.inner:
            for j, y in deep:
                row[j] = pair_weight(x, y, memo)
        yield row


def table(left: list[Node], right: list[Node], memo: dict):
    """Rows of the most weight of each front of the left with each front of the right."""
    if len(right) < 24:  # arrays would cost more
        best = [0] * (len(right) + 1)
        for x in left:
            now = [0]
            for j, y in enumerate(right):
                now.append(max(best[j + 1], now[j], best[j] + pair_weight(x, y, memo)))
            best = now
            yield best
        return
    best = np.zeros(len(right) + 1, dtype=np.int64)
    for row in weights(left, right, memo):
        now = best.copy()
        now[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + row))
        best = now
        yield best


def last(rows):
    for row in rows:
        pass
    return row


def weigh(a: Node, b: Node) -> dict[tuple[int, int], int]:
    """The most weight of matching two trees of one tag, for all that meet in them, by form."""
    memo: dict[tuple[int, int], int] = {}
    stack = [(a, b)]
    while stack:
        x, y = stack[-1]
        left, right, total = middle(x, y)
        deep = [v for v in right if v.inner]
        wanted = [
            (u, v)
            for u in left
            if u.inner
            for v in deep
            if u.tag == v.tag and u.form != v.form and (u.form, v.form) not in memo
        ]
        if wanted:
            stack += wanted
            continue
        stack.pop()
        if left and right:
            total += int(last(table(left, right, memo))[-1])
        alike = x.value is not None and x.value == y.value
        memo[x.form, y.form] = 1 + alike + total
    return memo


def sequence(left: list[Node], right: list[Node], plan: Wrapper, memo: dict) -> list[tuple[Node, Node]]:
    """Pairs of the heaviest matching of two sequences in order."""
    out, stack = [], [(left, right)]
    while stack:
        left, right = stack.pop()
        if not left or not right:
            continue
        if len(left) > 1 and len(left) * len(right) > plan.cells:
            half = len(left) // 2
            fore = np.asarray(last(table(left[:half], right, memo)))
            back = np.asarray(last(table(left[: half - 1 : -1], right[::-1], memo)))[::-1]
            cut = int(np.argmax(fore + back))
            stack += [(left[half:], right[cut:]), (left[:half], right[:cut])]
            continue
        score = [[0] * (len(right) + 1), *table(left, right, memo)]
        i, j = len(left), len(right)
        while i and j:
            if score[i][j] == score[i - 1][j]:
                i -= 1
            elif score[i][j] == score[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((left[i], right[j]))
    return out


def matched(a: Node, b: Node, plan: Wrapper) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: the heaviest pairs of nodes that two trees share in order, and
    their number. Roots must have the same tag. A pair weighs 1, with equal values 2."""
    if a.tag != b.tag:
        return 0, []
    for root in (a, b):
        if not root.order:
            shaped(root)
    common = a.values & b.values
    forms: dict = {}
    formed(a, common, forms)
    formed(b, common, forms)
    memo = weigh(a, b) if a.form != b.form else {}
    pairs, stack = [], [(a, b)]
    while stack:
        x, y = stack.pop()
        pairs.append((x, y))
        if x.form == y.form:
            stack += zip(x.inner, y.inner, strict=True)
        elif x.inner and y.inner:
            front, end = trimmed(x.inner, y.inner)
            n, m = len(x.inner), len(y.inner)
            stack += zip(x.inner[:front], y.inner[:front], strict=True)
            stack += zip(x.inner[n - end :], y.inner[m - end :], strict=True)
            stack += sequence(x.inner[front : n - end], y.inner[front : m - end], plan, memo)
    return len(pairs), pairs


def constants(root: Node) -> list[tuple[int, list[Node]]]:
    """Each text with the tags it lies in and its times there, as a 64-bit hash; its nodes."""
    found: dict[bytes, list[Node]] = {}
    paths: dict[tuple[bytes, str], bytes] = {}
    stack = [(root, b"")]
    while stack:
        node, above = stack.pop()
        path = paths.get((above, node.tag))
        if path is None:
            path = hashlib.blake2b(above + node.tag.encode("utf-8", "replace"), digest_size=8).digest()
            paths[above, node.tag] = path
        if text := node.own_text():
            found.setdefault(path + text.encode("utf-8", "replace"), []).append(node)
        stack += [(x, path) for x in reversed(node.parts) if not isinstance(x, str)]
    out = []
    for key, nodes in found.items():
        digest = hashlib.blake2b(key, digest_size=8, salt=len(nodes).to_bytes(8, "big")).digest()
        out.append((int.from_bytes(digest, "big", signed=True), nodes))
    return out


def walk(node: Node):
    stack = [node]
    while stack:
        node = stack.pop()
        yield node
        stack += reversed(node.children())


def shaped(root: Node) -> Node:
    """Sets what matched() and placed() read of the nodes."""
    root.order = list(walk(root))
    for node in root.order:
        node.inner = node.children()
    found = constants(root)
    for value, nodes in found:
        for node in nodes:
            node.value = value
    root.values = frozenset([value for value, _ in found])
    return root


def hashed(above: int, tag: str, value: int = 0) -> int:
    data = b"%d %d %s" % (above, value, tag.encode("utf-8", "replace"))
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "big", signed=True)


def placed(root: Node, seed: Node, plan: Wrapper) -> list[tuple[int, Node]]:
    """Each node with text, with its place in the wrapper that grows from the seed and its
    value, as a hash. The place is that of the node of the seed it is matched with, if their
    values are equal; other texts are put in below the place of the element they lie in."""
    partner = {id(x): y for x, y in matched(root, seed, plan)[1]}
    number = {id(y): i for i, y in enumerate(seed.order)}
    out, stack = [], [(root, 0)]
    while stack:
        node, above = stack.pop()
        other = partner.get(id(node))
        if node.value is not None:
            alike = other is not None and other.value == node.value
            out.append((number[id(other)] if alike else hashed(above, node.tag, node.value), node))
        if node.inner:
            place = hashed(above, node.tag) if other is None else number[id(other)]
            stack += [(x, place) for x in node.inner]
    return out


def is_boilerplate(node: Node, inside_main: bool, bulk: frozenset | set = frozenset()) -> bool:
    """bulk: ids of elements that hold most of what varies: only a whole name, or a piece
    that stands for readers' comments, makes them boilerplate."""
    if node.tag in DROPPED or "#hidden" in node.names:
        return True
    if node.tag == "header":
        return not inside_main
    if node.tag in ("html", "body", *MAIN_TAGS):
        return False
    if node.names & NAMES or node.pieces & COMMENTS:
        return True
    return bool(node.pieces & NAMES) and id(node) not in bulk


def bulk_of(root: Node, template: set[int], plan: Wrapper) -> set[int]:
    """Elements named in part like boilerplate that hold most of the page's varying text."""
    sizes: dict[int, int] = {}
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag not in DROPPED:
            order.append(node)
            stack += node.children()
    for node in reversed(order):  # children before their parents
        own = 0 if id(node) in template else len(node.own_text())
        sizes[id(node)] = own + sum(sizes.get(id(x), 0) for x in node.children())
    least = plan.most * sizes[id(root)]
    return {id(x) for x in order if x.pieces & NAMES and sizes[id(x)] and sizes[id(x)] >= least}


def pieces(region: Node, inside_main: bool, bulk: frozenset | set = frozenset()):
    """Texts of a region in page order with the nodes they lie in; None for a text where a
    block ends, with the innermost block node."""
    # iterative: pages nest without limit
    stack: list = [(region, iter(region.parts), region, inside_main)]
    while stack:
        node, parts, owner, main = stack[-1]
        part = next(parts, None)
        if part is None:
            stack.pop()
            if node.tag in BLOCKS:
                yield owner, None
        elif isinstance(part, str):
            yield node, part
        elif part.tag == "br":
            yield part, " "
        elif not is_boilerplate(part, main, bulk):
            block = part.tag in BLOCKS
            if block:
                yield owner, None
            now_main = main or part.tag in MAIN_TAGS
            stack.append((part, iter(part.parts), part if block else owner, now_main))
    yield region, None


def blocks(
    region: Node, template: set[int], inside_main: bool, bulk: frozenset | set = frozenset()
) -> list[tuple[str, Node]]:
    """Texts of the blocks of a region in page order, each with its innermost block node."""
    out: list[tuple[str, Node]] = []
    buffer: list[str] = []
    for node, text in pieces(region, inside_main, bulk):
        if text is None:
            if joined := " ".join("".join(buffer).split()):
                out.append((joined, node))
            buffer.clear()
        elif id(node) not in template:
            buffer.append(text)
    return out


def main_region(root: Node) -> Node | None:
    """The element marked as the article, with most text among its like."""
    best, most = None, 0
    for rank, marked in (
        (2, lambda n: n.tag == "article"),
        (1, lambda n: n.tag == "main" or "articlebody" in n.names),
    ):
        for node in outside_boilerplate(root):
            if marked(node):
                size = sum(len(t) for t, _ in blocks(node, set(), True))
                if size > most:
                    best, most = node, size
        if best is not None:
            return best
    return None


def outside_boilerplate(root: Node):
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        main = node.tag in MAIN_TAGS
        stack += [x for x in reversed(node.children()) if not is_boilerplate(x, main)]


def largest_slot(root: Node, template: set[int], bulk: set[int]) -> Node:
    """The innermost element that holds most of the varying text outside boilerplate."""
    node = root
    whole = sum(len(t) for t, _ in blocks(root, template, False, bulk))
    while True:
        for child in node.children():
            if child.tag in BLOCKS and child.tag != "p" and not is_boilerplate(child, False, bulk):
                if 10 * sum(len(t) for t, _ in blocks(child, template, False, bulk)) >= 8 * whole > 0:
                    node = child
                    break
        else:
            return node


def link_share(node: Node) -> float:
    linked = sum(len(x.own_text()) for n in walk(node) if n.tag == "a" for x in walk(n))
    whole = sum(len(x.own_text()) for x in walk(node))
    return linked / whole if whole else 0.0


def main_text(html: str, template: set[int] | None, plan: Wrapper, constants=()) -> str:
    """template: texts of the wrapper; constants: of the nodes with text, in page order."""
    root = parse(html)
    fixed: set[int] = set()
    if template:
        own = [x for x in walk(root) if x.own_text()]
        fixed = {id(x) for x, constant in zip(own, constants, strict=True) if constant in template}
    region = main_region(root)
    if region is not None:
        return "\n".join(t for t, _ in blocks(region, fixed, True))
    bulk = bulk_of(root, fixed, plan)
    region = largest_slot(root, fixed, bulk)
    kept = blocks(region, fixed, False, bulk)
    return "\n".join(t for t, n in kept if n is region or link_share(n) < 0.6)


def article_hash(root: Node, region: Node | None) -> int:
    """64 bits of the text of the marked article, or of the whole page if none is marked."""
    every = {id(x) for x in walk(root)}  # here no piece of a name decides
    found = blocks(region or root, set(), region is not None, every)
    text = "\n".join(t for t, _ in found).encode("utf-8", "replace")
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big", signed=True)


READ = (
    "page_id long, url string, host string, part int, article long, constants array<long>, "
    "body string, cuts array<int>, at array<int>"
)


def read_rows(batches, plan: Wrapper):
    """What is needed of each page: the hash of its article, its texts in their places of the
    wrapper, and the pieces of a marked article one after another, with their lengths and
    the numbers of their texts (-1: none, -2: a block ends); of other pages the html."""
    seeds = None, None
    for batch in slices(batches, "html"):
        articles, constants, bodies, cuts, ats = [], [], [], [], []
        for html, seed in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
            root = parse(html)
            number, own = {}, []
            if seed is not None:
                if seed != seeds[0]:  # rows come in the order of their hosts
                    seeds = seed, shaped(parse(seed))
                places = {id(x): place for place, x in placed(shaped(root), seeds[1], plan)}
                for x in root.order:
                    if x.value is not None:
                        number[id(x)] = len(own)
                        own.append(places[id(x)])
            region = main_region(root)
            articles.append(article_hash(root, region) if html and seed is not None else None)
            constants.append(own)
            if region is None:
                bodies.append(html)
                cuts.append(None)
                ats.append(None)
                continue
            found = list(pieces(region, True))
            bodies.append("".join([text for _, text in found if text]))
            cuts.append([len(text or "") for _, text in found])
            ats.append([-2 if text is None else number.get(id(x), -1) for x, text in found])
        ints = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(i) for i in range(4)),
                pa.array(articles, pa.int64()),
                pa.array(constants, pa.list_(pa.int64())),
                pa.array(bodies, pa.string()),
                pa.array(cuts, ints),
                pa.array(ats, ints),
            ],
            names=["page_id", "url", "host", "part", "article", "constants", "body", "cuts", "at"],
        )


def joined(body: str, cuts: list[int], at: list[int], constants: list[int], template: set[int]) -> str:
    """The blocks of a marked article without the template, as main_text() gives them."""
    out, buffer, begin = [], [], 0
    for length, number in zip(cuts, at, strict=True):
        if number == -2:
            if text := " ".join("".join(buffer).split()):
                out.append(text)
            buffer.clear()
        elif number == -1 or constants[number] not in template:
            buffer.append(body[begin : begin + length])
        begin += length
    return "\n".join(out)


def extract_rows(batches, plan: Wrapper):
    for batch in slices(batches, "body"):
        texts = []
        for constants, body, cuts, at, wrapper in zip(*(x.to_pylist() for x in batch.columns[2:]), strict=True):
            template = set(wrapper or ())
            if cuts is None:
                texts.append(main_text(body, template, plan, constants))
            else:
                texts.append(joined(body, cuts, at, constants, template))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"],
        )


def host_of(url):
    return F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract(pages: DataFrame, plan: Wrapper = Wrapper()) -> DataFrame:
    """One row per page row: page_id, url, text (empty if there is none) and n_chars.

    Null html is empty. A page whose url is null or has no host, or whose host has no
    second, unlike article, is read without a template. Repeated rows have equal results. All
    articles of a host count, copies once, so a text that only copies of one article share is
    no template; only hashes of texts are brought together, counted in the map tasks first.
    The pages of a host are dealt to several groups, each with the host's seed and template.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("host", F.coalesce(host_of(F.col("url")), F.lit("")))
    part = F.pmod(F.monotonically_increasing_id(), F.lit(plan.parts)).cast("int")
    rows = rows.withColumn("part", part)
    own = rows.filter("host <> '' and html <> ''")

    def to_parts(hosts: DataFrame) -> DataFrame:
        return hosts.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(plan.parts - 1))))

    seed = F.min(F.struct(F.xxhash64("html").alias("order"), "html")).alias("seed")
    seeds = written(own.groupBy("host").agg(seed).select("host", F.col("seed.html").alias("seed")), "seeds")
    read = written(
        rows.join(to_parts(seeds), ["host", "part"], "left")
        .sortWithinPartitions("host")
        .select("page_id", "url", "host", "part", "html", "seed")
        .mapInArrow(lambda batches: read_rows(batches, plan), READ),
        "read",
    )
    # copies of an article have equal rows here, so that they count once; null: the article itself
    own = F.concat(F.array(F.lit(None).cast("long")), "constants")
    listed = (
        read.filter("article is not null").select("host", "article", F.explode(own).alias("constant")).distinct()
    )
    counts = written(listed.groupBy("host", "constant").agg(F.count(F.lit(1)).alias("n")), "constants")
    total = counts.filter("constant is null and n > 1").select("host", F.col("n").alias("unlike"))
    wrappers = (
        counts.filter("constant is not null and n > 1")
        .join(total, "host")
        .filter(F.col("n") >= plan.share * F.col("unlike"))
        .groupBy("host")
        .agg(F.collect_list("constant").alias("wrapper"))
    )
    wrappers = written(wrappers, "wrappers")
    found = (
        read.join(to_parts(wrappers), ["host", "part"], "left")
        .select("page_id", "url", "constants", "body", "cuts", "at", "wrapper")
        .mapInArrow(lambda batches: extract_rows(batches, plan), "page_id long, url string, text string")
    )
    return found.withColumn("n_chars", F.length("text").cast("long"))
