"""Main text of web pages by wrapper induction.

Pages are parsed into trees of block elements. Induction comes first: the different tree shapes of a
host are aligned, one after the other, with a growing wrapper tree by simple tree matching: the
heaviest order-preserving matching of children, found by dynamic programming. Every page is then
matched to the finished wrapper of its host, and the texts in each place of it are counted over all
pages of the host. A text that is the same on most pages is template; where texts vary is a slot.
Extraction comes second and judges all pages of a host by the same wrapper and counts. Slots become
content unless they stand in a part of the page that by its element or role, or by a class or id of a
container that says nothing else, is navigation, header, footer, sidebar, advert, notice, form or comments. If the page has article or main elements
with text, content is what stands in them, and else every slot; the node that holds most of the
varying text tells whether the page is one of many near copies, whose text is kept too.
"""

from __future__ import annotations

import hashlib
import html as references
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.llm.common import arrow_type, materialise, prepare, table

#: hosts with more than this share of the pages, and this many, are spread over several tasks
HOST_SHARE, HOST_PAGES = 2000, 512
#: shapes of a host are aligned in so many parts, whose wrappers are then aligned with one another
SHAPE_PARTS = 16
#: a text is template if so many different pages have it in one place, and so large a part of them
TEMPLATE_PAGES, TEMPLATE_SHARE = 4, 0.6

# Element classes of HTML
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe svg object select option button head canvas".split())
_BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_CLOSES_P = _BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "html", "body"}
_SAME_CLOSES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
_APART = frozenset("nav footer form dialog menu".split())
_APART_OUTSIDE = frozenset(("header", "aside"))  # unless they belong to an article
_CORE = frozenset(("article", "main"))
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_HINTS = frozenset(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar aside"
    " footer header masthead topbar comment comments disqus respond reply replies share sharing social related recommended cookie cookies consent gdpr"
    " notice notices alert popup modal overlay newsletter subscribe subscription signup login search widget pagination pager toolbar skip".split())

#: words that say where a part stands or how it looks, beside one that says what it is
_NEUTRAL = frozenset(
    "area bar block bottom box col column container content fixed first global group inner item items last left link links list main"
    " mobile outer page panel primary rail right row secondary section site slot small sticky top unit wide wrap wrapper zone".split())
#: elements that hold parts of a page; the others are content by where they stand
_CONTAINERS = frozenset("aside center details dir div dl fieldset header hgroup menu nav ol section table ul".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")


class Node:
    """A block element, or (tag '#') a run of text between blocks; of a page or of a wrapper."""

    __slots__ = ("tag", "apart", "children", "text", "match", "number")

    def __init__(self, tag: str, apart: bool = False, text: str = ""):
        self.tag, self.apart, self.text = tag, apart, text
        self.children: list[Node] = []
        self.match: Node | None = None  # of a page: its place in the wrapper
        self.number = -1  # of a run in a finished wrapper


def _apart(tag: str, attributes: str, in_core: bool) -> bool:
    """Whether an element is set apart from the content by what it says of itself. A class or id does so
    only for a container, and only if it has no word for anything else: what a page calls `news-ad-report`
    or `related work` is for the wrapper to decide."""
    if tag in _APART or (tag in _APART_OUTSIDE and not in_core):
        return True
    for name, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "role" and value in _ROLES):
            return True
        if name in ("class", "id") and tag in _CONTAINERS:
            words = set(_WORD.findall(value))
            if words & _HINTS and words <= _HINTS | _NEUTRAL:
                return True
    return False


def parse(page: str) -> Node:
    """Block tree of a page. Unclosed, misnested and cut-off markup is taken as it comes; raw text
    elements (scripts, styles, the head, form fields) are left out with all they hold."""
    root = Node("html")
    stack, words, at = [root], [], 0
    inline: list[tuple[str, bool]] = []  # open inline elements, and whether they are set apart
    hidden, core = 0, 0

    def flush() -> None:
        if words:
            text = " ".join(references.unescape("".join(words)).split())
            words.clear()
            if text:
                node = Node("#", text=text)
                stack[-1].children.append(node)

    def close(to: int) -> None:
        nonlocal core
        flush()
        while len(stack) > to:
            core -= stack.pop().tag in _CORE

    end, size = 0, len(page)
    while end < size:
        found = _TAG.search(page, end)
        if found is None:
            if not hidden:
                words.append(page[end:])
            break
        if found.start() > end and not hidden:
            words.append(page[end : found.start()])
        end = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _RAW:
            if not found[1] and not found[3].endswith("/"):
                if tag == "head":
                    stop = re.compile(r"</head\s*>|<body[\s>]", re.IGNORECASE).search(page, _head_end(page, end))
                    end = size if stop is None else stop.start() if stop[0][1] != "/" else stop.end()
                else:
                    stop = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, end)
                    end = size if stop is None else stop.end()
            if tag == "button" or tag == "select":
                words.append(" ")
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif tag == "br" and not hidden:
                words.append(" ")
            continue
        if tag in ("html", "body"):
            flush()
            continue
        if tag not in _BLOCK:
            if found[1]:
                for i in range(len(inline) - 1, -1, -1):
                    if inline[i][0] == tag:
                        hidden -= inline.pop(i)[1]
                        break
            elif not found[3].endswith("/"):
                apart = _apart(tag, found[3], True) if found[3] else False
                inline.append((tag, apart))
                hidden += apart
            continue
        # a block ends what is open inside the line
        hidden -= sum(apart for _, apart in inline)
        inline.clear()
        if found[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in _CORE or stack[i].tag == "table" and tag != "table" and tag not in ("div", "section", *_CORE):
                    break
            else:
                flush()
            continue
        flush()
        if tag in _CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in _BLOCK:
                    break
        if tag in _SAME_CLOSES:
            same = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in same or (tag == "tr" and stack[i].tag in ("td", "th")):
                    close(i)
                    if tag != "tr":
                        break
                if i < len(stack) and stack[i].tag in _SAME_CLOSES[tag]:
                    break
        node = Node(tag, _apart(tag, found[3], core > 0))
        stack[-1].children.append(node)
        if not found[3].endswith("/"):
            stack.append(node)
            core += tag in _CORE
    flush()
    return root


def _head_end(page: str, at: int) -> int:
    """Where to look for the end of the head: behind its scripts, styles and title."""
    while True:
        found = re.compile(r"<(script|style|title|noscript)\b[^>]*>|</head\s*>|<body[\s>]", re.IGNORECASE).search(page, at)
        if found is None or found[1] is None:
            return at if found is None else found.start()
        stop = re.compile(rf"</{found[1]}\s*>", re.IGNORECASE).search(page, found.end())
        if stop is None:
            return found.end()
        at = stop.end()


def flatten(root: Node) -> tuple[str, list[str]]:
    """The shape of a tree and its text runs, both in page order. In a shape each block is opened by
    its tag, with ! if it is set apart, and closed by /; # is a run."""
    shape: list[str] = []
    texts: list[str] = []
    stack: list[Node | None] = [root]
    while stack:
        node = stack.pop()
        if node is None:
            shape.append("/")
        elif node.tag == "#":
            shape.append("#")
            texts.append(node.text)
        else:
            shape.append(node.tag + "!" if node.apart else node.tag)
            stack.append(None)
            stack.extend(reversed(node.children))
    return " ".join(shape), texts


def tree_of(shape: str) -> tuple[Node, list[Node]]:
    """The tree of a shape, and its runs, numbered in page order."""
    top = Node("")
    stack, runs = [top], []
    for token in shape.split(" "):
        if token == "/":
            stack.pop()
            continue
        node = Node(token.rstrip("!"), token.endswith("!"))
        stack[-1].children.append(node)
        if token == "#":
            node.number = len(runs)
            runs.append(node)
        else:
            stack.append(node)
    return top.children[0], runs


def _weigh(slot: Node, node: Node, known: dict[tuple[int, int], int]) -> int:
    """Nodes of the heaviest order-preserving matching of two trees with equal root tags. known holds
    the weights of pairs below."""
    if not slot.children or not node.children:
        return 1
    stack = [(slot, node)]
    while stack:
        s, n = stack[-1]
        if (id(s), id(n)) in known:
            stack.pop()
            continue
        below = [(a, b) for a in s.children if a.children for b in n.children if b.tag == a.tag and b.children and (id(a), id(b)) not in known]
        if below:
            stack += below
            continue
        stack.pop()
        known[id(s), id(n)] = 1 + _table(s.children, n.children, known)[-1][-1]
    return known[id(slot), id(node)]


def _table(slots: list[Node], nodes: list[Node], known: dict[tuple[int, int], int]) -> list[list[int]]:
    rows = [[0] * (len(nodes) + 1)]
    for slot in slots:
        above, row, best = rows[-1], [0], 0
        tag = slot.tag
        for j, node in enumerate(nodes, 1):
            best = above[j] if above[j] > best else best
            if node.tag == tag:
                through = above[j - 1] + (known[id(slot), id(node)] if node.children and slot.children else 1)
                if through > best:
                    best = through
            row.append(best)
        rows.append(row)
    return rows


def _fits(small: Node, big: Node, known: dict[tuple[int, int], bool]) -> bool:
    """Whether all of a tree can be matched to another with an equal root tag."""
    stack = [[small, big, 0, 0]]
    while stack:
        s, b, i, j = frame = stack[-1]
        if i == len(s.children) or len(b.children) - j < len(s.children) - i:
            known[id(s), id(b)] = i == len(s.children)
            stack.pop()
            continue
        c, d = s.children[i], b.children[j]
        if c.tag != d.tag or c.children and not d.children:
            frame[3] += 1
        elif not c.children:
            frame[2:] = i + 1, j + 1
        elif (id(c), id(d)) not in known:
            stack.append([c, d, 0, 0])
        else:
            frame[2:] = i + known[id(c), id(d)], j + 1
    return known[id(small), id(big)]


def _embedding(small: list[Node], big: list[Node], known: dict[tuple[int, int], bool]) -> list[int] | None:
    """For each child of one list the first child of the other that takes all of it, in order, if there
    are such: then that matching is the heaviest, and the one that the table would give."""
    at, out = 0, []
    for node in small:
        while at < len(big) and (big[at].tag != node.tag or node.children and not _fits(node, big[at], known)):
            at += 1
        if at == len(big):
            return None
        out.append(at)
        at += 1
    return out


def _pairs(slots: list[Node], nodes: list[Node], known: dict[tuple[int, int], int], fits: dict[tuple[int, int], bool]) -> list[tuple[int, int]]:
    """The heaviest order-preserving matching of two lists of children."""
    found = _embedding(nodes, slots, fits)
    if found is not None:
        return [(i, j) for j, i in enumerate(found)]
    found = _embedding(slots, nodes, fits)
    if found is not None:
        return [*enumerate(found)]
    for slot in slots:
        if slot.children:
            for node in nodes:
                if node.tag == slot.tag and node.children:
                    _weigh(slot, node, known)
    rows = _table(slots, nodes, known)
    i, j = len(slots), len(nodes)
    pairs = []
    while i and j:
        if rows[i][j] == rows[i][j - 1]:
            j -= 1
        elif rows[i][j] == rows[i - 1][j]:
            i -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    pairs.reverse()
    return pairs


def align(wrapper: Node, page: Node, grow: bool = True) -> None:
    """Match a page's tree, or another wrapper, to the wrapper, and add what the wrapper lacks. A
    wrapper that is not to grow matches all of a page that has been aligned with it before."""
    known: dict[tuple[int, int], int] = {}
    fits: dict[tuple[int, int], bool] = {}
    stack = [(wrapper, page)]
    while stack:
        slot, node = stack.pop()
        node.match = slot
        if not node.children:
            continue
        slots, nodes = slot.children, node.children
        if len(slots) == len(nodes) and [s.tag for s in slots] == [n.tag for n in nodes]:
            stack += zip(slots, nodes, strict=True)
            continue
        matched = {j: slots[i] for i, j in _pairs(slots, nodes, known, fits)} if slots else {}
        if grow:
            added, at = [], 0
            for j, child in enumerate(nodes):
                if j in matched:
                    while slots[at] is not matched[j]:
                        added.append(slots[at])
                        at += 1
                    at += 1
                else:
                    matched[j] = Node(child.tag)
                added.append(matched[j])
            slot.children = added + slots[at:]
        stack += [(s, nodes[j]) for j, s in matched.items()]


def places(wrapper: Node, shape: str) -> list[int]:
    """For each run of a shape the number of its run in a finished wrapper, or -1."""
    page, runs = tree_of(shape)
    align(wrapper, page, grow=False)
    return [-1 if r.match is None else r.match.number for r in runs]


def _outside(root: Node) -> list[tuple[Node, bool]]:
    """Text runs outside the parts set apart, and whether they stand in an article or main element."""
    out: list[tuple[Node, bool]] = []
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        if node.tag == "#":
            out.append((node, inside))
        else:
            stack += [(c, inside or c.tag in _CORE) for c in reversed(node.children) if not c.apart]
    return out


def _main_node(root: Node, varying: set[Node]) -> Node:
    """Down from the root while one child holds most of the varying text."""
    order, sizes = [root], {}
    for node in order:  # grows: parents before children
        order += () if node.apart else node.children
    for node in reversed(order):
        sizes[node] = (len(node.text) if node in varying else 0) + (0 if node.apart else sum(sizes[c] for c in node.children))
    node = root
    while True:
        best = max(((sizes[c], -i) for i, c in enumerate(node.children) if c.tag not in ("#", "p", "li", "ul", "ol", "table", "blockquote")), default=(0, 0))
        if not sizes[node] or best[0] < 0.6 * sizes[node]:
            return node
        node = node.children[-best[1]]


def content(shape: str, texts: list[str], template: list[bool]) -> list[str]:
    """Blocks of a page, given which of its runs are template."""
    root, runs = tree_of(shape)
    for run, text in zip(runs, texts, strict=True):
        run.text = text
    outside = _outside(root)
    inside = [n for n, core in outside if core]
    elsewhere: list[Node] = []
    if not inside:
        inside = [n for n, _ in _outside(_main_node(root, {n for n, _ in outside if not template[n.number]}))]
        elsewhere = [n for n, _ in outside]
    varying = [n for n in inside if not template[n.number]]
    # mostly "template": rather one of many near copies of a text than a page of little content
    kept = varying if 2 * sum(len(n.text) for n in varying) >= sum(len(n.text) for n in inside) else inside
    chosen = {n.number for n in kept} | {n.number for n in elsewhere if not template[n.number]}
    return [n.text for n in runs if n.number in chosen]


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _evidence(page: str) -> tuple[int, str, list[int]]:
    """Of a page: what tells it from copies of its text, its shape, and hashes of its texts."""
    root = parse(page)
    shape, texts = flatten(root)
    return _hash("\n".join(n.text for n, core in _outside(root) if core) or page), shape, [_hash(t) for t in texts]


def _packed(page: str) -> tuple[str, bytes]:
    """Of a page: its shape and packed texts; runs have no line breaks."""
    shape, texts = flatten(parse(page))
    return shape, zlib.compress("\n".join(texts).encode(), 1)


def _folded(batches: Iterator[pa.RecordBatch], parts: bool) -> Iterator[pa.RecordBatch]:
    """One wrapper for the shapes of each host, or of each part of it, of sorted rows (host, part, shape)."""
    names = ["host", "part", "shape"]
    key, wrapper = None, None
    for batch in batches:
        for host, part, shape in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            now = (host, part if parts else 0)
            if now != key:
                if wrapper is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([flatten(wrapper)[0]])], names=names)
                key, wrapper = now, Node("html")
            align(wrapper, tree_of(shape)[0])
    if wrapper is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([flatten(wrapper)[0]])], names=names)


def _wrappers(shapes: DataFrame) -> DataFrame:
    """(host, shape): the finished wrapper of each host, from its different shapes alone, whatever
    their batches and partitions."""
    plain = shapes.select("host", F.regexp_replace("shape", "!", "").alias("shape")).distinct()
    dealt = plain.select("host", F.pmod(F.xxhash64("shape"), F.lit(SHAPE_PARTS)).alias("part"), "shape")
    kind = "host string, part long, shape string"
    some = dealt.repartition("host", "part").sortWithinPartitions("host", "part", "shape").mapInArrow(lambda rows: _folded(rows, True), kind)
    return some.repartition("host").sortWithinPartitions("host", "part").mapInArrow(lambda rows: _folded(rows, False), kind).select("host", "shape")


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, place, hash, n): pages with a text in a place of the wrapper, summed per batch. Rows (host,
    part, kind, shape, hashes) are sorted; the wrapper comes before its pages."""
    wrapper, last, at = Node("html"), None, []
    for batch in batches:
        found: Counter = Counter()
        for host, _, kind, shape, hashes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not kind:
                wrapper, last = tree_of(shape)[0], None
                continue
            if shape != last:
                last, at = shape, places(wrapper, shape)
            found.update((host, place, h) for place, h in zip(at, hashes, strict=True))
        hosts, at_, of = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(at_, pa.int32()), pa.array(of, pa.int64()), pa.array(list(found.values()), pa.int64())],
            names=["host", "place", "hash", "n"])


def _templates(seen: DataFrame) -> DataFrame:
    """(host, template): of each host's wrapper the places whose text is template, with its hash."""
    texts = seen.where("place >= 0").groupBy("host", "place", "hash").agg(F.sum("n").alias("n"))
    # a share above one half: only the most frequent text can be template
    top = texts.groupBy("host", "place").agg(F.sum("n").alias("pages"), F.max(F.struct("n", "hash")).alias("top"))
    return top.where((F.col("top.n") >= TEMPLATE_PAGES) & (F.col("top.n") >= TEMPLATE_SHARE * F.col("pages"))).groupBy("host").agg(
        F.collect_list(F.struct("place", "top.hash")).alias("template"))


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages (page_id, url, html).

    Blocks of content, white space collapsed and character references decoded, joined by two newlines
    in page order. Null and empty pages, and pages without content, give an empty text. Pages without
    a url, or whose url has no host, are one host. Hosts with too few pages to tell template from slots
    rely on what elements say of themselves; repeated pages count once as evidence. Large hosts are
    spread over tasks by page, but all pages of a host are judged by one wrapper and by counts over all
    of them. Other columns are not read; an empty table gives no rows.
    """
    prepare(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    pages = pages.select("page_id", "url", host.alias("host"), "html")

    def read(df: DataFrame, what: Callable[[str], tuple], fields: list[StructField]) -> DataFrame:
        """df with its last column, the page, replaced by what is read from it."""
        schema = StructType([*df.schema.fields[:-1], *fields])

        def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [what(page) if page else (None,) * len(fields) for page in batch.columns[-1].to_pylist()]
                columns = list(zip(*found, strict=True)) or [()] * len(fields)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], *(pa.array(c, arrow_type(f.dataType)) for c, f in zip(columns, fields, strict=True))], names=schema.names)

        return df.mapInArrow(parsed, schema)

    # texts are read again in the end rather than stored until then
    shape = StructField("shape", StringType())
    rows = materialise(read(pages.select("host", "html"), _evidence, [StructField("key", LongType()), shape, StructField("hashes", ArrayType(LongType()))]))
    texts = read(pages, _packed, [shape, StructField("body", BinaryType())]).withColumn("row", F.monotonically_increasing_id())
    limit = max(HOST_PAGES, rows.count() // HOST_SHARE)
    # at most HOST_SHARE hosts are so large
    large = materialise(rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("host", F.ceil(F.col("n") / limit).alias("parts")))

    def dealt(df: DataFrame, by: str) -> DataFrame:
        return df.join(F.broadcast(large), "host", "left").withColumn("part", F.pmod(F.col(by), F.coalesce("parts", F.lit(1).cast("long")))).withColumn("kind", F.lit(1))

    def first(df: DataFrame) -> DataFrame:
        """Wrappers, one for each part of a host, to come before its pages."""
        parts = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1).cast("long")) - 1))
        return df.join(F.broadcast(large), "host", "left").withColumn("part", parts).withColumn("kind", F.lit(0))

    def together(wrappers: DataFrame, of_pages: DataFrame) -> DataFrame:
        return wrappers.unionByName(of_pages).repartition("host", "part").sortWithinPartitions("host", "part", "kind", "shape")

    parsed = rows.where(F.col("shape").isNotNull())
    wrappers = materialise(_wrappers(parsed))
    # a copy of a text is no evidence that it is template
    once = parsed.groupBy("host", "key").agg(F.min(F.struct(F.regexp_replace("shape", "!", "").alias("shape"), "hashes")).alias("page")).select("host", "key", "page.*")
    evidence = ("host", "part", "kind", "shape", "hashes")
    seen = together(first(wrappers).withColumn("hashes", F.lit(None).cast("array<bigint>")).select(*evidence), dealt(once, "key").select(*evidence))
    templates = _templates(seen.mapInArrow(_located, "host string, place int, hash long, n long"))

    schema = StructType([pages.schema["page_id"], pages.schema["url"], StructField("text", StringType()), StructField("n_chars", LongType())])
    template_type = ArrayType(StructType([StructField("place", IntegerType()), StructField("hash", LongType())]))
    finished = first(wrappers.join(templates, "host", "left")).select(
        "host", "part", "kind", "shape", F.col("template").cast(template_type).alias("template"), F.lit(None).cast(pages.schema["page_id"].dataType).alias("page_id"),
        F.lit(None).cast(pages.schema["url"].dataType).alias("url"), F.lit(None).cast("binary").alias("body"))
    judged = dealt(texts, "row").select("host", "part", "kind", "shape", F.lit(None).cast(template_type).alias("template"), "page_id", "url", "body")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrapper, template, last, at = Node("html"), {}, None, []
        for batch in batches:
            texts: list[str] = []
            kinds = batch.column(2).to_pylist()
            for kind, shape, known, body in zip(kinds, *(batch.column(i).to_pylist() for i in (3, 4, 7)), strict=True):
                if not kind:
                    wrapper, last = tree_of(shape)[0], None
                    template = {t["place"]: t["hash"] for t in known or ()}
                elif shape is None:
                    texts.append("")
                else:
                    runs = zlib.decompress(body).decode().split("\n") if "#" in shape else []
                    if template and shape != last:
                        last, at = shape, places(wrapper, shape)
                    same = [p in template and template[p] == _hash(t) for p, t in zip(at, runs, strict=True)] if template else [False] * len(runs)
                    texts.append("\n\n".join(content(shape, runs, same)))
            use = pa.array([i for i, kind in enumerate(kinds) if kind], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(5).take(use), batch.column(6).take(use), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=schema.names)

    return together(finished, judged).mapInArrow(extract, schema)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
