"""Main text of web pages: wrappers induced from all pages of a host, aligned by simple tree matching."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import keep_batches_small, small_batches, strings
from wattline.sources.scratch import written

REFERENCES = 12  # pages of a host that its reference is chosen from at most; every page of the host is aligned with it
ALIGNED = 5  # of these, different ones that are held against each other
SALTS = 16
_DEPTH = 200  # elements nested deeper are kept side by side
_PLACE = {"place": pa.int64(), "mark": pa.int64(), "blocks": pa.int64(), "path": pa.string()}

# Element names of HTML by their kind.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_SCOPE = frozenset("article aside body div footer header html main nav section table td th form blockquote ul ol dl fieldset figure".split())
_NEVER = frozenset(
    "script style noscript template iframe object embed svg canvas map head title form button select textarea input option datalist dialog nav menu "
    "aside footer audio video".split()
)
_CLOSED_BY = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",)),
}

# Words in class, id or role that name a part of a page which is not its article.
_PART = re.compile(
    r"^(ad|ads|adbox|adslot|adsense|adunit|advert.*|sponsor.*|promo.*|banner.*|sidebar.*|sidenav|menu.*|nav|navbar.*|navigation|breadcrumb.*|header"
    r"|masthead|footer.*|cookie.*|consent.*|gdpr|notice.*|notification.*|alert|popup.*|modal.*|overlay|newsletter.*|subscribe.*|subscription|signup"
    r"|login|comment.*|disqus.*|reply|replies|respond|related.*|recommend.*|share.*|sharing|social.*|toolbar|pagination|pager|copyright"
    r"|skip|complementary|contentinfo|search)$"
)

_LISTS = re.compile(r"comment|disqus|repl|respond|related|recommend")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)([^>]*+)>",
    re.S,
)
_NAMES = re.compile(r"(?:^|[\s\"'/])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


class Node:
    __slots__ = ("tag", "names", "children")

    def __init__(self, tag: str, names: str = ""):
        self.tag, self.names, self.children = tag, names, []

    @property
    def label(self) -> str:
        return f"{self.tag}.{self.names}" if self.names else self.tag


def parse(html: str) -> Node:
    """A tree of elements and raw text, forgiving about unclosed and stray tags."""
    root = Node("#root")
    stack, at = [root], 0
    while True:
        m = _TOKEN.search(html, at)
        text = html[at : m.start()] if m else html[at:]
        if text:
            stack[-1].children.append(text)
        if not m:
            return root
        at = m.end()
        close, tag, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:
            continue
        tag = tag.lower()
        if close:
            _close(stack, tag)
            continue
        _make_room(stack, tag)
        names = " ".join(sorted({w for _, a, b, c in _NAMES.findall(rest) for w in (a or b or c).lower().split()})) if "=" in rest else ""
        node = Node(tag, names)
        stack[-1].children.append(node)
        if tag in _RAW:
            end = re.compile(rf"</{tag}\s*>|\Z", re.I).search(html, at)
            node.children.append(html[at : end.start()])
            at = end.end()
        elif tag not in _VOID and not rest.endswith("/") and len(stack) < _DEPTH:
            stack.append(node)


def _close(stack: list[Node], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if tag not in _BLOCK and stack[i].tag in _BLOCK:
            return  # an inline end never closes a block


def _make_room(stack: list[Node], tag: str) -> None:
    """End what the new element ends without a tag: a paragraph, a list item, a cell."""
    ends, inside = ("p", _SCOPE) if tag in _BLOCK else (None, None)
    if tag in _CLOSED_BY:
        _end(stack, *_CLOSED_BY[tag])
    elif ends:
        _end(stack, ends, inside)


def _end(stack: list[Node], ends: str, inside) -> None:
    ends = ends.split()
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in inside:
            return
        if stack[i].tag in ends:
            del stack[i:]
            return


def _walk(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        n = stack.pop()
        yield n
        stack += [c for c in reversed(n.children) if isinstance(c, Node)]


def _holds_article(node: Node, lists: bool) -> bool:
    """Whether the article is inside; each entry of a list of comments or of related texts may be an article element too."""
    tags = ("main", "h1") if lists else ("article", "main", "h1")
    return any(n.tag in tags or "articlebody" in n.names.split() for n in _walk(node))


def is_part(node: Node, in_article: bool) -> bool:
    """Whether the element is by its kind or its names a part that is not the article."""
    if node.tag in _NEVER or (node.tag == "header" and not in_article):
        return True
    if not node.names or node.tag in ("html", "body", "article", "main"):
        return False
    words = [w for w in re.split(r"[^a-z0-9]+", node.names) if _PART.match(w) and not (w == "header" and in_article)]
    return bool(words) and not _holds_article(node, any(_LISTS.match(w) for w in words))


def _squeezed(pieces: list[str]) -> str:
    return " ".join(unescape("".join(pieces)).split())


def _text(node: Node) -> str:
    pieces, stack = [], [node]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            pieces.append(n)
        elif n.tag not in _NEVER or n is node:
            if n.tag in _BLOCK or n.tag == "br":
                pieces.append(" ")
            stack += reversed(n.children)
    return _squeezed(pieces)


def _raw(root: Node) -> dict[int, str]:
    """The text of every element below, before references and white space are resolved, put together from the inside out."""
    raw: dict[int, str] = {}
    for node in reversed(list(_walk(root))):
        pieces = [" "] if node.tag in _BLOCK or node.tag == "br" else []
        pieces += [c if isinstance(c, str) else raw[id(c)] for c in node.children if isinstance(c, str) or c.tag not in _NEVER]
        raw[id(node)] = "".join(pieces)
    return raw


# ---- wrappers -------------------------------------------------------------


class Shape:
    """A node as it is aligned: label, text, and children, where children of one label in a row count as one."""

    __slots__ = ("label", "text", "children", "blocks")

    def __init__(self, node: Node, raw: dict[int, str] | None = None):
        raw = _raw(node) if raw is None else raw

        def text(n: Node) -> str:
            return _squeezed([raw[id(n)]])

        self.label, self.text, self.children = node.label, text(node), []
        kids = [c for c in node.children if isinstance(c, Node) and c.tag not in _VOID and c.tag not in ("script", "style", "head")]
        self.blocks = sum(len(text(c)) for c in kids if c.tag == "p")
        at = 0
        while at < len(kids):
            end = at + 1
            while end < len(kids) and kids[end].label == kids[at].label:
                end += 1
            shape = Shape(kids[at], raw)
            if end - at > 1:
                shape.text, shape.children = " ".join(text(k) for k in kids[at:end]), []
            self.children.append(shape)
            at = end


def match(a: Shape, b: Shape) -> tuple[int, list[tuple[Shape, Shape]]]:
    """Simple tree matching: the largest number of nodes that pair up in order under equal roots, and the pairs."""
    if a.label != b.label:
        return 0, []
    known: dict[tuple[int, int], int] = {}

    def table(x: Shape, y: Shape) -> list[list[int]]:
        best = [[0] * (len(y.children) + 1)]
        for c in x.children:
            above, row = best[-1], [0]
            for j, d in enumerate(y.children):
                most = above[j + 1] if above[j + 1] > row[j] else row[j]
                if c.label == d.label:
                    most = max(most, above[j] + count(c, d))
                row.append(most)
            best.append(row)
        return best

    def count(x: Shape, y: Shape) -> int:
        if not x.children or not y.children:
            return 1
        if (id(x), id(y)) not in known:
            known[id(x), id(y)] = table(x, y)[-1][-1] + 1
        return known[id(x), id(y)]

    pairs, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        pairs.append((x, y))
        best, i, j = table(x, y), len(x.children), len(y.children)
        while i and j:
            c, d = x.children[i - 1], y.children[j - 1]
            if c.label == d.label and best[i][j] == best[i - 1][j - 1] + count(c, d):
                todo.append((c, d))
                i, j = i - 1, j - 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return len(pairs), pairs


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode()) - (1 << 63)


def _mark(path: str, text: str) -> int:
    return _hash(f"{path}\n{text}")


def _paths(first: Shape) -> Iterator[tuple[Shape, str]]:
    stack = [(first, first.label)]
    while stack:
        node, path = stack.pop()
        yield node, path
        stack += [(c, f"{path}>{c.label}") for c in node.children]


def reference(pages: list[str]) -> str | None:
    """Of the first few pages of different text, the one that fits the others best."""
    shapes = {}
    for html in pages:
        shape = Shape(parse(html))
        if shape.text and shape.text not in {s.text for s in shapes.values()} and len(shapes) < ALIGNED:
            shapes[html] = shape
    fits = {html: sum(match(a, b)[0] for b in shapes.values() if b is not a) for html, a in shapes.items()}
    return max(fits, key=fits.get) if fits else None


def places(first: Shape, shape: Shape) -> dict[tuple[int, int | None], tuple[int, str | None]]:
    """What a page shows: (place, mark) -> length of its own paragraphs, and path where it has any.

    A place is the node of the host's reference that the page's node is aligned with, by its number (the root is 0);
    a node that the reference lacks is placed by its path, so none is lost. A node without text has no mark. Nodes that
    are neither named nor hold paragraphs tell nothing.
    """
    numbers = {id(node): i for i, (node, _) in enumerate(_paths(first))}
    paired = {id(b): numbers[id(a)] for a, b in match(first, shape)[1]}
    found: dict[tuple[int, int | None], tuple[int, str | None]] = {}
    for node, path in _paths(shape):
        if "." not in node.label and not node.blocks and node is not shape:
            continue
        place = paired.get(id(node))
        if place is None:
            place = _hash(path) | -1 << 62  # negative, so it is no number of a node
        key = place, _mark(path, node.text) if node.text else None
        found[key] = found.get(key, (0, None))[0] + node.blocks, path if node.blocks else None
    return found


def induce(pages: list[str]) -> tuple[list[int], str]:
    """The wrapper of a few pages of one host by the rule of ``wrappers``: marks of its constant nodes, and its content slot."""
    ref = reference(pages)
    first = Shape(parse(ref or ""))
    shapes = {s.text: s for s in map(Shape, map(parse, pages)) if s.text}
    counted: dict[int, dict] = {}
    for shape in shapes.values():
        for (place, mark), (blocks, path) in places(first, shape).items():
            counted.setdefault(place, {}).setdefault(mark, []).append((blocks, path))
    marks, slots = [], [(0, "")]
    for texts in counted.values():
        mark = max(texts, key=lambda m: len(texts[m]))
        if len(texts[mark]) > 1 and 2 * len(texts[mark]) > len(shapes):
            marks += [mark] if mark is not None else []
        elif len(texts) > 1:
            shown = [x for found in texts.values() for x in found]
            slots.append((sum(x[0] for x in shown), min((x[1] for x in shown if x[1]), default="")))
    return (sorted(set(marks)), max(slots)[1]) if len(shapes) > 1 else ([], "")


# ---- extraction -----------------------------------------------------------


def _regions(root: Node, slot: str) -> list[Node]:
    """Where the article is: article elements, else main, else the wrapper's content slot, else the whole page."""
    articles, mains, slots = [], [], []
    stack = [(root, root.label, False)]
    while stack:
        node, path, inside = stack.pop()
        if not inside and (node.tag == "article" or "articlebody" in node.names.split()):
            articles.append(node)
            inside = True
        if node.tag == "main" or "main" in node.names.split():
            mains.append(node)
        if slot and path == slot:
            slots.append(node)
        if not is_part(node, inside):
            stack += [(c, f"{path}>{c.label}", inside) for c in reversed(node.children) if isinstance(c, Node)]
    for found in (articles, mains[:1], slots):
        if any(_text(n) for n in found):
            return found
    return [root]


def extract(html: str, marks: frozenset[int] = frozenset(), slot: str = "") -> str:
    """The article's blocks in page order, one per line. Constant nodes of the host's template go when they
    are named elements; plain paragraphs, headings and lists inside the article stay, however often they recur."""
    root = parse(html)
    found = _regions(root, slot)
    regions, whole = {id(n) for n in found}, found[0] is root
    blocks: list[str] = []
    pieces: list[str] = []

    def end() -> None:
        if pieces:
            if line := _squeezed(pieces):
                blocks.append(line)
            pieces.clear()

    stack: list = [(root, root.label, False)]
    while stack:
        node, path, inside = stack.pop()
        if node is None:
            end()
            continue
        if isinstance(node, str):
            if inside:
                pieces.append(node)
            continue
        was, inside = inside, inside or id(node) in regions
        if is_part(node, was and not whole):
            continue
        if marks and inside and id(node) not in regions and node.names and _mark(path, _text(node)) in marks:
            continue
        if node.tag == "br" and inside:
            pieces.append(" ")
        if node.tag in _BLOCK:
            end()
            stack.append((None, "", False))
        stack += [(c, f"{path}>{c.label}" if isinstance(c, Node) else "", inside) for c in reversed(node.children)]
    end()
    return "\n".join(blocks)


def references(pages: DataFrame) -> DataFrame:
    """(host, reference) for every host of (host, page_id, html) that has a page with text."""
    order = Window.partitionBy("host").orderBy(F.xxhash64("page_id", "html"), "page_id")
    some = pages.where("host is not null and length(html) > 0").withColumn("at", F.row_number().over(order)).where(F.col("at") <= REFERENCES)

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"host": key[0], "reference": reference(group.sort_values("at").html.tolist())}])

    return some.select("host", "at", "html").groupBy("host").applyInPandas(run, "host string, reference string").where("reference is not null")


def _sheets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page the hash of its text and its places."""
    last, first = None, None
    for batch in small_batches(batches, "html", 8 << 20):
        hosts, seen, own, ends, found = [], [], [], [0], []
        for host, ref, html in sorted(zip(*(batch.column(c).to_pylist() for c in ("host", "reference", "html")))):
            if ref != last:
                last, first = ref, Shape(parse(ref))
            shape = Shape(parse(html))
            if shape.text:
                found += [(*k, *v) for k, v in places(first, shape).items()]
                hosts.append(host), seen.append(_hash(shape.text)), own.append(_hash(html)), ends.append(len(found))
        columns = zip(list(zip(*found)) or [()] * len(_PLACE), _PLACE.values())
        place = pa.StructArray.from_arrays([pa.array(c, t) for c, t in columns], names=list(_PLACE))
        each = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), place)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(seen, pa.int64()), pa.array(own, pa.int64()), each], names=["host", "seen", "own", "places"])


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, marks, slot) for every host of (host, page_id, html): marks of its constant nodes (place and text), and the
    place of its content slot.

    Every page of a host is aligned with the host's reference; pages of equal text count once. A place that holds the same
    text in more than half of them is template where it does; the content slot is, of the other places, the one whose own
    paragraphs hold most of the text that varies. Texts are counted across tasks, so the pages of a host never meet in one.
    """
    rows = pages.where("host is not null and length(html) > 0").select("host", "html", _salt("html").alias("salt"))
    known = _salted(written(references(pages), "references"))
    schema = "host string, seen long, own long, places array<struct<place: long, mark: long, blocks: long, path: string>>"
    sheets = rows.join(known, ["host", "salt"]).select("host", "reference", "html").mapInArrow(_sheets, schema)
    different = sheets.groupBy("host", "seen").agg(F.min(F.struct("own", "places")).alias("page"))
    shown = different.select("host", F.explode("page.places").alias("x")).select("host", "x.*")
    texts = shown.groupBy("host", "place", "mark").agg(F.count("*").alias("n"), F.sum("blocks").alias("blocks"), F.min("path").alias("path"))
    top = F.max(F.struct("n", "mark"))
    by_place = texts.groupBy("host", "place").agg(
        top["n"].alias("n"), top["mark"].alias("mark"), F.count("*").alias("texts"), F.sum("n").alias("pages"), F.sum("blocks").alias("blocks"), F.min("path").alias("path")
    )
    by_place = written(by_place, "places")
    hosts = by_place.where("place = 0 and pages > 1").select("host", F.col("pages").alias("all"))
    judged = by_place.join(hosts, "host").withColumn("template", F.expr("n > 1 and 2 * n > all"))
    slot = F.max(F.when(~F.col("template") & (F.col("texts") > 1) & (F.col("blocks") > 0), F.struct("blocks", "path")))
    marks = F.array_sort(F.collect_set(F.when(F.col("template"), F.col("mark"))))
    return judged.groupBy("host").agg(marks.alias("marks"), F.coalesce(slot["path"], F.lit("")).alias("slot"))


def _salt(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def _salted(hosts: DataFrame) -> DataFrame:
    """Rows of hosts once per salt: the pages of a host join them in as many places."""
    return hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every page: the article without menus, page headers, footers, sidebars,
    notices, adverts, forms, scripts, styles, markup and reader comments.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by one line end.
    Null or empty html gives empty text; a page without a readable host, or the only one of its host, is extracted without a
    wrapper; repeated rows give repeated results; an empty table none. A host's pages join its reference and its wrapper by
    host and a salt, so a host with a third of all pages is spread.
    """
    keep_batches_small(pages.sparkSession)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    rows = rows.withColumn("host", F.lower(F.try_parse_url("url", F.lit("HOST"))))
    known = written(wrappers(rows), "wrappers")
    salted, spread = rows.withColumn("salt", _salt("page_id", "html")), _salted(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html", 16 << 20):
            texts = [
                extract(h, frozenset(m or ()), s or "")
                for h, m, s in zip(strings(batch.column("html")), batch.column("marks").to_pylist(), batch.column("slot").to_pylist())
            ]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    joined = salted.join(spread, ["host", "salt"], "left").select("page_id", "url", "html", "marks", "slot")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
