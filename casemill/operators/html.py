"""HTML of judgments and statutes as rows: paragraphs, provision trees and definitions.

Documents are parsed one at a time by a small tree builder on the standard library's parser; everything behind the rows
(layout, completeness, blocks) is DataFrame work. A document bounds what one row of the function holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.functions.scalars import ORDINALS
from casemill.operators.storage import spread

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: An opening tag closes an open one of these first, up to the nearest of SCOPES.
CLOSES = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
BLOCKS = {"div", "table", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "header", "footer", "nav", "form", "pre", "blockquote"}
APART = BLOCKS | {"p", "td", "tr"}
SCOPES = {"table", "div", "ul", "ol", "article", "section", "body"}
HIDDEN = {"script", "style"}
#: Classes of the statutes' markup.
SECTIONS, SUBSECTIONS, NOTE = ("prov1", "prov1Rep"), ("prov2Txt", "prov2TxtIL"), "amendNote"
MARKED = frozenset((*SECTIONS, "schedule"))
MARKERS, POINT_TEXTS = ("p1No", "p2No", "p3No", "p1DefNo", "sProvP1No"), ("pTxt", "p2Txt", "p3Txt", "pDefTxt", "sProvP1")
CONNECTIVES = ("means", "mean", "includes", "include", "has the meaning", "have the meaning", "shall mean", "shall include", "does not include", "do not include")
CONNECTIVE = rf"(?i)\b(?:{'|'.join(CONNECTIVES)})\b"
#: Classes of numbered paragraphs, and how those of headings begin.
NUMBERED, HEADINGS = ("Judg-1", "Judg-1-firstpara", "judg-1"), ("Judg-Heading", "judg-heading", "Judg-Author", "Judg-author", "Judg-Hearing", "Judg-Date")
#: Words that a piece between two line breaks needs to be a paragraph.
LEAST_WORDS = 10


NONE: frozenset[str] = frozenset()


class Node:
    """An element: inside are its elements and texts in order, kids the elements alone."""

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.inside, self.kids = tag, attrs, parent, [], []
        self.names = frozenset(attrs["class"].split()) if attrs.get("class") else NONE

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [x for x in reversed(node.inside) if isinstance(x, Node)]

    def has(self, *names: str) -> bool:
        return not self.names.isdisjoint(names)

    def elements(self) -> list[Node]:
        return self.kids

    def each_below(self, *names: str, tag: str | None = None, without: frozenset[int] = frozenset()) -> Iterator[Node]:
        stack = self.kids[::-1]
        while stack:
            node = stack.pop()
            if not without or id(node) not in without:
                if (tag is None or node.tag == tag) and (not names or not node.names.isdisjoint(names)):
                    yield node
                if node.kids:
                    stack += node.kids[::-1]

    def below(self, *names: str, tag: str | None = None, without: frozenset[int] = frozenset()) -> list[Node]:
        """Elements inside of this one that have one of these classes, in order; nothing inside of those in `without`."""
        return list(self.each_below(*names, tag=tag, without=without)) if self.kids else []

    def first(self, *names: str, tag: str | None = None) -> Node | None:
        """The first of below(): nothing behind it is walked."""
        return next(self.each_below(*names, tag=tag), None) if self.kids else None

    def text(self, without: tuple[str, ...] = (), breaks: str = " ", apart: bool = False, dropped: frozenset[int] = frozenset()) -> str:
        """Visible text, white space collapsed around `breaks`, which stand for line breaks. With apart, elements part words.

        Elements inside are left out if they have a class of `without` or are in `dropped`.
        """
        out, stack, hidden = [], [self], frozenset(without)
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            elif node.tag == "br":
                out.append("\0")
            elif node.tag not in HIDDEN and not (node is not self and (not hidden.isdisjoint(node.names) or id(node) in dropped)):
                stack += reversed([" ", *node.inside, " "] if apart else [*node.inside, " "] if node.tag in APART else node.inside)
        # Breaks with white space between them stay apart by a blank.
        pieces = "".join(out).split("\0")
        return breaks.join(" ".join(x.split()) or " " * (bool(x) and breaks != " ") for x in pieces).strip()


class _Growing:
    """A tree that grows by tags and texts."""

    def __init__(self):
        super().__init__()
        self.root = self.at = Node("root", {}, None)

    def handle_starttag(self, tag, attrs):
        closes, scopes = ENDS.get(tag, (NONE, NONE))
        if closes:
            node = self.at
            while node.parent and node.tag not in scopes:
                if node.tag in closes:
                    self.at = node.parent
                    break
                node = node.parent
        child = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.inside.append(child)
        self.at.kids.append(child)
        if tag not in VOID:
            self.at = child

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        node = self.at
        while node.parent and node.tag != tag:
            node = node.parent
        if node.parent:
            self.at = node.parent

    def handle_data(self, data):
        self.at.inside.append(data)


class _Builder(_Growing, HTMLParser):
    pass


#: What an opening tag closes, and where that search ends.
ENDS = {t: (c, SCOPES - c) for t, c in ({t: {"p"} for t in BLOCKS} | CLOSES).items()}
#: Pages of nothing but these tags in lower case, attributes in double quotes, and texts without entities need no tolerant parser.
PLAIN = ("a", "article", "b", "body", "br", "center", "div", "em", "footer", "form", "h[1-6]", "head", "header", "hr", "html", "i", "li", "nav", "ol", "p", "section", "span", "strong", "sub", "sup", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "u", "ul")
TOKEN = re.compile(rf'([^<&]+)|<({"|".join(PLAIN)})((?: [a-z][a-z-]*="[^"<>&]*")*)>|</({"|".join(PLAIN)})>')
ATTRIBUTE = re.compile(r' ([a-z][a-z-]*)="([^"]*)"')


def _plain_tree(html: str) -> Node | None:
    """The tree of a page of PLAIN markup, null for any other."""
    tokens, end, size = [], 0, len(html)
    while end < size:
        token = TOKEN.match(html, end)
        if token is None:
            return None
        tokens.append(token)
        end = token.end()
    tree = _Growing()
    for token in tokens:
        kind = token.lastindex
        if kind == 1:
            tree.at.inside.append(token[1])
        elif kind == 4:
            tree.handle_endtag(token[4])
        else:
            tree.handle_starttag(token[2], ATTRIBUTE.findall(token[3]))
    return tree.root


def parse(html: str) -> Node:
    """The tree of a document; unclosed elements end where HTML lets them. Pages of plain markup, the same tree of which needs a fraction of the time, go without the tolerant parser."""
    root = _plain_tree(html)
    if root is None:
        builder = _Builder()
        builder.feed(html)
        builder.close()
        root = builder.root
    return root


def paragraph_rows(html: str | None) -> list[tuple[int, str, str, str]]:
    """pos, text, classes, and text with line breaks kept, of each <p> of the judgment, or of the whole page."""
    if not html or not html.strip():
        return []
    root = parse(html)
    body = next((n for n in root.walk() if n.attrs.get("id") == "judgments"), root)
    found = [n for n in body.walk() if n.tag == "p"]
    return [(i, n.text(apart=True), " ".join(n.classes()), n.text(breaks="\n", apart=True)) for i, n in enumerate(found)]


def mapped(pages: DataFrame, key: str, html: str, function, columns: list[tuple[str, pa.DataType]], sql: str) -> DataFrame:
    """key and the columns of the rows that the function gives for each page, pages being dealt over all tasks."""
    schema = pa.schema([("key", pa.int64()), *columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, *r) for k, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for r in function(h)]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)

    rows = spread(pages.select(F.col(key).cast("long").alias("key"), F.col(html).alias("html")))
    return rows.mapInArrow(run, f"key long, {sql}").withColumnRenamed("key", key)


def paragraphs(pages: DataFrame, key: str, html: str) -> DataFrame:
    """A row for each <p>: key, pos, text, classes, lines, number (the printed one, or null). A page without any has no rows."""
    columns = [("pos", pa.int32()), ("text", pa.string()), ("classes", pa.string()), ("lines", pa.string())]
    rows = mapped(pages, key, html, paragraph_rows, columns, "pos int, text string, classes string, lines string")
    number = F.nullif(F.regexp_extract("text", r"^([0-9]+)[.)]*(?:\s|$)", 1), F.lit("")).try_cast("int")
    return rows.select(key, "pos", "text", "classes", "lines", number.alias("number"))


def _modern() -> Column:
    """Whether a paragraph has the class of numbered ones."""
    return F.arrays_overlap(F.split("classes", " "), F.array(*map(F.lit, NUMBERED)))


def _pieces() -> Column:
    """The parts of a paragraph between two line breaks that are long enough."""
    clean = F.transform(F.split("lines", "\n\n+"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    return F.filter(clean, lambda x: F.size(F.split(x, " ")) >= LEAST_WORDS)


def layouts(pages: DataFrame, rows: DataFrame, key: str, html: str) -> DataFrame:
    """key, layout, expected and extracted paragraphs, and parse_status of each page.

    A page is modern if any paragraph has the class of numbered ones; then only these count as numbered.
    """
    marked = F.when(_modern(), F.col("number"))
    totals = {"numbered": F.count, "highest": F.max, "different": F.countDistinct, "lowest": F.min}
    seen = rows.groupBy(key).agg(
        F.bool_or(_modern()).alias("modern"), F.sum(F.size(_pieces())).alias("pieces"), *(f("number").alias(n) for n, f in totals.items()), *(f(marked).alias(f"marked_{n}") for n, f in totals.items()),
    )
    seen = seen.withColumns({n: F.when(F.col("modern"), F.col(f"marked_{n}")).otherwise(F.col(n)) for n in totals})
    joined = pages.select(key, F.length(F.trim(F.coalesce(F.col(html), F.lit("")))).alias("size")).join(seen, key, "left")
    layout = F.when(F.col("size") == 0, "failed").when(F.col("modern"), "modern_judg1").when(F.col("numbered") >= 2, "numbered_plain_p").when(F.col("pieces") >= 2, "unnumbered_br").otherwise("unknown")
    by_number = F.col("layout").isin("modern_judg1", "numbered_plain_p")
    whole = (F.col("extracted") == F.col("expected")) & (F.col("different") == F.col("expected")) & (F.col("lowest") == 1)
    status = F.when(F.col("layout").isin("failed", "unknown"), F.col("layout")).when(by_number, F.when(whole, "complete").otherwise("incomplete")).otherwise("complete")
    counts = {"expected": F.when(by_number, F.col("highest")).when(F.col("layout") == "unnumbered_br", F.col("pieces")), "extracted": F.when(by_number, F.col("numbered")).when(F.col("layout") == "unnumbered_br", F.col("pieces")).otherwise(0)}
    return joined.withColumn("layout", layout).withColumns(counts).withColumn("parse_status", status).select(key, "layout", "expected", "extracted", "parse_status")


def blocks(rows: DataFrame, states: DataFrame, key: str) -> DataFrame:
    """The paragraphs of judgments by their pages' layouts (of layouts()): key, ordinal, text.

    A numbered paragraph takes the unnumbered ones behind it, except headings of modern pages; those before the first are
    dropped. Of pages without numbers each long enough piece between two line breaks is a paragraph. Unknown and failed
    pages have none.
    """
    laid = rows.join(states.select(F.col(key).alias("s_key"), "layout"), F.col(key) == F.col("s_key")).drop("s_key")
    modern = F.col("layout") == "modern_judg1"
    numbered = laid.filter(F.col("layout").isin("modern_judg1", "numbered_plain_p")).withColumn("number", F.when(~modern | _modern(), F.col("number")))
    body = numbered.filter(F.col("number").isNotNull() | ((F.col("text") != "") & ~(modern & F.col("classes").rlike(rf"(?:^| )(?:{'|'.join(HEADINGS)})"))))
    ordinal = F.count("number").over(Window.partitionBy(key).orderBy("pos"))
    text = F.when(F.col("number").isNotNull(), F.regexp_replace("text", r"(?U)^\s*\S+\s*", "")).otherwise(F.col("text"))
    parts = body.select(key, "pos", ordinal.cast("int").alias("ordinal"), text.alias("text")).filter("ordinal > 0")
    lists = parts.groupBy(key, "ordinal").agg(F.array_sort(F.collect_list(F.when(F.col("text") != "", F.struct("pos", "text")))).alias("parts"))
    joined = lists.select(key, "ordinal", F.array_join(F.transform("parts", lambda x: x["text"]), "\n").alias("text"))
    pieces = laid.filter("layout = 'unnumbered_br'").select(key, "pos", F.posexplode(_pieces()).alias("nth", "text"))
    nth = F.row_number().over(Window.partitionBy(key).orderBy("pos", "nth"))
    return joined.unionByName(pieces.select(key, nth.alias("ordinal"), "text"))


TREE = "ordinal int, level int, parent_ordinal int, descendant_count int, kind string, number string, citation string, heading string, content string, anchor string, note string"


def _plain(node: Node, dropped: frozenset[int] = frozenset()) -> str:
    """Text without notes on amendments and without what is told apart."""
    return node.text((NOTE,), apart=True, dropped=dropped)


def _notes(node: Node, dropped: frozenset[int] = frozenset()) -> str | None:
    """The notes on amendments inside, each on a line; those within others belong to them."""
    outer = node.below(NOTE, tag="div", without=dropped)
    inner = {id(x) for n in outer for x in n.below(NOTE, tag="div")}
    return "\n".join(t for t in (n.text(apart=True) for n in outer if id(n) not in inner) if t) or None


def _first(found: list[Node]) -> Node | None:
    return found[0] if found else None


def _cell(node: Node, name: str) -> Node | None:
    return node.first(name, tag="td")


class _Tree:
    """Collects the provisions of a statute in pre-order, as a walk opens and closes them."""

    def __init__(self):
        self.rows: list[dict] = []
        self.open: list[int] = []
        self.in_schedule, self.extracted = False, 0

    @contextmanager
    def at(self, kind: str, **what) -> Iterator[None]:
        """A provision; what is added within it lies below it."""
        self.extracted += kind == "schedule" or (kind == "section" and not self.in_schedule)
        parent = self.open[-1] if self.open else None
        self.rows.append({"ordinal": len(self.rows) + 1, "level": len(self.open) + 1, "parent_ordinal": None if parent is None else parent + 1, "kind": kind} | {k: v or None for k, v in what.items()})
        self.open.append(len(self.rows) - 1)
        yield
        mine = self.open.pop()
        self.rows[mine]["descendant_count"] = len(self.rows) - mine - 1

    def add(self, kind: str, **what) -> None:
        with self.at(kind, **what):
            pass


def _group(tree: _Tree, cell: Node, kind: str, short: str) -> None:
    """A part or a division: number, heading, and what lies directly in its cell."""
    number = heading = None
    for child in cell.elements():
        if child.has("partNo" if kind == "part" else "divNo"):
            number = _plain(child)
        elif child.tag == "table" and not child.has(*SECTIONS) and not (kind == "part" and _cell(child, "div")) and not child.below("prov1", tag="div"):
            heading = _plain(child) or heading
    mark = re.match(rf"{kind}\s+(\S+)", number or "", re.IGNORECASE)
    with tree.at(kind, number=mark and mark[1], citation=mark and f"{short} {mark[1]}", heading=heading, anchor=cell.attrs.get("id")):
        for child in cell.elements():
            if child.has(*SECTIONS):
                _section(tree, child)
            elif kind == "part" and child.tag == "table" and not child.has("partNo") and (inner := _cell(child, "div")):
                _group(tree, inner, "division", "Div")


def _section(tree: _Tree, node: Node) -> None:
    header, body = _cell(node, "prov1Hdr"), _cell(node, "prov1Txt") or _cell(node, "prov1RepText")
    strong = _first([x for x in body.elements() if x.tag == "strong"]) if body else None
    mark = re.match(r"\d+[A-Z]*", _plain(strong)) if strong else None
    anchor = (header.attrs.get("id") if header else None) or node.attrs.get("id")
    _container(tree, body, "section", mark and f"s {mark[0]}", number=mark and mark[0], heading=header and _plain(header), anchor=anchor)


def _container(tree: _Tree, body: Node | None, kind: str, citation: str | None, **what) -> None:
    """A section or a schedule's paragraph: subsections, each with its points, or else points of its own. Subsections within others stand behind them."""
    subsections = body.below(*SUBSECTIONS) if body else []
    if not subsections:
        _points(tree, body, kind, citation, r"\d+[A-Z]*\.\s*", frozenset(), **what)
        return
    apart = frozenset(map(id, subsections))
    with tree.at(kind, citation=citation, content=_unmarked(_plain(body, apart), r"\d+[A-Z]*\.\s*"), note=_notes(body, apart), **what):
        for sub in subsections:
            dropped = frozenset(id(x) for x in sub.below(*SUBSECTIONS))
            mark = re.match(r"—?\s*\((\d+[A-Z]?)\)", _plain(sub, dropped))
            named = _first([x for x in sub.below(tag="a") if x.attrs.get("name")])
            own = f"{citation}({mark[1]})" if citation and mark else citation
            _points(tree, sub, "subsection", own, r"—?\s*\(\d+[A-Z]?\)\s*", dropped, number=mark and mark[1], anchor=named.attrs["name"] if named else sub.attrs.get("id"))


def _unmarked(text: str, mark: str) -> str:
    return re.sub(f"^(?:{mark})", "", text).strip()


def _points(tree: _Tree, node: Node | None, kind: str, citation: str | None, mark: str, dropped: frozenset[int], **what) -> None:
    """A provision with the points of the tables in it. A table is one of points if some cell in it is a marker; those within definitions are text."""
    tables = _point_tables(node, dropped) if node else []
    apart = dropped | {id(t) for t in tables}
    with tree.at(kind, citation=citation, content=_unmarked(_plain(node, apart), mark) if node else None, note=_notes(node, apart) if node else None, **what):
        for table in tables:
            for row in (_first(table.below(tag="tbody", without=dropped)) or table).elements():
                cells = [c for c in row.elements() if c.tag == "td" and id(c) not in dropped] if row.tag == "tr" else []
                marker = next((c for c in reversed(cells) if c.has(*MARKERS)), None)
                text = next((c for c in reversed(cells) if c.has(*POINT_TEXTS) and not c.has(*MARKERS)), None)
                if marker and text:
                    sign = "".join(_plain(marker).split())
                    own = f"{citation}{sign}" if citation and sign else sign or None
                    _points(tree, text, "point", own, "", dropped, number=sign.strip("()"), anchor=text.attrs.get("id"))


def _point_tables(node: Node, dropped: frozenset[int]) -> list[Node]:
    """The outermost tables of points."""
    out, stack = [], node.elements()[::-1]
    while stack:
        x = stack.pop()
        if id(x) in dropped or x.has("def"):
            continue
        if x.tag == "table" and next(x.each_below(*MARKERS, tag="td", without=dropped), None):
            out.append(x)
        else:
            stack += x.elements()[::-1]
    return out


def _schedule(tree: _Tree, node: Node) -> None:
    """A schedule and its paragraphs; a heading in a table of its own belongs to the next paragraph only."""
    header, subject = _cell(node, "sHdr"), _cell(node, "scHdr")
    title, about = (_plain(n) if n else None for n in (header, subject))
    citation = short_schedule(title)
    number = citation.removeprefix("Sch").strip() if citation else None
    tree.in_schedule = True
    with tree.at("schedule", number=number, citation=citation, heading=title or about, content=about if about != title else None, anchor=header and header.attrs.get("id"), note=header and _notes(header)):
        carried = None
        for table in node.elements():
            if table.tag != "table" or any(_cell(table, c) for c in ("sHdr", "scHdr", "SbodyRefs")):
                continue
            if lead := _cell(table, "sProvHdr"):
                carried = _plain(lead) or None
            elif body := _cell(table, "tailSTxt"):
                mark = re.match(r"(\d+[A-Z]?)\.", _plain(body))
                _container(tree, body, "section", f"{citation} para {mark[1]}" if citation and mark else citation, number=mark and mark[1], heading=carried, anchor=body.attrs.get("id"))
                carried = None
    tree.in_schedule = False


def _statute(page: Node) -> _Tree:
    """Opening words, the body's parts, divisions and sections, and the tail's schedules."""
    tree, area = _Tree(), lambda name: page.first(name, tag="div")
    if front := area("front"):
        opening = next((t for t in front.below(tag="table") if _plain(t).startswith("An Act ")), None)
        if opening:
            tree.add("opening", content=_plain(opening), note=_notes(opening), anchor=opening.attrs.get("id") or "opening")
    for child in body.elements() if (body := area("body")) else ():
        if part := _cell(child, "part"):
            _group(tree, part, "part", "Pt")
        elif division := _cell(child, "div"):
            _group(tree, division, "division", "Div")
        elif child.has(*SECTIONS):
            _section(tree, child)
    for schedule in tail.below("schedule", tag="div") if (tail := area("tail")) else ():
        _schedule(tree, schedule)
    return tree


def _legis(html: str) -> Node:
    page = parse(html)
    return page.first("legis", tag="div") or page


def _marked(root: Node) -> int:
    """How many sections and schedules the markup tells of."""
    return sum(len(n.names & MARKED) for n in root.each_below(*MARKED, tag="div"))


def statute_rows(html: str | None) -> list[dict]:
    """All rows of a statute: its provisions in pre-order, its definitions, and one row with what the markup holds and what was taken from it."""
    if not html or not html.strip():
        return [{"what": "state"}]
    root = _legis(html)
    tree = _statute(root)
    marked = _marked(root)
    return [
        *({"what": "provision"} | r for r in tree.rows), *({"what": "definition", "ordinal": i, "term": t, "content": d} for i, (t, d) in enumerate(_definitions(root))), {"what": "state", "expected": marked, "extracted": tree.extracted},
    ]


def provision_rows(html: str | None) -> list[dict]:
    """The provisions of a statute in pre-order, each with its level, parent and number of descendants."""
    return _statute(_legis(html)).rows if html and html.strip() else []


def state_rows(html: str | None) -> list[tuple[int | None, int | None]]:
    """What the markup of a statute holds and what is taken from it, counted without reading any text."""
    if not html or not html.strip():
        return [(None, None)]
    root = _legis(html)
    body, tail = (root.first(name, tag="div") for name in ("body", "tail"))
    taken = len(tail.below("schedule", tag="div")) if tail else 0
    for child in body.elements() if body else ():
        if part := _cell(child, "part"):
            taken += _sections(part, True)
        elif division := _cell(child, "div"):
            taken += _sections(division, False)
        else:
            taken += child.has(*SECTIONS)
    return [(_marked(root), taken)]


def _sections(cell: Node, part: bool) -> int:
    """How many sections _group() finds in a part or a division."""
    taken = 0
    for child in cell.elements():
        if child.has(*SECTIONS):
            taken += 1
        elif part and child.tag == "table" and not child.has("partNo") and (inner := _cell(child, "div")):
            taken += _sections(inner, False)
    return taken


def short_schedule(title: str | None) -> str | None:
    """Like "Sch 3" for THIRD SCHEDULE, and "Sch" for a schedule without a number; null for other titles."""
    title = (title or "").upper()
    if found := re.match(rf"({'|'.join(ORDINALS)}|[0-9]+)(?:ST|ND|RD|TH)?\s+SCHEDULE\b", title):
        return f"Sch {ORDINALS.index(found[1]) + 1 if found[1] in ORDINALS else found[1]}"
    return "Sch" if re.match(r"SCHEDULE\b", title) else None


def _definitions(root: Node) -> list[tuple[str, str]]:
    out = []
    for cell in root.below("def", tag="td"):
        text = _plain(cell)
        stop = re.search(CONNECTIVE, text)
        quoted = list(re.finditer(r"[“\"]([^”\"]+)[”\"]", text))
        terms = [" ".join(t[1].split()) for t in quoted if not stop or t.start() <= stop.start()]
        meaning = text[quoted[0].end() :].strip() if quoted else ""
        out += [(t, meaning) for t in terms if t and meaning]
    return out


def definition_rows(html: str | None) -> list[tuple[str, str]]:
    """term and definition of each defined term; several terms before the connective share one."""
    return [(r["term"], r["content"]) for r in statute_rows(html) if r["what"] == "definition"]


STATE = "expected int, extracted int"
STATUTE = f"what string, {TREE}, term string, expected int, extracted int"


def _kinds(sql: str) -> list[tuple[str, pa.DataType]]:
    return [(c.split()[0], pa.int32() if c.endswith(" int") else pa.string()) for c in sql.split(", ")]


def statutes(pages: DataFrame, key: str, html: str) -> DataFrame:
    """All rows of statutes by one parse, told apart by `what`: see provisions_of, definitions_of and states_of. Write it before more than one is read."""
    kinds = _kinds(STATUTE)
    return mapped(pages, key, html, lambda h: [tuple(r.get(n) for n, _ in kinds) for r in statute_rows(h)], kinds, STATUTE)


def provisions_of(parsed: DataFrame, key: str) -> DataFrame:
    """The provision trees among the rows of statutes()."""
    return parsed.filter("what = 'provision'").select(key, *(c.split()[0] for c in TREE.split(", ")))


def definitions_of(parsed: DataFrame, key: str) -> DataFrame:
    """term and definition; of equal terms of a statute the first counts."""
    return parsed.filter("what = 'definition'").groupBy(key, "term").agg(F.min_by("content", "ordinal").alias("definition"))


def states_of(parsed: DataFrame, key: str) -> DataFrame:
    """The states among the rows of statutes(), as _states() gives them."""
    return _states(parsed.filter("what = 'state'"), key)


def _states(rows: DataFrame, key: str) -> DataFrame:
    """expected (sections and schedules in the markup), extracted (schedules, and sections outside of them), and parse_status: failed for a blank page, unknown without any."""
    status = F.when(F.col("expected").isNull(), "failed").when(F.col("expected") == 0, "unknown").when(F.col("expected") == F.col("extracted"), "complete").otherwise("incomplete")
    return rows.select(key, "expected", F.coalesce("extracted", F.lit(0)).alias("extracted"), status.alias("parse_status"))


def provisions(pages: DataFrame, key: str, html: str) -> DataFrame:
    """The provision trees of statutes as nested sets. A blank page has no rows."""
    kinds = _kinds(TREE)
    return mapped(pages, key, html, lambda h: [tuple(r.get(n) for n, _ in kinds) for r in provision_rows(h)], kinds, TREE)


def definitions(pages: DataFrame, key: str, html: str) -> DataFrame:
    return definitions_of(statutes(pages, key, html), key)


def legislation_status(pages: DataFrame, key: str, html: str) -> DataFrame:
    return _states(mapped(pages, key, html, state_rows, _kinds(STATE), STATE), key)
