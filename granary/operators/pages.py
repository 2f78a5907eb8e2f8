"""Tables of html pages, found in one pass over each page with a stack of what is open.

Patterns cannot say which table a row belongs to once tables nest, nor where a title ends that holds tags. So an Arrow
function goes over the marks of a page once, keeps the open elements on a stack and notes the pieces of the page's text
where each begins and ends. That depends on the marks alone, so pages with the same marks share it. Pages without a table
never reach it. Closing tags that html lets one leave out (cells, rows,
sections) are supplied; a stray closing tag closes nothing beyond its cell. What the tables mean is column expressions.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numbers import let

TABLES = "array<struct<finance:boolean,debts:boolean,said:string,rows:array<struct<head:boolean,body:boolean,label:string,years:array<string>,values:array<string>,cells:array<string>,said:string>>>>"

# a mark that never ends takes what is left of the page, as browsers have it, so no place is looked at twice
_MARKS = (
    r"({mark}<!--.*?(?:-->|\Z)|<(?P<raw>script|style|template|noscript)\b.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<({end}/?)({tag}[a-z][^\s/>]*+)({rest}(?:=\s*+(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|[^>=]+|=)*+)(?:>|\Z))")  # fmt: skip
_MARK = re.compile(_MARKS.format(mark="?:", **{part: f"?P<{part}>" for part in ("end", "tag", "rest")}), re.I | re.S)
_SPLIT = re.compile(_MARKS.format(mark="", **dict.fromkeys(("end", "tag", "rest"), "?:")), re.I | re.S)
_STEP = _SPLIT.groups + 1
_SETTING = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_YEAR = re.compile("[0-9]{4}")
_DEBTS = re.compile(r"(?:kort|lång)fristiga\s+skulder", re.I)
# fixed values: html's elements without content, and those that begin a line
_EMPTY = frozenset("area base br col embed hr img input link meta source track wbr".split())
_LINES = frozenset("address article br caption div dd dl dt footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tr ul".split())
_SECTIONS, _CELLS = frozenset(("thead", "tbody", "tfoot")), frozenset(("td", "th"))
_FRAME = _SECTIONS | _CELLS | {"table", "tr"}
_OF_ROW, _OF_SECTION = _CELLS | {"tr"}, _CELLS | _SECTIONS | {"tr"}
# of what is kept for other pages of a task: characters of a mark, marks of a page
_SHARED, _STRUCTURE = 256, 2048
_PAGES = 500  # whose tables are held in Python at once


@dataclass(slots=True)
class Node:
    """An element that matters: its tag, what its marks say, and its span of the page's pieces of text."""

    tag: str
    start: int
    right: bool = False
    end: int = -1
    body: bool = False
    head: bool = False
    finance: bool = False
    title: Node | None = None
    parts: list[Node] = field(default_factory=list)


@dataclass(frozen=True)
class Mark:
    """What one opening or closing tag says; of equal ones there is one. Comments and scripts have no tag."""

    tag: str
    closes: bool
    line: bool
    empty: bool
    frame: bool
    cell: bool
    right: bool
    title: bool
    finance: bool


def _settings(rest: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _SETTING.finditer(rest)}


_one = lru_cache(maxsize=1 << 13)(lambda *said: Mark(*said))


def _read(mark: str) -> Mark:
    m = _MARK.match(mark)
    if not m["tag"]:
        return _one("", False, False, True, False, False, False, False, False)
    tag, rest, closes = m["tag"].lower(), m["rest"], bool(m["end"])
    said = _settings(rest) if not closes and (tag in _CELLS or tag == "table" or "title" in rest.lower()) else {}
    classes = said.get("class", "").split()
    return _one(tag, closes, tag in _LINES, tag in _EMPTY, tag in _FRAME, tag in _CELLS, "text-right" in classes, "title" in classes, said.get("data-test") == "finance-table")


_known = lru_cache(maxsize=1 << 13)(_read)  # pages of a site share their marks


class Structure:
    """The tables of pages with the same marks, as spans of their pieces: texts, which stand at `places`, and line ends and tabs."""

    def __init__(self, marks: tuple[Mark, ...]):
        self.tables: list[Node] = []
        self.pieces: list[str] = []
        self.places: list[int] = []
        self._stack: list[tuple[str, Node | None]] = []
        self._frames: list[tuple[str, int]] = []  # open parts of tables, with their places on the stack
        self._open_tables: list[Node] = []
        self._open_rows: list[Node] = []
        self._named: list[dict[str, int]] = [{}]  # open plain tags of each frame
        for mark in marks:
            self._text()
            if mark.tag:
                (self._close if mark.closes else self._open)(mark)
        self._text()
        while self._stack:
            self._pop()

    def _text(self) -> None:
        self.places.append(len(self.pieces))
        self.pieces.append("")

    def _pop(self) -> None:
        tag, node = self._stack.pop()
        if tag in _FRAME:
            self._named.pop()
            self._frames.pop()
        else:
            self._named[-1][tag] -= 1
        if node:
            node.end = len(self.pieces)
            if tag == "table":
                self._open_tables.pop()
            elif tag == "tr":
                self._open_rows.pop()

    def _close_within_table(self, tags: frozenset[str]) -> None:
        """Close the elements of the innermost open table from its outermost one named in `tags`."""
        found = None
        for tag, depth in reversed(self._frames):
            if tag == "table":
                break
            if tag in tags:
                found = depth
        if found is not None:
            while len(self._stack) > found:
                self._pop()

    def _open(self, mark: Mark) -> None:
        tag = mark.tag
        if mark.line:
            self.pieces.append("\n")
        if mark.empty or (mark.frame and tag != "table" and not self._open_tables):
            return  # without content, or a part of no table
        if not mark.frame:
            node = self._titled(None, tag) if mark.title else None
            self._named[-1][tag] = self._named[-1].get(tag, 0) + 1
            self._stack.append((tag, node))
            return
        if mark.cell:
            self._close_within_table(_CELLS)
            self.pieces.append("\t")
        elif tag == "tr":
            self._close_within_table(_OF_ROW)
        elif tag != "table":
            self._close_within_table(_OF_SECTION)
        node = self._node(mark)
        self._frames.append((tag, len(self._stack)))
        self._named.append({})
        self._stack.append((tag, node))

    def _node(self, mark: Mark) -> Node | None:
        tag, node = mark.tag, None
        if mark.cell:
            node = Node(tag, len(self.pieces), mark.right)
            for row in self._open_rows:
                row.parts.append(node)
        elif tag == "table":
            node = Node(tag, len(self.pieces), finance=mark.finance)
            self.tables.append(node)
            self._open_tables.append(node)
        elif tag == "tr":
            own = next(t for t, _ in reversed(self._frames) if t == "table" or t in _SECTIONS)
            around = [t for t, _ in self._frames]
            node = Node(tag, len(self.pieces), body=own == "table" or "tbody" in around, head="thead" in around)
            for outer in self._open_tables:
                outer.parts.append(node)
            self._open_rows.append(node)
        return self._titled(node, tag) if mark.title else node

    def _titled(self, node: Node | None, tag: str) -> Node | None:
        """The node of a title, which open rows without one take."""
        untitled = [r for r in self._open_rows if r.title is None]
        if untitled:
            node = node or Node(tag, len(self.pieces))
            for row in untitled:
                row.title = node
        return node

    def _close(self, mark: Mark) -> None:
        tag = mark.tag
        if mark.line:
            self.pieces.append("\n")
        if tag == "table":
            if self._open_tables:
                while self._stack[-1][0] != "table":
                    self._pop()
                self._pop()
        elif mark.frame:
            self._close_within_table(frozenset((tag,)))
        elif self._named[-1].get(tag):
            while self._stack[-1][0] != tag:
                self._pop()
            self._pop()


_structure = lru_cache(maxsize=1 << 9)(Structure)  # pages of a site often share it whole


def _structure_of(marks: tuple[str, ...]) -> Structure:
    read = tuple([_known(m) if len(m) <= _SHARED else _read(m) for m in marks])
    return _structure(read) if len(read) <= _STRUCTURE else Structure(read)


_written = lru_cache(maxsize=1 << 10)(_structure_of)  # by the marks as they are written: most pages ask for no mark by itself


def _plain(text: str) -> str:
    return entities.unescape(text) if "&" in text else text


class Scan:
    """The tables of one page in the order in which they begin, and the pieces of its text."""

    def __init__(self, page: str):
        parts = _SPLIT.split(page)
        texts, marks, shared = [], [], True
        held, more = _plain(parts[0]), None
        for mark, text in zip(parts[1::_STEP], parts[_STEP::_STEP]):
            if "&" in text:
                text = entities.unescape(text)
            if len(mark) <= _SHARED:
                known = _known(mark)
            else:
                known, shared = _read(mark), False
            if known.empty:  # a part of the text, so that it makes no structure of its own
                more = more or [held]
                more += ("\n" if known.line else "", text)
            else:
                texts.append("".join(more) if more else held)
                marks.append(mark)
                held, more = text, None
        texts.append("".join(more) if more else held)
        structure = (_written if shared and len(marks) <= _SHARED else _structure_of)(tuple(marks))
        self.tables, self._pieces = structure.tables, structure.pieces.copy()
        for place, text in zip(structure.places, texts):
            self._pieces[place] = text

    def said(self, node: Node | None) -> str | None:
        return None if node is None else " ".join("".join(self._pieces[node.start : node.end]).split())

    def _of_debts(self) -> Node | None:
        """The first table that names debts."""
        found = [m.start() for m in _DEBTS.finditer("".join(self._pieces)) if m[0][0] in "kK"]
        if not found:
            return None
        begins = [0, *accumulate(map(len, self._pieces))]
        return next((t for t in self.tables if any(begins[t.start] <= p < begins[t.end] for p in found)), None)

    def records(self, finance: bool = True, debts: bool = True) -> list[tuple]:
        """Finance tables, and the first table that names debts, as far as they are asked for; other tables say nothing here."""
        first = self._of_debts() if debts else None
        return [self._record(t, t is first) for t in self.tables if finance and t.finance or t is first]

    def finance(self) -> list[tuple[list[int], str, list[str]]]:
        """What finance_of() says of the page: (years, label, values) of rows of its finance tables."""
        out = []
        for table in self.tables:
            if table.finance:
                rows = self._record(table, False)[3]
                years = [y for head, _, _, years, *_ in rows if head for y in years] or next((years for _, body, _, years, *_ in rows if body), [])
                dated = [int(y[:4]) for y in years if _YEAR.fullmatch(y[:4])]
                if len(dated) >= 2:
                    out += [(dated, label, values) for _, body, label, _, values, *_ in rows if body and label is not None and values]
        return out

    def _record(self, table: Node, debts: bool) -> tuple:
        rows, held = [], {}  # a cell's text once, however many rows it lies in
        for row in table.parts:
            years, values, cells = [], [], []
            for cell in row.parts:
                if debts or cell.right:
                    text = held.get(id(cell))
                    if text is None:
                        text = held[id(cell)] = self.said(cell)
                    if cell.right:
                        (years if cell.tag == "th" else values).append(text)
                    if debts:
                        cells.append(text)
            rows.append((row.head, row.body, self.said(row.title), years, values, cells, self.said(row) if debts else None))
        return table.finance, debts, self.said(table) if debts else None, rows


FIGURES = "array<struct<years:array<int>,rawLabel:string,values:array<string>>>"


def _kind() -> pa.DataType:
    """TABLES as Arrow has it."""
    texts = pa.list_(pa.string())
    row = pa.struct([("head", pa.bool_()), ("body", pa.bool_()), ("label", pa.string()), ("years", texts), ("values", texts), ("cells", texts), ("said", pa.string())])
    return pa.list_(pa.struct([("finance", pa.bool_()), ("debts", pa.bool_()), ("said", pa.string()), ("rows", pa.list_(row))]))


def _nested(lists: list[list], kind: pa.DataType) -> pa.Array:
    """Lists of plain values, their items as one array."""
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, lists))], pa.int32()), pa.array([v for own in lists for v in own], kind))


def _figures(pages: list[list[tuple[list[int], str, list[str]]]]) -> pa.Array:
    """FIGURES as Arrow has it, column by column."""
    rows = [row for own in pages for row in own]
    fields = [_nested([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()), _nested([r[2] for r in rows], pa.string())]
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, pages))], pa.int32()), pa.StructArray.from_arrays(fields, ["years", "rawLabel", "values"]))


def tables_of(pages: DataFrame, most: str = "2m") -> DataFrame:
    """pages (html and others) with `tables` and `debts` in place of html: rows of years, rawLabel and values as finance_of() has them,
    and the debts of debts_of(), short ones first, as such rows; null where there are none.

    Every page has a row, and none has both. A table of debts is looked for only where no finance table says anything. Arrow batches end at
    `most` bytes, however many pages that is.
    """
    others = [c for c in pages.columns if c != "html"]

    def run(batches):
        for batch in (b.slice(at, _PAGES) for b in batches for at in range(0, b.num_rows, _PAGES)):
            figures, debts = [], []
            for page in batch.column(batch.num_columns - 1).to_pylist():
                scan = None if page is None else Scan(page)
                figures.append(scan.finance() if scan else [])
                debts.append(scan.records(finance=False) if scan and not figures[-1] else [])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), _figures(figures), pa.array(debts, _kind())], [*others, "_figures", "_debts"])

    pages.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)
    tabled = pages.select(*others, F.when(F.col("html").rlike("(?i)<table"), F.col("html")).alias("html"))
    schema = T.StructType([*tabled.drop("html").schema.fields, T.StructField("_figures", T.DataType.fromDDL(FIGURES)), T.StructField("_debts", T.DataType.fromDDL(TABLES))])
    scanned = tabled.mapInArrow(run, schema)
    label = lambda kind: F.when(kind == "short", "Kortfristiga skulder").otherwise("Långfristiga skulder")
    row = lambda r: F.struct(F.transform(r["cells"], lambda c: c["year"]).alias("years"), label(r["kind"]).alias("rawLabel"), F.transform(r["cells"], lambda c: F.coalesce(c["value"].cast("string"), F.lit(""))).alias("values"))
    debts = F.when(F.size("_debts") > 0, F.transform(_debt_rows(F.get("_debts", F.lit(0))), row))
    some = lambda c: F.when(F.size(c) > 0, c)
    return scanned.select(*others, some(F.col("_figures")).alias("tables"), let(debts, some).alias("debts"))


def scan_tables(pages: DataFrame, *keys: str, finance: bool = True, debts: bool = True) -> DataFrame:
    """(keys, found) of pages with (keys, html): the tables that finance_of() and debts_of() read, or those of one of them.

    Rows and cells count for every table and row that they lie in, so a table within a finance table is a part of it. A
    page's text is held once; a cell's text is repeated for each row around it. Null pages and those without tables have no row.
    """

    def run(batches):
        for batch in (b.slice(at, _PAGES) for b in batches for at in range(0, b.num_rows, _PAGES)):
            found = [Scan(page).records(finance, debts) for page in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(found, kind)], [*batch.schema.names[:-1], "found"])

    wanted = pages.where(F.col("html").rlike("(?i)<table")).select(*keys, "html")
    schema = T.StructType([*wanted.drop("html").schema.fields, T.StructField("found", T.DataType.fromDDL(TABLES))])
    kind = _kind()
    return wanted.mapInArrow(run, schema).where(F.size("found") > 0)


def finance_of(scanned: DataFrame, *keys: str) -> DataFrame:
    """(keys, tables): rows of finance tables with years, rawLabel and values.

    A row a page that has any. Years are those of the head's right-aligned cells, or else of the first row of the body; four
    digits begin them, and a table has at least two.
    """
    def own(table: Column) -> Column:
        rows = table["rows"]
        head = F.flatten(F.transform(F.filter(rows, lambda r: r["head"]), lambda r: r["years"]))
        first = F.coalesce(F.try_element_at(F.filter(rows, lambda r: r["body"]), F.lit(1))["years"], F.array().cast("array<string>"))
        said = let(head, lambda h: F.when(F.size(h) > 0, h).otherwise(first))
        years = F.transform(F.filter(F.transform(said, lambda y: F.substring(y, 1, 4)), lambda y: y.rlike("^[0-9]{4}$")), lambda y: y.cast("int"))
        kept = F.filter(rows, lambda r: r["body"] & r["label"].isNotNull() & (F.size(r["values"]) > 0))
        shaped = lambda years: F.transform(kept, lambda r: F.struct(years.alias("years"), r["label"].alias("rawLabel"), r["values"].alias("values")))
        return let(years, lambda y: F.when(F.size(y) >= 2, shaped(y)).otherwise(F.filter(shaped(y), lambda r: F.lit(False))))

    # page by page: nothing is shuffled; exploded, so that a condition does not compute it once more
    tables = F.flatten(F.transform(F.filter("found", lambda t: t["finance"]), own))
    return scanned.select(*keys, F.explode(F.filter(F.array(tables), lambda t: F.size(t) > 0)).alias("tables"))


def _debt_rows(table: Column, every_row: bool = False) -> Column:
    """(kind, cells of year and value) of the rows of a table that name debts; null with fewer than two years."""
    years = F.slice(F.sort_array(F.array_distinct(F.regexp_extract_all(table["said"], F.lit("\\b(20[0-3][0-9])\\b"), F.lit(1))), asc=False), 1, 3)

    def rows_of(kind: str, words: str) -> Column:
        named = F.filter(table["rows"], lambda r: F.lower(r["said"]).contains(words))
        return F.transform(named if every_row else F.slice(named, 1, 1), lambda r: F.struct(F.lit(kind).alias("kind"), r["cells"].alias("cells")))

    # fixed values: what the rows are called
    kinds = F.concat(rows_of("short", "kortfristiga skulder"), rows_of("long", "långfristiga skulder"))

    def dated(years: Column) -> Column:
        values = lambda cells: F.slice(F.transform(cells, lambda c: F.regexp_replace(c, "[^0-9-]", "")), F.lit(2), F.size(years))
        cell = lambda z: F.struct(z["year"].cast("int").alias("year"), z["value"].try_cast("bigint").alias("value"))
        cells = lambda k: F.transform(F.arrays_zip(years.alias("year"), values(k["cells"]).alias("value")), cell)
        return F.when(F.size(years) >= 2, F.transform(kinds, lambda k: F.struct(k["kind"].alias("kind"), cells(k).alias("cells"))))

    return let(years, dated)


def debts_of(scanned: DataFrame, *keys: str, every_row: bool = False) -> DataFrame:
    """(keys, kind, year, value): short and long debts of the first table that names them, over its three latest years.

    A kind's first row counts, or with `every_row` each row that names it. A row's first cell is its label, and cells of
    the others that hold no number are null.
    """
    table = scanned.select(*keys, F.explode("found").alias("t")).where("t.debts")
    rows = table.select(*keys, F.explode(_debt_rows(F.col("t"), every_row)).alias("k"))
    return rows.select(*keys, "k.kind", F.explode("k.cells").alias("z")).select(*keys, "kind", "z.year", "z.value")
