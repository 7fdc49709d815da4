"""HTML bodies to document nodes.

Spark has no HTML reader, so this is the one Python job of the extraction side:
a single pass per body in ``mapInArrow``, one output row per document holding its
nodes. Which table, which header and which link a page family means is decided
afterwards by array and map expressions over those nodes. One parse serves every
family, and because a document stays one row, no family plan needs a shuffle to
bring a cell together with its header, its row or its page.
"""

from __future__ import annotations

import gc
import re
import sys
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from html import unescape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nested import array_rows, struct_rows

# Ship this module's code with the job: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ITEM_DDL = "col_no int, tag string, classes array<string>, text string, href string, attrs map<string,string>"
NODE_DDL = (
    "pos int, tag string, id string, classes array<string>, parent int, last int, parent_last int, "
    "table_no int, table_id string, table_classes array<string>, row_no int, col_no int, "
    "section string, head string, text string, href string, attrs map<string,string>, "
    f"heads array<string>, cells array<string>, items array<struct<{ITEM_DDL}>>"
)
NODE_FIELDS = (
    "pos", "tag", "id", "classes", "parent", "last", "parent_last", "table_no", "table_id", "table_classes",
    "row_no", "col_no", "section", "head", "text", "href", "attrs", "heads", "cells", "items",
)

# Elements that are always nodes; those of TEXT_TAGS carry their text.
NODE_TAGS = frozenset("table tr td th a img use link script title h1 h2 select option".split())
TEXT_TAGS = frozenset("td th a title h1 h2 option script".split())
# Attributes that make any element a node.
NODE_ATTRS = ("data-ticker", "data-boxover-ticker")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
    "main nav ol p pre section table ul".split()
)
# A start tag ends these open elements, looking no further than the fence.
IMPLIED_END = {
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr", "td", "th"), ("table",)),
    "li": (("li",), ("ul", "ol")),
    "option": (("option",), ("select",)),
} | {
    part: (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",))
    for part in ("thead", "tbody", "tfoot")
}
TABLE_PARTS = frozenset("table thead tbody tfoot tr".split())


# Most tags hold no ``<`` and no unpaired quote; the last group is any other ``<``. A try ends at the next ``<``.
_PLAIN = re.compile(
    r"""</([a-zA-Z][^\s/<>]*+)[^<>]*+>|<([a-zA-Z][^\s/<>"']*+)(?=[\s/>])((?:[^<>"']++|"[^"<>]*+"|'[^'<>]*+')*+)>|(<)"""
)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in ("script", "style")}


class _Markup:
    """The markup tokens of one body, in time linear in its length.

    A tag ends at the first ``>`` outside quotes or, where its quotes do not pair up, at the
    first ``>`` of all. Both searches remember what they learnt: behind the last ``>`` of the
    body nothing is a tag, and a quote that was followed once is never followed again.
    """

    def __init__(self, body: str):
        self.body, self.last = body, body.rfind(">")
        self.known: dict[int, int] = {}

    def _unquoted(self, at: int) -> int:
        """The first ``>`` from ``at`` on that stands outside quotes, or -1."""
        seen = []
        while True:
            found = _STOP.search(self.body, at)
            if found is None:
                end = -1
                break
            here = found.start()
            if self.body[here] == ">":
                end = here
                break
            if here in self.known:
                end = self.known[here]
                break
            seen.append(here)
            close = self.body.find(self.body[here], here + 1)
            if close < 0:
                end = -1
                break
            at = close + 1
        for quote in seen:
            self.known[quote] = end
        return end

    def odd(self, at: int) -> tuple[int, str | None, str | None, str] | None:
        """``(end, closed tag, opened tag, attributes)`` of what a ``<`` begins; comments and declarations name no tag."""
        body = self.body
        if body.startswith("!--", at + 1):
            close = body.find("-->", at + 4)
            return len(body) if close < 0 else close + 3, None, None, ""
        if at > self.last:
            return None
        following = body[at + 1 : at + 2]
        if following in ("!", "?"):
            return body.index(">", at) + 1, None, None, ""
        closing = following == "/"
        name = _NAME.match(body, at + 2 if closing else at + 1)
        if name is None:
            return None
        if closing:
            return body.index(">", name.end()) + 1, name.group(), None, ""
        end = self._unquoted(name.end())
        if end < 0:
            end = body.index(">", name.end())
        return end + 1, None, name.group(), body[name.end() : end]

    def raw_end(self, tag: str, at: int) -> tuple[int, int]:
        """Where the code of a script or style element stops, and where its end tag does."""
        close = _RAW_END[tag].search(self.body, at, self.last + 1)
        return (close.start(), close.end()) if close else (len(self.body), len(self.body))


# Where a node, a list, holds its fields: those of NODE_FIELDS, then whether its text is kept.
(
    _POS, _TAG, _ID, _CLASSES, _PARENT, _LAST, _PARENT_LAST, _TABLE_NO, _TABLE_ID, _TABLE_CLASSES,
    _ROW_NO, _COL_NO, _SECTION, _HEAD, _TEXT, _HREF, _ATTRS, _HEADS, _CELLS, _ITEMS, _KEEP,
) = range(21)
_TABLE_TAGS = frozenset(("table", "tr", "td", "th"))
# A paragraph is ended by the start of any block.
_P_END = (("p",), ("td", "th", "table", "li", "button", "div"))
# Tags are looked up as they are written, if not longer than this, among so many that were seen last.
_KNOWN_LENGTH, _KNOWN_TAGS = 400, 4096


class _Tag:
    """A start tag as it is written: what it says whatever place it stands at."""

    __slots__ = ("name", "css", "classes", "id", "named", "node", "item", "structure", "ends", "void", "raw", "end", "plain")

    def __init__(self, name: str, written: str, classes: frozenset[str], ids: frozenset[str]):
        attrs: dict[str, str] = {}
        if written and not written.isspace():
            for key, double, single, bare in _ATTRIBUTE.findall(written):
                value = double or single or bare
                attrs.setdefault(key.lower(), unescape(value) if "&" in value else value)
        self.name, self.id = name, attrs.get("id")
        self.css = attrs.get("class") or ""
        self.classes = self.css.split()
        self.named = bool(attrs) and (
            not classes.isdisjoint(self.classes) or self.id in ids or not attrs.keys().isdisjoint(NODE_ATTRS)
        )
        self.ends = IMPLIED_END.get(name) or (_P_END if name in BLOCK else None)
        self.void, self.raw = name in VOID, name in _RAW_END
        self.end = None if self.void or self.raw else f"</{name}>"
        self.structure = name in _TABLE_TAGS and not self.named
        self.item = name not in ("tr", "th") and (name != "td" or self.named or "data-" in " ".join(attrs))
        self.node = None
        if name in NODE_TAGS or self.named:
            self.node = node = [None] * 21
            node[_TAG], node[_ID], node[_CLASSES], node[_ATTRS] = name, self.id, self.classes, list(attrs.items())
            node[_HREF] = attrs.get("href", attrs.get("xlink:href", attrs.get("src")))
            node[_KEEP] = name in TEXT_TAGS or (self.named and name != "table")
        self.plain = self.node is None and self.ends is None


class _Open:
    """An element whose end tag has not been seen."""

    __slots__ = ("tag", "pos", "node", "mark", "table", "row", "section", "children")


class _Table:
    __slots__ = ("no", "id", "classes", "rows", "ths", "thead", "read")

    def __init__(self, no: int, tag: _Tag, read: frozenset[str] | None):
        self.no, self.id, self.classes = no, tag.id, tag.classes
        self.read = read is None or self.id in read or not read.isdisjoint(self.classes)
        self.rows, self.ths, self.thead = [], [], []


class _Row:
    __slots__ = ("no", "cells", "items", "node", "cols")

    def __init__(self, no: int):
        self.no, self.cells, self.items, self.node, self.cols = no, [], [], None, 0


class _Nodes:
    """Collects the nodes of one body, supplying the end tags HTML may omit.

    With ``rows``, only the ``table`` and ``tr`` nodes of the tables with such a class or id
    and the cells that a class, an id or an attribute makes nodes are collected.
    """

    def __init__(self, classes: frozenset[str], ids: frozenset[str], skeleton: bool, rows: frozenset[str] | None = None):
        self.classes, self.ids, self.skeleton, self.rows = classes, ids, skeleton, rows
        self.known: dict[str, _Tag | str] = {}

    def parse(self, body: str) -> list[list]:
        self.out: list[list] = []
        self.open: list[_Open] = []
        self.words: list[str] = []
        self.shape: list[str] = []
        self.tables: list[_Table] = []
        self.count = 0
        self.code: str | None = None
        self.places: dict[str, list[int]] = {}
        words, opened, known, markup = self.words, self.open, self.known, _Markup(body)
        begun, close, start = 0, -1, body.find("<")
        while start >= 0:
            if close < start:  # the next ``>``, looked for once
                close = body.find(">", start)
                if close < 0:
                    close = sys.maxsize
            tag = known.get(body[start + 1 : close]) if close - start <= _KNOWN_LENGTH else None
            if tag is not None:
                end = close + 1
            else:
                m = _PLAIN.match(body, start)
                closed, name, attributes, odd = m.groups()
                end = m.end()
                if odd:
                    found = markup.odd(start)
                    if found is None:  # a ``<`` of the text
                        start = body.find("<", end)
                        continue
                    end, closed, name, attributes = found
                tag = closed and closed.lower()
                if name is not None:
                    tag = _Tag(name.lower(), attributes, self.classes, self.ids)
                if not odd and end - start <= _KNOWN_LENGTH:
                    if len(known) >= _KNOWN_TAGS:
                        known.clear()
                    known[body[start + 1 : end - 1]] = tag
            if start > begun:
                data = body[begun:start]
                words.append(unescape(data) if "&" in data else data)
            begun, start = end, body.find("<", end)
            if tag.__class__ is _Tag:
                leaf = tag.end is not None and body.startswith(tag.end, start)
                if leaf and tag.plain and not self.skeleton:  # only its text counts
                    node = None
                    self.count += 1
                else:
                    node = self._start(tag, leaf)
                if leaf:
                    data = body[end:start]
                    if "&" in data:
                        data = unescape(data)
                    words.append(data)
                    if node is not None and node[_KEEP]:
                        node[_TEXT] = data.strip()
                    begun = start + len(tag.end)
                    start = body.find("<", begun)
                elif tag.raw:
                    stop, begun = markup.raw_end(tag.name, end)
                    self.code = body[end:stop]
                    self._end(tag.name)
                    start = body.find("<", begun)
            elif tag is not None:
                if opened and opened[-1].tag == tag:
                    self._end_last()
                else:
                    self._end(tag)
        if begun < len(body):
            data = body[begun:]
            words.append(unescape(data) if "&" in data else data)
        while opened:
            self._end_last()
        self._fill_tables()
        if self.skeleton:
            document = [None] * 21
            document[_POS], document[_TAG], document[_TEXT] = self.count, "#document", "\n".join(self.shape)
            self.out.append(document)
        return self.out

    def _end_last(self) -> None:
        e = self.open.pop()
        self.places[e.tag].pop()
        last = self.count - 1
        if e.children is not None:
            for child in e.children:
                child[_PARENT_LAST] = last
        node = e.node
        if node is not None:
            node[_LAST] = last
            if node[_KEEP]:
                words = self.words
                if e.tag == "script":
                    text = self.code or ""
                elif len(words) == e.mark + 1:
                    text = words[-1]
                else:
                    text = "".join(words[e.mark :])
                node[_TEXT] = text.strip()

    def _imply_ends(self, ended: tuple[str, ...], fence: tuple[str, ...]) -> None:
        opened, places = self.open, self.places
        if not opened or opened[-1].tag in fence:
            return
        if opened[-1].tag in ended and len(opened) > 1 and opened[-2].tag in fence:
            self._end_last()
            return
        for name in ended:
            if places.get(name):
                break
        else:
            return
        wall = self._deepest(fence)
        cut = len(opened)
        for name in ended:
            at = places.get(name, ())
            inside = bisect_right(at, wall)
            if inside < len(at):
                cut = min(cut, at[inside])
        while len(opened) > cut:
            self._end_last()

    def _deepest(self, tags: tuple[str, ...]) -> int:
        """The place of the innermost open element among ``tags``, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def _start(self, tag: _Tag, leaf: bool) -> list | None:
        """Opens an element, unless its own end follows its text (``leaf``), and returns its node."""
        if tag.ends is not None:
            self._imply_ends(*tag.ends)
        if self.skeleton:
            self.shape.append(f"{tag.name}.{tag.css}")
        opened, name, pos = self.open, tag.name, self.count
        if opened:
            parent = opened[-1]
            table, row, section = parent.table, parent.row, parent.section
        else:
            parent = table = row = section = None
        if name == "td" or name == "th":
            if row is not None:
                row.cols += 1
        elif name == "tr":
            if table is not None:
                row = _Row(len(table.rows))
                table.rows.append(row)
        elif name == "table":
            table, row, section = _Table(len(self.tables), tag, self.rows), None, None
            self.tables.append(table)
        elif name == "thead" or name == "tbody" or name == "tfoot":
            section = name
        node = None
        if tag.node is not None:
            node = tag.node.copy()
            node[_POS] = node[_LAST] = pos
            node[_SECTION] = section
            if table is not None:
                node[_TABLE_NO], node[_TABLE_ID], node[_TABLE_CLASSES] = table.no, table.id, table.classes
            if row is not None:
                node[_ROW_NO] = row.no
                if row.cols:
                    node[_COL_NO] = row.cols - 1
                if name == "tr":
                    row.node = node
                elif name == "td":
                    row.cells.append(node)
                elif name == "th":
                    (table.thead if section == "thead" else table.ths).append(node)
                if tag.item:
                    row.items.append(node)
            if not (tag.structure and self.rows is not None and (name == "td" or name == "th" or table is None or not table.read)):
                self.out.append(node)
            if parent is not None:
                node[_PARENT] = parent.pos
                if parent.children is None:
                    parent.children = [node]
                else:
                    parent.children.append(node)
        self.count = pos + 1
        if leaf or tag.void:
            return node
        here = _Open()
        here.tag, here.pos, here.node, here.mark, here.children = name, pos, node, len(self.words), None
        here.table, here.row, here.section = table, row, section
        if name in self.places:
            self.places[name].append(len(opened))
        else:
            self.places[name] = [len(opened)]
        opened.append(here)
        return node

    def _fill_tables(self) -> None:
        for table in self.tables:
            heads = [th[_TEXT] or "" for th in (table.thead or table.ths)]
            for row in table.rows:
                if heads:
                    for cell in row.cells:
                        at = cell[_COL_NO]
                        cell[_HEAD] = heads[at] if at < len(heads) else None
                if table.read:
                    node = row.node
                    node[_HEADS], node[_CELLS], node[_ITEMS] = heads, [c[_TEXT] or "" for c in row.cells], row.items

    def _end(self, tag: str) -> None:
        if self.open and self.open[-1].tag == tag:
            self._end_last()
            return
        at = self._deepest((tag,))
        if at >= 0 and at >= self._deepest(("table",) if tag in TABLE_PARTS else ("table", "td", "th")):
            while len(self.open) > at:
                self._end_last()


_MAP = pa.map_(pa.string(), pa.string())
_ITEM = pa.struct(
    [("col_no", pa.int32()), ("tag", pa.string()), ("classes", pa.list_(pa.string())), ("text", pa.string()),
     ("href", pa.string()), ("attrs", _MAP)]
)
_NODE_TYPES = {
    "pos": pa.int32(), "parent": pa.int32(), "last": pa.int32(), "parent_last": pa.int32(),
    "classes": pa.list_(pa.string()), "table_classes": pa.list_(pa.string()),
    "table_no": pa.int32(), "row_no": pa.int32(), "col_no": pa.int32(), "attrs": _MAP,
    "heads": pa.list_(pa.string()), "cells": pa.list_(pa.string()), "items": pa.list_(_ITEM),
}
_ITEMS_TYPE = _NODE_TYPES["items"]
_FLUSH_NODES = 16384


def _lists(column: Sequence, kind: pa.DataType) -> pa.Array:
    """Lists of strings, items or pairs, or nulls, as one array: what they hold is laid out at once."""
    offsets, held, size = [], [], 0
    for value in column:
        if value is None:
            offsets.append(None)
        else:
            offsets.append(size)
            if value:
                held += value
                size = len(held)
    offsets.append(size)
    if kind == _MAP:
        keys, values = zip(*held, strict=True) if held else ((), ())
        return pa.MapArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys, pa.string()), pa.array(values, pa.string()))
    if kind == _ITEMS_TYPE:
        columns = [*zip(*held, strict=True)] if held else [()] * 21
        values = pa.StructArray.from_arrays([_column(columns[NODE_FIELDS.index(f.name)], f.type) for f in _ITEM], fields=list(_ITEM))
    else:
        values = pa.array(held, pa.string())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _column(column: Sequence, kind: pa.DataType) -> pa.Array:
    return _lists(column, kind) if pa.types.is_nested(kind) else pa.array(column, kind)


def _pack(source: pa.RecordBatch, kept: list[str], docs: list[list[list]], fields: frozenset[str]) -> pa.RecordBatch:
    """The documents of a slice of the input batch beside its carried columns."""
    flat = [node for nodes in docs for node in nodes]
    offsets = [0]
    for nodes in docs:
        offsets.append(offsets[-1] + len(nodes))
    given = [*zip(*flat, strict=True)] if flat else [()] * len(NODE_FIELDS)
    columns = []
    for at, name in enumerate(NODE_FIELDS):
        kind = _NODE_TYPES.get(name, pa.string())
        columns.append(_column(given[at], kind) if name in fields else pa.nulls(len(flat), kind))
    nodes = pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, names=NODE_FIELDS)
    )
    carried = [source.column(i) for i in range(len(kept))]
    return pa.RecordBatch.from_arrays([*carried, nodes], names=[*kept, "nodes"])


def html_documents(
    df: DataFrame,
    key: str = "capture_id",
    body: str = "body",
    *,
    classes: tuple[str, ...] = (),
    ids: tuple[str, ...] = (),
    carry: tuple[str, ...] = (),
    skeleton: bool = False,
    fields: tuple[str, ...] = NODE_FIELDS,
    tables: tuple[str, ...] = (),
    rows: tuple[str, ...] | None = None,
) -> DataFrame:
    """``(key, *carry, nodes)`` per body: tables, rows, cells, links, images, scripts, titles.

    ``classes`` and ``ids`` name further elements to keep with their text;
    ``skeleton`` adds one ``#document`` node holding the ordered ``tag.class``
    list. ``fields`` names the node fields a plan reads (others are null) and ``tables``
    the classes or ids of the tables it reads: nodes inside other tables then stay behind. ``rows``
    names the tables whose rows it reads, cell by cell from their ``tr`` nodes: other ``table`` and
    ``tr`` nodes and all cells that no class, id or attribute makes nodes then stay behind. Only
    the key, the body and the ``carry`` columns (provenance such as ``fetched_at``) cross into
    Python: column pruning does not reach through the Python operator. Bodies are parsed where they are read; nothing is shuffled.
    """
    kept = [key, *carry]
    narrow = df.select(*kept, F.col(body).alias("_body"))
    types = ", ".join(f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in kept)
    by_class, by_id, wanted, read = frozenset(classes), frozenset(ids), frozenset(fields), frozenset(tables)
    by_row = None if rows is None else frozenset(rows)

    def within(node: list) -> bool:
        return node[_TABLE_NO] is None or node[_TABLE_ID] in read or not read.isdisjoint(node[_TABLE_CLASSES])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _Nodes(by_class, by_id, skeleton, by_row)
        collected = gc.isenabled()
        for batch in batches:
            if batch.column(len(kept)).null_count:  # a filter ahead would spell a computed body once more
                batch = batch.filter(batch.column(len(kept)).is_valid())
            start, size, docs = 0, 0, []
            gc.disable()  # nodes hold no cycles, and there are too many to look them through again and again
            try:
                for at in range(batch.num_rows):
                    nodes = parser.parse(batch.column(len(kept))[at].as_py())
                    docs.append([n for n in nodes if within(n)] if read else nodes)
                    size += len(docs[-1])
                    if size >= _FLUSH_NODES or at + 1 == batch.num_rows:
                        yield _pack(batch.slice(start, len(docs)), kept, docs, wanted)
                        start, size, docs = at + 1, 0, []
            finally:
                if collected:
                    gc.enable()

    return narrow.mapInArrow(parse, f"{types}, nodes array<struct<{NODE_DDL}>>")


# ---------------------------------------------------------------- node expressions


def has_class(classes: Column, name: str) -> Column:
    """Whether a class list holds the class ``name``."""
    return F.coalesce(F.array_contains(classes, name), F.lit(False))


def within(node: Column, element: Column) -> Column:
    """Whether a node lies inside an element, given that element's ``pos`` and ``last``."""
    return (node["pos"] > element["pos"]) & (node["pos"] <= element["last"])


def nodes_of(docs: DataFrame, *keep: str, test=None) -> DataFrame:
    """Nodes as rows, with the key columns of the documents (all, or ``keep``).

    ``test`` of a node selects inside the array, before nodes become rows.
    """
    keys = keep or [c for c in docs.columns if c != "nodes"]
    return struct_rows(docs, list(keys), "nodes" if test is None else F.filter("nodes", test))


def first_text(nodes: Column, test) -> Column:
    """Text of the first node passing ``test``; null when there is none."""
    return F.get(F.filter(nodes, test), F.lit(0))["text"]


def x_html_cells(docs: DataFrame) -> DataFrame:
    """Table cells with their table, place, header label and display."""
    rows = nodes_of(docs, test=lambda n: n["tag"].isin("td", "th") & n["col_no"].isNotNull())
    return rows.drop("heads", "cells", "items", "href", "id", "parent", "last", "parent_last")


def x_html_links(docs: DataFrame) -> DataFrame:
    """Anchors, images and references with their place in the document."""
    rows = nodes_of(docs, test=lambda n: n["tag"].isin("a", "img", "link", "use"))
    return rows.drop("heads", "cells", "items", "head", "section")


def x_fingerprint(docs: DataFrame) -> DataFrame:
    """SHA-256 of each document's tag and class skeleton; no values enter it."""
    keys = [c for c in docs.columns if c != "nodes"]
    skeleton = first_text(F.col("nodes"), lambda n: n["tag"] == "#document")
    return docs.select(*keys, F.sha2(skeleton, 256).alias("fingerprint"))


def x_links_fast(df: DataFrame, key: str, body: str) -> DataFrame:
    """Plain anchors straight from the text, JVM-side: href and tag-free text.

    For bodies whose anchors are double-quoted and not nested; the full parser
    handles everything else.
    """
    pattern = r'<a\s+[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
    found = F.arrays_zip(
        F.regexp_extract_all(F.col(body), F.lit(pattern), F.lit(1)).alias("href"),
        F.regexp_extract_all(F.col(body), F.lit(pattern), F.lit(2)).alias("text"),
    )
    return array_rows(df, [key], found, "link_no", "link").select(
        key,
        "link_no",
        F.col("link.href").alias("href"),
        F.regexp_replace(F.col("link.text"), "<[^>]*>", "").alias("text"),
    )


def register_html_cells(spark: SparkSession, name: str = "html_cells") -> None:
    """The cell relation as a table function: ``FROM captures, LATERAL html_cells(body)``."""

    @F.udtf(returnType="table_no int, row_no int, col_no int, head string, text string")
    class HtmlCells:
        def eval(self, body: str):
            for n in _Nodes(frozenset(), frozenset(), False).parse(body or ""):
                if n[_TAG] in ("td", "th") and n[_COL_NO] is not None:
                    yield n[_TABLE_NO], n[_ROW_NO], n[_COL_NO], n[_HEAD], n[_TEXT]

    spark.udtf.register(name, HtmlCells)
