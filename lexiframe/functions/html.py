"""The Arrow helper that turns a page into its rows, cells, links and tables.

Spark has no lenient HTML reader, so this one step runs in Python. It only records what the page
holds; every rule about the records is a Spark expression.
"""

from __future__ import annotations

import html
import re
import sys
import unicodedata
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from lexiframe.constants import HIDDEN_TEXT_TAGS, PREFORMATTED_TAGS, VOID_TAGS

# The helpers travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TEXT = pa.string()
_CELL = pa.struct([("text", _TEXT), ("joined", _TEXT)])
_ROW = pa.struct(
    [
        ("tables", pa.list_(pa.int32())),
        ("text", _TEXT),
        ("joined", _TEXT),
        ("cells", pa.list_(_CELL)),
        ("hrefs", pa.list_(_TEXT)),
    ]
)
_TABLE = pa.struct([("first_text", _TEXT), ("links", pa.list_(_TEXT))])
_PAGE = pa.struct(
    [
        ("title", _TEXT),
        ("hrefs", pa.list_(_TEXT)),
        ("lines", _TEXT),
        ("tables", pa.list_(_TABLE)),
        ("rows", pa.list_(_ROW)),
    ]
)


# Markup that every version of the standard parser reads in one way. Its tokenizer takes most of
# the time of a page, so it gets only what comes from the first piece of other markup on. Elements
# whose content has rules of its own are other markup, and so is a title that is not plain text.
_OTHER = (
    r"(?!(?i:(?:iframe|noembed|noframes|noscript|plaintext|script|style|textarea|xmp)\b"
    r"|title(?!>[^<&]*</title>)))"
)
_ATTRIBUTE = r"[ \t\n\r\f]+[a-zA-Z][-a-zA-Z0-9]*=\"[^\"&<>]*\""
_PIECES = re.compile(
    r"([^<&]+)"
    r"|</([a-zA-Z][a-zA-Z0-9]*)>"
    rf"|<{_OTHER}([a-zA-Z][a-zA-Z0-9]*)((?:{_ATTRIBUTE})*)[ \t\n\r\f]*>"
    r"|&([a-zA-Z][a-zA-Z0-9]*);"
    r"|([<&](?s:.*))"
)
_ATTRIBUTES = re.compile(r"([a-zA-Z][-a-zA-Z0-9]*)=\"([^\"]*)\"")


class _Span:
    """Text pieces seen while an element of interest is open."""

    __slots__ = ("tag", "pieces", "cells", "links", "hrefs", "tables", "number")

    def __init__(self, tag: str) -> None:
        self.tag = tag
        self.pieces: list[str] = []
        self.cells: list[_Span] = []
        self.links: list[_Span] = []
        self.hrefs: list[str] = []
        self.tables: list[int] = []
        self.number = 0

    def text(self) -> str:
        return "".join(self.pieces)

    def joined(self, separator: str = "") -> str:
        return separator.join(filter(None, map(str.strip, self.pieces)))


class _PageReader(HTMLParser):
    TRACKED = frozenset(("table", "tr", "td", "a", "title"))

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.page = _Span("page")
        self.open: list[tuple[str, _Span | None]] = []
        self.spans: list[_Span] = [self.page]  # the tracked elements among the open ones
        self.hidden = self.preformatted = 0  # how many such elements are open
        self.buffer: list[str] = []
        self.tables: list[_Span] = []
        self.rows: list[_Span] = []
        self.title: _Span | None = None

    def _read_plain(self, source: str) -> str:
        """Handle the plain markup that the page begins with; returns the rest of the page."""
        for text, end, tag, attributes, entity, rest in _PIECES.findall(source):
            if text:
                self.buffer.append(text)
            elif end:
                self.handle_endtag(end.lower())
            elif tag:
                pairs = _ATTRIBUTES.findall(attributes) if attributes else ()
                self.handle_starttag(tag.lower(), [(name.lower(), value) for name, value in pairs])
            elif entity:
                self.handle_entityref(entity)
            else:
                return rest
        return ""

    def read(self, source: str) -> dict:
        if rest := self._read_plain(source):
            self.feed(rest)
            self.close()
        self._end_piece()
        return {
            "title": self.title.joined() if self.title else "",
            "hrefs": self.page.hrefs,
            "lines": self.page.joined("\n"),
            "tables": [
                {
                    "first_text": next(filter(None, map(str.strip, table.pieces)), ""),
                    "links": [text for link in table.links if (text := link.joined())],
                }
                for table in self.tables
            ],
            "rows": [
                {
                    "tables": row.tables,
                    "text": row.text(),
                    "joined": row.joined(),
                    "cells": [{"text": c.text(), "joined": c.joined()} for c in row.cells],
                    "hrefs": row.hrefs,
                }
                for row in self.rows
            ],
        }

    def _spans(self, tag: str) -> list[_Span]:
        return [span for span in self.spans if span.tag == tag]

    def _end_piece(self) -> None:
        if not self.buffer:
            return
        piece = "".join(self.buffer)
        self.buffer.clear()
        if self.hidden:
            return
        if not self.preformatted and not piece.strip(" \n\t\f\r"):
            piece = "\n" if "\n" in piece else " "
        for span in self.spans:
            span.pieces.append(piece)

    def _count(self, tag: str, step: int) -> None:
        if tag in HIDDEN_TEXT_TAGS:
            self.hidden += step
        elif tag in PREFORMATTED_TAGS:
            self.preformatted += step

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.buffer:
            self._end_piece()
        span = _Span(tag) if tag in self.TRACKED else None
        if tag == "tr":
            span.tables = [table.number for table in self._spans("table")]
            self.rows.append(span)
        elif tag == "td":
            for row in self._spans("tr"):
                row.cells.append(span)
        elif tag == "table":
            span.number = len(self.tables)
            self.tables.append(span)
        elif tag == "title" and self.title is None:
            self.title = span
        elif tag == "a":
            for table in self._spans("table"):
                table.links.append(span)
            if href := dict(attrs).get("href"):
                self.page.hrefs.append(href)
                for row in self._spans("tr"):
                    row.hrefs.append(href)
        if tag not in VOID_TAGS:
            self.open.append((tag, span))
            if span is not None:
                self.spans.append(span)
            else:
                self._count(tag, 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.buffer:
            self._end_piece()
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                for name, span in self.open[depth:]:
                    if span is not None:
                        self.spans.remove(span)
                    else:
                        self._count(name, -1)
                del self.open[depth:]
                return

    def updatepos(self, start: int, end: int) -> int:
        return end  # line numbers are not needed

    def handle_data(self, data: str) -> None:
        self.buffer.append(data)

    def handle_entityref(self, name: str) -> None:
        decoded = html.entities.html5.get(f"{name};")
        self.buffer.append(f"&{name}" if decoded is None else decoded)

    def handle_charref(self, name: str) -> None:
        self.buffer.append(html.unescape(f"&#{name};"))

    def unknown_decl(self, data: str) -> None:
        self._end_piece()
        if data.upper().startswith("CDATA["):
            self.buffer.append(data[len("CDATA[") :])
            self._end_piece()

    def handle_comment(self, data: str) -> None:
        self._end_piece()

    def handle_decl(self, decl: str) -> None:
        self._end_piece()

    def handle_pi(self, data: str) -> None:
        self._end_piece()


@F.arrow_udf(from_arrow_type(_PAGE))
def _read_page(pages: pa.Array) -> pa.Array:
    sources = pages.to_pylist()
    return pa.array([None if s is None else _PageReader().read(s) for s in sources], type=_PAGE)


def read_page(source: Column) -> Column:
    return _read_page(source)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _compose(values: pa.Array) -> pa.Array:
    return pa.array(
        [
            None if row is None else [text and unicodedata.normalize("NFC", text) for text in row]
            for row in values.to_pylist()
        ],
        type=pa.list_(_TEXT),
    )


def compose(*values: Column) -> Column:
    """Values as one array in Unicode form NFC; rows that are ASCII skip Python."""
    packed = F.array(*values)
    wide = F.exists(packed, lambda text: text.rlike(r"[^\x00-\x7f]"))
    return F.coalesce(_compose(F.when(wide, packed)), packed)


@F.arrow_udf(T.StringType())
def _unescape(values: pa.Array) -> pa.Array:
    return pa.array([text and html.unescape(text) for text in values.to_pylist()], type=_TEXT)


def unescape(text: Column) -> Column:
    """Decode character references; rows without `&` send no text to Python."""
    return F.coalesce(_unescape(F.when(F.contains(text, F.lit("&")), text)), text)
