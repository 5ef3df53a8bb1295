"""Pages of plain markup are read without the standard tokenizer, and their texts are made once."""

from __future__ import annotations

import random
from html.parser import HTMLParser

import pytest

from lexiframe.functions import html
from lexiframe.operators import pages

FIELD = (
    '<html><head><title> c1 </title></head><BODY><table><tr><td>nav&nbsp;&bogus;</td></tr></table>'
    "<table><tr><td>Label:</td><td>A  b</td></tr></table>"
    '<table><tr><td>Indexes:</td><td><a class="x" HREF="k.htm" >k-1</a><a href="">none</a></td></tr></table>'
    "<table><tr><td>Description:</td></tr><tr><td>d  1</td></tr></table></BODY></html>"
)
PIECES = [
    "<table>", "</table>", "<tr>", "</tr>", "<td >", "<td>", "</td>", "</ td>", "</td >", '<a href="x.htm">',
    "<A HREF='y'>", '<a href="a&amp;b">', "<a href>", "</a>", "<title>", "</TITLE>", "<titles>", "<title x>", " t ",
    "é\n", "&amp;", "&lt", "&#38;", "&bogus;", "&", "<", ">", "<!-- c -->", "<!doctype html>", "<br/>", "<br>",
    "<p\xa0x>", '<td\x0bx="1">', '<td a="1"b="2">', '<td a="1" A="2">', "<script>", "</script>", "<SCRIPT>",
    "<textarea>", "</textarea>", "<pre>", "</pre>", "<rt>", "</rt>", "<xmp>", "</xmp>", "<?x?>", "<![CDATA[q]]>",
    "<a", "</", "<1", "&a-b;", "\x00",
]


class StandardReader(html._PageReader):
    def _read_plain(self, source: str) -> str:
        return source


def test_plain_pages_need_no_standard_tokenizer(monkeypatch):
    expected = StandardReader().read(FIELD)

    def refuse(self, end):
        raise AssertionError("standard tokenizer")

    monkeypatch.setattr(HTMLParser, "goahead", refuse)
    assert html._PageReader().read(FIELD) == expected
    assert expected["title"] == "c1" and expected["hrefs"] == ["k.htm"]
    with pytest.raises(AssertionError):
        html._PageReader().read(FIELD + "<!-- other -->")


def test_any_markup_is_read_as_the_standard_parser_reads_it():
    dice = random.Random(11)
    for _ in range(20_000):
        source = "".join(dice.choice(PIECES) for _ in range(dice.randint(0, 14)))
        assert html._PageReader().read(source) == StandardReader().read(source), source


def test_texts_of_a_page_are_made_once(spark):
    frame = spark.createDataFrame(
        [("c1.htm", FIELD, None), ("none.htm", None, None)], "path string, html string, error string"
    )
    notes = pages.annotate_pages(frame)
    plan = notes._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(".tables, 1)") == 1
    found = {row["path"]: row for row in notes.collect()}
    assert (found["c1.htm"]["label"], found["c1.htm"]["description"], found["c1.htm"]["indexes"]) == ("A b", "d 1", ["k-1", "none"])
    # A page that could not be read keeps its row, with empty texts.
    assert (found["none.htm"]["label"], found["none.htm"]["content"], found["none.htm"]["indexes"]) == ("", "", [])
