"""Page reading and extraction on hand-made pages."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from lexiframe.operators import pages
from lexiframe.sources.pages import decode_index_pages, decode_pages, module_pages, resolve_pages


def page(spark, html):
    return pages.shred(spark.createDataFrame([("p.htm", html)], "filename string, html string"))


def table(*rows):
    return "<table>" + "".join(f"<tr><td>{row}</td></tr>" for row in rows) + "</table>"


def test_bytes(spark):
    files = spark.createDataFrame(
        [
            ("d/a.htm", "é€\r\nx\ry".encode()),
            ("d/b.htm", b"caf\xe9 \x80\x92"),
            ("d/c.htm", b"\xe9\x81"),
            ("d/d.htm", b"plain"),
        ],
        "path string, content binary",
    )
    rows = {row.filename: row for row in decode_pages(files).collect()}
    assert rows["a.htm"].html == "é€\nx\ny"
    assert rows["b.htm"].html == "café €’"
    assert rows["c.htm"].html is None and rows["c.htm"].error
    assert rows["d.htm"].error is None
    index = {row.filename: row.html for row in decode_index_pages(files).collect()}
    assert index["b.htm"] == "café \x80\x92"


def test_module_pages(spark):
    names = ["Taxtbl.htm", "taxtbl.htm", "XL_stringtbl.htm", "Taxtbl.html", "Tax.htm"]
    frame = spark.createDataFrame([(name,) for name in names], "filename string")
    assert [row.filename for row in module_pages(frame).collect()] == ["Taxtbl.htm"]


def test_titles_links_and_hidden_text(spark):
    html = (
        "<!-- <title>no</title> --><TITLE> a &amp; <b>b</b> </TITLE><script>'<a href=\"s.htm\">'</script>"
        '<a href="x/One.HTM">1</a><a name="n">2</a><a href="">3</a><a href="t.htm#top">4</a>'
        "<a HREF='./a//b.htm'>5</a><a href=/root.htm>6</a><a href='?q=1&amp;r.htm'>7</a>"
    )
    shredded = page(spark, html)
    assert pages.page_titles(shredded).first().title == "a &b"
    links = pages.page_links(shredded, "help").orderBy("link_pos").collect()
    assert [(row.link_name, row.link_path) for row in links] == [
        ("One.HTM", "help/x/One.HTM"),
        ("b.htm", "help/a/b.htm"),
        ("root.htm", "/root.htm"),
        ("?q=1&r.htm", "help/?q=1&r.htm"),
    ]
    assert pages.page_titles(page(spark, "<p>x</p>")).first().title == ""


def test_rows_follow_the_tree(spark):
    html = (
        "<table><tr><td>a<table><tr><td>in</td></tr></table></td></tr><tr><td>b<td>c</table>"
        "<tr><td>loose<br>x</td></tr></p>"
    )
    rows = pages.page_rows(page(spark, html)).orderBy("row_no").collect()
    assert [row.in_table for row in rows] == [[0], [0, 1], [0], []]
    assert [row.row_text for row in rows] == ["ain", "in", "bc", "loosex"]
    assert [[cell.joined for cell in row.cells] for row in rows] == [
        ["ain", "in"], ["in"], ["bc", "c"], ["loosex"],
    ]


def test_sections_stop_at_a_blank_row_and_may_leave_the_table(spark):
    link = '<a href="{}.htm">x</a>'
    html = table("Indexes", link.format("i1")) + table(link.format("i2"), " \xa0 ", link.format("i3"))
    found = pages.table_sections(page(spark, html)).first()
    assert found.index_hrefs == ["i1.htm", "i2.htm"] and found.field_hrefs == []
    html = table("Indexes", link.format("i1"), "Field", link.format("f1"))
    found = pages.table_sections(page(spark, html)).first()
    assert found.index_hrefs == ["i1.htm", "f1.htm"] and found.field_hrefs == ["f1.htm"]
    html = table("x") + table("Indexes", link.format("i1"))
    assert pages.table_sections(page(spark, html)).first().index_hrefs == []


def test_triggers_run_to_the_end(spark):
    html = table("Triggers:", "a</td><td> </td><td> b ", " ") + table("c")
    assert pages.table_triggers(page(spark, html)).first().triggers == [["a", "b"], ["c"]]


def test_metadata_comes_from_the_second_table(spark):
    html = (
        table("Label:</td><td>no")
        + table("LABEL :</td><td>x", "Label:</td><td> <b>A</b> b ", "Other:</td><td>y", "Type:")
        + table("Indexes: <a>i 1</a><a> </a><a href='q'>i2</a>")
        + table("Indexes: <a>late</a>")
    )
    shredded = page(spark, html)
    found = pages.field_metadata(shredded).first()
    assert found.label == "Ab" and found.type == ""
    assert pages.field_indexes(shredded).first().indexes == ["i 1", "i2"]


def brute_sections(texts):
    """The sections by walking over the rows, as a reader of the page would."""
    section, lines, out = None, [], {"d": "", "c": ""}
    for text in texts:
        if "Description:" in text:
            section, lines = "d", []
        elif "Content:" in text:
            if section == "d":
                out["d"] = "\n".join(lines) or out["d"]
                lines = []
            section = "c"
        elif section and text:
            lines.append(text)
    if section:
        out[section] = "\n".join(lines) or out[section]
    return out["d"], out["c"]


def test_description_and_content_in_any_order(spark):
    chance = random.Random(3)
    cases = [
        [chance.choice(["Description:", "Content:", "a Content: b", "one", "two", "", "Description: Content:"]) for _ in range(chance.randint(0, 9))]
        for _ in range(400)
    ]
    rows = [(str(at), table("nav") + table(*texts)) for at, texts in enumerate(cases)]
    frame = pages.shred(spark.createDataFrame(rows, "filename string, html string"))
    got = {row.filename: (row.description, row.content) for row in pages.field_sections(frame).collect()}
    wrong = [(c, got[str(at)]) for at, c in enumerate(cases) if got[str(at)] != brute_sections(c)]
    assert wrong[:3] == []


def test_whole_annotation(spark):
    html = table("nav") + table("Label:</td><td>Café \n x") + table("Description:", "a \t b\n\n c", "Content:")
    frame = spark.createDataFrame([("f.htm", html)], "filename string, html string")
    found = pages.annotate_pages(frame).first()
    assert found.label == "Café x" and found.description == "a b\nc" and found.content == ""


def test_index_page_flags_and_fields(spark):
    html = (
        "<p>Primary</p><p>primary: perhaps</p><p>PRIMARY KEY: Yes</p><p>Unique: no</p><p>Unique: yes</p>"
        "<p>Word</p>: yes<table><tr><td>٣</td><td>c</td><td>Asc</td><td>no</td></tr>"
        "<tr><td>²</td><td>c</td><td>Asc</td><td>no</td></tr><tr><td>1</td><td>c</td><td>x</td></tr></table>"
    )
    found = pages.index_pages(page(spark, html)).first()
    assert (found.is_primary, found.is_unique, found.is_word) == (True, False, None)
    assert [tuple(field) for field in found.fields] == [(3, "c", "Asc", "no")]


def test_lost_paths_fall_back_to_the_folder(spark):
    corpus = spark.createDataFrame([("h/a.htm",), ("old/b.htm",)], "path string")
    links = spark.createDataFrame(
        [("x/a.htm", "old/a.htm"), ("b.htm", "old/b.htm"), ("c.htm", None), ("a.htm", "")],
        "filename string, path string",
    )
    got = {row.filename: row.resolved for row in resolve_pages(links, corpus, "h/").collect()}
    assert got == {"x/a.htm": "h/a.htm", "b.htm": "old/b.htm", "c.htm": None, "a.htm": "h/a.htm"}
    assert resolve_pages(links.limit(0), corpus, "h").filter(F.lit(True)).count() == 0
