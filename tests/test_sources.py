"""Documents, files and whole jobs."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from lexiframe.operators import dictionary, source_model
from lexiframe.plans.corpus import corpus_to_relational, key_report
from lexiframe.plans.storage import stored, write_json
from lexiframe.sources import csv_blocks, documents


def texts(spark, *values):
    return spark.createDataFrame(
        [(f"d{at}", v if isinstance(v, str) else json.dumps(v)) for at, v in enumerate(values)],
        "path string, text string",
    )


def test_repeated_json_keys_keep_last_value_and_first_place(spark):
    doc = (
        '{"modules":{"A":{"title":"x","tables":{}},"B":{"tables":{"t":{"title":"one"},"u":{"title":"u"},'
        '"t":{"title":"two","fields":[["f.htm","p/f.htm"],["only"]]}}},"A":{"code":"A","tables":{"z":{}}}}}'
    )
    rows = documents.json_dictionary(texts(spark, doc)).orderBy("module_pos", "table_pos").collect()
    assert [(r.module_code, r.module_pos, r.table_name, r.table_pos, r.title) for r in rows] == [
        ("A", 0, "z", 0, None), ("B", 1, "t", 0, "two"), ("B", 1, "u", 1, "u"),
    ]
    assert [tuple(link) for link in rows[1].fields] == [("f.htm", "p/f.htm"), ("only", None)]


def test_annotations(spark):
    fields = {
        "parcel_weightkg": {"label": "Weight kg", "description": "Description: gross weight", "help": "as weighed", "content": "Content: 1 = boxed", "indexes": ["k", " "]},
        "WEIGHTKG.x": {"label": "later"},
    }
    first = {"modules": {"LG": {"code": "LG", "tables": {"parcel": {"title": "  ", "fields": fields, "indexes": [
        {"name": "K", "primary": True, "unique": False, "fields": [{"name": "A"}, {"name": "B"}]}, ["x/PARCEL_k2.htm"], ["parcel_K3.htm", "p"], []]}}}}}
    second = {"modules": {"X": {"tables": {"csd_parcel": {"title": "PARCEL - Parcel Data", "fields": {"other": {}}}}}}}
    docs = texts(spark, first, second)
    (table,) = source_model.annotation_tables(documents.json_tables(docs)).collect()
    assert (table.table_code, table.warehouse_table_name, table.label) == ("parcel", "csd_parcel", "Parcel Data")
    assert table.source_ref == "d0:modules.LG.parcel"
    assert table.description == (
        "Legacy Data Dictionary Entries:\n\nPrimary Key:\nk: a, b\n\n"
        "Indexes:\nk (primary): a, b\nparcel_k2: unknown\nk3: unknown"
    )
    columns = {r.column_name: r for r in source_model.annotation_columns(documents.json_fields(docs)).collect()}
    assert set(columns) == {"weightkg", "other"}
    assert columns["weightkg"].label == "later" and columns["weightkg"].description is None
    only = texts(spark, {"modules": {"M": {"code": "M", "tables": {"parcel": {"fields": {"a": fields["parcel_weightkg"]}}}}}})
    (column,) = source_model.annotation_columns(documents.json_fields(only)).collect()
    assert column.description == (
        "Legacy Data Dictionary Entries:\n\nDescription:\ngross weight\n\nHelp:\nas weighed\n\nContent:\n1 = boxed"
        "\n\nIndexes:\nk"
    )
    assert column.content == "1 = boxed" and column.source_ref == "d0:modules.M.parcel.a"


def test_relational_source(spark):
    tables = spark.createDataFrame([("parcel", "PARCEL - Parcel Data"), ("bare", None)], "table_id string, table_title string")
    fields = spark.createDataFrame(
        [(1, "parcel", "parcel_weightkg", "Weight kg", "", "Description: gross weight", ""), (2, "lost", "x", "", "", "", "")],
        "id int, table_id string, field_name string, label string, help string, description string, content string",
    )
    indexes = spark.createDataFrame(
        [(1, "parcel", "k-parcel", 1, 1, 0)], "id int, table_id string, index_name string, is_primary int, is_unique int, is_word int"
    )
    parts = spark.createDataFrame([(1, 2, "parcelno"), (1, 1, "branchno")], "index_id int, field_sequence int, field_name string")
    got = {r.table_code: r for r in source_model.relational_tables(tables, indexes, parts, path="m").collect()}
    assert got["parcel"].description == (
        "Legacy Data Dictionary Entries:\n\nPrimary Key:\nk-parcel: branchno, parcelno\n\n"
        "Indexes:\nk-parcel (primary, unique): branchno, parcelno"
    )
    assert got["parcel"].label == "Parcel Data" and got["bare"].description is None
    (column,) = source_model.relational_columns(fields, tables, path="m").collect()
    assert column.description == "Legacy Data Dictionary Entries:\n\nDescription:\ngross weight"
    assert column.source_ref == "m:fields:parcel.parcel_weightkg" and column.help is None
    plain = source_model.relational_tables(tables).select("description").distinct().collect()
    assert plain[0].description is None


def test_csv_files(spark, tmp_path):
    head = "table_code,table_label,table_description,column_name,column_label,column_description\n"
    (tmp_path / "a.csv").write_text(
        "﻿" + head + 'parcel,,,weightkg,"Weight\nkg","Description: say ""hi"""\n\n,x,y,z,,\n'
        "CSD_PARCEL,PARCEL - Parcel,About,branchno,Branch code,\nparcel,Later,,parcel_branchno,Branch,no\n",
        encoding="utf-8",
    )
    (tmp_path / "b.csv").write_text(head + "other,Other,,a,A,\n", encoding="utf-8")
    records = csv_blocks.read_csv(spark, str(tmp_path))
    assert sorted(r.record_no for r in records.collect()) == [1, 1, 2, 3, 4]
    tables = {r.table_code: r for r in source_model.csv_tables(records).collect()}
    assert tables["parcel"].label == "PARCEL - Parcel" and tables["parcel"].description == "About"
    assert tables["parcel"].source_ref.endswith("a.csv:2") and tables["other"].source_ref.endswith("b.csv:2")
    columns = {(r.table_code, r.column_name): r for r in source_model.csv_columns(records).collect()}
    assert set(columns) == {("parcel", "weightkg"), ("parcel", "branchno"), ("other", "a")}
    assert columns["parcel", "weightkg"].label == "Weight kg"
    assert columns["parcel", "weightkg"].description == 'say "hi"'
    assert columns["parcel", "branchno"].label == "Branch" and columns["parcel", "branchno"].source_ref.endswith("a.csv:5")


def test_csv_files_name_their_own_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("table_code,column_name,column_label\nt,a,A\n")
    (tmp_path / "b.csv").write_text("column_name,extra,table_code\nb,x,u\n")
    (tmp_path / "c.csv").write_text("table_code\n")
    rows = csv_blocks.read_csv(spark, str(tmp_path)).select("table_code", "column_name", "column_label").collect()
    assert sorted(map(tuple, rows)) == [("t", "a", "A"), ("u", "b", None)]


def test_index_flags_of_any_spelling(spark):
    entry = {"name": "k", "primary": "yes", "unique": 1, "word": False, "fields": [{"sequence": "2", "name": "a"}, {"sequence": 3, "name": "b"}]}
    frame = spark.createDataFrame([([json.dumps(entry)], "t")], "e array<string>, c string")
    (index,) = frame.select(source_model.json_indexes(F.col("e"), F.col("c")).alias("i")).first().i
    assert (index.is_primary, index.is_unique, index.is_word) == (True, True, False)
    assert [f.field_sequence for f in index.fields] == [2, 3]


def test_long_csv_file_is_numbered_across_batches(spark, tmp_path):
    head = "table_code,column_name\n"
    for name, size in (("a.csv", 25_000), ("b.csv", 12_000)):
        (tmp_path / name).write_text(head + "".join(f"t,c{at}\n" for at in range(1, size + 1)))
    records = csv_blocks.read_csv(spark, str(tmp_path))
    wrong = records.filter(F.concat(F.lit("c"), "record_no") != F.col("column_name"))
    assert records.count() == 37_000 and wrong.count() == 0


def test_config_texts(spark):
    good = 'csd_active_source_tables:\n  ["csd_a", "b" ,\'CSD_C\'\n, "", d]\nother: [e]'
    rows = documents.active_tables(texts(spark, good, "csd_active_source_tables: ]", "none")).collect()
    assert sorted(r.table_code for r in rows if not r.error) == ["a", "b", "c", "d"]
    assert sorted(r.error for r in rows if r.error) == ["invalid list", "marker not found"]


def test_snapshots(spark):
    files = spark.createDataFrame(
        [("d", "old", "2024-01-01 00:00:00"), ("d", "new", "2024-01-02 12:00:00"), ("a", "x", "2024-01-01 00:00:00")],
        "kind string, path string, mtime string",
    ).withColumn("mtime", F.to_timestamp("mtime"))
    rows = documents.latest_snapshot(files, F.to_timestamp(F.lit("2024-01-03 00:00:00"))).collect()
    assert {r.kind: (r.path, r.is_fresh) for r in rows} == {"d": ("new", True), "a": ("x", False)}


def test_catalogue_presence_of_keys(spark):
    table = {"fullyQualifiedName": "f", "displayName": None, "columns": [{"name": "a", "description": None, "extra": {"b": 1}}, {}]}
    docs = texts(spark, table)
    row = documents.catalog_tables(docs).first()
    assert (row.has_display_name, row.has_description) == (True, False)
    first, second = documents.catalog_columns(docs).orderBy("ordinal").collect()
    assert (first.has_description, first.has_display_name) == (True, False)
    assert json.loads(first.raw)["extra"] == {"b": 1} and second.name == ""


def test_later_table_of_one_short_name_wins(spark):
    tables = spark.createDataFrame(
        [("M", "m", "x", 0, [("a.htm", "h/a.htm")]), ("M", "m", "xtbl", 1, [("b.htm", "h/b.htm"), ("b.html", "h/c.htm"), ("q.htm", "h/q.htm")])],
        "module_code string, module_title string, table_name string, table_pos int, fields array<struct<filename:string,path:string>>",
    )
    html = "<table></table><table><tr><td>Label</td><td>{}</td></tr></table>"
    pages = spark.createDataFrame(
        [(f"h/{n}.htm", f"{n}.htm", html.format(n), None) for n in "abc"], "path string, filename string, html string, error string"
    )
    links = dictionary.annotation_links(tables, pages)
    assert links.filter("found").count() == 3 and links.count() == 4
    rows = dictionary.annotate_fields(links).collect()
    assert {(r.field_name, r.label, r.field_pos) for r in rows} == {("b", "c", 0)}


def test_whole_corpus(spark, tmp_path):
    def row(*cells):
        return "<tr>" + "".join(f"<td>{cell}</td>" for cell in cells) + "</tr>"

    def link(name):
        return f'<a href="{name}">{name}</a>'

    pages = {
        "Taxtbl.htm": f"<title>Tax</title>{link('taxtbl.htm')}{link('losttbl.htm')}",
        "taxtbl.htm": "<title>TAX - Taxes</title><table>" + row("Indexes") + row(link("tax_k-1.htm")) + row("") + row("Field")
        + row(link("tax_branchno.htm")) + row(link("tax_transdttmz.htm")) + row("") + row("Triggers:") + row("Create", "p") + "</table>",
        "tax_branchno.htm": "<table></table><table>" + row("Label:", "Branch code") + "</table><table>" + row("Description:") + row("The branch") + "</table>",
        "tax_transdttmz.htm": "<table></table><table>" + row("Label:", "Stamp") + "</table>",
        "tax_k-1.htm": "<p>Primary: yes</p><p>Unique: yes</p><table>" + row("1", "branchno", "Ascending", "no") + "</table>",
    }
    for name, html in pages.items():
        (tmp_path / name).write_text(f"<html>{html}</html>", encoding="utf-8")
    model = corpus_to_relational(spark, str(tmp_path), "sxe")
    tables = {r.table_id: r for r in model["tables"].collect()}
    assert tables["tax"].table_name == "sxe.tax" and tables["tax"].table_title == "TAX - Taxes"
    assert tables["tax"].module_code == "TAX" and set(tables) == {"tax", "lost"}
    assert {r.field_name: r.label for r in model["fields"].collect()} == {"tax_branchno": "Branch code", "tax_transdttmz": "Stamp"}
    index = model["table_indexes"].first()
    assert (index.index_name, index.is_primary, index.is_unique, index.is_word) == ("k-1", 1, 1, None)
    counts = {r.key: r.value for r in model["metadata"].collect()}
    assert counts["fields_count"] == "2" and counts["modules_count"] == "1" and counts["tables_count"] == "2"
    report = {(r.table_name, r.list_name): r.column_name for r in key_report(model).collect()}
    assert report == {
        ("sxe.tax", "pk_columns"): "branchno", ("sxe.tax", "transaction_columns"): "transdttmz",
        ("sxe.lost", "pk_columns"): None, ("sxe.lost", "transaction_columns"): None,
    }
    full = key_report(model, simple=False).filter("table_name = 'sxe.tax'").first()
    assert full.has_primary_unique_key and full.has_transdttmz
    assert model["field_details"].count() == 2 and model["index_details"].count() == 1
    assert counts["schema_prefix"] == "sxe." and counts["generated_at"][:2] == "20"


def test_pages_of_any_case_folder_and_name(spark, tmp_path):
    def row(*cells):
        return "<tr>" + "".join(f"<td>{cell}</td>" for cell in cells) + "</tr>"

    def link(name):
        return f'<a href="{name}">{name}</a>'

    pages = {
        "Uptbl.htm": f"{link('uptbl.HTM')}{link('sub/bobtbl.htm')}",
        "uptbl.HTM": "<table>" + row("Indexes") + row(link("upk1.htm")) + row("") + row("Field") + row(link("sub/f.htm")) + "</table>",
        "sub/bobtbl.htm": "<title>Bob</title><table>" + row("Field") + row(link("f2.htm")) + "</table>",
        "sub/f.htm": "<table></table><table>" + row("Label:", "deep") + "</table>",
        "upk1.htm": "<p>Primary: no</p><table>" + row("1", "caf\xe9", "Descending", "no") + "</table>",
    }
    for name, html in pages.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(f"<html>{html}</html>".encode("latin-1"))
    model = corpus_to_relational(spark, str(tmp_path))
    assert {r.table_id: r.table_title for r in model["tables"].collect()} == {"up": "", "bob": "Bob"}
    assert [(r.table_id, r.label) for r in model["fields"].collect()] == [("up", "deep")]
    index = model["index_details"].first()
    assert (index.index_name, index.is_primary, index.field_name) == ("upk1", 0, "caf\xe9")


def test_json_sink_writes_nulls_and_plain_text(spark, tmp_path):
    write_json(spark.createDataFrame([("é", None)], "a string, b string"), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first().value == '{"a":"é","b":null}'
    assert stored(spark.range(3), "three").count() == 3
