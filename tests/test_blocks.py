"""JSON and CSV files cut into blocks at every place, against the standard library's readers."""

from __future__ import annotations

import csv
import io
import json
import random
from itertools import zip_longest

import pytest

from lexiframe.plans import loader
from lexiframe.schemas import CSV_COLUMNS
from lexiframe.sources import csv_blocks, documents, json_blocks


def blocks_of(text, separator, cuts):
    records = text.split(separator)
    if records[-1] == "":
        records.pop()
    edges = [0, *cuts(len(records)), len(records)]
    return [(a, records[a:b]) for a, b in zip(edges, edges[1:]) if b > a]


def read(module, reader, blocks):
    """Rows of all blocks, each begun in the state that the summaries before it give."""
    state, rows = module.START, []
    for at, values in blocks:
        own = reader("p", at, None if len(blocks) == 1 else json.loads(json.dumps(state)))
        own.feed(values[: len(values) // 2])
        own.feed(values[len(values) // 2 :])
        own.finish()
        rows += [row for batch in own.rows() for row in batch.to_pylist()]
        summary = module.Summary(at)
        summary.feed(values)
        summary.finish()
        state = module.advance(json.loads(json.dumps(state)), json.loads(json.dumps(summary.summary)))
    module.check("p", state)
    return rows


def json_members(blocks):
    found = {}
    for row in read(json_blocks, json_blocks.JsonReader, blocks):
        key = tuple(row[c] for c in ("kind", "module", "module_pos", "table", "table_pos", "key", "pos"))
        assert row["partial"] or key not in found
        found[key] = found.get(key, "") + row["text"] if row["text"] is not None else None
    return {key: text and json.loads(text) for key, text in found.items()}


class Pairs(list):
    pass


def plain(value):
    if isinstance(value, Pairs):
        return {key: plain(own) for key, own in value}
    return [plain(own) for own in value] if isinstance(value, list) else value


def expected_members(text):
    doc, found = json.loads(text, object_pairs_hook=Pairs), {}
    modules = dict(doc).get("modules") if isinstance(doc, Pairs) else None
    for mp, (module, members) in enumerate(modules if isinstance(modules, Pairs) else []):
        found["modules", module, mp, None, None, None, None] = None
        for at, (key, value) in enumerate(members if isinstance(members, Pairs) else []):
            if key != "tables":
                found["module", module, mp, None, None, key, at] = plain(value)
            for tp, (table, own) in enumerate(value if key == "tables" and isinstance(value, Pairs) else []):
                found["tables", module, mp, table, tp, None, None] = None
                for place, (name, entry) in enumerate(own if isinstance(own, Pairs) else []):
                    if name == "fields" and isinstance(entry, Pairs):
                        for fp, (field, content) in enumerate(entry):
                            found["field", module, mp, table, tp, field, fp] = plain(content)
                    else:
                        found["table", module, mp, table, tp, name, place] = plain(entry)
    return found


DOCUMENTS = [
    "{}", '{"a":1}\n', '{"modules":{}}', '{"modules":null}', '[{"modules":{"a":{}}}]', '{"modules":[{"a":{"tables":{"t":{"x":1}}}}]}',
    '{"x":{"modules":{"A":{"tables":{"t":{}}}}},"modules":{"A":{"code":"A","tables":{"t":{"fields":{"f":{"l":"l"},"g":{"l":"m"}}},"u":null}}}}',
    '{"modules":{"A}":{"co}de":"x}y","tables":{"t}":{"fields":{"a}b":{"l":"p}q}","n":{"z":[1,{"}":"}"}]}},"c":5,"d":"}","e":{}},'
    '"indexes":[{"name":"K","fields":[{"n":1},{"n":2}]},["x}"]]}},"title":{"a":{"b":{}}}},"B":{"tables":[{"t":{"q":1}}]},"C":7}}',
    '{"modules" : {"M":{"tables":{"t":{"fields":[["c1.htm","p}"],["x",{"y":1}]],"title":"\\"}\\\\"},"t":{"fields":"}x"},'
    '"k\\"}\\u0041":{"fields":{"\\"":{"a":"\\\\"},"\\\\":{"b":"}{"},"q":{"c":[]},"r":{"d":[[],{}]}}}}}}}\n\n',
]


def some_document(rng):
    def text():
        return "".join(rng.choice('ab{}[]",:\\ é') for _ in range(rng.randint(0, 4)))

    def value(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.4:
            return rng.choice([1, None, True, -2.5, text(), text()])
        if kind < 0.6:
            return [value(depth - 1) for _ in range(rng.randint(0, 3))]
        return {text(): value(depth - 1) for _ in range(rng.randint(0, 3))}

    def table():
        fields = {text(): value(2) for _ in range(rng.randint(0, 5))}
        return rng.choice([{"title": text(), "fields": fields, "indexes": value(2)}, {"fields": value(2)}, value(1)])

    def module():
        return rng.choice([{"code": text(), "tables": {text(): table() for _ in range(3)}, "title": text()}, value(2)])

    doc = {"modules": {text(): module() for _ in range(rng.randint(0, 3))}, "z": value(2)}
    return json.dumps(doc, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2]))


def ways_to_cut(rng):
    yield lambda n: []
    yield lambda n: range(1, n)
    for _ in range(4):
        yield lambda n: sorted(rng.sample(range(1, n), min(n - 1, 3))) if n > 1 else []


def test_json_cut_anywhere():
    rng = random.Random(1)
    for text in DOCUMENTS + [some_document(rng) for _ in range(150)]:
        cuts = [*ways_to_cut(rng), *[lambda n, c=c: [c] if c < n else [] for c in range(1, 40)]]
        for cut in cuts:
            assert json_members(blocks_of(text, "}", cut)) == expected_members(text)


@pytest.mark.parametrize("text", ['{"a":{"b":1}', '{"a":"x}', '{"a":1}}}'])
def test_json_that_is_not_whole_is_refused(text):
    for cut in (lambda n: [], lambda n: range(1, n)):
        with pytest.raises(ValueError):
            json_members(blocks_of(text, "}", cut))


def csv_rows(blocks):
    rows, pieces = {}, {}
    for row in read(csv_blocks, csv_blocks.CsvReader, blocks):
        if row["fragment"] is None:
            assert row["record_no"] not in rows
            rows[row["record_no"]] = [row[n] for n in CSV_COLUMNS]
        else:
            pieces.setdefault(row["record_no"], []).append((row["block"], row["fragment"], row["header"]))
    for number, own in pieces.items():
        assert number not in rows
        text = "".join(fragment for _, fragment, _ in sorted(own))
        found = dict(zip_longest(json.loads(own[0][2]), next(csv.reader(io.StringIO(text, newline="")))))
        rows[number] = [found.get(n) or None for n in CSV_COLUMNS]
    return rows


def expected_csv(text):
    text = text.removeprefix("﻿")
    whole = text if text.endswith("\n") else text + "\n"
    rows = [row for row in csv.reader(io.StringIO(whole, newline="")) if row]
    found = {}
    for number, row in enumerate(rows[1:], 1):
        own = dict(zip_longest([n.strip() for n in rows[0]], row))
        found[number] = [own.get(n) or None for n in CSV_COLUMNS]
    return found


def some_csv(rng):
    def cell():
        text = "".join(rng.choice(["a", "b", '"', ",", "\n", "\r\n", " ", "é", "\r"]) for _ in range(rng.randint(0, 5)))
        bare = "".join(c for c in text if c not in ",\r\n")
        kind = rng.random()
        return '"' + text.replace('"', '""') + '"' if kind < 0.5 else "a" + bare if kind < 0.6 else bare.replace('"', "")

    names = rng.sample(CSV_COLUMNS, rng.randint(1, 6)) + rng.choices(["x", 'a "q"', '"two\nlines"', "table_code"], k=rng.randint(0, 3))
    rng.shuffle(names)
    end = rng.choice(["\n", "\r\n"])
    text = rng.choice(["", "﻿"]) + rng.choice(["", "\n"]) + ",".join(names) + end
    for _ in range(rng.randint(0, 6)):
        text += ",".join(cell() for _ in range(rng.randint(1, len(names) + 1))) + rng.choice([end, end, end + end])
    return text + ('"open\n,x' if rng.random() < 0.2 else "")


def test_csv_cut_anywhere():
    rng = random.Random(2)
    for text in ["", "\n", "table_code\n", "table_code"] + [some_csv(rng) for _ in range(600)]:
        for cut in ways_to_cut(rng):
            blocks = blocks_of(text, "\n", cut)
            assert csv_rows(blocks) == expected_csv(text), text


def test_a_header_too_long_is_an_error_and_not_a_loss(monkeypatch):
    monkeypatch.setattr(csv_blocks, "MOST_HEADER", 20)
    with pytest.raises(ValueError):
        csv_rows(blocks_of('"' + "x" * 10 + "\n" + "y" * 30 + '",table_code\na,b\n', "\n", lambda n: range(1, n)))


@pytest.fixture
def block_size(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("size", [400, 1 << 26])
def test_json_files_in_blocks_of_any_size(spark, tmp_path, block_size, size):
    fields = {f"f{i}": {"label": f"l}}{i}", "indexes": ["k", {"a": i}]} for i in range(30)}
    table = {"title": "A", "fields": fields, "indexes": [{"name": "K", "fields": [{"name": "a"}]}, ["x}"]], "triggers": [["c", "p"]]}
    parts = [f'"f{i}":{json.dumps(f)}' for i, f in enumerate(fields.values())]
    repeated = '"f3":{"label":"old"},' + ",".join(parts)
    text = json.dumps({"modules": {"M": {"code": "c", "title": 7, "tables": {"t": table, "u": None}}}})
    again = text.replace(", ".join(f'"f{i}": {json.dumps(f)}' for i, f in enumerate(fields.values())), repeated)
    (tmp_path / "one.json").write_text(text)
    (tmp_path / "two.json").write_text(json.dumps({"modules": {"M": {"tables": {"old": {"title": "gone"}}}}})[:-2] + "," + again[again.index('"M"') :])
    (tmp_path / "no.txt").write_text("not read")
    block_size(size)
    members = json_blocks.read_members(spark, str(tmp_path))
    name = "regexp_extract(path, '[^/]*$', 0)"
    docs = spark.createDataFrame(
        [(p.name, p.read_text()) for p in sorted(tmp_path.glob("*.json"))], "path string, text string"
    )

    def rows(frame):
        named = frame.selectExpr(f"{name} AS file", "*").drop("path").toDF("path", *frame.drop("path").columns)
        return sorted(json.dumps(r.asDict(True), sort_keys=True) for r in named.collect())

    want_fields, want_tables = documents.json_fields(docs), documents.json_tables(docs)
    assert want_fields.count() == 60 and want_tables.count() == 4
    assert rows(json_blocks.field_rows(members)) == rows(want_fields.select(json_blocks.field_rows(members).columns))
    assert rows(json_blocks.table_rows(members)) == rows(want_tables.select(json_blocks.table_rows(members).columns))


@pytest.mark.parametrize("size", [300])
def test_dictionary_files_in_blocks(spark, tmp_path, block_size, size):
    table = {"filename": "t.htm", "title": "T", "fields": [["a.htm", "h/a.htm"], ["only"]], "indexes": [], "triggers": [["c", "p"]]}
    text = json.dumps({"modules": {"M": {"code": "M", "title": "m", "tables": {"t": table, "e": {"error": "bad}"}}}}}, indent=2)
    (tmp_path / "d.json").write_text(text)
    block_size(size)
    got = json_blocks.dictionary_rows(json_blocks.read_members(spark, str(tmp_path)))
    want = documents.json_dictionary(spark.createDataFrame([("d", text)], "path string, text string"))
    assert sorted(map(str, got.drop("path").collect())) == sorted(map(str, want.select(got.columns).drop("path").collect()))


@pytest.mark.parametrize("size", [500, 1 << 26])
def test_csv_files_in_blocks_of_any_size(spark, tmp_path, block_size, size):
    rng = random.Random(size)
    head = [f"c{i}" for i in range(90)] + ["column_name", "table_code"]
    out = io.StringIO()
    writer = csv.writer(out)
    writer.writerow(head)
    for i in range(60):
        writer.writerow([*[""] * 90, f"name\n{i}" if i % 3 else 'a "b",\r\nc', rng.choice(["t", "u"])])
    (tmp_path / "a.csv").write_text(out.getvalue(), newline="")
    (tmp_path / "b.csv").write_text("﻿table_code,column_label\n\nt,\"x\ny\"\nu\n", encoding="utf-8")
    (tmp_path / "empty.csv").write_text("")
    block_size(size)
    got = csv_blocks.read_csv(spark, str(tmp_path)).collect()
    for file in ("a.csv", "b.csv"):
        own = {r.record_no: [r[n] for n in CSV_COLUMNS] for r in got if r.path.endswith(file)}
        assert own == expected_csv((tmp_path / file).read_bytes().decode())
    assert len(got) == 62


def test_no_files_of_the_wanted_name_give_no_rows(spark, tmp_path):
    (tmp_path / "x.txt").write_text("{}")
    assert json_blocks.field_rows(json_blocks.read_members(spark, str(tmp_path))).collect() == []
    assert csv_blocks.read_csv(spark, str(tmp_path)).collect() == []


def test_the_kind_of_a_source_follows_its_path(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"modules":{"M":{"code":"M","tables":{"t":{"title":"T - Title","fields":{"f":{"label":"L"}}}}}}}')
    (tmp_path / "b.CSV").write_text("table_code,column_name,column_label\nt,f,L\n")
    spark.createDataFrame([("t", "T - Title")], "table_id string, table_title string").write.parquet(str(tmp_path / "model/tables"))
    spark.createDataFrame([("1", "t", "f", "L")], "id string, table_id string, field_name string, label string").write.parquet(str(tmp_path / "model/fields"))
    for name, fields in (("table_indexes", "id string, table_id string, index_name string, is_primary int, is_unique int, is_word int"), ("table_index_fields", "index_id string, field_sequence int, field_name string")):
        spark.createDataFrame([], fields).write.parquet(str(tmp_path / "model" / name))
    for path, glob in (("a.json", {}), ("b.CSV", {}), ("model", {}), ("", {"kind": "json"})):
        if path == "b.CSV":
            (tmp_path / path).rename(tmp_path / "b.csv")
            path = "b.csv"
        tables, columns = loader.read_source(spark, str(tmp_path / path), **glob)
        assert [r.table_code for r in tables.collect()] == ["t"]
        assert [(r.table_code, r.column_name, r.label) for r in columns.collect()] == [("t", "f", "L")]
    with pytest.raises(ValueError):
        loader.read_source(spark, "x.xlsx")
