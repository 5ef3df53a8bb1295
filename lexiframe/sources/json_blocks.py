"""Dictionary and annotation JSON of any size, one document read by many tasks.

A document is cut behind closing braces. A block tells, for both cases of beginning outside and inside a
text, how many of the open objects it closes, what it does to the one that remains, and which it
opens. From the state it begins in, it gives its members of modules, tables and fields as rows;
a value that crosses blocks leaves as fragments and is put together afterwards.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiframe.plans.storage import stored
from lexiframe.sources import blocks, documents

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TEXT_END = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.S)
_TOKEN = re.compile(r'"([^"\\]*(?:\\.[^"\\]*)*)"|[{\[\],:"]', re.S)
# What a block mostly holds: one more member whose value is an object without further objects.
_FLAT = re.compile(r'\s*+,\s*+"([^"\\]*+)"\s*+:()\s*+\{[^{"]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^{"]*+)*+\Z', re.S)

_ROWS = (
    "path string, kind string, module string, module_pos int, table string, table_pos int, key string, pos int, "
    "text string, block long, partial boolean"
)
_SCHEMA = pa.schema(
    [("path", pa.string()), ("kind", pa.string()), ("module", pa.string()), ("module_pos", pa.int32())]
    + [("table", pa.string()), ("table_pos", pa.int32()), ("key", pa.string()), ("pos", pa.int32())]
    + [("text", pa.string()), ("block", pa.int64()), ("partial", pa.bool_())]
)


class Walk:
    """Open objects and arrays along a text. A frame is [key of its current member, place of that
    member, is it an object]. Frames below the start of the text are not known; `pops`, `base` and
    `keyed` tell what happens to them.

    Records end with a closing brace, which counts when the next record arrives, so the one behind the last
    record of a block counts in the next block, and none is made up at the end of a file.
    """

    def __init__(self, frames: list[list], text: str | None, pending: bool):
        self.frames = frames
        self.text = text  # what is known of the text the walk is inside of, else None
        self.pending = pending
        self.last: str | None = None
        self.after_colon = False
        self.pops, self.base, self.keyed = 0, 0, None

    def close(self) -> None:
        if self.frames:
            self.frames.pop()
        else:
            self.pops, self.base, self.keyed = self.pops + 1, 0, None

    def comma(self, at: int) -> None:
        if self.frames:
            self.frames[-1][1] += 1
        else:
            self.base += 1

    def colon(self, at: int) -> None:
        if self.frames:
            self.frames[-1][0] = self.last
        else:
            self.keyed = self.last

    def open(self, at: int, is_object: bool) -> None:
        self.frames.append([None, 0, is_object])

    def resumed(self, brace: bool) -> None:
        """A new record begins; `brace` says that a closing brace before it is part of a text."""

    def record(self, value: str) -> None:
        at = 0
        if self.pending:
            inside = self.text is not None
            self.resumed(inside)
            if inside:
                self.text += "}"
            else:
                self.close()
                self.after_colon = False
        else:
            self.resumed(False)
        self.pending = True
        if self.text is not None:
            end = _TEXT_END.match(value)
            if end is None:
                if not self.after_colon:
                    self.text += value
                return
            self.last, self.text, at = self.text + value[: end.end() - 1], None, end.end()
            self.after_colon = False
        elif self.flat(value):
            return
        for token in _TOKEN.finditer(value, at):
            sign = value[token.start()]
            if sign == '"':
                if token.end() - token.start() == 1:
                    # A text with a brace in it; only keys have to be known in full.
                    self.text = "" if self.after_colon else value[token.end() :]
                    return
                self.last = token.group(1)
                self.after_colon = False
            elif sign == ":":
                self.after_colon = True
                self.colon(token.end())
            else:
                self.after_colon = False
                if sign == ",":
                    self.comma(token.start())
                elif sign == "]":
                    self.bracket(token.start())
                else:
                    self.open(token.start(), sign == "{")

    def bracket(self, at: int) -> None:
        self.close()

    def flat(self, value: str) -> bool:
        """Take a record that only adds one flat member, if it does."""
        found = _FLAT.match(value)
        if found is None:
            return False
        self.comma(0)
        self.last, self.after_colon = found.group(1), False
        self.colon(found.start(2))
        self.open(found.start(2), True)
        return True


class Summary:
    def __init__(self, block: int):
        # The text of a key that began before the block is not known; a mark stands for it.
        self.cases = {"outside": Walk([], None, block > 0), "inside": Walk([], "\0", block > 0)}
        if block == 0:
            del self.cases["inside"]

    def feed(self, values: list[str]) -> None:
        for walk in self.cases.values():
            for value in values:
                walk.record(value)

    def finish(self) -> None:
        self.summary = {
            case: {"pops": w.pops, "base": w.base, "key": w.keyed, "frames": w.frames, "text": w.text}
            | {"value": w.after_colon}
            for case, w in self.cases.items()
        }


START = {"frames": [], "text": None, "value": False}


def advance(state: dict, summary: dict) -> dict:
    before = state["text"]
    own = summary["outside" if before is None else "inside"]

    def whole(text: str | None) -> str | None:
        return (before or "") + text[1:] if text and text.startswith("\0") else text

    frames = [list(f) for f in state["frames"]]
    if own["pops"] > len(frames):
        raise ValueError("a document with more closing than opening brackets")
    if own["pops"]:
        del frames[-own["pops"] :]
    if frames:
        frames[-1][1] += own["base"]
        if own["key"] is not None:
            frames[-1][0] = whole(own["key"])
    return {
        "frames": frames + [[whole(k), at, o] for k, at, o in own["frames"]],
        "text": whole(own["text"]),
        "value": own["value"] or (state["value"] and own["text"] is not None and own["text"].startswith("\0")),
    }


def check(path: str, state: dict) -> None:
    # The last closing brace has not been counted.
    if len(state["frames"]) > 1 or state["text"] is not None:
        raise ValueError(f"{path} is not a whole JSON document")


def _plain(key: str | None) -> str | None:
    return json.loads(f'"{key}"') if key and "\\" in key else key


class JsonReader(Walk):
    """Rows of one block: members of modules (kind `module`), tables (`table`) and of `fields`
    (`field`), and one row for each module and table found (`modules`, `tables`)."""

    def __init__(self, path: str, block: int, state: dict | None):
        self.single = state is None
        state = state or START
        super().__init__([list(f) for f in state["frames"]], state["text"], block > 0)
        self.after_colon = state["value"] and self.text is not None
        self.path, self.block = path, block
        self.held: int | None = self._depth()  # depth of the member whose value is gathered
        if self.held == len(self.frames) and self.text is not None and not self.after_colon:
            self.held = None  # the text is the next key; the last member has ended
        self.partial = self.held is not None
        self.parts: list[str] = []
        self.start = 0
        self.value = ""
        self.out: list[dict] = []

    def _depth(self) -> int | None:
        """Depth of the member that is gathered in the present state, if one is."""
        f = self.frames
        if len(f) < 3 or f[0][0] != "modules" or f[1][0] is None or f[2][0] is None:
            return None
        if f[2][0] != "tables":
            return 3
        if len(f) < 5 or not f[3][2] or f[3][0] is None or f[4][0] is None:
            return None
        is_list = not f[5][2] if len(f) > 5 else self.after_colon
        if f[4][0] != "fields" or is_list:
            return 5
        return 6 if len(f) > 5 and f[5][0] is not None else None

    def _row(self, kind: str, depth: int, text: str | None, partial: bool) -> None:
        f = self.frames
        row = {"path": self.path, "kind": kind, "module": _plain(f[1][0]), "module_pos": f[1][1], "block": self.block}
        if depth > 3:
            row |= {"table": _plain(f[3][0]), "table_pos": f[3][1]}
        if depth in (3, 5, 6):
            row |= {"key": _plain(f[depth - 1][0]), "pos": f[depth - 1][1]}
        self.out.append(row | {"text": text, "partial": partial})

    def _gathered(self, end: int, partial: bool = False) -> None:
        """The value gathered so far ends here."""
        self.parts.append(self.value[self.start : end])
        kind = {3: "module", 5: "table", 6: "field"}[self.held]
        self._row(kind, self.held, "".join(self.parts), self.partial or partial)
        self.held, self.partial, self.parts = None, False, []

    def record(self, value: str) -> None:
        if self.held is not None:
            self.parts.append(self.value[self.start :])
        self.value, self.start = value, 0
        super().record(value)

    def resumed(self, brace: bool) -> None:
        if self.held is not None and self.pending:
            if brace or len(self.frames) > self.held:
                self.parts.append("}")
            else:
                self.value, own = "", self.value
                self._gathered(0)
                self.value = own

    def comma(self, at: int) -> None:
        if self.held is not None and len(self.frames) == self.held:
            self._gathered(at)
        super().comma(at)

    def bracket(self, at: int) -> None:
        if self.held is not None and len(self.frames) == self.held:
            self._gathered(at)
        super().bracket(at)

    def colon(self, at: int) -> None:
        super().colon(at)
        f = self.frames
        if self.held is not None or not f or f[0][0] != "modules":
            return
        if len(f) == 2:
            self._row("modules", 2, None, False)
        elif len(f) == 4 and f[2][0] == "tables" and f[3][2]:
            self._row("tables", 4, None, False)
        elif len(f) in (3, 5, 6) and self._depth() == len(f):
            self.held, self.start = len(f), at

    def open(self, at: int, is_object: bool) -> None:
        f = self.frames
        if self.held == 5 and len(f) == 5 and f[4][0] == "fields" and is_object:
            self.held, self.parts = None, []  # its members are rows of their own
        super().open(at, is_object)

    def flat(self, value: str) -> bool:
        # Only members of `fields`, or what is gathered anyway, need no look inside.
        deep = self.held is not None and len(self.frames) > self.held
        fields = len(self.frames) == 6 and self._depth() == 6
        return (deep or fields) and super().flat(value)

    def feed(self, values: list[str]) -> None:
        for value in values:
            self.record(value)

    def finish(self) -> None:
        if self.held is not None:
            self._gathered(len(self.value), partial=True)
        if self.single or self.pops > 1:
            check(self.path, {"frames": self.frames + [None] * self.pops, "text": self.text})

    def rows(self) -> Iterator[pa.RecordBatch]:
        found, self.out = self.out, []
        if found:
            yield pa.RecordBatch.from_pylist(found, schema=_SCHEMA)


_KEYS = ["path", "kind", "module", "module_pos", "table", "table_pos", "key", "pos"]


def _last_of_repeats(rows: DataFrame, kind: str, names: list[str], pos: str, only: bool) -> DataFrame:
    """Of members with one key the last stays, at the place of the first, with all rows below it
    (`only`: there are none)."""
    own = F.col("kind") == kind
    ends = rows.filter(own).groupBy(names).agg(F.min(pos).alias("_first"), F.max(pos).alias("_last"))
    repeats = stored(ends.filter("_first < _last"), "repeated-keys")
    if repeats.isEmpty():
        return rows
    below = rows.filter(own) if only else rows
    joined = below.join(repeats, names, "left").filter(F.col("_last").isNull() | (F.col(pos) == F.col("_last")))
    single = joined.withColumn(pos, F.coalesce("_first", pos)).drop("_first", "_last")
    return single.unionByName(rows.filter(~own)) if only else single


def read_members(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """`(path, kind, module, module_pos, table, table_pos, key, pos, text)` of JSON files: one row for
    each module (`modules`) and table (`tables`), and the JSON text of each member of a module
    (`module`) or table (`table`) and of each field (`field`).

    Files may be of any size; one that is no whole JSON document raises an error. A file
    without modules gives no rows. Of repeated keys the last value counts, at the first place.
    """
    lines = blocks.text_blocks(spark, path, "}", glob)
    states = blocks.begin_states(lines, Summary, advance, START, check)
    rows = stored(blocks.read_blocks(lines, states, JsonReader, _ROWS), "json-members")
    # Only values at the ends of blocks are in pieces.
    pieces = rows.filter("partial").groupBy(_KEYS).agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("block", "text")))["text"], "").alias("text")
    )
    whole = rows.filter("NOT partial").select(*_KEYS, "text").unionByName(pieces)
    whole = _last_of_repeats(whole, "modules", ["path", "module"], "module_pos", False)
    whole = _last_of_repeats(whole, "tables", ["path", "module", "table"], "table_pos", False)
    return _last_of_repeats(whole, "field", ["path", "module", "table", "key"], "pos", True)


def _scalar(text: Column) -> Column:
    return F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "v string")["v"]


def _with_module(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Add `code` and `module_title` of each row's module."""
    own = members.filter("kind = 'module' AND key IN ('code', 'title')").groupBy("path", "module").agg(
        *[
            F.max_by(_scalar(F.col("text")), F.when(F.col("key") == key, F.col("pos"))).alias(name)
            for key, name in (("code", "code"), ("title", "module_title"))
        ]
    )
    filled = {name: F.coalesce(name, F.lit("")) for name in ("code", "module_title")}
    return rows.join(stored(own, "json-modules"), ["path", "module"], "left").withColumns(filled)


def _tables(members: DataFrame, schema: str) -> DataFrame:
    """One row for each table, its members parsed as `schema`."""
    wanted = (F.col("kind") == "table") & F.col("key").isin(re.findall(r"(\w+): ", schema))
    named = F.concat(F.lit('"'), "key", F.lit('":'), "text")
    names = ["path", "module", "module_pos", "table", "table_pos"]
    tables = members.filter("kind IN ('tables', 'table')").groupBy(names).agg(
        F.array_sort(F.collect_list(F.when(wanted, F.struct("pos", named.alias("m"))))).alias("_m")
    )
    text = F.concat(F.lit("{"), F.array_join(F.col("_m.m"), ","), F.lit("}"))
    return _with_module(tables, members).select(
        "path",
        F.col("module").alias("module_code"),
        "module_pos",
        "code",
        "module_title",
        F.col("table").alias("table_name"),
        "table_pos",
        F.from_json(text, schema).alias("t"),
    ).select("path", "module_code", "module_pos", "code", "module_title", "table_name", "table_pos", "t.*")


def dictionary_rows(members: DataFrame) -> DataFrame:
    """Members of dictionary files as rows of `dictionary_tables`."""
    return documents.dictionary_rows(_tables(members, documents.DICTIONARY_TABLE))


def table_rows(members: DataFrame) -> DataFrame:
    """Members of annotation files as one row for each table, without its fields."""
    return _tables(members, documents.ANNOTATED_TABLE)


def field_rows(members: DataFrame) -> DataFrame:
    """Members of annotation files as one row for each field."""
    fields = _with_module(members.filter("kind = 'field'"), members)
    return fields.select(
        "path",
        F.col("module").alias("module_code"),
        "module_pos",
        "code",
        F.col("table").alias("table_name"),
        "table_pos",
        F.col("key").alias("field_name"),
        F.col("pos").alias("field_pos"),
        F.from_json("text", documents.ANNOTATED_FIELD).alias("f"),
    ).select(
        "path", "module_code", "module_pos", "code", "table_name", "table_pos", "field_name", "field_pos", "f.*"
    ).withColumnRenamed("type", "field_type")
