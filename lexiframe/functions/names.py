"""Identifier, path and naming rules."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiframe.constants import DEFAULT_PREFIX, NOT_WS, WS_CLASS
from lexiframe.functions.text import clean_text, strip

# White space, each kind of quotes, white space: what is stripped, from the outside to the inside.
_WRAPPED = [WS_CLASS, '"', "'", r"[\[\]]", "`", WS_CLASS]
_OPENING = "".join(f"{mark}*" for mark in _WRAPPED)
_CLOSING = "".join(f"{mark}*+" for mark in reversed(_WRAPPED))
# The name reaches to the last character that can not be stripped; only behind it are marks tried.
_BARE_NAME = rf"(?s)\A{_OPENING}((?:.*{NOT_WS[:-1]}\"'\[\]`])?.*?){_CLOSING}\z"


def clean_identifier(value: Column) -> Column:
    """Strip white space and quotes, lower the case. One pattern, which names `value` once."""
    # Folded first: Spark takes upper(lower(x)) for upper(x), which is not so for every letter.
    return F.regexp_extract(F.lower(F.coalesce(value, F.lit(""))), _BARE_NAME, 1)


def base_name(path: Column) -> Column:
    """Last component of a path, as a file system would resolve it."""
    last = F.regexp_extract(path, r"(?<![^/])([^/]*+)(?:/\.?)*\z", 1)
    name = F.when(F.contains(path, F.lit("/")), last).otherwise(path)
    return F.regexp_replace(name, r"\A\.\z", "")


def stem(path: Column) -> Column:
    """Last path component without its last suffix, from one look at the text."""
    whole = r"([^/]+?)(?:\.[^./]+)?"
    return F.regexp_extract(path, rf"(?<![^/])(?:\.(?=(?:/\.?)*\z)|{whole}|)(?:/\.?)*\z", 1)


def join_path(folder: Column, relative: Column) -> Column:
    full = F.when(relative.startswith("/"), relative).otherwise(F.concat_ws("/", folder, relative))
    tidy = F.regexp_replace(full, r"/(?:\.?/)+", "/")
    return F.regexp_replace(tidy, r"(?<=[^/])/\.?\z", "")


# A rule that names its argument several times repeats the work below it wherever Spark moves the
# expression, for instance into a pushed-down filter. Prefix rules name it once.


def normalize_table_name(code: Column, prefix: str = DEFAULT_PREFIX) -> Column:
    start = rf"(?s)\A(?=.)(?!{re.escape(prefix.lower())})"
    escaped = prefix.replace("\\", r"\\").replace("$", r"\$")
    return F.regexp_replace(clean_identifier(code), start, escaped)


def normalize_table_code(code: Column, prefix: str = DEFAULT_PREFIX) -> Column:
    return F.regexp_replace(clean_identifier(code), rf"\A{re.escape(prefix.lower())}", "")


def drop_prefix(value: Column, prefix: Column) -> Column:
    """`value` without `prefix`: both behind each other, cut at the repetition."""
    return F.regexp_replace(
        F.concat(prefix, F.lit("\0"), value), r"\A([^\x00]*)\x00(?:\1)?", ""
    )


def without_table_prefix(name: Column, table: Column, given: Column | None = None) -> Column:
    """Cut `table_` off; nothing is cut where the table as given is null or empty."""
    prefix = F.concat(table, F.lit("_"))
    if given is not None:
        prefix = F.when(given != "", prefix).otherwise("")
    return drop_prefix(name, prefix)


def normalize_column_name(column: Column, table_code: Column | None = None) -> Column:
    """File stem first, then the identifier rule, then the prefix of a nonblank table."""
    name = clean_identifier(stem(column))
    if table_code is None:
        return name
    return without_table_prefix(name, clean_identifier(table_code), table_code)


def normalize_field_name(field: Column, table: Column) -> Column:
    """Like `normalize_column_name`, but without the file stem."""
    return without_table_prefix(clean_identifier(field), clean_identifier(table))


def build_table_fqn(service: Column, database: Column, schema: Column, table: Column) -> Column:
    return F.concat_ws(".", strip(service), strip(database), strip(schema), strip(table))


def clean_table_label(table_code: Column, title: Column) -> Column:
    """Title without a leading `CODE -` or `CODE:`, unless nothing would be left."""
    code = F.upper(clean_identifier(table_code))
    both = F.concat(code, F.lit("\0"), clean_text(title))
    return F.regexp_replace(both, r"(?isu)\A([^\x00]*)\x00(?:\1 *[-:] *(?=.))?", "")


def plain_default(name: Column) -> Column:
    """Default label of a physical name, in the lower-case form used for comparison."""
    return clean_identifier(F.replace(clean_identifier(name), F.lit("_"), F.lit(" ")))


def is_default_table_name(
    shown: Column, physical_name: Column, prefix: str = DEFAULT_PREFIX, allow_unprefixed: bool = True
) -> Column:
    """Is the cleaned display name `shown` blank or made from the physical name?"""
    name = clean_identifier(shown)
    physical = clean_identifier(physical_name)
    defaults = [clean_identifier(physical), plain_default(physical)]
    if allow_unprefixed:
        short = F.when(
            physical.startswith(prefix.lower()),
            physical.substr(F.lit(len(prefix) + 1), F.length(physical)),
        )
        # Without the prefix there is no short form; the full name stands in for it.
        known = F.coalesce(short, physical)
        defaults += [clean_identifier(known), plain_default(known)]
    return shown.isNull() | F.array_contains(F.array(*defaults), name)


def is_default_column_name(shown: Column, physical_name: Column) -> Column:
    """Is the cleaned display name `shown` blank or the physical name?"""
    return shown.isNull() | (clean_identifier(shown) == clean_identifier(physical_name))


def is_default_table_display_name(
    current: Column, physical_name: Column, prefix: str = DEFAULT_PREFIX, allow_unprefixed: bool = True
) -> Column:
    return is_default_table_name(clean_text(current), physical_name, prefix, allow_unprefixed)


def is_default_column_display_name(current: Column, physical_name: Column) -> Column:
    return is_default_column_name(clean_text(current), physical_name)


def clean_index_name(filename: Column, table_id: Column) -> Column:
    return without_table_prefix(F.lower(stem(filename)), F.lower(table_id), table_id)


def parse_flag(value: Column) -> Column:
    word = F.lower(strip(value.cast("string")))
    return F.when(word.isin("1", "true", "yes", "y"), True).when(
        word.isin("0", "false", "no", "n"), False
    )
