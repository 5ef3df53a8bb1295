"""White-space, multi-line and description rules (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiframe.constants import (
    LEGACY_HEADING,
    LINE_BREAK_CHAR,
    NOT_WS,
    WS_CLASS,
)


# From the first to the last character that is no white space. Spark's own trim for a set of
# characters looks each one up in the set and notes the place of every character of the text.
_INNER = f"(.*{NOT_WS}|)"


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_extract(text, rf"(?s)\A{WS_CLASS}*{_INNER}", 1)


def null_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


# The patterns below match only what has to change: a single space between words is no match. Each
# begins with one class, so that a character outside it costs one test.
_RUN = f"{WS_CLASS}(?:(?<! )|{WS_CLASS}){WS_CLASS}*"
_BLANK_RUN = "[ \t](?:(?<=\t)|[ \t])[ \t]*"
# A white-space run that holds a line break: the end of a line, blank lines, the next line's indent.
# The look-behind lets each white-space run be entered once only, so long runs stay linear.
_LINE_EDGE = (
    f"{WS_CLASS}(?<!{WS_CLASS}{{2}})(?:(?<={LINE_BREAK_CHAR})|{WS_CLASS}*?{LINE_BREAK_CHAR}){WS_CLASS}*"
)


def collapse(text: Column) -> Column:
    """Each run of white space becomes one space."""
    return F.regexp_replace(text, _RUN, " ")


def clean_text(text: Column) -> Column:
    return null_if_empty(F.trim(collapse(text)))


def is_blank(text: Column) -> Column:
    return clean_text(text).isNull()


def _spaced_lines(text: Column) -> Column:
    """Collapse tabs and spaces inside lines, strip lines where they meet, drop blank lines."""
    return F.regexp_replace(F.regexp_replace(text, _LINE_EDGE, "\n"), _BLANK_RUN, " ")


def tidy_lines(text: Column) -> Column:
    """Collapse tabs and spaces inside lines, strip every line, drop blank lines."""
    return strip(_spaced_lines(text))


def clean_multiline_text(text: Column) -> Column:
    return null_if_empty(tidy_lines(text))


def clean_description(text: Column) -> Column:
    # Clean text has single spaces only, so nothing is left to trim behind a label.
    labels = r"(?iu)\A(?:description: *)?(?:content: *)?"
    return null_if_empty(F.regexp_replace(clean_text(text), labels, ""))


def section_text(text: Column, label: str) -> Column:
    """Tidy text without its leading label, empty if blank. `label` is letters and spaces only."""
    start = rf"(?s)\A{WS_CLASS}*(?:(?iu:{label}:){WS_CLASS}*)?"
    return F.regexp_extract(_spaced_lines(text), start + _INNER, 1)


def clean_legacy_section(text: Column, label: str) -> Column:
    return null_if_empty(section_text(text, label))


def legacy_entries(sections: list[tuple[str, Column]]) -> Column:
    """Nonblank sections under one heading, or null if there are none."""
    parts = [
        F.concat(F.lit(f"{label}:\n"), clean_legacy_section(value, label))
        for label, value in sections
    ]
    body = null_if_empty(F.concat_ws("\n\n", *parts))
    return F.concat(F.lit(LEGACY_HEADING + "\n\n"), body)


def description_state(current: Column, proposed: Column) -> Column:
    now, new = clean_text(current), clean_text(proposed)
    return (
        F.when(now.isNull(), "blank").when(now == new, "identical").otherwise("differs")
    )


def index_list_text(value: Column) -> Column:
    """A list held as JSON text becomes `a, b`; any other text stays."""
    text = null_if_empty(strip(value))
    items = F.when(text.startswith("["), F.from_json(text, "array<string>"))
    kept = F.filter(F.transform(items, strip), lambda item: item != "")
    return F.when(items.isNull(), text).otherwise(null_if_empty(F.array_join(kept, ", ")))
