"""Column names and types of the relations passed between operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Metadata of a column whose values are in lower case already.
IN_LOWER_CASE = {"lower_case": True}

FIELD_COLUMNS = [
    "id",
    "module_code",
    "table_id",
    "field_name",
    "label",
    "field_type",
    "format",
    "decimals",
    "initial",
    "extent",
    "mandatory",
    "val_exp",
    "val_msg",
    "help",
    "trigger",
    "indexes",
    "description",
    "content",
]
CSV_COLUMNS = [
    "table_code",
    "table_label",
    "table_description",
    "column_name",
    "column_label",
    "column_description",
]
PLAN_COLUMNS = [
    "entity_type",
    "table_fqn",
    "table_name",
    "column_name",
    "current_display_name",
    "proposed_display_name",
    "display_name_action",
    "current_description_state",
    "proposed_description",
    "description_action",
    "reason",
    "source_ref",
]

LINKS = "array<struct<filename: string, path: string>>"
INDEX_FIELDS = (
    "array<struct<field_sequence: bigint, field_name: string, field_order: string, "
    "abbreviated: string>>"
)
#: An index entry of an annotation document; flags and numbers come in several spellings.
INDEX_ENTRY = (
    "struct<name: string, primary: string, unique: string, word: string, source_file: string, "
    "fields: array<struct<sequence: string, name: string, order: string, abbreviated: string>>>"
)


def with_missing(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Add each absent column as a null string."""
    absent = [name for name in columns if name not in frame.columns]
    return frame.withColumns({name: F.lit(None).cast("string") for name in absent})


def row_key(*parts: Column, seq: Column) -> Column:
    """Key of a row of a table, made of the table's own key and the row's place in it.

    A place that is a text (of a row that came from a document) is longer than a number's padding.
    """
    text = seq.cast("string")
    return F.concat_ws("/", *parts, F.when(F.length(text) > 10, text).otherwise(F.lpad(text, 10, "0")))
