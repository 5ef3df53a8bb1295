"""Checks of the sinks: what was written and read back is what the operator gave."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import model_checks, page_checks, plan_checks
from checks.inputs import FOLDER, Inputs
from checks.registry import ORACLES, check
from checks.sql import over_plan, with_views
from lexiframe.operators import keys, relational
from lexiframe.plans.storage import new_path, read_relational, write_json, write_relational
from lexiframe.sources import documents


def _json_round_trip(inputs: Inputs, frame: DataFrame, name: str) -> DataFrame:
    path = new_path(inputs.spark, name)
    write_json(frame, path)
    return inputs.spark.read.schema(frame.schema).json(path)


def _written_documents(inputs: Inputs, frame: DataFrame, name: str) -> DataFrame:
    path = new_path(inputs.spark, name)
    frame.write.text(path)
    return inputs.spark.read.text(path).select(F.lit("doc").alias("path"), F.col("value").alias("text"))


@check("sink_dictionary_json", ORACLES["dictionary"])
def sink_dictionary(inputs: Inputs) -> DataFrame:
    """Nested documents that the dictionary reader takes again."""
    made = documents.dictionary_documents(page_checks._tables(inputs))
    return page_checks.flat_dictionary(
        documents.json_dictionary(_written_documents(inputs, made, "dictionary-json"))
    )


_FIELD_VALUES = "module_code, table_id, field_name, label, type, val_msg, indexes, description, content"


@check("sink_annotations_json", f"SELECT {_FIELD_VALUES} FROM ({ORACLES['annotate_fields']}) f")
def sink_annotations(inputs: Inputs) -> DataFrame:
    """Nested documents of at most 7 fields that the annotations reader takes again."""
    tables = page_checks._stored_tables(inputs)
    links = page_checks.dictionary.annotation_links(tables, inputs.corpus)
    made = documents.annotation_documents(
        page_checks.dictionary.latest_tables(tables), page_checks.dictionary.annotate_fields(links), 7
    )
    read = _written_documents(inputs, made, "annotations-json")
    fields = relational.annotated_fields(documents.json_fields(read))
    return page_checks.flat_fields(fields).drop("field_pos")


@check("rel_fields_from_json", f"SELECT {_FIELD_VALUES} FROM ({ORACLES['annotate_fields']}) f")
def rel_fields_from_json(inputs: Inputs) -> DataFrame:
    tables = page_checks._stored_tables(inputs)
    links = page_checks.dictionary.annotation_links(tables, inputs.corpus)
    made = documents.annotation_documents(
        page_checks.dictionary.latest_tables(tables), page_checks.dictionary.annotate_fields(links)
    )
    fields = relational.rel_fields(
        relational.annotated_fields(
            documents.json_fields(made.select(F.xxhash64("text").cast("string").alias("path"), "text"))
        )
    )
    return fields.select(
        "module_code", "table_id", "field_name", "label", F.col("field_type").alias("type"), "val_msg",
        F.array_join(F.from_json("indexes", "array<string>"), ",").alias("indexes"), "description", "content",
    )


_INDEX_VALUES = "module_code, table_id, index_name, is_primary, is_unique, is_word, source_file"


@check(
    "rel_indexes_from_json",
    f"""SELECT {_INDEX_VALUES} FROM ({ORACLES['rel_indexes']}) i UNION ALL
      SELECT 'MOD' || CAST(floor(s_suppkey / 50) AS BIGINT), 't' || s_suppkey, 'own', CAST(1 AS INT), CAST(0 AS INT), CAST(NULL AS INT), ''
      FROM supplier""",
)
def rel_indexes_from_json(inputs: Inputs) -> DataFrame:
    """Links that lead to pages, and for each table an entry that is an object."""
    latest = page_checks.dictionary.latest_tables(page_checks._stored_tables(inputs))
    made = documents.json_tables(
        documents.annotation_documents(
            latest, page_checks.dictionary.annotate_fields(page_checks._links(inputs)).limit(0)
        ).select(F.lit("d").alias("path"), "text")
    )
    own = F.lit('{"name":"own","primary":"yes","unique":0,"fields":[{"sequence":"1","name":"x"}]}')
    entries = F.concat(F.coalesce("indexes", F.array().cast("array<string>")), F.array(own))
    with_objects = made.withColumn("indexes", entries)
    found = relational.annotated_indexes(with_objects, inputs.corpus, FOLDER)
    return relational.rel_indexes(found).select(*_INDEX_VALUES.split(", "))


@check(
    "sink_relational",
    with_views(f"""SELECT f.module_code, 'sxe.' || f.table_id AS table_name, field_name, label, description
      FROM {model_checks._FIELDS} f"""),
)
def sink_relational(inputs: Inputs) -> DataFrame:
    """The model on disk, and the field view over it."""
    path = new_path(inputs.spark, "relational")
    write_relational(
        {"modules": inputs.dict_modules, "tables": inputs.rel_tables, "fields": inputs.rel_fields}, path
    )
    back = read_relational(inputs.spark, path, ["modules", "tables", "fields"])
    return relational.field_details(back["fields"], back["tables"], back["modules"]).select(
        "module_code", "table_name", "field_name", "label", "description"
    )


@check("sink_key_report_json", ORACLES["key_report_simple"])
def sink_key_report(inputs: Inputs) -> DataFrame:
    report = keys.key_report_simple(*model_checks.report_inputs(inputs))
    return _json_round_trip(inputs, report, "key-report-json")


@check("sink_key_report_full_json", ORACLES["key_report_full"])
def sink_key_report_full(inputs: Inputs) -> DataFrame:
    report = keys.key_report_full(*model_checks.report_inputs(inputs))
    return _json_round_trip(inputs, report, "key-report-full-json")


@check(
    "sink_plan_json",
    over_plan("""SELECT table_fqn, column_name, proposed_display_name, proposed_description, display_name_action,
      description_action, reason, entity_type = 'table' AS explicit_null FROM plan"""),
)
def sink_plan(inputs: Inputs) -> DataFrame:
    """Every row comes back, and null members are written: table rows have a null `column_name`."""
    path = new_path(inputs.spark, "plan-json")
    rows = plan_checks.build_plan(inputs).rows
    write_json(rows, path)
    lines = inputs.spark.read.text(path)
    return lines.select(
        F.from_json("value", rows.schema).alias("r"),
        F.contains("value", F.lit('"column_name":null')).alias("explicit_null"),
    ).select(
        "r.table_fqn", "r.column_name", "r.proposed_display_name", "r.proposed_description",
        "r.display_name_action", "r.description_action", "r.reason", "explicit_null",
    )


@check("sink_backup_json", ORACLES["backup_columns"])
def sink_backup(inputs: Inputs) -> DataFrame:
    return _json_round_trip(inputs, plan_checks.backup_columns(inputs), "backup-json")


@check("sink_results_json", ORACLES["apply_results_continue"])
def sink_results(inputs: Inputs) -> DataFrame:
    return _json_round_trip(inputs, plan_checks.apply_results_continue(inputs), "results-json")
