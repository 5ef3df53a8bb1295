"""From a page corpus to the relational model and the key report."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from lexiframe.operators import dictionary, keys, relational
from lexiframe.plans.storage import new_path, read_relational, stored, write_relational
from lexiframe.sources.pages import decode_index_pages, decode_pages, read_bytes

RELATIONS = ["modules", "tables", "fields", "table_indexes", "table_index_fields", "metadata"]


def corpus_to_relational(
    spark: SparkSession,
    folder: str,
    schema_prefix: str = "",
    output: str | None = None,
) -> dict[str, DataFrame]:
    """Read the pages under `folder`, write the six relations, and read them back with their two views.

    The page files are stored first: many small files are opened once, and later steps read only
    the names or pages they need, each decoded as its kind of page asks for. The dictionary and the
    annotations are stored as well, because several steps read them.
    """
    root = folder.rstrip("/")
    files = stored(read_bytes(spark, root), "pages")
    pages = decode_pages(files)
    modules = stored(dictionary.dictionary_modules(pages), "modules")
    tables = stored(dictionary.dictionary_tables(pages, root), "dictionary")
    links = stored(dictionary.annotation_links(tables, pages), "annotations")
    latest = dictionary.latest_tables(tables)
    entries = stored(
        relational.parsed_index_links(
            relational.index_links(latest), decode_index_pages(files), root
        ),
        "indexes",
    )
    relations = {
        "modules": relational.rel_modules(modules),
        "tables": relational.rel_tables(latest, schema_prefix),
        "fields": relational.rel_fields(dictionary.annotate_fields(links)),
        "table_indexes": relational.rel_indexes(entries),
        "table_index_fields": relational.rel_index_fields(entries),
    }
    path = output or new_path(spark, "relational")
    write_relational(relations, path)
    written = read_relational(spark, path, list(relations))
    counts = {
        "modules_count": written["modules"],
        "tables_count": written["tables"],
        "fields_count": written["fields"],
        "indexes_count": written["table_indexes"],
        "index_fields_count": written["table_index_fields"],
    }
    provenance = {
        "source_file": folder,
        "schema_prefix": relational.closed_prefix(schema_prefix),
        "generated_at": datetime.now(UTC).isoformat(),
    }
    write_relational({"metadata": relational.rel_metadata(counts, provenance)}, path)
    back = read_relational(spark, path, RELATIONS)
    back["field_details"] = relational.field_details(
        back["fields"], back["tables"], back["modules"]
    )
    back["index_details"] = relational.index_details(
        back["table_indexes"], back["table_index_fields"], back["tables"], back["modules"]
    )
    return back


def key_report(relations: dict[str, DataFrame], simple: bool = True) -> DataFrame:
    """Key and transaction columns of every table of a relational model.

    The two lists are stored: the report reads each of them several times.
    """
    details = relational.index_details(
        relations["table_indexes"],
        relations["table_index_fields"],
        relations["tables"],
        relations["modules"],
    )
    unique = stored(keys.primary_unique_indexes(details), "unique-indexes")
    changes = stored(keys.trans_columns(relations["fields"], relations["tables"]), "trans-columns")
    report = keys.key_report_simple if simple else keys.key_report_full
    return report(relations["tables"], unique, changes)
