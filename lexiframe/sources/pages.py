"""Page corpora: reading, decoding, module pages and index-page lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiframe.constants import CP1252_HIGH, CP1252_UNDEFINED
from lexiframe.functions.names import base_name

_HIGH_BYTES = "".join(chr(code) for code in range(0x80, 0xA0))


def _single_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


#: Page files, with the extension in either case.
PAGE_FILES = "*.[hH][tT][mM]"


def read_bytes(spark: SparkSession, folder: str, glob: str = PAGE_FILES) -> DataFrame:
    """Files in the folder and below as `(path, content)`; a path is the folder as given and the
    place below it."""
    root = folder.rstrip("/")
    place = F.regexp_extract("path", rf"(?s)\Q{root}\E(/.*)\z", 1)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(F.concat(F.lit(root), place).alias("path"), "content")
    )


def decode_pages(files: DataFrame) -> DataFrame:
    """`(path, content)` to `(path, filename, html, error)`: UTF-8, else cp1252.

    Bytes that cp1252 leaves undefined make the page an error instead of ending the job.
    """
    single = F.decode("content", "ISO-8859-1")
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    undefined = ~valid & (F.translate(single, CP1252_UNDEFINED, "") != single)
    text = F.when(valid, F.col("content").cast("string")).otherwise(
        F.translate(single, _HIGH_BYTES, CP1252_HIGH)
    )
    return files.select(
        "path",
        base_name(F.col("path")).alias("filename"),
        F.when(~undefined, _single_newlines(text)).alias("html"),
        F.when(undefined, "byte undefined in cp1252").alias("error"),
    )


def decode_index_pages(files: DataFrame) -> DataFrame:
    """Index pages are always single-byte text."""
    return files.select(
        "path",
        base_name(F.col("path")).alias("filename"),
        _single_newlines(F.decode("content", "ISO-8859-1")).alias("html"),
        F.lit(None).cast("string").alias("error"),
    )


def scan_pages(spark: SparkSession, folder: str, glob: str = PAGE_FILES) -> DataFrame:
    return decode_pages(read_bytes(spark, folder, glob))


def scan_index_pages(spark: SparkSession, folder: str, glob: str = PAGE_FILES) -> DataFrame:
    return decode_index_pages(read_bytes(spark, folder, glob))


def module_pages(pages: DataFrame) -> DataFrame:
    """Pages that list the tables of a module."""
    name = F.col("filename")
    return pages.filter(name.rlike(r"^[A-Z].*tbl\.htm\z") & ~name.contains("_"))


def resolve_pages(links: DataFrame, pages: DataFrame, folder: str) -> DataFrame:
    """Add `resolved`: the linked path if there is such a page, else the page in `folder`."""
    known = pages.select(F.col("path").alias("_known")).distinct()
    fallback = F.concat(F.lit(folder.rstrip("/") + "/"), base_name(F.col("filename")))
    # The first candidate is never null, so missing paths do not gather in one partition.
    wanted = links.withColumn("_second", fallback).withColumn(
        "_first", F.coalesce(F.nullif("path", F.lit("")), "_second")
    )
    first = known.select(F.col("_known").alias("_first"), F.lit(True).alias("_has_first"))
    second = known.select(F.col("_known").alias("_second"), F.lit(True).alias("_has_second"))
    # Names only, on keys that are unique on one side; many links to one page are split at run time.
    found = wanted.join(first, "_first", "left").join(second, "_second", "left")
    return found.withColumn(
        "resolved", F.when(F.col("_has_first"), F.col("_first")).when(F.col("_has_second"), F.col("_second"))
    ).drop("_first", "_second", "_has_first", "_has_second")
