"""License scans by diagonal voting, in DataFrame functions only.

All runs of k words of every document are joined by hash to the places where templates hold them.
A match at document word d and template word t votes for the diagonal d - t. Whole phrases are
diagonals on which every run of the phrase voted. Texts that were edited leave votes on
neighbouring diagonals, which are merged and verified by the share of the template they cover.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.llm import shared

#: Words of a run. No phrase may be shorter.
RUN = 3
#: Runs of templates that are broadcast at once; further ones are blocks of their own.
BLOCK_RUNS = 50_000
#: Diagonals further apart than this are not merged.
DRIFT = 6
#: Share of a template's words that a span must hold, and its longest length in templates.
COVERAGE, STRETCH = 0.7, 2

#: Phrases that name a license wherever their words stand consecutively. Fixed values.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

#: Notices that name a license also when words are changed, left out or put in.
TEMPLATES = [
    (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license",
    ),
    ("apache-2", "licensed under the apache license version 2 0"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl-3",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation either version 3 of the license or at your option any later version",
    ),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
    ),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
]

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ADDED = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

_TEMPLATE_FIELDS = "label string, _template int, _phrase boolean, _length int, _at int, _run array<string>"


def words(text: Column) -> Column:
    """Runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII."""
    return F.array_remove(F.split(shared.lower_ascii(F.coalesce(text, F.lit(""))), _BREAK), "")


def template_rows(
    phrases: Iterable[tuple[str, str]], templates: Iterable[tuple[str, str]], k: int
) -> list[tuple[str, int, bool, int, int, list[str]]]:
    """One row for each run of k words of each phrase and template."""
    rows = []
    named = [(label, text, True) for label, text in phrases] + [(label, text, False) for label, text in templates]
    for number, (label, text, phrase) in enumerate(named):
        own = text.split()
        if len(own) < k:
            raise ValueError(f"{text!r} has fewer than {k} words")
        rows += [(label, number, phrase, len(own), i, own[i : i + k]) for i in range(len(own) - k + 1)]
    return rows


def _votes(docs: DataFrame, block: list[tuple], k: int, heads: bool) -> DataFrame:
    """(_row, _own, n_words, label, _template, _phrase, _length, _diagonal, _at): one row for each
    matching run. With `heads`, each document also has a row without a template, and only that row
    holds its columns and its number of words."""
    marks = [("", -1, False, 0, 0, None)] if heads else []
    table = docs.sparkSession.createDataFrame(block + marks, _TEMPLATE_FIELDS)
    own = F.xxhash64(*[F.get("_run", F.lit(i)) for i in range(k)])
    table = table.withColumn("_hash", F.when(F.col("_template") >= 0, own).otherwise(F.lit(0).cast("long")))
    last = F.size("_words") - k
    hashes = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*[F.get(F.col("_words"), i + j) for j in range(k)]),
    )
    some = F.when(last >= 0, hashes).otherwise(F.array().cast("array<bigint>"))
    # Place 0 is the document's own row, run number i has place i + 1. As a column of their own the
    # hashes are read by compiled code, which takes half the time.
    placed = F.explode(F.array(F.concat(F.array(F.lit(0).cast("long")), some))).alias("_hashes")
    runs = docs.select("_row", "_own", "_words", placed)
    runs = runs.select("_row", "_own", "_words", F.posexplode("_hashes").alias("_place", "_hash"))
    # The words themselves are compared as well, so no vote rests on a hash alone.
    same = F.slice("_words", F.greatest("_place", F.lit(1)), k) == F.col("_run")
    head = F.col("_template") < 0
    found = runs.join(F.broadcast(table), "_hash")
    found = found.filter(F.when(F.col("_place") == 0, head).otherwise(~head & same))
    return found.select(
        "_row",
        F.when(head, F.col("_own")).alias("_own"),
        F.when(head, F.size("_words").cast("long")).alias("n_words"),
        "label",
        "_template",
        "_phrase",
        "_length",
        (F.col("_place") - 1 - F.col("_at")).alias("_diagonal"),
        "_at",
    )


def _spans(votes: DataFrame, k: int) -> DataFrame:
    """Verified spans: (_row, label, _phrase, _start, _share)."""
    by_diagonal = votes.groupBy("_row", "_template", "label", "_phrase", "_length", "_diagonal").agg(
        F.collect_list("_at").alias("_ats")
    )
    whole = by_diagonal.filter(F.col("_phrase") & (F.size("_ats") == F.col("_length") - k + 1))
    whole = whole.select("_row", "label", "_phrase", F.col("_diagonal").alias("_start"), F.lit(1.0).alias("_share"))
    along = Window.partitionBy("_row", "_template").orderBy("_diagonal")
    far = F.col("_diagonal") - F.lag("_diagonal").over(along) > DRIFT
    loose = by_diagonal.filter(~F.col("_phrase")).withColumn("_new", F.coalesce(far, F.lit(True)).cast("long"))
    chained = loose.withColumn("_group", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    group = Window.partitionBy("_row", "_template", "_group")
    ends = {
        "_low": F.min(F.array_min("_ats") + F.col("_diagonal")).over(group),
        "_high": F.max(F.array_max("_ats") + F.col("_diagonal") + k).over(group),
    }
    chained = chained.withColumns(ends)
    # A chain of diagonals too long for one copy of the template is judged diagonal by diagonal.
    alone = F.col("_high") - F.col("_low") > STRETCH * F.col("_length")
    keys = ["_row", "_template", "label", "_phrase", "_length", "_group"]
    merged = chained.groupBy(*keys, F.when(alone, F.col("_diagonal")).alias("_own")).agg(
        F.array_distinct(F.flatten(F.collect_list("_ats"))).alias("_ats"),
        F.min(F.array_min("_ats") + F.col("_diagonal")).alias("_start"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("_ats", lambda t: F.sequence(t, t + k - 1)))))
    merged = merged.withColumn("_share", covered / F.col("_length"))
    judged = merged.filter(F.col("_share") >= COVERAGE).select("_row", "label", "_phrase", "_start", "_share")
    return whole.unionByName(judged)


def license_scan(
    docs: DataFrame,
    text_col: str = "text",
    phrases: Iterable[tuple[str, str]] = tuple(PHRASES),
    templates: Iterable[tuple[str, str]] = tuple(TEMPLATES),
    k: int = RUN,
    block_runs: int = BLOCK_RUNS,
) -> DataFrame:
    """All columns of `docs` but the text, with `n_words`, `n_base`, `first_word`, `last_word`,
    `base_labels`, `labels` and `score`.

    `n_base` counts the places of whole phrases, which begin between `first_word` and `last_word`
    (null without any); `base_labels` and `labels` are sorted, joined by commas, empty without any.
    `labels` adds those of notices of which a span holds at least 0.7 of the words; `score` is the
    largest share found, 1 for a phrase and 0 without any. Null and empty texts have no words. Rows
    that repeat, or have no id, are judged one by one. The result columns replace columns of the
    same names; other columns are kept whatever their names. An empty table gives no rows.
    """
    names = [c for c in docs.columns if c not in {*ADDED, text_col}]
    own = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.lit(None).cast("int")
    # The explode makes the words a column of their own; a mere projection would be put into the
    # expressions that read it, and the text split again for every run.
    read = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        own.alias("_own"),
        F.explode(F.array(words(F.col(f"`{text_col}`")))).alias("_words"),
    )
    rows = template_rows(phrases, templates, k)
    blocks = [rows[i : i + block_runs] for i in range(0, len(rows), block_runs)] or [[]]
    if len(blocks) > 1:
        read = shared.stored(read, "license-words")  # the numbers of rows hold for all blocks
    found = None
    for block in blocks:
        some = _votes(read, block, k, heads=found is None)
        found = some if found is None else found.unionByName(some)
    found = shared.stored(found, "license-votes")
    head = found.filter("_template < 0").select("_row", "_own", "n_words")
    spans = _spans(found.filter("_template >= 0").repartition("_row"), k)
    base = F.when(F.col("_phrase"), F.col("label"))
    start = F.when(F.col("_phrase"), F.col("_start").cast("long"))
    per_row = spans.groupBy("_row").agg(
        F.collect_set("label").alias("_labels"),
        F.collect_set(base).alias("_base"),
        F.count(base).alias("n_base"),
        F.min(start).alias("first_word"),
        F.max(start).alias("last_word"),
        F.max("_share").alias("score"),
    )
    joined = head.join(per_row, "_row", "left")

    def listed(column: str) -> Column:
        return F.coalesce(F.array_join(F.array_sort(column), ","), F.lit(""))

    return joined.select(
        *[F.col("_own")[c].alias(c) for c in names],
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        listed("_base").alias("base_labels"),
        listed("_labels").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
