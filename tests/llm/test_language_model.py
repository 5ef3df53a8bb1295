from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lexiframe.llm import language

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("unknown", ["de", "en"])
def test_a_language_left_out_is_rejected(spark, unknown):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter(F.length("text") > 20)
    model = language.fit(docs.filter(F.col("lang") != unknown).filter(~language.held_out()))
    told = language.identify(docs.filter((F.col("lang") == unknown) | language.held_out()), model)
    counts = {(r["u"], r["rejected"]): r["count"] for r in told.groupBy((F.col("lang") == unknown).alias("u"), "rejected").count().collect()}
    kept, gone = counts.get((True, False), 0), counts[(True, True)]
    assert kept <= 0.04 * (kept + gone)
    assert counts.get((False, True), 0) <= 0.01 * counts[(False, False)]


def test_short_foreign_texts_are_rejected(spark, docs):
    model = language.fit(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    rows = [
        (1, "Bugün hava çok güzel ve çocuklar parkta oynuyor."),
        (2, "Tänään sää on kaunis ja lapset leikkivät puistossa."),
        (3, "Dzisiaj jest piękna pogoda i dzieci bawią się w parku."),
    ]
    assert all(r["rejected"] for r in language.identify(docs(rows), model).collect())


def test_every_labelled_language_is_learned(spark, docs):
    import random

    def text(language, seed):
        rng = random.Random(f"{language} {seed}")
        words = random.Random(language)
        own = ["".join(words.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(12)]
        return " ".join(rng.choice(own) for _ in range(20))

    names = [f"l{i:02}" for i in range(80)]
    teach = [(text(name, i), name) for n, name in enumerate(names) for i in range(9 + n % 3)]
    model = language.fit(spark.createDataFrame(teach, "text string, lang string"))
    assert model.languages == names
    told = language.identify(docs([(i, text(name, "new")) for i, name in enumerate(names)]), model)
    found = {r["doc_id"]: (r["lang_pred"], r["rejected"]) for r in told.collect()}
    assert found == {i: (name, False) for i, name in enumerate(names)}


def test_copies_of_a_text_teach_once(spark, monkeypatch):
    hot = ("the same sentence, again and again", "en")
    others = [(f"{a} and {b} went home", "en") for a in ("ann", "bob", "cat", "dan") for b in ("eve", "fay", "gil")]
    frame = spark.createDataFrame([hot] * 3000 + others, "text string, lang string")
    sizes = []
    cluster = language.cluster
    monkeypatch.setattr(language, "cluster", lambda rows, k: sizes.append(len(rows)) or cluster(rows, k))
    language.fit(frame, most_rows=100)
    language.fit(frame, most_rows=10)
    assert sizes == [13, 10]
