from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiframe.llm import decontaminate, language, toxicity

FOLDER = "/root/testdata/sf0.01"


def test_held_out_languages_are_told(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.fit(docs.filter(~language.held_out()), most_rows=400)
    told = language.identify(docs.filter(language.held_out()), model)
    rows = told.select("lang", "lang_pred", "rejected", "score").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    assert not any(r["rejected"] for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark, docs):
    schema = "doc_id long, text string, lang string"
    teach = [(i, f"the cat number {i} and the dog", "en") for i in range(9)]
    teach += [(i + 20, f"der hund und die katze {i}", "de") for i in range(9)] + [(50, None, "en"), (51, "12", "fr")]
    model = language.fit(spark.createDataFrame(teach, schema), clusters=3)
    assert model.languages == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "12 ?!"), (4, "The DOG"), (4, "the dog"), (5, "日本語の文章です"), (None, "die katze " * 300_000)]
    out = language.identify(docs(rows), model)
    found = [(r["doc_id"], r["lang_pred"], r["rejected"]) for r in out.collect()]
    assert found[:3] == [(1, "und", True), (2, "und", True), (3, "und", True)]
    assert found[3:5] == [(4, "en", False)] * 2
    assert found[5][2]
    assert found[6] == (None, "de", False)
    assert out.columns[-3:] == ["lang_pred", "score", "rejected"]
    assert language.identify(docs([]), model).collect() == []
    signs = docs([(i, t) for i, t in enumerate(["½", "² 3", "Ⅷ", "٣", "_", "ª", "ʰ", "ß"])])
    assert [r["lang_pred"] == "und" for r in language.identify(signs, model).collect()] == [True] * 5 + [False] * 3
    nothing = language.fit(spark.createDataFrame([], schema))
    assert [r["lang_pred"] for r in language.identify(docs(rows[3:4]), nothing).collect()] == ["und"]


def plain_language(model, text):
    """(language, cosine, rejected) with one loop over n-grams and one over all centroids."""
    if not any(unicodedata.category(c)[0] == "L" for c in text or ""):
        return "und", 0.0, True
    letters = [b if b >= 128 or 97 <= b <= 122 else 32 for b in text.lower().encode()]
    data = b" ".join(bytes(letters).split())
    counts = Counter()
    for n in (1, 2, 3, 4):
        for i in range(len(data) - n + 1):
            code = n
            for b in data[i : i + n]:
                code = (code * 257 + b) % 2**32
            counts[code * 2654435761 % 2**32 >> 18] += 1
    weights = {slot: math.log1p(c) * float(model.idf[slot]) for slot, c in counts.items()}
    length = math.sqrt(sum(w * w for w in weights.values())) or 1.0
    cosines = [sum(w / length * float(row[slot]) for slot, w in weights.items()) for row in model.centroids]
    best = max(range(len(cosines)), key=lambda c: (cosines[c], -c))
    language = model.owner[best]
    asked = model.floor[language] * min(1, math.sqrt(sum(counts.values()) / 256))
    return model.languages[language], min(max(cosines[best], 0.0), 1.0), cosines[best] < asked


def test_languages_like_plain_loops(spark, docs, sample):
    model = language.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter(~language.held_out()), clusters=3)
    rows = [(i, t[:3000]) for i, t in sample[:60]]
    rows += [(1000, None), (1001, ""), (1002, "12 ²"), (1003, "ß"), (1004, "日本語"), (1005, "zq zq xw " * 40), (1006, "The, und; que")]
    got = {r["doc_id"]: r for r in language.identify(docs(rows), model).collect()}
    for doc, text in rows:
        name, cosine, rejected = plain_language(model, text)
        assert (got[doc]["lang_pred"], got[doc]["rejected"]) == (name, rejected)
        assert abs(got[doc]["score"] - cosine) < 1e-5
    assert {r["lang_pred"] for r in got.values()} > {"und"}


def test_long_texts_are_counted_whole(monkeypatch):
    text = "Das ist ein längerer Text, der in Stücken gezählt wird. " * 50
    whole = language.features(text)
    monkeypatch.setattr(language, "_STEP", 97)
    assert np.array_equal(whole, language.features(text))


@pytest.fixture(scope="module")
def model():
    return toxicity.Model(frozenset({"idiot", "moron"}), {"vequ": 1, "lo": 2})


@pytest.mark.parametrize(
    "text, readings",
    [
        ("You are an idiot.", ["insult+target"]),
        ("What an idiot", ["insult"]),
        ("Nobody here is not an idiot! moron", ["insult+negated", "insult"]),
        ("She said that moron left; fine", ["insult+reported"]),
        ("not so long ago there was one big idiot", ["insult"]),
        ("We will kill time", ["threat+target"]),
        ("kill the process", []),
        ("la vequade. le vequi et veque", ["insult", "insult"]),
        ("lo", []),
        ("lo\nloma", ["insult", "insult"]),
        ("idiotic morons", []),
        ("", []),
    ],
)
def test_readings(model, text, readings):
    assert model.clauses(text) == readings


def test_scores_rank_readings(model):
    plain, negated, reported, none = map(
        model.score, ["you idiot", "he is not an idiot", "they wrote idiot", "hello"]
    )
    assert plain > reported > negated > none
    assert model.score(None) == model.score("") == none
    assert model.score("idiot. " * 50_000) <= 1


def test_toxic_documents_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(docs, labels.filter(~language.held_out()))
    out = toxicity.toxicity(docs.filter(language.held_out()), model).join(labels, "doc_id")
    counts = {(r["toxic"], r["predicted"]): r["count"] for r in out.groupBy("toxic", "predicted").count().collect()}
    assert counts[(1, 1)] >= 0.9 * (counts[(1, 1)] + counts.get((1, 0), 0))
    assert counts.get((0, 1), 0) <= 0.03 * counts[(0, 0)]


def test_toxicity_edges(spark, docs):
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None), (3, 0)], "doc_id long, toxic int")
    frame = docs([(1, "moron"), (2, None), (3, ""), (3, ""), (None, "x")])
    model = toxicity.fit(frame, labels)
    rows = toxicity.toxicity(frame, model).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
    none = toxicity.fit(docs([]), labels)
    assert toxicity.toxicity(docs([]), none).collect() == []


def test_the_smallest_of_near_copies_teaches(spark, docs):
    near = [(i, "you are a moron and a fool " * 20 + ("" if i != 4 else "x")) for i in range(2, 40)]
    rows = near + [(100 + i, f"a calm text number {i} about the weather of day {i * 7}") for i in range(30)]
    labels = [(i, int(i == 2)) for i, _ in near] + [(100 + i, 0) for i in range(30)] + [(2, 0)]
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    models = [toxicity.fit(docs(rows).repartition(n), table.repartition(n)) for n in (1, 3, 7)]
    assert models[0] == models[1] == models[2]


def brute_hits(rows, items, window=10):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows = []
    for item, text in items:
        own = fold(text)
        size = min(window, len(own))
        windows += [(item, tuple(own[i : i + size])) for i in range(len(own) - size + 1) if size]
    out = []
    for doc, text in rows:
        own, hit, names = fold(text), set(), set()
        for item, win in windows:
            for i in range(len(own) - len(win) + 1):
                if tuple(own[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    names.add(str(item))
        out.append((doc, len(own), len(hit), sorted(names)))
    return sorted(out, key=str)


def judged(frame, benchmark):
    rows = decontaminate.contamination(frame, benchmark).select("doc_id", "n_words", "n_hit", "items").collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("block", [None, 500])  # bytes of items in one automaton
def test_contamination_like_brute_force(spark, docs, monkeypatch, block):
    if block:
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    import random

    rng = random.Random(4)
    words = ["a", "b", "c", "É"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 4, 7, 10, 11, 25])))) for i in range(25)]
    items = [(i, t) for i, t in items if len(t) > 1] + [(90, None), (91, ""), (92, "!?"), (None, "a b"), (93, "b b b b"), (94, "b B b b")]
    rows = [(i, ", ".join(rng.choice(words) for _ in range(rng.randrange(120)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "B b-b\nB"), (102, "B b-b\nB"), (None, "b b b b c")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    known = [(i, t) for i, t in items if i is not None]
    assert judged(docs(rows), benchmark) == brute_hits(rows, known)
    assert judged(docs([]), benchmark) == []
    assert judged(docs(rows[:3]), benchmark.limit(0)) == brute_hits(rows[:3], [])


def test_texts_are_cut_alike_with_several_automata(spark, docs, sample, monkeypatch):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    frame = docs(sample).withColumnRenamed("_id", "_row")
    whole = [r.asDict() for r in decontaminate.strip_spans(frame, benchmark).collect()]
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 4000)
    parts = decontaminate.strip_spans(frame, benchmark)
    assert parts.schema == frame.schema
    assert sorted(map(str, (r.asDict() for r in parts.collect()))) == sorted(map(str, whole))


def test_spans_are_cut_and_documents_dropped(spark, docs):
    item = "one two three four five six seven eight nine ten eleven"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    frame = docs([(1, f"Before, {item.upper()}! After."), (2, "clean"), (3, None)])
    cut = {r["doc_id"]: r["text"] for r in decontaminate.strip_spans(frame, benchmark).collect()}
    assert cut == {1: "Before, ! After.", 2: "clean", 3: None}
    kept = decontaminate.drop_contaminated(frame, benchmark)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    kept = decontaminate.drop_contaminated(frame, benchmark, max_span=11, max_coverage=0.9)
    assert kept.count() == 3
