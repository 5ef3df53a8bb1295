"""Toxicity by weighted finite-state patterns over clauses.

Words are read as classes: insult, threat, target, negation, report, other. Small transducers for
insults, threats, targets, negation and reported speech are composed into one machine, which reads a
clause and gives its best reading with a weight. Weights and the insult lexicon (words, and stems of
words) are learned from labelled rows; a document is scored by the clauses that match, not by words.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiframe.llm import shared, words

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Own short word lists of the grammar, in four languages.
TARGETS = "you your he she they him her them we us du ihr dich euch sie er tu vous toi il elle tú usted vosotros él ella"
NEGATIONS = "not never no none neither nor cannot nicht nie kein keine ne pas jamais aucun nunca jamás tampoco"
REPORTS = "said says wrote writes called quoted quote sagte schrieb nannte dit disait écrit dijo escribió llamó"
THREATS = "kill murder hurt beat stab töten umbringen schlagen tuer frapper matar golpear"

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.!?;:\n]+")
_NEAR = 3

#: Readings of a clause: prior share of toxic documents, used until labels say otherwise.
PRIORS = {
    "insult": 0.8,
    "insult+target": 0.9,
    "insult+negated": 0.3,
    "insult+reported": 0.4,
    "threat+target": 0.8,
    "threat+target+negated": 0.2,
    "threat+target+reported": 0.3,
}


class Transducer:
    """States 0.., arcs (state, class) -> (state, output, weight); a class without an arc loops.

    An output is a mark or "", weights add up along a path; every state may end a clause.
    """

    def __init__(self, arcs: dict[tuple[int, str], tuple[int, str, float]]):
        self.arcs = arcs

    def step(self, state: int, word: str) -> tuple[int, str, float]:
        return self.arcs.get((state, word), (state, "", 0.0))


class Composed:
    """The machine whose states are pairs: the second transducer also reads the first one's marks."""

    def __init__(self, first, second: Transducer):
        self.first, self.second = first, second
        self.cache: dict = {}

    def step(self, state, word: str):
        key = (state, word)
        if key not in self.cache:
            a, mark, weight = self.first.step(state[0], word)
            b, own, more = self.second.step(state[1], word)
            for event in mark.split("+") if mark else ():
                b, other, extra = self.second.step(b, f"<{event}>")
                own, more = (own + "+" + other).strip("+"), more + extra
            marks = "+".join(x for x in (mark, own) if x)
            self.cache[key] = ((a, b), marks, weight + more)
        return self.cache[key]


def near(word: str, mark: str, weight: float, *events: str) -> Transducer:
    """Marks events within `_NEAR` words after `word`."""
    arcs: dict = {}
    for state in range(_NEAR + 1):
        for kind in ("insult", "threat", "target", "negation", "report", "other"):
            arcs[(state, kind)] = (_NEAR if kind == word else max(state - 1, 0), "", 0.0)
        if state:
            for event in events:
                arcs[(state, f"<{event}>")] = (state, mark, weight)
    return Transducer(arcs)


def after(word: str, mark: str, weight: float, *events: str) -> Transducer:
    """Marks events anywhere after `word` in the clause."""
    arcs: dict = {(0, word): (1, "", 0.0), (1, word): (1, "", 0.0)}
    arcs |= {(1, f"<{event}>"): (1, mark, weight) for event in events}
    return Transducer(arcs)


def grammar() -> Composed:
    insult = Transducer({(0, "insult"): (0, "insult", 1.0)})
    threat = Transducer({(0, "threat"): (0, "threat", 1.0)})
    target = after("target", "target", 0.5, "insult", "threat")
    negation = near("negation", "negated", -1.0, "insult", "threat")
    report = after("report", "reported", -0.7, "insult", "threat")
    machine = Composed(insult, threat)
    for part in (target, negation, report):
        machine = Composed(machine, part)
    return machine


_START = ((((0, 0), 0), 0), 0)


@dataclass
class Model:
    """`words` match whole words, `stems` their beginnings, once the document has so many of them."""

    words: frozenset[str]
    stems: dict[str, int]
    shares: dict[str, float] = field(default_factory=lambda: dict(PRIORS))
    base: float = 0.05

    def __post_init__(self):
        kinds = {"target": TARGETS, "negation": NEGATIONS, "report": REPORTS, "threat": THREATS}
        self.classes = {w: kind for kind, listed in kinds.items() for w in listed.split()}
        self.machine = grammar()
        events = sorted({*self.words, *THREATS.split()}, key=lambda w: (-len(w), w))
        whole = "|".join(map(re.escape, events))
        self.prefixes = tuple(sorted(self.stems, key=lambda w: (-len(w), w)))
        begun = "|".join(map(re.escape, self.prefixes))
        end = r"(?![^\W\d_])"
        parts = [f"(?:{whole}){end}" if whole else "", f"(?:{begun})" if begun else ""]
        self.spot = re.compile(r"(?<![^\W\d_])(?:" + "|".join(p for p in parts if p) + ")")

    def __getstate__(self):
        return (self.words, self.stems, self.shares, self.base)

    def __setstate__(self, state):
        self.words, self.stems, self.shares, self.base = state
        self.__post_init__()

    def kind(self, word: str, stems: tuple[str, ...]) -> str:
        if word in self.words or word.startswith(stems):
            return "insult"
        return self.classes.get(word, "other")

    def reading(self, clause: str, stems: tuple[str, ...]) -> str | None:
        """The reading of the clause's heaviest event; threats need a target."""
        state, best, most = _START, None, -math.inf
        for word in _WORD.findall(clause):
            state, marks, weight = self.machine.step(state, self.kind(word, stems))
            if not marks:
                continue
            found = set(marks.split("+"))
            event = "insult" if "insult" in found else "threat"
            if event == "threat" and "target" not in found:
                continue
            shape = [event, *(["target"] if event == "threat" else [])]
            softened = [m for m in ("negated", "reported") if m in found]
            if softened:
                shape.append(softened[0])
            elif event == "insult" and "target" in found:
                shape.append("target")
            if weight > most:
                best, most = "+".join(shape), weight
        return best

    def clauses(self, text: str) -> list[str]:
        """Readings of the clauses that match. Only clauses that hold an event word are read."""
        text = text.lower()
        hits = [(hit.start(), hit[0]) for hit in self.spot.finditer(text)]
        if not hits:
            return []
        often = Counter(stem for at, _ in hits for stem in self.prefixes if text.startswith(stem, at))
        stems = tuple(stem for stem, n in often.items() if n >= self.stems[stem])
        found, done = [], -1
        for start, word in hits:
            if start < done or not (word in self.words or word in self.classes or text.startswith(stems, start)):
                continue
            stop = _CLAUSE.search(text, start)
            done = stop.start() if stop else len(text)
            begin = max(text.rfind(c, 0, start) for c in ".!?;:\n") + 1
            reading = self.reading(text[begin:done], stems)
            if reading:
                found.append(reading)
        return found

    def score(self, text: str | None) -> float:
        """Share of toxic documents: the base without a match, else a noisy-or of the best three."""
        found = self.clauses(text) if text else []
        if not found:
            return self.base
        left = 1.0
        for share in sorted((self.shares[r] for r in found), reverse=True)[:3]:
            left *= 1 - share
        return min(max(1 - left, 0.0), 1.0)


def _learned(toxic: Counter, clean: Counter, n_toxic: int, n_clean: int) -> tuple[set[str], dict[str, int]]:
    """Words and stems that mark toxic documents far beyond chance.

    Features are "word", or "stem*k" for at least k words that begin with the stem. A stem gives way
    to a longer feature that keeps nearly all of its documents, so a lone word stays a word and a
    family of words becomes its common stem; of a stem's k, the one with most documents stays.
    """
    rate = n_toxic / max(n_toxic + n_clean, 1)
    chosen = {}
    for feature, n in toxic.items():
        other = clean[feature]
        # Surprise of so many toxic documents in nats, and a bound on those that are clean.
        share = n / (n + other)
        surprise = n * math.log(share / rate) + (other * math.log((1 - share) / (1 - rate)) if other else 0)
        if share >= 0.8 and surprise > 14 + math.log(len(toxic)) / 2:
            chosen[feature] = n
    words = {f for f in chosen if "*" not in f}
    best: dict[str, tuple[int, int]] = {}
    for feature, n in chosen.items():
        stem, star, k = feature.partition("*")
        if star:
            best[stem] = max(best.get(stem, (0, 0)), (n, -int(k)))
    longest = max(map(len, [*words, *best]), default=0)
    reach: dict[str, int] = {}  # documents of the best longer feature below a stem
    for name, n in [*((w, chosen[w]) for w in words), *((s, n) for s, (n, _) in best.items())]:
        for size in range(3, min(len(name) + (name in words), longest + 1)):
            reach[name[:size]] = max(reach.get(name[:size], 0), n)
    stems = {s: -k for s, (n, k) in best.items() if reach.get(s, 0) < 0.95 * n}
    always = tuple(s for s, k in stems.items() if k == 1)
    stems = {s: k for s, k in stems.items() if not any(s != t and s.startswith(t) for t in always)}
    return {w for w in words if not w.startswith(always or ("\0",))}, stems


def _features(text: str) -> set[str]:
    counts = Counter(_WORD.findall(text.lower()))
    stems: Counter = Counter()
    for word, n in counts.items():
        for size in range(4, min(len(word), 8) + 1):
            stems[word[:size]] += n
    return set(counts) | {f"{stem}*{k}" for stem, n in stems.items() for k in range(1, min(n, 3) + 1)}


_SKETCHES = 4


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smallest hashes of the texts' three-word groups, under several hash functions."""
    for batch in batches:
        for part in shared.slices(batch, "_text"):
            data, offsets = shared.text_bytes(part.column("_text"))
            starts, ends, firsts = words.split(words.LOWER[data], offsets)
            grams = words.grams(words.hashes(words.LOWER[data], starts, ends), 3)
            rows = []
            for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
                own = grams[a : max(b - 2, a)]
                if len(own):
                    seeds = range(_SKETCHES)
                    rows.append([int(words.mix(own + np.uint64(i)).min() >> np.uint64(1)) for i in seeds])
                else:
                    rows.append([-a - 1] * _SKETCHES)
            columns = [*(part.column(c) for c in ("_id", "_text", "_toxic")), pa.array(rows, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_text", "_toxic", "h"])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    most_rows: int = 8000,
) -> Model:
    """A model from at most `most_rows` labelled rows, chosen by a hash of the id; equal texts teach
    once, and of near copies the one with the smallest (id, label, text), 0 before 1. Rows with a null
    id, text or label teach nothing; without labels the priors hold."""
    taken = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .select(F.col(id_col).alias("_id"), (F.col(label_col) == 1).alias("_toxic"))
        .orderBy(F.xxhash64("_id"), "_id", "_toxic")
        .limit(most_rows)
    )
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    sample = rows.filter(F.col("_text").isNotNull()).join(F.broadcast(taken), "_id")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sample.select("_id", "_text", "_toxic").schema)
    sample = sample.select("_id", "_text", "_toxic").mapInArrow(_sketch, f"{fields}, h array<long>")
    for i in range(_SKETCHES):
        # Near copies agree in most of these; their words must not count as often as they are copied.
        # The row with the smallest (id, label, text) stays, so a repeated task chooses the same.
        least = F.min(F.struct("_id", "_toxic", "_text", "h")).alias("r")
        sample = sample.groupBy(F.col("h")[i]).agg(least).select("r.*")
    sample = shared.stored(sample.select("_text", "_toxic"), "toxic-sample")
    sizes = dict(map(tuple, sample.groupBy("_toxic").count().collect()))
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)

    def count(frame: DataFrame, known: frozenset[str] | None, least: int) -> Counter:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in shared.slices(batch, "_text"):
                    own: Counter = Counter()
                    for text in part.column("_text").to_pylist():
                        found = _features(text)
                        own.update(found if known is None else found & known)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own.keys(), pa.string()), pa.array(own.values(), pa.int64())], ["f", "n"]
                    )

        sums = frame.select("_text").mapInArrow(run, "f string, n long").groupBy("f").agg(F.sum("n").alias("n"))
        return Counter(dict(map(tuple, sums.filter(F.col("n") >= least).collect())))

    # A feature needs some toxic documents to stand out; fewer candidates than sampled words result.
    toxic = count(sample.filter("_toxic"), None, 5)
    clean = count(sample.filter("NOT _toxic"), frozenset(toxic), 1) if toxic else Counter()
    lexicon, stems = _learned(toxic, clean, n_toxic, n_clean) if toxic and n_clean else (set(), {})
    model = Model(frozenset(lexicon), stems)
    return _calibrated(model, sample)


def _calibrated(model: Model, sample: DataFrame, weight: float = 2.0) -> Model:
    """Shares of toxic documents by strongest reading, and among documents without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.slices(batch, "_text"):
                own: Counter = Counter()
                for text, toxic in zip(part.column("_text").to_pylist(), part.column("_toxic").to_pylist()):
                    found = model.clauses(text)
                    best = max(found, key=lambda r: (PRIORS[r], r)) if found else ""
                    own[(best, toxic)] += 1
                rows = [{"r": r, "toxic": t, "n": n} for (r, t), n in own.items()]
                yield pa.RecordBatch.from_pylist(
                    rows, pa.schema([("r", pa.string()), ("toxic", pa.bool_()), ("n", pa.int64())])
                )

    sums = sample.select("_text", "_toxic").mapInArrow(run, "r string, toxic boolean, n long")
    counts = {(r, t): n for r, t, n in sums.groupBy("r", "toxic").agg(F.sum("n")).collect()}

    def share(reading: str, prior: float) -> float:
        yes, no = counts.get((reading, True), 0), counts.get((reading, False), 0)
        return (yes + weight * prior) / (yes + no + weight)

    return Model(model.words, model.stems, {r: share(r, p) for r, p in PRIORS.items()}, share("", 0.05))


def toxicity(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """All columns of `docs` with score (0 to 1) and predicted (1 if score >= threshold).

    Null and empty texts have no clause and get the base share. The result columns replace columns
    of the same names; nothing but the text is looked at, and each row is scored by itself.
    """
    added = ["score", "predicted"]
    kept = docs.drop(*added)
    schema = T.StructType(
        [*kept.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )
    # Pickled with its class, so executors need no installed copy of this package.
    shipped = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cloudpickle.loads(shipped.value)
        for batch in batches:
            for part in shared.slices(batch, text_col):
                scores = list(map(own.score, part.column(text_col).to_pylist()))
                columns = [
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= threshold) for s in scores], pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *added])

    return kept.mapInArrow(run, schema)
