"""Language identification: nearest of several centroids per language, with rejection by distance.

Texts become TF-IDF vectors of hashed byte n-grams of their letters, scaled to length 1. The centroids
of a language are spherical k-means clusters of its sampled vectors. The model has a fixed size and
travels with the job; documents are judged one by one, without any shuffle.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiframe.llm import shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMENSIONS = 1 << 14
SIZES = (1, 2, 3, 4)
UNDETERMINED = "und"
#: N-grams of a text below which its cosine, and so what a language accepts, falls with their root.
SHORT = 256

# ASCII other than letters parts words; all bytes of other characters are kept.
_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_STEP = 1 << 20


def has_letter(text: str) -> bool:
    """Does the text hold a character of Unicode category L?"""
    return any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of a whole text; long texts are counted piece by piece."""
    counts = np.zeros(DIMENSIONS, np.float32)
    data = b" ".join(text.lower().encode().translate(_LETTERS).split())
    for first in range(0, len(data), _STEP):
        # A piece begins with the end of the one before it, for n-grams across the border.
        for n in SIZES:
            piece = np.frombuffer(data[max(first - n + 1, 0) : first + _STEP], np.uint8)
            if len(piece) < n:
                continue
            code = np.full(len(piece) - n + 1, n, np.uint32)
            for i in range(n):
                code = code * np.uint32(257) + piece[i : len(piece) - n + 1 + i]
            code *= np.uint32(2654435761)
            counts += np.bincount(code >> np.uint32(18), minlength=DIMENSIONS)
    return counts


def unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(lengths > 0, lengths, 1)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # one row each
    owner: np.ndarray  # language of each centroid
    floor: np.ndarray  # least cosine that each language accepts of texts that are not short

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        """The counts as unit vectors, in place."""
        np.log1p(counts, out=counts)
        counts *= self.idf
        lengths = np.linalg.norm(counts, axis=1, keepdims=True)
        counts /= np.where(lengths > 0, lengths, 1)
        return counts

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, cosine with its nearest centroid, rejected) of each text."""
        out: list[tuple[str, float, bool]] = [(UNDETERMINED, 0.0, True)] * len(texts)
        known = [i for i, t in enumerate(texts) if t and has_letter(t)]
        if not known or not self.languages:
            return out
        for first in range(0, len(known), 64):
            part = known[first : first + 64]
            counts = np.stack([features(texts[i]) for i in part])
            reached = reach(counts)
            near = self.vectors(counts) @ self.centroids.T
            best = near.argmax(axis=1)
            for row, (i, c) in enumerate(zip(part, best.tolist())):
                cosine = float(min(max(near[row, c], 0.0), 1.0))
                language = self.owner[c]
                rejected = bool(cosine < self.floor[language] * reached[row])
                out[i] = (self.languages[language], cosine, rejected)
        return out


def reach(counts: np.ndarray) -> np.ndarray:
    """Share of a long text's cosine that can be asked of each text, by its number of n-grams."""
    return np.minimum(1, np.sqrt(counts.sum(axis=1, dtype=np.float64) / SHORT))


def cluster(rows: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; the first centres are the rows farthest from those before them."""
    centres = unit(rows.mean(axis=0, keepdims=True))
    near = rows @ centres[0]
    while len(centres) < min(k, len(rows)):
        far = int(near.argmin())
        centres = np.vstack([centres, rows[far : far + 1]])
        near = np.maximum(near, rows @ rows[far])
    for _ in range(rounds):
        chosen = (rows @ centres.T).argmax(axis=1)
        groups = [rows[chosen == c] for c in range(len(centres))]
        centres = unit(np.stack([g.mean(axis=0) if len(g) else centres[c] for c, g in enumerate(groups)]))
    return centres


def common(centres: np.ndarray, rows: np.ndarray, share: float = 0.02) -> np.ndarray:
    """The centres without those of fewer than `share` of the rows, or of one row: these are rows that
    are not in the language, and would attract whatever is not."""
    sizes = np.bincount((rows @ centres.T).argmax(axis=1), minlength=len(centres))
    return centres[(sizes >= max(2, share * len(rows))) | (sizes == sizes.max())]


def fit(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    order: Column | None = None,
    most_rows: int = 2000,
    least_rows: int = 8,
    clusters: int = 4,
    margin: float = 0.65,
) -> Model:
    """A model of every labelled language from at most `most_rows` rows, the same number of each
    language, chosen by a hash; or from `least_rows` of each if that is more. A language has one
    centroid for each `least_rows` sampled rows, `clusters` at most. Equal texts of a language teach once. Rows with a null text or language,
    or without a letter, teach nothing. `margin` is the share down to which a text is accepted of the
    cosine that 99 of 100 of a language's sampled texts reach (relative to their length, see `reach`);
    it is smaller by 1/sqrt(n + 1) of itself where only n texts are sampled."""
    rows = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = rows.select(
        F.col(text_col).alias("_text"),
        F.col(lang_col).alias("_lang"),
        F.xxhash64(text_col).alias("_key"),
        (order if order is not None else F.xxhash64(text_col)).alias("_order"),
    )
    # Copies of a text count once, here and in the sample.
    counts = rows.groupBy("_lang").agg(F.approx_count_distinct("_key", 0.02).alias("_n"))
    known = counts.collect()
    if not known:
        empty = np.empty(0)
        return Model([], np.ones(DIMENSIONS, np.float32), np.empty((0, DIMENSIONS)), empty, empty)
    each = max(least_rows, most_rows // len(known))
    # Rows whose hash lies in the lowest share of its range; three spreads above the expected bound,
    # and a tenth for the counts, which are not exact.
    shares = [(r["_lang"], min(1.0, 1.1 * (each + 3 * each**0.5) / max(r["_n"], 1))) for r in known]
    limits = labelled.sparkSession.createDataFrame(shares, "_lang string, _limit double")
    place = F.xxhash64("_order").bitwiseAND((1 << 52) - 1) / float(1 << 52)
    sample = rows.join(F.broadcast(limits), "_lang").filter(place < F.col("_limit"))
    sample = sample.groupBy("_lang", "_key").agg(F.min("_order").alias("_order"), F.first("_text").alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("_lang", "_order", "_key")
            told = zip(*(batch.column(n).to_pylist() for n in names))
            for text, row in zip(batch.column("_text"), told):
                text = text.as_py()
                if not has_letter(text):
                    continue
                found = features(text)
                places = np.flatnonzero(found)
                # The driver gathers bytes, not lists.
                packed = places.astype(np.uint16).tobytes(), found[places].tobytes()
                columns = [pa.array([x]) for x in (*row, *packed)]
                yield pa.RecordBatch.from_arrays(columns, [*names, "at", "n"])

    counted = sample.mapInArrow(count, "_lang string, _order long, _key long, at binary, n binary")
    first = Window.partitionBy("_lang").orderBy("_order", "_key")
    bounded = counted.withColumn("_place", F.row_number().over(first)).filter(F.col("_place") <= each)
    taken: dict[str, list] = {}
    for lang, places, numbers in sorted(map(tuple, bounded.select("_lang", "at", "n").collect())):
        own = taken.setdefault(lang, [])
        own.append((np.frombuffer(places, np.uint16), np.frombuffer(numbers, np.float32)))
    document_count = np.zeros(DIMENSIONS, np.float32)
    for own in taken.values():
        for at, _ in own:
            document_count[at] += 1
    total = sum(map(len, taken.values()))
    model = Model(sorted(taken), (np.log((1 + total) / (1 + document_count)) + 1).astype(np.float32), None, None, None)
    centres, owner, floor = [], [], []
    for number, language in enumerate(model.languages):
        rows_of = np.zeros((len(taken[language]), DIMENSIONS), np.float32)
        for row, (at, n) in enumerate(taken[language]):
            rows_of[row, at] = n
        reached = reach(rows_of)
        rows_of = model.vectors(rows_of)
        own = common(cluster(rows_of, max(1, min(clusters, len(rows_of) // least_rows))), rows_of)
        cosines = np.minimum((rows_of @ own.T).max(axis=1) / reached, 1)
        floor.append(margin * (1 - (len(cosines) + 1) ** -0.5) * float(np.quantile(cosines, 0.01)))
        centres.append(own)
        owner += [number] * len(own)
    model.centroids = np.vstack(centres).astype(np.float32)
    model.owner, model.floor = np.array(owner), np.array(floor)
    return model


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of `docs` with lang_pred, score and rejected.

    A null text or one without a letter is `und`, score 0 and rejected; so is every text if nothing
    was learned. Others get the language of the nearest centroid, their cosine with it as score, and
    are rejected if that is below the language's floor, which is lower for short texts. Ties go to the language that sorts first.
    The result columns replace columns of the same names; nothing but the text is looked at.
    """
    added = ["lang_pred", "score", "rejected"]
    kept = docs.drop(*added)
    schema = T.StructType(
        [
            *kept.schema.fields,
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )
    # Pickled with its class, so executors need no installed copy of this package.
    shipped = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cloudpickle.loads(shipped.value)
        for batch in batches:
            for part in shared.slices(batch, text_col):
                found = own.predict(part.column(text_col).to_pylist())
                types = (pa.string(), pa.float64(), pa.bool_())
                columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(types)]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *added])

    return kept.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that no model may learn from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
