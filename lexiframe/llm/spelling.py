"""Spelling variants: words one edit apart, found by probing Bloom filters with generated edits.

The vocabulary is split by word length into filters of 64-bit blocks. Each word generates its
deletions and its replacements by a later letter; that names every pair one edit apart once, as an
insertion is a deletion seen from the longer word. Edits are hashed without being spelled out
and probed against the filters; only edits that pass become strings and are joined to the vocabulary, which
removes the false positives.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.llm import shared
from lexiframe.llm.words import mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words a filter is made for at most; a length with more words has several filters.
FILTER_WORDS = 1 << 18
#: Bytes of filters that are broadcast at once; more filters are further rounds over the words.
ROUND_BYTES = 32 << 20
BITS_PER_WORD, LEAST_BLOCKS = 24, 64
#: Edits that are hashed in one step.
STEP = 1 << 20
#: Lengths from here on share a filter with the other lengths up to the next power of two.
LONG = 64

_BASE = np.uint64(0x9E3779B97F4A7C15)
_CODES = mix(np.arange(1, 257, dtype=np.uint64))


def runs_of(text: str, shortest: int) -> list[str]:
    """Maximal runs of letters with at least `shortest` of them, A-Z lower-cased."""
    lowered = text.encode().lower().decode()  # bytes lower-case A-Z only
    return re.findall(f"[a-zÀ-ÿ]{{{shortest},}}", lowered)


def spelled(doc_id: int | None, run: str, drop_every: int) -> str:
    """The run, or the run without one letter where its document's checksum says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % drop_every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(
    docs: DataFrame, shortest: int = 6, least: int = 5, drop_every: int = 199, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(word, n) of every word with at least `shortest` letters and `least` occurrences."""
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter("_text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for part in shared.slices(batch, "_text"):
                for doc, text in zip(part.column("_id").to_pylist(), part.column("_text").to_pylist()):
                    for word, n in Counter(runs_of(text, shortest)).items():
                        counts[spelled(doc, word, drop_every)] += n
                if len(counts) > 200_000:
                    yield flush()
        yield flush()

    counted = texts.mapInArrow(run, "word string, n long").filter(F.char_length("word") >= shortest)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def length_class(length: int) -> int:
    """The filter group of a length: itself, or for long words the power of two above it."""
    return length if length < LONG else LONG + (length // LONG).bit_length()


def powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(codes: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row of letters, before the final mix."""
    return (_CODES[codes] * powers(codes.shape[1])[::-1]).sum(axis=1, dtype=np.uint64)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, letters as a matrix) of the words of each length. A letter is one byte of Latin-1."""
    data = [w.encode("latin-1") for w in words]
    lengths = np.array(list(map(len, data)), np.int64)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        rows = max(1, STEP // max(int(length), 1))
        for first in range(0, len(at), rows):
            some = at[first : first + rows]
            codes = np.frombuffer(b"".join(data[i] for i in some), np.uint8)
            yield some, codes.reshape(len(some), length)


def filter_key(mixed: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and the bits in it. Five bits, from parts of the hash that the block does not use."""
    high = (mixed >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
    bits = np.zeros(len(mixed), np.uint64)
    for i in range(5):
        bits |= np.uint64(1) << ((mixed >> np.uint64(6 * i)) & np.uint64(63))
    return high.astype(np.int64), bits


def part_of(mixed: np.ndarray, parts: int) -> np.ndarray:
    """Which filter of its length a word belongs to, from a hash independent of the filter's own."""
    return (mix(mixed ^ _BASE) % np.uint64(parts)).astype(np.int64)


def filters(words: DataFrame) -> DataFrame:
    """(class, part, parts, n, bits): one row a filter, each for a bounded number of words."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("word").to_pylist()
            h, classes = np.empty(len(own), np.uint64), np.empty(len(own), np.int32)
            for at, codes in by_length(own):
                h[at], classes[at] = mix(word_hashes(codes)), length_class(codes.shape[1])
            columns = [pa.array(classes), pa.array(h.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["class", "h"])

    hashed = shared.stored(words.select("word").mapInArrow(keyed, "class int, h long"), "word-hashes")
    sizes = {c: -(-n // FILTER_WORDS) for c, n in hashed.groupBy("class").count().collect()}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes = batch.column("class").to_numpy()
            h = batch.column("h").to_numpy().view(np.uint64)
            part = np.zeros(len(h), np.int64)
            for c in np.unique(classes):
                part[classes == c] = part_of(h[classes == c], sizes[int(c)])
            columns = [batch.column("class"), pa.array(part), batch.column("h")]
            yield pa.RecordBatch.from_arrays(columns, ["class", "part", "h"])

    def build(table: pa.Table) -> pa.Table:
        h = table.column("h").to_numpy().view(np.uint64)
        blocks = max(LEAST_BLOCKS, -(-len(h) * BITS_PER_WORD // 64))
        bits = np.zeros(blocks, np.uint64)
        at, own = filter_key(h, blocks)
        np.bitwise_or.at(bits, at, own)
        c = table.column("class")[0].as_py()
        row = {"class": c, "part": table.column("part")[0].as_py(), "parts": sizes[c], "bits": bits.tobytes()}
        return pa.Table.from_pylist([row], schema=pa.schema(
            [("class", pa.int32()), ("part", pa.int64()), ("parts", pa.int64()), ("bits", pa.binary())]
        ))

    parted = hashed.mapInArrow(dealt, "class int, part long, h long")
    built = parted.groupBy("class", "part").applyInArrow(build, "class int, part long, parts long, bits binary")
    return shared.stored(built, "filters")


def rounds(sizes: list[tuple[int, int, int]], most: int) -> list[list[tuple[int, int]]]:
    """(class, part, bytes) of filters in groups of at most `most` bytes."""
    found, size = [[]], 0
    for c, part, n in sorted(sizes):
        if found[-1] and size + n > most:
            found.append([])
            size = 0
        found[-1].append((c, part))
        size += n
    return found


class Prober:
    """Generated edits against some of the filters: {class: (number of parts, {part: bits})}."""

    def __init__(self, held: dict[int, tuple[int, dict[int, np.ndarray]]], letters: bytes):
        self.held, self.letters = held, np.frombuffer(letters, np.uint8)

    def passes(self, length: int, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that a filter of this length lets pass."""
        parts, own = self.held[length_class(length)]
        mixed = mix(h)
        if parts == 1:
            return self._inside(mixed, own[0])
        part, found = part_of(mixed, parts), []
        for number, bits in own.items():
            at = np.flatnonzero(part == number)
            found.append(at[self._inside(mixed[at], bits)])
        return np.concatenate(found) if found else np.empty(0, np.int64)

    @staticmethod
    def _inside(mixed: np.ndarray, bits: np.ndarray) -> np.ndarray:
        block, own = filter_key(mixed, len(bits))
        return np.flatnonzero((bits[block] & own) == own)

    def edits(self, codes: np.ndarray) -> Iterator[tuple[int, str]]:
        """(row, edit) of words of one length that the filters let pass."""
        count, length = codes.shape
        up = powers(length)[::-1]
        values = _CODES[codes]
        shares = values * up
        total = shares.sum(axis=1, dtype=np.uint64)
        if length_class(length - 1) in self.held and length > 1:
            lower = np.concatenate((up[1:], np.ones(1, np.uint64)))
            before = np.cumsum(values * lower, axis=1, dtype=np.uint64)
            after = total[:, None] - np.cumsum(shares, axis=1, dtype=np.uint64)
            h = after.copy()
            h[:, 1:] += before[:, :-1]
            # A letter that repeats the one before it gives the same word again.
            fresh = np.ones(codes.shape, bool)
            fresh[:, 1:] = codes[:, 1:] != codes[:, :-1]
            at = np.flatnonzero(fresh)
            for place in at[self.passes(length - 1, h.ravel()[at])]:
                row, i = divmod(int(place), length)
                word = codes[row].tobytes()
                yield row, (word[:i] + word[i + 1 :]).decode("latin-1")
        if length_class(length) in self.held:
            width = max(1, STEP // max(1, len(self.letters) * count))
            for first in range(0, length, width):
                own = codes[:, first : first + width]
                change = _CODES[self.letters] - values[:, first : first + width, None]
                h = total[:, None, None] + change * up[first : first + width][None, :, None]
                at = np.flatnonzero(self.letters > own[:, :, None])
                for place in at[self.passes(length, h.ravel()[at])]:
                    cell, letter = divmod(int(place), len(self.letters))
                    row, i = divmod(cell, own.shape[1])
                    word = bytearray(codes[row].tobytes())
                    word[first + i] = self.letters[letter]
                    yield row, word.decode("latin-1")


def positives(words: DataFrame, held: dict, letters: bytes) -> DataFrame:
    """(edit, other, other_n) of all edits that a filter lets pass; `other` is the edited word."""
    shared_filters = words.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prober = Prober(
            {c: (n, {p: np.frombuffer(b, np.uint64) for p, b in own.items()}) for c, (n, own) in shared_filters.value.items()},
            letters,
        )
        for batch in batches:
            own, n = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            for at, codes in by_length(own):
                found: list[list] = [[], [], []]
                size = 0
                for row, edit in prober.edits(codes):
                    found[0].append(edit)
                    found[1].append(own[at[row]])
                    found[2].append(n[at[row]])
                    size += 2 * len(edit)
                    if size > shared.BLOCK_BYTES:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, found)), ["edit", "other", "other_n"])
                        found, size = [[], [], []], 0
                if found[0]:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, found)), ["edit", "other", "other_n"])

    return words.mapInArrow(run, "edit string, other string, other_n long")


def near_pairs(words: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(word, n, other, other_n): every pair of `words` (word, n) one edit apart, in both directions."""
    built = filters(words)
    sizes = built.select("class", "part", F.octet_length("bits")).collect()
    # Letters in use, at most 90 of them.
    letter = F.explode(F.array_distinct(F.split("word", "")))
    letters = sorted(r[0] for r in words.select(letter.alias("c")).distinct().collect() if r[0])
    spread = words.repartition(shared.shuffle_partitions(words.sparkSession))
    found = None
    for group in rounds([tuple(r) for r in sizes], round_bytes):
        held: dict[int, tuple[int, dict[int, bytes]]] = {}
        wanted = F.struct("class", "part").isin([F.struct(F.lit(c), F.lit(p).cast("long")) for c, p in group])
        for c, part, parts, bits in (built.filter(wanted).collect() if group else []):
            held.setdefault(c, (parts, {}))[1][part] = bytes(bits)
        own = positives(spread, held, "".join(letters).encode("latin-1"))
        found = own if found is None else found.unionByName(own)
    pairs = found.join(words, F.col("edit") == F.col("word")).select("word", "n", "other", "other_n")
    pairs = shared.stored(pairs, "near-words")
    back = pairs.select(
        F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")
    )
    return pairs.unionByName(back)


def roots(forms: DataFrame, least: int, ratio: int, most_n: int) -> DataFrame:
    """(word, root) of `forms` (word, form): where following the forms ends.

    A form has `ratio` times the occurrences of its word, so no chain has more links than powers of
    `ratio` fit between the smallest and the largest number; pointers double their reach each round.
    """
    links = 0
    while least * ratio ** (links + 1) <= most_n:
        links += 1
    current = forms.select("word", F.col("form").alias("root"))
    reach = 1
    while reach < links:
        current = shared.stored(current, "roots")
        step = current.select(F.col("word").alias("_from"), F.col("root").alias("_to"))
        joined = current.join(step, F.col("root") == F.col("_from"), "left")
        current = joined.select("word", F.coalesce("_to", "root").alias("root"))
        reach *= 2
    return current


def spelling_variants(
    docs: DataFrame,
    shortest: int = 6,
    least: int = 5,
    ratio: int = 5,
    drop_every: int = 199,
    id_col: str = "doc_id",
    text_col: str = "text",
    round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the corpus.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, with at least
    `shortest` letters and `least` occurrences over all rows. A run whose checksum with its document's id is a multiple of
    `drop_every` loses one letter. The form of a word is its most frequent neighbour one edit away,
    the smallest of equals, if that has `ratio` times its occurrences. Null and empty texts have no
    words; a null id counts as an empty one; repeated rows count each. Other columns, whatever their
    names, are ignored. An empty table gives no rows.
    """
    words = shared.stored(vocabulary(docs, shortest, least, drop_every, id_col, text_col), "vocabulary")
    pairs = near_pairs(words, round_bytes)
    # The largest number first, then the smallest word.
    first = F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("form"))).alias("b")
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first)
    known = words.join(best, "word", "left")
    strong = -F.col("b.m") >= ratio * F.col("n")
    known = known.select(
        "word",
        F.when(strong, F.col("b.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, -F.col("b.m")).alias("form_n"),
    )
    known = shared.stored(known, "word-forms")
    most_n = known.agg(F.max("n")).first()[0] or 0
    ends = roots(known.filter("form IS NOT NULL"), least, ratio, most_n)
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
