"""Token ids of many texts with a public tokenizer, each distinct piece encoded once per worker.

Texts of Latin-1 characters are cut into the words that the tokenizer itself would make, whose ids the
library's model gives. Other texts are cut at single spaces, where both tokenizers start a new word, so the ids of a text are
those of its pieces in order. Pieces repeat far more often than texts do; a worker keeps the ids of
pieces and of words it has met, up to a bound, and only the others go through the tokenizer.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from itertools import chain
from unicodedata import category, is_normalized

import numpy as np
from pyspark import cloudpickle

from lexiframe.llm import shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes that a worker keeps of words met lately, about, as much of words met before those, and half
#: of that of pieces of texts beyond Latin-1; and the longest that is kept.
CACHE_BYTES, LONGEST_KEPT = 80 << 20, 1024
#: Bytes of an entry besides those of its key and its ids.
ENTRY_BYTES = 190

_LETTERS = re.compile(r"([^\W\d_]+)")
_BLANKS = re.compile(r"\s\s")

# The words of the two kinds of vocabularies, as their published patterns cut texts of Latin-1
# characters. Fixed values.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\t\n\x0b\x0c\r \x85\xa0"
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
# Words of letters come first, as no other alternative begins like them.
_SPACED = re.compile(f" ?[{_L}]+|{_ENDINGS}| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_BARE = re.compile(f"[{_L}]+|{_ENDINGS}|[{_N}]|[^{_S}{_L}{_N}]+")

# Byte-level vocabularies write bytes as characters: those that print as themselves, the others as
# the characters from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_AS_CHARACTER = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTED)}


class _Kept(dict):
    """Ids of words met lately; others are asked for, and kept unless they are long.

    Words met before those are asked of `older` first, so words in use are never lost at once.
    """

    def __init__(self, word: Callable[[str], bytes]):
        super().__init__()
        self.word, self.kept = word, 0
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.word(word)
        if len(word) <= LONGEST_KEPT:
            self[word] = ids
            self.kept += len(word) + len(ids) + ENTRY_BYTES
        return ids

    def age(self) -> None:
        """Forget the older words, and begin anew beside those of now."""
        self.older = dict(self)
        self.clear()
        self.kept = 0


def _is_plain(text: str) -> bool:
    """Is the text of Latin-1 characters, and without the beginning of a special token?"""
    if "<|" in text:
        return False
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """`keeps_spaces`: a word's ids depend on the space before it (byte-level vocabularies)."""

    def __init__(self, path: str):
        # A task has one core; the library would start a thread for every core of the machine.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.mark = next(t for t in ("<|endoftext|>", None) if t is None or self.tokenizer.token_to_id(t))
        self.mark_id = self.mark and self.tokenizer.token_to_id(self.mark)
        a, both, capital = self._encode(["a", "a a", "A"])
        self.keeps_spaces = both != a + a
        self.folds = capital == a
        # Words may go to the model alone only if it gives what the whole tokenizer gives.
        self.tokens = _Kept(self._word)
        self.pattern = (_SPACED if self.keeps_spaces else _BARE).findall
        tries = "Hello, it's ÅßÿÀn ² 12½ \x85\n  Zoë--x\0\xad \xa0.".split("|")
        self.direct = b"".join(map(self._word, self._words(tries[0]))) == self._encode(tries)[0]
        # Pieces behind a space, and the first pieces of texts, which have none before them.
        self.pieces: dict[str, bytes] = {}
        self.firsts: dict[str, bytes] = {}
        self.kept = 0
        # Words met lately, and those met before; words in neither are forgotten.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.kept_words = 0

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _words(self, text: str) -> list[str]:
        """The words of a text of Latin-1 characters."""
        return self.pattern(text.lower() if self.folds else text)

    def _word(self, word: str) -> bytes:
        if not (word.isascii() and word.isalnum()):
            word = word.encode().decode("latin-1").translate(_AS_CHARACTER)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _plain_ids(self, texts: list[str]) -> list[bytes]:
        if self.tokens.kept > CACHE_BYTES:
            self.tokens.age()
        get = self.tokens.__getitem__
        return [b"".join(map(get, self._words(t))) for t in texts]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Many words in one call, parted by a special token, at which the tokenizer starts anew."""
        if self.mark is None:
            return self._encode(words)
        groups = [words[i : i + 16] for i in range(0, len(words), 16)]
        texts = [self.mark.join(g) for g in groups]
        out: list[bytes] = []
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            ends = (np.flatnonzero(ids == self.mark_id) * 4).tolist()
            data = ids.tobytes()
            begins = [0, *[x + 4 for x in ends]]
            out += [data[x:y] for x, y in zip(begins, [*ends, len(data)])]
        return out

    def _cut(self, bare: str, first: bool) -> tuple[str, ...]:
        """Parts whose ids together are those of the piece: runs of letters and what is between.

        Where a word might not end there (apostrophes, runs of blanks, marks that combine, special
        tokens, letters that are none in lower case, unassigned characters), the piece stays whole.
        """
        piece = bare if first or not self.keeps_spaces else " " + bare
        plain = bare.isascii()
        if not plain:
            # The library may know letters that this Python does not.
            if not is_normalized("NFC", bare) or any(category(c) == "Cn" for c in bare):
                return (piece,)
            if self.folds and any(len(x := c.lower()) != 1 or x.isalpha() != c.isalpha() for c in bare if c > "\x7f"):
                return (piece,)
        if bare.isalpha():
            return (piece.lower(),) if plain and self.folds else (piece,)
        if bare[-1:] in (".", ",") and bare[:-1].isalpha():
            word = piece[:-1]
            return (word.lower() if plain and self.folds else word, bare[-1])
        if "'" in piece or "<|" in piece or _BLANKS.search(piece):
            return (piece,)
        parts = _LETTERS.split(piece)
        if not all(x.isalpha() for x in parts[1::2]):
            return (piece,)
        if self.keeps_spaces and parts[0] == " " and len(parts) > 1:
            parts[0:2] = [" " + parts[1]]
        if self.folds:
            parts = [x.lower() if x.isascii() else x for x in parts]
        return tuple(x for x in parts if x)

    def _learn(self, keys: set[str], into: dict[str, bytes], first: bool) -> None:
        """Put the ids of the pieces into a cache."""
        if self.kept_words > CACHE_BYTES // 4:
            self.words, self.older, self.kept_words = {}, self.words, 0
        words, older = self.words, self.older
        cut = [self._cut(key, first) for key in keys]
        wanted = set(chain.from_iterable(cut)).difference(words)
        new = [w for w in wanted if w not in older]
        words.update((w, older[w]) for w in wanted.difference(new))
        odd = [w for w in new if "<|" in w]
        rest = [w for w in new if "<|" not in w] if odd else new
        words.update(zip(rest, self._encode_words(rest)))
        words.update(zip(odd, self._encode(odd)))
        self.kept_words += sum(map(len, wanted)) + ENTRY_BYTES * len(wanted)
        get = words.__getitem__
        found = [get(parts[0]) if len(parts) == 1 else b"".join(map(get, parts)) for parts in cut]
        into.update(zip(keys, found))
        self.kept += sum(map(len, keys)) + sum(map(len, found)) + ENTRY_BYTES * len(keys)
        for word in [w for w in wanted if len(w) > LONGEST_KEPT]:
            self.kept_words -= len(word) + ENTRY_BYTES
            del words[word]

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text as unsigned 32-bit numbers."""
        plain = [self.direct and _is_plain(t) for t in texts]
        simple = self._plain_ids([t for t, own in zip(texts, plain) if own])
        others = self._other_ids([t for t, own in zip(texts, plain) if not own])
        simple, others = iter(simple), iter(others)
        return (np.frombuffer(next(simple if own else others), np.uint32) for own in plain)

    def _other_ids(self, texts: list[str]) -> list[bytes]:
        pieces, firsts = self.pieces, self.firsts
        if self.kept > CACHE_BYTES // 2:
            pieces.clear()
            firsts.clear()
            self.kept = 0
        cut: list[list[str]] = []
        for text in texts:
            if self.keeps_spaces and "  " in text:
                cut.append([])  # a run of spaces is cut otherwise; these texts go whole
            else:
                cut.append(text.split(" "))
        missing = set().union(*[own[1:] for own in cut]).difference(pieces)
        begun = {own[0] for own in cut if own}.difference(firsts)
        self._learn(missing, pieces, False)
        self._learn(begun, firsts, True)
        get = pieces.__getitem__
        found = [
            firsts[own[0]] + b"".join(map(get, own[1:])) if own else self._encode([text])[0]
            for text, own in zip(texts, cut)
        ]
        for cache, keys in ((pieces, missing), (firsts, begun)):
            for key in [k for k in keys if len(k) > LONGEST_KEPT]:
                self.kept -= len(key) + len(cache.pop(key)) + ENTRY_BYTES
        return found


def encoder(path: str) -> Encoder:
    """The worker's encoder for this vocabulary, made once for all its tasks."""
    state = shared.worker_state()
    if path not in state:
        state[path] = Encoder(path)
    return state[path]
