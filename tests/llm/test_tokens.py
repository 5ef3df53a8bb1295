from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexiframe.llm import encode, packing, token_files

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a   b ", "don't it's I'LL", "x\n y", "x \n y\n\n z", "\tq\t w",
    "<|endoftext|> a <|endoftext|>", "é É ß ΑΣ ΣΑΣ, Σ.", "é ́x", "12,345. 6 ,7", "word. Word, word.\n", " x  y\x1c z",
    "a.\n\nb", "(x) [y]y 1a2b3c", "THE The tHE!!", "ÉCOLE École", "Ⅷa ²b", "a\u0301b e\u0301", "don't.\nIt's", "a\0 b\0", "...a..b",
    "x\u00a0y \u2003z", "ﬁne ǅ ŉ", "a<|endoftext|>b", "\x85a", "a\u200bb", "_a_", "İI ıi",
    "日本語 テキスト。", "🙂 🙂🙂", "a.b, c.,\n d,\n\n", "__x__ _y", "'s 't", "x\r\n y", "ـ ١٢٣ ४५, ²³.",
]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_give_the_ids_of_whole_texts(path, sample, monkeypatch):
    monkeypatch.setattr(encode, "CACHE_BYTES", 200_000)
    monkeypatch.setattr(encode, "LONGEST_KEPT", 20)
    plain = Tokenizer.from_file(path)
    own = encode.Encoder(path)
    texts = ODD + [t for _, t in sample[:60]] + [" ".join(ODD)]
    for first in range(0, len(texts), 7):
        part = texts[first : first + 7]
        want = [plain.encode(t, add_special_tokens=False).ids for t in part]
        assert [x.tolist() for x in own.ids(part)] == want


def same_as_the_library(own, texts):
    want = own.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    return [t for t, got, e in zip(texts, own.ids(texts), want) if got.tolist() != e.ids]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_zero_characters_and_capitals_that_grow(path):
    texts = ["'B \0", "\0", "\0 \0", "a \0b \0", "İ.", "İ,", "İ-", "(İ)", "bİ:", "x İ. İSTANBUL'da İ", "\0İ \0İ."]
    assert same_as_the_library(encode.Encoder(path), texts) == []


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_every_character_alone_inside_and_before_punctuation(path):
    own = encode.Encoder(path)
    # All of the first planes' letters and signs, and samples beyond.
    codes = [*range(0x3100), *range(0xA640, 0xABFF), *range(0xF900, 0x10FFF, 3), *range(0x11000, 0x32400, 41)]
    for first in range(0, len(codes), 1000):
        chars = [chr(c) for c in codes[first : first + 1000] if not 0xD800 <= c < 0xE000]
        texts = [t for x in chars for t in (x, f"a{x}b", f"Word {x}. {x},x", f"(x{x}) {x}-{x}: {x}É")]
        assert same_as_the_library(own, texts) == []


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_random_texts(path):
    own, rng = encode.Encoder(path), random.Random(3)
    latin = [chr(c) for c in range(256)]
    texts = ["".join(rng.choices(latin, k=rng.randint(0, 12))) for _ in range(4000)]
    texts += ["".join(rng.choices([*"aZé1½ '., \n\t", "'re", "'S", "  ", "\u0101", "\xad", "\xa0"], k=rng.randint(0, 16))) for _ in range(4000)]
    assert same_as_the_library(own, texts) == []
    bits = ["a", "B", "é", "İ", "\0", " ", " ", ".", ",", "'", "ß", "\n", "  ", "1", "ﬁ", "Σ", "word", "-", "<|endoftext|>", "\u00a0"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(6000)]
    assert same_as_the_library(own, texts) == []


def test_caches_stay_within_their_bytes(monkeypatch):
    monkeypatch.setattr(encode, "CACHE_BYTES", 50_000)
    own, rng = encode.Encoder(WORDS), random.Random(4)
    for _ in range(40):
        text = " ".join("".join(rng.choices("abcdefghij", k=rng.randint(3, 40))) for _ in range(100)) + " " + "z" * 5000
        assert same_as_the_library(own, [text, text + " \u0101"]) == []
        for cache, kept, most in ((own.tokens, own.tokens.kept, 50_000), (own.pieces, own.kept, 25_000), (own.words, own.kept_words, 12_500)):
            assert kept < most + 100 * 400 and max(map(len, cache), default=0) <= encode.LONGEST_KEPT


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("most", [0, 3])
def test_token_files_round_trip_in_id_order(spark, docs, sample, tmp_path, most):
    rows = [(5, None), (3, ""), (9, ODD[12]), (3, "again"), (None, "none")] + [(i + 100, t) for i, t in sample[:40]]
    random.Random(1).shuffle(rows)
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", most)  # a task may write several files
    try:
        token_files.write_tokens(docs(rows), path, BYTES, 2, files=4)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    plain = Tokenizer.from_file(BYTES)
    ids = {(i, t): [*plain.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows}
    got = [tuple(r) for r in token_files.token_digests(spark, path).collect()]
    assert sorted((r[0] or -1, r[2], r[3]) for r in got) == sorted((i or -1, len(x), crc(x)) for (i, _), x in ids.items())
    at = 0
    for doc, start, n, _ in sorted(got, key=lambda r: (r[1])):
        assert start == at
        at += n
    order = [r[0] or -1 for r in sorted(got, key=lambda r: r[1])]
    assert order == sorted(order)
    some = token_files.read_tokens(spark, path, [9, 110]).collect()
    assert sorted(r["doc_id"] for r in some) == sorted(i for i, _ in rows if i in (9, 110))
    assert next(list(r["ids"]) for r in some if r["doc_id"] == 9) == ids[(9, ODD[12])]


def test_no_documents_give_no_tokens(spark, docs, tmp_path):
    path = str(tmp_path / "t")
    token_files.write_tokens(docs([]), path, BYTES, 2)
    assert token_files.token_digests(spark, path).collect() == []
    assert packing.pack(docs([]), WORDS).collect() == []


def best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(20))
def test_plan_is_best_fit_in_falling_order(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 20, 64])
    lengths = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 400))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    steps = packing.plan(counts, capacity)
    filled = {}
    for n, count in counts.items():
        own = sorted(s for s in steps if s[0] == n)
        for rank in range(count):
            _, first, sequence, fit, offset = [s for s in own if s[1] <= rank][-1]
            at = rank - first
            filled.setdefault(sequence + at // fit, []).append((offset + at % fit * n, n))
    for places in filled.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end
            end += n
        assert end <= capacity
    assert len(filled) == best_fit(lengths, capacity)


def test_packing_places_every_piece(docs, sample):
    rows = sample + [(9001, None), (9002, ""), (9003, "x"), (9003, "x"), (None, "y"), (9004, "z " * 9000)]
    got = packing.pack(docs(rows), WORDS, capacity=512).collect()
    plain = Tokenizer.from_file(WORDS)
    want = []
    for doc, text in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 512):
            want.append((doc or -1, k // 512, k, len(ids[k : k + 512]), crc(ids[k : k + 512])))
    assert sorted((r[0] or -1, *r[1:5]) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end
            end += n
        assert end <= 512
    assert sorted(by) == list(range(len(by)))
    assert len(by) == best_fit([w[3] for w in want], 512)
