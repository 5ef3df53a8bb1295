"""Words that a worker keeps while it encodes."""

from __future__ import annotations

import public_tokenizers

from lexiframe.llm import encode


def test_words_in_use_are_not_asked_for_again(monkeypatch):
    monkeypatch.setattr(encode, "CACHE_BYTES", 20_000)
    own = encode.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    asked: list[str] = []
    model = own.tokens.word
    own.tokens.word = lambda word: asked.append(word) or model(word)
    texts = [f"hello world number{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} again" for i in range(600)]
    found = [ids.tolist() for text in texts for ids in own.ids([text])]
    want = [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert found == want
    assert asked.count("hello") == asked.count(" world") == 1
    assert own.tokens.kept <= 2 * encode.CACHE_BYTES and len(own.tokens.older) < 300
