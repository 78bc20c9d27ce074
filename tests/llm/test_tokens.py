import random

import pytest

from tidewell.llm import tokens as tk


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_and_spans_of_whole_texts(name, monkeypatch):
    e = tk.Encoder(tk.vocabulary(name))
    monkeypatch.setattr(tk, "PIECES_KEPT", 200)
    rng = random.Random(1)
    parts = ["tree", " ", "  ", "\n", "\n\n", "\t", "\r\n", "don't", "it's", "42nd", "...", "$%&", "é", "É", "e\u0301", " \u0301", "日本", "İ", "ß", "Σας", "_x_", "\x0b", "\x00", "😀", "</w>", "12345"]
    odd = ["\xa0", "\x1c", "\u2003", "\u3000", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "\x85", "\u2028"]
    texts = ["".join(rng.choice(parts + (odd if i % 3 == 0 else [])) for _ in range(rng.randrange(0, 25))) for i in range(900)]
    monkeypatch.setattr(tk, "SLAB", 500)
    for text, ids, spans in zip(texts, e.encode_all(texts), e.offsets_all(texts), strict=True):
        want = e.tokenizer.encode(text, add_special_tokens=False)
        assert ids.tolist() == want.ids, repr(text)
        assert [tuple(x) for x in spans.tolist()] == want.offsets, repr(text)


def test_given_texts(spark):
    import os
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        e = tk.Encoder(tk.vocabulary(name))
        assert all(x.tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids for t, x in zip(texts, e.encode_all(texts), strict=True))


def test_a_word_is_encoded_once_whatever_sign_follows():
    for name, most in (("word_bpe_49k.json", 1), ("byte_bpe_50k.json", 4)):  # this one tells case and the space before a word apart
        e = tk.Encoder(tk.vocabulary(name))
        asked, real = [], e.tokenize
        e.tokenize = lambda w: asked.append(w) or real(w)  # noqa: B023
        texts = ["harbour harbour, harbour. harbour;", "Harbour Harbour! harbour### Harbour,$$$ harbour"]
        for t, ids in zip(texts, e.encode_all(texts), strict=True):
            assert ids.tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids
        assert sum("arbour" in w for w in asked) <= most


def test_lower_case_is_that_of_the_tokenizer():
    e = tk.Encoder(tk.vocabulary("word_bpe_49k.json"))
    letters = [c for c in map(chr, range(0x250)) if tk.re.fullmatch(f"[{tk.LETTERS}]", c)]
    assert len(letters) > 400 and all(e.tokenizer.normalizer.normalize_str(c) == c.lower() for c in letters)
    marks = [chr(m) for m in range(0x300, 0x370)]
    for t in [*(f"x {c}{m}. {c.lower()}{m},{c}" for c in map(chr, range(65, 91)) for m in marks), "<|EndOfText|>a", "A.̸ B≠", "ΑΣ, aΣ."]:
        assert e.encode_all([t])[0].tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids, ascii(t)
