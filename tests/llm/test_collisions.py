"""Two strings of 1,024 letters that every polynomial hash modulo 2^64 takes for equal."""

import re
import zlib

import numpy as np
import pytest

from tests.llm import brute
from tidewell.llm import best_fit, jaccard_join, piece_sampling, suffix_dedup, token_counts, token_files
from tidewell.llm.bytehash import Keyed, Rolling
from tidewell.llm.tokens import Encoder, vocabulary

BITS = [bin(i).count("1") % 2 for i in range(1024)]
ONE, TWO = ("".join("ab"[b ^ x] for b in BITS) for x in (0, 1))
DOCS = [(1, ONE), (2, TWO)]


def docs(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


def test_the_strings_collide_and_the_keyed_hash_tells_them_apart():
    data = np.frombuffer((ONE + TWO).encode(), np.uint8)
    begin, end = np.array([0, 1024]), np.array([1024, 2048])
    a, b = Rolling(data).ranges(begin, end)
    assert a == b
    for key in range(50):
        a, b = Keyed(data, key).ranges(begin, end)
        assert a != b
        assert a == Keyed(data[:1024], key).ranges(begin[:1], end[:1])[0]  # the place does not matter
        assert (Keyed(data, key).windows(9) == Keyed(data, key).ranges(np.arange(2040), np.arange(2040) + 9)).all()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_and_spans(name):
    e = Encoder(vocabulary(name))
    for texts in ([ONE, TWO, f"x {TWO} {ONE}"], [TWO], [ONE, TWO]):
        for t, ids, spans in zip(texts, e.encode_all(texts), e.offsets_all(texts)):
            want = e.tokenizer.encode(t, add_special_tokens=False)
            assert ids.tolist() == want.ids and [tuple(x) for x in spans.tolist()] == want.offsets


def test_token_files_and_packing(spark):
    from tokenizers import Tokenizer
    for name, end, rows in (("word_bpe_49k.json", 1, token_files.store_digest(docs(spark), tokenizer=vocabulary("word_bpe_49k.json"), end_id=1)),
                            ("byte_bpe_50k.json", 0, best_fit.pack(docs(spark), tokenizer=vocabulary("byte_bpe_50k.json"), end_id=0, capacity=2048))):
        tok = Tokenizer.from_file(vocabulary(name))
        want = {i: zlib.crc32(np.array([*tok.encode(t, add_special_tokens=False).ids, end], "<u4").tobytes()) for i, t in DOCS}
        assert {r.doc_id: r.ids_crc32 for r in rows.collect()} == want


def test_token_counts(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.section_tokens(docs(spark), tokenizer=vocabulary("byte_bpe_50k.json")).collect()}
    assert got == {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in DOCS}


def test_sampled_pieces_are_those_of_the_text(spark):
    model = vocabulary("piece_bpe_32k.model")
    for rows in (DOCS, DOCS[::-1]):
        got = piece_sampling.sample_segmentations(docs(spark, rows), model=model, k=2).collect()
        assert {(r.doc_id, piece_sampling.decode(model, [r.ids])[0]) for r in got} == set(DOCS)


def test_no_shingle_no_link(spark):
    got = {(r.doc_id, r.component_id) for r in jaccard_join.similar_groups(docs(spark), percent=80).collect()}
    assert got == {(1, 1), (2, 2)}


def test_removed_copies(spark):
    rows = [*DOCS, (3, "c" * 500), (4, ONE + "d")]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removal_digest(docs(spark, rows), length=400).collect()}
    assert got == dict(zip([i for i, _ in rows], brute.repeated([t for _, t in rows], 400)))


def test_removed_text_is_what_remains(spark):
    rows = [(1, "é" * 300 + "x"), (2, "é" * 300 + "y"), (3, None), (4, "z" * 10)]
    got = {r.doc_id: r.text for r in suffix_dedup.removal_digest(docs(spark, rows), length=400).collect()}
    assert got == {1: "x", 2: "y", 3: "", 4: "z" * 10}


def test_passages(spark):
    filler = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"{ONE} {filler}"), (2, f"{TWO} {filler}x y")]
    kept = {r.doc_id: r.text for r in suffix_dedup.without_passages(docs(spark, rows), words=50).collect()}
    assert {i: t.encode() for i, t in kept.items()} == brute.passages_kept(rows, 50)
    assert kept[1] == rows[0][1] and TWO in kept[2] and not re.search(r"w5\b", kept[2])
