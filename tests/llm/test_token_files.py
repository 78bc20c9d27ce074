import random
import zlib

import numpy as np
import pytest

from tidewell.llm import token_files as tf
from tidewell.llm.tokens import encode, vocabulary
from tidewell.session import scratch

WORDS = vocabulary("word_bpe_49k.json")


def corpus(n=80):
    rng = random.Random(5)
    out = [(i * 3 % 101, " ".join(rng.choice(["tree", "sea", "Of", "wörter", "stone"]) for _ in range(rng.randrange(0, 80)))) for i in range(n)]
    return out + [(500, None), (None, "no key"), (501, "twice"), (501, "twice"), (502, "long " * 20_000)]


def expected(texts):
    rows = sorted(zip(texts, encode(WORDS, [t for _, t in texts]), strict=True), key=lambda r: (r[0][0] is not None, r[0][0] or 0))
    out, start = [], 0
    for (k, _), x in rows:
        x = np.r_[x, 1].astype("<u4")
        out.append((-1 if k is None else k, start, len(x), zlib.crc32(x.tobytes())))
        start += len(x)
    return out


@pytest.mark.parametrize("part,shard", [(1 << 24, 1 << 20), (3000, 200)])
def test_round_trip_in_key_order(spark, monkeypatch, part, shard):
    monkeypatch.setattr(tf, "PART_BYTES", part)
    monkeypatch.setattr(tf, "SHARD_IDS", shard)
    texts = corpus()
    d = spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, start int")
    got = tf.store_digest(d, tokenizer=WORDS, end_id=1).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted(expected(texts))


def test_one_document_is_read_by_its_index(spark):
    texts = corpus()
    path = scratch(spark, "store")
    d = spark.createDataFrame(texts, "doc_id long, text string")
    tf.write(d, path, tokenizer=WORDS, end_id=1)
    for k, t in texts[:5]:
        (ids,) = tf.read_document(spark, path, k)
        assert ids.tolist() == [*next(encode(WORDS, [t])).tolist(), 1]
    assert len(tf.read_document(spark, path, 501)) == 2 and tf.read_document(spark, path, 12345) == []
    assert spark.read.parquet(f"{path}/shards").select("dict_id").distinct().count() == 1
    assert len(tf.dictionary(spark, path)[1]) > 0
    ids = {r.doc_id: r.ids for r in tf.read(spark, path, with_ids=True).collect()}
    assert ids[500] == [1]


def test_empty(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    assert tf.store_digest(d, tokenizer=WORDS, end_id=1).collect() == []
