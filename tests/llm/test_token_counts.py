import random

import numpy as np
import pytest

from tidewell.llm import token_counts as tc
from tidewell.llm.tokens import encoder, vocabulary

BPE = vocabulary("byte_bpe_50k.json")


def plain(text, cuts, rule):
    """Tokens of each section by looking at every character."""
    e = encoder(BPE).tokenizer.encode(text, add_special_tokens=False)
    section = lambda c: max(i for i, x in enumerate(cuts) if x <= c)
    counts, crossing = [0] * len(cuts), [0] * len(cuts)
    for a, b in e.offsets:
        at = [section(c) for c in range(a, b)] or [section(a)]
        to = at[0] if rule == "first" else at[-1] if rule == "last" else min(set(at), key=lambda s: (-at.count(s), s))
        counts[to] += 1
        crossing[to] += len(set(at)) > 1
    return counts, crossing


@pytest.mark.parametrize("rule", tc.RULES)
def test_lines(spark, rule):
    rng = random.Random(1)
    texts = [(i, "".join(rng.choice(["tree", " sea", "\n", "\n\n", "  ", "é", "\n \n", "Wörter.", "日本"]) for _ in range(rng.randrange(0, 40)))) for i in range(40)]
    d = spark.createDataFrame(texts, "doc_id long, text string")
    got = {}
    for r in tc.section_tokens(d, tokenizer=BPE, rule=rule).collect():
        got.setdefault(r.doc_id, {})[r.section] = r
    for i, t in texts:
        cuts = tc.line_starts(t)
        counts, crossing = plain(t, cuts, rule)
        rows = [got[i][s] for s in range(len(cuts))]
        assert [r.n_tokens for r in rows] == counts and [r.n_crossing for r in rows] == crossing
        assert [r.start for r in rows] == cuts and sum(r.n_chars for r in rows) == len(t)


def test_ties_and_wide_tokens():
    spans = np.array([[0, 4], [4, 12], [12, 12]])
    cuts = np.array([0, 2, 6, 8, 12])
    assert tc.allocate(spans, cuts, "largest")[0].tolist() == [0, 3, 4]
    assert tc.allocate(spans, cuts, "first")[0].tolist() == [0, 1, 4]
    assert tc.allocate(spans, cuts, "last")[0].tolist() == [1, 3, 4]


def test_fields_nulls_repeats_and_empty(spark):
    d = spark.createDataFrame([(1, "title", None, 9), (None, None, "body text", 9), (2, "", "", 9), (2, "", "", 9), (3, "x" * 100_000, "y\n" * 50_000, 9)], "doc_id long, title string, body string, section int")
    got = tc.section_tokens(d, tokenizer=BPE, fields=["title", "body"]).collect()
    assert len(got) == 10 and {r.section for r in got} == {0, 1}
    for r in got:
        assert (r.n_tokens == 0) == (r.n_chars == 0)
    lines = tc.section_tokens(d, text="body", tokenizer=BPE)
    assert sorted((r.doc_id or -1, r.n_tokens > 0) for r in lines.filter("doc_id is null or doc_id < 3").collect()) == [(-1, True), (1, False), (2, False), (2, False)]
    assert lines.filter("doc_id = 3").count() == 50_000
    assert tc.section_tokens(spark.createDataFrame([], "doc_id long, text string"), tokenizer=BPE).collect() == []
    with pytest.raises(ValueError):
        tc.section_tokens(d, tokenizer=BPE, rule="half")
