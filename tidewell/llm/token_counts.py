"""Token counts of sections from one encoding of the whole document (operator 7).

A document is encoded once.  The tokenizer's character spans are joined with the
spans of its sections by two sorted searches, and each token goes to one section:

    largest   the section that holds most of its characters, the earlier one on a tie
    first     the section of its first character
    last      the section of its last character

A token without characters goes to the section at its place.  So the counts of a
document's sections add up to its tokens, which encoding section by section does
not give.  Sections are the lines of the text with their line ends, or fields that
are joined by a separator, which belongs to the field before it.

Defined cases: null or empty text is one empty section without tokens; null and
repeated keys are carried; a section that no token falls to counts 0; an empty
table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewell.llm.bytehash import slabs
from tidewell.llm.tokens import encoder

CHARS = 1 << 20  # text that makes one batch of rows
RULES = ("largest", "first", "last")


def allocate(spans: np.ndarray, cuts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and whether it crosses a boundary.  spans: (start, end)
    of each token; cuts: starts of the sections, ascending from 0."""
    a, b = spans[:, 0], spans[:, 1]
    first = np.searchsorted(cuts, a, side="right") - 1
    last = np.searchsorted(cuts, np.maximum(a, b - 1), side="right") - 1
    crossing = last > first
    out = first.copy() if rule != "last" else last
    if rule == "largest":
        edges = np.r_[cuts, np.iinfo(np.int64).max]
        for i in np.flatnonzero(crossing):
            held = np.arange(first[i], last[i] + 1)
            out[i] = held[np.argmax(np.minimum(b[i], edges[held + 1]) - np.maximum(a[i], edges[held]))]
    return out, crossing


def line_starts(text: str) -> list[int]:
    out, at = [0], text.find("\n") + 1
    while 0 < at < len(text):
        out.append(at)
        at = text.find("\n", at) + 1
    return out


def section_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", *, tokenizer: str, rule: str = "largest",
                   fields: list[str] | None = None, separator: str = "\n") -> DataFrame:
    """(key, section, start, n_chars, n_tokens, n_crossing) for each section of each document.

    start and n_chars are in characters.  n_crossing: tokens of the section that
    touch another one.  With `fields`, these columns joined by the separator are the
    document and section is the field's number.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    kind = docs.schema[key].dataType.simpleString()
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (fields or [text])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = encoder(tokenizer)
        for b in batches:
            rows = b.column("p").to_pylist()
            texts = [separator.join(p) for p in rows]
            for x, y in slabs(texts, CHARS):
                at, number, start, size, n, crossed = [], [], [], [], [], []
                for i, spans in zip(range(x, y), t.offsets_all(texts[x:y]), strict=True):
                    if fields:
                        cuts = np.cumsum([0, *(len(f) + len(separator) for f in rows[i][:-1])])
                    else:
                        cuts = np.array(line_starts(texts[i]))
                    to, crossing = allocate(spans, cuts, rule)
                    at.append(np.full(len(cuts), i))
                    number.append(np.arange(len(cuts)))
                    start.append(cuts)
                    size.append(np.diff(np.r_[cuts, len(texts[i])]))
                    n.append(np.bincount(to, minlength=len(cuts)))
                    crossed.append(np.bincount(to[crossing], minlength=len(cuts)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("k").take(pa.array(np.concatenate(at))), *(pa.array(np.concatenate(v).astype(np.int64)) for v in (number, start, size, n, crossed))],
                    names=["k", "section", "start", "n_chars", "n_tokens", "n_crossing"])

    out = docs.select(F.col(key).alias("k"), F.array(*parts).alias("p")).mapInArrow(run, f"k {kind}, section long, start long, n_chars long, n_tokens long, n_crossing long")
    return out.withColumnRenamed("k", key)
