"""Ranked lexical search with bag deduplication (operator 13).

Every document is read once and restricted to the words that the searched items
hold: a sorted vector of (word, occurrences), and the number of all its terms.  Two
documents with the same vector and the same length measure m have the same score for
every item, so they form a class: classes are found by a hash and verified by the
vector itself, each class is scored once, and its members follow in ascending key
order.  Of a class no more than the k smallest keys can be among the k best of an item,
so a hot class sends k rows from each task, not all its copies.

Items are a stated query set.  They are cut by hash into blocks of about
`block_bytes` of text, however many there are; a block's words and postings are what a
task holds, and each block is searched against all documents.

Scores are sums of whole numbers.  They are added in doubles, which are exact below
2^53, and in 64-bit integers where the weights could reach that.

Defined cases: a null text has no term and is in no answer; a document without terms
does not count for N; an item without terms, or with a null text, has no answer; null
keys are documents too and come after all others among equal scores; repeated documents
are documents of their own; repeated equal items are answered once, items of one id with
different texts each by itself.  Empty tables give an empty answer.  Only the named
columns are read.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidewell.llm.tables import written

BLOCK_BYTES = 4 << 20  # item text whose words a task holds at once
CELLS = 2 << 20  # (class, item) scores held at once

#: Bytes of terms as they are (A-Z in lower case), all others as a space.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of letters, digits and everything beyond ASCII, A-Z in lower case."""
    return text.translate(TERM_BYTES).split()


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
           *, k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item key, rank, key, score): the k best documents of each item with a score above 0."""
    asked = items.select(F.col(item_key).alias("q"), F.coalesce(F.col(item_text), F.lit("")).alias("t")).distinct()
    total = asked.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    found = None
    for block in range(blocks):
        # about block_bytes of text
        rows = asked.filter(F.pmod(F.xxhash64("q", "t"), F.lit(blocks)) == block).collect()
        answer = _search_block(docs, [(r["q"], r["t"]) for r in rows], key, text, asked.schema["q"].dataType, k)
        found = answer if found is None else found.unionByName(answer)
    return found.select(F.col("q").alias(item_key), "rank", F.col("k").alias(key), "score")


def _search_block(docs: DataFrame, items: list, key: str, text: str, item_type, k: int) -> DataFrame:
    spark = docs.sparkSession
    bags = [(q, Counter(terms(t.encode()))) for q, t in items]
    words = sorted({w for _, bag in bags for w in bag})
    number = {w: i for i, w in enumerate(words)}
    vocabulary = spark.sparkContext.broadcast(number)  # words of one block of items
    kind = docs.schema[key].dataType
    plain = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    vectors = written(plain.mapInArrow(lambda it: _vectors(it, vocabulary.value), f"k {kind.simpleString()}, n long, v binary"), "lexical-vectors")
    n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    held = vectors.filter(F.octet_length("v") > 0)
    # one row a word of the block
    df = {r["w"]: r["df"] for r in held.select("v").mapInArrow(lambda it: _held(it, len(words)), "w int, df long").groupBy("w").agg(F.sum("df").alias("df")).collect()}
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(words))], np.int64)
    measured = held.select("k", "v", F.expr(f"25L + (75L * n * {n_docs}L) div {max(1, n_terms or 0)}L").alias("m"))
    # members of a class: equal hash, verified by equal vector and m
    alike = Window.partitionBy("h", "m", "v").orderBy(F.asc_nulls_last("k"))
    first = measured.withColumn("h", F.xxhash64("v", "m")).withColumn("r", F.row_number().over(alike)).filter(F.col("r") <= k)
    classes = first.groupBy("h", "m", "v").agg(F.sort_array(F.collect_list(F.struct("r", "k"))).alias("members")).select("m", "v", F.col("members.k").alias("members"))
    board = spark.sparkContext.broadcast(_Board(bags, number, weight, to_arrow_type(item_type), to_arrow_type(kind)))
    best = classes.mapInArrow(lambda it: _best(it, board.value, k), f"i int, q {item_type.simpleString()}, k {kind.simpleString()}, score long")
    order = Window.partitionBy("i").orderBy(F.desc("score"), F.asc_nulls_last("k"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("q", "rank", "k", "score")


def _vectors(batches: Iterator[pa.RecordBatch], number: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, out = [], []
        for t in b.column("t").cast(pa.binary()):
            found = terms(t.as_py())
            n.append(len(found))
            held = sorted((number[w], c) for w, c in Counter(found).items() if w in number)
            out.append(array("i", chain.from_iterable(held)).tobytes())
        yield pa.RecordBatch.from_arrays([b.column("k"), pa.array(n, pa.int64()), pa.array(out, pa.binary())], names=["k", "n", "v"])


def _flat(vectors: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of vectors one after the other: which one, word, occurrences."""
    pairs = np.frombuffer(b"".join(vectors), np.int32).reshape(-1, 2)
    of = np.repeat(np.arange(len(vectors)), [len(v) // 8 for v in vectors])
    return of, pairs[:, 0], pairs[:, 1].astype(np.int64)


def _held(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Documents that hold each word, summed over the task."""
    count = np.zeros(words, np.int64)
    for b in batches:
        count += np.bincount(_flat(b.column("v").to_pylist())[1], minlength=words)
    at = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(count[at], pa.int64())], names=["w", "df"])


class _Board:
    """Postings of a block of items: for each word the items that hold it, and how often."""

    def __init__(self, bags: list, number: dict[bytes, int], weight: np.ndarray, item_type: pa.DataType, key_type: pa.DataType):
        self.ids = [q for q, _ in bags]
        self.weight, self.item_type, self.key_type = weight, item_type, key_type
        post = sorted((number[w], i, c) for i, (_, bag) in enumerate(bags) for w, c in bag.items())
        word, item, times = (np.array(x, np.int64) for x in (zip(*post) if post else ((), (), ())))
        self.item, self.times = item, times
        self.first = np.searchsorted(word, np.arange(len(number) + 1))
        longest = max((sum(bag.values()) for _, bag in bags), default=0)
        top = int(weight.max(initial=0)) * 1_000_000 * longest
        self.exact = top < 2 ** 53  # sums of doubles are exact

    def scores(self, m: np.ndarray, vectors: list[bytes]) -> np.ndarray:
        """One row a class, one column an item."""
        of, word, tf = _flat(vectors)
        part = self.weight[word] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[of]))
        count = self.first[word + 1] - self.first[word]
        total = np.cumsum(count)
        at = np.repeat(self.first[word] - (total - count), count) + np.arange(total[-1] if len(total) else 0)
        cell = np.repeat(of, count) * len(self.ids) + self.item[at]
        value = np.repeat(part, count) * self.times[at]
        size = len(vectors) * len(self.ids)
        if self.exact:
            flat = np.bincount(cell, value, size).astype(np.int64)
        else:
            flat = np.zeros(size, np.int64)
            np.add.at(flat, cell, value)
        return flat.reshape(len(vectors), len(self.ids))


def _best(batches: Iterator[pa.RecordBatch], board: _Board, k: int) -> Iterator[pa.RecordBatch]:
    """The task's k best documents of each item.  A class that has k better classes
    before it cannot be among them, since each of those has a member."""
    n = len(board.ids)
    kept: list[list] = [[] for _ in range(n)]  # (-score, first key, members)
    least = np.ones(n, np.int64)  # a score must reach this
    step = max(1, CELLS // max(1, n))
    for b in batches:
        for x in range(0, b.num_rows, step):
            part = b.slice(x, step)
            members = part.column("members").to_pylist()
            s = board.scores(part.column("m").to_numpy(), part.column("v").to_pylist())
            bar = least if len(s) < k else np.maximum(least, np.partition(s, len(s) - k, axis=0)[len(s) - k])
            row, item = np.nonzero(s >= bar)
            for c, i, v in zip(row.tolist(), item.tolist(), s[row, item].tolist(), strict=True):
                kept[i].append((-v, _last(members[c][0]), members[c]))
            for i in set(item.tolist()):
                kept[i].sort(key=lambda e: e[:2])
                del kept[i][k:]
                if len(kept[i]) == k:
                    least[i] = max(1, -kept[i][-1][0])
    out = []
    for i, classes in enumerate(kept):
        rows = sorted(((v, _last(key), key) for v, _, keys in classes for key in keys), key=lambda e: e[:2])
        out += [(i, board.ids[i], key, -v) for v, _, key in rows[:k]]
    cols = list(zip(*out)) if out else [()] * 4
    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], board.item_type), pa.array(cols[2], board.key_type), pa.array(cols[3], pa.int64())],
                                     names=["i", "q", "k", "score"])


def _last(key) -> tuple:
    return (key is None, key)


def search_sql(k: int = 10) -> str:
    """The same answer over the views `documents` and `benchmark`."""
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all({low}, '{term}')) AS w FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
asked AS (SELECT item_id, w, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all({low}, '{term}')) AS w FROM benchmark) GROUP BY item_id, w),
tfs AS (SELECT doc_id, w, count(*) AS tf FROM words WHERE w IN (SELECT w FROM asked) GROUP BY doc_id, w),
weights AS (SELECT w, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM tfs, totals GROUP BY w, docs),
parts AS (SELECT tfs.doc_id, tfs.w, weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))) AS part
  FROM tfs JOIN weights USING (w) JOIN lengths ON lengths.doc_id = tfs.doc_id, totals),
scored AS (SELECT item_id, doc_id, sum(times * part)::BIGINT AS score FROM asked JOIN parts USING (w) GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {k}"""
