"""Packing of documents into sequences by bin completion (operator 6).

Documents are encoded in parallel; each ends with `end_id`.  Longer ones than a
sequence are cut, the first piece taking the remainder.  What fits together
depends only on how many pieces there are of each length, a table of at most
`capacity` rows however large the corpus.  The plan for that table is found by
bin completion: take the longest remaining length, enumerate fillings of the space
beside it that no other filling dominates, use one as often as the counts allow,
and go on; a branch ends when its waste exceeds what a better packing could have.
The first incumbent is best-fit decreasing, and search stops at the lower bound.
Effort is bounded by `nodes`; that limits how many packings are tried, never what
is packed.  Pieces then find their place in parallel: a piece's rank among those of
its length (counted by salted groups, so one length may hold any share of the rows)
selects the sequence and the offset.

Defined cases: null text is empty, so it is one end token; null and repeated keys
are packed like others; equal pieces are interchangeable; an empty table gives an
empty one; other columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewell.llm.tables import written
from tidewell.llm.tokens import crc, encode

Plan = list[tuple[tuple[int, ...], int]]  # lengths in one sequence, how many such sequences
SALT_ROWS = 200_000


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Plan:
    """Each length, longest first, into the fullest sequences it fits."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    spaces: list[int] = []

    def put(space: int, pattern: tuple[int, ...], n: int) -> None:
        if not groups.get(space):
            insort(spaces, space)
        groups.setdefault(space, []).append((pattern, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_left(spaces, length)
            if i == len(spaces):
                each = capacity // length
                if left >= each:
                    put(capacity - each * length, (length,) * each, left // each)
                if left % each:
                    put(capacity - left % each * length, (length,) * (left % each), 1)
                break
            space = spaces[i]
            pattern, n = groups[space].pop()
            if not groups[space]:
                spaces.pop(i)
            k = min(n, left)
            if n > k:
                put(space, pattern, n - k)
            put(space - length, (*pattern, length), k)
            left -= k
    return [g for found in groups.values() for g in found]


def dominated(filling: tuple[int, ...], space: int, lengths: list[int], counts: dict[int, int]) -> bool:
    """Whether one available longer piece could stand for some of the filling's
    pieces without overflowing: then the filling with that piece is as good."""
    slack = space - sum(filling)
    subsets = (s for k in range(1, min(len(filling), 3) + 1) for s in set(combinations(filling, k)))
    for s in subsets:
        low, high = sum(s) + (len(s) == 1), sum(s) + slack
        i = bisect_left(lengths, low)
        while i < len(lengths) and lengths[i] <= high:
            if counts[lengths[i]] > filling.count(lengths[i]):
                return True
            i += 1
    return False


def fillings(space: int, counts: dict[int, int], lengths: list[int], width: int, steps: int = 400) -> list[tuple[int, ...]]:
    """Undominated fillings of the space, least waste and fewest pieces first."""
    found: set[tuple[int, ...]] = set()
    budget = [steps]

    def descend(space: int, chosen: tuple[int, ...], upto: int) -> None:
        if len(found) >= 3 * width or budget[0] <= 0:
            return
        budget[0] -= 1
        i = bisect_left(lengths, min(space, upto) + 1) - 1
        if i >= 0 and lengths[i] == space and counts[space] > chosen.count(space):
            found.add((*chosen, space))  # one piece that fits exactly dominates every other way
            return
        fits = False
        while i >= 0 and budget[0] > 0:
            x = lengths[i]
            if counts[x] > chosen.count(x):
                fits = True
                descend(space - x, (*chosen, x), x)
            i -= 1
        if not fits:
            found.add(chosen)

    descend(space, (), space)
    ranked = sorted(found, key=lambda f: (-sum(f), len(f), tuple(-x for x in f)))
    kept = [f for f in ranked if sum(f) == space or not dominated(f, space, lengths, counts)]
    return (kept or ranked)[:width]


def bin_completion(counts: dict[int, int], capacity: int, *, nodes: int = 6000, width: int = 4) -> Plan:
    """Sequences for pieces of each length; see the module."""
    counts = {k: v for k, v in counts.items() if v}
    total = sum(k * v for k, v in counts.items())
    bound = -(-total // capacity)
    best = best_fit_decreasing(counts, capacity)
    size = sum(n for _, n in best)
    left, lengths = dict(counts), sorted(counts)
    trail: list[tuple[tuple[int, ...], int, list[tuple[int, ...]]]] = []  # filled pattern, times, other fillings
    waste = 0

    def use(pattern: tuple[int, ...], times: int, sign: int) -> None:
        nonlocal waste
        for x in pattern:
            if sign < 0 and left[x] == 0:
                insort(lengths, x)
            left[x] -= sign * times
            if sign > 0 and left[x] == 0:
                lengths.pop(bisect_left(lengths, x))
        waste += sign * times * (capacity - sum(pattern))

    while size > bound and nodes > 0:
        nodes -= 1
        options: list[tuple[int, ...]] = []
        if lengths and waste <= (size - 1) * capacity - total:
            top = lengths[-1]
            left[top] -= 1
            options = [(top, *f) for f in fillings(capacity - top, left, lengths, width)][::-1]
            left[top] += 1
        elif not lengths and (n := sum(t for _, t, _ in trail)) < size:
            best, size = [(p, t) for p, t, _ in trail], n
        while not options and trail:
            pattern, times, options = trail.pop()
            use(pattern, times, -1)
        if not options:
            break
        pattern = options.pop()
        times = min(left[x] // pattern.count(x) for x in set(pattern))
        use(pattern, times, 1)
        trail.append((pattern, times, options))
    return best


def pieces(docs: DataFrame, key: str, text: str, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """(k, piece, start, length, ids_crc32, ids) of every document."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, number, start, size, check, ids = [], [], [], [], [], []
            for i, x in enumerate(encode(tokenizer, b.column("t").to_pylist())):
                x = np.r_[x, np.uint32(end_id)].astype(np.uint32)
                edges = [0, *range(len(x) % capacity or capacity, len(x) + 1, capacity)]
                for j, (a, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    row.append(i), number.append(j), start.append(a), size.append(e - a), check.append(crc(x[a:e])), ids.append(x[a:e].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("k").take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()),
                                              pa.array(check, pa.int64()), pa.array(ids, pa.binary())], names=["k", "piece", "start", "length", "ids_crc32", "ids"])

    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, piece int, start long, length long, ids_crc32 long, ids binary")


def _places(plan: Plan) -> dict[str, np.ndarray]:
    """For each length the ranges of ranks and where they go, sorted by (length, rank)."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in plan:
        offset = 0
        for x in sorted(set(pattern), reverse=True):
            c = pattern.count(x)
            rows.append((x, used.get(x, 0), c, sequence, offset))
            used[x] = used.get(x, 0) + c * times
            offset += c * x
        sequence += times
    rows.sort()
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    return {n: np.array(c, np.int64) for n, c in zip(("length", "rank", "each", "sequence", "offset"), cols, strict=True)}


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", *, tokenizer: str, end_id: int = 0, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) for every piece, and its ids if asked for."""
    cut = pieces(docs, key, text, tokenizer, end_id, capacity)
    found = written(cut if with_ids else cut.drop("ids"), "pieces")
    n = found.count()
    salted = found.withColumn("salt", F.pmod(F.xxhash64("k", "piece", "ids_crc32"), F.lit(max(1, math.ceil(n / SALT_ROWS)))))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    table = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    place = _places(bin_completion(table, capacity))
    before = counts.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("length", "salt").orderBy("k", "piece", "ids_crc32")) - 1
    ranked = salted.withColumn("rank", number.cast("long")).join(before, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before", "salt")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = 1 << 48
        keys = place["length"] * wide + place["rank"]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            i = np.searchsorted(keys, length * wide + rank, side="right") - 1
            r = rank - place["rank"][i]
            out = b.drop_columns(["rank"]) if hasattr(b, "drop_columns") else b.select([c for c in b.schema.names if c != "rank"])
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(place["sequence"][i] + r // place["each"][i]), pa.array(place["offset"][i] + r % place["each"][i] * length)],
                                             names=[*out.schema.names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    out = ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")
    return out.select(F.col("k").alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids) of pieces packed with their ids: one row of little-endian ids for each sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # a sequence holds `capacity` ids at most
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
