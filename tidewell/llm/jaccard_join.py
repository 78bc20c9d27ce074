"""Exact Jaccard join of documents as sets of word shingles (operator 10).

1. Documents are dealt into blocks.  Each block sends its distinct shingle hashes,
   packed and pre-aggregated, to hash buckets; a bucket counts them over the corpus
   and sends one byte of frequency level back for each.  Levels only have to be the
   same for all documents: they define the global order of shingles, rare first.
2. A document of which too few shingles occur anywhere else cannot link.  The rest
   keep their whole set, ordered; its prefix goes into index lists.  Documents with
   equal sets are one set from here on.
3. Answers of a list's first set: every set is compared with one leader, the first
   set of the list it shares most often.  The differences from the leader are kept.
4. Index lists are cut into blocks of equal (size, position, component).  A pair of
   blocks that the length or positional filter refutes, or that is one component
   already, is skipped as a whole.  For sets with the same leader the answer follows
   from the leader's: bounds from the two overlaps refute or accept the pair, and
   what is left is computed from the differences alone, not from the sets.
5. Components of all links.

Long lists are dealt into cells of bounded size (every pair of chunks is one cell),
so no task holds a list.  Nothing is capped: every pair of different sets that
links is either found or already joined by other links.

Defined cases: null text is empty; an empty set links with nothing; a null key keeps
its row with a null component and links with nothing; rows that repeat a key are
versions of one document and share its links; ties go to the smaller key; an empty
table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewell.llm.bytehash import Keyed, U, joined, mix, new_key, slabs
from tidewell.llm.graph import components
from tidewell.llm.tables import written

BLOCK_BYTES = 4 << 20  # text of a block
BUCKET_SHINGLES = 2 << 20  # hashes a bucket counts at once
CELL_ROWS = 4096  # rows of a list that one cell holds of either side
GROUP_ROWS = 100_000  # rows of short lists that are worked on together
PAIRS_AT_ONCE = 1 << 18
SLAB = 1 << 20


def shingle_sets(texts: list[bytes], words: int, seed: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, under a key of the run."""
    out: list[np.ndarray] = []
    for first, last in slabs(texts, SLAB):
        out += _slab_sets(texts[first:last], words, seed)
    return out


def _slab_sets(texts: list[bytes], words: int, seed: int) -> list[np.ndarray]:
    data, starts = joined(texts, b" ")
    data = data.copy()
    data[(data >= 65) & (data <= 90)] += 32
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.r_[True, gap, True]))
    begin, end = edge[::2], edge[1::2]
    h = Keyed(data, seed).ranges(begin, end)
    first = np.searchsorted(begin, starts)  # of each document's words
    count = np.diff(first)
    k = U(words)
    full = h[: max(0, len(h) - words + 1)] * k
    for j in range(1, words):
        full = mix(full + h[j: len(h) - words + 1 + j])
    out = []
    for i, n in enumerate(count.tolist()):
        a = first[i]
        if n >= words:
            s = np.sort(full[a:a + n - words + 1])
            out.append(s[np.r_[True, s[1:] != s[:-1]]])
        elif n:
            x = U(n)
            with np.errstate(over="ignore"):
                for j in range(n):
                    x = mix(np.array([x * U(31) + h[a + j]], U))[0]
            out.append(np.array([x], U))
        else:
            out.append(np.empty(0, U))
    return out


def required(n: int, percent: int) -> int:
    """Least overlap of a set of n with any partner."""
    return -(-percent * n // 100)


def overlap_needed(n, m, percent: int):
    return -(-percent * (n + m) // (100 + percent))


def _texts(table: pa.Table) -> list[bytes]:
    return [(x or "").encode() for x in table.column("t").to_pylist()]


def _block_keys(sets: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shortened hashes of a block, ascending, and in how many of its documents."""
    if not sets:
        return np.empty(0, U), np.empty(0, np.int64)
    return np.unique(np.concatenate(sets) >> U(32 - bits), return_counts=True)


def _levels(df: np.ndarray) -> np.ndarray:
    return np.where(df <= 1, 0, np.minimum(255, np.ceil(6 * np.log2(np.maximum(df, 1))))).astype(np.uint8)


def ordered_sets(docs: DataFrame, key: str, text: str, percent: int, words: int) -> DataFrame:
    """(k, n, sig, skip, body) for every row; sig, skip and body are null where a document
    cannot link.  body: the set's hashes, rare first; skip: how many occur nowhere else."""
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_blocks = max(1, math.ceil(size / BLOCK_BYTES))
    bits = max(0, math.ceil(math.log2(max(1, size / 6 / BUCKET_SHINGLES))))
    # by key and text: one key, or null, on many rows is dealt over all blocks
    rows = rows.withColumn("block", F.pmod(F.xxhash64("k", "t"), F.lit(n_blocks)))
    seed = new_key()

    def send(table: pa.Table) -> pa.Table:
        keys, counts = _block_keys(shingle_sets(_texts(table), words, seed), bits)
        bucket = (keys >> U(32)).astype(np.int64)
        cuts = np.searchsorted(bucket, np.arange((1 << bits) + 1))
        out = [(b, keys[x:y].astype(np.uint32).tobytes(), np.minimum(counts[x:y], 65535).astype(np.uint16).tobytes())
               for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if y > x]
        return pa.table({"bucket": pa.array([o[0] for o in out], pa.int64()), "block": pa.array([table.column("block")[0].as_py()] * len(out), pa.int64()),
                         "keys": pa.array([o[1] for o in out], pa.binary()), "counts": pa.array([o[2] for o in out], pa.binary())})

    def count(table: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint32)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint16).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        fresh = np.r_[True, keys[order][1:] != keys[order][:-1]]
        total = np.add.reduceat(counts[order], np.flatnonzero(fresh))
        level = np.empty(len(keys), np.uint8)
        level[order] = _levels(total)[np.cumsum(fresh) - 1]
        cuts = np.cumsum([0, *(len(x) // 4 for x in table.column("keys").to_pylist())])
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "levels": pa.array([level[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})

    def order(left: pa.Table, right: pa.Table) -> pa.Table:
        sets = shingle_sets(_texts(left), words, seed)
        keys, _ = _block_keys(sets, bits)
        parts = sorted(zip(right.column("bucket").to_pylist(), right.column("levels").to_pylist(), strict=True))
        levels = np.frombuffer(b"".join(x for _, x in parts), np.uint8)
        out = []
        for k, s in zip(left.column("k"), sets, strict=True):
            n = len(s)
            row = [k, n, None, None, None]
            if n and k.is_valid:
                lev = levels[np.searchsorted(keys, s >> U(32 - bits))]
                skip = int((lev == 0).sum())
                if n - skip >= required(n, percent):
                    row[2:] = [xxhash.xxh3_128_digest(s.tobytes()), skip, s[np.argsort(lev, kind="stable")].tobytes()]
            out.append(row)
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        return pa.table({"k": pa.array([x.as_py() for x in cols[0]], left.column("k").type), "n": pa.array(cols[1], pa.int32()), "sig": pa.array(cols[2], pa.binary()),
                         "skip": pa.array(cols[3], pa.int32()), "body": pa.array(cols[4], pa.binary())})

    sent = rows.groupBy("block").applyInArrow(send, "bucket long, block long, keys binary, counts binary")
    back = sent.groupBy("bucket").applyInArrow(count, "block long, bucket long, levels binary")
    return rows.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(order, f"k {kind}, n int, sig binary, skip int, body binary")


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """Index lists: (token, k, n, pos) for the prefix of each set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            token, place, row = [], [], []
            n = b.column("n").to_pylist()
            for i, (skip, body) in enumerate(zip(b.column("skip").to_pylist(), b.column("body").to_pylist(), strict=True)):
                upto = n[i] - required(n[i], percent) + 1
                if upto > skip:
                    token.append(np.frombuffer(body, np.int64)[skip:upto])
                    place.append(np.arange(skip, upto, dtype=np.int32))
                    row.append(np.full(upto - skip, i))
            if row:
                at = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(token)), b.column("k").take(at), b.column("n").take(at), pa.array(np.concatenate(place))], names=["token", "k", "n", "pos"])

    return sets.select("k", "n", "skip", "body").mapInArrow(run, f"token long, k {sets.schema['k'].dataType.simpleString()}, n int, pos int")


def _compare_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlap of two sets, and what the second lacks (places in the first, sorted) and adds."""
    for b in batches:
        out = []
        for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True):
            p, q = np.sort(np.frombuffer(x, np.uint64)), np.sort(np.frombuffer(y, np.uint64))
            at = np.minimum(np.searchsorted(q, p), len(q) - 1)
            common = q[at] == p
            mine = np.ones(len(q), bool)
            mine[at[common]] = False
            out.append((int(common.sum()), np.flatnonzero(~common).astype(np.int32).tobytes(), q[mine].tobytes()))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), b.column("na"), b.column("nb"), pa.array([o[0] for o in out], pa.int32()),
                                          pa.array([o[1] for o in out], pa.binary()), pa.array([o[2] for o in out], pa.binary())], names=["a", "b", "na", "nb", "o", "minus", "plus"])


def _compare_differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlap of two sets from their differences from one leader."""
    for b in batches:
        c = {k: b.column(k).to_pylist() for k in ("nl", "minus_a", "minus_b", "plus_a", "plus_b")}
        out = []
        for nl, ma, mb, pa_, pb in zip(*c.values(), strict=True):
            lacks = len(np.union1d(np.frombuffer(ma, np.int32), np.frombuffer(mb, np.int32)))
            out.append(nl - lacks + len(np.intersect1d(np.frombuffer(pa_, np.uint64), np.frombuffer(pb, np.uint64), assume_unique=True)))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), b.column("na"), b.column("nb"), pa.array(out, pa.int32())], names=["a", "b", "na", "nb", "o"])


def _ranges(first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) with first[i] <= j < last[i], about PAIRS_AT_ONCE of them at a time."""
    size = np.maximum(0, last - first)
    total = np.cumsum(size)
    i = 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + PAIRS_AT_ONCE, side="right")))
        n = size[i:j]
        owner = np.repeat(np.arange(i, j), n)
        yield owner, first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        i = j


def _cells(percent: int):
    """Pairs that no filter refutes, over all cells of a group at once; kind 2 ones link for sure."""
    def run(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(["token", "i", "j", "n", "pos", "comp", "k"], kind="stable").reset_index(drop=True)
        n, pos, comp = t["n"].to_numpy().astype(np.int64), t["pos"].to_numpy(), pd.factorize(t["comp"])[0]
        cell = t[["token", "i", "j"]].to_numpy()
        new_cell = np.r_[True, (cell[1:] != cell[:-1]).any(1)]
        number = np.cumsum(new_cell)
        starts = np.flatnonzero(new_cell | np.r_[True, (n[1:] != n[:-1]) | (pos[1:] != pos[:-1]) | (comp[1:] != comp[:-1])])
        ends = np.r_[starts[1:], len(t)]
        bn, bp, bc, bl = n[starts], pos[starts], comp[starts], number[starts]
        wide = np.int64(1) << 32
        # blocks of a cell ascend by size: those from the next one to the largest size that can link
        stop = np.searchsorted(bl * wide + bn, bl * wide + bn * 100 // percent, side="right")
        side, one_chunk = (t["chunk"] == t["i"]).to_numpy(), (t["i"] == t["j"]).to_numpy()
        o, nl, leader = t["o"].to_numpy().astype(np.int64), t["nl"].to_numpy().astype(np.int64), pd.factorize(t["leader"])[0]
        k = t["k"].to_numpy()
        out = []
        for x, y in _ranges(np.arange(1, len(starts) + 1), stop):
            ok = (bc[x] != bc[y]) & (np.minimum(bn[x] - bp[x], bn[y] - bp[y]) >= overlap_needed(bn[x], bn[y], percent))
            x, y = x[ok], y[ok]
            rows = np.repeat(np.arange(len(x)), ends[x] - starts[x])
            a_all = starts[x][rows] + np.arange(len(rows)) - np.repeat(np.cumsum(ends[x] - starts[x]) - (ends[x] - starts[x]), ends[x] - starts[x])
            for r, b in _ranges(starts[y][rows], ends[y][rows]):
                a = a_all[r]
                keep = one_chunk[a] | (side[a] != side[b])
                need = overlap_needed(n[a], n[b], percent)
                near = leader[a] == leader[b]
                keep &= ~near | (np.minimum(o[a], o[b]) + np.minimum(n[a] - o[a], n[b] - o[b]) >= need)
                kind = np.where(near, np.where(o[a] + o[b] - nl[a] >= need, 2, 1), 0)[keep]
                a, b = a[keep], b[keep]
                swap = k[a] > k[b]
                a, b = np.where(swap, b, a), np.where(swap, a, b)
                out.append(pd.DataFrame({"a": k[a], "b": k[b], "na": n[a].astype(np.int32), "nb": n[b].astype(np.int32), "kind": kind.astype(np.int32)}).drop_duplicates())
        return pd.concat(out) if out else pd.DataFrame({"a": k[:0], "b": k[:0], "na": np.empty(0, np.int32), "nb": np.empty(0, np.int32), "kind": np.empty(0, np.int32)})
    return run


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", *, percent: int = 80, words: int = 5) -> DataFrame:
    """(key, n_shingles, component_id) for every row; component_id is the smallest key
    that can be reached over links of at least `percent` Jaccard."""
    kind = docs.schema[key].dataType.simpleString()
    every = written(ordered_sets(docs, key, text, percent, words), "sets")
    able = every.filter(F.col("sig").isNotNull())
    first = able.groupBy("sig", "n").agg(F.min("k").alias("rep"))  # equal sets are one set
    sets = able.join(first.select(F.col("rep").alias("k"), "sig"), ["k", "sig"], "left_semi").dropDuplicates(["k", "sig"])
    lists = written(_postings(sets, percent), "lists")
    bodies = sets.select("k", "n", "body")

    # the leader of a set: the first set of the most of its lists
    band = F.floor(F.log("n") / math.log(100 / percent)).alias("band")
    heads = lists.groupBy("token", band).agg(F.min("k").alias("leader"), F.count("*").alias("m")).filter("m > 1").drop("m")
    led = (lists.select("token", band, "k").join(heads, ["token", "band"]).filter("k > leader").groupBy("k", "leader").agg(F.count("*").alias("shared"))
           .groupBy("k").agg(F.max_by("leader", F.struct("shared", -F.col("leader") if kind in ("bigint", "int") else F.col("leader"))).alias("leader")))
    asked = (led.join(bodies.select(F.col("k"), F.col("n").alias("nb"), F.col("body").alias("y")), "k")
             .join(bodies.select(F.col("k").alias("leader"), F.col("n").alias("na"), F.col("body").alias("x")), "leader")
             .select(F.col("leader").alias("a"), F.col("k").alias("b"), "na", "nb", "x", "y"))
    answers = written(asked.mapInArrow(_compare_sets, f"a {kind}, b {kind}, na int, nb int, o int, minus binary, plus binary"), "answers")
    links_of = lambda d: d.filter(F.col("o").cast("long") * (100 + percent) >= (F.col("na") + F.col("nb")).cast("long") * percent).select("a", "b")
    near_links = links_of(answers)
    so_far = components(near_links, "a", "b")

    # what is left: pairs of one list in different components
    known = answers.select(F.col("b").alias("k"), F.col("a").alias("leader"), "o", F.col("na").alias("nl"))
    lists2 = (lists.join(so_far.withColumnRenamed("id", "k"), "k", "left").join(known, "k", "left")
              .select("token", "k", "n", "pos", F.coalesce("component", "k").alias("comp"), F.coalesce("leader", "k").alias("leader"), F.coalesce("o", "n").alias("o"), F.coalesce("nl", "n").alias("nl")))
    lists2 = written(lists2, "open")
    open_lists = lists2.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m")).filter("lo < hi")
    chunks = F.ceil(F.col("m") / CELL_ROWS).cast("int")
    # every pair of chunks of a list is one cell; a row goes to the cells of its chunk
    dealt = (lists2.join(open_lists.select("token", chunks.alias("g")), "token").withColumn("chunk", F.pmod(F.xxhash64("k"), F.col("g")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1))).withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other")))
    groups = max(1, math.ceil((open_lists.agg(F.sum(F.col("m") * chunks)).first()[0] or 0) / GROUP_ROWS))
    dealt = dealt.withColumn("g", F.pmod(F.xxhash64("token", "i", "j"), F.lit(groups))).drop("other")
    pairs = written(dealt.groupBy("g").applyInPandas(_cells(percent), f"a {kind}, b {kind}, na int, nb int, kind int").filter("a != b").distinct(), "pairs")
    diffs = answers.select(F.col("b").alias("k"), "minus", "plus", F.col("na").alias("nl")).unionByName(
        sets.select("k", F.lit(b"").alias("minus"), F.lit(b"").alias("plus"), F.col("n").alias("nl")).join(answers.select(F.col("b").alias("k")), "k", "left_anti"))
    by_diff = (pairs.filter("kind = 1").join(diffs.select(F.col("k").alias("a"), F.col("minus").alias("minus_a"), F.col("plus").alias("plus_a"), "nl"), "a")
               .join(diffs.select(F.col("k").alias("b"), F.col("minus").alias("minus_b"), F.col("plus").alias("plus_b")), "b")
               .select("a", "b", "na", "nb", "nl", "minus_a", "minus_b", "plus_a", "plus_b").mapInArrow(_compare_differences, f"a {kind}, b {kind}, na int, nb int, o int"))
    by_set = (pairs.filter("kind = 0").join(bodies.select(F.col("k").alias("a"), F.col("body").alias("x")), "a").join(bodies.select(F.col("k").alias("b"), F.col("body").alias("y")), "b")
              .select("a", "b", "na", "nb", "x", "y").mapInArrow(_compare_sets, f"a {kind}, b {kind}, na int, nb int, o int, minus binary, plus binary"))
    links = near_links.unionByName(pairs.filter("kind = 2").select("a", "b")).unionByName(links_of(by_diff)).unionByName(links_of(by_set))
    found = components(links, "a", "b")

    of_set = first.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("sig", F.coalesce("component", "rep").alias("component"))
    out = every.filter(F.col("sig").isNull()).select("k", "n", F.col("k").alias("component")).unionByName(
        able.select("k", "n", "sig").join(of_set, "sig").select("k", "n", "component"))
    return out.select(F.col("k").alias(key), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))


def drop_similar(docs: DataFrame, key: str = "doc_id", text: str = "text", *, percent: int = 80, words: int = 5) -> DataFrame:
    """One document of each group stays, that with the smallest key; all columns are kept.
    Rows that repeat a key stay or go together; null keys stay."""
    groups = similar_groups(docs, key, text, percent=percent, words=words)
    gone = groups.filter(F.col("component_id") < F.col(key)).select(F.col(key).alias("__gone")).distinct()
    return docs.join(gone, docs[key] == F.col("__gone"), "left_anti")
