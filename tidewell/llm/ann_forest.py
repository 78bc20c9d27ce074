"""Nearest neighbours by a forest of hash strings (operator 2).

Every tree hashes a vector to a string of `BITS` bits, the sides of random planes.
For inner products candidates get one more component, sqrt(M^2 - |x|^2) with M the
largest norm, so that the nearest by angle is the nearest by product.  A tree is the
sorted array of its strings; a query descends to its longest common prefixes and
ascends all trees at once, one bit at a time, until it has `m` candidates; these are
compared exactly.

m is fitted: for a bounded sample of queries the true neighbours are computed against
all rows, and m is the least number with which `recall` of them are candidates.
Vectors without structure need a large share of the rows, clustered ones few.

On Spark a tree's array lies in shards, one for each prefix of `depth` bits, and a
shard in chunks of bounded size.  First only strings move: each shard counts, for its
queries and every prefix length, the rows that share it; summed over trees that gives
each query its length.  Then vectors move to their shard, and a query to the shards
and chunks under its prefix, which it visits with one matrix product for all queries
of a prefix.  Each visit keeps the k best, so the merge sees k rows a tree and query.

Of equal vectors only the k + 1 smallest ids can be neighbours, so others are no
candidates (they still may be queries).  A query that needs a prefix shorter than
`depth` for its m candidates, or finds fewer than k rows, is compared with all rows.

Defined cases: unusable vectors (null, zero, null or non-finite components) and rows
without an id take no part, nor do vectors of another length than the most frequent one;
of repeated ids the vector with the smallest hash counts, and it asks if any of them does; ties go to the smaller id; with
fewer than k candidates all are returned; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewell.llm.tables import written
from tidewell.llm.vectors import matrix, packed, unpacked, usable, usual_length

BITS = 32
CHUNK_ROWS = 20_000
SAMPLE = 128


def planes(trees: int, size: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(size, trees * BITS))


def codes(x: np.ndarray, normals: np.ndarray, trees: int) -> np.ndarray:
    """Bit strings as numbers, first bit highest: one row a vector, one column a tree."""
    bits = (x @ normals > 0).reshape(len(x), trees, BITS)
    return bits.astype(np.int64) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of bit strings."""
    return BITS - np.frexp((a ^ b).astype(np.float64))[1]


def lifted(x: np.ndarray, largest: float | None) -> np.ndarray:
    """Queries (no norm given) and candidates in the space where angles rank products."""
    more = np.zeros(len(x)) if largest is None else np.sqrt(np.maximum(0.0, largest**2 - (x * x).sum(1)))
    return np.c_[x, more]


def best(q: np.ndarray, c: np.ndarray, qid: np.ndarray, cid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, id, product) of each query's k best rows but itself."""
    s = q @ c.T
    s[qid[:, None] == cid[None, :]] = -np.inf
    if s.shape[1] > k:
        edge = np.partition(s, s.shape[1] - k, axis=1)[:, -k]
        i, j = np.nonzero(s >= (edge - 1e-9 * (1 + np.abs(edge)))[:, None])
    else:
        i, j = np.nonzero(s > -np.inf)
    exact = np.einsum("ij,ij->i", q[i], c[j])  # the same order of sums wherever a row stands
    ok = s[i, j] > -np.inf
    i, j, exact = i[ok], j[ok], exact[ok]
    order = np.lexsort((cid[j], -exact, i))
    i, j, exact = i[order], j[order], exact[order]
    rank = np.arange(len(i)) - np.searchsorted(i, i)
    return i[rank < k], cid[j[rank < k]], exact[rank < k]


def _fit(cand: DataFrame, queries: DataFrame, largest: float, normals: np.ndarray, trees: int, k: int, recall: float) -> tuple[int, int]:
    """(m, depth) from at most SAMPLE queries against all rows."""
    rows = queries.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    qid, q = np.array([r["id"] for r in rows], np.int64), np.array([r["v"] for r in rows], np.float64)
    qc = codes(lifted(q, None), normals, trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hist = np.zeros((len(qid), BITS + 1), np.int64)
        kept: list[tuple] = []
        for b in batches:
            for x in range(0, b.num_rows, 2000):
                part = b.slice(x, 2000)
                ids, v = part.column("id").to_numpy(), matrix(part.column("v"))
                cc = codes(lifted(v, largest), normals, trees)
                depth = np.zeros((len(qid), len(ids)), np.int64)
                for i in range(len(qid)):
                    shared = common_prefix(cc, qc[i])
                    shared[ids == qid[i]] = 0
                    hist[i] += np.bincount(shared.ravel(), minlength=BITS + 1)
                    depth[i] = shared.max(1)
                i, c, s = best(q, v, qid, ids, k)
                at = np.searchsorted(ids, c, sorter=np.argsort(ids))
                kept += zip(i.tolist(), c.tolist(), s.tolist(), depth[i, np.argsort(ids)[at]].tolist(), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in kept], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.int64()))] + [pa.nulls(len(kept), pa.list_(pa.int64()))], names=["q", "c", "s", "depth", "hist"])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(qid))), pa.nulls(len(qid), pa.int64()), pa.nulls(len(qid), pa.float64()), pa.nulls(len(qid), pa.int64()), pa.array(hist.tolist(), pa.list_(pa.int64()))], names=["q", "c", "s", "depth", "hist"])

    seen = cand.select("id", "v").mapInArrow(run, "q long, c long, s double, depth long, hist array<long>")
    seen = written(seen, "fit")
    w = Window.partitionBy("q").orderBy(F.desc("s"), "c")
    true = seen.filter("c is not null").withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k).select("q", "depth").collect()  # SAMPLE * k rows
    sums = [F.sum(F.col("hist")[i]) for i in range(BITS + 1)]
    level = seen.filter("hist is not null").groupBy("q").agg(F.array(*sums).alias("n")).collect()  # SAMPLE rows
    counts = np.zeros((len(qid), BITS + 1), np.int64)
    for r in level:
        counts[r["q"]] = r["n"]
    reach = counts[:, ::-1].cumsum(1)[:, ::-1]  # rows that share at least so many bits, over trees
    who, deep = np.array([r["q"] for r in true], np.int64), np.array([r["depth"] for r in true], np.int64)
    for m in sorted({int(2**e) for e in np.arange(5, 50, 0.25)}):
        at = np.where(reach >= m, np.arange(BITS + 1), 0).max(1)
        if not len(who) or (deep >= at[who]).mean() >= recall:
            break
    return m, int(np.quantile(at, 0.25))


def nearest(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", *, query: F.Column | None = None, k: int = 20, trees: int = 32, recall: float = 0.95, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k rows with the largest inner product found for
    each query (rows where `query` holds; all, if none is given)."""
    rows = vectors.filter(F.col(id_col).isNotNull() & usable(column)).select(F.col(id_col).cast("long").alias("id"), F.col(column).alias("v"), (F.lit(True) if query is None else query).alias("asks"))
    rows = rows.filter(F.size("v") == usual_length(rows, "v"))
    # of rows that repeat an id always the same one, however often a task runs
    rows = written(rows.groupBy("id").agg(F.min_by("v", F.xxhash64("v")).alias("v"), F.bool_or("asks").alias("asks")), "vectors")
    spark = vectors.sparkSession
    kind = np.float32 if rows.schema["v"].dataType.elementType.simpleString() == "float" else np.float64  # vectors travel as they are stored
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shape = rows.agg(F.max(F.size("v")), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))).first()
    if shape[0] is None or not rows.filter("asks").head(1):
        return empty
    size, largest = shape[0], shape[1]
    normals = planes(trees, size + 1, seed)
    same = Window.partitionBy("v").orderBy("id")
    cand = rows.withColumn("rn", F.row_number().over(same)).filter(F.col("rn") <= k + 1).select("id", "v")
    queries = rows.filter("asks").select("id", "v")
    m, depth = _fit(cand, queries, largest, normals, trees, k, recall)

    def place(norm: float | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for x in range(0, b.num_rows, 500):
                    part = b.slice(x, 500)
                    v = matrix(part.column("v"))
                    c = codes(lifted(v, norm), normals, trees)
                    body = pa.array(packed(v.astype(kind)), pa.binary())
                    for t in range(trees):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), t, np.int32)), part.column("id"), pa.array(c[:, t]), body], names=["tree", "id", "code", "body"])
        return run

    prefix = F.shiftright("code", BITS - depth).alias("shard")
    strings = "tree int, id long, code long, body binary"
    placed, asked = cand.mapInArrow(place(largest), strings).withColumn("shard", prefix), queries.mapInArrow(place(None), strings).withColumn("shard", prefix)

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        c, q = np.sort(left.column("code").to_numpy()), right.column("code").to_numpy()
        out = np.zeros((len(q), BITS + 1 - depth), np.int64)
        for level in range(depth, BITS + 1):
            low = q >> (BITS - level) << (BITS - level)
            out[:, level - depth] = np.searchsorted(c, low + (1 << (BITS - level))) - np.searchsorted(c, low)
        # a query is no candidate of its own, as in the fit
        _, i, j = np.intersect1d(left.column("id").to_numpy(), right.column("id").to_numpy(), return_indices=True)
        out[j] -= common_prefix(left.column("code").to_numpy()[i], q[j])[:, None] >= np.arange(depth, BITS + 1)
        return pa.table({"id": right.column("id"), "counts": pa.array(out.tolist(), pa.list_(pa.int64()))})

    # strings only; a chunk of a shard counts by itself, and counts add up
    sizes = placed.groupBy("tree", "shard").agg(F.count("*").alias("n"))
    cut = sizes.select("tree", "shard", F.ceil(F.col("n") / CHUNK_ROWS).cast("int").alias("g"))
    cut = written(cut, "shards")
    chunk_of = lambda d: d.join(cut, ["tree", "shard"]).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("g")).cast("int")).drop("g")
    to_chunks = lambda d: d.join(cut, ["tree", "shard"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("g") - 1))).drop("g")
    keys = ["tree", "shard", "chunk"]
    counted = (chunk_of(placed.select("tree", "shard", "id", "code")).groupBy(*keys).cogroup(to_chunks(asked.select("tree", "shard", "id", "code")).groupBy(*keys)).applyInArrow(count, "id long, counts array<long>"))
    # rows under a prefix, for each length, over all trees; longer prefixes hold fewer
    total = counted.groupBy("id").agg(F.array(*[F.sum(F.col("counts")[i]) for i in range(BITS + 1 - depth)]).alias("n"))
    levels = total.select("id", (F.size(F.filter("n", lambda x: x >= m)) - 1 + depth).cast("int").alias("level")).filter(F.col("level") >= depth)

    def visit(left: pa.Table, right: pa.Table) -> pa.Table:
        code = left.column("code").to_numpy()
        order = np.argsort(code, kind="stable")
        code, cid = code[order], left.column("id").to_numpy()[order]
        c, q = unpacked(left.column("body"), kind)[order] if len(code) else np.empty((0, 0)), unpacked(right.column("body"), kind)
        qid, qcode, lev = (right.column(n).to_numpy() for n in ("id", "code", "level"))
        low = qcode >> (BITS - lev) << (BITS - lev)
        a, b = np.searchsorted(code, low), np.searchsorted(code, low + (np.int64(1) << (BITS - lev)))
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for x, y in sorted(set(zip(a.tolist(), b.tolist(), strict=True))):
            here = np.flatnonzero((a == x) & (b == y))
            for at in range(0, len(here) if y > x else 0, 256):
                w = here[at:at + 256]
                i, ids, s = best(q[w], c[x:y], qid[w], cid[x:y], k)
                out.append((qid[w][i], ids, s))
        return pa.table({"query_id": np.concatenate([o[0] for o in out]), "vec_id": np.concatenate([o[1] for o in out]), "score": np.concatenate([o[2] for o in out])})

    wide = asked.join(levels, "id")
    found = (chunk_of(placed).groupBy(*keys).cogroup(to_chunks(wide).groupBy(*keys)).applyInArrow(visit, "query_id long, vec_id long, score double"))
    found = written(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), "found")

    # too few rows this way, or fewer than m candidates in their shards: all rows
    enough = found.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= k).select(F.col("query_id").alias("id"))
    rest = written(queries.join(enough, "id", "left_anti"), "rest")
    n_rest = rest.count()
    if n_rest:
        parts = max(1, math.ceil(n_rest / 1000))
        n = max(1, math.ceil(cand.count() / CHUNK_ROWS))
        left = cand.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(n))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        right = rest.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))

        def scan(left: pa.Table, right: pa.Table) -> pa.Table:
            c, q = (matrix(x.column("v").combine_chunks()) if len(x) else np.empty((0, size)) for x in (left, right))
            qid = right.column("id").to_numpy()
            i, ids, s = best(q, c, qid, left.column("id").to_numpy(), k) if len(c) and len(q) else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
            return pa.table({"query_id": qid[i], "vec_id": ids, "score": s})

        more = left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block")).applyInArrow(scan, "query_id long, vec_id long, score double")
        found = found.join(enough.withColumnRenamed("id", "query_id"), "query_id", "left_semi").unionByName(more)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
