"""Near-duplicate vectors by a forest of random-projection trees (operator 8).

A tree splits by the median projection on a random direction, again and again;
vectors within `spill` of a split go to both sides.  Directions and medians are
fitted on a bounded sample; every row is routed through every tree.  Rows of one
label and leaf are compared with each other.

Two unit vectors with cosine c differ by at most sqrt(2 - 2c) along any direction,
and by much less along a random one of many dimensions; a pair can only be parted at
a split if it differs by more than twice the spill there, and must be parted so in
every tree to be missed.

Counting links needs no pairs: a pair that shares several leaves is counted in the
first one only, which each side can tell from the leaves of both.  A leaf sends one
count for each row and one edge for each row to the smallest row it is connected to.
Large leaves are dealt into cells of two chunks each, so no task holds a leaf.  Equal
vectors of a label are one class with a size, and are never compared.

Defined cases: vectors that are null, zero, hold null or non-finite components or have
another length than the most frequent one, and rows without a label, link with nothing and are their own component; null ids keep
their row with a null component; repeated ids are versions of one row; an empty table
gives an empty one; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewell.llm.graph import components
from tidewell.llm.tables import written
from tidewell.llm.vectors import matrix, usable, usual_length

SAMPLE = 8_000
LEAF_ROWS = 1_000
CELL_ROWS = 2_000
SPLIT_LEAST = 8  # sample vectors a split must stand on


class Tree:
    """Splits as arrays: children of node i are 2i + 1 and 2i + 2."""

    def __init__(self, sample: np.ndarray, depth: int, rng: np.random.Generator):
        self.depth = depth
        self.direction = rng.normal(size=(2**depth - 1, sample.shape[1]))
        self.direction /= np.linalg.norm(self.direction, axis=1, keepdims=True)
        self.median = np.full(2**depth - 1, np.nan)
        held = {0: np.arange(len(sample))}
        for i in range(2**depth - 1):
            rows = held.pop(i, np.empty(0, np.int64))
            if len(rows) >= SPLIT_LEAST:
                p = sample[rows] @ self.direction[i]
                self.median[i] = np.median(p)
                held[2 * i + 1], held[2 * i + 2] = rows[p < self.median[i]], rows[p >= self.median[i]]

    def leaves(self, x: np.ndarray, spill: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf each row belongs to; an unsplit node is a leaf."""
        row, node, out = np.arange(len(x)), np.zeros(len(x), np.int64), []
        for _ in range(self.depth):
            split = ~np.isnan(self.median[node])
            out.append((row[~split], node[~split]))
            row, node = row[split], node[split]
            d = np.einsum("ij,ij->i", x[row], self.direction[node]) - self.median[node]
            left, right = d < spill, d >= -spill
            row, node = np.r_[row[left], row[right]], np.r_[2 * node[left] + 1, 2 * node[right] + 2]
        out.append((row, node))
        return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def _unit(column: pa.Array) -> np.ndarray:
    x = matrix(column)
    if not len(x):
        return x
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _membership(own: list[list[dict]], trees: int) -> list[np.ndarray]:
    """For each tree the leaves of each row, padded with numbers that no other row has."""
    out = []
    for t in range(trees):
        of = [[o["leaf"] for o in row if o["tree"] == t] for row in own]
        wide = max(map(len, of), default=0)
        out.append(np.array([row + [-1 - i] * (wide - len(row)) for i, row in enumerate(of)], np.int64).reshape(len(own), wide))
    return out


def _first_shared(leaves: list[np.ndarray], p: np.ndarray, q: np.ndarray, tree: int, leaf: int) -> np.ndarray:
    """Whether this leaf of this tree is the first that both rows of a pair lie in."""
    first = np.ones(len(p), bool)
    for t in range(tree + 1):
        mine, other = leaves[t][p], leaves[t][q]
        for x in range(mine.shape[1]):
            for y in range(other.shape[1]):
                same = mine[:, x] == other[:, y]
                first &= ~(same & (mine[:, x] < leaf)) if t == tree else ~same
    return first


def _smallest_reached(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Smallest row each row is connected to."""
    low = np.arange(n)
    while len(p):
        m = np.minimum(low[p], low[q])
        before = low.copy()
        np.minimum.at(low, p, m)
        np.minimum.at(low, q, m)
        low = low[low]
        if (low == before).all():
            break
    return low


def _pairs_in_leaf(threshold: float, trees: int):
    """Counts and spanning edges of a cell: rows of chunk i against rows of chunk j."""
    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("c")
        ident, x = t.column("c").to_numpy(), np.frombuffer(b"".join(t.column("u").to_pylist()), np.float64).reshape(len(t), -1)
        leaves = _membership(t.column("leaves").to_pylist(), trees)
        tree, leaf, i, j = (k.as_py() for k in key[1:])
        chunk, size = t.column("chunk").to_numpy(), t.column("size").to_numpy()
        a, b = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for at in range(0, len(a), 256):
            w = a[at:at + 256]
            p, q = np.nonzero(x[w] @ x[b].T >= threshold - 1e-9)
            p, q = w[p], b[q]
            keep = p < q if i == j else p != q
            p, q = p[keep], q[keep]
            keep = np.einsum("ij,ij->i", x[p], x[q]) >= threshold
            p, q = p[keep], q[keep]
            keep = _first_shared(leaves, p, q, tree, leaf)
            left.append(p[keep])
            right.append(q[keep])
        p, q = np.concatenate(left), np.concatenate(right)
        count = np.bincount(p, size[q], len(t)) + np.bincount(q, size[p], len(t))
        at = np.flatnonzero(count)
        return pa.table({"c": ident[at], "count": count[at].astype(np.int64), "to": ident[_smallest_reached(len(t), p, q)[at]]})
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", label: str = "label", *, cosine: float = 0.98, trees: int = 4, spill: float = 0.04, seed: int = 11) -> DataFrame:
    """(id, n_links, component_id, kept) for every row."""
    every = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label).alias("label"), F.col(column).alias("v"))
    known = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & usable("v"), F.lit(False))
    fit = known & (F.size("v") == usual_length(every.filter(known), "v"))
    able = every.filter(fit)
    # equal vectors of a label are one class, named by its smallest id
    able = written(able.withColumn("h", F.xxhash64("v")), "able")
    classes = able.groupBy("label", "v", "h").agg(F.min("id").alias("c"), F.countDistinct("id").alias("size"))
    classes = written(classes, "classes")
    n, kinds = classes.agg(F.count("*"), F.countDistinct("label")).first()
    sample_rows = classes.orderBy(F.xxhash64("c"), "c").limit(SAMPLE).select("v").toArrow()  # bounded by SAMPLE
    if n:
        sample = _unit(sample_rows.column("v").combine_chunks())
        depth = max(0, math.ceil(math.log2(max(1, n / max(1, kinds) / LEAF_ROWS))))
        forest = [Tree(sample, min(depth, 12), np.random.default_rng([seed, t])) for t in range(trees)]
    else:
        forest = []

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 1000):
                part = b.slice(s, 1000)
                x = _unit(part.column("v"))
                mine: list[list[dict]] = [[] for _ in range(len(x))]
                for t, tree in enumerate(forest):
                    for r, leaf in zip(*(y.tolist() for y in tree.leaves(x, spill)), strict=True):
                        mine[r].append({"tree": t, "leaf": leaf})
                yield pa.RecordBatch.from_arrays([part.column("label"), part.column("c"), part.column("size"), pa.array([r.tobytes() for r in x], pa.binary()),
                                                  pa.array(mine, pa.list_(pa.struct([("tree", pa.int32()), ("leaf", pa.int64())])))], names=["label", "c", "size", "u", "leaves"])

    kind = every.schema["label"].dataType.simpleString()
    routed = written(classes.select("label", "c", "size", "v").mapInArrow(route, f"label {kind}, c long, size long, u binary, leaves array<struct<tree: int, leaf: bigint>>"), "routed")
    places = routed.select("*", F.explode("leaves").alias("at")).select("label", "c", "size", "u", "leaves", "at.tree", "at.leaf")
    sizes = places.groupBy("label", "tree", "leaf").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("g"), F.count("*").alias("m")).filter("m > 1").drop("m")
    dealt = (places.join(sizes, ["label", "tree", "leaf"]).withColumn("chunk", F.pmod(F.xxhash64("c"), F.col("g")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
             .withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other")).drop("g", "other"))
    found = written(dealt.groupBy("label", "tree", "leaf", "i", "j").applyInArrow(_pairs_in_leaf(cosine, trees), "c long, count long, to long"), "links")
    counts = found.groupBy("c").agg(F.sum("count").alias("others"))
    comp = components(found, "c", "to").withColumnsRenamed({"id": "c"})
    of_class = classes.select("label", "v", "h", "c", "size").join(counts, "c", "left").join(comp, "c", "left")
    of_class = of_class.select("c", (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "c").alias("component_id"), "label", "h", "v")
    linked = able.join(of_class, ["label", "h", "v"]).select("id", "n_links", "component_id")
    alone = every.filter(~F.coalesce(fit, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
