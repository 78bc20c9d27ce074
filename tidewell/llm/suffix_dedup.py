"""Repeated byte strings by suffix order and longest previous factors (operator 5).

A window is a string of `length` bytes inside one document.  Its anchor is the
place of the smallest hash among the half-length strings in it, so equal windows
have equal anchors.  Consecutive windows with one anchor are a run; a run's
context is all their bytes.

1. Runs are counted by (anchor hash, context hash).  An anchor that occurs once
   settles its windows as unique; equal contexts settle theirs as copies.
2. What is open is at the edges of copies: contexts that share an anchor but
   differ.  Their bytes are fetched and put, one of each kind, into groups of
   bounded size that hold whole anchors.  In a group a sparse suffix array of the
   window starts is sorted (prefix doubling), neighbours get their longest common
   prefixes, and previous and next smaller positions in suffix order give the
   longest previous factor of every window (the same on the reversed order: the
   longest later factor).  A factor of `length` or more is a copy.
3. An anchor with more kinds of context than a group may hold is decided window by
   window on a hash of the whole window, counted with a partial aggregate.

keep="none" removes every byte under a copied window, keep="first" only those of
windows that occur earlier (by key, then place).  All strings are judged on the
input.  Matches never cross documents.

`without_passages` judges by words: its windows are strings of more than `words` whole
words, anchored by half as many.  Equal contexts settle copies as in 1; windows of
contexts that differ are decided as in 2, in suffix order of whole words and gaps, and
those of anchors with more contexts or bytes than a group may hold by hashes as in 3.
Of the words beside a copied window goes what an earlier place of the window has beside
it too, by the longest previous factor that goes on over the window.  So exactly the bytes go that are in a string which stands earlier and holds
more than `words` words, whole in both places, between white space as of ASCII.

Defined cases: null text is empty; texts under `length` bytes are kept whole; null
keys are documents like others; rows that repeat key and text are copies of each
other with keep="none", and stay or go together with keep="first"; an empty table
gives an empty one; other columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidewell.llm.bytehash import PLACE_BITS, Keyed, Rolling, U, joined, mix, new_key, slabs, sliding_argmin
from tidewell.llm.tables import written

SLAB = 1 << 17  # so that the arrays of a slab stay in the cache
PIECE = 1 << (PLACE_BITS - 2)  # longer documents are hashed in pieces that overlap by a window
BLOCK_BYTES = 8 << 20
GROUP_CONTEXTS = 2000  # contexts a suffix array is built of
GROUP_BYTES = 16 << 20  # and their bytes, where words may be of any length


def _runs(texts: list[bytes], length: int, key: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For some texts at a time: (text, first window, windows, anchor hash, context hash) of its runs."""
    half = length // 2
    for first, last in slabs(texts, SLAB):
        pieces = [(i, x) for i in range(first, last) for x in range(0, max(1, len(texts[i]) - length + 1), PIECE)]
        for a, b in slabs([texts[i][x:x + PIECE] for i, x in pieces], SLAB):
            part = pieces[a:b]
            data, starts = joined([texts[i][x:x + PIECE + length - 1] for i, x in part])
            if len(data) < length:
                continue
            roll = Keyed(data, key)
            grams = Rolling(data, key).windows(half)  # these only choose and group anchors; contexts tell what is equal
            anchor = sliding_argmin(grams, length - half + 1)
            sizes = np.diff(starts)
            of = np.repeat(np.arange(len(part)), sizes)[: len(anchor)]
            valid = np.arange(len(anchor)) + length <= starts[of + 1]
            cut = np.r_[True, (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1]) | (valid[1:] != valid[:-1])]
            s = np.flatnonzero(cut)
            e = np.r_[s[1:], len(anchor)]
            ok = valid[s]
            s, e = s[ok], e[ok]
            at = anchor[s]
            where = np.array([i for i, _ in part])[of[s]]
            base = np.array([x for _, x in part])[of[s]]
            # the anchor's place in the context is part of its identity
            yield where, s - starts[of[s]] + base, e - s, grams[at], mix(roll.ranges(s, e - 1 + length) ^ (at - s).astype(U))


def _bytes_of(column) -> list[bytes]:
    return [(x or "").encode() for x in column.to_pylist()]


def _find_runs(length: int, key: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for where, s, size, kh, ch in _runs(_bytes_of(b.column("t")), length, key):
                at = pa.array(where)
                yield pa.RecordBatch.from_arrays(
                    [b.column("k").take(at), b.column("r").take(at), pa.array(s.astype(np.int64)), pa.array(size.astype(np.int32)), pa.array(kh.view(np.int64)), pa.array(ch.view(np.int64))],
                    names=["k", "r", "s", "size", "kh", "ch"])
    return run


def _cut_contexts(length: int):
    def run(docs: pa.Table, asked: pa.Table) -> pa.Table:
        text = dict(zip(docs.column("r").to_pylist(), _bytes_of(docs.column("t")), strict=True)) if len(asked) else {}
        body = [text[r][s:s + n - 1 + length] for r, s, n in zip(asked.column("r").to_pylist(), asked.column("s").to_pylist(), asked.column("size").to_pylist(), strict=True)]
        return asked.append_column("body", pa.array(body, pa.binary()))
    return run


def _ranks(first: np.ndarray, width: int, length: int) -> tuple[dict[int, np.ndarray], int]:
    """Prefix doubling: ranks of the strings of `width`, 2 * `width` ... symbols, up to `length`, and the last width."""
    ranks = {width: first}
    while width * 2 <= length:
        r = ranks[width]
        pair = (r << U(32)) | np.r_[r[width:], np.zeros(min(width, len(r)), U)][:len(r)]
        width *= 2
        ranks[width] = np.unique(pair, return_inverse=True)[1].astype(U)
    return ranks, width


def suffix_factors(bodies: list[bytes], windows: np.ndarray, rank_of_body: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the first `windows[i]` starts of every body: (body, place, longest previous
    factor, longest later factor), factors cut at `length`; bodies are ordered by rank."""
    gap = bytes(7)
    data, starts = joined(bodies, gap)
    data = np.r_[data, np.zeros(length + 8, np.uint8)]
    n = len(data) - 7
    packed = np.zeros(n, U)
    for j in range(8):
        packed = (packed << U(8)) | data[j: j + n].astype(U)
    ranks, width = _ranks(np.unique(packed, return_inverse=True)[1].astype(U), 8, length)
    body = np.repeat(np.arange(len(bodies)), windows)
    place = np.arange(len(body)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = starts[body] + place
    top = ranks[width]
    full = (top[at] << U(32)) | top[at + length - width]  # order of the first `length` bytes
    pos = np.lexsort((place, rank_of_body[body]))  # text order
    text_order = np.empty(len(pos), np.int64)
    text_order[pos] = np.arange(len(pos))
    suffix = np.lexsort((text_order, full))
    x, y = at[suffix[:-1]].copy(), at[suffix[1:]].copy()
    lcp = np.zeros(len(x), np.int64)
    for w in sorted(ranks, reverse=True):
        for _ in range(2 if w == width else 1):
            same = (lcp + w <= length) & (ranks[w][np.minimum(x + lcp, n - 1)] == ranks[w][np.minimum(y + lcp, n - 1)])
            lcp[same] += w
    for _ in range(7):
        same = (lcp < length) & (data[x + lcp] == data[y + lcp])
        lcp[same] += 1
    lcp[full[suffix[:-1]] == full[suffix[1:]]] = length
    order = text_order[suffix]
    before, after = _previous_factors(order, lcp), _previous_factors(len(order) - 1 - order, lcp)
    lpf, llf = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    lpf[suffix], llf[suffix] = before, after
    return body, place, lpf, llf


def _previous_factors(order: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """By suffix rank: the larger of the common prefixes with the nearest suffixes on
    either side that stand earlier in the text (previous and next smaller values)."""
    out = np.zeros(len(order), np.int64)
    for o, c, flip in ((order.tolist(), lcp.tolist(), False), (order[::-1].tolist(), lcp[::-1].tolist(), True)):
        found = [0] * len(o)
        stack: list[tuple[int, int]] = []  # (text order, common prefix with the entry below)
        for i, v in enumerate(o):
            common = c[i - 1] if i else 0
            while stack and stack[-1][0] > v:
                common = min(common, stack.pop()[1])
            found[i] = common if stack else 0
            stack.append((v, common))
        side = np.array(found[::-1] if flip else found, np.int64)
        np.maximum(out, side, out=out)
    return out


def _spans(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the maximal rows of consecutive numbers in ascending places."""
    edge = np.flatnonzero(np.diff(places) != 1)
    return np.r_[places[:1], places[edge + 1]], np.r_[places[edge], places[-1:]]


def _decide(length: int, keep: str, limit: int):
    def run(table: pa.Table) -> pa.Table:
        none = pa.table({"block": pa.array([], pa.int64()), "r": pa.array([], pa.int64()), "first": pa.array([], pa.int64()), "last": pa.array([], pa.int64())})
        if table.column("c")[0].as_py() > limit:
            return none  # decided by window hashes
        t = table.select(["block", "r", "s", "size", "single"]).to_pandas()
        order = np.empty(len(t), np.int64)
        order[pc.sort_indices(table, [("k", "ascending"), ("r", "ascending"), ("s", "ascending")], null_placement="at_start").to_numpy()] = np.arange(len(t))
        body, place, lpf, llf = suffix_factors(table.column("body").to_pylist(), t["size"].to_numpy(), order, length)
        hit = lpf >= length if keep == "first" else (lpf >= length) | (llf >= length)
        if keep != "first":
            hit &= t["single"].to_numpy()[body]  # the others are settled
        i = np.flatnonzero(hit)
        if not len(i):
            return none
        key = body[i] * (1 << 32) + place[i]
        a, b = _spans(key)
        at, s = a >> 32, t["s"].to_numpy()
        return pa.table({"block": t["block"].to_numpy()[at], "r": t["r"].to_numpy()[at], "first": s[at] + (a & 0xFFFFFFFF), "last": s[at] + (b & 0xFFFFFFFF)})
    return run


def _window_hashes(length: int, key: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pc.greater(b.column("c"), limit))
            for i, (body, size) in enumerate(zip(b.column("body").to_pylist(), b.column("size").to_pylist(), strict=True)):
                at = pa.array(np.full(size, i))
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).take(at) for c in ("block", "k", "r", "kh", "single")] + [pa.array(b.column("s")[i].as_py() + np.arange(size)),
                     pa.array(Keyed(np.frombuffer(body, np.uint8), key).windows(length).view(np.int64))], names=["block", "k", "r", "kh", "single", "p", "wh"])
    return run


def copied_windows(rows: DataFrame, length: int, keep: str, n_blocks: int) -> DataFrame:
    """(block, r, first, last): ranges of window starts to remove, of rows (block, k, r, t, ...)."""
    kind = rows.schema["k"].dataType.simpleString()
    block = F.pmod(F.col("r"), F.lit(n_blocks)).alias("block")
    key = new_key()
    runs = rows.select("k", "r", "t").mapInArrow(_find_runs(length, key), f"k {kind}, r long, s long, size int, kh long, ch long")
    # written first, like the counts below: a join with no aggregate above its exchange is split at a hot anchor
    anchors = written(runs.groupBy("kh").agg(F.count("*").alias("total")).filter("total > 1").select("kh"), "anchors")
    live = written(runs.join(anchors, "kh"), "runs")
    kinds = live.groupBy("kh", "ch").agg(F.count("*").alias("n"), F.min(F.struct("k", "r", "s", "size")).alias("rep"))
    kinds = written(kinds, "counted")
    shared = kinds.groupBy("kh").agg(F.count("*").alias("c"), F.count(F.when(F.col("n") == 1, 1)).alias("singles"))
    kinds = written(kinds.join(written(shared, "shared"), "kh"), "kinds")
    # equal contexts: all, or all but the first, are copies
    same = live.join(kinds.filter("n > 1").select("kh", "ch", "rep"), ["kh", "ch"])
    if keep == "first":
        same = same.filter(~(F.col("k").eqNullSafe(F.col("rep.k")) & (F.col("r") == F.col("rep.r")) & (F.col("s") == F.col("rep.s"))))
    settled = same.select(block, "r", F.col("s").alias("first"), (F.col("s") + F.col("size") - 1).alias("last"))
    # contexts that differ
    is_open = F.col("c") > 1 if keep == "first" else (F.col("c") > 1) & (F.col("singles") > 0)
    asked = kinds.filter(is_open).select("kh", "c", "rep.*", (F.col("n") == 1).alias("single")).select(block, "*")
    total, most = asked.agg(F.count("*"), F.max("c")).first()
    groups = max(1, math.ceil(total / GROUP_CONTEXTS))
    schema = f"block long, kh long, c long, k {kind}, r long, s long, size int, single boolean, body binary"
    contexts = rows.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(_cut_contexts(length), schema)
    # whole anchors to a group, contexts of an anchor with more kinds to any of the groups behind; dealt out
    # by hand and not filtered here, so that all readers share this exchange and, under it, that of the texts
    anywhere = F.pmod(F.xxhash64("r", "s"), F.lit(groups)) + groups
    contexts = contexts.withColumn("g", F.when(F.col("c") > GROUP_CONTEXTS, anywhere).otherwise(F.pmod(F.xxhash64("kh"), F.lit(groups)))).repartition("g")
    few = contexts.groupBy("g").applyInArrow(_decide(length, keep, GROUP_CONTEXTS), "block long, r long, first long, last long")
    flags = settled.unionByName(few)
    if (most or 0) <= GROUP_CONTEXTS:
        return flags  # no anchor has more kinds than a group may hold
    windows = contexts.mapInArrow(_window_hashes(length, key, GROUP_CONTEXTS), f"block long, k {kind}, r long, kh long, single boolean, p long, wh long")
    counted = windows.groupBy("kh", "wh").agg(F.count("*").alias("n"), F.min(F.struct("k", "r", "p")).alias("rep")).filter("n > 1")
    # equal windows have one anchor; by wh alone the counts are dealt again, and the join is split at a hot window
    many = windows.join(counted.drop("n", "kh"), "wh")
    if keep == "first":
        many = many.filter(~(F.col("k").eqNullSafe(F.col("rep.k")) & (F.col("r") == F.col("rep.r")) & (F.col("p") == F.col("rep.p"))))
    else:
        many = many.filter("single")
    return flags.unionByName(many.select("block", "r", F.col("p").alias("first"), F.col("p").alias("last")))


def _word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word and the byte after its last."""
    inner = np.zeros(len(data) + 2, np.int8)
    inner[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    step = np.diff(inner)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _find_word_runs(size: int, key: int):
    half = size // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = _bytes_of(b.column("t"))
            for first, last in slabs(texts, SLAB):
                data, starts = joined(texts[first:last], b" ")
                begin, end = _word_bounds(data)
                n = len(begin) - size + 1  # windows
                if n < 1:
                    continue
                roll = Keyed(data, key)
                grams = roll.ranges(begin[:len(begin) - half + 1], end[half - 1:])
                wide = size - half + 1
                anchor = np.concatenate([x + sliding_argmin(grams[x:x + PIECE + wide - 1], wide) for x in range(0, n, PIECE)])
                of = np.searchsorted(starts, begin, side="right") - 1
                valid = of[:n] == of[size - 1:]
                cut = np.r_[True, (anchor[1:] != anchor[:-1]) | (of[1:n] != of[:n - 1]) | (valid[1:] != valid[:-1])]
                s = np.flatnonzero(cut)
                e = np.r_[s[1:], n]
                s, e = s[valid[s]], e[valid[s]]
                if not len(s):
                    continue
                at, text, z = anchor[s], of[s], e + size - 2  # z: last word
                # the context has the words beside it, of which a part may be repeated too
                low = np.where((s > 0) & (of[s - 1] == text), begin[s - 1], starts[text])
                after = np.minimum(z + 1, len(begin) - 1)
                high = np.where((after > z) & (of[after] == text), end[after], starts[text + 1] - 1)
                lead = begin[s] - low
                ch = mix(mix(mix(roll.ranges(low, high) ^ (begin[at] - low).astype(U)) ^ lead.astype(U)) ^ (e - s).astype(U))
                row = pa.array(text + first)
                yield pa.RecordBatch.from_arrays(
                    [b.column("k").take(row), b.column("r").take(row), pa.array(low - starts[text]), pa.array(high - low), pa.array(lead), pa.array((e - s).astype(np.int32)), pa.array(grams[at].view(np.int64)), pa.array(ch.view(np.int64))],
                    names=["k", "r", "s", "bytes", "lead", "size", "kh", "ch"])
    return run


def _word_windows(size: int, key: int):
    """Windows of the contexts, each with the words beside it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first, last in slabs(whole.column("body").to_pylist(), SLAB):
                b = whole.slice(first, last - first)
                which, p, q, wh, left, right = [], [], [], [], [], []
                for i, (body, s, lead, windows) in enumerate(zip(*(b.column(c).to_pylist() for c in ("body", "s", "lead", "size")), strict=True)):
                    data = np.frombuffer(body, np.uint8)
                    begin, end = _word_bounds(data[lead:])
                    begin, end = begin + lead, end + lead
                    x, y = begin[:windows], end[size - 1:size - 1 + windows]
                    low, high = np.r_[0, begin[:windows - 1]], np.r_[end[size:size - 1 + windows], len(body)]
                    which.append(np.full(windows, i))
                    p.append(s + x)
                    q.append(s + y)
                    wh.append(Keyed(data, key).ranges(x, y).view(np.int64))
                    left += [body[a:z] for a, z in zip(low.tolist(), x.tolist(), strict=True)]
                    right += [body[a:z] for a, z in zip(y.tolist(), high.tolist(), strict=True)]
                at = pa.array(np.concatenate(which))
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).take(at) for c in ("block", "k", "r", "kh")] + [pa.array(np.concatenate(x)) for x in (p, q, wh)] + [pa.array(x, pa.binary()) for x in (left, right)],
                    names=["block", "k", "r", "kh", "p", "q", "wh", "beside_left", "beside_right"])
    return run


def _common(x: bytes, y: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    return int(np.flatnonzero(np.frombuffer(x, np.uint8, n) != np.frombuffer(y, np.uint8, n))[0])


def word_factors(bodies: list[bytes], leads: list[int], windows: np.ndarray, rank_of_body: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows of `size` words that stand earlier too: (body, first byte, byte after
    the last), with what the longest match with an earlier place has on either side.

    The suffixes begin at words and are strings of symbols, a whole word or a whole gap
    each; they are put in order by 2 * `size` - 1 symbols, then by the bytes that follow."""
    data, starts = joined(bodies)
    begins, ends = [], []
    for i, lead in enumerate(leads):
        begin, end = _word_bounds(data[starts[i] + lead:starts[i + 1]])
        begins.append(begin + starts[i] + lead)
        ends.append(end + starts[i] + lead)
    n_words = np.array([len(x) for x in begins])
    begin, end = np.concatenate(begins), np.concatenate(ends)
    edges = np.stack([begin, end], 1).ravel()  # what is between two bodies is a symbol of no window
    words = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)])
    symbols = words.dictionary_encode().indices.to_numpy().astype(U)
    length = 2 * size - 1
    ranks, width = _ranks(symbols, 1, length)
    body = np.repeat(np.arange(len(bodies)), windows)
    place = np.arange(len(body)) - np.repeat(np.cumsum(windows) - windows, windows)
    word = np.repeat(np.cumsum(n_words) - n_words, windows) + place
    full = (ranks[width][2 * word] << U(32)) | ranks[width][2 * word + length - width]
    kind, n = np.unique(full, return_inverse=True, return_counts=True)[1:]
    some = np.flatnonzero(n[kind] > 1)
    pos = np.lexsort((place[some], rank_of_body[body[some]]))
    some, kind = some[pos], kind[some[pos]]  # in text order
    body, word = body[some], word[some]
    a, b = begin[word], end[word + size - 1]
    low = np.where(place[some] > 0, begin[np.maximum(word - 1, 0)], starts[body])
    last = place[some] == windows[body] - 1
    high = np.where(last, starts[body + 1], end[np.minimum(word + size, len(end) - 1)])
    raw = data.tobytes()
    right = _sides_held(kind, [raw[x:y] for x, y in zip(b.tolist(), high.tolist(), strict=True)])
    left = _sides_held(kind, [raw[x:y][::-1] for x, y in zip(low.tolist(), a.tolist(), strict=True)])
    hit = right > 0  # then left is above 0 too
    at = body[hit]
    return at, (a[hit] - left[hit] + 1) - starts[at], (b[hit] + right[hit] - 1) - starts[at]


def _sides_held(kind: np.ndarray, beside: list[bytes]) -> np.ndarray:
    """For windows in text order, of the given kinds: 0 without an earlier one of the kind,
    else 1 and the longest common prefix of what is beside it with that of an earlier one."""
    order = np.array(sorted(range(len(kind)), key=lambda i: (kind[i], beside[i], i)), np.int64)
    lcp = np.array([_common(beside[x], beside[y]) + 1 if kind[x] == kind[y] else 0 for x, y in zip(order[:-1].tolist(), order[1:].tolist(), strict=True)], np.int64)
    out = np.empty(len(order), np.int64)
    out[order] = _previous_factors(order, lcp)
    return out


def _cut_bodies(docs: pa.Table, asked: pa.Table) -> pa.Table:
    text = dict(zip(docs.column("r").to_pylist(), _bytes_of(docs.column("t")), strict=True)) if len(asked) else {}
    body = [text[r][s:s + n] for r, s, n in zip(*(asked.column(c).to_pylist() for c in ("r", "s", "bytes")), strict=True)]
    return asked.append_column("body", pa.array(body, pa.binary()))


def _decide_words(size: int):
    def run(table: pa.Table) -> pa.Table:
        order = np.empty(len(table), np.int64)
        order[pc.sort_indices(table, [("k", "ascending"), ("r", "ascending"), ("s", "ascending"), ("lead", "ascending")], null_placement="at_start").to_numpy()] = np.arange(len(table))
        s, windows = (table.column(c).to_numpy() for c in ("s", "size"))
        body, first, last = word_factors(table.column("body").to_pylist(), table.column("lead").to_pylist(), windows, order, size)
        found = defaultdict(list)
        for i, x, y in zip(body.tolist(), first.tolist(), last.tolist(), strict=True):
            found[i].append((x, y))
        spans = [(i, x, y) for i, xy in found.items() for x, y in removed_bytes(*np.array(xy).T, 0)]
        i, x, y = (np.array(c, np.int64) for c in zip(*spans, strict=True)) if spans else [np.empty(0, np.int64)] * 3
        return pa.table({"block": table.column("block").to_numpy()[i], "r": table.column("r").to_numpy()[i], "first": s[i] + x, "last": s[i] + y})
    return run


def _beside(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[pa.RecordBatch]:
    """Each string that ends a left neighbour or begins a right one, by its hash."""
    for b in batches:
        for side, differs, body in ((0, "dl", "beside_left"), (1, "dr", "beside_right")):
            which, far, hashes = [], [], []
            for i, (d, t) in enumerate(zip(b.column(differs).to_pylist(), b.column(body).to_pylist(), strict=True)):
                if d and t:
                    n = np.arange(1, len(t) + 1)
                    zero = np.zeros(len(t), np.int64)
                    which.append(np.full(len(t), i))
                    far.append(n)
                    hashes.append(Keyed(np.frombuffer(t, np.uint8), key).ranges(*((zero, n) if side else (len(t) - n, zero + len(t)))))
            if which:
                at = pa.array(np.concatenate(which))
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).take(at) for c in ("block", "k", "r", "p", "q", "kh", "wh")] + [pa.array(np.full(len(at), side, np.int32)), pa.array(np.concatenate(far)), pa.array(np.concatenate(hashes).view(np.int64))],
                    names=["block", "k", "r", "p", "q", "kh", "wh", "side", "far", "h"])


def _later(p: str) -> F.Column:
    return ~(F.col("k").eqNullSafe(F.col("rep.k")) & (F.col("r") == F.col("rep.r")) & (F.col(p) == F.col(f"rep.{p}")))


def copied_passages(rows: DataFrame, words: int, n_blocks: int) -> DataFrame:
    """(block, r, first, last): byte ranges to remove (last not included), of rows (block, k, r, t, ...)."""
    kind = rows.schema["k"].dataType.simpleString()
    block = F.pmod(F.col("r"), F.lit(n_blocks)).alias("block")
    key = new_key()
    runs = rows.select("k", "r", "t").mapInArrow(_find_word_runs(words + 1, key), f"k {kind}, r long, s long, bytes long, lead long, size int, kh long, ch long")
    # tables are written as in copied_windows: joins are split at a hot anchor
    anchors = written(runs.groupBy("kh").agg(F.count("*").alias("total")).filter("total > 1").select("kh"), "anchors")
    live = written(runs.join(anchors, "kh"), "runs")
    kinds = written(live.groupBy("kh", "ch").agg(F.count("*").alias("n"), F.min(F.struct("k", "r", "s", "bytes", "lead", "size")).alias("rep")), "counted")
    shared = written(kinds.groupBy("kh").agg(F.count("*").alias("c"), F.sum("rep.bytes").alias("weight")).filter("c > 1"), "shared")
    same = live.join(kinds.filter("n > 1").select("kh", "ch", "rep"), ["kh", "ch"]).filter(_later("s"))
    settled = same.select(block, "r", F.col("s").alias("first"), (F.col("s") + F.col("bytes")).alias("last"))
    # contexts that differ
    asked = kinds.join(shared, "kh").select("kh", "c", "weight", "rep.*").select(block, "*")
    is_few = (F.col("c") <= GROUP_CONTEXTS) & (F.col("weight") <= GROUP_BYTES)
    total, weight, most = asked.agg(F.count("*"), F.sum("bytes"), F.count_if(~is_few)).first()
    groups = max(1, math.ceil(total / GROUP_CONTEXTS), math.ceil((weight or 0) / GROUP_BYTES))
    schema = f"block long, kh long, c long, weight long, k {kind}, r long, s long, bytes long, lead long, size int, body binary"
    contexts = rows.select("block", "r", "t").groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(_cut_bodies, schema)
    if most:
        contexts = written(contexts, "contexts")  # read twice below: the texts are not shuffled again for it
    few = contexts.filter(is_few).withColumn("g", F.pmod(F.xxhash64("kh"), F.lit(groups))).groupBy("g").applyInArrow(_decide_words(words + 1), "block long, r long, first long, last long")
    flags = settled.unionByName(few)
    if not most:
        return flags  # no anchor has more than a group may hold
    schema = f"block long, k {kind}, r long, kh long, p long, q long, wh long, beside_left binary, beside_right binary"
    windows = written(contexts.filter(~is_few).mapInArrow(_word_windows(words + 1, key), schema), "windows")
    differs = lambda c: F.min(c) != F.max(c)
    counted = windows.groupBy("kh", "wh").agg(F.count("*").alias("n"), F.min(F.struct("k", "r", "p")).alias("rep"), differs("beside_left").alias("dl"), differs("beside_right").alias("dr"))
    many = written(windows.join(written(counted.filter("n > 1").drop("n"), "repeated"), ["kh", "wh"]), "copies")
    copies = many.filter(_later("p")).select(
        "block", "r", F.when(F.col("dl"), F.col("p")).otherwise(F.col("p") - F.octet_length("beside_left")).alias("first"), F.when(F.col("dr"), F.col("q")).otherwise(F.col("q") + F.octet_length("beside_right")).alias("last"))
    # neighbours that differ: as much as an earlier place has too
    edges = many.filter("dl or dr").mapInArrow(lambda it: _beside(it, key), f"block long, k {kind}, r long, p long, q long, kh long, wh long, side int, far long, h long")
    edges = written(edges, "edges")
    keys = ["kh", "wh", "side", "far", "h"]
    held = edges.groupBy(*keys).agg(F.count("*").alias("n"), F.min(F.struct("k", "r", "p")).alias("rep")).filter("n > 1").drop("n")
    edges = edges.join(written(held, "held"), keys).filter(_later("p"))
    left = F.col("side") == 0
    edges = edges.select("block", "r", F.when(left, F.col("p") - F.col("far")).otherwise(F.col("q")).alias("first"), F.when(left, F.col("p")).otherwise(F.col("q") + F.col("far")).alias("last"))
    return flags.unionByName(copies).unionByName(edges)


def removed_bytes(first: np.ndarray, last: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges under the windows that start in the given ranges."""
    out: list[list[int]] = []
    for a, b in sorted(zip(first.tolist(), (last + length).tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def keep_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def keep_text(text: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without the whole characters inside the spans."""
    inner = []
    for a, b in spans:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        inner.append((a, b))
    return keep_bytes(text, inner).decode()


def _spans_by_row(flags: pa.Table, length: int) -> dict[int, list[tuple[int, int]]]:
    if not len(flags):
        return {}
    t = flags.select(["r", "first", "last"]).to_pandas().sort_values("r", kind="stable")
    r, a, b = (t[c].to_numpy() for c in ("r", "first", "last"))
    cut = np.r_[np.flatnonzero(np.r_[True, r[1:] != r[:-1]]), len(r)]
    out: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        out[int(r[x])] = removed_bytes(a[x:y], b[x:y], length)
    return out


def _in_blocks(docs: DataFrame, key: str, text: str, others: list[str]) -> tuple[DataFrame, int]:
    """Rows (block, k, r, t, rest): r tells the texts of one key apart, rest is carried."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    n = max(1, math.ceil(size / BLOCK_BYTES))
    rest = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest")] if others else []
    # by key and text: one key, or null, on many rows is dealt over all blocks
    return docs.select(F.pmod(F.xxhash64(key, text), F.lit(n)).alias("block"), F.col(key).alias("k"), F.xxhash64(key, text).alias("r"), F.col(text).alias("t"), *rest), n


def remove_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", *, length: int = 400, keep: str = "none") -> DataFrame:
    """(key, n_bytes, n_removed, spans, kept, text) for every row: the removed byte ranges,
    the remaining bytes, and those as text, without characters of which a part went."""
    _check(length, keep)
    rows, n_blocks = _in_blocks(docs, key, text, [])
    flags = copied_windows(rows, length, keep, n_blocks)

    def apply(docs: pa.Table, flags: pa.Table) -> pa.Table:
        spans = _spans_by_row(flags, length)
        out = []
        for r, t in zip(docs.column("r").to_pylist(), _bytes_of(docs.column("t")), strict=True):
            cut = spans.get(r, [])
            kept = keep_bytes(t, cut)
            out.append((len(t), sum(b - a for a, b in cut), [{"start": a, "end": b} for a, b in cut], kept, keep_text(t, cut)))
        n, gone, cut, kept, text = zip(*out, strict=True) if out else ([], [], [], [], [])
        return pa.table({"k": docs.column("k"), "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()),
                         "spans": pa.array(cut, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept": pa.array(kept, pa.binary()), "text": pa.array(text, pa.string())})

    kind = docs.schema[key].dataType.simpleString()
    out = rows.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(apply, f"k {kind}, n_bytes long, n_removed long, spans array<struct<start: bigint, end: bigint>>, kept binary, text string")
    return out.withColumnRenamed("k", key)


def removal_digest(docs: DataFrame, key: str = "doc_id", text: str = "text", *, length: int = 400) -> DataFrame:
    """Counts of removed bytes and spans, the SHA-256 of what remains, and that as text."""
    out = remove_copies(docs, key, text, length=length)
    return out.select(key, "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), "text")


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", *, length: int = 400) -> DataFrame:
    """All rows and columns, later copies cut from the text (whole characters only);
    a null text stays null.  A text that is a copy as a whole becomes empty."""
    _check(length, "first")
    rows, n_blocks = _in_blocks(docs, key, text, [c for c in docs.columns if c not in (key, text)])
    return _without(docs, key, text, rows, copied_windows(rows, length, "first", n_blocks), length)


def without_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", *, words: int = 50) -> DataFrame:
    """Like `without_copies`, of passages of more than `words` words."""
    if words < 1:
        raise ValueError("words must be 1 or more")
    rows, n_blocks = _in_blocks(docs, key, text, [c for c in docs.columns if c not in (key, text)])
    return _without(docs, key, text, rows, copied_passages(rows, words, n_blocks), 0)


def _without(docs: DataFrame, key: str, text: str, rows: DataFrame, flags: DataFrame, length: int) -> DataFrame:
    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        spans = _spans_by_row(right, length)
        texts = left.column("t").to_pylist()
        new = [t if t is None or r not in spans else keep_text(t.encode(), spans[r]) for r, t in zip(left.column("r").to_pylist(), texts, strict=True)]
        out = left.select([c for c in left.column_names if c in ("k", "rest")])
        return out.append_column("t", pa.array(new, left.column("t").type))

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("k", "rest", "t") if c in kinds)
    out = rows.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(apply, schema)
    place = {key: F.col("k"), text: F.col("t")}
    return out.select(*[place.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns])


def _check(length: int, keep: str) -> None:
    if length < 32 or keep not in ("none", "first"):
        raise ValueError("length must be 32 or more, keep none or first")
