"""Plain versions of the corpus operators, for tests."""

import hashlib
import re
from collections import defaultdict


def groups(pairs, ids):
    top = {i: i for i in ids}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x
    for a, b in pairs:
        a, b = root(a), root(b)
        top[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text, k=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def jaccard_groups(docs, percent=80, k=5):
    """{id: (set size, component)} of [(id, text)]."""
    sets = {i: shingles(t, k) for i, t in docs}
    held = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            held[x].append(i)
    near = set()
    for ids in held.values():
        near |= {(a, b) for a in ids for b in ids if a < b}
    links = [(a, b) for a, b in near if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = groups(links, sets)
    return {i: (len(s), comp[i]) for i, s in sets.items()}


def repeated(docs, length):
    """[(n_bytes, n_removed, n_spans, sha256)] of [text], all copies removed."""
    raw = [(t or "").encode() for t in docs]
    seen = defaultdict(int)
    for t in raw:
        for p in range(len(t) - length + 1):
            seen[t[p:p + length]] += 1
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def first_kept(docs, length):
    """Bytes kept of [(id, text)] when earlier windows (by id, place) stay."""
    rows = sorted(((i, (t or "").encode()) for i, t in docs), key=lambda x: x[0])
    seen, out = set(), {}
    for i, t in rows:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            w = t[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        out[i] = bytes(c for c, g in zip(t, gone, strict=True) if not g)
    return out


def passages_kept(docs, words):
    """Bytes kept of [(id, text)] when strings of more than `words` words, whole in both places, go but for the first by id and place."""
    rows = sorted(((i, t.encode()) for i, t in docs), key=lambda x: x[0])
    bounds = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0d]+", t)] for _, t in rows]
    gone = [bytearray(len(t)) for _, t in rows]
    held = defaultdict(list)
    for d, (_, t) in enumerate(rows):
        for a in range(len(bounds[d]) - words):
            p, q = bounds[d][a][0], bounds[d][a + words][1]
            for e, x, y in held[t[p:q]]:
                u, i, j = rows[e][1], 0, 0
                while p - i > 0 and x - i > 0 and t[p - i - 1] == u[x - i - 1]:
                    i += 1
                while q + j < len(t) and y + j < len(u) and t[q + j] == u[y + j]:
                    j += 1
                gone[d][p - i:q + j] = b"\1" * (q - p + i + j)
            held[t[p:q]].append((d, p, q))
    return {i: bytes(c for c, g in zip(t, x, strict=True) if not g) for (i, t), x in zip(rows, gone, strict=True)}
