"""Encoding inside tasks with the installed tokenizers; files are read, never trained.

Texts are encoded piece by piece: a piece is a run of anything but white space, with
the one space before it, or a run of white space.  The tokenizers used here split
text at these places before they merge, so the ids are those of the whole text, and
a task encodes each different piece once.  They also split where a sign follows a letter,
so a word is the same piece with and without a comma; where a tokenizer drops white space
and lower-cases, pieces have no space and A-Z are lower-cased first, but not before a byte
beyond ASCII, which may be a mark that belongs to the letter.  Texts in which that could fail, with white
space beyond ASCII, the separators 28 to 31 or the string of an added token, are
encoded whole.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate, chain

import numpy as np

from tidewell.llm.bytehash import Rolling, U, joined, slabs

UNUSUAL = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
UNUSUAL_ASCII = re.compile("[\x1c-\x1f]")
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
SIGNS = r"!-/:-@\[-`{-~"
WORD = re.compile(f"^( ?[{LETTERS}]+)([{SIGNS}]*)$")
BARE = re.compile(f"^ ?([{LETTERS}]+)([{SIGNS}]*)$")
PIECES_KEPT = 500_000  # about 70 MB a worker
SLAB = 1 << 17  # so that the arrays of a slab stay in the cache
CHARS = 1 << 22  # text that is encoded at once


def _byte_letters() -> dict[int, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand
    for themselves, the others for those from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}


_LETTER = _byte_letters()
_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES | 32, _BYTES)
_IS_LETTER = (_LOWER >= 97) & (_LOWER <= 122)
_IS_SIGN = np.array([bool(re.match(f"[{SIGNS}]", chr(b))) for b in range(256)])


def _shown(word: str) -> str:
    if word.isascii():
        return word.replace(" ", chr(_LETTER[32]))
    return word.encode().decode("latin-1").translate(_LETTER)


def vocabulary(name: str) -> str:
    """Place of an installed vocabulary file; a path with a folder is taken as it is."""
    if os.path.dirname(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def cut(data: np.ndarray, starts: np.ndarray, bare: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the pieces of some texts in one buffer, in order.

    A run without white space takes the one space before it.  Of white space before a
    word, what is left but its last sign is a piece, and the last if it is no space;
    at the end of a text white space is one piece.  Bare pieces are the runs without white space alone."""
    n = len(data)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(n + 1, bool)
    edge[starts] = True
    edge[1:n] |= space[1:] != space[:-1]
    at = np.flatnonzero(edge)
    begin, end = at[:-1], at[1:]
    blank = space[begin]
    last_of_text = np.zeros(n + 1, bool)
    last_of_text[starts] = True
    word_b, word_e = begin[~blank], end[~blank]
    if bare:
        return word_b, word_e
    inner = np.ones(n + 1, bool)  # not the first byte of a text
    inner[starts] = False
    word_b = word_b - (inner[word_b] & (data[np.maximum(word_b - 1, 0)] == 32))
    run_b, run_e = begin[blank], end[blank]
    closing = last_of_text[run_e]
    lead_e = np.where(closing, run_e, run_e - 1)
    lead = lead_e > run_b
    odd = ~closing & (data[run_e - 1] != 32)
    return _sorted(word_b, run_b[lead], run_e[odd] - 1), _sorted(word_e, lead_e[lead], run_e[odd])


def _sorted(*parts: np.ndarray) -> np.ndarray:
    return np.sort(np.concatenate(parts), kind="stable")  # which merges what is sorted already


def at_signs(data: np.ndarray, starts: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces cut where a sign follows a letter, both of ASCII."""
    cuts = _IS_SIGN[data]
    cuts[1:] &= _IS_LETTER[data[:-1]]
    cuts[starts[:-1][starts[:-1] < len(data)]] = False
    cuts = np.flatnonzero(cuts)
    return _sorted(begin, cuts), _sorted(end, cuts)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased but before a byte beyond ASCII: H and a macron below make no letter, h and it do."""
    out = _LOWER[data]
    kept = np.flatnonzero(data[1:] >= 128)
    out[kept] = data[kept]
    return out


_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], U)  # of a word of 8 bytes the first n


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, of data that ends in 8 bytes more."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


def _put(held: np.ndarray, at: int, more: np.ndarray) -> np.ndarray:
    """The array with `more` from a place on, twice as long where it is too short."""
    if at + len(more) > len(held):
        held = np.concatenate([held[:at], np.zeros((at + len(more), *held.shape[1:]), held.dtype)])
    held[at:at + len(more)] = more
    return held


class Pieces:
    """What has been made of pieces: rows of numbers, found by the hash of the piece and
    compared with its bytes.  Pieces that share another's hash are kept by their bytes."""

    def __init__(self, make: Callable[[list[str]], list[list]], width: int):
        self.make, self.width = make, width
        self.clear()

    def clear(self) -> None:
        self.bits = 16
        self.keys, self.at = np.zeros(1 << self.bits, U), np.zeros(1 << self.bits, np.int64)
        self.pieces = 0
        self.known = np.empty(1024, U)
        self.count, self.first, self.begin, self.size = (np.empty(1024, np.int64) for _ in range(4))
        self.rows = np.empty((1024, self.width), np.int32)
        self.used = 0
        self.text, self.end = np.zeros(1 << 16, np.uint8), 0
        self.clashes: dict[bytes, int] = {}

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Number of each piece, -1 where it is not known."""
        out = np.full(len(h), -1, np.int64)
        slot, open_ = (h >> U(64 - self.bits)).astype(np.int64), np.arange(len(h))
        while len(open_):
            k = self.keys[slot]
            hit = k == h[open_]
            out[open_[hit]] = self.at[slot[hit]]
            on = ~hit & (k != 0)
            open_, slot = open_[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out

    def _place(self, h: np.ndarray, number: np.ndarray) -> None:
        slot = (h >> U(64 - self.bits)).astype(np.int64)
        while len(h):
            free = self.keys[slot] == 0
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(h))), return_index=True)
            take = first[free[first]]
            self.keys[slot[take]], self.at[slot[take]] = h[take], number[take]
            left = np.ones(len(h), bool)
            left[take] = False
            h, number, slot = h[left], number[left], (slot[left] + 1) & (len(self.keys) - 1)

    def _store(self, h: np.ndarray, pieces: list[bytes]) -> np.ndarray:
        """Numbers of new pieces."""
        made = self.make([p.decode() for p in pieces])
        count = np.fromiter(map(len, made), np.int64, len(made)) // self.width
        flat = np.fromiter(chain.from_iterable(made), np.int32, int(count.sum()) * self.width).reshape(-1, self.width)
        self.rows = _put(self.rows, self.used, flat)
        body, size = b"".join(pieces), np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.text = _put(self.text, self.end, np.frombuffer(body + bytes(8), np.uint8))
        n = self.pieces
        self.first = _put(self.first, n, self.used + np.cumsum(count) - count)
        self.count = _put(self.count, n, count)
        self.begin = _put(self.begin, n, self.end + np.cumsum(size) - size)
        self.size = _put(self.size, n, size)
        self.known = _put(self.known, n, h)
        self.used += len(flat)
        self.end += len(body)
        self.pieces += len(h)
        return n + np.arange(len(h))

    def _learn(self, h: np.ndarray, pieces: list[bytes]) -> None:
        number = self._store(h, pieces)
        if 2 * self.pieces > len(self.keys):
            while 3 * self.pieces > 1 << self.bits:
                self.bits += 1
            self.keys, self.at = np.zeros(1 << self.bits, U), np.zeros(1 << self.bits, np.int64)
            number = np.flatnonzero(self.known[:self.pieces])
            h = self.known[number]
        self._place(h, number)

    def _differ(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Which pieces are not those of their numbers."""
        odd = self.size[number] != size
        open_, new, old, at = np.flatnonzero(~odd), _words(data), _words(self.text), self.begin[number]
        done = 0
        while len(open_):
            left = _MASK[np.minimum(size[open_] - done, 8)]
            other = (new[begin[open_] + done] ^ old[at[open_] + done]) & left != 0
            odd[open_[other]] = True
            done += 8
            open_ = open_[~other & (size[open_] > done)]
        return np.flatnonzero(odd)

    def of(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the pieces one after the other, and how many each has."""
        if self.pieces > PIECES_KEPT:
            self.clear()
        number = self._find(h)
        miss = np.flatnonzero(number < 0)
        if len(miss):
            fresh, place = np.unique(h[miss], return_index=True)
            at = miss[place]
            self._learn(fresh, [data[b:e].tobytes() for b, e in zip(begin[at].tolist(), end[at].tolist(), strict=True)])
            number[miss] = self._find(h[miss])
        for i in self._differ(np.r_[data, np.zeros(8, np.uint8)], begin, end - begin, number).tolist():
            piece = data[begin[i]:end[i]].tobytes()
            if piece not in self.clashes:
                self.clashes[piece] = int(self._store(np.zeros(1, U), [piece])[0])
            number[i] = self.clashes[piece]
        count = self.count[number]
        total = np.cumsum(count)
        take = np.repeat(self.first[number] - (total - count), count) + np.arange(total[-1] if len(total) else 0)
        return self.rows[take], count


class Encoder:
    """A tokenizer with the pieces it has met in this task."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        kind = str(self.tokenizer.pre_tokenizer)
        # both tokenizers used here cut words from signs; one keeps the space before a word, one drops it
        self.simple = WORD if self.tokenizer.normalizer is None and kind.startswith("ByteLevel(") else BARE if "Removed" in kind or "removed" in kind else None
        self.ids = Pieces(self._ids_of, 1)
        self.spans = Pieces(lambda pieces: [self._spans_of(p) for p in pieces], 2)

    def whole(self, text: str) -> bool:
        # also in another case, which lower-cased pieces would lose
        return any(t[0] in text and t.lower() in text.lower() for t in self.added) or bool((UNUSUAL_ASCII if text.isascii() else UNUSUAL).search(text))

    def _ids_of(self, pieces: list[str]) -> list[list[int]]:
        if not self.simple:
            return [self._ids_cut(p) for p in pieces]
        tokenize, bare, space = self.tokenize, self.simple is BARE, chr(_LETTER[32])
        out = []
        for p in pieces:
            if p.isascii() and (p.isalpha() or (p[0] == " " and p[1:].isalpha())):
                out.append([t.id for t in tokenize(p.lower().lstrip() if bare else p.replace(" ", space))])
            else:
                out.append(self._ids_cut(p))
        return out

    def _ids_cut(self, piece: str) -> list[int]:
        m = self.simple.match(piece) if self.simple else None
        if m:
            # a word and the signs after it: what the tokenizer's own cutting gives, straight to its merges
            word, signs = m.groups()
            if self.simple is BARE:
                word = word.lower()  # of these letters the same as the tokenizer's
            if self.simple is WORD or word.isalpha():  # else lower case made a letter and a mark of a letter
                return [t.id for part in (word, signs) if part for t in self.tokenize(_shown(part))]
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def _spans_of(self, piece: str) -> list[int]:
        m = WORD.match(piece) if self.simple is WORD else None
        if m:
            out, first = [], 0
            for part in m.groups():
                if part:
                    ends = list(accumulate(len(t.value) for t in self.tokenize(_shown(part))))  # in bytes
                    if not part.isascii():  # a token of a part of a character covers it
                        at = [i for i, c in enumerate(part) for _ in c.encode()]
                        out += [x for a, b in zip([0, *ends], ends) for x in (first + at[a], first + at[b - 1] + 1)]
                    else:
                        out += [x for a, b in zip([0, *ends], ends) for x in (first + a, first + b)]
                    first += len(part)
            return out
        return list(chain.from_iterable(self.tokenizer.encode(piece, add_special_tokens=False).offsets))

    def _slabs(self, texts: list[str], known: Pieces) -> Iterator[tuple[list[int], list[np.ndarray]]]:
        """For some texts at a time their numbers and rows; rows hold places in characters as from the piece's begin."""
        usual = [i for i, t in enumerate(texts) if not self.whole(t)]
        raw = [texts[i].encode() for i in usual]
        for x, y in slabs(raw, SLAB):
            data, starts = joined(raw[x:y])
            if not len(data):
                yield usual[x:y], [known.rows[:0]] * (y - x)
                continue
            begin, end = cut(data, starts, self.simple is BARE)
            if self.simple:
                begin, end = at_signs(data, starts, begin, end)
            if self.simple is BARE:
                data = lowered(data)
            rows, count = known.of(data, begin, end, Rolling(data).ranges(begin, end))
            first = np.searchsorted(begin, starts)
            if known.width == 2:
                chars = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
                of = np.repeat(np.arange(y - x), np.diff(first))
                rows = rows + np.repeat(chars[begin] - chars[starts[of]], count)[:, None]
            upto = np.r_[0, np.cumsum(count)][first]
            yield usual[x:y], [rows[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without special tokens."""
        out: list = [None] * len(texts)
        for numbers, rows in self._slabs(texts, self.ids):
            for i, r in zip(numbers, rows, strict=True):
                out[i] = r[:, 0].astype(np.uint32)
        return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) if r is None else r for t, r in zip(texts, out, strict=True)]

    def offsets_all(self, texts: list[str]) -> list[np.ndarray]:
        """(start, end) in characters of each token of each text."""
        out: list = [None] * len(texts)
        for numbers, rows in self._slabs(texts, self.spans):
            for i, r in zip(numbers, rows, strict=True):
                out[i] = r.astype(np.int64)
        return [np.array(self.tokenizer.encode(t, add_special_tokens=False).offsets, np.int64).reshape(-1, 2) if r is None else r for t, r in zip(texts, out, strict=True)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The task's encoder, kept by the worker for later tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(path: str, texts: list[str | None]) -> Iterator[np.ndarray]:
    """Ids of each text (null: empty), without special tokens."""
    plain = [t or "" for t in texts]
    for x, y in slabs(plain, CHARS):
        yield from encoder(path).encode_all(plain[x:y])


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
