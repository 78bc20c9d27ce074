"""Vectorised hashes of words and windows over UTF-8 bytes, for use inside tasks.

Everything here takes one buffer that holds many texts one after the other, so
that numpy works on long arrays whatever the length of a text.

`Keyed` decides equality: two bases modulo the prime 2^31 - 1, drawn from a key that the
driver takes anew for every run and ships to the tasks, so no text can be written that
collides.  `Rolling` is cheaper and works modulo 2^64, where some long strings collide
whatever the base: it only finds candidates, which its users compare by their bytes.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

U = np.uint64
# of this process alone
_ODD = U(secrets.randbits(63) << 1 | 1)
_BYTE = np.random.default_rng(secrets.randbits(63)).integers(1, 2**63, 256, dtype=np.uint64) | U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    y = x >> U(30)
    y ^= x
    x = y
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _powers(n: int, base: np.uint64) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.empty(n, U)
    out[:1] = 1
    k = 1
    while k < n:
        m = min(k, n - k)
        out[k:k + m] = out[:m] * (out[k - 1:k] * base)  # arrays wrap around without a warning
        k += m
    return out


@lru_cache(maxsize=2)
def _shared(key: int) -> tuple[np.ndarray, np.uint64]:
    """Letters and base that all tasks of a run have in common."""
    rng = np.random.default_rng([key, 1])
    return rng.integers(1, 2**63, 256, dtype=np.uint64) | U(1), U(int(rng.integers(1, 2**62)) << 1 | 1)


_KEPT = 1 << 18  # powers of one base that a worker keeps


@lru_cache(maxsize=4)
def _kept_powers(base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    return _powers(_KEPT, base), _powers(_KEPT, U(pow(int(base), -1, 2**64)))


class Rolling:
    """Hash of any range of one buffer, of bytes or of other numbers, from prefix sums; for candidates only."""

    def __init__(self, data: np.ndarray, key: int | None = None):
        """With a key, hashes are the same in all tasks that have it."""
        n = len(data)
        self.prefix = np.zeros(n + 1, U)
        table, base = (_BYTE, _ODD) if key is None else _shared(key)
        letters = table[data] if data.dtype == np.uint8 else mix(data.astype(U) + base)
        power, inverse = _kept_powers(base) if n < _KEPT else (_powers(n, base), _powers(n + 1, U(pow(int(base), -1, 2**64))))
        np.cumsum(letters * power[:n], out=self.prefix[1:])
        self.inverse = inverse[:n + 1]

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.prefix[end] - self.prefix[start]) * self.inverse[start]
        return mix(h ^ ((end - start).astype(U) * U(0xD6E8FEB86659FD93)))

    def windows(self, width: int) -> np.ndarray:
        """Hash of every window of the width, by its start."""
        m = len(self.prefix) - width
        if m <= 0:
            return np.empty(0, U)
        return mix((self.prefix[width:] - self.prefix[:m]) * self.inverse[:m])


_P = U((1 << 31) - 1)


def _fold(x: np.ndarray) -> np.ndarray:
    """Of numbers below 2^62 the rest modulo 2^31 - 1, which may be left as 2^31 - 1 for 0."""
    y = x >> U(31)
    y += x & _P
    z = y >> U(31)
    y &= _P
    y += z
    return y


class _Base:
    """Powers of one base and of its inverse, kept by the worker as far as they were needed."""

    def __init__(self, base: int, letters: np.ndarray):
        self.letters = letters
        self.roots = (base, pow(base, -1, int(_P)))
        self.powers = [np.ones(1, U), np.ones(1, U)]

    def upto(self, n: int) -> list[np.ndarray]:
        while len(self.powers[0]) < n:
            k = len(self.powers[0])
            self.powers = [np.r_[x, _fold(x * U(pow(root, k, int(_P))))] for x, root in zip(self.powers, self.roots, strict=True)]
        return self.powers


@lru_cache(maxsize=2)
def _bases(key: int) -> tuple[_Base, _Base]:
    rng = np.random.default_rng(key)
    a, b = (_Base(int(rng.integers(1 << 20, int(_P) - 1)), rng.integers(1, int(_P), 256).astype(U)) for _ in range(2))
    return a, b


def new_key() -> int:
    """Drawn by the driver, once a run."""
    return secrets.randbits(63)


class Keyed:
    """Hash of any range of a buffer of bytes; equal ranges are told from others but for
    a chance of 2^-62 or, for strings of n bytes chosen without the key, (n / 2^31)^2."""

    def __init__(self, data: np.ndarray, key: int):
        self.sums, self.inverses = [], []
        n = len(data)
        for base in _bases(key):
            power, inverse = base.upto(n + 1)
            prefix = np.zeros(n + 1, U)
            np.cumsum(_fold(base.letters[data] * power[:n]), out=prefix[1:])  # below 2^31 each
            self.sums.append(prefix)
            self.inverses.append(inverse)

    @staticmethod
    def _joined(parts: list[np.ndarray], length) -> np.ndarray:
        for x in parts:
            x[x == _P] = 0
        return mix((parts[0] << U(31) | parts[1]) ^ length * U(0xD6E8FEB86659FD93))

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._joined([_fold(_fold(p[end] - p[start]) * i[start]) for p, i in zip(self.sums, self.inverses, strict=True)], (end - start).astype(U))

    def windows(self, width: int) -> np.ndarray:
        """Hash of every window of the width, by its start."""
        m = len(self.sums[0]) - width
        if m <= 0:
            return np.empty(0, U)
        return self._joined([_fold(_fold(p[width:] - p[:m]) * i[:m]) for p, i in zip(self.sums, self.inverses, strict=True)], np.full(1, width, U))


def slabs(texts: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about `limit` bytes each."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def joined(texts: list[bytes], gap: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other as bytes, and where each starts (with the end)."""
    lengths = np.fromiter((len(t) + len(gap) for t in texts), np.int64, len(texts))
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths, out=starts[1:])
    return np.frombuffer(gap.join([*texts, b""]), np.uint8), starts


PLACE_BITS = 24


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first smallest value (by its upper bits) of each window.
    The position is packed under the value, so one minimum finds both."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    if len(values) >> PLACE_BITS:
        raise ValueError("a slab is longer than positions can be packed")
    place = U((1 << PLACE_BITS) - 1)
    low = (values & ~place) | np.arange(len(values), dtype=U)
    span = 1
    while span * 2 <= width:  # minima of 2, 4, 8 ... values
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    least = np.minimum(low[:n], low[width - span: width - span + n])
    return (least & place).astype(np.int64)
