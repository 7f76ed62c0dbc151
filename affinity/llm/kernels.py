"""Vectorised byte and word kernels used inside Arrow tasks.

Texts are handled in blocks of about `BLOCK_BYTES`, so the arrays of a task stay small; a
single longer text makes a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BLOCK_BYTES = 1 << 19

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply)."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit constants that depend on the seed alone."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


_BYTE_VALUE = odd_constants(256, 1)
_PLACE = odd_constants(64, 2)
_powers = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, grown by doubling and kept per process."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(20, (n - 1).bit_length())
        have = np.ones(1, dtype=np.uint64)
        while len(have) < size:
            have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
        _powers[base] = have
    return have[:n]


def blocks(texts: Sequence[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges [lo, hi) whose texts add up to about `limit` bytes."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


class Words:
    """Words of a block of texts: per word its 64-bit hash, per text the range of words.

    `breaks` is a 256-entry boolean table of the bytes that separate words.
    """

    def __init__(self, texts: Sequence[bytes], breaks: np.ndarray):
        joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        text_start = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
        inside = np.concatenate([[False], ~breaks[joined]])
        change = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = change[0::2], change[1::2]
        self.bounds = np.concatenate([np.searchsorted(self.starts, text_start), [len(self.starts)]])
        total = np.empty(len(joined) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(_BYTE_VALUE[joined] * powers(_BASE, len(joined)), out=total[1:])
        h = (total[self.ends] - total[self.starts]) * powers(_INVERSE, len(joined))[self.starts]
        self.hashes = mix(h + (self.ends - self.starts).astype(np.uint64))

    def shingles(self, k: int) -> list[np.ndarray]:
        """Per text the sorted distinct 64-bit hashes of its k-word shingles; a text of
        fewer words has its whole word sequence as its one shingle, one without words none."""
        w, n = self.hashes, len(self.hashes)
        counts = np.diff(self.bounds)
        owner_end = np.repeat(self.bounds[1:], counts)
        at = np.arange(n)
        acc = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            part = np.zeros(n, dtype=np.uint64)
            part[: max(0, n - j)] = w[j:]
            part[at + j >= owner_end] = 0
            acc += part * _PLACE[j]
        size = np.minimum(np.repeat(counts, counts), k).astype(np.uint64)
        acc = mix(acc + size * _PLACE[k])
        out = []
        for lo, hi in zip(self.bounds[:-1], self.bounds[1:]):
            last = max(lo + 1, hi - k + 1) if hi > lo else lo
            out.append(np.unique(acc[lo:last]))
        return out


def byte_table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[np.frombuffer(chars, dtype=np.uint8)] = True
    return t


#: Fixed value: the white space of the word rule `[^\x20\x09-\x0D]+`.
SPACES = byte_table(b" \t\n\x0b\x0c\r")
#: Every ASCII byte that is neither a letter nor a digit; bytes of other characters join words.
NOT_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
