"""Word shingles of a text as sets of 64-bit hashes, without a loop over words."""

from __future__ import annotations

import hashlib

import numpy as np

from newsflow.llm.common import letters_lower, utf8

SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, made once a process."""

    def __init__(self):
        inv = pow(_BASE, -1, 1 << 64)
        n = SEGMENT + 1
        self.up = np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE, np.uint64)], dtype=np.uint64)
        self.down = np.cumprod(np.r_[np.uint64(1), np.full(n, inv, np.uint64)], dtype=np.uint64)


_powers: list[_Powers] = []


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xCF1BBCDCBFA56387)
    return h ^ (h >> np.uint64(32))


def words(text: str | None) -> list[bytes]:
    """A-Z lowered; words are runs without blank, tab, line and page ends."""
    return utf8(text).translate(letters_lower).split()


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    if not _powers:
        _powers.append(_Powers())
    up, down = _powers[0].up, _powers[0].down
    out, first, size = [], 0, 0
    for i in range(len(tokens) + 1):
        n = len(tokens[i]) + 1 if i < len(tokens) else SEGMENT + 1
        if size + n > SEGMENT and i > first:
            buf = np.frombuffer(b" ".join(tokens[first:i]) + b" ", np.uint8)
            ends = np.flatnonzero(buf == 32)
            starts = np.r_[0, ends[:-1] + 1]
            total = np.r_[np.uint64(0), np.cumsum((buf + np.uint64(1)) * up[:len(buf)], dtype=np.uint64)]
            out.append((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
            first, size = i, 0
        if i < len(tokens) and n > SEGMENT:  # one word longer than a segment
            out.append(np.frombuffer(hashlib.blake2b(tokens[i], digest_size=8).digest(), np.uint64))
            first, size = i + 1, 0
        else:
            size += n
    return mix(np.concatenate(out)) if out else np.empty(0, np.uint64)


def shingle_set(tokens: list[bytes], n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``n`` words; fewer words make one
    shingle, none make an empty set."""
    if not tokens:
        return np.empty(0, np.uint64)
    h = word_hashes(tokens)
    k = min(n, len(h))
    total = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        total = total + h[j:len(h) - k + 1 + j] * np.uint64((_BASE * (2 * j + 1) ** 3 + 2 * j) & _MASK | 1)
        total = total ^ (total >> np.uint64(31))
    return np.unique(mix(total))
