"""Words, word runs and character n-grams of many texts at once, as numpy hashes."""

from __future__ import annotations

import numpy as np

from skyledger.llm.batches import Texts

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _power(which: str, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        steps = np.full(max(n, 1 << 16), _BASE if which == "up" else _BASE_INVERSE, np.uint64)
        steps[0] = 1
        _powers[which] = np.cumprod(steps, dtype=np.uint64)
    return _powers[which][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def runs_of(mask: np.ndarray, offsets: np.ndarray):
    """Starts and ends of maximal runs of true that stay within one text."""
    before = np.zeros(len(mask), bool)
    before[1:] = mask[:-1]
    after = np.zeros(len(mask), bool)
    after[:-1] = mask[1:]
    inner = offsets[(offsets > 0) & (offsets < len(mask))]
    before[inner] = False
    after[inner - 1] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: differences of a running polynomial sum."""
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _power("up", len(buf)), out=total[1:])
    return mix((total[ends] - total[starts]) * _power("down", len(buf) + 1)[starts])


class Words:
    """Words of all texts in order: byte spans, hashes, and the text of each."""

    def __init__(self, texts: Texts, space: np.ndarray = SPACE):
        self.texts = texts
        self.starts, self.ends = runs_of(~space[texts.buf], texts.offsets)
        self.hashes = span_hashes(texts.buf, self.starts, self.ends)
        first = np.searchsorted(self.starts, texts.offsets)
        self.first = first  # number of the first word of each text, and the total
        self.counts = np.diff(first)
        self.doc = texts.owner(self.counts)

    def windows(self, n: int):
        """(position, hash) of every run of n words that lies within one text."""
        h = self.hashes
        if len(h) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        made = np.zeros(len(h) - n + 1, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(n):
                made = made * np.uint64(_BASE) + h[i : len(h) - n + 1 + i]
        inside = np.flatnonzero(self.doc[: len(made)] == self.doc[n - 1 :])
        return inside, mix(made[inside])


def seen_before(doc: np.ndarray, hashes: np.ndarray):
    """Two masks over the items: equal to an earlier one of its text; equal to any other."""
    with np.errstate(over="ignore"):
        key = hashes + doc.astype(np.uint64) * np.uint64(_BASE)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    later = np.zeros(len(key), bool)
    later[order[1:][same]] = True
    both = later.copy()
    both[order[:-1][same]] = True
    return later, both


def byte_grams(buf: np.ndarray, offsets: np.ndarray, n: int):
    """(position, 32-bit code) of every run of n <= 4 bytes within one text."""
    if len(buf) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    m = len(buf) - n + 1
    code = buf[:m].astype(np.uint32)
    for i in range(1, n):
        code |= buf[i : m + i].astype(np.uint32) << np.uint32(8 * i)
    ok = np.ones(m, bool)
    for i in range(1, n):  # starts of the last n-1 bytes of each text
        cut = offsets[1:] - i
        cut = cut[(cut >= 0) & (cut < m)]
        ok[cut] = False
    where = np.flatnonzero(ok)
    return where, code[where]


def bucket(codes: np.ndarray, bits: int, salt: int = 0) -> np.ndarray:
    """Bucket numbers in [0, 2**bits) of 32- or 64-bit codes."""
    if codes.dtype == np.uint64:
        return (codes >> np.uint64(64 - bits)).astype(np.int32)
    with np.errstate(over="ignore"):
        spread = (codes ^ (codes >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        spread = (spread ^ (spread >> np.uint32(12)) ^ np.uint32(salt)) * np.uint32(0x297A2D39)
    return (spread >> np.uint32(32 - bits)).astype(np.int32)
