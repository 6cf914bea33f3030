"""Word shingles as 64-bit hashes and their min-hash signatures, in numpy."""

from __future__ import annotations

import hashlib
import re

import numpy as np

SHINGLE = 5
COMPONENTS = 42
# Bytes that are cut into words at once; a longer text is taken in segments.
SEGMENT = 1 << 18
# Shingles that are hashed for all components at once.
BLOCK = 4096

_rng = np.random.default_rng(20)
_PLACES = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TIMES = _rng.integers(1, 1 << 63, COMPONENTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _rng.integers(1, 1 << 63, COMPONENTS, dtype=np.uint64)
_BYTE = _rng.integers(1, 1 << 63, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = [np.empty(0, np.uint64), np.empty(0, np.uint64)]
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_IN_WORD = np.array([not _BLANK.match(bytes([b])) for b in range(256)])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the byte multiplier and of its inverse."""
    if n > len(_POWERS[0]):
        size = max(n, SEGMENT)
        inverse = pow(int(_BYTE), -1, 1 << 64)
        for k, base in enumerate((_BYTE, np.uint64(inverse))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS[k] = np.multiply.accumulate(factors)
    return _POWERS[0], _POWERS[1]


def _segment(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first and last byte of each word; hashes are differences of prefix sums."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_WORD[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[0::2], edges[1::2]
    power, inverse = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mixed((sums[stops] - sums[starts]) * inverse[starts]), starts, stops


def word_spans(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, bytes and end of each word in order; whole words, however long."""
    raw = text.encode().lower()
    hashes, sizes, ends, at = [], [], [], 0
    while at < len(raw):
        cut = _BLANK.search(raw, at + SEGMENT) if at + SEGMENT < len(raw) else None
        stop = cut.end() if cut else len(raw)
        found, starts, stops = _segment(raw[at:stop])
        hashes.append(found)
        sizes.append(stops - starts)
        ends.append(stops + at)
        at = stop
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(sizes), np.concatenate(ends)


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct shingles of a text; a short text is one shingle.

    Letters A-Z count as lower case. Words are what ASCII white space separates.
    """
    hashes, _, _ = word_spans(text or "")
    if not len(hashes):
        return hashes
    size = min(SHINGLE, len(hashes))
    n = len(hashes) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total += hashes[k : k + n] * _PLACES[k]
    total = mixed(total)
    total.sort()
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def signature(found: np.ndarray) -> np.ndarray:
    """The min-hash signature of a non-empty set of shingles."""
    least = np.full(COMPONENTS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), BLOCK):
        block = found[None, at : at + BLOCK] * _TIMES[:, None] + _PLUS[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def digest(found: np.ndarray) -> bytes:
    """Equal for equal sets."""
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the intersection is at least so many per cent of the union."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (small + large - common)
