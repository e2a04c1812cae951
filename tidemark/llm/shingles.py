"""Hashes of word shingles for batches of texts, vectorised over the bytes of the batch.

ASCII letters are lower-cased; words are separated by space and tab to carriage return.
A word's hash is a polynomial over its bytes modulo 2**64, read off running sums, so no
text is walked in Python. A text with fewer words than the width is one shingle.
"""

from __future__ import annotations

import numpy as np

_GAP = np.zeros(256, dtype=bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (64-bit integers, in place on a copy)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_LETTER = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n + 1:
        size = max(n + 1, 1 << 20)
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for base in (_BASE, inverse):
            t = np.full(size, base, dtype=np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=np.uint64))
        _powers[:] = tables
    return _powers[0][: n + 1], _powers[1][: n + 1]


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (uint64) of each text; texts without words have none."""
    flat, bounds = shingle_list(texts, width)
    return [np.unique(flat[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def shingle_list(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """All shingle hashes of the texts in order, and where each text's begin (one more at the end)."""
    coded = [(t or "").encode().lower() for t in texts]
    data = b"\n".join(coded) + b"\n"
    raw = np.frombuffer(data, dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(c) + 1 for c in coded])])
    gap = _GAP[raw]
    edge = np.diff(np.concatenate([[True], gap]).astype(np.int8))
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, inverse = _power_tables(len(raw))
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_LETTER[raw] * power[: len(raw)], dtype=np.uint64, out=sums[1:])
    words = mixed((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))
    begin = np.searchsorted(first, offsets)
    count = np.diff(begin)
    parts = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(parts)])
    multipliers = mixed(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
    total = max(len(words) - width + 1, 0)
    full = np.zeros(total, dtype=np.uint64)
    for j in range(width):
        full += words[j : j + total] * multipliers[j]
    owner = np.repeat(np.arange(len(texts)), parts)
    place = begin[owner] + np.arange(len(owner)) - bounds[owner]
    out = np.zeros(len(owner), dtype=np.uint64)
    long = count[owner] >= width
    out[long] = full[place[long]]
    for m in range(1, width):
        at = np.flatnonzero(count[owner] == m)
        if len(at):
            for j in range(m):
                out[at] += words[place[at] + j] * multipliers[j]
            out[at] += np.uint64((m + 1) * 0xA24BAED4963EE407 % (1 << 64))
    return mixed(out), bounds
